"""One named query per operator. Each reads whole tables from a folder and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidelake.functions import as_type, transform
from tidelake.operators import (
    chosen_image, events_of, insert_absent, merge, parse_records, record_kind, reject_counts, snapshot_events,
)
from tidelake.operators.envelope import MALFORMED
from tidelake.plans import analytics, gold, metrics, quality
from tidelake.plans.checks import Checks
from tidelake.plans.delta import refresh_changed
from tidelake.plans.distinct import daily_bitmaps, rolled_up
from tidelake.plans.pipeline import (
    EPOCH, Lakehouse, apply_events, merge_new_events, rebuild, refresh_reports, side_by_side, stage,
)
from tidelake.schemas import CLOCK, DAY, ENTITIES, FOREIGN_KEYS
from tidelake.session import configure, scratch_folder
from tidelake.sources import shop_sample as shop
from tidelake.sources.event_log import append_events, close_days, read_new_events, stream_events
from tidelake.sources.files import EXPORT_FILES, load_csv, read_record_files
from tidelake.sources.storage import totals
from tidelake.sources.tables import ReportTable, stored
from tidelake.streaming import start_histogram, start_ingest, start_state
from tidelake.streaming.ingest import DRAIN

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Buckets and record files for small tables, and the bytes of input that one more of each stands for:
# what one task holds does not grow with the tables.
SHARED_BUCKETS, BUCKET_BYTES = 2, 64 << 20
RECORD_FILES, RECORD_BYTES = 6, 16 << 20
WATERMARK = datetime(2024, 1, 1, 0, 0, 30)


def named(name: str, run: Query) -> None:
    def configured(spark: SparkSession, folder: str) -> DataFrame:
        return run(configure(spark), folder)

    QUERIES[name] = configured


def query(run: Query) -> Query:
    named(run.__name__, run)
    return run


def updated_at(batch: int) -> Column:
    """A fixed update time per batch, one minute apart, in place of the clock."""
    return F.lit(f"2024-01-01T00:{batch:02d}:00").cast("timestamp_ntz")


def parsed(records: DataFrame) -> DataFrame:
    return parse_records(records, ingested_at=F.col("timestamp"))


def events(spark: SparkSession, folder: str, *names: str) -> DataFrame:
    return events_of(parsed(shop.all_changes(spark, folder, names or tuple(ENTITIES))))


def staged_batch(spark: SparkSession, folder: str, name: str, batch: int, ops: str = "crud") -> DataFrame:
    records = shop.changes(spark, folder, name).filter(F.col("batch") == batch)
    wanted = events_of(parsed(records)).filter(F.col("_cdc_op").isin(*ops))
    return stage(wanted, ENTITIES[name], updated_at(batch))


def no_rows(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], ENTITIES[name].state)


def after_batches(spark: SparkSession, folder: str, name: str, *batches: int, **kept: str) -> DataFrame:
    """State of a table after merging batches in the given order."""
    state = no_rows(spark, name)
    for batch in batches:
        state = merge(state, staged_batch(spark, folder, name, batch, kept.get(f"ops_{batch}", "crud")), ENTITIES[name])
    return state


def order_state(rows: DataFrame) -> DataFrame:
    return rows.select(
        "order_id", "customer_id", "status", "purchased_at", "estimated_delivery_date", "is_deleted",
        "_cdc_op", "_cdc_source_ts_ms", "_cdc_offset", "_silver_updated_at",
    )


def new_lake(spark: SparkSession, folder: str, label: str) -> Lakehouse:
    """An empty lakehouse in a new shared folder, with buckets for the tables in ``folder``."""
    return Lakehouse(spark, scratch_folder(spark, label), max(SHARED_BUCKETS, -(-shop.size(spark, folder) // BUCKET_BYTES)))


def file_scale(spark: SparkSession, folder: str) -> int:
    """How many times the record files of small tables the tables in ``folder`` need."""
    return max(1, -(-shop.size(spark, folder) // (RECORD_FILES * RECORD_BYTES)))


def filled_log(spark: SparkSession, folder: str, names=tuple(ENTITIES), label: str = "log") -> Lakehouse:
    """A lakehouse in a new shared folder whose event log holds the history of ``names``."""
    lake = new_lake(spark, folder, label)
    append_events(events(spark, folder, *names), lake.log_root, "load", 0)
    return lake


# ---- current state per entity, analytic queries, reports ----------------------------------------

for _entity in ENTITIES.values():
    named(
        f"silver_{_entity.name}",
        lambda spark, folder, e=_entity: stage(events(spark, folder, e.name), e, updated_at(0)).drop("_silver_updated_at"),
    )

_ANALYTICS = {
    "q01_daily_revenue": (analytics.daily_revenue, gold.READS["daily_revenue"]),
    "q02_top_sellers": (analytics.top_sellers, gold.READS["top_sellers"]),
    "q03_review_sentiment": (analytics.review_sentiment, gold.READS["review_sentiment_by_state"]),
    "q04_order_funnel": (partial(analytics.order_funnel, one_row_per_order=True), ("orders",)),
    "q04_order_funnel_distinct": (analytics.order_funnel, ("orders",)),
    "q05_cohort_retention": (analytics.cohort_retention_window, ("orders",)),
    "q05_cohort_retention_join": (analytics.cohort_retention, ("orders",)),
    "q05_cohort_retention_window": (analytics.cohort_retention_window, ("orders",)),
    "gold_top_sellers_order_rate": (gold.top_sellers_order_rate, gold.READS["top_sellers"]),
    **{f"gold_{name}": (model, gold.READS[name]) for name, model in gold.MODELS.items()},
}
for _name, (_plan, _reads) in _ANALYTICS.items():
    named(_name, lambda spark, folder, p=_plan, r=_reads: p(shop.current_tables(spark, folder, r)))


def report_tables(spark: SparkSession, folder: str, *names: str) -> dict[str, ReportTable]:
    """Reports computed and stored."""
    lake = new_lake(spark, folder, "reports")
    for name in names:
        rows = gold.MODELS[name](shop.current_tables(spark, folder, gold.READS[name]))
        lake.report_table(name).publish(rows)
    return {name: lake.report_table(name) for name in names}


def stored_reports(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    """Reports computed, stored and read back."""
    return {name: table.read() for name, table in report_tables(spark, folder, *names).items()}


_READS = {"mv_q01": "daily_revenue", "mv_q02": "top_sellers", "mv_q03": "review_sentiment_by_state", "mv_q04": "order_funnel"}
for _name, _report in _READS.items():
    named(_name, lambda spark, folder, r=_report: analytics.stored_read(r, report_tables(spark, folder, r)[r]))


@query
def active_rows(spark, folder):
    tables = shop.current_tables(spark, folder)
    counted = [
        rows.agg(F.count("*").alias("row_count"), F.count_if(F.col("is_deleted") == F.lit(False)).alias("active_count"))
        .select(F.lit(name).alias("table_name"), "row_count", "active_count")
        for name, rows in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


# ---- event log ----------------------------------------------------------------------------------


def log_columns(rows: DataFrame) -> DataFrame:
    """Log rows without the image texts, whose writing differs between engines."""
    return rows.select(
        "source_table", "_cdc_op", "_cdc_source_ts_ms", "_cdc_event_ts_ms",
        F.col("_cdc_ingested_at").cast("timestamp_ntz").alias("_cdc_ingested_at"),
        "_cdc_topic", "_cdc_partition", "_cdc_offset",
        F.col("before_json").isNotNull().alias("has_before"), F.col("after_json").isNotNull().alias("has_after"),
        F.get_json_object("after_json", "$.order_status").alias("after_status"),
    )


@query
def bronze_parse(spark, folder):
    return log_columns(events(spark, folder))


@query
def bronze_malformed_count(spark, folder):
    rows = parsed(shop.all_changes(spark, folder))
    return rows.groupBy(F.col("_cdc_topic").alias("topic"), record_kind(rows).alias("kind")).agg(F.count("*").alias("records"))


@query
def bronze_route_counts(spark, folder):
    return filled_log(spark, folder, label="route").events().groupBy("source_table", "ingest_date").agg(
        F.count("*").alias("row_count"), F.count_if(F.col("_cdc_op") == "d").alias("deletes")
    )


@query
def bronze_scan(spark, folder):
    return log_columns(filled_log(spark, folder, ("orders", "customers"), "scan").events("orders"))


@query
def bronze_incremental(spark, folder):
    lake = filled_log(spark, folder, ("orders",), "incremental")
    return log_columns(read_new_events(spark, lake.log_root, "orders", WATERMARK))


@query
def bronze_closed_days(spark, folder):
    """Orders of a log whose batches came a day apart: the first two days are closed, one at a time, and
    a late batch comes for the first. What is read since a moment of the second day has the name ``new``."""
    lake = new_lake(spark, folder, "closed")
    for batch in (1, 2, 3):
        records = shop.changes(spark, folder, "orders").where(F.col("batch") == batch)
        rows = events_of(parse_records(records, F.timestamp_seconds(F.lit(1_704_067_200 + 86_400 * batch))))
        late = F.col("_cdc_offset") % 4 == 0
        append_events(rows.where(~late), lake.log_root, "run", batch)
        close_days(spark, lake.log_root, date(2024, 1, min(batch + 1, 3)))
        append_events(rows.where(late), lake.log_root, "late run", batch)
    parts = {"all": lake.events("orders"), "new": read_new_events(spark, lake.log_root, "orders", datetime(2024, 1, 2, 12))}
    return reduce(DataFrame.unionByName, [
        rows.select(F.lit(name).alias("part"), "ingest_date", "run_id", "batch_id", "_cdc_op", "_cdc_source_ts_ms", "_cdc_offset") for name, rows in parts.items()
    ])


def snapshot_loaded(rows: DataFrame, name: str) -> DataFrame:
    loaded = snapshot_events(rows, name, f"shop.public.{name}", F.lit("2024-01-01T00:00:00").cast("timestamp"))
    return loaded.withColumn("_cdc_ingested_at", F.col("_cdc_ingested_at").cast("timestamp_ntz"))


@query
def bronze_snapshot_encode(spark, folder):
    return snapshot_loaded(shop.current(spark, folder, "customers").drop("is_deleted"), "customers")


@query
def bronze_snapshot_times(spark, folder):
    """Orders whose times have microseconds, made of their keys, through the snapshot form and back."""
    orders = ENTITIES["orders"]
    rows = shop.mapped(spark, folder, "orders")
    fine = F.timestamp_add("MICROSECOND", (F.col("m") * 7919 % 1_000_000).cast("int"), F.col("purchased_at"))
    source = rows.withColumn("purchased_at", fine).select(*[F.col(c).alias(orders.source_field(c)) for c in orders.columns])
    return stage(snapshot_loaded(source, "orders"), orders, updated_at(0)).select("order_id", "purchased_at", "estimated_delivery_date")


def ingested(spark: SparkSession, folder: str, names=tuple(ENTITIES), parts: int = RECORD_FILES) -> Lakehouse:
    """The history as record files, taken into the log by the stream a third of the files at a time."""
    lake = new_lake(spark, folder, "stream")
    scale = file_scale(spark, folder)
    shop.dealt_changes(spark, folder, parts * scale, names).drop("batch").write.parquet(f"{lake.root}/records")
    start_ingest(
        read_record_files(spark, f"{lake.root}/records", max_files=2 * scale), lake.log_root,
        f"{lake.root}/checkpoints/ingest", DRAIN, ingested_at=F.col("timestamp"),
    ).awaitTermination()
    return lake


def logged_counts(lake: Lakehouse) -> DataFrame:
    return lake.events().where(F.col("_cdc_op").isNotNull()).groupBy("source_table", "_cdc_op").agg(
        F.count("*").alias("row_count"), F.min("_cdc_offset").alias("first_offset"),
        F.max("_cdc_offset").alias("last_offset"), F.count_distinct("_cdc_partition").alias("partitions"),
    )


@query
def bronze_stream_ingest(spark, folder):
    return logged_counts(ingested(spark, folder))


@query
def bronze_stream_dedup(spark, folder):
    """As ``bronze_stream_ingest``, each position once, from files that hold all records of the later
    batches a second time; the sample repeats some of the first batch itself. Its records that are no
    events share an event's position, so they get others, as a broker would give them."""
    lake = new_lake(spark, folder, "dedup")
    no_event = F.col("value").isNull() | (F.col("value") == F.lit("not json").cast("binary"))
    scale = file_scale(spark, folder)
    again = shop.all_changes(spark, folder).where(F.col("batch") > 1).repartition(4 * scale)
    for part in (shop.dealt_changes(spark, folder, 4 * scale), again):
        part.withColumn("offset", F.when(no_event, -1 - F.col("offset")).otherwise(F.col("offset"))).drop("batch").write.mode("append").parquet(f"{lake.root}/records")
    start_ingest(
        read_record_files(spark, f"{lake.root}/records", max_files=3 * scale), lake.log_root,
        f"{lake.root}/checkpoints/ingest", DRAIN, F.col("timestamp"), drop_repeats="1 hour",
    ).awaitTermination()
    return logged_counts(lake)


@query
def bronze_stream_malformed(spark, folder):
    """Malformed records stay in the log beside the events, with their text."""
    kept = ingested(spark, folder, ("orders",)).events(MALFORMED)
    return kept.groupBy("source_table", F.col("after_json").alias("record_text")).agg(F.count("*").alias("row_count"))


@query
def silver_payload_choice(spark, folder):
    return events(spark, folder, "orders").select(
        "_cdc_offset", "_cdc_op", F.when(F.col("_cdc_op") == "d", "before").otherwise("after").alias("image"),
        F.get_json_object(chosen_image(), "$.order_id").alias("order_id"),
        F.get_json_object(chosen_image(), "$.order_status").alias("status"),
    )


@query
def silver_rejected_rows(spark, folder):
    """What cannot be merged or decoded. Orders come damaged: in after-images every tenth has no
    key and every seventh an unreadable purchase time."""
    number = F.floor(F.col("_cdc_offset") / 6)

    def damaged(rows: DataFrame) -> DataFrame:
        no_key = F.regexp_replace("after_json", '"order_id":"[0-9]+"', '"order_id":null')
        rows = rows.withColumn("after_json", F.when(number % 10 == 0, no_key).otherwise(F.col("after_json")))
        bad_time = F.regexp_replace("after_json", '"order_purchase_timestamp":[^,}]*', '"order_purchase_timestamp":"never"')
        return rows.withColumn("after_json", F.when(number % 7 == 0, bad_time).otherwise(F.col("after_json")))

    counted = []
    for entity in ENTITIES.values():
        rows = events(spark, folder, entity.name)
        counted.append(reject_counts(damaged(rows) if entity.name == "orders" else rows, entity))
    return reduce(DataFrame.unionByName, counted)


@query
def decode_epoch_micros(spark, folder):
    rows = shop.current(spark, folder, "orders").select(
        "order_id", F.unix_micros(F.col("purchased_at").cast("timestamp")).alias("micros")
    )
    return rows.withColumn("decoded", as_type(F.col("micros").cast("string"), CLOCK))


@query
def decode_epoch_days(spark, folder):
    rows = shop.current(spark, folder, "orders").select("order_id", F.unix_date("estimated_delivery_date").alias("days"))
    return rows.withColumn("decoded", as_type(F.col("days").cast("string"), DAY))


@query
def partition_transforms(spark, folder):
    """Rows per partition. Bucket numbers are engine-specific, so buckets give their invariants."""
    tables = shop.current_tables(spark, folder)

    def counted(table: str, kind: str, column: str) -> DataFrame:
        part = transform(kind, F.col(column)).cast("string")
        return tables[table].groupBy(part.alias("part")).agg(F.count("*").alias("row_count")).select(
            F.lit(table).alias("table_name"), F.lit(kind).alias("transform"), "part", "row_count"
        )

    def in_range(table: str, column: str) -> DataFrame:
        bucket = transform("bucket", F.col(column))
        return tables[table].groupBy(column).agg(
            F.count("*").alias("n"), F.min(bucket).alias("low"), F.max(bucket).alias("high")
        ).agg(F.sum(F.when((F.col("low") == F.col("high")) & F.col("low").between(0, 7), F.col("n"))).alias("row_count")).select(
            F.lit(table).alias("table_name"), F.lit("bucket").alias("transform"), F.lit("one of 8 per key").alias("part"), "row_count"
        )

    parts = [
        in_range(e.name, e.layout[1]) if e.layout[0] == "bucket" else counted(e.name, *e.layout) for e in ENTITIES.values()
    ]
    parts.append(counted("orders", "day", "purchased_at"))
    return reduce(DataFrame.unionByName, parts)


@query
def csv_load_roundtrip(spark, folder):
    """Orders written as a delimited export and loaded from it again."""
    orders = ENTITIES["orders"]
    exports = scratch_folder(spark, "csv")
    shop.current(spark, folder, "orders").select(
        *[F.col(name).alias(orders.source_field(name)) for name in orders.columns]
    ).write.csv(f"{exports}/orders.csv", header=True, nullValue="", escape='"')
    return load_csv(spark, exports)["orders"]


@query
def csv_load_exports(spark, folder):
    """All seven exports written and loaded: rows, filled fields, characters of the reviews' texts.

    Reviews carry a text with quotes and a line break, made of their key.
    """
    exports = scratch_folder(spark, "exports")

    def export(name: str) -> None:
        entity = ENTITIES[name]
        rows = shop.mapped(spark, folder, name)
        if name == "order_reviews":
            text = F.concat(F.lit('said "'), F.col("m").cast("string"), F.lit('"\nand, then, no more'))
            rows = rows.withColumn("review_comment_msg", text)
        rows.select(*[F.col(c).alias(entity.source_field(c)) for c in entity.columns]).write.csv(
            f"{exports}/{EXPORT_FILES[name]}", header=True, nullValue="", escape='"', quote='"'
        )

    side_by_side(spark, export, ENTITIES)
    counted = []
    for name, rows in load_csv(spark, exports).items():
        filled = reduce(lambda a, b: a + b, [F.count(c) for c in rows.columns])
        chars = F.sum(F.length("review_comment_msg")) if name == "order_reviews" else F.lit(0)
        counted.append(rows.agg(F.count("*").alias("row_count"), filled.alias("filled_fields"), chars.cast("bigint").alias("text_chars"))
                       .select(F.lit(name).alias("table_name"), "row_count", "filled_fields", "text_chars"))
    return reduce(DataFrame.unionByName, counted)


# ---- merge --------------------------------------------------------------------------------------


@query
def silver_dedup_latest(spark, folder):
    return shop.latest_lines(spark, folder)


@query
def merge_insert(spark, folder):
    return order_state(after_batches(spark, folder, "orders", 1))


@query
def merge_update(spark, folder):
    return order_state(after_batches(spark, folder, "orders", 1, 2, ops_2="u"))


@query
def merge_delete(spark, folder):
    return order_state(after_batches(spark, folder, "orders", 1, 2))


@query
def merge_delete_unknown_key(spark, folder):
    """Deletes that arrive before anything else about their rows: inserted, marked deleted."""
    return order_state(after_batches(spark, folder, "orders", 2, ops_2="d"))


@query
def merge_revive(spark, folder):
    return order_state(after_batches(spark, folder, "orders", 1, 2, 3))


@query
def merge_late_event(spark, folder):
    """Batches in reverse order: older events find newer rows and are ignored."""
    return order_state(after_batches(spark, folder, "orders", 3, 2, 1)).drop("_silver_updated_at")


@query
def merge_replay(spark, folder):
    """Every batch twice, and all of them a third time in the wrong order."""
    return order_state(after_batches(spark, folder, "orders", 1, 1, 2, 2, 3, 3, 2, 1)).drop("_silver_updated_at")


@query
def merge_insert_ignore(spark, folder):
    """Customers not deleted are there already; staging all of them adds only the others."""
    customers = ENTITIES["customers"]
    everyone = stage(events(spark, folder, "customers"), customers, updated_at(0))
    there = everyone.filter(F.col("is_deleted") == F.lit(False))
    staged = everyone.withColumn("customer_city", F.lit("staged"))
    return insert_absent(there, staged, customers).select("customer_id", "customer_city", "customer_state", "is_deleted")


def published(spark: SparkSession, folder: str, names=tuple(ENTITIES)) -> Lakehouse:
    """Current-state tables after publishing the three batches one after the other."""
    lake = new_lake(spark, folder, "publish")

    def publish(name: str) -> None:
        for batch in (1, 2, 3):
            records = shop.changes(spark, folder, name).filter(F.col("batch") == batch)
            apply_events(lake, name, events_of(parsed(records)), updated_at(batch))

    side_by_side(spark, publish, names)
    return lake


@query
def silver_row_counts(spark, folder):
    tables = published(spark, folder).tables()
    counted = [
        rows.agg(F.count("*").alias("row_count"), F.count_if("is_deleted").alias("deleted_count"))
        .select(F.lit(name).alias("table_name"), "row_count", "deleted_count")
        for name, rows in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


@query
def silver_as_of(spark, folder):
    """Orders as the log has them after each of three batches, ingested a minute apart."""
    lake = new_lake(spark, folder, "as-of")
    records = shop.changes(spark, folder, "orders")
    minute = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("batch") * 60)
    append_events(events_of(parse_records(records.withColumn("timestamp", minute), F.col("timestamp"))), lake.log_root, "load", 0)
    versions = [
        lake.state_as_of("orders", datetime(2024, 1, 1, 0, v), updated_at(v))
        .select(F.lit(v).alias("version"), "order_id", "status", "is_deleted", "_cdc_op")
        for v in (1, 2, 3)
    ]
    return reduce(DataFrame.unionByName, versions)


@query
def silver_as_of_kept(spark, folder):
    """As ``silver_as_of``, of batches that come a day apart, from the states kept after the first and the second."""
    lake = new_lake(spark, folder, "as-of")
    for batch in (1, 2, 3):
        records = shop.changes(spark, folder, "orders").where(F.col("batch") == batch)
        arrived = F.timestamp_seconds(F.lit(1_704_067_200 + 86_400 * batch))
        append_events(events_of(parse_records(records, arrived)), lake.log_root, "load", batch)
        if batch < 3:
            lake.keep_state("orders", datetime(2024, 1, 1 + batch, 12), updated_at(batch))
    versions = [
        lake.state_as_of("orders", datetime(2024, 1, 1 + v, 18), updated_at(v))
        .select(F.lit(v).alias("version"), "order_id", "status", "is_deleted", "_cdc_op")
        for v in (1, 2, 3)
    ]
    return reduce(DataFrame.unionByName, versions)


@query
def silver_incremental_merge(spark, folder):
    """Only events past the watermark are merged, into a table that already has the earlier ones."""
    lake = filled_log(spark, folder, ("orders",), "watermark")
    merge_new_events(lake, EPOCH, updated_at(1), ("orders",))
    merge_new_events(lake, WATERMARK, updated_at(2), ("orders",))
    return order_state(lake.state("orders")).drop("_silver_updated_at")


def moved_orders(spark: SparkSession, folder: str) -> DataFrame:
    """A later update of every seventh order: bought 45 days later, or at no known time."""
    number = F.col("order_id").cast("bigint")
    rows = stage(events(spark, folder, "orders"), ENTITIES["orders"], updated_at(4)).where(number % 7 == 0)
    later = F.when(number % 35 != 0, F.col("purchased_at") + F.make_dt_interval(days=F.lit(45)))
    changed = {"purchased_at": later, "_cdc_op": F.lit("u"), "_cdc_source_ts_ms": F.lit(shop.T0_MS + 9000), "_cdc_offset": number * 6 + 5, "is_deleted": F.lit(False)}
    return rows.withColumns(changed)


@query
def silver_partitioned_merge(spark, folder):
    """Orders merged by month in four batches, of which the last moves rows to other months; with the folder each row lies in."""
    lake = published(spark, folder, ("orders",))
    table = lake.state_table("orders")
    table.merge(moved_orders(spark, folder))
    return table.whole().select("order_id", "status", "purchased_at", "is_deleted", "purchased_at_month")


@query
def silver_full_rebuild(spark, folder):
    lake = filled_log(spark, folder, ("orders",), "rebuild")
    rebuild(lake, updated_at(0), ("orders",))
    return order_state(lake.state("orders")).drop("_silver_updated_at")


# ---- streams end to end -------------------------------------------------------------------------


def streamed(spark: SparkSession, folder: str, names, refresh: bool) -> Lakehouse:
    """State by the stream over the log, in two triggers or three: each rewrites what it touches, so
    that with triggers of fixed size the work would grow with the square of the log."""
    lake = ingested(spark, folder, names)
    files, _ = totals(spark, lake.log_root)
    start_state(
        lake, f"{lake.root}/checkpoints/state", DRAIN, max_files=max(8, 2 * len(names), -(-files // 2)),
        updated_at=updated_at(0), refresh=refresh,
    ).awaitTermination()
    return lake


@query
def silver_stream_state(spark, folder):
    return order_state(streamed(spark, folder, ("orders",), refresh=False).state("orders")).drop("_silver_updated_at")


@query
def gold_stream_refresh(spark, folder):
    lake = streamed(spark, folder, tuple(ENTITIES), refresh=True)
    return lake.reports()["order_funnel"]


@query
def gold_batch_refresh(spark, folder):
    """Log, current state and reports by the batch path; the sales report is returned."""
    names = ("orders", "order_items", "products")
    lake = filled_log(spark, folder, names, "batch")
    merge_new_events(lake, EPOCH, updated_at(1), names)
    refresh_reports(lake, ("products",))
    return lake.reports()["daily_revenue"]


@query
def gold_delta_refresh(spark, folder):
    """All reports, computed whole after a first batch and by difference after three more, with deletes and moved orders."""
    lake = new_lake(spark, folder, "delta")

    read = {name for names in gold.READS.values() for name in names}

    def merged(batch: int, names=read) -> dict:
        def one(name: str):
            records = shop.changes(spark, folder, name).filter(F.col("batch") == batch)
            return apply_events(lake, name, events_of(parsed(records)), updated_at(batch), keep=True)

        found = side_by_side(spark, one, names)
        return {name: changes for name, (_, changes) in found.items() if changes}

    merged(1)
    refresh_reports(lake)
    refresh_changed(lake, merged(2))
    refresh_changed(lake, merged(3, ("orders",)))  # the only events of that batch
    _, changes = lake.state_table("orders").merge(moved_orders(spark, folder), keep=True)
    refresh_changed(lake, {"orders": changes})

    def listed(name: str, group: Column, label: str, amount: str | None, count: str) -> DataFrame:
        value = F.col(amount) if amount else F.lit(None)
        return lake.report_table(name).read().select(F.lit(name).alias("report"), group.cast("string").alias("group_key"), F.col(label).alias("label"), value.cast("decimal(20,2)").alias("amount"), F.col(count).alias("row_count"))

    return listed("daily_revenue", F.col("order_date"), "category", "total_revenue", "order_count").unionByName(
        listed("top_sellers", F.col("seller_id"), "seller_state", "gmv", "total_orders")).unionByName(
        listed("review_sentiment_by_state", F.col("customer_state"), "customer_state", None, "review_count")).unionByName(
        listed("order_funnel", F.to_date("order_week"), "order_week", None, "total_created").withColumn("label", F.lit(None).cast("string")))


@query
def gold_distinct_rollup(spark, folder):
    """Distinct orders and customers of delivered sales by day, week and month, from one stored table of daily bitmaps."""
    bitmaps = stored(daily_bitmaps(shop.current_tables(spark, folder, gold.READS["daily_revenue"])), "bitmaps")
    grains = {"day": F.col("order_date"), "week": F.trunc("order_date", "week"), "month": F.trunc("order_date", "month")}
    return reduce(DataFrame.unionByName, [rolled_up(bitmaps, period).select(F.lit(grain).alias("grain"), "period", "orders", "customers") for grain, period in grains.items()])


# ---- quality ------------------------------------------------------------------------------------


@query
def dq_gold_not_null(spark, folder):
    return quality.gold_not_null(stored_reports(spark, folder, *gold.MODELS))


@query
def dq_gold_unique(spark, folder):
    return quality.gold_unique(stored_reports(spark, folder, *gold.MODELS))


@query
def dq_review_score_range(spark, folder):
    return quality.score_range(shop.current(spark, folder, "order_reviews"))


@query
def dq_orphans(spark, folder):
    names = {name for child, _, parent in FOREIGN_KEYS for name in (child, parent)}
    return quality.orphans(shop.current_tables(spark, folder, names))


@query
def dq_silver_pk(spark, folder):
    """Repeated keys in the current state, and in the raw lines it is made from."""
    raw = quality.repeated_keys(spark.read.parquet(f"{folder}/lineitem.parquet"), "raw lines", ("l_orderkey", "l_linenumber"))
    return quality.state_keys(shop.current_tables(spark, folder)).unionByName(raw)


@query
def dq_silver_not_null(spark, folder):
    return quality.state_not_null({
        e.name: stage(events(spark, folder, e.name), e, updated_at(0)) for e in ENTITIES.values()
    })


@query
def dq_checks_by_difference(spark, folder):
    """References, keys, missing values and scores, checked whole when only orders and lines are there, and
    by difference as the other tables, the later batches and every seventh customer's absence come."""
    lake = new_lake(spark, folder, "checks")
    checks = Checks(lake)

    def merged(batch: int, *names: str) -> dict:
        def one(name: str):
            records = shop.changes(spark, folder, name).filter(F.col("batch") == batch)
            rows = events_of(parsed(records))
            absent = F.floor(F.col("_cdc_offset") / 6) % 7 == 0
            return apply_events(lake, name, rows.where(~absent) if name == "customers" else rows, updated_at(batch), keep=True)

        return {name: changes for name, (_, changes) in side_by_side(spark, one, names).items() if changes}

    merged(1, "orders", "order_items")
    checks.start()
    checks.follow(merged(1, *(n for n in ENTITIES if n not in ("orders", "order_items"))))
    checks.follow(merged(2, *ENTITIES))
    checks.follow(merged(3, "orders"))
    lost = checks.orphans().select(F.concat_ws(".", "table_name", "column_name").alias("checked"), F.lit("reference").alias("rule"), "missing_keys", "violations")
    others = {"key": checks.state_keys(), "not null": checks.state_not_null()}
    none = F.lit(None).cast("bigint").alias("missing_keys")
    parts = [rows.select(F.concat_ws(".", "table_name", "column_name").alias("checked"), F.lit(rule).alias("rule"), none, "violations") for rule, rows in others.items()]
    scores = checks.score_range().select(F.lit("order_reviews").alias("checked"), F.lit("score").alias("rule"), F.col("rows_checked").alias("missing_keys"), "violations")
    return reduce(DataFrame.unionByName, [lost, *parts, scores])


# ---- metrics ------------------------------------------------------------------------------------

named("metrics_bronze_throughput", lambda spark, folder: metrics.log_throughput(events(spark, folder)))
named("metrics_bronze_span", lambda spark, folder: metrics.log_span(events(spark, folder)))
named("metrics_e2e_latency", lambda spark, folder: metrics.commit_latency(events(spark, folder, "orders")))
named("metrics_e2e_latency_approx", lambda spark, folder: metrics.approx_rank_check(events(spark, folder, "orders")))


@query
def metrics_e2e_latency_sketches(spark, folder):
    """What the ranks need of the events is made once, and read for the sketches and for the check."""
    rows = stored(events(spark, folder).select("source_table", "_cdc_ingested_at", "_cdc_source_ts_ms"), "latency")
    return metrics.sketch_rank_check(rows, stored(metrics.hourly_sketches(rows), "sketches"))


named(
    "metrics_batch_latency_by_table",
    lambda spark, folder: metrics.latency_by_table(events(spark, folder), F.col("_cdc_ingested_at")),
)
named(
    "metrics_latency_histogram",
    lambda spark, folder: metrics.latency_histogram(events(spark, folder), F.col("_cdc_ingested_at")),
)
named(
    "metrics_latency_p95_over_time",
    lambda spark, folder: metrics.latency_p95_over_time(events(spark, folder), F.col("_cdc_ingested_at"), "10 seconds"),
)


@query
def metrics_silver_throughput(spark, folder):
    """From tables published in three batches a minute apart."""
    return metrics.state_throughput(published(spark, folder).tables())


def come_late(lake: Lakehouse, run_id: str, arrived: str) -> None:
    """The deletes of orders once more, as they would stand in the log had they arrived at another time."""
    deletes = lake.events("orders").where("_cdc_op = 'd' AND run_id NOT LIKE 'late%'").drop("run_id", "batch_id")
    moment = F.lit(arrived).cast("timestamp")
    append_events(deletes.withColumns({"_cdc_ingested_at": moment, "ingest_date": F.to_date(moment)}), lake.log_root, run_id, 0)


@query
def metrics_stream_histogram(spark, folder):
    """Closed stretches of 10 seconds, in three runs of one stream: all events, then deletes that
    arrive inside the watermark and beyond it, then some an hour later, which close the others."""
    lake = ingested(spark, folder)
    late = [(), ("00:00:50", "00:00:05"), ("01:00:00",)]
    for times in late:
        for time in times:
            come_late(lake, f"late-{time.replace(':', '')}", f"2024-01-01 {time}")
        start_histogram(
            stream_events(spark, lake.log_root), f"{lake.root}/histogram", f"{lake.root}/checkpoints/histogram",
            DRAIN, "10 seconds", "20 seconds",
        ).awaitTermination()
    return spark.read.parquet(f"{lake.root}/histogram").drop("day")
