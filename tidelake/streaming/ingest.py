"""Change records to the event log, continuously."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager, nullcontext
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelake.operators.envelope import UNROUTED, log_rows, parse_records
from tidelake.plans.metrics import stream_latency
from tidelake.schemas import ENTITIES
from tidelake.sources.event_log import append_events

TRIGGER = {"processingTime": "30 seconds"}
DRAIN = {"availableNow": True}  # work off what is there, then stop


def batch_measures() -> list[Column]:
    """Counters taken while a batch flows through, without a job of their own."""
    is_event = F.col("_cdc_op").isNotNull()
    latency = stream_latency(F.col("_cdc_ingested_at"))
    per_table = [
        measure
        for table in ENTITIES
        for measure in (
            F.count_if(is_event & (F.col("source_table") == table)).alias(f"{table}_records"),
            F.max(F.when(is_event & (F.col("source_table") == table), latency)).alias(f"{table}_max_latency_s"),
        )
    ]
    return [
        F.count(F.lit(1)).alias("records"),
        F.count_if("is_tombstone").alias("tombstones"),
        F.count_if(~is_event & ~F.col("is_tombstone")).alias("malformed"),
        F.count_if(is_event & (F.col("source_table") == UNROUTED)).alias("unrouted"),
        *per_table,
    ]


def query_id(batch: DataFrame) -> str:
    """The id kept in the stream's checkpoint: the same after a restart, new after a reset."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def without_repeats(records: DataFrame, within: str) -> DataFrame:
    """Records but for those delivered again ``within`` some time of their first delivery.

    A record is told by topic, partition and offset; one that lacks any of these is kept. The clock
    is that of the delivery, not the record's own: nothing is ever late, so that none is lost,
    however old it is. The state holds the positions of the last stretch of ``within``.
    """
    position = [F.col(n).cast("string") for n in ("partition", "offset", "topic")]
    known = reduce(Column.__and__, [p.isNotNull() for p in position])
    marked = records.withColumns({
        "_position": F.when(known, F.concat_ws(" ", *position)).otherwise(F.expr("uuid()")),
        "_delivered": F.current_timestamp(),
    })
    return marked.withWatermark("_delivered", within).dropDuplicatesWithinWatermark(["_position"]).drop("_position", "_delivered")


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state on the executors' disks, for states that outgrow the heap."""
    key, store = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(key)
    spark.conf.set(key, store)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def start_ingest(
    records: DataFrame,
    log_root: str,
    checkpoint: str,
    trigger: dict | None = None,
    ingested_at: Column | None = None,
    drop_repeats: str | None = None,
) -> StreamingQuery:
    """Parse, measure and append every batch. The measures appear in the query's progress.

    A batch is written by exactly one job; repeated after a failure, it replaces itself. With
    ``drop_repeats``, a length of time, records delivered again within it are left out, at the
    cost of an exchange (:func:`without_repeats`).
    """
    if drop_repeats:
        records = without_repeats(records, drop_repeats)

    def append(batch: DataFrame, batch_id: int) -> None:
        append_events(batch, log_root, query_id(batch), batch_id)

    parsed = parse_records(records, ingested_at).observe("ingest", *batch_measures())
    stream = (
        log_rows(parsed).writeStream.queryName("event-log-ingest").foreachBatch(append)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or TRIGGER))
    )
    with state_on_disk(records.sparkSession) if drop_repeats else nullcontext():
        return stream.start()
