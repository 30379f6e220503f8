"""The append-only event log: one partitioned table for all entities."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import date, datetime
from urllib.parse import unquote
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidelake.schemas import EVENT_FILE, EVENT_FOLDERS
from tidelake.sources.storage import child_names, child_sizes, delete, exists

# Spark forgets files that are a week older than the newest one it has seen, unless told otherwise.
ANY_AGE = "36500d"
_TABLE, _DAY = "source_table=", "ingest_date="
# A closed day's files are named by the call that wrote them; run and batch are columns there.
_CLOSING = "closing"
_CLOSED_FILE = T.StructType([*EVENT_FILE.fields, T.StructField(_CLOSING, T.StringType())])


def append_events(events: DataFrame, root: str, run_id: str, batch_id: int, even_out: bool = True) -> None:
    """Write one batch of events, routed to its tables' folders in a single job.

    Folders are named by table, day, run and batch, and only the folders written to are replaced.
    Repeating a batch therefore leaves one copy, and a run started anew cannot touch an older
    one's data. ``even_out`` evens out file sizes by one exchange, also where one table dominates
    the batch; events of a single table, already in even parts, do without.
    """
    rows = events.select("*", F.lit(run_id).alias("run_id"), F.lit(batch_id).cast("bigint").alias("batch_id"))
    if even_out:
        rows = rows.hint("rebalance", "source_table", "ingest_date")
    (
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*EVENT_FOLDERS.names).parquet(root)
    )


def read_events(spark: SparkSession, root: str, table: str | None = None) -> DataFrame:
    """The whole log, or one table's part of it, listing only that part's folders; closed days included."""
    tables = [table] if table else [n.removeprefix(_TABLE) for n in child_names(spark, closed_root(root)) if n.startswith(_TABLE)]
    both = {t: log_batches(spark, root, t) for t in tables if _closed_days(spark, root, t)}
    path = f"{root}/{_TABLE}{table}" if table else root
    rows = spark.read.schema(EVENT_FILE).option("basePath", root).parquet(path) if exists(spark, path) else spark.createDataFrame([], EVENT_FILE)
    for name, batches in both.items():
        rows = rows.unionByName(read_closed(spark, root, name, batches))
    return rows


def read_new_events(spark: SparkSession, root: str, table: str, watermark: datetime) -> DataFrame:
    """Events of a table ingested after ``watermark``. Only its day folders from then on are listed."""
    moment = F.lit(watermark.isoformat()).cast("timestamp")
    zone = ZoneInfo(spark.conf.get("spark.sql.session.timeZone"))
    first = (watermark.astimezone(zone) if watermark.tzinfo else watermark).date().isoformat()
    folder = f"{root}/{_TABLE}{table}"
    days = [n for n in child_names(spark, folder) if n.startswith(_DAY) and n.removeprefix(_DAY) >= first]
    closed = [n for n in _closed_days(spark, root, table) if n.removeprefix(_DAY) >= first]
    batches = log_batches(spark, root, table, closed) if closed else set()
    events = spark.createDataFrame([], EVENT_FILE)
    if days:
        events = spark.read.schema(EVENT_FILE).option("basePath", root).parquet(*[f"{folder}/{day}" for day in days])
    if closed:
        events = events.unionByName(read_closed(spark, root, table, batches, closed))
    return events.filter(
        (F.col("ingest_date") >= F.to_date(moment)) & (F.col("_cdc_ingested_at") > moment)
    )


def log_batches(spark: SparkSession, root: str, table: str, days: Iterable[str] | None = None) -> set[str]:
    """The folders of a table's batches, by day, run and batch: names only. ``days``: folder names of those wanted.

    Batches of closed days are not among them.
    """
    top = f"{_TABLE}{table}"
    there = child_names(spark, f"{root}/{top}") if days is None else days
    folders = {f"{top}/{n}" for n in there if "=" in n}
    for _ in EVENT_FOLDERS.names[2:]:
        folders = {f"{f}/{n}" for f in folders for n in child_names(spark, f"{root}/{f}") if "=" in n}
    return folders


def read_batches(spark: SparkSession, root: str, table: str, batches: set[str]) -> DataFrame:
    """Events of the batches that were listed, whatever has come since."""
    if not batches:
        return spark.createDataFrame([], EVENT_FILE)
    return spark.read.schema(EVENT_FILE).option("basePath", root).parquet(*[f"{root}/{b}" for b in sorted(batches)])


# ---- closed days --------------------------------------------------------------------------------


def closed_root(root: str) -> str:
    """Closed days lie beside the log, not in it, so that no stream over the log takes them for news."""
    return f"{root.rstrip('/')}_closed"


def _closed_days(spark: SparkSession, root: str, table: str) -> list[str]:
    return [n for n in child_names(spark, f"{closed_root(root)}/{_TABLE}{table}") if n.startswith(_DAY)]


def _named(batch: str) -> tuple[str, str, str, int]:
    """Table, day, run and batch number of a batch's folder."""
    table, day, run, number = (unquote(part.partition("=")[2]) for part in batch.split("/"))
    return table, day, run, int(number)


def read_closed(spark: SparkSession, root: str, table: str, besides: Iterable[str], days: Iterable[str] | None = None) -> DataFrame:
    """Events of a table's closed days, all or some, but for the batches ``besides``, which still lie in the log.

    List those before: a batch that is closed in between is then read in the log or not at all,
    and where its files are gone by the time they are read, Spark says so.
    """
    folder = f"{closed_root(root)}/{_TABLE}{table}"
    paths = [folder] if days is None else [f"{folder}/{day}" for day in days]
    if not paths or not _closed_days(spark, root, table):
        return spark.createDataFrame([], EVENT_FILE)
    rows = spark.read.schema(_CLOSED_FILE).option("basePath", closed_root(root)).parquet(*paths)
    closed = set(_closed_days(spark, root, table))
    open_there = sorted({_named(b)[1:] for b in besides if b.split("/")[1] in closed})
    return rows.where(~_in_batches(open_there)).select(*EVENT_FILE.names)


def _in_batches(batches: Iterable[tuple[str, str, int]]) -> Column:
    """A test for being in one of some batches, by day and run."""
    numbers: dict[tuple[str, str], list[int]] = {}
    for day, run, number in batches:
        numbers.setdefault((day, run), []).append(number)
    found = F.lit(False)
    for (day, run), some in numbers.items():
        found = found | ((F.col("ingest_date") == F.lit(date.fromisoformat(day))) & (F.col("run_id") == run) & F.col("batch_id").isin(some))
    return found


def taken_files(spark: SparkSession, checkpoint: str) -> set[str]:
    """Files that a stream over the log has worked off, from its checkpoint: names below the log, by folder."""
    done = [int(n) for n in child_names(spark, f"{checkpoint}/commits") if n.isdigit()]
    folder = f"{checkpoint}/sources/0"
    if not done or not exists(spark, folder):
        return set()
    listed = spark.read.schema("path string, batchId bigint").json(f"{folder}/*").where(F.col("batchId") <= max(done))
    at = F.regexp_extract("path", f"({_TABLE}.*)$", 1)
    return {unquote(r[0]) for r in listed.select(at).distinct().collect()}


def close_days(spark: SparkSession, root: str, before: date, streams: Iterable[str] = (), file_bytes: int = 256 << 20) -> list[str]:
    """Move batches of days before ``before`` out of the log, into few files per table and day that are sorted by time of ingestion.

    ``streams`` are the checkpoints of all streams that read the log: a batch that one of them has
    not worked off stays until a later call, so that no stream misses or repeats a row. A stream
    begun afterwards sees the open log only: begin it from :func:`read_events` or ``rebuild``.

    Every call writes partitions of its own and replaces none, and a batch leaves the log after it
    is in them; a call that broke off is made good by the next. Returns the batches moved. Batches
    that come for a closed day later are read with it, and closed in their turn. One caller at a
    time. File names go to the driver, rows do not.
    """
    listed = sorted(
        batch for top in child_names(spark, root) if top.startswith(_TABLE)
        for batch in log_batches(spark, root, top.removeprefix(_TABLE), [n for n in child_names(spark, f"{root}/{top}") if n.startswith(_DAY) and n.removeprefix(_DAY) < before.isoformat()])
    )
    sizes = {b: {n: size for n, size in child_sizes(spark, f"{root}/{b}").items() if n.endswith(".parquet")} for b in listed}
    for checkpoint in streams:
        taken = taken_files(spark, checkpoint)
        listed = [b for b in listed if all(f"{b}/{n}" in taken for n in sizes[b])]
    if not listed:
        return []
    todo = sorted(set(listed) - _already_closed(spark, root, listed))
    if todo:
        rows = read_batches(spark, root, "", set(todo)).withColumn(_CLOSING, F.lit(uuid.uuid4().hex))
        parts = 1 + sum(sum(sizes[b].values()) for b in todo) // file_bytes
        # A bulk load stamps all its rows alike, so the range goes on by a hash of the image.
        order = ["source_table", "ingest_date", "_cdc_ingested_at", F.xxhash64("after_json", "before_json")]
        (
            rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_table", "ingest_date", _CLOSING).parquet(closed_root(root))
        )
    for batch in listed:
        delete(spark, f"{root}/{batch}")
    return listed


def _already_closed(spark: SparkSession, root: str, batches: list[str]) -> set[str]:
    """Of some batches in the log those that a call which broke off has written already."""
    by_name = {_named(b): b for b in batches}
    pairs = {b.rsplit("/", 2)[0] for b in batches}
    folders = [f for f in sorted(pairs) if exists(spark, f"{closed_root(root)}/{f}")]
    if not folders:
        return set()
    rows = spark.read.schema(_CLOSED_FILE).option("basePath", closed_root(root)).parquet(*[f"{closed_root(root)}/{f}" for f in folders])
    found = rows.select("source_table", F.col("ingest_date").cast("string"), "run_id", "batch_id").distinct().collect()
    return {by_name[tuple(r)] for r in found if tuple(r) in by_name}


def stream_events(spark: SparkSession, root: str, max_files: int | None = None) -> DataFrame:
    """Log files not seen before, as a stream: its checkpoint is the watermark.

    Files count however old they are beside the newest one (restored, or copied with their times),
    and a file that is gone stops the stream: state must not go on without part of its log.
    """
    reader = spark.readStream.schema(EVENT_FILE).option("maxFileAge", ANY_AGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(root)
