"""Event log to current state to reports: the batch path, and the pieces the streams share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime
from zlib import crc32
from zoneinfo import ZoneInfo

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidelake.operators.envelope import snapshot_events
from tidelake.operators.extract import extract
from tidelake.operators.latest import latest_change
from tidelake.operators.merge import merge
from tidelake.plans import gold
from tidelake.schemas import ENTITIES, GOLD, Entity
from tidelake.session import configure
from tidelake.sources.catalog import bucket_count
from tidelake.sources.event_log import append_events, log_batches, read_batches, read_closed, read_events, read_new_events
from tidelake.sources.storage import child_names
from tidelake.sources.tables import Changes, ReportTable, StateTable, stored

EPOCH = datetime(1970, 1, 1)
# How a moment is written in a folder's name.
_STAMP = "%Y%m%dT%H%M%S.%f"


class OnDemand(Mapping):
    """Tables by name, each opened when it is first asked for."""

    def __init__(self, names: Iterable[str], open_table: Callable[[str], DataFrame]):
        self._names, self._open, self._opened = tuple(names), open_table, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._opened:
            self._opened[name] = self._open(name)
        return self._opened[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def side_by_side(spark: SparkSession, task: Callable[[str], object], names: Iterable[str], at_once: int = 4) -> dict:
    """Run independent jobs together, so that small tables fill what a large one leaves idle."""
    names = list(names)
    with ThreadPoolExecutor(max_workers=max(1, min(at_once, len(names)))) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(task), name) for name in names}
        return {name: job.result() for name, job in running.items()}


@dataclass
class Lakehouse:
    """The three layers below one root folder.

    ``buckets`` is the number of buckets of every table, fixed when the first one is made: about
    as many as a cluster has cores, or as gigabytes in the largest table, whichever is more.
    ``named`` puts the tables into the databases ``silver`` and ``gold``, for SQL text; otherwise
    they have databases of their own, so that a session can hold several lakes.
    """

    spark: SparkSession
    root: str
    buckets: int = 8
    entities: Mapping[str, Entity] = field(default_factory=lambda: ENTITIES)
    named: bool = False

    def __post_init__(self) -> None:
        configure(self.spark)  # tables made without it would not see their folders
        self.buckets = bucket_count(self.spark, f"{self.root}/silver", self.buckets)

    @property
    def log_root(self) -> str:
        return f"{self.root}/bronze"

    def _database(self, layer: str) -> str:
        return layer if self.named else f"{layer}_{crc32(self.root.encode()):08x}"

    def state_table(self, name: str) -> StateTable:
        return StateTable(self.spark, self._database("silver"), f"{self.root}/silver/{name}", self.entities[name], self.buckets)

    def report_table(self, name: str) -> ReportTable:
        return ReportTable(self.spark, self._database("gold"), name, f"{self.root}/gold/{name}", self.buckets)

    def events(self, table: str | None = None) -> DataFrame:
        return read_events(self.spark, self.log_root, table)

    def state(self, name: str, bucketed: bool = True) -> DataFrame:
        return self.state_table(name).read(bucketed=bucketed)

    def even(self) -> bool:
        """Whether no bucket is so much larger than the others that its key should be split.

        The limits are those by which adaptive execution calls a partition skewed. Only if all
        tables clustered alike pass are they joined by buckets.
        """
        factor = float(self.spark.conf.get("spark.sql.adaptive.skewJoin.skewedPartitionFactor"))
        least = self.spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(self.spark.conf.get("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"))
        sizes = [self.state_table(name).bucket_sizes() for name, entity in self.entities.items() if entity.clustered]
        return not any(max(x) > max(least, factor * sorted(x)[len(x) // 2]) for x in sizes)

    def state_as_of(self, name: str, moment: datetime, updated_at: Column | None = None, whole: bool = False) -> DataFrame:
        """What the events ingested up to a moment give.

        The newest state that was kept at or before it (:meth:`keep_state`) is taken, and only the
        log's days from then on are listed and merged into it; the ``whole`` log is read without
        one, or as told. Rows of a kept state keep the update time they got there.
        """
        entity, moment = self.entities[name], self._local(moment)
        upto = F.lit(moment.isoformat()).cast("timestamp")
        base = max((x for x in self._kept(name) if x <= moment), default=None) if not whole else None
        seen = self.events(name) if base is None else read_new_events(self.spark, self.log_root, name, base)
        seen = seen.filter((F.col("ingest_date") <= F.to_date(upto)) & (F.col("_cdc_ingested_at") <= upto))
        staged = stage(seen, entity, updated_at)
        if base is None:
            return staged
        folder = self._history(name)
        kept = self.spark.read.schema(entity.state).option("basePath", folder).parquet(f"{folder}/upto={base:{_STAMP}}")
        return merge(kept.select(*entity.state.names), staged, entity)

    def keep_state(self, name: str, moment: datetime, updated_at: Column | None = None, whole: bool = False) -> None:
        """Keep the state as of a moment, an ordinary partition of a table of such states.

        It starts from the state kept before, so that one a day costs a day of the log. Call it
        when the log has all that was ingested up to then: events that enter the log with an older
        ingestion time afterwards are in no state that builds on it, until it is kept again from
        the ``whole`` log.
        """
        upto = self._local(moment)
        rows = self.state_as_of(name, upto, updated_at, whole).withColumn("upto", F.lit(f"{upto:{_STAMP}}"))
        stored(rows, f"kept-{name}").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("upto").parquet(self._history(name))

    def _history(self, name: str) -> str:
        return f"{self.root}/history/{name}"

    def _kept(self, name: str) -> list[datetime]:
        """Moments whose state is kept, from the folders' names."""
        names = [n.removeprefix("upto=") for n in child_names(self.spark, self._history(name)) if n.startswith("upto=")]
        return [datetime.strptime(n, _STAMP) for n in names]

    def _local(self, moment: datetime) -> datetime:
        """A moment in the session's zone, without it."""
        zone = ZoneInfo(self.spark.conf.get("spark.sql.session.timeZone"))
        return moment.astimezone(zone).replace(tzinfo=None) if moment.tzinfo else moment

    def tables(self, bucketed: bool | None = None) -> OnDemand:
        """Current state by name; joined by buckets where they are :meth:`even`, or as told."""
        joined = [bucketed]

        def open_table(name: str) -> DataFrame:
            if joined[0] is None:
                joined[0] = self.even()
            return self.state(name, joined[0])

        return OnDemand(self.entities, open_table)

    def reports(self) -> OnDemand:
        return OnDemand(GOLD, lambda name: self.report_table(name).read())


def stage(events: DataFrame, entity: Entity, updated_at: Column | None = None) -> DataFrame:
    """Events of one entity reduced to the newest typed row per key."""
    return latest_change(extract(events, entity, updated_at), entity)


def load_snapshot(lake: Lakehouse, name: str, rows: DataFrame, run_id: str, loaded_at: datetime, topic: str) -> None:
    """Put a whole source table into the event log, as it is read: no exchange, no count."""
    moment = F.lit(loaded_at.isoformat()).cast("timestamp")
    append_events(snapshot_events(rows, name, topic, moment), lake.log_root, run_id, 0, even_out=False)


def apply_events(lake: Lakehouse, name: str, events: DataFrame, updated_at: Column | None = None, **rules: bool) -> tuple[set, Changes | None]:
    """Merge the newest row per key of new events into a current-state table.

    ``rules``: ``late_guard``, ``delete_keeps_target`` and ``keep`` of :meth:`StateTable.merge`,
    which says what is returned. With the guard a batch may come twice and in any order.
    """
    return lake.state_table(name).merge(stage(events, lake.entities[name], updated_at), **rules)


def merge_new_events(
    lake: Lakehouse, watermark: datetime, updated_at: Column | None = None, names: Iterable[str] | None = None, **rules: bool
) -> dict[str, tuple[set, Changes | None]]:
    """Merge what was ingested after ``watermark`` into each table."""

    def one(name: str) -> tuple[set, Changes | None]:
        return apply_events(lake, name, read_new_events(lake.spark, lake.log_root, name, watermark), updated_at, **rules)

    return side_by_side(lake.spark, one, names or lake.entities)


def rebuild(lake: Lakehouse, updated_at: Column | None = None, names: Iterable[str] | None = None) -> None:
    """Replace current-state tables by what the whole event log gives.

    What is appended to the log meanwhile, and may have been merged into the table that is being
    replaced, is merged again afterwards. Run no other writer of the table beside it.
    """

    def one(name: str) -> None:
        seen = log_batches(lake.spark, lake.log_root, name)
        events = read_batches(lake.spark, lake.log_root, name, seen).unionByName(read_closed(lake.spark, lake.log_root, name, seen))
        lake.state_table(name).replace(stage(events, lake.entities[name], updated_at))
        while later := log_batches(lake.spark, lake.log_root, name) - seen:
            seen = seen | later
            apply_events(lake, name, read_batches(lake.spark, lake.log_root, name, later), updated_at)

    side_by_side(lake.spark, one, names or lake.entities)


def refresh_reports(lake: Lakehouse, changed: Iterable[str] | None = None) -> list[str]:
    """Recompute stored reports, all or those that read a changed table; returns their names when readable."""
    changed = set(lake.entities if changed is None else changed)
    tables, names = lake.tables(), [name for name in gold.MODELS if changed & set(gold.READS[name])]
    side_by_side(lake.spark, lambda name: lake.report_table(name).publish(gold.MODELS[name](tables)), names)
    return names
