"""Event log to current state and reports, continuously."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelake.plans.pipeline import Lakehouse, apply_events, refresh_reports, side_by_side
from tidelake.sources.event_log import stream_events
from tidelake.streaming.ingest import TRIGGER


def start_state(
    lake: Lakehouse,
    checkpoint: str,
    trigger: dict | None = None,
    max_files: int | None = None,
    updated_at: Column | None = None,
    refresh: bool = True,
    refresh_every: timedelta = timedelta(0),
) -> StreamingQuery:
    """Merge log files as they appear, and refresh the reports that read a changed table.

    It runs when the log has files not seen before, whichever table they belong to, and advances
    only after tables and reports are published. Reports are refreshed at most once in
    ``refresh_every``; tables changed since wait for the next refresh, or for the ``refresh`` job.
    A batch is not kept: the log lies in a folder per table, and each table reads its own.
    """
    waiting: set[str] = set()
    last = [datetime.min]

    def apply(batch: DataFrame, batch_id: int) -> None:
        # A folder name per row, of which the captured tables' are kept: seven rows at most.
        known = batch.filter(F.col("source_table").isin(*lake.entities)).select("source_table")
        present = {row[0] for row in known.distinct().collect()}

        def one(name: str) -> None:
            apply_events(lake, name, batch.filter(F.col("source_table") == name), updated_at)

        changed = [name for name in lake.entities if name in present]
        side_by_side(lake.spark, one, changed)
        waiting.update(changed)
        if refresh and waiting and datetime.now() - last[0] >= refresh_every:
            refresh_reports(lake, waiting)
            waiting.clear()
            last[0] = datetime.now()

    return (
        stream_events(lake.spark, lake.log_root, max_files).writeStream
        .queryName("current-state").foreachBatch(apply)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or TRIGGER)).start()
    )
