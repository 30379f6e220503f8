"""Arrival latency of the log per stretch of time, kept up by a stateful stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelake.plans.metrics import label_bounds, window_counts
from tidelake.streaming.ingest import TRIGGER

_CLOCK = "_cdc_ingested_at"


def start_histogram(
    events: DataFrame,
    out: str,
    checkpoint: str,
    trigger: dict | None = None,
    width: str = "5 minutes",
    delay: str = "10 minutes",
) -> StreamingQuery:
    """Store the latency histogram of each stretch of ``width`` once no more events are due for it.

    ``events`` is the log as a stream. A stretch is written, once and for good, when the latest
    arrival seen is ``delay`` past its end; events that come for it later are left out and counted
    by the query's progress (``numRowsDroppedByWatermark``). The state holds one count per table
    and latency range of the open stretches, whatever the events: they are added up before the
    exchange, so a table with a third of them costs no more than another, and the state is small
    enough for the heap.
    """
    timed = events.where(F.col("_cdc_op").isNotNull()).withWatermark(_CLOCK, delay)
    rows = label_bounds(window_counts(timed, _CLOCK, width)).withColumn("day", F.to_date("window_start"))
    # A few rows per closed stretch: one file each day and trigger.
    return (
        rows.repartition(1).writeStream.queryName("latency-histogram").outputMode("append").format("parquet")
        .option("path", out).option("checkpointLocation", checkpoint).partitionBy("day")
        .trigger(**(trigger or TRIGGER)).start()
    )
