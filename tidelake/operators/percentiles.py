"""Exact percentiles without gathering the values in one place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def _running_start(counts: DataFrame, within: Sequence[str], by: str) -> DataFrame:
    """Adds ``before``: the count of all smaller values of ``by`` inside the same ``within``."""
    smaller = Window.partitionBy(*within).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("n").over(smaller), F.lit(0)))


def exact_percentiles(rows: DataFrame, value: Column, levels: Sequence[float], names: Sequence[str]) -> DataFrame:
    """One row: interpolated percentiles of a whole-number ``value`` and ``measured_rows``.

    Values are counted first, so equal values cost one row. Positions then come from running
    counts on three levels of 2^14 steps each: every window holds at most 2^14 rows except the
    topmost, whose size is the value range divided by 2^28. For microseconds that is one row per
    4.5 minutes between the smallest and the largest value, whatever the number of events.
    """
    step = 1 << 14

    def coarser(column: str) -> Column:
        # Never NULL here; saying so spares the joins a filter of their own, so that all three
        # levels read the same counts and Spark computes these once.
        return F.coalesce(F.floor(F.col(column) / step), F.lit(0))

    counted = (
        rows.select(value.cast("bigint").alias("v")).dropna().groupBy("v").agg(F.count("*").alias("n"))
        .withColumn("mid", coarser("v")).withColumn("top", coarser("mid"))
    )
    mids = counted.groupBy("top", "mid").agg(F.sum("n").alias("n"))
    tops = mids.groupBy("top").agg(F.sum("n").alias("n"))
    top_start = _running_start(tops, [], "top").select(
        "top", F.col("before").alias("top_before"), F.sum("n").over(Window.partitionBy()).alias("total")
    )
    mid_start = _running_start(mids, ["top"], "mid").select("mid", "top", F.col("before").alias("mid_before"))
    starts = mid_start.join(top_start, "top").select(
        "mid", "total", (F.col("top_before") + F.col("mid_before")).alias("base")
    )
    placed = (
        _running_start(counted, ["mid"], "v").join(starts, "mid")
        .withColumn("first", F.col("base") + F.col("before"))
    )

    def at(position: Column) -> Column:
        inside = (position >= F.col("first")) & (position < F.col("first") + F.col("n"))
        return F.max(F.when(inside, F.col("v")))

    def position(level: float) -> Column:
        return F.lit(level) * (F.col("total") - 1)

    found = placed.agg(
        *[at(F.floor(position(q))).alias(f"lo_{i}") for i, q in enumerate(levels)],
        *[at(F.ceil(position(q))).alias(f"hi_{i}") for i, q in enumerate(levels)],
        *[F.max(position(q) - F.floor(position(q))).alias(f"part_{i}") for i, q in enumerate(levels)],
        F.coalesce(F.max("total"), F.lit(0)).alias("measured_rows"),
    )
    return found.select(
        *[
            (F.col(f"lo_{i}") + (F.col(f"hi_{i}") - F.col(f"lo_{i}")) * F.col(f"part_{i}")).alias(name)
            for i, name in enumerate(names)
        ],
        "measured_rows",
    )
