"""Distinct counts that can be added up: exact bitmaps per day, rolled up to any longer span.

Orders and customers get dense numbers, and a day keeps the set of numbers it saw as bitmaps of
32,768 each. The union over days is the set of a week or month, so that one stored table serves
every grain, without the rows. Orders are numbered by day, so a day's orders fill few bitmaps;
customers come back on any day, so a day has a bitmap for every range that one of its customers is in.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidelake.plans.gold import sold_lines
from tidelake.sources.tables import stored

# Rows that get their numbers in one task, about.
RUN_ROWS = 100_000


def dense_numbers(keys: DataFrame, key: str, order: Column | None = None) -> DataFrame:
    """``key`` and ``number``, from 0 without gaps, one per key; equal ``order`` values get numbers in a row.

    Keys are ranked in runs of bounded size, and a run begins where those before it end: one row
    per run is summed up. Null keys have no number.
    """
    ranks = F.lit(0) if order is None else order
    rows = stored(keys.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(ranks).alias("rank")), "numbers")
    sized = rows.groupBy("rank").agg(F.count("*").alias("n")).select("rank", F.ceil(F.col("n") / F.lit(RUN_ROWS)).alias("runs"))
    placed = rows.alias("r").join(sized.alias("s"), F.col("r.rank").eqNullSafe(F.col("s.rank"))).select(key, F.col("r.rank").alias("rank"), F.pmod(F.xxhash64(key), F.col("runs")).alias("run"))
    counts = placed.groupBy("rank", "run").agg(F.count("*").alias("n"))
    before = Window.orderBy("rank", "run").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("rank", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("rank", "run").orderBy(key)) - 1
    p, b = placed.withColumn("inside", inside).alias("p"), bases.alias("b")
    joined = p.join(b, F.col("p.rank").eqNullSafe(F.col("b.rank")) & (F.col("p.run") == F.col("b.run")))
    return joined.select(key, (F.col("inside") + F.col("base")).alias("number"))


def daily_bitmaps(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per day and measure (``orders``, ``customers``) of delivered sales the bitmaps of the numbers seen.

    Columns: ``order_date``, ``measure``, ``bucket``, ``bits``. Each row of sales is one bit, set
    map-side, so a day with a third of all sales sends its bitmaps and no rows.
    """
    sales = stored(sold_lines(tables).select("order_id", "customer_id", "order_date").distinct(), "sales")
    orders = dense_numbers(sales, "order_id", F.col("order_date"))
    customers = dense_numbers(sales, "customer_id")

    def maps(numbers: DataFrame, key: str, measure: str) -> DataFrame:
        seen = sales.join(numbers, key).groupBy("order_date", F.bitmap_bucket_number("number").alias("bucket"))
        bits = F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")
        return seen.agg(bits).select("order_date", F.lit(measure).alias("measure"), "bucket", "bits")

    return maps(orders, "order_id", "orders").unionByName(maps(customers, "customer_id", "customers"))


def rolled_up(bitmaps: DataFrame, period: Column) -> DataFrame:
    """Distinct ``orders`` and ``customers`` of every ``period``, from stored bitmaps alone."""
    merged = bitmaps.groupBy(period.alias("period"), "measure", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    counts = [F.coalesce(F.sum(F.when(F.col("measure") == name, F.bitmap_count("bits"))), F.lit(0)).alias(name) for name in ("orders", "customers")]
    return merged.groupBy("period").agg(*counts)
