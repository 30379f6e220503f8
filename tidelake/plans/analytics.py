"""The five analytic queries over current-state tables, and the four reads of stored reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidelake.functions import money, percent, start_of_month
from tidelake.operators.retention import first_two_purchases
from tidelake.plans import gold
from tidelake.plans.gold import Tables, active
from tidelake.sources.tables import ReportTable


def daily_revenue(tables: Tables) -> DataFrame:
    """Revenue and orders per day and category, delivered orders only."""
    return (
        gold.sold_lines(tables, by_order=False).groupBy("order_date", "category")
        .agg(money(F.sum("price")).alias("total_revenue"), F.count_distinct("order_id").alias("order_count"))
        .orderBy(F.desc("order_date"), F.desc("total_revenue"))
    )


def top_sellers(tables: Tables, limit: int = 100) -> DataFrame:
    """Sellers by gross merchandise value."""
    return (
        gold.top_sellers(tables)
        .select("seller_id", "seller_state", "total_orders", "gmv", "delivery_rate_pct")
        .orderBy(F.desc("gmv"), "seller_id").limit(limit)
    )


def review_sentiment(tables: Tables) -> DataFrame:
    """Review scores per customer state."""
    return gold.review_sentiment_by_state(tables).drop("positive_rate_pct").orderBy(F.desc("review_count"))


def order_funnel(tables: Tables, one_row_per_order: bool = False) -> DataFrame:
    """Weekly steps of orders."""
    return gold.order_funnel(tables, one_row_per_order).drop("invoiced_or_later").orderBy(F.desc("order_week"))


def _purchases(tables: Tables) -> DataFrame:
    return active(tables["orders"]).filter(F.col("status") != "canceled").select("customer_id", "purchased_at")


def _cohorts(customers: DataFrame) -> DataFrame:
    """Monthly cohorts from one row per customer with first and next purchase.

    A customer returned within n days of the first purchase exactly if the next one did.
    """

    def returned_within(days: int):
        in_time = F.col("next_purchase_at") <= F.col("first_purchase_at") + F.make_dt_interval(F.lit(days))
        return F.count(F.when(in_time, F.col("customer_id"))).alias(f"retained_{days}d")

    return (
        customers.groupBy(start_of_month(F.col("first_purchase_at")).alias("cohort_month"))
        .agg(F.count("customer_id").alias("cohort_size"), *[returned_within(d) for d in (30, 60, 90)])
        .withColumn("retention_90d_pct", percent(F.col("retained_90d"), F.col("cohort_size")))
        .orderBy("cohort_month")
    )


def cohort_retention(tables: Tables, horizon_days: int = 90) -> DataFrame:
    """90-day retention by joining purchases to each customer's first one over a time range.

    The range join is an inner join with purchases as its large side, which is split where a
    customer has very many, and keeps only the earliest match per customer; the outer join that
    keeps customers without a return then has one row per customer on both sides.
    """
    purchases = _purchases(tables)
    first = purchases.groupBy("customer_id").agg(F.min("purchased_at").alias("first_purchase_at"))
    # Spark splits a join's partitions only where both sides were exchanged for that join. The first
    # purchases lie by customer already; a second join column makes them be exchanged once more.
    spread = F.hash("customer_id").alias("spread")
    later = purchases.select("*", spread).join(first.select("*", spread), ["customer_id", "spread"]).filter(
        (F.col("purchased_at") > F.col("first_purchase_at"))
        & (F.col("purchased_at") <= F.col("first_purchase_at") + F.make_dt_interval(F.lit(horizon_days)))
    )
    earliest = later.groupBy("customer_id").agg(F.min("purchased_at").alias("next_purchase_at"))
    return _cohorts(first.join(earliest, "customer_id", "left"))


def cohort_retention_window(tables: Tables) -> DataFrame:
    """The same result from one pass: rank purchases per customer and keep the first two."""
    return _cohorts(first_two_purchases(_purchases(tables)))


# Reads of the stored tables. Each order ends in a unique key, so that a cut is repeatable.


def read_daily_revenue(reports: Tables, limit: int = 100) -> DataFrame:
    return (
        reports["daily_revenue"].select("order_date", "category", "total_revenue", "order_count")
        .orderBy(F.desc("order_date"), F.desc("total_revenue"), F.asc_nulls_last("category")).limit(limit)
    )


def read_top_sellers(reports: Tables, limit: int = 50) -> DataFrame:
    return (
        reports["top_sellers"].select("seller_id", "seller_state", "total_orders", "gmv", "delivery_rate_pct")
        .orderBy(F.desc("gmv"), "seller_id").limit(limit)
    )


def read_review_sentiment(reports: Tables) -> DataFrame:
    return (
        reports["review_sentiment_by_state"]
        .select("customer_state", "review_count", "avg_score", "positive_count", "positive_rate_pct")
        .orderBy(F.desc("review_count"), "customer_state")
    )


def read_order_funnel(reports: Tables, limit: int = 52) -> DataFrame:
    return (
        reports["order_funnel"].select("order_week", "total_created", "delivered", "canceled", "delivery_rate_pct")
        .orderBy(F.desc("order_week")).limit(limit)
    )


def stored_read(name: str, table: ReportTable) -> DataFrame:
    """A read of a stored report from the part of it that can hold the rows asked for."""
    if name == "daily_revenue":
        return read_daily_revenue({name: table.newest(100)})
    if name == "top_sellers":
        return read_top_sellers({name: table.largest(50)})
    if name == "order_funnel":
        return read_order_funnel({name: table.newest(52)})
    return read_review_sentiment({name: table.read()})  # all of its rows are asked for
