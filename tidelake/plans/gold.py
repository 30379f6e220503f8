"""The four stored report tables ("Gold"), computed from current-state tables.

Current-state tables hold one row per key. The plans use that: they fold to one row per order
where several distinct counts are asked for, and they aggregate facts before joining the
dimension whose key may be unevenly used.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tidelake.functions import money, percent, start_of_week

Tables = Mapping[str, DataFrame]


def active(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("is_deleted") == F.lit(False))


def sold_lines(tables: Tables, by_order: bool = True) -> DataFrame:
    """Items of delivered orders with their day and product category.

    ``by_order`` leaves the lines of an order together; without it orders are joined first, so that
    only lines of delivered ones are exchanged by product.
    """
    orders = active(tables["orders"]).filter(F.col("status") == "delivered").select(
        "order_id", "customer_id", F.to_date("purchased_at").alias("order_date")
    )
    items = active(tables["order_items"]).select("order_id", "product_id", "price", "freight_value")
    products = active(tables["products"]).select("product_id", F.col("product_category").alias("category"))
    if not by_order:
        return items.join(orders, "order_id").join(products, "product_id")
    # Orders come last: their exchange by order also serves the fold to one row per order.
    return items.join(products, "product_id").join(orders, "order_id")


def daily_revenue(tables: Tables) -> DataFrame:
    sums = [F.sum("total_revenue").alias("total_revenue"), F.sum("total_freight").alias("total_freight")]
    per_order = sold_lines(tables).groupBy("order_id", "customer_id", "order_date", "category").agg(
        F.sum("price").alias("total_revenue"), F.sum("freight_value").alias("total_freight")
    )
    per_customer = per_order.groupBy("order_date", "category", "customer_id").agg(*sums, F.count("*").alias("orders"))
    per_day = per_customer.groupBy("order_date", "category").agg(
        *sums, F.sum("orders").alias("order_count"), F.count("customer_id").alias("unique_customers")
    )
    return per_day.select(
        "order_date", "category", money(F.col("total_revenue")).alias("total_revenue"),
        money(F.col("total_freight")).alias("total_freight"), "order_count", "unique_customers",
    )


def seller_totals(tables: Tables) -> DataFrame:
    """Measures per seller id, before seller attributes are joined.

    Lines are folded per (order, seller) on the join's own partitioning, then per seller, so a
    seller with very many sales is summed in every task and not gathered in one.
    """
    orders = active(tables["orders"]).select(
        "order_id",
        (F.col("status") == "delivered").alias("is_delivered"),
        F.datediff(F.to_date("delivered_customer_at"), F.to_date("purchased_at")).alias("days"),
    )
    items = active(tables["order_items"]).select("order_id", "seller_id", "price", "freight_value")
    per_order = items.join(orders, "order_id").groupBy("order_id", "seller_id").agg(
        F.sum("price").alias("gmv"), F.sum("freight_value").alias("freight"),
        F.count_if("is_delivered").alias("delivered_lines"), F.max("is_delivered").alias("is_delivered"),
        F.sum("days").alias("days"), F.count("days").alias("timed_lines"),
    )
    return per_order.groupBy("seller_id").agg(
        F.count("*").alias("total_orders"), F.sum("gmv").alias("gmv"), F.sum("freight").alias("total_freight"),
        F.sum("delivered_lines").alias("delivered_lines"), F.count_if("is_delivered").alias("delivered_orders"),
        F.sum("days").alias("days"), F.sum("timed_lines").alias("timed_lines"),
    )


def sellers_with_totals(tables: Tables, part: str) -> DataFrame:
    sellers = active(tables["sellers"]).select("seller_id", "seller_city", "seller_state")
    days = F.col("days").cast("double") / F.nullif(F.col("timed_lines"), F.lit(0))
    return sellers.join(seller_totals(tables), "seller_id").select(
        "seller_id", "seller_city", "seller_state", "total_orders",
        money(F.col("gmv")).alias("gmv"), money(F.col("total_freight")).alias("total_freight"),
        percent(F.col(part), F.col("total_orders")).alias("delivery_rate_pct"),
        days.alias("avg_delivery_days"),
    )


def top_sellers(tables: Tables) -> DataFrame:
    """Per seller: gross merchandise value without freight, and delivery figures.

    ``delivery_rate_pct`` sets delivered item lines against distinct orders, so it can pass 100;
    ``top_sellers_order_rate`` counts orders on both sides.
    """
    return sellers_with_totals(tables, "delivered_lines")


def top_sellers_order_rate(tables: Tables) -> DataFrame:
    return sellers_with_totals(tables, "delivered_orders")


def score_counts(score: Column) -> list[Column]:
    return [
        F.count_if(score >= 4).alias("positive_count"),
        F.count_if(score == 3).alias("neutral_count"),
        F.count_if(score <= 2).alias("negative_count"),
    ]


def review_sentiment_by_state(tables: Tables) -> DataFrame:
    reviews = active(tables["order_reviews"]).select("order_id", "review_id", "review_score")
    orders = active(tables["orders"]).select("order_id", "customer_id")
    customers = active(tables["customers"]).select("customer_id", "customer_state")
    score = F.col("review_score")
    per_customer = reviews.join(orders, "order_id").groupBy("customer_id").agg(
        F.count("review_id").alias("review_count"), F.sum(score).alias("scores"), F.count(score).alias("scored"),
        *score_counts(score),
    )
    counts = ["review_count", "scores", "scored", "positive_count", "neutral_count", "negative_count"]
    per_state = customers.join(per_customer, "customer_id").groupBy("customer_state").agg(
        *[F.sum(c).alias(c) for c in counts]
    )
    return per_state.select(
        "customer_state", "review_count",
        F.round(F.col("scores").cast("double") / F.nullif(F.col("scored"), F.lit(0)), 2).alias("avg_score"),
        "positive_count", "neutral_count", "negative_count",
        percent(F.col("positive_count"), F.col("review_count")).alias("positive_rate_pct"),
    )


# Statuses of an order that has at least been invoiced.
INVOICED_OR_LATER = ("invoiced", "processing", "shipped", "delivered")


def funnel_steps() -> dict[str, Column]:
    return {
        "approved": F.col("approved_at").isNotNull(),
        "invoiced_or_later": F.col("status").isin(*INVOICED_OR_LATER),
        "shipped": F.col("delivered_carrier_at").isNotNull(),
        "delivered": F.col("status") == "delivered",
        "canceled": F.col("status") == "canceled",
    }


def order_funnel(tables: Tables, one_row_per_order: bool = True) -> DataFrame:
    """Orders of each week by the step they reached.

    With one row per order, as in published tables, counting needs no exchange but that of the few
    weekly totals. Otherwise rows are folded per order first, which costs one exchange for all
    distinct counts together.
    """
    steps = funnel_steps()
    flagged = active(tables["orders"]).select(
        "order_id", start_of_week(F.col("purchased_at")).alias("order_week"),
        *[F.coalesce(test, F.lit(False)).alias(name) for name, test in steps.items()],
    )
    if not one_row_per_order:
        flagged = flagged.groupBy("order_week", "order_id").agg(*[F.max(name).alias(name) for name in steps])
    per_week = flagged.groupBy("order_week").agg(
        F.count("order_id").alias("total_created"), *[F.count_if(name).alias(name) for name in steps]
    )
    return per_week.withColumn("delivery_rate_pct", percent(F.col("delivered"), F.col("total_created")))


MODELS: dict[str, Callable[[Tables], DataFrame]] = {
    "daily_revenue": daily_revenue,
    "top_sellers": top_sellers,
    "review_sentiment_by_state": review_sentiment_by_state,
    "order_funnel": order_funnel,
}

# Which current-state tables a model reads, so that a change refreshes what depends on it.
READS: dict[str, tuple[str, ...]] = {
    "daily_revenue": ("orders", "order_items", "products"),
    "top_sellers": ("sellers", "order_items", "orders"),
    "review_sentiment_by_state": ("order_reviews", "orders", "customers"),
    "order_funnel": ("orders",),
}
