"""First and next purchase per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def first_two_purchases(purchases: DataFrame) -> DataFrame:
    """Per customer, the earliest purchase time and the earliest later one (NULL if none).

    Equal times are folded first, which spreads a customer's rows over (customer, time); the rank
    limit then leaves two rows per customer and task, so no customer is gathered as a whole.
    """
    times = purchases.select("customer_id", "purchased_at").distinct()
    by_time = Window.partitionBy("customer_id").orderBy(F.col("purchased_at").asc_nulls_last())
    nth = F.row_number().over(by_time)
    return (
        times.withColumn("nth", nth).filter(F.col("nth") <= 2)
        .groupBy("customer_id")
        .agg(
            F.min("purchased_at").alias("first_purchase_at"),
            F.max(F.when(F.col("nth") == 2, F.col("purchased_at"))).alias("next_purchase_at"),
        )
    )
