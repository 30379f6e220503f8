"""Reads of stored reports take their rows from the parts that can hold them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidelake.plans import analytics
from tidelake.plans.pipeline import Lakehouse
from tidelake.schemas import GOLD


@pytest.fixture
def lake(spark, tmp_path):
    return Lakehouse(spark, str(tmp_path), 4)


def scanned(spark, run):
    """Rows that scans gave out while something ran."""
    store = spark._jsparkSession.sharedState().statusStore()
    start = store.executionsCount()
    result = run()
    spark._jsc.sc().listenerBus().waitUntilEmpty()
    total, done = 0, store.executionsList()
    for k in range(start, done.size()):
        graph, values = store.planGraph(done.apply(k).executionId()), store.executionMetrics(done.apply(k).executionId())
        nodes = graph.allNodes()
        for i in range(nodes.size()):
            if nodes.apply(i).name().startswith("Scan parquet"):
                metrics = nodes.apply(i).metrics()
                for j in range(metrics.size()):
                    if metrics.apply(j).name() == "number of output rows":
                        found = values.get(metrics.apply(j).accumulatorId())
                        total += int(found.get().replace(",", "")) if found.isDefined() else 0
    return result, total


def shaped(rows, name):
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in rows.columns else F.lit(1).cast(f.dataType).alias(f.name) for f in GOLD[name]])


def sellers(spark, n, gmv):
    return shaped(spark.range(n).select(F.col("id").cast("string").alias("seller_id"), gmv.alias("gmv")), "top_sellers")


def test_top_sellers_read_the_heads_of_files(spark, lake):
    table, n = lake.report_table("top_sellers"), 400_000
    gmv = F.pmod(F.xxhash64("id"), F.lit(10**7)) / 100
    table.publish(sellers(spark, n, gmv))
    rows, read = scanned(spark, lambda: analytics.stored_read("top_sellers", table).collect())
    want = analytics.read_top_sellers({"top_sellers": table.read()}).collect()
    assert rows == want and len(rows) == 50
    assert read < 0.7 * n  # one of four buckets whole, pages of the others
    # a changed group is put back in order
    changed = spark.createDataFrame([("7",)], "seller_id string")
    table.replace_groups(changed, sellers(spark, 8, F.lit(10**6)).where("seller_id = '7'"))
    rows, read = scanned(spark, lambda: analytics.stored_read("top_sellers", table).collect())
    assert rows[0].seller_id == "7" and rows[1:] == want[:49] and read < 0.7 * n


@pytest.mark.parametrize("n", [0, 3, 60])
def test_few_equal_and_missing_values(spark, lake, n):
    table = lake.report_table("top_sellers")
    table.publish(sellers(spark, n, F.when(F.col("id") % 3 > 0, F.lit(5))))
    got = analytics.stored_read("top_sellers", table).collect()
    assert got == analytics.read_top_sellers({"top_sellers": table.read()}).collect() and len(got) == min(n, 50)


@pytest.mark.parametrize("name,step,limit", [("daily_revenue", 1, 100), ("order_funnel", 7, 52)])
def test_newest_months_only(spark, lake, name, step, limit):
    key = "order_date" if name == "daily_revenue" else "order_week"
    table, n = lake.report_table(name), 700
    day = F.date_add(F.lit(dt.date(2010, 1, 4)), (F.col("id") * step).cast("int"))
    rows = spark.range(n).select(F.when(F.col("id") > 0, day).alias(key), F.col("id").cast("string").alias("category"))
    table.publish(shaped(rows, name))
    read_whole = {"daily_revenue": analytics.read_daily_revenue, "order_funnel": analytics.read_order_funnel}[name]
    got, read = scanned(spark, lambda: analytics.stored_read(name, table).collect())
    assert got == read_whole({name: table.read()}).collect() and len(got) == limit
    assert read < 6 * limit < n or name == "daily_revenue" and read < n
    table.publish(shaped(rows.where("id < 10"), name))  # fewer than asked for, one of them without a day
    assert analytics.stored_read(name, table).count() == 10
    table.publish(shaped(rows.limit(0), name))
    assert analytics.stored_read(name, table).isEmpty()
    with pytest.raises(ValueError):
        lake.report_table("top_sellers").newest(1)
