"""Plans that have to hold at scale: what reaches the scan, what is exchanged, what is split."""

import os
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidelake.plans import analytics, gold, quality
from tidelake.plans.pipeline import EPOCH, Lakehouse, merge_new_events
from tidelake.registry.queries import QUERIES, events
from tidelake.schemas import ENTITIES
from tidelake.sources import append_events


def plan_of(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lake(spark, small, tmp_path_factory):
    lake = Lakehouse(spark, str(tmp_path_factory.mktemp("plans")), 2)
    append_events(events(spark, small), lake.log_root, "load", 0)
    merge_new_events(lake, EPOCH)
    return lake


@pytest.fixture(scope="module")
def tables(lake):
    return lake.tables()


@pytest.fixture
def no_broadcast(spark):
    """Tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


REPORTS = {
    "q01": analytics.daily_revenue, "q02": analytics.top_sellers, "q03": analytics.review_sentiment, "q04": analytics.order_funnel,
    "q05": analytics.cohort_retention, "q05w": analytics.cohort_retention_window, **gold.MODELS, "orphans": quality.orphans,
}


@pytest.mark.parametrize("name", REPORTS)
def test_no_cross_join_no_expand_no_python(tables, no_broadcast, name):
    plan = plan_of(REPORTS[name](tables))
    for banned in ("Cartesian", "NestedLoop", "Expand", "Python", "BatchEval", "MapInPandas"):
        assert banned not in plan, banned


def test_filters_and_columns_reach_the_scan(tables):
    plan = plan_of(analytics.order_funnel(tables, one_row_per_order=True))
    assert "PushedFilters: [IsNotNull(is_deleted), Not(EqualTo(is_deleted,true))]" in plan or "EqualTo(is_deleted,false)" in plan
    read = re.search(r"ReadSchema: struct<(.*)", plan)[1]
    assert "estimated_delivery_date" not in read and "customer_id" not in read
    sold = plan_of(analytics.daily_revenue(tables))
    assert "EqualTo(status,delivered)" in sold and "freight_value" not in sold


def test_weekly_counts_need_one_small_exchange(tables, no_broadcast):
    plan = plan_of(gold.order_funnel(tables))
    assert plan.count("Exchange") == 1 and "hashpartitioning(order_week" in plan


def exchanged(plan: str) -> list[str]:
    return [re.sub(r"#\d+L?", "", k) for k in re.findall(r"hashpartitioning\((\w+#\d+L?)", plan)]


def test_buckets_join_orders_and_lines_without_an_exchange(tables, no_broadcast):
    """Join and fold to one row per order run on the tables' buckets; reviews, laid out by month, too."""
    plan = plan_of(gold.seller_totals(tables))
    assert exchanged(plan) == ["seller_id"] and plan.count("Bucketed: true") == 2
    assert "order_id" not in exchanged(plan_of(gold.review_sentiment_by_state(tables)))
    paid = tables["order_payments"].join(tables["orders"], "order_id").join(tables["order_items"], "order_id").groupBy("order_id").count()
    assert "Exchange" not in plan_of(paid) and plan_of(paid).count("Bucketed: true") == 3


@pytest.mark.parametrize("model,groups", [(gold.daily_revenue, {"order_date"}), (analytics.daily_revenue, {"order_date"})])
def test_sales_are_joined_and_folded_by_bucket(tables, model, groups):
    """With products small enough to be sent around, as Spark decides, only daily sums are exchanged."""
    plan = plan_of(model(tables))
    assert set(exchanged(plan)) <= groups and plan.count("Bucketed: true") == 2


def test_a_month_filter_reaches_the_folders(lake):
    table = lake.state_table("orders")
    low, high = datetime(1996, 3, 10), datetime(1996, 5, 1)
    rows = table.between(low, high)
    assert rows.count() == table.read().where((F.col("purchased_at") >= F.lit(low)) & (F.col("purchased_at") < F.lit(high))).count() > 0
    assert re.search(r"PartitionFilters: \[isnotnull\(purchased_at_month#\d+\), \(purchased_at_month#\d+ >= 1996-03-01\)", plan_of(rows))
    with pytest.raises(ValueError):
        lake.state_table("sellers").between(low, high)


def test_top_k_does_not_sort_everything(tables):
    assert "TakeOrderedAndProject(limit=100" in plan_of(analytics.top_sellers(tables))


def test_merge_joins_once_on_the_key(spark, no_broadcast):
    from tidelake.operators import merge

    entity = ENTITIES["order_items"]
    empty = spark.createDataFrame([], entity.state)
    plan = merge(empty, empty, entity)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") <= 1


def hot(spark, tables, name, column, value):
    """The table with a third of its rows moved to one value of a column."""
    return {**{n: tables[n] for n in tables}, name: tables[name].withColumn(
        column, F.when(F.pmod(F.hash(*ENTITIES[name].key), F.lit(3)) == 0, F.lit(value)).otherwise(F.col(column)))}


@pytest.mark.parametrize("plan,name,column,value", [
    (gold.daily_revenue, "order_items", "product_id", "1"),
    (analytics.cohort_retention, "orders", "customer_id", "1"),
    (analytics.daily_revenue, "order_items", "product_id", "1"),
    (gold.top_sellers, "order_items", "order_id", "1"),
    (gold.review_sentiment_by_state, "order_reviews", "order_id", "1"),
])
def test_a_hot_key_is_split_over_tasks(spark, lake, no_broadcast, plan, name, column, value):
    tables = lake.tables(bucketed=False)
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.files.maxPartitionBytes": "20k", "spark.sql.files.openCostInBytes": "0",
    }
    uneven = hot(spark, tables, name, column, value)
    expected = sorted(map(str, plan(uneven).collect()))
    kept = {k: spark.conf.get(k) for k in small}
    for key, setting in small.items():
        spark.conf.set(key, setting)
    try:
        rows = plan(uneven)
        assert sorted(map(str, rows.collect())) == expected
        assert "skew=true" in plan_of(rows)
    finally:
        for key, setting in kept.items():
            spark.conf.set(key, setting)


def test_uneven_buckets_are_not_joined_by_bucket(spark, small, tmp_path, no_broadcast):
    """A third of all lines on one order: the stored buckets show it, and joins exchange and split instead."""
    from tidelake.sources import shop_sample as shop

    lake = Lakehouse(spark, str(tmp_path), 4)
    for name in ("orders", "order_items"):
        rows = spark.createDataFrame([], ENTITIES[name].state).unionByName(shop.current(spark, small, name), allowMissingColumns=True)
        lake.state_table(name).replace(hot(spark, {name: rows}, name, "order_id", "1")[name] if name == "order_items" else rows)
    assert lake.even() and "Bucketed: true" in plan_of(gold.seller_totals(lake.tables()))
    expected = sorted(map(str, gold.seller_totals(lake.tables()).collect()))
    small_parts = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.files.maxPartitionBytes": "20k", "spark.sql.files.openCostInBytes": "0",
    }
    kept = {k: spark.conf.get(k) for k in small_parts}
    for key, setting in small_parts.items():
        spark.conf.set(key, setting)
    try:
        assert not lake.even()
        rows = gold.seller_totals(lake.tables())
        assert sorted(map(str, rows.collect())) == expected
        assert exchanged(plan_of(rows)).count("order_id") >= 2 and "Bucketed: true" not in plan_of(rows)
    finally:
        for key, setting in kept.items():
            spark.conf.set(key, setting)


def test_a_dominant_table_is_written_in_even_parts(spark, small, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "60k")
    try:
        rows = events(spark, small, "orders", "sellers").repartition(4)
        append_events(rows, f"{tmp_path}/log", "run", 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [
        os.path.getsize(os.path.join(base, f)) for base, _, names in os.walk(f"{tmp_path}/log/source_table=orders") for f in names if f.endswith(".parquet")
    ]
    assert len(files) >= 4 and max(files) < 0.5 * sum(files)


@pytest.mark.parametrize("name", [n for n in QUERIES if n.startswith(("merge", "silver_o", "metrics", "bronze_parse"))])
def test_log_queries_stay_inside_the_engine(spark, small, name):
    plan = plan_of(QUERIES[name](spark, small))
    for banned in ("Cartesian", "NestedLoop", "Python"):
        assert banned not in plan


def test_exact_percentiles_read_the_events_once(spark, small, tmp_path):
    from tidelake.plans import metrics
    from tidelake.sources import read_events

    append_events(events(spark, small, "orders"), f"{tmp_path}/log", "run", 0)
    rows = metrics.commit_latency(read_events(spark, f"{tmp_path}/log", "orders"))
    rows.collect()
    final = plan_of(rows).split("Initial Plan")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final
