"""The nine results on a few rows of our own, through the whole bulk-load path."""

import datetime as dt
from decimal import Decimal as D

import pytest
from tidelake.plans import analytics, gold, quality
from tidelake.plans.pipeline import EPOCH, Lakehouse, load_snapshot, merge_new_events, refresh_reports
from tidelake.schemas import ENTITIES, GOLD
from tidelake.sources.catalog import register_views

T = dt.datetime
ROWS = {
    "customers": [("k1", "person-1", "111", "north end", "North"), ("k2", "person-2", "222", "harbour", "South"), ("k3", "person-3", "333", "hill", "West")],
    "sellers": [("v1", "900", "mill", "North"), ("v2", "901", "quay", "South")],
    "products": [("g1", "lamps", 11, 101, 1, 700, 7, 8, 9), ("g2", "rugs", 12, 102, 2, 1700, 17, 18, 19), ("g3", "pots", 13, 103, 3, 270, 27, 28, 29)],
    "orders": [
        ("a1", "k1", "delivered", T(2020, 3, 4, 8), T(2020, 3, 4, 9), None, T(2020, 3, 9, 20), dt.date(2020, 3, 12)),
        ("a2", "k2", "processing", T(2020, 5, 19, 22), T(2020, 5, 20, 1), None, None, dt.date(2020, 6, 1)),
    ],
    "order_items": [
        ("a1", 1, "g1", "v1", T(2020, 3, 5), D("41.25"), D("3.10")), ("a1", 2, "g2", "v2", T(2020, 3, 6), D("120.00"), D("9.00")),
        ("a2", 1, "g3", "v1", T(2020, 5, 21), D("7.75"), D("1.05")),
    ],
    "order_payments": [("a1", 1, "card", 2, D("173.35")), ("a2", 1, "cash", 1, D("8.80"))],
    "order_reviews": [
        ("w1", "a1", 4, "good", "arrived whole", T(2020, 3, 10), T(2020, 3, 11)),
        ("w2", "a2", 2, "slow", "no news yet", T(2020, 5, 28), T(2020, 5, 29)),
    ],
}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lake = Lakehouse(spark, str(tmp_path_factory.mktemp("seed")), 2)
    for name, rows in ROWS.items():
        source = spark.createDataFrame(rows, ENTITIES[name].source)
        load_snapshot(lake, name, source, "load", T(2024, 1, 1), f"shop.public.{name}")
    merge_new_events(lake, EPOCH, "load")
    refresh_reports(lake)
    return lake


def rows(frame):
    return [tuple(r) for r in frame.collect()]


def test_every_entity_is_typed_as_declared(lake):
    for name, entity in ENTITIES.items():
        state = lake.state(name)
        assert [(f.name, f.dataType) for f in state.schema] == [(f.name, f.dataType) for f in entity.state]
        assert sorted(tuple(r) for r in state.select(*entity.columns).collect()) == sorted(ROWS[name])


def test_analytic_queries(lake):
    tables = lake.tables()
    day = dt.date(2020, 3, 4)
    assert rows(analytics.daily_revenue(tables)) == [(day, "rugs", D("120.00"), 1), (day, "lamps", D("41.25"), 1)]
    assert rows(analytics.top_sellers(tables)) == [("v2", "South", 1, D("120.00"), 100.0), ("v1", "North", 2, D("49.00"), 50.0)]
    assert rows(analytics.top_sellers(tables, limit=1)) == [("v2", "South", 1, D("120.00"), 100.0)]
    assert sorted(rows(analytics.review_sentiment(tables))) == [("North", 1, 4.0, 1, 0, 0), ("South", 1, 2.0, 0, 0, 1)]
    funnel = [(T(2020, 5, 18), 1, 1, 0, 0, 0, 0.0), (T(2020, 3, 2), 1, 1, 0, 1, 0, 100.0)]
    assert rows(analytics.order_funnel(tables)) == rows(analytics.order_funnel(tables, one_row_per_order=True)) == funnel
    cohorts = [(T(2020, 3, 1), 1, 0, 0, 0, 0.0), (T(2020, 5, 1), 1, 0, 0, 0, 0.0)]
    assert rows(analytics.cohort_retention(tables)) == rows(analytics.cohort_retention_window(tables)) == cohorts


def test_reports(lake):
    reports, day = lake.reports(), dt.date(2020, 3, 4)
    for name, frame in reports.items():
        assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in GOLD[name]]
    assert sorted(rows(reports["daily_revenue"])) == [(day, "lamps", D("41.25"), D("3.10"), 1, 1), (day, "rugs", D("120.00"), D("9.00"), 1, 1)]
    assert sorted(rows(reports["top_sellers"])) == [
        ("v1", "mill", "North", 2, D("49.00"), D("4.15"), 50.0, 5.0), ("v2", "quay", "South", 1, D("120.00"), D("9.00"), 100.0, 5.0)]
    assert sorted(rows(reports["review_sentiment_by_state"])) == [("North", 1, 4.0, 1, 0, 0, 100.0), ("South", 1, 2.0, 0, 0, 1, 0.0)]
    assert sorted(rows(reports["order_funnel"])) == [(T(2020, 3, 2), 1, 1, 1, 0, 1, 0, 100.0), (T(2020, 5, 18), 1, 1, 1, 0, 0, 0, 0.0)]
    assert rows(analytics.read_daily_revenue(reports, 1)) == [(day, "rugs", D("120.00"), 1)]
    assert rows(analytics.read_top_sellers(reports, 1)) == [("v2", "South", 1, D("120.00"), 100.0)]
    assert rows(analytics.read_review_sentiment(reports)) == [("North", 1, 4.0, 1, 100.0), ("South", 1, 2.0, 0, 0.0)]
    assert rows(analytics.read_order_funnel(reports, 1)) == [(T(2020, 5, 18), 1, 0, 0, 0.0)]


def test_reports_in_sql_text(spark, lake):
    """The same tables under names for SQL give what the DataFrame plans give."""
    register_views(lake.tables(), "silver_")
    register_views(lake.reports(), "gold_")
    found = spark.sql("""
      WITH done AS (SELECT order_id, CAST(purchased_at AS date) AS day FROM silver_orders WHERE status = 'delivered' AND NOT is_deleted)
      SELECT done.day, kind.product_category, SUM(line.price) AS value, COUNT(DISTINCT line.order_id) AS orders
      FROM done INNER JOIN silver_order_items line USING (order_id) INNER JOIN silver_products kind USING (product_id)
      WHERE NOT (line.is_deleted OR kind.is_deleted) GROUP BY ALL ORDER BY done.day DESC, value DESC""")
    assert rows(found) == rows(analytics.daily_revenue(lake.tables()))
    best = spark.sql("SELECT max_by(seller_id, gmv) AS best, max(gmv) AS gmv FROM gold_top_sellers")
    assert rows(best) == [("v2", D("120.00"))]


def test_rules_pass_on_good_rows(lake):
    for found in (
        quality.gold_not_null(lake.reports()), quality.gold_unique(lake.reports()), quality.state_keys(lake.tables()),
        quality.state_not_null(lake.tables()), quality.orphans(lake.tables()), quality.score_range(lake.state("order_reviews")),
    ):
        assert found.filter("violations > 0").isEmpty() and not found.isEmpty()


def state_rows(spark, name, values):
    entity = ENTITIES[name]
    audit = ("u", 1, 1, False, T(2024, 1, 1))
    return spark.createDataFrame([tuple(v.get(c) for c in entity.columns) + audit for v in values], entity.state)


def test_rates_can_pass_100_by_lines_but_not_by_orders(spark):
    order = dict(order_id="o", customer_id="c", status="delivered", purchased_at=T(2018, 1, 1, 23), delivered_customer_at=T(2018, 1, 2, 1))
    item = lambda n: dict(order_id="o", order_item_id=n, product_id="p", seller_id="s", price=D("1.00"), freight_value=D("0.10"))
    tables = {
        "orders": state_rows(spark, "orders", [order]), "order_items": state_rows(spark, "order_items", [item(1), item(2), item(3)]),
        "sellers": state_rows(spark, "sellers", [dict(seller_id="s"), dict(seller_id="idle")]),
    }
    by_lines, by_orders = rows(gold.top_sellers(tables)), rows(gold.top_sellers_order_rate(tables))
    assert by_lines == [("s", None, None, 1, D("3.00"), D("0.30"), 300.0, 1.0)]  # 23:00 to 01:00 is one day
    assert by_orders[0][6] == 100.0


def test_cohort_edges(spark):
    first = T(2018, 1, 31)
    after = lambda **d: first + dt.timedelta(**d)

    def order(n, customer, at, status="shipped"):
        return dict(order_id=str(n), customer_id=customer, status=status, purchased_at=at)

    orders = [
        order(1, "same moment", first), order(2, "same moment", first),
        order(3, "day 30", first), order(4, "day 30", after(days=30)),
        order(5, "past 30", first), order(6, "past 30", after(days=30, microseconds=1)),
        order(7, "day 90", first), order(8, "day 90", after(days=90)), order(9, "day 90", after(days=95)),
        order(10, "past 90", first), order(11, "past 90", after(days=90, seconds=1)),
        order(12, "canceled", first, "canceled"), order(13, "canceled again", first), order(14, "canceled again", after(days=1), "canceled"),
        order(15, None, first), order(16, None, after(days=2)), order(17, "no time", None), order(18, "no status", first, None),
    ]
    tables = {"orders": state_rows(spark, "orders", orders)}
    expected = [(None, 1, 0, 0, 0, 0.0), (T(2018, 1, 1), 6, 1, 2, 3, 50.0)]
    assert rows(analytics.cohort_retention(tables)) == expected
    assert rows(analytics.cohort_retention_window(tables)) == expected


def test_null_week_is_a_group_and_repeated_orders_count_once(spark):
    order = dict(order_id="1", status="delivered", purchased_at=None, approved_at=T(2018, 1, 1))
    tables = {"orders": state_rows(spark, "orders", [order, order, {**order, "order_id": "2", "status": None}])}
    assert rows(analytics.order_funnel(tables)) == [(None, 2, 2, 0, 1, 0, 50.0)]


def test_distinct_customers_and_orders_per_day(spark):
    order = lambda n, c: dict(order_id=n, customer_id=c, status="delivered", purchased_at=T(2018, 1, 1, 5))
    item = lambda o, n, p: dict(order_id=o, order_item_id=n, product_id=p, seller_id="s", price=D("1.00"), freight_value=D("0.50"))
    tables = {
        "orders": state_rows(spark, "orders", [order("1", "a"), order("2", "a"), order("3", "b"), order("4", None)]),
        "order_items": state_rows(spark, "order_items", [item("1", 1, "p"), item("1", 2, "q"), item("2", 1, "p"), item("3", 1, "none"), item("4", 1, "p")]),
        "products": state_rows(spark, "products", [dict(product_id="p", product_category="x"), dict(product_id="q", product_category="x"), dict(product_id="none")]),
    }
    day = dt.date(2018, 1, 1)
    assert sorted(rows(gold.daily_revenue(tables)), key=str) == [
        (day, "x", D("4.00"), D("2.00"), 3, 1), (day, None, D("1.00"), D("0.50"), 1, 1)]
    assert sorted(rows(analytics.daily_revenue(tables)), key=str) == [(day, "x", D("4.00"), 3), (day, None, D("1.00"), 1)]
