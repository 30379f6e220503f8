"""Quality rules that fail, and metrics against plain computation."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tidelake.operators import exact_percentiles
from tidelake.plans import metrics, quality
from tidelake.plans.metrics import BOUNDS
from tidelake.schemas import ENTITIES


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_rules_count_violations(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), (None, 3), (None, 3), ("b", None)], "k string, n int")
    assert rows(quality.null_counts(frame, "t", ["k", "n"])) == [("t", "k", 2), ("t", "n", 1)]
    assert rows(quality.repeated_keys(frame, "t", ["k"])) == [("t", "k", 1)]
    assert rows(quality.repeated_keys(frame, "t", ["k", "n"])) == [("t", "k,n", 1)]
    reviews = spark.createDataFrame([(0,), (1,), (5,), (6,), (None,)], "review_score int")
    assert rows(quality.score_range(reviews)) == [(5, 2)]


def test_orphans_are_counted_by_key_and_row(spark):
    ids = lambda column, *values: spark.createDataFrame([(v,) for v in values], f"{column} string")
    keyed = lambda **columns: spark.createDataFrame([tuple(columns.values())], ", ".join(f"{c} string" for c in columns))
    lines = spark.createDataFrame([("o1", "lost", "s1")] * 5 + [("o1", "gone", "s1"), ("o1", None, "s1")], "order_id string, product_id string, seller_id string")
    tables = {
        "orders": keyed(order_id="o1", customer_id="c1"), "customers": ids("customer_id", "c1"), "order_items": lines,
        "products": ids("product_id", "p1"), "sellers": ids("seller_id", "s1"),
        "order_payments": ids("order_id", "o1"), "order_reviews": ids("order_id", "o9"),
    }
    bad = [r for r in rows(quality.orphans(tables)) if r[4]]
    assert bad == [("order_items", "product_id", "products", 2, 6), ("order_reviews", "order_id", "orders", 1, 1)]


@pytest.mark.parametrize("values", [
    [5], [1, 2], [7] * 50, list(range(100)), [-3, 0, 10**9, 10**12, 5 * 10**12],
    [random.Random(1).randrange(-(10**10), 10**10) for _ in range(997)],
    [3] * 300 + [random.Random(2).randrange(10**7) for _ in range(600)],
])
def test_exact_percentiles(spark, values):
    frame = spark.createDataFrame([(v,) for v in values] + [(None,)], "v bigint")
    levels = [0.0, 0.5, 0.95, 0.99, 1.0]
    found = exact_percentiles(frame, F.col("v"), levels, ["a", "b", "c", "d", "e"]).first()
    ordered = sorted(values)

    def at(q):
        p = q * (len(ordered) - 1)
        low, part = int(p), p - int(p)
        return ordered[low] + (ordered[min(low + 1, len(ordered) - 1)] - ordered[low]) * part

    assert list(found)[:5] == pytest.approx([at(q) for q in levels], rel=1e-9)
    assert found.measured_rows == len(values)


def test_percentiles_of_nothing(spark):
    found = exact_percentiles(spark.createDataFrame([], "v bigint"), F.col("v"), [0.5], ["p"]).first()
    assert tuple(found) == (None, 0)


def timed(spark, *pairs, table="orders"):
    """Events as (commit ms, seconds until arrival)."""
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    data = [(table, ms, start + dt.timedelta(milliseconds=(ms or 0) - 1_704_067_200_000, seconds=s)) for ms, s in pairs]
    return spark.createDataFrame(data, "source_table string, _cdc_source_ts_ms bigint, _cdc_ingested_at timestamp")


T0 = 1_704_067_200_000


def test_sketched_percentiles_are_within_their_rank_error(spark):
    draw = random.Random(3)
    waits = [draw.expovariate(0.1) for _ in range(4000)]
    events = timed(spark, *[(T0 + i, w) for i, w in enumerate(waits)])
    exact, sketch = metrics.commit_latency(events).first(), metrics.commit_latency_approx(events, 1000).first()
    cuts = statistics.quantiles(waits, n=100, method="inclusive")
    assert list(exact)[:3] == pytest.approx([cuts[49], cuts[94], cuts[98]], abs=0.01)
    ordered = sorted(waits)
    for value, level in zip(list(sketch)[:3], (0.5, 0.95, 0.99)):
        rank = sum(w <= value + 0.01 for w in ordered) / len(ordered)
        assert abs(rank - level) <= 0.004
    assert sketch.measured_rows == exact.measured_rows == 4000


def test_unknown_commit_times_are_not_measured(spark):
    events = timed(spark, (T0, 1.0), (None, 5.0), (0, 9.0))
    assert tuple(metrics.commit_latency(events).first()) == (1.0, 1.0, 1.0, 1)


def test_throughput_clamps_and_says_so(spark):
    events = timed(spark, (T0, 0.0), (T0, 4.0), (T0, 9.0)).unionByName(timed(spark, (T0, 0.0), (T0, 0.5), table="sellers"))
    assert rows(metrics.log_throughput(events)) == [("orders", 3, 9.0, 0.3, False), ("sellers", 2, 0.5, 2.0, True)]
    assert rows(metrics.log_span(events)) == [(5, 9.0, 0.6, False)]


def test_arrival_latency_per_table(spark):
    now = F.lit("2024-01-01T00:00:10").cast("timestamp")
    events = timed(spark, (T0, 0), (T0 + 4000, 0), (T0 + 60_000, 0), (None, 0)).unionByName(
        timed(spark, (T0, 0)).withColumn("source_table", F.lit(None).cast("string")))
    assert rows(metrics.latency_by_table(events, now)) == [("orders", 4, 0.0, 10.0, 4.0), ("unknown", 1, 10.0, 10.0, 10.0)]


def test_histogram_bounds_are_inclusive_above(spark):
    now = F.col("_cdc_ingested_at")
    events = timed(spark, *[(T0, s) for s in (0, 5, 5.001, 10000, 10000.5)])
    assert {r.le: r.n for r in metrics.latency_histogram(events, now).collect()} == {"0": 1, "5": 1, "10": 1, "10000": 1, "+Inf": 1}


def test_percentile_read_from_the_histogram(spark):
    now = F.col("_cdc_ingested_at")
    one = metrics.latency_p95_over_time(timed(spark, *[(T0, 0.1)] * 100), now).first()
    assert (one.window_start, one.p95_s, one.n) == (dt.datetime(2024, 1, 1), 4.75, 100)
    assert metrics.latency_p95_over_time(timed(spark, (T0, 20000)), now).first().p95_s == float(BOUNDS[-1])
    assert metrics.latency_p95_over_time(timed(spark, (T0, 0)), now).first().p95_s == 0.0
    spread = timed(spark, *[(T0, 1)] * 90, *[(T0, 7)] * 10)
    assert metrics.latency_p95_over_time(spread, now).first().p95_s == 7.5  # half way through (5, 10]


def test_state_throughput_skips_empty_tables(spark):
    entity = ENTITIES["sellers"]
    row = lambda i, minute: (str(i), None, None, None, "r", 1, 1, False, dt.datetime(2024, 1, 1, 0, minute))
    full = spark.createDataFrame([row(1, 0), row(2, 0), row(3, 1)], entity.state)
    empty = spark.createDataFrame([], ENTITIES["products"].state)
    assert rows(metrics.state_throughput({"sellers": full, "products": empty})) == [("sellers", 3, 60.0, 0.1, False)]
