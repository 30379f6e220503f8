"""Times the pipeline and the headline queries; prints one JSON line.

The layers are built once, as in production: records on disk, the event log by the stream, current
state by merging the log, stored reports by a refresh. Then each query runs over the stored layer
it belongs to: once cold, twice to warm up, and three timed runs, of which the geometric mean counts.
"""

from __future__ import annotations

import json
import math
import os
import tempfile
import time

from pyspark.sql import functions as F

from tidelake.plans import analytics, gold
from tidelake.plans.pipeline import EPOCH, Lakehouse, merge_new_events, rebuild, refresh_reports
from tidelake.session import build_session
from tidelake.sources import shop_sample as shop
from tidelake.sources.files import read_record_files
from tidelake.streaming import start_ingest, start_state
from tidelake.streaming.ingest import DRAIN

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_UPS, TIMED = 2, 3


def once(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def drain(rows) -> None:
    """Run a query and deliver its rows, as a reader would get them."""
    rows.toArrow()


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS, spark__ui__enabled="false",
        spark__driver__memory="12g", spark__sql__adaptive__advisoryPartitionSizeInBytes="8m",
        spark__sql__execution__arrow__pyspark__enabled="true",
    )
    spark.sparkContext.setLogLevel("ERROR")
    work = os.environ.get("BENCH_WORK_DIR") or tempfile.mkdtemp(prefix="run-", dir="/tmp")
    lake = Lakehouse(spark, f"{work}/lake", buckets=max(2, int(CPUS) // 2))
    seconds, cold, rates = {}, {}, {}

    # Records as the broker would hold them, in several files. Not timed: the source system's work.
    records = f"{work}/records"
    shop.all_changes(spark, FOLDER).repartition(4 * int(CPUS)).write.parquet(records)
    changes = spark.read.parquet(records).count()

    def ingest() -> None:
        start_ingest(
            read_record_files(spark, records), lake.log_root, f"{work}/checkpoints/ingest", DRAIN,
            ingested_at=F.col("timestamp"),
        ).awaitTermination()

    seconds["bronze_stream_ingest"] = once(ingest)
    logged = lake.events().count()
    seconds["silver_merge_first"] = once(lambda: merge_new_events(lake, EPOCH))
    seconds["silver_merge_replay"] = once(lambda: merge_new_events(lake, EPOCH))
    seconds["silver_rebuild"] = once(lambda: rebuild(lake))
    seconds["gold_refresh"] = once(lambda: refresh_reports(lake))

    streamed = Lakehouse(spark, f"{work}/streamed", buckets=max(2, int(CPUS) // 2))
    os.makedirs(streamed.root, exist_ok=True)
    os.symlink(lake.log_root, streamed.log_root)
    seconds["stream_state_and_reports"] = once(
        lambda: start_state(streamed, f"{work}/checkpoints/state", DRAIN).awaitTermination()
    )
    rates = {
        "change_records": changes,
        "bronze_rows_per_sec": round(logged / seconds["bronze_stream_ingest"]),
        "silver_merge_rows_per_sec": round(logged / seconds["silver_merge_first"]),
    }

    queries = {
        "q01_daily_revenue": lambda: analytics.daily_revenue(lake.tables()),
        "q02_top_sellers": lambda: analytics.top_sellers(lake.tables()),
        "q03_review_sentiment": lambda: analytics.review_sentiment(lake.tables()),
        "q04_order_funnel": lambda: analytics.order_funnel(lake.tables(), one_row_per_order=True),
        "q04_order_funnel_distinct": lambda: analytics.order_funnel(lake.tables()),
        "q05_cohort_retention": lambda: analytics.cohort_retention_window(lake.tables()),
        "q05_cohort_retention_join": lambda: analytics.cohort_retention(lake.tables()),
        **{f"gold_{name}": (lambda m=model: m(lake.tables())) for name, model in gold.MODELS.items()},
        "mv_q01": lambda: analytics.read_daily_revenue(lake.reports()),
        "mv_q02": lambda: analytics.read_top_sellers(lake.reports()),
        "mv_q03": lambda: analytics.read_review_sentiment(lake.reports()),
        "mv_q04": lambda: analytics.read_order_funnel(lake.reports()),
    }
    for name, query in queries.items():
        cold[name] = once(lambda: drain(query()))
        for _ in range(WARM_UPS):
            drain(query())
        runs = [once(lambda: drain(query())) for _ in range(TIMED)]
        seconds[name] = math.exp(sum(math.log(r) for r in runs) / TIMED)

    def mean(names) -> float:
        return round(math.exp(sum(math.log(seconds[n]) for n in names) / len(names)), 4)

    scans = ["q01_daily_revenue", "q02_top_sellers", "q03_review_sentiment", "q04_order_funnel", "q05_cohort_retention"]
    print(json.dumps({
        "metric": "geometric mean of five analytic queries over current state, warm",
        "value": mean(scans), "unit": "sec",
        "queries": {name: round(value, 4) for name, value in seconds.items()},
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
        "cold": {name: round(value, 4) for name, value in cold.items()},
        "stored_reports_geomean": mean(["mv_q01", "mv_q02", "mv_q03", "mv_q04"]),
        **rates,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
