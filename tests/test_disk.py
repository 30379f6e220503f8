"""What a job keeps on disk: the exchanges of one step, tables that something still reads, rows rather than records."""

import datetime as dt
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from tidelake.plans.pipeline import Lakehouse
from tidelake.registry.queries import staged_batch
from tidelake.sources import shop_sample as shop
from tidelake.sources import tables


def exchanged(spark):
    """Names of the exchanges' files."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {p.name for d in folders for p in Path(d).rglob("shuffle_*")}


def test_exchanges_go_when_a_write_ends(spark, tmp_path):
    before = exchanged(spark)
    spark.range(100_000).repartition(8, "id").groupBy("id").count().write.parquet(f"{tmp_path}/rows")
    assert spark.read.parquet(f"{tmp_path}/rows").count() == 100_000
    until = time.time() + 20
    while exchanged(spark) - before and time.time() < until:  # they go in the background
        time.sleep(0.1)
    assert not exchanged(spark) - before


@pytest.mark.parametrize("keep", [False, True])
def test_a_merge_leaves_no_tables_but_those_of_its_changes(spark, small, tmp_path, monkeypatch, keep):
    made, new_folder = [], tables.scratch_folder
    monkeypatch.setattr(tables, "scratch_folder", lambda *x: made.append(new_folder(*x)) or made[-1])
    table = Lakehouse(spark, str(tmp_path), 2).state_table("orders")
    table.merge(staged_batch(spark, small, "orders", 1))
    moved = staged_batch(spark, small, "orders", 2).withColumn("purchased_at", F.lit(dt.datetime(2030, 1, 2)))
    _, changes = table.merge(moved, keep=keep)
    left = [Path(x).name for x in made if Path(x).exists()]
    assert len(made) >= 4 and [n for n in left if "merged" in n or "places" in n] == []
    assert len(left) == (2 if keep else 0)
    if keep:
        assert changes.after.count() == moved.count() and changes.before.count() > 0


def test_dealt_records_are_all_records_and_rows_are_exchanged(spark, small):
    names = ("orders", "order_items", "customers")
    dealt, every = shop.dealt_changes(spark, small, 5, names), shop.all_changes(spark, small, names)
    assert dealt.rdd.getNumPartitions() == 5
    assert dealt.schema == every.schema and dealt.exceptAll(every).isEmpty() and every.exceptAll(dealt).isEmpty()
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("RepartitionByExpression")  # nearer the root: behind the exchange
