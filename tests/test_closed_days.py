"""Closed days of the log: the same rows before and after, in batch reads, by name and in a stream that goes on."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidelake.jobs import arguments, run
from tidelake.plans.pipeline import EPOCH, Lakehouse, merge_new_events, rebuild
from tidelake.registry.queries import events, updated_at
from tidelake.schemas import ENTITIES
from tidelake.sources import append_events, event_log
from tidelake.sources.catalog import name_log
from tidelake.sources.event_log import close_days, closed_root, log_batches, read_new_events, stream_events

NAMES = ("orders", "sellers")


def batch_of(spark, small, k, day, names=NAMES):
    """A tenth of the events, as if they had come on a day of January."""
    rows = events(spark, small, *names).where(F.pmod(F.hash("_cdc_offset"), F.lit(10)) == k)
    return rows.withColumns({"_cdc_ingested_at": F.col("_cdc_ingested_at") + F.make_dt_interval(F.lit(day - 1)), "ingest_date": F.lit(dt.date(2024, 1, day))})


@pytest.fixture
def lake(spark, small, tmp_path):
    lake = Lakehouse(spark, f"{tmp_path}/lake", 2, {n: ENTITIES[n] for n in NAMES})
    for k, day in enumerate((1, 1, 1, 2, 2, 3)):
        append_events(batch_of(spark, small, k, day).repartition(4), lake.log_root, f"run {k}:a+b", k, even_out=False)
    return lake


def content(frame):
    return sorted(map(str, frame.collect()))


def files(root):
    return {os.path.join(base, n): os.stat(os.path.join(base, n)).st_mtime_ns for base, _, names in os.walk(root) for n in names if n.endswith(".parquet")}


def batches(lake):
    return {b for n in NAMES for b in log_batches(lake.spark, lake.log_root, n)}


def reads(lake):
    spark, moment = lake.spark, dt.datetime(2024, 1, 2)
    return [content(lake.events()), content(lake.events("orders")), content(read_new_events(spark, lake.log_root, "orders", moment)), content(read_new_events(spark, lake.log_root, "sellers", EPOCH))]


def test_reads_are_the_same_and_files_few_and_sorted(spark, small, lake):
    before, many, there = reads(lake), len(files(lake.log_root)), batches(lake)
    moved = close_days(spark, lake.log_root, dt.date(2024, 1, 3))
    assert set(moved) == {b for b in there if "2024-01-03" not in b} and len(moved) >= 6
    assert reads(lake) == before and close_days(spark, lake.log_root, dt.date(2024, 1, 3)) == []
    closed = files(closed_root(lake.log_root))
    assert len(closed) == len({b.rsplit("/", 2)[0] for b in moved}) and len(closed) + len(files(lake.log_root)) < many
    for path in closed:
        times = [r[0] for r in spark.read.parquet(path).select("_cdc_ingested_at").collect()]
        assert times == sorted(times)
    assert {b.split("/")[1] for b in log_batches(spark, lake.log_root, "orders")} == {"ingest_date=2024-01-03"}
    # a batch that comes late is read at once, and closed without a change to what is closed
    append_events(batch_of(spark, small, 7, 1), lake.log_root, "late", 0)
    after = reads(lake)
    assert len(after[0]) > len(before[0])
    close_days(spark, lake.log_root, dt.date(2024, 1, 2))
    assert reads(lake) == after and {p: t for p, t in files(closed_root(lake.log_root)).items() if p in closed} == closed


def test_a_file_is_split_where_a_load_has_one_time(spark, small, tmp_path):
    root = f"{tmp_path}/log"
    rows = events(spark, small, "orders").withColumns({"_cdc_ingested_at": F.lit("2024-01-01").cast("timestamp"), "ingest_date": F.lit(dt.date(2024, 1, 1))})
    append_events(rows, root, "load", 0)
    close_days(spark, root, dt.date(2024, 1, 2), file_bytes=20_000)
    sizes = [os.path.getsize(p) for p in files(closed_root(root))]
    assert len(sizes) >= 4 and max(sizes) < 0.5 * sum(sizes)


@pytest.mark.parametrize("left", [0, 1])
def test_a_call_that_broke_off_is_made_good(spark, lake, monkeypatch, left):
    before, done = reads(lake), []

    def breaks(spark, path):
        if len(done) >= left:
            raise OSError("lost")
        done.append(path)
        real(spark, path)

    real = event_log.delete
    monkeypatch.setattr(event_log, "delete", breaks)
    with pytest.raises(OSError):
        close_days(spark, lake.log_root, dt.date(2024, 1, 2))
    assert reads(lake) == before  # batches in both places count once
    monkeypatch.undo()
    kept = files(closed_root(lake.log_root))
    close_days(spark, lake.log_root, dt.date(2024, 1, 2))
    assert reads(lake) == before and files(closed_root(lake.log_root)) == kept


def test_a_stream_goes_on_without_repeat_or_loss(spark, small, lake, tmp_path):
    cp, out = f"{tmp_path}/cp", f"{tmp_path}/out"

    def advance():
        stream_events(spark, lake.log_root, 3).writeStream.format("parquet").option("checkpointLocation", cp).trigger(availableNow=True).start(out).awaitTermination()

    def taken():
        return content(spark.read.schema(lake.events().schema).parquet(out))

    assert close_days(spark, lake.log_root, dt.date(2024, 1, 9), [cp]) == []  # it has seen nothing yet
    advance()
    append_events(batch_of(spark, small, 8, 1), lake.log_root, "unseen", 0)
    there = batches(lake)
    moved = close_days(spark, lake.log_root, dt.date(2024, 1, 3), [cp])
    assert set(moved) == {b for b in there if "2024-01-03" not in b and "unseen" not in b} != set()
    append_events(batch_of(spark, small, 9, 3), lake.log_root, "new", 0)
    advance()
    assert taken() == content(lake.events())
    assert len(close_days(spark, lake.log_root, dt.date(2024, 1, 9), [cp, f"{tmp_path}/other"])) == 0  # another stream has not begun
    there = batches(lake)
    assert set(close_days(spark, lake.log_root, dt.date(2024, 1, 9), [cp])) == there != set()
    advance()
    assert taken() == content(lake.events()) and not log_batches(spark, lake.log_root, "orders")


def test_state_and_names_read_closed_days(spark, small, lake):
    for n in NAMES:
        assert n in name_log(spark, lake.log_root, "closed_test")
    close_days(spark, lake.log_root, dt.date(2024, 1, 3))
    append_events(batch_of(spark, small, 7, 1), lake.log_root, "late", 0)
    rebuild(lake, updated_at(0))
    other = Lakehouse(spark, f"{lake.root}-2", 2, lake.entities)
    for n in NAMES:
        append_events(lake.events(n).drop("run_id", "batch_id"), other.log_root, "all", 0)
    merge_new_events(other, EPOCH, updated_at(0))
    for n in NAMES:
        assert content(lake.state(n)) == content(other.state(n))
    name_log(spark, lake.log_root, "closed_test")
    assert spark.table("closed_test.orders").count() == lake.events("orders").count()
    close_days(spark, lake.log_root, dt.date(2024, 1, 9))
    name_log(spark, lake.log_root, "closed_test")
    assert spark.table("closed_test.orders").count() == lake.events("orders").count() > 0


def test_command_and_empty_log(spark, tmp_path):
    assert close_days(spark, f"{tmp_path}/none", dt.date(2024, 1, 3)) == []
    args = arguments(["close-days", "--root", f"{tmp_path}/lake", "--buckets", "2", "--before", "2024-01-03", "--checkpoint", "a", "--checkpoint", "b"])
    assert (args.before, args.checkpoint) == (dt.date(2024, 1, 3), ["a", "b"])
    run(spark, args)
