"""Streams: several triggers, restart, failure, checkpoint reset; always the batch result."""

import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F, types as T

from tidelake.operators.envelope import MALFORMED
from tidelake.plans.pipeline import EPOCH, Lakehouse, merge_new_events, rebuild
from tidelake.registry.queries import updated_at
from tidelake.schemas import ENTITIES, EVENT, EVENT_FOLDERS, RECORD
from tidelake.sources import shop_sample as shop
from tidelake.sources.files import read_record_files
from tidelake.sources.event_log import append_events, stream_events
from tidelake.streaming import ingest, start_histogram, start_ingest, start_state, state
from tidelake.streaming.ingest import DRAIN

NAMES = ("orders", "customers", "sellers")
FEW = {n: ENTITIES[n] for n in NAMES}


@pytest.fixture(scope="module")
def record_files(spark, small, tmp_path_factory):
    folder = f"{tmp_path_factory.mktemp('records')}/in"
    shop.all_changes(spark, small, NAMES).drop("batch").repartition(4).write.parquet(folder)
    return folder


def take_in(spark, files, lake, checkpoint, max_files=1):
    query = start_ingest(read_record_files(spark, files, max_files), lake.log_root, checkpoint, DRAIN, F.col("timestamp"))
    query.awaitTermination()
    return query


def advance(lake, checkpoint, max_files=2, **options):
    start_state(lake, checkpoint, DRAIN, max_files, updated_at(0), **{"refresh": False, **options}).awaitTermination()


def expected(spark, small, name):
    columns = [*ENTITIES[name].columns, "is_deleted"]
    return sorted(map(str, shop.current(spark, small, name).select(columns).collect()))


def actual(lake, name):
    return sorted(map(str, lake.state(name).select(*ENTITIES[name].columns, "is_deleted").collect()))


def test_ingest_in_triggers_measures_and_restarts(spark, small, record_files, tmp_path):
    lake = Lakehouse(spark, str(tmp_path), 2, FEW)
    query = take_in(spark, record_files, lake, f"{tmp_path}/cp")
    seen = [p.observedMetrics["ingest"] for p in query.recentProgress if p.numInputRows]
    assert len(seen) == 4
    total = spark.read.parquet(record_files).count()
    assert sum(m.records for m in seen) == total
    assert sum(m.tombstones for m in seen) == shop.mapped(spark, small, "orders").filter("m % 97 = 0").count()
    assert sum(m.malformed for m in seen) == shop.mapped(spark, small, "orders").filter("m % 500 = 0").count()
    logged = lake.events().count()
    assert logged == total - sum(m.tombstones for m in seen)
    assert lake.events(MALFORMED).count() == sum(m.malformed for m in seen)
    assert lake.events().where("_cdc_op IS NOT NULL").count() == sum(m[f"{n}_records"] for m in seen for n in NAMES)
    take_in(spark, record_files, lake, f"{tmp_path}/cp")  # nothing new
    assert lake.events().count() == logged
    assert lake.events().select("run_id").distinct().count() == 1 and lake.events().select("batch_id").distinct().count() == 4


def test_a_batch_that_fails_after_writing_is_not_written_twice(spark, record_files, tmp_path, monkeypatch):
    lake, real, calls = Lakehouse(spark, str(tmp_path), 2, FEW), ingest.append_events, []

    def failing(events, root, run_id, batch_id):
        real(events, root, run_id, batch_id)
        calls.append(batch_id)
        if calls == [0, 1]:
            raise RuntimeError("lost after the write")

    monkeypatch.setattr(ingest, "append_events", failing)
    with pytest.raises(StreamingQueryException):
        take_in(spark, record_files, lake, f"{tmp_path}/cp")
    take_in(spark, record_files, lake, f"{tmp_path}/cp")
    assert calls == [0, 1, 1, 2, 3]
    once = Lakehouse(spark, f"{tmp_path}/once", 2, FEW)
    take_in(spark, record_files, once, f"{tmp_path}/once-cp", max_files=10)
    assert lake.events().count() == once.events().count()


def test_default_ingestion_time_survives_a_repeat(spark, record_files, tmp_path, monkeypatch):
    """The clock of a repeated batch is the one of its first attempt, so it lands in the same folders."""
    real, failed = ingest.append_events, []
    lake = Lakehouse(spark, str(tmp_path), 2, FEW)

    def failing(events, root, run_id, batch_id):
        real(events, root, run_id, batch_id)
        if not failed:
            failed.append(events.agg(F.min("_cdc_ingested_at")).first()[0])
            raise RuntimeError("lost")

    monkeypatch.setattr(ingest, "append_events", failing)
    start = lambda: start_ingest(read_record_files(spark, record_files), lake.log_root, f"{tmp_path}/cp", DRAIN)
    with pytest.raises(StreamingQueryException):
        start().awaitTermination()
    start().awaitTermination()
    assert [r[0] for r in lake.events().select("_cdc_ingested_at").distinct().collect()] == failed


def test_state_stream_equals_batch_and_rebuild(spark, small, record_files, tmp_path, monkeypatch):
    lake = Lakehouse(spark, str(tmp_path), 2, FEW)
    take_in(spark, record_files, lake, f"{tmp_path}/cp", 2)
    # The run is lost after the tables of its second batch were published, before it was recorded.
    real, calls = state.side_by_side, []

    def failing(*given):
        done = real(*given)
        calls.append(done)
        if len(calls) == 2:
            raise RuntimeError("lost after publishing")
        return done

    monkeypatch.setattr(state, "side_by_side", failing)
    with pytest.raises(StreamingQueryException):
        advance(lake, f"{tmp_path}/cp-state")
    advance(lake, f"{tmp_path}/cp-state")  # the batch comes a second time
    for name in NAMES:
        assert actual(lake, name) == expected(spark, small, name)
    done = len(calls)
    advance(lake, f"{tmp_path}/cp-state")  # no new files, no batch
    assert len(calls) == done
    monkeypatch.undo()
    # Ingested again from the start: the log has everything twice, current state does not change.
    before = {n: actual(lake, n) for n in NAMES}
    events = lake.events().count()
    take_in(spark, record_files, lake, f"{tmp_path}/cp-reset", 4)
    assert lake.events().count() == 2 * events
    advance(lake, f"{tmp_path}/cp-state", max_files=20)
    assert {n: actual(lake, n) for n in NAMES} == before
    batch = Lakehouse(spark, f"{tmp_path}/batch", 2, FEW)
    take_in(spark, record_files, batch, f"{tmp_path}/cp-batch", 4)
    merge_new_events(batch, EPOCH, updated_at(0))
    assert {n: actual(batch, n) for n in NAMES} == before
    rebuild(batch, updated_at(0))
    assert {n: actual(batch, n) for n in NAMES} == before


def test_reports_follow_the_tables_they_read(spark, small, tmp_path):
    lake = Lakehouse(spark, str(tmp_path), 2)
    folder = f"{tmp_path}/in"
    shop.all_changes(spark, small).drop("batch").coalesce(2).write.parquet(folder)
    take_in(spark, folder, lake, f"{tmp_path}/cp", 10)
    advance(lake, f"{tmp_path}/cp-state", max_files=50, refresh=True)
    from tidelake.plans import gold

    for name, model in gold.MODELS.items():
        fresh = model(shop.current_tables(spark, small))
        stored = lake.reports()[name]
        assert stored.schema.names == fresh.schema.names
        assert sorted(map(str, stored.collect())) == sorted(map(str, fresh.collect()))
    before = {n: lake.report_table(n)._files() for n in gold.MODELS}
    shop.changes(spark, small, "customers").drop("batch").coalesce(1).write.mode("append").parquet(folder)
    take_in(spark, folder, lake, f"{tmp_path}/cp", 10)
    advance(lake, f"{tmp_path}/cp-state", max_files=50, refresh=True)
    assert [n for n in gold.MODELS if lake.report_table(n)._files() != before[n]] == ["review_sentiment_by_state"]


def test_files_of_any_age_are_read(spark, small, tmp_path):
    """A restored or copied file may be much older than the newest one the stream has seen."""
    import os

    lake = Lakehouse(spark, str(tmp_path), 2, FEW)
    files = f"{tmp_path}/in"
    shop.all_changes(spark, small, ("sellers",)).drop("batch").repartition(2).write.parquet(files)
    parts = sorted(f"{files}/{n}" for n in os.listdir(files) if n.endswith(".parquet"))
    long_ago = time.time() - 90 * 86400
    os.utime(parts[1], (long_ago, long_ago))
    take_in(spark, files, lake, f"{tmp_path}/cp")
    logged = [os.path.join(d, n) for d, _, names in os.walk(lake.log_root) for n in names if n.endswith(".parquet")]
    assert len(logged) > 1
    for path in logged[1:]:
        os.utime(path, (long_ago, long_ago))
    advance(lake, f"{tmp_path}/cs", max_files=1)
    assert actual(lake, "sellers") == expected(spark, small, "sellers")


def record(offset, value="not json", partition=0):
    return (None, value.encode(), "shop.public.orders", partition, offset, datetime(2020, 1, 1), 0)


def deliver(spark, folder, rows):
    spark.createDataFrame(rows, RECORD).coalesce(1).write.mode("append").parquet(folder)


def take_once(spark, files, lake, within):
    query = start_ingest(read_record_files(spark, files), lake.log_root, f"{lake.root}/cp", DRAIN, drop_repeats=within)
    query.awaitTermination()
    return [p.stateOperators[0] for p in query.recentProgress]


def test_repeated_records_are_dropped_and_odd_ones_kept(spark, tmp_path):
    """Also across runs and however old the record's own time; without a whole position nothing is a repeat."""
    lake, files = Lakehouse(spark, str(tmp_path), 2, FEW), f"{tmp_path}/in"
    deliver(spark, files, [record(1), record(1), record(2), record(1, partition=1), record(None), record(None)])
    take_once(spark, files, lake, "1 hour")
    assert lake.events(MALFORMED).count() == 5
    deliver(spark, files, [record(1), record(2), record(3), record(None)])
    states = take_once(spark, files, lake, "1 hour")
    assert any(name.startswith("rocksdb") for name in states[-1].customMetrics)
    assert lake.events(MALFORMED).count() == 7
    assert sum(s.numRowsDroppedByWatermark for s in states) == 0


def test_positions_leave_the_state_in_time(spark, tmp_path):
    lake, files = Lakehouse(spark, str(tmp_path), 2, FEW), f"{tmp_path}/in"
    deliver(spark, files, [record(n) for n in range(50)])
    take_once(spark, files, lake, "1 second")
    for n in (100, 101):
        time.sleep(2)
        deliver(spark, files, [record(n)])
        states = take_once(spark, files, lake, "1 second")
    assert states[-1].numRowsTotal <= 2  # of 52 positions
    assert lake.events(MALFORMED).count() == 52


def test_histogram_stream_closes_stretches_and_counts_what_is_too_late(spark, tmp_path):
    lake, out = Lakehouse(spark, str(tmp_path), 2, FEW), f"{tmp_path}/histogram"
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)

    def arrive(run, *seconds, op="c"):
        rows = [(op, int(start.timestamp() * 1000) - 1000, 0, start + timedelta(seconds=s), "t", 0, s, None, None, "orders", start.date()) for s in seconds]
        schema = T.StructType([*EVENT.fields, *EVENT_FOLDERS.fields[:2]])
        append_events(spark.createDataFrame(rows, schema), lake.log_root, run, 0)
        query = start_histogram(stream_events(spark, lake.log_root), out, f"{tmp_path}/cp", DRAIN, "10 seconds", "20 seconds")
        query.awaitTermination()
        found = spark.read.schema("window_start timestamp_ntz, le string, n bigint").parquet(out)
        return sum(p.stateOperators[0].numRowsDroppedByWatermark for p in query.recentProgress), {(r[0].second, r[1]): r[2] for r in found.collect()}

    assert arrive("a", 1, 2, 9, 15, 35) == (0, {(0, "5"): 2, (0, "10"): 1})  # closed up to 15
    late, found = arrive("b", 3, 16)  # beyond the watermark, and inside it
    assert late == 1 and found == {(0, "5"): 2, (0, "10"): 1}
    assert arrive("c", 55)[1] == {(0, "5"): 2, (0, "10"): 1, (10, "25"): 2}
    assert arrive("d", 56, op=None)[1] == {(0, "5"): 2, (0, "10"): 1, (10, "25"): 2}  # no event
