"""Stored state and reports: batches in any order, partitions left alone, emptied and repaired; reports by group."""

import datetime as dt
import itertools
import os

import pytest
from pyspark.sql import functions as F

from tidelake.operators import events_of, parse_records
from tidelake.plans.pipeline import Lakehouse, apply_events, rebuild
from tidelake.registry.queries import events, updated_at
from tidelake.schemas import ENTITIES
from tidelake.sources import append_events, event_log, shop_sample as shop

NOW = dt.datetime(2024, 1, 1)


@pytest.fixture
def lake(spark, tmp_path):
    return Lakehouse(spark, str(tmp_path), 2)


def batch(spark, name, *rows):
    """Staged rows of an entity from (columns, time, op)."""
    entity = ENTITIES[name]
    values = [tuple(given.get(c) for c in entity.columns) + (op, at, at, op == "d", NOW) for given, at, op in rows]
    return spark.createDataFrame(values, entity.state)


def seller(i, city, at, op, state="SP"):
    return {"seller_id": i, "seller_city": city, "seller_state": state}, at, op


def order(i, month, at, op="u", status="delivered"):
    return {"order_id": i, "status": status, "purchased_at": month and dt.datetime(2024, month, 5, 12)}, at, op


def content(table, *columns):
    return sorted((tuple(r) for r in table.read().select(*columns, "is_deleted").collect()), key=str)


def files(table):
    """Partition folders and the files in them, with their times."""
    out = {}
    for base, _, names in os.walk(table.root):
        kept = [n for n in names if n.endswith(".parquet")]
        if kept:
            out[os.path.basename(base)] = {n: os.stat(f"{base}/{n}").st_mtime_ns for n in kept}
    return out


def test_empty(lake, spark):
    table = lake.state_table("sellers")
    assert table.read().isEmpty() and table.read().schema.names == ENTITIES["sellers"].state.names and table.partitions() == set()
    assert table.merge(batch(spark, "sellers")) == (set(), None) and files(table) == {}


def test_changes_in_any_order_and_split(spark, tmp_path):
    changes = [seller("a", "one", 1, "r"), seller("a", "two", 2, "u", "RJ"), seller("b", "x", 1, "r"), seller("b", "x", 3, "d"), seller("c", "late", 5, "c", None)]
    want = [("a", "two", "RJ", False), ("b", "x", "SP", True), ("c", "late", None, False)]
    for k, turn in enumerate(itertools.islice(itertools.permutations(changes), 0, 120, 40)):
        table = Lakehouse(spark, f"{tmp_path}/{k}", 2).state_table("sellers")
        for change in turn:
            table.merge(batch(spark, "sellers", change))
        assert content(table, "seller_id", "seller_city", "seller_state") == want
        before = files(table)
        table.merge(batch(spark, "sellers", turn[0]))  # repeated: rewritten with the same rows
        assert content(table, "seller_id", "seller_city", "seller_state") == want and set(files(table)) == set(before)


def test_rows_move_between_months_and_other_months_keep_their_files(spark, lake):
    table = lake.state_table("orders")
    touched, _ = table.merge(batch(spark, "orders", *[order(str(i), 1 + i % 4, 1, "r") for i in range(40)], order("none", None, 1, "r")))
    assert touched == table.partitions() == {dt.date(2024, m, 1) for m in (1, 2, 3, 4)} | {None}
    before = files(table)
    touched, _ = table.merge(batch(spark, "orders", order("1", 3, 2), order("none", 3, 2), order("2", 3, 0)))  # the last is late
    assert touched == {dt.date(2024, 2, 1), dt.date(2024, 3, 1), None}
    after = files(table)
    kept = {f"purchased_at_month=2024-{m:02d}-01" for m in (1, 4)}
    assert all(before[f] == after[f] for f in kept) and "__HIVE_DEFAULT_PARTITION__" not in str(list(after))
    got = {r.order_id: r.purchased_at and r.purchased_at.month for r in table.read().collect()}
    assert len(got) == table.read().count() == 41 and (got["1"], got["none"], got["2"]) == (3, 3, 3)
    folder = table.whole().select("purchased_at", F.col("purchased_at_month").alias("m")).collect()
    assert all(r.m == r.purchased_at.date().replace(day=1) for r in folder)


def test_a_moved_rows_commit_that_broke_off_is_repaired(spark, lake):
    """The new month was written and the old one was not: the batch, repeated, leaves one row."""
    table = lake.state_table("orders")
    table.merge(batch(spark, "orders", order("1", 1, 1, "r"), order("2", 1, 1, "r")))
    moved = batch(spark, "orders", order("1", 2, 2))
    table.overwrite(table.placed(moved))
    assert table.read().count() == 3
    table.merge(moved)
    assert content(table, "order_id", "purchased_at") == [("1", dt.datetime(2024, 2, 5, 12), False), ("2", dt.datetime(2024, 1, 5, 12), False)]


def test_texts_that_folders_cannot_hold_come_back(spark, lake):
    table = lake.state_table("sellers")
    states = ["", None, "-", "a/b=c", "100%", "é'\\", "__HIVE_DEFAULT_PARTITION__x"]
    table.merge(batch(spark, "sellers", *[seller(str(i), "c", 1, "r", s) for i, s in enumerate(states)]))
    table.merge(batch(spark, "sellers", *[seller(str(i), "d", 2, "u", s) for i, s in enumerate(states) if i % 2]))
    assert {r.seller_id: r.seller_state for r in table.read().collect()} == {str(i): s for i, s in enumerate(states)}
    table.merge(batch(spark, "sellers", *[seller(str(i), "e", 3, "u", "all") for i in range(len(states))]))
    assert table.partitions() == {"all"} and table.read().count() == len(states)


def test_rules_of_the_merge_reach_stored_tables(spark, lake):
    table = lake.state_table("sellers")
    table.merge(batch(spark, "sellers", seller("a", "new", 5, "u"), seller("b", "kept", 5, "u")))
    table.merge(batch(spark, "sellers", seller("a", "old", 1, "u"), seller("b", "image", 6, "d")), late_guard=False, delete_keeps_target=True)
    assert content(table, "seller_id", "seller_city") == [("a", "old", False), ("b", "kept", True)]


def test_what_a_batch_changed_is_kept_on_demand(spark, lake):
    table = lake.state_table("orders")
    table.merge(batch(spark, "orders", order("1", 1, 1, "r"), order("2", 1, 1, "r"), order("3", 2, 1, "r")))
    _, changes = table.merge(batch(spark, "orders", order("1", 3, 2), order("9", 2, 2)), keep=True)
    assert [(r.order_id, r.purchased_at.month) for r in changes.before.collect()] == [("1", 1)]
    assert sorted((r.order_id, r.purchased_at.month) for r in changes.after.collect()) == [("1", 3), ("9", 2)]


def test_the_first_number_of_buckets_stays(spark, tmp_path):
    assert Lakehouse(spark, str(tmp_path), 4).buckets == Lakehouse(spark, str(tmp_path), 16).buckets == 4


def test_rebuild_keeps_what_comes_meanwhile(spark, small, lake, monkeypatch):
    """A batch appended and merged after the log was listed is in the rebuilt table."""
    rows = events(spark, small, "sellers").where("_cdc_op = 'r'")
    half = F.pmod(F.hash("_cdc_offset"), F.lit(2)) == 0
    append_events(rows.where(half), lake.log_root, "one", 0)
    apply_events(lake, "sellers", lake.events("sellers"))
    seen, real = [], event_log.log_batches

    def listing(*given):
        found = real(*given)
        if not seen:
            append_events(rows.where(~half), lake.log_root, "two", 0)
            apply_events(lake, "sellers", lake.events("sellers"))
        seen.append(found)
        return found

    monkeypatch.setattr("tidelake.plans.pipeline.log_batches", listing)
    rebuild(lake, names=("sellers",))
    assert len(seen[0]) == 1 and len(seen) == 3
    assert lake.state("sellers").count() == rows.count() > rows.where(half).count() > 0


def test_rebuild_drops_what_the_log_does_not_have(spark, small, lake):
    append_events(events(spark, small, "sellers"), lake.log_root, "one", 0)
    lake.state_table("sellers").merge(batch(spark, "sellers", seller("stray", "x", 1, "r", "nowhere")))
    rebuild(lake, names=("sellers",))
    assert "stray" not in {r.seller_id for r in lake.state("sellers").collect()} and "nowhere" not in lake.state_table("sellers").partitions()


def test_reports_are_replaced_whole_or_by_group(spark, lake):
    from tidelake.schemas import GOLD

    table = lake.report_table("order_funnel")
    assert table.read().isEmpty()

    def rows(*weeks):
        return spark.createDataFrame([(dt.datetime(2024, m, d), n, *[0] * 5, 0.0) for m, d, n in weeks], GOLD["order_funnel"])

    def counts():
        return sorted((r.order_week.month, r.order_week.day, r.total_created) for r in table.read().collect())

    table.publish(rows((1, 1, 1), (2, 5, 2)))
    table.publish(rows((1, 1, 3), (1, 8, 4), (3, 4, 5)))
    assert counts() == [(1, 1, 3), (1, 8, 4), (3, 4, 5)] and len(table.partitions()) == 2
    before = files(table)
    gone = spark.createDataFrame([(dt.datetime(2024, 1, 8),), (dt.datetime(2024, 2, 5),)], "order_week timestamp_ntz")
    assert table.replace_groups(gone, rows((2, 5, 6))) == {dt.date(2024, 1, 1), dt.date(2024, 2, 1)}
    assert counts() == [(1, 1, 3), (2, 5, 6), (3, 4, 5)]
    assert files(table)["order_week_month=2024-03-01"] == before["order_week_month=2024-03-01"]
    table.replace_groups(spark.createDataFrame([(dt.datetime(2024, 3, 4),)], "order_week timestamp_ntz"), rows())
    assert counts() == [(1, 1, 3), (2, 5, 6)] and dt.date(2024, 3, 1) not in table.partitions()


def test_state_as_of_a_time_starts_from_the_nearest_kept_one(spark, small, tmp_path):
    """Equal to the whole replay, at kept moments, between them and before the first; only the tail of the log is read."""
    lake = Lakehouse(spark, str(tmp_path), 2, {"orders": ENTITIES["orders"]})
    for day in (1, 2, 3):
        records = shop.changes(spark, small, "orders").where(F.col("batch") == day)
        arrived = F.timestamp_seconds(F.lit(1_704_067_200 + 86_400 * day + 3600))
        append_events(events_of(parse_records(records, arrived)), lake.log_root, "run", day)
    moments = [dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 2, 5), dt.datetime(2024, 1, 3, 0, 30), dt.datetime(2024, 1, 3, 5), dt.datetime(2024, 1, 5)]

    def rows(moment, **how):
        return sorted(map(str, lake.state_as_of("orders", moment, updated_at(0), **how).collect()))

    replayed = [rows(m) for m in moments]
    assert not replayed[0] and replayed[1] == replayed[2] and replayed[2] != replayed[3] != replayed[4]
    for moment in (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 4, 0, 0, 0, 5, dt.timezone.utc)):
        lake.keep_state("orders", moment, updated_at(0))
    assert [rows(m) for m in moments] == replayed and [rows(m, whole=True) for m in moments] == replayed

    def days(moment):
        return {f.split("ingest_date=")[1][:10] for f in lake.state_as_of("orders", moment).inputFiles() if "ingest_date=" in f}

    assert "2024-01-02" in days(moments[1]) and "2024-01-02" not in days(moments[3])
    assert days(moments[4]) == {"2024-01-04"}
