"""Tasks, files and triggers follow the size of the tables, so that what one task holds does not grow with them."""

import pytest

from tidelake.registry import queries
from tidelake.sources import shop_sample as shop
from tidelake.sources.storage import child_names


@pytest.fixture
def large(monkeypatch, spark, small):
    """The small tables, taken for ones four times as large as a lake of the least size is made for."""
    monkeypatch.setattr(queries, "BUCKET_BYTES", -(-shop.size(spark, small) // 8))
    monkeypatch.setattr(queries, "RECORD_BYTES", -(-shop.size(spark, small) // (4 * queries.RECORD_FILES)))
    return small


def test_buckets_follow_the_size(spark, small, large, monkeypatch):
    assert queries.new_lake(spark, large, "sizes").buckets == 8
    monkeypatch.undo()
    assert queries.new_lake(spark, small, "sizes").buckets == queries.SHARED_BUCKETS


def test_record_files_follow_the_size_and_triggers_do_not(spark, large):
    lake = queries.streamed(spark, large, ("orders",), refresh=False)
    records = [n for n in child_names(spark, f"{lake.root}/records") if n.endswith(".parquet")]
    assert len(records) == 4 * queries.RECORD_FILES
    for stream, most in (("ingest", 3), ("state", 3)):
        assert len([n for n in child_names(spark, f"{lake.root}/checkpoints/{stream}/commits") if n.isdigit()]) <= most


def test_sketches_and_their_check_read_events_that_are_made_once(spark, small, monkeypatch):
    made, all_changes = [], shop.all_changes
    monkeypatch.setattr(shop, "all_changes", lambda *x: made.append(x) or all_changes(*x))
    rows = queries.QUERIES["metrics_e2e_latency_sketches"](spark, small).collect()
    assert len(made) == 1 and len(rows) == 7 and all(r[k] for r in rows for k in range(1, 4))
