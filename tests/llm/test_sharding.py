"""The law of even counts, slots, and how many linked documents stay together."""

import zlib
from collections import Counter, defaultdict

import pytest

from tidelake.llm import sharding
from tidelake.llm.queries import op5_sharding
from tidelake.llm.sharding import quotas, shard

SCHEMA = "doc_id bigint, text string, shard int, size string, members int"


def lawful(rows, shards):
    counts = Counter(r.shard for r in rows)
    assert set(counts) <= set(range(shards))
    sizes = [counts[k] for k in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def cut_share(rows):
    """Links from each copy to the next that cross shards, in the best order of a group."""
    groups = defaultdict(Counter)
    for r in rows:
        groups[r.size, r.text_crc32][r.shard] += 1
    links = sum(sum(c.values()) - 1 for c in groups.values())
    return sum(sum(c.values()) - max(c.values()) for c in groups.values()) / max(links, 1)


@pytest.mark.parametrize("bucket_rows", [20_000, 7])
def test_shards(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", bucket_rows)
    texts = [f"lone {i}" for i in range(600)] + [f"pair {i % 60}" for i in range(120)] + [f"ten {i % 6}" for i in range(60)] + [None, "", "é" * 40_000]
    rows = [(None if i == 5 else i, t, 1, "x", 2) for i, t in enumerate(texts)] + [(7, "lone 7", 1, "x", 2)] * 3
    got = shard(spark.createDataFrame(rows, SCHEMA).repartition(5), 8).collect()
    lawful(got, 8)
    want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == want
    assert cut_share(got) < 0.1  # by hash alone it is 0.8


def test_a_group_larger_than_shards(spark):
    rows = [(i, "same" if i < 400 else f"t{i}") for i in range(1000)]
    got = shard(spark.createDataFrame(rows, "doc_id bigint, text string"), 8).collect()
    lawful(got, 8)
    assert max(Counter(r.shard for r in got if r.size == 5).values()) > 100  # one shard is filled with it


@pytest.mark.parametrize("n", [0, 1, 3, 8, 9])
def test_few_rows(spark, n):
    got = shard(spark.createDataFrame([(i, "a") for i in range(n)], "doc_id bigint, text string"), 8).collect()
    assert len(got) == n
    lawful(got, 8)


def test_quotas():
    full = {(0, 0): 8, (1, 1): 8, (0, 1): 2, (1, 0): 2}
    assert quotas(full, 10, 2) == {(0, 1): 1.0, (1, 0): 1.0}  # swaps need no room
    assert quotas({(0, 0): 8, (0, 1): 2, (1, 1): 10}, 10, 2) == {(0, 1): 0.0}  # no room
    assert quotas({(0, 0): 8, (0, 1): 2, (1, 1): 9}, 10, 2) == {(0, 1): 0.5}  # room for one


def test_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = op5_sharding(spark, small).collect()
    lawful(got, 8)
    assert len(got) == docs.count() and {r.law for r in got} == {"rows"}
    assert cut_share(got) < 0.3
