"""Targets against the rule step by step, rates against the dual's conditions, copies against their bounds."""

import re
from collections import defaultdict

import numpy as np
import pytest

from tidelake.llm import mixing
from tidelake.llm.mixing import mix, source_targets, whole_copies
from tidelake.llm.queries import op11_mixing

SCHEMA = "doc_id bigint, text string, source string, size string, target int, copies string"


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    """Share by weight, cut at the cap, share the excess again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, rest, free = dict.fromkeys(order, 0.0), share * sum(sizes.values()), set(order)
    while free and rest > 1e-9:
        unit = rest / sum(weight[s] for s in free)
        rest = 0.0
        for s in list(free):
            target[s] += unit * weight[s]
        for s in list(free):
            if target[s] >= cap * sizes[s]:
                rest += target[s] - cap * sizes[s]
                target[s] = cap * sizes[s]
                free.remove(s)
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100, None: 5}, {"a": 1, "b": 1000, "é": 10, "z": 0, "𝒳": 7, "": 3}, {"only": 12}, {"a": 0, None: 0}, {f"s{i:02d}": i * i for i in range(40)},
])
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in source_targets(frame).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def check(got, docs):
    """Sizes, targets, bounds, nearness and the dual's conditions."""
    sizes = defaultdict(int)
    for _, text, source in docs:
        sizes[source] += words(text)
    target = plain_targets(sizes)
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(i), words(t)) for i, t, _ in docs)
    by_source = defaultdict(list)
    for r in got:
        assert 0 <= r.copies <= 2 and r.taken == r.copies * r.size and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source])
        by_source[r.source].append(r)
    for source, rows in by_source.items():
        few = sorted({r.size for r in rows if r.size})
        # The long document of b leaves a gap that whole copies of the others cannot fill.
        assert abs(sum(r.taken for r in rows) - target[source]) <= (few[0] if few else 0) + 1 or (source == "b" and all(r.copies == (2 if r.size < 9000 else 1) for r in rows if r.size))
        assert sum(r.rate * r.size for r in rows) == pytest.approx(target[source], rel=1e-8)
        free = [(r.size, np.log(r.rate / 1.5)) for r in rows if r.size and r.rate < 2]
        if free:  # one multiplier serves all documents below the cap
            slopes = [y / x for x, y in free]
            assert max(slopes) - min(slopes) <= 1e-9 + 1e-9 * max(map(abs, slopes))
            assert all(1.5 * np.exp(slopes[0] * r.size) >= 2 - 1e-9 for r in rows if r.size and r.rate == 2)


def test_query(spark, small):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "source").collect()]
    got = op11_mixing(spark, small)
    assert got.columns[:5] == ["doc_id", "size", "source_size", "target", "taken"]
    source = {i: s for i, _, s in docs}
    totals, sizes = defaultdict(int), defaultdict(int)
    for r in got.collect():
        totals[source[r.doc_id]] += r.taken
        sizes[source[r.doc_id]] += r.size
    want = plain_targets(sizes)
    assert all(abs(totals[s] - want[s]) <= 0.005 * want[s] for s in want)


@pytest.mark.parametrize("bucket_rows", [16_384, 3])
def test_mix(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket_rows)
    rng = np.random.default_rng(4)
    docs = [(i, " ".join(["w"] * int(n)), s) for i, (n, s) in enumerate(zip(rng.integers(1, 60, 500), rng.choice(["a", "b", "b", "b", "c", ""], 500), strict=True))]
    docs += [(None, "one two", None), (1, None, None), (2, "", "a"), (3, "x " * 50_000, "b"), (4, " \n", "empty")]
    docs += [(7, "all alike", "d")] * 90 + [(8, "q", "d")] * 5 + [(9, "single", "e")]
    frame = spark.createDataFrame([(*d, "s", 1, "c") for d in docs], SCHEMA)
    got = mix(frame.repartition(6)).collect()
    check(got, docs)
    again = mix(frame.repartition(2)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mix(frame.limit(0)).collect() == []
    assert [r.taken for r in mix(frame.where("doc_id = 1 AND text IS NULL")).collect()] == [0]


def test_whole_copies():
    size, n = np.array([0, 1, 5, 90]), np.array([3, 2, 4, 1])
    total = whole_copies(size, n, np.array([0.0, 0.3, 1.2, 0.5]), 70.0, 2)
    assert (total >= 0).all() and (total <= 2 * n).all() and abs((total * size).sum() - 70) <= 26
    assert whole_copies(size, n, np.array([0.0, 2, 2, 2]), 224.0, 2).tolist() == [0, 4, 8, 2]


def test_copies_where_none_can_be_added_or_left_out():
    assert whole_copies(np.array([10]), np.array([1]), np.array([2.0]), 25.0, 2).tolist() == [2]
    assert whole_copies(np.array([10]), np.array([1]), np.array([0.1]), 1.0, 2).tolist() == [0]
    rng = np.random.default_rng(6)
    for _ in range(300):
        size = np.unique(rng.integers(0, 40, rng.integers(1, 6)))
        n = rng.integers(1, 4, len(size))
        rate = rng.random(len(size)) * 2
        total = whole_copies(size, n, rate, float((size * n * rate).sum()), 2)
        assert (total >= 0).all() and (total <= 2 * n).all() and abs((total * size).sum() - (size * n * rate).sum()) <= size.max() / 2 + 1
