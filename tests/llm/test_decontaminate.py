"""Containment search against sets of word tuples."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tidelake.llm.decontaminate import Items, contaminated, without_contaminated
from tidelake.llm.queries import op3_decontamination

DOC = "doc_id bigint, text string, item_id int, containment string"


def shingles(text, size=5):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    size = min(size, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def plain(docs, items):
    out = set()
    for item, text in items:
        if own := shingles(text):
            size = len(next(iter(own)))
            for doc, t in docs:
                words = shingles(t, size) if len(shingles(t, 1)) else set()
                share = Fraction(len(own & words), len(own))
                if share >= Fraction(4, 5):
                    out.add((doc, item, round(float(share), 9)))
    return out


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(4)

    def prose(n):
        return [f"w{rng.randint(0, 3000)}" for _ in range(n)]

    items = [(i, " ".join(prose(n))) for i, n in enumerate((4, 5, 6, 15, 37, 59, 200))]
    docs = []
    for item, text in items:
        words = text.split()
        for edits in range(4):
            inside = list(words)
            for k in range(edits):
                inside[len(words) * k // max(edits, 1)] = "changed"
            docs.append(" ".join(prose(300) + inside + prose(3000)).upper())
    docs += [None, "", " ", items[0][1], items[3][1] + " " + items[4][1], " ".join(prose(20000)), "short text"]
    return list(enumerate(docs)), [*items, (98, None), (99, " "), (4, items[4][1])]


def test_containment(spark, cases):
    docs, items = cases
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], DOC).repartition(3)
    bench = spark.createDataFrame([(i, t, 7) for i, t in items], "item_id bigint, text string, doc_id int")
    want = plain(docs, items)
    assert len(want) > 12
    for block in (16 << 20, 300):
        rows = contaminated(frame, bench, block_bytes=block).collect()
        assert {(r.doc_id, r.item_id, round(r.containment, 9)) for r in rows} == want
        assert len(rows) == len(want) + sum(item == 4 for _, item, _ in want)  # the repeated item
    kept = without_contaminated(frame, bench, block_bytes=300)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - {d for d, *_ in want}


def test_sketch_misses_nothing():
    rng = random.Random(1)
    for n in (5, 12, 30, 55):
        words = [f"x{i}" for i in range(n)]
        items = Items([(1, " ".join(words))], Fraction(4, 5))
        for _ in range(40):
            cut = list(words)
            for _ in range(rng.randint(0, max(1, n // 20))):
                cut[rng.randrange(n)] = "other"
            text = " ".join(["a", "b"] * 50 + cut)
            assert {(1, i) for i, _ in items.contained(text, {})} == {(d, i) for d, i, _ in plain([(1, text)], [(1, " ".join(words))])}


def test_empty_tables_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b c d e f g"), (1, "z")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(5, "a b c d e f g")], "item_id bigint, text string")
    assert [tuple(r) for r in contaminated(docs, bench).collect()] == [(None, 5, 1.0)]
    assert contaminated(docs.limit(0), bench).count() == contaminated(docs, bench.limit(0)).count() == 0
    assert without_contaminated(docs, bench.limit(0)).count() == 2


def test_query(spark, small):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    got = op3_decontamination(spark, small).select("doc_id", "item_id", F.round("containment", 9)).collect()
    assert {tuple(r) for r in got} == plain(docs, items)
