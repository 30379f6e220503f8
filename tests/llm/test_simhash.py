"""Fingerprints, close pairs and groups against plain loops."""

import random

import pytest
import xxhash

from tidelake.llm import simhash
from tidelake.llm.components import components
from tidelake.llm.queries import op9_simhash
from tidelake.llm.simhash import allocate, close_pairs, estimate, fingerprint, fingerprints, near_groups, partition_bits


def plain_print(text):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


def linked(prints, distance=2):
    return roots([(a, b) for i, a in enumerate(prints) for b in prints[i:] if (a ^ b).bit_count() <= distance])


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("text", [None, "", "  \n", "one", "One TWO", "a b c", "É b c d e", "x " * 3000, "a\x1cb c d", "k" * 9000])
def test_fingerprint(text):
    assert fingerprint(text) == plain_print(text)


def crowd(n, seed=3):
    """Random fingerprints, and a crowd of them within a few bits of one."""
    rng = random.Random(seed)
    out = {rng.getrandbits(64) for _ in range(n)} | {0}
    centre = rng.getrandbits(64)
    for _ in range(n):
        x = centre
        for b in rng.sample(range(64), rng.randint(0, 3)):
            x ^= 1 << b
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize(("heavy", "distance"), [(1000, 2), (3, 2), (3, 1), (1000, 3)])
def test_close_pairs_connect_the_same(spark, monkeypatch, heavy, distance):
    monkeypatch.setattr(simhash, "HEAVY", heavy)
    prints = crowd(150)
    got = close_pairs(spark.createDataFrame([(signed(x),) for x in prints], "fingerprint bigint"), distance).collect()
    assert all((r.a % (1 << 64) ^ r.b % (1 << 64)).bit_count() <= distance for r in got)
    want = linked(prints, distance)
    mine = roots([(x, x) for x in prints] + [(r.a % (1 << 64), r.b % (1 << 64)) for r in got])
    assert mine == want


def test_layout():
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.integers(0, 2, (500, 64)).astype(float)
    x[:, 40] = x[:, 3]  # two bits that always agree share a part
    parts = partition_bits(500, x.sum(0).tolist(), x.T @ x, 3)
    assert sorted(b for p in parts for b in p) == list(range(64))
    assert any({3, 40} <= set(p) for p in parts)
    assert allocate([[5.0, 50.0, 500.0], [1.0, 2.0, 30.0]], 3) == (7.0, [0, 1])  # unequal
    assert allocate([[500.0, 600.0, 900.0], [1.0, 2.0, 3.0]], 3) == (3.0, [-1, 2])  # one part left out
    assert estimate(10, 4.0, [0.5, 0.5], 1) > estimate(10, 4.0, [0.5, 0.5], 0)


def test_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(120)]
    frame = spark.createDataFrame([*links, *links[:5], (None, 3), (7, 7)], "a bigint, b bigint")
    got = {r.node: r.root for r in components(frame).collect()}
    assert got == {x: r for x, r in roots(links).items() if x in got}
    assert {x for a, b in links if a != b for x in (a, b)} == set(got)
    assert components(frame.limit(0)).count() == 0


def test_groups_of_documents(spark):
    base = " ".join(f"w{i}" for i in range(400))
    texts = [base, base.upper(), base, base + " tail", None, "", " ", "a b", "A B", "other words here entirely", "x " * 20000]
    frame = spark.createDataFrame([(i if i != 3 else None, t, 1, 2) for i, t in enumerate(texts)] + [(0, base, 1, 2)], "doc_id bigint, text string, fingerprint int, root int")
    rows = near_groups(fingerprints(frame)).collect()
    prints = [plain_print(t) for t in [*texts, base]]
    ids = [None if i == 3 else i for i in range(len(texts))] + [0]
    root = linked(sorted(set(prints)))
    least = {}
    for i, p in zip(ids, prints, strict=True):
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    want = sorted((str(i), p, least.get(root[p])) for i, p in zip(ids, prints, strict=True))
    assert sorted((str(r.doc_id), r.fingerprint % (1 << 64), r.component_id) for r in rows) == want
    assert near_groups(fingerprints(frame.limit(0))).count() == 0


def test_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    prints = {r.doc_id: plain_print(r.text) for r in docs}
    root = linked(sorted(set(prints.values())))
    least = {}
    for i, p in sorted(prints.items()):
        least.setdefault(root[p], i)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op9_simhash(spark, small).collect()}
    assert got == {i: (f"{p:016x}", least[root[p]]) for i, p in prints.items()}
