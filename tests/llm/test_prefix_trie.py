"""The trie against plain loops: shards of any size, odd rows, and parentheses on their own."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tidelake.llm.prefix_trie import find_close, prefix_trie, range_minima, turn_sequences
from tidelake.llm.queries import op13_prefix_trie, spliced

SCHEMA = "conv_id bigint, turn bigint, role string, text string, path string, n bigint, id string"


def told(rows):
    """Turns (role, text) of each conversation in order."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            out[conv].append((turn is not None, turn or 0, key, role, text))
    return {c: [x[3:] for x in sorted(turns)] for c, turns in out.items()}


def rebuilt(turns):
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = turns.get(c - c % 5, [])[:h] + own[h:]
    return out


def plain(turns):
    """Rows of the trie by loops over all prefixes."""
    members = defaultdict(list)
    for c, own in turns.items():
        for d in range(len(own) + 1):
            members[tuple(own[:d])].append(c)
    rows = {}
    for p in sorted(members, key=len, reverse=True):
        below = [q for q in members if len(q) == len(p) + 1 and q[:-1] == p]
        saved = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        ends = sorted(c for c in members[p] if len(turns[c]) == len(p))
        rows[p] = (
            min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(below),
            sum(rows[q][5] for q in below) or 1, saved + sum(rows[q][6] for q in below), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        )
    return sorted(rows.values(), key=str)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_query_equals_loops(spark, small):
    table = spark.read.parquet(f"{small}/conversations.parquet").collect()
    assert rows_of(op13_prefix_trie(spark, small)) == plain(rebuilt(told([tuple(r) for r in table])))


@pytest.mark.parametrize("shard_turns", [1, 5, 40, 10_000])
def test_shards_merge(spark, shard_turns):
    """Branches at every depth, one prefix of a third of all, long copies: the same trie from any number of shards."""
    rng = np.random.default_rng(3)
    rows = []
    for c in range(160):
        n = int(rng.integers(0, 9)) + 1
        say = rng.integers(0, 2 if c % 3 else 1, n)
        rows += [(c, t, "user" if t % 2 else None, f"é{x}" * int(x + 1)) for t, x in enumerate(say)]
    rows += [(900 + k, t, "r", "deep") for k in range(3) for t in range(60 + k)]
    frame = spark.createDataFrame([(*r, "p", 1, "i") for r in rows], SCHEMA).repartition(5)
    got = rows_of(prefix_trie(turn_sequences(frame), shard_turns=shard_turns))
    assert got == plain(told(rows))


def test_odd_rows(spark):
    rows = [
        (None, 0, "u", "lost"), (5, None, None, None), (5, 1, "", ""), (5, 1, "", ""), (6, 0, "u", "x" * 200_000), (7, 2, "a", "b"), (7, 2, "a", "a"),
        (8, 0, "ab", "c"), (9, 0, "a", "bc"), (-1, 0, "u", "x" * 200_000), (10, 0, "u", "one"),
        *[(c, 0, "u", "no base") for c in (21, 22, 23)],
    ]
    frame = spark.createDataFrame([(*r, "p", 1, "i") for r in rows], SCHEMA)
    assert rows_of(prefix_trie(turn_sequences(frame))) == plain(told(rows))
    got = {r.conv_id: len(r.turns) for r in spliced(turn_sequences(frame)).collect()}
    assert got == {c: len(x) for c, x in rebuilt(told(rows)).items()} and 0 in got.values()
    assert rows_of(prefix_trie(spliced(turn_sequences(frame)))) == plain(rebuilt(told(rows)))
    assert rows_of(prefix_trie(turn_sequences(frame.limit(0)))) == []


@pytest.mark.parametrize("shape", ["deep", "wide", "random"])
def test_closing_parentheses(shape):
    rng = np.random.default_rng(1)
    if shape == "deep":
        bits = [True] * 5000 + [False] * 5000
    elif shape == "wide":
        bits = [True] + [True, False] * 4000 + [False]
    else:
        bits, depth = [True], 1
        while depth:
            up = rng.random() < (0.5 if len(bits) < 9000 else 0)
            bits.append(bool(up))
            depth += 1 if up else -1
            if not depth and len(bits) < 9000:
                bits[-1], depth = True, 2
    stack, want = [], {}
    for i, b in enumerate(bits):
        if b:
            stack.append(i)
        else:
            want[stack.pop()] = i
    bits = np.array(bits)
    assert find_close(bits).tolist() == [want[i] for i in np.flatnonzero(bits)]


def test_range_minima():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 1000, 300)
    begin = rng.integers(0, 299, 500)
    end = begin + 1 + (rng.random(500) * (300 - begin - 1)).astype(int)
    assert range_minima(values, begin, end).tolist() == [values[a:b].min() for a, b in zip(begin, end, strict=True)]
