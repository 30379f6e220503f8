"""SimHash fingerprints of documents and the groups that close fingerprints form."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb, prod

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.common import map_batches, stored
from tidelake.llm.components import components

BITS = 64
# A bucket with more fingerprints than this is not paired up but searched through masks.
HEAVY = 1000
_WINDOW = 1 << 16


def fingerprints(docs: DataFrame, *, shingle: int = 3) -> DataFrame:
    """``doc_id``, ``row_key`` (hash of id and text) and ``fingerprint`` (64 bits as a signed long) per row.

    A-Z are lowered; words are split at ASCII white space; a bit is set where more than half of
    the shingles' 64-bit hashes (seed 42) have it. Fewer words than a shingle needs: the whole
    sequence is one; a null, empty or blank text has fingerprint zero.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("doc_id", "text").alias("row_key"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((fingerprint(x, shingle) for x in batch.column(2).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints.view(np.int64))], ["doc_id", "row_key", "fingerprint"])

    return map_batches(rows, run, "doc_id bigint, row_key bigint, fingerprint bigint")


def fingerprint(text: str | None, shingle: int = 3) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(0, len(words) - shingle)
    starts, ends = starts[: last + 1].tolist(), ends[-last - 1 :].tolist()
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(starts), _WINDOW):
        hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts[i : i + _WINDOW], ends[i : i + _WINDOW], strict=True)), ">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(starts)).tobytes(), "big")


def near_groups(prints: DataFrame, *, distance: int = 2) -> DataFrame:
    """``prints`` with ``component_id``: the smallest doc_id reachable over links of ``distance`` bits.

    Equal fingerprints are one node, so copies cost nothing; ``prints`` should be a stored table.
    A group without any doc_id has a null component_id. Also ``root``: a fingerprint of the group.
    """
    nodes = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    links = close_pairs(nodes.select("fingerprint"), distance)
    roots = components(links, "simhash-components").withColumnRenamed("node", "fingerprint")
    rooted = nodes.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fingerprint", "root", "component_id")
    return prints.join(named, "fingerprint")


def close_pairs(distinct: DataFrame, distance: int) -> DataFrame:
    """Links ``a`` < ``b`` that connect all fingerprints within ``distance`` bits of each other.

    Generalised pigeonhole: bits that vary together share a part; part i gets a threshold t(i)
    such that the t(i)+1 add up to distance+1, so a close pair is within t(i) in some part. The
    thresholds are unequal where dynamic programming over estimated candidate counts says so.
    Each fingerprint is filed under its value in every chosen part, probes all values within the
    part's threshold, and what it meets is verified. Values that more than ``HEAVY`` fingerprints
    share are left out of that join and searched through masks, which gives the same links.
    """
    layout, buckets = _layout(distinct, distance)
    filed = _keyed(distinct, [(part, mask, [0]) for part, mask, _ in layout])
    probes = _keyed(distinct, [(part, mask, flips) for part, mask, flips in layout])
    heavy = stored(buckets.where(F.col("n") > HEAVY).select("part", "key"), "simhash-heavy")
    if heavy.isEmpty():
        return _met(probes, filed, distance)
    keys = ["part", "key"]
    light = _met(probes.join(heavy, keys, "left_anti"), filed.join(heavy, keys, "left_anti"), distance)
    inside = probes.join(heavy, keys, "left_semi").select("fingerprint").distinct()
    return light.union(_masked(inside, distance))


def _met(probes: DataFrame, filed: DataFrame, distance: int) -> DataFrame:
    a, b = probes.withColumnRenamed("fingerprint", "p"), filed.withColumnRenamed("fingerprint", "q")
    met = a.join(b, ["part", "key"]).where((F.col("p") != F.col("q")) & (F.bit_count(F.col("p").bitwiseXOR(F.col("q"))) <= distance))
    return met.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()


def _masked(inside: DataFrame, distance: int) -> DataFrame:
    """Fingerprints equal outside some ``distance`` bits; at most 2**distance share such a key, so no list is long."""
    bits = list(range(BITS))
    each = inside.select("fingerprint", F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))).alias("i0"))
    chosen = ["i0"]
    for k in range(1, distance):
        each = each.withColumn(f"i{k}", F.explode(F.sequence(F.lit(0), F.lit(len(bits) - 1)))).where(F.col(f"i{k}") > F.col(f"i{k - 1}"))
        chosen.append(f"i{k}")
    mask = sum((F.expr(f"shiftleft(1L, {x})") for x in chosen[1:]), F.expr("shiftleft(1L, i0)"))
    keyed = each.withColumn("mask", mask).withColumn("key", F.col("fingerprint").bitwiseAND(F.bitwise_not("mask")))
    met = keyed.groupBy("mask", "key").agg(F.collect_list("fingerprint").alias("all")).where(F.size("all") > 1)
    return met.select(F.array_min("all").alias("a"), F.explode("all").alias("b")).where("a <> b").distinct()


def _keyed(distinct: DataFrame, parts: list[tuple[int, int, list[int]]]) -> DataFrame:
    pairs = [
        F.struct(F.lit(part).alias("part"), F.col("fingerprint").bitwiseAND(_long(mask)).bitwiseXOR(_long(flip)).alias("key"))
        for part, mask, flips in parts
        for flip in flips
    ]
    return distinct.select("fingerprint", F.explode(F.array(*pairs)).alias("x")).select("fingerprint", "x.part", "x.key")


def _long(bits: int) -> Column:
    return F.lit(bits - (1 << 64) if bits >> 63 else bits).cast("bigint")


def _layout(distinct: DataFrame, distance: int) -> tuple[list[tuple[int, int, list[int]]], DataFrame]:
    """The chosen parts (number, mask, flips to probe) and the size of every bucket of those parts."""
    total, ones, together = _bit_counts(distinct)
    layouts = {m: partition_bits(total, ones, together, m) for m in range(1, distance + 2)}
    numbered = [(m, part) for m, parts in layouts.items() for part in parts]
    masks = [sum(1 << b for b in part) for _, part in numbered]
    buckets = stored(_keyed(distinct, [(k, mask, [0]) for k, mask in enumerate(masks)]).groupBy("part", "key").agg(F.count("*").alias("n")), "simhash-buckets")
    equal = {r["part"]: float(r["pairs"] or 0) for r in buckets.groupBy("part").agg(F.sum(F.col("n").cast("double") * (F.col("n") - 1)).alias("pairs")).collect()}
    differ = [2 * (x / max(total, 1)) * (1 - x / max(total, 1)) for x in ones]
    best = None
    for m in layouts:
        own = [k for k, (of, _) in enumerate(numbered) if of == m]
        costs = [[estimate(total, equal.get(k, 0.0), [differ[b] for b in numbered[k][1]], t) for t in range(distance + 1)] for k in own]
        cost, thresholds = allocate(costs, distance + 1)
        if best is None or cost < best[0]:
            best = cost, [(k, masks[k], _flips(numbered[k][1], t)) for k, t in zip(own, thresholds, strict=True) if t >= 0]
    return best[1], buckets.where(F.col("part").isin([k for k, _, _ in best[1]]))


def _bit_counts(distinct: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """Fingerprints, how many have each bit, and how many have each two bits: 4,096 sums over all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((BITS, BITS))
        for batch in batches:
            rows = np.ascontiguousarray(batch.column(0).to_numpy()).view(np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8)
            x = np.unpackbits(rows, axis=1)[:, ::-1].astype(np.float32)
            both += x.T @ x
            n += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS * BITS + 1)), pa.array(np.append(both.ravel(), n))], ["cell", "n"])

    cells = map_batches(distinct.select("fingerprint"), run, "cell bigint, n double").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    sums = np.zeros(BITS * BITS + 1)
    for r in cells:
        sums[r["cell"]] = r["n"]
    both = sums[:-1].reshape(BITS, BITS)
    return int(sums[-1]), both.diagonal().tolist(), both


def partition_bits(total: int, ones: list[int], together: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` near-equal parts; a part grows by the bit that varies most with those it holds."""
    p = np.array(ones) / max(total, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    alike = np.abs(together / max(total, 1) - np.outer(p, p)) / np.outer(spread, spread)
    free = set(range(BITS))
    out = []
    for k in range(parts):
        size = len(free) // (parts - k)
        part = [max(free, key=lambda b: (spread[b], -b))]
        free.discard(part[0])
        while len(part) < size:
            part.append(max(free, key=lambda b: (alike[b, part].sum(), -b)))
            free.discard(part[-1])
        out.append(sorted(part))
    return out


def estimate(total: int, equal_pairs: float, differ: list[float], threshold: int) -> float:
    """Probes, and candidates: the pairs equal in the part, times how many more differ in up to ``threshold`` bits."""
    probes = total * sum(comb(len(differ), t) for t in range(threshold + 1))
    odds = [q / max(1 - q, 1e-9) for q in differ]
    grown, sums = 1.0, [1.0] + [0.0] * threshold
    for x in odds:
        for t in range(threshold, 0, -1):
            sums[t] += x * sums[t - 1]
    grown = sum(sums)
    uniform = total * total * prod(1 - q for q in differ)
    return probes + max(equal_pairs, uniform) * grown


def allocate(costs: list[list[float]], budget: int) -> tuple[float, list[int]]:
    """Thresholds of least total cost whose t+1 add up to ``budget``; -1 leaves a part out."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (so_far, chosen) in best.items():
            for t in range(-1, budget - used):
                now = so_far + (cost[t] if t >= 0 else 0.0)
                if used + t + 1 not in step or now < step[used + t + 1][0]:
                    step[used + t + 1] = now, [*chosen, t]
        best = step
    return best[budget]


def _flips(part: list[int], threshold: int) -> list[int]:
    return [sum(1 << b for b in bits) for t in range(threshold + 1) for bits in combinations(part, t)]


def hex_fingerprint(column: str) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))
