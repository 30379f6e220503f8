"""Documents that hold benchmark items: size-partitioned MinHash search, verified by exact containment."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import floor

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.common import map_batches

SHINGLE = 5
_MIX = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier of the rolling combination


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words of letters and digits' stretches: A-Z lowered, cut at ASCII white space."""
    return (text or "").encode().lower().split()


class WordHashes(dict):
    """A table of word hashes that makes those it lacks."""

    def __missing__(self, word: bytes) -> int:
        self[word] = out = xxhash.xxh64_intdigest(word)
        return out


def shingle_hashes(words: list[bytes], cache: dict[bytes, int], size: int = SHINGLE) -> np.ndarray:
    """One 64-bit hash for each ``size`` words in a row; fewer words, but one at least, are one shingle."""
    if not words:
        return np.zeros(0, np.uint64)
    if not isinstance(cache, WordHashes):
        for word in set(words).difference(cache):
            cache[word] = xxhash.xxh64_intdigest(word)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    out = h[: len(h) - size + 1].copy()
    for k in range(1, size):
        out ^= out >> np.uint64(29)
        out *= _MIX
        out += h[k : len(h) - size + 1 + k]
    return out * _MIX ^ (out >> np.uint64(32))


def trimmed(cache: dict[bytes, int], most: int = 400_000) -> dict[bytes, int]:
    """A table of word hashes, emptied when it has grown to its limit."""
    if len(cache) > most:
        cache.clear()
    return cache


class Items:
    """A bounded block of items: a MinHash sketch each, sized by the item's class, and the exact shingles.

    Items fall into classes by shingle count, each class ending at twice the last. A document
    that contains a share ``threshold`` of an item lacks at most (1 - threshold) of its shingles,
    so of the item's smallest hashes, one more than the class's largest such number, it has one
    at least: a sketch of that length misses nothing.
    """

    def __init__(self, items: list[tuple], threshold: Fraction) -> None:
        cache: dict[bytes, int] = {}
        self.threshold, self.ids, self.shingles = threshold, [], []
        hashes, owners = [], []
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            sketch = np.unique(shingle_hashes(words, cache))
            most = 1 << (len(sketch) - 1).bit_length()  # the largest size of its class
            sketch = sketch[: floor((1 - threshold) * most) + 1]
            hashes.append(sketch)
            owners.append(np.full(len(sketch), len(self.ids)))
            self.ids.append(item_id)
            self.shingles.append(_shingles(words))
        order = np.argsort(np.concatenate(hashes), kind="stable") if hashes else []
        self.hashes = np.concatenate(hashes)[order] if hashes else np.zeros(0, np.uint64)
        self.owners = np.concatenate(owners)[order] if hashes else np.zeros(0, np.int64)
        self.short = any(len(next(iter(x))) < SHINGLE for x in self.shingles)
        # one bit per low part of a sketched hash: most shingles of a document end here
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.hashes & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def contained(self, text: str | None, cache: dict[bytes, int]) -> list[tuple]:
        """(item, share) for each item of which the text has ``threshold`` of the shingles or more."""
        words = words_of(text)
        if not words or not self.ids:
            return []
        found: set[int] = set()
        sizes = range(1, SHINGLE + 1) if self.short else (SHINGLE,)
        for size in sizes:
            if size <= len(words):
                found |= self._candidates(shingle_hashes(words, cache, size))
        out = []
        for k in sorted(found):
            size = len(next(iter(self.shingles[k])))
            share = Fraction(len(self.shingles[k] & _shingles(words, size)), len(self.shingles[k]))
            if share >= self.threshold:
                out.append((self.ids[k], float(share)))
        return out

    def _candidates(self, hashes: np.ndarray) -> set[int]:
        hashes = hashes[self.bits[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)]]
        begin, end = np.searchsorted(self.hashes, hashes, "left"), np.searchsorted(self.hashes, hashes, "right")
        return {int(k) for a, b in zip(begin[begin < end].tolist(), end[begin < end].tolist(), strict=True) for k in self.owners[a:b]}


def _shingles(words: list[bytes], size: int = SHINGLE) -> set[tuple[bytes, ...]]:
    size = min(size, len(words))
    return set(zip(*(words[k : len(words) - size + 1 + k] for k in range(size)), strict=True))


def item_blocks(benchmark: DataFrame, block_bytes: int = 16 << 20) -> Iterator[list[tuple]]:
    """The benchmark in blocks of bounded size; the driver holds one at a time."""
    block, size = [], 0
    for r in benchmark.select("item_id", F.col("text").cast("string").alias("text")).toLocalIterator():
        block.append((r[0], r[1]))
        size += len((r[1] or "").encode()) + 16
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, *, threshold: float = 0.8, block_bytes: int = 16 << 20) -> DataFrame:
    """``doc_id``, ``item_id`` and ``containment`` for every document that holds an item of ``benchmark``.

    Containment is the share of the item's distinct five-word shingles that the document has,
    0.8 or more. The benchmark is a stated query set: it goes to the tasks in blocks of
    ``block_bytes``, each of which all documents pass once; documents are never exchanged.
    Blocks grow in number with the benchmark only.

    An item of fewer words is one shingle; items without words are in no document; null and
    empty texts hold nothing; repeated items and documents each give their own rows; other
    columns are ignored; empty tables give no rows.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = f"doc_id bigint, item_id {benchmark.schema['item_id'].dataType.simpleString()}, containment double"
    limit = Fraction(str(threshold))
    out = None
    for block in item_blocks(benchmark, block_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(block)  # at most block_bytes and one item
        part = map_batches(rows, _search(sent, limit), schema)
        out = part if out is None else out.union(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def _search(sent, limit: Fraction):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, cache = Items(sent.value, limit), {}
        kind = pa.array([x for x, _ in sent.value]).type
        for batch in batches:
            found = [(doc_id, *hit) for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for hit in items.contained(text, trimmed(cache))]
            doc_ids, item_ids, shares = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(item_ids, kind), pa.array(shares, pa.float64())], ["doc_id", "item_id", "containment"])

    return run


def without_contaminated(docs: DataFrame, benchmark: DataFrame, *, threshold: float = 0.8, block_bytes: int = 16 << 20) -> DataFrame:
    """``docs``, all columns kept, less the rows whose text holds a benchmark item."""
    limit = Fraction(str(threshold))
    at = docs.columns.index("text")

    def drop(sent):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items, cache = Items(sent.value, limit), {}
            for batch in batches:
                yield batch.filter(pa.array([not items.contained(text, trimmed(cache)) for text in batch.column(at).to_pylist()], pa.bool_()))

        return run

    for block in item_blocks(benchmark, block_bytes):
        docs = map_batches(docs, drop(docs.sparkSession.sparkContext.broadcast(block)), docs.schema)
    return docs
