"""Packing of token sequences into windows by multiway differencing."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.common import map_batches
from tidelake.llm.tokens import default_tokenizer, encoder

_PIECES = "start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"


def pack(docs: DataFrame, *, capacity: int = 2048, end_id: int = 1, tokenizer: str | None = None, block: int = 512) -> DataFrame:
    """Pieces of all documents, each with its place in a window of at most ``capacity`` tokens.

    A document is its text's ids and ``end_id``. Its full windows stand alone; what is left over
    goes whole into a shared window. Leftovers are dealt in blocks of ``block`` as a task meets
    them: Karmarkar-Karp differencing divides a block among as many windows as its tokens need,
    and among more while the fullest window is over capacity. Tokens never leave their task.

    Columns: ``doc_id``, ``start`` (ids of the document before the piece), ``length``,
    ``doc_tokens``, ``sequence_id``, ``offset`` (gapless from 0) and ``ids`` (little-endian
    unsigned 32-bit). A null or empty text is its end id alone; null and repeated doc_ids are
    packed row by row; other columns are ignored; no rows give no rows.
    """
    path = tokenizer or default_tokenizer()
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Windows(capacity, TaskContext.get().partitionId() << 36)
        end = np.uint32(end_id).tobytes()
        pending: list[tuple] = []
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder(path).encode(texts), strict=True):
                ids += end
                n = len(ids) // 4
                full = n - n % capacity
                for start in range(0, full, capacity):
                    out.put([(doc_id, start, n, ids[4 * start : 4 * (start + capacity)])])
                if full < n:
                    pending.append((doc_id, full, n, ids[4 * full :]))
                if len(pending) == block:
                    out.deal(pending)
                    pending = []
                if out.size > 4 << 20:
                    yield out.batch()
        if pending:
            out.deal(pending)
        if out.size:
            yield out.batch()

    return map_batches(rows, run, f"doc_id bigint, {_PIECES}")


class _Windows:
    """Collects pieces of finished windows as rows."""

    def __init__(self, capacity: int, first: int) -> None:
        self.capacity, self.next, self.size = capacity, first, 0
        self.rows: list[tuple] = []

    def put(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, total, ids in pieces:
            length = len(ids) // 4
            self.rows.append((doc_id, start, length, total, self.next, offset, ids))
            offset += length
            self.size += len(ids) + 64
        self.next += 1

    def deal(self, pieces: list[tuple]) -> None:
        windows: dict[int, list[tuple]] = {}
        for piece, k in zip(pieces, divide([len(x[3]) // 4 for x in pieces], self.capacity), strict=True):
            windows.setdefault(k, []).append(piece)
        for window in windows.values():
            self.put(window)

    def batch(self) -> pa.RecordBatch:
        kinds = [pa.int64()] * 6 + [pa.binary()]
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
        out = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*self.rows, strict=True), kinds, strict=True)], names)
        self.rows, self.size = [], 0
        return out


def divide(lengths: list[int], capacity: int) -> list[int]:
    """A window for each length, none over ``capacity``, in as few windows as differencing finds.

    The count starts at what the total needs and rises, first in growing steps, then back by
    halves to the smallest count seen to fit. A window each always fits.
    """
    low = -(-sum(lengths) // capacity) - 1
    count, step, best = low + 1, 1, None
    while best is None:
        labels = difference(lengths, count)
        if _fits(labels, lengths, capacity):
            best = labels
        else:
            low, count, step = count, min(len(lengths), count + step), 2 * step
    high = count
    while high - low > 1:
        count = (low + high) // 2
        labels = difference(lengths, count)
        if _fits(labels, lengths, capacity):
            best, high = labels, count
        else:
            low = count
    return best


def _fits(labels: list[int], lengths: list[int], capacity: int) -> bool:
    return np.bincount(labels, weights=lengths).max(initial=0) <= capacity


def difference(lengths: list[int], count: int) -> list[int]:
    """Karmarkar-Karp: divide ``lengths`` among ``count`` windows of near-equal sums.

    A partial partition holds its sums in falling order and one member of each part. The two
    partial partitions of largest imbalance merge until one is left, the large sums of one
    meeting the small sums of the other; sums of zero are left out of the lists.
    """
    if count >= len(lengths):
        return list(range(len(lengths)))
    parent = list(range(len(lengths)))
    heap = [(-x, i, np.array([x]), np.array([i])) for i, x in enumerate(lengths)]
    heapq.heapify(heap)
    serial = len(heap)
    while len(heap) > 1:
        _, _, sums, members = heapq.heappop(heap)
        _, _, more, others = heapq.heappop(heap)
        meet = max(0, len(sums) + len(more) - count)
        if meet:
            at, to = len(sums) - meet, len(more) - meet
            for keep, lose in zip(members[at:].tolist(), others[to:][::-1].tolist(), strict=True):
                parent[lose] = keep
            joint = sums[at:] + more[to:][::-1]
            sums, members = np.concatenate((sums[:at], more[:to], joint)), np.concatenate((members[:at], others[:to], members[at:]))
        else:
            sums, members = np.concatenate((sums, more)), np.concatenate((members, others))
        order = np.argsort(-sums, kind="stable")
        sums, members = sums[order], members[order]
        imbalance = sums[0] - (sums[-1] if len(sums) == count else 0)
        heapq.heappush(heap, (-int(imbalance), serial, sums, members))
        serial += 1
    part = {int(x): k for k, x in enumerate(heap[0][3])}
    return [part[_root(parent, i)] for i in range(len(lengths))]


def _root(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i
