"""Token counts of documents from the counts of their distinct pre-tokens."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.common import map_batches, slices
from tidelake.llm.tokens import default_tokenizer, encoder

# A posting: the document's place in its block, and how often the pre-token occurs there.
_POSTING = np.dtype([("doc", "<u2"), ("n", "<u4")])
# A document of a block: its id, whether it has one, and its bytes.
_DOCUMENT = np.dtype([("doc_id", "<i8"), ("known", "?"), ("n_bytes", "<i8")])
_BLOCK_CHARS = 32 << 20
_BLOCK_ROWS = 1 << 16
_SUM_BYTES = 64 << 20
# ``packed`` holds postings of the pre-token ``key`` or, where that is null, the block's documents.
_FREQUENCIES = "key string, block bigint, packed binary"


def count_tokens(docs: DataFrame, *, tokenizer: str | None = None) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8) and ``n_tokens`` of each row's whole text; no ids are made.

    Documents are read in blocks. A block gives one row per distinct pre-token with the block's
    frequencies of it, packed per document. One exchange brings a pre-token's rows together and
    sorts them, so its pieces are counted once and joined to all its frequencies; the products
    are summed within a task and then by block. A frequent pre-token has one row per block.
    A pre-token is a stretch that the tokenizer's own split never crosses (see ``tokens``).

    A null text counts as empty: no bytes, no tokens. Null and repeated doc_ids are counted row
    by row; other columns are ignored; no rows give no rows.
    """
    path = tokenizer or default_tokenizer()
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spark = docs.sparkSession

    by_key = map_batches(rows, _frequencies(path), _FREQUENCIES).repartition(_parts(spark), "key", F.when(F.col("key").isNull(), F.col("block"))).sortWithinPartitions("key")
    sums = map_batches(by_key, _sum_postings(path), _SUMS)
    return map_batches(sums.repartition(_parts(spark), "block").sortWithinPartitions("block"), _finish, "doc_id bigint, n_bytes bigint, n_tokens bigint")


# ``packed`` holds tokens of the documents at ``doc_at`` or, where that is empty, the block's documents.
_SUMS = "block bigint, doc_at binary, packed binary"


def _parts(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _frequencies(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, end in slices(texts, _BLOCK_CHARS):
                for begin in range(start, end, _BLOCK_ROWS):
                    part = texts[begin : min(end, begin + _BLOCK_ROWS)]
                    yield from _block(path, serial, batch.column(0).slice(begin, len(part)), part)
                    serial += 1

    return run


def _block(path: str, block: int, doc_ids: pa.Array, texts: list[str | None]) -> Iterator[pa.RecordBatch]:
    numbers: dict[str, int] = {}
    found = []
    for doc, text in enumerate(texts):
        counts = Counter(encoder(path).units(text or ""))
        units = np.fromiter((numbers.setdefault(unit, len(numbers)) for unit in counts), np.int64, len(counts))
        row = np.empty(len(counts), _POSTING)
        row["doc"], row["n"] = doc, np.fromiter(counts.values(), np.int64, len(counts))
        found.append((units, row))
    units = np.concatenate([x for x, _ in found])
    postings = np.concatenate([x for _, x in found])[np.argsort(units, kind="stable")]
    at = np.concatenate(([0], np.bincount(units, minlength=len(numbers)).cumsum())) * _POSTING.itemsize
    keys = list(numbers)
    step = 200_000
    for i in range(0, len(keys), step):
        n = min(step, len(keys) - i)
        cut = at[i : i + n + 1]
        packed = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((cut - cut[0]).astype("<i4").tobytes()), pa.py_buffer(postings.view(np.uint8)[cut[0] : cut[-1]].tobytes())])
        yield pa.RecordBatch.from_arrays([pa.array(keys[i : i + n]), pa.array(np.full(n, block)), packed], ["key", "block", "packed"])
    # The block's documents travel beside its pre-tokens, without a key: no text can stand in for that.
    own = np.zeros(len(texts), _DOCUMENT)
    own["doc_id"], own["known"] = doc_ids.fill_null(0).to_numpy(), doc_ids.is_valid().to_numpy(zero_copy_only=False)
    own["n_bytes"] = [len(text.encode()) if text else 0 for text in texts]
    yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), pa.array([block]), pa.array([own.tobytes()])], ["key", "block", "packed"])


def _sum_postings(path: str):
    """Count each pre-token's pieces, add up what they give each document, hand on bounded sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        held = 0
        last: tuple[str | None, int] = (None, 0)
        for batch in batches:
            is_block = pc.is_null(batch.column(0))
            own = batch.filter(is_block)
            if own.num_rows:
                yield pa.RecordBatch.from_arrays([own.column(1), pa.array([b""] * own.num_rows), own.column(2)], ["block", "doc_at", "packed"])
            batch = batch.filter(pc.invert(is_block))
            if not batch.num_rows:
                continue
            keys = batch.column(0).dictionary_encode()
            distinct = keys.dictionary.to_pylist()
            known = distinct[0] == last[0]
            counts = np.array([last[1]] * known + encoder(path).count(distinct[known:]))
            last = distinct[-1], int(counts[-1])
            held += _add(sums, batch.column(1).to_numpy(), batch.column(2), counts[keys.indices.to_numpy()])
            if held > _SUM_BYTES:
                yield _flushed(sums)
                sums, held = {}, 0
        if sums:
            yield _flushed(sums)

    return run


def _add(sums: dict[int, np.ndarray], block: np.ndarray, packed: pa.Array, pieces: np.ndarray) -> int:
    """Add frequency times pieces to the documents of each block; the bytes by which ``sums`` grew."""
    at = np.frombuffer(packed.buffers()[1], "<i4", len(packed) + 1, 4 * packed.offset)
    rows = np.frombuffer(packed.buffers()[2], np.uint8)[at[0] : at[-1]].view(_POSTING)
    each = np.diff(at) // _POSTING.itemsize
    blocks, tokens, docs = np.repeat(block, each), np.repeat(pieces, each) * rows["n"], rows["doc"].astype(np.int64)
    order = np.argsort(blocks, kind="stable")
    blocks, tokens, docs = blocks[order], tokens[order], docs[order]
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(blocks)) + 1, [len(blocks)]))
    grown = 0
    for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        more = np.bincount(docs[i:j], weights=tokens[i:j]).astype(np.int64)
        was = sums.get(int(blocks[i]), np.zeros(0, np.int64))
        if len(was) < len(more):
            grown += 8 * (len(more) - len(was))
            was = np.concatenate((was, np.zeros(len(more) - len(was), np.int64)))
        was[: len(more)] += more
        sums[int(blocks[i])] = was
    return grown


def _flushed(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
    sums = {block: x for block, x in sums.items() if x.any()}  # an empty text has a unit without tokens
    docs = {block: np.flatnonzero(x) for block, x in sums.items()}
    return pa.RecordBatch.from_arrays([
        pa.array(list(sums), pa.int64()),
        pa.array([docs[b].astype("<u2").tobytes() for b in sums], pa.binary()),
        pa.array([x[docs[b]].astype("<i8").tobytes() for b, x in sums.items()], pa.binary()),
    ], ["block", "doc_at", "packed"])


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a block follow each other: add its parts and name its documents."""
    now, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["block"] != now and rows:
                yield _named(rows)
                rows = []
            now = row["block"]
            rows.append(row)
    if rows:
        yield _named(rows)


def _named(rows: list[dict]) -> pa.RecordBatch:
    own = np.frombuffer(next(row["packed"] for row in rows if not row["doc_at"]), _DOCUMENT)
    tokens = np.zeros(len(own), np.int64)
    for row in rows:
        if row["doc_at"]:
            tokens[np.frombuffer(row["doc_at"], "<u2")] += np.frombuffer(row["packed"], "<i8")
    doc_ids = pa.array(own["doc_id"], mask=~own["known"])
    return pa.RecordBatch.from_arrays([doc_ids, pa.array(own["n_bytes"]), pa.array(tokens)], ["doc_id", "n_bytes", "n_tokens"])
