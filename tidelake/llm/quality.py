"""Quality rules: measures of each text, and lines that too many documents of a host share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidelake.llm.common import MOST_SENT, free_name, map_batches, stored

_SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\x0b\x0c\r"
_DIGITS = bytes(0x30 if 0x30 <= b <= 0x39 else b for b in range(256))
_MEASURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
_VERDICT = f"{_MEASURES}, base_failed boolean, removed_words bigint, kept boolean"
# A line is shared by too many above this many documents of its host and this share of them.
MIN_DOCUMENTS = 10
HOST_SHARE = 0.02
# A document is depleted when its removed lines hold more than this share of its words.
DEPLETED = 0.5


def measures(text: str | None) -> tuple[int, int, int, int, int]:
    """Words, their characters, symbols, repeated lines, and words in three-word windows found twice or more."""
    raw = (text or "").encode()
    words = raw.split()
    chars = len(text or "") - (len(raw) - len(raw.translate(None, _SPACE)))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(words), chars, len(raw) - len(raw.translate(None, _SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


def repeated_words(words: list[bytes]) -> int:
    n = len(words)
    if n < 3:
        return 0
    first: dict[bytes, int] = {}
    ids = np.fromiter(map(first.setdefault, words, range(n)), np.int64, n)
    pairs = ids[:-1] * n + ids[1:]
    if n > 2_000_000:  # three numbers below n no longer fit 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    keys = pairs[:-1] * n + ids[2:]
    order = np.argsort(keys, kind="stable")
    same = np.diff(keys[order]) == 0
    if not same.any():
        return 0
    often = np.zeros(n - 2, bool)
    often[order[1:][same]] = often[order[:-1][same]] = True
    held = np.zeros(n, bool)
    for k in range(3):
        held[k : n - 2 + k] |= often
    return int(held.sum())


def line_keys(text: str | None, host: str | None) -> tuple[list[bytes], list[int], list[int]]:
    """The text's lines, a key of host and normalised line for each (0: no word), and their words.

    Normalised: A-Z lowered, digits as 0, white space as one space between words.
    """
    lines = (text or "").encode().split(b"\n")
    seed = xxhash.xxh64_intdigest(b"null" if host is None else b"=" + str(host).encode())
    keys, counts = [], []
    for line in lines:
        words = line.lower().translate(_DIGITS).split()
        keys.append((xxhash.xxh64_intdigest(b" ".join(words), seed) or 1) if words else 0)
        counts.append(len(words))
    return lines, keys, counts


def _signed(keys: list[int]) -> np.ndarray:
    return np.array(keys, np.uint64).view(np.int64)


def shared_lines(docs: DataFrame, host: str = "source", *, min_documents: int = MIN_DOCUMENTS, share: float = HOST_SHARE, classes: DataFrame | None = None) -> DataFrame:
    """``line_key`` of every line in more than ``min_documents`` and ``share`` of its host's documents.

    Documents with equal texts count once, so copies alone make no line shared. A line is hashed
    with its host; (line, text) pairs are first made distinct, which spreads a line that very
    many documents have, and then counted with sums per task. With ``classes`` (``node``, the
    text's xxhash64, and ``root``), texts of one root count once too: a document meets its root with
    its line keys, not with its text.
    """
    rows = docs.select(F.col(host).cast("string").alias("host"), F.col("text").cast("string").alias("text"))
    flat = classes is None
    if not flat:
        rows = rows.withColumn("node", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, texts, lines = [], [], []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                keys = np.unique(_signed([0, *line_keys(text, name)[1]]))  # 0 stands for the document itself
                lines.append(keys)
                n = len(keys) if flat else 1
                hosts.append(np.full(n, xxhash.xxh64_intdigest(b"null" if name is None else b"=" + name.encode()), np.uint64))
                texts.append(np.full(n, xxhash.xxh64_intdigest((text or "").encode()), np.uint64))
            host, line, alone = (pa.array(np.concatenate(x).view(np.int64) if x else np.zeros(0, np.int64)) for x in (hosts, lines, texts))
            if flat:
                yield pa.RecordBatch.from_arrays([host, line, alone], ["host_key", "line_key", "text_key"])
            else:
                held = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, lines)]), pa.int32()), line)
                yield pa.RecordBatch.from_arrays([host, held, alone, batch.column(2)], ["host_key", "line_keys", "text_key", "node"])

    if flat:
        pairs = map_batches(rows, run, "host_key bigint, line_key bigint, text_key bigint")
    else:
        lined = map_batches(rows, run, "host_key bigint, line_keys array<bigint>, text_key bigint, node bigint").join(classes, "node", "left")
        pairs = lined.select("host_key", F.explode("line_keys").alias("line_key"), F.coalesce("root", "text_key").alias("text_key"))
    counts = pairs.distinct().groupBy("host_key", "line_key").agg(F.count("*").alias("n")).where(f"n > {min_documents} or line_key = 0")
    counts = stored(counts, "quality-lines")
    totals = counts.where("line_key = 0").select("host_key", F.col("n").alias("total"))
    return counts.where("line_key <> 0").join(totals, "host_key").where(F.col("n") > F.lit(share) * F.col("total")).select("line_key")


def judge(docs: DataFrame, host: str = "source", *, min_documents: int = MIN_DOCUMENTS, share: float = HOST_SHARE) -> DataFrame:
    """One row per document: ``doc_id``, the base measures, the verdict, and ``text`` without its shared lines.

    ``base_failed``: under 50 words, or over half of them in repeated three-word windows.
    ``kept``: not failed, and at most half of the words are in lines that ``shared_lines`` names.
    A null text has no words and fails; its text stays null. Null hosts are a host of their own;
    null and repeated doc_ids are judged row by row; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(host).cast("string").alias("host"), F.col("text").cast("string").alias("text"))
    names = ["doc_id", *[x.split()[0] for x in _VERDICT.split(", ")], "text"]

    def finish(batch: pa.RecordBatch, verdicts: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*verdicts, strict=True)) if verdicts else [()] * 9
        kinds = [pa.int64()] * 5 + [pa.bool_(), pa.int64(), pa.bool_(), pa.string()]
        return pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x, t) for x, t in zip(columns, kinds, strict=True)]], names)

    return _with_lines(rows, "host", "text", shared_lines(rows, "host", min_documents=min_documents, share=share), finish, f"doc_id bigint, {_VERDICT}, text string")


def keep_good(docs: DataFrame, host: str = "source", *, min_documents: int = MIN_DOCUMENTS, share: float = HOST_SHARE, classes: DataFrame | None = None) -> DataFrame:
    """``docs``, all columns, without rejected documents and with shared lines cut from ``text``; ``classes`` as in ``shared_lines``.

    A null or empty text has no words and is rejected; repeated rows are judged and kept alike; a
    null host is one of its own; other columns stay as they are; no rows give no rows.
    """
    names = docs.columns
    at = names.index("text")

    def finish(batch: pa.RecordBatch, verdicts: list[tuple]) -> pa.RecordBatch:
        text = pa.array([x[-1] for x in verdicts], pa.string()).cast(batch.schema.field(at).type)
        kept = pa.array([x[-2] for x in verdicts], pa.bool_())
        return batch.select(names).set_column(at, batch.schema.field(at), text).filter(kept)

    return _with_lines(docs, host, "text", shared_lines(docs, host, min_documents=min_documents, share=share, classes=classes), finish, docs.schema)


def _with_lines(docs: DataFrame, host: str, text: str, shared: DataFrame, finish, schema: str | StructType) -> DataFrame:
    """Judge every row knowing which of its lines are shared, by a sent set of proven size or by joins."""
    shared = stored(shared, "quality-shared")
    if shared.count() <= MOST_SENT:
        keys = np.sort(np.array([r[0] for r in shared.toLocalIterator()], np.int64))
        return map_batches(docs, _judged(docs.columns, host, text, finish, docs.sparkSession.sparkContext.broadcast(keys)), schema)
    # The verdict is a function of host and text: shared lines come back as a list under their hash.
    key = F.xxhash64(F.coalesce(F.col(host).cast("string"), F.lit("")), F.col(host).isNull(), F.col(text))
    lined = map_batches(docs.select(key.alias("row"), F.col(host).cast("string").alias("host"), F.col(text).cast("string").alias("text")), _row_lines, "row bigint, line_key bigint")
    found = lined.join(shared, "line_key", "left_semi").groupBy("row").agg(F.collect_set("line_key").alias("__shared"))
    row, lines = free_name(docs.columns, "__row"), free_name(docs.columns, "__shared")
    named = found.select(F.col("row").alias(row), F.col("__shared").alias(lines))
    joined = docs.withColumn(row, key).join(named, row, "left").select(*docs.columns, F.coalesce(lines, F.array().cast("array<bigint>")).alias(lines))
    return map_batches(joined, _judged(docs.columns, host, text, finish, None), schema)


def _row_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, lines = [], []
        for row, host, text in zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True):
            keys = np.unique(_signed(line_keys(text, host)[1]))
            lines.append(keys[keys != 0])
            rows.append(np.full(len(lines[-1]), row))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else np.zeros(0, np.int64)) for x in (rows, lines)], ["row", "line_key"])


def _judged(columns: list[str], host: str, text: str, finish, sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, texts = batch.column(columns.index(host)).to_pylist(), batch.column(columns.index(text)).to_pylist()
            lists = [None] * len(texts) if sent else batch.column(len(columns)).to_pylist()
            yield finish(batch, [verdict(t, h, sent.value if sent else np.array(sorted(x or []), np.int64)) for t, h, x in zip(texts, hosts, lists, strict=True)])

    return run


def verdict(text: str | None, host: str | None, shared: np.ndarray) -> tuple:
    """The measures, base_failed, removed words, kept, and the text without shared lines."""
    base = measures(text)
    failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
    removed = 0
    if len(shared) and text:
        lines, keys, counts = line_keys(text, host)
        own = _signed(keys)
        hit = (shared[np.minimum(np.searchsorted(shared, own), len(shared) - 1)] == own) & (own != 0)
        if hit.any():
            removed = int(np.array(counts)[hit].sum())
            text = b"\n".join(x for x, cut in zip(lines, hit.tolist(), strict=True) if not cut).decode()
    return *base, failed, removed, not failed and removed <= DEPLETED * base[0], text


def verdict_columns() -> list[Column]:
    return [F.col(x) for x in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words")]
