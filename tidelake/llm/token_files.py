"""Token ids of documents as flat binary files with 64-bit document offsets."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelake.llm.common import map_batches
from tidelake.llm.tokens import default_tokenizer, encoder

_BUFFER = 8 << 20


def write_token_files(docs: DataFrame, folder: str, *, end_id: int = 0, tokenizer: str | None = None) -> None:
    """Write all documents' ids, each closed by ``end_id``, in ascending ``doc_id`` order.

    ``docs`` is dealt by ranges of ``doc_id``; each task streams its range into three files:
    ``.ids`` (flat little-endian unsigned integers, 16 bits wide where the vocabulary allows,
    else 32), ``.offsets`` (64-bit, one more than documents, from 0 within the file) and
    ``.keys`` (the doc_ids, an Arrow file). A task names its files anew at each attempt and only
    finished tasks enter the manifest, so repeated or lost attempts leave no trace in the result.
    ``folder`` is a file system path or address that pyarrow and Spark both open.

    Null doc_ids come first; equal doc_ids are ordered by a hash of the text; a null or empty
    text is its end id alone; other columns are ignored; without rows the manifest is empty.
    """
    path = tokenizer or default_tokenizer()
    kind = "<u2" if max(encoder(path).vocabulary, end_id + 1) <= 1 << 16 else "<u4"
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tie = F.xxhash64("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        end = np.uint32(end_id).tobytes()
        for batch in batches:
            if not batch.num_rows:
                continue
            writer = writer or _Writer(folder, kind)
            texts = batch.column(1).to_pylist()
            for ids in encoder(path).encode(texts):
                writer.add(ids + end)
            writer.keys(batch.column(0))
        if writer:
            yield pa.RecordBatch.from_pydict({
                "part": [TaskContext.get().partitionId()], "name": [writer.name], "kind": [kind],
                "documents": [writer.documents], "tokens": [writer.close()],
            })

    ordered = rows.repartitionByRange(F.col("doc_id"), tie).sortWithinPartitions("doc_id", tie)
    parts = map_batches(ordered, run, "part bigint, name string, kind string, documents bigint, tokens bigint")
    parts.write.parquet(f"{folder}/manifest")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids`` (unsigned 32-bit).

    A file's place among all ids is the sum of the counts of the files before it: one row per
    file, so the running sum stays small. Files on a mounted file system are memory-mapped.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = spark.read.parquet(f"{folder}/manifest").withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                yield from _documents(folder, part)

    spread = parts.repartition(spark.sparkContext.defaultParallelism, "name")
    return map_batches(spread, run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


class _Writer:
    def __init__(self, folder: str, kind: str) -> None:
        self.store, root = fs.FileSystem.from_uri(_address(folder))
        self.store.create_dir(root, recursive=True)
        self.kind, self.name = kind, uuid.uuid4().hex
        self.file = self.store.open_output_stream(f"{root}/{self.name}.ids")
        self.offset_file = self.store.open_output_stream(f"{root}/{self.name}.offsets")
        self.key_file = self.store.open_output_stream(f"{root}/{self.name}.keys")
        self.key_rows = pa.ipc.new_file(self.key_file, _KEYS)
        self.offset_file.write(np.int64(0).tobytes())
        self.documents = self.tokens = self.size = 0
        self.waiting: list[bytes] = []
        self.ends: list[int] = []

    def add(self, ids: bytes) -> None:
        self.waiting.append(ids)
        self.size += len(ids)
        self.documents += 1
        self.tokens += len(ids) // 4
        self.ends.append(self.tokens)
        if self.size > _BUFFER:
            self._flush()

    def keys(self, doc_ids: pa.Array) -> None:
        self.key_rows.write_batch(pa.RecordBatch.from_arrays([doc_ids.cast(pa.int64())], schema=_KEYS))

    def close(self) -> int:
        self._flush()
        self.key_rows.close()
        for file in (self.file, self.offset_file, self.key_file):
            file.close()
        return self.tokens

    def _flush(self) -> None:
        self.file.write(np.frombuffer(b"".join(self.waiting), "<u4").astype(self.kind).tobytes())
        self.offset_file.write(np.array(self.ends, "<i8").tobytes())
        self.waiting, self.ends, self.size = [], [], 0


_KEYS = pa.schema([("doc_id", pa.int64())])


def _address(folder: str) -> str:
    folder = folder.replace("s3a://", "s3://", 1)
    return folder if "://" in folder else "file://" + folder.removeprefix("file:")


def _mapped(store: fs.FileSystem, path: str, kind: str) -> np.ndarray:
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, kind, "r")
    with store.open_input_file(path) as file:
        return np.frombuffer(file.read(), kind)


def _documents(folder: str, part: dict) -> Iterator[pa.RecordBatch]:
    store, root = fs.FileSystem.from_uri(_address(folder))
    ids = _mapped(store, f"{root}/{part['name']}.ids", part["kind"])
    ends = _mapped(store, f"{root}/{part['name']}.offsets", "<i8")
    with store.open_input_file(f"{root}/{part['name']}.keys") as file:
        keys = pa.ipc.open_file(file).read_all().column(0).combine_chunks()
    begin = 0
    while begin < part["documents"]:
        # as many documents as fit the buffer, one at least
        end = max(begin + 1, int(np.searchsorted(ends, ends[begin] + _BUFFER // 4, "right")) - 1)
        end = min(end, part["documents"])
        cut = ends[begin : end + 1]
        wide = np.ascontiguousarray(ids[cut[0] : cut[-1]].astype("<u4"))
        at = ((cut - cut[0]) * 4).astype("<i4")
        yield pa.RecordBatch.from_arrays([
            keys.slice(begin, end - begin), pa.array(cut[:-1] + part["base"]), pa.array(np.diff(cut)),
            pa.Array.from_buffers(pa.binary(), end - begin, [None, pa.py_buffer(at.tobytes()), pa.py_buffer(wide)]),
        ], ["doc_id", "start", "n_tokens", "ids"])
        begin = end
