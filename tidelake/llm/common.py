"""Reading documents, batch functions on executors, and tables kept between jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.session import scratch_folder

# Words are what ASCII white space separates; bytes.split() cuts at exactly these characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
# Keys that are sent to the tasks at most; beyond it they are joined by exchanging both sides.
MOST_SENT = 2_000_000
# Rows that a batch function gets at once in the pipeline: both JVM and Python hold whole batches, of texts.
BATCH_ROWS = 1_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_ROOT = str(Path(__file__).resolve().parents[2])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` whose workers find this package, also where it is not installed (local mode)."""
    env = df.sparkSession.sparkContext.environment
    if _ROOT not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (_ROOT, env.get("PYTHONPATH", "")) if x)
    return df.mapInArrow(fn, schema)


def small_batches(spark: SparkSession) -> None:
    """From now on batch functions get ``BATCH_ROWS`` rows at once; a session with fewer stays so."""
    if not 0 < int(spark.conf.get(_BATCH)) <= BATCH_ROWS:
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: later jobs read it and recompute nothing."""
    spark = df.sparkSession
    folder = scratch_folder(spark, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def picked(rows: DataFrame, keys: DataFrame, name: str, how: str = "left_semi") -> DataFrame:
    """``rows`` whose ``name`` is among the stored ``keys`` (``left_anti``: is not): keys go to the rows, so that texts stay where they are."""
    return rows.join(F.broadcast(keys) if keys.count() <= MOST_SENT else keys, name, how)


def free_name(columns: list[str], wanted: str) -> str:
    """A column name that none of ``columns`` has, in any case: ``wanted``, or that with underscores."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def slices(texts: list[str | None], most_chars: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``most_chars`` characters; a longer text stands alone."""
    begin = size = 0
    for i, text in enumerate(texts):
        n = len(text or "")
        if size and size + n > most_chars:
            yield begin, i
            begin, size = i, 0
        size += n
    if begin < len(texts):
        yield begin, len(texts)
