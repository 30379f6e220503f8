"""A few small-file operations on whatever storage the session is configured for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _path(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(p)] if fs.exists(p) else []


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether there is a file anywhere below a folder; stops at the first."""
    fs, p = _path(spark, path)
    return fs.exists(p) and fs.listFiles(p, True).hasNext()


def child_sizes(spark: SparkSession, path: str) -> dict[str, int]:
    fs, p = _path(spark, path)
    return {status.getPath().getName(): status.getLen() for status in fs.listStatus(p)} if fs.exists(p) else {}


def totals(spark: SparkSession, path: str) -> tuple[int, int]:
    """Number and bytes of all files at or below a path; none if there is nothing."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return 0, 0
    found = fs.getContentSummary(p)
    return found.getFileCount(), found.getLength()


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder and what is in it; nothing happens if there is none."""
    fs, p = _path(spark, path)
    fs.delete(p, True)


def first_text(spark: SparkSession, path: str, text: str) -> str:
    """The text of a small file, which is made with ``text`` if there is none."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        out = fs.create(p, False)
        out.write(bytearray(text.encode()))
        out.close()
        return text
    stream = fs.open(p)
    try:
        return bytes(stream.readNBytes(1 << 16)).decode()
    finally:
        stream.close()
