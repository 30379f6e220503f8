"""Partition transforms as plain columns, since folders can only be split by identity."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def day_of(moment: Column) -> Column:
    return F.to_date(moment)


def month_of(moment: Column) -> Column:
    return F.trunc(F.to_date(moment), "month")


def bucket_of(count: int, *columns: Column) -> Column:
    """Number 0..count-1 from the columns.

    It is the hash Spark's own exchanges use: where the number of shuffle partitions is a multiple
    of ``count``, one task of a join on these columns holds rows of one bucket only, and its output
    needs no further exchange to be written by bucket.
    """
    return F.pmod(F.hash(*columns), F.lit(count))


def folder_of(column: Column) -> Column:
    """A name for every value. Folders cannot tell an empty text from none, so both go to ``-``; the
    column itself stays in the files."""
    return F.coalesce(F.nullif(column.cast("string"), F.lit("")), F.lit("-"))


def transform(kind: str, column: Column, buckets: int = 8) -> Column:
    """One of the four transforms by name."""
    known = {
        "day": lambda: day_of(column),
        "month": lambda: month_of(column),
        "bucket": lambda: bucket_of(buckets, column),
        "identity": lambda: column,
    }
    if kind not in known:
        raise ValueError(f"unknown partition transform {kind!r}")
    return known[kind]()
