"""Stored current state and stored reports: partitioned, bucketed Parquet tables that Spark writes."""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import date, datetime
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidelake.functions import bucket_of, folder_of, month_of
from tidelake.operators.latest import latest_per_key, recency
from tidelake.operators.merge import merge
from tidelake.schemas import GOLD, GOLD_LARGEST_FIRST, GOLD_LAYOUT, Entity
from tidelake.session import scratch_folder
from tidelake.sources.catalog import declare_table, layout_column
from tidelake.sources.storage import child_names, child_sizes, delete


def stored(rows: DataFrame, label: str, folders: list[str] | None = None) -> DataFrame:
    """Rows written to the shared folder and read again: computed once, whatever comes after. ``folders`` gets the place."""
    folder = scratch_folder(rows.sparkSession, label)
    if folders is not None:
        folders.append(folder)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def same(left: str, right: str, columns: Iterable[str]) -> Column:
    """Equal in all columns, nulls included."""
    tests = [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
    out = tests[0]
    for test in tests[1:]:
        out = out & test
    return out


class Changes(NamedTuple):
    """What a batch did to a table: rows of its keys as they were, and as the batch has them."""

    before: DataFrame
    after: DataFrame


class PartitionedTable:
    """One table over ``root``, declared with a partition per month, bucket or value of a column.

    ``clustered`` adds buckets by hash of a column, the same number for all tables, so that tables
    clustered alike are joined without an exchange. The partition column is derived and comes
    after the table's own. Rows are replaced by partition: Spark writes the new files beside the
    old ones and swaps whole folders when it commits. One writer at a time; readers that are at a
    partition while it is swapped have to start again.
    """

    def __init__(self, spark: SparkSession, database: str, name: str, root: str, schema: T.StructType, layout: tuple[str, str], buckets: int, clustered: str | None = None):
        self.spark, self.schema, self.layout, self.buckets, self.clustered = spark, schema, layout, buckets, clustered
        self.root, self.folder, self.largest_first = root.rstrip("/"), layout_column(layout), None
        self.name = declare_table(spark, database, name, self.root, schema, layout, buckets, clustered)

    def placed(self, rows: DataFrame) -> DataFrame:
        """Rows of the table's columns with the partition each belongs to."""
        kind, column = self.layout
        by_kind = {"month": lambda: month_of(F.col(column)), "bucket": lambda: bucket_of(self.buckets, F.col(column)), "identity": lambda: folder_of(F.col(column))}
        return rows.select(*self.schema.names, by_kind[kind]().alias(self.folder))

    def _folders(self) -> dict:
        """Partition values and the names of their folders."""
        read = {"month": date.fromisoformat, "bucket": int, "identity": str}[self.layout[0]]
        names = [n for n in child_names(self.spark, self.root) if n.startswith(f"{self.folder}=")]
        texts = {n: unquote(n.removeprefix(f"{self.folder}=")) for n in names}
        return {None if text == "__HIVE_DEFAULT_PARTITION__" else read(text): n for n, text in texts.items()}

    def partitions(self) -> set:
        """Values of the partitions that have files."""
        return {value for value, files in self._files().items() if files}

    def _files(self) -> dict:
        return {value: frozenset(n for n in child_names(self.spark, f"{self.root}/{folder}") if n.endswith(".parquet")) for value, folder in self._folders().items()}

    def bucket_sizes(self) -> list[int]:
        """Bytes of each bucket over all partitions, from the files' names."""
        sizes = [0] * self.buckets
        for folder in self._folders().values():
            for name, size in child_sizes(self.spark, f"{self.root}/{folder}").items():
                if bucket := re.search(r"_(\d+)\.c\d+\.", name):
                    sizes[int(bucket[1])] += size
        return sizes

    def whole(self, bucketed: bool = True) -> DataFrame:
        """All columns, the partition's included. Not ``bucketed``: the same files, whose joins exchange
        both sides, so that a key too large for its bucket can be split."""
        if not bucketed and self._folders():
            columns = T.StructType([*self.schema.fields, self.spark.table(self.name).schema[self.folder]])
            return self.spark.read.schema(columns).option("basePath", self.root).parquet(self.root)
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def in_use(self, placed: DataFrame) -> set:
        """The partitions that placed rows fall into."""
        return {r[0] for r in placed.select(self.folder).distinct().collect()}

    def of(self, partitions: Iterable) -> Column:
        """A test for being in one of some partitions, which reach the scan as a partition filter."""
        values = set(partitions)
        known = F.col(self.folder).isin(sorted(values - {None})) if values - {None} else F.lit(False)
        return known | F.col(self.folder).isNull() if None in values else known

    def read(self, partitions: Iterable | None = None, bucketed: bool = True) -> DataFrame:
        rows = self.whole(bucketed)
        return (rows if partitions is None else rows.where(self.of(partitions))).select(*self.schema.names)

    def overwrite(self, rows: DataFrame) -> None:
        """Replace the partitions that the placed ``rows`` fall into. Others keep their files."""
        spread = rows.repartition(self.buckets, self.clustered) if self.clustered else rows.hint("rebalance", self.folder)
        if self.largest_first:
            spread = spread.sortWithinPartitions(self.folder, F.desc(self.largest_first))
        spread.write.insertInto(self.name, overwrite=True)

    def overwrite_all(self, rows: DataFrame, partitions: set) -> None:
        """Replace those of ``partitions`` that the placed ``rows`` fall into, and empty the others."""
        before = self._files()
        self.overwrite(rows)
        after = self._files()
        self.clear(value for value in partitions if before.get(value) and before[value] == after.get(value))

    def clear(self, partitions: Iterable) -> None:
        """Empty some partitions."""
        nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()})" for f in self.schema)
        for value in partitions:
            literal = "NULL" if value is None else str(value) if self.layout[0] == "bucket" else f"DATE'{value}'" if self.layout[0] == "month" else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
            self.spark.sql(f"INSERT OVERWRITE TABLE {self.name} PARTITION ({self.folder} = {literal}) SELECT {nothing} WHERE false")


class StateTable(PartitionedTable):
    """One typed row per key. Merging a batch rewrites the partitions it touches and no others."""

    def __init__(self, spark: SparkSession, database: str, root: str, entity: Entity, buckets: int = 8):
        super().__init__(spark, database, entity.name, root, entity.state, entity.layout, buckets, entity.clustered)
        self.entity = entity

    def between(self, since: datetime | None, until: datetime | None) -> DataFrame:
        """Rows whose layout column is in [since, until); only their months are read."""
        kind, column = self.layout
        if kind != "month":
            raise ValueError(f"{self.entity.name} is not laid out by time")
        rows = self.whole()
        if since is not None:
            rows = rows.where((F.col(column) >= F.lit(since)) & (F.col(self.folder) >= F.lit(since.date().replace(day=1))))
        if until is not None:
            rows = rows.where((F.col(column) < F.lit(until)) & (F.col(self.folder) <= F.lit(until.date().replace(day=1))))
        return rows.select(*self.schema.names)

    def merge(self, staged: DataFrame, late_guard: bool = True, delete_keeps_target: bool = False, keep: bool = False) -> tuple[set, Changes | None]:
        """Apply staged rows, one per key at most, by :func:`tidelake.operators.merge.merge`.

        Returns the partitions rewritten, none without rows, and with ``keep`` what was changed.
        The partitions touched are those the batch falls into and those its keys are in now: a row
        whose month changes leaves one and enters another. Where the key does not tell the
        partition, the table's keys are read to find it. A partition that loses its last row is
        emptied first; a batch lost on the way can be repeated, and brings back what it moved.
        What is stored in between goes at the end; ``keep`` leaves the tables of the changes.
        """
        between: list[str] = []
        try:
            return self._merge(staged, late_guard, delete_keeps_target, keep, between)
        finally:
            for folder in between:
                delete(self.spark, folder)

    def _merge(self, staged: DataFrame, late_guard: bool, delete_keeps_target: bool, keep: bool, between: list[str]) -> tuple[set, Changes | None]:
        batch = stored(self.placed(staged), f"staged-{self.entity.name}", None if keep else between)
        touched = self.in_use(batch)
        if not touched:
            return set(), None
        there, key = self.partitions(), list(self.entity.key)
        moves = False
        twice = False
        if there and self.layout[1] not in key:
            where = self.whole().select(*key, self.folder).alias("old").join(batch.select(*key, self.folder).alias("new"), key)
            found = stored(where.select(*key, F.col(f"old.{self.folder}").alias("at"), F.col(f"new.{self.folder}").alias("goes")), f"places-{self.entity.name}", between)
            places = found.groupBy("at").agg(F.count_if(~F.col("at").eqNullSafe(F.col("goes"))).alias("moved"), F.count("*").alias("n")).collect()
            touched |= {r["at"] for r in places}
            moves = any(r["moved"] for r in places)
            # Only after a commit that broke off between two folders is a key in both.
            twice = moves and found.select(*key).distinct().count() < sum(r["n"] for r in places)
        rows = self.read(touched & there)
        if twice:
            rows = latest_per_key(rows, key, [part.desc_nulls_last() for part in recency()])
        batch = batch.select(*self.schema.names)
        changes = None
        if keep:
            old, new = rows.alias("old"), batch.alias("new")
            changes = Changes(stored(old.join(new, same("old", "new", key), "left_semi"), f"before-{self.entity.name}"), batch)
        merged = self.placed(merge(rows, batch, self.entity, late_guard, delete_keeps_target))
        if moves:
            merged = stored(merged, f"merged-{self.entity.name}", between)
            self.clear((touched & there) - self.in_use(merged))
        self.overwrite(merged)
        return touched, changes

    def replace(self, rows: DataFrame) -> None:
        """Make ``rows`` the whole table."""
        self.overwrite_all(self.placed(rows), self.partitions())


class ReportTable(PartitionedTable):
    """A stored result, replaced whole or by group."""

    def __init__(self, spark: SparkSession, database: str, name: str, root: str, buckets: int = 8):
        super().__init__(spark, database, name, root, GOLD[name], GOLD_LAYOUT[name], buckets)
        self.group, self.largest_first = GOLD_LAYOUT[name][1], GOLD_LARGEST_FIRST[name]

    def newest(self, count: int) -> DataFrame:
        """Rows of the newest months that hold ``count`` rows between them, or the whole report if all do not.

        Months are taken by doubling, and counted by their files' own counts.
        """
        if self.layout[0] != "month":
            raise ValueError(f"{self.name} is not laid out by time")
        months = sorted(self.partitions() - {None}, reverse=True)
        taken = 1
        while taken <= len(months):
            rows = self.read(months[:taken])
            if rows.count() >= count:
                return rows
            taken *= 2
        return self.read()

    def largest(self, count: int) -> DataFrame:
        """Rows that hold the ``count`` largest values of the column its files are sorted by, and those equal to the last.

        The ``count``-th of one partition bounds that of all from below. It becomes a filter, so of
        every other file only the head is read.
        """
        column = self.largest_first
        for partition in sorted(self.partitions(), key=str):
            head = self.read([partition]).where(F.col(column).isNotNull()).select(column).orderBy(F.desc(column)).limit(count)
            least = head.agg(F.count("*").alias("n"), F.min(column).alias("least")).first()
            if least["n"] == count:
                return self.read().where(F.col(column) >= F.lit(least["least"]))
        return self.read()

    def publish(self, rows: DataFrame) -> None:
        """Make ``rows`` the whole report."""
        self.overwrite_all(self.placed(rows.select(*self.schema.names)), self.partitions())

    def replace_groups(self, groups: DataFrame, rows: DataFrame) -> set:
        """Put ``rows`` in place of all rows of ``groups`` (one column, the report's first key); returns the partitions touched.

        Partitions without such a group are neither read nor written.
        """
        shaped = groups.select(*[F.col(f.name) if f.name == self.group else F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema])
        touched = self.in_use(self.placed(shaped))
        kept = self.read(touched).alias("kept").join(groups.alias("gone"), same("kept", "gone", [self.group]), "left_anti")
        self.overwrite_all(self.placed(kept.unionByName(rows.select(*self.schema.names))), touched)
        return touched
