"""Whole-table reads from the source database, in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER = "org.postgresql.Driver"


def jdbc_options(url: str, table: str, user: str, password: str, fetch_rows: int = 50_000) -> dict[str, str]:
    return {
        "url": url, "dbtable": f"public.{table}", "user": user, "password": password,
        "driver": DRIVER, "fetchsize": str(fetch_rows),
    }


def block_ranges(blocks: int, parts: int) -> list[str]:
    """Predicates that split a table by physical block, so that no numeric key is needed.

    Together they cover every row once: the first range has no lower and the last no upper bound,
    so a table that has grown past ``blocks`` since they were counted is still read whole.
    """
    blocks = max(blocks, parts)  # of fewer blocks some ranges are empty, which costs nothing
    cuts = [blocks * i // parts for i in range(1, parts)]
    bounds = [None, *cuts, None]
    ranges = []
    for low, high in zip(bounds, bounds[1:]):
        tests = []
        if low is not None:
            tests.append(f"ctid >= '({low},0)'::tid")
        if high is not None:
            tests.append(f"ctid < '({high},0)'::tid")
        ranges.append(" AND ".join(tests) or "TRUE")
    return ranges


def block_count(spark: SparkSession, url: str, table: str, user: str, password: str) -> int:
    """Blocks of a table by the database's own file size, so that ranges fit each table."""
    asked = f"(SELECT pg_relation_size('public.{table}') / current_setting('block_size')::int AS n) AS blocks"
    options = {**jdbc_options(url, table, user, password), "dbtable": asked}
    return int(spark.read.format("jdbc").options(**options).load().first()[0])


def read_table(
    spark: SparkSession, url: str, table: str, user: str, password: str, blocks: int | None = None, parts: int = 1
) -> DataFrame:
    """One table, read by ``parts`` tasks over its ``blocks``, which are asked for where not given."""
    options = jdbc_options(url, table, user, password)
    if blocks is None:
        blocks = block_count(spark, url, table, user, password) if parts > 1 else 1
    properties = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(url, options["dbtable"], predicates=block_ranges(blocks, parts), properties=properties)
