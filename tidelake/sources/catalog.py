"""Catalog entries: databases, declared tables, views under the names queries use."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, types as T

from tidelake.schemas import ENTITIES, EVENT, REQUIRED_IN_EVENT
from tidelake.sources.event_log import closed_root
from tidelake.sources.storage import first_text, has_files

# The column a partition transform is stored in. A value's folder has a column of its own, as
# folders cannot hold an empty text.
LAYOUT_COLUMN = {"month": "{}_month", "day": "{}_day", "bucket": "{}_bucket", "identity": "{}_folder"}
LAYOUT_TYPE = {"month": "DATE", "day": "DATE", "bucket": "INT", "identity": "STRING"}

_LOGGED = ", ".join([*EVENT.names, "ingest_date", "run_id", "CAST(batch_id AS BIGINT) AS batch_id"])


def _columns(schema: T.StructType, required: tuple[str, ...] = ()) -> list[str]:
    return [f"{f.name} {f.dataType.simpleString()}{' NOT NULL' if f.name in required else ''}" for f in schema]


def layout_column(layout: tuple[str, str]) -> str:
    kind, column = layout
    return LAYOUT_COLUMN[kind].format(column)


def event_table_ddl(database: str, table: str, location: str, required: tuple[str, ...]) -> str:
    columns = _columns(EVENT, required) + ["ingest_date DATE", "run_id STRING", "batch_id BIGINT"]
    return (
        f"CREATE TABLE IF NOT EXISTS {database}.{table} ({', '.join(columns)}) USING parquet "
        f"PARTITIONED BY (ingest_date, run_id, batch_id) LOCATION '{location}/source_table={table}'"
    )


def table_ddl(
    name: str, location: str, schema: T.StructType, layout: tuple[str, str], buckets: int, clustered: str | None = None, required: tuple[str, ...] = ()
) -> str:
    """A table partitioned by its layout's column, whose partitions are overwritten one by one."""
    folder = layout_column(layout)
    columns = [*_columns(schema, required), f"{folder} {LAYOUT_TYPE[layout[0]]}"]
    cluster = f"CLUSTERED BY ({clustered}) SORTED BY ({clustered}) INTO {buckets} BUCKETS " if clustered else ""
    return (
        f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}) USING parquet OPTIONS (partitionOverwriteMode 'dynamic') "
        f"PARTITIONED BY ({folder}) {cluster}LOCATION '{location}'"
    )


def declare_table(
    spark: SparkSession, database: str, name: str, location: str, schema: T.StructType, layout: tuple[str, str], buckets: int, clustered: str | None = None
) -> str:
    """The full name of a table over ``location``. An entry of that name over another place gives way; its files stay.

    Its partitions are its folders, so none is registered, and files another session wrote are seen.
    """
    full = f"{database}.{name}"
    if spark.catalog.tableExists(full):
        described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {full}").collect()}
        place = described.get("Location", "")
        if described.get("Type") != "VIEW" and place.removeprefix("file:").rstrip("/") == location.removeprefix("file:").rstrip("/"):
            return full
        spark.sql(f"DROP {'VIEW' if described.get('Type') == 'VIEW' else 'TABLE'} {full}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(table_ddl(full, location, schema, layout, buckets, clustered))
    return full


def bucket_count(spark: SparkSession, root: str, wanted: int) -> int:
    """The number of buckets that tables below ``root`` are made with: the first one ever asked for.

    Files carry their bucket's number, so another count would misread them.
    """
    return int(first_text(spark, f"{root}/_buckets", str(wanted)))


def _tables_in(spark: SparkSession, database: str) -> list[str]:
    return [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]


def create_event_tables(spark: SparkSession, location: str, database: str = "bronze") -> list[str]:
    """One external table per entity over its folder of the event log."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table in ENTITIES:
        spark.sql(event_table_ddl(database, table, location, REQUIRED_IN_EVENT))
    return _tables_in(spark, database)


def create_state_tables(spark: SparkSession, location: str, database: str = "silver", buckets: int = 8, recreate: bool = False) -> list[str]:
    """Declared current-state tables over their folders; ``recreate`` drops the entries first so that schema changes apply."""
    buckets = bucket_count(spark, location, buckets)
    for entity in ENTITIES.values():
        if recreate:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{entity.name}")
        declare_table(spark, database, entity.name, f"{location}/{entity.name}", entity.state, entity.layout, buckets, entity.clustered)
    return _tables_in(spark, database)


def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> list[str]:
    """Make tables usable in SQL text under ``prefix`` and their name."""
    for name, rows in tables.items():
        rows.createOrReplaceTempView(f"{prefix}{name}")
    return [f"{prefix}{name}" for name in tables]


def name_log(spark: SparkSession, log_root: str, database: str = "bronze") -> list[str]:
    """Names for the log's folders. A view over a folder sees what was appended since, no partition
    needs to be registered. Closed days are in it; a batch that is in both places counts once."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    named = []
    for table in ENTITIES:
        texts = [f"{root}/source_table={table}" for root in (log_root, closed_root(log_root))]
        news, old = (f"SELECT {_LOGGED} FROM parquet.`{t}`" if has_files(spark, t) else None for t in texts)
        if news and old:
            old = f"SELECT c.* FROM ({old}) c LEFT ANTI JOIN (SELECT DISTINCT ingest_date, run_id, CAST(batch_id AS BIGINT) AS batch_id FROM parquet.`{texts[0]}`) o USING (ingest_date, run_id, batch_id)"
            old = f"SELECT {_LOGGED} FROM ({old})"  # USING puts its columns first
        if news or old:
            _view(spark, database, table, " UNION ALL ".join(x for x in (news, old) if x))
            named.append(table)
    return named


def _view(spark: SparkSession, database: str, name: str, text: str) -> None:
    # A declared table of that name gives way to the view, which has the data.
    if any(t.name == name and t.tableType != "VIEW" for t in spark.catalog.listTables(database)):
        spark.sql(f"DROP TABLE {database}.{name}")
    spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {text}")
