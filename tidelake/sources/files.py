"""File sources: delimited exports of the shop tables, and change records kept as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidelake.schemas import ENTITIES, LOOKUPS, RECORD
from tidelake.sources.event_log import ANY_AGE
from tidelake.sources.storage import exists

# The file name of each table's export.
EXPORT_FILES = {
    "customers": "customers.csv",
    "sellers": "sellers.csv",
    "products": "products.csv",
    "orders": "orders.csv",
    "order_items": "order_items.csv",
    "order_payments": "order_payments.csv",
    "order_reviews": "order_reviews.csv",
    "geolocation": "geolocation.csv",
    "category_translations": "category_translations.csv",
}


def export_schema(table: str):
    return ENTITIES[table].source if table in ENTITIES else LOOKUPS[table]


# Tables with free text, where a quoted field may run over several lines. Such a file is read by one
# task, so large exports of these come as many files; all others are split freely.
FREE_TEXT = {"order_reviews"}
QUOTED_EMPTY = "\u0001"


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """An export with a header line; columns are taken by position under their declared names.

    An empty field is NULL, a quoted empty one is an empty text, and a doubled quote is a quote.
    """
    rows = spark.read.schema(export_schema(table)).csv(
        path, header=True, nullValue="", emptyValue=QUOTED_EMPTY, escape='"', multiLine=table in FREE_TEXT
    )
    return rows.select(
        *[
            F.when(F.col(f.name) == QUOTED_EMPTY, "").otherwise(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in rows.schema
        ]
    )


def load_csv(
    spark: SparkSession, folder: str, files: dict[str, str] = EXPORT_FILES
) -> dict[str, DataFrame]:
    """Every table whose export is in ``folder``; a missing file is skipped."""
    found = {}
    for table, name in files.items():
        path = f"{folder.rstrip('/')}/{name}"
        if exists(spark, path):
            found[table] = read_csv(spark, path, table)
    return found


def read_record_files(
    spark: SparkSession, path: str, max_files: int | None = None, skip_missing: bool = True
) -> DataFrame:
    """Change records from parquet files as a stream, in the broker's columns.

    All existing files are read first, whatever their age; ``max_files`` bounds each trigger;
    ``skip_missing`` passes over files removed since they were listed, else the stream stops there.
    """
    reader = spark.readStream.schema(RECORD).option("maxFileAge", ANY_AGE)
    reader = reader.option("ignoreMissingFiles", str(skip_missing).lower())
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
