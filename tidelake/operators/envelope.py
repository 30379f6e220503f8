"""From broker records to event-log rows, and from table rows to snapshot events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidelake.functions.decode import json_fields
from tidelake.schemas import ENVELOPE, EVENT

UNROUTED = "__unrouted__"
MALFORMED = "__malformed__"
# Six digits, which the defaults cut to three.
EXACT_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def parse_records(records: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """One row per record, in event-log columns, with ``source_table`` and ``ingest_date``.

    Records that are no change event (a NULL value or text that is not an envelope) keep a NULL
    ``_cdc_op``. On a stream, the default ingestion time is the time of the micro-batch, which the
    checkpoint keeps: a repeated batch gets the same time and so the same folders.
    """
    moment = F.current_timestamp() if ingested_at is None else ingested_at
    opened = records.select(
        "topic", "partition", "offset", moment.alias("_cdc_ingested_at"),
        F.col("value").isNull().alias("is_tombstone"), F.col("value").cast("string").alias("raw"),
        json_fields(F.col("value").cast("string"), ENVELOPE),
    )
    return opened.select(
        F.col("op").alias("_cdc_op"),
        F.col("source.ts_ms").alias("_cdc_source_ts_ms"),
        F.col("ts_ms").alias("_cdc_event_ts_ms"),
        "_cdc_ingested_at",
        F.col("topic").alias("_cdc_topic"),
        F.col("partition").cast("int").alias("_cdc_partition"),
        F.col("offset").cast("bigint").alias("_cdc_offset"),
        F.col("before").alias("before_json"),
        F.col("after").alias("after_json"),
        F.coalesce(F.col("source.table"), F.lit(UNROUTED)).alias("source_table"),
        F.to_date("_cdc_ingested_at").alias("ingest_date"),
        "is_tombstone", "raw",
    )


def record_kind(parsed: DataFrame) -> Column:
    """What became of a record: ``tombstone``, ``malformed``, ``unrouted`` or ``event``."""
    return (
        F.when(parsed["is_tombstone"], "tombstone")
        .when(parsed["_cdc_op"].isNull(), "malformed")
        .when(parsed["source_table"] == UNROUTED, "unrouted")
        .otherwise("event")
    )


def events_of(parsed: DataFrame) -> DataFrame:
    """The change events among parsed records."""
    return parsed.filter(F.col("_cdc_op").isNotNull()).drop("is_tombstone", "raw")


def log_rows(parsed: DataFrame) -> DataFrame:
    """What the log keeps: events, and malformed records under a table of their own, text and all.

    A malformed record has no operation; its text stands in the after-image. Only tombstones go,
    which repeat the delete before them.
    """
    broken = F.col("_cdc_op").isNull()
    return parsed.filter(~F.col("is_tombstone")).withColumns({
        "source_table": F.when(broken, MALFORMED).otherwise(F.col("source_table")),
        "after_json": F.when(broken, F.col("raw")).otherwise(F.col("after_json")),
    }).drop("is_tombstone", "raw")


def snapshot_events(rows: DataFrame, table: str, topic: str, loaded_at: Column) -> DataFrame:
    """Whole table rows as snapshot events: operation ``r``, the row as after-image, offset zero."""
    loaded_ms = F.unix_millis(loaded_at)
    image = F.to_json(F.struct(*[rows[c] for c in rows.columns]), EXACT_TIMES)
    values = dict(
        _cdc_op=F.lit("r"), _cdc_source_ts_ms=loaded_ms, _cdc_event_ts_ms=loaded_ms,
        _cdc_ingested_at=loaded_at, _cdc_topic=F.lit(topic), _cdc_partition=F.lit(0),
        _cdc_offset=F.lit(0), before_json=F.lit(None), after_json=image,
    )
    return rows.select(
        *[values[f.name].cast(f.dataType).alias(f.name) for f in EVENT],
        F.lit(table).alias("source_table"),
        F.to_date(loaded_at).alias("ingest_date"),
    )
