"""Typed current-state rows from the event log, driven by an entity's description."""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, functions as F

from tidelake.functions.decode import as_type, json_fields
from tidelake.schemas import Entity


def chosen_image() -> Column:
    """A delete only has the row as it was before; every other event has the row as it is after."""
    return F.when(F.col("_cdc_op") == "d", F.col("before_json")).otherwise(F.col("after_json"))


def extract(events: DataFrame, entity: Entity, updated_at: Column | None = None) -> DataFrame:
    """Events of one entity as typed rows with audit columns.

    The row image is parsed once for all columns. Images without a complete key stay in the result
    with a NULL key; ``latest_change`` leaves them out and ``reject_counts`` counts them.
    """
    moment = F.current_timestamp().cast("timestamp_ntz") if updated_at is None else updated_at
    opened = events.select(
        "_cdc_op", "_cdc_source_ts_ms", "_cdc_offset", moment.alias("_silver_updated_at"),
        json_fields(chosen_image(), entity.payload),
    )
    typed = [
        as_type(F.col(entity.source_field(name)), kind).alias(name)
        for name, kind in entity.columns.items()
    ]
    return opened.select(
        *typed, "_cdc_op", "_cdc_source_ts_ms", "_cdc_offset",
        (F.col("_cdc_op") == "d").alias("is_deleted"), "_silver_updated_at",
    )


def reject_counts(events: DataFrame, entity: Entity) -> DataFrame:
    """Events of one entity, those that cannot be merged for want of a key, and fields that hold
    something their type does not take and so become NULL."""
    opened = events.select(json_fields(chosen_image(), entity.payload))
    read = {name: as_type(F.col(entity.source_field(name)), kind) for name, kind in entity.columns.items()}
    lost = [(F.col(entity.source_field(name)).isNotNull() & value.isNull()).cast("int") for name, value in read.items()]
    no_key = reduce(or_, (read[name].isNull() for name in entity.key))
    return opened.agg(
        F.count("*").alias("events_read"), F.count_if(no_key).alias("incomplete_keys"),
        F.coalesce(F.sum(reduce(add, lost)), F.lit(0)).alias("undecoded_fields"),
    ).select(F.lit(entity.name).alias("table_name"), "events_read", "incomplete_keys", "undecoded_fields")
