"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidelake.schemas import Entity


def latest_per_key(rows: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under ``order``.

    The rank is filtered to 1, so Spark drops all but one row per key in every map task before the
    exchange: a key with a large share of the rows sends one row per task and no more.
    """
    ranked = rows.withColumn("__rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.filter(F.col("__rank") == 1).drop("__rank")


def recency(alias: str | None = None) -> list[Column]:
    """What makes one event newer than another, most significant first.

    Commit time; at equal times a logged change beats a snapshot row, which has no log position;
    then the position in the log.
    """
    name = (lambda c: f"{alias}.{c}") if alias else (lambda c: c)
    return [
        F.col(name("_cdc_source_ts_ms")),
        F.col(name("_cdc_op")) != "r",
        F.col(name("_cdc_offset")),
    ]


def latest_change(rows: DataFrame, entity: Entity) -> DataFrame:
    """The newest event of each key; rows without a complete key are left out."""
    keyed = rows.dropna(subset=list(entity.key))
    return latest_per_key(keyed, entity.key, [part.desc_nulls_last() for part in recency()])
