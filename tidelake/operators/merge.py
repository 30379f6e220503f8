"""Upsert of staged changes into current-state rows, as one full outer join."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidelake.operators.latest import recency
from tidelake.schemas import Entity


def merge(
    target: DataFrame,
    staged: DataFrame,
    entity: Entity,
    late_guard: bool = True,
    delete_keeps_target: bool = False,
) -> DataFrame:
    """Current state after applying ``staged``, which has at most one row per key.

    A key only in ``target`` is carried over, a key only in ``staged`` is inserted (also a delete,
    as a row marked deleted), and a key in both takes the staged row: an update replaces all
    columns and revives a deleted row; a delete marks the row.

    ``late_guard`` keeps the target where the staged event is not newer, so batches may arrive in
    any order and more than once. ``delete_keeps_target`` leaves the business columns as they were
    on a delete instead of taking its before-image; the result then depends on how the log is cut
    into batches. Either way a delete also carries its log offset, which the guard compares.
    """
    old, new = target.alias("old"), staged.alias("new")
    joined = old.join(new, [F.col(f"old.{c}") == F.col(f"new.{c}") for c in entity.key], "full_outer")

    # is_deleted is never NULL in a row, so it tells which sides are present.
    has_old, has_new = F.col("old.is_deleted").isNotNull(), F.col("new.is_deleted").isNotNull()
    newer = F.struct(*recency("new")) > F.struct(*recency("old")) if late_guard else F.lit(True)
    takes_new = has_new & (~has_old | newer)
    keeps_business = has_old & F.col("new.is_deleted") if delete_keeps_target else F.lit(False)

    def pick(column: str):
        use = takes_new & ~keeps_business if column in entity.columns else takes_new
        return F.when(use, F.col(f"new.{column}")).otherwise(F.col(f"old.{column}")).alias(column)

    return joined.select(*[pick(f.name) for f in entity.state])


def insert_absent(target: DataFrame, staged: DataFrame, entity: Entity) -> DataFrame:
    """``target`` and those staged rows whose key it does not hold; existing rows stay as they are."""
    new_rows = staged.join(target.select(*entity.key), list(entity.key), "left_anti")
    return target.unionByName(new_rows.select(*target.columns))
