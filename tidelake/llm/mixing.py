"""Sources mixed to target sizes by entropy balancing: tilted document rates, rounded into copies."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm.common import WORD_PATTERN, stored

CAP = 2
WEIGHTS = (3, 1, 2)
SHARE = 1.5
# Newton's iterations end when every source's words are this near its target, relatively.
NEAR = 1e-9
ROUNDS = 100
# Rows among which the last copies of equally long documents are dealt out, about.
BUCKET_ROWS = 16_384

_RATE = "least({cap}D, {share}D * exp(lam * size / mean_size))"


def n_words(text: Column) -> Column:
    """Words of a text; a null one has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, *, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``sizes`` (``source``, ``source_size``, one row each) with ``place`` (from 0 in code point order, null last), ``weight`` and ``target``.

    Sources take the weights in turn and share ``share`` of all sizes by them. None gets more
    than ``cap`` times its own size: the excess goes to the others by weight until all fit. That
    is the level t at which the lesser of cap and t times weight sums up to what is shared, and
    sources fill up in the order of cap by weight. One row per source passes one task.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    placed = sizes.withColumn("place", F.row_number().over(order) - 1).withColumn("limit", cap * F.col("source_size").cast("double"))
    of_place = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    filling = placed.withColumn("weight", of_place).withColumn("full_at", F.col("limit") / F.col("weight"))
    fills = Window.orderBy("full_at", "place")
    so_far, later = fills.rowsBetween(Window.unboundedPreceding, -1), fills.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy()).cast("double") * share
    level = (total - F.coalesce(F.sum("limit").over(so_far), F.lit(0.0))) / F.sum("weight").over(later)
    # A source is full if the level that the ones not yet full would share is not below its own.
    levels = filling.withColumn("level", level).withColumn("full", F.col("level") >= F.col("full_at"))
    reached = F.max(F.when(~F.col("full"), F.struct(-F.col("full_at"), -F.col("place"), "level"))).over(Window.partitionBy())["level"]
    target = F.when(F.col("full"), F.col("limit")).otherwise(F.col("weight") * reached)
    return levels.withColumn("target", F.least(target, "limit")).select("source", "place", "source_size", "weight", "target")


def mix(docs: DataFrame, *, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """Copies of every document, so that each source's words come to its target.

    Columns: ``doc_id``, ``source``, ``size`` (words), ``source_size``, ``target`` (of the
    source), ``rate``, ``copies`` (0 to ``cap``) and ``taken`` (copies times size). Sizes and targets:
    :func:`n_words`, :func:`source_targets`.

    Entropy balancing: of all rates r between 0 and ``cap`` that give a source its words, those
    nearest to ``share`` in relative entropy are r = min(cap, share exp(lam size / mean)), and the one
    multiplier ``lam`` per source is where the gradient of the convex dual vanishes. Newton's steps
    for all sources at once are sums over the table of (source, size, documents), kept in
    brackets by bisection. A source whose target is ``cap`` times its size takes everything that often.

    Rates become whole copies per size, carried over from size to size, and what a source then
    lacks or has too much is made up by copies of the sizes that fit. What stays is less than a
    document that could still be copied or left out; a source of one long document and few
    others can miss by more, as copies are whole. Documents of one size get equal copies and the
    remainder goes by hash of id and text, so that reruns agree.

    A null text has no words, and documents without words take none; a null source is one of its
    own; repeated rows and null ids are documents like others; other columns are ignored; no rows
    give no rows. What one task gathers is a row per size of a source: no more than the root of
    twice its words.
    """
    text = F.col("text").cast("string")
    rows = stored(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), n_words(text).alias("size"), F.xxhash64("doc_id", text).alias("hash")), "mix-rows")
    counted = rows.groupBy("source", "size").agg(F.count("*").alias("n"))
    sources = stored(source_targets(counted.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights=weights, share=share, cap=cap), "mix-sources")
    sized = stored(_joined(counted, sources.select("source", "place")).select("place", "size", "n"), "mix-sizes")
    tilted = sized.join(_multipliers(sized, sources, share, cap), "place")
    rate = F.when(F.col("size") == 0, F.lit(0.0)).when(F.col("full"), F.lit(float(cap))).otherwise(F.expr(_RATE.format(cap=cap, share=share)))
    rates = tilted.select("place", "size", "n", "target", rate.alias("rate"))
    whole = stored(rates.groupBy("place").applyInPandas(_rounder(cap), "place int, size bigint, n bigint, rate double, total bigint"), "mix-copies")
    placed = _joined(rows, sources).join(whole, ["place", "size"])
    dealt = _dealt(placed.select("doc_id", "source", "size", "source_size", "target", "rate", "place", "hash", "n", "total"))
    return dealt.select("doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _joined(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with what is known of their source, the null one included."""
    one, two = rows.alias("one"), sources.alias("two")
    return one.join(two, F.col("one.source").eqNullSafe(F.col("two.source"))).drop(F.col("two.source"))


def _multipliers(sized: DataFrame, sources: DataFrame, share: float, cap: float) -> DataFrame:
    """``place``, ``target``, ``mean_size``, ``full`` and the multiplier ``lam`` of every source."""
    means = sized.groupBy("place").agg((F.sum(F.col("size") * F.col("n")) / F.sum(F.when(F.col("size") > 0, F.col("n")))).alias("mean_size"))
    full = (F.col("source_size") == 0) | (F.col("target") >= cap * F.col("source_size") * (1 - NEAR))
    start = sources.join(means, "place").select("place", "target", F.coalesce("mean_size", F.lit(1.0)).alias("mean_size"), full.alias("full"), F.lit(0.0).alias("lam"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"))
    now = stored(start.withColumn("miss", F.lit(1.0)), "mix-newton")
    z, r = F.col("size") / F.col("mean_size"), F.expr(_RATE.format(cap=cap, share=share))
    for _ in range(ROUNDS):
        if now.where(~F.col("full") & (F.abs("miss") > NEAR)).isEmpty():
            break
        open_sizes = sized.where("size > 0").join(now.where("NOT full"), "place").withColumn("r", r).withColumn("z", z)
        # The dual's gradient and its second derivative; rates at the cap do not move.
        words = F.col("n") * F.col("size") * F.col("r")
        sums = open_sizes.groupBy("place").agg(_exact_sum(words).alias("words"), _exact_sum(F.when(F.col("r") < cap, words * F.col("z")).otherwise(0.0)).alias("slope"))
        met = now.join(sums, "place", "left").withColumn("miss", F.when(~F.col("full"), F.col("words") / F.col("target") - 1).otherwise(0.0))
        low = F.when(F.col("miss") < 0, F.col("lam")).otherwise(F.col("low"))
        high = F.when(F.col("miss") > 0, F.col("lam")).otherwise(F.col("high"))
        # The words grow like an exponential, so the step is Newton's for their logarithm.
        step = F.col("lam") + F.try_divide(F.log(F.try_divide("target", "words")) * F.col("words"), F.col("slope"))
        inside = (F.col("low").isNull() | (F.col("step") > F.col("low"))) & (F.col("high").isNull() | (F.col("step") < F.col("high"))) & ~F.isnan("step")
        halves = F.when(F.col("low").isNull(), F.col("high") - F.greatest(F.lit(1.0), F.abs("high"))).when(F.col("high").isNull(), F.col("low") + F.greatest(F.lit(1.0), F.abs("low"))).otherwise((F.col("low") + F.col("high")) / 2)
        bracketed = met.withColumn("low", low).withColumn("high", high).withColumn("step", step)
        moved = F.when(F.col("full") | (F.abs("miss") <= NEAR), F.col("lam")).when(inside, F.col("step")).otherwise(halves)
        now = stored(bracketed.withColumn("lam", moved).select(*now.columns), "mix-newton")
    return now.select("place", "target", "mean_size", "full", "lam")


def _exact_sum(value: Column) -> Column:
    """A sum in billionths: it does not depend on the order of the rows, so that reruns agree."""
    return F.sum(F.round(value * 1e9).cast("decimal(38,0)")).cast("double") / 1e9


def _rounder(cap: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size", ignore_index=True)
        total = whole_copies(rows["size"].to_numpy(), rows["n"].to_numpy(), rows["rate"].to_numpy(), float(rows["target"].iloc[0]), cap)
        return rows[["place", "size", "n", "rate"]].assign(total=total)

    return run


def whole_copies(size: np.ndarray, n: np.ndarray, rate: np.ndarray, target: float, cap: int) -> np.ndarray:
    """Copies of all documents of each size, between 0 and cap times n, whose words come to the target.

    Fractions are carried from size to size, so that neighbouring sizes make up for each other;
    then the largest sizes that fit what is lacking (or too much) are given (or taken) copies.
    Sizes rise.
    """
    wanted = np.cumsum(n * rate)
    total = np.clip(np.diff(np.floor(wanted + 0.5), prepend=0.0).astype(np.int64), 0, cap * n)
    total[size == 0] = 0
    lacking = _made_up(size, cap * n, total, round(target) - int((total * size).sum()))
    while lacking:
        # One copy more of a size and one less of another (or either alone), as near as there are.
        more = np.flatnonzero((total < cap * n) & (size > 0))
        less = np.flatnonzero((total > 0) & (size > 0))
        ups, downs = np.append(0, size[more]), np.append(0, size[less])  # 0: none
        at = np.searchsorted(downs, ups - lacking)
        tries = np.stack([np.clip(at - 1, 0, len(downs) - 1), np.clip(at, 0, len(downs) - 1)])
        left = np.abs(lacking - ups + downs[tries])
        side, up = np.unravel_index(left.argmin(), left.shape)
        if left[side, up] >= abs(lacking):
            break
        down = tries[side, up]
        total[more[up - 1 : up]] += 1
        total[less[down - 1 : down]] -= 1
        lacking = int(lacking - ups[up] + downs[down])
    return total


def _made_up(size: np.ndarray, most: np.ndarray, total: np.ndarray, lacking: int) -> int:
    """Give (or take) copies of the largest sizes that fit into what is lacking (or too much); what is left of it."""
    for k in np.argsort(-size, kind="stable"):
        if not lacking or not size[k]:
            break
        room = int(most[k] - total[k] if lacking > 0 else total[k])
        move = min(room, abs(lacking) // int(size[k])) * (1 if lacking > 0 else -1)
        total[k] += move
        lacking -= move * int(size[k])
    return lacking


def _dealt(rows: DataFrame) -> DataFrame:
    """``copies`` of each row: its size's total div n, and one more for the first rows in order of hash.

    Where they end is found by counts over ranges of the hash, then inside the one range. Rows
    alike at that very place are numbered within the tasks that hold them; which is which is the same.
    """
    group = ["place", "size"]
    over = F.col("total") % F.col("n")
    unsigned = F.shiftrightunsigned(F.col("hash"), 11) / F.lit(float(1 << 53))
    bucket = F.floor(unsigned * F.ceil(F.col("n") / F.lit(BUCKET_ROWS)))
    known = rows.withColumn("over", over).withColumn("unsigned", unsigned).withColumn("bucket", bucket)
    split = known.where("over > 0")
    by_bucket = split.groupBy(*group, "over", "bucket").agg(F.count("*").alias("m"))
    cut = _place_of(by_bucket, [*group, "over"], "bucket", "over").select(*group, "bucket", F.col("rest").alias("wanted"))
    by_hash = split.join(cut, [*group, "bucket"]).groupBy(*group, "wanted", "unsigned", "hash").agg(F.count("*").alias("m"))
    edge = stored(_place_of(by_hash, [*group, "wanted"], ["unsigned", "hash"], "wanted").select(*group, F.col("unsigned").alias("edge"), F.col("hash").alias("edge_hash"), "rest", "m"), "mix-edges")
    same = F.col("unsigned") == F.col("edge")
    ordered = (F.col("unsigned") < F.col("edge")) | (same & (F.col("hash") < F.col("edge_hash")))
    at_edge = same & (F.col("hash") == F.col("edge_hash"))
    extra = F.when(F.col("edge").isNull(), F.lit(0)).when(ordered | (at_edge & (F.col("rest") >= F.col("m"))), F.lit(1)).otherwise(F.lit(0))
    base = F.expr("total div n")
    met = known.join(edge, group, "left").withColumn("torn", F.coalesce(at_edge & (F.col("rest") < F.col("m")), F.lit(False)))
    if edge.where("rest < m").isEmpty():
        return met.withColumn("copies", base + extra)
    torn = stored(met.where("torn").withColumn("part", F.spark_partition_id()), "mix-torn")
    parts = torn.groupBy(*group, "part").agg(F.count("*").alias("held"))
    before = F.coalesce(F.sum("held").over(Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    number = F.row_number().over(Window.partitionBy(*group, "part").orderBy("hash"))
    numbered = torn.join(parts.select(*group, "part", before.alias("before")), [*group, "part"]).withColumn("number", number + F.col("before"))
    rest = met.where("NOT torn").withColumn("copies", base + extra)
    return rest.unionByName(numbered.withColumn("copies", base + (F.col("number") <= F.col("rest")).cast("int")).select(*rest.columns))


def _place_of(counts: DataFrame, group: list[str], order: str | list[str], wanted: str) -> DataFrame:
    """Of each group's rows in order the one at which the counts ``m`` reach ``wanted``, and the ``rest`` that is wanted of it."""
    keys = [order] if isinstance(order, str) else order
    upto = F.sum("m").over(Window.partitionBy(*group).orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0))
    placed = counts.withColumn("upto", upto).withColumn("rest", F.col(wanted) - (F.col("upto") - F.col("m")))
    return placed.where("rest > 0 AND rest <= m")
