"""Shards of near-equal size that keep linked documents together, by balanced label propagation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm.common import stored

ROUNDS = 8
# Rows of a bucket in which ranks are taken at most, about.
BUCKET_ROWS = 20_000


def shard(docs: DataFrame, shards: int = 8, *, rounds: int = ROUNDS) -> DataFrame:
    """A shard and a slot for every row, equal texts together as far as room allows.

    Columns: ``doc_id``, ``size`` (UTF-8 bytes and 1), ``text_crc32``, ``shard``, ``slot`` (gapless
    from 0 in its shard). Law ``rows``: the shards' row counts differ by one at most.

    Rows of one text are neighbours. All start at a shard by hash; in each round a row wants the
    shard where most of its neighbours are, and for every pair of shards as many rows move as
    want the other way or fit under the quota. Rounds end when nothing moves or no fewer links
    are cut. Rows without neighbours then fill what is left of each shard, and the shards'
    ends are cut at exact ranks, where only such rows stand. A group larger than a shard is cut.

    A null text has size 1 and counts as the empty text; null doc_ids and repeated rows are rows
    like others; other columns are ignored; no rows give no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("group"))
    rows = stored(rows, "shard-rows")
    total = rows.count()
    sizes = rows.groupBy("group", "text_crc32", "size").agg(F.count("*").alias("members"))
    links = stored(rows.join(sizes.where("members > 1"), ["group", "text_crc32", "size"]), "shard-links")
    alone = rows.join(sizes.where("members > 1"), ["group", "text_crc32", "size"], "left_anti").withColumn("members", F.lit(1).cast("bigint"))
    placed, loads = _propagate(links, total, shards, rounds)
    filled = alone.withColumn("shard", _by_room(loads, total, shards))
    return _cut(placed.unionByName(filled), total, shards)


def _share(*columns) -> Column:
    """A number from 0 to 1 that is a hash of the columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / F.lit(float(1 << 30))


def _propagate(links: DataFrame, total: int, shards: int, rounds: int) -> tuple[DataFrame, dict[int, int]]:
    """Rows that have neighbours, with their shards, and how many each shard holds."""
    quota = -(-total // shards)
    # A small group moves as one, a large one row by row, so that no move overshoots its quota.
    whole = F.col("members") <= max(1, quota // 100)
    pick = F.when(whole, F.col("group")).otherwise(F.xxhash64("doc_id", "group", F.lit(3)))
    now = stored(links.withColumn("pick", pick).withColumn("shard", F.pmod(F.xxhash64("doc_id", "group"), F.lit(shards)).cast("int")), "shard-labels")
    last_kept = -1
    for turn in range(rounds):
        at = now.groupBy("group", "shard").agg(F.count("*").alias("n"))
        best = at.groupBy("group").agg(F.max_by("shard", F.struct("n", F.xxhash64("group", "shard"))).alias("want"))
        wants = now.join(best, "group")
        flows = wants.groupBy("shard", "want").agg(F.count("*").alias("n")).collect()  # shards squared at most
        demand = {(r["shard"], r["want"]): r["n"] for r in flows}
        kept = sum(n for (s, t), n in demand.items() if s == t)
        if kept <= last_kept or not any(s != t for s, t in demand):
            break
        last_kept = kept
        chance = quotas(demand, quota, shards)
        goes = F.lit(0.0)
        for (s, t), p in chance.items():
            goes = F.when((F.col("shard") == s) & (F.col("want") == t), F.lit(p)).otherwise(goes)
        moved = F.when(_share("pick", F.lit(turn)) < goes, F.col("want")).otherwise(F.col("shard"))
        now = stored(wants.withColumn("shard", moved).drop("want"), "shard-labels")
    loads = {r["shard"]: r["n"] for r in now.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    return now.drop("pick"), loads


def quotas(demand: dict[tuple[int, int], int], quota: int, shards: int) -> dict[tuple[int, int], float]:
    """The share of each wish s -> t that may go: its swaps with t -> s, and its part of t's room."""
    load = {k: sum(n for (s, _), n in demand.items() if s == k) for k in range(shards)}
    swaps = {(s, t): min(n, demand.get((t, s), 0)) for (s, t), n in demand.items() if s != t}
    left = {x: demand[x] - n for x, n in swaps.items()}
    out = {}
    for (s, t), n in swaps.items():
        waiting = sum(m for (_, to), m in left.items() if to == t)
        room = max(0, quota - load[t])
        out[s, t] = (n + (left[s, t] * min(1.0, room / waiting) if waiting else 0)) / demand[s, t]
    return out


def _by_room(loads: dict[int, int], total: int, shards: int) -> Column:
    """Shards by hash, in proportion to the room that each has left."""
    room = [max(0.0, total / shards - loads.get(k, 0)) for k in range(shards)]
    room = room if sum(room) else [1.0] * shards
    at = _share("doc_id", "group", F.lit(5))
    out, upper = F.lit(shards - 1), 1.0
    for k in range(shards - 1, 0, -1):
        upper -= room[k] / sum(room)
        out = F.when(at < upper, F.lit(k - 1)).otherwise(out)
    return out.cast("int")


def _cut(rows: DataFrame, total: int, shards: int) -> DataFrame:
    """Exact ranks in the order shard, lone rows, groups, lone rows; the rank gives shard and slot.

    Ranks are counted in buckets of bounded size. A group is in one bucket unless it is larger
    than that; its rows, even if all alike, are then dealt out, and that is stored before use.
    Bucket counts are summed up, one row each.
    """
    buckets = max(1, -(-total // (BUCKET_ROWS * shards)))
    lone = F.when(_share("doc_id", "group", F.lit(7)) < 0.5, F.lit(0)).otherwise(F.lit(2))
    tier = F.when(F.col("members") > 1, F.lit(1)).otherwise(lone)
    salts = F.ceil(F.col("members") / F.lit(BUCKET_ROWS)).cast("bigint")
    salt = F.when(salts > 1, F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), salts)).otherwise(F.lit(-1))
    # a group that needs several buckets has them to itself
    bucket = F.when(salts > 1, F.col("group")).otherwise(F.pmod(F.xxhash64("group", F.when(F.col("members") == 1, F.col("doc_id"))), F.lit(buckets)))
    key = ["shard", "tier", "bucket", "salt"]
    rows = stored(rows.withColumn("tier", tier).withColumn("salt", salt).withColumn("bucket", bucket), "shard-order")
    counts = rows.groupBy(*key).agg(F.count("*").alias("n"))
    before = Window.orderBy(*key).rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(*key, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy(*key).orderBy("group", "doc_id", "text_crc32", "size")) - 1
    ranked = rows.join(bases, key).withColumn("rank", inside + F.col("base"))
    # shard k holds the ranks from ceil(k total / shards) on
    numbered = ranked.withColumn("shard", F.expr(f"cast((rank * {shards}) div {max(1, total)} as int)"))
    slot = F.expr(f"rank - (shard * {total}L + {shards - 1}) div {shards}")
    return numbered.select("doc_id", "size", "text_crc32", "shard", slot.alias("slot"))
