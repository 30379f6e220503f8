"""Connected components of a table of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.common import stored


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """``node`` and ``root``, the smallest node it is linked with, for every node of ``links`` (``a``, ``b``).

    Alternating large-star and small-star rounds: every node points its larger, then its smaller
    neighbours at the smallest one it sees, until nothing changes. Each round's links go to the
    shared folder, so neither lineage nor driver memory grows. A node with very many links costs
    a sum per task for its minimum, and one skewed join side that adaptive execution can split.
    Null ends and loops are ignored; repeated links count once; no links give no rows.
    """
    links = links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v")
    now = stored(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), label)
    seen = None
    while True:
        both = now.union(now.select("v", "u"))
        large = stored(_pointed(both, F.col("u") < F.col("v")), label)
        small = stored(_pointed(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), F.lit(True)), label)
        # The links are a star around each root when two rounds leave the same set.
        state = small.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        now = small
        if state == seen:
            break
        seen = state
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _pointed(pairs: DataFrame, chosen) -> DataFrame:
    """Link every chosen neighbour ``v`` of ``u``, and ``u`` itself, to the smallest node among ``u`` and its neighbours."""
    least = pairs.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    ends = pairs.where(chosen).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return ends.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
