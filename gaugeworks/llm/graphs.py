"""Connected components by alternating stars, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.session import cut_lineage


def _least(pairs: DataFrame) -> DataFrame:
    """The least partner of each u, settled so that the joins on u may split a hub's rows."""
    return cut_lineage(pairs.groupBy("u").agg(F.min("v").alias("m")))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node`` and ``component`` (its least node) of every node of ``edges`` (long columns u, v; loops and repeats do no harm).

    Large and small stars by turns: each node hands its greater, then its smaller partners to its least
    one, until nothing changes; the count of rounds grows with the logarithm of the longest path. Hubs
    are pre-aggregated, and their rows may be split in the joins.
    """
    now = cut_lineage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    loops = now.filter("u = v").select(F.col("u").alias("node"), F.col("u").alias("component"))
    now, state = now.filter("u <> v"), None
    for _ in range(max_rounds):
        both = cut_lineage(now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        large = both.join(_least(both), "u").filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        large = cut_lineage(large.distinct())
        joined = large.join(_least(large), "u")
        now = cut_lineage(joined.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").union(joined.select("u", F.col("m").alias("v"))).distinct())
        found = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if found == state:
            break
        state = found
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component")))
    return stars.union(loops).groupBy("node").agg(F.min("component").alias("component"))
