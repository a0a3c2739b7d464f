"""Mixing sources to target weights.

Tokens are added up per source, weights give each source a target, and a document is emitted
floor(rate) times plus once more with the probability of the fraction, drawn from a hash of its id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import hash_unit, running

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per source with its size and target, from columns ``source`` and ``size``.

    Sources in code-point order, null last, take the weights in turn. The sum of all sizes times
    ``share`` is dealt by weight; no target exceeds ``most`` times its source's size, what is above is
    dealt again by weight. A source reaches its limit exactly if the level over the sources that reach
    theirs later does, so one pass in the order of limit over weight settles all of them.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = running(sizes, [F.col("source").asc_nulls_last()], {"place": F.lit(1)})
    turn = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("place") % len(weights)).cast("int") + 1)
    placed = placed.withColumn("weight", turn)
    filled = running(placed, [F.col("source_size") / F.col("weight"), F.col("place")], {"size_before": F.col("source_size"), "weight_before": F.col("weight")})
    total = filled.agg(F.sum("source_size").alias("all_size"), F.sum("weight").alias("all_weight"))
    level = filled.crossJoin(F.broadcast(total)).withColumn(  # one row of totals
        "full", F.col("weight") * (F.lit(share) * F.col("all_size") - F.lit(most) * F.col("size_before"))
        >= F.lit(most) * F.col("source_size") * (F.col("all_weight") - F.col("weight_before")))
    rest = level.agg(
        F.coalesce(F.sum(F.when(F.col("full"), F.col("source_size"))), F.lit(0)).alias("full_size"),
        F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))), F.lit(0)).alias("open_weight"))
    target = F.when(F.col("full"), F.lit(most) * F.col("source_size")).otherwise(
        F.col("weight") * (F.lit(share) * F.col("all_size") - F.lit(most) * F.col("full_size")) / F.col("open_weight"))
    return level.crossJoin(F.broadcast(rest)).select("source", "source_size", "weight", target.cast("double").alias("target"))


def mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: str = "mix") -> DataFrame:
    """Documents with ``size``, ``source_size``, ``target``, ``copies`` and ``taken``; columns of these names are replaced.

    Needs ``doc_id``, ``text`` and ``source``. Null text has size 0; null source is a source of its own, the
    last; rows with the same id (or a null id) get the same draw; repeated rows count each. A source
    without words has target 0 and copies 0. An empty table gives an empty table.
    """
    added = ["size", "source_size", "weight", "target", "copies", "taken", "_source"]
    sized = docs.drop(*added).withColumn("size", word_count(F.col("text")))
    plan = source_targets(sized.select("source", "size"), weights, share, most).withColumnRenamed("source", "_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    draw = hash_unit(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), seed)
    copies = F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)
    out = sized.join(plan, sized["source"].eqNullSafe(plan["_source"])).drop("_source", "weight")
    return out.withColumn("copies", copies.cast("long")).withColumn("taken", F.col("size") * F.col("copies"))


def emit(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixed.select(*columns, F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("_copy")).drop("_copy")
