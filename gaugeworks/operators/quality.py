"""Constraint reports (C1-C4): jobs that list violations instead of refusing rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Distinct foreign-key values without a parent, with how often they occur.

    The child is counted per value first, so a value that fills a third of the table is one
    row by the time it is joined.
    """
    values = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return values.join(keys, column, "left_anti")


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column_name, nulls`` for each column, one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "nulls")


def outside(df: DataFrame, column: str, allowed: tuple[int, ...]) -> DataFrame:
    """Rows whose value is not allowed; null passes a CHECK."""
    return df.filter(~F.col(column).isin(*allowed))


def report(
    name: str, df: DataFrame, constraints, parents: dict[str, DataFrame]
) -> DataFrame:
    """``table_name, check_name, violations`` for all declared constraints of one table, from one scan and one exchange of it.

    A row states its key and its foreign keys, and each null or value that is not allowed. Equal statements are counted, before
    the shuffle as far as they meet there, so a value that fills a third of the table is one row per task; distinct foreign keys then meet those of the parents.
    """
    key, foreign = "key " + ",".join(constraints.key), {c: t for c, t in sorted(constraints.foreign.items()) if t[0] in parents}

    def states(check: str, value: Column, holds: Column) -> Column:
        return F.when(holds, F.struct(F.lit(check).alias("check_name"), value.cast("string").alias("value")))

    facts = [states(key, F.to_json(F.struct(*constraints.key)), F.lit(True))]
    facts += [states(f"not null {c}", F.lit(None), F.col(c).isNull()) for c in constraints.not_null]
    facts += [states(f"foreign {c}", F.col(c), F.col(c).isNotNull()) for c in foreign]
    facts += [states(f"allowed {c}", F.lit(None), ~F.col(c).isin(*allowed)) for c, allowed in sorted(constraints.allowed.items())]
    counted = df.select(F.explode(F.array_compact(F.array(*facts))).alias("f")).groupBy("f.check_name", "f.value").agg(F.count(F.lit(1)).alias("rows"))
    for c, (table, parent_column) in foreign.items():
        known = parents[table].select(F.lit(f"foreign {c}").alias("check_name"), F.col(parent_column).cast("string").alias("value")).distinct()
        counted = counted.join(known, ["check_name", "value"], "left_anti")
    bad = F.when(F.col("check_name") == key, (F.col("rows") > 1).cast("bigint")).otherwise(F.col("rows"))
    found = counted.groupBy("check_name").agg(F.sum(bad).alias("violations"))
    checks = [key, *[f"not null {c}" for c in constraints.not_null], *[f"foreign {c}" for c in foreign], *[f"allowed {c}" for c in sorted(constraints.allowed)]]
    every = df.sparkSession.createDataFrame([(name, c) for c in checks], "table_name string, check_name string")
    return every.join(found, "check_name", "left").select("table_name", "check_name", F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations"))
