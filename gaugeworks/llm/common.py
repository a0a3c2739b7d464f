"""What several operators share: reading, learnable rows, order over all rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeworks.session import cut_lineage


ROWS_PER_BATCH = 1000  # of whole texts; a batch is held several times over, by the engine and by Python


def bounded_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches for tables of texts, unless the session says otherwise."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":  # the engine's own choice
        spark.conf.set(name, str(ROWS_PER_BATCH))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def is_held_out(doc_id: Column, modulus: int, rest: int) -> Column:
    """Rows that a model never learns from; a null id counts as not held out."""
    return F.coalesce(remainder(doc_id, modulus) == rest, F.lit(False))


def may_learn(doc_id: Column, modulus: int, rest: int) -> Column:
    """Rows that a model may learn from; never a row with a null id."""
    return F.coalesce(remainder(doc_id, modulus) != rest, F.lit(False))


def hash_unit(text: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the text and the seed only."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), text).cast("binary")), 1, 13), 16, 10).cast("double") / float(2**52)


def bounded_sample(rows: DataFrame, label: str, key: str, max_rows: int, seed: str) -> DataFrame:
    """About ``max_rows`` rows, evenly over the labels as far as these have rows, chosen by a hash of the key.

    All rows stay while there are not more than ``max_rows``. Only counts reach the driver.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    if sum(counts.values()) <= max_rows:
        return rows
    room, share = max_rows, {}
    for i, (value, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], str(x[0])))):
        take = min(n, room // (len(counts) - i))
        room -= take
        share[value] = take / n
    wanted = reduce(lambda a, b: a | b, [
        (F.col(label) == F.lit(v)) & (hash_unit(F.col(key).cast("string"), seed) < F.lit(s)) for v, s in share.items()
    ])
    return rows.filter(wanted)


def running(rows: DataFrame, order: list, sums: dict[str, Column]) -> DataFrame:
    """Add the sums over all earlier rows of the order, and ``sums`` must be integers or null.

    Rows are cut into ranges of the order; sums within a range come from a window over that range,
    and one total per range is added up beforehand. No window spans the table. Rows that are equal in
    the order share a range, so give it keys that hardly repeat.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    valued = rows.withColumns({f"_v_{k}": F.coalesce(v.cast("long"), F.lit(0)) for k, v in sums.items()})
    ranged = cut_lineage(valued.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = ranged.groupBy("_range").agg(*[F.sum(f"_v_{k}").alias(f"_t_{k}") for k in sums]).select(
        "_range", *[F.coalesce(F.sum(f"_t_{k}").over(earlier), F.lit(0)).alias(f"_b_{k}") for k in sums])
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # one row per range: as many as there are shuffle partitions
    out = ranged.withColumns({f"_w_{k}": F.coalesce(F.sum(f"_v_{k}").over(within), F.lit(0)) for k in sums})
    out = out.join(F.broadcast(before), "_range")
    return out.select(*rows.columns, *[(F.col(f"_b_{k}") + F.col(f"_w_{k}")).alias(k) for k in sums])


def hot_keys(keyed: DataFrame, weight: str, least: int = 10_000) -> DataFrame | None:
    """Rows of ``keyed`` (one per key) whose ``weight`` is a thousandth of all and ``least`` or more: at most 1000 rows. None without any."""
    total = keyed.agg(F.sum(weight)).first()[0] or 0
    if total < least:
        return None
    hot = keyed.filter(F.col(weight) >= max(least, total // 1000))
    return None if hot.isEmpty() else hot


def join_hot(left: DataFrame, right: DataFrame, key: str, weight: str) -> DataFrame:
    """Inner join with ``right`` (one row per key, ``weight`` the rows of ``left`` that have it); rows of hot keys stay where they are."""
    hot = hot_keys(right, weight)
    if hot is None:
        return left.join(right, key)
    rest = left.join(F.broadcast(hot.select(key)), key, "left_anti").join(right, key)
    return left.join(F.broadcast(hot), key).unionByName(rest)


def range_buckets(rows: DataFrame, key: str, count: int) -> Column:
    """A bucket number that rises with the integer key, about even, null first; at most ``count`` and a few more.

    Bounds are up to 256 approximate quantiles, each part again cut in equal widths.
    """
    coarse = max(1, min(256, count))
    fine = -(-count // coarse)
    marks = rows.select(F.percentile_approx(F.col(key).cast("long"), [i / coarse for i in range(coarse + 1)], 20_000)).first()[0]
    if not marks:
        return F.lit(0)
    marks = sorted(set(marks))
    bounds = F.array(*[F.lit(m).cast("long") for m in marks])
    value = F.col(key).cast("long")
    part = F.size(F.filter(bounds, lambda b: b <= value))  # 0: below all bounds
    if fine == 1:
        return F.when(value.isNull(), F.lit(-1)).otherwise(part)
    low, high = F.element_at(bounds, F.greatest(part, F.lit(1))), F.element_at(bounds, F.least(part + 1, F.lit(len(marks))))
    inner = F.floor((value - low).cast("double") * fine / F.greatest(high - low, F.lit(1)).cast("double"))
    return F.when(value.isNull(), F.lit(-1)).otherwise(part * fine + F.least(F.greatest(inner, F.lit(0)), F.lit(fine - 1)).cast("int"))
