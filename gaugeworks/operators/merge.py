"""Keyed merges and append-only logs (K1-K3, K5-K9)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugeworks.schemas import (
    MEASUREMENT_CALENDAR, MEASUREMENT_KEY, MEASUREMENT_VALUES, PHENOMENON_CALENDAR, PHENOMENON_VALUES,
)

#: Load order of rows that a table already holds: before every row of a load.
OLD = -1


def _pick(columns: list[str], order: str, pick: Callable[..., Column]) -> list[Column]:
    """Each value of the picked row (nulls included). Orders must differ within a key.

    Fixed-width values under a fixed-width order fit a hash aggregate; text goes through a sort aggregate.
    """
    return [pick(c, order).alias(c) for c in columns]


def keep_first(rows: DataFrame, key: list[str], values: list[str], order: str = "load_order") -> DataFrame:
    """First row per key in load order. Partial aggregation keeps a hot key cheap."""
    return rows.groupBy(*key).agg(*_pick(values, order, F.min_by)).select(*key, *values)


def upsert(
    rows: DataFrame, key: list[str], overwrite: list[str], keep: list[str], order: str = "load_order"
) -> DataFrame:
    """One row per key: ``overwrite`` from the last row (nulls included), ``keep`` from the first.

    Both picks are associative, so they combine map-side and can be applied again to merged rows.
    """
    picks = [*_pick(keep, order, F.min_by), *_pick(overwrite, order, F.max_by)]
    return rows.groupBy(*key).agg(*picks).select(*key, *keep, *overwrite)


def merge_gauges(rows: DataFrame, order: str = "load_order") -> DataFrame:
    return keep_first(rows, ["station_code"], ["station_name", "river_name"], order)


def merge_measurements(rows: DataFrame, order: str = "load_order") -> DataFrame:
    return upsert(rows, MEASUREMENT_KEY, MEASUREMENT_VALUES, MEASUREMENT_CALENDAR, order)


def merge_phenomena(rows: DataFrame, order: str = "load_order") -> DataFrame:
    return upsert(rows, MEASUREMENT_KEY, PHENOMENON_VALUES, PHENOMENON_CALENDAR, order)


def insert_absent(existing: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Existing rows win; ``new`` must hold one row per key."""
    return existing.unionByName(new.join(existing.select(*key), key, "left_anti"))


def replace_by_key(target: DataFrame, source: DataFrame, key: list[str]) -> DataFrame:
    """Source rows win; ``source`` must hold one row per key."""
    return target.join(source.select(*key), key, "left_anti").unionByName(source)


def number_rows(df: DataFrame, spread: str, order: list[str], start: int | Column = 0) -> DataFrame:
    """Consecutive ``id`` values from ``start + 1``, the same on every run.

    Rows are spread over 4096 buckets of a hash of ``spread``; ids run through the buckets in
    turn. Only the bucket counts (at most 4096 rows) meet in one task and are broadcast. ``df``
    is read twice, so pass a written or checkpointed frame when it is expensive.
    """
    bucket = F.conv(F.substring(F.md5(F.col(spread).cast("string")), 1, 3), 16, 10).cast("int")
    rows = df.withColumn("_bucket", bucket)
    counts = rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_count"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_bucket", F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_offset"))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order))
    first = start if isinstance(start, Column) else F.lit(start)
    return (
        rows.withColumn("_place", place)
        .join(F.broadcast(offsets), "_bucket")
        .select((first + F.col("_offset") + F.col("_place")).cast("bigint").alias("id"), *df.columns)
    )


def append_log(
    existing: DataFrame | None, new: DataFrame, spread: str, order: list[str]
) -> DataFrame:
    """New rows with ids above every existing id; the old rows are left as they are (K5)."""
    if existing is None:
        return number_rows(new, spread, order)
    top = existing.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    return number_rows(new, spread, order, top)


def latest_per_key(df: DataFrame, key: list[str], order: str = "id") -> DataFrame:
    """Row with the highest ``order`` per key in one pass."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("v")).select(
        *[F.col(c) if c in key else F.col(f"v.{c}").alias(c) for c in df.columns]
    )


def replace_export(
    target: DataFrame, target_flows: DataFrame, estimations: DataFrame, flows: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Replace all estimations of the given stations and attach their flows (K8).

    Old estimations of a station that has new ones go, and their flows with them. Flows without
    a fresh estimation are dropped.
    """
    key = ["station_code", "distribution", "method", "frequency"]
    stations = estimations.select("station_code").distinct()
    kept = target.join(stations, "station_code", "left_anti")
    kept_flows = target_flows.join(kept.select(F.col("id").alias("estimation_id")), "estimation_id", "left_semi")
    fresh = append_log(target, estimations, "station_code", key)
    values = ["return_period", "probability", "q_estimated_m3s"]
    matched = flows.join(fresh.select(F.col("id").alias("estimation_id"), *key), key).select(
        "estimation_id", *values
    )
    fresh_flows = append_log(target_flows, matched, "estimation_id", ["estimation_id", "return_period"])
    return (
        kept.unionByName(fresh.select(*kept.columns)),
        kept_flows.unionByName(fresh_flows.select(*kept_flows.columns)),
    )


def station_uuid(station_code: Column) -> Column:
    """Identifier fixed by the station code: re-running a job never changes it (K9). Null for a null code."""
    h = F.md5(station_code)
    return F.when(station_code.isNotNull(), F.concat_ws(
        "-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
        F.substring(h, 17, 4), F.substring(h, 21, 12),
    ))


def add_uuid(gauges: DataFrame) -> DataFrame:
    """Add the column where it is absent and fill gaps where it is present."""
    made = station_uuid(F.col("station_code"))
    if "uuid" in gauges.columns:
        made = F.coalesce(F.col("uuid"), made)
    return gauges.withColumn("uuid", made)
