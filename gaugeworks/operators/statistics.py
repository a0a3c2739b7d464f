"""Characteristic values.

``measurements`` holds one row per station and day (see ``merge_measurements``), so a month has
at most 31 rows, a half-year 184 and a year 366. The exact median therefore never buffers more
than that, however many rows a station has in all. A table that breaks its key must go through
``merge_measurements`` first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.calendar import season_of, season_order
from gaugeworks.functions.rounding import round_half_away
from gaugeworks.schemas import MIN_YEARS, STAT_COLUMNS


def _eight_values() -> list[Column]:
    out = []
    for column, suffix in (("flow_m3s", "Q"), ("water_level_cm", "W")):
        for prefix, agg in (("N", F.min), ("S", F.avg), ("Z", F.median), ("W", F.max)):
            out.append(round_half_away(agg(column).cast("double")).alias(prefix + suffix))
    out.append(F.count(F.lit(1)).cast("int").alias("mes_count"))
    return out


def monthly(measurements: DataFrame) -> DataFrame:
    return measurements.groupBy(
        "station_code", F.year("measured_at").alias("year"), F.col("calendar_month").alias("month")
    ).agg(*_eight_values())


def annual(measurements: DataFrame) -> DataFrame:
    return measurements.filter("hydro_year is not null").groupBy("station_code", "hydro_year").agg(
        *_eight_values()
    )


def seasonal(measurements: DataFrame) -> DataFrame:
    return (
        measurements.filter("hydro_year is not null and hydro_month is not null")
        .groupBy("station_code", "hydro_year", season_of(F.col("hydro_month")).alias("season"))
        .agg(*_eight_values())
    )


#: Rows of ``periods``: one per station, grain and period.
PERIODS = (
    "station_code string, hydro_year int, year int, part int, " + ", ".join(f"{c} double" for c in STAT_COLUMNS) + ", mes_count int, grain string"
)


_PAIRS = (("flow_m3s", "Q"), ("water_level_cm", "W"))


def _median(ordered: Column) -> Column:
    """Exact median of a sorted array, null for an empty one."""
    n = F.size(ordered)
    at = lambda place: F.get(ordered, place.cast("int"))
    return at(F.floor((n - 1) / 2)) * 0.5 + at(F.floor(n / 2)) * 0.5


def periods(measurements: DataFrame) -> DataFrame:
    """Monthly, annual and seasonal statistics as one frame, from one scan and one exchange.

    Rows are dealt by station and hydrological year, which holds every month, half-year and year whole, since the time of a row fixes both.
    The same task gathers each month once; only the months then count for the three periods they belong to. ``part`` is the month, or the
    order of the season.
    """
    h, month = F.col("hydro_year"), F.col("hydro_month")
    half = F.when(h.isNotNull() & month.isNotNull(), season_order(season_of(month)))
    values = [F.col(c).cast("double").alias(x) for c, x in _PAIRS]
    rows = measurements.select("station_code", "hydro_year", F.year("measured_at").alias("year"), "calendar_month", half.alias("half"), *values)
    dealt = rows.repartition("station_code", "hydro_year")
    cells = dealt.groupBy("station_code", "hydro_year", "year", "calendar_month", "half").agg(
        F.count(F.lit(1)).alias("mes_count"),
        *[f(x).alias(k + x) for _, x in _PAIRS for k, f in (("N", F.min), ("W", F.max), ("T", F.sum), ("all", F.collect_list))])
    grain = lambda name, year, part: F.struct(F.lit(name).alias("grain"), year.cast("int").alias("year"), part.cast("int").alias("part"))
    season = F.when(F.col("half").isNotNull(), grain("seasonal", h, F.col("half")))
    year = F.when(h.isNotNull(), grain("annual", h, F.lit(0)))
    spread = cells.withColumn("g", F.explode(F.array_compact(F.array(grain("monthly", F.col("year"), F.col("calendar_month")), season, year))))
    sums = spread.groupBy("station_code", "hydro_year", F.col("g.grain").alias("grain"), F.col("g.year").alias("year"), F.col("g.part").alias("part")).agg(
        F.sum("mes_count").cast("int").alias("mes_count"),
        *[f(k + x).alias(k + x) for _, x in _PAIRS for k, f in (("N", F.min), ("W", F.max), ("T", F.sum), ("all", F.collect_list))])
    ordered = sums.withColumns({f"all{x}": F.sort_array(F.flatten(f"all{x}")) for _, x in _PAIRS})
    made = {}
    for _, x in _PAIRS:
        made |= {f"N{x}": F.col(f"N{x}"), f"S{x}": F.try_divide(F.col(f"T{x}"), F.size(f"all{x}")), f"Z{x}": _median(F.col(f"all{x}")), f"W{x}": F.col(f"W{x}")}
    return ordered.select("station_code", "hydro_year", "year", "part", *[round_half_away(made[c]).alias(c) for c in STAT_COLUMNS], "mes_count", "grain")


def of_grain(made: DataFrame, grain: str) -> DataFrame:
    """The rows of ``periods`` as the table of one grain."""
    names = {"monthly": [F.col("year"), F.col("part").alias("month")], "annual": [F.col("hydro_year")],
             "seasonal": [F.col("hydro_year"), F.when(F.col("part") == 0, "winter").otherwise("summer").alias("season")]}
    return made.filter(F.col("grain") == grain).select("station_code", *names[grain], *STAT_COLUMNS, "mes_count")


def _mean_of_rounded(c: str) -> Column:
    """Mean of two-decimal values through an exact decimal sum: no dependence on row order."""
    total = F.sum(F.col(c).cast("decimal(20,2)")).cast("double")
    return round_half_away(F.try_divide(total, F.count(c)))


def alltime(monthly_stats: DataFrame) -> DataFrame:
    """From the rounded monthly rows, never from the daily ones."""
    return monthly_stats.groupBy("station_code").agg(
        round_half_away(F.min("NQ")).alias("NNQ"),
        round_half_away(F.max("WQ")).alias("WWQ"),
        _mean_of_rounded("WQ").alias("SWQ"),
        _mean_of_rounded("NQ").alias("SNQ"),
        _mean_of_rounded("SQ").alias("SSQ"),
        F.count(F.lit(1)).cast("int").alias("mes_count"),
    )


def station_rows(df: DataFrame, station_code: str, *order: str) -> DataFrame:
    """Rows of one station in order; the equality reaches the file scan."""
    return df.filter(F.col("station_code") == station_code).orderBy(*order)


def station_seasons(seasonal_stats: DataFrame, station_code: str) -> DataFrame:
    """Seasons of one station, winter before summer (L2)."""
    return seasonal_stats.filter(F.col("station_code") == station_code).orderBy(
        "hydro_year", season_order(F.col("season"))
    )


def in_season_order(seasonal_stats: DataFrame) -> DataFrame:
    return seasonal_stats.orderBy("station_code", "hydro_year", season_order(F.col("season")))


def long_record_stations(gauges: DataFrame, series: DataFrame, min_count: int = MIN_YEARS) -> DataFrame:
    """Gauges with more than ``min_count`` non-null maxima, by name."""
    counts = series.filter("x is not null").groupBy("station_code").agg(F.count(F.lit(1)).alias("n"))
    return (
        gauges.join(counts.filter(F.col("n") > min_count), "station_code", "left_semi")
        .select("station_code", "station_name", "river_name")
        .orderBy("station_name", "station_code")
    )


def top_peak_flow(alltime_stats: DataFrame, gauges: DataFrame, k: int = 10) -> DataFrame:
    """The k stations with the highest peak flow, unknown peaks last.

    Ranked before the join: only k rows meet the gauge table.
    """
    known = alltime_stats.join(gauges.select("station_code"), "station_code", "left_semi")
    top = known.orderBy(F.desc_nulls_last("WWQ"), "station_code").limit(k)
    return (
        top.join(gauges, "station_code")
        .select("station_code", "station_name", "river_name", "NNQ", "SNQ", "SSQ", "SWQ", "WWQ")
        .orderBy(F.desc_nulls_last("WWQ"), "station_code")
    )


def ice_days(phenomena: DataFrame, gauges: DataFrame, k: int = 10) -> DataFrame:
    """The k named gauges with the most ice-event days.

    Days are counted per station before the join, so the join sees one row per station.
    """
    days = phenomena.filter("ice_phenomenon_code is not null").groupBy("station_code").agg(
        F.count(F.lit(1)).alias("days")
    )
    return (
        days.join(gauges, "station_code")
        .groupBy("station_name", "river_name").agg(F.sum("days").alias("ice_days"))
        .orderBy(F.desc("ice_days"), "station_name", "river_name").limit(k)
    )
