"""Data sets behind the probability plots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.functions.numeric import z_of_exceedance
from gaugeworks.functions.special import normal_quantile_udf
from gaugeworks.operators import series as srs
from gaugeworks.operators.frequency import curve_grid, quantiles

# Reference lines and axis ticks.
REFERENCE_LINES = {0.01: "p=1%\n(T=100)", 0.002: "p=0.2%\n(T=500)", 0.001: "p=0.1%\n(T=1000)"}
AXIS_TICKS = {
    0.001: "0.1%", 0.005: "0.5%", 0.01: "1%", 0.02: "2%", 0.05: "5%", 0.10: "10%", 0.20: "20%",
    0.50: "50%", 0.80: "80%", 0.90: "90%", 0.95: "95%", 0.99: "99%",
}


def theoretical_curves(fits: DataFrame, grid: list[float] | None = None) -> DataFrame:
    """Curve points of every fit; ``z`` is the axis position, the normal quantile of p."""
    rows = quantiles(fits, grid if grid is not None else curve_grid())
    return rows.select("station_code", "model", "p", (-F.col("z")).alias("z"), "q")


def empirical_points(series: DataFrame) -> DataFrame:
    """Observed values at their plotting positions (D3)."""
    return srs.hazen_positions(series).select("station_code", "t", "x", "m", "p").withColumn(
        "z", normal_quantile_udf(F.col("p"))
    )


def peak_labels(series: DataFrame) -> DataFrame:
    """Annotation of the largest value."""
    top = srs.peak(series)
    return top.withColumn("label", F.format_string("WWQ = %.0f m³/s\n(year %d)", "WWQ", "peak_t"))


def axis_marks(spark: SparkSession) -> DataFrame:
    """Reference lines and ticks with their axis position."""
    rows = [("line", p, -z_of_exceedance(p), label) for p, label in REFERENCE_LINES.items()]
    rows += [("tick", p, -z_of_exceedance(p), label) for p, label in AXIS_TICKS.items()]
    return spark.createDataFrame(rows, "kind string, p double, z double, label string")


def marks_on_curves(fits: DataFrame) -> DataFrame:
    """Flow of every fit at every reference line and tick."""
    grid = sorted({*REFERENCE_LINES, *AXIS_TICKS})
    rows = quantiles(fits, grid)
    marks = axis_marks(fits.sparkSession).select("kind", "p", "label")
    return rows.select("station_code", "model", "p", (-F.col("z")).alias("z"), "q").join(F.broadcast(marks), "p")


def station_bundles(gauges: DataFrame, series: DataFrame, latest: DataFrame, ci: DataFrame) -> DataFrame:
    """One row per gauge and latest fit with its band, or the reason there is no plot.

    ``latest`` comes from ``export.latest_fit``; ``ci`` has ``fitted_distribution_id``.
    """
    described = srs.describe(series)
    bands = ci.groupBy(F.col("fitted_distribution_id").alias("fitted_id")).agg(
        F.max_by("ci_data", "id").alias("ci_data")
    )
    df = described.join(gauges.select("station_code", "station_name", "river_name", "uuid"), "station_code", "full")
    df = df.join(latest, "station_code", "left").join(bands, "fitted_id", "left")
    reason = (
        F.when(F.col("n").isNull(), "no WQ data")
        .when(F.col("fitted_id").isNull(), "no fitted params")
        .when(F.col("uuid").isNull(), "not in gauges_list")
    )
    return df.select(
        "station_code", "station_name", "river_name", "uuid", "n", "year_start", "year_end",
        "fitted_id", "distribution", "method", "params", "ci_data", reason.alias("skip_reason"),
    )
