"""Export data sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.operators.merge import latest_per_key
from gaugeworks.schemas import DISTRIBUTIONS, ESTIMATION_METHODS, FREQUENCIES, catalogue

EXPORT_KEY = ["station_code", "distribution", "method", "frequency"]


def stations(gauges: DataFrame) -> DataFrame:
    return gauges.select(
        "station_code", "station_name", "river_name", "lat", "lon", F.col("uuid").cast("string").alias("uuid")
    ).orderBy("station_code")


def alltime(alltime_stats: DataFrame, gauges: DataFrame) -> DataFrame:
    """All-time rows of known stations."""
    return alltime_stats.join(gauges.select("station_code"), "station_code", "left_semi").orderBy("station_code")


def with_names(df: DataFrame) -> DataFrame:
    """Names for the three catalogue ids; each catalogue is a literal of a few rows."""
    for column, rows, name in (
        ("distribution_id", DISTRIBUTIONS, "distribution"),
        ("estimation_method_id", ESTIMATION_METHODS, "method"),
        ("frequency_id", FREQUENCIES, "frequency"),
    ):
        names = catalogue(df.sparkSession, rows).select(F.col("id").alias(column), F.col("name").alias(name))
        df = df.join(F.broadcast(names), column)
    return df


def estimations(fitted: DataFrame) -> DataFrame:
    """Latest fit per station, distribution, method and frequency, with its fields unpacked.

    Two parameters keep their own columns; ``params`` carries all of them, so that three-parameter
    fits are complete too.
    """
    key = ["station_code", "distribution_id", "estimation_method_id", "frequency_id"]
    df = with_names(latest_per_key(fitted, key))
    params, info = F.col("distribution_params"), F.col("source_timeseries_info")
    return df.select(
        *EXPORT_KEY,
        F.get_json_object(params, "$.mu_log").cast("double").alias("mu_log"),
        F.get_json_object(params, "$.sigma_log").cast("double").alias("sigma_log"),
        F.get_json_object(info, "$.n").cast("int").alias("n"),
        F.get_json_object(info, "$.year_start").cast("int").alias("year_start"),
        F.get_json_object(info, "$.year_end").cast("int").alias("year_end"),
        F.from_json(params, "map<string,double>").alias("params"),
    ).orderBy(*EXPORT_KEY)


def estimated_flows(discharges: DataFrame) -> DataFrame:
    """Latest flow per fit key and return period."""
    key = ["station_code", "distribution_id", "estimation_method_id", "frequency_id", "return_period"]
    df = with_names(latest_per_key(discharges, key))
    return df.select(
        *EXPORT_KEY, "return_period",
        (F.lit(1.0).cast("double") / F.col("return_period")).alias("probability"),
        F.get_json_object("notes", "$.Q_estimated_m3s").cast("double").alias("q_estimated_m3s"),
    ).orderBy(*EXPORT_KEY, "return_period")


def latest_fit(fitted: DataFrame, station_code: str | None = None, frequency_id: int = 1) -> DataFrame:
    """Latest fit per distribution and method with names, for one station or all."""
    chosen = fitted.filter(F.col("frequency_id") == frequency_id)
    if station_code is not None:
        chosen = chosen.filter(F.col("station_code") == station_code)
    key = ["station_code", "distribution_id", "estimation_method_id", "frequency_id"]
    return with_names(latest_per_key(chosen, key)).select(
        F.col("id").alias("fitted_id"), "station_code", "distribution_id", "distribution",
        "estimation_method_id", "method", F.from_json("distribution_params", "map<string,double>").alias("params"),
    )


def latest_ci(ci: DataFrame, fitted: DataFrame, frequency_id: int = 1) -> DataFrame:
    """Newest band of the newest fit of each station that has one."""
    fits = fitted.filter(F.col("frequency_id") == frequency_id).select(F.col("id").alias("fitted_distribution_id"), "station_code")
    rows = ci.select("id", "fitted_distribution_id", "alpha", "n_bootstrap", "ci_data").join(fits, "fitted_distribution_id")
    newest = latest_per_key(rows.withColumn("_order", F.struct("fitted_distribution_id", "id")), ["station_code"], "_order")
    return newest.drop("_order", "id")


def write_jdbc(df: DataFrame, url: str, table: str, batch: int = 500, **properties: str) -> None:
    """Send an export frame to a database with Spark's own writer, in parallel batches."""
    df.write.mode("append").option("batchsize", batch).jdbc(url, table, properties=properties)
