"""Table schemas, declared constraints and the seeded catalogues."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

GAUGES = "station_code string, station_name string, river_name string, lat double, lon double, uuid string"
MEASUREMENTS = (
    "station_code string, measured_at timestamp, hydro_year int, hydro_month int, "
    "calendar_month int, water_level_cm int, flow_m3s double, water_temp_c double"
)
PHENOMENA = (
    "station_code string, measured_at timestamp, hydro_year int, hydro_month int, "
    "ice_thickness_cm int, ice_phenomenon_code string, ice_phenomenon_pct int, overgrowth_code string"
)
STAT_COLUMNS = ["NQ", "SQ", "ZQ", "WQ", "NW", "SW", "ZW", "WW"]
ALLTIME_COLUMNS = ["NNQ", "WWQ", "SWQ", "SNQ", "SSQ"]
TEST_RESULTS = (
    "id bigint, series_type string, station_code string, test_id int, period_start int, "
    "period_end int, result_notes string, result boolean"
)
FITTED = (
    "id bigint, estimation_method_id int, distribution_id int, frequency_id int, "
    "distribution_params string, station_code string, source_timeseries_info string"
)
DISCHARGES = (
    "id bigint, station_code string, return_period int, distribution_id int, "
    "estimation_method_id int, frequency_id int, notes string"
)

MEASUREMENT_KEY = ["station_code", "measured_at"]
MEASUREMENT_VALUES = ["water_level_cm", "flow_m3s", "water_temp_c"]
MEASUREMENT_CALENDAR = ["hydro_year", "hydro_month", "calendar_month"]
PHENOMENON_VALUES = ["ice_thickness_cm", "ice_phenomenon_code", "ice_phenomenon_pct", "overgrowth_code"]
PHENOMENON_CALENDAR = ["hydro_year", "hydro_month"]

# Seeded catalogue rows.
STAT_TESTS = {
    1: "Grubbs-Beck test",
    2: "Kruskal-Wallis test",
    3: "Chi-square test",
    4: "Wald-Wolfowitz runs test",
    5: "Mann-Kendall test",
    6: "Spearman rank correlation test",
    7: "Lambda-Kolmogorov",
}
DISTRIBUTIONS = {
    1: "Gumbel", 2: "Log-Normal", 3: "Pearson III", 4: "Log-Pearson III", 5: "GEV", 6: "Weibull",
}
ESTIMATION_METHODS = {
    1: "Method of Moments", 2: "Maximum Likelihood", 3: "Linear Moments", 4: "Weighted Moments",
}
FREQUENCIES = {1: "annual", 2: "winter", 3: "summer"}
RETURN_PERIODS = (100, 1000)
MIN_YEARS = 30
ANNUAL, WINTER, SUMMER = 1, 2, 3


def catalogue(spark: SparkSession, rows: dict[int, str]) -> DataFrame:
    """A seeded catalogue as a literal table of at most seven rows."""
    return spark.createDataFrame(sorted(rows.items()), "id int, name string")


@dataclass(frozen=True)
class Constraints:
    """What the data-quality jobs check for one table."""

    key: list[str]
    not_null: list[str] = field(default_factory=list)
    foreign: dict[str, tuple[str, str]] = field(default_factory=dict)
    allowed: dict[str, tuple[int, ...]] = field(default_factory=dict)


CONSTRAINTS = {
    "gauges_list": Constraints(["station_code"]),
    "measurements": Constraints(MEASUREMENT_KEY, MEASUREMENT_KEY),
    "phenomena": Constraints(MEASUREMENT_KEY, MEASUREMENT_KEY),
    "stats_monthly": Constraints(
        ["station_code", "year", "month"], ["station_code", "year", "month", "mes_count"]),
    "stats_annual": Constraints(
        ["station_code", "hydro_year"], ["station_code", "hydro_year", "mes_count"]),
    "stats_seasonal": Constraints(
        ["station_code", "hydro_year", "season"],
        ["station_code", "hydro_year", "season", "mes_count"]),
    "stats_alltime": Constraints(["station_code"], ["mes_count"]),
    "stat_test_results": Constraints(
        ["id"], ["series_type", "station_code", "test_id", "result"],
        {"test_id": ("stat_tests", "id")}),
    "dist_test_results": Constraints(
        ["id"], ["fitted_distribution_id", "test_id", "result"],
        {"fitted_distribution_id": ("fitted_distributions", "id"), "test_id": ("stat_tests", "id")}),
    "fitted_distributions": Constraints(
        ["id"],
        ["estimation_method_id", "distribution_id", "frequency_id", "distribution_params",
         "station_code", "source_timeseries_info"],
        {"estimation_method_id": ("estimation_methods", "id"),
         "distribution_id": ("distributions", "id"), "frequency_id": ("frequencies", "id"),
         "station_code": ("gauges_list", "station_code")}),
    "estimated_discharges": Constraints(
        ["id"],
        ["station_code", "return_period", "distribution_id", "estimation_method_id", "frequency_id"],
        {"distribution_id": ("distributions", "id"),
         "estimation_method_id": ("estimation_methods", "id"),
         "frequency_id": ("frequencies", "id"), "station_code": ("gauges_list", "station_code")},
        {"return_period": RETURN_PERIODS}),
    "ci_estimates": Constraints(
        ["id"], ["fitted_distribution_id", "alpha", "n_bootstrap", "ci_data"],
        {"fitted_distribution_id": ("fitted_distributions", "id")}),
    "estimations": Constraints(
        ["station_code", "distribution", "method", "frequency"],
        ["station_code", "distribution", "method", "frequency"],
        {"station_code": ("stations", "station_code")}),
    "estimated_flows": Constraints(
        ["id"], ["estimation_id", "return_period", "probability"],
        {"estimation_id": ("estimations", "id")}),
}
