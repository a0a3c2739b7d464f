"""Every operator as a query over the driver's tables: ``name -> f(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.functions import calendar as cal
from gaugeworks.functions import text
from gaugeworks.operators import bootstrap, cleaning, export, frequency, goodness, hypothesis, merge, quality
from gaugeworks.operators import series as srs
from gaugeworks.operators import statistics as st
from gaugeworks.plans import adapters as ad
from gaugeworks.plans import jobs, plots
from gaugeworks.schemas import DISTRIBUTIONS, ESTIMATION_METHODS, FREQUENCIES, STAT_TESTS, catalogue
from gaugeworks.session import configure, cut_lineage, scratch_path
from gaugeworks.sources import tables
from gaugeworks.sources import observations as obs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MIN_COUNT = 20  # series of the driver's tables are shorter than thirty years
SAMPLES = 100  # resamples that SQL redoes
CURVE_GRID = [0.0005, 0.01, 0.2, 0.5, 0.8, 0.9995]
_TIME = "yyyy-MM-dd HH:mm:ss"


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _r(*names: str, digits: int = 6) -> list[Column]:
    return [F.round(n, digits).alias(n) for n in names]


def _clock(df: DataFrame) -> DataFrame:
    return df.withColumn("measured_at", F.date_format("measured_at", _TIME))


def _measurements(spark: SparkSession, sf: str) -> DataFrame:
    return merge.merge_measurements(ad.measurement_rows(spark, sf))


def _series(spark: SparkSession, sf: str) -> DataFrame:
    """All series, computed once for queries that use them several times."""
    return cut_lineage(ad.all_series(spark, sf))


def _phenomena(spark: SparkSession, sf: str) -> DataFrame:
    return merge.merge_phenomena(ad.phenomenon_rows(spark, sf))


# ---- statistics -------------------------------------------------------------------------------

@query
def stats_annual(spark: SparkSession, sf: str) -> DataFrame:
    return st.annual(_measurements(spark, sf))


@query
def stats_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return st.monthly(_measurements(spark, sf))


@query
def stats_seasonal(spark: SparkSession, sf: str) -> DataFrame:
    return st.seasonal(_measurements(spark, sf))


@query
def stats_alltime(spark: SparkSession, sf: str) -> DataFrame:
    return st.alltime(st.monthly(_measurements(spark, sf)))


@query
def rebuild_stats(spark: SparkSession, sf: str) -> DataFrame:
    configure(spark)
    root = scratch_path(spark, "rebuild")
    return tables.rebuild(st.annual(_measurements(spark, sf)), root, "stats_annual", ["hydro_year"])


@query
def seasonal_sorted(spark: SparkSession, sf: str) -> DataFrame:
    """Season rows with their place in season order."""
    rows = st.in_season_order(st.seasonal(_measurements(spark, sf)))
    return rows.select("station_code", "hydro_year", "season", cal.season_order(F.col("season")).alias("place"), "WQ")


@query
def station_daily(spark: SparkSession, sf: str) -> DataFrame:
    return _clock(st.station_rows(_measurements(spark, sf), "7", "measured_at"))


@query
def station_ice(spark: SparkSession, sf: str) -> DataFrame:
    return _clock(st.station_rows(_phenomena(spark, sf), "7", "measured_at"))


@query
def station_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return st.station_rows(st.monthly(_measurements(spark, sf)), "7", "year", "month")


@query
def station_seasons(spark: SparkSession, sf: str) -> DataFrame:
    return st.station_seasons(st.seasonal(_measurements(spark, sf)), "7")


@query
def stations_min_years(spark: SparkSession, sf: str) -> DataFrame:
    series = _series(spark, sf)
    return st.long_record_stations(ad.series_gauges(series), series)


@query
def top_peak_flow(spark: SparkSession, sf: str) -> DataFrame:
    alltime = st.alltime(st.monthly(_measurements(spark, sf)))
    return st.top_peak_flow(alltime, ad.gauges(spark, sf))


@query
def ice_days(spark: SparkSession, sf: str) -> DataFrame:
    return st.ice_days(_phenomena(spark, sf), ad.gauges(spark, sf))


@query
def series_descriptor(spark: SparkSession, sf: str) -> DataFrame:
    return srs.describe(ad.all_series(spark, sf))


@query
def annual_maxima(spark: SparkSession, sf: str) -> DataFrame:
    return srs.annual_maxima(st.annual(_measurements(spark, sf)))


@query
def winter_maxima(spark: SparkSession, sf: str) -> DataFrame:
    return srs.seasonal_maxima(st.seasonal(_measurements(spark, sf)), "winter")


@query
def table_counts(spark: SparkSession, sf: str) -> DataFrame:
    return tables.row_counts({
        "gauges_list": ad.gauges(spark, sf), "measurements": _measurements(spark, sf),
        "phenomena": _phenomena(spark, sf),
    })


@query
def sql_view(spark: SparkSession, sf: str) -> DataFrame:
    tables.register(ad.gauges(spark, sf), "gw_gauges")
    tables.register(_phenomena(spark, sf), "gw_phenomena")
    return spark.sql(
        "select g.river_name, count(*) as days, max(p.ice_thickness_cm) as thickest "
        "from gw_phenomena p join gw_gauges g using (station_code) group by g.river_name"
    )


@query
def refresh_set(spark: SparkSession, sf: str) -> DataFrame:
    return ad.all_series(spark, sf).select("station_code").distinct()


# ---- sources, cleaning, merging ---------------------------------------------------------------

def _codz_lines(spark: SparkSession, sf: str, encoded: bool = True, ordered: bool = False) -> DataFrame:
    """Text lines with over-long, short and blank lines among them, and the place of each.

    Those in order are ordered before they are made, so the sort samples and moves the few columns they are made of.
    """
    rows = ad.load(spark, sf, "lineitem")
    rows = (rows.orderBy(F.expr(ad.LINE_ORDER)) if ordered else rows).selectExpr(*ad.columns(ad.RAW_CODZ), "l_partkey", f"{ad.LINE_ORDER} as place")
    if encoded:
        rows = rows.withColumn("station_name", text.encode_cp1250(F.col("station_name")))
    line = F.concat_ws(",", *[F.col(c) for c in obs.CODZ_FIELDS])
    short = F.concat_ws(",", *[F.col(c) for c in obs.CODZ_FIELDS[:8]])
    return rows.select(
        F.when(F.expr("l_partkey % 211 = 0"), F.concat(line, F.lit(",EXTRA")))
        .when(F.expr("l_partkey % 223 = 0"), short).when(F.expr("l_partkey % 227 = 0"), "")
        .otherwise(line).alias("line"), "place",
    )


def _part_lines(spark: SparkSession, sf: str, part: str) -> DataFrame:
    """Lines of a part of the line items in their order."""
    rows = ad.load(spark, sf, "lineitem").filter(part).orderBy(F.expr(ad.LINE_ORDER)).selectExpr(*ad.columns(ad.RAW_CODZ))
    rows = rows.withColumn("station_name", text.encode_cp1250(F.col("station_name")))
    return rows.select(F.concat_ws(",", *obs.CODZ_FIELDS).alias("line"))


def _codz_files(spark: SparkSession, sf: str) -> str:
    configure(spark)
    path = scratch_path(spark, "codz")
    obs.write_lines(_codz_lines(spark, sf), path)
    return path


def _typed(df: DataFrame, values: list[str]) -> DataFrame:
    rows = df.filter("reject_reason is null").select(
        "station_code", "station_name", "river_name", "measured_at", "hydro_year", "hydro_month", *values
    )
    return _clock(rows)


_CODZ_VALUES = ["calendar_month", "water_level_cm", "flow_m3s", "water_temp_c"]
_ZJAW_VALUES = ["ice_thickness_cm", "ice_phenomenon_code", "ice_phenomenon_pct", "overgrowth_code"]


@query
def scan_codz(spark: SparkSession, sf: str) -> DataFrame:
    rows = obs.scan_codz(spark, _codz_files(spark, sf), glob="part-*")
    return _typed(cleaning.type_codz(rows), _CODZ_VALUES)


@query
def scan_zjaw(spark: SparkSession, sf: str) -> DataFrame:
    rows = ad.raw_rows(spark, sf, ad.RAW_ZJAW).withColumn("station_name", text.encode_cp1250(F.col("station_name")))
    path = scratch_path(spark, "zjaw")
    obs.write_lines(rows.select(F.concat_ws(",", *obs.ZJAW_FIELDS).alias("line")), path)
    return _typed(cleaning.type_zjaw(obs.scan_zjaw(spark, path, glob="part-*")), _ZJAW_VALUES)


@query
def load_twice(spark: SparkSession, sf: str) -> DataFrame:
    """The load job on two parts of the line items that share a third; the second meets what the first has written."""
    work, out = scratch_path(spark, "loads"), {}
    for load, part in enumerate(("l_orderkey % 3 <> 0", "l_orderkey % 3 <> 1")):
        obs.write_lines(_part_lines(spark, sf, part), f"{work}/in-{load}")  # files in order
        out = jobs.load_observations(spark, f"{work}/in-{load}", f"{work}/tables", globs=("part-*", "none-*"))
    return _clock(out["measurements"].join(out["gauges_list"].select("station_code", "station_name", "river_name"), "station_code"))


@query
def scan_first_files(spark: SparkSession, sf: str) -> DataFrame:
    rows = ad.load(spark, sf, "lineitem").selectExpr(
        f"concat('codz_', cast({ad.Y} as string), '_', lpad(cast({ad.M} as string), 2, '0'), '.csv') as file"
    )
    return obs.first_files(rows, 12).groupBy("file").agg(F.count(F.lit(1)).alias("rows"))


@query
def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    return obs.tidy_fields(ad.raw_rows(spark, sf, ad.RAW_CODZ), obs.CODZ_FIELDS, decode=False).drop("load_order")


@query
def clean_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Trimming and missing-value rules over whole free texts."""
    docs = ad.load(spark, sf, "documents")
    cleaned = text.clean_text(text.missing_to_null(F.col("text")))
    return docs.select("doc_id", F.length(cleaned).alias("cleaned_chars"), F.md5(cleaned).alias("digest"))


@query
def numeric_coercion(spark: SparkSession, sf: str) -> DataFrame:
    fields = ["hydro_year", "hydro_month", "day", *_CODZ_VALUES]
    rows = obs.tidy_fields(ad.raw_rows(spark, sf, ad.RAW_CODZ), obs.CODZ_FIELDS, decode=False)
    return cleaning.numbers(rows, fields).select("station_code", *fields)


@query
def hydro_calendar(spark: SparkSession, sf: str) -> DataFrame:
    days = ad.load(spark, sf, "lineitem").selectExpr(f"{ad.Y} as y", f"{ad.M} as m", f"{ad.D} as d")
    hm, hy = cal.hydro_month_of(F.col("m")), cal.hydro_year_of(F.col("y"), F.col("m"))
    df = days.withColumns({"hydro_month": hm, "hydro_year": hy})
    df = df.withColumn("calendar_month", cal.calendar_month_of(F.col("hydro_month")))
    return df.select(
        "y", "m", "d", F.col("hydro_year").cast("int").alias("hydro_year"),
        F.col("hydro_month").cast("int").alias("hydro_month"),
        F.col("calendar_month").cast("int").alias("calendar_month"),
        cal.calendar_year_of(F.col("hydro_year"), F.col("calendar_month")).cast("int").alias("calendar_year"),
        cal.season_of(F.col("hydro_month")).alias("season"),
    )


@query
def measured_at(spark: SparkSession, sf: str) -> DataFrame:
    """Dates three days on: some do not exist."""
    days = ad.load(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", f"{ad.Y} + case when {ad.M} >= 11 then 1 else 0 end as hydro_year",
        f"{ad.M} as calendar_month", f"{ad.D} + 3 as day",
    )
    when = cal.observation_time(F.col("hydro_year"), F.col("calendar_month"), F.col("day"))
    return _clock(days.withColumn("measured_at", when).filter("measured_at is not null"))


@query
def sentinels(spark: SparkSession, sf: str) -> DataFrame:
    df = ad.load(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "case when l_quantity = 50 then 9999.0 else l_quantity end as water_level_cm",
        "case when l_linenumber = 7 then 99999.999 when l_linenumber = 6 then 100000.5 else l_extendedprice end as flow_m3s",
        "case when l_linenumber = 5 then 99.9 else l_tax end as water_temp_c",
        "case when l_linenumber = 4 then 999.0 else l_quantity end as ice_thickness_cm",
        "case when l_returnflag = 'N' then '' else l_returnflag end as code",
    )
    return df.withColumns({
        "water_level_cm": text.narrow(text.level_value(F.col("water_level_cm").cast("double"))),
        "flow_m3s": text.flow_value(F.col("flow_m3s")),
        "water_temp_c": text.temp_value(F.col("water_temp_c")),
        "ice_thickness_cm": text.narrow(text.ice_value(F.col("ice_thickness_cm").cast("double"))),
        "code": text.blank_to_null(F.col("code")),
    })


@query
def reject_audit(spark: SparkSession, sf: str) -> DataFrame:
    rows = ad.load(spark, sf, "lineitem").selectExpr(*ad.columns(ad.RAW_CODZ), "l_returnflag as file")
    typed = cleaning.type_codz(obs.tidy_fields(rows, obs.CODZ_FIELDS, obs.CODZ_NUMBERS, decode=False))
    return cleaning.reject_audit(typed).withColumn("reasons", F.array_join("reasons", "; "))


@query
def gauges_first_wins(spark: SparkSession, sf: str) -> DataFrame:
    rows = ad.load(spark, sf, "lineitem").selectExpr(
        "cast(l_suppkey as string) as station_code", "concat('name ', cast(l_orderkey as string)) as station_name",
        "l_returnflag as river_name", f"{ad.LINE_ORDER} as load_order",
    )
    return merge.merge_gauges(rows)


@query
def measurements_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return _clock(_measurements(spark, sf)).withColumn("water_temp_c", F.round("water_temp_c", 6))


@query
def phenomena_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return _clock(_phenomena(spark, sf))


@query
def gauge_uuid(spark: SparkSession, sf: str) -> DataFrame:
    return merge.add_uuid(ad.gauges(spark, sf))


@query
def insert_absent(spark: SparkSession, sf: str) -> DataFrame:
    users = _phenomena(spark, sf).select("station_code").distinct().select(
        "station_code", F.lit("user").alias("station_name"), F.lit("events").alias("river_name")
    )
    return merge.insert_absent(ad.gauges(spark, sf), users, ["station_code"])


# ---- constraints ------------------------------------------------------------------------------

@query
def pk_violations(spark: SparkSession, sf: str) -> DataFrame:
    return _clock(quality.duplicate_keys(ad.measurement_rows(spark, sf), ["station_code", "measured_at"]))


@query
def fk_orphans(spark: SparkSession, sf: str) -> DataFrame:
    return quality.orphans(ad.phenomenon_rows(spark, sf), "station_code", ad.gauges(spark, sf), "station_code")


@query
def null_report(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["station_code", "measured_at", "water_level_cm", "flow_m3s", "water_temp_c"]
    return quality.null_counts(ad.measurement_rows(spark, sf), columns)


@query
def check_violations(spark: SparkSession, sf: str) -> DataFrame:
    fits = frequency.fit_all(ad.all_series(spark, sf), ["lognormal_mom"])
    flows = frequency.design_flows(fits, (50, 100, 1000))
    return quality.outside(flows, "return_period", (100, 1000)).select("station_code", "return_period", *_r("q", digits=4))


@query
def quality_report(spark: SparkSession, sf: str) -> DataFrame:
    annual = st.annual(_measurements(spark, sf))
    return jobs.quality_report({
        "gauges_list": ad.gauges(spark, sf), "measurements": ad.measurement_rows(spark, sf),
        "phenomena": ad.phenomenon_rows(spark, sf), "stats_annual": annual,
    })


# ---- ranks and tests --------------------------------------------------------------------------

@query
def hazen(spark: SparkSession, sf: str) -> DataFrame:
    return srs.hazen_positions(ad.all_series(spark, sf)).select("station_code", "t", "x", "m", *_r("p", digits=9))


@query
def split_groups(spark: SparkSession, sf: str) -> DataFrame:
    return srs.split_groups(ad.all_series(spark, sf), 3).groupBy("station_code", "grp").agg(
        F.count(F.lit(1)).alias("size"), F.min("t").alias("first_t"), F.max("t").alias("last_t")
    )


@query
def split_label(spark: SparkSession, sf: str) -> DataFrame:
    return srs.split_label(ad.all_series(spark, sf))


@query
def mid_ranks(spark: SparkSession, sf: str) -> DataFrame:
    return srs.mid_ranks(ad.all_series(spark, sf)).select("station_code", "t", "x", "ties", "mid_rank")


@query
def median_runs(spark: SparkSession, sf: str) -> DataFrame:
    return srs.median_signs(ad.all_series(spark, sf)).groupBy("station_code").agg(
        F.count_if(F.col("sign") > 0).alias("n1"), F.count_if(F.col("sign") < 0).alias("n2"),
        F.sum("starts_run").alias("runs"),
    )


@query
def ecdf_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return srs.ecdf_bounds(ad.all_series(spark, sf)).select("station_code", "t", *_r("below", "upto", digits=9))


@query
def series_peak(spark: SparkSession, sf: str) -> DataFrame:
    return plots.peak_labels(ad.all_series(spark, sf)).select("station_code", "WWQ", "peak_t")


@query
def concordance(spark: SparkSession, sf: str) -> DataFrame:
    return srs.concordance(ad.all_series(spark, sf))


def _test(name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return hypothesis.TESTS[name](ad.all_series(spark, sf)).withColumns({
            "statistic": F.round("statistic", 6), "p_value": F.round("p_value", 6),
        })
    run.__name__ = name
    return query(run)


for _name in ("grubbs_beck", "kruskal_wallis", "wald_wolfowitz", "mann_kendall", "spearman"):
    _test(_name)


@query
def test_results(spark: SparkSession, sf: str) -> DataFrame:
    series = _series(spark, sf)
    series = cut_lineage(jobs.eligible_series(ad.series_gauges(series), series, MIN_COUNT))
    return hypothesis.run_tests(series).select(
        "series_type", "station_code", "test_id", "period_start", "period_end", "result_notes", "result"
    )


@query
def append_results(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs of one test in the result log: ids go on where the first run ended."""
    rows = hypothesis.run_tests(ad.all_series(spark, sf), ["mann_kendall"])
    rows = cut_lineage(rows.select("series_type", "station_code", "test_id", "result"))
    first = merge.append_log(None, rows, "station_code", ["station_code", "test_id"])
    second = merge.append_log(first, rows, "station_code", ["station_code", "test_id"])
    return first.unionByName(second)


# ---- fits -------------------------------------------------------------------------------------

@query
def fit_lognormal_mom(spark: SparkSession, sf: str) -> DataFrame:
    return frequency.fit_lognormal_mom(ad.all_series(spark, sf)).filter("reason is null").select(
        "station_code", "year_start", "year_end", "n", *_r("mu_log", "sigma_log")
    )


@query
def fit_lognormal_3p(spark: SparkSession, sf: str) -> DataFrame:
    return frequency.fit_lognormal_3p(ad.all_series(spark, sf)).filter("reason is null").select(
        "station_code", "n", *_r("epsilon", "mu", "sigma")
    )


@query
def pearson_profile(spark: SparkSession, sf: str) -> DataFrame:
    return frequency.pearson3_profile(ad.all_series(spark, sf)).select(
        "station_code", "grid_no", *_r("epsilon", "loglik", digits=4)
    )


@query
def fit_pearson3(spark: SparkSession, sf: str) -> DataFrame:
    return frequency.fit_pearson3(ad.all_series(spark, sf)).filter("reason is null").select(
        "station_code", "n", "grid_no", *_r("epsilon", "lambda", "alpha", "loglik", digits=5)
    )


@query
def fit_weibull(spark: SparkSession, sf: str) -> DataFrame:
    return frequency.fit_weibull(ad.all_series(spark, sf)).filter("reason is null").select(
        "station_code", "n", *_r("alpha", digits=9), *_r("beta")
    )


def _closed(spark: SparkSession, sf: str) -> DataFrame:
    return frequency.fit_all(_series(spark, sf), ["lognormal_mom", "lognormal_3p", "weibull"])


@query
def fit_failures(spark: SparkSession, sf: str) -> DataFrame:
    fits = frequency.fit_all(_series(spark, sf))
    return frequency.fit_failures(fits)


@query
def design_flows(spark: SparkSession, sf: str) -> DataFrame:
    return frequency.design_flows(_closed(spark, sf)).select("station_code", "model", "return_period", *_r("q", digits=4))


@query
def design_flows_pearson3(spark: SparkSession, sf: str) -> DataFrame:
    fits = frequency.fit_all(ad.all_series(spark, sf), ["pearson3"])
    return frequency.design_flows(fits).select("station_code", "return_period", *_r("q", digits=4))


@query
def quantile_curve(spark: SparkSession, sf: str) -> DataFrame:
    return frequency.quantiles(_closed(spark, sf), CURVE_GRID).select("station_code", "model", "p", *_r("q", digits=4))


@query
def quantile_curve_pearson3(spark: SparkSession, sf: str) -> DataFrame:
    fits = frequency.fit_all(ad.all_series(spark, sf), ["pearson3"])
    return frequency.quantiles(fits, CURVE_GRID).select("station_code", "p", *_r("q", digits=4))


@query
def bootstrap_ci(spark: SparkSession, sf: str) -> DataFrame:
    """Bands of both log-normal models on the whole grid, with draws that SQL can redo."""
    bands = bootstrap.bootstrap_ci(ad.all_series(spark, sf), ["lognormal_mom", "lognormal_3p"], SAMPLES, draw="hash")
    points = bands.filter("n_valid > 0").select("station_code", "model", "n_valid", F.explode(F.arrays_zip("probabilities", "q_lower", "q_upper")).alias("g"))
    return points.select("station_code", "model", F.col("g.probabilities").alias("p"), F.col("g.q_lower").alias("q_lower"), F.col("g.q_upper").alias("q_upper"), "n_valid").withColumns(
        {c: F.round(c, 4) for c in ("q_lower", "q_upper")})


@query
def bootstrap_ci_all(spark: SparkSession, sf: str) -> DataFrame:
    """All four models on the 200-point grid."""
    return bootstrap.bootstrap_ci(ad.all_series(spark, sf), n_samples=500)


@query
def batch_estimation(spark: SparkSession, sf: str) -> DataFrame:
    """Fits of all four models as log rows, with ids and provenance."""
    series = srs.longer_than(_series(spark, sf), MIN_COUNT)
    rows = cut_lineage(frequency.fitted_rows(frequency.fit_all(series)))
    log = merge.append_log(None, rows, "station_code", ["station_code", "distribution_id", "estimation_method_id"])
    info = F.col("source_timeseries_info")
    return log.select(
        "id", "station_code", "distribution_id", "estimation_method_id", "frequency_id",
        F.get_json_object(info, "$.n").cast("int").alias("n"),
        F.get_json_object(info, "$.year_start").cast("int").alias("year_start"),
        F.get_json_object(info, "$.year_end").cast("int").alias("year_end"),
    )


@query
def lambda_kolmogorov(spark: SparkSession, sf: str) -> DataFrame:
    series = _series(spark, sf)
    fits = frequency.fit_all(series, ["pearson3"])
    return goodness.lambda_kolmogorov(series, fits).select(
        "station_code", "test_id", "n", *_r("d", "lambda_stat"), "result"
    )


@query
def lambda_kolmogorov_lognormal(spark: SparkSession, sf: str) -> DataFrame:
    series = _series(spark, sf)
    fits = frequency.fit_all(series, ["lognormal_mom"])
    return goodness.lambda_kolmogorov(series, fits, "lognormal_mom").select("station_code", "test_id", "n", *_r("d", "lambda_stat"), "result")


@query
def lambda_kolmogorov_lognormal_3p(spark: SparkSession, sf: str) -> DataFrame:
    series = _series(spark, sf)
    fits = frequency.fit_all(series, ["lognormal_3p"])
    return goodness.lambda_kolmogorov(series, fits, "lognormal_3p").select("station_code", "test_id", "n", *_r("d", "lambda_stat"), "result")


@query
def lambda_kolmogorov_weibull(spark: SparkSession, sf: str) -> DataFrame:
    series = _series(spark, sf)
    fits = frequency.fit_all(series, ["weibull"])
    return goodness.lambda_kolmogorov(series, fits, "weibull").select(
        "station_code", "test_id", "n", *_r("d", "lambda_stat"), "result"
    )


# ---- logs and exports -------------------------------------------------------------------------

_ORDER = ["station_code", "distribution_id", "estimation_method_id"]


def _runs(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Fits of two runs that share station codes: users by day, then suppliers by month."""
    users = frequency.fit_all(cut_lineage(ad.one_series(spark, sf, "B", prefix=False)), ["lognormal_mom", "lognormal_3p"])
    suppliers = frequency.fit_all(ad.one_series(spark, sf, "C", prefix=False), ["lognormal_mom"])
    return [cut_lineage(users), cut_lineage(suppliers)]


def _fitted_log(runs: list[DataFrame]) -> DataFrame:
    first = merge.append_log(None, frequency.fitted_rows(runs[0]), "station_code", _ORDER)
    second = merge.append_log(first, frequency.fitted_rows(runs[1]), "station_code", _ORDER)
    return first.unionByName(second)


def _discharge_log(runs: list[DataFrame]) -> DataFrame:
    order = [*_ORDER, "return_period"]
    rows = [frequency.discharge_rows(frequency.design_flows(r)) for r in runs]
    first = merge.append_log(None, rows[0], "station_code", order)
    return first.unionByName(merge.append_log(first, rows[1], "station_code", order))


@query
def export_stations(spark: SparkSession, sf: str) -> DataFrame:
    gauges = ad.gauges(spark, sf).withColumns({"lat": F.lit(None).cast("double"), "lon": F.lit(None).cast("double")})
    return export.stations(merge.add_uuid(gauges))


@query
def export_alltime(spark: SparkSession, sf: str) -> DataFrame:
    return export.alltime(st.alltime(st.monthly(_measurements(spark, sf))), ad.gauges(spark, sf))


@query
def export_estimations(spark: SparkSession, sf: str) -> DataFrame:
    rows = export.estimations(_fitted_log(_runs(spark, sf)))
    return rows.select(*export.EXPORT_KEY, *_r("mu_log", "sigma_log"), "n", "year_start", "year_end")


@query
def export_flows(spark: SparkSession, sf: str) -> DataFrame:
    return export.estimated_flows(_discharge_log(_runs(spark, sf)))


@query
def latest_fit(spark: SparkSession, sf: str) -> DataFrame:
    return export.latest_fit(_fitted_log(_runs(spark, sf))).drop("params")


@query
def latest_fit_station(spark: SparkSession, sf: str) -> DataFrame:
    return export.latest_fit(_fitted_log(_runs(spark, sf)), "7").drop("params")


@query
def merge_export(spark: SparkSession, sf: str) -> DataFrame:
    """Supplier stations replace user stations of the same code in an earlier export."""
    old = _phenomena(spark, sf).select("station_code").distinct().select(
        "station_code", F.lit("user").alias("station_name"), F.lit("events").alias("river_name")
    )
    return merge.replace_by_key(old, ad.gauges(spark, sf), ["station_code"])


@query
def replace_export(spark: SparkSession, sf: str) -> DataFrame:
    """Stations of the second run lose their old estimations and flows and get fresh ones."""
    runs = _runs(spark, sf)

    def frames(run: DataFrame) -> tuple[DataFrame, DataFrame]:
        est = export.with_names(run.filter("reason is null")).select(*export.EXPORT_KEY, "n")
        flows = export.with_names(frequency.design_flows(run)).select(
            *export.EXPORT_KEY, "return_period", (F.lit(1.0) / F.col("return_period")).alias("probability"),
            F.round("q", 4).alias("q_estimated_m3s"),
        )
        return est, flows

    empty = spark.createDataFrame([], "id bigint, station_code string, distribution string, method string, frequency string, n int")
    no_flows = spark.createDataFrame(
        [], "id bigint, estimation_id bigint, return_period int, probability double, q_estimated_m3s double")
    target, target_flows = merge.replace_export(empty, no_flows, *frames(runs[0]))
    target, target_flows = merge.replace_export(cut_lineage(target), cut_lineage(target_flows), *frames(runs[1]))
    return target.join(target_flows.drop("id").withColumnRenamed("estimation_id", "id"), "id")


def _bands(spark: SparkSession, sf: str, runs: list[DataFrame], fitted: DataFrame) -> DataFrame:
    series = ad.one_series(spark, sf, "C", prefix=False)
    bands = bootstrap.bootstrap_ci(series, ["lognormal_mom"])
    latest = export.latest_fit(fitted).filter("distribution_id = 2 and estimation_method_id = 1")
    tied = latest.select("station_code", F.lit("lognormal_mom").alias("model"), F.col("fitted_id").alias("fitted_distribution_id"))
    rows = bootstrap.ci_rows(bands, tied)
    return merge.append_log(None, cut_lineage(rows), "fitted_distribution_id", ["fitted_distribution_id"])


@query
def latest_ci(spark: SparkSession, sf: str) -> DataFrame:
    runs = _runs(spark, sf)
    fitted = _fitted_log(runs)
    return export.latest_ci(_bands(spark, sf, runs, fitted), fitted).drop("ci_data")


@query
def catalogue_usage(spark: SparkSession, sf: str) -> DataFrame:
    """Seeded catalogues with the number of fits that use each entry."""
    fitted = _fitted_log(_runs(spark, sf))
    tests = hypothesis.run_tests(_series(spark, sf), ["mann_kendall", "spearman"])
    out = None
    for label, rows, used, column in (
        ("distributions", DISTRIBUTIONS, fitted, "distribution_id"),
        ("estimation_methods", ESTIMATION_METHODS, fitted, "estimation_method_id"),
        ("frequencies", FREQUENCIES, fitted, "frequency_id"), ("stat_tests", STAT_TESTS, tests, "test_id"),
    ):
        counts = used.groupBy(F.col(column).alias("id")).agg(F.count(F.lit(1)).alias("uses"))
        one = catalogue(spark, rows).join(counts, "id", "left").select(
            F.lit(label).alias("catalogue"), "id", "name", F.coalesce("uses", F.lit(0)).alias("uses")
        )
        out = one if out is None else out.unionByName(one)
    return out


# ---- plots ------------------------------------------------------------------------------------

@query
def plot_curve(spark: SparkSession, sf: str) -> DataFrame:
    """Curve of every closed-form fit on the full grid, summed up per fit."""
    curve = plots.theoretical_curves(_closed(spark, sf))
    return curve.groupBy("station_code", "model").agg(
        F.count("q").alias("points"), F.round(F.min("q"), 3).alias("lowest"), F.round(F.max("q"), 3).alias("highest"),
        F.round(F.avg("q"), 3).alias("mean_q"), F.round(F.max("z"), 6).alias("max_z"),
    )


@query
def plot_curve_pearson3(spark: SparkSession, sf: str) -> DataFrame:
    return plots.theoretical_curves(frequency.fit_all(ad.all_series(spark, sf), ["pearson3"]))


@query
def plot_points(spark: SparkSession, sf: str) -> DataFrame:
    return plots.empirical_points(ad.all_series(spark, sf)).select("station_code", "t", "x", *_r("p", digits=9), *_r("z"))


@query
def plot_marks(spark: SparkSession, sf: str) -> DataFrame:
    fits = frequency.fit_all(ad.all_series(spark, sf), ["lognormal_mom"])
    return plots.marks_on_curves(fits).select("station_code", "kind", "label", "p", *_r("z"), *_r("q", digits=4))


@query
def plot_bundle(spark: SparkSession, sf: str) -> DataFrame:
    runs = _runs(spark, sf)
    fitted = _fitted_log(runs)
    gauges = merge.add_uuid(ad.gauges(spark, sf))
    series = ad.one_series(spark, sf, "B", prefix=False)
    bundle = plots.station_bundles(gauges, series, export.latest_fit(fitted), _bands(spark, sf, runs, fitted))
    return bundle.select(
        "station_code", "station_name", "uuid", "n", "distribution", "method",
        F.col("ci_data").isNotNull().alias("has_band"), "skip_reason",
    )
