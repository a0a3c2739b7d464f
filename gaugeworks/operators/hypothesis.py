"""Tests on station series.

Every test maps a series frame to one row per station:
``station_code, test_id, period_start, period_end, n, statistic, p_value, result_notes, result``.
Each test starts from the same spread of stations over tasks, so tests run together share one
shuffle. ``result`` is true when the null hypothesis is kept. Series too short for a test have no row;
a statistic that is undefined (no variation) gives ``result = false``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.numeric import chi_square_upper, normal_two_sided, student_two_sided
from gaugeworks.functions.rounding import one_decimal
from gaugeworks.functions.special import grubbs_critical_udf
from gaugeworks.operators import series as srs

SERIES_TYPE = "WQ_annual"
RESULT_COLUMNS = [
    "station_code", "test_id", "period_start", "period_end", "n", "statistic", "p_value",
    "result_notes", "result",
]


def _period() -> list[Column]:
    return [F.min("t").alias("period_start"), F.max("t").alias("period_end")]


def _size() -> Column:
    return F.count(F.lit(1)).cast("int").alias("n")


def _percent(alpha: float) -> str:
    return f"{alpha:.0%}"


def _fixed4(c: Column) -> Column:
    return F.when(c.isNull() | F.isnan(c), "nan").otherwise(F.format_string("%.4f", c))


def _decide(df: DataFrame, test_id: int, alpha: float, notes: Column) -> DataFrame:
    kept = F.coalesce(F.col("p_value") >= alpha, F.lit(False)) & ~F.isnan(F.coalesce("p_value", F.lit(0.0)))
    return df.withColumns({
        "test_id": F.lit(test_id), "result_notes": notes, "result": kept,
    }).select(*RESULT_COLUMNS)


def grubbs_beck(series: DataFrame, alpha: float = 0.10) -> DataFrame:
    """Low and high outliers of log10 values, single pass.

    The values of a station (one per block) are kept as one array, so the limits are applied
    where they are computed: one shuffle, no join back.
    """
    log_x = F.when(F.col("x") > 0, F.log10("x"))
    df = srs.spread(series).groupBy("station_code").agg(
        *_period(), _size(), F.count(log_x).cast("int").alias("n_pos"),
        F.avg(log_x).alias("mean_log"), F.stddev_samp(log_x).alias("sd_log"),
        F.sort_array(F.collect_list(F.when(F.col("x") > 0, F.struct("t", "x")))).alias("values"),
    ).filter("n_pos >= 3").withColumn("k", grubbs_critical_udf(F.col("n_pos"), F.lit(alpha)))
    df = df.withColumns({
        "low": F.pow(F.lit(10.0), F.col("mean_log") - F.col("k") * F.col("sd_log")),
        "high": F.pow(F.lit(10.0), F.col("mean_log") + F.col("k") * F.col("sd_log")),
    })
    df = df.withColumn(
        "outliers", F.filter("values", lambda v: (v["x"] < F.col("low")) | (v["x"] > F.col("high")))
    )
    labels = F.transform("outliers", lambda v: F.concat(v["t"].cast("string"), F.lit(": "), one_decimal(v["x"])))
    none = F.size("outliers") == 0
    head = F.concat(F.format_string("(n=%d, α=", F.col("n")), F.lit(_percent(alpha) + ")"))
    notes = F.when(none, F.concat(F.lit("No outliers "), head)).otherwise(
        F.concat(F.lit("Outliers detected "), head, F.lit(": "), F.array_join(labels, ", "), F.lit(" m³/s"))
    )
    return df.select(
        "station_code", F.lit(1).alias("test_id"), "period_start", "period_end", "n",
        F.col("k").alias("statistic"), F.lit(None).cast("double").alias("p_value"),
        notes.alias("result_notes"), none.alias("result"),
    )


def kruskal_wallis(series: DataFrame, k: int = 2, alpha: float = 0.05) -> DataFrame:
    """Equal distribution of k consecutive parts, H corrected for ties."""
    if k < 2:
        raise ValueError("k must be at least 2")
    ranked = srs.mid_ranks(srs.split_groups(srs.spread(series), k))
    parts = ranked.groupBy("station_code", "grp").agg(
        *_period(), F.count(F.lit(1)).alias("size"), F.sum("mid_rank").alias("rank_sum"),
        F.sum(F.col("ties") * F.col("ties") - 1).cast("double").alias("tie_term"),
    )
    whole = parts.groupBy("station_code").agg(
        F.min("period_start").alias("period_start"), F.max("period_end").alias("period_end"),
        F.sum("size").cast("int").alias("n"),
        F.sum(F.col("rank_sum") * F.col("rank_sum") / F.col("size")).alias("squares"),
        F.sum("tie_term").alias("tie_term"),
        F.min(F.when(F.col("grp") == 2, F.col("period_start"))).alias("split_t"),
    ).filter(F.col("n") >= k)
    n = F.col("n").cast("double")
    raw = 12.0 / (n * (n + 1.0)) * F.col("squares") - 3.0 * (n + 1.0)
    h = F.try_divide(raw, 1.0 - F.col("tie_term") / (n * n * n - n))
    whole = whole.withColumn("statistic", h)
    whole = whole.withColumn("p_value", chi_square_upper(F.col("statistic"), k - 1))
    whole = whole.withColumn("p_value", F.when(F.col("statistic").isNotNull(), F.col("p_value")))
    notes = F.concat(
        F.format_string("k=%d groups split at ", F.lit(k)), F.col("split_t").cast("string"), F.format_string(" (n=%d, α=", F.col("n")),
        F.lit(_percent(alpha) + ", p="), _fixed4(F.col("p_value")), F.lit(")"),
    )
    return _decide(whole, 2, alpha, notes)


def _short_notes(alpha: float) -> Column:
    return F.concat(
        F.format_string("n=%d, α=", F.col("n")), F.lit(_percent(alpha) + ", p="), _fixed4(F.col("p_value"))
    )


def wald_wolfowitz(series: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Randomness by the number of runs about the median."""
    runs = srs.median_signs(srs.spread(series)).groupBy("station_code").agg(
        *[F.first(c).alias(c) for c in ("period_start", "period_end", "n")],
        F.count_if(F.col("sign") > 0).cast("double").alias("n1"),
        F.count_if(F.col("sign") < 0).cast("double").alias("n2"),
        F.sum("starts_run").alias("runs"),
    ).filter("n1 + n2 >= 2")
    n = F.col("n1") + F.col("n2")
    twice = 2.0 * F.col("n1") * F.col("n2")
    expected = twice / n + 1.0
    variance = twice * (twice - n) / (n * n * (n - 1.0))
    runs = runs.withColumn("statistic", F.try_divide(F.col("runs") - expected, F.sqrt(variance)))
    runs = runs.withColumn("p_value", normal_two_sided(F.col("statistic")))
    runs = runs.withColumn("p_value", F.when(F.col("statistic").isNotNull(), F.col("p_value")))
    return _decide(runs, 4, alpha, _short_notes(alpha))


def mann_kendall(series: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Monotonic trend; variance without tie correction, continuity-corrected Z."""
    df = srs.rank_digits(srs.spread(series)).groupBy("station_code").agg(
        *_period(), F.count_if(F.col("level") == 0).cast("int").alias("n"), F.sum("gain").alias("s")
    ).filter("n >= 3")
    n = F.col("n").cast("double")
    variance = n * (n - 1.0) * (2.0 * n + 5.0) / 18.0
    df = df.withColumn("statistic", (F.col("s") - F.signum(F.col("s"))) / F.sqrt(variance))
    df = df.withColumn("p_value", normal_two_sided(F.col("statistic")))
    return _decide(df, 5, alpha, _short_notes(alpha))


def spearman(series: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Rank correlation with time, p from Student's t."""
    ranked = srs.mid_ranks(srs.spread(series)).withColumn("i", F.row_number().over(srs.by_time()))
    df = ranked.groupBy("station_code").agg(
        *_period(), _size(), F.sum(F.col("mid_rank") * F.col("i")).alias("sxy"),
        F.sum(F.col("mid_rank") * F.col("mid_rank")).alias("sxx"),
    ).filter("n >= 3")
    n = F.col("n").cast("double")
    centre = n * (n + 1.0) * (n + 1.0) / 4.0
    syy = n * (n + 1.0) * (2.0 * n + 1.0) / 6.0 - centre
    spread = F.sqrt((F.col("sxx") - centre) * syy)
    rho = F.try_divide(F.col("sxy") - centre, spread)
    df = df.withColumn("statistic", F.greatest(F.lit(-1.0), F.least(F.lit(1.0), rho)))
    df = df.withColumn("statistic", F.when(rho.isNotNull(), F.col("statistic")))
    r = F.col("statistic")
    t = F.try_divide(r * F.sqrt(n - 2.0), F.sqrt(1.0 - r * r))
    df = df.withColumn("_t", t)
    p = F.when(r.isNull(), None).when(F.abs(r) >= 1.0, 0.0).otherwise(
        student_two_sided(F.col("_t"), F.col("n") - 2)
    )
    df = df.withColumn("p_value", p)
    notes = F.concat(F.lit("ρ="), _fixed4(F.col("statistic")), F.lit(", "), _short_notes(alpha))
    return _decide(df, 6, alpha, notes)


# A test is any function from a series frame to the result columns.
TESTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "grubbs_beck": grubbs_beck,
    "kruskal_wallis": kruskal_wallis,
    "wald_wolfowitz": wald_wolfowitz,
    "mann_kendall": mann_kendall,
    "spearman": spearman,
}


def register_test(name: str, run: Callable[[DataFrame], DataFrame]) -> None:
    TESTS[name] = run


def run_tests(
    series: DataFrame, names: list[str] | None = None, series_type: str = SERIES_TYPE
) -> DataFrame:
    """All chosen tests on all stations, as rows for the result log."""
    out = None
    for name in names or list(TESTS):
        one = TESTS[name](series).select(*RESULT_COLUMNS)
        out = one if out is None else out.unionByName(one)
    dated = dict(series.dtypes)["t"] in ("date", "timestamp", "timestamp_ntz")
    whole = (lambda c: F.year(c)) if dated else (lambda c: F.col(c).cast("int"))  # a period is told in years
    return out.select(
        F.lit(series_type).alias("series_type"), "station_code", "test_id",
        whole("period_start").alias("period_start"), whole("period_end").alias("period_end"), "result_notes", "result",
    )
