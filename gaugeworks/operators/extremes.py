"""Fits that the catalogues offer beside the four standard ones: Gumbel, GEV, Log-Pearson III, linear and weighted moments.

Linear moments come from ranks: a window by station orders the values, and the sums that follow need no further shuffle. Shapes and scales
without a closed form are found by bisection inside a bracket that holds the root, as Column expressions over the row of a station; only
gamma quantiles visit Python. Importing this module registers the models with ``frequency``, ``goodness`` and ``bootstrap``.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugeworks.functions.numeric import log_gamma
from gaugeworks.functions.resampling import EULER, PLOTTING, SHAPE_HIGH, SHAPE_LOW, SMALL_SHAPE, SMALL_SKEW
from gaugeworks.functions.special import gamma_cdf_udf, gamma_product_udf, gamma_quantile_udf, gumbel_udf
from gaugeworks.operators.frequency import FIT_COLUMNS, MODELS, _TOO_FEW, Model, _fit_with, _period, fit_all, quantiles, register_model
from gaugeworks.operators.goodness import KNOWN, _normal_cdf, register_distribution
from gaugeworks.operators.series import finite, keyed, per_station, spread, unkeyed
from gaugeworks.schemas import RETURN_PERIODS, SUMMER, WINTER
from gaugeworks.session import cut_lineage

Value = Callable[[str], Column]
_STEPS = 80


def bisect(low: Column, high: Column, root_is_above: Callable[[Column], Column], steps: int = _STEPS) -> Column:
    """Middle of the bracket after so many halvings; ``root_is_above(x)`` says on which side of x the root lies."""

    def halve(acc: Column, _: Column) -> Column:
        mid = (acc["lo"] + acc["hi"]) / 2.0
        above = root_is_above(mid)
        return F.struct(F.when(above, mid).otherwise(acc["lo"]).alias("lo"), F.when(above, acc["hi"]).otherwise(mid).alias("hi"))

    start = F.struct(low.cast("double").alias("lo"), high.cast("double").alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve, lambda acc: (acc["lo"] + acc["hi"]) / 2.0)


def ordered_moments(series: DataFrame, weighted: bool = False) -> DataFrame:
    """Extent of each series and its probability-weighted moments ``b0``, ``b1``, ``b2``, with ``l1``, ``l2``, ``t3`` made of them.

    Unbiased ones weigh the value of rank i by the share of pairs and triples in which it is the largest; with ``weighted`` the weights are
    powers of the plotting position (i - 0.35) / n.
    """
    rank = F.row_number().over(Window.partitionBy("station_code").orderBy(F.col("x").asc_nulls_last(), "t")).cast("double")
    n = F.count("x").over(per_station()).cast("double")
    if weighted:
        first = (rank - PLOTTING) / F.when(n > 0, n)
        second = first * first
    else:
        first = F.try_divide(rank - 1.0, n - 1.0)
        second = first * F.try_divide(rank - 2.0, n - 2.0)
    rows = finite(series).select("station_code", "t", "x", first.alias("first"), second.alias("second"))
    x = F.col("x")
    sums = rows.groupBy("station_code").agg(
        *_period(), F.avg(x).alias("b0"), F.avg(x * F.col("first")).alias("b1"), F.avg(x * F.col("second")).alias("b2"),
        F.min(x).alias("low"), F.max(x).alias("high"))
    b0, b1, b2 = F.col("b0"), F.col("b1"), F.col("b2")
    sums = sums.withColumns({"l1": b0, "l2": 2.0 * b1 - b0, "l3": 6.0 * b2 - 6.0 * b1 + b0})
    reason = F.when(F.col("n") < 3, _TOO_FEW).when(~(F.col("low") < F.col("high")), "no variation").when(~(F.col("l2") > 0), "no variation")
    sums = sums.withColumns({"reason": reason, "t3": F.try_divide(F.col("l3"), F.col("l2"))})
    return sums.drop("l3", "low", "high")


def gev_shape(t3: Column) -> Column:
    """Shape whose L-skewness is ``t3`` (between -1 and 1); positive shapes are bounded above."""
    def skewness(k: Column) -> Column:
        ratio = F.when(k == 0.0, math.log(3) / math.log(2)).otherwise(F.expm1(-k * math.log(3)) / F.expm1(-k * math.log(2)))
        return 2.0 * ratio - 3.0

    return bisect(F.lit(SHAPE_LOW), F.lit(SHAPE_HIGH), lambda k: skewness(k) > t3)


def fit_gev(series: DataFrame, weighted: bool = False) -> DataFrame:
    """GEV by linear moments, or by weighted moments."""
    df = ordered_moments(series, weighted)
    reason = F.coalesce("reason", F.when(~(F.abs("t3") < 1), "L-skewness beyond 1"))
    df = df.withColumn("reason", reason)
    df = df.withColumn("shape", F.when(F.col("reason").isNull(), gev_shape(F.col("t3"))))
    k, l1, l2 = F.col("shape"), F.col("l1"), F.col("l2")
    near = F.abs(k) < SMALL_SHAPE
    gamma = F.exp(log_gamma(1.0 + k))
    safe = F.when(near, 1.0).otherwise(k)
    scale = F.when(near, l2 / math.log(2)).otherwise(l2 * safe / (-F.expm1(-safe * math.log(2)) * gamma))
    df = df.withColumn("scale", scale)
    location = F.when(near, l1 - EULER * F.col("scale")).otherwise(l1 - F.col("scale") * (1.0 - gamma) / safe)
    return df.select("station_code", "year_start", "year_end", "n", location.alias("location"), "scale", "shape", "reason")


def fit_gumbel_lmom(series: DataFrame) -> DataFrame:
    df = ordered_moments(series).withColumn("scale", F.col("l2") / math.log(2))
    return _two(df, F.col("l1") - EULER * F.col("scale"))


def _two(df: DataFrame, location: Column) -> DataFrame:
    good = F.col("reason").isNull()
    return df.select("station_code", "year_start", "year_end", "n", F.when(good, location).alias("location"), F.when(good, F.col("scale")).alias("scale"), "reason")


def fit_gumbel_mom(series: DataFrame) -> DataFrame:
    """Gumbel by mean and standard deviation."""
    df = finite(series).groupBy("station_code").agg(*_period(), F.avg("x").alias("mean"), (F.stddev_samp("x") * (math.sqrt(6) / math.pi)).alias("scale"))
    df = df.withColumn("reason", F.when(F.col("n") < 3, _TOO_FEW).when(~(F.col("scale") > 0), "no variation"))
    return _two(df, F.col("mean") - EULER * F.col("scale"))


def fit_gumbel(series: DataFrame) -> DataFrame:
    """Gumbel by maximum likelihood: one series per array, solved per Arrow batch."""
    df = finite(spread(series)).groupBy("station_code").agg(
        *_period(), F.min("x").alias("low"), F.max("x").alias("high"), F.sort_array(F.collect_list("x")).alias("xs"))
    df = df.withColumn("reason", F.when(F.col("n") < 3, _TOO_FEW).when(~(F.col("low") < F.col("high")), "no variation"))
    # Rejected series get a stand-in so that the batch kernel sees no empty array.
    usable = F.when(F.col("reason").isNull(), F.col("xs")).otherwise(F.array(F.lit(0.0), F.lit(1.0)))
    df = df.withColumn("w", gumbel_udf(usable)).withColumn("scale", F.col("w.scale"))
    return _two(df, F.col("w.location"))


def fit_pearson3_lmom(series: DataFrame) -> DataFrame:
    """Pearson III by linear moments; ``alpha`` is negative where the distribution is bounded above.

    The shape follows from the L-skewness by rational approximations (relative error below 5e-5).
    """
    df = ordered_moments(series)
    t = F.abs("t3")
    df = df.withColumn("reason", F.coalesce("reason", F.when(~(t < 1), "L-skewness beyond 1").when(t < 1e-6, "no skewness")))
    good = F.col("reason").isNull()
    low, high = 3 * math.pi * t * t, 1.0 - t
    # fixed values: coefficients of the approximations
    inner = (1.0 + 0.2906 * low) / (low * (1.0 + low * (0.1882 + 0.0442 * low)))
    outer = high * (0.36067 + high * (-0.59567 + 0.25361 * high)) / (1.0 + high * (-2.78861 + high * (2.56096 - 0.77045 * high)))
    df = df.withColumn("lambda", F.when(good, F.when(t < 1 / 3, inner).otherwise(outer)))
    lam = F.col("lambda")
    deviation = F.col("l2") * math.sqrt(math.pi) * F.sqrt(lam) * F.exp(log_gamma(lam) - log_gamma(lam + 0.5))
    df = df.withColumn("alpha", F.signum("t3") * F.sqrt(lam) / deviation)
    return df.select("station_code", "year_start", "year_end", "n", (F.col("l1") - lam / F.col("alpha")).alias("epsilon"), "lambda", "alpha", "reason")


def fit_log_pearson3(series: DataFrame) -> DataFrame:
    """Mean, standard deviation and bias-corrected skew of ln x over the positive values."""
    series = finite(series)
    ln = F.when(F.col("x") > 0, F.log("x"))
    rows = series.select("station_code", "t", "x", ln.alias("y"), (ln - F.avg(ln).over(per_station())).alias("d"))
    m = F.col("m")
    df = rows.groupBy("station_code").agg(
        *_period(), F.count("y").cast("double").alias("m"), F.avg("y").alias("mu_log"), F.stddev_samp("y").alias("sigma_log"), F.sum(F.col("d") ** 3).alias("cubes"))
    df = df.withColumn("reason", F.when(m < 3, _TOO_FEW).when(~(F.col("sigma_log") > 1e-12), "no variation"))
    skew = F.when(F.col("reason").isNull(), m * F.col("cubes") / ((m - 1.0) * (m - 2.0) * F.col("sigma_log") ** 3))
    return df.select("station_code", "year_start", "year_end", "n", "mu_log", "sigma_log", skew.alias("skew_log"), "reason")


def gumbel_quantile(v: Value, p: Column, z: Column) -> Column:
    return v("location") - v("scale") * F.log(-F.log1p(-p))


def gev_quantile(v: Value, p: Column, z: Column) -> Column:
    k, u = v("shape"), F.log(-F.log1p(-p))
    near = F.abs(k) < SMALL_SHAPE
    return v("location") - v("scale") * F.when(near, u).otherwise(F.expm1(k * u) / F.when(near, 1.0).otherwise(k))


def signed_gamma_quantile(v: Value, p: Column, z: Column) -> Column:
    return v("epsilon") + gamma_quantile_udf(F.when(v("alpha") > 0, 1.0 - p).otherwise(p), v("lambda")) / v("alpha")


def log_pearson3_quantile(v: Value, p: Column, z: Column) -> Column:
    """exp(mu + sigma K), K the quantile of a standardised Pearson III; for next to no skew its expansion about the normal one."""
    g, h = v("skew_log"), v("skew_log") / 6.0
    shape = F.when(F.abs(g) >= SMALL_SKEW, 4.0 / F.when(g != 0.0, g * g))
    far = (gamma_quantile_udf(F.when(g > 0, 1.0 - p).otherwise(p), shape) - shape) * g / 2.0
    near = z + (z**2 - 1.0) * h + (z**3 - 6.0 * z) * h**2 / 3.0 - (z**2 - 1.0) * h**3 + z * h**4 + h**5 / 3.0
    return F.exp(v("mu_log") + v("sigma_log") * F.when(shape.isNull(), near).otherwise(far))


def gumbel_cdf(x: Column, v: Value) -> Column:
    return F.exp(-F.exp(-(x - v("location")) / v("scale")))


def gev_cdf(x: Column, v: Value) -> Column:
    """Nothing lies beyond the bound: above it for positive shapes, below it for negative ones."""
    k = v("shape")
    near = F.abs(k) < SMALL_SHAPE
    y = 1.0 - k * (x - v("location")) / v("scale")
    beyond = F.when(k > 0, 1.0).otherwise(0.0)
    inside = F.exp(-F.pow(F.when(y > 0, y), 1.0 / F.when(near, 1.0).otherwise(k)))
    return F.when(near, gumbel_cdf(x, v)).when(y <= 0, beyond).otherwise(inside)


def signed_gamma_cdf(x: Column, v: Value) -> Column:
    below = gamma_cdf_udf((x - v("epsilon")) * v("alpha"), v("lambda"))
    return F.when(v("alpha") > 0, below).otherwise(1.0 - below)


def log_pearson3_cdf(x: Column, v: Value) -> Column:
    g = v("skew_log")
    k = (F.log(F.when(x > 0, x)) - v("mu_log")) / v("sigma_log")
    shape = F.when(F.abs(g) >= SMALL_SKEW, 4.0 / F.when(g != 0.0, g * g))
    below = gamma_cdf_udf(shape + 2.0 * k / F.when(g != 0.0, g), shape)
    far = F.when(g > 0, below).otherwise(1.0 - below)
    return F.when(x <= 0, 0.0).when(shape.isNull(), _normal_cdf(k - g / 6.0 * (k * k - 1.0))).otherwise(far)


_GUMBEL = {"location": "location", "scale": "scale"}
_GEV = _GUMBEL | {"shape": "shape"}
_GAMMA = {"epsilon": "epsilon", "lambda": "lambda", "alpha": "alpha"}
_LOGS = {"mu_log": "mu_log", "sigma_log": "sigma_log", "skew_log": "skew_log"}

CATALOGUE = [
    Model("gumbel_mom", "Gumbel (MoM)", 1, 1, _fit_with(fit_gumbel_mom, _GUMBEL), gumbel_quantile, optional=True),
    Model("gumbel", "Gumbel (MLE)", 1, 2, _fit_with(fit_gumbel, _GUMBEL), gumbel_quantile, optional=True),
    Model("gumbel_lmom", "Gumbel (L-moments)", 1, 3, _fit_with(fit_gumbel_lmom, _GUMBEL), gumbel_quantile, optional=True),
    Model("gev", "GEV (L-moments)", 5, 3, _fit_with(fit_gev, _GEV), gev_quantile, optional=True, free=3),
    Model("gev_weighted", "GEV (weighted moments)", 5, 4, _fit_with(lambda s: fit_gev(s, weighted=True), _GEV), gev_quantile, optional=True, free=3),
    Model("pearson3_lmom", "Pearson III (L-moments)", 3, 3, _fit_with(fit_pearson3_lmom, _GAMMA), signed_gamma_quantile, python=True, optional=True, free=3),
    Model("log_pearson3", "Log-Pearson III (MoM)", 4, 1, _fit_with(fit_log_pearson3, _LOGS), log_pearson3_quantile, python=True, optional=True, free=3),
]
_CDFS = {
    "gumbel_mom": gumbel_cdf, "gumbel": gumbel_cdf, "gumbel_lmom": gumbel_cdf, "gev": gev_cdf, "gev_weighted": gev_cdf,
    "pearson3_lmom": signed_gamma_cdf, "log_pearson3": log_pearson3_cdf,
}
for _model in CATALOGUE:
    register_model(_model)
    register_distribution(_model.name, _CDFS[_model.name])


# ---- half-years -------------------------------------------------------------------------------

def fit_frequencies(series: DataFrame, models: list[str] | None = None) -> DataFrame:
    """``fit_all`` of series with a ``frequency_id``: (station, frequency) is the key, all in one pass."""
    return unkeyed(fit_all(keyed(series), models)).select(*FIT_COLUMNS)


def _gamma_terms(model: str, v: Value) -> list[Column]:
    """Origin, rate and shape of the gamma variable behind a model; of its logarithm for Log-Pearson III."""
    if model != "log_pearson3":
        return [v("epsilon"), v("alpha"), v("lambda")]
    g = F.when(F.abs(v("skew_log")) >= SMALL_SKEW, v("skew_log"))
    return [v("mu_log") - 2.0 * v("sigma_log") / g, 2.0 / (v("sigma_log") * g), 4.0 / (g * g)]


def both_seasons(fits: DataFrame, grid: list[float], models: list[str] | None = None) -> DataFrame:
    """Value that the yearly maximum exceeds with each probability, from the fits of both half-years.

    The half-years count as independent, so the value is the root of F_winter(q) F_summer(q) = 1 - p. It lies between the larger of the
    two seasons' quantiles at p and the larger of those at 1 - sqrt(1 - p). Stations without both fits give no row; every model
    with a distribution function takes part unless ``models`` names some. Log-Pearson III fits of next to no skew give null.
    Columns: ``station_code``, ``model``, catalogue ids, ``p``, ``q``.
    """
    upper = {1.0 - math.sqrt(1.0 - p): p for p in grid}
    points = quantiles(fits.filter(F.col("frequency_id").isin(WINTER, SUMMER)), [*grid, *upper])
    names = ["station_code", "model", "distribution_id", "estimation_method_id"]
    whole = F.coalesce(*[F.when(F.col("p") == u, F.lit(p)) for u, p in upper.items()], F.col("p"))
    is_low = F.col("p").isin(grid)
    season = lambda k: F.first(F.when(F.col("frequency_id") == k, F.col("params")), ignorenulls=True)
    rows = points.withColumns({"is_low": is_low, "p": whole}).groupBy(*names, "p").agg(
        F.max(F.when(F.col("is_low"), F.col("q"))).alias("lo"), F.max(F.when(~F.col("is_low"), F.col("q"))).alias("hi"),
        season(WINTER).alias("winter"), season(SUMMER).alias("summer"))
    rows = cut_lineage(rows.filter("winter is not null and summer is not null"))  # few: stations by probabilities
    v = lambda c: lambda key: F.col(c)[key]
    out = None
    for name in models or [n for n in MODELS if n in KNOWN]:
        m = MODELS[name]
        of_model = rows.filter(F.col("model") == name)
        if m.python:
            logs = name == "log_pearson3"
            ends = [F.log(c) if logs else c for c in (F.col("lo"), F.col("hi"))]
            root = gamma_product_udf(*ends, F.col("p"), *_gamma_terms(name, v("winter")), *_gamma_terms(name, v("summer")))
            root = F.exp(root) if logs else root
        else:
            cdf = KNOWN[name]
            root = bisect(F.col("lo"), F.col("hi"), lambda x, cdf=cdf: cdf(x, v("winter")) * cdf(x, v("summer")) < 1.0 - F.col("p"), 60)
        one = of_model.select(*names, "p", root.alias("q"))
        out = one if out is None else out.unionByName(one)
    return out


def seasonal_design_flows(fits: DataFrame, return_periods: tuple[int, ...] = RETURN_PERIODS, models: list[str] | None = None) -> DataFrame:
    """Flow of each return period of the yearly maximum, from winter and summer fits."""
    rows = both_seasons(fits, [1.0 / t for t in return_periods], models)
    return rows.withColumn("return_period", F.round(1.0 / F.col("p")).cast("int")).drop("p")
