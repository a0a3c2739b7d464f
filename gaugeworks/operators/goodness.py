"""Goodness of fit: distance between a fitted and the empirical distribution (T6), and the chi-square test of classes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.numeric import normal_upper
from gaugeworks.functions.special import gamma_cdf_udf, normal_quantile_udf
from gaugeworks.operators.frequency import MODELS, weibull_exceedance
from gaugeworks.operators.series import ecdf_bounds, finite, is_finite, spread

#: Models whose distribution function is known here; ``register_distribution`` adds others.
KNOWN: dict[str, Callable[[Column, Callable[[str], Column]], Column]] = {}
CRITICAL_LAMBDA = 1.36  # fixed value: 5 % point
LAMBDA_TEST_ID = 7


def _normal_cdf(z: Column) -> Column:
    upper = normal_upper(F.abs(z))
    return F.when(z < 0, upper).otherwise(1.0 - upper)


def register_distribution(model: str, cdf: Callable[[Column, Callable[[str], Column]], Column]) -> None:
    """``cdf(x, param)`` of a registered model."""
    KNOWN[model] = cdf


def _lognormal_3p(x: Column, v: Callable[[str], Column]) -> Column:
    gap = F.when(x > v("epsilon"), x - v("epsilon"))
    return F.coalesce(_normal_cdf((F.log(gap) - v("mu")) / v("sigma")), F.lit(0.0))


register_distribution("pearson3", lambda x, v: gamma_cdf_udf((x - v("epsilon")) * v("alpha"), v("lambda")))
register_distribution("lognormal_mom", lambda x, v: F.when(x <= 0, 0.0).otherwise(_normal_cdf((F.log(x) - v("mu_log")) / v("sigma_log"))))
register_distribution("lognormal_3p", _lognormal_3p)
register_distribution("weibull", lambda x, v: F.when(x <= v("epsilon"), 0.0).otherwise(
    1.0 - weibull_exceedance(x, v("epsilon"), v("alpha"), v("beta"))))


def _cdf(models: list[str], x: Column) -> Column:
    """Distribution function of whichever of the models a row names."""
    if unknown := [m for m in models if m not in KNOWN]:
        raise ValueError(f"no distribution function for {', '.join(unknown)}")
    of = lambda m: KNOWN[m](x, lambda key: F.col("params")[key])
    return F.coalesce(*[F.when(F.col("model") == m, of(m)) for m in models]) if len(models) > 1 else of(models[0])


def lambda_kolmogorov(series: DataFrame, fits: DataFrame, model: str | list[str] = "pearson3") -> DataFrame:
    """D and D·√n of every fitted station; kept when below the critical value.

    ``fits`` has one row per station and model (see ``latest_per_key``) with ``params``. Several models share one ordering of the series
    and one join, and the result then names the ``model``. Stations are dealt over a fixed number of tasks, so no task orders a large part of the series.
    """
    models, named = ([model], []) if isinstance(model, str) else (list(model), ["model"])
    carried = [*named, *[c for c in ("fitted_distribution_id",) if c in fits.columns]]
    chosen = fits.filter(F.col("model").isin(models) & F.col("params").isNotNull()).select("station_code", "params", *carried)
    rows = ecdf_bounds(spread(series.filter(is_finite(F.col("x").cast("double"))))).join(chosen, "station_code")
    rows = rows.withColumn("f", _cdf(models, F.col("x")))
    df = rows.groupBy("station_code", *carried).agg(
        F.first("n").cast("int").alias("n"),
        F.max(F.greatest(F.col("upto") - F.col("f"), F.col("f") - F.col("below"))).alias("d"),
    )
    df = df.withColumn("lambda_stat", F.col("d") * F.sqrt(F.col("n").cast("double")))
    notes = F.format_string("n=%d, D=%.4f, λ=%.4f, critical λ=1.36 (α=5%%)", "n", "d", "lambda_stat")
    return df.select(
        "station_code", *carried, F.lit(LAMBDA_TEST_ID).alias("test_id"), "n", "d", "lambda_stat",
        notes.alias("result_notes"), (F.col("lambda_stat") < CRITICAL_LAMBDA).alias("result"),
    )


CHI_SQUARE_TEST_ID = 3
LEAST_EXPECTED = 5  # fixed value: a class of fewer expected values is merged with its neighbours
CHI_ALPHA = 0.05


def chi_square(series: DataFrame, fits: DataFrame, model: str = "pearson3") -> DataFrame:
    """Counts of values in classes of equal probability against a fit, for every fitted station.

    There are ceil(1 + log2 n) classes; their bounds come from the fitted curve, so a model needs no distribution function. Consecutive classes
    are merged until 5 values are expected in each, what is left over joins the last. Degrees of freedom are the classes less one and less the
    fitted parameters; stations without any are left out. ``fits`` as in ``lambda_kolmogorov``. Bounds of a station are at
    most as many as the logarithm of its values, and values are counted per class before anything moves.
    """
    m = MODELS[model]
    carried = [c for c in ("fitted_distribution_id",) if c in fits.columns]
    chosen = fits.filter((F.col("model") == model) & F.col("params").isNotNull()).select("station_code", "params", *carried)
    values = finite(series).filter("x is not null").select("station_code", "x")
    sizes = values.groupBy("station_code").agg(F.count("x").alias("n")).filter("n >= 3")
    df = chosen.join(sizes, "station_code").withColumn("k", F.ceil(1 + F.log2(F.col("n").cast("double"))).cast("int"))
    df = df.withColumn("j", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    df = df.withColumn("p", 1.0 - F.col("j") / F.col("k"))
    df = df.withColumn("q", m.quantile(lambda key: F.col("params")[key], F.col("p"), -normal_quantile_udf("p")))
    bounds = df.groupBy("station_code", *carried).agg(F.first("n").alias("n"), F.first("k").alias("k"), F.sort_array(F.collect_list("q")).alias("bounds"))
    bounds = bounds.filter((F.size("bounds") == F.col("k") - 1) & ~F.exists("bounds", F.isnan))
    width = F.least(F.ceil(F.lit(LEAST_EXPECTED) * F.col("k") / F.col("n")), F.col("k")).cast("int")
    bounds = bounds.withColumn("width", width).withColumn("classes", F.floor(F.col("k") / F.col("width")).cast("int"))
    rows = values.join(bounds, "station_code")
    place = F.floor(F.size(F.filter("bounds", lambda b: b < F.col("x"))) / F.col("width")).cast("int")
    own = ["station_code", *carried, "n", "k", "width", "classes"]
    counts = rows.groupBy(*own, F.least(place, F.col("classes") - 1).alias("place")).agg(F.count(F.lit(1)).alias("seen"))
    parts = F.when(F.col("place") == F.col("classes") - 1, F.col("k") - F.col("width") * F.col("place")).otherwise(F.col("width"))
    expected = F.col("n") * parts / F.col("k")
    sums = counts.groupBy(*own).agg((F.sum(F.col("seen") * F.col("seen") / expected) - F.col("n")).alias("chi_square"))  # empty classes add their expected values
    sums = sums.withColumn("df", F.col("classes") - 1 - m.free).filter("df >= 1")
    sums = sums.withColumn("p_value", 1.0 - gamma_cdf_udf(F.greatest("chi_square", F.lit(0.0)) / 2, F.col("df") / 2))
    notes = F.format_string("n=%d, classes=%d, χ²=%.4f, df=%d, p=%.4f (α=5%%)", "n", "classes", "chi_square", "df", "p_value")
    return sums.select("station_code", *carried, F.lit(CHI_SQUARE_TEST_ID).alias("test_id"), F.col("n").cast("int").alias("n"), "classes", "df", "chi_square", "p_value",
                       notes.alias("result_notes"), (F.col("p_value") >= CHI_ALPHA).alias("result"))
