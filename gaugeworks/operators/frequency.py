"""Flood-frequency fits.

Every fit maps a series frame to one row per station:
``station_code, model, distribution_id, estimation_method_id, frequency_id, params, year_start,
year_end, n, reason``. ``params`` is null and ``reason`` set where the model cannot be fitted.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.numeric import linspace, log_gamma, z_of_exceedance
from gaugeworks.functions.rounding import round_half_away
from gaugeworks.functions.special import gamma_quantile_udf, grid_logs_udf, weibull_udf
from gaugeworks.operators.series import finite, per_station, spread
from gaugeworks.schemas import ANNUAL, RETURN_PERIODS

# Extent and size of the location grid, as fractions of the smallest value.
GRID_SIZE = 200
GRID_LOW = 1e-4
GRID_HIGH = 0.999
# Ends of the probability grids.
P_LOW, P_HIGH = 0.0005, 0.9995
CI_POINTS, CURVE_POINTS = 200, 1000

_TOO_FEW = "fewer than 3 usable values"
FIT_COLUMNS = [
    "station_code", "model", "distribution_id", "estimation_method_id", "frequency_id", "params",
    "year_start", "year_end", "n", "reason",
]


def _period() -> list[Column]:
    return [F.min("t").alias("year_start"), F.max("t").alias("year_end"), F.count("x").cast("int").alias("n")]


@dataclass(frozen=True)
class Model:
    """A fit together with its quantile: ``quantile(param, p, z)`` with p the exceedance.

    ``python`` marks a quantile that visits Python; rows of other models then do not. ``optional`` models take part where they are named.
    ``free`` counts the parameters that are fitted.
    """

    name: str
    label: str
    distribution_id: int
    estimation_method_id: int
    fit: Callable[[DataFrame], DataFrame]
    quantile: Callable[[Callable[[str], Column], Column, Column], Column]
    python: bool = False
    optional: bool = False
    free: int = 2


def fit_lognormal_mom(series: DataFrame) -> DataFrame:
    """Mean and standard deviation of ln x over the positive values (F1)."""
    series = finite(series)
    ln = F.when(F.col("x") > 0, F.log("x"))
    df = series.groupBy("station_code").agg(
        *_period(), F.avg(ln).alias("mu_log"), F.stddev_samp(ln).alias("sigma_log"),
        F.count(ln).alias("n_pos"),
    )
    return df.select(
        "station_code", "year_start", "year_end", "n",
        "mu_log", "sigma_log", F.col("n_pos").cast("double").alias("n_used"),
        F.when(F.col("n_pos") < 3, _TOO_FEW).alias("reason"),
    )


def fit_lognormal_3p(series: DataFrame) -> DataFrame:
    """Bound from largest, smallest and median value, then moments of ln(x - bound) (F2).

    The order statistics are windows on the station, so the second pass needs no second shuffle.
    """
    series = finite(series)
    low, high, mid = (f("x").over(per_station()) for f in (F.min, F.max, F.median))
    spread = high + low - 2.0 * mid
    df = series.withColumns({
        "_low": low, "_spread": spread, "_eps": F.try_divide(high * low - mid * mid, spread),
    })
    fits = (F.col("_low") > 0) & (F.col("_eps") < F.col("_low"))
    ln = F.when(fits, F.log(F.when(F.col("x") > F.col("_eps"), F.col("x") - F.col("_eps"))))
    df = df.groupBy("station_code").agg(
        *_period(), F.first("_low").alias("low"), F.first("_eps").alias("epsilon"),
        F.avg(ln).alias("mu"), F.stddev_samp(ln).alias("sigma"),
    )
    reason = (
        F.when(F.col("n") < 3, _TOO_FEW)
        .when(F.col("low") <= 0, "values must be positive")
        .when(F.col("epsilon").isNull(), "largest plus smallest equals twice the median")
        .when(F.col("epsilon") >= F.col("low"), "bound not below the smallest value")
        .when(F.coalesce(F.col("sigma"), F.lit(0.0)) <= 0, "no variation")
    )
    return df.select(
        "station_code", "year_start", "year_end", "n", "epsilon", "mu", "sigma", reason.alias("reason")
    )


_EXTENT = ["year_start", "year_end", "n", "n_pos"]


def _profile(series: DataFrame, grid_size: int) -> DataFrame:
    """Estimates and log-likelihood at every grid point, next to the extent of the series.

    The positive values of a station (one per block) form one array; the sums of logarithms over it are taken per Arrow batch, for all grid
    points at once, and only then come the rows of the grid. Stations that cannot be fitted keep one row without a grid point, so no station is lost.
    """
    positive = F.when(F.col("x") > 0, F.col("x"))
    df = spread(finite(series)).groupBy("station_code").agg(
        *_period(), F.count(positive).alias("n_pos"), F.min(positive).alias("low"), F.sum(positive).alias("total"),
        F.sort_array(F.collect_list(positive)).alias("xs"),
    )
    start, stop = F.col("low") * GRID_LOW, F.col("low") * GRID_HIGH

    def bound(grid_no: Column) -> Column:
        return F.when(grid_no == grid_size - 1, stop).otherwise(start + grid_no * ((stop - start) / (grid_size - 1)))

    takes_part = F.col("n_pos") >= 3
    grid = F.when(takes_part, F.transform(F.sequence(F.lit(0), F.lit(grid_size - 1)), bound))
    logs = grid_logs_udf(F.when(takes_part, F.col("xs")), grid)
    sums = df.withColumn("logs", logs).drop("xs").select("*", F.posexplode_outer("logs").alias("grid_no", "sl")).drop("logs")
    eps = bound(F.col("grid_no"))
    sums = sums.withColumns({"epsilon": eps, "m": F.col("n_pos").cast("double")})
    m, sl = F.col("m"), F.col("sl")
    sd = F.col("total") - m * F.col("epsilon")
    sums = sums.withColumn("a", F.log(F.try_divide(sd, m)) - F.try_divide(sl, m))
    shape = (1.0 + F.sqrt(1.0 + 4.0 * F.col("a") / 3.0)) / (4.0 * F.col("a"))
    sums = sums.withColumn("lambda", F.when(F.col("a") > 0, shape))
    sums = sums.withColumn("alpha", F.col("lambda") * m / sd)
    lam, alpha = F.col("lambda"), F.col("alpha")
    loglik = m * lam * F.log(alpha) - m * log_gamma(lam) + (lam - 1.0) * sl - alpha * sd
    return sums.select(
        "station_code", *_EXTENT, "grid_no", "epsilon", "lambda", "alpha", F.nanvl(loglik, F.lit(None)).alias("loglik")
    )


def pearson3_profile(series: DataFrame, grid_size: int = GRID_SIZE) -> DataFrame:
    """Log-likelihood and conditional estimates at every grid point of the bound."""
    return _profile(series, grid_size).filter("loglik is not null").drop(*_EXTENT)


def fit_pearson3(series: DataFrame, grid_size: int = GRID_SIZE) -> DataFrame:
    """Best grid point, the first on ties."""
    best = F.max_by(
        F.struct("grid_no", "epsilon", "lambda", "alpha", "loglik"), F.struct("loglik", -F.col("grid_no"))
    ).alias("b")
    df = _profile(series, grid_size).groupBy("station_code").agg(*[F.first(c).alias(c) for c in _EXTENT], best)
    reason = F.when(F.col("n_pos") < 3, _TOO_FEW).when(
        F.col("b.loglik").isNull(), "likelihood undefined on the whole grid"
    )
    return df.select("station_code", "year_start", "year_end", "n", "b.*", reason.alias("reason"))


def fit_weibull(series: DataFrame, epsilon: float = 0.0) -> DataFrame:
    """Maximum likelihood for a given bound (F4). One series per array, solved per Arrow batch."""
    if epsilon < 0:
        raise ValueError("epsilon must not be negative")
    series = finite(series)
    ln = F.when(F.col("x") > epsilon, F.log(F.col("x") - epsilon))
    df = series.groupBy("station_code").agg(
        *_period(), F.min("x").alias("low"), F.stddev_pop(ln).alias("sd"),
        F.sort_array(F.collect_list(ln)).alias("ln_y"),
    )
    reason = (
        F.when(F.col("n") < 3, _TOO_FEW)
        .when(F.col("low") <= 0, "values must be positive")
        .when(F.col("low") <= epsilon, "bound not below the smallest value")
        .when(F.col("sd") < 1e-12, "no variation")
    )
    df = df.withColumn("reason", reason)
    # Rejected series get a stand-in so that the batch kernel sees no empty array.
    usable = F.when(F.col("reason").isNull(), F.col("ln_y")).otherwise(F.array(F.lit(0.0), F.lit(1.0)))
    df = df.withColumn("w", weibull_udf(usable))
    reason = F.coalesce("reason", F.when(F.isnan("w.beta"), "shape could not be bracketed"))
    good = reason.isNull()
    return df.select(
        "station_code", "year_start", "year_end", "n", F.lit(float(epsilon)).alias("epsilon"),
        F.when(good, F.col("w.alpha")).alias("alpha"), F.when(good, F.col("w.beta")).alias("beta"),
        reason.alias("reason"),
    )


def _params(names: dict[str, str]) -> Column:
    pairs: list[Column] = []
    for key, column in names.items():
        pairs += [F.lit(key), F.col(column)]
    return F.when(F.col("reason").isNull(), F.create_map(*pairs))


def _fit_with(fit: Callable[[DataFrame], DataFrame], names: dict[str, str]) -> Callable[[DataFrame], DataFrame]:
    def run(series: DataFrame) -> DataFrame:
        return fit(series).withColumn("params", _params(names))
    return run


MODELS: dict[str, Model] = {
    m.name: m
    for m in [
        Model(
            "lognormal_mom", "Log-Normal (MoM)", 2, 1,
            _fit_with(fit_lognormal_mom, {"mu_log": "mu_log", "sigma_log": "sigma_log", "n": "n_used"}),
            lambda v, p, z: F.exp(v("mu_log") + v("sigma_log") * z),
        ),
        Model(
            "lognormal_3p", "Log-Normal 3p (MLE)", 2, 2,
            _fit_with(fit_lognormal_3p, {"epsilon": "epsilon", "mu": "mu", "sigma": "sigma"}),
            lambda v, p, z: v("epsilon") + F.exp(v("mu") + v("sigma") * z), free=3,
        ),
        Model(
            "pearson3", "Pearson III (MLE)", 3, 2,
            _fit_with(fit_pearson3, {"epsilon": "epsilon", "lambda": "lambda", "alpha": "alpha", "loglik": "loglik"}),
            lambda v, p, z: v("epsilon") + gamma_quantile_udf(1.0 - p, v("lambda")) / v("alpha"),
            python=True, free=3,
        ),
        Model(
            "weibull", "Weibull (MLE)", 6, 2,
            _fit_with(fit_weibull, {"epsilon": "epsilon", "alpha": "alpha", "beta": "beta"}),
            lambda v, p, z: v("epsilon") + F.pow(-F.log(p), 1.0 / v("beta")) / v("alpha"),
        ),
    ]
}


def register_model(model: Model) -> None:
    """Add an estimator; everything below works with it."""
    MODELS[model.name] = model


def usual_models() -> list[str]:
    """The models that take part without being named: the four standard ones and those registered."""
    return [name for name, m in MODELS.items() if not m.optional]


def fit_all(series: DataFrame, models: list[str] | None = None, frequency_id: int = ANNUAL) -> DataFrame:
    """All chosen models on all stations, failures included."""
    out = None
    for name in models or usual_models():
        m = MODELS[name]
        one = m.fit(series).withColumns({
            "model": F.lit(name), "distribution_id": F.lit(m.distribution_id),
            "estimation_method_id": F.lit(m.estimation_method_id), "frequency_id": F.lit(frequency_id),
        }).select(*FIT_COLUMNS)
        out = one if out is None else out.unionByName(one)
    return out


def fit_failures(fits: DataFrame) -> DataFrame:
    return fits.filter("reason is not null").select("station_code", "model", "reason")


def _quantile_of(p: Column, z: Column) -> Column:
    """Quantile of whichever model a fit row holds, those in Python apart."""
    def v(key: str) -> Column:
        return F.col("params")[key]

    out = None
    for name, m in MODELS.items():
        if m.python:
            continue
        hit = F.col("model") == name
        out = F.when(hit, m.quantile(v, p, z)) if out is None else out.when(hit, m.quantile(v, p, z))
    return out


def grid_points(grid: list[float]) -> Column:
    """A fixed grid as one literal array of (p, z). Parsed as text: a thousand points at once."""
    return F.expr("array(" + ", ".join(
        f"named_struct('p', {p!r}D, 'z', {z_of_exceedance(p)!r}D)" for p in grid
    ) + ")")


def quantiles(fits: DataFrame, grid: list[float], extra: dict[float, int] | None = None) -> DataFrame:
    """``p, z, q`` of every fit at every exceedance probability of a fixed grid.

    The grid is a literal array exploded on the row, so no join and no shuffle is involved.
    Only rows of models whose quantile asks for it visit Python.
    """
    if any(not 0.0 < p < 1.0 for p in grid):
        raise ValueError("probabilities must lie strictly between 0 and 1")
    points = grid_points(grid)
    rows = fits.filter("reason is null").withColumn("_g", F.explode(points)).select("*", "_g.p", "_g.z").drop("_g")
    apart = [name for name, m in MODELS.items() if m.python]
    out = rows.filter(~F.col("model").isin(apart)).withColumn("q", _quantile_of(F.col("p"), F.col("z")))
    for name in apart:
        of_model = MODELS[name].quantile(lambda k: F.col("params")[k], F.col("p"), F.col("z"))
        out = out.unionByName(rows.filter(F.col("model") == name).withColumn("q", of_model))
    return out


def design_flows(fits: DataFrame, return_periods: tuple[int, ...] = RETURN_PERIODS) -> DataFrame:
    """Flow of each return period for each fit."""
    if any(t <= 1 for t in return_periods):
        raise ValueError("return_period must be > 1 year")
    rows = quantiles(fits, [1.0 / t for t in return_periods])
    period = F.round(1.0 / F.col("p")).cast("int")
    return rows.select(*FIT_COLUMNS[:-1], period.alias("return_period"), "q")


def ci_grid() -> list[float]:
    return linspace(P_LOW, P_HIGH, CI_POINTS)


def curve_grid() -> list[float]:
    return linspace(P_LOW, P_HIGH, CURVE_POINTS)


def fitted_rows(fits: DataFrame) -> DataFrame:
    """Rows of the fit log without ids (K5)."""
    info = F.to_json(F.struct("station_code", "frequency_id", "year_start", "year_end", "n"))
    return fits.filter("reason is null").select(
        "estimation_method_id", "distribution_id", "frequency_id",
        F.to_json("params").alias("distribution_params"), "station_code",
        info.alias("source_timeseries_info"),
    )


def discharge_rows(flows: DataFrame) -> DataFrame:
    """Rows of the discharge log without ids; the value is kept to three decimals."""
    q = F.create_map(F.lit("Q_estimated_m3s"), round_half_away(F.col("q"), 3))
    return flows.select(
        "station_code", "return_period", "distribution_id", "estimation_method_id", "frequency_id",
        F.to_json(F.map_concat("params", q)).alias("notes"),
    )


def weibull_exceedance(x: Column, epsilon: Column, alpha: Column, beta: Column) -> Column:
    """P(X >= x) of a Weibull fit."""
    return F.exp(-F.pow(alpha * (x - epsilon), beta))


