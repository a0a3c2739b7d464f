"""Queries of the catalogue models beyond the standard four, of the chi-square test and of the half-years, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.operators import bootstrap, extremes, frequency, goodness
from gaugeworks.operators import series as srs
from gaugeworks.operators import statistics as st
from gaugeworks.plans import adapters as ad
from gaugeworks.plans import jobs
from gaugeworks.plans.oracle import (
    LN, LN3, MEAS, ORACLE, PROFILE, SEASONAL, SERIES, WEIBULL, _gamma_cdf, _normal_cdf, _number, _points, _r, _with, ANNUAL as ANNUAL_SQL,
)
from gaugeworks.plans.queries import SAMPLES, _measurements, _r as _round, _series, query
from gaugeworks.session import cut_lineage, scratch_path

CLOSED_FORM = ["gumbel_mom", "gumbel", "gumbel_lmom", "gev", "gev_weighted"]
GAMMA = ["pearson3_lmom", "log_pearson3"]
LOGGED = ["lognormal_mom", "gumbel_mom", "gumbel_lmom", "gev"]
BAND_MODELS = ["gumbel_lmom", "gev"]


# ---- fits -------------------------------------------------------------------------------------

def _fit(name: str, fit, columns: list[str]) -> None:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return fit(ad.all_series(spark, sf)).filter("reason is null").select("station_code", "year_start", "year_end", "n", *_round(*columns, digits=5))
    run.__name__ = name
    query(run)


_fit("fit_gumbel_mom", extremes.fit_gumbel_mom, ["location", "scale"])
_fit("fit_gumbel", extremes.fit_gumbel, ["location", "scale"])
_fit("fit_gumbel_lmom", extremes.fit_gumbel_lmom, ["location", "scale"])
_fit("fit_gev", extremes.fit_gev, ["location", "scale", "shape"])
_fit("fit_gev_weighted", lambda s: extremes.fit_gev(s, weighted=True), ["location", "scale", "shape"])
_fit("fit_pearson3_lmom", extremes.fit_pearson3_lmom, ["epsilon", "lambda", "alpha"])
_fit("fit_log_pearson3", extremes.fit_log_pearson3, ["mu_log", "sigma_log", "skew_log"])


@query
def linear_moments(spark: SparkSession, sf: str) -> DataFrame:
    """First two linear moments and L-skewness, unbiased and by plotting positions."""
    series = _series(spark, sf)
    both = [extremes.ordered_moments(series, w).filter("reason is null").select("station_code", F.lit(w).alias("weighted"), "n", *_round("l1", "l2", "t3")) for w in (False, True)]
    return both[0].unionByName(both[1])


@query
def design_flows_extremes(spark: SparkSession, sf: str) -> DataFrame:
    fits = frequency.fit_all(_series(spark, sf), CLOSED_FORM)
    return frequency.design_flows(fits).select("station_code", "model", "return_period", *_round("q", digits=3))


@query
def design_flows_gamma(spark: SparkSession, sf: str) -> DataFrame:
    """Pearson III by linear moments and Log-Pearson III, of either sign of skew."""
    fits = frequency.fit_all(_series(spark, sf), GAMMA)
    return frequency.design_flows(fits).select("station_code", "model", "return_period", *_round("q", digits=3))


@query
def quantile_curve_gev(spark: SparkSession, sf: str) -> DataFrame:
    """The whole grid of the bands."""
    fits = frequency.fit_all(ad.all_series(spark, sf), ["gev"])
    return frequency.quantiles(fits, frequency.ci_grid()).select("station_code", "p", *_round("q", digits=2))


@query
def lambda_kolmogorov_extremes(spark: SparkSession, sf: str) -> DataFrame:
    series = _series(spark, sf)
    fits = cut_lineage(frequency.fit_all(series, CLOSED_FORM))
    return goodness.lambda_kolmogorov(series, fits, CLOSED_FORM).select("model", "station_code", "n", *_round("d", "lambda_stat"), "result")


@query
def chi_square_fit(spark: SparkSession, sf: str) -> DataFrame:
    """The four standard models against classes of equal probability."""
    series = _series(spark, sf)
    fits = cut_lineage(frequency.fit_all(series))
    out = None
    for name in frequency.usual_models():
        one = goodness.chi_square(series, fits, name).select(
            F.lit(name).alias("model"), "station_code", "test_id", "n", "classes", "df", *_round("chi_square", "p_value", digits=5), "result")
        out = one if out is None else out.unionByName(one)
    return out


@query
def bootstrap_ci_gev(spark: SparkSession, sf: str) -> DataFrame:
    """Bands of both models by linear moments on the whole grid, with draws that SQL can redo."""
    bands = bootstrap.bootstrap_ci(ad.all_series(spark, sf), BAND_MODELS, SAMPLES, draw="hash")
    points = bands.filter("n_valid > 0").select("station_code", "model", "n_valid", F.explode(F.arrays_zip("probabilities", "q_lower", "q_upper")).alias("g"))
    return points.select("station_code", "model", F.col("g.probabilities").alias("p"), F.round("g.q_lower", 2).alias("q_lower"), F.round("g.q_upper", 2).alias("q_upper"), "n_valid")


# ---- half-years -------------------------------------------------------------------------------

def _frequency_series(spark: SparkSession, sf: str) -> DataFrame:
    measurements = _measurements(spark, sf)
    return cut_lineage(srs.frequency_series(st.annual(measurements), st.seasonal(measurements)))


@query
def seasonal_design_flows(spark: SparkSession, sf: str) -> DataFrame:
    """Flows of the yearly maximum out of winter and summer fits."""
    models = ["lognormal_mom", "gumbel_mom"]
    fits = cut_lineage(extremes.fit_frequencies(_frequency_series(spark, sf), models))
    return extremes.seasonal_design_flows(fits, models=models).select("station_code", "model", "return_period", *_round("q", digits=3))


@query
def estimation_log(spark: SparkSession, sf: str) -> DataFrame:
    """The job itself on annual, winter and summer series: one row per logged parameter."""
    series = _frequency_series(spark, sf)
    made = jobs.log_estimates(spark, scratch_path(spark, "estimates"), series, models=LOGGED, n_samples=50)
    info = F.col("source_timeseries_info")
    params = F.explode(F.from_json("distribution_params", "map<string,double>")).alias("name", "value")
    rows = made["fitted_distributions"].select(
        "id", "station_code", "distribution_id", "estimation_method_id", "frequency_id", F.get_json_object(info, "$.n").cast("int").alias("n"),
        F.get_json_object(info, "$.year_start").cast("int").alias("year_start"), F.get_json_object(info, "$.year_end").cast("int").alias("year_end"), params)
    return rows.withColumn("value", F.round("value", 5))


# ---- SQL --------------------------------------------------------------------------------------

EULER = 0.5772156649015329  # fixed value

_LMOM = """places AS (SELECT station_code, t, x, count(*) OVER w AS n, row_number() OVER (PARTITION BY station_code ORDER BY x, t) AS i FROM series WINDOW w AS (PARTITION BY station_code)),
pwm AS (SELECT station_code, CAST(min(t) AS INT) AS year_start, CAST(max(t) AS INT) AS year_end, CAST(any_value(n) AS INT) AS n, sum(x) / any_value(n) AS b0,
  sum(x * (i - 1)) / any_value(n * (n - 1.0::DOUBLE)) AS b1, sum(x * (i - 1) * (i - 2)) / any_value(n * (n - 1.0::DOUBLE) * (n - 2)) AS b2,
  sum(x * (i - 0.35::DOUBLE) / n) / any_value(n) AS w1, sum(x * pow((i - 0.35::DOUBLE) / n, 2)) / any_value(n) AS w2
  FROM places GROUP BY station_code HAVING count(*) >= 3 AND min(x) < max(x)),
lmom AS (SELECT station_code, year_start, year_end, n, FALSE AS weighted, b0 AS l1, 2 * b1 - b0 AS l2, (6 * b2 - 6 * b1 + b0) / (2 * b1 - b0) AS t3 FROM pwm
  UNION ALL SELECT station_code, year_start, year_end, n, TRUE, b0, 2 * w1 - b0, (6 * w2 - 6 * w1 + b0) / (2 * w1 - b0) FROM pwm WHERE 2 * w1 > b0)"""


def _gev(source: str, key: str, name: str = "gev") -> str:
    """GEV of rows (key, l1, l2, t3): the ratio of sums of powers is bisected, as 2 (1 - 3^-k) / (1 - 2^-k) - 3 falls with k."""
    t3 = "2 * (1 - pow(3.0, -(lo + hi) / 2)) / (1 - pow(2.0, -(lo + hi) / 2)) - 3"
    return f"""{name}_root AS (
  SELECT {key}, t3, -0.999999::DOUBLE AS lo, 59.7::DOUBLE AS hi, 0 AS step FROM {source} WHERE abs(t3) < 1
  UNION ALL SELECT {key}, t3, CASE WHEN {t3} > t3 THEN (lo + hi) / 2 ELSE lo END, CASE WHEN {t3} > t3 THEN hi ELSE (lo + hi) / 2 END, step + 1 FROM {name}_root WHERE step < 80),
{name}_k AS (SELECT {key}, (lo + hi) / 2 AS k FROM {name}_root WHERE step = 80),
{name} AS (SELECT *, l1 - scale * (1 - gamma(1 + k)) / k AS location FROM (
  SELECT *, l2 * k / ((1 - pow(2.0, -k)) * gamma(1 + k)) AS scale FROM {source} JOIN {name}_k USING ({key})))"""


_GUMBEL_ML = """packed_x AS (SELECT station_code, CAST(min(t) AS INT) AS year_start, CAST(max(t) AS INT) AS year_end, CAST(count(*) AS INT) AS n, list(x) AS xs, min(x) AS low, avg(x) AS mean
  FROM series GROUP BY station_code HAVING count(*) >= 3 AND min(x) < max(x)),
scale_root AS (SELECT station_code, 0.0::DOUBLE AS lo, mean - low AS hi, 0 AS step FROM packed_x
  UNION ALL SELECT station_code, CASE WHEN score < 0 THEN mid ELSE lo END, CASE WHEN score < 0 THEN hi ELSE mid END, step + 1 FROM (
    SELECT r.station_code, lo, hi, step, (lo + hi) / 2 AS mid, (lo + hi) / 2 - mean
      + list_sum(list_transform(xs, lambda x: x * exp(-(x - low) / ((lo + hi) / 2)))) / list_sum(list_transform(xs, lambda x: exp(-(x - low) / ((lo + hi) / 2)))) AS score
    FROM scale_root r JOIN packed_x USING (station_code) WHERE step < 60)),
gumbel_ml AS (SELECT station_code, year_start, year_end, n, (lo + hi) / 2 AS scale,
  low - (lo + hi) / 2 * ln(list_sum(list_transform(xs, lambda x: exp(-(x - low) / ((lo + hi) / 2)))) / n) AS location FROM scale_root JOIN packed_x USING (station_code) WHERE step = 60)"""

_GUMBEL_MOM = f"""gumbel_mo AS (SELECT station_code, year_start, year_end, n, scale, mean - {EULER!r} * scale AS location FROM (
  SELECT station_code, CAST(min(t) AS INT) AS year_start, CAST(max(t) AS INT) AS year_end, CAST(count(*) AS INT) AS n, avg(x) AS mean, stddev_samp(x) * sqrt(6) / pi() AS scale
  FROM series GROUP BY station_code HAVING count(*) >= 3 AND min(x) < max(x)))"""

_GUMBEL_LM = f"gumbel_lm AS (SELECT *, l2 / ln(2) AS scale, l1 - {EULER!r} * l2 / ln(2) AS location FROM lmom WHERE NOT weighted)"

_P3_LM = """p3_shape AS (SELECT *, CASE WHEN abs(t3) < 1.0::DOUBLE / 3 THEN (1 + 0.2906 * z) / (z + 0.1882 * z * z + 0.0442 * z * z * z)
    ELSE (0.36067 * y - 0.59567 * y * y + 0.25361 * y * y * y) / (1 - 2.78861 * y + 2.56096 * y * y - 0.77045 * y * y * y) END AS lam
  FROM (SELECT *, 3 * pi() * t3 * t3 AS z, 1 - abs(t3) AS y FROM lmom WHERE NOT weighted AND abs(t3) < 1 AND abs(t3) >= 1e-6)),
p3_lm AS (SELECT *, l1 - lam / alpha AS epsilon FROM (
  SELECT *, sign(t3) * sqrt(lam) / (l2 * sqrt(pi()) * sqrt(lam) * gamma(lam) / gamma(lam + 0.5)) AS alpha FROM p3_shape))""".replace(
    "gamma(lam) / gamma(lam + 0.5)", "exp(lgamma(lam) - lgamma(lam + 0.5))")

_LP3 = """logs AS (SELECT station_code, t, x, CASE WHEN x > 0 THEN ln(x) END AS y FROM series),
lp3 AS (SELECT station_code, CAST(min(t) AS INT) AS year_start, CAST(max(t) AS INT) AS year_end, CAST(count(*) AS INT) AS n, avg(y) AS mu_log, stddev_samp(y) AS sigma_log,
  count(y) * sum(pow(y - m, 3)) / ((count(y) - 1.0::DOUBLE) * (count(y) - 2) * pow(stddev_samp(y), 3)) AS skew_log
  FROM (SELECT *, avg(y) OVER (PARTITION BY station_code) AS m FROM logs) GROUP BY station_code HAVING count(y) >= 3 AND stddev_samp(y) > 1e-12)"""


def _columns(names: list[str], alias: dict[str, str] | None = None) -> str:
    return ", ".join(f'{_r((alias or {}).get(c, c), 5)} AS "{c}"' for c in names)


def _gamma_roots(source: str, grid: list[float]) -> str:
    """x with the probability 1 - p (rate above 0) or p below it, of rows (station_code, model, lam, up).

    Shapes are large where there is next to no skew; terms fall like a normal density beyond x - shape, so some 60 deviations are enough.
    """
    whole = _gamma_cdf("((lo + hi) / 2)", "lam")
    few = whole.replace("CAST(200 + greatest(((lo + hi) / 2), 0) * 2 AS BIGINT)", "CAST(300 + 60 * sqrt((lo + hi) / 2) AS BIGINT)")
    assert few != whole
    below = f"{few} < prob"
    return f"""{_points(grid)}, gamma_root AS (
  SELECT station_code, model, p, CASE WHEN up THEN 1 - p ELSE p END AS prob, lam, 0.0::DOUBLE AS lo, lam + 40 * sqrt(lam) + 40 AS hi, 0 AS step FROM {source}, points
  UNION ALL SELECT station_code, model, p, prob, lam, CASE WHEN {below} THEN (lo + hi) / 2 ELSE lo END, CASE WHEN {below} THEN hi ELSE (lo + hi) / 2 END, step + 1 FROM gamma_root WHERE step < 60)"""


def _chi_square(fits: dict[str, tuple[str, str, int]]) -> str:
    """Classes by the distribution function of each model: (table, its value at x, fitted parameters)."""
    parts = " UNION ALL ".join(f"SELECT '{m}' AS model, station_code, {free} AS free, {cdf} AS f FROM series JOIN {table} USING (station_code)" for m, (table, cdf, free) in fits.items())
    return f"""probs AS ({parts}),
sized AS (SELECT *, count(*) OVER (PARTITION BY model, station_code) AS n FROM probs),
classed AS (SELECT *, CAST(ceil(1 + log2(n)) AS BIGINT) AS k FROM sized),
widths AS (SELECT *, least(CAST(ceil(5 * k / n::DOUBLE) AS BIGINT), k) AS width FROM classed),
placed AS (SELECT *, k // width AS classes, least(least(CAST(floor(f * k) AS BIGINT), k - 1) // width, k // width - 1) AS place FROM widths),
seen AS (SELECT model, station_code, free, n, k, width, classes, place, count(*) AS o FROM placed GROUP BY ALL),
chi AS (SELECT model, station_code, n, classes, classes - 1 - free AS df,
  sum(o * o / (n * CASE WHEN place = classes - 1 THEN k - width * place ELSE width END / k::DOUBLE)) - n AS h FROM seen GROUP BY model, station_code, n, classes, free),
tested AS (SELECT *, 1 - {_gamma_cdf('(greatest(h, 0) / 2)', '(df / 2.0::DOUBLE)')} AS p_value FROM chi WHERE df >= 1)"""


def _halves() -> str:
    """Annual, winter and summer maxima."""
    return ", ".join([MEAS, ANNUAL_SQL, SEASONAL, """halves AS (SELECT station_code, 1 AS frequency_id, hydro_year AS t, WQ AS x FROM annual WHERE WQ IS NOT NULL
  UNION ALL SELECT station_code, CASE season WHEN 'winter' THEN 2 ELSE 3 END, hydro_year, WQ FROM seasonal WHERE WQ IS NOT NULL)""",
        "series AS (SELECT station_code || '|' || frequency_id AS station_code, t, x FROM halves)"])


def _sql() -> dict[str, str]:
    q: dict[str, str] = {}
    recursive = lambda *parts: "WITH RECURSIVE " + ", ".join(parts) + " "
    extent = "station_code, year_start, year_end, n"
    two, three = ["location", "scale"], ["location", "scale", "shape"]
    gev = _gev("(SELECT * FROM lmom WHERE NOT weighted)", "station_code")
    gevw = _gev("(SELECT * FROM lmom WHERE weighted)", "station_code", "gevw")
    q["linear_moments"] = _with(SERIES, _LMOM) + f"SELECT station_code, weighted, n, {_r('l1')} AS l1, {_r('l2')} AS l2, {_r('t3')} AS t3 FROM lmom"
    q["fit_gumbel_mom"] = _with(SERIES, _GUMBEL_MOM) + f"SELECT {extent}, {_columns(two)} FROM gumbel_mo"
    q["fit_gumbel"] = recursive(SERIES, _GUMBEL_ML) + f"SELECT {extent}, {_columns(two)} FROM gumbel_ml"
    q["fit_gumbel_lmom"] = _with(SERIES, _LMOM, _GUMBEL_LM) + f"SELECT {extent}, {_columns(two)} FROM gumbel_lm"
    q["fit_gev"] = recursive(SERIES, _LMOM, gev) + f"SELECT {extent}, {_columns(three, {'shape': 'k'})} FROM gev"
    q["fit_gev_weighted"] = recursive(SERIES, _LMOM, gevw) + f"SELECT {extent}, {_columns(three, {'shape': 'k'})} FROM gevw"
    q["fit_pearson3_lmom"] = _with(SERIES, _LMOM, _P3_LM) + f"SELECT {extent}, {_columns(['epsilon', 'lambda', 'alpha'], {'lambda': 'lam'})} FROM p3_lm"
    q["fit_log_pearson3"] = _with(SERIES, _LP3) + f"SELECT {extent}, {_columns(['mu_log', 'sigma_log', 'skew_log'])} FROM lp3"

    fits = [SERIES, _LMOM, _GUMBEL_MOM, _GUMBEL_ML, _GUMBEL_LM, gev, gevw]
    tables = {"gumbel_mom": "gumbel_mo", "gumbel": "gumbel_ml", "gumbel_lmom": "gumbel_lm", "gev": "gev", "gev_weighted": "gevw"}
    u = "ln(-ln(1 - p))"
    curve = {m: f"location - scale * {u}" if m.startswith("gumbel") else f"location + scale * (1 - exp(k * {u})) / k" for m in tables}
    union = " UNION ALL ".join(f"SELECT station_code, '{m}' AS model, p, {curve[m]} AS q FROM {t}, points" for m, t in tables.items())
    q["design_flows_extremes"] = recursive(*fits, _points([0.01, 0.001]), f"flows AS ({union})") + (
        f"SELECT station_code, model, CAST(round(1 / p) AS INT) AS return_period, {_r('q', 3)} AS q FROM flows")
    q["quantile_curve_gev"] = recursive(SERIES, _LMOM, gev, _points(frequency.ci_grid())) + f"SELECT station_code, p, {_r(curve['gev'], 2)} AS q FROM gev, points"
    shapes = """gammas AS (SELECT station_code, 'pearson3_lmom' AS model, lam, alpha > 0 AS up FROM p3_lm
  UNION ALL SELECT station_code, 'log_pearson3', 4 / (skew_log * skew_log), skew_log > 0 FROM lp3)"""
    q["design_flows_gamma"] = recursive(SERIES, _LMOM, _P3_LM, _LP3, shapes, _gamma_roots("gammas", [0.01, 0.001])) + (
        "SELECT r.station_code, r.model, CAST(round(1 / p) AS INT) AS return_period, "
        + _r("CASE r.model WHEN 'pearson3_lmom' THEN epsilon + (lo + hi) / 2 / alpha ELSE exp(mu_log + sigma_log * ((lo + hi) / 2 - r.lam) * skew_log / 2) END", 3)
        + " AS q FROM gamma_root r LEFT JOIN p3_lm p ON p.station_code = r.station_code LEFT JOIN lp3 l ON l.station_code = r.station_code WHERE step = 60")
    cdf = {m: "exp(-exp(-(x - location) / scale))" if m.startswith("gumbel") else
           "CASE WHEN 1 - k * (x - location) / scale <= 0 THEN CASE WHEN k > 0 THEN 1.0 ELSE 0.0 END ELSE exp(-pow(greatest(1 - k * (x - location) / scale, 0), 1 / k)) END" for m in tables}
    union = " UNION ALL ".join(f"SELECT '{m}' AS model, s.station_code, s.n, s.i, {cdf[m]} AS f FROM places s JOIN {t} USING (station_code)" for m, t in tables.items())
    q["lambda_kolmogorov_extremes"] = recursive(*fits, f"dist AS ({union})") + (
        f"SELECT model, station_code, CAST(n AS INT) AS n, {_r('d')} AS d, {_r('d * sqrt(n)')} AS lambda_stat, d * sqrt(n) < 1.36 AS result FROM ("
        "SELECT model, station_code, any_value(n) AS n, max(greatest(i / n - f, f - (i - 1) / n)) AS d FROM dist GROUP BY ALL)")

    tail = _normal_cdf("(({y} - {m}) / {s})")
    normal = lambda y, m, s: tail.replace("{y}", y).replace("{m}", m).replace("{s}", s)
    standard = {
        "lognormal_mom": ("(SELECT * FROM ln_moments WHERE n_pos >= 3)", f"CASE WHEN x <= 0 THEN 0.0 ELSE {normal('ln(greatest(x, 1e-300))', 'mu_log', 'sigma_log')} END", 2),
        "lognormal_3p": ("ln3", normal("ln(x - epsilon)", "mu", "sigma"), 3),
        "pearson3": ("pearson", _gamma_cdf("((x - epsilon) * alpha)", "lam"), 3),
        "weibull": ("weib", "1 - exp(-pow(alpha * x, beta))", 2),
    }
    q["chi_square_fit"] = recursive(SERIES, LN.format(s="series"), LN3.format(s="series"), PROFILE, WEIBULL, _chi_square(standard)) + (
        f"SELECT model, station_code, 3 AS test_id, CAST(n AS INT) AS n, CAST(classes AS INT) AS classes, CAST(df AS INT) AS df, {_r('h', 5)} AS chi_square, {_r('p_value', 5)} AS p_value, "
        "p_value >= 0.05 AS result FROM tested")

    draws = f"""packed_b AS (SELECT station_code, list(x ORDER BY x) AS xs, count(*) AS n FROM (SELECT station_code, x FROM series_all WHERE x > 0) GROUP BY 1 HAVING count(*) >= 3),
series AS (SELECT station_code || '~' || rep AS station_code, j AS t, xs[1 + CAST(('0x' || substr(md5(concat_ws('|', '42', station_code, CAST(rep AS VARCHAR), CAST(j AS VARCHAR))), 1, 8)) AS BIGINT) % n] AS x
  FROM (SELECT *, unnest(range(n)) AS j FROM (SELECT *, unnest(range({SAMPLES})) AS rep FROM packed_b)))"""
    band = " UNION ALL ".join(f"SELECT regexp_replace(station_code, '~[0-9]+$', '') AS station_code, '{m}' AS model, p, {curve[m]} AS q FROM {tables[m]}, points" for m in BAND_MODELS)
    q["bootstrap_ci_gev"] = recursive(SERIES.replace(", series AS (", ", series_all AS ("), draws, _LMOM, _GUMBEL_LM, gev, _points(bootstrap.ci_grid()), f"curves AS ({band})") + (
        f"SELECT station_code, model, p, {_r('quantile_cont(q, 0.05)', 2)} AS q_lower, {_r('quantile_cont(q, 0.95)', 2)} AS q_upper, CAST(count(q) AS INT) AS n_valid FROM curves GROUP BY 1, 2, 3")

    pairs = f"""fits AS (SELECT station_code, 'gumbel_mom' AS model, location AS a, scale AS b FROM gumbel_mo
  UNION ALL SELECT station_code, 'lognormal_mom', mu_log, sigma_log FROM ln_moments WHERE n_pos >= 3),
named AS (SELECT split_part(station_code, '|', 1) AS station_code, split_part(station_code, '|', 2) AS f, model, a, b FROM fits),
half_pairs AS (SELECT w.station_code, w.model, w.a AS a1, w.b AS b1, s.a AS a2, s.b AS b2, rp FROM named w JOIN named s ON w.station_code = s.station_code AND w.model = s.model
  CROSS JOIN (VALUES (100), (1000)) v(rp) WHERE w.f = '2' AND s.f = '3'),
flow_root AS (SELECT *, 0.0::DOUBLE AS lo, 30.0::DOUBLE AS hi, 0 AS step FROM half_pairs
  UNION ALL SELECT station_code, model, a1, b1, a2, b2, rp, CASE WHEN low THEN (lo + hi) / 2 ELSE lo END, CASE WHEN low THEN hi ELSE (lo + hi) / 2 END, step + 1 FROM (
    SELECT *, CASE model WHEN 'gumbel_mom' THEN exp(-exp(-(exp((lo + hi) / 2) - a1) / b1) - exp(-(exp((lo + hi) / 2) - a2) / b2))
      ELSE ({normal('(lo + hi) / 2', 'a1', 'b1')}) * ({normal('(lo + hi) / 2', 'a2', 'b2')}) END < 1 - 1.0::DOUBLE / rp AS low FROM flow_root WHERE step < 80))"""
    q["seasonal_design_flows"] = recursive(_halves(), LN.format(s="series"), _GUMBEL_MOM, pairs) + (
        f"SELECT station_code, model, rp AS return_period, {_r('exp((lo + hi) / 2)', 3)} AS q FROM flow_root WHERE step = 80")

    values = " UNION ALL ".join(
        f"SELECT {extent}, {d} AS distribution_id, {m} AS estimation_method_id, {name!r} AS name, {column} AS value FROM {t}"
        for t, d, m, names in (("(SELECT * FROM ln_moments WHERE n_pos >= 3)", 2, 1, {"mu_log": "mu_log", "sigma_log": "sigma_log", "n": "CAST(n_pos AS DOUBLE)"}),
                               ("gumbel_mo", 1, 1, {"location": "location", "scale": "scale"}), ("gumbel_lm", 1, 3, {"location": "location", "scale": "scale"}),
                               ("gev", 5, 3, {"location": "location", "scale": "scale", "shape": "k"}))
        for name, column in names.items())
    order = "station_code, distribution_id, estimation_method_id, frequency_id"
    q["estimation_log"] = recursive(_halves(), LN.format(s="series"), _GUMBEL_MOM, _LMOM, _GUMBEL_LM, gev, f"""loose AS ({values}),
parts AS (SELECT split_part(station_code, '|', 1) AS station_code, CAST(split_part(station_code, '|', 2) AS INT) AS frequency_id, * EXCLUDE (station_code) FROM loose),
ids AS (SELECT {order}, {_number('', order)} AS id FROM (SELECT DISTINCT {order} FROM parts))""") + (
        f"SELECT id, station_code, distribution_id, estimation_method_id, frequency_id, n, year_start, year_end, name, {_r('value', 5)} AS value FROM parts JOIN ids USING ({order})")
    return q


ORACLE |= _sql()
