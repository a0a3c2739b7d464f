"""Catalogue models: definitions, closed forms and brute force."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeworks.functions import resampling
from gaugeworks.operators import bootstrap, extremes, frequency, goodness
from gaugeworks.operators import series as srs
from gaugeworks.plans import jobs
from gaugeworks.sources import tables
from tests.conftest import by_key

NAMES = [m.name for m in extremes.CATALOGUE]
ALL = ["lognormal_mom", "lognormal_3p", "pearson3", "weibull", *NAMES]


def sample(seed, n, skew=1.0):
    r = random.Random(seed)
    return [round(50 + 30 * r.gammavariate(2, 1) * skew, 3) if skew > 0 else round(300 + 30 * r.gammavariate(2, 1) * skew, 3) for _ in range(n)]


def test_linear_moments_from_their_definition(make_series):
    """Half the mean distance of pairs; the mean bend of triples."""
    values = {"a": sample(1, 9), "b": [3.0, 3.0, 8.0, 1.0, 3.0], "c": sample(2, 12, -1.0)}
    got = by_key(extremes.ordered_moments(make_series(**values)))
    for s, xs in values.items():
        pairs, triples = [sorted(p) for p in itertools.combinations(xs, 2)], [sorted(p) for p in itertools.combinations(xs, 3)]
        l2 = sum(b - a for a, b in pairs) / len(pairs) / 2
        l3 = sum(c - 2 * b + a for a, b, c in triples) / len(triples) / 3
        assert got[s].l1 == pytest.approx(sum(xs) / len(xs)) and got[s].l2 == pytest.approx(l2) and got[s].t3 == pytest.approx(l3 / l2)
    weighted = by_key(extremes.ordered_moments(make_series(**values), weighted=True))
    for s, xs in values.items():
        b1 = sum((i + 0.65) / len(xs) * x for i, x in enumerate(sorted(xs))) / len(xs)
        assert weighted[s].l2 == pytest.approx(2 * b1 - sum(xs) / len(xs))


def test_gev_gives_back_its_linear_moments(make_series):
    values = {f"s{k}": sample(k, 15 + k, 1.0 if k % 2 else -1.0) for k in range(8)}
    series = make_series(**values)
    moments, fits = by_key(extremes.ordered_moments(series)), by_key(extremes.fit_gev(series))
    for s, f in fits.items():
        k, g = f.shape, lambda r, k=f.shape: 1 - r ** -k
        assert f.scale * math.gamma(1 + k) * g(2) / k == pytest.approx(moments[s].l2)
        assert f.location + f.scale * (1 - math.gamma(1 + k)) / k == pytest.approx(moments[s].l1)
        assert 2 * g(3) / g(2) - 3 == pytest.approx(moments[s].t3, abs=1e-12)
    assert min(f.shape for f in fits.values()) < 0 < max(f.shape for f in fits.values())


def test_gumbel_likelihood_is_largest(make_series):
    xs = sample(5, 30)
    f = by_key(extremes.fit_gumbel(make_series(a=xs, b=[1e6 + x for x in xs])))

    def loglik(location, scale):
        return sum(-math.log(scale) - (x - location) / scale - math.exp(-(x - location) / scale) for x in xs)

    best = loglik(f["a"].location, f["a"].scale)
    assert all(best > loglik(f["a"].location + a, f["a"].scale + b) for a in (-0.05, 0.0, 0.05) for b in (-0.05, 0.0, 0.05) if a or b)
    assert f["b"].location - 1e6 == pytest.approx(f["a"].location, rel=1e-6) and f["b"].scale == pytest.approx(f["a"].scale, rel=1e-6)


def test_log_pearson3_skew_of_either_sign(make_series):
    up = [math.exp(v) for v in (1.0, 1.2, 1.1, 1.9, 3.1, 1.4)]
    f = by_key(extremes.fit_log_pearson3(make_series(a=up, b=[1 / x for x in up], c=[-1.0, 0.0, 2.0])))
    ys = [math.log(x) for x in up]
    m, n = sum(ys) / 6, 6
    s = math.sqrt(sum((y - m) ** 2 for y in ys) / 5)
    assert f["a"].skew_log == pytest.approx(n * sum((y - m) ** 3 for y in ys) / (5 * 4 * s**3)) and f["b"].skew_log == pytest.approx(-f["a"].skew_log)
    assert f["c"].reason and f["c"].skew_log is None


@pytest.mark.parametrize("bad,reason", [([5.0] * 6, "no variation"), ([1.0, 2.0], "fewer than 3 usable values"), ([float("nan")] * 4, "fewer than 3 usable values"), ([None] * 4, "fewer")])
def test_what_cannot_be_fitted_gets_a_reason(spark, bad, reason):
    rows = [("bad", k, x) for k, x in enumerate(bad)] + [("good", k, x) for k, x in enumerate(sample(9, 12))]
    fits = frequency.fit_all(spark.createDataFrame(rows, "station_code string, t int, x double"), NAMES).collect()
    for f in fits:
        assert (f.params is None) == (f.station_code == "bad"), f
        assert (f.reason or "").startswith(reason if f.station_code == "bad" else "")


def test_quantile_and_distribution_function_agree(spark, make_series):
    """Skews of both signs and next to none; nothing beyond the bounds."""
    mirrored = sample(3, 25)
    values = {"up": sample(1, 40), "down": sample(2, 40, -1.0), "even": mirrored + [2 * 400 - x for x in mirrored]}
    fits = frequency.fit_all(make_series(**values), NAMES).filter("reason is null")
    logs = spark.createDataFrame([("flat", "log_pearson3", {"mu_log": 2.0, "sigma_log": 0.4, "skew_log": g}) for g in (1e-5, -9e-4, 2e-3, -2e-3)],
                                 "station_code string, model string, params map<string,double>").withColumn("reason", F.lit(None).cast("string"))
    q = frequency.quantiles(fits.select("station_code", "model", "params", "reason").unionByName(logs), [0.001, 0.2, 0.5, 0.9, 0.999])
    seen = set()
    for name in NAMES:
        v = lambda key: F.col("params")[key]
        rows = q.filter(F.col("model") == name).withColumn("f", goodness.KNOWN[name](F.col("q"), v)).collect()
        for r in rows:
            assert 1 - r.f == pytest.approx(r.p, abs=2e-6 if "skew_log" in r.params and abs(r.params["skew_log"]) < 1e-3 else 1e-9), r
            seen.add((name, r.station_code))
    assert {(n, s) for n in NAMES for s in ("up", "down", "even")} - seen <= {("pearson3_lmom", "even")}
    near = {r.params["skew_log"]: r.q for r in q.filter("station_code = 'flat' and p = 0.001").collect()}
    assert abs(near[2e-3] + near[-2e-3] - 2 * near[1e-5]) < 1e-3  # the expansion joins the gamma quantile
    bounded = spark.createDataFrame([(0.5, 1e9), (-0.5, -1e9)], "k double, x double").select(
        goodness.KNOWN["gev"](F.col("x"), lambda key: {"location": F.lit(0.0), "scale": F.lit(1.0), "shape": F.col("k")}[key]).alias("f"))
    assert [r.f for r in bounded.collect()] == [1.0, 0.0]


def test_bands_by_brute_force(spark, make_series):
    """Every resample fitted as a series of its own, in Spark; the array kernels must give the same band."""
    values, samples, grid = {"a": sample(11, 14), "b": sample(12, 9, -1.0)}, 25, [0.01, 0.3, 0.9]
    rows = []
    for s, xs in values.items():
        draws = bootstrap.hashed_draws(s, len(xs), 0, samples, 42)
        rows += [(f"{s}#{r}", j, sorted(xs)[i]) for r, row in enumerate(draws) for j, i in enumerate(row)]
    spelled = spark.createDataFrame(rows, "station_code string, t int, x double")
    curves: dict = {}
    for r in frequency.quantiles(frequency.fit_all(spelled, ALL), grid).select("station_code", "model", "p", "q").collect():
        curves.setdefault((r.station_code.split("#")[0], r.model), {}).setdefault(r.station_code, {})[r.p] = r.q
    bands = bootstrap.bootstrap_ci(make_series(**values), ALL, samples, grid=grid, draw="hash").collect()
    assert {(b.station_code, b.model) for b in bands} == {(s, m) for s in values for m in ALL}
    for b in bands:
        whole = [[c[p] for p in grid] for c in curves.get((b.station_code, b.model), {}).values()]
        whole = [c for c in whole if not any(q is None or math.isnan(q) for q in c)]
        assert b.n_valid == len(whole)
        if whole:
            lower, upper = np.quantile(whole, [0.05, 0.95], axis=0)
            assert b.q_lower == pytest.approx(lower, rel=1e-6) and b.q_upper == pytest.approx(upper, rel=1e-6), b.model
    assert set(NAMES) <= set(resampling.RESAMPLERS)


@pytest.mark.parametrize("models,samples,slices", [(["lognormal_mom", "lognormal_3p", "pearson3", "weibull", "gumbel_lmom", "gev"], 5000, 3), (["log_pearson3", "gumbel"], 600, 2)])
def test_sliced_bands_equal_those_of_one_task(make_series, models, samples, slices):
    """The default 5,000 resamples among them."""
    series = make_series(a=sample(31, 12), b=sample(32, 10))
    key = lambda bands: {(b.station_code, b.model): (b.n_valid, b.q_lower, b.q_upper) for b in bands.collect()}
    whole = key(bootstrap.bootstrap_ci(series, models, samples, grid=[0.01, 0.5, 0.9]))
    got = key(bootstrap.bootstrap_ci(series, models, samples, grid=[0.01, 0.5, 0.9], slices=slices))
    assert got.keys() == whole.keys()
    for k, (valid, lower, upper) in whole.items():
        assert got[k][0] == valid and got[k][1] == pytest.approx(lower, rel=1e-14) and got[k][2] == pytest.approx(upper, rel=1e-14)


def test_gamma_quantiles_of_large_shapes():
    """The expansion joins the direct solution."""
    from gaugeworks.functions.special import gamma_quantile

    prob = np.array([0.0005, 0.05, 0.5, 0.9995])
    lam = np.array([30_001.0, 200_000.0])
    assert np.allclose(resampling.GammaCurves(prob).rows(lam), gamma_quantile(prob[None, :], lam[:, None]), rtol=1e-7)


def test_percentiles_from_tails():
    r = np.random.default_rng(8)
    for n in (1, 2, 3, 19, 20, 21, 400):
        values = r.normal(size=(n, 4))
        keep = int((n - 1) * 0.05) + 2
        parts = np.array_split(values, 3)
        low = np.concatenate([bootstrap.tails(x, keep)[0] for x in parts])
        high = np.concatenate([bootstrap.tails(x, keep)[1] for x in parts])
        got = bootstrap.from_tails(bootstrap.tails(low, keep)[0], bootstrap.tails(high, keep)[1], n, 0.1)
        assert np.allclose(got, np.quantile(values, [0.05, 0.95], axis=0), rtol=1e-14)


def chi_by_hand(xs, quantile, free):
    n = len(xs)
    k = math.ceil(1 + math.log2(n))
    width = min(math.ceil(5 * k / n), k)
    classes = k // width
    bounds = sorted(quantile(1 - j / k) for j in range(1, k))
    seen = [0] * classes
    for x in xs:
        seen[min(sum(b < x for b in bounds) // width, classes - 1)] += 1
    expected = [n * width / k] * (classes - 1) + [n * (k - width * (classes - 1)) / k]
    return classes, classes - 1 - free, sum((o - e) ** 2 / e for o, e in zip(seen, expected))


def test_chi_square_by_hand(spark, make_series):
    values = {"a": sample(21, 60), "b": sample(22, 47), "c": sample(23, 12)}
    series = make_series(**values)
    fits = frequency.fit_all(series, ["gumbel", "gev", "lognormal_mom"])
    params = {(f.station_code, f.model): f.params for f in fits.collect()}
    for model, free in (("gumbel", 2), ("gev", 3), ("lognormal_mom", 2)):
        got = by_key(goodness.chi_square(series, fits, model))
        for s, xs in values.items():
            v = params[s, model]
            if model == "lognormal_mom":
                quantile = lambda p, v=v: math.exp(v["mu_log"] + v["sigma_log"] * -__import__("statistics").NormalDist().inv_cdf(p))
            else:
                quantile = lambda p, v=v: float(resampling.gev_curve({k: np.array([x]) for k, x in ({"shape": 0.0} | v).items()}, np.array([p]), None)[0, 0])
            classes, df, h = chi_by_hand(xs, quantile, free)
            assert (s in got) == (df >= 1)
            if s in got:
                assert (got[s].classes, got[s].df) == (classes, df) and got[s].chi_square == pytest.approx(h)
                if df == 2:
                    assert got[s].p_value == pytest.approx(math.exp(-h / 2))


def test_own_model_without_distribution_function(make_series):
    """The chi-square test inverts the curve."""
    def fit(series):
        stats = series.groupBy("station_code").agg(F.min("t").alias("year_start"), F.max("t").alias("year_end"), F.count("x").cast("int").alias("n"), F.max("x").alias("m"))
        return stats.withColumns({"reason": F.lit(None).cast("string"), "params": F.create_map(F.lit("top"), F.col("m"))})

    frequency.register_model(frequency.Model("flat", "Uniform", 1, 1, fit, lambda v, p, z: v("top") * (1.0 - p), free=1))
    try:
        xs = [float(k) for k in range(1, 65)]
        row = goodness.chi_square(make_series(s=xs), frequency.fit_all(make_series(s=xs), ["flat"]), "flat").first()
        assert (row.classes, row.df, row.result) == (7, 5, True)
        assert row.chi_square == pytest.approx(chi_by_hand(xs, lambda p: 64 * (1 - p), 1)[2])
    finally:
        del frequency.MODELS["flat"]


def halves(spark, n=24):
    rows = []
    for s in ("a", "b"):
        for f in (1, 2, 3):
            rows += [(s, f, 1990 + k, x) for k, x in enumerate(sample(f"{s}{f}", n))]
    return spark.createDataFrame(rows + [("only winter", 2, 1990 + k, x) for k, x in enumerate(sample(4, n))], "station_code string, frequency_id int, t int, x double")


def test_both_seasons_have_the_probability_of_the_year(spark):
    fits = extremes.fit_frequencies(halves(spark), ALL)
    grid = [0.01, 0.5]
    rows = extremes.both_seasons(fits, grid)
    params = fits.filter("reason is null").select("station_code", "model", "frequency_id", "params")
    for f, name in ((2, "w"), (3, "s")):
        rows = rows.join(params.filter(f"frequency_id = {f}").select("station_code", "model", F.col("params").alias(name)), ["station_code", "model"])
    rows = rows.persist()
    for model in ALL:
        both = rows.filter(F.col("model") == model)
        for side in ("w", "s"):
            both = both.withColumn(f"f_{side}", goodness.KNOWN[model](F.col("q"), lambda key, side=side: F.col(side)[key]))
        found = both.collect()
        assert {(r.station_code, r.p) for r in found} == {(s, p) for s in "ab" for p in grid}, model
        for r in found:
            assert 1 - r.f_w * r.f_s == pytest.approx(r.p, rel=1e-6), r
    rows.unpersist()


def test_job_logs_all_frequencies(spark, tmp_path):
    root, series = str(tmp_path), halves(spark)
    made = jobs.log_estimates(spark, root, series, models=["gev", "log_pearson3"], n_samples=20)
    fitted = made["fitted_distributions"].collect()
    assert sorted((r.station_code, r.distribution_id, r.frequency_id) for r in fitted) == sorted(
        (s, d, f) for s, fs in (("a", (1, 2, 3)), ("b", (1, 2, 3)), ("only winter", (2,))) for f in fs for d in (4, 5))
    assert made["estimated_discharges"].count() == 2 * len(fitted)
    assert {r.fitted_distribution_id for r in made["ci_estimates"].collect()} == {r.id for r in fitted}
    logged = tables.read_table(spark, root, "dist_test_results").collect()
    assert {r.test_id for r in logged} == {7} or {r.test_id for r in logged} == {3, 7}
    assert {r.fitted_distribution_id for r in logged if r.test_id == 7} == {r.id for r in fitted}
    annual = jobs.estimate(series.filter("frequency_id = 1").drop("frequency_id"), ["gev"], n_samples=20)
    want = {r.station_code: r.distribution_params for r in annual["fitted_distributions"].collect()}
    assert want == {r.station_code: r.distribution_params for r in fitted if (r.distribution_id, r.frequency_id) == (5, 1)}


def test_frequency_series(spark):
    annual = spark.createDataFrame([("a", 1990, 5.0), ("a", 1991, None)], "station_code string, hydro_year int, WQ double")
    seasonal = spark.createDataFrame([("a", 1990, "winter", 5.0), ("a", 1990, "summer", 2.0), ("a", 1991, "summer", None)], "station_code string, hydro_year int, season string, WQ double")
    got = srs.frequency_series(annual, seasonal)
    assert sorted(got.select("station_code", "frequency_id", "t", "x").collect()) == [("a", 1, 1990, 5.0), ("a", 2, 1990, 5.0), ("a", 3, 1990, 2.0)]
    assert srs.unkeyed(srs.keyed(got)).exceptAll(got.select("station_code", "t", "x", "frequency_id")).isEmpty()
