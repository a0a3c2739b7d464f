import json
import math
from datetime import date
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeworks.functions import resampling
from gaugeworks.operators import bootstrap, frequency, goodness, hypothesis
from gaugeworks.plans import jobs, plots
from tests.conftest import by_key


def test_pearson_and_weibull_goldens(series_a):
    p3 = by_key(frequency.fit_pearson3(series_a))
    got = {s: (r.grid_no, round(r.epsilon, 6), round(r["lambda"], 6), round(r.alpha, 6), round(r.loglik, 6)) for s, r in p3.items()}
    assert got == {
        "click": (0, 0.004295, 8.076792, 0.047298, -656.660362),
        "error": (146, 41.646861, 3.843953, 0.030487, -658.830210),
        "purchase": (179, 65.733178, 2.373748, 0.023772, -652.203201),
        "signup": (106, 31.419753, 5.134012, 0.036039, -659.031332),
        "view": (109, 35.077839, 6.040702, 0.048214, -635.138636),
    }
    beta = {s: round(r.beta, 9) for s, r in by_key(frequency.fit_weibull(series_a)).items()}
    assert beta == {"click": 2.746502508, "error": 2.798738216, "purchase": 2.767939818, "signup": 2.951012785, "view": 3.248129984}


def test_hashed_bootstrap_golden(series_a):
    bands = bootstrap.bootstrap_ci(series_a, ["lognormal_mom"], 50, grid=[0.01], draw="hash")
    got = {r.station_code: (round(r.q_lower[0], 4), round(r.q_upper[0], 4)) for r in bands.collect()}
    assert got == {
        "click": (333.6638, 412.0134), "error": (336.6145, 409.2273), "purchase": (330.5711, 390.2837),
        "signup": (350.6968, 410.5976), "view": (292.3646, 346.2942),
    }


def test_exact_sample_returns_its_parameters(make_series):
    z = [NormalDist().inv_cdf((i + 0.5) / 99) for i in range(99)]
    xs = [float(np.exp(2.0 + 0.5 * v)) for v in z]
    fit = frequency.fit_lognormal_mom(make_series(s=xs)).first()
    assert fit.mu_log == pytest.approx(2.0) and fit.sigma_log == pytest.approx(0.5, rel=0.02)
    three = frequency.fit_lognormal_3p(make_series(s=[x + 7.0 for x in xs])).first()
    assert three.epsilon == pytest.approx(7.0, abs=1e-9) and three.mu == pytest.approx(2.0)


def test_weibull_score_is_zero(make_series):
    xs = np.array([3.0, 5.5, 9.1, 2.2, 14.0, 7.7])
    f = frequency.fit_weibull(make_series(s=xs)).first()
    y = np.log(xs)
    w = xs**f.beta
    assert 1 / f.beta + y.mean() - (w * y).sum() / w.sum() == pytest.approx(0.0, abs=1e-12)
    assert f.alpha == pytest.approx(w.mean() ** (-1 / f.beta))


def test_failures_are_rows(make_series):
    series = make_series(short=[1, 2], flat=[4, 4, 4, 4], zero=[0, 1, 2, 3], symmetric=[1, 2, 3], fine=[3, 5, 4, 9, 20, 6], none=[0, 0, 0])
    rows = frequency.fit_failures(frequency.fit_all(series)).collect()
    got = {(r.station_code, r.model): r.reason for r in rows}
    assert got[("short", "pearson3")] == got[("short", "weibull")] == "fewer than 3 usable values"
    assert got[("flat", "lognormal_3p")] == "largest plus smallest equals twice the median"
    assert got[("flat", "weibull")] == "no variation"
    assert got[("zero", "lognormal_3p")] == got[("zero", "weibull")] == "values must be positive"
    assert ("zero", "lognormal_mom") not in got and ("zero", "pearson3") not in got
    assert got[("none", "lognormal_mom")] == got[("none", "pearson3")] == "fewer than 3 usable values"
    assert got[("symmetric", "lognormal_3p")] == "largest plus smallest equals twice the median"
    assert not any(s == "fine" and m != "lognormal_3p" for s, m in got)


def test_quantile_arguments(series_a):
    fits = frequency.fit_all(series_a, ["lognormal_mom"])
    with pytest.raises(ValueError):
        frequency.quantiles(fits, [0.0, 0.5])
    with pytest.raises(ValueError):
        frequency.design_flows(fits, (1,))
    with pytest.raises(ValueError):
        frequency.fit_weibull(series_a, -1.0)
    with pytest.raises(ValueError):
        bootstrap.bootstrap_ci(series_a, alpha=1.0)


def test_resample_kernels_equal_spark_fits(make_series):
    """A kernel on given multiplicities equals the Spark fit of the spelled-out resample."""
    xs = np.sort(np.array([12.0, 15.5, 9.0, 30.2, 22.0, 17.0, 18.5, 40.0, 11.0, 14.0]))
    counts = np.concatenate(list(bootstrap.resample_counts("s", len(xs), 12, 7)))
    spelled = make_series(**{f"r{i}": np.repeat(xs, c) for i, c in enumerate(counts)})
    fits = by_key(frequency.fit_all(spelled, ["lognormal_mom"]))
    for model, names in (("lognormal_mom", ["mu_log", "sigma_log"]), ("lognormal_3p", ["epsilon", "mu", "sigma"]),
                         ("pearson3", ["epsilon", "lambda", "alpha"]), ("weibull", ["alpha", "beta"])):
        fits = by_key(frequency.fit_all(spelled, [model]))
        params = resampling.RESAMPLERS[model][0](xs, counts)
        for i in range(len(counts)):
            row = fits[f"r{i}"]
            for k in names:
                if row.params is None:
                    assert np.isnan(params[k][i])
                else:
                    assert params[k][i] == pytest.approx(row.params[k], rel=1e-8)


def test_gamma_curves_interpolate_exactly():
    lam = np.exp(np.random.default_rng(3).uniform(-2, 8, 300))
    prob = np.linspace(0.0005, 0.9995, 40)
    got = resampling.GammaCurves(prob).rows(np.append(lam, np.nan))
    want = resampling.gamma_quantile(prob[None, :], lam[:, None])
    assert got[:-1] == pytest.approx(want, rel=1e-9) and np.isnan(got[-1]).all()


def test_bootstrap_does_not_depend_on_partitions(series_a):
    one = bootstrap.bootstrap_ci(series_a, n_samples=60, grid=[0.01, 0.5], partitions=1)
    many = bootstrap.bootstrap_ci(series_a.repartition(7), n_samples=60, grid=[0.01, 0.5], partitions=13)
    key = lambda rows: sorted((r.station_code, r.model, r.n_valid, tuple(r.q_lower), tuple(r.q_upper)) for r in rows.collect())
    assert key(one) == key(many)


def test_bootstrap_with_own_model(series_a):
    def fit(xs, counts):
        return {"mean": counts @ xs / counts.sum(axis=1)}

    resampling.register_resampler("mean", fit, lambda v, p, z: np.repeat(v["mean"][:, None], len(p), axis=1))
    try:
        row = bootstrap.bootstrap_ci(series_a, ["mean"], n_samples=200, grid=[0.5]).first()
        assert row.n_valid == 200 and row.q_lower[0] < row.q_upper[0]
    finally:
        del resampling.RESAMPLERS["mean"]


def test_kolmogorov_distance_by_hand(make_series):
    xs = [3.0, 5.5, 9.1, 2.2, 14.0, 7.7]
    series = make_series(s=xs)
    fits = frequency.fit_all(series, ["weibull"])
    p = fits.first().params
    f = 1 - np.exp(-((p["alpha"] * np.sort(xs)) ** p["beta"]))
    n = len(xs)
    d = max(np.max(np.arange(1, n + 1) / n - f), np.max(f - np.arange(n) / n))
    row = goodness.lambda_kolmogorov(series, fits, "weibull").first()
    assert row.d == pytest.approx(d) and row.lambda_stat == pytest.approx(d * np.sqrt(n)) and row.result
    assert row.result_notes.startswith("n=6, D=")


def test_estimate_job_and_bundles(spark, series_a):
    out = jobs.estimate(series_a, n_samples=40)
    fitted = out["fitted_distributions"]
    assert fitted.count() == 20 and out["estimated_discharges"].count() == 40 and out["ci_estimates"].count() == 20
    assert jobs.distribution_test_results(series_a, fitted).count() == 5
    from gaugeworks.operators.export import latest_fit

    gauges = series_a.select("station_code").distinct().select(
        "station_code", F.col("station_code").alias("station_name"), F.lit("r").alias("river_name"), F.lit("u").alias("uuid"))
    bundle = plots.station_bundles(gauges, series_a, latest_fit(fitted), out["ci_estimates"])
    assert bundle.filter("skip_reason is null and ci_data is not null").count() == 20
    curve = plots.theoretical_curves(frequency.fit_all(series_a, ["pearson3"]), [0.01, 0.5, 0.99])
    qs = [r.q for r in curve.filter("station_code = 'view'").orderBy("p").collect()]
    assert qs == sorted(qs, reverse=True)


def test_bootstrap_slices_change_nothing(series_a, monkeypatch):
    key = lambda: sorted((r.station_code, r.model, r.n_valid, tuple(r.q_lower), tuple(r.q_upper)) for r in bootstrap.bootstrap_ci(
        series_a, ["lognormal_mom", "weibull"], n_samples=40, grid=[0.01, 0.5], draw="hash").collect())
    whole = key()
    monkeypatch.setattr(bootstrap, "_CELLS", 1000)
    assert key() == whole


def test_values_that_are_no_numbers_count_as_missing(make_series):
    good = [3.0, 5.5, 9.1, 2.2, 14.0, 7.7]
    series = make_series(s=[*good, float("nan"), float("inf")], t=good, u=[float("nan")] * 5)
    fits = {(r.station_code, r.model): r for r in frequency.fit_all(series).collect()}
    for name in frequency.usual_models():
        assert fits["s", name].params == fits["t", name].params and fits["u", name].reason and fits["u", name].params is None
    assert {r.station_code for r in bootstrap.bootstrap_ci(series, ["lognormal_mom"], 20, grid=[0.5]).collect()} == {"s", "t"}


def test_registered_model_everywhere(series_a):
    """An exponential law by its mean: fit, flow, curve, band and goodness of fit."""
    def fit(series):
        stats = series.filter("x > 0").groupBy("station_code").agg(
            F.min("t").alias("year_start"), F.max("t").alias("year_end"), F.count("x").cast("int").alias("n"), F.avg("x").alias("m"))
        return stats.withColumns({"reason": F.lit(None).cast("string"), "params": F.create_map(F.lit("mean"), F.col("m"))})

    frequency.register_model(frequency.Model("exponential", "Exponential", 1, 1, fit, lambda v, p, z: -v("mean") * F.log(p)))
    goodness.register_distribution("exponential", lambda x, v: 1.0 - F.exp(-x / v("mean")))
    try:
        out = jobs.estimate(series_a, ["exponential"], n_samples=40)
        means = {r.station_code: r.m for r in series_a.groupBy("station_code").agg(F.avg("x").alias("m")).collect()}
        flows = {(r.station_code, r.return_period): json.loads(r.notes)["Q_estimated_m3s"] for r in out["estimated_discharges"].collect()}
        assert all(q == pytest.approx(means[s] * math.log(t), rel=1e-3) for (s, t), q in flows.items()) and len(flows) == 10
        bands = [json.loads(r.ci_data) for r in out["ci_estimates"].collect()]
        assert len(bands) == 5 and all(b["n_valid"] == 40 and all(x <= y for x, y in zip(b["q_lower"], b["q_upper"])) for b in bands)
        tested = jobs.distribution_test_results(series_a, out["fitted_distributions"], model="exponential")
        assert tested.count() == 5
    finally:
        del frequency.MODELS["exponential"], goodness.KNOWN["exponential"]


def test_dated_series(spark):
    rows = [("s", date(1990 + i, 5, 1), float(10 + (i * 7) % 13)) for i in range(40)]
    series = spark.createDataFrame(rows, "station_code string, t date, x double")
    got = hypothesis.run_tests(series).collect()
    assert len(got) == 5 and {(r.period_start, r.period_end) for r in got} == {(1990, 2029)}
    assert any("split at 2010-05-01" in r.result_notes for r in got)
