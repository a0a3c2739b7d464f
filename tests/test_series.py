import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import hypothesis
from gaugeworks.operators import series as srs
from gaugeworks.plans import jobs
from tests.conftest import by_key


def test_concordance_equals_all_pairs(make_series):
    rng = np.random.default_rng(5)
    data = {f"s{n}": rng.integers(0, 9, n).tolist() for n in (1, 2, 3, 17, 64, 65, 130)}
    data["flat"] = [4, 4, 4, 4]
    got = {r.station_code: r.s for r in srs.concordance(make_series(**data)).collect()}
    for name, xs in data.items():
        assert got[name] == sum(np.sign(xs[j] - xs[i]) for i in range(len(xs)) for j in range(i + 1, len(xs)))


def test_goldens(series_a):
    mk = {r.station_code: r.s for r in srs.concordance(series_a).collect()}
    assert mk == {"click": 27, "error": 734, "purchase": -10, "signup": -584, "view": 626}
    h = {s: round(r.statistic, 6) for s, r in by_key(hypothesis.kruskal_wallis(series_a)).items()}
    assert h == {"click": 0.750003, "error": 2.647383, "purchase": 0.259201, "signup": 2.113747, "view": 0.636474}
    rho = {s: round(r.statistic, 6) for s, r in by_key(hypothesis.spearman(series_a)).items()}
    assert rho == {"click": 0.001674, "error": 0.151059, "purchase": 0.000306, "signup": -0.122363, "view": 0.122981}
    runs = srs.median_signs(series_a).groupBy("station_code").agg(F.sum("starts_run").alias("r"))
    assert {r.station_code: r.r for r in runs.collect()} == {"click": 63, "error": 62, "purchase": 62, "signup": 51, "view": 57}


def test_notes(make_series):
    series = make_series(s=[10, 12, 11, 9, 10.5, 13, 12.5, 11.5, 10.2, 24811.85])
    gb = hypothesis.grubbs_beck(series).first()
    assert gb.result_notes == "Outliers detected (n=10, α=10%): 2009: 24811.8 m³/s" and not gb.result
    kw = hypothesis.kruskal_wallis(series).first()
    assert kw.result_notes.startswith("k=2 groups split at 2005 (n=10, α=5%, p=")
    assert hypothesis.mann_kendall(series).first().result_notes.startswith("n=10, α=5%, p=")
    assert hypothesis.spearman(series).first().result_notes.startswith("ρ=")


def test_trend_is_found(make_series):
    up = make_series(up=range(1, 31))
    assert not hypothesis.mann_kendall(up).first().result
    sp = hypothesis.spearman(up).first()
    assert sp.statistic == 1.0 and sp.p_value == 0.0 and not sp.result
    assert not hypothesis.kruskal_wallis(up).first().result
    ww = hypothesis.wald_wolfowitz(up).first()
    assert ww.p_value < 1e-6 and not ww.result


def test_no_variation_fails_without_error(make_series):
    flat = make_series(flat=[3, 3, 3, 3, 3])
    assert hypothesis.grubbs_beck(flat).first().result
    assert not hypothesis.kruskal_wallis(flat).first().result
    assert hypothesis.mann_kendall(flat).first().p_value == pytest.approx(1.0)
    assert not hypothesis.spearman(flat).first().result
    assert hypothesis.wald_wolfowitz(flat).isEmpty()


def test_short_series_have_no_row(make_series):
    short = make_series(one=[5], two=[5, 6])
    for name in ("grubbs_beck", "mann_kendall", "spearman"):
        assert hypothesis.TESTS[name](short).isEmpty()
    assert [r.station_code for r in hypothesis.kruskal_wallis(short).collect()] == ["two"]


def test_kruskal_more_groups(make_series):
    xs = [6, 1, 4, 9, 2, 7, 3, 8, 5, 11]
    got = hypothesis.kruskal_wallis(make_series(s=xs), k=3).first()
    ranks = np.argsort(np.argsort(xs)) + 1
    parts = [ranks[:4], ranks[4:7], ranks[7:]]
    h = 12 / (10 * 11) * sum(p.sum() ** 2 / len(p) for p in parts) - 3 * 11
    assert got.statistic == pytest.approx(h) and got.p_value == pytest.approx(np.exp(-h / 2))


def test_plugged_in_test(make_series):
    def always(series):
        return hypothesis.mann_kendall(series).withColumn("test_id", F.lit(99))

    hypothesis.register_test("always", always)
    try:
        rows = hypothesis.run_tests(make_series(s=[1, 3, 2, 5]), ["always"])
        assert rows.first().test_id == 99
    finally:
        del hypothesis.TESTS["always"]


def test_result_log(series_a):
    log = jobs.test_results(series_a)
    assert log.count() == 25 and sorted(r.id for r in log.collect()) == list(range(1, 26))
    again = jobs.test_results(series_a, log)
    assert min(r.id for r in again.collect()) == 26
