import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeworks.functions import calendar as cal
from gaugeworks.functions import numeric, special, text
from gaugeworks.functions.rounding import one_decimal, round_half_away


def column(spark, values, kind, expr):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}").select("i", expr(F.col("v")).alias("r"))
    return [r.r for r in df.orderBy("i").collect()]


def test_round_is_on_the_binary_value(spark):
    values = [1.005, 2.675, 0.285, 1.115, 10.075, 4.35, 1234.565, None]
    assert column(spark, values, "double", round_half_away) == [1.0, 2.68, 0.28, 1.12, 10.07, 4.35, 1234.57, None]


def test_one_decimal_is_c_style(spark):
    values = [24811.85, 0.25, 0.35, 0.75, 43.0, 2.05, 1e6 + 0.05, 12.349]
    assert column(spark, values, "double", one_decimal) == [f"{v:.1f}" for v in values]


def test_numbers(spark):
    values = ["1.5", "1d", "2f", "inf", "nan", "Infinity", "abc", "", ' "3" ', " 4 ", "1e3", "-7", None]
    want = [1.5, None, None, None, None, None, None, None, 3.0, 4.0, 1000.0, -7.0, None]
    assert column(spark, values, "string", text.to_number) == want


def test_clean_text_matches_python_strip(spark):
    values = ['  "a b" ', '"" x ""', " ŁÓDŹ\t", '" q', "plain", "", ' "" ', "a "]
    want = [v.strip().strip('"').strip() for v in values]
    assert column(spark, values, "string", text.clean_text) == want


def test_missing_words(spark):
    assert column(spark, ["NA", "null", "NULL", "na", "x", ""], "string", text.missing_to_null) == [
        None, None, None, "na", "x", None]


def test_cp1250_round_trip(spark):
    values = ["CHAŁUPKI", "ŁÓDŹ", "Święta Ż", "plain"]
    as_latin1 = [v.encode("cp1250").decode("latin-1") for v in values]
    assert column(spark, as_latin1, "string", text.decode_cp1250) == values
    assert column(spark, values, "string", text.encode_cp1250) == as_latin1
    assert column(spark, ["\x81"], "string", text.decode_cp1250) == ["�"]


def test_calendar(spark):
    months = list(range(1, 13))
    assert column(spark, months, "int", cal.calendar_month_of) == [11, 12, *range(1, 11)]
    back = column(spark, months, "int", lambda m: cal.hydro_month_of(cal.calendar_month_of(m)))
    assert back == months
    df = spark.createDataFrame([(1951, 11, 1), (1951, 2, 30), (1951, 10, 31)], "y int, m int, d int")
    got = df.select(cal.observation_time(F.col("y"), F.col("m"), F.col("d")).cast("string").alias("t"))
    assert [r.t for r in got.collect()] == ["1950-11-01 07:00:00", None, "1951-10-31 07:00:00"]


def test_normal_tail(spark):
    zs = [0.0, 0.3, 1.0, 1.959963984540054, 3.9, 4.1, 8.0, 20.0]
    for got, z in zip(column(spark, zs, "double", numeric.normal_upper), zs):
        assert got == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)), rel=1e-11)


def test_student_and_chi_square(spark):
    table = {1: 12.7062047, 2: 4.3026527, 3: 3.1824463, 4: 2.7764451, 5: 2.5705818, 10: 2.2281389, 30: 2.0422725}
    df = spark.createDataFrame(list(table.items()), "df int, t double")
    for r in df.select("df", numeric.student_two_sided(F.col("t"), F.col("df")).alias("p")).collect():
        assert r.p == pytest.approx(0.05, abs=1e-8)
    for k, h in {1: 3.841458820694124, 2: 5.991464547107979, 3: 7.814727903251179, 4: 9.487729036781154}.items():
        assert column(spark, [h], "double", lambda c, k=k: numeric.chi_square_upper(c, k))[0] == pytest.approx(0.05, abs=1e-12)


def test_grubbs_table():
    table = {3: 1.153, 5: 1.671, 10: 2.176, 20: 2.557, 30: 2.745, 50: 2.957, 100: 3.210}
    assert {n: round(special.grubbs_critical(n, 0.10), 3) for n in table} == table


def test_log_gamma(spark):
    xs = [1e-3, 0.5, 1.0, 3.3, 40.0, 1e3, 1e6]
    for got, x in zip(column(spark, xs, "double", numeric.log_gamma), xs):
        assert got == pytest.approx(math.lgamma(x), rel=1e-12, abs=1e-12)
    assert special.log_gamma(np.array(xs)) == pytest.approx([math.lgamma(x) for x in xs], rel=1e-12, abs=1e-12)


def test_gamma_quantile_inverts_cdf():
    rng = np.random.default_rng(1)
    a = np.exp(rng.uniform(-2, 8, 500))
    p = rng.uniform(0.0005, 0.9995, 500)
    assert special.gamma_cdf(special.gamma_quantile(p, a), a) == pytest.approx(p, abs=1e-10)
    chi = {1: 3.841458820694124, 2: 5.991464547107979, 10: 18.307038053275146}
    for k, h in chi.items():
        assert 2 * special.gamma_quantile(np.array([0.95]), np.array([k / 2]))[0] == pytest.approx(h, rel=1e-11)


def test_normal_tail_is_exact_and_runs_no_loop(spark):
    zs = [0.0, 1e-9, 0.3, 0.6629, 0.663, 1.0, 2.5, 5.65, 5.66, 8.0, 20.0, 37.0, float("inf")]
    rows = spark.createDataFrame([(z,) for z in [*zs, float("nan"), None]], "z double").select("z", numeric.normal_upper(F.col("z")).alias("q"))
    assert "aggregate(" not in rows._jdf.queryExecution().analyzed().toString()
    got = {r["z"]: r["q"] for r in rows.collect() if r["z"] == r["z"]}
    for z in zs:
        assert got[z] == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)), rel=1e-12, abs=0)
    assert got[None] is None
    assert [math.isnan(r["q"]) for r in rows.filter("isnan(z)").collect()] == [True]
