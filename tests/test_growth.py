"""What a query costs must not outgrow its input: plans, batches and memory of the steps that large tables meet."""

import datetime as dt
import math

import numpy as np
from pyspark.sql import functions as F

from gaugeworks.functions import text
from gaugeworks.session import METHOD_CONF, configure
from tests.conftest import by_key


def test_wide_parsers_stay_in_methods_that_the_jvm_compiles(spark):
    session = spark.newSession()
    assert configure(session).conf.get(METHOD_CONF) == "8000"
    session.conf.set(METHOD_CONF, "4000")
    assert configure(session).conf.get(METHOD_CONF) == "4000"


def test_only_what_can_be_a_number_is_tried(spark):
    """Same numbers as before; words are told by their last character and are not tried a second time."""
    values = ["1.", "1 \t", "-.5", "0x1p3", "1e5f", "NA", "1a", "\u00a01\u00a0", '"2"', '"NA"', "+3", "1e", "\u0663", '1"2', "9\x00"]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string").select("i", text.to_number(F.col("v")).alias("r"))
    got = [r.r for r in df.orderBy("i").collect()]
    assert got == [1.0, 1.0, -0.5, 8.0, None, None, None, 1.0, 2.0, None, 3.0, None, None, None, 9.0]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("cast(v") <= 3, plan


def test_goodness_of_several_models_orders_the_series_once(make_series):
    from gaugeworks.operators import extremes, frequency, goodness

    models = ["gumbel_mom", "gev", "lognormal_mom"]
    series = make_series(a=[3, 1, 4, 1, 5, 9, 2, 6], b=[2.5, 7.1, 8.2, 8.1, 30.0], c=[1.0, 2.0, 1.0, 4.0], d=[5, float("nan"), 7, 11, float("inf"), 12])
    fits = frequency.fit_all(series, models).localCheckpoint()
    together = goodness.lambda_kolmogorov(series, fits, models)
    got = {(r.model, r.station_code): (r.n, r.d, r.lambda_stat, r.result, r.result_notes) for r in together.collect()}
    want = {(m, r.station_code): (r.n, r.d, r.lambda_stat, r.result, r.result_notes) for m in models for r in goodness.lambda_kolmogorov(series, fits, m).collect()}
    assert got == want and len(got) == 12 and extremes.CATALOGUE
    plan = together._jdf.queryExecution().executedPlan().toString()
    final = plan[:plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert final.count("Sort [station_code") <= 2, final  # the series once, the fits once


def test_gumbel_is_solved_by_batch(make_series):
    """The score at the root is nothing; long, short, constant and missing series side by side, and no expression loops over a row."""
    from gaugeworks.operators import extremes

    rng = np.random.default_rng(5)
    values = {f"s{k}": np.round(rng.gumbel(100, 20, 3 + 5 * k), 3).tolist() for k in range(20)}
    series = make_series(**values, constant=[4.0] * 5, short=[1.0, 2.0], gaps=[3.0, float("nan"), 8.0, 5.0], far=[1e6, 1e6 + 1, 1e6 + 3])
    made = extremes.fit_gumbel(series)
    got = by_key(made)
    assert got["constant"].reason == "no variation" and got["short"].reason is not None and got["constant"].scale is None and got["gaps"].n == 3
    for name in values:
        xs, s, u = np.array(values[name]), got[name].scale, got[name].location
        w = np.exp(-(xs - xs.min()) / s)
        assert abs(s - xs.mean() + (xs * w).sum() / w.sum()) < 1e-9 * xs.mean()
        assert math.isclose(np.exp(-(xs - u) / s).mean(), 1.0, rel_tol=1e-9)
    assert "aggregate(" not in made._jdf.queryExecution().optimizedPlan().toString()


def test_profile_keeps_values_out_of_the_grid(make_series):
    """Values by grid points are never rows: the grid unfolds after the sums; stations that cannot be fitted stay."""
    from gaugeworks.operators import frequency

    xs = [3.0, 1.5, 4.0, 1.25, 5.0, 9.0]
    series = make_series(a=[*xs, -1.0, float("nan")], few=[1.0, 2.0, -3.0], none=[float("nan")] * 3)
    whole = frequency._profile(series, 20)
    rows = whole.collect()
    assert sorted((r.station_code, r.n, r.n_pos) for r in rows if r.grid_no is None) == [("few", 3, 2), ("none", 0, 0)]
    assert sorted(r.grid_no for r in rows if r.station_code == "a") == list(range(20))
    for r in rows:
        if r.station_code == "a" and r.loglik is not None:
            eps = 1.25 * 1e-4 + r.grid_no * (1.25 * 0.999 - 1.25 * 1e-4) / 19
            y = np.array(xs) - eps
            a = math.log(y.mean()) - np.log(y).mean()
            lam = (1 + math.sqrt(1 + 4 * a / 3)) / (4 * a)
            alpha = lam / y.mean()
            assert math.isclose(r.epsilon, eps, rel_tol=1e-12) and math.isclose(r["lambda"], lam, rel_tol=1e-9)
            assert math.isclose(r.loglik, 6 * (lam * math.log(alpha) - math.lgamma(lam)) + (lam - 1) * np.log(y).sum() - alpha * y.sum(), rel_tol=1e-9)
    lines = whole._jdf.queryExecution().optimizedPlan().toString().splitlines()
    unfold = next(i for i, line in enumerate(lines) if "Generate" in line)
    assert all("Aggregate" not in line for line in lines[:unfold]) and frequency.fit_pearson3(series).count() == 3


def test_bands_are_neither_broadcast_nor_moved_for_their_ids(spark, make_series, tmp_path):
    from gaugeworks.operators import bootstrap
    from gaugeworks.plans import jobs
    from gaugeworks.sources import tables

    series = make_series(a=[3.0, 1.0, 4.0, 1.5, 5.0], b=[2.5, 7.1, 8.2, 8.1, 30.0], c=[1.0, 2.0])
    made = jobs.log_estimates(spark, str(tmp_path / "t"), series, models=["lognormal_mom", "gumbel_mom"], n_samples=20)
    stored = tables.read_table(spark, str(tmp_path / "t"), "ci_estimates")
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(made["ci_estimates"]) == rows(stored) and [r.id for r in stored.orderBy("id").collect()] == [1, 2, 3, 4]
    assert stored.columns == ["id", "fitted_distribution_id", "alpha", "n_bootstrap", "ci_data"]
    assert {r.fitted_distribution_id for r in stored.collect()} == {r.id for r in made["fitted_distributions"].collect()}
    bands = bootstrap.bootstrap_ci(series, ["lognormal_mom"], 20)
    keys = bands.select("station_code", "model", F.lit(1).alias("fitted_distribution_id")).localCheckpoint()
    plan = bootstrap.ci_rows(bands, keys)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "ShuffledHashJoin" in plan, plan
    assert len(tables.read_table(spark, str(tmp_path / "t"), "dist_test_results").collect()) == 4  # chi-square has no degrees left


def test_archives_are_packed_and_read_by_batch(spark, tmp_path):
    """A partition of several batches is never whole in a task; lines and their order stay."""
    from gaugeworks.plans import loads
    from gaugeworks.sources import archives

    total = 25_000
    lines = spark.range(0, total, 1, 1).select(F.concat(F.lit("x"), F.col("id").cast("string")).alias("line"))
    loads._zip(lines, str(tmp_path / "zips"))
    got = archives.scan_members(spark, str(tmp_path / "zips")).orderBy("archive", "member", "line_no").collect()
    assert [r.line for r in got] == [f"x{k}" for k in range(total)]
    sizes = [sum(1 for r in got if r.member == m) for m in sorted({r.member for r in got})]
    assert len(sizes) == 9 and max(sizes) <= 3334
    reader = archives.MemberReader({"path": str(tmp_path / "zips")})
    batches = [b for share in reader.partitions() for b in reader.read(share)]
    assert max(b.num_rows for b in batches) <= 10_000 and sum(b.num_rows for b in batches) == total


def test_blank_lines_are_told_by_their_beginning(spark):
    from gaugeworks.sources import archives, observations as obs

    texts = ["", " ", "\t\u00a0 ", " 1,a", "2,b", "\u00a03,c", ",", '"",d']
    lines = spark.createDataFrame([("z", "m", i, t, None) for i, t in enumerate(texts)], "archive string, member string, line_no bigint, line string, error string")
    rows = archives.parse_lines(lines, obs.CODZ_FIELDS, obs.CODZ_NUMBERS)
    assert sorted(r.load_order.pos for r in rows.collect()) == [3, 4, 5, 6, 7]
    assert "isin" not in rows._jdf.queryExecution().optimizedPlan().toString()


def test_files_in_order_are_sorted_before_their_lines_are_made(spark):
    from gaugeworks.plans import queries
    from tests.conftest import SMALL

    for lines in (queries._part_lines(spark, SMALL, "l_orderkey % 3 <> 0"), queries._codz_lines(spark, SMALL, ordered=True)):
        plan = lines._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("concat_ws") < plan.index("Sort"), plan  # the lines are made above the sort
    got = [r.line for r in queries._codz_lines(spark, SMALL, ordered=True).select("line").collect()]
    assert got == [r.line for r in queries._codz_lines(spark, SMALL).orderBy("place").collect()]


def test_rows_are_gathered_once_for_three_grains(spark):
    """Months are gathered before they count for half-years and years, so the unfolded rows are months; odd rows give what each grain alone gives."""
    from gaugeworks.operators import statistics as st

    rng = np.random.default_rng(7)
    rows = []
    for station in ("a", "b", None):
        for day in range(700):
            at = dt.datetime(1990, 11, 1, 7) + dt.timedelta(days=day)
            year = at.year + (at.month > 10)
            month = (at.month + 1) % 12 + 1
            flow = [None, float("nan"), float("inf"), -0.125][day] if day < 4 else float(rng.integers(0, 4000)) / 8
            shown = (month + 6) % 12 + 1 if day == 50 else month
            calendar = None if day % 97 == 0 else year, None if day % 89 == 0 else shown, at.month if day % 83 else None
            rows.append((station, at, *calendar, int(rng.integers(-90, 900)) if station else None, flow))
    rows += [("c", None, None, None, None, None, None), ("c", dt.datetime(1990, 1, 1, 7), 1990, 3, 1, None, None), rows[5], rows[5]]
    daily = spark.createDataFrame(rows, "station_code string, measured_at timestamp, hydro_year int, hydro_month int, calendar_month int, water_level_cm int, flow_m3s double")
    made = st.periods(daily)
    text_of = lambda df: sorted(str(tuple(r)) for r in df.collect())
    assert text_of(st.of_grain(made, "annual")) == text_of(st.annual(daily))
    assert text_of(st.of_grain(made, "seasonal")) == text_of(st.seasonal(daily))
    known = daily.filter("hydro_year is not null and calendar_month is not null")  # months are kept apart by hydrological year
    assert text_of(st.of_grain(st.periods(known), "monthly")) == text_of(st.monthly(known))
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.rindex("Aggregate ["), plan
    assert "median(" not in plan and "percentile(" not in plan
