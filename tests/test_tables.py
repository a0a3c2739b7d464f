from pyspark.sql import functions as F

from tests.conftest import SF
from gaugeworks.operators import export, merge, quality
from gaugeworks.operators import statistics as st
from gaugeworks.plans import adapters
from gaugeworks.schemas import CONSTRAINTS, Constraints


def test_upsert_golden(spark):
    """Values from the last row, calendar from the first, over all line items."""
    rows = adapters.load(spark, SF, "lineitem").selectExpr(
        "cast(l_suppkey as string) as station_code", "l_shipdate as measured_at",
        f"cast(({adapters.M} + 1) % 12 + 1 as int) as hydro_month",
        "case when l_quantity = 50 then 9999 else cast(l_quantity * 10 as int) end as level",
        "case when l_linenumber = 7 then 99999.999D else l_extendedprice end as flow",
        f"{adapters.LINE_ORDER} as load_order",
    )
    merged = merge.upsert(rows, ["station_code", "measured_at"], ["level", "flow"], ["hydro_month"])
    got = merged.agg(F.count(F.lit(1)).alias("n"), F.sum("hydro_month").alias("m")).first()
    assert (got.n, got.m) == (53307, 353152)
    again = merge.upsert(merged.withColumn("load_order", F.lit(1)), ["station_code", "measured_at"], ["level", "flow"], ["hydro_month"])
    assert again.exceptAll(merged).isEmpty()


def test_upsert_keeps_overwriting_nulls(spark):
    rows = spark.createDataFrame([("a", 1, 5, 10), ("a", 2, None, 20)], "k string, load_order int, v int, c int")
    assert merge.upsert(rows, ["k"], ["v"], ["c"]).collect() == [("a", 10, None)]


def test_ids_are_consecutive_and_stable(spark):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("station_code"), (F.col("id") % 3).alias("test_id"))
    first = merge.append_log(None, rows, "station_code", ["station_code", "test_id"])
    assert sorted(r.id for r in first.collect()) == list(range(1, 1001))
    other = merge.append_log(None, rows.repartition(7), "station_code", ["station_code", "test_id"])
    assert first.exceptAll(other).isEmpty()
    second = merge.append_log(first, rows, "station_code", ["station_code", "test_id"])
    assert sorted(r.id for r in second.collect()) == list(range(1001, 2001))


def test_latest_per_key(spark):
    rows = spark.createDataFrame([(1, "a", "x"), (5, "a", None), (3, "b", "y")], "id long, k string, v string")
    assert sorted(merge.latest_per_key(rows, ["k"]).collect(), key=str) == [(3, "b", "y"), (5, "a", None)]


def test_replace_export_drops_old_flows(spark):
    est = "station_code string, distribution string, method string, frequency string, n int"
    flow = "station_code string, distribution string, method string, frequency string, return_period int, probability double, q_estimated_m3s double"
    target = spark.createDataFrame([(1, "a", "D", "M", "annual", 40), (2, "b", "D", "M", "annual", 50)], "id long, " + est)
    flows = spark.createDataFrame([(1, 1, 100, 0.01, 7.0), (2, 2, 100, 0.01, 8.0)], "id long, estimation_id long, return_period int, probability double, q_estimated_m3s double")
    new = spark.createDataFrame([("a", "D", "M", "annual", 41)], est)
    new_flows = spark.createDataFrame([("a", "D", "M", "annual", 100, 0.01, 9.0), ("z", "D", "M", "annual", 100, 0.01, 1.0)], flow)
    t, f = merge.replace_export(target, flows, new, new_flows)
    assert sorted((r.id, r.station_code, r.n) for r in t.collect()) == [(2, "b", 50), (3, "a", 41)]
    assert sorted((r.id, r.estimation_id, r.q_estimated_m3s) for r in f.collect()) == [(2, 2, 8.0), (3, 3, 9.0)]


def test_uuid_is_fixed_and_fills_gaps(spark):
    rows = spark.createDataFrame([("1", None), ("2", "kept")], "station_code string, uuid string")
    got = {r.station_code: r.uuid for r in merge.add_uuid(rows).collect()}
    assert got["2"] == "kept" and len(got["1"]) == 36


def test_statistics_by_hand(spark):
    rows = [("s", f"2000-01-{d:02d} 07:00:00", 2000, 3, 1, lv, q, 1.0) for d, lv, q in ((1, 10, 1.0), (2, None, 2.0), (3, 40, 10.0))]
    rows.append(("s", "2000-06-01 07:00:00", 2000, 8, 6, 7, None, 1.0))
    df = spark.createDataFrame(rows, "station_code string, m string, hydro_year int, hydro_month int, calendar_month int, water_level_cm int, flow_m3s double, water_temp_c double")
    df = df.withColumn("measured_at", F.to_timestamp("m"))
    m = {r.month: r for r in st.monthly(df).collect()}
    assert (m[1].NQ, m[1].SQ, m[1].ZQ, m[1].WQ, m[1].SW, m[1].ZW, m[1].mes_count) == (1.0, 4.33, 2.0, 10.0, 25.0, 25.0, 3)
    assert (m[6].NQ, m[6].WW, m[6].mes_count) == (None, 7.0, 1)
    a = st.alltime(st.monthly(df)).first()
    assert (a.NNQ, a.WWQ, a.SWQ, a.SSQ, a.mes_count) == (1.0, 10.0, 10.0, 4.33, 2)
    seasons = [r.season for r in st.station_seasons(st.seasonal(df), "s").collect()]
    assert seasons == ["winter", "summer"]


def test_constraint_report(spark):
    df = spark.createDataFrame([(1, None, 100), (1, 9, 50)], "id long, distribution_id int, return_period int")
    df = df.withColumns({c: F.lit(1) for c in ("station_code", "estimation_method_id", "frequency_id")})
    parents = {"distributions": spark.createDataFrame([(2,)], "id int")}
    got = {r.check_name: r.violations for r in quality.report("estimated_discharges", df, CONSTRAINTS["estimated_discharges"], parents).collect()}
    assert got["key id"] == 1 and got["not null distribution_id"] == 1
    assert got["foreign distribution_id"] == 1 and got["allowed return_period"] == 1


def test_constraint_report_from_one_scan(spark, tmp_path):
    """Every check against its own job, keys with nulls among them."""
    rows = [("a", 1, None, 1), ("a", 1, 5, 1), (None, 1, 5, 2), (None, 1, 6, 2), ("b", None, 7, 100), ("b", 2, 7, 100), ("{", 2, 9, None)]
    spark.createDataFrame(rows, "k string, j int, parent int, period int").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    parents = {"p": spark.createDataFrame([(5,), (7,), (7,)], "id int"), "q": spark.createDataFrame([("a",)], "code string")}
    declared = Constraints(["k", "j"], ["k", "parent"], {"parent": ("p", "id"), "k": ("q", "code"), "j": ("missing", "id")}, {"period": (100, 2)})
    found = quality.report("t", df, declared, parents)
    want = {"key k,j": quality.duplicate_keys(df, ["k", "j"]).count(), "allowed period": quality.outside(df, "period", (100, 2)).count()}
    want |= {f"not null {r.column_name}": r.nulls for r in quality.null_counts(df, ["k", "parent"]).collect()}
    for c, t, p in (("parent", "p", "id"), ("k", "q", "code")):
        want[f"foreign {c}"] = sum(r.rows for r in quality.orphans(df, c, parents[t], p).collect())
    assert {r.check_name: r.violations for r in found.collect()} == want == {
        "key k,j": 2, "allowed period": 2, "not null k": 2, "not null parent": 1, "foreign parent": 2, "foreign k": 3}
    assert found._jdf.queryExecution().sparkPlan().toString().count("FileScan parquet") == 1


def test_export_unpacks_latest_fit(spark):
    fitted = spark.createDataFrame(
        [(1, 1, 2, 1, '{"mu_log":1.0,"sigma_log":0.5,"n":3.0}', "s", '{"n":3,"year_start":1,"year_end":3}'),
         (4, 1, 2, 1, '{"mu_log":2.0,"sigma_log":0.5,"n":4.0}', "s", '{"n":4,"year_start":1,"year_end":4}')],
        "id long, estimation_method_id int, distribution_id int, frequency_id int, distribution_params string, station_code string, source_timeseries_info string")
    row = export.estimations(fitted).first()
    assert (row.distribution, row.method, row.frequency, row.mu_log, row.n, row.year_end) == ("Log-Normal", "Method of Moments", "annual", 2.0, 4, 4)
    assert row.params == {"mu_log": 2.0, "sigma_log": 0.5, "n": 4.0}
