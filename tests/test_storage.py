"""Tables that change together, whatever breaks off in between; loads and streams that share them; statistics refreshed by what changed."""

import re

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import merge
from gaugeworks.operators import statistics as st
from gaugeworks.plans import jobs
from gaugeworks.sources import tables
from gaugeworks.streaming import ingest
from tests.test_sources import FIRST, ICE, SECOND, WANT, measured

THIRD = "\n".join(["149180020,NEW NAME,y,1951,01,1,300,1.25,4.5,11", "149180099,Nowa,w,1952,03,7,5,6.5,1.0,1"])


def years(spark, lo, n=6):
    return spark.range(n).select(F.col("id"), (F.lit(lo) + F.col("id") % 3).cast("int").alias("y"))


def all_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("broken", ["_rename", "_write_commit", "remove"])
def test_a_writer_that_breaks_off_changes_nothing(spark, tmp_path, monkeypatch, broken):
    """At every call of the functions that touch the store: readers see the old tables, and the next writer succeeds."""
    root = str(tmp_path)
    tables.rebuild_partitions(years(spark, 1990), root, "p", "y")
    tables.rebuild(spark.range(3), root, "t")
    before = all_rows(tables.read_table(spark, root, "p")), all_rows(tables.read_table(spark, root, "t"))
    real, calls = getattr(tables, broken), []

    def failing(*args):
        calls.append(args)
        if len(calls) == wanted:
            raise OSError("lost")
        return real(*args)

    def write():
        with tables.change(spark, root) as change:
            change.rebuild_partitions(years(spark, 1991, 9), "p", "y")
            change.rebuild(spark.range(5), "t")

    for wanted in range(1, 12):
        calls.clear()
        monkeypatch.setattr(tables, broken, failing)
        try:
            write()
        except OSError:
            pass
        finally:
            monkeypatch.setattr(tables, broken, real)
        seen = all_rows(tables.read_table(spark, root, "p")), all_rows(tables.read_table(spark, root, "t"))
        after = sorted([*[r for r in before[0] if r[1] == 1990], *all_rows(years(spark, 1991, 9))], key=str), all_rows(spark.range(5))
        assert seen in (before, after)
        if len(calls) < wanted:
            break
    assert seen == after
    tables.vacuum(spark, root)
    assert (all_rows(tables.read_table(spark, root, "p")), all_rows(tables.read_table(spark, root, "t"))) == after


def test_partition_values_keep_their_type(spark, tmp_path):
    root = str(tmp_path)
    rows = years(spark, 1990).unionByName(spark.createDataFrame([(99, None)], "id long, y int"))
    tables.rebuild_partitions(rows, root, "p", "y")
    tables.rebuild_partitions(years(spark, 1992), root, "p", "y")
    got = tables.read_table(spark, root, "p")
    assert got.dtypes == [("id", "bigint"), ("y", "int")]
    assert {r.y for r in got.collect()} == {None, 1990, 1991, 1992, 1993, 1994}
    plan = got.filter("y = 1991")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(y" in plan
    tables.rebuild(rows.limit(0), root, "p", ["y"])
    assert tables.read_table(spark, root, "p").count() == 0


def test_reader_of_the_last_commit_goes_on(spark, tmp_path):
    root = str(tmp_path)
    tables.rebuild(spark.range(3), root, "t")
    reader = tables.read_table(spark, root, "t")
    tables.rebuild(spark.range(4), root, "t")
    assert reader.count() == 3
    tables.rebuild(spark.range(5), root, "t")
    assert len(list((tmp_path / "t").iterdir())) == 2 and len(list((tmp_path / "_commits").glob("[0-9]*.json"))) == 2
    tables.append(spark.range(2), root, "t")
    assert tables.read_table(spark, root, "t").count() == 7


def test_second_writer_fails(spark, tmp_path):
    root = str(tmp_path)
    tables.rebuild(spark.range(3), root, "t")
    late = tables.Change(spark, root)
    tables.rebuild(spark.range(4), root, "t")
    late.rebuild(spark.range(9), "t")
    with pytest.raises(RuntimeError, match="another writer"):
        late.commit()
    assert tables.read_table(spark, root, "t").count() == 4


def test_tables_of_other_writers(spark, tmp_path):
    """Plain folders are read, and taken over when they change."""
    root = str(tmp_path)
    years(spark, 1990).write.partitionBy("y").parquet(f"{root}/p")
    spark.range(3).write.parquet(f"{root}/t")
    assert tables.read_table(spark, root, "t").count() == 3 and tables.read_table(spark, root, "p").count() == 6
    tables.rebuild_partitions(years(spark, 1992, 3), root, "p", "y")
    assert {(r.y, r["count"]) for r in tables.read_table(spark, root, "p").groupBy("y").count().collect()} == {(1990, 2), (1991, 2), (1992, 1), (1993, 1), (1994, 1)}
    tables.append(spark.range(2), root, "t")
    assert tables.read_table(spark, root, "t").count() == 5
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, root, "none")


@pytest.fixture
def folders(tmp_path):
    for k, files in enumerate(({"codz_1.csv": FIRST, "zjaw_1.csv": ICE}, {"codz_2.csv": SECOND}, {"codz_3.csv": THIRD, "zjaw_3.csv": "149180040,ONLY ICE,y,1952,01,1,5,,40,W"})):
        (tmp_path / f"in-{k}").mkdir()
        for name, body in files.items():
            (tmp_path / f"in-{k}" / name).write_bytes(body.encode("cp1250"))
    return tmp_path


def state(spark, root):
    read = lambda name: tables.read_table(spark, root, name)
    audit = {r.file.rsplit("/", 1)[1]: (r.rows, r.rejected, tuple(r.reasons)) for r in read("load_audit").collect()}
    names = {r.station_code: (r.station_name, r.river_name, r.uuid) for r in read("gauges_list").collect()}
    return measured(read("measurements")), all_rows(read("phenomena").select("station_code", F.col("measured_at").cast("string"), "ice_thickness_cm", "ice_phenomenon_pct")), names, audit


def stream(spark, folders, root, k):
    for kind in ("codz", "zjaw"):
        ingest.ingest_tables(spark, str(folders / f"in-{k}"), root, f"{root}-state-{kind}-{k}", kind).awaitTermination()


@pytest.mark.parametrize("streamed", [{1}, {0, 2}])
def test_streams_and_batch_loads_share_the_tables(spark, folders, streamed):
    want, got = str(folders / "want"), str(folders / "got")
    for k in range(3):
        jobs.load_observations(spark, str(folders / f"in-{k}"), want)
        stream(spark, folders, got, k) if k in streamed else jobs.load_observations(spark, str(folders / f"in-{k}"), got)
    assert state(spark, got) == state(spark, want)


def test_a_batch_counts_once(spark, folders):
    """A batch that the stream runs again after its rows were committed does not win over later loads."""
    root = str(folders / "tables")
    batches = []
    real = ingest._start

    def kept(rows, table, checkpoint, write):
        return real(rows, table, checkpoint, lambda batch, n: (batches.append((write, batch.sparkSession, n)), write(batch, n)))

    ingest._start = kept
    try:
        stream(spark, folders, root, 0)
    finally:
        ingest._start = real
    jobs.load_observations(spark, str(folders / "in-2"), root)
    before = state(spark, root)
    write, session, n = batches[0]
    write(session.createDataFrame([], "x int"), n)
    assert state(spark, root) == before
    assert tables.read_table(spark, root, ingest.LEDGER).count() == 2


def test_published_stream_keeps_what_loads_brought(spark, folders):
    root, table = str(folders / "tables"), str(folders / "state")
    jobs.load_observations(spark, str(folders / "in-2"), root)
    ingest.ingest_codz(spark, str(folders / "in-1"), table, str(folders / "checkpoint")).awaitTermination()
    for _ in range(2):
        ingest.publish(spark, table, root)
    rows = measured(tables.read_table(spark, root, "measurements"))
    assert rows["149180020", "1950-11-01 07:00"] == (1951, 1, 11, 200, None, 3.5) and ("149180099", "1952-01-07 07:00") in rows
    names = {r.station_code: r.station_name for r in tables.read_table(spark, root, "gauges_list").collect()}
    assert names == {"149180020": "NEW NAME", "149180099": "Nowa", "149180022": "Trzecia", "149180040": "ONLY ICE"}
    assert tables.read_table(spark, root, "phenomena").count() == 1 and tables.read_table(spark, root, "load_audit").count() == 3


def daily(spark, stations, years, bump=0):
    rows = [(s, f"{y - (m > 10)}-{m:02d}-{d:02d} 07:00:00", y, (m + 1) % 12 + 1, m, (d * 7 + m + bump) % 23, ((d * 5 + m * 3 + len(s) + bump) % 31) / 4, 1.0)
            for s in stations for y in years for m in range(1, 13) for d in range(1, 29, 3)]
    df = spark.createDataFrame(rows, "station_code string, at string, hydro_year int, hydro_month int, calendar_month int, water_level_cm int, flow_m3s double, water_temp_c double")
    return df.select("station_code", F.to_timestamp("at").alias("measured_at"), *df.columns[2:]).withColumn("load_order", F.lit(0).cast("bigint"))


def load(spark, root, rows):
    with tables.change(spark, root) as change:
        jobs.merge_rows(change, rows)


def test_refresh_equals_a_full_rebuild(spark, tmp_path):
    root = str(tmp_path)
    load(spark, root, daily(spark, ["a", "bb", "c"], range(1990, 1995)))
    jobs.refresh_statistics(spark, root)  # the first time: all
    load(spark, root, daily(spark, ["a"], [1992], 5))
    load(spark, root, daily(spark, ["bb", "new"], [1994, 1996], 9).filter("calendar_month in (10, 11)"))
    refreshed = {n: all_rows(t) for n, t in jobs.refresh_statistics(spark, root).items()}
    assert {n: all_rows(tables.read_table(spark, root, n)) for n in jobs.STAT_TABLES} == refreshed
    assert tables.read_table(spark, root, "stats_pending").count() == 0
    assert {n: all_rows(t) for n, t in jobs.refresh_statistics(spark, root).items()} == refreshed  # nothing waits
    full = jobs.compute_statistics(spark, root)
    assert {n: all_rows(t) for n, t in full.items()} == refreshed
    changed = spark.createDataFrame([("a", 1992)], "station_code string, hydro_year int")
    plan = jobs.changed_rows(tables.read_table(spark, root, "measurements"), changed, [1992])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*hydro_year#\d+ = 1992", plan)


def test_statistics_from_one_exchange(spark):
    rows = merge.merge_measurements(daily(spark, ["a", "bb"], range(1990, 1993)).unionByName(daily(spark, ["a"], [1991], 3).withColumn("load_order", F.lit(1).cast("bigint"))))
    rows = spark.createDataFrame(rows.collect(), rows.schema)
    made = st.periods(rows)
    assert all_rows(st.of_grain(made, "monthly")) == all_rows(st.monthly(rows))
    assert all_rows(st.of_grain(made, "annual")) == all_rows(st.annual(rows))
    assert all_rows(st.of_grain(made, "seasonal")) == all_rows(st.seasonal(rows))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Scan ") == 1
