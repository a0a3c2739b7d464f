import zipfile

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import cleaning, merge
from gaugeworks.plans import jobs
from gaugeworks.sources import archives, tables
from gaugeworks.sources import observations as obs
from gaugeworks.streaming import ingest

FIRST = "\n".join([
    '"149180020","CHAŁUPKI","Odra (1)",1951,"01",1,181,99999.999,99.9,11',
    "149180021, ŁÓDŹ ,z,1951,3,3,9999,1.5,2.5,1",
    "149180020,x,y,1951,01,2,182,5.5",
    "149180020,x,y,1951,01,3,182,5.5,1.0,11,EXTRA",
    "149180020,x,y,1951,04,30,182,5.5,1.0,2",
    "149180020,x,y,abc,04,3,182,5.5,1.0,2",
    "149180020,x,y,1951,05,4,181.5,5.5,1.0,3",
    "",
    "149180020,x,y,1951,05,5,NA,NA,1.0,3",
])
SECOND = "\n".join([
    "149180020,OTHER NAME,y,1951,01,1,200,,3.5,12",
    "149180022,Trzecia,w,1951,12,1,7,8.25,99.9,10",
])
# The repeated key must have the same time, so its calendar month is 11 like the first.
SECOND = SECOND.replace("3.5,12", "3.5,11")
ICE = "\n".join([
    "149180020,LATE NAME,y,1951,01,1,999,,40,W",
    "149180020,x,y,1951,03,2,12,7, 30 , ",
    "149180030,ICE ONLY,y,1951,04,30,12,7,30,",
])


@pytest.fixture
def drop(tmp_path):
    folder = tmp_path / "in" / "1951"
    folder.mkdir(parents=True)
    (folder / "codz_1951_01.csv").write_bytes(FIRST.encode("cp1250"))
    (folder / "codz_1951_02.csv").write_bytes(SECOND.encode("cp1250"))
    (folder / "zjaw_1951.csv").write_bytes(ICE.encode("cp1250"))
    return tmp_path


def measured(df):
    return {
        (r.station_code, r.at): (r.hydro_year, r.hydro_month, r.calendar_month, r.water_level_cm, r.flow_m3s, r.water_temp_c)
        for r in df.withColumn("at", F.date_format("measured_at", "yyyy-MM-dd HH:mm")).collect()
    }


WANT = {
    ("149180020", "1950-11-01 07:00"): (1951, 1, 11, 200, None, 3.5),
    ("149180020", "1950-11-02 07:00"): (1951, 1, 11, 182, 5.5, None),
    ("149180020", "1951-03-05 07:00"): (1951, 5, 3, None, None, 1.0),
    ("149180021", "1951-01-03 07:00"): (1951, 3, 1, None, 1.5, 2.5),
    ("149180022", "1951-10-01 07:00"): (1951, 12, 10, 7, 8.25, None),
}


def test_edge_rows(spark, drop):
    typed = cleaning.type_codz(obs.scan_codz(spark, str(drop / "in")))
    reasons = sorted(r.reject_reason for r in typed.filter("reject_reason is not null").collect())
    assert reasons == ["missing date part", "no such date", "too many fields", "water_level_cm not integral"]
    assert measured(merge.merge_measurements(cleaning.measurement_rows(typed))) == WANT


def test_file_limit_opens_first_files_only(spark, drop):
    files = obs.scan_codz(spark, str(drop / "in"), 1).select("file").distinct().collect()
    assert [f.file.rsplit("/", 1)[1] for f in files] == ["codz_1951_01.csv"]
    assert obs.first_files(obs.scan_codz(spark, str(drop / "in")), 1).select("file").distinct().count() == 1


def test_load_twice_is_load_once(spark, drop):
    root = str(drop / "tables")
    jobs.load_observations(spark, str(drop / "in"), root)
    out = jobs.load_observations(spark, str(drop / "in"), root)
    assert measured(out["measurements"]) == WANT
    names = {r.station_code: r.station_name for r in out["gauges_list"].collect()}
    assert names == {"149180020": "CHAŁUPKI", "149180021": "ŁÓDŹ", "149180022": "Trzecia"}
    ice = {r.hydro_month: (r.ice_thickness_cm, r.ice_phenomenon_code, r.ice_phenomenon_pct, r.overgrowth_code)
           for r in out["phenomena"].collect()}
    assert ice == {1: (None, None, 40, "W"), 3: (12, "7", 30, None)}
    audit = {r.file.rsplit("/", 1)[1]: (r.rows, r.rejected, r.ok) for r in out["load_audit"].collect()}
    assert audit == {"codz_1951_01.csv": (4, 4, False), "codz_1951_02.csv": (2, 0, True), "zjaw_1951.csv": (2, 1, False)}
    stats = jobs.compute_statistics(spark, root)
    row = stats["stats_alltime"].filter("station_code = '149180020'").first()
    assert (row.NNQ, row.WWQ, row.mes_count) == (5.5, 5.5, 2)


def test_archives(spark, drop):
    folder = drop / "zips" / "1951"
    folder.mkdir(parents=True)
    for name, body in (("a", FIRST), ("b", SECOND)):
        with zipfile.ZipFile(folder / f"codz_{name}.zip", "w") as z:
            z.writestr(f"codz_{name}.csv", body.encode("cp1250"))
    (folder / "broken.zip").write_bytes(b"not a zip")
    lines = archives.scan_members(spark, str(drop / "zips"))
    audit = {r.archive.rsplit("/", 1)[1]: (r.lines, r.ok) for r in archives.archive_audit(lines).collect()}
    assert audit == {"codz_a.zip": (9, True), "codz_b.zip": (2, True), "broken.zip": (0, False)}
    typed = cleaning.type_codz(archives.parse_lines(lines, obs.CODZ_FIELDS, obs.CODZ_NUMBERS))
    assert measured(merge.merge_measurements(cleaning.measurement_rows(typed))) == WANT


def test_members_are_read_by_offset_in_tasks_of_their_own(spark, tmp_path):
    """Stored and deflated members, one that expands far beyond what is read at once, one whose bytes are broken, one without a last line end."""
    import random

    r = random.Random(6)
    bodies = {f"d/{k}.csv": "\n".join(f"{r.random()}" for _ in range(r.randint(0, 3000))).encode() for k in range(6)}
    bodies |= {"flat.csv": b"a,b\r\n" * 700_000, "empty.csv": b"", "broken.csv": b"x" * 5000}
    path = tmp_path / "in" / "many.zip"
    path.parent.mkdir()
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("d/", b"")
        for k, (name, body) in enumerate(bodies.items()):
            z.writestr(zipfile.ZipInfo(name), body, zipfile.ZIP_DEFLATED if k % 2 == 0 and name != "broken.csv" else zipfile.ZIP_STORED)
    raw = path.read_bytes()
    path.write_bytes(raw.replace(b"x" * 5000, b"x" * 4999 + b"y"))
    lines = archives.scan_members(spark, str(tmp_path / "in"), task_bytes=1000)
    assert lines.rdd.getNumPartitions() > 5
    got = {}
    for row in lines.collect():
        got.setdefault(row.member, []).append(row)
    assert "checksum" in [x.error for x in got.pop("broken.csv") if x.error][0]
    for name, body in bodies.items():
        want = [x.rstrip(b"\r\n").decode() for x in body.splitlines(keepends=True)]
        if name != "broken.csv":
            assert [x.line for x in sorted(got.get(name, []), key=lambda x: x.line_no)] == want, name
    assert archives.shares("a", [archives.Member("m", 0, 3 << 30, 8, 0, 0), archives.Member("n", 9, 5, 8, 0, 0)])[0].members[0].name == "m"
    assert archives.scan_members(spark, str(tmp_path / "in"), 10**9).rdd.getNumPartitions() == 1


def test_stream_equals_batch(spark, drop):
    source, table, state = str(drop / "in"), str(drop / "stream"), str(drop / "state")
    ingest.ingest_codz(spark, source, table, state, max_files=1).awaitTermination()
    assert measured(ingest.current_measurements(spark, table)) == WANT
    # a file that comes again under a later name changes nothing but is read
    again = drop / "in" / "1951" / "codz_1951_03.csv"
    again.write_bytes(SECOND.encode("cp1250"))
    ingest.ingest_codz(spark, source, table, state).awaitTermination()
    assert measured(ingest.current_measurements(spark, table)) == WANT
    names = {r.station_code: r.station_name for r in ingest.current_gauges(spark, table).collect()}
    assert names["149180020"] == "CHAŁUPKI"
    ingest.compact(spark, table, str(drop / "compact"))
    assert measured(ingest.current_measurements(spark, str(drop / "compact"))) == WANT
    ingest.ingest_zjaw(spark, source, table, str(drop / "state_ice")).awaitTermination()
    assert ingest.current_phenomena(spark, table).count() == 2


def test_empty_source_is_an_error(spark):
    empty = spark.createDataFrame([], "station_code string")
    with pytest.raises(ValueError):
        tables.require_rows(empty, "measurements")


def test_second_folder_adds_to_the_first(spark, drop):
    root, later = str(drop / "tables"), drop / "later"
    later.mkdir()
    jobs.load_observations(spark, str(drop / "in"), root)
    rows = "\n".join([
        "149180020,NEW NAME,y,1951,01,1,300,1.25,4.5,11",  # known day: values are replaced
        "149180099,Nowa,w,1952,03,7,5,6.5,1.0,1",  # another year
        "149180020,x,y,1951,05,1.5,182,5.5,1.0,3",
        ",x,y,1951,05,6,182,5.5,1.0,3",
    ])
    (later / "codz_1952.csv").write_bytes(rows.encode("cp1250"))
    out = jobs.load_observations(spark, str(later), root)
    want = WANT | {
        ("149180020", "1950-11-01 07:00"): (1951, 1, 11, 300, 1.25, 4.5),
        ("149180099", "1952-01-07 07:00"): (1952, 3, 1, 5, 6.5, 1.0),
    }
    assert measured(out["measurements"]) == want and measured(tables.read_table(spark, root, "measurements")) == want
    names = {r.station_code: r.station_name for r in out["gauges_list"].collect()}
    assert names["149180020"] == "CHAŁUPKI" and names["149180099"] == "Nowa" and len(names) == 4
    assert tables.read_table(spark, root, "phenomena").count() == 2
    audit = {r.file.rsplit("/", 1)[1]: r.reasons for r in out["load_audit"].collect()}
    assert audit["codz_1952.csv"] == ["day not integral", "missing station"] and len(audit) == 4


def test_archives_load_like_files(spark, drop):
    folder = drop / "zips"
    folder.mkdir()
    with zipfile.ZipFile(folder / "all.zip", "w") as z:
        for name, body in (("1951/codz_1951_01.csv", FIRST), ("1951/codz_1951_02.csv", SECOND), ("1951/zjaw_1951.csv", ICE)):
            z.writestr(name, body.encode("cp1250"))
    (folder / "broken.zip").write_bytes(b"not a zip")
    out = jobs.load_archives(spark, str(folder), str(drop / "tables"))
    assert measured(out["measurements"]) == WANT and out["phenomena"].count() == 2
    assert {r.archive.rsplit("/", 1)[1]: r.ok for r in out["archive_audit"].collect()} == {"all.zip": True, "broken.zip": False}


def test_failed_write_leaves_the_table(spark, tmp_path):
    root = str(tmp_path)
    tables.rebuild(spark.range(5), root, "t")
    tables.rebuild_partitions(spark.range(6).withColumn("y", F.col("id") % 2), root, "p", "y")
    bad = spark.range(5).select(F.expr("case when id = 3 then raise_error('no') else id end").cast("long").alias("id"))
    for write in (lambda: tables.rebuild(bad, root, "t"), lambda: tables.rebuild_partitions(bad.withColumn("y", F.lit(1)), root, "p", "y")):
        with pytest.raises(Exception, match="no"):
            write()
    assert tables.read_table(spark, root, "t").count() == 5 and tables.read_table(spark, root, "p").count() == 6
    assert sorted(p.name for p in tmp_path.iterdir()) == ["_commits", "p", "t"]
    assert len(list((tmp_path / "t").iterdir())) == 1 and not list((tmp_path / "p").glob("_fresh*"))


def test_load_does_not_depend_on_the_session_zone(spark, drop):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        typed = cleaning.type_codz(obs.scan_codz(spark, str(drop / "in")))
        seconds = typed.filter("reject_reason is null").agg(F.min(F.unix_timestamp("measured_at"))).first()[0]
        assert seconds % 86400 == 7 * 3600
        out = jobs.load_observations(spark, str(drop / "in"), str(drop / "tables"))
        assert measured(out["measurements"]) == WANT
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_load_merges_in_a_hash_aggregate_and_cleans_up(spark, drop):
    root = drop / "tables"
    jobs.load_observations(spark, str(drop / "in"), str(root))
    typed = obs.ordered(cleaning.type_codz(obs.scan_codz(spark, str(drop / "in"))))
    assert dict(typed.dtypes)["load_order"] == "bigint"
    plan = merge.merge_measurements(cleaning.measurement_rows(typed))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    assert sorted(p.name for p in root.iterdir()) == ["_commits", "gauges_list", "load_audit", "measurements", "phenomena", "stats_pending"]
    from gaugeworks.session import checkpoint_dir
    import pathlib
    assert not list(pathlib.Path(checkpoint_dir(spark).removeprefix("file:")).glob("staging-*"))


def test_scratch_must_be_shared_on_a_cluster(spark, monkeypatch):
    from gaugeworks import session

    class Far:
        class conf:
            get = staticmethod(lambda key, default=None: None)
            set = staticmethod(lambda key, value: None)

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Far)
    Far.sparkContext.master = "local[2]"
    assert "gaugeworks-" in session.checkpoint_dir(Far)


def test_stream_keeps_ice_only_gauges_and_feeds_statistics(spark, drop):
    source, table, root = str(drop / "in"), str(drop / "stream"), str(drop / "published")
    ingest.ingest_codz(spark, source, table, str(drop / "s1"), max_files=1).awaitTermination()
    ingest.ingest_zjaw(spark, source, table, str(drop / "s2")).awaitTermination()
    (drop / "in" / "1951" / "zjaw_1952.csv").write_bytes("149180040,ONLY ICE,y,1952,01,1,5,,40,W\n149180020,LATER,y,1952,01,1,5,,40,W".encode("cp1250"))
    ingest.ingest_zjaw(spark, source, table, str(drop / "s2")).awaitTermination()
    want = {"149180020": "CHAŁUPKI", "149180021": "ŁÓDŹ", "149180022": "Trzecia", "149180040": "ONLY ICE"}
    assert {r.station_code: r.station_name for r in ingest.current_gauges(spark, table).collect()} == want
    audit = {r.file.rsplit("/", 1)[1]: (r.rows, r.rejected) for r in ingest.current_audit(spark, table).collect()}
    assert audit == {"codz_1951_01.csv": (4, 4), "codz_1951_02.csv": (2, 0), "zjaw_1951.csv": (2, 1), "zjaw_1952.csv": (2, 0)}
    small = str(drop / "compact")
    ingest.compact(spark, table, small)
    (drop / "more").mkdir()
    (drop / "more" / "codz_1953.csv").write_bytes(b"149180022,x,w,1953,12,1,9,1.5,2.0,10")
    ingest.ingest_codz(spark, str(drop / "more"), small, str(drop / "s3")).awaitTermination()  # batch 0 of a new state
    ingest.publish(spark, small, root)
    assert measured(tables.read_table(spark, root, "measurements")) == WANT | {("149180022", "1953-10-01 07:00"): (1953, 12, 10, 9, 1.5, 2.0)}
    assert jobs.compute_statistics(spark, root)["stats_alltime"].count() == 3
    assert tables.read_table(spark, root, "load_audit").count() == 5


def test_logs_and_exports_on_storage(spark, tmp_path):
    root = str(tmp_path)
    gauges = spark.createDataFrame([("a", "A", "r", None, None, "u1"), ("b", "B", "r", None, None, "u2")], "station_code string, station_name string, river_name string, lat double, lon double, uuid string")
    tables.rebuild(gauges, root, "gauges_list")
    tables.rebuild(spark.createDataFrame([("a", 1.0), ("b", 2.0)], "station_code string, NNQ double"), root, "stats_alltime")
    values = [float(20 + (i * 37) % 23 + i % 5) for i in range(40)]
    make = lambda codes, up: spark.createDataFrame([(c, 1950 + i, x + up) for c in codes for i, x in enumerate(values)], "station_code string, t int, x double")
    two = ["lognormal_mom", "weibull"]
    assert jobs.log_tests(spark, root, make("ab", 0)).count() == 10
    jobs.log_estimates(spark, root, make("ab", 0), models=two, n_samples=20)
    first = jobs.export_all(spark, root)
    assert (first["estimations"].count(), first["estimated_flows"].count(), first["stations"].count()) == (4, 8, 2)
    jobs.log_tests(spark, root, make("a", 5))
    jobs.log_estimates(spark, root, make("a", 5), models=two, n_samples=20)
    for name, rows in (("stat_test_results", 15), ("fitted_distributions", 6), ("estimated_discharges", 12), ("ci_estimates", 6), ("dist_test_results", 12)):
        ids = sorted(r.id for r in tables.read_table(spark, root, name).select("id").collect())
        assert ids == list(range(1, rows + 1)), name
    before = {(r.station_code, r.distribution): r.id for r in first["estimations"].collect()}
    second = jobs.export_all(spark, root)
    after = {(r.station_code, r.distribution): r.id for r in second["estimations"].collect()}
    assert len(after) == 4 and not set(after.values()) & set(before.values())  # both stations have estimations in this run
    assert second["estimated_flows"].count() == 8 and set(r.estimation_id for r in second["estimated_flows"].collect()) == set(after.values())
    other = tables.rebuild(gauges.filter("station_code = 'b'"), root, "gauges_list")
    assert other.count() == 1 and jobs.export_all(spark, root)["stations"].count() == 2  # what the run does not know stays
