"""Queries of loads that share tables, streams among them, and of statistics that are refreshed by what loads changed; and their SQL."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.operators import cleaning
from gaugeworks.operators import statistics as st
from gaugeworks.plans import adapters as ad
from gaugeworks.plans import jobs
from gaugeworks.plans.oracle import (
    _CODZ_OUT, _CODZ_TYPED, _LINE_ORDER, _LINES, _WHOLE_LINES, ALLTIME, ANNUAL, MEAS, MONTHLY, ORACLE, SEASONAL, _raw, _with,
)
from gaugeworks.plans.queries import _CODZ_VALUES, _clock, _codz_lines, _measurements, _part_lines, _typed, query
from gaugeworks.schemas import STAT_COLUMNS
from gaugeworks.session import configure, scratch_path
from gaugeworks.sources import archives, tables
from gaugeworks.sources import observations as obs
from gaugeworks.streaming import ingest

#: Parts of the line items, each sharing a third with the next; every row is in two of them.
PARTS = ["l_orderkey % 3 <> 0", "l_orderkey % 3 <> 1", "l_orderkey % 3 <> 2"]
#: What the second load of ``refresh_changed`` holds; the first holds all else.
LATER = "l_suppkey % 5 = 0 and l_orderkey % 2 = 0"


def _with_names(root_tables: dict[str, DataFrame]) -> DataFrame:
    names = root_tables["gauges_list"].select("station_code", "station_name", "river_name")
    return _clock(root_tables["measurements"].join(names, "station_code"))


@query
def ingest_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The table that a stream's own state gives, all columns, from files with odd lines among the others."""
    configure(spark)
    work = scratch_path(spark, "stream")
    obs.write_lines(_codz_lines(spark, sf, ordered=True), f"{work}/in")
    ingest.ingest_codz(spark, f"{work}/in", f"{work}/state", f"{work}/checkpoint", glob="part-*").awaitTermination()
    ingest.publish(spark, f"{work}/state", f"{work}/tables")
    return _with_names({name: tables.read_table(spark, f"{work}/tables", name) for name in ("measurements", "gauges_list")})


@query
def stream_after_load(spark: SparkSession, sf: str) -> DataFrame:
    """A batch load, a stream and a batch load into the same tables."""
    configure(spark)
    work = scratch_path(spark, "shared-tables")
    for k, part in enumerate(PARTS):
        obs.write_lines(_part_lines(spark, sf, part), f"{work}/in-{k}")
    load = lambda k: jobs.load_observations(spark, f"{work}/in-{k}", f"{work}/tables", globs=("part-*", "none-*"))
    load(0)
    ingest.ingest_tables(spark, f"{work}/in-1", f"{work}/tables", f"{work}/checkpoint", glob="part-*").awaitTermination()
    return _with_names(load(2))


def _gathered(batches: Iterator[pd.DataFrame], size: int = 10_000) -> Iterator[list[str]]:
    """Lines of batches that come to ``size`` rows, so that members do not hang on how small a session makes its batches."""
    held: list[str] = []
    for batch in batches:
        held += batch["line"].to_list()
        if len(held) >= size:
            yield held
            held = []
    if held:
        yield held


def _zip(lines: DataFrame, folder: str, members: int = 3) -> None:
    """Pack a frame of lines, in the order of its partitions, into one archive per partition with several members per batch; a task holds a batch."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow.fs import FileSystem

        name = f"{TaskContext.get().partitionId():06d}.zip"
        store, base = FileSystem.from_uri(folder if ":/" in folder else f"file://{folder}")
        store.create_dir(base, recursive=True)
        with store.open_output_stream(f"{base}/{name}") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for no, rows in enumerate(_gathered(batches)):
                for k in range(members):
                    part = rows[len(rows) * k // members:len(rows) * (k + 1) // members]
                    z.writestr(f"1951/codz_{no:08d}_{k}.csv", "\r\n".join(part).encode("latin-1"))
        yield pd.DataFrame({"name": [name]})

    lines.select("line").mapInPandas(pack, "name string").count()


@query
def scan_zip(spark: SparkSession, sf: str) -> DataFrame:
    """Lines packed into archives and read member by member."""
    configure(spark)
    path = scratch_path(spark, "zip")
    _zip(_codz_lines(spark, sf, ordered=True), path)
    rows = archives.member_rows(archives.scan_members(spark, path), obs.CODZ_GLOB, obs.CODZ_FIELDS, obs.CODZ_NUMBERS)
    return _typed(cleaning.type_codz(rows), _CODZ_VALUES)


@query
def load_zip(spark: SparkSession, sf: str) -> DataFrame:
    """The load job on archives: members in order, the last row of a key wins."""
    work = scratch_path(spark, "zip-load")
    _zip(_codz_lines(spark, sf, ordered=True), f"{work}/in")
    return _with_names(jobs.load_archives(spark, f"{work}/in", f"{work}/tables"))


def _refreshed(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    configure(spark)
    root = scratch_path(spark, "refresh")
    rows = ad.load(spark, sf, "lineitem")
    for k, part in enumerate((f"not ({LATER})", LATER)):
        with tables.change(spark, root) as change:
            jobs.merge_rows(change, rows.filter(part).selectExpr(*ad.columns(ad.MEASUREMENT), f"{ad.LINE_ORDER} as load_order"))
        out = jobs.refresh_statistics(spark, root)
    return out


@query
def refresh_changed(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics after a second load that touches a fifth of the stations."""
    out = _refreshed(spark, sf)
    frames = [
        out["stats_monthly"].select("station_code", F.lit("month").alias("grain"), "year", F.col("month").alias("part"), *STAT_COLUMNS, "mes_count"),
        out["stats_annual"].select("station_code", F.lit("year").alias("grain"), F.col("hydro_year").alias("year"), F.lit(0).alias("part"), *STAT_COLUMNS, "mes_count"),
        out["stats_seasonal"].select("station_code", F.col("season").alias("grain"), F.col("hydro_year").alias("year"), F.lit(0).alias("part"), *STAT_COLUMNS, "mes_count"),
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query
def refresh_alltime(spark: SparkSession, sf: str) -> DataFrame:
    return _refreshed(spark, sf)["stats_alltime"]


@query
def stats_together(spark: SparkSession, sf: str) -> DataFrame:
    """All three grains from one exchange."""
    return st.periods(_measurements(spark, sf)).drop("hydro_year")


def _loads(parts: list[str], fields: dict[str, str] = ad.RAW_CODZ, whole: str = "") -> str:
    union = " UNION ALL ".join(f"SELECT *, {k} AS load FROM good WHERE {part}" for k, part in enumerate(parts))
    return f"""WITH {_raw(fields, 'l_orderkey, l_linenumber, l_partkey')}, {_CODZ_TYPED},
  good AS (SELECT * FROM ({_CODZ_OUT.replace('SELECT station_code', f'SELECT l_orderkey, {_LINE_ORDER} AS place, station_code', 1)}{whole})),
  loads AS ({union}), ranked AS (SELECT *, row_number() OVER (ORDER BY load, place) AS o FROM loads),
  names AS (SELECT station_code, arg_min({{'a': station_name, 'b': river_name}}, o) AS f FROM ranked GROUP BY 1),
  merged AS (SELECT station_code, measured_at, arg_min({{'y': hydro_year, 'm': hydro_month, 'c': calendar_month}}, o) AS f,
    arg_max({{'w': water_level_cm, 'q': flow_m3s, 't': water_temp_c}}, o) AS l FROM ranked GROUP BY ALL)
  SELECT station_code, n.f.a AS station_name, n.f.b AS river_name, measured_at, m.f.y AS hydro_year, m.f.m AS hydro_month, m.f.c AS calendar_month,
    m.l.w AS water_level_cm, m.l.q AS flow_m3s, m.l.t AS water_temp_c FROM merged m JOIN names n USING (station_code)"""


def _sql() -> dict[str, str]:
    two_loads = MEAS.replace(f"{_LINE_ORDER} AS load_order", f"CASE WHEN {LATER} THEN 1 ELSE 0 END * 1152921504606846976 + {_LINE_ORDER} AS load_order")
    assert two_loads != MEAS
    values = ", ".join([*STAT_COLUMNS, "mes_count"])
    rows = (f"SELECT station_code, 'month' AS grain, year, month AS part, {values} FROM monthly UNION ALL SELECT station_code, 'year', hydro_year, 0, {values} FROM annual "
            f"UNION ALL SELECT station_code, season, hydro_year, 0, {values} FROM seasonal")
    together = (f"SELECT station_code, 'monthly' AS grain, year, month AS part, {values} FROM monthly UNION ALL SELECT station_code, 'annual', hydro_year, 0, {values} FROM annual "
                f"UNION ALL SELECT station_code, 'seasonal', hydro_year, CASE season WHEN 'winter' THEN 0 ELSE 1 END, {values} FROM seasonal")
    return {
        "ingest_stream": _loads(["true"], _LINES, _WHOLE_LINES),
        "load_zip": _loads(["true"], _LINES, _WHOLE_LINES),
        "stream_after_load": _loads(PARTS),
        "refresh_changed": _with(two_loads, MONTHLY, ANNUAL, SEASONAL) + rows,
        "refresh_alltime": _with(two_loads, MONTHLY, ALLTIME) + "SELECT * FROM alltime",
        "stats_together": _with(MEAS, MONTHLY, ANNUAL, SEASONAL) + together,
    }


ORACLE |= _sql()
