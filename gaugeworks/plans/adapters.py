"""The driver's tables seen as gauge tables.

Expressions are plain SQL that Spark and DuckDB both read, so ``queries`` and ``oracle`` start
from the same rows and differ in everything after.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.operators import series as srs
from gaugeworks.session import configure

Y, M, D = "year(l_shipdate)", "month(l_shipdate)", "day(l_shipdate)"

# Flow is kept to eighths, so that sums are exact in any order.
MEASUREMENT = {
    "station_code": "cast(l_suppkey as varchar(20))",
    "measured_at": f"make_timestamp({Y}, {M}, {D}, 7, 0, 0)",
    "hydro_year": f"cast({Y} + case when {M} >= 11 then 1 else 0 end as int)",
    "hydro_month": f"cast(({M} + 1) % 12 + 1 as int)",
    "calendar_month": f"cast({M} as int)",
    "water_level_cm": "case when l_quantity = 50 then null else cast(l_quantity * 10 as int) end",
    "flow_m3s": "case when l_linenumber = 7 then null else floor(l_extendedprice * 8) / 8 end",
    "water_temp_c": "l_discount * 100",
}
# Line items in key order; the part separates the few that share an order line.
LINE_ORDER = "(l_orderkey * 8 + l_linenumber) * 16777216 + l_partkey"
GAUGE = {
    "station_code": "cast(s_suppkey as varchar(20))",
    "station_name": "s_name",
    "river_name": "n_name",
}
PHENOMENON = {
    "station_code": "cast(user_id as varchar(20))",
    "measured_at": "make_timestamp(year(ts), month(ts), day(ts), 7, 0, 0)",
    "hydro_year": "cast(year(ts) + case when month(ts) >= 11 then 1 else 0 end as int)",
    "hydro_month": "cast((month(ts) + 1) % 12 + 1 as int)",
    "ice_thickness_cm": "case when event_type = 'error' then null else cast(floor(value) as int) end",
    "ice_phenomenon_code": "case when event_type = 'view' then null else event_type end",
    "ice_phenomenon_pct": "cast(replace(substr(props, 7), '}', '') as int)",
    "overgrowth_code": "cast(null as varchar(20))",
}

# Raw text as found in files: quotes, padding, sentinels, gaps and mistakes, all by row content.
RAW_COMMON = {
    "station_code": "case when l_partkey % 331 = 0 then '\"\"' else concat('\"', cast(l_suppkey as varchar(20)), '\"') end",
    "station_name": "concat(' CHAŁUPKI ŁÓDŹ ', cast(l_suppkey % 7 as varchar(20)), '  ')",
    "river_name": "case when l_suppkey % 5 = 0 then 'NA' else concat('\" Odra (', cast(l_suppkey as varchar(20)), ') \"') end",
    "hydro_year": (
        f"case when l_orderkey % 101 = 0 then 'abc' else cast({Y} + case when {M} >= 11 then 1 else 0 end as varchar(20)) end"
    ),
    "hydro_month": f"lpad(cast(({M} + 1) % 12 + 1 as varchar(20)), 2, '0')",
    "day": f"case when l_partkey % 337 = 0 then '1.5' when l_orderkey % 53 = 0 then '31' else cast({D} as varchar(20)) end",
}
RAW_CODZ = {
    **RAW_COMMON,
    "water_level_cm": (
        "case when l_quantity = 50 then '9999' when l_partkey % 97 = 0 then '181.5' "
        "else cast(cast(l_quantity as int) as varchar(20)) end"
    ),
    "flow_m3s": (
        "case when l_linenumber = 7 then '99999.999' when l_linenumber = 6 then 'NA' "
        "else concat(' ', cast(cast(floor(l_extendedprice) as int) as varchar(20)), '.25') end"
    ),
    "water_temp_c": "case when l_discount > 0.085 then '99.9' else cast(cast(floor(l_tax * 100) as int) as varchar(20)) end",
    "calendar_month": f"case when l_orderkey % 3 = 0 then '' else cast({M} as varchar(20)) end",
}
RAW_ZJAW = {
    **RAW_COMMON,
    "ice_thickness_cm": "case when l_linenumber = 7 then '999' else cast(cast(l_quantity as int) as varchar(20)) end",
    "ice_phenomenon_code": "case when l_returnflag = 'N' then '' else l_returnflag end",
    "ice_phenomenon_pct": "cast(cast(floor(l_discount * 100) as int) as varchar(20))",
    "overgrowth_code": "case when l_linestatus = 'O' then '  ' else '\"W\"' end",
}

# Series: station, block number, value.
SERIES = {
    "A": ("events", "event_type", "cast(floor({us} / 21600000000.0) as int)", "value"),
    "B": ("events", "cast(user_id as varchar(20))", "cast(floor({us} / 86400000000.0) as int)", "value"),
    "C": ("lineitem", "cast(l_suppkey as varchar(20))", f"cast({Y} * 12 + {M} as int)", "l_extendedprice"),
}
_MICROS = "timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def columns(expressions: dict[str, str]) -> list[str]:
    return [f"{e} as {c}" for c, e in expressions.items()]


def gauges(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = load(spark, sf_dir, "supplier").join(
        load(spark, sf_dir, "nation"), F.expr("s_nationkey = n_nationkey")
    )
    return joined.selectExpr(*columns(GAUGE))


def measurement_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rows with repeats of a key, in load order."""
    return load(spark, sf_dir, "lineitem").selectExpr(
        *columns(MEASUREMENT), f"{LINE_ORDER} as load_order"
    )


def phenomenon_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").selectExpr(*columns(PHENOMENON), "event_id as load_order")


def raw_rows(spark: SparkSession, sf_dir: str, expressions: dict[str, str]) -> DataFrame:
    return load(spark, sf_dir, "lineitem").selectExpr(
        *columns(expressions), f"{LINE_ORDER} as load_order"
    )


def one_series(spark: SparkSession, sf_dir: str, which: str, prefix: bool = True) -> DataFrame:
    table, station, block, value = SERIES[which]
    code = F.expr(station)
    if prefix:
        code = F.concat(F.lit(which + ":"), code)
    return srs.block_maxima(
        load(spark, sf_dir, table), code, F.expr(block.format(us=_MICROS)), F.expr(value)
    )


def all_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types by six hours, users by day and suppliers by month."""
    a, b, c = (one_series(spark, sf_dir, w) for w in "ABC")
    return a.unionByName(b).unionByName(c)


def series_gauges(series: DataFrame) -> DataFrame:
    """A gauge table for the stations of a series."""
    codes = series.select("station_code").distinct()
    return codes.select(
        "station_code", F.concat(F.lit("Station "), "station_code").alias("station_name"),
        F.substring("station_code", 1, 1).alias("river_name"),
        F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"),
    )
