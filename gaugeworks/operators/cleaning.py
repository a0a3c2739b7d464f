"""From tidied fields to typed, dated table rows (P4-P12) with row-level rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions import calendar as cal
from gaugeworks.functions import text
from gaugeworks.schemas import MEASUREMENT_CALENDAR, MEASUREMENT_VALUES, PHENOMENON_CALENDAR, PHENOMENON_VALUES

GAUGE_COLUMNS = ["station_code", "station_name", "river_name"]


def numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace text columns by numbers; unreadable text becomes null."""
    return df.withColumns({c: text.to_number(F.col(c)) for c in columns})


def with_calendar(df: DataFrame, calendar_month: Column | None = None) -> DataFrame:
    """Numeric ``calendar_month`` (given, else derived) and ``measured_at``."""
    derived = cal.calendar_month_of(F.col("hydro_month"))
    month = derived if calendar_month is None else F.coalesce(calendar_month, derived)
    df = df.withColumn("calendar_month", month)
    return df.withColumn(
        "measured_at", cal.observation_time(F.col("hydro_year"), F.col("calendar_month"), F.col("day"))
    )


def _reject(whole: list[str]) -> Column:
    """First reason a row cannot be kept, or null."""
    dated = [F.col(c).isNull() for c in ("hydro_year", "hydro_month", "day")]
    reason = (
        F.when(F.col("too_long"), "too many fields")
        .when(F.coalesce(F.col("station_code"), F.lit("")) == "", "missing station")
        .when(dated[0] | dated[1] | dated[2], "missing date part")
    )
    for c in whole:
        reason = reason.when(~text.is_integral(F.col(c)), f"{c} not integral")
    return reason.when(F.col("measured_at").isNull(), "no such date")


def _flagged(rows: DataFrame) -> DataFrame:
    """Rows that do not come from a file scan have no field too many."""
    return rows if "too_long" in rows.columns else rows.withColumn("too_long", F.lit(False))


def type_codz(rows: DataFrame) -> DataFrame:
    """Typed level / flow / temperature rows with ``reject_reason``."""
    df = with_calendar(_flagged(rows), F.col("calendar_month"))
    df = df.withColumns({
        "water_level_cm": text.level_value(F.col("water_level_cm")),
        "flow_m3s": text.flow_value(F.col("flow_m3s")),
        "water_temp_c": text.temp_value(F.col("water_temp_c")),
    })
    whole = ["hydro_year", "hydro_month", "day", "calendar_month", "water_level_cm"]
    df = df.withColumn("reject_reason", _reject(whole))
    return df.withColumns({c: text.narrow(F.col(c)) for c in whole}).drop("too_long")


def type_zjaw(rows: DataFrame) -> DataFrame:
    """Typed ice / vegetation rows with ``reject_reason``."""
    df = with_calendar(_flagged(rows))
    df = df.withColumns({
        "ice_thickness_cm": text.ice_value(F.col("ice_thickness_cm")),
        "ice_phenomenon_code": text.blank_to_null(F.col("ice_phenomenon_code")),
        "overgrowth_code": text.blank_to_null(F.col("overgrowth_code")),
    })
    whole = ["hydro_year", "hydro_month", "day", "ice_thickness_cm", "ice_phenomenon_pct"]
    df = df.withColumn("reject_reason", _reject(whole))
    return df.withColumns({c: text.narrow(F.col(c)) for c in whole}).drop("too_long")


def _accepted(typed: DataFrame, columns: list[str]) -> DataFrame:
    extra = ["load_order"] if "load_order" in typed.columns else []
    return typed.filter(F.col("reject_reason").isNull()).select(*columns, *extra)


def measurement_rows(typed: DataFrame) -> DataFrame:
    return _accepted(typed, ["station_code", "measured_at", *MEASUREMENT_CALENDAR, *MEASUREMENT_VALUES])


def phenomenon_rows(typed: DataFrame) -> DataFrame:
    return _accepted(typed, ["station_code", "measured_at", *PHENOMENON_CALENDAR, *PHENOMENON_VALUES])


def gauge_rows(typed: DataFrame) -> DataFrame:
    return _accepted(typed, GAUGE_COLUMNS)


def reject_audit(typed: DataFrame) -> DataFrame:
    """Per file: rows kept, rows rejected, and the reasons seen."""
    bad = F.col("reject_reason").isNotNull()
    return typed.groupBy("file").agg(
        F.count_if(~bad).alias("rows"),
        F.count_if(bad).alias("rejected"),
        F.sort_array(F.collect_set("reject_reason")).alias("reasons"),
    ).withColumn("ok", F.col("rejected") == 0)
