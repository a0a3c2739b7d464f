"""Hydrological calendar (P5-P8, P13). The hydrological year runs 1 November - 31 October."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OBSERVATION_HOUR_UTC = 7  # fixed value: daily readings are taken at 07:00 UTC


def calendar_month_of(hydro_month: Column) -> Column:
    """1 = November ... 12 = October."""
    return F.pmod(hydro_month + 9, F.lit(12)) + 1


def hydro_month_of(calendar_month: Column) -> Column:
    return F.pmod(calendar_month + 1, F.lit(12)) + 1


def calendar_year_of(hydro_year: Column, calendar_month: Column) -> Column:
    return F.when(calendar_month <= 10, hydro_year).otherwise(hydro_year - 1)


def hydro_year_of(calendar_year: Column, calendar_month: Column) -> Column:
    return F.when(calendar_month <= 10, calendar_year).otherwise(calendar_year + 1)


def observation_time(hydro_year: Column, calendar_month: Column, day: Column) -> Column:
    """Timestamp of the reading; null for dates that do not exist."""
    year = calendar_year_of(hydro_year, calendar_month)
    return F.try_make_timestamp(
        year.try_cast("int"), calendar_month.try_cast("int"), day.try_cast("int"),
        F.lit(OBSERVATION_HOUR_UTC), F.lit(0), F.lit(0), F.lit("UTC"),
    )


def season_of(hydro_month: Column) -> Column:
    """Winter half-year = hydrological months 1-6."""
    return F.when(hydro_month.between(1, 6), "winter").otherwise("summer")


def season_order(season: Column) -> Column:
    """Winter precedes summer; a plain string sort would not."""
    return F.when(season == "winter", 0).otherwise(1)
