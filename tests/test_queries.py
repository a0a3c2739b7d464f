"""Queries against DuckDB. All of them with GAUGEWORKS_FULL=1, a quick choice otherwise."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from tools.check_oracle import normal

QUICK = [
    "stats_monthly", "stats_alltime", "ice_days", "measurements_upsert", "reject_audit", "scan_codz",
    "quality_report", "spearman", "grubbs_beck", "fit_pearson3", "design_flows", "replace_export", "plot_points",
    "fit_gev", "stats_together",
]
NAMES = sorted(entry.oracle_sql()) if os.environ.get("GAUGEWORKS_FULL") else QUICK


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SMALL).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    got = normal(entry.queries()[name](spark, SMALL).toPandas())
    want = normal(duck.execute(entry.oracle_sql()[name]).df())
    assert list(got.columns) == list(want.columns) and len(got) == len(want)
    for c in got.columns:
        assert ((got[c] == want[c]) | (got[c].isna() & want[c].isna())).all(), c


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
