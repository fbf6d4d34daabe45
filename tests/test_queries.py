"""Registered queries against their DuckDB twins; all of them with FRESHET_ALL=1, else one of each family."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from freshet.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
SOME = ["ag9_station_catalog", "ag1_bucket_aggregate", "jo5_missing_days", "wn5_fetch_windows", "df6_forecast_cycle", "sf5_coordinate", "wn2_interval_totals", "gr5_bilinear", "jo11_as_of_join", "jo13_expected_asset", "sk3_value_upsert", "sc5_observation_files", "gx3_basin_weights", "sc10_matrix_records", "sk8_box_of_written_grid", "pj4_forecast_forcing"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def rows(frame):
    def text(v):
        if v is None or str(v) in ("nan", "<NA>", "None", "NaT"):
            return ""
        return f"{float(v) + 0.0:.5f}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    return sorted("|".join(map(text, r)) for r in frame[sorted(frame.columns)].astype(object).values.tolist())


@pytest.mark.parametrize("name", sorted(ORACLES) if os.environ.get("FRESHET_ALL") else SOME)
def test_query(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toPandas(), duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) and rows(got) == rows(want)


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
