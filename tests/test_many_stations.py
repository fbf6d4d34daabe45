"""Queries over observation files of many stations: files, folders and tasks don't grow with the stations."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from freshet import queries_tables as Q
from freshet.queries import QUERIES
from freshet.sources import scans
from freshet.sources.scratch import scratch_dir

STATIONS = 300


@pytest.fixture(scope="module")
def many(spark, tmp_path_factory):
    """Two raw events of each station, a rain and a flow."""
    path = str(tmp_path_factory.mktemp("many"))
    at = datetime.datetime(2024, 1, 1, 4, 10, 30)
    rows = [(3 * i, i % STATIONS, "view" if i < STATIONS else "purchase", at, i / 4) for i in range(2 * STATIONS)]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string, ts timestamp_ntz, value double").write.parquet(f"{path}/events.parquet")
    return path


@pytest.fixture
def folders(monkeypatch):
    """The folders that a query of the files asks for."""
    asked = []

    def new(spark):
        asked.append(scratch_dir(spark))
        return asked[-1]

    monkeypatch.setattr(Q, "scratch_dir", new)
    return asked


def files(spark, folders):
    read = (spark.read.option("recursiveFileLookup", "true").text(f) for f in folders)
    return sum(len([x for x in r.inputFiles() if x.endswith(".csv")]) for r in read)


def station(u):
    return f"{'inmet' if u % 2 else 'ana'}:{u}"


def test_sc5_observation_files(spark, many, folders):
    got = {(r.station_id, r.observed_at, r.variable_code): (r.value, r.state) for r in QUERIES["sc5_observation_files"](spark, many).collect()}
    want = {(station(i % STATIONS), "2024-01-01 04:10:00", "rain" if i < STATIONS else "flow"): (i / 4, "raw") for i in range(2 * STATIONS)}
    assert got == want and 0 < files(spark, folders) < 40


def test_pj1_file_ingest(spark, many, folders):
    got = {r.series_id: (r.observed_at, r.value) for r in QUERIES["pj1_file_ingest"](spark, many).collect()}
    want = {f"{station(i % STATIONS)}.{'rain' if i < STATIONS else 'flow'}.raw": ("2024-01-01 06:00:00", i / 4) for i in range(2 * STATIONS)}
    assert got == want and 0 < files(spark, folders) < 40


def test_sc5_observation_errors(spark, many, folders):
    got = {(r.station_id, r.reason, r.n) for r in QUERIES["sc5_observation_errors"](spark, many).collect()}
    assert got == {(station(u), "variable", 1) for u in range(1, STATIONS, 2)} and 0 < files(spark, folders) < 40


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_rows_are_not_dealt_by_variable(spark, adaptive):
    """Providers and variables are few: with them as keys, a few tasks would have nearly all rows."""
    rows = spark.createDataFrame([("ana", "1", "2024-01-01 00:10", v, x) for v, x in (("rain", "1"), ("flow", "2"), (None, "3"), ("rain", "-"))], "provider_code string, station_code string, observed_at string, variable_code string, value string")
    typed = scans.typed_observations(rows.withColumns({"file_path": F.lit("f"), "row_seq": F.monotonically_increasing_id()}))
    offered = spark.createDataFrame([("ana", "rain"), ("ana", "rain"), ("inmet", "flow")], "provider_code string, variable_code string")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = scans.with_reason(typed, spark.createDataFrame([("ana:1",)], "station_id string"), offered)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert sorted((r.variable_code or "", r.reason or "") for r in out.collect()) == [("", "variable"), ("flow", "variable"), ("rain", ""), ("rain", "value")]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [line for line in plan.splitlines() if "Join [provider_code" in line]
    assert len(joins) == 1 and "BroadcastHashJoin" in joins[0]
