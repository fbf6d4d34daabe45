"""Work by different places, joins of tables of nodes without a broadcast, minis over tasks."""

from __future__ import annotations

import pytest

from freshet.operators import grids as G
from freshet.operators import network as N


def test_a_small_file_of_minis_is_dealt_over_tasks(spark):
    axis = spark.createDataFrame([("2026-01-01",), ("2026-01-02",)], "dt string")
    block = G.zero_block(axis, spark.range(100).withColumnRenamed("id", "mini_id").coalesce(1))
    assert block.rdd.getNumPartitions() > 1 and block.distinct().count() == 200


def test_equal_places_are_asked_once(spark, monkeypatch):
    asked = []
    pairs = G.near_pairs
    monkeypatch.setattr(G, "near_pairs", lambda targets, *rest: asked.append(targets.count()) or pairs(targets, *rest))
    targets = spark.createDataFrame([(i, float(i % 3), 0.0) for i in range(60)] + [(60, None, 0.0)], "target_id long, lat double, lon double")
    samples = spark.createDataFrame([("a", 0.0, 0.0, 1.0), ("b", 1.0, 0.0, 3.0), ("c", 2.5, 0.0, None)], "source_id string, lat double, lon double, value double")
    near = G.nearest(targets, samples, 2).collect()
    assert asked == [3] and len(near) == 120
    assert {(r.source_id, r.distance, r.place) for r in near if r.target_id == 59} == {("c", 0.5, 1), ("b", 1.0, 2)}
    got = {r.target_id: r.value for r in G.idw(targets, samples, 2).collect()}
    assert len(got) == 61 and got[60] is None and (got[57], got[58], got[59]) == (1.0, 3.0, pytest.approx(2.6))


def test_nodes_are_not_broadcast(spark):
    minis = spark.createDataFrame([(i, i // 2, 1.0) for i in range(1, 64)] + [(100, 101, 1.0), (101, 100, 1.0), (102, 100, 1.0)], "mini_id long, mini_jus long, mini_area double")
    assert "Broadcast" not in N._edges(minis)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in N.numbered(minis)._jdf.queryExecution().executedPlan().toString()
    assert {r.mini_id: r.steps for r in N.upstream(minis, 3).collect()} == {i: i.bit_length() - 2 for i in range(1, 64) if bin(i).startswith("0b11")}
    assert {(r.mini_id, r.reason) for r in N.network_errors(minis).collect()} == {(100, "cycle"), (101, "cycle"), (102, "cycle")}
