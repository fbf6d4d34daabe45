"""Turned grids: every cell of small ones, and long ones of which only the cells around targets are made."""

from __future__ import annotations

import math
import os

import pytest
from pyspark.sql import functions as F

from freshet.operators import grids as G


def grid(spark, ny, nx, asset="a", r=0.25):
    """A grid whose lower left centre is at (r / 2, r / 2); every seventh value is missing."""
    rows = spark.range(ny * nx).select(F.floor(F.col("id") / nx).cast("int").alias("iy"), (F.col("id") % nx).cast("int").alias("ix"), F.when(F.col("id") % 7 != 3, F.col("id").cast("double")).alias("value"))
    start = F.lit("2026-03-18 00:00:00").cast("timestamp_ntz")
    return rows.select(F.lit(asset).alias("asset_id"), start.alias("start_utc"), (start + F.expr("interval 3 hours")).cast("timestamp_ntz").alias("end_utc"), "iy", "ix", ((F.col("iy") + 0.5) * r).alias("lat"), ((F.col("ix") + 0.5) * r).alias("lon"), "value")


def brute(ny, nx, degrees, my, mx, f, r=0.25):
    """``(lat, lon): value`` by going through all cells of the box around the turned grid."""
    s, c = math.sin(math.radians(degrees)), math.cos(math.radians(degrees))
    cy, cx = ny * r / 2, nx * r / 2
    my, mx = round(my) * r, round(mx) * r
    edges = [(cx + (px + mx - cx) * c - (py + my - cy) * s, cy + (px + mx - cx) * s + (py + my - cy) * c) for px in (0, nx * r) for py in (0, ny * r)]
    west, east = (g(round(h(e[0] for e in edges) / r, 9)) for g, h in ((math.floor, min), (math.ceil, max)))
    south, north = (g(round(h(e[1] for e in edges) / r, 9)) for g, h in ((math.floor, min), (math.ceil, max)))
    out = {}
    for y in range(south, north):
        for x in range(west, east):
            dy, dx = (y + 0.5) * r - cy, (x + 0.5) * r - cx
            row, col = round(round((cy + c * dy - s * dx - my - r / 2) / r, 9)), round(round((cx + c * dx + s * dy - mx - r / 2) / r, 9))
            i = row * nx + col
            out[y, x] = i * f if 0 <= row < ny and 0 <= col < nx and i % 7 != 3 else None
    return out


@pytest.mark.parametrize("degrees", [0.0, 20.0, 45.0, 90.0, 180.0, 213.7])
def test_every_cell_of_the_box(spark, monkeypatch, degrees):
    monkeypatch.setattr(G, "TILE", 4)
    got = G.rotated(grid(spark, 5, 9), 0.25, degrees, 1.0, -2.0, 2.0).collect()
    want = brute(5, 9, degrees, 1, -2, 2.0)
    assert len(got) == len(want) and {(round(r.lat / 0.25 - 0.5), round(r.lon / 0.25 - 0.5)): r.value for r in got} == want
    assert min(r.iy for r in got) == min(r.ix for r in got) == 0


def test_some_cells_are_those_of_the_whole(spark):
    wanted = spark.createDataFrame([(y, x) for y in range(-3, 4) for x in (-1, 2, 5, 90)] * 2, "gy int, gx int")
    every, some = ({(r.iy, r.ix, r.lat, r.lon, r.value) for r in d.collect()} for d in (G.rotated(grid(spark, 5, 9), 0.25, 30.0), G.rotated_at(grid(spark, 5, 9), wanted, 0.25, 30.0)))
    assert some == {r for r in every if -3 <= round(r[2] / 0.25 - 0.5) < 4 and round(r[3] / 0.25 - 0.5) in (-1, 2, 5, 90)} and some


def test_a_long_grid_turned_at_a_few_targets(spark):
    """A grid of two rows of 30,000 cells, whose box has 450 million cells after the turn."""
    cells = grid(spark, 2, 30_000)
    edits = spark.createDataFrame([("a", 0, 3, 0.0, 0.0, 45.0, 1.0)], "asset_id string, t0_step int, t1_step int, shift_lat double, shift_lon double, rotation_deg double, multiplication_factor double")
    # the middle of the grid stays where it is; a target far from it lies in the box, but not on the turned grid
    targets = spark.createDataFrame([("middle", 0.25, 3750.0), ("aside", 500.0, 3750.0), ("outside", 0.25, 9000.0)], "target_id string, lat double, lon double")
    got = {r.target_id for r in G.forecast_working_grid(cells, edits, targets, (0.125, 0.125), 0.25, 3, strict=False).collect()}
    assert got == {"middle", "aside"}


def test_equal_places_in_bilinear(spark):
    """Targets at one place, one on a centre beside a missing cell, one next to it, one at the edge, one beyond the grid."""
    places = {"p": (1.0, 1.0), "q": (1.0, 1.0), "on": (0.5, 2.5), "null": (0.6, 2.6), "edge": (0.5, 0.4), "far": (50.0, 50.0)}
    targets = spark.createDataFrame([(k, *v) for k, v in places.items()], "target_id string, lat double, lon double")
    got = {r.target_id: r.value for r in G.bilinear(grid(spark, 3, 4, r=1.0), targets, (0.5, 0.5), 1.0).collect()}
    assert got == {"p": 2.5, "q": 2.5, "on": 2.0, "null": None, "edge": None}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="the driver's tables aren't here")
def test_times_of_a_turned_grid_are_text_before_the_cells_are_made(spark):
    """The query of all cells of the boxes casts no time after the last generator."""
    from freshet.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    plan = QUERIES["gr8_rotate"](spark, folder)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    last = min(i for i, line in enumerate(plan) if "Generate explode" in line)
    assert not any("_utc" in line and "cast(" in line and "as string" in line for line in plan[:last])


def test_files_of_a_box_stay_small(spark, tmp_path):
    """A box of 4 million cells, almost all of them empty: its columns repeat from row to row, so that a cell takes little of a file."""
    G.rotated(grid(spark, 2, 2830), 0.25, 45.0).write.parquet(f"{tmp_path}/box")
    cells = spark.read.parquet(f"{tmp_path}/box").count()
    assert cells > 4_000_000 and sum(f.stat().st_size for f in (tmp_path / "box").glob("*.parquet")) < cells


@pytest.mark.parametrize("degrees", [0.0, 20.0, 90.0])
def test_every_cell_of_small_blocks(spark, monkeypatch, degrees):
    monkeypatch.setattr(G, "TILE", 4)
    monkeypatch.setattr(G, "BLOCK", 2)
    got = G.rotated(grid(spark, 5, 9), 0.25, degrees, 1.0, -2.0, 2.0).collect()
    want = brute(5, 9, degrees, 1, -2, 2.0)
    assert len(got) == len(want) and {(round(r.lat / 0.25 - 0.5), round(r.lon / 0.25 - 0.5)): r.value for r in got} == want


def test_six_decimals_are_those_of_round(spark):
    from freshet.queries import six_decimals

    numbers = [0.125, -33.0, 0.1 + 0.2, 1.0000005, -1.0000005, 2.5e-7, 5e-7, -1e-9, -0.0, 4294967296.123457, 8589934593.000001, 1e15 + 0.3, 1e300, float("nan"), float("inf"), float("-inf"), None] + [k / 7 for k in range(-50, 50)] + [k * 1e-6 for k in range(-50, 50)]
    rows = spark.createDataFrame([(x,) for x in numbers], "x double").select((F.round("x", 6) + 0.0).alias("a"), (six_decimals(F.col("x")) + 0.0).alias("b")).collect()
    assert [repr(r.a) for r in rows] == [repr(r.b) for r in rows]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="the driver's tables aren't here")
def test_times_of_edited_cells_are_text_before_the_cells_are_made(spark):
    from freshet.queries import QUERIES

    plan = QUERIES["jo8_edited_cells"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    last = next(i for i, line in enumerate(plan) if "Generate explode" in line and "array_except" in line)
    assert not any("as string" in line for line in plan[last - 2 : last])
