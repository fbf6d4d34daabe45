"""Dyadic bins against brute force: each point meets each interval that holds it once."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from freshet.operators import grids as G
from freshet.operators import intervals as I
from freshet.operators import registry as R


def test_each_point_is_in_one_bin_of_each_interval(spark):
    rng = random.Random(2)
    spans = [(i, a := rng.randint(-300, 300), a + rng.choice([-1, 0, 1, 2, 3, 7, 64, rng.randint(1, 200)])) for i in range(300)] + [(900, None, 3), (901, 0, 256), (902, -256, 1)]
    s = spark.createDataFrame(spans, "id long, a long, b long")
    depth = I.depth_of(max(b - a for _, a, b in spans if a is not None))
    bins = I.bins_of_spans(s, F.col("a"), F.col("b"), depth)
    p = I.bins_of_points(spark.range(-310, 520).withColumnRenamed("id", "at"), F.col("at"), depth)
    got = sorted((r.id, r.at) for r in bins.join(p, I.BIN).collect())
    assert got == sorted((i, x) for i, a, b in spans if a is not None for x in range(a, b))
    assert bins.groupBy("id").count().agg(F.max("count")).first()[0] <= 2 * (depth + 1)
    assert I.depth_of(None) == 0 == I.depth_of(1) and I.depth_of(256) == 8


@pytest.mark.parametrize("step", [timedelta(hours=6), timedelta(seconds=7), timedelta(microseconds=1)])
def test_as_of(spark, step):
    rng, start = random.Random(3), datetime(1969, 12, 25)
    at = lambda n: start + n * step
    assets = [(f"a{i:03}", rng.choice(["x", "y"]), k := rng.randint(0, 100), k + rng.choice([0, 1, 5, 60]), rng.choice([None, 1, 2])) for i in range(150)]
    points = [(i, rng.choice(["x", "y", "z"]), rng.randint(-10, 180), rng.choice([0, 0, 1])) for i in range(400)]
    a = spark.createDataFrame([(i, "forecast_grid" if n % 9 else "other", p, at(f), at(t), None if c is None else at(c)) for n, (i, p, f, t, c) in enumerate(assets)], "asset_id string, asset_kind string, provider_code string, valid_from timestamp_ntz, valid_to timestamp_ntz, created_at timestamp_ntz")
    p = spark.createDataFrame([(i, p, at(k) + late * step / 2) for i, p, k, late in points], "point_id long, provider_code string, at timestamp_ntz")
    got = {r.point_id: r.asset_id for r in R.as_of(p, a, "forecast_grid").collect()}
    half = step / 2 > timedelta(0)
    want = {}
    for i, provider, k, late in points:
        k2 = 2 * k + (late if half else 0)
        held = [(-f, -1 if c is None else -c, c is None, name) for n, (name, own, f, t, c) in enumerate(assets) if n % 9 and own == provider and 2 * f <= k2 <= 2 * t]
        held = [(f, c is None, -(c or 0), name) for f, name, c in ((-2 * assets[int(x[3][1:])][2], x[3], assets[int(x[3][1:])][4]) for x in held)]
        want[i] = min(held)[3] if held else None
    assert got == want and len(set(want.values())) > 10


def test_work_of_as_of_grows_with_rows(spark):
    """Long validity, one provider: what is joined is a few rows for each point, not all assets that hold it."""
    n = 2000
    a = spark.range(n).select(F.col("id").cast("string").alias("asset_id"), F.lit("k").alias("asset_kind"), F.lit("p").alias("provider_code"), F.timestamp_add("HOUR", F.col("id"), F.lit("2026-01-01").cast("timestamp_ntz")).alias("valid_from")).withColumns({"valid_to": F.timestamp_add("HOUR", F.lit(1000), F.col("valid_from")), "created_at": F.col("valid_from")})
    p = spark.range(n).select(F.col("id").alias("point_id"), F.lit("p").alias("provider_code"), F.timestamp_add("HOUR", F.col("id"), F.lit("2026-01-01").cast("timestamp_ntz")).alias("at"))
    spans = a.select("asset_id", (I.micros(F.col("valid_from")) / 3.6e9).cast("long").alias("f"))
    depth = I.depth_of(1000)
    bins = I.bins_of_spans(spans, F.col("f"), F.col("f") + 1000, depth).select(*I.BIN).distinct()
    points = I.bins_of_points(p.select("point_id", (I.micros(F.col("at")) / 3.6e9).cast("long").alias("u")), F.col("u"), depth)
    assert points.join(bins, I.BIN).count() <= n * (depth + 1) < n * 1000 / 50
    assert {r.point_id: r.asset_id for r in R.as_of(p, a, "k").collect()} == {i: str(i) for i in range(n)}


def test_a_thousand_edits_of_one_asset(spark):
    """Each interval meets the edit that holds it, turned ones too; intervals between edits or across them stay."""
    base = datetime(2026, 1, 1)
    cells = spark.createDataFrame([("a", base + timedelta(hours=3 * i), base + timedelta(hours=3 * i + 3), y, 0, 1.0 * y, 0.0, 1.0) for i in range(1100) for y in range(2)] + [("b", base, base + timedelta(hours=3), 0, 0, 0.0, 0.0, 1.0)], "asset_id string, start_utc timestamp_ntz, end_utc timestamp_ntz, iy int, ix int, lat double, lon double, value double")
    edits = spark.createDataFrame([("a", 3 * i, 3 * i + (3 if i % 3 else 2), 0.0, 0.0, 0.0, 1.0 + i) for i in range(1000)], "asset_id string, t0_step int, t1_step int, shift_lat double, shift_lon double, rotation_deg double, multiplication_factor double")
    got = {(r.asset_id, r.start_utc, r.iy): r.value for r in G.edited(cells, edits, 1.0).collect()}
    want = {("a", base + timedelta(hours=3 * i), y): 1.0 + i if i < 1000 and i % 3 else 1.0 for i in range(1100) for y in range(2)}
    assert {k: v for k, v in got.items() if k[0] == "a"} == want and got["b", base, 0] == 1.0
    assert G.edited(cells, edits.limit(0), 1.0).count() == 2201
