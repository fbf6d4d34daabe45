"""Known answers of single operators, as literals."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from freshet.functions import text as T
from freshet.functions import timeops as D
from freshet.operators import grids as G
from freshet.operators import network as N
from freshet.operators import observations as O
from freshet.operators import registry as R
from freshet.operators import series as S


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


def obs(spark, rows):
    df = spark.createDataFrame(rows, "station_id string, variable_code string, state string, t string, value double, arrival_seq long")
    return df.withColumn("observed_at", F.col("t").cast("timestamp_ntz"))


def buckets(df, hours, methods=None):
    return {(r.variable_code, str(r.observed_at)): r.value for r in O.bucket_values(df, hours, methods).collect()}


def test_buckets_are_closed_on_the_right(spark):
    df = obs(spark, [("a", "rain", "raw", f"2026-03-10 {h}", v, i) for i, (h, v) in enumerate([("00:10", 1.0), ("02:55", 2.0), ("03:00", 4.0)])])
    assert buckets(df, 3) == {("rain", "2026-03-10 03:00:00"): 7.0}


def test_bucket_methods(spark):
    rows = [("a", "level", "raw", "2026-03-10 00:10", 10.0, 2), ("a", "level", "raw", "2026-03-10 00:50", 20.0, 1), ("a", "flow", "raw", "2026-03-10 00:10", 100.0, 3), ("a", "flow", "raw", "2026-03-10 01:00", 140.0, 4)]
    assert buckets(obs(spark, rows), 1) == {("level", "2026-03-10 01:00:00"): 15.0, ("flow", "2026-03-10 01:00:00"): 120.0}
    assert buckets(obs(spark, rows), 1, {"level": "last"}) == {("level", "2026-03-10 01:00:00"): 10.0}


def test_buckets_skip_what_has_no_value(spark):
    rows = [("a", "rain", "raw", "2026-03-10 00:10", None, 1), ("a", "rain", "raw", None, 1.0, 2), ("a", "rain", "raw", "2026-03-10 00:10", math.nan, 3), ("a", "other", "raw", "2026-03-10 00:10", 1.0, 3)]
    assert buckets(obs(spark, rows), 1) == {}
    assert O.bucket_values(obs(spark, []), 1).count() == 0


def test_timestep_must_divide_a_day():
    with pytest.raises(ValueError, match="divide"):
        D.check_timestep(5)


def test_preferred_series(spark):
    rows = [("1", "a", "rain", "raw", "2026-01-03"), ("2", "a", "rain", "curated", "2026-01-02"), ("3", "a", "rain", "approved", None), ("4", "a", "rain", "approved", "2025-01-01"), ("5", "a", "level", "odd", None), ("6", "b", "rain", "raw", "2026-01-01"), ("7", "b", "rain", "raw", "2026-01-01")]
    df = spark.createDataFrame(rows, "series_id string, station_id string, variable_code string, state string, created_at string")
    assert sorted(r.series_id for r in S.preferred_series(df).collect()) == ["4", "5", "6"]


def test_station_status(spark):
    stations = spark.createDataFrame([("ok",), ("issue",), ("none",)], "station_id string")
    values = spark.createDataFrame([("ok", 1.0), ("ok", None), ("issue", None)], "station_id string, value double")
    assert {r.station_id: (r.status, r.n_rows) for r in S.station_status(stations, values).collect()} == {"ok": ("ok", 2), "issue": ("data_issue", 1), "none": ("no_data", 0)}


def test_sums_are_zero_where_older_rain_exists(spark):
    rows = [("a", "rain", "2026-03-01 00:00", 5.0), ("b", "rain", "2026-03-10 00:00", 2.0), ("c", "level", "2026-03-10 00:00", 2.0)]
    df = spark.createDataFrame(rows, "station_id string, variable_code string, t string, value double").withColumn("observed_at", F.col("t").cast("timestamp_ntz"))
    got = {r.station_id: (r.rain_24h, r.level) for r in S.observed_metrics(df, ts("2026-03-10 00:00:00")).collect()}
    assert got == {"a": (0.0, None), "b": (2.0, None), "c": (None, 2.0)}


def test_basin_weights(spark):
    rows = [(1, "2026-01-01", 0.0), (2, "2026-01-01", 100.0), (1, "2026-01-02", 1.0), (2, "2026-01-02", None), (1, "2026-01-03", None), (2, "2026-01-03", math.nan)]
    out = spark.createDataFrame(rows, "mini_id long, dt string, value double").withColumn("prev_flag", F.lit(0))
    weights = spark.createDataFrame([(1, 1.0), (2, 3.0)], "mini_id long, weight double")
    assert {r.dt: r.value for r in S.weighted_mean(out, weights).collect()} == {"2026-01-01": 75.0, "2026-01-02": 1.0, "2026-01-03": None}


def test_peaks_need_a_current_value(spark):
    rows = [(1, 0, "2026-01-01", 5.0), (1, 1, "2026-01-03", 9.0), (2, 1, "2026-01-03", 9.0)]
    df = spark.createDataFrame(rows, "mini_id long, prev_flag int, t string, value double").withColumn("dt", F.col("t").cast("timestamp_ntz"))
    got = {r.mini_id: (r.current_value, r.forecast_peak) for r in S.mini_peaks(df, ts("2026-01-02 00:00:00"), ts("2026-02-01 00:00:00")).collect()}
    assert got == {1: (5.0, 9.0), 2: (None, None)}


def test_level_offset(spark):
    model = spark.createDataFrame([("2026-01-01 00:00", 0, 10.0), ("2026-01-01 01:00", 0, 14.0), ("2026-01-01 02:00", 1, 18.0)], "t string, prev_flag int, value double").withColumn("dt", F.col("t").cast("timestamp_ntz"))
    seen = spark.createDataFrame([("2026-01-01 00:00", 120.0), ("2026-01-01 01:00", 125.0)], "t string, value double").withColumn("observed_at", F.col("t").cast("timestamp_ntz"))
    assert sorted(r.value for r in S.adjusted_level(model, seen).collect()) == [121.0, 125.0, 129.0]
    assert S.adjusted_level(model, seen.limit(0)).count() == 0


def points(spark, rows, name):
    return spark.createDataFrame(rows, f"{name} string, lat double, lon double")


def test_idw(spark):
    target, sources = points(spark, [("t", 0.0, 0.0)], "target_id"), points(spark, [("a", 0.0, -1.0), ("b", 0.0, 1.0)], "source_id")
    samples = sources.withColumn("value", F.when(F.col("source_id") == "a", 2.0).otherwise(6.0))
    assert G.idw(target, samples).first().value == 4.0
    weights = G.idw_weights(target, sources)
    values = spark.createDataFrame([("a", 1, 2.0), ("b", 1, 6.0), ("a", 2, math.nan), ("b", 2, 8.0), ("a", 3, None), ("b", 3, None)], "source_id string, dt int, value double")
    assert {r.dt: r.value for r in G.apply_weights(weights, values).collect()} == {1: 4.0, 2: 8.0, 3: None}
    assert G.idw(points(spark, [("t", 0.0, -1.0)], "target_id"), samples).first().value == 2.0
    assert G.idw(target, samples.withColumn("value", F.lit(None).cast("double"))).first().value is None


def test_nearest_against_brute_force(spark):
    import random

    random.seed(3)
    t = [(f"t{i}", random.uniform(-5, 5), random.uniform(-50, 50)) for i in range(40)]
    s = [(f"s{i:03d}", random.choice([0.0, random.gauss(0, 1)]), random.gauss(0, 20)) for i in range(150)] + [("far", 80.0, 170.0)]
    for k in (1, 4, 200):
        got = {}
        for r in G.nearest(points(spark, t, "target_id"), points(spark, s, "source_id"), k).collect():
            got.setdefault(r.target_id, []).append((r.place, r.source_id))
        for name, y, x in t:
            want = [n for _, n in sorted((math.sqrt((y - b) ** 2 + (x - c) ** 2), n) for n, b, c in s)[:k]]
            assert [n for _, n in sorted(got[name])] == want


CELL = "asset_id string, a string, b string, iy int, ix int, lat double, lon double, value double"


def cells(spark, rows):
    return spark.createDataFrame(rows, CELL).withColumns({"start_utc": F.col("a").cast("timestamp_ntz"), "end_utc": F.col("b").cast("timestamp_ntz")}).drop("a", "b")


def square(spark, values, y0=0.5, x0=10.5, r=1.0):
    rows = [("g", "2026-01-01 00:00", "2026-01-01 03:00", i, j, y0 + i * r, x0 + j * r, float(v) if v is not None else None) for i, line in enumerate(values) for j, v in enumerate(line)]
    return cells(spark, rows)


def test_bilinear(spark):
    grid = square(spark, [[0, 2], [2, 4]])
    targets = points(spark, [("centre", 1.0, 11.0), ("node", 0.5, 10.5), ("outside", 0.4, 11.0)], "target_id")
    got = {r.target_id: r.value for r in G.bilinear(grid, targets, (0.5, 10.5), 1.0).collect()}
    assert got["centre"] == 2.0 and got["node"] == 0.0 and got.get("outside") is None


def test_missing_corner_of_weight_zero_does_not_spread(spark):
    grid = square(spark, [[1, None], [3, None]])
    targets = points(spark, [("edge", 1.0, 10.5), ("inside", 1.0, 10.75)], "target_id")
    got = {r.target_id: r.value for r in G.bilinear(grid, targets, (0.5, 10.5), 1.0).collect()}
    assert got == {"edge": 2.0, "inside": None}


def test_regular_grid(spark):
    grid = G.RegularGrid(-2, -1, 2, 1, 1.0)
    rows = grid.cells(spark.range(1)).collect()
    assert sorted({r.lon for r in rows}) == [-1.5, -0.5, 0.5, 1.5] and sorted({r.lat for r in rows}) == [-0.5, 0.5]
    touching = G.RegularGrid(0, 0, 2, 1, 1.0, touching=True)
    rows = touching.cells(spark.range(1)).collect()
    assert sorted({r.lon for r in rows}) == [-0.5, 0.5, 1.5, 2.5] and sorted({r.lat for r in rows}) == [-0.5, 0.5, 1.5]
    assert touching.box == (-1, -1, 3, 2)


def test_interval_split_and_edit(spark):
    rows = [("g", f"2026-01-01 0{a}:00", f"2026-01-01 0{a + 3}:00", 0, 0, 0.0, 0.0, v) for a, v in ((0, 6.0), (3, 9.0))]
    hourly = {str(r.end_utc)[11:13]: r.value for r in G.split_evenly(cells(spark, rows), 1).collect()}
    assert [hourly[h] for h in ("03", "04", "05", "06")] == [2.0, 3.0, 3.0, 3.0]
    edits = spark.createDataFrame([("g", 0, 3, 0.0, 0.0, 2.0)], "asset_id string, t0_step int, t1_step int, shift_lat double, shift_lon double, multiplication_factor double")
    hourly = {str(r.end_utc)[11:13]: r.value for r in G.split_evenly(G.edited(cells(spark, rows), edits, 1.0), 1).collect()}
    assert [hourly[h] for h in ("03", "04", "05", "06")] == [4.0, 3.0, 3.0, 3.0]


def test_cumulative_differences(spark):
    rows = [("g", 0, 0, 0.0, 0.0, h, f"2026-01-01 {h:02d}:00", v) for h, v in ((3, 3.0), (6, 8.0), (9, 7.0), (12, None), (15, 20.0), (18, 21.0))]
    messages = spark.createDataFrame(rows, "asset_id string, iy int, ix int, lat double, lon double, step_hours int, t string, value double").withColumn("valid_time", F.col("t").cast("timestamp_ntz"))
    got = [r.value for r in G.interval_totals(messages, ts("2026-01-01 00:00:00")).orderBy("end_utc").collect()]
    assert got == [3.0, 5.0, 0.0, None, None, 1.0]


def test_repeated_messages(spark):
    rows = [("g", 0, 0, 0, 3, 3.0), ("g", 0, 0, 0, 3, 3.0), ("g", 0, 0, 0, 6, 8.0), ("g", 0, 0, 3, 6, 99.0)]
    df = spark.createDataFrame(rows, "asset_id string, iy int, ix int, start_step_hours int, step_hours int, value double")
    kept, differ = G.cumulative_messages(df)
    assert sorted(r.value for r in kept.collect()) == [3.0, 8.0] and differ.count() == 0
    assert G.cumulative_messages(df.union(df.withColumn("value", F.col("value") + 1)))[1].count() == 2


def test_footprint_shift(spark):
    out = G.moved(square(spark, [[1, 2], [3, 4]]), 1.0, F.lit(1.0), F.lit(-1.0), F.lit(1.0)).collect()
    assert (min(r.lon for r in out) - 0.5, min(r.lat for r in out) - 0.5, max(r.lon for r in out) + 0.5, max(r.lat for r in out) + 0.5) == (9, 1, 11, 3)
    assert sorted(r.value for r in out) == [1, 2, 3, 4]


def test_rotation(spark):
    out = G.rotated(square(spark, [[1, 2], [3, 4]]), 1.0, 45.0).collect()
    assert (min(r.lon for r in out) - 0.5, min(r.lat for r in out) - 0.5, max(r.lon for r in out) + 0.5, max(r.lat for r in out) + 0.5) == (9, -1, 13, 3)
    assert len(out) == 16 and any(r.value is None for r in out) and {r.value for r in out} - {None}
    quarter = {(r.lat, r.lon): r.value for r in G.rotated(square(spark, [[1, 2], [3, 4]]), 1.0, 90.0).collect()}
    assert sorted(quarter.values()) == [1, 2, 3, 4] and quarter[0.5, 10.5] != 1


def test_shifts_are_cells_and_missing_stays_missing(spark):
    grid = square(spark, [[1, None], [3, 4]], 0.125, 10.125, 0.25)
    out = {(r.lat, r.lon): r.value for r in G.moved(grid, 0.25, F.lit(1.0), F.lit(-2.5), F.lit(2.0)).collect()}
    assert out == {(0.375, 9.625): 2.0, (0.375, 9.875): None, (0.625, 9.625): 6.0, (0.625, 9.875): 8.0}
    turned = {(r.lat, r.lon): r.value for r in G.rotated(grid, 0.25, 180.0, 1.0, 0.0, 2.0).collect()}
    assert turned == {(-0.125, 10.125): 8.0, (-0.125, 10.375): 6.0, (0.125, 10.125): None, (0.125, 10.375): 2.0}
    out = G.rotated(grid, 0.25, 45.0).collect()
    assert sorted(r.value for r in out if r.value is not None) == sorted(r.value for r in out if r.value) and any(r.value is None for r in out)
    canvas = {(r.iy, r.ix): r.value for r in G.shifted_canvas(grid, 0, 1, 2.0, 90.0).collect()}
    assert canvas == {(0, 0): 6.0, (0, 1): 2.0, (1, 0): 0.0, (1, 1): 0.0} or sorted(canvas.values()) == [0.0, 0.0, 2.0, 6.0]


def test_edits_turn_and_working_grids_are_complete(spark):
    grid = square(spark, [[1, 2], [3, 4]], 0.5, 0.5)
    edits = spark.createDataFrame([("g", 0, 3, 0.0, 1.0, 0.0, 1.0)], "asset_id string, t0_step int, t1_step int, shift_lat double, shift_lon double, rotation_deg double, multiplication_factor double")
    targets = points(spark, [("a", 0.5, 1.5), ("b", 0.5, 2.5), ("c", 1.5, 1.5), ("d", 1.5, 2.5)], "target_id")
    got = {r.target_id: r.value for r in G.forecast_working_grid(grid, edits, targets, (0.5, 0.5), 1.0, 3).collect()}
    assert got == {"a": 1.0, "b": 2.0, "c": 3.0, "d": 4.0}
    half = edits.withColumns({"shift_lon": F.lit(0.0), "rotation_deg": F.lit(180.0)})
    inside = points(spark, [("a", 0.5, 0.5), ("d", 1.5, 1.5)], "target_id")
    assert {r.target_id: r.value for r in G.forecast_working_grid(grid, half, inside, (0.5, 0.5), 1.0, 3).collect()} == {"a": 4.0, "d": 1.0}
    with pytest.raises(ValueError, match="without a value"):
        G.forecast_working_grid(grid, edits, inside, (0.5, 0.5), 1.0, 3)
    with pytest.raises(ValueError, match="without a value"):
        G.forecast_working_grid(grid.limit(0), None, inside, (0.5, 0.5), 1.0, 3)
    lazy = G.forecast_working_grid(grid, edits, inside, (0.5, 0.5), 1.0, 3, strict=False)
    assert [(r.present, r.wanted) for r in G.incomplete(lazy, inside, ["asset_id", "end_utc"]).collect()] == [(1, 2)]


def test_neighbours_of_clusters_and_outliers(spark):
    import random

    rng = random.Random(3)
    sources = [(i, rng.gauss(0, 1e-4), rng.gauss(0, 1e-4)) for i in range(200)] + [(1000, 80.0, 170.0), (1001, -80.0, -170.0)]
    targets = [(i, rng.gauss(0, 2e-4), rng.gauss(0, 2e-4)) for i in range(60)] + [(900, 70.0, 160.0), (901, 5.0, 5.0)]
    s, t = points(spark, sources, "source_id"), points(spark, targets, "target_id")
    got = {}
    for r in G.nearest(t, s, 4).collect():
        got.setdefault(r.target_id, {})[r.place] = r.source_id
    for i, y, x in targets:
        want = [str(k) for _, k in sorted((((y - b) ** 2 + (x - a) ** 2) ** 0.5, k) for k, b, a in sources)[:4]]
        assert [str(got[str(i)][p]) for p in (1, 2, 3, 4)] == want


def test_crop(spark):
    rows = [("g", "2026-01-01", "2026-01-02", 0, i, 0.0, x, 1.0) for i, x in enumerate((0.25, 0.75, 1.25, 1.75))]
    assert sorted(r.lon for r in G.crop(cells(spark, rows), 0.5, -1, 1.0, 1, 0.5).collect()) == [0.25, 0.75, 1.25]


def test_missing_counts_as_zero_only_in_the_forecast(spark):
    grid = square(spark, [[1, None], [3, 4]])
    a, b = ts("2026-01-01 00:00:00"), ts("2026-01-01 03:00:00")
    assert sorted(r.value for r in G.forecast_accumulation(grid, a, b).collect()) == [0.0, 1.0, 3.0, 4.0]
    assert [r.value for r in G.covered_accumulation(grid, a, b).orderBy("iy", "ix").collect()] == [1.0, None, 3.0, 4.0]
    assert G.covered_accumulation(grid, a, ts("2026-01-01 06:00:00")).count() == 0


def test_upstream(spark):
    edges = spark.createDataFrame([(1, 3), (2, 3), (3, 4), (4, 99)], "mini_id long, mini_jus long")
    up = N.upstream(edges, 4).orderBy(N.upstream_order())
    assert [r.mini_id for r in up.collect()] == [1, 2, 3, 4]
    assert N.upstream(edges, 4, include_target=False).count() == 3
    chain = spark.createDataFrame([(i, i + 1) for i in range(1, 301)], "mini_id long, mini_jus long")
    assert N.distances(chain, 300).agg(F.max("steps")).first()[0] == 299


def test_network_errors(spark):
    edges = spark.createDataFrame([(1, 2), (2, 1), (3, 1), (4, 5), (4, 6), (7, 7), (8, 9)], "mini_id long, mini_jus long")
    assert {(r.mini_id, r.reason) for r in N.network_errors(edges).collect()} == {(1, "cycle"), (2, "cycle"), (3, "cycle"), (7, "cycle"), (4, "downstream")}


def test_windows_and_cycles(spark):
    one = spark.range(1)
    w = one.select(*D.horizon_window(ts("2026-03-11 23:00:00"), 2, 2, 1)).first()
    assert (str(w.start_time), w.nt, w.forecast_nt) == ("2026-03-09 00:00:00", 121, 49)
    for local, cycle in (("2026-03-18 22:30:00", "2026-03-19 00:00:00"), ("2026-03-18 01:00:00", "2026-03-18 00:00:00")):
        assert str(one.select(D.forecast_cycle(D.local_to_utc(ts(local)))).first()[0]) == cycle
    steps = [r.step_hours for r in G.step_schedule(one, G.GFS_STEPS, 241).orderBy("position").collect()]
    assert len(steps) == 81 and steps[-2:] == [240, 252]
    assert G.step_schedule(one, G.ECMWF_STEPS).count() == 85 and G.step_schedule(one, G.GFS_STEPS).count() == 92


def test_buffered_box(spark):
    box = spark.range(1).select(*T.buffered_box(F.lit(-52.0), F.lit(-31.0), F.lit(-50.0), F.lit(-30.0), 2.0)).first()
    assert tuple(box) == (-56, -33, -46, -28, True)


def test_edits_may_touch_but_not_overlap(spark):
    rows = [("1", "a", 0, 24), ("2", "a", 24, 48), ("3", "b", 0, 24), ("4", "b", 12, 36)]
    df = spark.createDataFrame(rows, "manual_edit_id string, asset_id string, t0_step int, t1_step int")
    assert [r.manual_edit_id for r in R.overlapping_edits(df).collect()] == ["4"]


def test_lenient_text(spark):
    df = spark.createDataFrame([(" 00a ", "1,234", "-29.12349", "1,5", "Açaí ão"), ("000", "", "", "-", None), ("", "x", "x", "x", "")], "code string, n string, c string, d string, name string")
    got = df.select(T.station_code(F.col("code")), T.nullable_int(F.col("n")), T.coordinate(F.col("c")), T.decimal_comma(F.col("d")), T.station_name(F.col("name"))).collect()
    assert [tuple(r) for r in got] == [("A", 1234, -29.1234, 1.5, "ACAI AO"), ("0", None, None, None, None), (None, None, None, None, "")]


def test_time_text(spark):
    rows = ["2026-03-10T21:00:00Z", "2026-03-10 18:00", "2026-03-10T18:00:30-03:00", "1773187200000", "10/03/2026 18:00", "x", None]
    got = [str(r[0]) for r in spark.createDataFrame([(r,) for r in rows], "t string").select(D.parse_provider(F.col("t"))).collect()]
    assert got == ["2026-03-10 18:00:00"] * 3 + ["2026-03-10 21:00:00", "2026-03-10 18:00:00", "None", "None"]


def test_fetch_windows(spark):
    days = spark.createDataFrame([("a", f"2026-01-{d:02d}") for d in (1, 2, 3, 4, 7, 8, 8)], "station_id string, day string").withColumn("day", F.to_date("day"))
    assert sorted((str(r.start_day)[-2:], str(r.end_day)[-2:]) for r in O.fetch_windows(days, 3).collect()) == [("01", "03"), ("04", "04"), ("07", "08")]


def test_far_targets_of_clustered_sources_meet_a_few(spark):
    """Pairs grow with k, not with the cluster; many sources at one place, few sources and lattice ties are as by brute force."""
    import random

    rng = random.Random(1)
    cluster = [(i, 50 + rng.gauss(0, 1e-4), 50 + rng.gauss(0, 1e-4)) for i in range(6000)] + [(20_000 + i, rng.random() * 100, rng.random() * 100) for i in range(20)]
    around = [(i, rng.random() * 1000 - 500, rng.random() * 1000 - 500) for i in range(40)] + [(100 + i, 50 + rng.gauss(0, 1e-4), 50 + rng.gauss(0, 1e-4)) for i in range(40)]
    cases = [(around, cluster, 5), ([(i, 1.0 * i, 0.0) for i in range(5)], [(i, 1.0, 1.0) for i in range(300)] + [(9000, 2.0, 2.0)], 4), ([(1, 0.0, 0.0)], [(7, 1.0, 1.0), (3, 1.0, 1.0)], 5), ([(i, (i % 9) * 0.5, (i // 9) * 0.5) for i in range(81)], [(i, i % 9 * 1.0, i // 9 * 1.0) for i in range(81)], 4)]
    for targets, sources, k in cases:
        t, s = spark.createDataFrame(targets, "target_id long, lat double, lon double"), spark.createDataFrame(sources, "source_id long, lat double, lon double")
        got: dict[int, list[int]] = {}
        for r in G.nearest(t, s, k).orderBy("target_id", "place").collect():
            got.setdefault(r.target_id, []).append(r.source_id)
        assert got == {i: [x for _, x in sorted((((a - c) ** 2 + (b - d) ** 2) ** 0.5, x) for x, c, d in sources)[:k]] for i, a, b in targets}
        assert G.near_pairs(t, s, k).count() <= 20 * k * len(targets)
    assert G.nearest(t.limit(0), s, 3).collect() == [] == G.nearest(t, s.limit(0), 3).collect()
