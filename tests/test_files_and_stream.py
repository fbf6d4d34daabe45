"""Files, tables and the stream: round trips, idempotence, and the same result in one batch or many."""

from __future__ import annotations

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from freshet.functions.curve import interleaved
from freshet.operators import grids as G
from freshet.plans import jobs
from freshet.sources import scans, sinks, versioned
from freshet.sources.scratch import scratch_dir
from freshet.streaming import ingest


def test_inventory_is_strict(spark, tmp_path):
    head = "provider_code,station_code,station_name,mini_id,latitude,longitude,altitude_m,observed_variables\n"
    (tmp_path / "good.csv").write_text(head + 'ana,02650035,Estação,8504,-29.12349,-51.1234,10,"rain,level"\ninmet,A801,X,,,,,none\n')
    rows = {r.station_id: r for r in scans.stations_of(scans.read_text_csv(spark, str(tmp_path / "good.csv"), scans.INVENTORY)).collect()}
    assert set(rows) == {"ana:2650035", "inmet:A801"} and rows["ana:2650035"].latitude == -29.1234 and rows["inmet:A801"].mini_id is None
    (tmp_path / "bad.csv").write_text(head + "ana,1,X,1,1,1,1,none,more\n")
    with pytest.raises(Exception, match=r"(?i)malformed|column"):
        scans.read_text_csv(spark, str(tmp_path / "bad.csv"), scans.INVENTORY).collect()


def test_provider_xml_and_json(spark):
    xml = "<DadosHidrometereologicos><CodEstacao>{}</CodEstacao><DataHora>{}</DataHora><Nivel>{}</Nivel><Chuva>{}</Chuva><Vazao></Vazao></DadosHidrometereologicos>"
    texts = [xml.format("0741", "2026-03-10 00:00:00", "", "1,5"), xml.format("741", "", "1", "1"), xml.format("741", "2026-03-10 00:00:00", "", ""), xml.format("9", "2026-03-10 00:00:00", "2", "")]
    df = spark.createDataFrame([(t,) for t in texts], "payload string")
    assert [(r.station_code, r.rain, r.level) for r in scans.provider_xml(df, station=F.lit("741")).collect()] == [("741", 1.5, None)]
    texts = ['{"data":{"data":[[1773187200000,1.5],[1773187260000,null]]}}', '{"data":[{"timestamp":1773187200000,"chuva":"2,5","codigo":"A801"}]}', "[[1773187200000,3]]", "nonsense", None]
    df = spark.createDataFrame([("A801", t) for t in texts], "station_code string, payload string")
    assert sorted((str(r.observed_at), r.rain, r.given_code) for r in scans.provider_json(df).where("rain is not null").collect()) == [("2026-03-10 21:00:00", 1.5, None), ("2026-03-10 21:00:00", 2.5, "A801"), ("2026-03-10 21:00:00", 3.0, None)]


def test_matrix_file(spark, tmp_path):
    values = np.arange(12, dtype="<f4").reshape(4, 3)
    (tmp_path / "flow.bin").write_bytes(values.tobytes())
    got = scans.from_records(scans.matrix_file(spark, str(tmp_path / "flow.bin"), 3), 3).collect()
    assert {(r.t, r.position): r.value for r in got} == {(i, j): float(values[i, j]) for i in range(4) for j in range(3)}
    with pytest.raises(Exception, match="4 values"):
        scans.from_records(scans.matrix_file(spark, str(tmp_path / "flow.bin"), 3), 4).collect()


def test_matrix_in_partitions(spark, tmp_path):
    """Ranges and batches begin and end anywhere in a record; a folder's files follow each other by name."""
    values = np.random.default_rng(3).normal(size=(37, 5)).astype("<f4")
    for name, a, b in (("a.f4", 0, 20), ("b.f4", 20, 20), ("c.f4", 20, 37)):
        (tmp_path / name).write_bytes(values[a:b].tobytes())
    (tmp_path / "_left").write_bytes(b"x")
    want = {(i, j): float(values[i, j]) for i in range(37) for j in range(5)}
    for split, batch in ((4, 1), (28, 3), (64, 100), (1 << 20, 7)):
        df = scans.matrix_values(spark, str(tmp_path), 5, split, batch)
        rows = df.collect()
        assert len(rows) == len(want) and {(r.t, r.position): r.value for r in rows} == want
        assert df.rdd.getNumPartitions() == -(-100 // (split // 4)) + -(-85 // (split // 4))
        records = scans.matrix_file(spark, str(tmp_path), 5, split, batch)
        assert [bytes(r.record) for r in records.orderBy("t").collect()] == [x.tobytes() for x in values]
    with pytest.raises(Exception, match="records of 3 values"):
        scans.matrix_values(spark, str(tmp_path), 3).collect()
    with pytest.raises(Exception, match="nowhere"):
        scans.matrix_values(spark, str(tmp_path / "nowhere"), 3).collect()
    (tmp_path / "none").mkdir()
    assert scans.matrix_values(spark, str(tmp_path / "none"), 3).collect() == []
    with pytest.raises(ValueError, match="at least one"):
        scans.matrix_values(spark, str(tmp_path), 0)


def test_matrix_is_written_and_read_back(spark, tmp_path):
    rows = spark.range(0, 90, numPartitions=7).select(F.col("id").alias("t"), F.array(*(F.col("id") * 4.0 + i for i in range(4))).alias("row"))
    assert scans.write_matrix(scans.to_records(rows.orderBy(F.hash("t"))), str(tmp_path / "all")) == 90
    got = scans.matrix_values(spark, str(tmp_path / "all"), 4, 40).collect()
    assert {(r.t, r.position): r.value for r in got} == {(i // 4, i % 4): float(i) for i in range(360)} and len(got) == 360
    assert scans.write_matrix(scans.to_records(rows.where("t < 0")), str(tmp_path / "no")) == 0
    for n, wrong in enumerate((rows.where("t <> 40"), rows.where("t > 0"), rows.union(rows.where("t = 7")), rows.where("t <> 40").union(rows.where("t = 7")))):
        with pytest.raises(ValueError, match="all timesteps once"):
            scans.write_matrix(scans.to_records(wrong), str(tmp_path / f"wrong{n}"))


def test_upsert_is_idempotent_and_the_new_value_wins(spark):
    path = scratch_dir(spark)

    def rows(*values):
        return spark.createDataFrame([(s, t, v) for s, t, v in values], "series_id string, t string, value double").select("series_id", F.col("t").cast("timestamp_ntz").alias("observed_at"), "value").withColumn("day", F.to_date("observed_at"))

    first = rows(("a", "2026-01-01 00:00", 1.0), ("a", "2026-01-02 00:00", 2.0))
    for batch in (first, first, rows(("a", "2026-01-02 00:00", 9.0), ("b", "2026-01-02 00:00", 3.0))):
        sinks.upsert_values(spark, path, batch)
    assert sorted((r.series_id, str(r.observed_at)[:10], r.value) for r in sinks.read_values(spark, path).collect()) == [("a", "2026-01-01", 1.0), ("a", "2026-01-02", 9.0), ("b", "2026-01-02", 3.0)]


def test_upsert_keeps_rows_when_columns_differ(spark):
    path = scratch_dir(spark)
    kind = "series_id string, observed_at string, value double, day string"
    sinks.upsert_values(spark, path, spark.createDataFrame([("a", "t", 1.0, "2026-01-01"), ("b", "t", 2.0, "2026-01-01")], kind))
    sinks.upsert_values(spark, path, spark.createDataFrame([("a", "t", 9.0, "2026-01-01", "x")], kind + ", note string"))
    sinks.upsert_values(spark, path, spark.createDataFrame([("c", "t", 3.0, "2026-01-02")], kind))
    rows = {(r.series_id, r.value, r.note) for r in sinks.read_values(spark, path).collect()}
    assert rows == {("a", 9.0, "x"), ("b", 2.0, None), ("c", 3.0, None)}
    clash = spark.createDataFrame([("k", 1, 2, 3)], "key string, __new int, __order int, __n int")
    assert [tuple(r) for r in sinks.merged(clash, clash.withColumn("__n", F.lit(4)), ["key"]).collect()] == [("k", 1, 2, 4)]


def test_a_second_scenario_or_asset_leaves_the_first(spark):
    out, grid = scratch_dir(spark), scratch_dir(spark)
    for s in ("s0", "s1", "s0"):
        sinks.write_model_output(spark.createDataFrame([(s, "flow", i, "t", 1.5 * i) for i in range(5)], "scenario_id string, variable_code string, mini_id long, dt string, value double"), out)
    assert {(r.scenario_id, r["count"]) for r in spark.read.parquet(out).groupBy("scenario_id").count().collect()} == {("s0", 5), ("s1", 5)}
    for a in ("a0", "a1"):
        cells = spark.createDataFrame([(a, y, x, y * 1.0, x * 1.0, 1.0) for y in range(2) for x in range(2)], "asset_id string, iy int, ix int, lat double, lon double, value double")
        sinks.write_grid(cells.withColumns({"start_utc": F.lit("2026-01-01").cast("timestamp_ntz"), "end_utc": F.lit("2026-01-02").cast("timestamp_ntz")}), grid)
    assert {(r.asset_id, r["count"]) for r in spark.read.parquet(grid).groupBy("asset_id").count().collect()} == {("a0", 4), ("a1", 4)}


def test_publication_points_to_the_last_complete_batch(spark):
    path = scratch_dir(spark)
    batch = spark.createDataFrame([("s0", 1.0), ("s1", 2.0)], "scenario_id string, value double")
    some = batch.where("scenario_id = 's0'")
    assert sinks.published(spark, path, some, "b0", 2).collect() == []
    assert sinks.published(spark, path, batch.limit(0), "b00", 2).collect() == []
    assert [r.batch_id for r in sinks.published(spark, path, batch, "b1", 2).collect()] == ["b1"]
    assert [r.batch_id for r in sinks.published(spark, path, some, "b2", 2).collect()] == ["b1"]
    assert [r.batch_id for r in sinks.published(spark, path, batch, "b3", 2).collect()] == ["b3"]


def test_packing(spark):
    df = spark.createDataFrame([("s", "flow", 1, 1.0005), ("s", "flow", 2, None), ("s", "flow", 3, 3e6)], "scenario_id string, variable_code string, mini_id long, value double")
    assert sinks.pack_errors(df).first().n == 1
    good = df.where("mini_id < 3")
    assert [r.value for r in sinks.unpacked(sinks.packed(good)).orderBy("mini_id").collect()] == [1.0, None]
    with pytest.raises(OverflowError):
        sinks.write_model_output(df, scratch_dir(spark))


def test_load_is_all_or_nothing(spark, tmp_path):
    (tmp_path / "a.csv").write_text("provider_code,station_code,observed_at,variable_code,value\nana,1,2026-03-10 00:10,rain,1.0\nana,1,2026-03-10 00:20,rain,x\n")
    typed = scans.typed_observations(scans.observations(spark, str(tmp_path)))
    stations = spark.createDataFrame([("ana:1",)], "station_id string")
    allowed = spark.createDataFrame([("ana", "rain")], "provider_code string, variable_code string")
    with pytest.raises(ValueError, match="ana:1: value"):
        jobs.ingest_files(typed, stations, allowed, 1)
    series, values = jobs.ingest_files(typed.where("value is not null"), stations, allowed, 1)
    assert [r.series_id for r in series.collect()] == ["ana:1.rain.raw"] and [r.value for r in values.collect()] == [1.0]


def test_stream_in_many_batches_is_one_batch(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    head = "provider_code,station_code,observed_at,variable_code,value\n"
    for i, line in enumerate(("ana,1,2026-03-10 00:10,rain,1\nana,1,2026-03-10 00:20,level,10", "ana,1,2026-03-10 02:55,rain,2", "ana,1,2026-03-10 03:00,rain,4\nana,1,2026-03-10 01:20,level,20\nana,1,bad,rain,3")):
        (source / f"{i}.csv").write_text(head + line + "\n")
    target = scratch_dir(spark)
    ingest.start(spark, str(source), target, scratch_dir(spark), 3, files_per_trigger=1).awaitTermination()
    assert sorted((r.series_id, str(r.observed_at), r.value) for r in ingest.values(spark, target).collect()) == [("ana:1.level.raw", "2026-03-10 03:00:00", 15.0), ("ana:1.rain.raw", "2026-03-10 03:00:00", 7.0)]


def test_files_of_any_order_make_one_table(spark, tmp_path):
    """Days that come backwards, weeks late, with a batch in the middle: the table is that of one load."""
    import random

    rng = random.Random(5)
    head = "provider_code,station_code,observed_at,variable_code,value\n"
    lines = [f"ana,{rng.randint(1, 3)},2026-{1 + d // 28:02}-{1 + d % 28:02} {rng.randint(0, 23):02}:{rng.randint(0, 59):02},{rng.choice(['rain', 'level', 'flow', 'other'])},{rng.randint(0, 90) / 4}" for d in range(80) for _ in range(6)]
    files = [lines[i : i + 60] for i in range(0, len(lines), 60)][::-1]
    source, target, state = tmp_path / "in", scratch_dir(spark), scratch_dir(spark)
    source.mkdir()
    for part in (files[:2], files[2:3], files[3:]):  # each goes on where the one before has ended
        for i, rows in enumerate(part):
            (source / f"{rows[0][6:16].replace(' ', '_')}-{i}-{len(rows)}-{lines.index(rows[0])}.csv").write_text(head + "\n".join(rows) + "\n")
        ingest.start(spark, str(source), target, state, 3, files_per_trigger=1).awaitTermination()
    typed = scans.typed_observations(scans.observations(spark, str(source)))
    want = sorted((r.series_id, str(r.observed_at), r.value) for r in jobs.ingest(typed.withColumn("state", F.lit("raw")), 3)[1].collect())
    got = sorted((r.series_id, str(r.observed_at), r.value) for r in ingest.values(spark, target).collect())
    assert len(got) > 300 and [g[:2] for g in got] == [w[:2] for w in want] and all(abs(g[2] - w[2]) < 1e-9 for g, w in zip(got, want, strict=True))


def _values(spark, *rows):
    return spark.createDataFrame([(s, t, v, t[:10]) for s, t, v in rows], "series_id string, observed_at string, value double, day string")


def test_an_upsert_reads_the_touched_days_alone(spark, capsys):
    path = scratch_dir(spark)
    sinks.upsert_values(spark, path, _values(spark, *[("a", f"2026-01-{d:02} 00:00", 1.0 * d) for d in range(1, 29)]))
    some = sinks.read_values(spark, path, ["2026-01-07"])
    some.explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters" in plan and "2026-01-07" in plan.split("PartitionFilters", 1)[1].split("\n")[0]
    assert [r.value for r in some.collect()] == [7.0]
    sinks.upsert_values(spark, path, _values(spark, ("a", "2026-01-07 00:00", 70.0), ("a", "2026-02-01 00:00", 32.0)))
    state = versioned.current(spark, path)
    assert state.seq == 2 and {p for p, v in state.parts.items() if v == 2} == {"2026-01-07", "2026-02-01"} and len(state.parts) == 29
    assert sum(r.value for r in sinks.read_values(spark, path).collect()) == sum(range(1, 29)) - 7 + 70 + 32
    assert versioned.vacuum(spark, path) == [] and versioned.current(spark, path).seq == 2
    sinks.upsert_values(spark, path, _values(spark, ("a", "2026-02-01 00:00", 1.0), ("b", "2026-01-07 00:00", 2.0)))
    assert versioned.vacuum(spark, path) == [2] and sinks.read_values(spark, path).count() == 30


def test_a_job_that_dies_leaves_the_table_as_it_was(spark, monkeypatch):
    path = scratch_dir(spark)
    sinks.upsert_values(spark, path, _values(spark, ("a", "2026-01-01 00:00", 1.0), ("a", "2026-01-02 00:00", 2.0)))
    new = _values(spark, ("a", "2026-01-01 00:00", 8.0), ("a", "2026-01-02 00:00", 9.0))
    with monkeypatch.context() as m:
        m.setattr(versioned, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            sinks.upsert_values(spark, path, new)
    assert sorted(r.value for r in sinks.read_values(spark, path).collect()) == [1.0, 2.0]  # both versions are on disk now
    sinks.upsert_values(spark, path, new.limit(1))
    assert sorted(r.value for r in sinks.read_values(spark, path).collect()) in ([2.0, 8.0], [1.0, 9.0])
    state = versioned.current(spark, path)
    with pytest.raises(versioned.ConflictingCommit):
        versioned._commit(spark, path, state)
    with pytest.raises(ValueError, match="value is double"):
        sinks.upsert_values(spark, path, new.withColumn("value", F.lit("x")))
    assert sinks.upsert_values(spark, path, new.limit(0)) == 0 and sinks.read_values(spark, path).count() == 2


def test_a_batch_is_added_once(spark):
    path = scratch_dir(spark)
    rows = spark.createDataFrame([("s", "rain", "raw", "2026-01-01 01:00", 2.0), ("s", "level", "raw", "2026-01-01 01:00", 2.0)], "station_id string, variable_code string, state string, observed_at string, value double").withColumn("observed_at", F.col("observed_at").cast("timestamp_ntz"))
    for number in (0, 0, 1, 1, 0):
        versioned.upsert(spark, path, ingest.partial_buckets(rows, 3), "day", ingest.added, writer="w", batch=number)
    assert sorted((r.series_id, r.value) for r in ingest.values(spark, path).collect()) == [("s.level.raw", 2.0), ("s.rain.raw", 4.0)]


def test_a_load_counts_while_it_reads(spark, tmp_path):
    path = scratch_dir(spark)
    (tmp_path / "a.csv").write_text("provider_code,station_code,observed_at,variable_code,value\nana,1,2026-03-10 00:10,rain,1.0\nana,1,2026-03-10 00:20,rain,2.0\n")
    stations, allowed = spark.createDataFrame([("ana:1",), ("ana:1",)], "station_id string"), spark.createDataFrame([("ana", "rain")], "provider_code string, variable_code string")
    load = lambda: jobs.load_files(spark, path, scans.typed_observations(scans.observations(spark, str(tmp_path))), stations, allowed, 1)
    assert load() == {"rows_read": 2, "rows_written": 1}
    (tmp_path / "b.csv").write_text("provider_code,station_code,observed_at,variable_code,value\nana,1,2026-03-10 00:30,rain,5.0\nana,9,2026-03-10 00:20,rain,7.0\n")
    with pytest.raises(ValueError, match="1 of 4 rows are wrong, as ana:9: station"):
        load()
    assert [r.value for r in sinks.read_values(spark, path).collect()] == [3.0]


def test_a_curve_takes_bits_in_turn(spark):
    rows = [(5, 3, 1), (0, 0, 0), (-1, 2, 7), (2**21 - 1, 2**20, 12345), (None, 1, 1)]
    got = spark.createDataFrame(rows, "a long, b int, c long").select(interleaved(F.col("a"), F.col("b"), F.col("c")).alias("m")).collect()

    def plain(*v):
        return sum((x >> b & 1) << (3 * b + 2 - d) for b in range(21) for d, x in enumerate(v))

    assert [r.m for r in got] == [None if None in v else plain(*v) for v in rows]
    for n in (0, 9):
        with pytest.raises(ValueError, match="dimensions"):
            interleaved(*[F.lit(1)] * n)


def test_a_box_or_window_reads_few_row_groups(spark, tmp_path, capsys):
    """A grid of 200 x 200 cells and 16 steps: what a box and a window may touch by the row groups' bounds."""
    start = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    n, path = F.col("id"), f"file://{tmp_path}/grid"
    cells = spark.range(200 * 200 * 16).select(
        F.lit("g").alias("asset_id"), F.timestamp_add("HOUR", (n % 16 * 3).cast("int"), start).alias("start_utc"), F.timestamp_add("HOUR", (n % 16 * 3 + 3).cast("int"), start).alias("end_utc"),
        (F.floor(n / 3200)).cast("int").alias("iy"), (F.floor(n / 16) % 200).cast("int").alias("ix"), (n % 1009).cast("double").alias("value"),
    ).withColumns({"lat": -30 + F.col("iy") * 0.25, "lon": -50 + F.col("ix") * 0.25, "_place": F.lit("mine")})
    sinks.write_grid(cells, path, 128 << 10)
    groups = [pq.ParquetFile(f).metadata for f in tmp_path.glob("grid/asset_id=g/*.parquet")]
    groups = [m.row_group(i) for m in groups for i in range(m.num_row_groups)]

    def touched(**bounds):
        def meets(g):
            stats = {g.column(i).path_in_schema: g.column(i).statistics for i in range(g.num_columns)}
            return all(stats[c].max >= a and stats[c].min <= b for c, (a, b) in bounds.items())

        return sum(map(meets, groups)) / len(groups)

    assert len(groups) > 60
    box = {"lat": (-20.0, -18.0), "lon": (-40.0, -38.0)}
    assert touched(**box) < 0.1 and touched(iy=(40, 48)) < 0.3
    table = spark.read.parquet(path)
    found = G.crop(table, -40.0, -20.0, -38.0, -18.0, 0.25)
    found.explain("formatted")
    pushed = capsys.readouterr().out.split("PushedFilters", 1)[1].split("\n")[0]
    assert "LessThanOrEqual(lat" in pushed and "GreaterThanOrEqual(lon" in pushed
    assert found.count() == sum(-20.125 <= -30 + i * 0.25 <= -17.875 for i in range(200)) * sum(-40.125 <= -50 + i * 0.25 <= -37.875 for i in range(200)) * 16
    assert table.where("_place = 'mine'").count() == cells.count()


def test_forcing_refuses_a_missing_cell(spark):
    minis = spark.createDataFrame([(1, -30.0, -50.0)], "mini_id long, lat double, lon double")

    def grid(*rows):
        cells = spark.createDataFrame([(t, i, float(i), v) for t, i, v in rows], "t string, iy int, lat double, value double")
        return cells.select(F.col("t").cast("timestamp_ntz").alias("end_utc"), "iy", F.lit(0).alias("ix"), "lat", F.lit(-50.0).alias("lon"), "value")

    past = grid(("2026-01-01", 0, 1.0), ("2026-01-01", 1, 3.0))
    ahead = grid(("2026-01-02", 0, 2.0), ("2026-01-02", 1, 4.0))
    got = {str(r.dt)[:10]: r.value for r in jobs.forcing(past, ahead, None, minis).collect()}
    assert set(got) == {"2026-01-01", "2026-01-02"} and got["2026-01-02"] == pytest.approx(got["2026-01-01"] + 1)
    for a, b in ((past, ahead.where("iy = 0")), (past.where("iy = 1"), ahead), (past.withColumn("value", F.when(F.col("iy") == 1, F.col("value"))), None)):
        with pytest.raises(ValueError, match="without a value"):
            jobs.forcing(a, b, None, minis)
        assert jobs.forcing(a, b, None, minis, strict=False).count() >= 1


def test_many_stations_are_few_files(spark, tmp_path):
    """Files go by bytes, not by stations; rows, order in a file and discovery are those of a folder for each."""
    at = F.lit("2026-03-10 00:10:30").cast("timestamp_ntz")
    long = spark.range(400).select(F.lit("ana").alias("provider_code"), (F.col("id") % 200).cast("string").alias("station_code"), (at + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("observed_at"), F.lit("rain").alias("variable_code"), (F.col("id") / 4).alias("value"))
    seen = []
    for folders in (False, True):
        path = str(tmp_path / str(folders))
        sinks.write_observations(long, path, "r1", folders)
        rows = scans.observations(spark, path)
        assert len(rows.inputFiles()) == 200 if folders else len(rows.inputFiles()) < 20
        found = {(r.run, r.station_code) for r in scans.discovered(rows, "r1", ["7", "199", "none"]).collect()}
        assert found == {("r1", "7"), ("r1", "199")} and scans.discovered(rows, "r2").isEmpty()
        assert scans.discovered(rows).select("station_code").distinct().count() == 200
        seen.append(sorted(tuple(r)[:5] for r in rows.collect()))
    assert seen[0] == seen[1] and len(seen[0]) == 400 and seen[0][0] == ("ana", "0", "2026-03-10 00:10", "rain", "0.0")


def test_one_station_of_many_rows_is_whole(spark, tmp_path):
    """A station that is far larger than the others; and a run without rows."""
    long = spark.range(20_000).select(F.lit("ana").alias("provider_code"), F.when(F.col("id") % 100 == 0, F.col("id").cast("string")).otherwise("big").alias("station_code"), F.lit("2026-03-10 00:10:00").cast("timestamp_ntz").alias("observed_at"), F.lit("rain").alias("variable_code"), F.col("id").cast("double").alias("value"))
    sinks.write_observations(long, str(tmp_path / "a"), "r1")
    got = scans.observations(spark, str(tmp_path / "a"))
    assert got.select("value").distinct().count() == got.count() == 20_000
    sinks.write_observations(long.where("value < 0"), str(tmp_path / "b"), "r1")
    assert scans.observations(spark, str(tmp_path / "b")).isEmpty()


def test_xml_is_parsed_once(spark):
    text = "<D><CodEstacao>07</CodEstacao><DataHora>2026-03-10 00:10:00</DataHora><Nivel>1,5</Nivel><Chuva></Chuva><Vazao></Vazao></D>"
    frame = spark.createDataFrame([(text,), (None,), ("<D>",)], "payload string")
    parsed = scans.provider_xml(frame).where("level is not null")
    assert parsed._jdf.queryExecution().optimizedPlan().toString().count("from_xml") == 1
    assert [(r.station_code, r.level) for r in parsed.collect()] == [("7", 1.5)]
