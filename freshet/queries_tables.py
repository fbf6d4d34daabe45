"""Queries over files and tables that Spark derives from the star-schema tables: scans, sinks, upserts, the stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from .operators import grids as G
from .operators import observations as O
from .plans import jobs
from .queries import query, ts
from .queries_series import BUCKET
from .sources import scans, sinks
from .sources.scratch import materialise, scratch_dir
from .streaming import ingest


def written_csv(df, **options):
    """A CSV of the table in the shared folder; returns the session and the folder."""
    path = scratch_dir(df.sparkSession)
    df.write.options(header=True, **options).csv(path)
    return df.sparkSession, path


def inventory(v):
    """Stations as an inventory file has them."""
    u = F.col("user_id")
    variables = F.when(u % 4 == 0, "none").when(u % 4 == 1, "rain").when(u % 4 == 2, "rain; level").otherwise("rain|level,flow")
    rows = v("station").select(
        F.lit("ana").alias("provider_code"), F.concat(F.lit("00"), "station_code").alias("station_code"), "station_name", F.col("mini_id").cast("string").alias("mini_id"),
        F.concat(F.lit("-"), (u % 30).cast("string"), F.lit(".12349")).alias("latitude"), F.lit("-51.5").alias("longitude"), F.lit("1,010").alias("altitude_m"), variables.alias("observed_variables"),
    )
    return scans.read_text_csv(*written_csv(rows), scans.INVENTORY)


_CODE = "coalesce(nullif(ltrim(concat('00', user_id), '0'), ''), '0')"
_LIST = "case user_id % 4 when 0 then 'none' when 1 then 'rain' when 2 then 'rain; level' else 'rain|level,flow' end"


@query(f"select concat('ana:', {_CODE}) as station_id, 'ana' as provider_code, {_CODE} as station_code, upper(concat('Estacao ', user_id)) as station_name, mini_id, round(-1 * (user_id % 30 + 0.1234), 6) as latitude, -51.5 as longitude, 1010 as altitude_m, {_LIST} as observed_variables from station")
def sc1_station_inventory(v):
    return scans.stations_of(inventory(v))


@query(f"select concat('ana:', {_CODE}) as key, 'repeated' as reason from station where user_id % 10 = 0 union all select cast(mini_id as varchar), 'mini' from station where user_id % 10 = 0")
def sc1_inventory_errors(v):
    """Every tenth station stands twice in the inventory."""
    rows = inventory(v)
    twice = rows.where("cast(station_code as bigint) % 10 = 0")
    return scans.inventory_errors(scans.stations_of(rows.unionByName(twice)))


@query(f"select distinct concat('ana:', {_CODE}) as station_id, trim(unnest(string_split_regex({_LIST}, '[,;|]'))) as variable_code from station where user_id % 4 <> 0")
def sc2_capabilities(v):
    return O.expand_capabilities(scans.stations_of(inventory(v)))


@query("""select concat('ana:', l.s_suppkey) as station_id, t as reference_type, round(s_acctbal + i, 6) as level_cm from supplier l join (select distinct user_id from events) u on u.user_id = l.s_suppkey
    cross join (values ('level_atention', 0), ('level_alert', 1), ('level_severe', 3)) k(t, i)""")
def sc3_reference_levels(v):
    b = F.col("s_acctbal")
    wide = v("supplier").select(F.concat(F.lit("0"), F.col("s_suppkey").cast("string")).alias("station_code"), F.regexp_replace(b.cast("string"), r"\.", ",").alias("level_atention"), (b + 1).cast("string").alias("level_alert"), F.lit(" ").alias("level_flood"), (b + 3).cast("string").alias("level_severe"))
    read = scans.read_text_csv(*written_csv(wide, sep=";"), ("station_code", "level_atention", "level_alert", "level_flood", "level_severe"), sep=";")
    stations = v("station").select(F.concat(F.lit("ana:"), F.col("user_id").cast("string")).alias("station_id"), F.col("user_id").cast("string").alias("station_code"))
    return scans.reference_levels(read, stations)


@query("select concat('ana:', user_id) as station_id, cast(cast(l_shipdate as date) as varchar) as event_date, round(max(l_extendedprice), 6) as level_cm from lineitem join (select distinct user_id from events) u on u.user_id = l_suppkey where l_quantity = 50 group by user_id, cast(l_shipdate as date)")
def sc4_historical_floods(v):
    rows = v("lineitem").where("l_quantity = 50").groupBy("l_suppkey", F.to_date("l_shipdate").alias("d")).agg(F.max("l_extendedprice").alias("m"))
    text = rows.select(F.col("l_suppkey").cast("string").alias("station_code"), F.col("m").cast("string").alias("level_registered"), F.col("d").cast("string").alias("date"))
    read = scans.read_text_csv(*written_csv(text), ("station_code", "level_registered", "date"))
    stations = v("station").select(F.concat(F.lit("ana:"), F.col("user_id").cast("string")).alias("station_id"), F.col("user_id").cast("string").alias("station_code"))
    return scans.floods(read, stations)[0]


def long_rows(v):
    """Raw observations in the canonical columns."""
    p = F.split("station_id", ":")
    rows = v("obs").where("state = 'raw'")
    return rows.select(p[0].alias("provider_code"), p[1].alias("station_code"), F.date_trunc("minute", "observed_at").cast("timestamp_ntz").alias("observed_at"), "variable_code", "value")


def landed(v):
    """Observation files of a run, written by the sink and scanned."""
    path = scratch_dir(v("events").sparkSession)
    sinks.write_observations(long_rows(v), path, "r1")
    return scans.observations(v("events").sparkSession, path)


RAW = "raw as (select station_id, variable_code, date_trunc('minute', observed_at) as observed_at, value from obs where state = 'raw')"
RAW_BUCKETS = f"select concat(station_id, '.', variable_code, '.raw') as series_id, cast({BUCKET.format('observed_at')} as varchar) as observed_at, round(case variable_code when 'rain' then sum(value) else avg(value) end, 6) as value from raw group by station_id, variable_code, {BUCKET.format('observed_at')}"


@query(f"with {RAW} select station_id, cast(observed_at as varchar) as observed_at, variable_code, round(value, 6) as value, 'raw' as state from raw")
def sc5_observation_files(v):
    return scans.typed_observations(landed(v)).select("station_id", "observed_at", "variable_code", "value", "state")


@query("select station_id, reason, count(*) as n from (select station_id, case when variable_code = 'flow' and station_id like 'inmet%' then 'variable' end as reason from obs where state = 'raw') where reason is not null group by 1, 2")
def sc5_observation_errors(v):
    allowed = v("station").select("provider_code").distinct().withColumn("variable_code", F.explode(F.when(F.col("provider_code") == "ana", F.array(F.lit("rain"), F.lit("level"), F.lit("flow"))).otherwise(F.array(F.lit("rain"), F.lit("level")))))
    return scans.observation_errors(scans.typed_observations(landed(v)), v("station"), allowed)


@query("select 'r1' as run, split_part(station_id, ':', 2) as station_code, count(distinct variable_code) > 0 as found from obs where state = 'raw' group by 1, 2")
def sc6_discovered_files(v):
    return scans.discovered(landed(v), "r1").groupBy("run", "station_code").agg((F.count("*") > 0).alias("found"))


@query("select split_part(station_id, ':', 2) as station_code, cast(date_trunc('minute', observed_at) as varchar) as observed_at, round(case when variable_code = 'rain' then value end, 6) as rain, round(case when variable_code = 'level' then value end, 6) as level, round(case when variable_code = 'flow' then value end, 6) as flow from obs")
def sc7_provider_xml(v):
    def tag(name, variable):
        return F.concat(F.lit(f"<{name}>"), F.when(F.col("variable_code") == variable, F.regexp_replace(F.col("value").cast("string"), r"\.", ",")).otherwise(""), F.lit(f"</{name}>"))

    code, at = F.split("station_id", ":")[1], F.date_format("observed_at", "yyyy-MM-dd HH:mm:ss")
    xml = F.concat(F.lit("<DadosHidrometereologicos><CodEstacao>0"), code, F.lit("</CodEstacao><DataHora>"), at, F.lit("</DataHora>"), tag("Nivel", "level"), tag("Chuva", "rain"), tag("Vazao", "flow"), F.lit("</DadosHidrometereologicos>"))
    rows = v("obs").select(xml.alias("payload"))
    path = scratch_dir(rows.sparkSession)
    rows.write.text(path)
    return scans.provider_xml(rows.sparkSession.read.text(path), "value")


@query("select station_id as station_code, case when user_id % 2 = 0 then null else station_id end as given_code, cast(date_trunc('minute', observed_at - interval '3' hour) as varchar) as observed_at, round(value, 6) as rain from (select *, cast(split_part(station_id, ':', 2) as bigint) as user_id from obs where variable_code = 'rain')")
def sc8_provider_json(v):
    rain = v("obs").where("variable_code = 'rain'").withColumn("user_id", F.split("station_id", ":")[1].cast("bigint"))
    ms = F.unix_millis(F.col("observed_at").cast("timestamp")).cast("string")
    pair = F.concat(F.lit("["), ms, F.lit(","), F.col("value").cast("string"), F.lit("]"))
    named = F.concat(F.lit('{"timestamp":'), ms, F.lit(',"chuva":"'), F.col("value").cast("string"), F.lit('","codigo":"'), F.col("station_id"), F.lit('"}'))
    entries = rain.groupBy("station_id", "user_id", F.to_date("observed_at").alias("day")).agg(F.concat_ws(",", F.collect_list(F.when(F.col("user_id") % 2 == 0, pair).otherwise(named))).alias("e"))
    text = F.when(F.col("user_id") % 3 == 0, F.concat(F.lit('{"data":{"data":['), "e", F.lit("]}}"))).when(F.col("user_id") % 3 == 1, F.concat(F.lit('{"data":['), "e", F.lit("]}"))).otherwise(F.concat(F.lit("["), "e", F.lit("]")))
    return scans.provider_json(entries.select(F.col("station_id").alias("station_code"), text.alias("payload")))


@query("select asset_id, step_hours, iy, ix, round(lon, 6) as lon, round(value * 1000, 6) as value from message where iy % 2 = 0")
def sc9_forecast_messages(v):
    rows = v("message").withColumns({"short_name": F.when(F.col("iy") % 2 == 0, "TP").otherwise("t2m"), "lon": F.col("lon") + 360})
    return G.normalise_messages(rows, ["tp"], 1000.0).select("asset_id", "step_hours", "iy", "ix", "lon", "value")


@query("select p_partkey // 50 as t, p_partkey % 50 as position, cast(p_size as double) as value from part")
def sc10_matrix_records(v):
    rows = v("part").groupBy(F.floor(F.col("p_partkey") / 50).alias("t")).agg(F.array_sort(F.collect_list(F.struct((F.col("p_partkey") % 50).alias("i"), F.col("p_size").cast("double").alias("x")))).alias("a"))
    spark, path = v("part").sparkSession, scratch_dir(v("part").sparkSession)
    scans.write_matrix(scans.to_records(rows.select("t", F.col("a.x").alias("row"))), path)
    return scans.matrix_values(spark, path, 50)


@query("select cast((select max(p_partkey // 50) + 1 from part) as bigint) as nt, cast(2 as bigint) as sources")
def sc10_timesteps(v):
    t = v("part").select(F.floor(F.col("p_partkey") / 50).alias("t")).distinct()
    return scans.timesteps(t.withColumn("source", F.lit("flow")).union(t.withColumn("source", F.lit("level"))))


@query("select mini_id, round(lon, 6) as lon, round(lat, 6) as lat from mini where mini_id <= 120")
def sc11_centroids(v):
    def comma(c):
        return F.regexp_replace(F.round(c, 6).cast("string"), r"\.", ",")

    lines = v("mini").select(F.concat_ws("   ", comma("lon"), F.col("mini_id").cast("string"), F.lit("x"), comma("lat")).alias("value"), F.col("mini_id").alias("n"))
    head = v("region").agg(F.lit(" Xcen  Mini Name  Ycen").alias("value"), F.lit(0).cast("long").alias("n"))
    return scans.centroids(head.unionByName(lines), 120)


@query("select mini_id from mini where mini_id <= 50")
def sl4_first_rows(v):
    """The first rows of a table whose lines came in another order."""
    return scans.first_lines(v("mini").select("mini_id", F.col("mini_id").alias("n")).orderBy(F.hash("mini_id")), 50).select("mini_id")


# --- sinks -----------------------------------------------------------------------------------------------------


@query("select split_part(station_id, ':', 1) as provider_code, split_part(station_id, ':', 2) as station_code, strftime(observed_at, '%Y-%m-%d %H:%M') as observed_at, variable_code, round(value, 6) as value from (select station_id, date_trunc('minute', observed_at) as observed_at, variable_code, sum(value) as value from obs group by 1, 2, 3)")
def sk1_observation_writer(v):
    p = F.split("station_id", ":")
    wide = v("obs").groupBy(p[0].alias("provider_code"), p[1].alias("station_code"), F.date_trunc("minute", "observed_at").cast("timestamp_ntz").alias("observed_at")).pivot("variable_code", ["rain", "level", "flow"]).agg(F.sum("value"))
    path = scratch_dir(wide.sparkSession)
    sinks.write_observations(sinks.to_long(wide, ["rain", "level", "flow"]), path, "r1")
    read = scans.observations(wide.sparkSession, path)
    return read.select("provider_code", "station_code", "observed_at", "variable_code", F.col("value").cast("double").alias("value"))


@query("select series_id, station_id, variable_code, state from series")
def sk2_ensured_series(v):
    have = v("series").where("state <> 'raw'").select("series_id", "station_id", "variable_code", "state")
    return sinks.ensured_series(have, O.series_of(v("obs")))


@query("select series_id, cast(observed_at as varchar) as observed_at, round(case when extract(day from observed_at) = 7 then value + 1 else value end, 6) as value from stored")
def sk3_value_upsert(v):
    spark = v("events").sparkSession
    path, rows = scratch_dir(spark), v("stored").withColumn("day", F.to_date("observed_at"))
    sinks.upsert_values(spark, path, rows)
    sinks.upsert_values(spark, path, rows.where("dayofmonth(observed_at) = 7").withColumns({"value": F.col("value") + 1, "note": F.lit("one more column")}))
    return sinks.read_values(spark, path).select("series_id", "observed_at", "value")


@query("select station_id, count(series_id) as series from (select * from station where user_id % 3 <> 0) left join series using (station_id) group by 1")
def sk4_station_sync(v):
    stations, series = sinks.synced(v("station"), v("station").where("user_id % 3 <> 0"), v("series"))
    return stations.select("station_id").join(series.select("station_id", "series_id"), "station_id", "left").groupBy("station_id").agg(F.count("series_id").alias("series"))


@query("select station_id, variable_code from capability where station_id not in (select station_id from station where user_id % 2 = 0) union all select station_id, 'rain' from station where user_id % 2 = 0")
def sk5_capability_replace(v):
    some = v("station").where("user_id % 2 = 0").select("station_id")
    return sinks.replaced(v("capability"), some.withColumn("variable_code", F.lit("rain")), some, "station_id")


@query("select cast(s_suppkey as varchar) as station_id, 'level_alert' as reference_type, round(s_acctbal, 6) as level_cm from supplier")
def sk6_reference_replace(v):
    spark, path = v("supplier").sparkSession, scratch_dir(v("supplier").sparkSession)
    rows = v("supplier").select(F.col("s_suppkey").cast("string").alias("station_id"), F.lit("level_alert").alias("reference_type"), F.col("s_acctbal").alias("level_cm"))
    for table in (rows.limit(1), rows):
        table.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@query("select scenario_id, variable_code, mini_id, cast(dt as varchar) as dt, prev_flag, round(round_even(round(value, 6) % 1000, 3), 6) as value from model_output")
def sk7_packed_output(v):
    """Sums are taken to six decimals first: what is left over 1000 of a sum just below a whole 1000 would depend on the order of its rows."""
    path = scratch_dir(v("orders").sparkSession)
    small = v("model_output").withColumn("value", F.round("value", 6) % 1000)
    for part in ("scenario_id = 'scenario0'", "scenario_id <> 'scenario0'"):  # the second write leaves the first one's rows
        sinks.write_model_output(small.where(part), path)
    return sinks.unpacked(v("orders").sparkSession.read.parquet(path)).select("scenario_id", "variable_code", "mini_id", "dt", "prev_flag", "value")


@query("select variable_code, count(*) as n from model_output where round_even(value * 100 / 0.001, 0) > 2147483647 group by 1")
def sk7_pack_errors(v):
    return sinks.pack_errors(v("model_output").withColumn("value", F.col("value") * 100))


@query("select asset_id, iy, ix, cast(start_utc as varchar) as start_utc, cast(end_utc as varchar) as end_utc, round(lat, 6) as lat, round(lon, 6) as lon, round(value, 6) as value from cell")
def sk8_grid_write(v):
    path = scratch_dir(v("part").sparkSession)
    for asset in ("asset0", "asset1"):  # the second write leaves the first one's rows
        sinks.write_grid(v("cell").where(F.col("asset_id") == asset), path)
    return v("part").sparkSession.read.parquet(path).select("asset_id", "iy", "ix", "start_utc", "end_utc", "lat", "lon", "value")


@query("select asset_id, iy, ix, cast(end_utc as varchar) as end_utc, round(value, 6) as value from cell where lat + 0.125 >= -31 and lat - 0.125 <= -29.5 and lon + 0.125 >= -54 and lon - 0.125 <= -52 and start_utc >= timestamp '2026-03-18 03:00:00' and end_utc <= timestamp '2026-03-18 09:00:00'")
def sk8_box_of_written_grid(v):
    """A box and a window of a grid that was written along the curve."""
    spark, path = v("part").sparkSession, scratch_dir(v("part").sparkSession)
    sinks.write_grid(v("cell"), path)
    window = G.window_of(spark.read.parquet(path), ts("2026-03-18 03:00:00"), ts("2026-03-18 09:00:00"))
    return G.crop(window, -54, -31, -52, -29.5, 0.25).select("asset_id", "iy", "ix", "end_utc", "value")


@query("select relative_path, asset_id, case when asset_id like '%7' then 'new' else checksum end as checksum from asset")
def sk9_asset_upsert(v):
    changed = v("asset").where("asset_id like '%7'").withColumn("checksum", F.lit("new"))
    return sinks.merged(v("asset"), changed, ["relative_path"]).select("relative_path", "asset_id", "checksum")


@query("select asset_id, manual_edit_id, t0_step from (select distinct asset_id, manual_edit_id, t0_step from edit) where asset_id not in (select asset_id from edit where manual_edit_id like '%0') union all select distinct asset_id, concat(asset_id, '-only'), 0 from edit where manual_edit_id like '%0'")
def sk11_edit_replace(v):
    edits = v("edit").select("asset_id", "manual_edit_id", "t0_step").distinct()
    owners = v("edit").where("manual_edit_id like '%0'").select("asset_id").distinct()
    new = owners.select("asset_id", F.concat("asset_id", F.lit("-only")).alias("manual_edit_id"), F.lit(0).alias("t0_step"))
    return sinks.replaced(edits, new, owners, "asset_id")


@query("select 'b1' as batch_id, scenario_id, count(*) as n from model_output group by 2")
def sk12_publication(v):
    """The first and the last batch lack a scenario and don't become the current one."""
    spark, path, rows = v("orders").sparkSession, scratch_dir(v("orders").sparkSession), v("model_output")
    sinks.published(spark, path, rows.where("scenario_id = 'scenario0'"), "b0", 3)
    sinks.published(spark, path, rows, "b1", 3)
    pointer = sinks.published(spark, path, rows.where("scenario_id <> 'scenario0'"), "b2", 3)
    return scans.current_batch(spark.read.parquet(f"{path}/batches"), pointer).groupBy("batch_id", "scenario_id").agg(F.count("*").alias("n"))


@query("select manual_edit_id, asset_id, t0_step, t1_step, cast(0 as double) as shift_lat, round(coalesce(case when multiplication_factor = 0 then null else multiplication_factor end, 1), 6) as multiplication_factor, reason from edit where t0_step <> 6")
def sk13_draft_edits(v):
    draft = v("edit").select("manual_edit_id", "asset_id", "t0_step", "t1_step", F.nullif("multiplication_factor", F.lit(0.0)).alias("multiplication_factor"), "reason", (F.col("t0_step") == 6).alias("remove"))
    return sinks.normal_edits(draft).select("manual_edit_id", "asset_id", "t0_step", "t1_step", "shift_lat", "multiplication_factor", "reason")


@query("""with e as (select manual_edit_id, asset_id, t0_step, t1_step, min(multiplication_factor) as f, min(reason) as reason from edit group by 1, 2, 3, 4)
    select manual_edit_id, case when f <= 0 then 'factor' else 'reason' end as reason from e where f <= 0 or reason is null
    union all select manual_edit_id, 'overlap' from (select *, max(t1_step) over (partition by asset_id order by t0_step, t1_step, manual_edit_id rows between unbounded preceding and 1 preceding) as ended from e) where t0_step < ended""")
def sk13_edit_errors(v):
    rows = v("edit").groupBy("manual_edit_id", "asset_id", "t0_step", "t1_step").agg(F.min("multiplication_factor").alias("multiplication_factor"), F.min("reason").alias("reason"))
    return sinks.edit_errors(rows)


# --- jobs and stream -------------------------------------------------------------------------------------------


@query(f"with {RAW} {RAW_BUCKETS}")
def pj1_file_ingest(v):
    allowed = v("station").select("provider_code").distinct().withColumn("variable_code", F.explode(F.array(F.lit("rain"), F.lit("level"), F.lit("flow"))))
    spark, path = v("events").sparkSession, scratch_dir(v("events").sparkSession)
    jobs.load_files(spark, path, scans.typed_observations(landed(v)), v("station"), allowed, 3)
    return sinks.read_values(spark, path).select("series_id", "observed_at", "value")


@query("select split_part(station_id, ':', 2) as station_code, strftime(observed_at, '%Y-%m-%d %H:%M') as observed_at, round(value, 6) as rain from (select station_id, date_trunc('minute', observed_at) as observed_at, value from obs where variable_code = 'rain')")
def pj3_provider_to_files(v):
    """Provider XML, parsed, written as observation files, and scanned."""
    parsed = sc7_provider_xml(v).where("rain is not null").withColumn("provider_code", F.lit("ana"))
    path = scratch_dir(parsed.sparkSession)
    sinks.write_observations(sinks.to_long(parsed, ["rain"]), path, "r1")
    return scans.observations(parsed.sparkSession, path).select("station_code", "observed_at", F.col("value").cast("double").alias("rain"))


@query(f"with {RAW} {RAW_BUCKETS}")
def st1_continuous_ingest(v):
    """Files of the raw observations as a stream, one at a time and in no order; the table must be that of one batch."""
    rows = long_rows(v)
    spark = rows.sparkSession
    source, target, state = (scratch_dir(spark) for _ in range(3))
    text = rows.withColumns({"observed_at": F.date_format("observed_at", "yyyy-MM-dd HH:mm"), "value": F.col("value").cast("string")})
    text.repartitionByRange(4, "observed_at").write.option("header", True).csv(source)
    ingest.start(spark, source, target, state, 3, files_per_trigger=1).awaitTermination()
    return ingest.values(spark, target)
