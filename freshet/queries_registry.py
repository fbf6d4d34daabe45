"""Queries over the asset registry, edits, scenarios and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from .operators import quality as Q
from .operators import registry as R
from .operators import series as S
from .queries import query, ts
from .sources import scans

AT = "1999-06-15 09:00:00"


#: Rows with equal ids are equal but for columns that no query shows.
ED = "with e as (select manual_edit_id, asset_id, t0_step, t1_step, min(multiplication_factor) as multiplication_factor, min(reason) as reason from edit group by 1, 2, 3, 4)"


def own_edits(v):
    return v("edit").groupBy("manual_edit_id", "asset_id", "t0_step", "t1_step").agg(F.min("multiplication_factor").alias("multiplication_factor"), F.min("reason").alias("reason"))


@query("select asset_id, row_number() over (partition by provider_code, asset_kind order by coalesce(valid_from, created_at) desc nulls last, created_at desc nulls last, asset_id) as place from asset where asset_kind = 'forecast_grid'")
def mf7_asset_list(v):
    return R.listed(v("asset"), kind="forecast_grid").select("asset_id", "place")


@query("select provider_code, provider_code = 'ecmwf' as supported from asset group by 1")
def mf8_enabled_providers(v):
    return R.enabled_providers(v("asset"), ["ecmwf"])


HEADER = """header as (select asset_id, valid_from, valid_to, provider_code, asset_kind, k, case when k % 3 = 0 then 'temperature' else 'precipitation' end as variable, case when k % 5 = 0 then 'enfo' else 'oper' end as product_type,
    case when k % 7 = 0 then 3 end as timestep_hours, case when k % 4 = 0 then 0.5 else 0.1 end as buffer_fraction, case when k % 6 = 1 then -55.0 else -54.0 end as west from (select *, cast(regexp_extract(asset_id, '[0-9]+') as bigint) as k from asset))"""


@query(f"with {HEADER} select asset_id, asset_kind = 'forecast_grid' and variable = 'precipitation' and provider_code = 'ecmwf' and product_type = 'oper' and k % 10 = 2 and timestep_hours is null and buffer_fraction = 0.1 and west = -54 and valid_from <= timestamp '1999-06-15 09:00:00' and valid_to >= timestamp '1996-06-15 09:00:00' as reusable from header")
def mf6_reusable_header(v):
    """All conditions on a header: identity, product, cycle, step, source, buffer, the three boxes, the span."""
    k = F.regexp_extract("asset_id", "[0-9]+", 0).cast("bigint")
    box = F.array(F.when(k % 6 == 1, -55.0).otherwise(-54.0), F.lit(-31.0), F.lit(-50.0), F.lit(-27.0))
    headers = v("asset").select(
        "asset_id", "asset_kind", "provider_code", "valid_from", "valid_to", F.when(k % 3 == 0, "temperature").otherwise("precipitation").alias("variable"), F.array("provider_code").alias("providers"), F.when(k % 5 == 0, "enfo").otherwise("oper").alias("product_type"),
        (k % 10).alias("cycle"), F.when(k % 7 == 0, 3).alias("timestep_hours"), F.lit("cropped_from_native_grid").alias("source"), F.when(k % 4 == 0, 0.5).otherwise(0.1).alias("buffer_fraction"), box.alias("model_box"), box.alias("buffered_box"), box.alias("requested_box"),
    )
    wanted_box = [-54.0, -31.0, -50.0, -27.0]
    wanted = {
        "asset_kind": "forecast_grid", "variable": "precipitation", "providers": ["ecmwf"], "provider_code": "ecmwf", "product_type": "oper", "cycle": 2, "timestep_hours": None, "source": "cropped_from_native_grid", "buffer_fraction": 0.1,
        "model_box": wanted_box, "buffered_box": wanted_box, "requested_box": wanted_box, "valid_from": ts(AT), "valid_to": ts("1996-06-15 09:00:00"),
    }
    return R.reusable(headers, wanted).select("asset_id", "reusable")


@query("select asset_id, asset_kind = 'forecast_grid' and provider_code = 'noaa' and valid_from <= timestamp '1999-06-15 09:00:00' and valid_to >= timestamp '1999-06-15 09:00:00' as reusable from asset")
def mf6_reusable(v):
    return R.reusable(v("asset"), {"asset_kind": "forecast_grid", "provider_code": "noaa", "valid_from": ts(AT), "valid_to": ts(AT)}).select("asset_id", "reusable")


@query("select asset_id, 'forecast' as grid_type, cast(valid_from as varchar) as cycle_time, 'ecmwf' as provider from asset where provider_code = 'ecmwf'")
def mf5_asset_metadata(v):
    meta = F.to_json(F.struct(F.lit("forecast").alias("type"), F.date_format("valid_from", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("cycle_time"), F.array("provider_code").alias("providers")))
    rows = v("asset").where("provider_code = 'ecmwf'").withColumn("metadata_json", meta)
    return R.with_metadata(rows).select("asset_id", "grid_type", "cycle_time", F.element_at("providers", 1).alias("provider"))


@query("select asset_id, relative_path, count(*) over () as n from asset where asset_id = 'noaa.7'")
def sc22_asset_lookup(v):
    return R.find_one(v("asset"), "asset_id", "noaa.7").select("asset_id", "relative_path", "n")


@query(f"{ED} select asset_id, manual_edit_id, row_number() over (partition by asset_id order by t0_step, t1_step, manual_edit_id) as place from e")
def sc23_edits_in_order(v):
    return R.edits_of(own_edits(v)).select("asset_id", "manual_edit_id", "place")


@query(f"{ED} select asset_id, manual_edit_id from (select *, max(t1_step) over (partition by asset_id order by t0_step, t1_step, manual_edit_id rows between unbounded preceding and 1 preceding) as ended from e) where t0_step < ended")
def jo9_overlapping_edits(v):
    return R.overlapping_edits(own_edits(v))


@query("select provider_code, asset_id from asset where asset_kind = 'forecast_grid' and valid_from <= timestamp '1999-06-15 09:00:00' and valid_to >= timestamp '1999-06-15 09:00:00' qualify row_number() over (partition by provider_code order by valid_from desc, created_at desc, asset_id) = 1")
def jo11_covering_asset(v):
    return R.covering(v("asset"), ts(AT), "forecast_grid").select("provider_code", "asset_id")


@query("""with p as (select o_orderkey as point_id, case o_orderkey % 2 when 0 then 'ecmwf' else 'noaa' end as provider_code, o_orderdate + interval '5' hour as t from orders), f as (
    select point_id, asset_id from p join (select * from asset where asset_kind = 'forecast_grid') a on a.provider_code = p.provider_code and valid_from <= t and valid_to >= t qualify row_number() over (partition by point_id order by valid_from desc, created_at desc, asset_id) = 1)
    select point_id, asset_id from p left join f using (point_id)""")
def jo11_as_of_join(v):
    key = F.col("o_orderkey")
    points = v("orders").select(key.alias("point_id"), F.when(key % 2 == 0, "ecmwf").otherwise("noaa").alias("provider_code"), (F.col("o_orderdate") + F.expr("interval 5 hours")).alias("at"))
    return R.as_of(points, v("asset"), "forecast_grid")


@query("""with w as (select distinct provider_code, valid_from as cycle_time from asset where asset_kind = 'forecast_grid' union select 'ecmwf', timestamp '1990-01-01')
    select provider_code, cast(cycle_time as varchar) as cycle_time, asset_id from w left join (select provider_code, valid_from as cycle_time, asset_id from asset where asset_kind = 'forecast_grid') using (provider_code, cycle_time)""")
def jo12_exact_cycle(v):
    wanted = v("asset").where("asset_kind = 'forecast_grid'").select("provider_code", F.col("valid_from").alias("cycle_time"))
    none = v("region").agg(F.lit("ecmwf").alias("provider_code"), ts("1990-01-01 00:00:00").alias("cycle_time"))
    return R.of_cycle(wanted.union(none).distinct(), v("asset"))


REFS = "refs as (select distinct case o_orderkey % 2 when 0 then 'ecmwf' else 'noaa' end as provider_code, date_trunc('day', o_orderdate) + interval '14' hour as reference from orders)"
OPTIONS = "options as (select provider_code, reference, i as rank, reference - interval '2' hour - i * interval '6' hour as cycle_time from refs, range({n}) r(i))"


def references(v):
    key = F.col("o_orderkey")
    return v("orders").select(F.when(key % 2 == 0, "ecmwf").otherwise("noaa").alias("provider_code"), (F.date_trunc("day", "o_orderdate").cast("timestamp_ntz") + F.expr("interval 14 hours")).alias("reference")).distinct()


@query(f"""with {REFS}, {OPTIONS.format(n=4)}, f as (select provider_code, reference, rank, asset_id from options join (select provider_code, valid_from as cycle_time, asset_id from asset where asset_kind = 'forecast_grid') using (provider_code, cycle_time)
    qualify row_number() over (partition by provider_code, reference order by rank, asset_id) = 1)
    select provider_code, cast(reference as varchar) as reference, rank, asset_id, case when asset_id is null then 'unregistered_cycle' end as problem from refs left join f using (provider_code, reference)""")
def jo13_expected_asset(v):
    return R.expected_asset(references(v), v("asset"), 4)


@query(f"""with {REFS}, {OPTIONS.format(n=3)}, u as (select distinct provider_code, valid_from as cycle_time from asset where asset_kind = 'forecast_grid' and valid_to >= timestamp '1996-01-01')
    select provider_code, cast(reference as varchar) as reference, cast(coalesce(arg_min(cycle_time, rank) filter (where u.cycle_time is not null), arg_min(o.cycle_time, rank)) as varchar) as cycle_time,
    case when count(u.cycle_time) > 0 then 'reuse' else 'produce' end as action from options o left join u using (provider_code, cycle_time) group by 1, reference""".replace("arg_min(cycle_time, rank)", "arg_min(o.cycle_time, rank)"))
def pj6_update_actions(v):
    return R.update_actions(references(v), v("asset"), 3, ts("1996-01-01 00:00:00"))


NEWEST = """newest as (select provider_code, min(asset_id) as asset_id, max(valid_from) as valid_from, count(*) as n from (
    select *, rank() over (partition by provider_code order by valid_from desc) as place from asset where asset_kind = 'forecast_grid' and valid_from <= timestamp '1999-06-15 09:00:00' and valid_to >= timestamp '1999-06-16') where place = 1 group by 1)"""


@query(f"with {NEWEST} select provider_code, asset_id, cast(valid_from as varchar) as valid_from, n from newest")
def wn7_newest_cycles(v):
    return R.newest_cycles(v("asset"), ts(AT), ts("1999-06-16 00:00:00"))


@query(f"""{ED}, {NEWEST}, raw as (select * from newest where n = 1) select 'zero' as scenario_id, 'zero' as kind, null as asset_id, null as manual_edit_id
    union all select concat(provider_code, '.raw'), 'raw', asset_id, null from raw union all select concat(provider_code, '.corrected.', manual_edit_id), 'corrected', asset_id, manual_edit_id from raw join e using (asset_id)""")
def jo18_scenarios(v):
    return R.scenarios(v("asset"), own_edits(v), ts(AT), ts("1999-06-16 00:00:00"))


@query(f"with {NEWEST} select provider_code, n from newest where n > 1")
def jo18_tied_providers(v):
    return R.tied_providers(v("asset"), ts(AT), ts("1999-06-16 00:00:00"))


@query("select asset_id, case when regexp_extract(asset_id, '[0-9]+')::bigint % 5 = 0 then 'insert' when regexp_extract(asset_id, '[0-9]+')::bigint % 5 = 1 then 'same' when regexp_extract(asset_id, '[0-9]+')::bigint % 5 = 2 then 'replace' else 'conflict' end as action from asset")
def sk10_ingest_actions(v):
    """Registered are four fifths of the assets; of the new ones some differ, and some of these were made later."""
    n = F.regexp_extract("asset_id", "[0-9]+", 0).cast("bigint") % 5
    registered = v("asset").where(n != 0)
    new = v("asset").withColumns({"checksum": F.when(n >= 2, F.concat("checksum", F.lit("x"))).otherwise(F.col("checksum")), "created_at": F.when(n == 2, F.col("created_at") + F.expr("interval 1 day")).otherwise(F.col("created_at"))})
    return R.classify_ingest(new, registered)


# --- checks ----------------------------------------------------------------------------------------------------


@query("""with f as (select station_id, bool_or(variable_code = 'rain') as r, bool_or(variable_code = 'flow') as f from capability group by 1), m as (select station_id, concat_ws(',', case when not coalesce(f, false) then 'flow' end, case when not coalesce(r, false) then 'rain' end) as m from station left join f using (station_id))
    select 'station_availability' as rule_code, station_id as subject, m = '' as passed, case when m = '' then 'info' else 'warning' end as severity, case when m = '' then '' else concat('missing: ', m) end as message from m""")
def qc1_station_availability(v):
    return Q.station_availability(v("station"), v("capability").withColumn("value", F.lit(1.0)), ["rain", "flow"])


@query("""with c as (select * from cell where asset_id = 'asset0' or end_utc <> timestamp '2026-03-18 06:00:00' and iy <> 5), rows_ as (select * from c union all select * from c where asset_id = 'asset0' and iy = 0 and ix < 3),
    t as (select asset_id, start_utc, lag(end_utc) over (partition by asset_id order by end_utc) as before from (select distinct asset_id, start_utc, end_utc from rows_)), gap as (select asset_id, count(*) filter (where before is not null and before <> start_utc) as n from t group by 1),
    twice as (select asset_id, count(*) filter (where k > 1) as n from (select asset_id, start_utc, end_utc, iy, ix, count(*) as k from rows_ group by all) group by 1),
    lat_ as (select asset_id, max(d) - min(d) < 1e-6 as ok from (select asset_id, lat - lag(lat) over (partition by asset_id order by lat) as d from (select distinct asset_id, lat from rows_)) group by 1),
    lon_ as (select asset_id, max(d) - min(d) < 1e-6 as ok from (select asset_id, lon - lag(lon) over (partition by asset_id order by lon) as d from (select distinct asset_id, lon from rows_)) group by 1),
    r as (select 'contiguous' as rule_code, asset_id, n = 0 as ok, concat(n, ' gaps') as why from gap union all select 'unique_cells', asset_id, n = 0, concat(n, ' repeated') from twice
        union all select 'regular_lat', asset_id, coalesce(ok, true), 'uneven steps' from lat_ union all select 'regular_lon', asset_id, coalesce(ok, true), 'uneven steps' from lon_)
    select rule_code, asset_id as subject, ok as passed, case when ok then 'info' else 'error' end as severity, case when ok then '' else why end as message from r""")
def qc2_grid_contract(v):
    """One asset has repeated cells, the other lacks an interval and a row."""
    cells = v("cell").where("asset_id = 'asset0' or end_utc <> timestamp_ntz '2026-03-18 06:00:00' and iy <> 5")
    return Q.grid_contract(cells.unionByName(cells.where("asset_id = 'asset0' and iy = 0 and ix < 3")))


@query("""with o as (select scenario_id, variable_code, mini_id, dt, case when scenario_id = 'scenario2' then 1 - prev_flag when scenario_id = 'scenario0' and mini_id = 3 then 2 else prev_flag end as prev_flag from model_output), rows_ as (select * from o union all select * from o where scenario_id = 'scenario1' and mini_id = 5),
    p as (select scenario_id, count(*) filter (where prev_flag not in (0, 1)) as odd, max(dt) filter (where prev_flag = 0) as c, min(dt) filter (where prev_flag = 1) as f from rows_ group by 1), w as (select scenario_id, count(*) filter (where k > 1) as n from (select scenario_id, variable_code, mini_id, dt, count(*) as k from rows_ group by all) group by 1),
    r as (select 'segments' as rule_code, scenario_id, odd = 0 as ok, 'unknown segment' as why from p union all select 'segment_order', scenario_id, coalesce(c < f, true), 'forecast before current' from p union all select 'unique_times', scenario_id, n = 0, 'repeated times' from w)
    select rule_code, scenario_id as subject, ok as passed, case when ok then 'info' else 'error' end as severity, case when ok then '' else why end as message from r""")
def qc2_model_contract(v):
    """Each scenario breaks one rule: an unknown segment, repeated times, forecast before current."""
    flag = F.when(F.col("scenario_id") == "scenario2", 1 - F.col("prev_flag")).when((F.col("scenario_id") == "scenario0") & (F.col("mini_id") == 3), F.lit(2)).otherwise(F.col("prev_flag"))
    rows = v("model_output").withColumn("prev_flag", flag)
    return Q.model_contract(rows.unionByName(rows.where("scenario_id = 'scenario1' and mini_id = 5")))


@query("select 'precipitation' as rule_code, cast(c_nationkey as varchar) as subject, min(c_acctbal) >= 0 as passed, case when min(c_acctbal) >= 0 then 'info' else 'error' end as severity, case when min(c_acctbal) >= 0 then '' else 'negative' end as message from customer group by c_nationkey")
def qc3_precipitation(v):
    return Q.precipitation(v("customer").select("c_nationkey", F.col("c_acctbal").alias("value")), "c_nationkey")


@query(f"{ED}, s as (select distinct asset_id from e), ok as (select manual_edit_id, t0_step >= 0 and t0_step < t1_step and t0_step % 3 = 0 and t1_step % 3 = 0 and t1_step <= 48 as ok from e) select 'correction_window' as rule_code, manual_edit_id as subject, ok as passed, case when ok then 'info' else 'error' end as severity, case when ok then '' else 'not between available steps' end as message from ok")
def qc4_correction_windows(v):
    steps = own_edits(v).select("asset_id").distinct().withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(48), F.lit(3))))
    return Q.correction_windows(own_edits(v), steps)


@query(f"""{ED}, o as (select asset_id, count(*) as n from (select *, max(t1_step) over (partition by asset_id order by t0_step, t1_step, manual_edit_id rows between unbounded preceding and 1 preceding) as ended from e) where t0_step < ended group by 1)
    select 'correction_overlap' as rule_code, asset_id as subject, n is null as passed, case when n is null then 'info' else 'error' end as severity, case when n is null then '' else concat(n, ' overlap') end as message from (select distinct asset_id from e) left join o using (asset_id)""")
def qc5_correction_overlaps(v):
    return Q.correction_overlaps(own_edits(v))


@query(f"{ED}, ok as (select manual_edit_id, multiplication_factor > 0 as ok from e) select 'instruction' as rule_code, manual_edit_id as subject, ok as passed, case when ok then 'info' else 'error' end as severity, case when ok then '' else 'invalid parameters' end as message from ok")
def qc6_instructions(v):
    return Q.instructions(own_edits(v).withColumns({c: F.lit(0.0) for c in ("shift_lat", "shift_lon", "rotation_deg")}))


@query("""with w as (select scenario_id, min(dt) as a, max(dt) as z from model_output where scenario_id <> 'scenario1' or extract(year from dt) < 1996 group by 1), x as (select min(dt) as a, max(dt) as z from model_output where scenario_id = 'scenario0'), p as (select scenario_id, w.a = x.a and w.z = x.z as ok from w, x)
    select 'stale_output' as rule_code, scenario_id as subject, ok as passed, case when ok then 'info' else 'error' end as severity, case when ok then '' else 'another window' end as message from p""")
def qc7_stale_output(v):
    """The expected window is that of one scenario; another one ends early."""
    out = v("model_output")
    window = out.where("scenario_id = 'scenario0'").agg(F.min("dt").alias("a"), F.max("dt").alias("z")).first()
    return Q.stale(out.where("scenario_id <> 'scenario1' or year(dt) < 1996"), F.lit(window.a), F.lit(window.z))


@query("select 'registered_data' as rule_code, asset_id as subject, checksum like '%3' as passed, case when checksum like '%3' then 'info' else 'error' end as severity, case when checksum like '%3' then '' else 'no cells' end as message from asset")
def qc8_registry_integrity(v):
    return Q.registry_integrity(v("asset"), v("asset").where("checksum like '%3'").select("asset_id"))


# --- scans of models -------------------------------------------------------------------------------------------


@query("select scenario_id, cast(dt as varchar) as dt, prev_flag, round(value, 6) as value, 'Precipitation' as display_name, 'mm' as unit from model_output where mini_id = 9 and prev_flag = 1 and dt >= timestamp '1997-03-01' and dt < timestamp '1998-03-01'")
def sc15_model_series(v):
    return S.model_series(v("model_output"), 9, "precipitation", 1, ts("1997-03-01 00:00:00"), ts("1998-03-01 00:00:00"))


@query("select 'precipitation' as variable_code, 'Precipitation' as display_name, 'mm' as unit from model_output limit 1")
def sc16_model_variables(v):
    return S.model_variables(v("model_output"))


@query("select station_id, round(lat, 6) as lat, round(lon, 6) as lon, series_id, variable_code, state, count(s.observed_at) as n from station join series using (station_id) left join stored s using (series_id) group by all")
def sc17_catalog_tables(v):
    both = v("station").where("lat is not null and lon is not null").join(v("series"), "station_id").join(v("stored").groupBy("series_id").agg(F.count("*").alias("n")), "series_id", "left")
    return both.select("station_id", "lat", "lon", "series_id", "variable_code", "state", F.coalesce("n", F.lit(0)).alias("n"))


@query("select series_id, cast(s.observed_at as varchar) as observed_at, round(s.value, 6) as value, station_id, variable_code from stored s join series using (series_id) where station_id = 'inmet:3' and s.observed_at between timestamp '2024-01-03' and timestamp '2024-01-20'")
def sc18_station_tables(v):
    return S.station_values(v("series"), v("stored"), "inmet:3", ts("2024-01-03 00:00:00"), ts("2024-01-20 00:00:00"))


@query("select series_id, station_id, variable_code, state, cast(created_at as varchar) as created_at, provider_code, round(lat, 6) as lat, round(lon, 6) as lon from series join station using (station_id) where variable_code = 'rain'")
def sc19_rain_series(v):
    return S.rain_series(v("series"), v("station")).select("series_id", "station_id", "variable_code", "state", "created_at", "provider_code", "lat", "lon")


@query("select s.series_id, cast(s.observed_at as varchar) as observed_at, round(s.value, 6) as value, station_id, variable_code from stored s join series using (series_id) where state = 'approved' and s.observed_at >= timestamp '2024-01-03' and s.observed_at <= timestamp '2024-01-10'")
def sc20_values_of_series(v):
    return S.values_of(v("series").where("state = 'approved'"), v("stored"), ts("2024-01-03 00:00:00"), ts("2024-01-10 00:00:00"), end_inclusive=True)


@query("select scenario_id, count(*) as n from model_output where scenario_id <> 'scenario2' group by 1")
def sc21_published_scenarios(v):
    published = v("model_output").withColumn("batch_id", F.when(F.col("scenario_id") == "scenario2", "old").otherwise("new"))
    pointer = v("region").agg(F.lit("new").alias("batch_id"))
    return scans.current_batch(published, pointer).groupBy("scenario_id").agg(F.count("*").alias("n"))


@query("select mini_id, concat('MINI|', mini_id) as click_id, round(mini_area, 6) as mini_area from mini where mini_id % 2 = 0")
def sc12_mini_layer(v):
    return scans.mini_layer(v("mini").select(F.when(F.col("mini_id") % 2 == 0, F.col("mini_id").cast("double")).otherwise(F.col("mini_id") + 0.5).alias("mini_id"), "mini_area")).select("mini_id", "click_id", "mini_area")
