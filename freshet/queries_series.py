"""Queries over observations and series: buckets, summaries, joins, windows, time and text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import text as T
from .functions import timeops as D
from .operators import observations as O
from .operators import series as S
from .plans import jobs
from .queries import query, ts

START, CUTOFF, END = "2024-01-05 00:00:00", "2024-01-20 12:00:00", "2024-01-25 00:00:00"
#: Right-closed bucket of a minute in DuckDB.
BUCKET = "time_bucket(interval '3 hours', date_trunc('minute', {0}) - interval '1 minute') + interval '3 hours'"
PREFERRED = """
    preferred as (select * exclude (rk) from (
        select *, row_number() over (partition by station_id, variable_code order by case state when 'approved' then 0 when 'curated' then 1 when 'raw' then 2 else 3 end, created_at desc nulls last, series_id) as rk
        from series) where rk = 1)"""
VALUES = f"""
    vals as (select s.*, p.station_id, p.variable_code from stored s join preferred p using (series_id)
             where s.observed_at >= timestamp '{START}' and s.observed_at <= timestamp '{END}')"""
OFFERED = """
    offered as (select * from (values ('ana', 'rain', 0), ('ana', 'level', 1), ('ana', 'flow', 2), ('inmet', 'rain', 0)) o(provider_code, variable_code, position))"""


def offered(v):
    """Variables of each provider in its order, for the providers that the stations have."""
    have = v("station").select("provider_code").distinct()
    lists = F.when(F.col("provider_code") == "ana", F.array(F.lit("rain"), F.lit("level"), F.lit("flow"))).otherwise(F.array(F.lit("rain")))
    return have.select("provider_code", F.posexplode(lists).alias("position", "variable_code"))


def values(v):
    return S.values_of(S.preferred_series(v("series")), v("stored"), ts(START), ts(END), end_inclusive=True)


# --- aggregations ----------------------------------------------------------------------------------------------


@query(f"""with {PREFERRED}, {VALUES}, k as (
    select station_id, bool_or(variable_code = 'rain') as r, bool_or(variable_code in ('level', 'flow')) as h from preferred group by 1
), a as (
    select station_id, count(*) as n, count(value) as c, avg(case when variable_code = 'rain' then value end) as mean_rain,
           case when count(case when variable_code = 'rain' then value end) > 0 then coalesce(sum(case when variable_code = 'rain' and observed_at > timestamp '{END}' - interval '24' hour then value end), 0) end as rain_24h,
           quantile_cont(case when variable_code = 'rain' then value end, 0.9) as p90_rain
    from vals group by 1
) select s.station_id, provider_code, station_code, station_name, mini_id, lat, lon,
         case when r and h then 'mixed' when r then 'rain' when h then 'level' else 'no_data' end as kind,
         case when coalesce(n, 0) = 0 then 'no_data' when c = 0 then 'data_issue' else 'ok' end as status, coalesce(n, 0) as n_rows,
         round(mean_rain, 6) as mean_rain, round(rain_24h, 6) as rain_24h, round(p90_rain, 6) as p90_rain
  from station s left join k using (station_id) left join a using (station_id)""")
def ag9_station_catalog(v):
    """Flagship: kind, status and rain of every station over its preferred series."""
    return S.station_catalog(v("station"), v("series"), v("stored"), ts(START), ts(END))


@query(f"""select station_id, variable_code, state, cast({BUCKET.format('observed_at')} as varchar) as observed_at,
    round(case variable_code when 'rain' then sum(value) when 'level' then avg(value) else arg_max(value, arrival_seq) end, 6) as value
    from obs_null where value is not null group by station_id, variable_code, state, {BUCKET.format('observed_at')}""")
def ag1_bucket_aggregate(v):
    return O.bucket_values(v("obs_null"), 3, {"rain": "sum", "level": "mean", "flow": "last"})


@query(f"""with b as (select variable_code, count(*) as rows_written from (select distinct station_id, variable_code, state, {BUCKET.format('observed_at')} as e from obs_null where value is not null) group by 1)
    select variable_code, rows_read, coalesce(rows_written, 0) as rows_written from (select variable_code, count(*) as rows_read from obs_null group by 1) left join b using (variable_code)""")
def ag2_import_summary(v):
    return O.import_summary(v("obs_null"), O.bucket_values(v("obs_null"), 3))


@query(f"with {PREFERRED} select station_id, case when bool_or(variable_code = 'rain') and bool_or(variable_code <> 'rain') then 'mixed' when bool_or(variable_code = 'rain') then 'rain' else 'level' end as kind from preferred group by 1")
def ag3_station_kind(v):
    return S.kinds(S.preferred_series(v("series")))


@query(f"""with {PREFERRED}, {VALUES} select station_id, case when count(v.series_id) = 0 then 'no_data' when count(v.value) = 0 then 'data_issue' else 'ok' end as status, count(v.series_id) as n_rows
    from station left join vals v using (station_id) group by 1""")
def ag4_station_status(v):
    return S.station_status(v("station"), values(v))


@query(f"""with {PREFERRED}, {VALUES} select station_id, round(avg(value), 6) as mean_rain,
    round(coalesce(sum(case when observed_at > timestamp '{CUTOFF}' - interval '24' hour then value end), 0), 6) as rain_24h, round(quantile_cont(value, 0.9), 6) as p90_rain
    from vals where variable_code = 'rain' and observed_at <= timestamp '{CUTOFF}' and value is not null group by 1""")
def ag5_rain_summary(v):
    return S.rain_summary(values(v), ts(CUTOFF))


_LAST = "case when count(case when variable_code = 'rain' then value end) > 0 then round(coalesce(sum(case when variable_code = 'rain' and observed_at > timestamp '%s' - interval '%d' hour then value end), 0), 6) end as rain_%dh"


@query(f"""with {PREFERRED}, {VALUES} select station_id, cast(max(observed_at) as varchar) as latest, {', '.join(_LAST % (CUTOFF, h, h) for h in (12, 24, 72))},
    round(arg_max(value, observed_at) filter (where variable_code = 'level'), 6) as level, round(arg_max(value, observed_at) filter (where variable_code = 'flow'), 6) as flow
    from vals where observed_at <= timestamp '{CUTOFF}' and value is not null group by 1""")
def ag6_observed_metrics(v):
    return S.observed_metrics(values(v), ts(CUTOFF))


@query(f"""with {PREFERRED} select station_id, round(sum(value), 6) as rain from stored join preferred using (series_id)
    where variable_code = 'rain' and observed_at > timestamp '{START}' and observed_at <= timestamp '{CUTOFF}' and value is not null group by 1""")
def ag7_rainfall_accumulations(v):
    return S.rainfall_accumulations(v("series"), v("stored"), ts(START), ts(CUTOFF))


@query(f"""with {PREFERRED} select p.station_id, lat, lon, round(sum(s.value), 6) as rain from preferred p join station using (station_id)
    left join stored s on s.series_id = p.series_id and s.observed_at >= timestamp '{START}' and s.observed_at < timestamp '{CUTOFF}' where variable_code = 'rain' group by 1, 2, 3""")
def ag8_accumulated_rain(v):
    return S.accumulated_rain(v("series"), v("stored"), v("station"), ts(START), ts(CUTOFF))


_PEAKS = """round(arg_max(value, dt) filter (where prev_flag = 0 and dt <= timestamp '1996-06-01'), 6) as current_value, cast(max(dt) filter (where prev_flag = 0 and dt <= timestamp '1996-06-01') as varchar) as current_time,
    round(max(value) filter (where prev_flag = 0 and dt <= timestamp '1996-06-01'), 6) as current_peak,
    case when count(*) filter (where prev_flag = 0 and dt <= timestamp '1996-06-01') > 0 then round(max(value) filter (where prev_flag = 1 and dt > timestamp '1996-06-01' and dt < timestamp '1999-01-01'), 6) end as forecast_peak"""


@query(f"select mini_id, {_PEAKS} from model_output where scenario_id = 'scenario0' group by 1")
def ag10_mini_peaks(v):
    return S.mini_peaks(v("model_output").where("scenario_id = 'scenario0'"), ts("1996-06-01 00:00:00"), ts("1999-01-01 00:00:00"))


@query(f"select mini_id, {_PEAKS} from (select mini_id from mini) left join (select * from model_output where scenario_id = 'scenario1') using (mini_id) group by 1")
def ag11_network_peaks(v):
    return S.network_peaks(v("model_output").where("scenario_id = 'scenario1'"), "precipitation", v("mini"), ts("1996-06-01 00:00:00"), ts("1999-01-01 00:00:00"))


@query(f"""with {PREFERRED}, {VALUES}, a as (select s.station_id, count(x.series_id) as n, count(x.value) as c,
    case when count(case when variable_code = 'rain' then value end) > 0 then coalesce(sum(case when variable_code = 'rain' and observed_at > timestamp '{END}' - interval '24' hour then value end), 0) end as r
    from station s left join vals x using (station_id) group by 1)
    select count(*) as stations, count(*) filter (where c > 0) as ok, count(*) filter (where n > 0 and c = 0) as data_issue, count(*) filter (where n = 0) as no_data,
    round(coalesce(avg(r) filter (where c > 0), avg(r)), 6) as mean_24h, round(coalesce(quantile_cont(case when c > 0 then r end, 0.9), quantile_cont(r, 0.9)), 6) as p90_24h from a""")
def ag12_network_summary(v):
    return S.network_summary(S.station_catalog(v("station"), v("series"), v("stored"), ts(START), ts(END)))


@query(f"""select variable_code, round(sum(case when observed_at > timestamp '{START}' and observed_at <= timestamp '{CUTOFF}' then value end), 6) as total from obs_null group by 1""")
def ag13_rainfall_total(v):
    rows = v("obs_null")
    return rows.groupBy("variable_code").agg(S.rainfall_total(rows, "observed_at", ts(START), ts(CUTOFF)).alias("total"))


@query(f"""select (select round(sum(value), 6) from obs_null where variable_code = 'rain' and station_id = 'ana:2' and observed_at > timestamp '{START}' and observed_at <= timestamp '{CUTOFF}') as station_past,
    (select round(sum(value), 6) from model_output where mini_id = 3 and prev_flag = 0 and dt > timestamp '1996-01-01' and dt <= timestamp '1997-01-01') as basin_past,
    (select round(sum(value), 6) from model_output where mini_id = 3 and prev_flag = 1 and dt > timestamp '1997-01-01' and dt <= timestamp '1998-01-01') as basin_ahead""")
def ag14_area_summary(v):
    rain = v("obs_null").where("variable_code = 'rain' and station_id = 'ana:2'")
    basin = v("model_output").where("mini_id = 3")
    a = rain.agg(S.rainfall_total(rain, "observed_at", ts(START), ts(CUTOFF)).alias("station_past")).withColumn("k", F.lit(1))
    b = S.area_summary(rain, basin, ts("1996-01-01 00:00:00"), ts("1997-01-01 00:00:00"), ts("1998-01-01 00:00:00")).drop("station_past").withColumn("k", F.lit(1))
    return a.join(b, "k").drop("k")


@query("""select cast(dt as varchar) as dt, prev_flag, round(sum(value * mini_area) / sum(mini_area), 6) as value from model_output join mini using (mini_id) where scenario_id = 'scenario0' group by dt, prev_flag""")
def ag15_weighted_mean(v):
    weights = v("mini").select("mini_id", F.col("mini_area").alias("weight"))
    return S.weighted_mean(v("model_output").where("scenario_id = 'scenario0'"), weights)


@query("select station_id, state, cast(max(observed_at) as varchar) as latest from obs where variable_code in ('rain', 'flow') group by 1, 2")
def ag21_latest_observed(v):
    return O.latest_observed(v("obs"), ["rain", "flow"])


@query("""with f as (select station_id, count(*) filter (where variable_code = 'flow') as r, min(arrival_seq) % 5 = 0 as failed from obs group by 1)
    select count(*) filter (where not failed and r > 0) as ok, count(*) filter (where not failed and r = 0) as no_data, count(*) filter (where failed) as error, cast(coalesce(sum(r), 0) as bigint) as rows from f""")
def ag22_fetch_summary(v):
    return O.fetch_summary(v("obs").groupBy("station_id").agg(F.count_if(F.col("variable_code") == "flow").alias("rows"), (F.min("arrival_seq") % 5 == 0).alias("failed")))


@query("select o_custkey as mini_id, count(distinct o_orderstatus) as n from orders group by 1 having count(distinct o_orderstatus) <> 1")
def ag23_inconsistent_attributes(v):
    return S.inconsistent_attributes(v("orders").select(F.col("o_custkey").alias("mini_id"), "o_orderstatus"), "o_orderstatus")


# --- joins and windows over series -----------------------------------------------------------------------------


@query(f"with {PREFERRED} select series_id, station_id, variable_code, state, cast(created_at as varchar) as created_at from preferred")
def wn1_preferred_series(v):
    return S.preferred_series(v("series"))


@query(f"select s.series_id, cast(s.observed_at as varchar) as observed_at, round(s.value, 6) as value, station_id, variable_code from stored s join series using (series_id) where s.observed_at >= timestamp '{START}' and s.observed_at < timestamp '{CUTOFF}'")
def jo1_series_values(v):
    return S.values_of(v("series"), v("stored"), ts(START), ts(CUTOFF))


@query(f"with {PREFERRED} select series_id, cast(observed_at as varchar) as observed_at, round(value, 6) as value from stored where series_id in (select series_id from preferred)")
def jo2_preferred_values(v):
    return v("stored").join(S.preferred_series(v("series")).select("series_id"), "series_id", "left_semi")


@query("""select station_id, coalesce(kind, 'no_data') as kind from station left join (select station_id, case when bool_or(variable_code = 'rain') and bool_or(variable_code <> 'rain') then 'mixed' when bool_or(variable_code = 'rain') then 'rain' else 'level' end as kind from capability group by 1) using (station_id)""")
def jo3_station_chain(v):
    return v("station").select("station_id").join(S.kinds(v("capability")), "station_id", "left").fillna("no_data", ["kind"])


@query("select station_id, coalesce(string_agg(c.variable_code, ',' order by c.variable_code), '') as variables from station left join capability c using (station_id) group by 1")
def jo4_station_variables(v):
    return O.stations_with_variables(v("station").select("station_id"), v("capability")).withColumn("variables", F.array_join("variables", ","))


_DAYS = "select distinct station_id, variable_code, cast(observed_at as date) as day from obs_null where value is not null"
_CALENDAR = "select station_id, variable_code, cast(unnest(generate_series(timestamp '2024-01-05', timestamp '2024-01-25', interval '1' day)) as date) as day from capability"


@query(f"""with w as ({_CALENDAR}), h as ({_DAYS}) select station_id, cast(day as varchar) as day from (
    select station_id, day from w anti join h using (station_id, variable_code, day) union select station_id, date '2024-01-20' from capability)""")
def jo5_missing_days(v):
    return O.missing_days(v("capability"), O.observed_days(v("obs_null")), ts(START), ts(END), ts(CUTOFF))


@query("""with l as (select station_id, max(observed_at) as t from obs_null semi join capability using (station_id, variable_code) where value is not null group by 1), s as (
    select c.station_id, greatest(date '2024-01-05', coalesce(cast(t as date), date '2024-01-05')) as a from (select distinct station_id from capability) c left join l using (station_id))
    select station_id, cast(cast(unnest(generate_series(cast(a as timestamp), timestamp '2024-01-31', interval '1' day)) as date) as varchar) as day from s where a <= date '2024-01-31'""")
def jo6_resume_days(v):
    return O.resume_days(v("capability"), v("obs_null"), ts(START), ts("2024-01-31 00:00:00"))


@query("""with d as (select distinct station_id, cast(observed_at as date) as day from obs where arrival_seq % 3 <> 0), i as (
    select *, day - cast(row_number() over (partition by station_id order by day) as int) as island from d), p as (
    select *, (row_number() over (partition by station_id, island order by day) - 1) // 3 as part from i)
    select station_id, cast(min(day) as varchar) as start_day, cast(max(day) as varchar) as end_day from p group by station_id, island, part""")
def wn5_fetch_windows(v):
    return O.fetch_windows(v("obs").where("arrival_seq % 3 <> 0").select("station_id", F.to_date("observed_at").alias("day")), 3)


@query(f"with {OFFERED} select station_id, variable_code, cast(position as bigint) as position from station join offered using (provider_code) join capability using (station_id, variable_code)")
def jo21_common_variables(v):
    return O.common_variables(v("station"), offered(v), v("capability"))


@query(f"""with {OFFERED}, w as (select station_id, variable_code from station join offered using (provider_code) join capability using (station_id, variable_code)), h as ({_DAYS}), c as (
    select station_id, variable_code, cast(unnest(generate_series(timestamp '2024-01-05', timestamp '2024-01-25', interval '1' day)) as date) as day from w), g as (
    select station_id, day from c anti join h using (station_id, variable_code, day) union select station_id, date '2024-01-20' from w), i as (
    select *, day - cast(row_number() over (partition by station_id order by day) as int) as island from g), p as (
    select *, (row_number() over (partition by station_id, island order by day) - 1) // 5 as part from i)
    select station_id, cast(min(day) as varchar) as start_day, cast(max(day) as varchar) as end_day from p group by station_id, island, part""")
def pj2_fetch_plan(v):
    return O.plan_requests(v("station"), offered(v), v("capability"), v("obs_null"), ts(START), ts(END), ts(CUTOFF), 5)


_LEVEL_MODEL = "select scenario_id, 'level' as variable_code, mini_id, dt, value, prev_flag from model_output"


@query("""with m as (select scenario_id, dt, prev_flag, value from model_output where mini_id = 5), o as (select scenario_id, dt, max(value) + 7 as v from model_output where mini_id = 6 group by 1, 2),
    f as (select m.scenario_id, arg_max(o.v - m.value, m.dt) as off from m join o on m.scenario_id = o.scenario_id and m.dt = o.dt where m.prev_flag = 0 group by 1)
    select scenario_id, cast(dt as varchar) as dt, prev_flag, round(value + off, 6) as value from m join f using (scenario_id)""")
def jo10_level_offset(v):
    model = v("model_output").where("mini_id = 5").select("scenario_id", "dt", "prev_flag", "value")
    seen = v("model_output").where("mini_id = 6").groupBy("scenario_id", "dt").agg((F.max("value") + 7).alias("value")).withColumnRenamed("dt", "observed_at")
    return S.adjusted_level(model, seen, ["scenario_id"])


@query("select mini_id, case when count(*) = 1 then min(station_id) end as station_id, count(*) as n from (select station_id, user_id % 50 as mini_id from station) group by 1")
def jo15_mini_station(v):
    return S.mini_station(v("station").select("station_id", (F.col("user_id") % 50).alias("mini_id")))


@query("select scenario_id, variable_code, cast(dt as varchar) as dt, prev_flag, round(value, 6) as value from model_output where scenario_id in ('scenario0', 'scenario2') and mini_id = 7")
def jo19_scenario_comparison(v):
    return S.comparison_series(v("model_output"), ["scenario0", "scenario2"], 7)


@query(f"""with {PREFERRED}, a as (select station_id, sum(value) as rain from stored join preferred using (series_id) where variable_code = 'rain' and observed_at > timestamp '{START}' and observed_at <= timestamp '{CUTOFF}' and value is not null group by 1)
    select station_id, coalesce(printf('%.1f', floor(round(rain, 6) * 10) / 10), '-') as label from station left join a using (station_id)""")
def jo20_rainfall_labels(v):
    return S.rainfall_labels(v("station"), S.rainfall_accumulations(v("series"), v("stored"), ts(START), ts(CUTOFF)))


@query(f"with {PREFERRED} select variable_code, cast(observed_at as varchar) as observed_at, round(value, 6) as value from stored join preferred using (series_id) where station_id = 'ana:4' and observed_at >= timestamp '{START}' and observed_at <= timestamp '{CUTOFF}'")
def pj9_station_series(v):
    return S.observed_series(v("series"), v("stored"), "ana:4", ts(START), ts(CUTOFF))


@query("""with f as (select mini_id, arg_max(s.v - m.value, m.dt) as off from (select * from model_output where scenario_id = 'scenario0' and prev_flag = 0) m
        join (select mini_id, dt, max(value) + mini_id as v from model_output where scenario_id = 'scenario1' group by mini_id, dt) s using (mini_id, dt) where mini_id % 2 = 0 group by 1)
    select mini_id, cast(dt as varchar) as dt, prev_flag, round(value + off, 6) as value from model_output join f using (mini_id) where scenario_id = 'scenario0'""")
def pj10_adjusted_levels(v):
    out = v("model_output")
    model = out.where("scenario_id = 'scenario0'").withColumn("variable_code", F.lit("level"))
    pairs = out.where("scenario_id = 'scenario1'")
    stations = v("mini").where("mini_id % 2 = 0").select("mini_id", F.concat(F.lit("s"), F.col("mini_id").cast("string")).alias("station_id"))
    named = pairs.join(stations, "mini_id")
    series = named.select("station_id").distinct().select(F.concat("station_id", F.lit(".level.raw")).alias("series_id"), "station_id", F.lit("level").alias("variable_code"), F.lit("raw").alias("state"), F.lit(None).cast("timestamp_ntz").alias("created_at"))
    stored = named.groupBy("station_id", "mini_id", F.col("dt").alias("observed_at")).agg(F.max("value").alias("value")).select(F.concat("station_id", F.lit(".level.raw")).alias("series_id"), "observed_at", (F.col("value") + F.col("mini_id")).alias("value"))
    return jobs.level_of_minis(model, stations, series, stored)


@query(f"select distinct concat(station_id, '.', variable_code, '.', state) as series_id, cast({BUCKET.format('observed_at')} as varchar) as observed_at, round(case variable_code when 'rain' then sum(value) else avg(value) end, 6) as value from obs_null where value is not null group by station_id, variable_code, state, {BUCKET.format('observed_at')}")
def pj1_ingest(v):
    return jobs.ingest(v("obs_null"), 3)[1]


@query("""select station_id, reference_type, round(level_cm, 6) as level_cm, cast(event_date as varchar) as event_date, row_number() over (partition by station_id order by rk, event_date nulls last, level_cm) as place from (
    select cast(s_suppkey as varchar) as station_id, t as reference_type, s_acctbal + i as level_cm, cast(null as date) as event_date, i as rk from supplier cross join (values ('level_atention', 1), ('level_alert', 2), ('level_flood', 3), ('level_severe', 4)) k(t, i)
    union all select cast(l_suppkey as varchar), 'flood_record', max(l_extendedprice), cast(l_shipdate as date), 5 from lineitem where l_quantity = 50 group by l_suppkey, cast(l_shipdate as date))""")
def so1_reference_levels(v):
    kinds = F.posexplode(F.array(*map(F.lit, S.REFERENCE_TYPES))).alias("i", "reference_type")
    alerts = v("supplier").select(F.col("s_suppkey").cast("string").alias("station_id"), "s_acctbal", kinds).select("station_id", "reference_type", (F.col("s_acctbal") + F.col("i") + 1).alias("level_cm"))
    floods = v("lineitem").where("l_quantity = 50").groupBy(F.col("l_suppkey").cast("string").alias("station_id"), F.to_date("l_shipdate").alias("event_date")).agg(F.max("l_extendedprice").alias("level_cm"))
    return S.reference_levels(alerts, floods)


@query("select reference_type, round(level_cm, 6) as level_cm, cast(event_date as varchar) as event_date, row_number() over (order by rk, event_date nulls last, level_cm) as place from (select t as reference_type, s_acctbal + i as level_cm, cast(null as date) as event_date, i as rk from supplier cross join (values ('level_atention', 1), ('level_alert', 2), ('level_flood', 3), ('level_severe', 4)) k(t, i) where s_suppkey = 7 union all select 'flood_record', max(l_extendedprice), cast(l_shipdate as date), 5 from lineitem where l_suppkey = 7 and l_quantity = 50 group by cast(l_shipdate as date))")
def sl3_levels_of_a_station(v):
    kinds = F.posexplode(F.array(*map(F.lit, S.REFERENCE_TYPES))).alias("i", "reference_type")
    alerts = v("supplier").select(F.col("s_suppkey").cast("string").alias("station_id"), "s_acctbal", kinds).select("station_id", "reference_type", (F.col("s_acctbal") + F.col("i") + 1).alias("level_cm"))
    floods = v("lineitem").where("l_quantity = 50").groupBy(F.col("l_suppkey").cast("string").alias("station_id"), F.to_date("l_shipdate").alias("event_date")).agg(F.max("l_extendedprice").alias("level_cm"))
    return S.reference_levels(alerts, floods, F.lit("7")).drop("station_id")


@query("select scenario_id, mini_id, cast(dt as varchar) as dt, row_number() over (partition by scenario_id order by variable_code, mini_id, dt) as place from model_output")
def sl5_output_order(v):
    return S.in_order(v("model_output"), ["scenario_id"], ["variable_code", "mini_id", "dt"]).select("scenario_id", "mini_id", "dt", "place")


@query("select provider_code, station_id, row_number() over (partition by provider_code order by station_code) as place from station")
def sl5_station_order(v):
    return S.in_order(v("station"), ["provider_code"], ["station_code"]).select("provider_code", "station_id", "place")


@query("select station_id, variable_code, cast(max(observed_at) as varchar) as latest from obs where value is not null group by 1, 2")
def sl1_latest_one(v):
    from .sources.scans import latest_rows

    return latest_rows(v("obs").where("value is not null").dropDuplicates(["station_id", "variable_code", "observed_at"]), ["station_id", "variable_code"], "observed_at").select("station_id", "variable_code", F.col("observed_at").alias("latest"))


@query("select station_id, variable_code, round(arg_max(value, arrival_seq), 6) as value from obs_null where value is not null group by 1, 2")
def sl2_last_valid_value(v):
    return v("obs_null").where("value is not null").groupBy("station_id", "variable_code").agg(F.max_by("value", "arrival_seq").alias("value"))


@query("select station_id from station where station_id not in (select station_id from capability where variable_code = 'flow')")
def so3_difference(v):
    return v("station").select("station_id").subtract(v("capability").where("variable_code = 'flow'").select("station_id"))


@query("select distinct station_id, variable_code from obs where value > 50")
def so4_distinct_rows(v):
    return v("obs").where("value > 50").select("station_id", "variable_code").dropDuplicates()


@query("select provider_code, station_id, lat, lon from station where provider_code = 'ana' union all select provider_code, station_id, lat, lon from station where provider_code = 'inmet'")
def so6_union_of_providers(v):
    parts = [v("station").where(F.col("provider_code") == p).select("provider_code", "station_id", "lat", "lon") for p in ("ana", "inmet")]
    return parts[0].unionByName(parts[1])


# --- time functions --------------------------------------------------------------------------------------------


@query(f"select arrival_seq, cast({BUCKET.format('observed_at')} as varchar) as bucket_end from obs")
def df3_bucket_end(v):
    return v("obs").select("arrival_seq", D.bucket_end(F.col("observed_at"), 3).alias("bucket_end"))


@query("select count(*) as n, cast(min(observed_at) as varchar) as first from (select date_trunc('hour', observed_at) as observed_at from obs) where extract(hour from observed_at) % 3 <> 0")
def df4_misaligned(v):
    return D.misaligned(v("obs").select(F.date_trunc("hour", "observed_at").cast("timestamp_ntz").alias("observed_at")), "observed_at", 3)


@query("select arrival_seq, cast(date_trunc('minute', observed_at) + interval '3' hour as varchar) as utc, cast(date_trunc('minute', observed_at) as varchar) as back from obs")
def df5_zones(v):
    local = D.minute(F.col("observed_at"))
    return v("obs").select("arrival_seq", D.local_to_utc(local).alias("utc"), D.utc_to_local(D.local_to_utc(local)).alias("back"))


@query("select arrival_seq, cast(date_trunc('day', observed_at) + (extract(hour from observed_at) // 6) * interval '6' hour as varchar) as cycle, cast(case when extract(hour from observed_at) >= 12 then date_trunc('day', observed_at) + interval '12' hour else date_trunc('day', observed_at) - interval '12' hour end as varchar) as noon from obs")
def df6_forecast_cycle(v):
    return v("obs").select("arrival_seq", D.forecast_cycle(F.col("observed_at")).alias("cycle"), D.forecast_cycle(F.col("observed_at"), (12,)).alias("noon"))


@query("select arrival_seq, i as rank, cast(date_trunc('day', observed_at) + (extract(hour from observed_at) // 6 - i) * interval '6' hour as varchar) as candidate from (select * from obs) cross join range(5) r(i)")
def df7_cycle_candidates(v):
    rows = v("obs").select("arrival_seq", D.forecast_cycle(F.col("observed_at")).alias("cycle"))
    return D.cycle_candidates(rows, "cycle", 5).select("arrival_seq", "rank", "candidate")


@query("""select arrival_seq, cast(date_trunc('day', observed_at) - interval '2' day as varchar) as start_time, cast(date_trunc('hour', observed_at) + interval '1' hour as varchar) as forecast_start,
    cast(date_trunc('hour', observed_at) + interval '49' hour as varchar) as end_time, cast(date_diff('hour', date_trunc('day', observed_at) - interval '2' day, date_trunc('hour', observed_at) + interval '49' hour) + 1 as bigint) as nt, cast(49 as bigint) as forecast_nt from obs""")
def df8_horizon_window(v):
    return v("obs").select("arrival_seq", *D.horizon_window(F.date_trunc("hour", "observed_at").cast("timestamp_ntz"), 2, 2, 1))


@query("select arrival_seq, cast(date_trunc('day', observed_at) - interval '28' day as varchar) as start_time, cast(observed_at as varchar) as cutoff_time, cast(date_trunc('day', observed_at) + interval '15' day as varchar) as forecast_end from (select arrival_seq, date_trunc('minute', observed_at) as observed_at from obs)")
def df9_analysis_window(v):
    return v("obs").select("arrival_seq", *D.analysis_window(D.minute(F.col("observed_at")), 28, 14))


@query("""select arrival_seq, cast(greatest(ceil(date_diff('second', timestamp '2024-01-03', date_trunc('minute', observed_at)) / 10800), 0) as bigint) as row_first,
    cast(greatest(least(ceil(date_diff('second', timestamp '2024-01-03', date_trunc('minute', observed_at) + interval '50' hour) / 10800), 200), greatest(ceil(date_diff('second', timestamp '2024-01-03', date_trunc('minute', observed_at)) / 10800), 0)) as bigint) as row_after from obs""")
def df10_row_bounds(v):
    t = D.minute(F.col("observed_at"))
    return v("obs").select("arrival_seq", *D.row_bounds(ts("2024-01-03 00:00:00"), t, D.plus_hours(t, 50), 3, F.lit(200)))


@query("select l_orderkey, l_linenumber, cast(timestamp '2024-01-01' + (l_partkey % 100) * interval '1' hour as varchar) as dt, case when l_partkey % 100 < 41 then 0 else 1 end as time_segment from lineitem")
def df11_segments(v):
    rows = v("lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 100).alias("t"))
    return D.segments(rows, "t", ts("2024-01-01 00:00:00"), ts("2024-01-02 16:00:00"), 1).drop("t")


@query("""select station_id, cast(cast(unnest(generate_series(cast(greatest(date '2024-01-05', cast(max(observed_at) as date)) as timestamp), timestamp '2024-02-02', interval '1' day)) as date) as varchar) as day from obs where variable_code = 'flow' group by station_id""")
def df12_request_days(v):
    latest = v("obs").where("variable_code = 'flow'").groupBy("station_id").agg(F.max("observed_at").alias("t"))
    return latest.select("station_id", F.explode(D.request_days(ts(START), ts("2024-02-02 00:00:00"), F.col("t"))).alias("day"))


@query("select distinct station_id, variable_code, cast(cast(observed_at as date) as varchar) as day from obs_null where value is not null")
def df13_observed_days(v):
    return O.observed_days(v("obs_null"))


_STAMPS = "select arrival_seq, case arrival_seq % 5 when 0 then strftime(observed_at, '%Y-%m-%dT%H:%M:%SZ') when 1 then strftime(observed_at, '%Y-%m-%d %H:%M') when 2 then strftime(observed_at, '%Y-%m-%dT%H:%M:%S-03:00') when 3 then strftime(observed_at, '%Y-%m-%d %H:%M:%S') else 'not a time' end as t, observed_at from obs"


def stamps(v):
    t = F.col("observed_at")
    m = F.col("arrival_seq") % 5
    text = F.when(m == 0, F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(m == 1, F.date_format(t, "yyyy-MM-dd HH:mm")).when(m == 2, F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-03:00"))).when(m == 3, F.date_format(t, "yyyy-MM-dd HH:mm:ss")).otherwise("not a time")
    return v("obs").select("arrival_seq", text.alias("t"))


@query("select arrival_seq, cast(date_trunc('minute', case arrival_seq % 5 when 0 then observed_at - interval '3' hour when 4 then null else observed_at end) as varchar) as local from obs")
def df1_parse_observed(v):
    return stamps(v).select("arrival_seq", D.parse_observed(F.col("t")).alias("local"))


@query("select arrival_seq, cast(date_trunc('minute', case arrival_seq % 2 when 0 then observed_at - interval '3' hour else observed_at end) as varchar) as local from obs")
def df2_parse_provider(v):
    t = F.col("observed_at")
    text = F.when(F.col("arrival_seq") % 2 == 0, F.unix_millis(t.cast("timestamp")).cast("string")).otherwise(F.date_format(t, "dd/MM/yyyy HH:mm"))
    return v("obs").select("arrival_seq", D.parse_provider(text).alias("local"))


@query("select arrival_seq, cast(date_trunc('second', case arrival_seq % 5 when 1 then date_trunc('minute', observed_at) when 2 then observed_at + interval '3' hour when 4 then null else observed_at end) as varchar) as utc from obs")
def df14_naive_utc(v):
    return stamps(v).select("arrival_seq", D.to_naive_utc(F.col("t")).alias("utc"))


@query("select station_id, cast(cast(unnest(generate_series(cast(max(observed_at) as date)::timestamp - interval '6' day, cast(max(observed_at) as date)::timestamp, interval '1' day)) as date) as varchar) as day from obs group by station_id")
def df15_last_days(v):
    return v("obs").groupBy("station_id").agg(F.max("observed_at").alias("t")).select("station_id", F.explode(D.last_days(F.col("t"), 7)).alias("day"))


# --- text and numbers ------------------------------------------------------------------------------------------


@query("select c_custkey, coalesce(nullif(ltrim(upper(trim(concat(' 00', c_custkey % 50, 'a '))), '0'), ''), '0') as code, upper(trim(concat(' 00', c_custkey % 50, 'a '))) as kept from customer")
def sf1_station_code(v):
    raw = F.concat(F.lit(" 00"), (F.col("c_custkey") % 50).cast("string"), F.lit("a "))
    return v("customer").select("c_custkey", T.station_code(raw).alias("code"), T.station_code(raw, strip_zeros=False).alias("kept"))


@query("select station_id, upper(concat('Estacao ', station_code)) as name from station")
def sf2_station_name(v):
    return v("station").select("station_id", T.station_name(F.col("station_name")).alias("name"))


@query("select station_id, concat('LJUBLJANA CZ FINO 12 ', station_code) as name from station")
def sf2_marks_and_ligatures(v):
    """Marks of other languages, letters that decompose into several, and what has no ASCII at all."""
    return v("station").select("station_id", T.station_name(F.concat(F.lit("ǈubljana Čž ﬁnõ ⑫ "), F.col("station_code"), F.lit(" 中"))).alias("name")).withColumn("name", F.rtrim("name"))


@query("select distinct concat(station_id, '.', variable_code, '.', state) as series_id, concat(split_part(station_id, ':', 1), ':', split_part(station_id, ':', 2)) as station_id from obs")
def sf3_ids(v):
    p = F.split("station_id", ":")
    return v("obs").select(T.series_id(F.col("station_id"), F.col("variable_code"), F.col("state")).alias("series_id"), T.station_id(p[0], p[1]).alias("station_id")).distinct()


@query("select o_orderkey, case when o_orderkey % 6 = 0 then null else o_custkey * 1000 + 7 end as n from orders")
def sf4_nullable_int(v):
    text = F.when(F.col("o_orderkey") % 6 == 0, "").otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit(",007")))
    return v("orders").select("o_orderkey", T.nullable_int(text).alias("n"))


@query("select c_custkey, round((case when c_custkey % 2 = 0 then -1 else 1 end) * (c_custkey % 90 + 0.1234), 6) as coordinate from customer")
def sf5_coordinate(v):
    text = F.concat(F.when(F.col("c_custkey") % 2 == 0, "-").otherwise(""), (F.col("c_custkey") % 90).cast("string"), F.lit(".12349"))
    return v("customer").select("c_custkey", T.coordinate(text).alias("coordinate"))


@query("select l_orderkey, l_linenumber, l_partkey, case when l_orderkey % 5 = 0 then null else round(l_quantity, 6) end as x from lineitem")
def sf6_decimal_comma(v):
    text = F.when(F.col("l_orderkey") % 5 == 0, " - ").otherwise(F.concat(F.lit(" "), F.regexp_replace(F.col("l_quantity").cast("string"), r"\.", ",")))
    return v("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", T.decimal_comma(text).alias("x"))


@query("select c_nationkey, string_agg(distinct lower(c_mktsegment), ',' order by lower(c_mktsegment)) as names from customer group by 1")
def sf7_providers(v):
    rows = v("customer").groupBy("c_nationkey").agg(F.collect_set("c_mktsegment").alias("a"))
    return rows.select("c_nationkey", F.array_join(T.providers(F.concat("a", F.array(F.lit(" "), F.lit("")))), ",").alias("names"))


@query("select o_orderkey, concat('ecmwf.ifs.oper.', strftime(o_orderdate, '%Y%m%d%H'), '.precipitation_grid') as asset_id from orders")
def sf8_asset_id(v):
    return v("orders").select("o_orderkey", T.asset_id(F.lit("ecmwf"), F.lit("ifs"), F.lit("oper"), F.col("o_orderdate")).alias("asset_id"))


@query("select arrival_seq, concat('+', arrival_seq % 48, 'h ', strftime(observed_at - interval '3' hour, '%d/%m %H:%M')) as label from obs")
def sf9_step_label(v):
    return v("obs").select("arrival_seq", T.step_label(F.col("observed_at"), F.col("arrival_seq") % 48).alias("label"))


@query("select c_custkey, round(case when c_acctbal < 0 then ceil(c_acctbal * 10) else floor(c_acctbal * 10) end / 10, 6) + 0.0 as cut from customer")
def mf1_one_decimal(v):
    return v("customer").select("c_custkey", T.one_decimal(F.col("c_acctbal")).alias("cut"))


@query("select arrival_seq, round(case when variable_code = 'level' then value * 100 else value end, 6) as value from obs_null")
def mf2_centimetres(v):
    return v("obs_null").select("arrival_seq", T.to_centimetres(F.col("value"), F.col("variable_code")).alias("value"))


@query("select c_custkey, round(greatest(c_acctbal * 1.5, 0), 6) as value from customer")
def mf3_multiply(v):
    return v("customer").select("c_custkey", T.multiplied(F.col("c_acctbal"), F.lit(1.5)).alias("value"))


@query("""select c_custkey, round(w - 2 * dx, 6) as west, round(s - 2 * dy, 6) as south, round(w + 3 * dx, 6) as east, round(s + 3 * dy, 6) as north,
    w - 2 * dx >= -180 and w + 3 * dx <= 180 and s - 2 * dy >= -90 and s + 3 * dy <= 90 as valid from (select c_custkey, -180.0 + c_custkey % 350 as w, -80.0 + c_custkey % 150 as s, 1.0 + c_custkey % 7 as dx, 1.0 + c_custkey % 5 as dy from customer)""")
def mf4_buffered_box(v):
    k = F.col("c_custkey")
    w, s, dx, dy = k % 350 - 180.0, k % 150 - 80.0, k % 7 + 1.0, k % 5 + 1.0
    return v("customer").select("c_custkey", *T.buffered_box(w, s, w + dx, s + dy, 2.0))


@query("select event_id, cast(json_extract(props, '$.k') as bigint) as k from events")
def mf5_json_fields(v):
    return v("events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))
