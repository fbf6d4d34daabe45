"""The engine's tables as views of the star-schema tables, in SQL that Spark and DuckDB both take.

``view(spark, folder, name)`` is the Spark side; ``with_views(names, body)`` puts the same text before an oracle query.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

VIEWS: dict[str, str] = {
    "obs": """
        select concat(case when user_id % 2 = 0 then 'ana' else 'inmet' end, ':', cast(user_id as string)) as station_id,
               case event_type when 'view' then 'rain' when 'click' then 'rain' when 'purchase' then 'flow' else 'level' end as variable_code,
               case event_id % 3 when 0 then 'raw' when 1 then 'curated' else 'approved' end as state,
               ts as observed_at, value, event_id as arrival_seq
        from events""",
    "obs_null": """
        select station_id, variable_code, state, observed_at, case when arrival_seq % 20 = 0 then null else value end as value, arrival_seq
        from obs""",
    "station": """
        select concat(case when user_id % 2 = 0 then 'ana' else 'inmet' end, ':', cast(user_id as string)) as station_id,
               case when user_id % 2 = 0 then 'ana' else 'inmet' end as provider_code, cast(user_id as string) as station_code,
               concat('Estação ', cast(user_id as string)) as station_name, user_id, user_id + 1 as mini_id,
               -31.0e0 + (user_id % 13) * 0.2e0 as lat, -54.0e0 + (user_id % 17) * 0.25e0 as lon
        from (select distinct user_id from events) u""",
    "series": """
        select concat(station_id, '.', variable_code, '.', state) as series_id, station_id, variable_code, state, min(observed_at) as created_at
        from obs group by station_id, variable_code, state""",
    "stored": """
        select concat(station_id, '.', variable_code, '.', state) as series_id, date_trunc('minute', observed_at) as observed_at, max(value) as value
        from obs_null group by station_id, variable_code, state, date_trunc('minute', observed_at)""",
    "capability": "select distinct station_id, variable_code from obs where arrival_seq % 4 = 0",
    "mini": """
        select c_custkey + 1 as mini_id, cast(floor((c_custkey + 1) / 2) as bigint) as mini_jus, 1.0e0 + c_custkey % 7 as mini_area,
               -30.9e0 + (c_custkey % 11) * 0.21e0 as lat, -53.9e0 + (c_custkey % 19) * 0.23e0 as lon
        from customer""",
    "model_output": """
        select concat('scenario', cast(o_orderkey % 3 as string)) as scenario_id, 'precipitation' as variable_code, o_custkey % 40 + 1 as mini_id,
               date_trunc('day', o_orderdate) as dt, sum(o_totalprice) as value,
               case when date_trunc('day', o_orderdate) > timestamp '1997-01-01 00:00:00' then 1 else 0 end as prev_flag
        from orders group by o_orderkey % 3, o_custkey % 40 + 1, date_trunc('day', o_orderdate)""",
    "message": """
        select concat('asset', cast(p_partkey % 2 as string)) as asset_id, cast(p_partkey % 50 as int) as iy, cast(floor(p_partkey / 50) as int) as ix,
               -33.0e0 + (p_partkey % 50) * 0.25e0 as lat, -55.0e0 + floor(p_partkey / 50) * 0.25e0 as lon, st.step_hours, st.valid_time,
               cast(p_size * (st.step_hours / 3) - (p_partkey % 3) * (st.step_hours % 2) * 5 as double) as value
        from part cross join (values (3, timestamp '2026-03-18 03:00:00'), (6, timestamp '2026-03-18 06:00:00'),
                                     (9, timestamp '2026-03-18 09:00:00'), (12, timestamp '2026-03-18 12:00:00')) st(step_hours, valid_time)""",
    "cell": """
        select asset_id, case step_hours when 3 then timestamp '2026-03-18 00:00:00' when 6 then timestamp '2026-03-18 03:00:00'
                                         when 9 then timestamp '2026-03-18 06:00:00' else timestamp '2026-03-18 09:00:00' end as start_utc,
               valid_time as end_utc, iy, ix, lat, lon, case when (iy + ix + step_hours) % 29 = 0 then null else abs(value) % 7 end as value
        from message""",
    "asset": """
        select concat(case o_orderkey % 2 when 0 then 'ecmwf' else 'noaa' end, '.', cast(o_orderkey as string)) as asset_id,
               case when o_orderkey % 11 = 0 then 'observed_grid' else 'forecast_grid' end as asset_kind, 'grid' as format,
               concat('grids/', cast(o_orderkey as string)) as relative_path,
               case o_orderkey % 2 when 0 then 'ecmwf' else 'noaa' end as provider_code, cast(o_custkey as string) as checksum,
               case o_orderkey % 4 when 0 then date_trunc('day', o_orderdate) when 1 then date_trunc('day', o_orderdate) + interval '6' hour
                                   when 2 then date_trunc('day', o_orderdate) + interval '12' hour else date_trunc('day', o_orderdate) + interval '18' hour end as valid_from,
               date_trunc('day', o_orderdate) + interval '10' day as valid_to, o_orderdate as created_at
        from orders""",
    "edit": """
        select concat(cast(l_orderkey as string), '-', cast(l_linenumber as string), '-', cast(l_partkey as string)) as manual_edit_id,
               concat(case l_orderkey % 2 when 0 then 'ecmwf' else 'noaa' end, '.', cast(l_orderkey as string)) as asset_id,
               cast(l_linenumber * 6 as int) as t0_step, cast(l_linenumber * 6 + l_quantity % 9 as int) as t1_step, cast(l_partkey % 3 as double) - 1 as shift_lat,
               cast(l_suppkey % 3 as double) - 1 as shift_lon, 0.0e0 as rotation_deg, l_discount * 10 as multiplication_factor,
               case when l_tax = 0 then null else 'adjusted' end as reason
        from lineitem""",
}

_NAMES = re.compile(r"\b(from|join)\s+(\w+)", re.I)


def _used(sql: str) -> list[str]:
    return sorted({m[2] for m in _NAMES.finditer(sql) if m[2] in VIEWS or m[2] in BASE})


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The view as a DataFrame; times without a zone, whatever a literal was."""
    if name in BASE:
        return read(spark, folder, name)
    sql = VIEWS[name]
    used = {n: view(spark, folder, n) for n in _used(sql)}
    text = _NAMES.sub(lambda m: f"{m[1]} {{{m[2]}}}" if m[2] in used else m[0], sql)
    df = spark.sql(text, **used)
    return df.select(*(F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes))


def with_views(body: str) -> str:
    """``body`` after the views that it names, as one DuckDB query."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in VIEWS and name not in order:
            for other in _used(VIEWS[name]):
                add(other)
            order.append(name)

    for name in _used(body):
        add(name)
    if not order:
        return body.strip()
    text = ", ".join(f"{n} as ({VIEWS[n].strip()})" for n in order)
    stripped = body.strip()
    if stripped.lower().startswith("with recursive "):
        return f"with recursive {text}, {stripped[15:]}"
    return f"with {text}, {stripped[5:]}" if stripped.lower().startswith("with ") else f"with {text} {stripped}"
