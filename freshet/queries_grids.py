"""Queries over grids and networks."""

from __future__ import annotations

from pyspark.sql import functions as F

from .operators import grids as G
from .operators import network as N
from .plans import jobs
from .queries import query, ts
from .sources.scratch import materialise

CYCLE = "2026-03-18 00:00:00"
#: A grid of half a degree over the box of the stations, in SQL.
GRID_SQL = """box0 as (select min(lat) as s, max(lat) as n, min(lon) as w, max(lon) as e from station), tall0 as (select *, unnest(range(cast(greatest(ceil(round((n - s) / 0.5 - 0.5, 9)), 1) as int))) as iy from box0),
    grid as (select iy, ix, s + 0.25 + iy * 0.5 as lat, w + 0.25 + ix * 0.5 as lon from (select *, unnest(range(cast(greatest(ceil(round((e - w) / 0.5 - 0.5, 9)), 1) as int))) as ix from tall0))"""
INTERVALS = """intervals as (select asset_id, iy, ix, lat, lon, coalesce(lag(valid_time) over w, timestamp '2026-03-18') as start_utc, valid_time as end_utc,
    greatest(value - lag(value, 1, 0.0) over w, 0.0) as value from message window w as (partition by asset_id, iy, ix order by valid_time))"""
KNN = """knn as (select * from (select t.target_id, s.source_id, sqrt(pow(t.lat - s.lat, 2) + pow(t.lon - s.lon, 2)) as d,
    row_number() over (partition by t.target_id order by sqrt(pow(t.lat - s.lat, 2) + pow(t.lon - s.lon, 2)), s.source_id) as place from t, s) where place <= {k})"""
ORIGIN, STEP = (-33.0, -55.0), 0.25


def one(v):
    """A table of one row, made from a table that is there."""
    return v("region").agg(F.count("*").alias("n"))


def days(v, name, after=0):
    """A row for each day with or between days with rain; or for each of the days ``after`` them."""
    span = v("obs_null").where("variable_code = 'rain' and value is not null").agg(F.to_date(F.min("observed_at")).alias("a"), F.to_date(F.max("observed_at")).alias("z"))
    edges = (F.date_add("z", 1), F.date_add("z", after)) if after else (F.col("a"), F.col("z"))
    rows = span.select(F.explode(F.sequence(*edges)).alias("day"))
    return rows.select(F.col("day").cast("timestamp_ntz").alias(name))


SPAN = "span as (select date_trunc('day', min(observed_at)) as a, date_trunc('day', max(observed_at)) as z from obs_null where variable_code = 'rain' and value is not null)"
DAYS = "select unnest(generate_series((select cast(a as timestamp) from span), (select cast(z as timestamp) from span), interval '1' day)) as dt"


def messages(v):
    return v("message").withColumn("start_step_hours", F.lit(0))


def station_grid(v):
    """A grid of half a degree over the box of the stations."""
    box = v("station").agg(F.min("lon").alias("west"), F.min("lat").alias("south"), F.max("lon").alias("east"), F.max("lat").alias("north"))
    return G.grids_of(box.withColumn("asset_id", F.lit("stations")), 0.5).drop("asset_id")


def points(v):
    return v("mini").select(F.col("mini_id").alias("target_id"), "lat", "lon")


def samples(v):
    """One value for each station, some missing."""
    mean = v("obs").where("variable_code = 'rain'").groupBy("station_id").agg(F.avg("value").alias("value"))
    return v("station").join(mean, "station_id").select(F.col("station_id").alias("source_id"), "lat", "lon", F.when(F.col("user_id") % 9 != 0, F.col("value")).alias("value"))


SAMPLES = "samples as (select station_id as source_id, lat, lon, case when user_id % 9 <> 0 then v end as value from station join (select station_id, avg(value) as v from obs where variable_code = 'rain' group by 1) using (station_id))"


@query("""with b as (select asset_id, min(lat) - 0.125 as south, max(lat) + 0.125 as north, min(lon) - 0.125 as west, max(lon) + 0.125 as east from cell group by 1),
    n as (select *, cast(greatest(ceil(round((north - south) / 0.5 - 0.5, 9)), 1) as int) as ny, cast(greatest(ceil(round((east - west) / 0.5 - 0.5, 9)), 1) as int) as nx from b)
    select asset_id, iy, ix, round(south + 0.25 + iy * 0.5, 6) as lat, round(west + 0.25 + ix * 0.5, 6) as lon from (select *, unnest(range(ny)) as iy from n) y, lateral (select unnest(range(nx)) as ix) x""")
def gr1_regular_grid(v):
    """A grid of half a degree over the box of each asset."""
    return G.grids_of(G.native_resolution(v("cell")).select("asset_id", "west", "south", "east", "north"), 0.5)


@query(f"with {INTERVALS} select asset_id, iy, ix, round(lat, 6) as lat, round(lon, 6) as lon, cast(start_utc as varchar) as start_utc, cast(end_utc as varchar) as end_utc, round(value, 6) as value from intervals")
def wn2_interval_totals(v):
    return G.interval_totals(v("message"), ts(CYCLE))


@query(f"with {INTERVALS} select asset_id, iy, ix, round(lat, 6) as lat, round(lon, 6) as lon, cast(start_utc + h * interval '1' hour as varchar) as start_utc, cast(start_utc + (h + 1) * interval '1' hour as varchar) as end_utc, round(value / 3, 6) as value from intervals, range(3) r(h)")
def wn3_hourly_rates(v):
    return G.hourly_rates(v("message"), ts(CYCLE))


@query("""with c as (select *, lag(end_utc) over (partition by asset_id order by start_utc) as last from (select distinct asset_id, start_utc, end_utc from cell where asset_id = 'asset0' or end_utc <> timestamp '2026-03-18 06:00:00'))
    select asset_id, count(*) as intervals, count(*) filter (where last <> start_utc) as gaps from c group by 1""")
def wn4_contiguity(v):
    return G.gaps(v("cell").where("asset_id = 'asset0' or end_utc <> timestamp_ntz '2026-03-18 06:00:00'"))


@query("select asset_id, row_number() over (partition by asset_id order by start_utc) - 1 as position, date_diff('hour', timestamp '2026-03-18', start_utc) as start_step, date_diff('hour', timestamp '2026-03-18', end_utc) as end_step, cast(start_utc as varchar) as start_utc, cast(end_utc as varchar) as end_utc from (select distinct asset_id, start_utc, end_utc from cell)")
def wn8_interval_steps(v):
    return G.interval_steps(v("cell"))


@query("select distinct asset_id, cast(timestamp '2026-03-18' + h * interval '1' hour as varchar) as at, cast(h as bigint) as step from cell, (values (3), (6), (9)) t(h)")
def wn9_forecast_steps(v):
    return G.forecast_steps(v("cell"), ts("2026-03-18 01:00:00"), ts("2026-03-18 12:00:00"))


@query("select asset_id, iy, ix, round(lat, 6) as lat, round(lon, 6) as lon, round(coalesce(sum(value), 0), 6) as value from cell where start_utc >= timestamp '2026-03-18 03:00:00' and end_utc <= timestamp '2026-03-18 09:00:00' group by all")
def ag16_forecast_accumulation(v):
    return G.forecast_accumulation(v("cell"), ts("2026-03-18 03:00:00"), ts("2026-03-18 09:00:00"))


@query("select asset_id, iy, ix, round(lat, 6) as lat, round(lon, 6) as lon, round(sum(value), 6) as value from cell where start_utc >= timestamp '2026-03-18 03:00:00' and end_utc <= timestamp '2026-03-18 12:00:00' group by all")
def ag17_covered_accumulation(v):
    return G.covered_accumulation(v("cell"), ts("2026-03-18 03:00:00"), ts("2026-03-18 12:00:00"))


@query("""with h as (select station_id as key, date_trunc('hour', observed_at) as dt, sum(value) as value from obs where variable_code = 'rain' group by 1, 2), n as (select *, (row_number() over (partition by key order by dt) - 1) // 3 as part from h)
    select key, cast(max(dt) as varchar) as dt, round(sum(value), 6) as value from n group by key, part having count(*) = 3""")
def ag18_to_timestep(v):
    hourly = v("obs").where("variable_code = 'rain'").groupBy(F.col("station_id").alias("key"), F.date_trunc("hour", "observed_at").cast("timestamp_ntz").alias("dt")).agg(F.sum("value").alias("value"))
    return G.to_timestep(hourly, 3)


@query(f"""with {SPAN}, o as (select station_id, date_trunc('day', observed_at) as dt, sum(value) as value from obs_null where variable_code = 'rain' and value is not null group by 1, 2), a as ({DAYS})
    select s.station_id, cast(a.dt as varchar) as dt, round(coalesce(o.value, 0), 6) as value from (select distinct station_id from o) s cross join a left join o on o.station_id = s.station_id and o.dt = a.dt""")
def ag19_station_matrix(v):
    rain = v("obs_null").where("variable_code = 'rain'").withColumn("observed_at", F.date_trunc("day", "observed_at").cast("timestamp_ntz"))
    return G.station_matrix(rain, days(v, "dt"))


@query("select round(quantile_cont(value, 0.05), 6) as low, round(quantile_cont(value, 0.95), 6) as high from cell")
def ag20_legend_range(v):
    return G.legend_range(v("cell"))


@query("""with a as (select asset_id, lon - lag(lon) over (partition by asset_id order by lon) as step from (select distinct asset_id, lon from cell)), r as (select asset_id, median(step) as r from a group by 1)
    select asset_id, round(r, 6) as resolution, round(min(lon) - r / 2, 6) as west, round(min(lat) - r / 2, 6) as south, round(max(lon) + r / 2, 6) as east, round(max(lat) + r / 2, 6) as north from cell join r using (asset_id) group by asset_id, r""")
def ag24_native_resolution(v):
    return G.native_resolution(v("cell"))


@query("select asset_id, cast(min(valid_time) as varchar) as first_valid, cast(max(valid_time) as varchar) as last_valid from message group by 1")
def ag25_valid_bounds(v):
    return G.valid_bounds(v("message"))


@query(f"with t as (select mini_id as target_id, lat, lon from mini), s as (select station_id as source_id, lat, lon from station), {KNN.format(k=5)} select target_id, source_id, round(d, 6) as distance, place from knn")
def jo16_nearest(v):
    return G.nearest(points(v), v("station").select(F.col("station_id").alias("source_id"), "lat", "lon"), 5)


@query(f"with {SAMPLES}, t as (select mini_id as target_id, lat, lon from mini), s as (select * from samples where value is not null), {KNN.format(k=1)} select target_id, source_id, place from knn")
def wn6_nearest_rank(v):
    return G.nearest(points(v), samples(v).where("value is not null"), 1).select("target_id", "source_id", "place")


_IDW = "coalesce(avg(case when d = 0 then value end), sum(case when d > 0 then value / pow(d, 2) end) / sum(case when d > 0 then 1 / pow(d, 2) end))"


@query(f"with {SAMPLES}, t as (select mini_id as target_id, lat, lon from mini), s as (select * from samples where value is not null), {KNN.format(k=5)} select target_id, round({_IDW}, 6) as value from knn join samples using (source_id) group by 1")
def gr2_idw(v):
    return G.idw(points(v), samples(v))


_DAILY = "daily as (select station_id as source_id, date_trunc('day', observed_at) as dt, sum(value) as value from obs_null where variable_code = 'rain' group by 1, 2)"


def daily(v):
    rain = v("obs_null").where("variable_code = 'rain'")
    return rain.groupBy(F.col("station_id").alias("source_id"), F.date_trunc("day", "observed_at").cast("timestamp_ntz").alias("dt")).agg(F.sum("value").alias("value"))


@query(f"""with {_DAILY}, t as (select mini_id as target_id, lat, lon from mini), s as (select station_id as source_id, lat, lon from station), {KNN.format(k=5)}, w as (select target_id, source_id, 1 / pow(greatest(d, 1e-12), 2) as w from knn)
    select target_id, cast(dt as varchar) as dt, round(sum(case when value is not null then w * value end) / sum(case when value is not null then w end), 6) as value from w join daily using (source_id) group by 1, 2""")
def gr3_fixed_neighbours(v):
    return G.fixed_neighbours(points(v), v("station").select(F.col("station_id").alias("source_id"), "lat", "lon"), daily(v))


def _grid_to_minis(asset):
    return f"""select * from (with t as (select mini_id as target_id, lat, lon from mini), s as (select distinct concat(iy, ':', ix) as source_id, lat, lon from cell where asset_id = '{asset}'), {KNN.format(k=5)}, w as (select target_id, source_id, 1 / pow(greatest(d, 1e-12), 2) as w from knn)
    select '{asset}' as asset_id, target_id, cast(end_utc as varchar) as end_utc, round(sum(case when value is not null then w * value end) / sum(case when value is not null then w end), 6) as value from w join (select concat(iy, ':', ix) as source_id, end_utc, value from cell where asset_id = '{asset}') c using (source_id) group by all)"""


@query(f"{_grid_to_minis('asset0')} union all {_grid_to_minis('asset1')}")
def gr4_grid_to_minis(v):
    """Both assets' grids, each with its own neighbours."""
    of = [G.grid_to_points(v("cell").where(F.col("asset_id") == a), points(v)).withColumn("asset_id", F.lit(a)) for a in ("asset0", "asset1")]
    return of[0].unionByName(of[1])


def dense(v):
    """One grid of all cells, the assets' columns put together."""
    return v("cell").withColumn("asset_id", F.lit("grid"))


_CORNERS = """pt as (select target_id, floor(round((lat + 33) / 0.25, 9)) as y, floor(round((lon + 55) / 0.25, 9)) as x, round((lat + 33) / 0.25, 9) - floor(round((lat + 33) / 0.25, 9)) as wy, round((lon + 55) / 0.25, 9) - floor(round((lon + 55) / 0.25, 9)) as wx from t),
    corners as (select target_id, y + dy as iy, x + dx as ix, (case dy when 1 then wy else 1 - wy end) * (case dx when 1 then wx else 1 - wx end) as w from pt, range(2) a(dy), range(2) b(dx)),
    bil as (select target_id, start_utc, end_utc, case when sum(case when value is not null then w end) > 1 - 1e-9 then sum(w * value) end as value from (select * from corners where w > 0) join {cells} using (iy, ix) group by 1, 2, 3)"""


@query(f"with t as (select mini_id as target_id, lat, lon from mini), {_CORNERS.format(cells='cell')} select target_id, cast(start_utc as varchar) as start_utc, cast(end_utc as varchar) as end_utc, round(value, 6) as value from bil")
def gr5_bilinear(v):
    return G.bilinear(dense(v), points(v), ORIGIN, STEP).drop("asset_id")


@query("select target_id, y + dy as iy, x + dx as ix, round((case dy when 1 then wy else 1 - wy end) * (case dx when 1 then wx else 1 - wx end), 6) as w from (select target_id, floor(fy) as y, floor(fx) as x, fy - floor(fy) as wy, fx - floor(fx) as wx from (select mini_id as target_id, round((lat + 33) / 0.25, 9) as fy, round((lon + 55) / 0.25, 9) as fx from mini)) a, range(2) b(dy), range(2) c(dx) where (case dy when 1 then wy else 1 - wy end) * (case dx when 1 then wx else 1 - wx end) > 0")
def jo17_bracket_corners(v):
    return G.corners(points(v), ORIGIN, STEP)


@query("select asset_id, iy, ix, cast(end_utc as varchar) as end_utc from cell where lat + 0.125 >= -31 and lat - 0.125 <= -29.5 and lon + 0.125 >= -54 and lon - 0.125 <= -52")
def gr6_crop(v):
    return G.crop(v("cell"), -54, -31, -52, -29.5, STEP).select("asset_id", "iy", "ix", "end_utc")


@query("select asset_id, iy, ix, cast(end_utc as varchar) as end_utc, round(lat + 4 * 0.25, 6) as lat, round(lon - 2 * 0.25, 6) as lon, case when value is not null then round(greatest(value * 1.5, 0), 6) end as value from cell")
def gr7_move(v):
    return G.moved(v("cell"), STEP, F.lit(3.6), F.lit(-2.5), F.lit(1.5)).select("asset_id", "iy", "ix", "end_utc", "lat", "lon", "value")


#: Turns by the corners of the boxes, one after the other; ``turn`` has asset_id, start_utc, end_utc, deg, dy, dx (cells), f of the intervals of ``cells``.
TURNED = """box as (select asset_id, min(lat) as y0, max(lat) as y1, min(lon) as x0, max(lon) as x1 from {cells} group by 1),
    turning as (select *, (y0 + y1) / 2 as cy, (x0 + x1) / 2 as cx, cos(radians(deg)) as co, sin(radians(deg)) as si, round_even(dy, 0) * 0.25 as sy, round_even(dx, 0) * 0.25 as sx from (select distinct asset_id, start_utc, end_utc, deg, dy, dx, f from {turn}) t join box using (asset_id)),
    corner as (select *, cx + (px + sx - cx) * co - (py + sy - cy) * si as qx, cy + (px + sx - cx) * si + (py + sy - cy) * co as qy from (select *, unnest([x0 - 0.125, x1 + 0.125, x0 - 0.125, x1 + 0.125]) as px, unnest([y0 - 0.125, y0 - 0.125, y1 + 0.125, y1 + 0.125]) as py from turning)),
    snapped as (select asset_id, start_utc, end_utc, floor(round(min(qx) / 0.25, 9)) * 0.25 as west, ceil(round(max(qx) / 0.25, 9)) * 0.25 as east, floor(round(min(qy) / 0.25, 9)) * 0.25 as south, ceil(round(max(qy) / 0.25, 9)) * 0.25 as north from corner group by 1, 2, 3),
    tall as (select *, unnest(range(cast(round((north - south) / 0.25) as bigint))) as iy from turning join snapped using (asset_id, start_utc, end_utc)),
    placed as (select *, south + (iy + 0.5) * 0.25 as lat, west + (ix + 0.5) * 0.25 as lon from (select *, unnest(range(cast(round((east - west) / 0.25) as bigint))) as ix from tall)),
    sourced as (select *, round_even(round((cy - (lon - cx) * si + (lat - cy) * co - sy - y0) / 0.25, 9), 0) as row, round_even(round((cx + (lon - cx) * co + (lat - cy) * si - sx - x0) / 0.25, 9), 0) as col from placed),
    turned as (select p.asset_id, p.start_utc, p.end_utc, p.iy, p.ix, p.lat, p.lon, case when c.value is not null then greatest(c.value * p.f, 0) end as value from sourced p left join {cells} c
        on c.asset_id = p.asset_id and c.start_utc = p.start_utc and c.end_utc = p.end_utc and round((c.lat - p.y0) / 0.25) = p.row and round((c.lon - p.x0) / 0.25) = p.col)"""


@query(f"with ask as (select distinct asset_id, start_utc, end_utc, 30.0 as deg, 2.0 as dy, 1.0 as dx, 1.2 as f from cell), {TURNED.format(cells='cell', turn='ask')} select asset_id, cast(start_utc as varchar) as start_utc, cast(end_utc as varchar) as end_utc, iy, ix, round(lat, 6) as lat, round(lon, 6) as lon, round(value, 6) as value from turned")
def gr8_rotate(v):
    # times are only keys here: as text once for a cell, not once for each of the many new ones
    cells = v("cell").withColumns({c: F.col(c).cast("string") for c in ("start_utc", "end_utc")})
    return G.rotated(cells, STEP, 30.0, 2.0, 1.0, 1.2)


@query("select asset_id, iy, ix, cast(end_utc as varchar) as end_utc, round(lat + 0.5, 6) as lat, round(lon, 6) as lon, round(value, 6) as value from cell")
def gr9_corrections_in_order(v):
    return G.corrected_in_order(v("cell"), STEP, [{"factor": 2.0, "shift_lat": 1.0}, {"factor": 0.5, "shift_lat": 1.0}]).select("asset_id", "iy", "ix", "end_utc", "lat", "lon", "value")


@query("select c.asset_id, c.iy, c.ix, cast(c.end_utc as varchar) as end_utc, round(coalesce(greatest(coalesce(m.value, 0) * 2, 0), 0), 6) as value from cell c left join cell m on m.asset_id = c.asset_id and m.end_utc = c.end_utc and m.iy + 2 = c.iy and m.ix - 1 = c.ix")
def gr10_fixed_canvas(v):
    return G.shifted_canvas(v("cell"), 2, -1, 2.0).select("asset_id", "iy", "ix", "end_utc", "value")


@query("""with s as (select asset_id, max(iy) / 2.0 as cy, max(ix) / 2.0 as cx from cell group by 1), p as (select c.*, round_even(round(cy + (iy - cy) * cos(radians(25)) + (ix - cx) * sin(radians(25)), 9), 0) as sy, round_even(round(cx - (iy - cy) * sin(radians(25)) + (ix - cx) * cos(radians(25)), 9), 0) as sx from cell c join s using (asset_id)),
    m as (select asset_id, end_utc, iy + 1 as sy, ix as sx, value from cell join s using (asset_id) where iy + 1 <= 2 * cy)
    select p.asset_id, p.iy, p.ix, cast(p.end_utc as varchar) as end_utc, round(greatest(coalesce(m.value, 0) * 2, 0), 6) as value from p left join m on m.asset_id = p.asset_id and m.end_utc = p.end_utc and m.sy = p.sy and m.sx = p.sx""")
def gr10_turned_canvas(v):
    return G.shifted_canvas(v("cell"), 1, 0, 2.0, 25.0).select("asset_id", "iy", "ix", "end_utc", "value")


@query("select asset_id, iy, ix, cast(start_utc + (h + 1) * interval '1' hour as varchar) as end_utc, round(value / 3, 6) as value from cell, range(3) r(h)")
def gr11_split_evenly(v):
    return G.split_evenly(v("cell"), 1).select("asset_id", "iy", "ix", "end_utc", "value")


EDIT_SQL = "e as (select * from (values ('asset0', 0, 3, 1.0, 0.0, 2.0), ('asset0', 3, 6, 1.0, 90.0, 1.5), ('asset1', 3, 9, -2.0, 20.0, 0.5)) e(asset_id, t0, t1, dlat, deg, f))"
EDITED = f"""stepped as (select c.*, deg, dlat as dy, 0.0 as dx, f from {{cells}} c left join e
    on e.asset_id = c.asset_id and date_diff('hour', timestamp '2026-03-18', start_utc) >= t0 and date_diff('hour', timestamp '2026-03-18', end_utc) <= t1),
    turn as (select * from stepped where deg <> 0), {TURNED.format(cells="turn", turn="turn")},
    ed as (select asset_id, start_utc, end_utc, iy, ix, lat + coalesce(dy, 0) * 0.25 as lat, lon, case when value is not null then greatest(value * coalesce(f, 1), 0) end as value, false as by_edges from stepped where coalesce(deg, 0) = 0
        union all select asset_id, start_utc, end_utc, iy, ix, lat, lon, value, true from turned)"""


def two_edits(v):
    """Edits of each asset, in the columns of the edit table: a move by a cell, and two turns."""
    names = ("asset_id", "t0_step", "t1_step", "shift_lat", "shift_lon", "rotation_deg", "multiplication_factor")
    rows = (("asset0", 0, 3, 1.0, 0.0, 0.0, 2.0), ("asset0", 3, 6, 1.0, 0.0, 90.0, 1.5), ("asset1", 3, 9, -2.0, 0.0, 20.0, 0.5))
    a = F.array(*(F.struct(*(F.lit(x).alias(n) for n, x in zip(names, row, strict=True))) for row in rows))
    return one(v).select(F.explode(a).alias("e")).select("e.*")


@query(f"with {EDIT_SQL}, {EDITED.format(cells='cell')} select asset_id, cast(start_utc as varchar) as start_utc, cast(end_utc as varchar) as end_utc, round(lat, 6) as lat, round(lon, 6) as lon, round(value, 6) as value from ed")
def jo8_edited_cells(v):
    return G.edited(v("cell"), two_edits(v), STEP, text=True).drop("iy", "ix")


#: Working cells of ``ed`` on the axes of the native grid, or of multiples of the resolution for turned ones.
WORKING = """split as (select asset_id, by_edges, start_utc + h * interval '1' hour as start_utc, start_utc + (h + 1) * interval '1' hour as end_utc, round((lat - case when by_edges then 0.125 else -33 end) / 0.25) as iy, round((lon - case when by_edges then 0.125 else -55 end) / 0.25) as ix, value / 3 as value from ed, range(3) r(h)),
    pt as (select target_id, by_edges, floor(fy) as y, floor(fx) as x, fy - floor(fy) as wy, fx - floor(fx) as wx from (select target_id, by_edges, round((lat - case when by_edges then 0.125 else -33 end) / 0.25, 9) as fy, round((lon - case when by_edges then 0.125 else -55 end) / 0.25, 9) as fx from t, (values (true), (false)) k(by_edges))),
    corners as (select target_id, by_edges, y + dy as iy, x + dx as ix, (case dy when 1 then wy else 1 - wy end) * (case dx when 1 then wx else 1 - wx end) as w from pt, range(2) a(dy), range(2) b(dx)),
    bil as (select asset_id, target_id, end_utc, case when sum(case when value is not null then w end) > 1 - 1e-9 then sum(w * value) end as value from (select * from corners where w > 0) join split using (iy, ix, by_edges) group by 1, 2, 3)"""


@query(f"with {EDIT_SQL}, {EDITED.format(cells='cell')}, t as (select mini_id as target_id, lat, lon from mini), {WORKING} select asset_id, cast(end_utc as varchar) as end_utc, target_id, round(value, 6) as value from bil")
def gr12_forecast_working_grid(v):
    return G.forecast_working_grid(v("cell"), two_edits(v), points(v), ORIGIN, STEP, 1, strict=False)


@query(f"with {EDIT_SQL}, {EDITED.format(cells='cell')}, t as (select mini_id as target_id, lat, lon from mini), {WORKING} select asset_id, cast(end_utc as varchar) as end_utc, count(value) as present, (select count(*) from t) as wanted from bil group by 1, 2 having count(value) < (select count(*) from t)")
def gr12_incomplete_steps(v):
    """The steps at which a working grid would be refused."""
    return G.incomplete(G.forecast_working_grid(v("cell"), two_edits(v), points(v), ORIGIN, STEP, 1, strict=False), points(v), ["asset_id", "end_utc"])


OBSERVED = f"""daily as (select station_id, date_trunc('day', observed_at) as end_utc, sum(value) as value from obs_null where variable_code = 'rain' and value is not null group by 1, 2),
    {GRID_SQL}, near as (select * from (select iy, ix, end_utc, d.value, sqrt(pow(g.lat - s.lat, 2) + pow(g.lon - s.lon, 2)) as d, row_number() over (partition by iy, ix, end_utc order by sqrt(pow(g.lat - s.lat, 2) + pow(g.lon - s.lon, 2)), s.station_id) as place
    from grid g cross join daily d join station s using (station_id)) where place <= 5),
    working as (select iy, ix, end_utc, {_IDW} as value from near group by 1, 2, 3)"""


def working(v):
    rain = v("obs_null").where("variable_code = 'rain'").groupBy("station_id", F.date_trunc("day", "observed_at").cast("timestamp_ntz").alias("observed_at")).agg(F.sum("value").alias("value"))
    return G.observed_working_grid(rain, v("station"), station_grid(v), days(v, "end_utc"))


@query(f"with {OBSERVED} select cast(end_utc as varchar) as end_utc, iy, ix, round(value, 6) as value from working")
def gr13_observed_working_grid(v):
    return working(v)


@query(f"""with {SAMPLES}, {GRID_SQL}, t as (select concat(iy, ':', ix) as target_id, lat, lon from grid), s as (select * from samples where value is not null), {KNN.format(k=5)}
    select target_id, round({_IDW}, 6) as value from knn join samples using (source_id) group by 1""")
def gr14_accumulation_grid(v):
    return G.idw(station_grid(v).select(F.concat_ws(":", "iy", "ix").alias("target_id"), "lat", "lon"), samples(v))


@query(f"""with {GRID_SQL}, t as (select concat(iy, ':', ix) as target_id, lat, lon from grid), acc as (select iy, ix, timestamp '2026-03-18' as start_utc, timestamp '2026-03-18' as end_utc, coalesce(sum(value), 0) as value from cell where end_utc <= timestamp '2026-03-18 09:00:00' group by 1, 2),
    {_CORNERS.format(cells='acc')} select target_id, round(value, 6) as value from bil""")
def gr15_forecast_preview(v):
    total = G.forecast_accumulation(dense(v), ts(CYCLE), ts("2026-03-18 09:00:00"))
    targets = station_grid(v).select(F.concat_ws(":", "iy", "ix").alias("target_id"), "lat", "lon")
    return G.bilinear(total, targets, ORIGIN, STEP, ("asset_id",)).select("target_id", "value")


@query("select cast(timestamp '2026-03-18' + h * interval '3' hour as varchar) as end_utc, (select count(value) from cell where end_utc = timestamp '2026-03-18' + h * interval '3' hour) as cells from range(1, 6) r(h)")
def gr16_required_steps(v):
    from .functions.timeops import plus_hours

    axis = one(v).select(F.explode(F.sequence(F.lit(3), F.lit(15), F.lit(3))).alias("h")).select(plus_hours(ts(CYCLE), F.col("h")).alias("end_utc"))
    return G.required_steps(axis, v("cell"))


@query("select asset_id, iy, ix, round(lat, 6) as lat, round(lon, 6) as lon, cast(valid_time - interval '3' hour as varchar) as start_utc, cast(valid_time as varchar) as end_utc, round(value, 6) as value from message where step_hours > 3")
def gr17_direct_intervals(v):
    rows = v("message").withColumn("start_step_hours", F.when(F.col("step_hours") > 3, F.col("step_hours") - 3).otherwise(3))
    return G.direct_intervals(rows, ts(CYCLE))


@query("select cast(dt as varchar) as dt, mini_id, cast(0 as double) as value from (select mini_id from mini) cross join (select distinct dt from model_output where mini_id = 1 and scenario_id = 'scenario0')")
def gr18_zero_block(v):
    axis = v("model_output").where("mini_id = 1 and scenario_id = 'scenario0'").select("dt").distinct()
    return G.zero_block(axis, v("mini"))


@query(f"with {INTERVALS} select asset_id, iy, ix, round(case when lon + 360 > 180 then lon else lon + 360 end, 6) as lon, cast(start_utc as varchar) as start_utc, cast(end_utc as varchar) as end_utc, round(value * 1000, 6) as value from intervals")
def gr19_canonical_grid(v):
    rows = v("message").withColumns({"short_name": F.lit("tp"), "lon": F.col("lon") + 360})
    return G.canonical_grid(rows, ts(CYCLE), ["tp"], 1000.0)[0].select("asset_id", "iy", "ix", "lon", "start_utc", "end_utc", "value")


@query("select asset_id, row_number() over (partition by asset_id order by s) - 1 as position, s as step_hours from (select distinct asset_id from asset where provider_code = 'ecmwf'), (select unnest(generate_series(0, 144, 3)) as s union all select unnest(generate_series(150, 360, 6)))")
def gr20_step_schedule(v):
    """The steps of each asset's cycle."""
    return G.step_schedule(v("asset").where("provider_code = 'ecmwf'").select("asset_id").distinct(), G.ECMWF_STEPS)


@query("""with s as (select unnest(generate_series(3, 240, 3)) as s union all select unnest(generate_series(252, 384, 12))), a as (select asset_id, min(date_diff('hour', valid_from, valid_to)) as needed from asset where provider_code = 'noaa' group by 1)
    select asset_id, row_number() over (partition by asset_id order by s) - 1 as position, s as step_hours from a, s where s <= (select min(x.s) from s x where x.s >= needed) or needed > 384""")
def gr20_required_steps(v):
    """The steps of each asset's cycle up to the first that reaches its end."""
    hours = F.timestamp_diff("HOUR", "valid_from", "valid_to")
    assets = v("asset").where("provider_code = 'noaa'").groupBy("asset_id").agg(F.min(hours).alias("needed"))
    return G.step_schedule(assets, G.GFS_STEPS, F.col("needed")).drop("needed")


@query("select asset_id, cast(timestamp '2026-03-18' + h * interval '1' hour as varchar) as end_utc, case when h between 1 and 12 then 1 else 0 end as n from (select distinct asset_id from cell), range(1, 15) r(h)")
def jo7_containing_intervals(v):
    from .functions.timeops import plus_hours

    targets = v("cell").select("asset_id").distinct().withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(14)))).select("asset_id", plus_hours(ts(CYCLE), F.col("h")).alias("end_utc"))
    return G.containing_intervals(targets, v("cell"), 1)


@query("""with p as (select mini_id as target_id, lat, lon from mini where lon <= -55 + 0.25 * 39 + 0.125)
    select target_id, cast(least(greatest(ceil(round((lat + 33) / 0.25 - 0.5, 9)), 0), 49) as bigint) as iy, cast(least(greatest(ceil(round((lon + 55) / 0.25 - 0.5, 9)), 0), 39) as bigint) as ix, asset_id, cast(end_utc as varchar) as end_utc, round(c.value, 6) as value
    from p left join cell c on c.iy = least(greatest(ceil(round((lat + 33) / 0.25 - 0.5, 9)), 0), 49) and c.ix = least(greatest(ceil(round((p.lon + 55) / 0.25 - 0.5, 9)), 0), 39)""".replace("(lat + 33)", "(p.lat + 33)").replace("(lon + 55)", "(p.lon + 55)").replace("p.p.", "p."))
def jo14_nearest_cell(v):
    return G.cell_of(v("cell"), points(v), ORIGIN, STEP, (50, 40), ("asset_id", "end_utc"))


@query("select asset_id, cast(start_utc as varchar) as start_utc, cast(end_utc as varchar) as end_utc, iy, ix, round(lat, 6) as lat, round(lon, 6) as lon, round(value, 6) as value from cell where asset_id = 'asset1'")
def sc13_grid_scan(v):
    return v("cell").where("asset_id = 'asset1'")


@query("select asset_id, iy, ix, cast(end_utc as varchar) as end_utc, round(value, 6) as value from cell where start_utc >= timestamp '2026-03-18 03:00:00' and end_utc <= timestamp '2026-03-18 09:00:00'")
def sc14_grid_window(v):
    return G.window_of(v("cell"), ts("2026-03-18 03:00:00"), ts("2026-03-18 09:00:00")).select("asset_id", "iy", "ix", "end_utc", "value")


@query("select asset_id, step_hours, iy, ix, round(value, 6) as value from message")
def so5_cumulative_messages(v):
    twice = messages(v).unionByName(messages(v)).unionByName(messages(v).withColumn("start_step_hours", F.lit(3)))
    return G.cumulative_messages(twice)[0].select("asset_id", "step_hours", "iy", "ix", "value")


@query("select asset_id, step_hours, iy, ix, cast(2 as bigint) as n from message where iy = 0")
def so5_conflicting_messages(v):
    other = messages(v).where("iy = 0").withColumn("value", F.col("value") + 1)
    return G.cumulative_messages(messages(v).unionByName(other))[1]


@query("""select mini_id, cast(dt as varchar) as dt, round(value, 6) as value from model_output where scenario_id = 'scenario0' and prev_flag = 0
    union all select mini_id, cast(dt as varchar), cast(0 as double) from (select distinct mini_id from model_output) cross join (select distinct dt from model_output where scenario_id = 'scenario0' and prev_flag = 1)""")
def so2_blocks_on_the_axis(v):
    out = v("model_output")
    first = out.where("scenario_id = 'scenario0' and prev_flag = 0").select("dt", "mini_id", "value")
    ahead = G.zero_block(out.where("scenario_id = 'scenario0' and prev_flag = 1").select("dt").distinct(), out.select("mini_id").distinct())
    return first.unionByName(ahead)


# --- networks --------------------------------------------------------------------------------------------------

UP = "with recursive up(mini_id, steps, path) as (select cast(5 as bigint), cast(0 as bigint), [cast(5 as bigint)] union all select m.mini_id, steps + 1, list_append(path, m.mini_id) from mini m join up on m.mini_jus = up.mini_id)"


@query(f"{UP} select mini_id, steps, row_number() over (order by list_append(path, 9223372036854775807)) as place from up")
def gx1_upstream(v):
    return N.upstream(v("mini"), 5)


ALL_UP = """with recursive up(mini_id, mini_area, path) as (select mini_id, mini_area, [mini_id] from mini where mini_jus not in (select mini_id from mini)
    union all select m.mini_id, m.mini_area, list_append(path, m.mini_id) from mini m join up on m.mini_jus = up.mini_id),
    through as (select outlet as mini_id, count(*) as size, sum(mini_area) as area from (select unnest(path) as outlet, mini_area from up) p group by 1)"""


@query(f"{ALL_UP} select mini_id, path[1] as root, len(path) - 1 as steps, row_number() over (partition by path[1] order by list_append(path, 9223372036854775807)) as place, size, round(area, 6) as area from up join through using (mini_id)")
def gx1_all_basins(v):
    """Every node as an outlet: its place in the order of its root, and the nodes and the area that drain through it."""
    return N.numbered(v("mini"))


@query(f"""{UP} select mini_id, 'cycle' as reason from (select distinct mini_id from up) union all select mini_id, 'downstream' from mini where mini_id % 11 = 0""")
def gx2_network_errors(v):
    """A loop 5 -> 10 -> 5 is put in: what drains into it is on or above a cycle, all else isn't; every eleventh has two downstream ones."""
    minis = v("mini").withColumn("mini_jus", F.when(F.col("mini_id") == 5, F.lit(10)).otherwise(F.col("mini_jus")))
    second = minis.where("mini_id % 11 = 0").withColumn("mini_jus", F.col("mini_jus") + 1_000_000_000)
    return N.network_errors(minis.unionByName(second))


@query(f"{UP} select mini_id, round(mini_area, 6) as weight from up join mini using (mini_id)")
def gx3_basin_weights(v):
    return N.basin_weights(v("mini"), 5)


# --- composed --------------------------------------------------------------------------------------------------


@query(f"""with {SPAN}, {OBSERVED}, t as (select mini_id as target_id, lat, lon from mini), s as (select concat(iy, ':', ix) as source_id, lat, lon from grid), {KNN.format(k=5)}, w as (select target_id, source_id, 1 / pow(greatest(d, 1e-12), 2) as w from knn)
    select cast(end_utc as varchar) as dt, target_id as mini_id, round(sum(w * value) / sum(w), 6) as value from w join (select concat(iy, ':', ix) as source_id, end_utc, value from working) g using (source_id) group by 1, 2
    union all select cast(cast(z as timestamp) + h * interval '1' day as varchar), target_id, cast(0 as double) from t, span, range(1, 3) r(h)""")
def pj4_catchment_forcing(v):
    observed = working(v).join(station_grid(v), ["iy", "ix"])
    ahead = days(v, "dt", after=2)
    return jobs.forcing(observed, None, G.zero_block(ahead, v("mini")), v("mini"), strict=False)


def _forecast_forcing(asset):
    return f"""select * from (with mine as (select target_id as source_id, end_utc, value from bil where asset_id = '{asset}'), s as (select distinct source_id, g.lat, g.lon from mine join gt g on g.target_id = source_id), {KNN.format(k=5)}, w as (select target_id, source_id, 1 / pow(greatest(d, 1e-12), 2) as w from knn)
    select '{asset}' as asset_id, cast(end_utc as varchar) as dt, target_id as mini_id, round(sum(case when value is not null then w * value end) / sum(case when value is not null then w end), 6) as value from w join mine using (source_id) group by all)"""


@query(f"""with {OBSERVED}, {EDIT_SQL}, {EDITED.format(cells='cell')}, gt as (select concat(iy, ':', ix) as target_id, lat, lon from grid), {WORKING.replace("from t,", "from gt,")}, t as (select mini_id as target_id, lat, lon from mini),
    past as (select * from (with s as (select concat(iy, ':', ix) as source_id, lat, lon from grid), {KNN.format(k=5)}, w as (select target_id, source_id, 1 / pow(greatest(d, 1e-12), 2) as w from knn) select cast(end_utc as varchar) as dt, target_id as mini_id, round(sum(case when value is not null then w * value end) / sum(case when value is not null then w end), 6) as value from w join (select concat(iy, ':', ix) as source_id, end_utc, value from working) g using (source_id) group by 1, 2))
    select asset_id, dt, mini_id, value from past cross join (values ('asset0'), ('asset1')) a(asset_id) union all {_forecast_forcing('asset0')} union all {_forecast_forcing('asset1')}""")
def pj4_forecast_forcing(v):
    """Observed rain and then each asset's edited forecast, both by way of the stations' grid."""
    grid = station_grid(v)
    observed = materialise(working(v).join(grid, ["iy", "ix"]))
    targets = grid.select(F.concat_ws(":", "iy", "ix").alias("target_id"), "iy", "ix", "lat", "lon")
    ahead = materialise(G.forecast_working_grid(v("cell"), two_edits(v), targets, ORIGIN, STEP, 1, strict=False).join(targets, "target_id"))
    of = [jobs.forcing(observed, ahead.where(F.col("asset_id") == a), None, v("mini"), strict=False).withColumn("asset_id", F.lit(a)) for a in ("asset0", "asset1")]
    return of[0].unionByName(of[1])


@query(f"""with {SPAN}, d as (select station_id as source_id, date_trunc('day', observed_at) as dt, sum(value) as value from obs_null where variable_code = 'rain' and value is not null group by 1, 2),
    t as (select mini_id as target_id, lat, lon from mini), s as (select station_id as source_id, lat, lon from station where station_id in (select source_id from d)), {KNN.format(k=5)}, a as ({DAYS})
    select cast(a.dt as varchar) as dt, target_id as mini_id, round(sum(coalesce(value, 0) / pow(greatest(d, 1e-12), 2)) / sum(1 / pow(greatest(d, 1e-12), 2)), 6) as value from knn cross join a left join d using (source_id, dt) group by 1, 2""".replace("knn cross join a left join d using (source_id, dt)", "knn k cross join a left join d x on x.source_id = k.source_id and x.dt = a.dt").replace("coalesce(value, 0)", "coalesce(x.value, 0)").replace("pow(greatest(d, 1e-12), 2)", "pow(greatest(k.d, 1e-12), 2)"))
def pj4_station_forcing(v):
    rain = v("obs_null").where("variable_code = 'rain'").withColumn("observed_at", F.date_trunc("day", "observed_at").cast("timestamp_ntz"))
    return jobs.station_forcing(rain, v("station"), v("mini"), days(v, "dt"))


@query("select cast(p_partkey % 50 as bigint) as mini_id, 'level' as variable_code, cast(timestamp '2026-03-10' + (p_partkey // 50) * interval '1' hour as varchar) as dt, case when p_partkey // 50 < 11 then 0 else 1 end as time_segment, round(p_retailprice * 100, 6) as value from part")
def pj5_output_export(v):
    cells = v("part").select(F.floor(F.col("p_partkey") / 50).alias("t"), (F.col("p_partkey") % 50).cast("int").alias("position"), F.col("p_retailprice").alias("value"))
    minis = v("part").select((F.col("p_partkey") % 50).alias("mini_id"), (F.col("p_partkey") % 50).cast("int").alias("position")).distinct()
    return jobs.export(cells, minis, "level", ts("2026-03-10 00:00:00"), ts("2026-03-10 10:00:00"), 1)


def two_scenarios(v, targets):
    """A raw and a corrected scenario of each asset at the targets; edits are named by their asset."""
    kinds = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.lit(k == "corrected").alias("edited")) for k in ("raw", "corrected"))))
    scenarios = v("cell").select("asset_id").distinct().select("asset_id", kinds.alias("k")).select("asset_id", "k.kind", F.when(F.col("k.edited"), F.col("asset_id")).alias("manual_edit_id"), F.concat_ws(".", "asset_id", "k.kind").alias("scenario_id"))
    edits = two_edits(v).withColumn("manual_edit_id", F.col("asset_id"))
    return jobs.scenario_forcings(scenarios, v("cell"), edits, targets, ORIGIN, STEP, 1, strict=False)


SCENARIOS = f"""sc as (select asset_id, kind, concat(asset_id, '.', kind) as scenario_id from (select distinct asset_id from cell), (values ('raw'), ('corrected')) k(kind)),
    own as (select scenario_id as asset_id, start_utc, end_utc, iy, ix, lat, lon, value from cell join sc using (asset_id)), e0 as (select * from (values ('asset0', 0, 3, 1.0, 0.0, 2.0), ('asset0', 3, 6, 1.0, 90.0, 1.5), ('asset1', 3, 9, -2.0, 20.0, 0.5)) e(asset_id, t0, t1, dlat, deg, f)),
    e as (select concat(asset_id, '.corrected') as asset_id, t0, t1, dlat, deg, f from e0), {EDITED.format(cells="own")}"""


@query(f"with {SCENARIOS}, t as (select mini_id as target_id, lat, lon from mini), {WORKING} select asset_id as scenario_id, cast(end_utc as varchar) as end_utc, target_id, round(value, 6) as value from bil")
def pj7_scenario_forcings(v):
    return two_scenarios(v, points(v))


@query("""with b as (select asset_id, min(valid_time) - interval '3' hour as a, max(valid_time) as z, min(lon) - 0.125 as w, min(lat) - 0.25 / 2 as s, max(lon) + 0.125 as e, max(lat) + 0.125 as n from message group by 1)
    select asset_id, 'forecast_grid' as asset_kind, 'ecmwf' as provider_code, cast(a as varchar) as valid_from, cast(z as varchar) as valid_to from b""")
def pj8_registered_grids(v):
    return jobs.registered_grid(v("message").withColumn("short_name", F.lit("tp")), ts(CYCLE), "ecmwf").drop("metadata_json")
