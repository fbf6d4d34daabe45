"""Station and model series: preferred states, summaries, accumulations, peaks, weighted means, level offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialise
from .quantiles import quantiles

#: States from the most to the least trusted.
STATES = ("approved", "curated", "raw")
#: Codes, names and units of model variables.
MODEL_VARIABLES = (("precipitation", "Precipitation", "mm"), ("flow", "Flow", "m3/s"), ("level", "Level", "cm"))
REFERENCE_TYPES = ("level_atention", "level_alert", "level_flood", "level_severe")


def state_rank(state: Column) -> Column:
    out = F.lit(len(STATES))
    for i, name in enumerate(STATES):
        out = F.when(state == name, i).otherwise(out)
    return out


def preferred_series(series: DataFrame) -> DataFrame:
    """One series for each station and variable: the most trusted state, then the newest, then the smallest id.

    Unknown states come last, and so does a series without a creation time among equals.
    """
    order = Window.partitionBy("station_id", "variable_code").orderBy(state_rank(F.col("state")), F.col("created_at").desc_nulls_last(), "series_id")
    return series.withColumn("place", F.row_number().over(order)).where("place = 1").drop("place")


def values_of(series: DataFrame, stored: DataFrame, start: Column | None = None, end: Column | None = None, end_inclusive: bool = False) -> DataFrame:
    """Values of the series in ``[start, end)``, or ``[start, end]``, with the series' keys."""
    rows = stored
    if start is not None:
        rows = rows.where(F.col("observed_at") >= start)
    if end is not None:
        rows = rows.where(F.col("observed_at") <= end if end_inclusive else F.col("observed_at") < end)
    return rows.join(series.select("series_id", "station_id", "variable_code"), "series_id")


def station_values(series: DataFrame, stored: DataFrame, station: str, start: Column, end: Column) -> DataFrame:
    """Values of one station's series in ``[start, end]``."""
    return values_of(series.where(F.col("station_id") == station), stored, start, end, end_inclusive=True)


def observed_series(series: DataFrame, stored: DataFrame, station: str, start: Column, end: Column) -> DataFrame:
    """``variable_code, observed_at, value`` of one station's preferred series in ``[start, end]``."""
    return station_values(preferred_series(series.where(F.col("station_id") == station)), stored, station, start, end).select("variable_code", "observed_at", "value")


def rain_series(series: DataFrame, stations: DataFrame) -> DataFrame:
    """Rain series with provider and coordinates of their stations."""
    return series.where("variable_code = 'rain'").join(stations.select("station_id", "provider_code", "lat", "lon"), "station_id")


def station_kind(rain: Column, hydro: Column) -> Column:
    """``mixed``, ``rain``, ``level`` or ``no_data`` of whether there are rain, and level or flow series."""
    return F.when(rain & hydro, "mixed").when(rain, "rain").when(hydro, "level").otherwise("no_data")


def kinds(preferred: DataFrame) -> DataFrame:
    """``station_id, kind`` of stations with series."""
    has = preferred.groupBy("station_id").agg(F.bool_or(F.col("variable_code") == "rain").alias("rain"), F.bool_or(F.col("variable_code").isin("level", "flow")).alias("hydro"))
    return has.select("station_id", station_kind(F.col("rain"), F.col("hydro")).alias("kind"))


def _status(rows: Column, present: Column) -> Column:
    return F.when(F.coalesce(rows, F.lit(0)) == 0, "no_data").when(present == 0, "data_issue").otherwise("ok")


def station_status(stations: DataFrame, values: DataFrame) -> DataFrame:
    """``station_id, status, n_rows``: no rows, only missing values, or ok."""
    counts = values.groupBy("station_id").agg(F.count("*").alias("n"), F.count("value").alias("present"))
    joined = stations.select("station_id").join(counts, "station_id", "left")
    return joined.select("station_id", _status(F.col("n"), F.col("present")).alias("status"), F.coalesce("n", F.lit(0)).alias("n_rows"))


def _last_hours(value: str, at: str, cutoff: Column, hours: int) -> Column:
    """Sum over ``(cutoff - hours, cutoff]``: 0 where older values exist but none in it, null where there are none at all."""
    inside = (F.col(at) > cutoff - F.make_dt_interval(F.lit(0), F.lit(hours))) & (F.col(at) <= cutoff)
    total = F.sum(F.when(inside, F.col(value)))
    return F.when(F.count(F.when(F.col(at) <= cutoff, F.col(value))) > 0, F.coalesce(total, F.lit(0.0)))


def rain_summary(values: DataFrame, cutoff: Column) -> DataFrame:
    """``station_id, mean_rain, rain_24h, p90_rain`` of rain up to the cutoff."""
    rows = values.where(F.col("variable_code") == "rain").where(F.col("observed_at") <= cutoff).where("value is not null")
    rows = materialise(rows.select("station_id", "observed_at", "value"))
    means = rows.groupBy("station_id").agg(F.avg("value").alias("mean_rain"), _last_hours("value", "observed_at", cutoff, 24).alias("rain_24h"))
    high = quantiles(rows, "value", {"p90_rain": 0.9}, ("station_id",))
    return means.join(high, "station_id", "left")


def station_catalog(stations: DataFrame, series: DataFrame, stored: DataFrame, start: Column, end: Column) -> DataFrame:
    """Every station with its kind, status, rows, and rain summary over its preferred series in ``[start, end]``."""
    preferred = preferred_series(series)
    values = values_of(preferred, stored, start, end, end_inclusive=True)
    rain = (F.col("variable_code") == "rain") & F.col("value").isNotNull()
    inside = F.col("observed_at") > end - F.make_dt_interval(F.lit(0), F.lit(24))
    amount = F.when(rain, F.col("value"))
    found = values.groupBy("station_id").agg(
        F.count("*").alias("n"),
        F.count("value").alias("present"),
        F.avg(amount).alias("mean_rain"),
        F.when(F.count(amount) > 0, F.coalesce(F.sum(F.when(inside, amount)), F.lit(0.0))).alias("rain_24h"),
        F.percentile(amount, F.lit(0.9)).alias("p90_rain"),
    )
    joined = stations.join(kinds(preferred), "station_id", "left").join(found, "station_id", "left")
    return joined.select(
        "station_id", "provider_code", "station_code", "station_name", "mini_id", "lat", "lon",
        F.coalesce("kind", F.lit("no_data")).alias("kind"), _status(F.col("n"), F.col("present")).alias("status"), F.coalesce("n", F.lit(0)).alias("n_rows"), "mean_rain", "rain_24h", "p90_rain",
    )


def observed_metrics(values: DataFrame, cutoff: Column) -> DataFrame:
    """``station_id, latest, rain_12h, rain_24h, rain_72h, level, flow`` up to the cutoff."""
    rows = values.where(F.col("observed_at") <= cutoff).where("value is not null")
    rain = rows.withColumn("rain", F.when(F.col("variable_code") == "rain", F.col("value")))

    def latest(variable: str) -> Column:
        mine = F.col("variable_code") == variable
        return F.max_by(F.when(mine, F.col("value")), F.when(mine, F.col("observed_at")))

    return rain.groupBy("station_id").agg(
        F.max("observed_at").alias("latest"),
        *(_last_hours("rain", "observed_at", cutoff, h).alias(f"rain_{h}h") for h in (12, 24, 72)),
        latest("level").alias("level"),
        latest("flow").alias("flow"),
    )


def rainfall_accumulations(series: DataFrame, stored: DataFrame, start: Column, end: Column) -> DataFrame:
    """``station_id, rain`` over ``(start, end]`` of the preferred rain series; stations without values aren't there."""
    rows = stored.where((F.col("observed_at") > start) & (F.col("observed_at") <= end)).where("value is not null")
    rain = preferred_series(series.where("variable_code = 'rain'")).select("series_id", "station_id")
    return rows.join(rain, "series_id").groupBy("station_id").agg(F.sum("value").alias("rain"))


def accumulated_rain(series: DataFrame, stored: DataFrame, stations: DataFrame, start: Column, end: Column) -> DataFrame:
    """``station_id, lat, lon, rain`` over ``[start, end)`` of every preferred rain series; null without any value."""
    rain = preferred_series(series.where("variable_code = 'rain'")).select("series_id", "station_id")
    total = values_of(rain.withColumn("variable_code", F.lit("rain")), stored, start, end).groupBy("station_id").agg(F.sum("value").alias("rain"))
    return rain.join(stations.select("station_id", "lat", "lon"), "station_id").join(total, "station_id", "left").select("station_id", "lat", "lon", "rain")


def rainfall_labels(catalog: DataFrame, accumulations: DataFrame) -> DataFrame:
    """``station_id, label``: the accumulation (to six decimals) cut to one decimal, or ``-``."""
    from ..functions.text import one_decimal

    joined = catalog.select("station_id").join(accumulations, "station_id", "left")
    return joined.select("station_id", F.when(F.col("rain").isNull(), "-").otherwise(F.format_string("%.1f", one_decimal(F.round("rain", 6)))).alias("label"))


def network_summary(catalog: DataFrame) -> DataFrame:
    """Stations by status, and mean and 90th percentile of 24 h rain over ok stations, else over all."""
    rows = materialise(catalog.select("status", "rain_24h"))
    ok = F.when(F.col("status") == "ok", F.col("rain_24h"))
    counts = rows.agg(
        F.count("*").alias("stations"),
        *(F.count_if(F.col("status") == s).alias(s) for s in ("ok", "data_issue", "no_data")),
        F.coalesce(F.avg(ok), F.avg("rain_24h")).alias("mean_24h"),
    )
    both = rows.select(F.explode(F.array(F.struct(F.lit("all").alias("of"), F.col("rain_24h").alias("rain")), F.struct(F.lit("ok").alias("of"), ok.alias("rain")))).alias("x")).select("x.*")
    high = quantiles(both, "rain", {"p90": 0.9}, ("of",)).agg(F.coalesce(*(F.max(F.when(F.col("of") == k, F.col("p90"))) for k in ("ok", "all"))).alias("p90_24h"))
    return counts.withColumn("k", F.lit(1)).join(high.withColumn("k", F.lit(1)), "k").drop("k")


def rainfall_total(values: DataFrame, at: str, start: Column, end: Column, segment: int | None = None) -> Column:
    """Sum over ``(start, end]``, of one segment if given; null without values."""
    inside = (F.col(at) > start) & (F.col(at) <= end)
    return F.sum(F.when(inside if segment is None else inside & (F.col("prev_flag") == segment), F.col("value")))


def area_summary(station_rain: DataFrame, basin_rain: DataFrame, past: Column, reference: Column, ahead: Column) -> DataFrame:
    """One row: rain of the station and of the basin before the reference, and of the basin after it."""
    a = station_rain.agg(rainfall_total(station_rain, "observed_at", past, reference).alias("station_past"))
    b = basin_rain.agg(rainfall_total(basin_rain, "dt", past, reference, 0).alias("basin_past"), rainfall_total(basin_rain, "dt", reference, ahead, 1).alias("basin_ahead"))
    return a.withColumn("k", F.lit(1)).join(b.withColumn("k", F.lit(1)), "k").drop("k")


def mini_peaks(values: DataFrame, cutoff: Column, end: Column) -> DataFrame:
    """``mini_id, current_value, current_time, current_peak, forecast_peak`` of each mini.

    Current values are those of segment 0 up to the cutoff, forecast values those of segment 1 after it and before the
    end. Without a current value a mini has nothing at all, even if it has a forecast.
    """
    now = (F.col("prev_flag") == 0) & (F.col("dt") <= cutoff) & F.col("value").isNotNull()
    ahead = (F.col("prev_flag") == 1) & (F.col("dt") > cutoff) & (F.col("dt") < end) & F.col("value").isNotNull()
    found = values.groupBy("mini_id").agg(
        F.max_by(F.when(now, F.col("value")), F.when(now, F.col("dt"))).alias("current_value"),
        F.max(F.when(now, F.col("dt"))).alias("current_time"),
        F.max(F.when(now, F.col("value"))).alias("current_peak"),
        F.max(F.when(ahead, F.col("value"))).alias("forecast_peak"),
    )
    return found.withColumn("forecast_peak", F.when(F.col("current_time").isNotNull(), F.col("forecast_peak")))


def network_peaks(output: DataFrame, variable: str, minis: DataFrame, cutoff: Column, end: Column) -> DataFrame:
    """:func:`mini_peaks` of every requested mini, in one pass; minis without rows have nulls."""
    rows = output.where(F.col("variable_code") == variable)
    return minis.select("mini_id").distinct().join(mini_peaks(rows, cutoff, end), "mini_id", "left")


def model_series(output: DataFrame, mini_id: int, variable: str, segment: int | None = None, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """``dt, prev_flag, value, display_name, unit`` of one mini and variable, in ``[start, end)`` and one segment if given."""
    rows = output.where((F.col("mini_id") == mini_id) & (F.col("variable_code") == variable))
    if segment is not None:
        rows = rows.where(F.col("prev_flag") == segment)
    if start is not None:
        rows = rows.where(F.col("dt") >= start)
    if end is not None:
        rows = rows.where(F.col("dt") < end)
    name, unit = next(((n, u) for c, n, u in MODEL_VARIABLES if c == variable), (variable, ""))
    return rows.select("scenario_id", "dt", "prev_flag", "value", F.lit(name).alias("display_name"), F.lit(unit).alias("unit"))


def model_variables(output: DataFrame) -> DataFrame:
    """``variable_code, display_name, unit`` of the known variables that the output has."""
    present = output.select("variable_code").distinct()
    known = F.explode(F.array(*(F.struct(*(F.lit(x).alias(n) for x, n in zip(v, ("code", "display_name", "unit"), strict=True))) for v in MODEL_VARIABLES))).alias("v")
    return present.select("variable_code", known).where("v.code = variable_code").select("variable_code", "v.display_name", "v.unit")


def weighted_mean(output: DataFrame, weights: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``dt, prev_flag, value``: mean over minis, weights renewed over those with a value; null where there is none."""
    keys = keys if keys is not None else ["dt", "prev_flag"]
    rows = output.join(weights.select("mini_id", "weight"), "mini_id")
    ok = F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") != float("inf"))
    total = F.sum(F.when(ok, F.col("weight") * F.col("value"))) / F.nullif(F.sum(F.when(ok, F.col("weight"))), F.lit(0.0))
    return rows.groupBy(*keys).agg(total.alias("value"))


def weight_errors(weights: DataFrame) -> DataFrame:
    """``mini_id, reason`` of weights that repeat a mini or aren't finite and positive."""
    w = F.col("weight")
    bad = weights.where(w.isNull() | F.isnan(w) | (F.abs(w) == float("inf")) | (w <= 0)).select("mini_id", F.lit("weight").alias("reason"))
    twice = weights.groupBy("mini_id").count().where("count > 1").select("mini_id", F.lit("repeated").alias("reason"))
    return bad.distinct().union(twice)


def inconsistent_attributes(minis: DataFrame, column: str = "mini_area") -> DataFrame:
    """Minis whose attribute hasn't exactly one value; a null counts as one."""
    found = minis.groupBy("mini_id").agg((F.count_distinct(column) + F.max(F.col(column).isNull().cast("long"))).alias("n"))
    return found.where("n <> 1")


def mini_station(stations: DataFrame) -> DataFrame:
    """``mini_id, station_id`` of minis with one station, and how many stations the others have (``n``, id null)."""
    found = stations.where("mini_id is not null").groupBy("mini_id").agg(F.count("*").alias("n"), F.min("station_id").alias("station_id"))
    return found.select("mini_id", F.when(F.col("n") == 1, F.col("station_id")).alias("station_id"), "n")


def adjusted_level(model: DataFrame, observed: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``dt, prev_flag, value`` of the modelled level, moved by the offset at the latest time that both sides have.

    Only the current segment is compared, at equal times, without missing values; without such a time there are no rows.
    ``keys`` tell several series apart.
    """
    keys = keys or []
    now = model.where("prev_flag = 0 and value is not null").select(*keys, "dt", F.col("value").alias("modelled"))
    seen = observed.where("value is not null").select(*keys, F.col("observed_at").alias("dt"), F.col("value").alias("seen"))
    offset = now.join(seen, [*keys, "dt"]).groupBy(*keys).agg(F.max_by(F.col("seen") - F.col("modelled"), "dt").alias("offset")).where("offset is not null")
    moved = model.join(offset, keys) if keys else model.join(F.broadcast(offset))
    return moved.select(*keys, "dt", "prev_flag", (F.col("value") + F.col("offset")).alias("value"))


def in_order(rows: DataFrame, group: list[str], order: list[str | Column]) -> DataFrame:
    """Rows with their ``place`` in the order in which outputs of a group stand; ties go by nothing else, so name enough columns."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))


def comparison_series(output: DataFrame, scenarios: list[str], mini_id: int) -> DataFrame:
    """``scenario_id, variable_code, dt, prev_flag, value`` of one mini in several scenarios."""
    return output.where(F.col("scenario_id").isin(*scenarios) & (F.col("mini_id") == mini_id)).select("scenario_id", "variable_code", "dt", "prev_flag", "value")


def reference_levels(boundaries: DataFrame, floods: DataFrame, station: Column | None = None) -> DataFrame:
    """``station_id, reference_type, level_cm, event_date, place``: alert levels in their order, then floods by date and level."""
    alerts = boundaries.select("station_id", "reference_type", "level_cm", F.lit(None).cast("date").alias("event_date"))
    every = alerts.unionByName(floods.select("station_id", F.lit("flood_record").alias("reference_type"), "level_cm", "event_date"))
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, REFERENCE_TYPES)), F.col("reference_type")), F.lit(0)), F.lit(len(REFERENCE_TYPES) + 1))
    order = Window.partitionBy("station_id").orderBy(rank, F.col("event_date").asc_nulls_last(), "level_cm")
    placed = every.withColumn("place", F.row_number().over(order))
    return placed if station is None else placed.where(F.col("station_id") == station)
