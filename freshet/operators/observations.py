"""Observations: timestep buckets, capabilities, coverage gaps, request windows, import summaries."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import series_id
from ..functions.timeops import bucket_end, request_days

#: How a timestep's values become one, by variable.
METHODS = {"rain": "sum", "level": "mean", "flow": "mean"}
KEYS = ["station_id", "variable_code", "state"]


def _aggregate(methods: Mapping[str, str], value: str, order: Column) -> Column:
    known = {"sum": F.sum(value), "mean": F.avg(value), "last": F.max_by(value, order)}
    out = F.lit(None).cast("double")
    for variable, method in methods.items():
        out = F.when(F.first("variable_code") == variable, known[method]).otherwise(out)
    return out


def bucket_values(obs: DataFrame, timestep_hours: int, methods: Mapping[str, str] | None = None, order: str = "arrival_seq") -> DataFrame:
    """One value for each station, variable, state and right-closed timestep, labelled with its end.

    ``sum``, ``mean`` or ``last`` (the last in arrival order, not in time) by variable; rows without a value or time and
    variables without a method don't count. One shuffle with partial aggregation.
    """
    methods = dict(METHODS if methods is None else methods)
    rows = obs.where(F.col("value").isNotNull() & ~F.isnan("value") & F.col("observed_at").isNotNull()).where(F.col("variable_code").isin(*methods))
    grouped = rows.withColumn("bucket", bucket_end(F.col("observed_at"), timestep_hours)).groupBy(*KEYS, "bucket")
    return grouped.agg(_aggregate(methods, "value", F.col(order)).alias("value")).select(*KEYS, F.col("bucket").alias("observed_at"), "value")


def import_summary(obs: DataFrame, buckets: DataFrame) -> DataFrame:
    """``variable_code, rows_read, rows_written`` of a load."""
    read = obs.groupBy("variable_code").agg(F.count("*").alias("rows_read"))
    written = buckets.groupBy("variable_code").agg(F.count("*").alias("rows_written"))
    return read.join(written, "variable_code", "left").fillna(0, ["rows_written"])


def series_of(obs: DataFrame) -> DataFrame:
    """``series_id`` and its keys, one row each."""
    return obs.select(*KEYS).distinct().withColumn("series_id", series_id(*map(F.col, KEYS))).select("series_id", *KEYS)


def expand_capabilities(stations: DataFrame, column: str = "observed_variables") -> DataFrame:
    """``station_id, variable_code``: a row for each entry of a list separated by ``,``, ``;`` or ``|``; ``none`` has none."""
    parts = F.transform(F.split(F.lower(F.col(column)), r"[,;\|]"), lambda x: F.trim(x))
    names = F.array_distinct(F.filter(parts, lambda x: (x != "") & (x != "none")))
    return stations.select("station_id", F.explode(names).alias("variable_code"))


def capability_errors(stations: DataFrame, allowed: list[str], column: str = "observed_variables") -> DataFrame:
    """Stations whose list names a variable twice, an unknown one, or ``none`` beside others, with the reason."""
    parts = F.filter(F.transform(F.split(F.lower(F.col(column)), r"[,;\|]"), lambda x: F.trim(x)), lambda x: x != "")
    reason = (
        F.when(F.size(parts) > F.size(F.array_distinct(parts)), "repeated")
        .when(F.array_contains(parts, "none") & (F.size(parts) > 1), "none_with_others")
        .when(F.size(F.array_except(parts, F.array(*map(F.lit, [*allowed, "none"])))) > 0, "unknown")
        .when(F.coalesce(F.size(parts), F.lit(0)) < 1, "empty")
    )
    return stations.select("station_id", reason.alias("reason")).where("reason is not null")


def stations_with_variables(stations: DataFrame, capabilities: DataFrame) -> DataFrame:
    """Stations with the sorted array of their variables, empty where they have none."""
    lists = capabilities.groupBy("station_id").agg(F.array_sort(F.collect_set("variable_code")).alias("variables"))
    return stations.join(lists, "station_id", "left").withColumn("variables", F.coalesce("variables", F.array().cast("array<string>")))


def common_variables(stations: DataFrame, provider_variables: DataFrame, capabilities: DataFrame) -> DataFrame:
    """``station_id, variable_code, position``: variables that both provider and station have, in the provider's order."""
    offered = stations.select("station_id", "provider_code").join(F.broadcast(provider_variables), "provider_code")
    return offered.join(capabilities, ["station_id", "variable_code"]).select("station_id", "variable_code", "position")


def observed_days(obs: DataFrame) -> DataFrame:
    """``station_id, variable_code, day`` of the days with a value."""
    return obs.where("value is not null").select("station_id", "variable_code", F.to_date("observed_at").alias("day")).distinct()


def missing_days(wanted: DataFrame, observed: DataFrame, start: Column, end: Column, reference: Column) -> DataFrame:
    """``station_id, day`` to request: days on which any wanted variable is missing, and always the reference's day.

    ``wanted`` has ``station_id, variable_code``. The calendar is a generated array, so that the gaps are one anti join.
    """
    calendar = wanted.select("station_id", "variable_code", F.explode(request_days(start, end)).alias("day"))
    gaps = calendar.join(observed, ["station_id", "variable_code", "day"], "left_anti").select("station_id", "day")
    return gaps.union(wanted.select("station_id", F.to_date(reference).alias("day"))).distinct()


def resume_days(wanted: DataFrame, obs: DataFrame, start: Column, end: Column) -> DataFrame:
    """``station_id, day`` from the latest observed day of the station (again), or from the window's start."""
    latest = obs.where("value is not null").join(wanted, ["station_id", "variable_code"], "left_semi").groupBy("station_id").agg(F.max("observed_at").alias("latest"))
    stations = wanted.select("station_id").distinct().join(latest, "station_id", "left")
    first = F.coalesce("latest", start)
    return stations.select("station_id", F.explode(request_days(start, end, first)).alias("day"))


def fetch_windows(days: DataFrame, window_days: int, keys: list[str] | None = None) -> DataFrame:
    """``start_day, end_day``: runs of consecutive days, each cut after ``window_days`` days. Repeated days count once."""
    keys = keys if keys is not None else ["station_id"]
    rows = days.select(*keys, "day").where("day is not null").distinct()
    in_order = Window.partitionBy(*keys).orderBy("day")
    islands = rows.withColumn("island", F.date_sub("day", F.row_number().over(in_order)))
    place = F.row_number().over(Window.partitionBy(*keys, "island").orderBy("day")) - 1
    cut = islands.withColumn("part", F.floor(place / window_days))
    return cut.groupBy(*keys, "island", "part").agg(F.min("day").alias("start_day"), F.max("day").alias("end_day")).select(*keys, "start_day", "end_day")


def plan_requests(stations: DataFrame, provider_variables: DataFrame, capabilities: DataFrame, obs: DataFrame, start: Column, end: Column, reference: Column, window_days: int = 30) -> DataFrame:
    """``station_id, start_day, end_day`` of every request that fills the window's gaps."""
    wanted = common_variables(stations, provider_variables, capabilities).select("station_id", "variable_code")
    return fetch_windows(missing_days(wanted, observed_days(obs), start, end, reference), window_days)


def latest_observed(obs: DataFrame, variables: list[str] | None = None) -> DataFrame:
    """``station_id, state, latest``: the last time with a row of each station and state."""
    rows = obs if variables is None else obs.where(F.col("variable_code").isin(*variables))
    return rows.groupBy("station_id", "state").agg(F.max("observed_at").alias("latest"))


def fetch_summary(results: DataFrame) -> DataFrame:
    """``ok, no_data, error, rows`` over ``station_id, rows, failed`` of a fetch."""
    return results.agg(
        F.count_if(~F.col("failed") & (F.col("rows") > 0)).alias("ok"),
        F.count_if(~F.col("failed") & (F.col("rows") == 0)).alias("no_data"),
        F.count_if(F.col("failed")).alias("error"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
    )
