"""Composed jobs: ingest, forcing, export, scenario forcings, grid registration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.text import to_centimetres
from ..functions.timeops import local_to_utc, plus_hours, segments
from ..operators import grids, observations, series
from ..sources import scans, sinks


def ingest(obs: DataFrame, timestep_hours: int) -> tuple[DataFrame, DataFrame]:
    """(series, values) of one load: values by series and timestep end."""
    buckets = observations.bucket_values(obs, timestep_hours)
    keyed = buckets.withColumn("series_id", F.concat_ws(".", *observations.KEYS))
    return observations.series_of(buckets), keyed.select("series_id", "observed_at", "value")


def ingest_files(typed: DataFrame, stations: DataFrame, provider_variables: DataFrame, timestep_hours: int) -> tuple[DataFrame, DataFrame]:
    """:func:`ingest` of typed file rows, all or nothing: raises with the first reasons where any row is wrong."""
    errors = scans.observation_errors(typed, stations, provider_variables).limit(5).collect()
    if errors:
        raise ValueError("; ".join(f"{e.station_id}: {e.reason} ({e.n})" for e in errors))
    return ingest(typed, timestep_hours)


def load_files(spark: SparkSession, path: str, typed: DataFrame, stations: DataFrame, provider_variables: DataFrame, timestep_hours: int) -> dict[str, int]:
    """Load typed file rows into the table of values at ``path``, all or nothing, in one pass over the files; returns ``rows_read, rows_written``.

    What is wrong is counted while the timesteps are made: with any wrong row it raises, before the table has changed.
    """
    seen = Observation()
    marked = scans.with_reason(typed, stations, provider_variables)
    first = F.min(F.when(F.col("reason").isNotNull(), F.concat_ws(": ", "station_id", "reason")))
    counted = marked.observe(seen, F.count(F.lit(1)).alias("rows"), F.count("reason").alias("wrong"), first.alias("first"))
    values = ingest(counted.where("reason is null"), timestep_hours)[1].withColumn("day", F.to_date("observed_at"))

    def check() -> None:
        if seen.get["wrong"]:
            raise ValueError(f"{seen.get['wrong']} of {seen.get['rows']} rows are wrong, as {seen.get['first']}")

    written = sinks.upsert_values(spark, path, values, check=check)
    return {"rows_read": seen.get["rows"], "rows_written": written}


def forcing(observed: DataFrame, forecast: DataFrame | None, zero: DataFrame | None, minis: DataFrame, k: int = 5, power: float = 2.0, strict: bool = True) -> DataFrame:
    """``dt, mini_id, value``: observed block and then forecast (or zero) block of catchment rainfall.

    ``observed`` and ``forecast`` are working grids of ``end_utc, iy, ix, lat, lon, value``; neighbours of each are fixed.
    With ``strict`` a cell that either grid has at some step must have a value at all steps of both: else it raises.
    """
    points = minis.select(F.col("mini_id").alias("target_id"), "lat", "lon")
    if strict:
        grids_ = [g.select(F.concat_ws(":", "iy", "ix").alias("target_id"), "end_utc", "value") for g in (observed, forecast) if g is not None]
        every = grids_[0].select("target_id") if len(grids_) == 1 else grids_[0].select("target_id").unionByName(grids_[1].select("target_id"))
        for g in grids_:
            grids.complete(g, every.distinct(), ["end_utc"])

    def block(cells: DataFrame) -> DataFrame:
        return grids.grid_to_points(cells, points, k, power).select(F.col("end_utc").alias("dt"), F.col("target_id").alias("mini_id"), "value")

    ahead = block(forecast) if forecast is not None else zero
    return block(observed) if ahead is None else block(observed).unionByName(ahead)


def shape_errors(forced: DataFrame, minis: DataFrame, nt: int) -> DataFrame:
    """Minis that haven't exactly ``nt`` values, or have a missing one."""
    found = forced.groupBy("mini_id").agg(F.count("*").alias("n"), F.count("value").alias("present"))
    return minis.select("mini_id").join(found, "mini_id", "left").where((F.coalesce("n", F.lit(0)) != nt) | (F.coalesce("present", F.lit(0)) != nt)).select("mini_id", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("present", F.lit(0)).alias("present"))


def station_forcing(values: DataFrame, stations: DataFrame, minis: DataFrame, axis: DataFrame, k: int = 5, power: float = 2.0) -> DataFrame:
    """Catchment rainfall straight from stations: a full matrix of station and time, absent as 0, by fixed neighbours."""
    points = minis.select(F.col("mini_id").alias("target_id"), "lat", "lon")
    inside = values.join(F.broadcast(axis.select(F.col("dt").alias("observed_at"))), "observed_at", "left_semi")
    have = grids.with_values(inside).select("station_id").distinct()
    sources = have.join(stations, "station_id").select(F.col("station_id").alias("source_id"), "lat", "lon")

    def block(places: DataFrame) -> DataFrame:
        # the matrix has the stations that are a neighbour of some place, not all
        weights = grids.idw_weights(places, sources, k, power)
        near = values.join(weights.select(F.col("source_id").alias("station_id")).distinct(), "station_id", "left_semi")
        return grids.apply_weights(weights, grids.station_matrix(near, axis).withColumnRenamed("station_id", "source_id"))

    return grids.for_places(points, block).select("dt", F.col("target_id").alias("mini_id"), "value")


def export(cells: DataFrame, minis: DataFrame, variable: str, start: Column, reference: Column, timestep_hours: int) -> DataFrame:
    """``mini_id, variable_code, dt, time_segment, value`` of decoded records ``t, position, value``; levels in centimetres."""
    placed = segments(cells, "t", start, reference, timestep_hours).join(minis.select("mini_id", "position"), "position")
    return placed.select("mini_id", F.lit(variable).alias("variable_code"), "dt", "time_segment", to_centimetres(F.col("value"), F.lit(variable)).alias("value"))


def scenario_forcings(scenarios: DataFrame, cells: DataFrame, edits: DataFrame, targets: DataFrame, origin: tuple[float, float], resolution: float, timestep_hours: int, strict: bool = True) -> DataFrame:
    """``scenario_id, end_utc, target_id, value`` of every scenario in one job: the scenario is one more key.

    With ``strict`` a scenario whose grid lacks a value at any target is an error.
    """
    mine = scenarios.where("kind <> 'zero'").select("scenario_id", "asset_id", "manual_edit_id")
    rows = cells.join(mine, "asset_id").drop("asset_id").withColumnRenamed("scenario_id", "asset_id")
    chosen = mine.where("manual_edit_id is not null").join(edits.drop("asset_id"), "manual_edit_id").drop("asset_id").withColumnRenamed("scenario_id", "asset_id")
    out = grids.forecast_working_grid(rows.select(*cells.columns), chosen, targets, origin, resolution, timestep_hours, strict)
    return out.withColumnRenamed("asset_id", "scenario_id")


def registered_grid(messages: DataFrame, cycle: Column, provider: str) -> DataFrame:
    """Registry rows of the canonical grids of some assets' messages, edges and resolution as JSON metadata."""
    cells, header = grids.canonical_grid(messages, cycle, ["tp", "apcp"], 1.0)
    spans = cells.groupBy("asset_id").agg(F.min("start_utc").alias("valid_from"), F.max("end_utc").alias("valid_to"))
    box = F.array("west", "south", "east", "north")
    meta = F.to_json(F.struct(box.alias("bbox"), F.date_format(cycle, "yyyy-MM-dd'T'HH:mm:ss").alias("cycle_time"), F.array(F.lit(provider)).alias("providers"), F.lit("forecast").alias("type")))
    return spans.join(header, "asset_id").select("asset_id", F.lit("forecast_grid").alias("asset_kind"), F.lit(provider).alias("provider_code"), "valid_from", "valid_to", meta.alias("metadata_json"))


def local_axis_utc(axis: DataFrame) -> DataFrame:
    """``end_utc`` of an axis of local times."""
    return axis.select(local_to_utc(F.col("dt")).alias("end_utc"))


def level_of_minis(output: DataFrame, stations: DataFrame, all_series: DataFrame, stored: DataFrame) -> DataFrame:
    """``mini_id, dt, prev_flag, value``: modelled levels moved to the observed level of each mini's only station.

    Minis without a station, or whose station has no common time, have no rows.
    """
    owner = series.mini_station(stations).where("station_id is not null").select("mini_id", "station_id")
    levels = series.preferred_series(all_series.where("variable_code = 'level'"))
    seen = series.values_of(levels, stored).join(owner, "station_id").select("mini_id", "observed_at", "value")
    return series.adjusted_level(output.where("variable_code = 'level'"), seen, ["mini_id"])


def next_step(ts: Column, timestep_hours: int) -> Column:
    return plus_hours(ts, timestep_hours)
