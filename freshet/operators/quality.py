"""Checks as rows of ``rule_code, subject, passed, severity, message``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .grids import gaps
from .registry import overlapping_edits, unregistered_cells


def result(rule: str, subject: Column, passed: Column, message: Column, severity: str = "error") -> list[Column]:
    return [F.lit(rule).alias("rule_code"), subject.cast("string").alias("subject"), passed.alias("passed"), F.when(passed, "info").otherwise(severity).alias("severity"), F.when(passed, "").otherwise(message).alias("message")]


def station_availability(stations: DataFrame, values: DataFrame, required: list[str]) -> DataFrame:
    """A warning for each station without rows or without a value of a required variable."""
    found = values.where("value is not null").groupBy("station_id").agg(F.collect_set("variable_code").alias("have"))
    joined = stations.select("station_id").join(found, "station_id", "left")
    missing = F.array_sort(F.array_except(F.array(*map(F.lit, required)), F.coalesce("have", F.array().cast("array<string>"))))
    return joined.select(*result("station_availability", F.col("station_id"), F.size(missing) == 0, F.concat(F.lit("missing: "), F.array_join(missing, ",")), "warning"))


def grid_contract(cells: DataFrame) -> DataFrame:
    """One row for each asset and rule: intervals that follow each other, unique cells, equal spacing of both axes."""
    follow = gaps(cells).select(*result("contiguous", F.col("asset_id"), F.col("gaps") == 0, F.concat(F.col("gaps").cast("string"), F.lit(" gaps"))))
    twice = cells.groupBy("asset_id", "start_utc", "end_utc", "iy", "ix").count().groupBy("asset_id").agg(F.count_if(F.col("count") > 1).alias("n"))
    unique = twice.select(*result("unique_cells", F.col("asset_id"), F.col("n") == 0, F.concat(F.col("n").cast("string"), F.lit(" repeated"))))
    out = follow.union(unique)
    for name in ("lat", "lon"):
        axis = cells.select("asset_id", F.round(name, 9).alias("c")).distinct().withColumn("step", F.col("c") - F.lag("c").over(Window.partitionBy("asset_id").orderBy("c")))
        spread = axis.groupBy("asset_id").agg((F.max("step") - F.min("step")).alias("spread"))
        out = out.union(spread.select(*result(f"regular_{name}", F.col("asset_id"), F.coalesce(F.col("spread") < 1e-6, F.lit(True)), F.lit("uneven steps"))))
    return out


def model_contract(output: DataFrame) -> DataFrame:
    """One row for each scenario and rule: segments of 0 and 1, one value for each time, current before forecast."""
    keys = ["scenario_id", "variable_code", "mini_id"]
    per = output.groupBy("scenario_id").agg(
        F.count_if(~F.col("prev_flag").isin(0, 1)).alias("odd"), F.max(F.when(F.col("prev_flag") == 0, F.col("dt"))).alias("current"), F.min(F.when(F.col("prev_flag") == 1, F.col("dt"))).alias("forecast")
    )
    twice = output.groupBy(*keys, "dt").count().groupBy("scenario_id").agg(F.count_if(F.col("count") > 1).alias("n"))
    segments = per.select(*result("segments", F.col("scenario_id"), F.col("odd") == 0, F.lit("unknown segment")))
    order = per.select(*result("segment_order", F.col("scenario_id"), F.coalesce(F.col("current") < F.col("forecast"), F.lit(True)), F.lit("forecast before current")))
    return segments.union(order).union(twice.select(*result("unique_times", F.col("scenario_id"), F.col("n") == 0, F.lit("repeated times"))))


def precipitation(values: DataFrame, key: str) -> DataFrame:
    """``empty``, ``infinite`` or ``negative`` values are errors, values none of which is finite a warning."""
    v = F.col("value")
    finite = v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    found = values.groupBy(key).agg(F.count("*").alias("n"), F.count_if(F.abs(v) == float("inf")).alias("infinite"), F.count_if(v < 0).alias("negative"), F.count_if(finite).alias("finite"))
    problem = F.when(F.col("n") == 0, "empty").when(F.col("infinite") > 0, "infinite").when(F.col("negative") > 0, "negative").when(F.col("finite") == 0, "no_finite")
    rows = found.withColumn("problem", problem)
    severity = F.when(F.col("problem").isNull(), "info").when(F.col("problem") == "no_finite", "warning").otherwise("error")
    return rows.select(F.lit("precipitation").alias("rule_code"), F.col(key).cast("string").alias("subject"), F.col("problem").isNull().alias("passed"), severity.alias("severity"), F.coalesce("problem", F.lit("")).alias("message"))


def correction_windows(edits: DataFrame, steps: DataFrame) -> DataFrame:
    """Whether ``0 <= t0 < t1`` and both are steps of the asset (``asset_id, step``)."""
    have = steps.groupBy("asset_id").agg(F.collect_set("step").alias("steps"))
    rows = edits.join(have, "asset_id", "left")
    there = F.array_contains("steps", F.col("t0_step")) & F.array_contains("steps", F.col("t1_step"))
    ok = (F.col("t0_step") >= 0) & (F.col("t0_step") < F.col("t1_step")) & F.coalesce(there, F.lit(False))
    return rows.select(*result("correction_window", F.col("manual_edit_id"), ok, F.lit("not between available steps")))


def correction_overlaps(edits: DataFrame) -> DataFrame:
    bad = overlapping_edits(edits).groupBy("asset_id").agg(F.count("*").alias("n"))
    rows = edits.select("asset_id").distinct().join(bad, "asset_id", "left")
    return rows.select(*result("correction_overlap", F.col("asset_id"), F.col("n").isNull(), F.concat(F.col("n").cast("string"), F.lit(" overlap"))))


def instructions(edits: DataFrame) -> DataFrame:
    """Whether parameters are finite, the factor positive, and the end not before the start."""
    finite = F.lit(True)
    for c in ("shift_lat", "shift_lon", "rotation_deg", "multiplication_factor"):
        v = F.col(c).cast("double")
        finite = finite & v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    ok = finite & (F.col("multiplication_factor") > 0) & (F.col("t1_step") >= F.col("t0_step"))
    return edits.select(*result("instruction", F.col("manual_edit_id"), F.coalesce(ok, F.lit(False)), F.lit("invalid parameters")))


def stale(output: DataFrame, start: Column, end: Column) -> DataFrame:
    """Whether the first and last time of each scenario are those of the expected window."""
    found = output.groupBy("scenario_id").agg(F.min("dt").alias("first"), F.max("dt").alias("last"))
    return found.select(*result("stale_output", F.col("scenario_id"), (F.col("first") == start) & (F.col("last") == end), F.lit("another window")))


def registry_integrity(assets: DataFrame, cells: DataFrame) -> DataFrame:
    lost = unregistered_cells(assets, cells).withColumn("lost", F.lit(True))
    rows = assets.select("asset_id").distinct().join(lost, "asset_id", "left")
    return rows.select(*result("registered_data", F.col("asset_id"), F.col("lost").isNull(), F.lit("no cells")))
