"""The registry of gridded assets, their manual edits, and the scenarios that follow from both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timeops import cycle_candidates, forecast_cycle, to_naive_utc
from .intervals import micros, newest_holding

ASSET_COLUMNS = ["asset_id", "asset_kind", "format", "relative_path", "provider_code", "checksum", "valid_from", "valid_to", "created_at"]


def with_metadata(assets: DataFrame, column: str = "metadata_json") -> DataFrame:
    """Assets with ``grid_type, cycle_time, box, providers`` of their JSON text; null where it has none."""
    text = F.col(column)
    return assets.withColumns({
        "grid_type": F.get_json_object(text, "$.type"),
        "cycle_time": to_naive_utc(F.get_json_object(text, "$.cycle_time")),
        "box": F.from_json(F.get_json_object(text, "$.bbox"), "array<double>"),
        "providers": F.from_json(F.get_json_object(text, "$.providers"), "array<string>"),
    })


def find_one(assets: DataFrame, column: str, value: str) -> DataFrame:
    """The asset whose ``asset_id`` or ``relative_path`` is the value, with the number of its rows, which must be 1."""
    return assets.where(F.col(column) == value).withColumn("n", F.count("*").over(Window.partitionBy(column)))


def listed(assets: DataFrame, kind: str | None = None, provider: str | None = None) -> DataFrame:
    """``place`` and the assets of a kind and provider, newest first by validity, else by creation.

    Places are given inside each provider and kind, so that no one task sorts them all.
    """
    rows = assets
    if kind is not None:
        rows = rows.where(F.col("asset_kind") == kind)
    if provider is not None:
        rows = rows.where(F.col("provider_code") == provider)
    order = Window.partitionBy("provider_code", "asset_kind").orderBy(F.coalesce("valid_from", "created_at").desc_nulls_last(), F.col("created_at").desc_nulls_last(), "asset_id")
    return rows.withColumn("place", F.row_number().over(order))


def covering(assets: DataFrame, at: Column, kind: str, keys: list[str] | None = None) -> DataFrame:
    """The newest asset of a kind that is valid at an instant, for each provider."""
    keys = keys or ["provider_code"]
    rows = assets.where((F.col("asset_kind") == kind) & (F.col("valid_from") <= at) & (F.col("valid_to") >= at))
    order = Window.partitionBy(*keys).orderBy(F.col("valid_from").desc(), F.col("created_at").desc(), "asset_id")
    return rows.withColumn("place", F.row_number().over(order)).where("place = 1").drop("place")


def as_of(points: DataFrame, assets: DataFrame, kind: str) -> DataFrame:
    """``point_id, asset_id`` of the newest asset valid at each point's instant, null without one.

    Validity is cut into dyadic bins of time, of which each keeps its newest asset; points meet the bins around them by
    equality. Work grows with assets plus points (times the logarithm of the longest validity), not with their pairs.
    """
    rows = assets.where(F.col("asset_kind") == kind).select("asset_id", "provider_code", "valid_from", "valid_to", "created_at")
    newest = F.struct((-micros(F.col("valid_from"))).alias("a"), F.coalesce(-micros(F.col("created_at")), F.lit(2**63 - 1)).alias("b"), F.col("asset_id").alias("asset_id"))
    found = newest_holding(points, rows, ["provider_code"], "point_id", "at", "valid_from", "valid_to", newest)
    return points.select("point_id").join(found.select("point_id", "best.asset_id"), "point_id", "left")


def of_cycle(wanted: DataFrame, assets: DataFrame, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """``provider_code, cycle_time, asset_id`` of the forecasts of exact cycles, if given only those that cover the window."""
    rows = assets.where("asset_kind = 'forecast_grid'").select("provider_code", F.col("valid_from").alias("cycle_time"), "asset_id", "valid_from", "valid_to")
    if start is not None:
        rows = rows.where((F.col("valid_from") <= start) & (F.col("valid_to") >= end))
    return wanted.join(rows, ["provider_code", "cycle_time"], "left").select("provider_code", "cycle_time", "asset_id")


def expected_asset(references: DataFrame, assets: DataFrame, lookback: int = 12) -> DataFrame:
    """``provider_code, reference, rank, asset_id, problem``: the newest registered cycle within the lookback.

    ``references`` has ``provider_code, reference`` (UTC). Rank 0 is the cycle that should be there; without any
    registered cycle the problem is ``unregistered_cycle``.
    """
    asked = references.withColumn("cycle", forecast_cycle(F.col("reference")))
    options = cycle_candidates(asked, "cycle", lookback).select("provider_code", "reference", "rank", F.col("candidate").alias("cycle_time"))
    registered = assets.where("asset_kind = 'forecast_grid'").select("provider_code", F.col("valid_from").alias("cycle_time"), "asset_id")
    found = options.join(registered, ["provider_code", "cycle_time"]).groupBy("provider_code", "reference").agg(F.min(F.struct("rank", "asset_id")).alias("best"))
    out = references.join(found, ["provider_code", "reference"], "left")
    return out.select("provider_code", "reference", "best.rank", "best.asset_id", F.when(F.col("best").isNull(), "unregistered_cycle").alias("problem"))


def update_actions(references: DataFrame, assets: DataFrame, lookback: int, end: Column) -> DataFrame:
    """``provider_code, reference, cycle_time, action``: the newest candidate cycle, reused if a registered grid covers it to the end, else to be produced."""
    asked = references.withColumn("cycle", forecast_cycle(F.col("reference")))
    options = cycle_candidates(asked, "cycle", lookback).select("provider_code", "reference", "rank", F.col("candidate").alias("cycle_time"))
    usable = assets.where("asset_kind = 'forecast_grid'").where(F.col("valid_to") >= end).select("provider_code", F.col("valid_from").alias("cycle_time")).distinct().withColumn("usable", F.lit(True))
    joined = options.join(usable, ["provider_code", "cycle_time"], "left")
    best = joined.groupBy("provider_code", "reference").agg(F.min_by("cycle_time", F.when(F.col("usable"), F.col("rank"))).alias("reused"), F.min_by("cycle_time", "rank").alias("newest"))
    return best.select("provider_code", "reference", F.coalesce("reused", "newest").alias("cycle_time"), F.when(F.col("reused").isNotNull(), "reuse").otherwise("produce").alias("action"))


def reusable(headers: DataFrame, wanted: dict) -> DataFrame:
    """Headers with ``reusable``: equal in every wanted column (null for None), a time span and a ``box`` that cover what is wanted.

    Lists, as the boxes of a header are, are equal item by item; a header without a value isn't reusable.
    """
    same = F.lit(True)
    for name, value in wanted.items():
        if name not in ("valid_from", "valid_to", "box"):
            same = same & (F.col(name).isNull() if value is None else F.col(name) == (F.array(*map(F.lit, value)) if isinstance(value, list | tuple) else value))
    if "valid_from" in wanted:
        same = same & (F.col("valid_from") <= wanted["valid_from"]) & (F.col("valid_to") >= wanted["valid_to"])
    if "box" in wanted:
        w, s, e, n = wanted["box"]
        same = same & (F.col("west") <= w) & (F.col("south") <= s) & (F.col("east") >= e) & (F.col("north") >= n)
    return headers.withColumn("reusable", F.coalesce(same, F.lit(False)))


def enabled_providers(assets: DataFrame, supported: list[str]) -> DataFrame:
    """``provider_code, supported`` of every provider with assets."""
    return assets.select("provider_code").distinct().withColumn("supported", F.col("provider_code").isin(*supported))


def edits_of(edits: DataFrame, asset: str | None = None) -> DataFrame:
    """Edits with their place in the order of an asset's steps and ids."""
    rows = edits if asset is None else edits.where(F.col("asset_id") == asset)
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("asset_id").orderBy("t0_step", "t1_step", "manual_edit_id")))


def overlapping_edits(edits: DataFrame) -> DataFrame:
    """``asset_id, manual_edit_id`` of edits that begin before an earlier one of their asset has ended; touching is allowed."""
    order = Window.partitionBy("asset_id").orderBy("t0_step", "t1_step", "manual_edit_id")
    ended = F.max("t1_step").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return edits.withColumn("ended", ended).where("t0_step < ended").select("asset_id", "manual_edit_id")


def newest_cycles(assets: DataFrame, start: Column, end: Column) -> DataFrame:
    """``provider_code, asset_id, valid_from, n``: the newest covering forecast of each provider; n over 1 is a tie, an error."""
    rows = assets.where("asset_kind = 'forecast_grid'").where((F.col("valid_from") <= start) & (F.col("valid_to") >= end))
    top = rows.withColumn("place", F.rank().over(Window.partitionBy("provider_code").orderBy(F.col("valid_from").desc()))).where("place = 1")
    return top.groupBy("provider_code").agg(F.min("asset_id").alias("asset_id"), F.max("valid_from").alias("valid_from"), F.count("*").alias("n"))


def tied_providers(assets: DataFrame, start: Column, end: Column) -> DataFrame:
    """``provider_code, n`` of providers whose newest covering cycle several assets have: an error, for which they have no scenarios."""
    return newest_cycles(assets, start, end).where("n > 1").select("provider_code", "n")


def scenarios(assets: DataFrame, edits: DataFrame, start: Column, end: Column) -> DataFrame:
    """``scenario_id, kind, asset_id, manual_edit_id``: zero, the raw newest forecast of each provider, one corrected for each of its edits.

    A provider without a single newest forecast has none; :func:`tied_providers` names it.
    """
    raw = newest_cycles(assets, start, end).where("n = 1").select("provider_code", "asset_id")
    none = F.lit(None).cast("string")
    a = raw.select(F.concat_ws(".", "provider_code", F.lit("raw")).alias("scenario_id"), F.lit("raw").alias("kind"), "asset_id", none.alias("manual_edit_id"))
    b = raw.join(edits.select("asset_id", "manual_edit_id"), "asset_id").select(F.concat_ws(".", "provider_code", F.lit("corrected"), "manual_edit_id").alias("scenario_id"), F.lit("corrected").alias("kind"), "asset_id", "manual_edit_id")
    zero = assets.agg(F.lit("zero").alias("scenario_id")).select("scenario_id", F.lit("zero").alias("kind"), none.alias("asset_id"), none.alias("manual_edit_id"))
    return zero.unionByName(a).unionByName(b)


def scenario_place(kind: Column, scenario: Column) -> list[Column]:
    """Zero, raw, corrected, then by id."""
    return [F.when(kind == "zero", 0).when(kind == "raw", 1).otherwise(2), scenario]


def classify_ingest(new: DataFrame, registered: DataFrame) -> DataFrame:
    """``asset_id, action`` of an immutable ingest: insert, same (all fields equal), replace (same id and provider, older creation), conflict."""
    fields = [c for c in ASSET_COLUMNS if c not in ("asset_id", "created_at")]
    old = registered.select("asset_id", F.lit(True).alias("known"), *(F.col(c).alias(f"old_{c}") for c in [*fields, "created_at"]))
    joined = new.join(old, "asset_id", "left")
    same = F.lit(True)
    for c in fields:
        same = same & F.col(c).eqNullSafe(F.col(f"old_{c}"))
    action = F.when(F.col("known").isNull(), "insert").when(same, "same").when((F.col("provider_code") == F.col("old_provider_code")) & (F.col("created_at") > F.col("old_created_at")), "replace").otherwise("conflict")
    return joined.select("asset_id", action.alias("action"))


def unregistered_cells(assets: DataFrame, cells: DataFrame) -> DataFrame:
    """``asset_id`` of registered assets of which there are no cells."""
    return assets.select("asset_id").join(cells.select("asset_id").distinct(), "asset_id", "left_anti")
