"""File scans: inventories, reference levels, observation files, provider XML and JSON, matrices, centroids.

Schemas are declared, never inferred. A scan returns rows and, where files may be wrong, a table of errors; a load looks
at the errors before it writes anything.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.timeops import parse_observed, parse_provider
from .matrix import matrix_file, matrix_values, write_matrix  # noqa: F401

INVENTORY = ("provider_code", "station_code", "station_name", "mini_id", "latitude", "longitude", "altitude_m", "observed_variables")
CANONICAL = ("provider_code", "station_code", "observed_at", "variable_code", "value")
LEGACY = ("station_id", *CANONICAL, "state")
#: Names that a provider's JSON rows may use for time and value, the first present counts (fixed values).
TIME_KEYS = ("timestamp", "datetime", "data_hora", "dataHora", "data", "time")
VALUE_KEYS = ("value", "chuva", "valor")


def read_text_csv(spark: SparkSession, path: str, columns: tuple[str, ...], **options: str) -> DataFrame:
    """A CSV with a header of exactly these columns as text; rows with too many fields fail the read."""
    schema = ", ".join(f"{c} string" for c in columns)
    return spark.read.schema(schema).options(header="true", mode="FAILFAST", enforceSchema="false", **options).csv(path)


def stations_of(inventory: DataFrame) -> DataFrame:
    """Normalised stations of inventory rows that are text."""
    code = F.when(F.lower(F.trim("provider_code")) == "ana", T.station_code(F.col("station_code"))).otherwise(T.station_code(F.col("station_code"), strip_zeros=False))
    provider = F.lower(F.trim("provider_code"))
    return inventory.select(
        T.station_id(provider, code).alias("station_id"), provider.alias("provider_code"), code.alias("station_code"), T.station_name(F.col("station_name")).alias("station_name"), T.nullable_int(F.col("mini_id")).alias("mini_id"),
        T.coordinate(F.col("latitude")).alias("latitude"), T.coordinate(F.col("longitude")).alias("longitude"), T.nullable_int(F.col("altitude_m")).alias("altitude_m"), F.lower(F.trim("observed_variables")).alias("observed_variables"),
    )


def inventory_errors(stations: DataFrame) -> DataFrame:
    """``key, reason``: stations without code, repeated stations, and minis on two stations."""
    none = stations.where("station_code is null").select(F.coalesce("provider_code", F.lit("")).alias("key"), F.lit("code").alias("reason"))
    twice = stations.groupBy("station_id").count().where("count > 1").select("station_id", F.lit("repeated"))
    minis = stations.where("mini_id is not null").groupBy("mini_id").count().where("count > 1").select(F.col("mini_id").cast("string"), F.lit("mini"))
    return none.union(twice).union(minis)


def reference_levels(wide: DataFrame, stations: DataFrame) -> DataFrame:
    """``station_id, reference_type, level_cm`` of a table with a column for each kind; blanks and unknown stations are left out."""
    kinds = ["level_atention", "level_alert", "level_flood", "level_severe"]
    long = wide.select("station_code", *kinds).unpivot(["station_code"], kinds, "reference_type", "level_cm")
    rows = long.select(T.station_code(F.col("station_code")).alias("station_code"), "reference_type", T.decimal_comma(F.col("level_cm").cast("string")).alias("level_cm")).where("level_cm is not null")
    return rows.join(stations.select("station_id", "station_code"), "station_code").select("station_id", "reference_type", "level_cm")


def floods(rows: DataFrame, stations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``station_id, event_date, level_cm``, errors): level and ISO date are required, a triple may not repeat."""
    parsed = rows.select(T.station_code(F.col("station_code")).alias("station_code"), T.decimal_comma(F.col("level_registered").cast("string")).alias("level_cm"), F.try_to_date("date", "yyyy-MM-dd").alias("event_date"))
    known = parsed.join(stations.select("station_id", "station_code"), "station_code").select("station_id", "event_date", "level_cm")
    bad = known.where("level_cm is null or event_date is null").select("station_id", F.lit("missing").alias("reason"))
    twice = known.groupBy("station_id", "event_date", "level_cm").count().where("count > 1").select("station_id", F.lit("repeated").alias("reason"))
    return known.where("level_cm is not null and event_date is not null"), bad.union(twice)


def observations(spark: SparkSession, path: str, legacy: bool = False, glob: str | None = None) -> DataFrame:
    """Rows of observation files with the file they come from and the order in which they came."""
    options = {"recursiveFileLookup": "true"} | ({"pathGlobFilter": glob} if glob else {})
    rows = read_text_csv(spark, path, LEGACY if legacy else CANONICAL, **options)
    return rows.select("*", F.col("_metadata.file_path").alias("file_path"), F.monotonically_increasing_id().alias("row_seq"))


def typed_observations(rows: DataFrame, state: str = "raw") -> DataFrame:
    """Observation rows with ``station_id``, local time, value, state and ``arrival_seq``; what can't be read is null."""
    own = F.coalesce(F.col("state"), F.lit(state)) if "state" in rows.columns else F.lit(state)
    order = F.struct("file_path", "row_seq")
    return rows.select(
        T.station_id(F.trim("provider_code"), F.trim("station_code")).alias("station_id"), *([F.col("station_id").alias("given_id")] if "station_id" in rows.columns else [F.lit(None).cast("string").alias("given_id")]),
        F.trim("provider_code").alias("provider_code"), parse_observed(F.col("observed_at")).alias("observed_at"), F.trim("variable_code").alias("variable_code"), T.decimal_comma(F.col("value")).alias("value"), own.alias("state"), order.alias("arrival_seq"),
    )


def with_reason(typed: DataFrame, stations: DataFrame, provider_variables: DataFrame) -> DataFrame:
    """Typed rows with the ``reason`` why a row makes a load fail: id, station, variable, time or value; null if it doesn't."""
    known = typed.join(stations.select("station_id", F.lit(True).alias("known")).distinct(), "station_id", "left")
    # a row for each variable of a provider: as keys of a shuffle, so few would put most rows into few tasks
    offered = provider_variables.select("provider_code", "variable_code", F.lit(True).alias("offered")).distinct()
    known = known.join(F.broadcast(offered), ["provider_code", "variable_code"], "left")
    reason = (
        F.when(F.col("given_id").isNotNull() & (F.col("given_id") != F.col("station_id")), "id")
        .when(F.col("known").isNull(), "station")
        .when(F.col("offered").isNull(), "variable")
        .when(F.col("observed_at").isNull(), "time")
        .when(F.col("value").isNull() | F.isnan("value"), "value")
    )
    return known.select(*typed.columns, reason.alias("reason"))


def observation_errors(typed: DataFrame, stations: DataFrame, provider_variables: DataFrame) -> DataFrame:
    """``station_id, reason, n`` of rows that make a load fail."""
    return with_reason(typed, stations, provider_variables).where("reason is not null").groupBy("station_id", "reason").agg(F.count("*").alias("n"))


def discovered(rows: DataFrame, run: str | None = None, stations: list[str] | None = None) -> DataFrame:
    """``run, station_code, file_path`` of files at ``.../run=<run>/...``, of one run and some stations if given.

    A station is that of the file's folder (``station_code=`` or ``station=``), or else each one that the file has rows of.
    """
    path = F.col("file_path")
    folder = F.nullif(F.regexp_extract(path, r"/station(?:_code)?=([^/]+)/", 1), F.lit(""))
    station = F.coalesce(folder, F.trim("station_code")) if "station_code" in rows.columns else folder
    found = rows.select(path, F.regexp_extract(path, r"/run=([^/]+)/", 1).alias("run"), station.alias("station_code")).distinct()
    if run is not None:
        found = found.where(F.col("run") == run)
    return found if stations is None else found.where(F.col("station_code").isin(*stations))


def provider_xml(rows: DataFrame, column: str = "payload", station: Column | None = None) -> DataFrame:
    """``station_code, observed_at, rain, level, flow`` of XML texts, one element for each observation.

    Undated rows and rows without any value are left out, and with ``station`` those of other codes.
    """
    schema = "CodEstacao string, DataHora string, Nivel string, Chuva string, Vazao string"
    # a generator's output isn't put into the filters below in its place, so that a text is parsed once
    parsed = rows.select("*", F.explode(F.array(F.from_xml(F.col(column), F.lit(schema)))).alias("x"))
    number = {n: T.decimal_comma(F.col(f"x.{c}")) for n, c in (("rain", "Chuva"), ("level", "Nivel"), ("flow", "Vazao"))}
    out = parsed.select(T.station_code(F.col("x.CodEstacao")).alias("station_code"), parse_provider(F.col("x.DataHora")).alias("observed_at"), *(v.alias(n) for n, v in number.items()), *([station.alias("asked")] if station is not None else []))
    kept = out.where("observed_at is not null and coalesce(rain, level, flow) is not null")
    return kept if station is None else kept.where("asked = station_code").drop("asked")


def provider_json(rows: DataFrame, column: str = "payload") -> DataFrame:
    """``station_code, given_code, observed_at, rain`` of JSON texts: ``{data:{data:[..]}}``, ``{data:[..]}`` or ``[..]``.

    Entries are ``[milliseconds, value]`` pairs or objects with one of several names for time and value.
    """
    v = F.try_parse_json(column)
    entries = F.coalesce(*(F.from_json(F.to_json(F.try_variant_get(v, p, "variant")), "array<string>") for p in ("$.data.data", "$.data", "$")))
    each = rows.select("station_code", F.explode(entries).alias("e")).withColumn("v", F.try_parse_json("e"))
    pair = F.col("e").startswith("[")

    def first(keys: tuple[str, ...], at: int) -> Column:
        named = F.coalesce(*(F.try_variant_get("v", f"$.{k}", "string") for k in keys))
        return F.when(pair, F.try_variant_get("v", f"$[{at}]", "string")).otherwise(named)

    return each.select(
        "station_code", F.when(~pair, F.try_variant_get("v", "$.codigo", "string")).alias("given_code"), parse_provider(first(TIME_KEYS, 0)).alias("observed_at"), T.decimal_comma(first(VALUE_KEYS, 1)).alias("rain")
    )


def to_records(matrix: DataFrame) -> DataFrame:
    """``t, record``: each row's array of numbers as 32-bit floats in little-endian order."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([np.array(x, "<f4").tobytes() for x in b.column(1).to_pylist()], pa.binary())], ["t", "record"])

    return matrix.select(F.col("t").cast("long").alias("t"), F.col("row").cast("array<double>").alias("row")).mapInArrow(run, "t long, record binary")


def from_records(records: DataFrame, nc: int) -> DataFrame:
    """``t, position, value`` of ``t, record``; a record of another length than ``nc`` floats is an error."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, packed = b.num_rows, b.column(1).cast(pa.binary())
            if packed.null_count or set(pc.unique(pc.binary_length(packed)).to_pylist()) - {4 * nc}:
                raise ValueError(f"a record hasn't {nc} values")
            start = int(np.frombuffer(packed.buffers()[1], "<i4")[packed.offset]) if n else 0
            values = np.frombuffer(packed.buffers()[2], "<f4", nc * n, start).astype(float) if n else np.empty(0)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(b.column(0).to_numpy(), nc)), pa.array(np.tile(np.arange(nc, dtype=np.int32), n)), pa.array(values)], ["t", "position", "value"])

    return records.mapInArrow(run, "t long, position int, value double")


def timesteps(sources: DataFrame) -> DataFrame:
    """``nt, sources``: how many sources (``source, t``) have each number of timesteps; more than one row is an error."""
    return sources.groupBy("source").agg(F.count("*").alias("nt")).groupBy("nt").agg(F.count("*").alias("sources"))


def centroids(lines: DataFrame, nc: int) -> DataFrame:
    """``mini_id, lon, lat`` of the first ``nc`` rows of a table of words with ``Mini, Xcen, Ycen`` in its header.

    ``lines`` has ``value`` and ``n``, the line's number; numbers may have decimal commas.
    """
    words = lines.select("n", F.split(F.trim("value"), r"\s+").alias("w")).where("w[0] <> ''")
    head = words.where(F.array_contains("w", "Mini")).agg(F.min_by("w", "n").alias("h"), F.min("n").alias("first"))
    rows = words.join(F.broadcast(head)).where("n > first")
    at = [F.element_at("w", F.array_position("h", c).cast("int")) for c in ("Mini", "Xcen", "Ycen")]
    out = rows.select("n", at[0].cast("bigint").alias("mini_id"), T.decimal_comma(at[1]).alias("lon"), T.decimal_comma(at[2]).alias("lat"))
    return first_lines(out, nc).select("mini_id", "lon", "lat")


def first_lines(lines: DataFrame, nc: int) -> DataFrame:
    """The first ``nc`` rows of a text table by their line number ``n``."""
    return lines.orderBy("n").limit(nc)


def centroid_errors(minis: DataFrame) -> DataFrame:
    return minis.groupBy("mini_id").count().where("count > 1 or mini_id is null").select("mini_id")


def mini_layer(attributes: DataFrame) -> DataFrame:
    """Catchments with whole ids and the key by which they are picked; rows without a whole id are left out."""
    return attributes.where("mini_id is not null and mini_id % 1 = 0").withColumn("mini_id", F.col("mini_id").cast("bigint")).withColumn("click_id", F.concat_ws("|", F.lit("MINI"), F.col("mini_id").cast("string")))


def current_batch(published: DataFrame, pointer: DataFrame, reference: Column | None = None) -> DataFrame:
    """Rows of the batch that the pointer names, at one reference time if given."""
    rows = published.join(F.broadcast(pointer.select("batch_id")), "batch_id", "left_semi")
    return rows if reference is None else rows.where(F.col("reference_time") == reference)


def latest_rows(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(order).desc()))).where("place = 1").drop("place")
