"""Continuous ingest of observation files, in any order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.timeops import bucket_end, check_timestep, parse_observed
from ..operators.observations import KEYS, METHODS
from ..sources import versioned

SCHEMA = "provider_code string, station_code string, observed_at string, variable_code string, value string"


def read_stream(spark: SparkSession, path: str, state: str = "raw", files_per_trigger: int | None = None) -> DataFrame:
    """``station_id, variable_code, state, observed_at, value`` of files as they arrive; wrong rows are left out."""
    reader = spark.readStream.schema(SCHEMA).option("header", True).option("recursiveFileLookup", True)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    rows = reader.csv(path)
    typed = rows.select(F.concat_ws(":", "provider_code", "station_code").alias("station_id"), "variable_code", F.lit(state).alias("state"), parse_observed(F.col("observed_at")).alias("observed_at"), F.expr("try_cast(value as double)").alias("value"))
    return typed.where("observed_at is not null and value is not null and not isnan(value)")


def partial_buckets(rows: DataFrame, timestep_hours: int) -> DataFrame:
    """``series_id, observed_at, day, mean, total, n`` of the right-closed timesteps of some rows: sums and counts, which add up.

    Variables without a method don't count, as in a batch load.
    """
    check_timestep(timestep_hours)
    mean = F.lit(None).cast("boolean")
    for variable, method in METHODS.items():
        mean = F.when(F.col("variable_code") == variable, method == "mean").otherwise(mean)
    end = bucket_end(F.col("observed_at"), timestep_hours).cast("timestamp_ntz")
    grouped = rows.where(F.col("variable_code").isin(*METHODS)).groupBy(F.concat_ws(".", *KEYS).alias("series_id"), end.alias("observed_at"), mean.alias("mean")).agg(F.sum("value").alias("total"), F.count("*").alias("n"))
    return grouped.withColumn("day", F.to_date("observed_at"))


def added(old: DataFrame, new: DataFrame) -> DataFrame:
    """Timesteps of both, with the sums of their sums and counts."""
    keys = ["series_id", "observed_at", "day", "mean"]
    return old.select(*new.columns).unionByName(new).groupBy(*keys).agg(F.sum("total").alias("total"), F.sum("n").cast("long").alias("n"))


def values(spark: SparkSession, target: str) -> DataFrame:
    """``series_id, observed_at, value`` of all timesteps so far."""
    rows = versioned.read(spark, target)
    return rows.select("series_id", "observed_at", F.when(F.col("mean"), F.col("total") / F.col("n")).otherwise(F.col("total")).alias("value"))


def start(spark: SparkSession, source: str, target: str, checkpoint: str, timestep_hours: int, files_per_trigger: int | None = None) -> StreamingQuery:
    """Add each micro-batch to the timesteps that it touches, in a versioned table partitioned by day; :func:`values` reads it.

    A timestep is kept as sum and count, to which any later row adds: there is no watermark, nothing is too late, and no
    state grows with the stream. Only the days that a batch touches are read and written, as one commit that has the
    batch's number, so that a batch that is run again after a failure isn't added twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        versioned.upsert(batch.sparkSession, target, partial_buckets(batch, timestep_hours), "day", added, writer=checkpoint, batch=number)

    rows = read_stream(spark, source, files_per_trigger=files_per_trigger)
    return rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start()
