"""Intervals and the points in them, by equality: an interval is cut into dyadic bins, a point is in one bin of each level.

A bin of level l holds 2 ** l units. An interval of n units has at most two bins of each level up to log2(n), and each of
its points is in exactly one of them, so that a join by level and bin makes one row for each interval and point that it
holds, and none else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Names of a bin's columns.
BIN = ["bin_level", "bin"]
#: Microseconds of the units of time that are tried, and the level of the keys of single instants.
UNITS, INSTANT = (3_600_000_000, 60_000_000, 1_000_000, 1_000, 1), -1


def depth_of(longest: int | None) -> int:
    """The highest level that an interval of so many units can have a bin of."""
    return max(int(longest or 1), 1).bit_length() - 1


def _floor(value: Column, level: Column) -> Column:
    return F.call_function("shiftright", value, level)


def bins_of_spans(rows: DataFrame, first: Column, after: Column, depth: int) -> DataFrame:
    """Each row once for every bin of the units ``first`` to before ``after`` (64-bit integers); an empty or null span has none."""
    spans = rows.withColumns({"_first": first.cast("long"), "_after": after.cast("long")})

    def of_level(level: Column) -> Column:
        a, b = -_floor(-F.col("_first"), level), _floor(F.col("_after"), level)
        left = F.when((a < b) & (F.pmod(a, F.lit(2)) == 1), F.struct(level.alias(BIN[0]), a.alias(BIN[1])))
        right = F.when((a < b) & (F.pmod(b, F.lit(2)) == 1), F.struct(level.alias(BIN[0]), (b - 1).alias(BIN[1])))
        return F.array_compact(F.array(left, right))

    bins = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(depth)), of_level))
    return spans.withColumn("_bin", F.explode(bins)).select(*rows.columns, *(F.col(f"_bin.{c}").alias(c) for c in BIN))


def bins_of_points(rows: DataFrame, at: Column, depth: int) -> DataFrame:
    """Each row once for the bin of every level that its unit ``at`` is in."""
    spread = rows.withColumn("_at", at.cast("long")).withColumn(BIN[0], F.explode(F.sequence(F.lit(0), F.lit(depth))))
    return spread.select(*rows.columns, BIN[0], _floor(F.col("_at"), F.col(BIN[0])).alias(BIN[1]))


def micros(time: Column) -> Column:
    """Microseconds of a time without a zone since 1970."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), time.cast("timestamp_ntz"))


def whole_units(value: Column, unit: int) -> Column:
    """Floor of a 64-bit integer by a number of units."""
    return F.call_function("div", value - F.pmod(value, F.lit(unit).cast("long")), F.lit(unit).cast("long"))


def newest_holding(points: DataFrame, spans: DataFrame, keys: list[str], point: str, at: str, start: str, end: str, best: Column) -> DataFrame:
    """``point, best`` of every point that a span of its keys holds, both ends included: the least ``best`` of those spans.

    Only the best span of a bin can be the best of a point in it: what is joined has a row for each bin and point, so
    that work grows with spans plus points, not with their pairs. Spans are whole units of the largest of ``UNITS`` that
    divides all their ends; their last instant has a key of its own.
    """
    own = spans.select(*keys, micros(F.col(start)).alias("_from"), micros(F.col(end)).alias("_to"), best.alias("best")).where("_to >= _from")
    fits = [F.coalesce(F.bool_and((F.pmod("_from", F.lit(u)) == 0) & (F.pmod("_to", F.lit(u)) == 0)), F.lit(True)) for u in UNITS]
    longest, *exact = own.agg(F.max(F.col("_to") - F.col("_from")), *fits).first()
    unit = next(u for u, whole in zip(UNITS, exact, strict=True) if whole)
    depth = depth_of((longest or 0) // unit)
    whole = bins_of_spans(own, whole_units(F.col("_from"), unit), whole_units(F.col("_to"), unit), depth)
    last = own.withColumns({BIN[0]: F.lit(INSTANT), BIN[1]: F.col("_to")})
    leaders = whole.unionByName(last).groupBy(*keys, *BIN).agg(F.min("best").alias("best"))
    placed = points.select(point, *keys, micros(F.col(at)).alias("_us"))
    spread = bins_of_points(placed, whole_units(F.col("_us"), unit), depth).unionByName(placed.withColumns({BIN[0]: F.lit(INSTANT), BIN[1]: F.col("_us")}))
    return spread.join(leaders, [*keys, *BIN]).groupBy(point).agg(F.min("best").alias("best"))
