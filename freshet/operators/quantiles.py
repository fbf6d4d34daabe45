"""Exact quantiles of groups of any size: cells of values are cut until the cell of each rank holds one value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.scratch import materialise

#: Parts into which a round cuts a cell, and the accuracy of the cuts (they needn't be right, counts are).
CUTS, ACCURACY = 32, 10_000


def quantiles(rows: DataFrame, value: str, wanted: dict[str, float], by: tuple[str, ...] = ()) -> DataFrame:
    """``by`` columns and a column for each name of ``wanted``: the quantile between the two nearest ranks, as ``percentile`` gives.

    Nulls, NaN and infinities aren't values; a group without values has no row (without ``by`` there is one row of nulls).
    Null keys are a group. Approximate percentiles cut each cell, where every cut is a cell of its own; exact counts say in
    which cell a rank lies, and only the rows of these cells go into the next round, less than about a sixteenth of a cell's
    rows for each. Rounds grow with the logarithm of the rows; no task holds a group's values, nor its different ones.
    """
    number = F.col(value).cast("double")
    finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) != float("inf"))
    cells = rows.where(finite).select(F.struct(F.lit(0).alias("_" * (1 + max(map(len, by), default=0))), *by).alias("group"), F.lit("").alias("cell"), (number + F.lit(0.0)).alias("v"))
    asked = F.array(*(F.struct(F.lit(name).alias("name"), F.lit(float(q)).alias("q"), F.lit(up).alias("up")) for name, q in wanted.items() for up in (False, True)))
    places = F.array(*(F.lit(i / CUTS) for i in range(CUTS + 1)))
    ranks, found = None, []
    while True:
        cuts = materialise(cells.groupBy("group", "cell").agg(F.percentile_approx("v", places, ACCURACY).alias("cuts"), F.count("*").alias("size")))
        if ranks is None:
            exact = F.col("a.q") * (F.col("size") - 1)
            every = cuts.select("group", "cell", "size", F.explode(asked).alias("a"))
            ranks = every.select("group", "cell", "a.name", "a.up", (exact - F.floor(exact)).alias("part"), F.when(F.col("a.up"), F.ceil(exact)).otherwise(F.floor(exact)).alias("rank"))
        binned = cells.join(cuts.drop("size"), ["group", "cell"]).withColumn("bin", F.expr("size(filter(cuts, c -> c < v)) + size(filter(cuts, c -> c <= v))")).drop("cuts")
        counts = binned.groupBy("group", "cell", "bin").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        below = F.coalesce(F.sum("n").over(Window.partitionBy("group", "cell").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        hit = ranks.join(counts.withColumn("below", below), ["group", "cell"]).where("rank >= below and rank < below + n")
        hit = materialise(hit.withColumn("rank", F.col("rank") - F.col("below")).drop("below", "n"))
        found.append(hit.where("low = high").select("group", "name", "up", "part", F.col("low").alias("v")))
        still = hit.where("low < high")
        if still.isEmpty():
            break
        name = F.concat_ws(".", "cell", "bin")
        cells = materialise(binned.join(still.select("group", "cell", "bin").distinct(), ["group", "cell", "bin"], "left_semi").select("group", name.alias("cell"), "v"))
        ranks = still.select("group", name.alias("cell"), "name", "up", "part", "rank")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)

    def between(name: str):
        low, high, part = (F.max(F.when((F.col("name") == name) & (F.col("up") == up), F.col(c))) for up, c in ((False, "v"), (True, "v"), (False, "part")))
        return (low + (high - low) * part).alias(name)

    if not by:
        return every.agg(*(between(name) for name in wanted))
    out = every.groupBy("group").agg(*(between(name) for name in wanted))
    return out.select(*(F.col("group")[c].alias(c) for c in by), *wanted)
