"""River networks: upstream sets, validation, basins. An edge table has ``mini_id, mini_jus, mini_area``.

Chains are long, so that rounds follow powers of two: each round doubles how far a node's pointer reaches. Tables of nodes
are joined by sorting: they are small files, which Spark would send whole through the driver, once a round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.scratch import materialise

#: Sums of areas are exact to nine decimals.
_AREA = "decimal(30,9)"


def _valid_area(area: Column) -> Column:
    return area.isNotNull() & ~F.isnan(area) & (F.abs(area) != float("inf")) & (area > 0)


def _edges(minis: DataFrame) -> DataFrame:
    ids = minis.where("mini_id is not null").select("mini_id", F.col("mini_jus").alias("down")).distinct()
    known = ids.select(F.col("mini_id").alias("down")).distinct()
    inside = ids.join(known.hint("merge"), "down", "left_semi").select("mini_id", "down")
    return ids.select("mini_id").distinct().join(inside.hint("merge"), "mini_id", "left").select(F.col("mini_id").alias("node"), F.col("down").alias("ahead"))


def distances(minis: DataFrame, target: int) -> DataFrame:
    """``node, steps`` of every node from which the target is reached, and how many steps away it is; the target has 0.

    A node on or above a cycle without the target isn't there. Rounds: the logarithm of the longest chain.
    """
    state = materialise(_edges(minis).withColumns({"hit": F.col("node") == target, "steps": F.lit(0).cast("long")}))
    n, reach = state.count(), 1
    while reach <= 2 * n and not state.where("not hit and ahead is not null").isEmpty():
        far = state.select(F.col("node").alias("ahead"), F.col("ahead").alias("next"), F.col("hit").alias("far_hit"), F.col("steps").alias("far_steps"))
        still = F.coalesce(~F.col("hit") & F.col("ahead").isNotNull(), F.lit(False))
        joined = state.where(still).join(far.hint("merge"), "ahead", "left")
        steps = F.when(F.col("far_hit"), F.col("far_steps") + reach).otherwise(0)
        moved = joined.select("node", F.col("next").alias("ahead"), F.coalesce("far_hit", F.lit(False)).alias("hit"), steps.alias("steps"))
        state = materialise(state.where(~still).unionByName(moved))
        reach *= 2
    return state.where("hit").select("node", "steps")


def _before(children: DataFrame) -> DataFrame:
    """``node, before``: the next smaller child of the same parent, for ``node, parent``; none for the first.

    Rows are dealt by ranges of (parent, node), so that a parent with very many children is cut; a range gets the last row
    of the one before it, of which there are as many as ranges.
    """
    dealt = materialise(children.repartitionByRange("parent", "node").withColumn("part", F.spark_partition_id()))
    last = dealt.groupBy("part").agg(F.max(F.struct("parent", "node")).alias("last"))
    carried = last.select("part", F.lag("last").over(Window.orderBy("part")).alias("carried"))
    inside = F.lag(F.struct("parent", "node")).over(Window.partitionBy("part").orderBy("parent", "node"))
    rows = dealt.withColumn("inside", inside).join(F.broadcast(carried), "part").withColumn("prior", F.coalesce("inside", "carried"))
    return rows.where("prior.parent = parent").select("node", F.col("prior.node").alias("before"))


def numbered(minis: DataFrame) -> DataFrame:
    """``mini_id, root, steps, place, size, area`` of every node: the basins of all outlets at once, without paths.

    ``steps`` lead to the root; ``place`` is the node's number, from 1, in its root's depth-first post-order with children
    ascending; ``size`` nodes (the node too) drain through it, with ``area`` together. They are the places
    ``(place - size, place]`` of the root, see :func:`drains_to`. Areas count to nine decimals; those that aren't finite and
    positive count 0. Of several downstream nodes (:func:`network_errors`) the smallest counts; a node on or above a cycle
    isn't there.

    A node is entered before its children and left after them. Every event points to the one before it, no two to the same,
    so that the doubling of pointers, the rounds of which grow with the logarithm of the nodes, has no hot key.
    """
    weight = F.max(F.when(_valid_area(F.col("mini_area")), F.col("mini_area"))) if "mini_area" in minis.columns else F.lit(None)
    areas = minis.where("mini_id is not null").groupBy(F.col("mini_id").alias("node")).agg(F.coalesce(weight.cast(_AREA), F.lit(0).cast(_AREA)).alias("area"))
    nodes = materialise(_edges(minis).groupBy("node").agg(F.min("ahead").alias("parent")))
    children = nodes.where("parent is not null")
    lasts = children.groupBy(F.col("parent").alias("node")).agg(F.max("node").alias("last"))
    links = nodes.join(_before(children).hint("merge"), "node", "left").join(lasts.hint("merge"), "node", "left").join(areas.hint("merge"), "node")
    enter = F.struct(
        F.lit(False).alias("out"), F.coalesce("before", "parent").alias("to"), F.col("before").isNotNull().alias("to_out"),
        F.lit(1).cast("long").alias("ins"), F.lit(0).cast("long").alias("outs"), F.lit(0).cast(_AREA).alias("area"),
    )
    leave = F.struct(
        F.lit(True).alias("out"), F.coalesce("last", "node").alias("to"), F.col("last").isNotNull().alias("to_out"),
        F.lit(0).cast("long").alias("ins"), F.lit(1).cast("long").alias("outs"), F.col("area"),
    )
    events = links.select("node", F.explode(F.array(enter, leave)).alias("e")).select("node", "e.*")
    state = materialise(events.withColumn("root", F.when(F.col("to").isNull(), F.col("node"))))
    n, reach = state.count(), 1
    while reach <= 2 * n and not state.where("to is not null").isEmpty():
        far = state.select(F.col("node").alias("to"), F.col("out").alias("to_out"), F.struct("to", "to_out", "ins", "outs", "area", "root").alias("far"))
        moved = state.where("to is not null").join(far.hint("merge"), ["to", "to_out"]).select(
            "node", "out", F.col("far.to").alias("to"), F.col("far.to_out").alias("to_out"), (F.col("ins") + F.col("far.ins")).alias("ins"),
            (F.col("outs") + F.col("far.outs")).alias("outs"), (F.col("area") + F.col("far.area")).cast(_AREA).alias("area"), F.col("far.root").alias("root"),
        )
        state = materialise(state.where("to is null").unionByName(moved))
        reach *= 2

    def of(out: bool, column: str):
        return F.max(F.when(F.col("out") == out, F.col(column)))

    return state.where("to is null").groupBy(F.col("node").alias("mini_id"), "root").agg(
        (of(False, "ins") - of(False, "outs") - 1).alias("steps"), of(True, "outs").alias("place"),
        (of(True, "outs") - of(False, "outs")).alias("size"), (of(True, "area") - of(False, "area")).cast("double").alias("area"),
    )


def drains_to(node: str, outlet: str) -> Column:
    """Whether a row of :func:`numbered` (alias ``node``) drains through another one (alias ``outlet``), or is it."""
    a, b = (lambda c: F.col(f"{node}.{c}")), (lambda c: F.col(f"{outlet}.{c}"))
    return (a("root") == b("root")) & (a("place") > b("place") - b("size")) & (a("place") <= b("place"))


def upstream(minis: DataFrame, target: int, include_target: bool = True) -> DataFrame:
    """``mini_id, steps, place``: all nodes above the target, their steps to it, and their places, from 1.

    Places are those of the depth-first post-order with children ascending (:func:`upstream_order`); the target's is the last.
    Nodes with several downstream ones: :func:`numbered`.
    """
    inside = distances(minis, target).select(F.col("node").alias("mini_id"))
    basin = minis.select("mini_id", F.when(F.col("mini_id") != target, F.col("mini_jus")).alias("mini_jus")).join(inside.hint("merge"), "mini_id", "left_semi")
    out = numbered(basin).where(F.col("root") == target).select("mini_id", "steps", "place")
    return out if include_target else out.where(F.col("mini_id") != target)


def upstream_order() -> Column:
    return F.col("place")


def network_errors(minis: DataFrame) -> DataFrame:
    """``mini_id, reason``: no whole id, several downstream nodes, on or above a cycle (a loop to itself is one)."""
    whole = minis.where("mini_id is null or mini_id % 1 <> 0").select(F.col("mini_id").cast("bigint"), F.lit("id").alias("reason"))
    several = minis.groupBy("mini_id").agg((F.count_distinct("mini_jus") + F.max(F.col("mini_jus").isNull().cast("int"))).alias("n")).where("n > 1").select(F.col("mini_id").cast("bigint"), F.lit("downstream").alias("reason"))
    state = materialise(_edges(minis).groupBy("node").agg(F.min("ahead").alias("ahead")))
    n, reach = state.count(), 1
    while reach <= n and not state.where("ahead is not null").isEmpty():
        # a node whose way ends goes, and then those that point to it
        still = state.where("ahead is not null")
        far = still.select(F.col("node").alias("ahead"), F.col("ahead").alias("next"))
        state = materialise(still.join(far.hint("merge"), "ahead").select("node", F.col("next").alias("ahead")))
        reach *= 2
    cycle = state.where("ahead is not null").select(F.col("node").cast("bigint").alias("mini_id"), F.lit("cycle").alias("reason"))
    return whole.union(several).union(cycle)


def basin_weights(minis: DataFrame, outlet: int) -> DataFrame:
    """``mini_id, weight``: the catchments of an outlet with their areas; areas that aren't finite and positive have no weight."""
    found = distances(minis, outlet).withColumnRenamed("node", "mini_id")
    return found.join(minis.select("mini_id", "mini_area").distinct().hint("merge"), "mini_id").select("mini_id", F.when(_valid_area(F.col("mini_area")), F.col("mini_area")).alias("weight"))
