"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: Parts of a key's rows.
PARTS = 256


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def with_least(rows: DataFrame, key: str, value: str, by: str) -> DataFrame:
    """``rows`` and ``least``, the smallest ``value`` of all rows with their ``key`` (not null), whichever key is hot.

    Rows of a key are dealt over ``PARTS`` parts by ``by``; a key's task sees one minimum of each part, and sends the
    least one back to the parts that there are.
    """
    dealt = rows.withColumn("part", F.pmod(F.xxhash64(by), F.lit(PARTS)))
    some = dealt.groupBy(key, "part").agg(F.min(value).alias("least"))
    least = some.groupBy(key).agg(F.min("least").alias("least"), F.collect_list("part").alias("parts"))
    return dealt.join(least.select(key, "least", F.explode("parts").alias("part")), [key, "part"]).drop("part")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest node around it."""
    both = with_least(_both_ways(edges), "u", "v", "v")
    return both.where("v > u").select(F.col("v").alias("u"), F.least("u", "least").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    moved = with_least(edges, "u", "v", "v")
    return moved.select(F.when(F.col("v") > F.col("least"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("least").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``u long, v long``: root is the smallest node of its component.

    Alternates large-star and small-star steps until each node but the roots has one edge, to its root; rounds grow with
    the logarithm of the longest chain. Each round is written to the shared folder. Loops and repeated edges are
    ignored, nulls belong to no edge, and no edges give no rows.
    """
    ordered = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, before = materialise(ordered), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == before:
            break
        before = state
        now = materialise(_small_star(_large_star(now)))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
