"""Basins of all outlets by numbers, and exact quantiles, against plain versions."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from freshet.operators import network as N
from freshet.operators.quantiles import quantiles


def plain_basins(edges):
    """mini_id -> (root, steps, place, size, area); a node on or above a cycle isn't there."""
    down = {a: b for a, b, _ in edges}
    area = {a: x for a, _, x in edges}
    above: dict = {}
    for a, b in down.items():
        if b in down:
            above.setdefault(b, []).append(a)
    found = {}
    for root in (a for a, b in down.items() if b not in down):
        order, stack = [], [(root, 0, False)]
        steps = {}
        while stack:
            node, n, left = stack.pop()
            if left:
                order.append(node)
                continue
            steps[node] = n
            stack.append((node, n, True))
            stack += [(c, n + 1, False) for c in sorted(above.get(node, []), reverse=True)]
        size, total = {}, {}
        for place, node in enumerate(order, 1):
            size[node] = 1 + sum(size[c] for c in above.get(node, []))
            total[node] = (area[node] if area[node] and area[node] > 0 else 0) + sum(total[c] for c in above.get(node, []))
            found[node] = (root, steps[node], place, size[node], pytest.approx(total[node]))
    return found


@pytest.mark.parametrize("seed", [0, 1])
def test_basins_of_a_forest(spark, seed):
    """Several roots, a node that a third of all drain to, a cycle with what is above it, a loop, areas that don't count."""
    rng = random.Random(seed)
    edges = [(1, None, 2.0), (2, 999, 1.5)] + [(i, rng.choice((7, rng.randrange(1, i), rng.randrange(1, i))) if i > 7 else 1, rng.choice((0.25, 3.0, None, -1.0))) for i in range(3, 160)]
    edges += [(200, 201, 1.0), (201, 202, 1.0), (202, 201, 1.0), (203, 203, 1.0), (204, 203, 1.0)]
    got = {r.mini_id: (r.root, r.steps, r.place, r.size, r.area) for r in N.numbered(spark.createDataFrame(edges, "mini_id long, mini_jus long, mini_area double")).collect()}
    assert got == plain_basins(edges) and not set(got) & {200, 201, 202, 203, 204} and len(got) == 159


def test_what_drains_to_an_outlet(spark):
    edges = spark.createDataFrame([(1, 3, 1.0), (2, 3, 1.0), (3, 4, 1.0), (5, 4, 1.0), (4, None, 1.0), (6, None, 1.0)], "mini_id long, mini_jus long, mini_area double")
    rows = N.numbered(edges)
    pairs = rows.alias("a").join(rows.alias("b"), N.drains_to("a", "b")).select("a.mini_id", F.col("b.mini_id").alias("outlet")).collect()
    assert {(r.mini_id, r.outlet) for r in pairs} == {(i, i) for i in range(1, 7)} | {(1, 3), (2, 3), (1, 4), (2, 4), (3, 4), (5, 4)}


def test_a_long_chain_and_no_rows(spark):
    chain = spark.range(1, 1001).select(F.col("id").alias("mini_id"), (F.col("id") + 1).alias("mini_jus"), F.lit(1.0).alias("mini_area"))
    got = N.numbered(chain).where("steps <> 1000 - mini_id or place <> mini_id or size <> mini_id or area <> mini_id or root <> 1000")
    assert got.isEmpty()
    assert N.numbered(chain.limit(0)).count() == 0


def test_repeated_rows_and_a_target_on_a_cycle(spark):
    edges = spark.createDataFrame([(1, 2), (1, 2), (2, 3), (3, 2), (4, 3), (None, 3)], "mini_id long, mini_jus long")
    assert [(r.mini_id, r.steps) for r in N.upstream(edges, 3).orderBy(N.upstream_order()).collect()] == [(1, 2), (2, 1), (4, 1), (3, 0)]


def cases():
    rng = random.Random(5)
    yield [0.0] * 500 + [1.0, 2.0, -3.0]
    yield [rng.choice((1.5, 2.5, 2.5, 1e300, -1e300, 5e-324)) for _ in range(700)]
    yield [rng.lognormvariate(0, 9) for _ in range(5000)]
    yield [float(i // 3) for i in range(20_000)] + [-0.0, 1e18, 1e18 + 256]
    yield [4.0]
    yield [4.0, 9.0]


@pytest.mark.parametrize("values", list(cases()))
def test_quantiles_are_exact(spark, values):
    wanted = {"low": 0.05, "mid": 0.5, "high": 0.95, "most": 1.0}
    rows = spark.createDataFrame([(x,) for x in values] + [(None,), (math.nan,), (math.inf,)], "value double")
    got = quantiles(rows, "value", wanted).first()
    for name, q in wanted.items():
        assert got[name] == pytest.approx(float(np.quantile(np.array(values), q)), rel=1e-12), name


def test_quantiles_of_groups(spark):
    """A group with most rows, a null group, one without values; a column of the name of a step."""
    rng = random.Random(2)
    rows = [("hot", rng.gauss(0, 1), "x") for _ in range(6000)] + [(None, float(i), "y") for i in range(10)] + [("none", None, "z")] + [(f"k{i % 40}", float(i), "w") for i in range(400)]
    table = spark.createDataFrame(rows, "cell string, v double, bin string")
    got = {r.cell: r.p90 for r in quantiles(table, "v", {"p90": 0.9}, ("cell",)).collect()}
    groups: dict = {}
    for k, x, _ in rows:
        if x is not None:
            groups.setdefault(k, []).append(x)
    assert got == {k: pytest.approx(float(np.quantile(np.array(x), 0.9))) for k, x in groups.items()}
    none = quantiles(table.where("cell = 'none'"), "v", {"p90": 0.9})
    assert [r.p90 for r in none.collect()] == [None] and quantiles(table.where("cell = 'none'"), "v", {"p90": 0.9}, ("cell",)).count() == 0
