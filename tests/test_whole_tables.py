"""The queries over all rows."""

from __future__ import annotations

import datetime
import os

import pytest
from test_queries import SF

from freshet.queries import QUERIES
from freshet.sources.views import view

def test_every_id_takes_part(spark, tmp_path):
    """350 catchments, beyond the ids of the queries over a part, and eight stations."""
    customers = [(i,) for i in range(350)]
    events = [(i, i % 8, "view", datetime.datetime(2024, 1, 1 + i % 3, 5), float(i)) for i in range(60)]
    spark.createDataFrame(customers, "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame(events, "event_id long, user_id long, event_type string, ts timestamp_ntz, value double").write.parquet(f"{tmp_path}/events.parquet")
    got = {(r.target_id, r.dt): r.value for r in QUERIES["gr3_fixed_neighbours"](spark, str(tmp_path)).collect()}

    name = {u: f"{'inmet' if u % 2 else 'ana'}:{u}" for u in range(8)}
    daily: dict = {}
    for e, u, _, t, x in events:
        there = daily.setdefault((u, f"2024-01-0{t.day} 00:00:00"), [])
        if e % 20:
            there.append(x)
    want = {}
    for i in range(350):
        lat, lon = -30.9 + i % 11 * 0.21, -53.9 + i % 19 * 0.23
        near = sorted((((lat + 31 - u % 13 * 0.2) ** 2 + (lon + 54 - u % 17 * 0.25) ** 2) ** 0.5, name[u], u) for u in range(8))[:5]
        for dt in {t for _, t in daily}:
            pairs = [(1 / max(d, 1e-12) ** 2, sum(daily[u, dt]) if daily[u, dt] else None) for d, _, u in near if (u, dt) in daily]
            some = [(w, x) for w, x in pairs if x is not None]
            if pairs:
                want[i + 1, dt] = sum(w * x for w, x in some) / sum(w for w, _ in some) if some else None
    assert got.keys() == want.keys() and {k[0] for k in got} == set(range(1, 351))
    assert all(got[k] == (None if x is None else pytest.approx(x, abs=1e-5)) for k, x in want.items())


def test_packed_output_of_sums_near_a_whole_thousand(spark, tmp_path):
    """A sum of exactly 1000 that floating point may leave just below leaves 0, not 1000."""
    day = datetime.datetime(1995, 1, 1)
    prices = [(0, 0.7)] * 36 + [(0, 974.8)] + [(1, 250.25)] * 5
    rows = [(3 * i, c, p, day) for i, (c, p) in enumerate(prices)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    got = {r.mini_id: r.value for r in QUERIES["sk7_packed_output"](spark, str(tmp_path)).collect()}
    assert got == {1: 0.0, 2: 251.25}


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")
def test_views_have_every_row(spark):
    orders, lines = (view(spark, SF, n).count() for n in ("orders", "lineitem"))
    assert (view(spark, SF, "asset").count(), view(spark, SF, "edit").count()) == (orders, lines)
    assert QUERIES["mf6_reusable"](spark, SF).count() == orders
