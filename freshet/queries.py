"""The registered queries of the engine over the star-schema tables, each with its DuckDB twin.

Times and dates leave as text, integers as 64 bits, and other numbers with six decimals, so that both engines' results
can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .sources.views import view, with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Comparable types: text for times, 64-bit integers, doubles with six decimals (and no negative zero)."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(name)
        if kind in ("timestamp", "timestamp_ntz", "date"):
            c = c.cast("string")
        elif kind in ("int", "smallint", "tinyint"):
            c = c.cast("bigint")
        elif kind in ("double", "float") or kind.startswith("decimal"):
            c = six_decimals(c.cast("double")) + F.lit(0.0)
        out.append(c.alias(name))
    return df.select(*out)


def six_decimals(c: Column) -> Column:
    """``round(c, 6)``, whose decimal arithmetic is left out where the number is the nearest one to six decimals already."""
    return F.when(F.rint(c * 1e6) / 1e6 == c, c).otherwise(F.round(c, 6))


def query(sql: str | None = None) -> Callable[[Callable], Callable]:
    """Register a function of (views, spark); ``views(name)`` is a table. Without ``sql`` the query has no twin."""

    def add(f: Callable) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(f(lambda name: view(spark, sf_dir, name)))

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__] = run
        if sql is not None:
            ORACLES[f.__name__] = with_views(sql)
        return f

    return add


def ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


from . import queries_grids, queries_registry, queries_series, queries_tables  # noqa: E402, F401
