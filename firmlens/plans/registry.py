"""Registry of named queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlens.plans.bindings import with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: str = "") -> Callable[[Query], Query]:
    """Register a query; ``sql`` is DuckDB SQL over the tables and the named views."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(views, sql)
        return fn

    return register


def rounded(table: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison: summation order differs between engines."""
    return table.select(
        *[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in table.dtypes]
    )
