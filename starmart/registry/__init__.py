"""Named queries over the driver tables, each with an independent SQL statement of the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is DuckDB SQL over the same tables."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, folder: at_the_edge(fn(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def at_the_edge(df: DataFrame) -> DataFrame:
    """Exact decimals become doubles only in the final projection."""
    money = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(c).cast("double") for c in money}) if money else df


def load() -> None:
    """Import every module that registers queries."""
    from starmart.registry import (  # noqa: F401
        building,
        cleansing,
        kpis,
        reporting,
        rules,
        shapes,
    )
