"""Name -> query and name -> SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""

    def add(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round sums and means on both sides of a check, since their last bits depend on row order."""
    return df.withColumns({c: F.round(c, digits) for c in columns})
