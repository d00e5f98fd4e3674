"""Duplicates, null and schema profiles, error quarantine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import http_status, redact
from .latest import first_row


def drop_duplicates(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in ``order``; rows with a null key form one group.

    A key that holds a third of the rows sends one short record per task; see ``first_row``.
    """
    return first_row(df, keys, order)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Drop rows equal in every column (null equals null, NaN equals NaN)."""
    return df.distinct()


def count_duplicates(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and their difference."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return copies.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Null count per column, one row per column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column", "nulls")


def schema_profile(df: DataFrame) -> DataFrame:
    """Type, non-null count and row count per column."""
    types = dict(df.dtypes)
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in df.columns])
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("type"), F.col(c).alias("non_null"))
            for c in df.columns
        ]
    )
    return counts.select(F.col("_rows").alias("n_rows"), F.inline(entries))


def key_counts(df: DataFrame, key: str, approximate: bool = False) -> DataFrame:
    """Number of rows and of distinct keys."""
    distinct = F.approx_count_distinct(key) if approximate else F.count_distinct(key)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), distinct.alias("n_keys"))


def quarantine(df: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """Split into rows without and with an error; secrets inside error texts are masked."""
    ok = df.where(F.col(error).isNull()).drop(error)
    errors = df.where(F.col(error).isNotNull()).withColumn(error, redact(F.col(error)))
    return ok, errors


def error_profile(errors: DataFrame, error: str = "error") -> DataFrame:
    """Error count per leading HTTP status."""
    return errors.groupBy(http_status(F.col(error)).alias("status")).agg(F.count(F.lit(1)).alias("n"))


def drop_nulls(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(subset))
