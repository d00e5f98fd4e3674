"""Joins: price history with product details, and size-checked small sides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import keep

SMALL_ROWS = 100_000
SMALL_BYTES = 64 * 1024 * 1024


def free_names(taken: Sequence[str], *wanted: str) -> list[str]:
    """The wanted names, longer where a column has them already (letter case does not count)."""
    used, out = {c.lower() for c in taken}, []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def hot_keys(df: DataFrame, key: str, share: float, most: int = 100) -> list:
    """Keys that hold more than ``share`` of the rows, by a frequent-items sketch of fixed size in one pass.

    The sketch counts a key at least as often as it occurs, so none is missed as long as ``1 / share`` is well under
    ``most``; a key just below the share may come along. The null key is told by None."""
    sketch = F.expr(f"approx_top_k(`{key}`, {most}, {max(10_000, 10 * most)})")
    found = df.agg(sketch.alias("top"), F.count(F.lit(1)).alias("n"), F.count_if(F.col(key).isNull()).alias("none")).first()
    hot = [r["item"] for r in found["top"] or [] if r["item"] is not None and r["count"] > share * found["n"]]  # ``most`` at most
    return hot + ([None] if found["none"] > share * found["n"] else [])


def _among(column: str, values: list) -> Column:
    known = F.col(column).isin([v for v in values if v is not None])
    return F.coalesce(known, F.lit(None in values))


def merge_history(history: DataFrame, details: DataFrame, key: str = "asin", salts: int = 1) -> DataFrame:
    """Every history row with its product's details; a null key matches a null key.

    Columns both sides share get ``_x`` (history) and ``_y`` (details). No hint is given: Spark
    broadcasts details only when their measured size allows it, and splits a skewed history
    partition at run time. ``salts`` > 1 is for joins that must shuffle where run-time splitting is off: keys that
    hold more than a ``1 / salts`` part of the history, found by a sketch, are spread over that many
    buckets, and only their details are copied.
    """
    taken = [*history.columns, *details.columns, *[f"{c}_{side}" for c in history.columns for side in "xy"]]
    own, salt, salt_right = free_names(taken, "_key", "_salt", "_salt_r")
    shared = [c for c in history.columns if c in details.columns and c != key]
    left = history.withColumnsRenamed({c: f"{c}_x" for c in shared})
    right = details.withColumnsRenamed({c: f"{c}_y" for c in shared} | {key: own})
    match = F.col(key).eqNullSafe(F.col(own))
    hot = hot_keys(history, key, 1 / salts) if salts > 1 else []
    if hot:
        # the input partition takes part, so that exact copies spread too
        row_hash = F.pmod(F.xxhash64(F.spark_partition_id(), *left.columns), F.lit(salts))
        left = left.withColumn(salt, F.when(_among(key, hot), row_hash).otherwise(0))
        last = F.when(_among(own, hot), salts - 1).otherwise(0).cast("bigint")
        right = right.withColumn(salt_right, F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
        match = match & (F.col(salt) == F.col(salt_right))
    joined = left.join(right, match, "left").drop(own, *([salt, salt_right] if hot else []))
    return joined.withColumn(f"{key}_group", F.col(key))


def join_small(
    df: DataFrame, side: DataFrame, on: Sequence[str], how: str = "inner", max_rows: int = SMALL_ROWS
) -> DataFrame:
    """Join a side that is expected to be small: measured first, broadcast only when it is.

    A side above ``max_rows`` rows or 64 MB is joined by shuffle, where Spark splits skewed partitions. Null keys
    match null keys.
    """
    names = dict(zip(on, free_names([*df.columns, *side.columns], *[f"_side_{c}" for c in on])))
    side = keep(side.withColumnsRenamed(names))
    size = side.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(side)).alias("b")).first()
    small = size["n"] <= max_rows and (size["b"] or 0) <= SMALL_BYTES
    match = F.lit(True)
    for c in on:
        match = match & F.col(c).eqNullSafe(F.col(names[c]))
    joined = df.join(F.broadcast(side) if small else side, match, how)
    return joined.drop(*names.values())


def _row_bytes(df: DataFrame) -> Column:
    """About what a row takes: 8 bytes a column, texts by their bytes, nested columns by their JSON text."""
    total = F.lit(8 * len(df.columns))
    for c, kind in df.dtypes:
        if kind == "string" or kind == "binary" or kind.startswith(("char", "varchar")):
            total = total + F.coalesce(F.octet_length(c), F.lit(0))
        elif kind.startswith(("array", "map", "struct")):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
    return total
