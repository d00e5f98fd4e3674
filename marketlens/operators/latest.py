"""Latest observation per key, and first row per key.

Both are picked in two steps. A hash aggregation over fixed-width values finds each key's best time (or
first order value) with a map-side step and no sort. The rows that hold it, few for each key, are then
taken by a join, which Spark broadcasts when the found values are small, and ties among them are broken.
The input is read twice: keep it first when it is costly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.prices import nan_to_null


def latest_columns(df: DataFrame, key: str, ts: str, tie: Sequence[str] = ()) -> DataFrame:
    """Last non-null value of **each column** per key, in ``ts`` order; NaN counts as null.

    One output row can mix values of several input rows. A null ``ts`` sorts last, so its values
    win; rows with a null key are left out. ``tie`` makes the order total.
    """
    types = dict(df.dtypes)
    floating = [c for c in df.columns if c != key and types[c] in ("float", "double")]
    df = df.where(F.col(key).isNotNull()).withColumns({c: nan_to_null(F.col(c)) for c in floating})
    values = [c for c in df.columns if c != key]
    late, name = F.col(ts).isNull(), {c: i for i, c in enumerate(values)}
    held = lambda c: F.when(F.col(c).isNotNull(), late.cast("int"))
    best = df.groupBy(F.col(key).alias("_key")).agg(
        *[F.max(held(c)).alias(f"_late_{name[c]}") for c in values],
        *[F.max(F.when(F.col(c).isNotNull(), F.col(ts))).alias(f"_ts_{name[c]}") for c in values if c != ts],
        F.max(ts).alias(f"_ts_{name[ts]}"),
    )
    picks = [
        F.col(c).isNotNull() & (late | ((F.col(f"_late_{name[c]}") == 0) & (F.col(ts) == F.col(f"_ts_{name[c]}")))) for c in values
    ]
    # One array, not a column for each flag: the optimizer then has one condition to reason about.
    flags = F.array(*[F.coalesce(p, F.lit(False)) for p in picks])
    rows = df.join(best, F.col(key) == F.col("_key")).select(key, *values, flags.alias("_at"))
    rows = rows.where(F.array_contains("_at", True))
    order = F.struct(*[F.col(t) for t in tie]) if tie else F.lit(0)
    last = [F.max_by(F.col(c), F.when(F.get("_at", F.lit(i)), order)).alias(c) for i, c in enumerate(values)]
    # A key whose values are all null keeps its row.
    return best.select(F.col("_key").alias(key)).join(rows.groupBy(key).agg(*last), key, "left")


def latest_row(df: DataFrame, key: str, ts: str, tie: Sequence[str] = ()) -> DataFrame:
    """Whole row at the last ``ts`` per key; null keys and null or NaN ``ts`` are left out.

    Equal ``ts`` are broken by ``tie``, ascending.
    """
    known = df.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    if dict(df.dtypes)[ts] in ("float", "double"):
        known = known.where(~F.isnan(ts))
    best = known.groupBy(F.col(key).alias("_key")).agg(F.max(ts).alias("_ts"))
    rows = known.join(best, (F.col(key) == F.col("_key")) & (F.col(ts) == F.col("_ts")), "left_semi")
    return _least(rows, [F.col(key)], [F.col(t) for t in tie])


def first_row(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Whole row that comes first in ``order`` (nulls first) per key; null keys are one key.

    Keys that are texts or nested are grouped by 128 bits of hash and, for texts, their length, so that
    no long key is shuffled but with the row that stays.
    """
    marks = {f"_k{i}": c for i, c in enumerate(_marks(df, keys))}
    df = df.withColumns(marks)
    first = F.col(order[0])
    best = df.groupBy(*[F.col(m).alias(f"{m}_") for m in marks]).agg(
        F.max(first.isNull()).alias("_null"), F.min(first).alias("_first")
    )
    same = F.when(F.col("_null"), first.isNull()).otherwise(first == F.col("_first"))
    for m in marks:
        same = same & F.col(m).eqNullSafe(F.col(f"{m}_"))
    rows = df.join(best, same, "left_semi")
    return _least(rows, [F.col(m) for m in marks], [F.col(o) for o in order[1:]]).drop(*marks)


def _marks(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Fixed-width columns that are equal where the keys are."""
    types, out = dict(df.dtypes), []
    wide = [k for k in keys if types[k].startswith(("string", "char", "varchar", "binary", "array", "struct", "map"))]
    out += [F.col(k) for k in keys if k not in wide]
    if wide:
        known = [F.col(k).isNull() for k in wide]
        out += [F.xxhash64(F.lit(seed), *known, *wide) for seed in (1, 2)]
        out += [F.octet_length(k) for k in wide if types[k].startswith(("string", "char", "varchar", "binary"))]
    return out


def _least(rows: DataFrame, keys: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    """One row per key: the least in ``order`` (any of those that are equal in it)."""
    whole = F.struct(*[F.col(c) for c in rows.columns])
    at = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]) if order else F.lit(0)
    named = [k.alias(f"_g{i}") for i, k in enumerate(keys)]
    return rows.groupBy(*named).agg(F.min_by(whole, at).alias("_row")).select("_row.*")


def latest_per_key(
    df: DataFrame, key: str, ts: str, tie: Sequence[str] = (), mode: str = "columns"
) -> DataFrame:
    if mode == "columns":
        return latest_columns(df, key, ts, tie)
    if mode == "row":
        return latest_row(df, key, ts, tie)
    raise ValueError(f"unknown mode {mode!r}")
