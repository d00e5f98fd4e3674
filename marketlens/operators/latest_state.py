"""Latest observation per key, kept as a state that new landings fold into.

The state holds, for each key and column, the column's last value together with what decides that it is the last:
(time missing, time, tie, value). Two states merge by the larger of these, in any order and any number of
times, so a landing that is folded twice does no harm. The stored state is dealt into buckets by key; a fold
adds the state of the new rows and never reads the history, and its result reads the touched buckets only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.prices import nan_to_null

BUCKETS = 256
BUCKET = "_bucket"


def latest_state(df: DataFrame, key: str, ts: str, tie: Sequence[str] = (), buckets: int = BUCKETS) -> DataFrame:
    """(key, a struct per column, bucket): the state of these rows alone.

    Same order as ``latest_columns``: a null ``ts`` sorts last, NaN counts as null, rows with a null key are left
    out. Rows that are equal in time and tie are settled by the larger value, so ``tie`` may be short. Values
    must be of types that can be compared.
    """
    if BUCKET in df.columns:
        raise ValueError(f"the state's own column name {BUCKET!r} is taken")
    types = dict(df.dtypes)
    known = df.where(F.col(key).isNotNull())
    values = [c for c in df.columns if c != key]

    def held(c: str) -> Column:
        value = nan_to_null(F.col(c)) if types[c] in ("float", "double") else F.col(c)
        order = [F.col(t).alias(f"t{i}") for i, t in enumerate(tie)]
        return F.when(value.isNotNull(), F.struct(F.col(ts).isNull().alias("late"), F.col(ts).alias("at"), *order, value.alias("value")))

    state = known.groupBy(key).agg(*[F.max(held(c)).alias(c) for c in values])
    return state.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def merge_states(state: DataFrame, key: str) -> DataFrame:
    """One row per key from several."""
    values = [c for c in state.columns if c not in (key, BUCKET)]
    return state.groupBy(BUCKET, key).agg(*[F.max(c).alias(c) for c in values]).select(key, *values, BUCKET)


def state_values(state: DataFrame, key: str) -> DataFrame:
    """The snapshot: key and values without what decided them."""
    return state.select(key, *[F.col(c)["value"].alias(c) for c in state.columns if c not in (key, BUCKET)])


def fold(new: DataFrame, path: str, key: str, ts: str, tie: Sequence[str] = (), buckets: int = BUCKETS) -> None:
    """Add the state of newly landed rows to the state stored at ``path`` (made if it is not there).

    Only ``new`` is read. ``buckets`` must stay the same for a path. Rows are dealt by bucket before they are
    written, so that a landing adds about one file to each."""
    latest_state(new, key, ts, tie, buckets).hint("rebalance", BUCKET).write.mode("append").partitionBy(BUCKET).parquet(path)


def stored_state(spark: SparkSession, path: str, key: str, touched_by: DataFrame | None = None, buckets: int = BUCKETS) -> DataFrame:
    """The merged state at ``path``; with ``touched_by`` only the buckets that its keys fall into are read."""
    stored = spark.read.parquet(path)
    if touched_by is not None:
        number = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
        touched = [r[0] for r in touched_by.where(F.col(key).isNotNull()).select(number).distinct().collect()]  # ``buckets`` at most
        stored = stored.where(F.col(BUCKET).isin(touched))
    return merge_states(stored, key)


def compact(spark: SparkSession, path: str, target: str, key: str) -> None:
    """Write the merged state to a new path, one row per key; readers move over when it is there."""
    merge_states(spark.read.parquet(path), key).write.partitionBy(BUCKET).parquet(target)
