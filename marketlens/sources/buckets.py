"""Stage tables bucketed by product: what is grouped or joined by the key afterwards needs no exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Replace ``table`` by the rows of ``df``, bucketed and sorted by ``key``, and give it to read.

    The rows are dealt by key before they are written, so that each bucket is one file. With ``path`` the files
    lie there and the catalog holds only their description."""
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def merge_bucketed(history: DataFrame, details: DataFrame, key: str = "asin") -> DataFrame:
    """``merge_history`` of two tables with equal bucketing by ``key``: every history row with its product's details,
    a null key with the details of the null key. Details have one row per product, so the null key's, which
    buckets cannot match, are one row and are sent along."""
    shared = [c for c in history.columns if c in details.columns and c != key]
    taken = {*history.columns, *details.columns}
    own = next(n for n in (f"{key}_of_details{'_' * i}" for i in range(len(taken) + 1)) if n not in taken)
    left = history.withColumnsRenamed({c: f"{c}_x" for c in shared})
    right = details.withColumnsRenamed({c: f"{c}_y" for c in shared} | {key: own})
    keyed = left.where(F.col(key).isNotNull()).join(right.hint("merge"), F.col(key) == F.col(own), "left")
    unkeyed = left.where(F.col(key).isNull()).join(F.broadcast(right.where(F.col(own).isNull())), F.col(key).eqNullSafe(F.col(own)), "left")
    return keyed.unionByName(unkeyed).drop(own).withColumn(f"{key}_group", F.col(key))
