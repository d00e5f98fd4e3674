"""What to ask for next: key lists, request manifests and retry lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct non-null keys as text."""
    return df.select(F.col(key).cast("string").alias(key)).where(F.col(key).isNotNull()).distinct()


def request_manifest(keys: DataFrame, pages: int = 3) -> DataFrame:
    """One request per key and page ``1..pages``."""
    return keys.withColumn("page", F.explode(F.sequence(F.lit(1), F.lit(pages))))


def retry_list(manifest: DataFrame, ok: DataFrame, errors: DataFrame, on: Sequence[str] = ("asin",)) -> DataFrame:
    """Requests that failed and have not succeeded.

    Both logs are reduced to distinct keys first, so a key with very many log rows weighs one row
    in the joins.
    """
    keys = list(on)
    failed = manifest.join(errors.select(*keys).distinct(), keys, "left_semi")
    return failed.join(ok.select(*keys).distinct(), keys, "left_anti")
