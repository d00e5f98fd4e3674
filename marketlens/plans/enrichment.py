"""Landed tables to the enriched analysis table, and its latest snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators.columns import enrich, normalize_columns
from ..operators.latest import latest_columns, latest_row
from ..operators.merge import merge_history
from ..operators.quality import distinct_rows, drop_duplicates, drop_nulls, null_profile


def clean_details(details: DataFrame, order: Sequence[str], key: str = "asin") -> DataFrame:
    """One detail row per product: the first in ``order``."""
    return drop_duplicates(normalize_columns(details), [key], order)


def one_per_key(details: DataFrame, key: str = "asin", order: Sequence[str] | None = None) -> DataFrame:
    """Details with one row per key: the first in ``order``, or in the order of all other columns."""
    return clean_details(details, order or [c for c in details.columns if c.strip().lower() != key], key)


def build_enriched(
    history: DataFrame,
    details: DataFrame,
    key: str = "asin",
    null_sales: int | None = 0,
    order: Sequence[str] | None = None,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """History x details, exact copies removed, derived columns added.

    Repeated details of a product are cut to the first in ``order``, so a unified row repeats exactly
    when its history row does. The copies are removed on the narrow history, before the join widens the
    rows, and the derived columns are computed once per product instead of once per price point.
    ``keys`` are the star keys if they are known (see ``enrich``).
    """
    return merge_history(distinct_rows(history), enrich(one_per_key(details, key, order), null_sales, keys), key)


def validate(enriched: DataFrame, needed: Sequence[str], key: str = "asin") -> tuple[DataFrame, DataFrame]:
    """``(rows, problems)``: rows with all ``needed`` values, and the null count of each of these columns."""
    return drop_nulls(enriched, needed), null_profile(enriched.select(*needed))


def latest_snapshot(
    history: DataFrame,
    details: DataFrame,
    ts: str = "date",
    tie: Sequence[str] = (),
    key: str = "asin",
    mode: str = "columns",
    null_sales: int | None = 0,
    order: Sequence[str] | None = None,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """Latest observation per product with details and derived columns.

    Details are cut to one row per product, the first in ``order``; pass an empty list when they are
    known to be so. Equal to taking the latest of the enriched table, because every detail column is constant
    within a product; but only the narrow history is shuffled, and the join meets one row per
    product.
    """
    pick = latest_columns if mode == "columns" else latest_row
    latest = pick(history, key, ts, tie)
    if order is None or order:
        details = one_per_key(details, key, order)
    return merge_history(latest, enrich(details, null_sales, keys), key)
