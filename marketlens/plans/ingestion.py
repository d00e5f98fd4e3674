"""Landed API responses to catalog, details, price history and reviews, each with its error rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..operators.columns import clean_catalog
from ..operators.quality import quarantine
from ..sources import envelopes as E
from ..session import keep
from ..sources.files import select_existing

_CATALOG_COLUMNS = [c.split()[0] for c in schemas.CATALOG.split(", ")]


def build_catalog(landed: DataFrame, product_schema: str, key: str | None = None) -> DataFrame:
    """Search pages to the cleaned catalog."""
    return select_existing(clean_catalog(E.explode_pages(landed, product_schema, key)), _CATALOG_COLUMNS)


def build_details(landed: DataFrame, detail_schema: str = schemas.DETAIL_COLUMNS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Detail responses to ``(details, no_data, errors)``. The responses are parsed once and kept."""
    rows = keep(E.unwrap_details(landed, detail_schema))
    columns = ["asin", *[c for c in rows.columns if c not in ("asin", "bucket", "error")]]
    of = lambda bucket: rows.where(F.col("bucket") == bucket)
    errors = quarantine(of("error").select("asin", "error"))[1]
    return of("ok").select(*columns), of("no_data").select("asin"), errors


def build_history(landed: DataFrame, as_of: str, days: int = 365) -> tuple[DataFrame, DataFrame]:
    """Price responses to ``(price history, errors)``. The responses are parsed once and kept."""
    checked = keep(E.validate_series(landed))
    errors = quarantine(checked.select("asin", "error"))[1]
    return E.decode_price_series(checked, as_of, days), errors


def build_reviews(
    landed: DataFrame, fields: Mapping[str, str] | None = None, rate_limit: int = 429
) -> tuple[DataFrame, DataFrame]:
    """Review pages to ``(reviews, errors)``. The responses are parsed once and kept.

    A rate-limited page ends that product's pages without an error row; any other failure is an
    error row and later pages still count.
    """
    limited = F.coalesce(F.col("status_code") == rate_limit, F.lit(False))
    tagged = keep(E.tag_reviews(E.cut_after_first(landed, "asin", "page", limited)))
    errors = quarantine(tagged.select("asin", "page", "error"))[1]
    return E.flatten_reviews(tagged.where(F.col("error").isNull()), fields), errors
