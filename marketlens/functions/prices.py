"""Price, discount and popularity arithmetic as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default band bounds (upper edges, inclusive) and names.
BAND_BOUNDS = (40.0, 100.0)
BAND_LABELS = ("economy", "mid", "premium")

# Price series count minutes from this moment and hold cents; -1 means "no price".
SERIES_EPOCH = "2011-01-01 00:00:00"
NO_PRICE = -1


def nan_to_null(col: Column) -> Column:
    """NaN to null; the column keeps its type (float or double)."""
    return F.when(~F.isnan(col), col)


def discount_pct_catalog(price: Column, original: Column) -> Column:
    """Catalog discount in percent; unknown counts as 0. A zero original price gives 0 too."""
    return F.coalesce(F.try_divide(original - price, original) * 100, F.lit(0.0))


def discount(price: Column, original: Column) -> Column:
    return original - price


def discount_pct(price: Column, original: Column) -> Column:
    """Discount over the original price in percent; a zero original price gives null."""
    return (original - price) / F.nullif(original, F.lit(0.0)) * 100


def popularity(rating: Column, num_ratings: Column) -> Column:
    return rating * num_ratings


def sales_per_price(sales: Column, price: Column) -> Column:
    """Sales per price unit plus one; a zero price gives null."""
    return sales / (F.nullif(price, F.lit(0.0)) + 1)


def badge_count(flags: Sequence[Column]) -> Column:
    total = F.lit(0)
    for f in flags:
        total = total + f.cast("int")
    return total


def price_band(
    price: Column,
    bounds: Sequence[float] = BAND_BOUNDS,
    labels: Sequence[str] = BAND_LABELS,
) -> Column:
    """Label by ascending inclusive upper bounds; the last label takes the rest and null."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("price_band needs one label more than bounds")
    band = F.when(price <= bounds[0], labels[0])
    for bound, label in zip(bounds[1:], labels[1:]):
        band = band.when(price <= bound, label)
    return band.otherwise(labels[-1])


def log_feature(col: Column) -> Column:
    """``log(1 + x)`` with null as 0 and negative values as 0."""
    return F.log1p(F.greatest(F.coalesce(col.cast("double"), F.lit(0.0)), F.lit(0.0)))


def series_time(minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", minutes, F.lit(SERIES_EPOCH).cast("timestamp_ntz"))


def cents(value: Column) -> Column:
    return value / F.lit(100.0)
