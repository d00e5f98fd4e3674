"""Schema-level steps: ensure, pick and normalise columns; flags and price features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import prices as P
from ..functions import text as T
from ..schemas import BADGE_FLAGS


def ensure_columns(df: DataFrame, defaults: Mapping[str, tuple[str, Any]]) -> DataFrame:
    """Add each missing column as a typed literal; ``defaults`` maps a name to (type, value)."""
    missing = {
        name: F.lit(value).cast(data_type)
        for name, (data_type, value) in defaults.items()
        if name not in df.columns
    }
    return df.withColumns(missing) if missing else df


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df


def normalize_columns(df: DataFrame) -> DataFrame:
    """Strip and lower-case the column names; two names that become equal are an error."""
    names = [c.strip().lower() for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"column names collide after normalising: {twice}")
    return df.toDF(*names)


def pick_column(df: DataFrame, candidates: Sequence[str]) -> str:
    """First candidate that exists."""
    for name in candidates:
        if name in df.columns:
            return name
    raise ValueError(f"none of {list(candidates)} in {df.columns}")


def to_flags(df: DataFrame, columns: Sequence[str] = BADGE_FLAGS) -> DataFrame:
    types = dict(df.dtypes)
    return df.withColumns({c: T.flag(F.col(c), types[c]) for c in columns if c in types})


def expand_distribution(
    df: DataFrame, col: str = "rating_distribution", keys: Sequence[str] | None = None, as_map: bool = False, limit: int = 1000
) -> DataFrame:
    """Add one share column ``pct_<key>stars`` per key of the counts written as text.

    Without ``keys`` they are found in the data, and the usual five are there in any case; more than
    ``limit`` of them are an error, as in a pivot. With ``as_map`` nothing is looked for: the shares of all
    keys come as one map column ``pct_stars`` beside the usual five (or ``keys``), however many there are.
    Text that is not a mapping of numbers, or sums to zero, gives 0 for every key; so does a key
    that is absent. The text is parsed once per row, in its own projection.
    """
    parsed = df.withColumn("_counts", T.number_map(F.col(col))).withColumn("_total", T.map_total(F.col("_counts")))
    if as_map:
        parsed = parsed.withColumn("pct_stars", F.transform_values("_counts", lambda k, n: F.coalesce(n / F.col("_total"), F.lit(0.0))))
        keys = T.STAR_KEYS if keys is None else keys
    elif keys is None:
        keys = sorted({*discover_keys(df, col, limit), *T.STAR_KEYS})
    shares = {f"pct_{k}stars": T.share(F.col("_counts"), F.col("_total"), k) for k in keys}
    return parsed.withColumns(shares).drop("_counts", "_total")


def discover_keys(df: DataFrame, col: str = "rating_distribution", limit: int = 1000) -> list[str]:
    """Keys that occur in the texts, for data-dependent share columns; more than ``limit`` are an error."""
    keys = df.select(F.explode(F.map_keys(T.number_map(F.col(col)))).alias("k")).distinct()
    found = [r.k for r in keys.limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"more than {limit} keys in {col}: name the keys, or take the shares as a map")
    return sorted(found)


def clean_catalog(df: DataFrame) -> DataFrame:
    """Search hits to catalog rows: numeric prices and ratings, discount percent, priced rows only."""
    df = ensure_columns(
        df,
        {
            c: ("string", None)
            for c in (
                "product_price",
                "product_original_price",
                "product_star_rating",
                "product_num_ratings",
            )
        },
    )
    cleaned = df.withColumns(
        {
            "product_price": T.clean_money(F.col("product_price")),
            "product_original_price": T.clean_money(F.col("product_original_price")),
            "product_star_rating": T.to_number(F.col("product_star_rating")),
            "product_num_ratings": T.to_number(F.col("product_num_ratings")),
        }
    ).where(F.col("product_price").isNotNull())
    return cleaned.withColumn(
        "discount", P.discount_pct_catalog(F.col("product_price"), F.col("product_original_price"))
    )


def price_features(df: DataFrame, flags: Sequence[str] = BADGE_FLAGS) -> DataFrame:
    """Discount, popularity, sales per price, badge count and rating balance."""
    require_columns(df, flags)
    price, original = F.col("product_price"), F.col("product_original_price")
    zero = F.lit(0.0)
    five = F.coalesce(F.col("pct_5stars"), zero) if "pct_5stars" in df.columns else zero
    one = F.coalesce(F.col("pct_1stars"), zero) if "pct_1stars" in df.columns else zero
    return df.withColumns(
        {
            "discount": P.discount(price, original),
            "discount_pct": P.discount_pct(price, original),
            "popularity_score": P.popularity(F.col("product_star_rating"), F.col("product_num_ratings")),
            "sales_per_price": P.sales_per_price(F.col("sales_volume_num"), price),
            "premium_badge_count": P.badge_count([F.col(f) for f in flags]),
            "rating_balance": five - one,
        }
    )


_ENRICH_NEEDS = ("product_price", "product_original_price", "product_star_rating", "product_num_ratings", "deal_badge", *BADGE_FLAGS)


def enrich(df: DataFrame, null_sales: int | None = 0, keys: Sequence[str] | None = None) -> DataFrame:
    """All derived columns in one projection, no shuffle; NaN counts as missing.

    Star keys other than ``keys`` get no column; without ``keys`` they are found in the data, which
    reads the distribution column once more.
    """
    require_columns(df, _ENRICH_NEEDS)
    types = dict(df.dtypes)
    df = df.withColumns(
        {c: T.to_number(F.col(c)) if types[c] == "string" else F.col(c).cast("double")
         for c in ("product_price", "product_original_price")}
    )
    df = df.withColumns({c: P.nan_to_null(F.col(c)) for c, kind in df.dtypes if kind in ("float", "double")})
    if "sales_volume" in types:
        df = df.withColumn("sales_volume_num", T.parse_volume(F.col("sales_volume"), null_sales))
    df = require_columns(df, ["sales_volume_num"])
    if "rating_distribution" in types:
        df = expand_distribution(df, keys=keys)
    df = to_flags(df).withColumn("deal_badge", T.has_text(F.col("deal_badge")))
    df = price_features(df)
    name = T.dict_text_field(F.col("category"), "name") if "category" in types else F.lit(None).cast("string")
    return df.withColumn("category_name", name)
