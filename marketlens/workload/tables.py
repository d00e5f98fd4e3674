"""Test tables and their adapters to the stage schemas.

The adapter expressions are plain SQL that both engines read alike, so one list of strings serves
the Spark frame and the SQL twin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.text import STAR_KEYS

PRODUCT_COLUMNS = {
    "asin": "CAST(p_partkey AS STRING)",
    "product_title": "p_name",
    "product_price": "CASE WHEN p_partkey % 10 = 3 THEN NULL ELSE p_retailprice END",
    "product_original_price": (
        "CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 50 = 1 THEN 0e0 "
        "ELSE p_retailprice * (1 + p_size / 1e2) END"
    ),
    "product_byline": "concat('Visit the ', p_brand, ' Store')",
    "product_star_rating": "1 + (p_partkey % 41) / 1e1",
    "product_num_ratings": "(p_partkey * 13) % 5000",
    "sales_volume": (
        "CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 13 = 0 THEN 'New' "
        "ELSE concat(CAST(p_size AS STRING), 'K+ bought in past month') END"
    ),
    "rating_distribution": (
        "concat('{\"1\": ', CAST(p_partkey % 5 AS STRING), ', \"2\": ', CAST(p_partkey % 3 AS STRING), "
        "', \"4\": ', CAST(p_size % 4 AS STRING), ', \"5\": ', CAST(p_size AS STRING), '}')"
    ),
    "category": "concat('{\"id\": \"', lower(p_type), '\", \"name\": \"', p_type, '\"}')",
    "is_prime": "CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_partkey % 2 = 1 END",
    "is_amazon_choice": "p_size % 2 = 0",
    "has_aplus": "p_size % 3 = 0",
    "has_brandstory": "p_size % 5 = 0",
    "deal_badge": "CASE p_partkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE 'Deal' END",
}

HISTORY_COLUMNS = {
    "asin": "CAST(l_partkey AS STRING)",
    "date": "l_shipdate",
    "price": "l_extendedprice / l_quantity",
    "t1": "l_orderkey",
    "t2": "l_linenumber",
    "t3": "l_suppkey",
    "t4": "l_extendedprice",
}
TIE = ["t1", "t2", "t3", "t4"]

# Band bounds near the thirds of the history price.
BOUNDS = (1400.0, 3000.0)


def _select(columns: dict[str, str], table: str) -> str:
    return "SELECT " + ", ".join(f"{e} AS {c}" for c, e in columns.items()) + f" FROM {table}"


def _exprs(columns: dict[str, str]) -> list[str]:
    return [f"{e} AS {c}" for c, e in columns.items()]


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @property
    def products(self) -> DataFrame:
        return self.part.selectExpr(*_exprs(PRODUCT_COLUMNS))

    @property
    def history(self) -> DataFrame:
        return self.lineitem.selectExpr(*_exprs(HISTORY_COLUMNS))

    @property
    def snapshot(self) -> DataFrame:
        """Latest observation per product with derived columns."""
        from ..plans.enrichment import latest_snapshot

        latest = latest_snapshot(self.history, self.products, tie=TIE, null_sales=None, order=[], keys=STAR_KEYS)
        return latest.drop(*TIE)

    @property
    def latest(self) -> DataFrame:
        """Latest observation per product, without details."""
        from ..operators.latest import latest_columns

        return latest_columns(self.history, "asin", "date", TIE).drop(*TIE)


# --- SQL twins -------------------------------------------------------------------------------

PRODUCTS_SQL = f"products AS ({_select(PRODUCT_COLUMNS, 'part')})"
HISTORY_SQL = f"history AS ({_select(HISTORY_COLUMNS, 'lineitem')})"


def volume_sql(null_as: str) -> str:
    number = r"TRY_CAST(regexp_extract(sales_volume, '(\d+\.?\d*)([KkMm]?)', 1) AS DOUBLE)"
    suffix = r"upper(regexp_extract(sales_volume, '(\d+\.?\d*)([KkMm]?)', 2))"
    return (
        f"CASE WHEN sales_volume IS NULL THEN {null_as} ELSE coalesce(CAST(trunc({number} * "
        f"CASE {suffix} WHEN 'K' THEN 1e3 WHEN 'M' THEN 1e6 ELSE 1e0 END) AS BIGINT), 0) END"
    )


def star_sql(k: int) -> str:
    return f"coalesce(CAST(json_extract_string(rating_distribution, '$.\"{k}\"') AS DOUBLE), 0e0)"


STAR_TOTAL_SQL = "(" + " + ".join(star_sql(k) for k in (1, 2, 3, 4, 5)) + ")"


def share_sql(k: int) -> str:
    return f"(CASE WHEN {STAR_TOTAL_SQL} = 0 THEN 0e0 ELSE {star_sql(k)} / {STAR_TOTAL_SQL} END)"


_FLAGS = ("is_amazon_choice", "is_prime", "has_aplus", "has_brandstory")


def enriched_sql(null_as: str = "NULL") -> str:
    """Products with derived columns, as the CTE ``enriched`` (needs ``products``)."""
    return f"""
    sized AS (SELECT *, CAST({volume_sql(null_as)} AS BIGINT) AS sales_volume_num,
      {", ".join(f"{share_sql(k)} AS pct_{k}stars" for k in (1, 2, 3, 4, 5))} FROM products),
    enriched AS (SELECT asin, product_title, product_price, product_original_price, product_byline,
      product_star_rating, product_num_ratings, sales_volume, rating_distribution, category,
      {", ".join(f"coalesce({f}, false) AS {f}" for f in _FLAGS)},
      trim(coalesce(deal_badge, '')) <> '' AS deal_badge, sales_volume_num,
      pct_1stars, pct_2stars, pct_3stars, pct_4stars, pct_5stars,
      product_original_price - product_price AS discount,
      (product_original_price - product_price) / nullif(product_original_price, 0) * 100 AS discount_pct,
      product_star_rating * product_num_ratings AS popularity_score,
      sales_volume_num / (nullif(product_price, 0) + 1) AS sales_per_price,
      {" + ".join(f"CAST(coalesce({f}, false) AS INTEGER)" for f in _FLAGS)} AS premium_badge_count,
      pct_5stars - pct_1stars AS rating_balance,
      json_extract_string(category, '$.name') AS category_name FROM sized)"""


LATEST_SQL = """latest AS (SELECT asin, date, price FROM (
      SELECT *, row_number() OVER (PARTITION BY asin ORDER BY date DESC, t1 DESC, t2 DESC, t3 DESC, t4 DESC) AS rn
      FROM history) WHERE rn = 1)"""

SNAPSHOT_SQL = f"""{PRODUCTS_SQL}, {HISTORY_SQL}, {enriched_sql()}, {LATEST_SQL},
    snapshot AS (SELECT l.asin, l.date, l.price, e.* EXCLUDE (asin), l.asin AS asin_group
      FROM latest l LEFT JOIN enriched e ON l.asin = e.asin)"""

BAND_SQL = (
    f"CASE WHEN price <= {BOUNDS[0]} THEN 'economy' WHEN price <= {BOUNDS[1]} THEN 'mid' ELSE 'premium' END"
)
