"""Parsing, feature and merge queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import prices as P
from ..functions import text as T
from ..operators import columns as C
from ..operators import quantiles as X
from ..operators.latest import latest_columns, latest_row
from ..operators.merge import merge_history
from ..sources.files import select_existing
from .registry import query, rounded
from .tables import HISTORY_SQL, PRODUCTS_SQL, TIE, enriched_sql, share_sql, volume_sql

_WANTED = ["p_partkey", "p_name", "p_missing", "p_retailprice", "p_other"]


@query("select_existing", "SELECT p_partkey, p_name, p_retailprice FROM part")
def select_existing_query(t):
    return select_existing(t.part, _WANTED)


@query(
    "ensure_columns",
    "SELECT p_partkey, p_name, 'Unknown' AS product_byline, CAST(0 AS DOUBLE) AS price FROM part",
)
def ensure_columns(t):
    defaults = {"product_byline": ("string", "Unknown"), "price": ("double", 0), "p_name": ("string", "unused")}
    return C.ensure_columns(t.part.select("p_partkey", "p_name"), defaults)


@query("normalize_columns", "SELECT p_partkey AS asin, p_name AS product_title, p_retailprice AS price FROM part")
def normalize_columns(t):
    raw = t.part.select("p_partkey", "p_name", "p_retailprice").toDF(" ASIN", "Product_Title ", "PRICE")
    return C.normalize_columns(raw)


@query("pick_column", "SELECT p_partkey, p_retailprice AS price FROM part")
def pick_column(t):
    name = C.pick_column(t.part, ["product_price", "p_retailprice"])
    return t.part.select("p_partkey", F.col(name).alias("price"))


_MONEY = (
    "CASE WHEN p_size % 9 = 0 THEN 'None' WHEN p_size % 4 = 0 "
    "THEN concat('$', CAST(p_size AS STRING), ',', CAST(100 + p_partkey % 900 AS STRING), '.50') "
    "ELSE concat('$', CAST(p_retailprice AS STRING)) END"
)


@query(
    "clean_money",
    f"""SELECT p_partkey, TRY_CAST(replace(replace(money, '$', ''), ',', '') AS DOUBLE) AS price
      FROM (SELECT p_partkey, {_MONEY} AS money FROM part)""",
)
def clean_money(t):
    raw = t.part.selectExpr("p_partkey", f"{_MONEY} AS money")
    return raw.select("p_partkey", T.clean_money(F.col("money")).alias("price"))


@query(
    "to_number",
    r"""SELECT doc_id, CASE WHEN regexp_full_match(trim(raw), '[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?')
        THEN TRY_CAST(trim(raw) AS DOUBLE) END AS n
      FROM (SELECT doc_id, CASE lang WHEN 'en' THEN concat(' ', CAST(n_chars AS STRING), 'e-2 ')
        WHEN 'fr' THEN concat(CAST(n_chars AS STRING), 'd') WHEN 'de' THEN source
        ELSE concat('-', CAST(n_chars AS STRING), '.5') END AS raw FROM documents)""",
)
def to_number(t):
    raw = t.documents.selectExpr(
        "doc_id",
        "CASE lang WHEN 'en' THEN concat(' ', CAST(n_chars AS STRING), 'e-2 ') "
        "WHEN 'fr' THEN concat(CAST(n_chars AS STRING), 'd') WHEN 'de' THEN source "
        "ELSE concat('-', CAST(n_chars AS STRING), '.5') END AS raw",
    )
    return raw.select("doc_id", T.to_number(F.col("raw")).alias("n"))


@query(
    "to_ts",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS TIMESTAMP) END AS ts FROM orders""",
)
def to_ts(t):
    raw = F.concat(
        F.when(F.col("o_orderstatus") == "P", F.lit("on ")).otherwise(F.lit("")),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
    )
    return t.orders.select("o_orderkey", T.to_ts(raw).alias("ts"))


@query(
    "parse_volume",
    f"WITH {PRODUCTS_SQL} SELECT asin, CAST({volume_sql('0')} AS BIGINT) AS sales_volume_num FROM products",
)
def parse_volume(t):
    return t.products.select("asin", T.parse_volume(F.col("sales_volume")).alias("sales_volume_num"))


@query(
    "parse_distribution",
    f"WITH {PRODUCTS_SQL} SELECT asin, "
    + ", ".join(f"{share_sql(k)} AS pct_{k}stars" for k in (1, 2, 3, 4, 5))
    + " FROM products",
)
def parse_distribution(t):
    return C.expand_distribution(t.products.select("asin", "rating_distribution")).drop("rating_distribution")


@query(
    "event_shares",
    """WITH n AS (SELECT user_id, count(*) AS total, """
    + ", ".join(f"count(*) FILTER (WHERE event_type = '{e}') AS {e}" for e in ("view", "click", "signup", "error", "purchase"))
    + """ FROM events GROUP BY user_id) SELECT user_id, """
    + ", ".join(
        f"CAST({e} AS DOUBLE) / total AS pct_{e}stars" for e in ("view", "click", "signup", "error", "purchase")
    )
    + " FROM n",
)
def event_shares(t):
    """Shares from count texts of any key set: event types in place of star levels."""
    kinds = ("view", "click", "signup", "error", "purchase")
    counts = t.events.groupBy("user_id").agg(
        *[F.count_if(F.col("event_type") == e).alias(e) for e in kinds]
    )
    parts = [F.concat(F.lit(f"'{e}': "), F.col(e).cast("string")) for e in kinds]
    text = F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))
    return C.expand_distribution(counts.select("user_id", text.alias("d")), "d", kinds).drop("d")


@query(
    "dict_text_field",
    f"WITH {PRODUCTS_SQL} SELECT asin, json_extract_string(category, '$.name') AS category_name FROM products",
)
def dict_text_field(t):
    return t.products.select("asin", T.dict_text_field(F.col("category"), "name").alias("category_name"))


_QUOTED = """CASE p_partkey % 3
  WHEN 0 THEN concat("{'name': 'Shoes, None, ", p_type, "', 'id': None, 'x': True}")
  WHEN 1 THEN concat('{"name": "Men''s, True, ', p_type, '", 7: False}')
  ELSE concat("{'name': 'Ratio, 3: ", p_type, "', 'y': [None, False]}") END AS category"""


@query(
    "dict_text_quoted",
    """SELECT CAST(p_partkey AS VARCHAR) AS asin, CASE p_partkey % 3 WHEN 0 THEN 'Shoes, None, ' || p_type
      WHEN 1 THEN 'Men''s, True, ' || p_type ELSE 'Ratio, 3: ' || p_type END AS category_name FROM part""",
)
def dict_text_quoted(t):
    """Words and numbers inside quoted values stay as they are."""
    rows = t.part.selectExpr("CAST(p_partkey AS STRING) AS asin", _QUOTED)
    return rows.select("asin", T.dict_text_field(F.col("category"), "name").alias("category_name"))


@query(
    "star_keys",
    """SELECT CAST(p_partkey AS VARCHAR) AS asin,
      CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS DOUBLE) / (p_size + 3) ELSE 0e0 END AS pct_0stars,
      CASE WHEN p_size % 2 = 0 THEN 0e0 ELSE CAST(1 AS DOUBLE) / (1 + p_size) END AS pct_45stars,
      CASE WHEN p_size % 2 = 0 THEN 3e0 / (p_size + 3) ELSE CAST(p_size AS DOUBLE) / (1 + p_size) END AS pct_5stars,
      0e0 AS pct_1stars, 0e0 AS pct_2stars, 0e0 AS pct_3stars, 0e0 AS pct_4stars FROM part""",
)
def star_keys(t):
    """Unusual star keys get their columns too: 0 and 45 beside the usual five."""
    even = F.concat(F.lit("{'0': "), F.col("p_size").cast("string"), F.lit(", '5': 3}"))
    odd = F.concat(F.lit("{45: 1, 5: "), F.col("p_size").cast("string"), F.lit("}"))
    text = F.when(F.col("p_size") % 2 == 0, even).otherwise(odd)
    rows = t.part.select(F.col("p_partkey").cast("string").alias("asin"), text.alias("rating_distribution"))
    return C.expand_distribution(rows).drop("rating_distribution")



@query("event_props", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def event_props(t):
    return t.events.select("event_id", T.dict_text_field(F.col("props"), "k").alias("k"))


@query(
    "to_flags",
    f"WITH {PRODUCTS_SQL} SELECT asin, "
    + ", ".join(f"coalesce({c}, false) AS {c}" for c in ("is_amazon_choice", "is_prime", "has_aplus", "has_brandstory"))
    + " FROM products",
)
def to_flags(t):
    return C.to_flags(t.products.select("asin", "is_amazon_choice", "is_prime", "has_aplus", "has_brandstory"))


@query(
    "has_text",
    f"WITH {PRODUCTS_SQL} SELECT asin, trim(coalesce(deal_badge, '')) <> '' AS deal_badge FROM products",
)
def has_text(t):
    return t.products.select("asin", T.has_text(F.col("deal_badge")).alias("deal_badge"))


@query(
    "discount_catalog",
    f"""WITH {PRODUCTS_SQL} SELECT asin, CASE WHEN product_original_price IS NULL OR product_price IS NULL
        OR product_original_price = 0 THEN 0e0
        ELSE (product_original_price - product_price) / product_original_price * 100 END AS discount FROM products""",
)
def discount_catalog(t):
    pct = P.discount_pct_catalog(F.col("product_price"), F.col("product_original_price"))
    return t.products.select("asin", pct.alias("discount"))


_FEATURES = (
    "asin", "discount", "discount_pct", "popularity_score", "sales_per_price", "premium_badge_count",
    "rating_balance", "sales_volume_num", "deal_badge", "category_name",
)


@query("price_features", f"WITH {PRODUCTS_SQL}, {enriched_sql('0')} SELECT {', '.join(_FEATURES)} FROM enriched")
def price_features(t):
    return C.enrich(t.products, keys=T.STAR_KEYS).select(*_FEATURES)


@query(
    "brand_short",
    f"""WITH {PRODUCTS_SQL} SELECT asin,
        trim(replace(replace(product_byline, 'Visit the ', ''), ' Store', '')) AS brand,
        upper(b[1]) || b[2:] AS brand_title
      FROM (SELECT *, trim(replace(replace(lower(product_byline), 'visit the ', ''), ' store', '')) AS b FROM products)""",
)
def brand_short(t):
    byline = F.col("product_byline")
    return t.products.select(
        "asin", T.brand_short(byline).alias("brand"), T.brand_short(byline, title=True).alias("brand_title")
    )


@query(
    "price_band",
    """SELECT p_partkey, CASE WHEN p <= 930 THEN 'economy' WHEN p <= 970 THEN 'mid' ELSE 'premium' END AS band
      FROM (SELECT p_partkey, CASE WHEN p_size > 2 THEN p_retailprice END AS p FROM part)""",
)
def price_band(t):
    price = F.when(F.col("p_size") > 2, F.col("p_retailprice"))
    return t.part.select("p_partkey", P.price_band(price, (930.0, 970.0)).alias("band"))


@query(
    "log_features",
    f"""WITH {PRODUCTS_SQL}, {enriched_sql()} SELECT asin,
        round(ln(1 + greatest(coalesce(product_num_ratings, 0), 0)), 9) AS ratings_log,
        round(ln(1 + greatest(coalesce(sales_volume_num, 0), 0)), 9) AS sales_log FROM enriched""",
)
def log_features(t):
    rows = C.enrich(t.products, null_sales=None, keys=T.STAR_KEYS).select(
        "asin",
        P.log_feature(F.col("product_num_ratings")).alias("ratings_log"),
        P.log_feature(F.col("sales_volume_num")).alias("sales_log"),
    )
    return rounded(rows, 9, "ratings_log", "sales_log")


@query(
    "fill_median",
    f"""WITH {PRODUCTS_SQL}, m AS (SELECT quantile_cont(product_price, 0.5) AS a,
        quantile_cont(product_original_price, 0.5) AS b FROM products)
      SELECT asin, coalesce(product_price, (SELECT a FROM m)) AS product_price,
        coalesce(product_original_price, (SELECT b FROM m)) AS product_original_price FROM products""",
)
def fill_median(t):
    rows = t.products.select("asin", "product_price", "product_original_price")
    return X.fill_median(rows, ["product_price", "product_original_price"])


# --- latest observation ----------------------------------------------------------------------

_GAPPY = {
    "date": "CASE WHEN l_tax = 0 THEN NULL ELSE l_shipdate END",
    "price": "CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_extendedprice / l_quantity END",
    "qty": "CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_quantity END",
}
_GAPPY_LIST = ", ".join(f"{e} AS {c}" for c, e in _GAPPY.items())
_TIES = "l_orderkey AS t1, l_linenumber AS t2, l_suppkey AS t3, l_extendedprice AS t4, l_discount AS t5"
_LATE = "row(date IS NULL, date, t1, t2, t3, t4, t5)"


@query(
    "latest_columns",
    f"""WITH h AS (SELECT l_partkey, {_GAPPY_LIST}, {_TIES} FROM lineitem),
      o AS (SELECT *, row_number() OVER (PARTITION BY l_partkey
        ORDER BY date IS NULL, date, t1, t2, t3, t4, t5) AS r FROM h)
      SELECT l_partkey, max(date) AS date, arg_max(price, r) FILTER (WHERE price IS NOT NULL) AS price,
        arg_max(qty, r) FILTER (WHERE qty IS NOT NULL) AS qty
      FROM o GROUP BY l_partkey""",
)
def latest_columns_query(t):
    rows = t.lineitem.selectExpr("l_partkey", *[f"{e} AS {c}" for c, e in _GAPPY.items()], *_TIES.split(", "))
    return latest_columns(rows, "l_partkey", "date", [*TIE, "t5"]).select("l_partkey", "date", "price", "qty")


@query(
    "latest_columns_nan",
    """SELECT l_partkey, max(l_shipdate) AS date, arg_max(l_discount, row(l_shipdate, l_orderkey, l_linenumber))
        FILTER (WHERE l_returnflag <> 'A') AS discount FROM lineitem GROUP BY l_partkey""",
)
def latest_columns_nan(t):
    """NaN never hides an earlier value."""
    discount = F.when(F.col("l_returnflag") == "A", float("nan")).otherwise(F.col("l_discount"))
    rows = t.lineitem.select("l_partkey", F.col("l_shipdate").alias("date"), discount.alias("discount"), "l_orderkey", "l_linenumber")
    return latest_columns(rows, "l_partkey", "date", ["l_orderkey", "l_linenumber"]).drop("l_orderkey", "l_linenumber")


@query(
    "latest_columns_events",
    """SELECT user_id, max(ts) AS ts, arg_max(event_type, ts) AS event_type,
        arg_max(value, ts) FILTER (WHERE event_type <> 'view') AS value FROM events GROUP BY user_id""",
)
def latest_columns_events(t):
    rows = t.events.selectExpr("user_id", "ts", "event_type", "CASE WHEN event_type <> 'view' THEN value END AS value")
    return latest_columns(rows, "user_id", "ts")


@query(
    "latest_row",
    f"""SELECT l_partkey, date, price, qty FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey
        ORDER BY date DESC, t1, t2, t3, t4, t5) AS rn
      FROM (SELECT l_partkey, {_GAPPY_LIST}, {_TIES} FROM lineitem) WHERE date IS NOT NULL) WHERE rn = 1""",
)
def latest_row_query(t):
    rows = t.lineitem.selectExpr("l_partkey", *[f"{e} AS {c}" for c, e in _GAPPY.items()], *_TIES.split(", "))
    return latest_row(rows, "l_partkey", "date", [*TIE, "t5"]).select("l_partkey", "date", "price", "qty")


@query(
    "latest_row_events",
    """SELECT user_id, event_id, ts, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id
        ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn = 1""",
)
def latest_row_events(t):
    rows = t.events.select("user_id", "event_id", "ts", "event_type", "value")
    return latest_row(rows, "user_id", "ts", ["event_id"])


# --- merge -----------------------------------------------------------------------------------


@query(
    "merge_history",
    """SELECT h.k AS asin, h.l_shipdate AS date, h.note AS note_x, p.note AS note_y, p.p_name AS product_title,
        h.k AS asin_group
      FROM (SELECT CAST(nullif(l_partkey, 7) AS VARCHAR) AS k, l_shipdate, l_returnflag AS note FROM lineitem) h
      LEFT JOIN (SELECT CAST(CASE WHEN p_size <= 5 THEN -p_partkey ELSE nullif(p_partkey, 11) END AS VARCHAR) AS k, p_name, p_brand AS note FROM part) p
        ON h.k IS NOT DISTINCT FROM p.k""",
)
def merge_history_query(t):
    history = t.lineitem.selectExpr("CAST(nullif(l_partkey, 7) AS STRING) AS asin", "l_shipdate AS date", "l_returnflag AS note")
    key = "CAST(CASE WHEN p_size <= 5 THEN -p_partkey ELSE nullif(p_partkey, 11) END AS STRING) AS asin"
    details = t.part.selectExpr(key, "p_name AS product_title", "p_brand AS note")
    return merge_history(history, details)


@query(
    "enriched_rows",
    f"""WITH {PRODUCTS_SQL}, {HISTORY_SQL}, {enriched_sql('0')}
      SELECT h.asin, h.date, h.price, e.discount_pct, e.sales_volume_num, e.premium_badge_count, h.asin AS asin_group
      FROM (SELECT DISTINCT asin, date, price FROM history) h LEFT JOIN enriched e ON h.asin = e.asin""",
)
def enriched_rows(t):
    from ..plans.enrichment import build_enriched

    rows = build_enriched(t.history.select("asin", "date", "price"), t.products, keys=T.STAR_KEYS)
    return rows.select("asin", "date", "price", "discount_pct", "sales_volume_num", "premium_badge_count", "asin_group")


@query(
    "full_chain",
    f"""WITH {PRODUCTS_SQL}, {HISTORY_SQL}, {enriched_sql('0')}
      SELECT h.asin, h.date, h.price, e.product_title, e.product_price, e.discount_pct, e.sales_volume_num,
        e.rating_balance, h.asin AS asin_group
      FROM (SELECT DISTINCT asin, date, price FROM history) h JOIN enriched e ON h.asin = e.asin
      WHERE e.product_price IS NOT NULL""",
)
def full_chain(t):
    """Clean details, merge, validate, enrich: each detail row and each history row comes twice."""
    from ..plans.enrichment import build_enriched, validate

    details = t.products.withColumn("loaded_at", F.lit(1))
    later = details.withColumns({"loaded_at": F.lit(2), "product_title": F.lit("later"), "product_price": F.lit(1.0)})
    history = t.history.select("asin", "date", "price")
    rows = build_enriched(history.unionAll(history), later.unionAll(details), order=["loaded_at"])
    rows, _ = validate(rows, ["asin", "price", "product_price"])
    return rows.select(
        "asin", "date", "price", "product_title", "product_price", "discount_pct", "sales_volume_num", "rating_balance", "asin_group"
    )
