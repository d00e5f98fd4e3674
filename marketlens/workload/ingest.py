"""Ingestion and data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators.merge import merge_history
from ..plans.ingestion import build_catalog, build_details, build_history, build_reviews
from ..session import spread
from ..sources import envelopes as E
from ..sources import files, requests
from .registry import query
from .tables import HISTORY_SQL, PRODUCTS_SQL

# --- landed responses built row by row from the test tables ----------------------------------

_PAGES_SQL = """pages_in AS (SELECT p_partkey // 1000 AS q, p_partkey // 100 % 10 + 1 AS page, *,
  sum(p_size) OVER (PARTITION BY p_partkey // 100) % 5 AS code FROM part),
  kept AS (SELECT * FROM pages_in p WHERE NOT EXISTS (
    SELECT 1 FROM pages_in b WHERE b.q = p.q AND b.code = 0 AND b.page <= p.page))"""


def landed_search(t):
    """Search responses of 100 products, ten pages per query; some pages report an error."""
    item = F.struct(
        F.col("p_partkey").cast("string").alias("asin"),
        F.col("p_name").alias("product_title"),
        F.concat(F.lit("$"), F.col("p_retailprice").cast("string")).alias("product_price"),
    )
    page_no = F.floor(F.col("p_partkey") / 100)
    packed = t.part.groupBy(page_no.alias("no")).agg(
        F.collect_list(item).alias("products"), (F.sum("p_size") % 5).alias("code")
    )
    body = F.to_json(
        F.struct(
            F.when(F.col("code") == 0, "ERROR").otherwise("OK").alias("status"),
            F.struct("products").alias("data"),
        )
    )
    return packed.select(
        F.floor(F.col("no") / 10).alias("q"), (F.col("no") % 10 + 1).alias("page"), body.alias("body")
    )


@query(
    "explode_pages",
    f"WITH {_PAGES_SQL} SELECT q, page, CAST(p_partkey AS VARCHAR) AS asin, p_name AS product_title, "
    "p_retailprice AS product_price FROM kept",
)
def explode_pages(t):
    from ..functions.text import clean_money

    rows = E.explode_pages(landed_search(t), "asin string, product_title string, product_price string", key="q")
    return rows.select("q", "page", "asin", "product_title", clean_money(F.col("product_price")).alias("product_price"))


@query(
    "build_catalog",
    f"WITH {_PAGES_SQL} SELECT CAST(p_partkey AS VARCHAR) AS asin, p_name AS product_title, "
    "p_retailprice AS product_price, NULL::DOUBLE AS product_original_price, 0e0 AS discount, "
    "NULL::DOUBLE AS product_star_rating, NULL::DOUBLE AS product_num_ratings FROM kept",
)
def build_catalog_query(t):
    return build_catalog(landed_search(t), "asin string, product_title string, product_price string", key="q")


@query(
    "unwrap_details",
    """SELECT CAST(p_partkey AS VARCHAR) AS asin,
      CASE WHEN p_size % 11 = 0 THEN 'error' WHEN p_size % 7 = 0 THEN 'no_data' ELSE 'ok' END AS bucket,
      CASE WHEN p_size % 11 = 0 THEN 'HTTP 429' END AS error,
      CASE WHEN p_size % 11 <> 0 AND p_size % 7 <> 0 THEN p_name END AS product_title,
      CASE WHEN p_size % 11 <> 0 AND p_size % 7 <> 0 THEN p_retailprice END AS product_price FROM part""",
)
def unwrap_details(t):
    return E.unwrap_details(landed_details(t), "product_title string, product_price double")


def landed_details(t):
    """Detail responses of all products; some are empty, some failed."""
    data = F.struct(F.col("p_name").alias("product_title"), F.col("p_retailprice").alias("product_price"))
    body = F.when(F.col("p_size") % 7 == 0, F.lit('{"data": {}}')).otherwise(F.to_json(F.struct(data.alias("data"))))
    landed = t.part.select(
        F.col("p_partkey").cast("string").alias("asin"),
        F.when(F.col("p_size") % 11 == 0, 429).otherwise(200).alias("status_code"),
        body.alias("body"),
    )
    return landed


@query(
    "details_job",
    """SELECT CASE WHEN p_size % 11 = 0 THEN 'error' WHEN p_size % 7 = 0 THEN 'no_data' ELSE 'ok' END AS kind,
      CAST(p_partkey AS VARCHAR) AS asin, CASE WHEN p_size % 11 = 0 THEN 'HTTP 429' END AS error,
      CASE WHEN p_size % 11 <> 0 AND p_size % 7 <> 0 THEN p_name END AS product_title FROM part""",
)
def details_job(t):
    """All outputs of the job, tagged."""
    ok, no_data, errors = build_details(landed_details(t), "product_title string, product_price double")
    kind = lambda df, name: df.withColumn("kind", F.lit(name))
    rows = E.union_pages(kind(ok.select("asin", "product_title"), "ok"), kind(no_data, "no_data"), kind(errors, "error"))
    return rows.select("kind", "asin", "error", "product_title")


def landed_series(t):
    """One price response per line item: its price, a gap 30 days on, a lower price 60 days on."""
    minutes = F.date_diff(F.col("l_shipdate").cast("date"), F.lit("2011-01-01").cast("date")) * 1440
    cents = F.round(F.col("l_extendedprice") * 100 / F.col("l_quantity")).cast("bigint")
    points = [minutes, cents, minutes + 43200, F.lit(-1), minutes + 86400, cents - 100]
    series = F.concat_ws(",", *[p.cast("string") for p in points])
    body = F.concat(F.lit('{"products": [{"csv": [['), series, F.lit("]]}]}"))
    number = F.col("l_linenumber")
    damaged = (
        F.when(number == 1, F.when(F.col("l_returnflag") == "R", '{"message": "none"}').otherwise(body))
        .when((number == 2) & (F.col("l_linestatus") == "O"), '{"products": []}')
        .when((number == 3) & (F.col("l_linestatus") == "O"), '{"products": [{"title": "x"}]}')
        .when((number == 4) & (F.col("l_linestatus") == "O"), '{"products": [{"csv": [null]}]}')
        .when((number == 5) & (F.col("l_linestatus") == "O"), '{"products": [{"csv": [[1, 2, 3]]}]}')
        .otherwise(body)
    )
    return spread(t.lineitem).select(F.col("l_partkey").cast("string").alias("asin"), damaged.alias("body"))


_REASON_SQL = """CASE WHEN l_linenumber = 1 AND l_returnflag = 'R' THEN 'no products in response'
  WHEN l_linenumber = 2 AND l_linestatus = 'O' THEN 'products is empty'
  WHEN l_linenumber = 3 AND l_linestatus = 'O' THEN 'no price history'
  WHEN l_linenumber IN (4, 5) AND l_linestatus = 'O' THEN 'price history is not a list of pairs' END"""
_CENTS_SQL = "CAST(round(l_extendedprice * 100 / l_quantity) AS BIGINT)"


@query(
    "validate_series",
    f"""SELECT CAST(l_partkey AS VARCHAR) AS asin, {_REASON_SQL} AS error,
      CASE WHEN {_REASON_SQL} IS NULL THEN 6 ELSE 0 END AS n_values FROM lineitem""",
)
def validate_series(t):
    checked = E.validate_series(landed_series(t))
    return checked.select("asin", "error", F.coalesce(F.size("series"), F.lit(0)).alias("n_values"))


@query(
    "decode_price_series",
    f"""WITH good AS (SELECT * FROM lineitem WHERE {_REASON_SQL} IS NULL),
      points AS (SELECT l_partkey, l_shipdate AS d, {_CENTS_SQL} AS c FROM good
        UNION ALL SELECT l_partkey, l_shipdate + INTERVAL 60 DAY, {_CENTS_SQL} - 100 FROM good)
      SELECT CAST(l_partkey AS VARCHAR) AS asin, d AS date, c / 1e2 AS price FROM points
      WHERE d >= TIMESTAMP '2001-11-04' - INTERVAL 365 DAY AND c <> -1""",
)
def decode_price_series(t):
    checked = E.validate_series(landed_series(t))
    return E.decode_price_series(checked, as_of="2001-11-04")


@query(
    "history_job",
    f"""WITH good AS (SELECT * FROM lineitem WHERE {_REASON_SQL} IS NULL),
      points AS (SELECT l_partkey, l_shipdate AS d, {_CENTS_SQL} AS c FROM good
        UNION ALL SELECT l_partkey, l_shipdate + INTERVAL 60 DAY, {_CENTS_SQL} - 100 FROM good)
      SELECT CAST(l_partkey AS VARCHAR) AS asin, d AS date, c / 1e2 AS price, NULL AS error FROM points
      WHERE d >= TIMESTAMP '2001-11-04' - INTERVAL 365 DAY AND c <> -1
      UNION ALL SELECT CAST(l_partkey AS VARCHAR), NULL, NULL, {_REASON_SQL} FROM lineitem WHERE {_REASON_SQL} IS NOT NULL""",
)
def history_job(t):
    """Price rows and error rows of the job, tagged by ``error``."""
    rows, errors = build_history(landed_series(t), as_of="2001-11-04")
    return E.union_pages(rows, errors).select("asin", "date", "price", "error")


@query(
    "reviews_job",
    """WITH l AS (SELECT *, CASE WHEN turn = 5 AND conv_id % 2 = 0 THEN 429 WHEN turn = 1 THEN 500 ELSE 200 END AS code,
        turn = 3 AS broken FROM conversations),
      k AS (SELECT * FROM l WHERE NOT (conv_id % 2 = 0 AND turn >= 5))
      SELECT CAST(conv_id AS VARCHAR) AS asin, turn AS page, text, NULL AS error FROM k WHERE code = 200 AND NOT broken
      UNION ALL SELECT CAST(conv_id AS VARCHAR), turn, NULL, CASE WHEN code = 500 THEN 'HTTP 500' ELSE 'unreadable response' END
      FROM k WHERE code = 500 OR broken""",
)
def reviews_job(t):
    """Reviews and error rows of the job, tagged by ``error``; a rate limit ends a product's pages."""
    code = F.when((F.col("turn") == 5) & (F.col("conv_id") % 2 == 0), 429).when(F.col("turn") == 1, 500).otherwise(200)
    body = F.when(F.col("turn") == 3, '{"data": 7}').otherwise(F.to_json(F.struct(F.array(F.struct("text")).alias("data"))))
    landed = t.conversations.select(
        F.col("conv_id").cast("string").alias("asin"), F.col("turn").alias("page"), code.alias("status_code"),
        F.lit(None).cast("string").alias("error"), body.alias("body"),
    )
    reviews, errors = build_reviews(landed, {"text": "string"})
    return E.union_pages(reviews.select("asin", "page", "text"), errors).select("asin", "page", "text", "error")


@query(
    "flatten_reviews",
    """SELECT CAST(conv_id AS VARCHAR) AS asin, turn AS page, i AS position,
      CASE WHEN turn = 0 THEN CASE i WHEN 0 THEN 'role' ELSE 'text' END WHEN i = 1 THEN role END AS review,
      CASE WHEN turn <> 0 AND i = 0 THEN text END AS text
      FROM conversations, (SELECT unnest([0, 1]) AS i)""",
)
def flatten_reviews(t):
    record = F.struct("text", "role")
    mixed = F.concat(F.lit('{"data": ['), F.to_json(record), F.lit(', "'), F.col("role"), F.lit('"]}'))
    body = F.when(F.col("turn") == 0, F.to_json(F.struct(record.alias("data")))).otherwise(mixed)
    landed = t.conversations.select(
        F.col("conv_id").cast("string").alias("asin"), F.col("turn").alias("page"), body.alias("body")
    )
    return E.flatten_reviews(landed, {"text": "string"}).drop("record")


@query(
    "cut_after_first",
    """SELECT event_id, user_id, event_type FROM events e WHERE NOT EXISTS (
      SELECT 1 FROM (SELECT user_id, min(event_id) AS cut FROM events WHERE event_type = 'error' GROUP BY user_id) c
      WHERE c.user_id = e.user_id AND e.event_id >= c.cut)""",
)
def cut_after_first(t):
    rows = t.events.select("event_id", "user_id", "event_type")
    return E.cut_after_first(rows, "user_id", "event_id", F.col("event_type") == "error")


@query(
    "project_inventory",
    """WITH p AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_name, p_size, p_size % 5 = 0 AS broken,
        p_size % 7 = 0 AS bare FROM part)
      SELECT CASE WHEN NOT broken AND NOT bare AND p_size % 2 = 0 THEN 'own-' || id ELSE id END AS asin,
        CASE WHEN broken THEN NULL WHEN bare THEN 'Sin título' ELSE p_name END AS title,
        CASE WHEN broken THEN NULL WHEN bare THEN 'No disponible'
          WHEN p_size % 3 <> 0 THEN CAST(p_size AS VARCHAR) END AS available_amazon,
        CASE WHEN NOT broken THEN 'No disponible' END AS available_third,
        CASE WHEN NOT broken THEN 'No especificado' END AS condition,
        CASE WHEN broken THEN 'no inventory in response' END AS error FROM p""",
)
def project_inventory(t):
    asin = F.col("p_partkey").cast("string")
    own_id = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit('"asin": "own-'), asin, F.lit('", '))).otherwise("")
    stock = F.when(F.col("p_size") % 3 == 0, F.lit("null")).otherwise(F.col("p_size").cast("string"))
    product = F.concat(
        F.lit('{"products": [{'), own_id, F.lit('"title": "'), F.col("p_name"), F.lit('", "availabilityAmazon": '),
        stock, F.lit("}, {}]}"),
    )
    body = (
        F.when(F.col("p_size") % 5 == 0, F.lit('{"products": []}'))
        .when(F.col("p_size") % 7 == 0, F.lit('{"timestamp": 1}'))
        .otherwise(product)
    )
    return E.project_inventory(t.part.select(asin.alias("asin"), body.alias("body")))


@query("distinct_keys", "SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS l_partkey FROM lineitem WHERE l_partkey IS NOT NULL")
def distinct_keys(t):
    return requests.distinct_keys(t.lineitem, "l_partkey")


@query(
    "request_manifest",
    "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, page FROM part, (SELECT unnest([1, 2, 3]) AS page)",
)
def request_manifest(t):
    return requests.request_manifest(requests.distinct_keys(t.part, "p_partkey"), pages=3)


@query(
    "retry_list",
    """SELECT o_orderkey AS asin FROM orders
      WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
        AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'N')""",
)
def retry_list(t):
    manifest = t.orders.select(F.col("o_orderkey").alias("asin"))
    line = t.lineitem.select(F.col("l_orderkey").alias("asin"), "l_returnflag")
    ok = line.where(F.col("l_returnflag") == "N")
    return requests.retry_list(manifest, ok, line.where(F.col("l_returnflag") == "R"))


@query(
    "reconcile_counts",
    f"""WITH {HISTORY_SQL}, {PRODUCTS_SQL}
      SELECT (SELECT count(*) FROM history) AS source_rows, count(*) AS loaded_rows,
        (SELECT count(*) FROM history) = count(*) AS matches
      FROM history h LEFT JOIN products p ON h.asin IS NOT DISTINCT FROM p.asin""",
)
def reconcile_counts(t):
    return files.reconcile_counts(t.history, merge_history(t.history, t.products))


@query(
    "union_pages",
    """SELECT p_partkey, p_name, p_size, NULL::DOUBLE AS p_retailprice FROM part WHERE p_size <= 25
      UNION ALL SELECT p_partkey, NULL, p_size, p_retailprice FROM part WHERE p_size > 25""",
)
def union_pages(t):
    small = t.part.where("p_size <= 25").select("p_partkey", "p_name", "p_size")
    return E.union_pages(small, t.part.where("p_size > 25").select("p_partkey", "p_size", "p_retailprice"))


# --- quality ---------------------------------------------------------------------------------


@query(
    "dedup_keyed",
    """SELECT doc_id, lang, source, text FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn
      FROM documents) WHERE rn = 1""",
)
def dedup_keyed(t):
    return Q.drop_duplicates(t.documents.select("doc_id", "lang", "source", "text"), ["text"], ["doc_id"])


@query("dedup_rows", "SELECT DISTINCT l_partkey, l_shipdate, l_quantity FROM lineitem")
def dedup_rows(t):
    return Q.distinct_rows(t.lineitem.select("l_partkey", "l_shipdate", "l_quantity"))


@query(
    "dup_count",
    """SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_distinct, CAST(sum(n) - count(*) AS BIGINT) AS duplicates
      FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_partkey, l_shipdate)""",
)
def dup_count(t):
    return Q.count_duplicates(t.lineitem.select("l_partkey", "l_shipdate"))


@query("key_counts", "SELECT count(*) AS n_rows, count(DISTINCT l_partkey) AS n_keys FROM lineitem")
def key_counts(t):
    return Q.key_counts(t.lineitem, "l_partkey")


_NULLABLE = (
    "asin", "product_price", "product_original_price", "sales_volume", "is_prime", "is_amazon_choice", "deal_badge",
)


@query(
    "null_profile",
    f"WITH {PRODUCTS_SQL} "
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM products" for c in _NULLABLE),
)
def null_profile(t):
    return Q.null_profile(t.products.select(*_NULLABLE))


_CUSTOMER = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "bigint", "c_acctbal": "double", "c_mktsegment": "string"}


@query(
    "schema_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{kind}' AS type, count({c}) AS non_null, count(*) AS n_rows FROM customer"
        for c, kind in _CUSTOMER.items()
    ),
)
def schema_profile(t):
    return Q.schema_profile(t.customer.selectExpr(*[f"CAST({c} AS {kind}) AS {c}" for c, kind in _CUSTOMER.items()]))


_LOG_TEXT = (
    "concat('400 Client Error: Bad Request for url: https://api.example.org/product?key=', "
    "CAST(event_id * 7919 AS STRING), '&user=', CAST(user_id AS STRING))"
)


@query(
    "quarantine",
    f"""SELECT event_id, user_id, CASE WHEN event_type = 'error' THEN regexp_replace({_LOG_TEXT}, 'key=[^&]+', 'key=***') END AS error
      FROM events""",
)
def quarantine(t):
    rows = t.events.selectExpr("event_id", "user_id", f"CASE WHEN event_type = 'error' THEN {_LOG_TEXT} END AS error")
    good, errors = Q.quarantine(rows)
    return E.union_pages(good, errors)


_STATUS = (
    "CASE WHEN url LIKE 'https%' THEN '429 Client Error: Too Many Requests for url: ' "
    "WHEN url LIKE 'http:%' THEN '400 Client Error: Bad Request for url: ' ELSE 'timeout for url: ' END"
)


@query(
    "error_profile",
    f"""SELECT coalesce(TRY_CAST(regexp_extract(error, '^\\s*(\\d{{3}})\\b', 1) AS INTEGER), 0) AS status, count(*) AS n
      FROM (SELECT concat({_STATUS}, url) AS error FROM pages) GROUP BY 1""",
)
def error_profile(t):
    return Q.error_profile(t.pages.selectExpr(f"concat({_STATUS}, url) AS error")).na.fill(0, ["status"])


@query(
    "drop_nulls",
    f"""WITH {PRODUCTS_SQL} SELECT asin, product_price, product_original_price FROM products
      WHERE product_price IS NOT NULL AND product_original_price IS NOT NULL""",
)
def drop_nulls(t):
    rows = t.products.select("asin", "product_price", "product_original_price")
    return Q.drop_nulls(rows, ["product_price", "product_original_price"])
