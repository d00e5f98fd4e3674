"""Landed API responses to rows. Input rows hold the JSON text in ``body``.

Every parser keeps one output row (or more) per readable response and leaves the reason in
``error`` for the others, so that one bad response never stops a run.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.prices import NO_PRICE, SERIES_EPOCH, cents, series_time

# Texts written for values a response leaves out.
INVENTORY_DEFAULTS = {
    "title": "Sin título",
    "availabilityAmazon": "No disponible",
    "availabilityFBA": "No disponible",
    "condition": "No especificado",
}
# Reasons for a price response that holds no series.
NO_PRODUCTS_KEY = "no products in response"
NO_PRODUCTS = "products is empty"
NO_SERIES = "no price history"
BROKEN_SERIES = "price history is not a list of pairs"


def request_failed(df: DataFrame) -> Column:
    """True for rows whose request itself failed (HTTP status or transport error)."""
    failed = F.lit(False)
    if "status_code" in df.columns:
        failed = failed | F.coalesce(F.col("status_code") >= 400, F.lit(False))
    if "error" in df.columns:
        failed = failed | F.col("error").isNotNull()
    return failed


def cut_after_first(df: DataFrame, key: str | None, order: str, cond: Column) -> DataFrame:
    """Drop, per key, the first row that meets ``cond`` and every row at or after it in ``order``.

    The cut points are a small aggregate (only keys with a hit, one row each), joined back; no
    key's rows are gathered in one task. Without a key the cut is global.
    """
    hits = df.where(cond)
    if key is None:
        cut = hits.agg(F.min(order).alias("cut")).scalar()
        return df.where(F.coalesce(F.col(order) < cut, F.lit(True)))
    cuts = hits.groupBy(F.col(key).alias("_key")).agg(F.min(order).alias("_cut"))
    return (
        df.join(cuts, F.col(key).eqNullSafe(F.col("_key")), "left")
        .where(F.col("_cut").isNull() | (F.col(order) < F.col("_cut")))
        .drop("_key", "_cut")
    )


def explode_pages(df: DataFrame, product_schema: str, key: str | None = None) -> DataFrame:
    """Search pages to one row per product.

    A failed request, a status other than ``OK`` or an empty list ends the scan of that query, so
    later pages are dropped. ``key`` names the query column when pages of several queries are mixed.
    """
    schema = f"data struct<products: array<struct<{product_schema}>>>"
    # The cut needs the status and the number of products only; the products of the pages that stay are
    # parsed after it.
    bad = (
        request_failed(df)
        | ~F.coalesce(F.get_json_object("body", "$.status") == "OK", F.lit(False))
        | F.coalesce(F.json_array_length(F.get_json_object("body", "$.data.products")) <= 0, F.lit(True))
    )
    kept = cut_after_first(df, key, "page", bad).withColumn("_page", F.from_json("body", schema))
    carried = [c for c in (key, "page") if c]
    return kept.select(*carried, F.posexplode("_page.data.products").alias("position", "product")).select(
        *carried, "position", "product.*"
    )


def unwrap_details(df: DataFrame, detail_schema: str) -> DataFrame:
    """Detail responses to one row each with a ``bucket``: ``ok``, ``no_data`` or ``error``.

    The id is the one in the response, or else the one that was asked for.
    """
    names = StructType.fromDDL(detail_schema).fieldNames()
    asin = F.coalesce(F.col("_d.asin"), F.col("asin")) if "asin" in names else F.col("asin")
    data = F.try_variant_get("_body", "$.data", "variant")
    fields = F.try_variant_get("_body", "$.data", "map<string,variant>")
    bucket = (
        F.when(request_failed(df) | F.col("_body").isNull(), "error")
        .when(F.coalesce(F.size(fields), F.lit(0)) > 0, "ok")
        .otherwise("no_data")
    )
    http_text = F.lit(None).cast("string")
    if "status_code" in df.columns:
        http_text = F.when(F.col("status_code") >= 400, F.format_string("HTTP %d", F.col("status_code")))
    given = F.col("error") if "error" in df.columns else F.lit(None).cast("string")
    reason = F.when(F.col("bucket") == "error", F.coalesce(given, http_text, F.lit("unreadable response")))
    detail = F.when(F.col("bucket") == "ok", F.from_json(F.to_json(data), detail_schema))
    return (
        df.withColumn("_body", F.try_parse_json("body"))
        .withColumn("bucket", bucket)
        .withColumn("error", reason)
        .withColumn("_d", detail)
        .select(asin.alias("asin"), "bucket", "error", *[F.col(f"_d.{n}") for n in names if n != "asin"])
    )


def validate_series(df: DataFrame) -> DataFrame:
    """Price responses to ``(asin, series, error)``; exactly one of the last two is null.

    The reasons are tried in order: failed request, unreadable text, no ``products``, empty
    ``products``, no ``csv``, series missing or of odd length. The text is parsed once.
    """
    at = lambda path, kind="variant": F.try_variant_get("_body", path, kind)
    given = F.col("error") if "error" in df.columns else F.lit(None).cast("string")
    reason = (
        F.when(request_failed(df), F.coalesce(given, F.lit("request failed")))
        .when(F.col("_body").isNull(), "unreadable response")
        .when(at("$.products").isNull(), NO_PRODUCTS_KEY)
        .when(F.coalesce(F.size(at("$.products", "array<variant>")), F.lit(0)) <= 0, NO_PRODUCTS)
        .when(at("$.products[0].csv").isNull(), NO_SERIES)
        .when(F.coalesce(F.size("_series") % 2 != 0, F.lit(True)), BROKEN_SERIES)
    )
    return (
        df.withColumn("_body", F.try_parse_json("body"))
        .withColumn("_series", F.try_variant_get("_body", "$.products[0].csv[0]", "array<bigint>"))
        .withColumn("_reason", reason)
        .select(
            "asin",
            F.when(F.col("_reason").isNull(), F.col("_series")).alias("series"),
            F.col("_reason").alias("error"),
        )
    )


def decode_price_series(df: DataFrame, as_of: str | datetime, days: int = 365) -> DataFrame:
    """``series`` arrays ``[t, p, t, p, ...]`` to rows ``(asin, date, price)``; a null array gives none.

    Pairs without a price and pairs older than ``days`` before ``as_of`` are dropped inside the
    array, on the stored whole minutes, before rows are made.
    """
    moment = as_of if isinstance(as_of, datetime) else datetime.fromisoformat(as_of)
    since = moment - timedelta(days=days) - datetime.fromisoformat(SERIES_EPOCH)
    first_minute = -(-since // timedelta(minutes=1))  # rounded up
    series = F.col("series")
    starts = F.when(F.size(series) >= 2, F.sequence(F.lit(0), F.floor(F.size(series) / 2).cast("int") - 1))
    pairs = F.transform(
        starts, lambda i: F.struct(F.get(series, i * 2).alias("t"), F.get(series, i * 2 + 1).alias("p"))
    )
    wanted = F.filter(pairs, lambda x: (x["p"] != NO_PRICE) & (x["t"] >= first_minute))
    return df.select("asin", F.inline(wanted)).select(
        "asin", series_time(F.col("t")).alias("date"), cents(F.col("p")).alias("price")
    )


def tag_reviews(df: DataFrame) -> DataFrame:
    """Review responses with ``_data``, the reviews of a readable response, and ``error``, the reason why
    there are none: a failed request, or ``data`` that is neither a list, nor an object, nor left out.
    The text is parsed once; ``body`` is dropped.
    """
    failed = request_failed(df)
    given = F.col("error") if "error" in df.columns else F.lit(None).cast("string")
    http_text = F.format_string("HTTP %d", F.col("status_code")) if "status_code" in df.columns else F.lit("request failed")
    kind = F.schema_of_variant(F.try_variant_get("_body", "$.data", "variant"))
    readable = F.col("_body").isNotNull() & F.coalesce(kind.startswith("ARRAY") | kind.startswith("OBJECT"), F.lit(True))
    reason = F.when(failed, F.coalesce(given, http_text)).when(~readable, "unreadable response")
    return (
        df.withColumn("_body", F.try_parse_json("body")).withColumn("_reason", reason)
        .withColumn("_data", F.when(F.col("_reason").isNull(), F.try_variant_get("_body", "$.data", "variant")))
        .drop("body", "_body", "error").withColumnRenamed("_reason", "error")
    )


def flatten_reviews(df: DataFrame, fields: Mapping[str, str] | None = None) -> DataFrame:
    """Review responses, whose ``data`` mixes objects and plain values, to one row per review.

    Objects keep their JSON in ``record`` (and the named ``fields`` as typed columns); plain values
    go to ``review``. When ``data`` itself is an object, each of its keys is a review. Other
    ``data`` gives no rows (see ``tag_reviews``, whose result is taken as well).
    """
    spark = df.sparkSession
    if "_data" not in df.columns:
        df = df.withColumn("_data", F.try_variant_get(F.try_parse_json("body"), "$.data", "variant"))
    rows = df.lateralJoin(spark.tvf.variant_explode(F.col("_data").outer()))
    kind = F.schema_of_variant(F.col("value"))
    from_object = F.col("key").isNotNull()
    is_record = ~from_object & kind.startswith("OBJECT")
    review = F.when(from_object, F.col("key")).when(~is_record, F.try_variant_get("value", "$", "string"))
    carried = [c for c in ("asin", "page") if c in df.columns]
    typed = [
        F.when(is_record, F.try_variant_get("value", f"$.{name}", data_type)).alias(name)
        for name, data_type in (fields or {}).items()
    ]
    record = F.when(is_record, F.to_json("value"))
    return rows.select(*carried, F.col("pos").alias("position"), review.alias("review"), record.alias("record"), *typed)


def project_inventory(df: DataFrame) -> DataFrame:
    """First product of each inventory response.

    A field that is absent gets its default text, one that is present but null stays null; a missing
    id falls back to the id that was asked for. An empty or malformed list gives an ``error`` row.
    """
    products = F.try_variant_get("_body", "$.products", "variant")
    first = F.try_variant_get("_body", "$.products[0]", "map<string,variant>")
    absent = F.col("_body").isNotNull() & products.isNull()
    broken = request_failed(df) | F.col("_body").isNull() | (~absent & F.col("_p").isNull())

    def field(name: str, default: Column) -> Column:
        present = F.coalesce(F.map_contains_key(F.col("_p"), name), F.lit(False))
        found = F.try_variant_get(F.try_element_at(F.col("_p"), F.lit(name)), "$", "string")
        value = F.when(present, found).otherwise(default)
        return F.when(F.col("error").isNull(), value)

    return (
        df.withColumn("_body", F.try_parse_json("body"))
        .withColumn("_p", first)
        .withColumn("error", F.when(broken, F.lit("no inventory in response")))
        .select(
            F.coalesce(field("asin", F.col("asin")), F.col("asin")).alias("asin"),
            field("title", F.lit(INVENTORY_DEFAULTS["title"])).alias("title"),
            field("availabilityAmazon", F.lit(INVENTORY_DEFAULTS["availabilityAmazon"])).alias("available_amazon"),
            field("availabilityFBA", F.lit(INVENTORY_DEFAULTS["availabilityFBA"])).alias("available_third"),
            field("condition", F.lit(INVENTORY_DEFAULTS["condition"])).alias("condition"),
            "error",
        )
    )


def union_pages(*frames: DataFrame) -> DataFrame:
    """Append page frames by column name; a column one of them lacks is null there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
