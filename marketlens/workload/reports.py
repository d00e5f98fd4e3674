"""Report, chart-data and finding queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.prices import price_band
from ..functions.text import brand_short
from ..operators import findings as N
from ..operators import reports as R
from ..operators.merge import merge_history
from ..session import keep
from .registry import query, rounded
from .tables import BAND_SQL, BOUNDS, HISTORY_SQL, SNAPSHOT_SQL

_BANDS_SQL = f"banded AS (SELECT *, {BAND_SQL} AS segment FROM snapshot)"


def banded(t):
    return t.snapshot.withColumn("segment", price_band(F.col("price"), BOUNDS))


@query(
    "price_by_band",
    f"""WITH {SNAPSHOT_SQL}, {_BANDS_SQL} SELECT segment, count(price) AS n, round(avg(price), 4) AS mean_price,
      min(price) AS min_price, max(price) AS max_price FROM banded GROUP BY segment""",
)
def price_by_band(t):
    """Flagship: what do products cost now, by band? The latest history has all that is asked."""
    rows = t.latest.withColumn("segment", price_band(F.col("price"), BOUNDS))
    return rounded(R.segment_summary(rows, "segment", "price"), 4, "mean_price")


@query(
    "latest_snapshot",
    f"""WITH {SNAPSHOT_SQL} SELECT asin, date, price, product_price, discount, discount_pct, popularity_score,
      sales_per_price, premium_badge_count, rating_balance, category_name FROM snapshot""",
)
def latest_snapshot(t):
    return t.snapshot.select(
        "asin", "date", "price", "product_price", "discount", "discount_pct", "popularity_score", "sales_per_price",
        "premium_badge_count", "rating_balance", "category_name",
    )


@query(
    "segment_summary",
    """SELECT p_brand, count(p_retailprice) AS n, round(avg(p_retailprice), 6) AS mean_price,
      min(p_retailprice) AS min_price, max(p_retailprice) AS max_price FROM part GROUP BY p_brand""",
)
def segment_summary(t):
    return rounded(R.segment_summary(t.part, "p_brand", "p_retailprice"), 6, "mean_price")


@query(
    "high_sellers",
    f"""WITH {SNAPSHOT_SQL} SELECT asin, product_byline, sales_volume_num FROM snapshot
      WHERE sales_volume_num >= 5000""",
)
def high_sellers(t):
    return R.high_sellers(t.snapshot.select("asin", "product_byline", "sales_volume_num"))


_UNITS_SQL = """units AS (SELECT p_brand, CAST(coalesce(sum(CASE WHEN l_returnflag <> 'R' THEN l_quantity END), 0) AS DOUBLE) AS units
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand)"""


def brand_units(t):
    sold = t.lineitem.select(
        F.col("l_partkey").alias("asin"),
        F.when(F.col("l_returnflag") != "R", F.col("l_quantity")).alias("units"),
    )
    per_product = sold.groupBy("asin").agg(F.sum("units").alias("units"))  # the join meets one row per product
    brands = t.part.select(F.col("p_partkey").alias("asin"), "p_brand")
    return R.brand_sales(merge_history(per_product, brands), "p_brand", "units")


@query("brand_sales", f"WITH {_UNITS_SQL} SELECT * FROM units")
def brand_sales(t):
    return brand_units(t)


@query(
    "brand_sales_null_group",
    f"""WITH {SNAPSHOT_SQL} SELECT product_byline, CAST(coalesce(sum(CASE WHEN product_byline NOT LIKE '%#1%'
      THEN sales_volume_num END), 0) AS BIGINT) AS sales_volume_num FROM snapshot GROUP BY product_byline""",
)
def brand_sales_null_group(t):
    """Brands without any known sales still get a row, with 0."""
    known = F.when(~F.col("product_byline").contains("#1"), F.col("sales_volume_num"))
    return R.brand_sales(t.snapshot.withColumn("sales_volume_num", known))


@query(
    "brand_sales_short",
    f"""WITH {SNAPSHOT_SQL} SELECT trim(replace(replace(product_byline, 'Visit the ', ''), ' Store', '')) AS brand_short,
      CAST(coalesce(sum(sales_volume_num), 0) AS BIGINT) AS sales_volume_num FROM snapshot GROUP BY 1""",
)
def brand_sales_short(t):
    named = t.snapshot.withColumn("brand_short", brand_short(F.col("product_byline"), title=True))
    return R.brand_sales(named, "brand_short")


@query(
    "brand_share",
    f"WITH {_UNITS_SQL} SELECT p_brand, units, round(units / (SELECT sum(units) FROM units) * 100, 8) AS share_pct FROM units",
)
def brand_share(t):
    return rounded(R.share_of_total(brand_units(t), "units"), 8, "share_pct")


@query(
    "brand_sales_top",
    f"""WITH {_UNITS_SQL} SELECT p_brand, units, round(units / (SELECT sum(units) FROM units) * 100, 8) AS share_pct
      FROM units ORDER BY units DESC, p_brand LIMIT 10""",
)
def brand_sales_top(t):
    shares = R.share_of_total(brand_units(t), "units")
    return rounded(R.top_k(shares, "units", 10, ["p_brand"]), 8, "share_pct")


@query("price_trend", f"WITH {HISTORY_SQL} SELECT date, round(avg(price), 6) AS price FROM history GROUP BY date")
def price_trend(t):
    return rounded(R.price_trend(t.history), 6, "price")


@query(
    "price_trend_month",
    f"WITH {HISTORY_SQL} SELECT CAST(date_trunc('month', date) AS TIMESTAMP) AS date, round(avg(price), 6) AS price FROM history GROUP BY 1",
)
def price_trend_month(t):
    return rounded(R.price_trend(t.history, grain="month"), 6, "price")


@query(
    "key_series",
    f"""WITH {HISTORY_SQL}, best AS (SELECT CAST(l_partkey AS VARCHAR) AS asin, sum(l_quantity) AS q FROM lineitem
      GROUP BY l_partkey ORDER BY q DESC, asin LIMIT 2)
      SELECT asin, date, price FROM history WHERE asin IN (SELECT asin FROM best)""",
)
def key_series(t):
    """Price history of the two best-selling products."""
    sold = t.lineitem.groupBy(F.col("l_partkey").cast("string").alias("asin")).agg(F.sum("l_quantity").alias("q"))
    best = R.top_k(sold, "q", 2, ["asin"])
    return R.key_series(t.history.select("asin", "date", "price"), best)


@query(
    "row_at_extreme",
    """(SELECT 'max' AS which, o_orderkey, o_totalprice, o_orderdate FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1)
      UNION ALL (SELECT 'min', o_orderkey, o_totalprice, o_orderdate FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 1)""",
)
def row_at_extreme(t):
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderdate")
    top = R.row_at_extreme(rows, "o_totalprice", tie=["o_orderkey"])
    low = R.row_at_extreme(rows, "o_totalprice", largest=False, tie=["o_orderkey"])
    named = lambda df, which: df.select(F.lit(which).alias("which"), "*")
    return named(top, "max").unionByName(named(low, "min"))


@query(
    "series_change",
    """SELECT arg_min(o_totalprice, row(o_orderdate, o_orderkey)) AS first_value,
        arg_max(o_totalprice, row(o_orderdate, o_orderkey)) AS last_value,
        (last_value - first_value) / first_value * 100 AS change_pct FROM orders""",
)
def series_change(t):
    return R.series_change(t.orders, "o_totalprice", ["o_orderdate", "o_orderkey"])


@query(
    "cluster_profile",
    f"""WITH {SNAPSHOT_SQL}, {_BANDS_SQL} SELECT segment, count(*) AS n_products, round(avg(price), 6) AS price,
      round(avg(product_star_rating), 6) AS product_star_rating, round(avg(discount_pct), 6) AS discount_pct,
      round(avg(rating_balance), 6) AS rating_balance, round(avg(product_num_ratings), 6) AS product_num_ratings,
      round(avg(sales_volume_num), 6) AS sales_volume_num FROM banded GROUP BY segment""",
)
def cluster_profile(t):
    means = ["price", "product_star_rating", "discount_pct", "rating_balance", "product_num_ratings", "sales_volume_num"]
    return rounded(R.cluster_profile(banded(t), "segment", means), 6, *means)


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "crosstab_bands",
    "SELECT o_orderstatus, "
    + ", ".join(f"count(*) FILTER (WHERE o_orderpriority = '{p}') AS \"{p}\"" for p in _PRIORITIES)
    + " FROM orders GROUP BY o_orderstatus",
)
def crosstab_bands(t):
    return R.crosstab(t.orders, "o_orderstatus", "o_orderpriority", _PRIORITIES[:2])


@query("crosstab_counts", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL")
def crosstab_counts(t):
    return R.crosstab_counts(t.orders, "o_orderstatus", "o_orderpriority")


_CORR = ["l_quantity", "l_extendedprice", "l_discount", "price"]


@query(
    "corr_matrix",
    "WITH l AS (SELECT *, CASE WHEN l_returnflag <> 'N' THEN l_extendedprice / l_quantity END AS price FROM lineitem) "
    + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 8) AS corr FROM l" for a in _CORR for b in _CORR),
)
def corr_matrix(t):
    price = F.when(F.col("l_returnflag") != "N", F.col("l_extendedprice") / F.col("l_quantity"))
    return rounded(R.corr_matrix(t.lineitem.withColumn("price", price), _CORR), 8, "corr")


@query(
    "column_stats",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS n, round(avg({c}), 6) AS mean, "
        f"round(stddev_pop({c}), 6) AS stddev_pop, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median FROM part"
        for c in ("p_size", "p_retailprice")
    ),
)
def column_stats(t):
    return rounded(R.column_stats(t.part, ["p_size", "p_retailprice"]), 6, "mean", "stddev_pop")


@query(
    "column_stats_nan",
    """SELECT 'price' AS "column", count(p) AS n, round(avg(p), 6) AS mean, round(stddev_pop(p), 6) AS stddev_pop,
      quantile_cont(p, 0.5) AS median FROM (SELECT CASE WHEN p_size % 3 <> 0 THEN p_retailprice END AS p FROM part)""",
)
def column_stats_nan(t):
    """NaN in the data counts as missing."""
    price = F.when(F.col("p_size") % 3 == 0, float("nan")).otherwise(F.col("p_retailprice"))
    return rounded(R.column_stats(t.part.select(price.alias("price")), ["price"]), 6, "mean", "stddev_pop")


@query(
    "box_stats",
    f"""WITH {SNAPSHOT_SQL}, b AS (SELECT product_byline, quantile_cont(price, 0.25) AS q1,
        quantile_cont(price, 0.5) AS median, quantile_cont(price, 0.75) AS q3 FROM snapshot GROUP BY product_byline)
      SELECT s.product_byline, count(*) AS n, round(avg(price), 6) AS mean, round(any_value(q1), 8) AS q1,
        round(any_value(median), 8) AS median, round(any_value(q3), 8) AS q3,
        min(price) FILTER (WHERE price BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1)) AS whisker_low,
        max(price) FILTER (WHERE price BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1)) AS whisker_high,
        count(*) FILTER (WHERE price NOT BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1)) AS outliers
      FROM snapshot s JOIN b ON s.product_byline = b.product_byline GROUP BY s.product_byline""",
)
def box_stats(t):
    boxes = R.box_stats(keep(t.snapshot.select("product_byline", "price")), "product_byline", "price")
    return rounded(rounded(boxes, 6, "mean"), 8, "q1", "median", "q3")


_STEEP = "l_quantity * l_quantity * l_quantity * l_quantity * l_quantity"


@query(
    "box_outliers",
    f"""WITH l AS (SELECT l_returnflag, {_STEEP} AS v FROM lineitem),
      b AS (SELECT l_returnflag AS f, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM l GROUP BY 1)
      SELECT l_returnflag, v FROM l JOIN b ON l_returnflag = f
      WHERE v NOT BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1)""",
)
def box_outliers(t):
    """Outliers by return flag of a value with a long upper tail."""
    return R.box_outliers(t.lineitem.selectExpr("l_returnflag", f"{_STEEP} AS v"), "l_returnflag", "v")


@query(
    "corr_table",
    " UNION ALL ".join(
        f"SELECT '{a}' AS \"column\", "
        + ", ".join(f"round(corr({a}, {b}), 3) AS {b}" for b in ("l_quantity", "l_extendedprice", "l_tax"))
        + " FROM lineitem"
        for a in ("l_quantity", "l_extendedprice", "l_tax")
    ),
)
def corr_table(t):
    return R.corr_table(t.lineitem, ["l_quantity", "l_extendedprice", "l_tax"])


@query(
    "histogram",
    """WITH s AS (SELECT min(l_extendedprice) AS lo, (max(l_extendedprice) - min(l_extendedprice)) / 20 AS step FROM lineitem),
      b AS (SELECT CAST(least(floor((l_extendedprice - lo) / step), 19) AS INTEGER) AS bin, count(*) AS n FROM lineitem, s GROUP BY 1),
      g AS (SELECT CAST(i AS INTEGER) AS bin FROM range(20) r(i))
      SELECT g.bin, lo + step * g.bin AS bin_start, lo + step * (g.bin + 1) AS bin_end, coalesce(n, 0) AS n
      FROM g CROSS JOIN s LEFT JOIN b ON g.bin = b.bin""",
)
def histogram(t):
    return R.histogram(t.lineitem, "l_extendedprice", 20)


@query(
    "kde_grid",
    """WITH s AS (SELECT min(p_retailprice) AS lo, (max(p_retailprice) - min(p_retailprice)) / 199 AS step,
        stddev_samp(p_retailprice) * pow(count(*), -0.2e0) AS h, count(*) AS n FROM part),
      g AS (SELECT CAST(i AS INTEGER) AS point, lo + step * i AS x, h, n FROM range(200) r(i), s)
      SELECT point, round(any_value(x), 9) AS x,
        round(sum(exp(-0.5e0 * ((p_retailprice - x) / h) * ((p_retailprice - x) / h))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 9) AS density
      FROM part, g GROUP BY point""",
)
def kde_grid(t):
    return rounded(R.kde_grid(t.part, "p_retailprice"), 9, "x", "density")


@query(
    "bar_means",
    f"""WITH {SNAPSHOT_SQL}, h AS (SELECT trim(replace(replace(product_byline, 'Visit the ', ''), ' Store', '')) AS brand,
        sales_volume_num AS v FROM snapshot WHERE sales_volume_num >= 5000)
      SELECT brand, count(*) AS n, round(avg(v), 6) AS mean,
        round(avg(v) - 1.96e0 * stddev_samp(v) / sqrt(count(*)), 6) AS low,
        round(avg(v) + 1.96e0 * stddev_samp(v) / sqrt(count(*)), 6) AS high FROM h GROUP BY brand""",
)
def bar_means(t):
    top = R.high_sellers(t.snapshot.withColumn("brand", brand_short(F.col("product_byline"))), ordered=False)
    return rounded(R.bar_means(top, "brand", "sales_volume_num"), 6, "mean", "low", "high")


@query(
    "scatter_points",
    f"""WITH {SNAPSHOT_SQL}, s AS (SELECT min(sales_volume_num) AS lo, max(sales_volume_num) AS hi FROM snapshot)
      SELECT asin, price AS x, product_star_rating AS y,
        40 + CAST(sales_volume_num - lo AS DOUBLE) / CAST(hi - lo AS DOUBLE) * 860 AS size, is_prime AS hue,
        product_star_rating >= 4.4e0 AS above_mark FROM snapshot, s""",
)
def scatter_points(t):
    columns = ("asin", "price", "product_star_rating", "sales_volume_num", "is_prime")
    return R.scatter_points(keep(t.snapshot.select(*columns)), hue="is_prime")


# --- findings --------------------------------------------------------------------------------


@query(
    "finding_segment",
    f"""WITH {SNAPSHOT_SQL}, {_BANDS_SQL},
      s AS (SELECT segment, count(price) AS n, avg(price) AS m FROM banded GROUP BY segment ORDER BY n DESC, segment LIMIT 1)
      SELECT segment, n, (SELECT count(*) FROM snapshot) AS total, round(m, 2) AS mean_price,
        printf('segment ''%s'' holds most products (%d of %d), at a mean price of $%.2f', segment, n,
          (SELECT count(*) FROM snapshot), round(m, 2)) AS finding FROM s""",
)
def finding_segment(t):
    rows = keep(t.latest.select("price").withColumn("segment", price_band(F.col("price"), BOUNDS)))
    return N.finding_segment(R.segment_summary(rows, "segment", "price", digits=2), "segment", rows)


@query(
    "finding_brand",
    f"""WITH {_UNITS_SQL}, w AS (SELECT sum(units) AS total FROM units),
      s AS (SELECT p_brand, units, units / total * 100 AS share FROM units, w ORDER BY units DESC, p_brand LIMIT 1)
      SELECT p_brand AS brand, CAST(units AS BIGINT) AS units, round(share, 8) AS share_pct,
        printf('''%s'' leads with %s estimated units sold, %.2f%% of the total', p_brand,
          format('{{:,}}', CAST(units AS BIGINT)), share) AS finding FROM s""",
)
def finding_brand(t):
    return rounded(N.finding_brand(brand_units(t), "p_brand", "units"), 8, "share_pct")


@query(
    "finding_trend",
    f"""WITH {HISTORY_SQL}, d AS (SELECT CAST(date_trunc('month', date) AS TIMESTAMP) AS date, avg(price) AS price FROM history GROUP BY 1),
      e AS (SELECT arg_min(price, date) AS p0, min(date) AS d0, arg_max(price, date) AS p1, max(date) AS d1,
        max(price) AS hi, arg_max(date, price) AS hd, min(price) AS lo, arg_min(date, price) AS ld FROM d)
      SELECT round(p0, 6) AS first_price, strftime(d0, '%d/%m/%Y') AS first_day, round(p1, 6) AS last_price,
        strftime(d1, '%d/%m/%Y') AS last_day, round((p1 - p0) / p0 * 100, 6) AS change_pct,
        round(hi, 6) AS max_price, strftime(hd, '%d/%m/%Y') AS max_day, round(lo, 6) AS min_price,
        strftime(ld, '%d/%m/%Y') AS min_day,
        printf('mean price went from $%.2f (%s) to $%.2f (%s), a change of %+.2f%%; highest $%.2f on %s, lowest $%.2f on %s',
          p0, strftime(d0, '%d/%m/%Y'), p1, strftime(d1, '%d/%m/%Y'), (p1 - p0) / p0 * 100, hi,
          strftime(hd, '%d/%m/%Y'), lo, strftime(ld, '%d/%m/%Y')) AS finding FROM e""",
)
def finding_trend(t):
    found = N.finding_trend(R.price_trend(t.history, grain="month"))
    return rounded(found, 6, "first_price", "last_price", "change_pct", "max_price", "min_price")


@query(
    "finding_corr",
    f"""WITH {SNAPSHOT_SQL}, c AS (SELECT round(corr(price, product_star_rating), 3) AS corr FROM snapshot)
      SELECT corr, CASE WHEN abs(corr) < 0.2 THEN 'practically none' WHEN abs(corr) < 0.5 THEN 'weak'
        ELSE 'considerable' END AS strength, abs(corr) >= 0.5 AS linked FROM c""",
)
def finding_corr(t):
    return N.finding_corr(t.snapshot, "price", "product_star_rating")
