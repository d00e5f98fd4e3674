import golden
import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlens.functions.prices import price_band
from marketlens.functions.text import brand_short
from marketlens.operators import columns as C
from marketlens.operators import findings as N
from marketlens.operators import reports as R
from marketlens.operators.quantiles import exact_quantiles, fill_median, medians


@pytest.fixture(scope="module")
def snapshot(spark):
    return spark.createDataFrame(list(golden.rows()), golden.COLUMNS)


# --- published tables ------------------------------------------------------------------------


def test_published_bands(snapshot):
    banded = snapshot.withColumn("segment", price_band(F.col("price")))
    got = {r.segment: (r.n, r.mean_price, r.min_price, r.max_price) for r in R.segment_summary(banded, "segment", "price", 2).collect()}
    assert got == golden.BANDS


def test_published_brand_sales(snapshot):
    totals = R.brand_sales(snapshot.withColumn("brand", brand_short(F.col("product_byline"))), "brand")
    top = R.top_k(R.share_of_total(totals, "sales_volume_num"), "sales_volume_num", 10, ["brand"]).collect()
    assert {r.brand: (r.sales_volume_num, round(r.share_pct, 2)) for r in top} == golden.BRANDS
    assert [r.brand for r in top][:3] == ["JBL", "Beats", "Soundcore"]
    assert sum(r.share_pct for r in top) == pytest.approx(100)


def test_published_correlations(snapshot):
    names = ["price", "product_star_rating", "sales_volume_num"]
    got = {(r.a, r.b): r["corr"] for r in R.corr_matrix(snapshot, names).collect()}
    assert len(got) == 9
    for pair, value in golden.CORRELATIONS.items():
        assert round(got[pair], 3) == value and got[pair] == got[pair[::-1]]
    table = {r.column: r for r in R.corr_table(snapshot, names).collect()}
    assert table["price"]["sales_volume_num"] == 0.141 and table["price"]["price"] == 1.0


def test_published_cluster_profile(snapshot):
    df = snapshot.withColumn(
        "discount_pct", (F.col("product_original_price") - F.col("product_price")) / F.col("product_original_price") * 100
    )
    names = ["product_price", "product_star_rating", "discount_pct", "rating_balance", "product_num_ratings", "sales_volume_num"]
    got = R.cluster_profile(df, "segment_kmeans", names).collect()
    shown = lambda v: None if v is None else round(v, 2)
    assert {r.segment_kmeans: (r.n_products, *[shown(r[n]) for n in names]) for r in got} == golden.PROFILE


def test_findings(snapshot):
    banded = snapshot.withColumn("segment", price_band(F.col("price")))
    seg = N.finding_segment(R.segment_summary(banded, "segment", "price", 2), "segment", snapshot).first()
    assert (seg.segment, seg.n, seg.total, seg.mean_price) == ("economy", 8, 20, 35.57)
    assert seg.finding == "segment 'economy' holds most products (8 of 20), at a mean price of $35.57"
    brand = N.finding_brand(R.brand_sales(snapshot), "product_byline", "sales_volume_num").first()
    assert brand.finding == "'Visit the JBL Store' leads with 45,000 estimated units sold, 28.85% of the total"
    corr = N.finding_corr(snapshot, "price", "product_star_rating").first()
    assert tuple(corr) == (0.03, "practically none", False)


@pytest.mark.parametrize("r,word,linked", [(0.199, "practically none", False), (-0.3, "weak", False), (0.5, "considerable", True), (-0.9, "considerable", True)])
def test_strength_words(spark, r, word, linked):
    x, y = np.array([1.0, -1, 0, 0]), np.array([0.0, 0, 1, -1])
    data = [(float(a), float(b)) for a, b in zip(x, r * x + np.sqrt(1 - r * r) * y)]
    got = N.finding_corr(spark.createDataFrame(data, "a double, b double"), "a", "b").first()
    assert (got.strength, got.linked) == (word, linked)


def test_trend_finding(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'2024-01-01' + make_dt_interval(id) AS date, price FROM VALUES "
        "(0, 10d), (0, 20d), (1, 30d), (2, 9d), (3, 12d), (4, CAST(NULL AS DOUBLE)) AS v(id, price)"
    )
    trend = R.price_trend(df)
    assert [r.price for r in trend.collect()] == [15.0, 30.0, 9.0, 12.0]
    got = N.finding_trend(trend).first()
    assert (got.first_price, got.last_price, got.change_pct) == (15.0, 12.0, -20.0)
    assert (got.max_day, got.min_day) == ("02/01/2024", "03/01/2024")
    assert "-20.00%" in got.finding
    assert R.price_trend(df, grain="month").count() == 1


# --- aggregates ------------------------------------------------------------------------------


def test_brand_with_null_sales_only_is_zero(spark):
    df = spark.createDataFrame([("a", None), ("b", 2), (None, 5)], "product_byline string, sales_volume_num bigint")
    assert sorted(map(tuple, R.brand_sales(df).collect())) == [("a", 0), ("b", 2)]


def test_crosstab_fills_absent_pairs(spark):
    df = spark.createDataFrame([("x", "a"), ("x", "a"), ("y", "b"), (None, "a"), ("y", None)], "r string, c string")
    assert sorted(map(tuple, R.crosstab(df, "r", "c", ["a", "b"]).collect())) == [("x", 2, 0), ("y", 0, 1)]


def test_corr_skips_incomplete_pairs_and_constants(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, None, 5.0), (3.0, 6.0, 5.0), (4.0, 7.0, 5.0)], "a double, b double, c double")
    got = {(r.a, r.b): r["corr"] for r in R.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert got[("a", "b")] == pytest.approx(np.corrcoef([1, 3, 4], [2, 6, 7])[0, 1])
    assert got[("a", "c")] is None and got[("c", "c")] is None


def test_row_picks(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 9.0), (3, 9.0), (4, 5.0), (5, None)], "asin int, v double")
    assert R.row_at_extreme(df, "v", tie=["asin"]).first().asin == 2
    assert R.row_at_extreme(df, "v", largest=False, tie=["asin"]).first().asin == 1
    assert [r.asin for r in R.high_sellers(df, "v", 6).collect()] == [2, 3]
    assert tuple(R.series_change(df.na.drop(), "v", ["asin"]).first()) == (5.0, 5.0, 0.0)
    assert [r.asin for r in R.key_series(df, [4, 1], ts="v").collect()] == [1, 4]


# --- chart data ------------------------------------------------------------------------------


def test_histogram_agrees_with_numpy(spark):
    values = np.random.default_rng(3).exponential(50, 500).round(2)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    got = R.histogram(df, "v", 20).orderBy("bin").collect()
    counts, edges = np.histogram(values, 20)
    assert [r.n for r in got] == counts.tolist()
    assert [r.bin_start for r in got] == pytest.approx(edges[:-1].tolist())
    flat = R.histogram(spark.createDataFrame([(2.0,)] * 3, "v double"), "v", 4).orderBy("bin").collect()
    assert (flat[0].bin_start, flat[-1].bin_end, sum(r.n for r in flat)) == (1.5, 2.5, 3)


def test_kde_agrees_with_numpy(spark):
    values = np.random.default_rng(4).normal(80, 20, 300).round(1)
    got = R.kde_grid(spark.createDataFrame([(float(v),) for v in values], "v double"), "v", 50).orderBy("point").collect()
    h = values.std(ddof=1) * len(values) ** -0.2
    grid = np.linspace(values.min(), values.max(), 50)
    want = np.exp(-0.5 * ((grid[:, None] - values) / h) ** 2).sum(1) / (len(values) * h * np.sqrt(2 * np.pi))
    assert [r.density for r in got] == pytest.approx(want.tolist())


def test_box_stats_and_outliers(spark):
    data = {"a": [1, 2, 3, 4, 5, 100], "b": [7], "c": [1.0, 1.0, 2.0]}
    df = spark.createDataFrame([(k, float(v)) for k, vs in data.items() for v in vs] + [("a", None), (None, 1.0)], "k string, v double")
    got = {r.k: r for r in R.box_stats(df, "k", "v").collect()}
    assert set(got) == set(data)
    for k, vs in data.items():
        assert [got[k].q1, got[k]["median"], got[k].q3] == pytest.approx(np.quantile(vs, [0.25, 0.5, 0.75]).tolist())
        assert (got[k].n, got[k]["mean"]) == (len(vs), pytest.approx(np.mean(vs)))
    assert (got["a"].whisker_high, got["a"].outliers) == (5.0, 1)
    assert [tuple(r) for r in R.box_outliers(df, "k", "v").collect()] == [("a", 100.0)]


def test_bar_means_and_scatter(spark):
    df = spark.createDataFrame(
        [("x", 1.0, 4.5, 10), ("x", 3.0, 4.0, 20), ("y", 5.0, 4.4, None)],
        "k string, price double, product_star_rating double, sales_volume_num int",
    )
    bars = {r.k: r for r in R.bar_means(df, "k", "price").collect()}
    half = 1.96 * np.std([1, 3], ddof=1) / np.sqrt(2)
    assert (bars["x"]["mean"], bars["x"].high) == (2.0, pytest.approx(2 + half))
    assert bars["y"].low is None
    points = R.scatter_points(df, hue="k").orderBy("x").collect()
    assert [p["size"] for p in points] == [40.0, 900.0, None]
    assert [p.above_mark for p in points] == [True, False, True]


# --- quantiles -------------------------------------------------------------------------------


@pytest.mark.parametrize("shape", ["uniform", "hot value", "long tail", "sorted copies"])
def test_exact_quantiles_beyond_the_sketch(spark, shape):
    rng = np.random.default_rng(7)
    n = 4000
    values = {
        "uniform": rng.random(n),
        "hot value": np.where(rng.random(n) < 0.4, 3.0, rng.random(n) * 10),
        "long tail": rng.pareto(0.5, n),
        "sorted copies": np.repeat(np.arange(n // 8), 8).astype(float),
    }[shape]
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    df = spark.createDataFrame([(float(v), "g1" if i % 3 else "g2") for i, v in enumerate(values)], "v double, g string")
    # accuracy 50 makes groups of more than 500 rows use brackets
    got = exact_quantiles(df, "v", probs, accuracy=50).first()
    assert got.n == n and got.quantiles == pytest.approx(np.quantile(values, probs).tolist())
    by = {r.g: r.quantiles for r in exact_quantiles(df, "v", probs, ["g"], accuracy=50).collect()}
    for g in by:
        mine = [v for i, v in enumerate(values) if ("g1" if i % 3 else "g2") == g]
        assert by[g] == pytest.approx(np.quantile(mine, probs).tolist())


def test_medians_and_fill(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (4.0, None), (float("nan"), None)], "a double, b double")
    assert medians(df, ["a", "b"]) == {"a": 2.5, "b": None}
    filled = fill_median(df, ["a", "b"]).collect()
    assert [r.a for r in filled][:3] == [1.0, 2.5, 4.0] and filled[1].b is None


def test_column_stats(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None), (3, 4.0)], "a int, b double")
    got = {r.column: (r.n, r["mean"], r.stddev_pop, r.median) for r in R.column_stats(df, ["a", "b"]).collect()}
    assert got["a"] == (3, 2.0, pytest.approx(np.std([1, 2, 3])), 2.0)
    assert got["b"] == (2, 3.0, 1.0, 3.0)


def test_price_features_need_all_flags(spark):
    with pytest.raises(ValueError):
        C.price_features(spark.createDataFrame([(1.0,)], "product_price double"))


def test_reports_take_nan_as_missing_and_stand_constant_columns(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 2.0), (nan, 5.0), (3.0, 4.0), (None, nan)], "a double, b double")
    stats = {r.column: (r.n, r["mean"], r.median) for r in R.column_stats(df, ["a", "b"]).collect()}
    assert stats == {"a": (2, 2.0, 2.0), "b": (3, pytest.approx(11 / 3), 4.0)}
    corr = {(r.a, r.b): r["corr"] for r in R.corr_matrix(df, ["a", "b"]).collect()}
    assert corr["a", "b"] == pytest.approx(1.0)
    assert sum(r.n for r in R.histogram(df, "a", 4).collect()) == 2
    assert all(r.density > 0 for r in R.kde_grid(df, "a", 5).collect())
    flat = spark.createDataFrame([(7.0,), (7.0,), (nan,)], "a double")
    got = R.kde_grid(flat, "a", 3).collect()
    assert [(r.x, r.density) for r in got] == [(7.0, None)] * 3
    assert R.kde_grid(df, "a", 1).count() == 1
    assert R.kde_grid(flat.limit(0), "a").count() == 0
    assert [r["corr"] for r in R.corr_matrix(flat, ["a"]).collect()] == [None]
    assert R.histogram(flat, "a", 2).agg({"n": "sum"}).first()[0] == 2


def test_crosstab_counts_every_value(spark):
    df = spark.createDataFrame([("x", "a"), ("x", "c"), ("y", "c"), ("y", None), (None, "a")], "r string, c string")
    got = {r.r: r.asDict() for r in R.crosstab(df, "r", "c", ["b"]).collect()}
    assert got == {"x": {"r": "x", "b": 0, "a": 1, "c": 1}, "y": {"r": "y", "b": 0, "a": 0, "c": 1}}
    with pytest.raises(ValueError, match="more than 1 values"):
        R.crosstab(df, "r", "c", limit=1)


@pytest.mark.parametrize("most_inside", [3, 1000])
def test_medians_and_quantiles_with_narrow_brackets_and_a_hot_group(spark, most_inside):
    import numpy as np

    from marketlens.operators.quantiles import exact_quantiles, medians

    rng = np.random.default_rng(most_inside)
    rows = [("hot" if i % 10 else f"g{i % 3}", float(rng.integers(0, 400)) if i % 3 else float(rng.normal()), i) for i in range(900)]
    df = spark.createDataFrame([(g, x, None if i % 7 == 0 else x * 2) for g, x, i in rows], "g string, x double, y double").cache()
    pdf = df.toPandas()
    assert medians(df, ["x", "y"], accuracy=200, most_inside=most_inside) == {c: pytest.approx(pdf[c].median()) for c in ("x", "y")}
    got = {r.g: r.quantiles for r in exact_quantiles(df, "x", [0.0, 0.25, 0.5, 1.0], ["g"], 200, most_inside).collect()}
    for g, part in pdf.groupby("g"):
        assert got[g] == pytest.approx(part.x.quantile([0.0, 0.25, 0.5, 1.0]).tolist())
