"""Quality, column, latest and merge operators against hand-made rows and pandas."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketlens.operators import columns as C
from marketlens.operators import quality as Q
from marketlens.operators.latest import latest_columns, latest_per_key, latest_row
from marketlens.operators.merge import join_small, merge_history
from marketlens.plans.enrichment import build_enriched, clean_details, latest_snapshot
from marketlens.sources.files import select_existing


def test_keyed_dedup_keeps_first_and_groups_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "b")], "i int, k string")
    assert sorted(r.i for r in Q.drop_duplicates(df, ["k"], ["i"]).collect()) == [1, 3, 5]


def test_keyed_dedup_with_a_hot_key(spark):
    df = spark.range(0, 9000, 1, 6).select(
        F.col("id").alias("i"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k")
    )
    kept = Q.drop_duplicates(df, ["k"], ["i"])
    assert kept.count() == 6001
    assert kept.where("k = 'hot'").first().i == 0


def test_full_row_dedup_and_count(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, nan), (1, nan), (1, None), (1, None), (2, 0.5)], "i int, x double")
    assert Q.distinct_rows(df).count() == 3
    assert tuple(Q.count_duplicates(df).first()) == (5, 3, 2)
    assert tuple(Q.count_duplicates(df.limit(0)).first()) == (0, 0, 0)


def test_profiles(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "i int, s string")
    assert {r.column: r.nulls for r in Q.null_profile(df).collect()} == {"i": 1, "s": 2}
    got = {r.column: (r.type, r.non_null, r.n_rows) for r in Q.schema_profile(df).collect()}
    assert got == {"i": ("int", 2, 3), "s": ("string", 1, 3)}


def test_column_steps(spark):
    df = spark.createDataFrame([(1,)], "a int")
    grown = C.ensure_columns(df, {"b": ("string", "unknown"), "a": ("int", 9)})
    assert tuple(grown.first()) == (1, "unknown")
    assert select_existing(grown, ["b", "zz", "a"]).columns == ["b", "a"]
    assert C.normalize_columns(df.toDF("  ASIN ")).columns == ["asin"]
    with pytest.raises(ValueError):
        C.normalize_columns(grown.toDF("x", " X"))
    with pytest.raises(ValueError):
        C.require_columns(df, ["asin"])
    assert C.pick_column(df, ["product_price", "a"]) == "a"


def test_catalog(spark):
    df = spark.createDataFrame([("$1,000.00", "x"), ("none", "y")], "product_price string, asin string")
    got = C.clean_catalog(df).collect()
    assert [(r.asin, r.product_price, r.discount) for r in got] == [("x", 1000.0, 0.0)]


def test_latest_columns_mixes_rows(spark):
    df = spark.createDataFrame(
        [("a", "2024-01-01", 1, 10), ("a", "2024-01-02", None, 20), ("a", None, 3, None), ("b", "2024-01-01", None, 5), (None, "2024-01-09", 9, 9)],
        "k string, d string, x int, y int",
    ).withColumn("d", F.col("d").cast("timestamp_ntz"))
    got = {r.k: (str(r.d)[:10], r.x, r.y) for r in latest_columns(df, "k", "d").collect()}
    assert got == {"a": ("2024-01-02", 3, 20), "b": ("2024-01-01", None, 5)}


def random_history(seed, n=400):
    rng = random.Random(seed)
    maybe = lambda v, p: None if rng.random() < p else v
    return [
        (maybe(f"k{min(rng.randrange(30), 9)}", 0.05), maybe(rng.randrange(10_000), 0.1), i, maybe(rng.random(), 0.3), maybe(rng.randrange(9), 0.3))
        for i, _ in enumerate(range(n))
    ]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_latest_columns_agrees_with_pandas(spark, seed):
    rows = random_history(seed)
    got = latest_columns(
        spark.createDataFrame(rows, "k string, t bigint, tie int, x double, y int"), "k", "t", ["tie"]
    ).toPandas().set_index("k").sort_index()
    pdf = pd.DataFrame(rows, columns=["k", "t", "tie", "x", "y"]).sort_values(["t", "tie"])
    want = pdf.groupby("k").last().sort_index()
    pd.testing.assert_frame_equal(got[["x", "y"]].astype(float), want[["x", "y"]].astype(float), check_dtype=False)


def test_latest_row_takes_first_of_equal_dates(spark):
    df = spark.createDataFrame([("a", 2, 5), ("a", 2, 4), ("a", 1, 1), ("a", None, 9), (None, 7, 7)], "k string, t int, i int")
    assert [(r.k, r.i) for r in latest_row(df, "k", "t", ["i"]).collect()] == [("a", 4)]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "bigint", "double", "decimal(12,2)", "string"])
def test_latest_row_by_every_kind_of_order(spark, kind):
    df = spark.range(60).select(
        (F.col("id") % 3).alias("k"), (F.col("id") * 7 % 20).alias("n"), "id", F.when(F.col("id") % 5 == 0, "x").alias("note")
    )
    if kind in ("timestamp", "timestamp_ntz", "date"):
        moment = F.lit("1969-12-25").cast("date") + F.col("n").cast("int")
        df = df.withColumn("t", moment.cast(kind))
    else:
        df = df.withColumn("t", F.lpad(F.col("n").cast("string"), 2, "0").cast(kind))
    got = {r.k: (r.n, r.id, r.note) for r in latest_row(df, "k", "t", ["id"]).collect()}
    want = {}
    for r in df.orderBy(F.col("n").desc(), "id").collect():
        want.setdefault(r.k, (r.n, r.id, r.note))
    assert got == want
    assert latest_row(df, "k", "t", ["id"]).columns == df.columns


def test_both_modes_agree_without_nulls(spark):
    rows = [(k, t, i, x, y) for k, t, i, x, y in random_history(5) if None not in (k, t, x, y)]
    rows = [(k, t * 1000 + i, i, x, y) for k, t, i, x, y in rows]
    df = spark.createDataFrame(rows, "k string, t bigint, tie int, x double, y int")
    a = sorted(map(tuple, latest_per_key(df, "k", "t", mode="columns").collect()))
    b = sorted(map(tuple, latest_per_key(df, "k", "t", mode="row").collect()))
    assert a == b
    with pytest.raises(ValueError):
        latest_per_key(df, "k", "t", mode="other")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_and_dedup_cut_rows_before_the_shuffle(spark):
    df = spark.createDataFrame(random_history(1), "k string, t bigint, tie int, x double, y int")
    for frame in (latest_row(df, "k", "t", ["tie"]), Q.drop_duplicates(df, ["k"], ["tie"])):
        assert "partial_min_by" in plan_of(frame)
    by_text = latest_row(df.withColumn("t", F.col("t").cast("string")), "k", "t", ["tie"])
    assert "Window" not in plan_of(by_text) and "partial_max" in plan_of(by_text)
    assert "partial_max_by" in plan_of(latest_columns(df, "k", "t", ["tie"]))


@pytest.mark.parametrize("salts", [1, 4])
@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_merge_history(spark, salts, broadcast):
    history = spark.createDataFrame(
        [("a", 1, "h1"), ("a", 1, "h1"), (None, 2, "h2"), ("z", 3, "h3")], "asin string, d int, note string"
    )
    details = spark.createDataFrame([("a", "A", "n1"), (None, "N", "n2")], "asin string, title string, note string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = merge_history(history, details, salts=salts).orderBy("d").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [(r.asin, r.d, r.note_x, r.title, r.note_y, r.asin_group) for r in got] == [
        ("a", 1, "h1", "A", "n1", "a"), ("a", 1, "h1", "A", "n1", "a"), (None, 2, "h2", "N", "n2", None), ("z", 3, "h3", None, None, "z"),
    ]


@pytest.mark.parametrize("max_rows", [0, 100])
def test_join_small_gives_the_same_either_way(spark, max_rows):
    left = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, i int")
    side = spark.createDataFrame([("a", 10), (None, 20)], "k string, v int")
    got = join_small(left, side, ["k"], max_rows=max_rows)
    assert got.columns == ["k", "i", "v"]
    assert sorted((r.i, r.v) for r in got.collect()) == [(1, 10), (2, 20)]
    assert ("BroadcastHashJoin" in plan_of(got)) or max_rows == 0


def products(spark):
    rows = [
        (f"p{i}", f"title {i}", None if i == 2 else 10.0 + i, 20.0 + i, "Visit the X Store", 4.0, 100, f"{i}K+", "{'5': 3, '1': 1}",
         "{'name': 'C'}", True, None, False, True, "Deal")
        for i in range(4)
    ]
    return spark.createDataFrame(
        rows,
        "asin string, product_title string, product_price double, product_original_price double, product_byline string, "
        "product_star_rating double, product_num_ratings int, sales_volume string, rating_distribution string, "
        "category string, is_prime boolean, is_amazon_choice boolean, has_aplus boolean, has_brandstory boolean, deal_badge string",
    )


def test_latest_before_join_equals_latest_after(spark):
    history = spark.createDataFrame(
        [(f"p{i % 5}", f"2024-01-{1 + i % 9:02d} 00:{i:02d}:00", float(i)) for i in range(40)], "asin string, d string, price double"
    ).select("asin", F.col("d").cast("timestamp_ntz").alias("date"), "price")
    history = history.unionAll(history.limit(10))
    details = clean_details(products(spark).withColumn("o", F.lit(1)), ["o"]).drop("o")
    late = latest_columns(build_enriched(history, details), "asin", "date").orderBy("asin")
    early = latest_snapshot(history, details).orderBy("asin")
    assert early.count() == 5
    assert [r.asDict() for r in early.select(late.columns).collect()] == [r.asDict() for r in late.collect()]
    rows = latest_snapshot(history, details, mode="row").orderBy("asin")
    assert [r.price for r in rows.collect()] == [r.price for r in early.collect()]


def test_enriched_drops_exact_copies_only(spark):
    history = spark.createDataFrame([("p1", 1.0), ("p1", 1.0), ("p1", 2.0)], "asin string, price double")
    assert build_enriched(history, products(spark)).count() == 2


def test_enrich_columns(spark):
    got = C.enrich(products(spark)).where("asin = 'p1'").first()
    assert (got.discount, got.sales_volume_num, got.premium_badge_count) == (10.0, 1000, 2)
    assert (got.rating_balance, got.category_name, got.deal_badge) == (0.5, "C", True)
    assert got.sales_per_price == pytest.approx(1000 / 12)


def test_latest_plans_do_not_sort_before_the_first_shuffle(spark):
    df = spark.range(0, 1000).selectExpr("id % 50 as k", "id as t", "id % 7 as tie", "cast(id as double) as x", "cast(id as string) as s")
    for frame in (latest_row(df, "k", "t", ["tie"]), latest_columns(df, "k", "t", ["tie"]), Q.drop_duplicates(df, ["s"], ["t"])):
        first_steps = plan_of(frame).split("functions=[partial_max(")[1].split("\n")
        assert not any("Sort" in line for line in first_steps)


def test_latest_at_the_ends_of_the_number_range(spark):
    low = -(2**63)
    df = spark.createDataFrame([("a", low, 1), ("a", low + 1, 2), ("b", low, 3)], "k string, t bigint, x int")
    assert {r.k: r.x for r in latest_row(df, "k", "t").collect()} == {"a": 2, "b": 3}
    nan = float("nan")
    df = spark.createDataFrame([("a", 1.0, 1.0), ("a", nan, 2.0), ("a", 2.0, nan), ("c", nan, 5.0)], "k string, t double, x double")
    assert {r.k: r.t for r in latest_row(df, "k", "t").collect()} == {"a": 2.0}
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, nan), ("b", 1, nan)], "k string, t bigint, x double")
    assert {r.k: (r.t, r.x) for r in latest_columns(df, "k", "t").collect()} == {"a": (2, 1.0), "b": (1, None)}


def test_first_row_with_null_order_and_ties(spark):
    df = spark.createDataFrame([(None, "x", 2), (1, "x", 1), (None, "x", 1), (5, None, 9), (4, None, 8)], "i int, k string, j int")
    got = {r.k: (r.i, r.j) for r in Q.drop_duplicates(df, ["k"], ["i", "j"]).collect()}
    assert got == {"x": (None, 1), None: (4, 8)}
