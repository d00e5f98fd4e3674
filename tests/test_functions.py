import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketlens.functions import prices as P
from marketlens.functions import text as T
from marketlens.operators.columns import discover_keys, expand_distribution


def test_volume(column):
    texts = ["7K+ bought in past month", "1.2K", "3M", "500", "1,200", "5 K", "New", None, "2.3k", ""]
    assert column(T.parse_volume, texts) == [7000, 1200, 3_000_000, 500, 1, 5, 0, 0, int(2.3 * 1000), 0]
    assert column(lambda c: T.parse_volume(c, null_as=None), [None, "New"]) == [None, 0]


def test_money(column):
    assert column(T.clean_money, ["$1,299.00", "None", "1.5d", None, "$ 12"]) == [1299.0, None, None, None, 12.0]


def test_number_agrees_with_pandas(column):
    texts = ["1", " 2.5 ", "-3e2", ".5", "5.", "1.5d", "abc", "", "+7", "1_000", "inf", "-Infinity", "1f", "--1"]
    expected = [None if math.isnan(v) else v for v in pd.to_numeric(pd.Series(texts), errors="coerce")]
    assert column(T.to_number, texts) == expected


def test_timestamp(column):
    got = column(T.to_ts, ["2026-02-07 14:44:00", "2026-03-15", "soon", None])
    assert [str(v) if v else None for v in got] == ["2026-02-07 14:44:00", "2026-03-15 00:00:00", None, None]


def test_distribution(spark):
    texts = ["{'1': 4, '2': 2, '3': 5, '4': 12, '5': 77}", "{'5': 0}", "[1]", "nan", "bad {", None, "{5: 3, 1: 1}", "{'1': None, '5': 2}"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(texts)], "i int, rating_distribution string")
    got = [tuple(r)[2:] for r in expand_distribution(df).orderBy("i").collect()]
    assert got[0] == pytest.approx((0.04, 0.02, 0.05, 0.12, 0.77))
    assert got[6] == pytest.approx((0.25, 0, 0, 0, 0.75))
    for i in (1, 2, 3, 4, 5, 7):
        assert got[i] == (0, 0, 0, 0, 0)
    assert discover_keys(df) == ["1", "2", "3", "4", "5"]
    with pytest.raises(ValueError, match="more than 2 keys"):
        discover_keys(df, limit=2)


def test_map_of_shares_has_the_same_columns_for_any_number_of_keys(spark):
    many = "{" + ", ".join(f"'{k}': 1" for k in range(1, 2001)) + "}"
    few = spark.createDataFrame([("{'1': 1, '9': 3}",), (None,)], "rating_distribution string")
    df = spark.createDataFrame([(many,)], "rating_distribution string")
    a, b = expand_distribution(few, as_map=True), expand_distribution(df, as_map=True)
    assert a.columns == b.columns
    row = b.first()
    assert len(row.pct_stars) == 2000 and row.pct_1stars == 1 / 2000 == row.pct_stars["2000"]
    with pytest.raises(ValueError, match="more than 1000 keys"):
        expand_distribution(df)


def test_star_keys_come_from_the_data(spark):
    df = spark.createDataFrame([("{'0': 1, '5': 3}",), ("{'half': 2}",), (None,)], "rating_distribution string")
    got = expand_distribution(df)
    assert got.columns[1:] == [f"pct_{k}stars" for k in ("0", "1", "2", "3", "4", "5", "half")]
    assert [(r.pct_0stars, r.pct_5stars, r.pct_halfstars) for r in got.collect()] == [(0.25, 0.75, 0), (0, 0, 1), (0, 0, 0)]
    many = expand_distribution(df, as_map=True).collect()
    assert many[0].pct_stars == {"0": 0.25, "5": 0.75} and many[0].pct_5stars == 0.75


def test_words_inside_quoted_values_stay(column):
    name = lambda c: T.dict_text_field(c, "name")
    texts = [
        "{'name': 'Shoes, None, Hats', 'id': None}",
        """{'name': "Men's, True, Fit", 'x': [True, None, {1: False}]}""",
        "{'name': 'Ratio, 3: 4', 5: 'x'}",
        r"{'name': 'it\'s, None, x'}",
        '{"name": "a, False, b"}',
    ]
    assert column(name, texts) == ["Shoes, None, Hats", "Men's, True, Fit", "Ratio, 3: 4", "it's, None, x", "a, False, b"]


def test_dict_field(column):
    name = lambda c: T.dict_text_field(c, "name")
    texts = [
        "{'id': 'electronics', 'name': 'Electronics'}",
        "{'id': None, 'name': 'X'}",
        "[]",
        "{'flag': True, 'name': \"Men's, None, really\"}",
        "{'name': None}",
        "plain",
        None,
        r"{'name': 'Men\'s'}",
    ]
    got = column(name, texts)
    assert got[:3] == ["Electronics", "X", None]
    assert got[4:] == [None, None, None, "Men's"]
    assert got[3].startswith("Men's")


def test_flags(column, spark):
    assert column(lambda c: T.flag(c, "boolean"), [None, True, False], "boolean") == [False, True, False]
    assert column(lambda c: T.flag(c, "string"), [None, "False", ""]) == [False, True, False]
    assert column(lambda c: T.flag(c, "double"), [None, 0.0, 2.0, float("nan")], "double") == [False, False, True, False]


def test_has_text(column):
    assert column(T.has_text, [None, "", "  ", "\t\n", "Deal"]) == [False, False, False, False, True]


def test_brand(column):
    names = ["Visit the Sony Store", "Visit the JBL Store", None, "Brand: b&o's 3m", "VISIT THE X STORE"]
    assert column(T.brand_short, names) == ["Sony", "JBL", None, "Brand: b&o's 3m", "VISIT THE X STORE"]
    titled = column(lambda c: T.brand_short(c, title=True), names)
    assert titled == ["Sony", "Jbl", None, "brand: b&o's 3m".title(), "X"]


def test_redact_and_status(column):
    text = "400 Client Error for url: https://x.example/p?key=abc123&domain=1&token=zz"
    assert column(T.redact, [text]) == ["400 Client Error for url: https://x.example/p?key=***&domain=1&token=***"]
    assert column(T.http_status, [text, "timeout", None]) == [400, None, None]


def test_band(column):
    got = column(P.price_band, [40.0, 40.01, 100.0, 100.01, None, float("nan")], "double")
    assert got == ["economy", "mid", "mid", "premium", "premium", "premium"]
    with pytest.raises(ValueError):
        P.price_band(F.lit(1.0), (1.0,), ("a",))


def test_price_arithmetic(spark):
    df = spark.createDataFrame(
        [(1, 80.0, 100.0), (2, 80.0, 0.0), (3, None, 100.0), (4, 0.0, 10.0)], "i int, p double, o double"
    )
    p, o = F.col("p"), F.col("o")
    got = df.select(
        "i", P.discount(p, o), P.discount_pct(p, o), P.discount_pct_catalog(p, o), P.sales_per_price(F.lit(50.0), p)
    ).orderBy("i").collect()
    assert tuple(got[0])[1:] == (20.0, 20.0, 20.0, pytest.approx(50 / 81))
    assert tuple(got[1])[1:4] == (-80.0, None, 0.0)
    assert tuple(got[2])[1:] == (None, None, 0.0, None)
    assert got[3][4] is None


def test_log_feature(column):
    assert column(P.log_feature, [None, -5.0, 0.0, math.e - 1], "double") == [0.0, 0.0, 0.0, pytest.approx(1.0)]
