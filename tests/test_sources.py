import json

import pytest
from pyspark.sql import functions as F

from marketlens import schemas
from marketlens.operators import quality as Q
from marketlens.sources import envelopes as E
from marketlens.sources import files, requests


def landed(spark, rows):
    """(asin, page, status_code, error, body) rows; dict bodies become JSON."""
    full = [(a, p, s, e, json.dumps(b) if isinstance(b, (dict, list)) else b) for a, p, s, e, b in rows]
    return spark.createDataFrame(full, schemas.LANDED)


def page(*names, status="OK"):
    return {"status": status, "data": {"products": [{"asin": n} for n in names]}}


def test_pages_end_at_first_bad_page(spark):
    df = landed(spark, [(None, 1, 200, None, page("a", "b")), (None, 2, 200, None, page()), (None, 3, 200, None, page("c"))])
    got = E.explode_pages(df, "asin string").collect()
    assert sorted(r.asin for r in got) == ["a", "b"]


@pytest.mark.parametrize("bad", [(429, None, None), (None, "timeout", None), (200, None, page("x", status="ERROR")), (200, None, {"status": "OK"})])
def test_pages_end_on_each_failure(spark, bad):
    df = landed(spark, [("q", 1, 200, None, page("a")), ("q", 2, *bad), ("q", 3, 200, None, page("c")), ("r", 3, 200, None, page("d"))])
    got = E.explode_pages(df.withColumnRenamed("asin", "q"), "asin string", key="q")
    assert sorted(r.asin for r in got.collect()) == ["a", "d"]


def test_no_bad_page_keeps_all(spark):
    df = landed(spark, [(None, 1, 200, None, page("a")), (None, 2, 200, None, page("b"))])
    assert E.explode_pages(df, "asin string").count() == 2


def test_cut_after_first_is_per_key(spark):
    df = spark.createDataFrame(
        [("p", 1, 200), ("p", 2, 429), ("p", 3, 200), ("q", 1, 500), ("q", 2, 200), (None, 1, 429), (None, 2, 200)],
        "asin string, page int, status int",
    )
    kept = E.cut_after_first(df, "asin", "page", F.col("status") == 429)
    assert sorted((r.asin, r.page) for r in kept.collect()) == [("p", 1), ("q", 1), ("q", 2)]


def test_details_buckets(spark):
    df = landed(
        spark,
        [
            ("a", 1, 200, None, {"data": {"product_title": "T", "product_price": 5.5}}),
            ("b", 1, 200, None, {"data": {}}),
            ("c", 1, 200, None, {"other": 1}),
            ("d", 1, 429, None, None),
            ("e", 1, None, "timeout", None),
            ("f", 1, 200, None, "<html>"),
        ],
    )
    got = {r.asin: r for r in E.unwrap_details(df, "product_title string, product_price double").collect()}
    assert (got["a"].bucket, got["a"].product_title, got["a"].product_price) == ("ok", "T", 5.5)
    assert [got[k].bucket for k in "bcdef"] == ["no_data", "no_data", "error", "error", "error"]
    assert [got[k].error for k in "adef"] == [None, "HTTP 429", "timeout", "unreadable response"]


def test_series_reasons(spark):
    def body(series):
        return {"products": [{"csv": [series]}]}

    df = landed(
        spark,
        [
            ("ok", 1, 200, None, body([1, 1000, 2, -1])),
            ("empty", 1, 200, None, body([])),
            ("odd", 1, 200, None, body([1, 2, 3])),
            ("null", 1, 200, None, body(None)),
            ("nokey", 1, 200, None, {"message": "x"}),
            ("none", 1, 200, None, {"products": []}),
            ("nocsv", 1, 200, None, {"products": [{"title": "t"}]}),
            ("http", 1, 400, None, None),
            ("junk", 1, 200, None, "{"),
        ],
    )
    got = {r.asin: (r.series, r.error) for r in E.validate_series(df).collect()}
    assert got["ok"] == ([1, 1000, 2, -1], None)
    assert got["empty"] == ([], None)
    assert got["odd"] == got["null"] == (None, E.BROKEN_SERIES)
    assert got["nokey"][1] == E.NO_PRODUCTS_KEY
    assert got["none"][1] == E.NO_PRODUCTS
    assert got["nocsv"][1] == E.NO_SERIES
    assert got["http"][1] == "request failed" and got["junk"][1] == "unreadable response"


def test_decode_series(spark):
    day = 24 * 60
    start = 5000 * day  # minutes after the epoch: 2024-09-09
    df = spark.createDataFrame(
        [("a", [start, 1000, start + 1, -1]), ("b", []), ("c", None), ("d", [start - 366 * day, 500, start - 365 * day, 600])],
        "asin string, series array<bigint>",
    )
    got = sorted((r.asin, str(r.date), r.price) for r in E.decode_price_series(df, "2024-09-09").collect())
    assert got == [("a", "2024-09-09 00:00:00", 10.0), ("d", "2023-09-10 00:00:00", 6.0)]


def test_reviews(spark):
    df = landed(
        spark,
        [
            ("a", 1, 200, None, {"data": [{"text": "good", "stars": 5}, "plain", 7]}),
            ("b", 1, 200, None, {"data": {"k1": 1, "k2": {"x": 2}}}),
            ("c", 1, 200, None, {"data": []}),
            ("d", 1, 200, None, {}),
            ("e", 1, 429, None, None),
        ],
    )
    got = E.flatten_reviews(df, {"text": "string", "stars": "int"}).orderBy("asin", "position").collect()
    assert [(r.asin, r.review, r.text, r.stars) for r in got] == [
        ("a", None, "good", 5), ("a", "plain", None, None), ("a", "7", None, None), ("b", "k1", None, None), ("b", "k2", None, None),
    ]
    assert json.loads(got[0].record) == {"text": "good", "stars": 5}


def test_inventory(spark):
    df = landed(
        spark,
        [
            ("a", 1, 200, None, {"products": [{"asin": "own", "title": None, "availabilityAmazon": 3}]}),
            ("b", 1, 200, None, {}),
            ("c", 1, 200, None, {"products": []}),
            ("d", 1, 500, None, None),
        ],
    )
    got = {r.asin: r for r in E.project_inventory(df).collect()}
    assert (got["own"].title, got["own"].available_amazon, got["own"].condition) == (None, "3", E.INVENTORY_DEFAULTS["condition"])
    assert got["b"].title == E.INVENTORY_DEFAULTS["title"] and got["b"].error is None
    assert got["c"].error and got["d"].error and got["c"].title is None


def test_requests(spark):
    keys = requests.distinct_keys(spark.createDataFrame([(1,), (1,), (None,), (2,)], "asin int"), "asin")
    assert sorted(r.asin for r in keys.collect()) == ["1", "2"]
    manifest = requests.request_manifest(keys, 3)
    assert manifest.count() == 6
    errors = spark.createDataFrame([("1",), ("2",)], "asin string")
    ok = spark.createDataFrame([("2",)], "asin string")
    assert {r.asin for r in requests.retry_list(keys, ok, errors).collect()} == {"1"}


def test_csv_round_trip_with_newlines_and_mark(spark, tmp_path):
    rows = [("a", "two\nlines, \"quoted\"", 1.5), ("b", None, None)]
    df = spark.createDataFrame(rows, "asin string, note string, price double")
    path = str(tmp_path / "out")
    files.write_csv(df.coalesce(1), path, bom=True)
    part = next((tmp_path / "out").glob("*.csv"))
    assert part.read_bytes().startswith(b"\xef\xbb\xbfasin,note,price")
    back = files.read_csv(spark, path, "asin string, note string, price double").orderBy("asin").collect()
    assert [tuple(r) for r in back] == rows


def test_stage_by_month_and_reconcile(spark, tmp_path):
    df = spark.sql("SELECT id, timestamp_ntz'2024-01-15' + make_dt_interval(CAST(id AS INT)) AS date FROM range(60)")
    path = str(tmp_path / "stage")
    files.write_stage(df, path, by_month_of="date")
    assert sorted(p.name for p in (tmp_path / "stage").glob("month=*")) == ["month=2024-01", "month=2024-02", "month=2024-03"]
    back = spark.read.parquet(path)
    assert tuple(files.reconcile_counts(df, back).first()) == (60, 60, True)
    assert tuple(files.reconcile_counts(df, back.limit(5)).first()) == (60, 5, False)


def test_load_table_replaces(spark, tmp_path):
    name = "load_table_check"
    spark.sql(f"CREATE TABLE {name} (id BIGINT) USING parquet LOCATION '{tmp_path}/t'")
    files.load_table(spark.range(3), name)
    files.load_table(spark.range(2), name)
    assert spark.table(name).count() == 2
    spark.sql(f"DROP TABLE {name}")


def test_quarantine_masks_keys(spark):
    df = spark.createDataFrame([("a", None), ("b", "400 for url: https://x/p?key=SECRET&d=1")], "asin string, error string")
    ok, errors = Q.quarantine(df)
    assert [r.asin for r in ok.collect()] == ["a"]
    assert "SECRET" not in errors.first().error
    assert tuple(Q.error_profile(errors).first()) == (400, 1)


def test_review_job_splits_limits_from_errors(spark):
    from marketlens.plans.ingestion import build_reviews

    good = {"data": [{"text": "t"}]}
    df = landed(
        spark,
        [
            ("p", 1, 200, None, good), ("p", 2, 429, None, None), ("p", 3, 200, None, good),
            ("q", 1, 500, None, None), ("q", 2, 200, None, good), ("q", 3, None, "timeout token=abc", None),
            ("r", 1, 200, None, "<html>"), ("r", 2, 200, None, {"data": None}), ("r", 3, 200, None, {}),
        ],
    )
    reviews, errors = build_reviews(df, {"text": "string"})
    assert sorted((r.asin, r.page) for r in reviews.collect()) == [("p", 1), ("q", 2)]
    assert sorted(map(tuple, errors.collect())) == [
        ("q", 1, "HTTP 500"), ("q", 3, "timeout token=***"), ("r", 1, "unreadable response"), ("r", 2, "unreadable response"),
    ]


def test_detail_and_history_jobs(spark):
    from marketlens.plans.ingestion import build_details, build_history

    df = landed(
        spark,
        [("a", 1, 200, None, {"data": {"product_title": "T"}}), ("b", 1, 200, None, {"data": {}}), ("c", 1, 429, None, None)],
    )
    details, no_data, errors = build_details(df)
    assert [r.product_title for r in details.collect()] == ["T"]
    assert [r.asin for r in no_data.collect()] == ["b"]
    assert [tuple(r) for r in errors.collect()] == [("c", "HTTP 429")]
    series = landed(spark, [("a", 1, 200, None, {"products": [{"csv": [[7200000, 150]]}]}), ("b", 1, 200, None, {"products": []})])
    history, errors = build_history(series, "2024-09-09")
    assert [(r.asin, r.price) for r in history.collect()] == [("a", 1.5)]
    assert [r.asin for r in errors.collect()] == ["b"]


def test_keep_writes_to_the_shared_folder_when_there_is_one(spark, tmp_path, monkeypatch):
    from marketlens import session

    monkeypatch.setattr(session, "CHECKPOINT_KEY", "marketlens.tests.folder")
    cached = session.keep(spark.range(5))
    assert cached.is_cached
    session.release(cached)
    spark.conf.set("marketlens.tests.folder", str(tmp_path))
    kept = session.keep(spark.range(7).where("id > 1"))
    spark.conf.unset("marketlens.tests.folder")
    assert not kept.is_cached and kept.count() == 5
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" in plan and "Range" not in plan
    assert spark.sparkContext.getCheckpointDir() is not None
