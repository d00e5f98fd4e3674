"""Stage files and tables on edge rows: CSV blocks, states, bucketed joins, hot keys, reconciliation."""

import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from marketlens.operators import latest_state as L
from marketlens.operators.digests import reconcile_rows
from marketlens.operators.latest import latest_columns
from marketlens.operators.merge import hot_keys, join_small, merge_history
from marketlens.session import shared_folder
from marketlens.sources.buckets import merge_bucketed, write_bucketed
from marketlens.sources.csv_blocks import read_csv_blocks
from marketlens.sources.files import read_csv, write_csv


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- CSV -------------------------------------------------------------------------------------

TEXTS = ["plain", 'a "quoted" word', "two\nlines", "\n\nempty lines\n", '"', '""', '",\n"', "comma, comma", None, " blanks ", "x" * 300, "\n" * 90, 'é"\né']


def csv_rows(n, seed=1):
    rng = random.Random(seed)
    return [(i, rng.choice(TEXTS), rng.choice(TEXTS), rng.choice([None, 1.5, -2.0])) for i in range(n)]


CSV = "i int, a string, b string, x double"


@pytest.mark.parametrize("block", [16, 61, 1000, 10**8])
def test_csv_blocks_cut_at_any_byte(spark, tmp_path, block):
    want = spark.createDataFrame(csv_rows(120), CSV)
    write_csv(want.coalesce(1), f"{tmp_path}/one", bom=True)
    write_csv(want.where("i % 2 = 0").repartition(3), f"{tmp_path}/many")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = read_csv_blocks(spark, f"{tmp_path}/one", CSV)
        rows, tasks = sorted(map(tuple, got.collect())), spark.read.text(f"{tmp_path}/one").rdd.getNumPartitions()
        half = sorted(map(tuple, read_csv_blocks(spark, f"{tmp_path}/many", CSV).collect()))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert tasks > 1
    assert rows == sorted(map(tuple, want.collect())) == sorted(map(tuple, read_csv(spark, f"{tmp_path}/one", CSV).collect()))
    assert half == [r for r in rows if r[0] % 2 == 0]


def test_csv_blocks_equal_another_reader(spark, tmp_path):
    with open(f"{tmp_path}/f.csv", "w", newline="") as f:  # carriage returns before newlines, inside and outside of fields
        f.write('i,a,b,x\r\n1,"one\ntwo","say ""hi""",1.5\r\n\r\n2,,plain,NaN\r\n3,"","last",2')
    got = sorted(map(tuple, read_csv_blocks(spark, f"{tmp_path}/f.csv", CSV).collect()))
    assert got == [(1, "one\ntwo", 'say "hi"', 1.5), (2, None, "plain", None), (3, None, "last", 2.0)]
    con = duckdb.connect()
    theirs = con.sql(f"SELECT i, a, b FROM read_csv('{tmp_path}/f.csv', header = true, quote = '\"', escape = '\"') ORDER BY i").fetchall()
    assert [(i, a or "", b) for i, a, b in theirs] == [(i, a or "", b) for i, a, b, _ in got]
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "f.csv").write_text("i,a,b,x\n")
    assert read_csv_blocks(spark, f"{tmp_path}/none", CSV).count() == 0
    (tmp_path / "bare.csv").write_text("7,a,b,0\n")
    assert read_csv_blocks(spark, f"{tmp_path}/bare.csv", CSV, header=False).first().i == 7


# --- state of the latest values --------------------------------------------------------------


def history(seed, n=400):
    rng = random.Random(seed)
    pick = lambda *v: rng.choice(v)
    return [(pick("a", "b", "c", "d", None), pick(1, 2, 3, 4, None), i, pick(None, float("nan"), rng.random()), pick(None, i)) for i in range(n)]


HISTORY = "k string, t int, tie int, x double, y int"


def test_folded_parts_equal_the_whole(spark, tmp_path):
    rows = history(3)
    whole = spark.createDataFrame(rows, HISTORY)
    want = sorted(map(str, latest_columns(whole, "k", "t", ["tie"]).collect()))
    for k in range(4):
        L.fold(whole.where(F.col("tie") % 4 == k), f"{tmp_path}/s", "k", "t", ["tie"], 8)
    L.fold(whole.where("tie < 50"), f"{tmp_path}/s", "k", "t", ["tie"], 8)  # a landing comes twice
    state = L.stored_state(spark, f"{tmp_path}/s", "k", buckets=8)
    assert sorted(map(str, L.state_values(state, "k").collect())) == want
    L.compact(spark, f"{tmp_path}/s", f"{tmp_path}/c", "k")
    assert spark.read.parquet(f"{tmp_path}/c").count() == 4
    again = L.state_values(L.stored_state(spark, f"{tmp_path}/c", "k", buckets=8), "k")
    assert sorted(map(str, again.collect())) == want
    with pytest.raises(ValueError):
        L.latest_state(whole.withColumn("_bucket", F.lit(1)), "k", "t")


def test_a_fold_touches_its_buckets_only(spark, tmp_path):
    old = spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("t"), F.col("id").alias("v"))
    L.fold(old, f"{tmp_path}/s", "k", "t", buckets=64)
    new = spark.createDataFrame([(5, 2, -5), (None, 9, 9)], "k long, t int, v long")
    L.fold(new, f"{tmp_path}/s", "k", "t", buckets=64)
    state = L.stored_state(spark, f"{tmp_path}/s", "k", touched_by=new, buckets=64)
    assert re.search(r"PartitionFilters: \[[^\]]*_bucket", plan_of(state))
    rows = {r.k: r.v for r in L.state_values(state, "k").collect()}
    assert rows.pop(5) == -5 and 0 < len(rows) < 100 and all(v == k for k, v in rows.items())


# --- buckets, hot keys, helper columns -------------------------------------------------------


def sides(spark):
    history = spark.createDataFrame([("a", 1, "h1"), ("a", 1, "h1"), (None, 2, "h2"), ("z", 3, "h3")], "asin string, d int, note string")
    details = spark.createDataFrame([("a", "A", "n1"), (None, "N", "n2"), ("q", "Q", "n3")], "asin string, title string, note string")
    return history, details


def bucketed(spark, df, name, key, n=4):
    path = shared_folder(spark, name)
    return write_bucketed(df, path.rsplit("/", 1)[1].replace("-", "_"), key, n, path)


def test_bucketed_tables_join_and_group_without_exchange(spark):
    history, details = sides(spark)
    want = sorted(map(str, merge_history(history, details).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        h, d = bucketed(spark, history, "h", "asin"), bucketed(spark, details, "d", "asin")
        joined = merge_bucketed(h, d)
        assert sorted(map(str, joined.collect())) == want
        plan = plan_of(joined)
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
        rows = bucketed(spark, spark.createDataFrame([r for r in globals()["history"](5)], HISTORY), "l", "k")
        latest = latest_columns(rows, "k", "t", ["tie"])
        assert "Exchange hashpartitioning" not in plan_of(latest)
        assert sorted(map(str, latest.collect())) == sorted(map(str, latest_columns(spark.createDataFrame(globals()["history"](5), HISTORY), "k", "t", ["tie"]).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_hot_keys_are_salted(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None).otherwise(F.col("id").cast("string")).alias("asin"), "id")
    assert set(hot_keys(rows, "asin", 1 / 8)) == {"hot", None} and hot_keys(rows, "asin", 0.5) == [] and hot_keys(rows.limit(0), "asin", 0.1) == []
    details = spark.createDataFrame([("hot", "H"), (None, "N"), ("2", "two"), ("5", "five")], "asin string, title string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = merge_history(rows, details, salts=8)
        got = {r.title: r["count"] for r in joined.groupBy("title").count().collect()}
        assert got == {"H": 1000, "N": 1000, "two": 1, "five": 1, None: 998}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("salts", [1, 2])
def test_helper_names_do_not_clash(spark, salts):
    history = spark.createDataFrame([("a", 1, 2, 3, 4)] * 3, "asin string, _salt int, _key int, _salt_r int, _salt__ int")
    details = spark.createDataFrame([("a", 7, 8)], "asin string, _Key_ int, title int")
    got = merge_history(history, details, salts=salts)
    assert got.columns == ["asin", "_salt", "_key", "_salt_r", "_salt__", "_Key_", "title", "asin_group"]
    assert set(map(tuple, got.collect())) == {("a", 1, 2, 3, 4, 7, 8, "a")}
    small = join_small(history, details.withColumn("_side_asin", F.lit("s")), ["asin"])
    assert small.columns == [*history.columns, "_Key_", "title", "_side_asin"] and small.first()._side_asin == "s"


# --- reconciliation --------------------------------------------------------------------------


def test_reconcile_finds_each_kind(spark):
    sent = [(i, f"v{i}", None if i % 3 else 1.0) for i in range(200)] + [(None, "n", None), (7, "second row of 7", 0.0)]
    loaded = [r for r in sent if r[0] not in (20, None)]  # lost
    loaded[loaded.index((30, "v30", 1.0))] = (30, "v30", 2.0)  # changed
    loaded += [(40, "v40", None), (500, "new", None), (7, "third", None)]
    schema = "k int, v string, x double"
    a, b = spark.createDataFrame(sent, schema), spark.createDataFrame(loaded, schema).select("x", "v", "k").repartition(3)
    got = {r.k: (r.verdict, r.only_source, r.only_loaded) for r in reconcile_rows(a, b, ["k"]).collect()}
    assert got == {20: ("lost", 1, 0), None: ("lost", 1, 0), 30: ("changed", 1, 1), 40: ("repeated", 0, 1), 500: ("added", 0, 1), 7: ("added", 0, 1)}
    assert reconcile_rows(a, a, ["k"]).count() == 0 and reconcile_rows(a.limit(0), a.limit(0), ["k"]).count() == 0
    assert reconcile_rows(a, a.limit(0), ["k"]).where("verdict = 'lost'").count() == 201
    with pytest.raises(ValueError):
        reconcile_rows(a, b.drop("x"), ["k"])
    taken = a.withColumns({c: F.lit(1) for c in ("_a", "_b", "_s", "_d", "bucket", "n")})
    assert reconcile_rows(taken, taken.where("k <> 20"), ["k"]).where("k = 20").first().verdict == "lost"
