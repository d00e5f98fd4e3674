"""Benchmark decontamination by winnowing, in DataFrame functions only.

A fingerprint is the smallest of ``window - k + 1`` neighbouring hashed word k-grams. Two texts that
share ``window`` words in a row share all the k-grams of that span, hence its fingerprint, so joining
fingerprints misses no such span. Hits are then extended in the documents that have one: their word runs
of a window's length are joined to the items' distinct ones, so a word that repeats costs no more than its places
in the document, and the spans found are merged. Items shorter than a window are one window of their own
length; those are found by joining the word runs of that length of all documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keep, private, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Runs of ASCII letters and digits and of all other than ASCII, A-Z lower-cased; null: none."""
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), NO_WORD), lambda w: w != "")


def runs(df: DataFrame, out: str, length: int) -> DataFrame:
    """``out``: hashes of the runs of ``length`` words of ``hashes``, in order. ``hashes`` must be a
    column of ``df``, not an expression, so that it is not worked out again for each place."""
    n = F.size("hashes") - length
    at = lambda i: F.xxhash64(*(F.get("hashes", i + j) for j in range(length)))
    return df.withColumn(out, F.when(n >= 0, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(0))), at)).otherwise(F.array().cast("array<long>")))


def winnow(df: DataFrame, out: str, over: int) -> DataFrame:
    """``out``: the distinct smallest hashes of each ``over`` neighbours of ``grams``."""
    n = F.size("grams") - over
    least = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(0)) + 1), lambda i: F.array_min(F.slice("grams", i, over)))
    return df.withColumn(out, F.when(n >= 0, F.array_distinct(least)).otherwise(F.array().cast("array<long>")))


def hashed(df: DataFrame) -> DataFrame:
    df = df.withColumn("words", words(F.col("text")))
    return df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))


def contamination(docs: DataFrame, benchmark: DataFrame, *, window: int = 13, k: int = 5, percent: int = 5) -> DataFrame:
    """Rows (doc_id, text_key, n_words, n_hit, n_items, items_sha256, contaminated), one per row of ``docs``.

    A document's word is hit when it lies in any occurrence of an item's window; a document is
    contaminated when at least ``percent`` % of its words, and at least one, are hit. Null and empty
    texts have no words. Rows with the same id are told apart by ``text_key``, a hash of the text;
    repeated rows each get the same result. Items without an id are numbered as the empty string.
    """
    docs = private(docs, doc_id="doc_id", text="text").withColumn("text_key", F.xxhash64("text"))
    items = private(benchmark, item_id="item_id", text="text").withColumn("item_id", F.coalesce(F.col("item_id").cast("string"), F.lit("")))
    key = ["doc_id", "text_key"]
    over = window - k + 1

    items = keep(runs(hashed(items), "grams", k).select("item_id", "hashes", "grams").where(F.size("hashes") > 0))
    long_items = items.where(F.size("hashes") >= window)
    prints = winnow(long_items, "prints", over).select(F.explode_outer("prints").alias("print")).distinct()

    marked = keep(
        winnow(runs(hashed(docs), "grams", k), "prints", over).select(*key, F.size("words").alias("n_words"), "prints")
    )
    suspects = marked.select(*key, F.explode("prints").alias("print")).join(prints, "print", "left_semi").select(*key).distinct()
    spans = _occurrences(_pick(docs, suspects), long_items, window)
    lengths = [r[0] for r in items.where(F.size("hashes") < window).select(F.size("hashes")).distinct().collect()]  # under ``window`` values
    for n in sorted(lengths):
        spans = spans.unionByName(_occurrences(hashed(docs), items.where(F.size("hashes") == n), n))

    found = F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")
    hits = spans.groupBy(*key).agg(_covered(F.collect_set(F.struct("first", "last"))).alias("n_hit"), found)
    out = marked.drop("prints").alias("m").join(hits.alias("h"), _same(key, "m", "h"), "left")
    n_hit, found = F.coalesce("n_hit", F.lit(0)).cast("long"), F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        *(F.col(f"m.{c}") for c in key),
        F.col("n_words").cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(found).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", found), 256).alias("items_sha256"),
        ((n_hit > 0) & (100 * n_hit >= percent * F.col("n_words"))).alias("contaminated"),
    )


def _same(key: list[str], a: str, b: str) -> Column:
    """Equal keys; a null id equals a null id."""
    first, second = (F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in key)
    return first & second


def _pick(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    key = ["doc_id", "text_key"]
    picked = docs.alias("d").join(chosen.alias("c"), _same(key, "d", "c"), "left_semi").dropDuplicates(key)
    return hashed(picked)


def _occurrences(docs: DataFrame, items: DataFrame, n: int) -> DataFrame:
    """Rows (doc_id, text_key, items, first, last): the places of runs of ``n`` words that items have, with all
    items that have them. Runs are compared by two hashes of their words."""

    def placed(df: DataFrame) -> DataFrame:
        last = F.size("hashes") - n
        at = lambda i, seed: F.xxhash64(F.lit(seed), *(F.get("hashes", i + j) for j in range(n)))
        both = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.struct(at(i, 1).alias("a"), at(i, 2).alias("b")))
        # The outer form: the other makes Spark test the size of the array first, which works out the words again.
        return df.withColumn("runs", F.when(last >= 0, both)).select("*", F.posexplode_outer("runs").alias("at", "run"))

    whole = placed(items.select("item_id", "hashes")).groupBy("run").agg(F.collect_set("item_id").alias("items"))
    hit = placed(docs.select("doc_id", "text_key", "hashes")).select("doc_id", "text_key", "at", "run").join(whole, "run")
    return hit.select("doc_id", "text_key", "items", F.col("at").alias("first"), (F.col("at") + n - 1).alias("last"))


def _covered(spans: Column) -> Column:
    """How many words the spans (first, last) of a document cover together."""
    start = F.struct(F.lit(-1).alias("end"), F.lit(0).alias("n"))

    def add(done: Column, span: Column) -> Column:
        new = F.greatest(span["last"] - F.greatest(span["first"] - 1, done["end"]), F.lit(0))
        return F.struct(F.greatest(done["end"], span["last"]).alias("end"), (done["n"] + new).alias("n"))

    return F.aggregate(F.array_sort(spans), start, add)["n"]


def op6_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


_WORDS_SQL = "list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{0}', '{1}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')".format(UPPER, LOWER)

ORACLE = f"""
WITH d AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
b AS (SELECT item_id, w, least(len(w), 13) AS n FROM (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark) WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[j:j + n - 1], ' ') AS g
       FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS j FROM b)),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM b) WHERE len(w) >= n)),
h AS (SELECT doc_id, item_id, i, dw.n FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hw ON d.doc_id = hw.doc_id LEFT JOIN hi ON d.doc_id = hi.doc_id
"""
