"""Target-distribution importance resampling over hashed word n-grams.

A text's UTF-8 bytes go through one 256-byte table that lower-cases A-Z and blanks separators, and
``bytes.split`` yields its words. The CRC-32 of a word seeds that of the word pair that starts with it,
and that one the triple's, so each longer n-gram costs only its last word. Codes modulo the number of
buckets are counted by a ``Counter`` per task, which holds no more entries than there are buckets; the
counters are added up by Spark.

Each bucket's gain is the log ratio of its smoothed shares in the target texts and in all documents. A
document's weight is the sum of its features' gains. With Gumbel noise from a digest of its id, the highest
scores are a sample without replacement in proportion to exp(weight).
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_map, keep, private, table


def byte_table(kept: set[int]) -> bytes:
    """256-byte table that lower-cases A-Z, leaves the bytes of ``kept`` and blanks all others."""
    return bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in kept else 0x20 for b in range(256))


_TABLE = byte_table({*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)})  # digits, a-z, bytes of other letters

SCORES = "n_words long, n_features long, weight long, score long"


def runs_of_words(text: bytes, bytes_table: bytes = _TABLE, most: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text, about ``most`` bytes at a time, so that a very long text needs no long list."""
    clean, at = text.translate(bytes_table), 0
    while len(clean) - at > most:
        end = clean.find(b" ", at + most)
        if end < 0:
            break
        yield clean[at:end].split()
        at = end
    yield clean[at:].split()


def feature_codes(text: bytes | None, order: int = 3, most: int = 1 << 20) -> Iterator[tuple[int, np.ndarray]]:
    """(words, CRC-32 of all n-grams that end in them) for each run of words of a text."""
    before: list[bytes] = []
    for words in runs_of_words(text or b"", most=most):
        chain = before + words
        spaced = [b" " + w for w in chain]
        codes = list(map(crc32, chain))
        found = codes[len(before) :]
        for n in range(1, order):  # an n-gram's code seeds the code of the one with a word more
            codes = list(map(crc32, spaced[n:], codes))
            found += codes[max(0, len(before) - n) :]
        yield len(words), np.array(found, np.uint32)
        before = chain[len(chain) - order + 1 :] if len(chain) >= order else chain
        if order == 1:
            before = []


def bucket_counts(texts: DataFrame, buckets: int, order: int = 3) -> DataFrame:
    """(bucket, n): how often the features of all texts fall into each bucket."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        held: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                for _, codes in feature_codes(text, order):
                    held.update((codes % buckets).tolist())
        yield {"bucket": list(held), "n": list(held.values())}

    own = texts.select(F.col("text").cast("binary").alias("text"))
    return arrow_map(own, run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int, order: int = 3) -> np.ndarray:
    """Gain of each bucket in thousandths: floor of 1000 times the log ratio of add-one shares."""

    def counted(texts: DataFrame) -> list[int]:
        n = [0] * buckets
        for row in bucket_counts(texts, buckets, order).collect():  # ``buckets`` rows at most
            n[row.bucket] = row.n
        return n

    s, t = counted(docs), counted(target)
    all_s, all_t = float(sum(s) + buckets), float(sum(t) + buckets)
    return np.array([math.floor(1000 * math.log((y + 1.0) * all_s / ((x + 1.0) * all_t))) for x, y in zip(s, t)], np.int64)


def noise(doc_id, seed: int) -> int:
    """Gumbel noise in thousandths from a digest of seed and id; a null id counts as empty."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def importance_scores(docs: DataFrame, gains: np.ndarray, *, order: int = 3, seed: int = 42) -> DataFrame:
    """Rows (doc_id, n_words, n_features, weight, score), one per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)  # one number a bucket

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        gains = shared.value
        for batch in batches:
            out = {"doc_id": batch["doc_id"], "n_words": [], "n_features": [], "weight": [], "score": []}
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                words = features = weight = 0
                for n, codes in feature_codes(text, order):
                    words, features = words + n, features + len(codes)
                    weight += int(gains[codes % len(gains)].sum())
                out["n_words"].append(words)
                out["n_features"].append(features)
                out["weight"].append(weight)
                out["score"].append(weight + noise(doc_id, seed))
            yield out

    own = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return arrow_map(own, run, f"doc_id {dict(own.dtypes)['doc_id']}, {SCORES}")


def draw(scored: DataFrame, min_words: int, num: int, den: int, rows_per_part: int = 100_000) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3... of the floor(num * N / den) highest scores among the N rows with at
    least ``min_words`` words, ties to the smaller id; else null.

    The rows are dealt into ranges of the score and numbered within each; the ranges' row counts give the
    offsets. Ranges wholly beyond the drawn ones are not sorted.
    """
    scored = keep(scored)
    fits = F.col("n_words") >= min_words
    eligible = scored.where(fits)
    n = eligible.count()
    drawn = num * n // den
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight")]
    ranged = keep(eligible.repartitionByRange(1 + n // rows_per_part, *order).withColumn("part", F.spark_partition_id()))
    counts = sorted((r.part, r["count"]) for r in ranged.groupBy("part").count().collect())  # a row a range
    before = [0, *accumulate(c for _, c in counts)]
    reached = [(part, at) for (part, _), at in zip(counts, before) if at < drawn]
    offsets = F.broadcast(scored.sparkSession.createDataFrame(reached, "part int, before long"))
    place = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy(*order))
    columns = [c for c in scored.columns]
    inside = ranged.join(offsets, "part").withColumn("rank", place).select(*columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
    none = F.lit(None).cast("long").alias("rank")
    beyond = ranged.join(offsets, "part", "left_anti").select(*columns, none)
    return inside.unionByName(beyond).unionByName(scored.where(~fits).select(*columns, none))


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    buckets: int = 10_000,
    order: int = 3,
    min_words: int = 20,
    num: int = 5,
    den: int = 100,
    seed: int = 42,
) -> DataFrame:
    """Rows (doc_id, n_words, n_features, weight, score, rank): the drawn documents have a rank.

    Features are all runs of 1 to ``order`` consecutive words, joined by one blank. A null or empty text has
    none and weight 0; it has too few words to be drawn unless ``min_words`` is 0. A null id counts as empty
    in the digest and comes last among ties. Repeated rows are counted, scored and drawn once each; equal
    rows are told apart by nothing, so their ranks may be exchanged. With an empty target all gains come from
    the smoothing; an empty table gives an empty result. Other columns are ignored.
    """
    own = private(docs, doc_id=id_col, text=text_col)
    gains = bucket_gains(own, private(target, text=target_col), buckets, order)
    return draw(importance_scores(own, gains, order=order, seed=seed), min_words, num, den)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` drawn towards the words of ``benchmark``."""
    found = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


_GRAM_WORDS = (
    r"list_filter(string_split_regex(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
)
_DIGIT = "(instr('0123456789ABCDEF', substr(h, {i}, 1)) - 1)"
_CRC_SHIFT = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
ORACLE = f"""
WITH RECURSIVE steps AS (SELECT range AS b, range AS c, 0 AS k FROM range(256)
  UNION ALL SELECT b, {_CRC_SHIFT}, k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8),
texts AS (SELECT 's' AS side, doc_id, {_GRAM_WORDS.format(text='text')} AS w FROM documents
  UNION ALL SELECT 't', NULL, {_GRAM_WORDS.format(text='text')} FROM benchmark),
grams AS (SELECT side, doc_id, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT side, doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM texts, (SELECT unnest([1, 2, 3]) AS n) WHERE len(w) >= n)),
coded AS (SELECT g, xor(list_reduce(list_transform(range(1, len(h), 2), lambda i: {_DIGIT.format(i='i')} * 16 + {_DIGIT.format(i='i + 1')}),
    lambda c, b: xor(t[xor(c & 255, b) + 1], c >> 8), 4294967295), 4294967295) % 10000 AS bucket
  FROM (SELECT g, hex(g) AS h FROM (SELECT DISTINCT g FROM grams)), crc),
counts AS (SELECT bucket, count(*) FILTER (WHERE side = 's') AS s, count(*) FILTER (WHERE side = 't') AS t FROM grams JOIN coded USING (g) GROUP BY bucket),
totals AS (SELECT CAST(sum(s) + 10000 AS DOUBLE) AS s_all, CAST(sum(t) + 10000 AS DOUBLE) AS t_all FROM counts),
gains AS (SELECT bucket, CAST(floor(1000 * ln((t + 1e0) * s_all / ((s + 1e0) * t_all))) AS BIGINT) AS gain FROM counts, totals),
weights AS (SELECT doc_id, sum(gain) AS weight, count(*) AS n FROM grams JOIN coded USING (g) JOIN gains USING (bucket) WHERE side = 's' GROUP BY doc_id),
noise AS (SELECT doc_id, len(w) AS n_words, list_reduce(list_transform(range(1, 9), lambda i: {_DIGIT.format(i='i')}), lambda a, b: a * 16 + b) AS x
  FROM (SELECT doc_id, w, upper(sha256('42:' || doc_id)) AS h FROM texts WHERE side = 's')),
scored AS (SELECT doc_id, n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
  CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((x + 0.5e0) / 4294967296e0))) AS BIGINT) AS score FROM noise LEFT JOIN weights USING (doc_id)),
ranked AS (SELECT *, n_words >= 20 AS fits, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
  count(*) OVER (PARTITION BY n_words >= 20) AS total FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN fits AND place <= 5 * total // 100 THEN CAST(place AS BIGINT) END AS rank FROM ranked
"""
