"""Nulls, empty and very long texts, repeated rows, ties, empty tables and clashing extra columns."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marketlens.llm import decontamination, fingerprints, jaccard, langid, maxent, packing, pii, quality, sharding, threads

random.seed(5)
VOCABULARY = [f"w{i}" for i in range(400)]
LONG = " ".join(random.choices(VOCABULARY, k=30_000))
PLAIN = "The quick brown fox jumps over the lazy dog and runs away. It was a good day for all of them."
ROWS = [
    (1, PLAIN, "en"),
    (2, None, "en"),
    (3, "", "fr"),
    (4, "   \n\t ", None),
    (5, LONG, "en"),
    (6, PLAIN, None),
    (7, PLAIN + "\nMail a.b@c.example, call +1 (222) 333-4444!", "en"),
    (None, PLAIN, "en"),
    (None, None, None),
    (8, "1234 5678", "de"),
    (9, "x", "en"),
    (9, "x", "en"),
    (10, "nul\x00 and \U0001f600 ÄÖ", "de"),
]
SCHEMA = "doc_id long, text string, lang string"


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text").cast("long"))
    clash = {c: F.lit(f"other {c}") for c in ("shard", "size", "n", "rep", "key", "tile", "words", "hashes", "gram", "range", "extra", "batch", "part", "_key", "text_key")}
    return df.withColumns(clash).repartition(3, "text").cache()


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, PLAIN), (2, None), (3, ""), (None, "w1 w2 w3"), (4, "x"), (4, "x")]
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("gram", F.lit(0))


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (1, 1, 0), (5, 1, None), (6, 1, 0), (8, 0, 0), (9, None, None), (None, 1, 0), (7, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").withColumn("text", F.lit("no text"))


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))


def operators(spark, benchmark, labels):
    return {
        "jaccard": lambda d: jaccard.jaccard_classes(d),
        "sharding": lambda d: sharding.shard_documents(d, 4),
        "quality": lambda d: quality.classify(d, labels),
        "decontamination": lambda d: decontamination.contamination(d, benchmark),
        "maxent": lambda d: maxent.score_texts(d, held_out(), rounds=2),
        "langid": lambda d: langid.identify(d, langid.learn_profiles(d)),
        "pii": lambda d: pii.find(d, pii.fit(d)),
        "redact": lambda d: pii.redact_documents(d, pii.fit(d)),
        "fingerprints": lambda d: fingerprints.fingerprints(d),
    }


NAMES = ["jaccard", "sharding", "quality", "decontamination", "maxent", "langid", "pii", "redact", "fingerprints"]


@pytest.mark.parametrize("name", NAMES)
def test_every_row_gets_its_result(spark, docs, benchmark, labels, name):
    got = operators(spark, benchmark, labels)[name](docs).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in ROWS)
    again = operators(spark, benchmark, labels)[name](docs).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, docs, benchmark, labels, name):
    assert operators(spark, benchmark, labels)[name](docs.limit(0)).count() == 0


def by_id(rows, column):
    out = {}
    for r in rows:
        out.setdefault(r.doc_id, []).append(r[column])
    return out


def test_defined_results(spark, docs, benchmark, labels):
    ops = operators(spark, benchmark, labels)
    rows = ops["jaccard"](docs).collect()
    assert by_id(rows, "component_id") | {} == {
        1: [1], 2: [2], 3: [3], 4: [4], 5: [5], 6: [1], 7: [7], None: [None, None], 8: [8], 9: [9, 9], 10: [10],
    }
    assert by_id(rows, "n_shingles")[8] == [1] and by_id(rows, "n_shingles")[4] == [0] and by_id(rows, "n_shingles")[2] == [0]

    rows = ops["sharding"](docs).collect()
    assert by_id(rows, "size")[2] == [16] and by_id(rows, "size")[3] == [16] and by_id(rows, "text_crc32")[2] == [0]
    shard = by_id(rows, "shard")
    assert shard[1] == shard[6] and shard[1][0] in shard[None] and len(set(shard[9])) == 1
    for k in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(sum(r.shard == k for r in rows)))

    rows = ops["quality"](docs).collect()
    assert by_id(rows, "perplexity")[2] == [None] and by_id(rows, "rejected")[2] == [True] and by_id(rows, "rejected")[3] == [True]
    assert by_id(rows, "rejected")[1] == [False]

    rows = ops["decontamination"](docs).collect()
    assert by_id(rows, "contaminated")[1] == [True] and by_id(rows, "n_items")[9] == [1, 1] and by_id(rows, "n_words")[2] == [0]
    assert by_id(rows, "n_hit")[1] == by_id(rows, "n_words")[1] and by_id(rows, "contaminated")[2] == [False]

    rows = ops["maxent"](docs).collect()
    assert by_id(rows, "n_tokens")[2] == [1] and by_id(rows, "n_tokens")[3] == [1] and by_id(rows, "n_tokens")[5] == [30_001]
    assert all(r.score < 0 and r.base_score < 0 for r in rows)

    rows = ops["langid"](docs).collect()
    assert by_id(rows, "lang_pred")[2] == ["und"] and by_id(rows, "lang_pred")[8] == ["und"] and by_id(rows, "lang_pred")[1] == ["en"]
    assert all(0 <= r.score <= 1 for r in rows)

    rows = ops["redact"](docs).collect()
    assert by_id(rows, "text")[7] == [PLAIN + "\nMail [EMAIL], call [PHONE]!"] and by_id(rows, "text")[2] == [None]
    assert by_id(rows, "n_chars")[7] == [len(PLAIN) + 28] and by_id(rows, "shard")[7] == ["other shard"]

    rows = ops["fingerprints"](docs).collect()
    assert by_id(rows, "n_chars")[2] == [0] and by_id(rows, "fingerprint")[2] == by_id(rows, "fingerprint")[3] == by_id(rows, "fingerprint")[4]
    assert by_id(rows, "fingerprint")[1] == by_id(rows, "fingerprint")[6]


def test_packing_edges(spark, docs):
    pieces = packing.pack_documents(docs, packing.vocabulary_path()).collect()
    total = by_id(pieces, "length")
    assert sum(total[2]) == sum(total[3]) == 1 and sum(total[9]) == 2 * by_id(pieces, "doc_tokens")[9][0]
    assert packing.pack_documents(docs.limit(0), packing.vocabulary_path()).count() == 0


def test_message_edges(spark):
    rows = [
        (1, 0, "a", "Hello there\nSecond line"), (1, 1, None, "> Hello there\n\nfine"), (1, 2, "a", "> > Hello there\n> fine\nok"),
        (1, 2, "a", "> > Hello there\n> fine\nok"), (1, 3, "a", None), (1, 4, "a", ""), (None, 5, "a", "> Hello there"),
        (2, None, "a", "Hello there"), (3, 0, "a", ">>>> \n>"), (1, 5, "a", "> not said by anyone"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("depth", F.lit("x"))
    got = sorted((str(r.scope), str(r.msg), r.parent, r.thread, r.depth, r.body, r.n_linked) for r in threads.link_quotes(df).collect())
    assert len(got) == len(rows)
    assert ("1", "1", 0, 0, 1, "fine", 1) in got and got.count(("1", "2", 1, 0, 2, "ok", 2)) == 2
    assert ("1", "3", None, 3, 0, "", 0) in got and ("None", "5", None, 5, 0, "", 0) in got and ("3", "0", None, 0, 0, "", 0) in got
    assert ("1", "5", None, 5, 0, "", 0) in got
    assert threads.link_quotes(df.limit(0)).count() == 0
    assert threads.to_chat(threads.link_quotes(df)).where("msg = 1").first().turn_text == "<|user|>\nfine"


def test_pipeline_stages_on_edges(spark, docs, benchmark, labels, tmp_path):
    for name, frame in (("documents", docs), ("benchmark", benchmark), ("labels", labels)):
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    at = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, at, str(tmp_path))
        if name != "packing":
            assert set(docs.columns) == set(out.columns)
            at = out.cache()
            at.count()
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() >= 0
