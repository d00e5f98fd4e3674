"""The pipeline against a plain version of its stages."""

import numpy as np

import corpus_pipeline
from marketlens.llm import packing, pii, quality
from test_operators import brute_classes, plain_spans

SF = "/root/testdata/sf0.001"


def windows(words, n=13):
    return {tuple(words[i : i + min(n, len(words))]) for i in range(max(1, len(words) - n + 1))} if words else set()


def plain_words(text):
    import re

    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in text))


def test_run_equals_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    judged = quality.classify(docs, spark.read.parquet(f"{SF}/labels.parquet")).where("NOT rejected").collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    ids = sorted(r.doc_id for r in judged)
    lower = ["".join(c.lower() if c.isascii() else c for c in texts[i]) for i in ids]
    ids = [i for k, i in enumerate(ids) if brute_classes_of(lower)[k] == k]
    items = [windows(plain_words(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    every = set().union(*items)
    kept = []
    for i in ids:
        w, hit = plain_words(texts[i]), set()
        for j in range(len(w) - 12):
            if tuple(w[j : j + 13]) in every:
                hit.update(range(j, j + 13))
        if not hit or 20 * len(hit) < len(w):
            kept.append(i)

    pieces = {}
    for r in corpus_pipeline.run(spark, SF).collect():
        pieces.setdefault(r.doc_id, []).append(r)
    assert sorted(pieces) == kept
    vocabulary = packing.vocabulary_path()
    from marketlens.llm.common import token_ids

    for i in kept:
        parts = sorted(pieces[i], key=lambda r: r.start)
        assert sum(r.length for r in parts) == parts[0].doc_tokens
        if "@" not in texts[i] and not any(c.isdigit() for c in texts[i]):
            assert parts[0].doc_tokens == len(token_ids(texts[i], vocabulary, 1))
        redacted = pii.redact(texts[i], plain_spans(texts[i]))
        assert not plain_spans(redacted)
    lengths = {}
    for rows in pieces.values():
        for r in rows:
            lengths[r.sequence_id] = lengths.get(r.sequence_id, 0) + r.length
    assert all(n <= 2048 and n & (n - 1) == 0 for n in lengths.values())
    assert np.mean([n == 2048 for n in lengths.values()]) > 0.5


def test_copies_with_a_fifth_of_new_text_are_dropped(spark):
    words = [f"w{i}" for i in range(400)]
    base, other = words[:80], words[200:280]
    rows = [(1, base), (2, base + words[100:118]), (3, other), (4, other + words[300:322])]  # 76/94 and 76/98 of five words
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    kept = corpus_pipeline.drop_near_copies(spark, docs, SF)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4]


_CACHE = {}


def brute_classes_of(texts):
    key = tuple(map(hash, texts))
    if key not in _CACHE:
        _CACHE[key] = brute_classes(texts)
    return _CACHE[key]
