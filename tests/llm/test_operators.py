"""Operators against brute force, SQL, held-out accuracy and exact round trips."""

import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from check import compare
from marketlens.llm import decontamination, fingerprints, jaccard, langid, maxent, packing, pii, quality, sharding
from marketlens.llm.common import word_codes

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op1_ngram_jaccard_join", "op3_quote_threads", "op6_winnowing_decontamination"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    verdict = compare(queries()[name](spark, SF).toPandas(), con.sql(oracle_sql()[name]).df())
    assert verdict == "ok"


# --- n-gram Jaccard join ---------------------------------------------------------------------


def brute_classes(texts, width=4, num=85, den=100):
    sets = []
    for t in texts:
        w = t.split()
        n = min(width, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
    up = list(range(len(texts)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return [root(i) for i in range(len(texts))]


@pytest.mark.parametrize("block", [4, 256])
def test_jaccard_classes_against_all_pairs(spark, block):
    rng = random.Random(block)
    words = [f"v{i}" for i in range(60)]
    passage = rng.choices(words, k=25)
    texts = []
    for size in (3, 4, 9, 12, 20, 45, 120):
        for _ in range(4):
            base = rng.choices(words, k=size)
            if rng.random() < 0.4:
                base += passage
            for edits in range(7):
                own = list(base)
                for _ in range(edits):
                    own[rng.randrange(len(own))] = rng.choice(words)
                texts.append(" ".join(own))
    texts += ["a b c d e f g h i j k l m n o p"] * 5 + [""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_classes(df, block=block).collect()}
    assert [got[i] for i in range(len(texts))] == brute_classes(texts)


@pytest.mark.parametrize("per_block", [60, 500_000])
def test_links_are_all_counted(spark, per_block):
    rng = random.Random(per_block)
    words = [f"v{i}" for i in range(60)]
    texts = []
    for size in (3, 12, 30, 60, 120):
        base = rng.choices(words, k=size)
        for edits in range(8):
            own = list(base)
            for _ in range(edits % 5):
                own[rng.randrange(len(own))] = rng.choice(words)
            texts.append(" ".join(own))
    texts += ["a b c d e f g h i j k l m n o p"] * 5 + ["", "a b c d e f g h i j k l m n o p q"]
    sets = [{tuple(t.split()[i : i + 4]) for i in range(max(1, len(t.split()) - 3))} if t else set() for t in texts]
    want = [sum(i != j and bool(a) and 100 * len(a & b) >= 85 * len(a | b) for j, b in enumerate(sets)) for i, a in enumerate(sets)]
    rows = [*enumerate(texts), (3, texts[3]), (None, texts[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = jaccard.jaccard_links(df, shingles_per_block=per_block).collect()
    assert len(got) == len(rows) and max(want) > 4
    assert all(r.n_links == (0 if r.doc_id is None else want[r.doc_id]) for r in got)


def test_links_query_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    name = "op1_ngram_jaccard_links"
    assert compare(queries()[name](spark, SF).toPandas(), con.sql(oracle_sql()[name]).df()) == "ok"


def test_linking_sets_share_a_tile_key_and_bitmaps_bound_from_above():
    rng = np.random.default_rng(1)
    bands = jaccard.Bands(85, 100)
    for _ in range(400):
        n = int(rng.integers(7, 300))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        gone, new = int(rng.integers(0, n // 10 + 2)), int(rng.integers(0, n // 10 + 2))
        b = np.unique(np.concatenate([rng.permutation(a)[gone:], rng.integers(0, 2**63, new).astype(np.uint64)]))
        both = jaccard.shared(a, b)
        assert both == len(np.intersect1d(a, b))
        assert jaccard.most_shared(jaccard.bitmap(a), jaccard.bitmap(b), len(a), len(b)) >= both
        if bands.links(both, len(a), len(b)) and not np.array_equal(a, b):
            assert len(np.intersect1d(bands.keys(a), bands.keys(b)))


def test_word_codes_follow_the_bytes():
    texts = [b"The the THE", b"", None, b"\x0bx\x1cy \xc3\x84 a\n", b"x" * 5000]
    codes, _, counts = word_codes(texts)
    assert counts.tolist() == [3, 0, 0, 3, 1] and len(set(codes[:3])) == 1
    again, _, _ = word_codes([b"a x\x1cy"])
    assert again[1] == codes[3] and again[0] == codes[5]


# --- sharding, packing -----------------------------------------------------------------------


def test_sharding_is_longest_first_and_keeps_groups(spark):
    rng = random.Random(3)
    texts = ["x" * rng.randrange(0, 900) + str(i % 150) for i in range(400)] + ["big" * 9000] * 30
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sharding.shard_documents(df, 7).collect()
    assert len({(r.text_sha256, r.shard) for r in rows}) == len({r.text_sha256 for r in rows})
    load = [sum(r.size for r in rows if r.shard == s) for s in range(7)]
    groups = {}
    for r in rows:
        groups[r.text_sha256] = groups.get(r.text_sha256, 0) + r.size
    heap = [0] * 7
    for size in sorted(groups.values(), reverse=True):
        heapq.heapreplace(heap, heap[0] + size)
    assert max(load) == max(heap)
    assert sharding.least_loaded([("a", 5), ("b", 5), ("c", 3), ("d", 2)], 2) == [("a", 0), ("b", 1), ("c", 0), ("d", 1)]


@pytest.mark.parametrize("limits", [(64, 5, 64), (64, 3, 20), (32, 100, 32)])
def test_packer_keeps_all_limits_and_every_id(limits):
    rng = np.random.default_rng(limits[1])
    packer = packing.Packer(*limits, pool=20)
    docs = [rng.integers(0, 50_000, int(rng.integers(1, 200))).astype("<u4") for _ in range(150)]
    skip = [int(rng.integers(0, 30)) for _ in docs]
    pieces = [p for i, d in enumerate(docs) for p in packer.add(i, d, skip[i])] + list(packer.finish())
    got, bins = {}, {}
    for doc, start, length, crc, total, sequence, offset, loss in pieces:
        assert zlib.crc32(docs[doc][start : start + length].tobytes()) == crc and total == len(docs[doc])
        assert loss == max(0, start + length - max(start, skip[doc]))
        got.setdefault(doc, []).append((start, length))
        bins.setdefault(sequence, []).append((offset, length, loss))
    for i, d in enumerate(docs):
        at = 0
        for start, length in sorted(got[i]):
            assert start == at
            at += length
        assert at == len(d)
    for parts in bins.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at & (at - 1) == 0 and at <= limits[0] and len(parts) <= limits[1] and sum(p[2] for p in parts) <= limits[2]


def test_packing_query_holds_the_tokenizer_ids(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    texts[-1] = "a <|endoftext|> b"
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    parts = {}
    for r in packing.pack_documents(df, packing.vocabulary_path()).collect():
        parts.setdefault(r.doc_id, []).append(r)
    for i, text in texts.items():
        ids = np.asarray([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
        assert sum(r.length for r in parts[i]) == len(ids)
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in parts[i])


def test_each_limit_of_the_packing_query_closes_sequences(spark):
    filled = {}
    for r in queries()["op5_vector_packing"](spark, "/root/testdata/sf0.01").collect():
        n = filled.setdefault(r.sequence_id, [0, 0, 0])
        n[0], n[1], n[2] = n[0] + r.length, n[1] + 1, n[2] + r.loss_tokens
    tokens, segments, loss = zip(*filled.values())
    assert (max(tokens), max(segments), max(loss)) == (2048, 8, 1920)
    assert sum(x == 1920 for x in loss) > 50 and sum(x == 8 for x in segments) > 1
    assert all(n & (n - 1) == 0 for n in tokens) and np.mean([n == 2048 for n in tokens]) > 0.9


def test_prompts_are_first_lines(spark):
    rows = [(1, "one two three\nfour five"), (2, "no prompt"), (3, None), (4, ""), (5, "\nstarts empty")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    free = Counter()
    for r in packing.pack_with_prompts(df, packing.vocabulary_path()).collect():
        free[r.doc_id] += r.length - r.loss_tokens
    assert free == {1: 3, 2: 0, 3: 0, 4: 0, 5: 0}
    odd = spark.createDataFrame([(1, "a b c", -4), (2, "a b c", None), (3, "a b c", 99)], "doc_id long, text string, skip int")
    bearing = Counter()
    for r in packing.pack_documents(odd, packing.vocabulary_path(), loss_from_col="skip").collect():
        bearing[r.doc_id] += r.loss_tokens
    assert bearing == {1: 4, 2: 4, 3: 0}


# --- quality, language model, language -------------------------------------------------------


def test_kneser_ney_probabilities_add_up_to_one(spark):
    texts = ["abracadabra", "alakazam", "abrakadabra alakazam", "bar", "zebra"] * 3 + ["cab"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    smoothed = quality.smooth(quality.count_ngrams(df, 3), 3)
    model = quality.Model(smoothed)
    seen = [ord(r.gram) for r in smoothed[0][0].collect()]
    for context in ("ab", "zz", "q?", "ka"):
        total = 0.0
        for c in [*seen, ord("?")]:  # "?" stands for all that was not seen
            points = np.array([*map(ord, context), c], np.uint32)
            total += math.exp(float(model.log_p(points)[0]))
        assert total == pytest.approx(1.0, abs=1e-4)
    sizes, costs, _ = quality.Scorer(model, None, 4).score(["abracadabra", None, "", "qqqq"])
    assert sizes == [12, 0, 0, 5] and costs[0] / 12 < costs[3] / 5 and costs[1] == 0


def test_quality_rejects_junk_and_keeps_clean_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality.classify(docs, labels).join(labels, "doc_id").toPandas()
    clean, junk = got[(got.quality == 1) & (got.toxic == 0)], got[got.quality == 0]
    assert clean.rejected.mean() <= 0.01 and junk.rejected.mean() >= 0.8


def test_quality_rejects_toxic_documents(spark):
    """English labels, where toxic texts hold toxic words; those not in the training half."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = quality.classify(docs, labels).join(labels, "doc_id").join(docs.select("doc_id", quality.in_sample(0.5).alias("taught")), "doc_id").toPandas()
    held = got[(~got.taught) & (got.quality == 1)]
    clean, toxic = held[held.toxic == 0], held[(held.toxic == 1) & (held.lang == "en")]
    assert len(toxic) > 100 and toxic.rejected.mean() >= 0.95 and clean.rejected.mean() <= 0.01
    print({x: round(held[(held.toxic == 1) & (held.lang == x)].rejected.mean(), 3) for x in ("en", "de", "fr", "es")}, clean.rejected.mean())


def test_worst_stretch_is_whole(spark, monkeypatch):
    df = spark.createDataFrame([("abcabcabd",), ("abdabd xyz",)], "text string")
    a, b = (quality.Model(quality.smooth(quality.count_ngrams(df.where(F.col("text").contains(x)), 3), 3)) for x in ("abc", "xyz"))
    text = "abc xyzabd" * 30
    plain = b.log_p(quality.padded(text, 3)).astype(float) - a.log_p(quality.padded(text, 3))
    want = max(plain[i : i + 7].sum() for i in range(len(plain) - 6))
    for piece in (3, 10, 64, 10**6):
        monkeypatch.setattr(quality, "_PIECE", piece)
        sizes, costs, worst = quality.Scorer(a, b, 7).score(["", text, None, "ab", text])
        assert sizes == [0, 301, 0, 3, 301] and worst[1] == pytest.approx(want) == worst[4] and worst[0] == 0.0
        assert costs[1] == pytest.approx(-a.log_p(quality.padded(text, 3)).astype(float).sum(), rel=1e-5)
    assert quality.Scorer(a, None, 7).score([text])[2] == [0.0]


def test_smoothing_against_plain_kneser_ney(spark):
    """Interpolated modified Kneser-Ney by the book, over a few texts."""
    from collections import Counter

    rng = random.Random(4)
    texts = ["".join(rng.choices("abcd ", k=rng.randrange(1, 40))) for _ in range(30)]
    order = 3
    pad = lambda t: "\x02" * (order - 1) + t + "\x03"
    counts = [Counter(p[i : i + order] for p in map(pad, texts) for i in range(len(p) - order + 1))]
    while len(counts) < order:
        counts.insert(0, Counter(g[1:] for g in counts[0]))

    def probability(gram):
        if not gram:
            return 1.0 / (len(counts[0]) + 1)
        own = counts[len(gram) - 1]
        spread = Counter(own.values())
        n = [spread[i] for i in (1, 2, 3, 4)]
        off = quality.discounts(n)
        same = {g: c for g, c in own.items() if g[:-1] == gram[:-1]}
        if not same:
            return probability(gram[1:])
        take = lambda c: off[min(c, 3) - 1]
        left = sum(map(take, same.values())) / sum(same.values())
        held = same.get(gram, 0)
        return (held - take(held) if held else 0.0) / sum(same.values()) + left * probability(gram[1:])

    df = spark.createDataFrame([(t,) for t in texts], "text string")
    model = quality.Model(quality.smooth(quality.count_ngrams(df, order), order))
    for text in [*texts[:5], "zz", "abz cd", "d" * 9]:
        p = pad(text)
        want = [math.log(probability(p[i - order + 1 : i + 1])) for i in range(order - 1, len(p))]
        assert model.log_p(quality.padded(text, order)) == pytest.approx(want, rel=1e-4)


def test_all_labelled_texts_teach_and_none_judges_itself(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choices("abcdé 5", k=rng.randrange(1, 60))) for _ in range(120)] + ["", None, "\U0001f600 ab" * 30]
    docs = spark.createDataFrame([(i, t, "xx") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    good, bad = (docs.where(f"doc_id % 4 {x}").select("doc_id") for x in ("< 2", "= 2"))
    order, window = 4, 5
    taught = quality.lessons(docs, good, bad)
    counts = quality.count_ngrams(taught, order)
    want = sum(len(t) + 1 for i, t in enumerate(texts) if t and i % 4 < 3)
    assert counts.groupBy().sum("n").first()[0] == want
    models = [quality.Model(quality.smooth(quality.count_ngrams(taught.where(f"model = {m}").select("text"), order), order)) for m in range(3)]
    assert all(m.known for m in models)
    half = {r.doc_id: r.own for r in docs.select("doc_id", quality.in_sample(0.5).cast("int").alias("own")).collect()}
    got = {r.doc_id: r for r in quality.score(docs, quality.smooth(counts, order), window, batch_bytes=700).collect()}
    assert len(got) == len(texts) and all(r.judged for r in got.values())
    for i, text in enumerate(texts):  # by the trusted model that the text did not teach
        (size,), (cost,), (worst,) = quality.Scorer(models[1 - half[i]], models[quality.TOXIC], window).score([text])
        assert got[i].symbols == size and got[i].cost == pytest.approx(cost, rel=1e-4) and got[i].worst == pytest.approx(worst, rel=1e-3, abs=1e-3)


def test_what_is_kept_for_quality_is_packed(spark, monkeypatch):
    """No row an n-gram of the full length, in whatever is kept between the steps; pairs at most."""
    rng = random.Random(11)
    texts = ["".join(rng.choices("abcdefgh ", k=200)) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, "xx") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), int(i % 3 == 0)) for i in range(60)], "doc_id long, quality int, toxic int")
    longest, hold = [], quality.keep

    def keep(df):
        if "gram" in df.columns:
            longest.append(df.agg(F.max(F.length("gram"))).first()[0])
        return hold(df)

    monkeypatch.setattr(quality, "keep", keep)
    assert quality.classify(docs, labels).count() == 60
    assert longest and max(x or 0 for x in longest) <= 2


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_shards_and_plain_tables_give_the_same_scores(spark, order):
    rng = random.Random(order)
    texts = ["".join(rng.choices("abcdé 5", k=rng.randrange(1, 60))) for _ in range(40)] + ["", None]
    docs = spark.createDataFrame([(i, t, "xx") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    good, bad = (docs.where(f"doc_id % 4 {x}").select("doc_id") for x in ("< 2", "= 2"))
    taught = quality.lessons(docs, good, bad)
    models = [quality.Model(quality.smooth(quality.count_ngrams(taught.where(f"model = {m}").select("text"), order), order)) for m in range(3)]
    half = {r.doc_id: r.own for r in docs.select("doc_id", quality.in_sample(0.5).cast("int").alias("own")).collect()}
    for r in quality.score(docs, quality.Lessons(taught, order), 5, batch_bytes=500).collect():
        (size,), (cost,), (worst,) = quality.Scorer(models[1 - (half[r.doc_id] or 0)], models[quality.TOXIC], 5).score([texts[r.doc_id]])
        assert (r.symbols, r.judged) == (size, True) and r.cost == pytest.approx(cost, rel=1e-4) and r.worst == pytest.approx(worst, rel=1e-3, abs=1e-3)


def test_packed_numbers_come_back():
    grams = np.arange(35, dtype=np.uint32).reshape(7, 5) * 77_777
    assert (quality.unpack(quality.pack(grams), np.uint32, 5) == grams).all()
    for kind in (np.int64, np.float32):
        values = np.array([1, 2**33, 0, -5], kind)
        assert (quality.unpack(quality.pack(values), kind, 1) == values).all()
        assert len(quality.unpack(quality.pack(values[:0]), kind, 1)) == 0


def test_grams_of_many_letters_are_counted_alike():
    rng = random.Random(3)
    parts = [quality.padded("".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(9000)) * 2, 5), quality.padded("ab", 5)]
    got = quality.distinct_grams(parts, 5)
    few = quality.distinct_grams(parts[1:], 5)
    assert int(got[1].sum()) == 18_001 + 3 and int(few[1].sum()) == 3
    assert {tuple(x) for x in few[0].tolist()} == {tuple(parts[1][i : i + 5].tolist()) for i in range(3)} <= {tuple(x) for x in got[0].tolist()}


def test_language_model_against_plain_counts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r for r in queries()["op7_maxent_lm"](spark, SF).collect()}
    words = {r.doc_id: [*(r.text or "").encode().lower().split(), None] for r in docs.collect()}
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in words}
    count = {}
    for i, w in words.items():
        for x in w if not out[i] else ():
            count[x] = count.get(x, 0) + 1
    n, v = sum(count.values()), len(count)
    for i, w in words.items():
        r = got[i]
        base = sum(math.log10((count.get(x, 0) + 1) / (n + v + 1)) for x in w)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out[i], len(w), sum(x in count for x in w), n)
        assert r.base_score == pytest.approx(base)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_language_model_gradient_and_normalisation():
    rng = np.random.default_rng(0)
    weights = rng.normal(0, 0.1, (maxent.CLASSES, maxent.ROWS)).astype(np.float32)
    code, sizes = maxent.tokens([b"a b a c a b", b"", b"the a b a c"])
    assert sizes.tolist() == [7, 1, 6] and (code == maxent.END).sum() == 3
    z = maxent.scores(weights, maxent.features(code, sizes))
    p = np.exp(z) / np.exp(z).sum(axis=0)
    assert p.sum(axis=0) == pytest.approx(np.ones(len(code)), abs=1e-4)
    target = maxent.classes_of(code)

    def loss(w):
        z = maxent.scores(w, maxent.features(code, sizes))
        return float((np.log(np.exp(z).sum(axis=0)) - z[target, np.arange(len(target))]).sum())

    before, trained = loss(weights), weights.copy()
    for _ in range(5):
        maxent.gradient_steps(trained, code, sizes, np.ones(maxent.ROWS, np.float32))
    assert loss(trained) < before


def test_language_model_against_plain_counts_and_softmax(spark):
    """Every score again by dictionaries: counts of pairs by (word before, class), and the class softmax one token at a time."""
    texts = ["a rose is a rose is a rose", "the rose is red the sky is blue", "a rose is blue", "", None, "the the the", "a rose was new"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    held = {3, 6}
    got = {r.doc_id: r.score for r in maxent.score_texts(docs, F.col("doc_id").isin(*held), rounds=2).collect()}
    batched = maxent._batched(docs, F.col("doc_id").isin(*held), 2)
    counts = maxent.Counts(maxent._answers(maxent._requests(batched, 2), 2))
    weights = maxent.train(docs.where(~F.col("doc_id").isin(*held)), counts, 2)
    words = {i: maxent.tokens([(t or "").encode()])[0].tolist() for i, t in enumerate(texts)}
    single, pair = Counter(), Counter()
    for i, w in words.items():
        if i not in held:
            single.update(w)
            pair.update(zip([0, *w], w))
    once, twice = (sum(n == k for n in pair.values()) for k in (1, 2))
    off = once / (once + 2 * twice)
    assert (counts.tokens, counts.distinct, counts.off) == (sum(single.values()), len(single), pytest.approx(off))

    def word(prev, w):
        c = w & 63
        mine = {x: n for x, n in single.items() if x & 63 == c}
        alone = (single[w] + 1) / (sum(mine.values()) + len(mine) + 1)
        after = [n for (a, b), n in pair.items() if a == prev and b & 63 == c]
        return (max(pair[prev, w] - off, 0) + off * len(after) * alone) / sum(after) if after else alone

    for i, w in words.items():
        code, sizes = maxent.tokens([(texts[i] or "").encode()])
        total = 0.0
        for k, f in enumerate(maxent.features(code, sizes).T):
            z = weights[:, 0] + sum(weights[:, j] for j in f)
            total += float(z[w[k] & 63] - np.log(np.exp(z).sum())) + math.log(word(w[k - 1] if k else 0, w[k]))
        assert got[i] == pytest.approx(total / math.log(10), abs=1e-3)
    unseen = 1  # of class c, a word that the corpus does not hold
    for prev in (0, *single):
        for c in {x & 63 for x in single}:
            mine = [x for x in single if x & 63 == c]
            assert sum(word(prev, x) for x in mine) + word(prev, (unseen << 6) | c) == pytest.approx(1)


def test_pair_weights_are_where_the_gradient_vanishes():
    """The softmax over the words seen after another and "another", with the counts left out one at a time."""
    n, off = np.array([5.0, 2.0, 1.0, 1.0]), 0.6
    theta = np.log(np.append(n - off, off * len(n)))
    p = np.exp(theta) / np.exp(theta).sum()
    goal = np.append(n - off, off * len(n))
    assert goal - goal.sum() * p == pytest.approx(np.zeros(5), abs=1e-9)
    alone = np.array([0.1, 0.2, 0.05, 0.01])
    found = maxent.in_class(alone, n, np.full(4, n.sum()), np.full(4, len(n)), off)
    assert found == pytest.approx(p[:4] + p[4] * alone)


def test_packed_counts_round_trip():
    for values in ([], [0, 1, 254, 255, 256, 10**12, 3], [255] * 9):
        x = np.array(values, np.int64)
        assert maxent.unpacked(maxent.packed(x), len(x)).tolist() == values


def test_language_model_gains_from_context(spark):
    rows = queries()["op7_maxent_lm"](spark, "/root/testdata/sf0.01").where("held_out").collect()
    tokens = sum(r.n_tokens for r in rows)
    assert sum(r.score - r.base_score for r in rows) / tokens / math.log10(2) > 1  # bits a token


def test_language_ids_on_held_out_documents(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    got = queries()["op8_rank_order_langid"](spark, "/root/testdata/sf0.01").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.98 * len(held)


def test_ranks_and_distance_by_hand():
    a = langid.grams(langid.code_points("Ab, ab!"))
    assert sorted(a.tolist()) == sorted(
        [97, 98, 97, 98, 97, 97 << 21 | 98, 98 << 21, 97, 97 << 21 | 98, 98 << 21, 97 << 21 | 98, (97 << 21 | 98) << 21, 97 << 21 | 98, (97 << 21 | 98) << 21]
    )
    profiles = langid.Profiles([("x", 97, 0), ("x", 98, 1), ("y", 98, 0), ("y", 99, 1)], 2)
    assert profiles.predict("aab")[0] == "x" and profiles.predict("bbc")[0] == "y"
    assert profiles.predict("12 ?") == ("und", 0.0) and profiles.predict(None) == ("und", 0.0)


# --- personal data ---------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    found = []
    for kind, (name, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            ok = {
                "email": lambda m=m: True,
                "ip": lambda m=m: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda d=digits, t=twice: 12 <= len(d) <= 19 and sum(x - 9 if x > 9 else x for x in t) % 10 == 0,
                "phone": lambda d=digits: 9 <= len(d) <= 15,
            }[name]()
            if ok:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(11)
    parts = ["a.b@c.d", "@", "x@", "@y.z", "1.2.3.4", "999.1.1.1", "1.2.3.4.5", "4111 1111 1111 1111", "4791583008326837", "+1 (202) 555-0100",
             "+", "555-0100", " ", ".", "-", "é", "_d@e.f", "00000000000000000000", "(", "12", "\n", "a%+-", "..", "1", "0001.02.3.4"]
    for _ in range(4000):
        text = "".join(rng.choices(parts, k=rng.randrange(1, 12)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_labels_reach_distant_tokens(spark):
    def line(i):
        return f"call +1 (2{i:02d}) 555-{1000 + i} or mail user{i}@mail.example today, box 77 on page {i} of 300"

    rows = [(i, line(i) + " and again 555-" + str(1000 + i) if i % 2 else line(i)) for i in range(60)]
    rows.append((99, "mail first.last7@mail.example please\nwrote: first.last7 " + "x " * 500 + "order 123456 from 2020"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in pii.find(df, pii.fit(df)).collect()}
    for i, text in rows:
        r = found[i]
        spans = list(zip(r.starts, r.kinds, r.ends, r.based))
        assert sorted(s[:3] for s in spans if s[3]) == plain_spans(text)
        for start, _, end, based in spans:
            if not based:
                assert text[start:end] in (f"555-{1000 + i}", "first.last7")
    again = [i for i, text in rows if "again" in text]
    hit = [i for i in again if any(not b for b in found[i].based)]
    assert len(hit) >= 0.9 * len(again)


def test_labels_reach_all_of_many_repeats(spark):
    def line(i):
        return f"call +1 (2{i:02d}) 555-{1000 + i} or mail user{i}@mail.example today, box 77 on page {i} of 300"

    rows = [(i, line(i) + (" and again 555-" + str(1000 + i) if i % 2 else "")) for i in range(60)]
    potentials = pii.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    for n in (1, 50, 1000):
        text = "call +1 (207) 555-1007 now " + "then word 555-1007 more " * n + "order 123456 from 2020 " * 50
        added = potentials.added(text, pii.base_spans(text))
        assert len(added) == n and all(text[a:z] == "555-1007" for a, _, z in added)


def test_a_hundred_thousand_repeats_take_seconds(spark):
    import time

    line = lambda i: f"call +1 (2{i:02d}) 555-{1000 + i} or mail user{i}@mail.example, box 77 on page {i}"
    long = "call +1 (207) 555-1007 now " + "then 555-1007 more " * 100_000
    rows = [(i, line(i) + (" and again 555-" + str(1000 + i) if i % 2 else "")) for i in range(60)] + [(99, long)]
    start = time.time()
    graph = pii.Graph(long, pii.base_spans(long))
    assert len(graph.unlabelled()) == 100_000
    potentials = pii.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    added = potentials.added(long, pii.base_spans(long))
    assert len(added) == 100_000 and time.time() - start < 40


def test_messages_are_exact_on_a_tree():
    """On a chain with a far edge and no loop, marginals equal the sums over all labellings."""
    import itertools

    text = "a1b2c 12345 x9 and far away 4444444 zz 4444444"
    graph = pii.Graph(text, [])
    graph.star = []
    rng = np.random.default_rng(3)
    potentials = pii.Potentials({(f, y): int(rng.integers(1, 9)) for f in graph.forms for y in range(pii.LABELS)}, {(0, 1): 5, (1, 1): 3}, {(1, 1): 4})
    n, unary = len(graph.forms), potentials.unary(graph)
    assert graph.skip and len(graph.chain) + len(graph.skip) < n
    total = np.zeros((n, pii.LABELS))
    for labels in itertools.product(range(pii.LABELS), repeat=n):
        energy = sum(unary[i, y] for i, y in enumerate(labels)) + sum(potentials.chain[labels[a], labels[b]] for a, b in graph.chain)
        weight = math.exp(energy + sum(potentials.skip[labels[a], labels[b]] for a, b in graph.skip))
        for i, y in enumerate(labels):
            total[i, y] += weight
    assert np.allclose(potentials.marginals(graph), total / total.sum(1, keepdims=True), atol=1e-4)


def test_redaction_leaves_no_base_span(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = pii.redact_documents(docs, pii.fit(docs)).collect()
    assert not any(pii.base_spans(r.text) for r in out) and all(r.n_chars == len(r.text) for r in out)


def test_repeated_words_multiply_nothing(spark):
    import time

    con = duckdb.connect()
    took = {}
    for name, word in (("distinct", lambda i: f"w{i}"), ("one", lambda i: "na")):
        text = " ".join(word(i) for i in range(4000))
        rows = [(1, text), (2, "x " * 30 + text), (3, "nothing in common here"), (4, " ".join(word(i) for i in range(12)))]
        items = [("a", text), ("b", " ".join(word(i) for i in range(100)) + " tail"), ("c", "na na na")]
        docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string")
        start = time.time()
        got = decontamination.contamination(docs, bench).drop("text_key").toPandas()
        took[name] = time.time() - start
        if name == "one":
            assert {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in got.itertuples()} == {1: (4000, 4000, 3), 2: (4030, 4000, 3), 3: (4, 0, 0), 4: (12, 12, 1)}
    assert took["one"] < 2 * took["distinct"] + 5


# --- fingerprints ----------------------------------------------------------------------------


def test_fingerprints_of_edited_texts(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries()["op10_multiset_fingerprint"](spark, SF).collect()}
    order = sorted(docs, reverse=True)
    for k, i in enumerate(order):
        text, following = docs[i], docs[order[(k + 1) % len(order)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[i].n_chars == len(text)
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    by_text = {}
    for i, text in docs.items():
        assert by_text.setdefault(text, got[i].fingerprint) == got[i].fingerprint
    assert len(set(by_text.values())) == len(by_text)


def test_fingerprints_add_and_forget_order(spark):
    lines = [f"Line number {i} of many." for i in range(40)]
    rows = [("whole", "\n".join(lines)), ("mixed", "\n".join(lines[::-1])), ("first", "\n".join(lines[:30])), ("rest", "\n".join(lines[30:])), ("none", "")]
    df = fingerprints.fingerprint(spark.createDataFrame(rows, "name string, text string"), "text", "f")
    wide = df.groupBy().pivot("name", [r[0] for r in rows]).agg(F.first("f"))
    c = F.col
    got = wide.select(
        (c("whole") == c("mixed")).alias("order"),
        (fingerprints.insert(c("first"), c("rest")) == c("whole")).alias("insert"),
        (fingerprints.delete(c("whole"), c("rest")) == c("first")).alias("delete"),
        fingerprints.likeness(c("whole"), c("first")).alias("part"),
        fingerprints.likeness(c("first"), c("rest")).alias("apart"),
        fingerprints.likeness(c("none"), c("none")).alias("nothing"),
        fingerprints.likeness(c("whole"), c("none")).alias("all_gone"),
    ).first()
    assert got.order and got.insert and got["delete"] and got.nothing == 1 and got.all_gone == 0
    assert got.part == pytest.approx(60 / 70, abs=0.2) and got.apart < 0.4


# --- decontamination -------------------------------------------------------------------------


def test_decontamination_with_short_items_and_repeats(spark):
    rng = random.Random(8)
    words = [f"v{i}" for i in range(12)]
    items = [(i, " ".join(rng.choices(words, k=k))) for i, k in enumerate((1, 2, 3, 5, 12, 13, 14, 20, 40))]
    docs = []
    for i in range(60):
        body = rng.choices(words, k=rng.randrange(0, 60))
        for _ in range(rng.randrange(3)):
            item = rng.choice(items)[1].split()
            a = rng.randrange(len(item))
            at = rng.randrange(len(body) + 1)
            body[at:at] = item[a : a + rng.randrange(1, 30)]
        docs.append((i, ", ".join(body).upper()))
    got = {r.doc_id: r for r in decontamination.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    for i, text in docs:
        w = re.findall(r"[a-z0-9]+", text.lower())
        hit, found = set(), set()
        for item, t in items:
            own = t.split()
            n = min(13, len(own))
            windows = {tuple(own[j : j + n]) for j in range(len(own) - n + 1)}
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in windows:
                    hit.update(range(j, j + n))
                    found.add(str(item))
        r = got[i]
        assert (r.n_words, r.n_hit, r.n_items) == (len(w), len(hit), len(found))
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(w))
