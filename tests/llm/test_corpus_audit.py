"""Importance resampling, source divergence and the archive against plain versions, SQL and edge rows."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from check import compare
from marketlens.llm import archive, divergence, importance

SF = "/root/testdata/sf0.001"
NAMES = ["op11_importance_resampling", "op12_source_divergence", "op13_warc_archive"]


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = queries()[name](spark, SF).toPandas(), con.sql(oracle_sql()[name]).df()
    for c in want.columns:  # pandas holds whole numbers with nulls as floats
        if got[c].dtype == float:
            got[c] = got[c].astype("Int64")
    assert len(got) and compare(got, want) == "ok"


LONG = " ".join(random.Random(3).choices([f"w{i}é" for i in range(300)] + ["Straße", "naïve"], k=200_000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog " * 5, "en", "a"),
    (2, None, "en", "a"),
    (3, "", "en", "b"),
    (4, " \n\t ...--- ", None, "b"),
    (5, LONG, "en", "b"),
    (6, "The quick brown fox jumps over the lazy dog " * 5, None, None),
    (6, "The quick brown fox jumps over the lazy dog " * 5, None, None),
    (None, "one two three " * 9, "de", "c"),
    (None, None, None, None),
    (8, "İstanbul K KELVIN ÄÖ ſ x\x00y\x85z\xa0q", "de", "c"),
    (9, "The THE the", "en", "c"),
    (10, "the fox", "en", "a"),
    (11, "xx" * 700_000, "xx", "lone"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
CLASH = "n part rank bucket shard term v total address payload header before value record_no sha1 refers_to".split()


def clashing(df):
    return df.withColumns({c: F.lit(f"other {c}") for c in CLASH})



@pytest.fixture(scope="module")
def docs(spark):
    return clashing(spark.createDataFrame(ROWS, SCHEMA)).repartition(3, "text").cache()


def words_of(text, pattern):
    return re.findall(pattern, "".join(c.lower() if c.isascii() else c for c in text or ""))


# --- importance resampling -------------------------------------------------------------------


def plain_resample(rows, target, min_words=20, num=5, den=100):
    def grams(text):
        w = [x.encode() for x in words_of(text, r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")]
        return len(w), [zlib.crc32(b" ".join(w[i : i + n])) % 10_000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]

    s, t = Counter(b for r in rows for b in grams(r[1])[1]), Counter(b for x in target for b in grams(x)[1])
    big_s, big_t = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    gain = [math.floor(1000 * math.log((t[b] + 1) * big_s / ((s[b] + 1) * big_t))) for b in range(10_000)]
    scored = []
    for doc_id, text, *_ in rows:
        n, buckets = grams(text)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in buckets)
        scored.append([doc_id, n, len(buckets), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    fits = sorted((r for r in scored if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    ranks = {id(r): k + 1 for k, r in enumerate(fits[: num * len(fits) // den])}
    return sorted((str(r[0]), *r[1:], ranks.get(id(r), 0)) for r in scored)


def found_rows(df):
    return sorted((str(r.doc_id), r.n_words, r.n_features, r.weight, r.score, r["rank"] or 0) for r in df.collect())


def test_resample_against_plain(spark, docs):
    target = ["the lazy dog", None, "", "quick brown fox jumps", "the lazy dog"]
    frame = spark.createDataFrame([(x,) for x in target], "text string")
    assert found_rows(importance.resample(docs, frame)) == plain_resample(ROWS, target)
    half = importance.resample(docs, frame, min_words=2, num=1, den=2)
    assert found_rows(half) == plain_resample(ROWS, target, 2, 1, 2)
    assert found_rows(importance.resample(docs, frame.limit(0))) == plain_resample(ROWS, [])
    assert importance.resample(docs.limit(0), frame).count() == 0


def test_long_texts_give_the_same_codes_in_runs(spark):
    text = LONG.encode()[:20_001]
    whole = sorted(c for _, x in importance.feature_codes(text) for c in x.tolist())
    for most in (1, 7, 100, 5000):
        parts = list(importance.feature_codes(text, most=most))
        assert sorted(c for _, x in parts for c in x.tolist()) == whole
        assert sum(n for n, _ in parts) == len(importance.runs_of_words(text).__next__())
    for order in (1, 2, 4):
        w = next(importance.runs_of_words(text))
        want = sorted(zlib.crc32(b" ".join(w[i : i + n])) for n in range(1, order + 1) for i in range(len(w) - n + 1))
        assert sorted(c for _, x in importance.feature_codes(text, order, 64) for c in x.tolist()) == want


def test_ranks_have_no_gaps_over_many_ranges(spark):
    rows = [(i, 30, 1, i % 7, i % 7) for i in range(2000)] + [(None, 30, 1, 6, 6), (5, 3, 1, 9, 9)]
    scored = spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long, score long").repartition(5)
    got = {r.doc_id: r["rank"] for r in importance.draw(scored, 20, 1, 3, rows_per_part=150).where("rank IS NOT NULL").collect()}
    best = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))[: 2001 // 3]
    assert got == {r[0]: k + 1 for k, r in enumerate(best)}


# --- source divergence -----------------------------------------------------------------------


def plain_audit(rows, min_docs=3, top=200):
    texts = [(lang or "", source or "", words_of(text, r"[^\x00-\x40\x5b-\x60\x7b-\x7f]+")) for _, text, lang, source in rows]
    held, groups = defaultdict(Counter), defaultdict(lambda: defaultdict(Counter))
    for lang, source, w in texts:
        held[lang].update(set(w))
        groups[lang][source].update(w)
    out = set()
    for lang, sources in groups.items():
        kept = sorted(t for t, n in held[lang].items() if n >= min_docs)

        def share(counter):
            n = sum(counter[t] for t in kept)
            return {t: 1 + 10**9 * (counter[t] + 1) // (n + len(kept)) for t in kept}

        p = {s: share(c) for s, c in sources.items()}
        q = share(sum(sources.values(), Counter()))
        for s in sources:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if sources[s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit]
                out |= {(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(ranked)}
    return out


def found_items(df):
    rows = [tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_audit_against_plain(spark, docs):
    assert found_items(divergence.audit(docs)) == plain_audit(ROWS)
    assert found_items(divergence.audit(docs, min_docs=1, top=5)) == plain_audit(ROWS, 1, 5)
    assert divergence.audit(docs.limit(0)).count() == 0
    assert divergence.audit(docs, min_docs=10**6).where("value <> 0 OR part <> 'pair'").count() == 0


def test_many_shards_rounds_and_flushes_change_nothing(spark, monkeypatch):
    rng = random.Random(11)
    terms = [f"{a}{b}{c}" for a in "abcdé" for b in "abcdß" for c in "abcdx"]
    rows = [(i, " ".join(rng.choices(terms, weights=range(1, 126), k=rng.randrange(1, 60))), rng.choice(["en", "fr", None]), rng.choice("xyz")) for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = plain_audit(rows)
    assert found_items(divergence.audit(docs, shard_terms=16)) == want
    assert found_items(divergence.audit(docs, shard_terms=16, broadcast_bytes=700)) == want
    monkeypatch.setattr(divergence, "HELD_TERMS", 20)
    monkeypatch.setattr(divergence, "HELD_NUMBERS", 50)
    monkeypatch.setattr(divergence, "SMALL_ROWS", 1)
    assert found_items(divergence.audit(docs)) == want


def test_perfect_hash_is_minimal_and_knows_its_keys():
    from types import SimpleNamespace

    rng = random.Random(2)
    for n in (1, 2, 3, 50, 3000):
        terms = list({bytes(rng.choices(b"abcdef\xc3\xa9", k=rng.randrange(1, 12))) for _ in range(n)})
        deal = {0: [], 1: [], 2: []}
        for t in terms:
            deal[zlib.crc32(t) % 3].append(t)
        rows = []
        for shard, mine in deal.items():
            if mine and shard != 1:  # one shard is of another round
                ordered, seeds = divergence.build_hash(mine)
                assert sorted(ordered) == sorted(mine)
                lengths = np.array([len(t) for t in ordered], np.int32)
                rows.append(SimpleNamespace(shard=shard, n=len(mine), seeds=seeds.tobytes(), lengths=divergence._pack(lengths), keys=b"".join(ordered)))
        if not rows:
            continue
        v = divergence.Vocabulary(3, rows)
        crc = lambda ts: np.array([zlib.crc32(t) for t in ts])
        slots = v.lookup(terms, crc(terms))
        inside = [zlib.crc32(t) % 3 != 1 for t in terms]
        assert sorted(slots[inside].tolist()) == list(range(v.slots)) and (slots[~np.array(inside)] == -1).all()
        others = [t + b"z" for t in terms] + [t[:-1] + b"y" for t in terms]
        assert (v.lookup(others, crc(others)) == -1).all()


def test_shares_are_exact_for_large_counts():
    counts = [0, 1, 9_300_000_000, 4 * 10**15]
    got = divergence.shares(np.array(counts), sum(counts) + 4)
    assert got.tolist() == [1 + 10**9 * (c + 1) // (sum(counts) + 4) for c in counts]
    assert divergence.shares(np.array([5]), 6).tolist() == [10**9 + 1]


# --- archive ---------------------------------------------------------------------------------

PAGES = [
    (5, "http://a/", "<p>same</p>"), (3, "http://b/", "<p>same</p>"), (9, None, "<p>same</p>"), (1, "http://c/\r\nWARC-Type: odd", "x\r\n\r\nWARC/1.1\r\n"),
    (2, "", None), (4, "http://d/", ""), (None, "http://e/", "<p>same</p>"), (None, "http://f/", "alone é\x00"), (7, "http://g/", "twice"),
    (7, "http://g/", "twice"), (8, "http://h/", "y" * 3_000_000),
]


@pytest.fixture(scope="module")
def pages(spark):
    return clashing(spark.createDataFrame(PAGES, "page_id long, url string, html string")).repartition(3)


def test_archive_round_trip(spark, pages, tmp_path):
    archive.write_archive(pages, f"{tmp_path}/a")
    rows = archive.read_archive(spark, f"{tmp_path}/a", with_payload=True).collect()
    assert sorted((str(r.page_id), bytes(r.payload)) for r in rows) == sorted((str(i), (t or "").encode()) for i, _, t in PAGES)
    assert spark.read.parquet(f"{tmp_path}/a/payloads").count() == len({t or "" for *_, t in PAGES})
    for r in rows:
        (fields, record, block), *more = archive.records_of(bytes(r.record))
        assert not more and record == bytes(r.record) and fields["WARC-Type"] == r.record_type
        sha1 = base64.b32encode(hashlib.sha1(bytes(r.payload)).digest()).decode()
        assert r.payload_digest == sha1 and fields["WARC-Payload-Digest"] == f"sha1:{sha1}" and r.payload_bytes == len(r.payload)
        http, body = block.split(archive.END, 1)
        assert http.startswith(b"HTTP/1.1 200 OK") and body == (bytes(r.payload) if r.record_type == "response" else b"")
        assert ("WARC-Refers-To" in fields) == (r.record_type == "revisit")
    together = b"".join(bytes(r.record) for r in rows)
    assert [record for _, record, _ in archive.records_of(together)] == [bytes(r.record) for r in rows]
    kinds = sorted((str(r.page_id), r.record_type, r.refers_to or 0) for r in rows)
    assert kinds == sorted([
        ("5", "revisit", 3), ("3", "response", 0), ("9", "revisit", 3), ("1", "response", 0), ("2", "response", 0), ("4", "revisit", 2),
        ("None", "revisit", 3), ("None", "response", 0), ("7", "response", 0), ("7", "revisit", 7), ("8", "response", 0),
    ])


def test_small_payloads_and_empty_tables(spark, pages, tmp_path):
    archive.write_archive(pages, f"{tmp_path}/a", min_bytes=6)
    rows = archive.read_archive(spark, f"{tmp_path}/a").collect()
    assert sorted(r.page_id or 0 for r in rows if r.record_type == "revisit") == [0, 5, 9]
    archive.write_archive(pages.limit(0), f"{tmp_path}/b")
    assert archive.read_archive(spark, f"{tmp_path}/b").count() == 0


def test_damage_is_found(spark, pages, tmp_path):
    archive.write_archive(pages, f"{tmp_path}/a")
    stored = spark.read.parquet(f"{tmp_path}/a/payloads")
    bad = F.when(F.octet_length("payload") == 5, F.lit(b"thrice")).otherwise(F.col("payload"))
    spark.read.parquet(f"{tmp_path}/a/headers").write.parquet(f"{tmp_path}/b/headers")
    stored.withColumn("payload", bad).write.parquet(f"{tmp_path}/b/payloads")
    with pytest.raises(Exception, match="damaged payload"):
        archive.read_archive(spark, f"{tmp_path}/b").collect()
    spark.read.parquet(f"{tmp_path}/a/headers").write.parquet(f"{tmp_path}/c/headers")
    stored.where("octet_length(payload) <> 5").write.parquet(f"{tmp_path}/c/payloads")
    with pytest.raises(Exception, match="no payload for digest"):
        archive.read_archive(spark, f"{tmp_path}/c").collect()
