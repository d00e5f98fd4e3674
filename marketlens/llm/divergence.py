"""Source divergence audit by a minimal-perfect-hash recount.

First pass: each task counts the documents that hold a term, sums are exact, and the terms of a language
that are in enough of its documents are kept. They are dealt into shards by CRC-32, and a task per shard builds
its perfect hash: every key has a slot of its own and no slot is empty. The keys are stored beside the hash, so
a term that was not kept is known by comparing bytes.

Second pass: the shards are broadcast, at most about ``broadcast_bytes`` at a time (more vocabulary takes more
rounds over the texts), and each task adds its terms up in one dense array of slots per (language, source),
one after the other. The arrays are summed per shard, and each shard compares the sources of its language.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_map, keep, mix, private, table
from .importance import byte_table, runs_of_words

_LETTERS = byte_table({*range(0x61, 0x7B), *range(0x80, 0x100)})
UNIT = 1_000_000_000
BROADCAST_BYTES = 128_000_000
HELD_TERMS = 400_000  # distinct terms that a task holds before it passes them on
HELD_NUMBERS = 2_000_000  # counts of a shard, over all sources of its language, that a task compares
SMALL_ROWS = 100_000


# --- perfect hash ----------------------------------------------------------------------------


def term_hashes(terms: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, terms), np.uint64, len(terms))


def _place(hashes: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(hashes ^ (seeds.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


def build_hash(terms: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """(terms in the order of their slots, seed of each bucket) for distinct terms.

    Terms meet in buckets of about four. Larger buckets first, each takes the smallest seed that sends its
    terms to free slots; a bucket of one names its slot, as a negative number.
    """
    n, hashes = len(terms), term_hashes(terms)
    if len(np.unique(hashes)) < n:
        raise ValueError("two terms share a 64-bit hash")
    buckets = n // 4 + 1
    bucket = (mix(hashes) % np.uint64(buckets)).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    first, sizes = np.searchsorted(bucket[by], np.arange(buckets)), np.bincount(bucket, minlength=buckets)
    seeds, slot, free = np.zeros(buckets, np.int32), np.zeros(n, np.int64), np.ones(n, bool)
    for b in np.argsort(-sizes, kind="stable"):
        mine = by[first[b] : first[b] + sizes[b]]
        if len(mine) < 2:
            break
        start, width = 1, 16
        while True:
            tried = np.arange(start, start + width)
            at = (_place(hashes[mine][:, None], tried[None, :]) % np.uint64(n)).astype(np.int64)
            apart = (np.diff(np.sort(at, axis=0), axis=0) > 0).all(axis=0)
            good = np.flatnonzero(apart & free[at].all(axis=0))
            if len(good):
                break
            start, width = start + width, min(4096, 2 * width)
        seeds[b], slot[mine] = tried[good[0]], at[:, good[0]]
        free[slot[mine]] = False
    alone = by[first[sizes == 1]]
    slot[alone] = np.flatnonzero(free)
    seeds[bucket[alone]] = -1 - slot[alone]
    return [terms[i] for i in np.argsort(slot)], seeds


class Vocabulary:
    """The perfect hashes of some shards of a language, end to end: a term's slot, -1 if it is in none of them."""

    def __init__(self, shards: int, rows: list):
        self.shards = shards
        self.sizes, self.buckets = np.zeros(shards, np.int64), np.zeros(shards, np.int64)
        rows = sorted(rows, key=lambda r: r.shard)
        self.held = [r.shard for r in rows]
        for r in rows:
            self.sizes[r.shard], self.buckets[r.shard] = r.n, len(r.seeds) // 4
        self.first, self.first_bucket = np.cumsum(self.sizes) - self.sizes, np.cumsum(self.buckets) - self.buckets
        self.seeds = np.concatenate([np.frombuffer(r.seeds, np.int32) for r in rows])
        self.lengths = np.concatenate([_unpack(r.lengths, r.n) for r in rows])
        self.starts = np.cumsum(self.lengths, dtype=np.int64) - self.lengths
        self.keys = np.frombuffer(b"".join(r.keys for r in rows), np.uint8)
        self.slots = int(self.sizes.sum())

    def lookup(self, terms: list[bytes], crcs: np.ndarray) -> np.ndarray:
        out = np.full(len(terms), -1)
        shard = crcs % self.shards
        at = np.flatnonzero(self.sizes[shard] > 0)
        if not len(at):
            return out
        hashes, shard = term_hashes(terms)[at], shard[at]
        seed = self.seeds[self.first_bucket[shard] + (mix(hashes) % self.buckets[shard].astype(np.uint64)).astype(np.int64)]
        placed = (_place(hashes, seed) % self.sizes[shard].astype(np.uint64)).astype(np.int64)
        slot = self.first[shard] + np.where(seed < 0, -1 - seed.astype(np.int64), placed)
        # the stored key decides: equal length, then equal bytes
        data = np.frombuffer(b"".join(terms), np.uint8)
        lengths = np.fromiter(map(len, terms), np.int64, len(terms))
        starts = (np.cumsum(lengths) - lengths)[at]
        same = np.flatnonzero(lengths[at] == self.lengths[slot])
        if not len(same):
            return out
        n = lengths[at][same]
        begin = np.cumsum(n) - n
        step = np.arange(int(n.sum())) - np.repeat(begin, n)
        equal = data[np.repeat(starts[same], n) + step] == self.keys[np.repeat(self.starts[slot[same]], n) + step]
        found = same[np.logical_and.reduceat(equal, begin)]
        out[at[found]] = slot[found]
        return out


# --- first pass ------------------------------------------------------------------------------


def document_counts(docs: DataFrame) -> DataFrame:
    """(lang, term, n): partial numbers of documents that hold a term."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        held: dict[str, Counter] = {}

        def out() -> dict:
            pairs = [(lang, term, n) for lang, c in held.items() for term, n in c.items()]
            return dict(zip(("lang", "term", "n"), map(list, zip(*pairs)))) if pairs else {"lang": [], "term": [], "n": []}

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                seen: set[bytes] = set()
                for words in runs_of_words(text, _LETTERS):
                    seen.update(words)
                held.setdefault(lang, Counter()).update(seen)
                if sum(map(len, held.values())) > HELD_TERMS:
                    yield out()
                    held.clear()
        yield out()

    return arrow_map(docs.select("lang", "text"), run, "lang string, term binary, n long")


def _small(df: DataFrame) -> DataFrame:
    """Kept, and broadcast in joins if it has few rows."""
    df = keep(df)
    return F.broadcast(df) if df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else df


def build_shards(docs: DataFrame, min_docs: int, shard_terms: int) -> DataFrame:
    """(lang, shard, shards, n, seeds, lengths, keys): the perfect hashes of the kept terms."""
    kept = keep(document_counts(docs).groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs).select("lang", "term"))
    sizes = kept.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / shard_terms).cast("int").alias("shards"))
    dealt = kept.join(_small(sizes), "lang").withColumn("shard", (F.crc32("term") % F.col("shards")).cast("int"))

    def run(group: pa.Table) -> pa.Table:
        terms, seeds = build_hash(group["term"].to_pylist())
        lengths = np.fromiter(map(len, terms), np.int32, len(terms))
        return pa.table(
            {
                "lang": group["lang"].slice(0, 1), "shard": group["shard"].slice(0, 1), "shards": group["shards"].slice(0, 1),
                "n": pa.array([len(terms)], pa.int32()), "seeds": pa.array([seeds.tobytes()], pa.binary()),
                "lengths": pa.array([_pack(lengths)], pa.binary()), "keys": pa.array([b"".join(terms)], pa.binary()),
            }
        )

    return dealt.groupBy("lang", "shard").applyInArrow(run, "lang string, shard int, shards int, n int, seeds binary, lengths binary, keys binary")


# --- second pass -----------------------------------------------------------------------------


def _pack(numbers: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs; their number tells the width."""
    most = int(numbers.max(initial=0))
    return numbers.astype(next(f"<u{w}" for w in (1, 2, 4, 8) if most < 1 << 8 * w)).tobytes()


def _unpack(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // n}") if n else np.zeros(0, np.uint8)


def slot_counts(docs: DataFrame, shards: list) -> DataFrame:
    """(lang, source, shard, size, n, steps, counts): partial counts of the terms of these shards, as steps from
    one filled slot to the next and their numbers. A task reads its texts by (lang, source), so it holds one dense
    array at a time."""
    shared = docs.sparkSession.sparkContext.broadcast(shards)

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        rows = sorted(shared.value, key=lambda r: r.lang)
        vocabulary = {lang: Vocabulary(same[0].shards, same) for lang, group in groupby(rows, key=lambda r: r.lang) for same in [list(group)]}

        def add(v: Vocabulary, dense: np.ndarray, counter: Counter) -> None:
            terms = list(counter)
            slots = v.lookup(terms, np.fromiter(map(crc32, terms), np.int64, len(terms)))
            hit = slots >= 0
            dense[slots[hit]] += np.fromiter(counter.values(), np.int64, len(terms))[hit]
            counter.clear()

        texts = (r for b in batches for r in zip(b["lang"], b["source"], b["text"]))
        for (lang, source), same in groupby(texts, key=lambda r: r[:2]):
            v = vocabulary.get(lang)
            if v is None:
                continue
            dense, counter = np.zeros(v.slots, np.int64), Counter()
            for *_, text in same:
                for words in runs_of_words(text, _LETTERS):
                    counter.update(words)
                    if len(counter) > HELD_TERMS:
                        add(v, dense, counter)
            add(v, dense, counter)
            out: dict[str, list] = {c: [] for c in ("lang", "source", "shard", "size", "n", "steps", "counts")}
            for shard in v.held:
                own = dense[v.first[shard] : v.first[shard] + v.sizes[shard]]
                at = np.flatnonzero(own)
                if len(at):
                    row = (lang, source, shard, len(own), len(at), _pack(np.diff(at, prepend=0)), _pack(own[at]))
                    for c, x in zip(out, row):
                        out[c].append(x)
            yield out

    ordered = docs.sortWithinPartitions("lang", "source")
    return arrow_map(ordered, run, "lang string, source string, shard int, size int, n int, steps binary, counts binary")


def sum_slots(parts: DataFrame) -> DataFrame:
    """(lang, source, shard, counts, total) of the parts of all tasks, streamed in key order."""
    key = ["lang", "source", "shard"]

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        rows = (r for b in batches for r in zip(b["lang"], b["source"], b["shard"], b["size"], b["n"], b["steps"], b["counts"]))
        for (lang, source, shard, size), same in groupby(rows, key=lambda r: r[:4]):
            dense = np.zeros(size, np.int64)
            for *_, n, steps, counts in same:
                dense[np.cumsum(_unpack(steps, n), dtype=np.int64)] += _unpack(counts, n).astype(np.int64)
            yield {"lang": [lang], "source": [source], "shard": [shard], "counts": [_pack(dense)], "total": [int(dense.sum())]}

    return arrow_map(parts.repartition(*key).sortWithinPartitions(*key), run, "lang string, source string, shard int, counts binary, total long")


# --- comparison ------------------------------------------------------------------------------


def shares(counts: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(10^9 * (count + 1) / total), exactly: three digits at a time, so no product overflows."""
    left, out = counts + 1, np.zeros_like(counts)
    for _ in range(3):
        left = left * 1000
        out = out * 1000 + left // total
        left = left % total
    return out + 1


def compare_shards(groups: DataFrame, shards: DataFrame, top: int) -> DataFrame:
    """(lang, source, part, item, value) of each shard: sums over its terms for each other source, and its
    ``top`` terms of each source."""

    def run(sources: pa.Table, shard: pa.Table) -> pa.Table:
        n, v = shard["n"][0].as_py(), sources["v"][0].as_py()
        lengths = _unpack(shard["lengths"][0].as_py(), n).astype(np.int64)
        ends, keys = np.cumsum(lengths), shard["keys"][0].as_py()
        terms = [keys[e - size : e] for e, size in zip(ends.tolist(), lengths.tolist())]
        in_order = np.empty(n, np.int64)
        in_order[sorted(range(n), key=terms.__getitem__)] = np.arange(n)
        names = sources["source"].to_pylist()
        counts = np.stack([_unpack(c, n).astype(np.int64) if c else np.zeros(n, np.int64) for c in sources["counts"].to_pylist()])
        p = np.stack([shares(c, total + v) for c, total in zip(counts, sources["total"].to_pylist())])
        q = shares(counts.sum(axis=0), sources["lang_total"][0].as_py() + v)
        out: dict[str, list] = {"source": [], "part": [], "item": [], "value": []}

        def add(source: str, part: str, items: list, values: np.ndarray) -> None:
            out["source"] += [source] * len(items)
            out["part"] += [part] * len(items)
            out["item"] += items
            out["value"] += values.tolist()

        for i, source in enumerate(names):
            gap = p[i] - p
            add(source, "pair", names[:i] + names[i + 1 :], np.delete((gap * gap // p).sum(axis=1), i))
            at = np.flatnonzero((counts[i] > 0) & (p[i] > q))
            f = (p[i][at] - q[at]) ** 2 // q[at]
            best = np.lexsort((in_order[at], -f))[:top]
            add(source, "term", [terms[k].decode() for k in at[best]], f[best])
        return pa.table({"lang": pa.array([sources["lang"][0].as_py()] * len(out["item"]), pa.string())} | {k: pa.array(x, pa.int64() if k == "value" else pa.string()) for k, x in out.items()})

    own = shards.select(F.col("lang").alias("of_lang"), F.col("shard").alias("of_shard"), "n", "lengths", "keys")  # apart from the other side's
    cogroup = groups.groupBy("lang", "shard").cogroup(own.groupBy("of_lang", "of_shard"))
    return cogroup.applyInArrow(run, "lang string, source string, part string, item string, value long")


def audit(
    docs: DataFrame,
    *,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    min_docs: int = 3,
    top: int = 200,
    shard_terms: int = 16_384,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) of how each source differs within its language.

    Part ``pair`` has a row for each other source of the language: the chi-square-like sum over all kept terms of
    the language. Part ``term`` has the ``top`` terms that the source uses more than its language does. Nulls in
    any of the three columns count as empty text. A group without terms still has its pairs; a language without
    kept terms has pairs of value 0. Ties go by the item's UTF-8 bytes. Repeated rows are documents of their own.
    An empty table gives an empty result. Other columns are ignored. A task of the comparison holds a
    shard's counts for all sources of a language; shards have at most ``shard_terms`` terms or so, fewer where a
    language has many sources.
    """
    spark = docs.sparkSession
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    docs = private(docs, lang=lang_col, source=source_col, text=text_col).select(blank("lang"), blank("source"), blank("text").cast("binary").alias("text"))
    groups = keep(docs.select("lang", "source").distinct())
    sources = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 1
    shards = keep(build_shards(docs, min_docs, min(shard_terms, max(64, HELD_NUMBERS // sources))))
    held = shards.agg(F.sum(F.octet_length("keys") + F.octet_length("lengths") + F.octet_length("seeds")), F.count(F.lit(1))).first()
    vocabulary = shards.groupBy("lang").agg(F.sum("n").alias("v"))
    bare = groups.join(vocabulary, "lang", "left_anti")
    others = bare.select("lang", F.col("source").alias("item"))
    found = bare.join(others, "lang").where("source <> item").select("lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("long").alias("value"))
    if held[1]:
        rounds = int(-(-held[0] // broadcast_bytes))
        number = F.pmod(F.xxhash64("lang", "shard"), F.lit(rounds))
        parts = [slot_counts(docs, shards.where(number == k).collect()) for k in range(rounds)]  # ``broadcast_bytes`` each
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionAll(part)
        sums = keep(sum_slots(whole))
        totals = groups.join(sums.groupBy("lang", "source").agg(F.sum("total").alias("total")), ["lang", "source"], "left").na.fill(0, ["total"])
        by_lang = totals.groupBy("lang").agg(F.sum("total").alias("lang_total")).join(vocabulary, "lang")
        every = shards.select("lang", "shard").join(_small(totals.join(by_lang, "lang")), "lang")
        rows = every.join(sums.select("lang", "source", "shard", "counts"), ["lang", "source", "shard"], "left")
        compared = compare_shards(rows, shards, top)
        pairs = compared.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
        found = keep(compared.where("part = 'term'")).unionByName(pairs).unionByName(found)
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    ranked = found.withColumn("rank", F.row_number().over(order))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= top))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the sources of ``documents`` differ within each language."""
    return audit(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
occ AS (SELECT d, lang, source, unnest(w) AS term FROM d),
vocab AS (SELECT lang, term FROM occ GROUP BY lang, term HAVING count(DISTINCT d) >= 3),
sizes AS (SELECT lang, count(*) AS v FROM vocab GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
cnt AS (SELECT lang, source, term, count(*) AS c FROM occ SEMI JOIN vocab USING (lang, term) GROUP BY ALL),
every AS (SELECT g.lang, g.source, k.term, v, coalesce(c, 0) AS c FROM groups g JOIN vocab k ON g.lang = k.lang JOIN sizes z ON z.lang = g.lang
  LEFT JOIN cnt ON cnt.lang = g.lang AND cnt.source = g.source AND cnt.term = k.term),
p AS (SELECT *, 1 + 1000000000 * CAST(c + 1 AS HUGEINT) // (sum(c) OVER (PARTITION BY lang, source) + v) AS p FROM every),
lc AS (SELECT lang, term, any_value(v) AS v, sum(c) AS c FROM every GROUP BY lang, term),
q AS (SELECT lang, term, 1 + 1000000000 * CAST(c + 1 AS HUGEINT) // (sum(c) OVER (PARTITION BY lang) + v) AS q FROM lc),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, (p - q) * (p - q) // q AS value FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM (FROM pairs UNION ALL FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR r <= 200
"""
