"""Hashed maximum-entropy language model with a class-factored softmax.

The probability of a token is that of its class given what stands before it, times that of the word in
its class given the word before it. Classes are groups of words with a common ending.

* The class is a softmax over sums of the weights of hashed features: the previous word, the pair of
  previous words, and a skip feature, the word before the previous one. Its table has a fixed size.
* The word in its class is a softmax with one feature for each pair of neighbours in the corpus: over the
  words seen after the previous one in this class, and "another", which draws from the class by corpus counts.
  Seen ``n`` times, a pair has weight ``log(n - d)``; "another" has ``log(d * pairs)``. There the gradient
  of the likelihood of pairs left out one at a time vanishes, with ``d`` from the pairs seen once and twice; so
  these weights are set, not stepped to. Their table grows with the corpus: it lies in shards dealt by hash.

So the probabilities of all words and of one unseen word in each class add up to one.

Counting: documents are dealt into batches; each batch asks the count shards, which are dealt by word and by
(previous word, class), for the words and pairs it holds, and is sent their counts. The class weights are trained
in rounds: the tasks of a round take gradient steps on their share of the learning documents, and the changes are
averaged by tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, buckets_for, keep, mix, pieces, private, table, text_bytes, word_codes

CLASSES = 64  # groups of words by their last bytes
ROWS = 4096  # hashed features of the class
STEP = 16384  # tokens in a gradient step
LOW = np.uint64(63)
WORD_BITS = np.uint64(24)  # of a pair's code; the others are of what stands before, and of the class


#: Of the end token, which counts in class 0.
END = np.uint64(0x9AE16A3B2F90404F & ~63)


def tokens(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Token codes of all texts after one another, an end after each, and the number of tokens of each.
    The last 6 bits of a word's code are the number of its class, by its last three bytes."""
    codes, endings, counts = word_codes(texts)
    codes = (codes & ~LOW) | mix(endings) % np.uint64(CLASSES)
    return np.insert(codes, np.cumsum(counts), END), counts + 1


def before(code: np.ndarray, sizes: np.ndarray, steps: int) -> np.ndarray:
    """Of each token the code ``steps`` places before it; 0 before a text's start."""
    place = np.arange(len(code)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.where(place >= steps, np.concatenate([np.zeros(steps, np.uint64), code])[: len(code)], np.uint64(0))


def features(code: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Numbers (3 x tokens) of the features of each token. Number 0 is left for the bias."""
    back = [before(code, sizes, k) for k in (1, 2)]
    with np.errstate(over="ignore"):
        keys = (back[0] + np.uint64(1), back[1] + np.uint64(2), back[0] * np.uint64(3) + mix(back[1]))
        return np.stack([(mix(k) % np.uint64(ROWS - 1)).astype(np.uint16) + np.uint16(1) for k in keys])


def classes_of(code: np.ndarray) -> np.ndarray:
    return (code & LOW).astype(np.int32)


def pairs(code: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Code of each token with the one before it: a hash of that one and of the token's class, then a short hash
    of the token."""
    with np.errstate(over="ignore"):
        stem = mix(before(code, sizes, 1) * np.uint64(3) + (code & LOW) + np.uint64(1))
        return (stem >> WORD_BITS << WORD_BITS) | (mix(code) >> (np.uint64(64) - WORD_BITS))


def dealt(codes: np.ndarray, what: np.ndarray, shards: int) -> tuple[np.ndarray, list[int]]:
    """Places of ``codes`` by the shard of ``what``, and where shards begin among them; and their order is the same
    for all who hold the same codes."""
    shard = (mix(what) % np.uint64(shards)).astype(np.int64)
    by = np.argsort(shard, kind="stable")
    shard = shard[by]
    return by, np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])).tolist() if len(by) else []


def packed(values: np.ndarray) -> bytes:
    """Counts as a byte each, and those of 255 and more once again after them."""
    return np.minimum(values, 255).astype(np.uint8).tobytes() + values[values >= 255].astype("<i8").tobytes()


def unpacked(data: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(data, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(data, "<i8", offset=n)
    return out


def scores(weights: np.ndarray, found: np.ndarray) -> np.ndarray:
    """(classes x tokens), the largest of each token 0. ``weights`` are (classes x features), so that all
    steps run along memory."""
    z = np.take(weights, found.ravel(), axis=1).reshape(len(weights), len(found), -1).sum(axis=1)
    z += weights[:, :1]
    z -= z.max(axis=0)
    return z


def gradient_steps(weights: np.ndarray, code: np.ndarray, sizes: np.ndarray, squares: np.ndarray, rate: float = 0.1) -> None:
    """One pass of minibatch steps over the tokens, in place; ``squares`` holds each feature's sum of
    squared gradients, which sets its rate."""
    found, target = features(code, sizes), classes_of(code)
    for a in range(0, len(code), STEP):
        f, y = found[:, a : a + STEP], target[a : a + STEP]
        g = np.exp(scores(weights, f))
        g /= g.sum(axis=0)
        g[y, np.arange(len(y))] -= 1
        flat = f.ravel()
        by = np.argsort(flat, kind="stable")
        ordered = flat[by]
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        change = np.zeros_like(weights)
        change[:, ordered[first]] = np.add.reduceat(np.take(g, by % len(y), axis=1), first, axis=1)
        change[:, 0] = g.sum(axis=1)
        squares += np.einsum("cf,cf->f", change, change) / len(weights)
        change *= rate / np.sqrt(squares)
        weights -= change


def _batched(docs: DataFrame, held_out, batches: int) -> DataFrame:
    return docs.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)).alias("batch"), "doc_id", held_out.alias("held_out"), F.col("text").cast("binary").alias("text")
    )


def _whole(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """``tokens`` of a batch, worked out piece by piece."""
    parts = [tokens(texts[a:z]) for a, z in pieces(texts)]
    return tuple(np.concatenate(x) for x in zip(*parts))  # type: ignore[return-value]


def _requests(batched: DataFrame, shards: int) -> DataFrame:
    """(batch, shard, codes, counts): the words and pairs of each batch and how often its learning texts hold
    them. Shards of pairs have the numbers from ``shards`` on."""

    def run(group: pa.Table) -> pa.Table:
        code, sizes = _whole(group["text"].to_pylist())
        learns = np.repeat(~np.asarray(group["held_out"].to_pylist(), bool), sizes)
        rows: list[tuple[int, bytes, bytes]] = []
        for first, all_codes, of in ((0, code, lambda x: x), (shards, pairs(code, sizes), lambda x: x >> WORD_BITS)):
            found = np.unique(all_codes)
            own, times = np.unique(all_codes[learns], return_counts=True)
            n = np.zeros(len(found), np.int64)
            n[np.searchsorted(found, own)] = times
            by, cuts = dealt(found, of(found), shards)
            for a, z in zip(cuts, [*cuts[1:], len(by)]):
                at = by[a:z]
                rows.append((first + int(mix(of(found[at[:1]]))[0] % np.uint64(shards)), found[at].tobytes(), packed(n[at])))
        return pa.table(
            {
                "batch": pa.array([group["batch"][0].as_py()] * len(rows), pa.int64()),
                "shard": pa.array([r[0] for r in rows], pa.int64()),
                "codes": pa.array([r[1] for r in rows], pa.binary()),
                "counts": pa.array([r[2] for r in rows], pa.binary()),
            }
        )

    return batched.groupBy("batch").applyInArrow(run, "batch long, shard long, codes binary, counts binary")


def _answers(requests: DataFrame, shards: int) -> DataFrame:
    """(batch, shard, n, counts, totals): for each request of ``n`` codes their counts over all batches, in the order
    of the request; for pairs these are followed by how often, and by how many words, what stands before is followed
    in the class. The first row of a shard also holds its totals."""

    def run(group: pa.Table) -> pa.Table:
        codes = [np.frombuffer(x, np.uint64) for x in group["codes"].to_pylist()]
        counts = np.concatenate([unpacked(x, len(c)) for x, c in zip(group["counts"].to_pylist(), codes)])
        found, which = np.unique(np.concatenate(codes), return_inverse=True)
        total = np.zeros(len(found), np.int64)
        np.add.at(total, which, counts)
        known = total > 0
        sums = np.zeros((2, CLASSES + 1), np.int64)
        sent = [total]
        if group["shard"][0].as_py() < shards:
            kind = classes_of(found)
            np.add.at(sums[0], kind[known], total[known])
            np.add.at(sums[1], kind[known], 1)
        else:
            stem = found >> WORD_BITS
            first = np.flatnonzero(np.concatenate([[True], stem[1:] != stem[:-1]]))
            lengths = np.diff(np.append(first, len(stem)))
            sent += [np.repeat(np.add.reduceat(x, first), lengths) for x in (total, known.astype(np.int64))]
            sums[:, CLASSES] = (total == 1).sum(), (total == 2).sum()
        ends = np.cumsum([len(c) for c in codes])
        answers = [np.concatenate([x[w] for x in sent]) for w in np.split(which, ends[:-1])]
        return pa.table(
            {
                "batch": group["batch"].cast(pa.int64()), "shard": group["shard"].cast(pa.int64()),
                "n": pa.array([len(c) for c in codes], pa.int64()), "counts": pa.array([packed(x) for x in answers], pa.binary()),
                "totals": pa.array([sums.tobytes()] + [None] * (len(codes) - 1), pa.binary()),
            }
        )

    return requests.repartition(2 * shards, "shard").groupBy("shard").applyInArrow(run, "batch long, shard long, n long, counts binary, totals binary")


class Counts:
    """Totals of the corpus: tokens, distinct words, the size of each class, and what is taken off a pair's count."""

    def __init__(self, answers: DataFrame):
        def add(group: pa.Table) -> pa.Table:
            sums = sum(np.frombuffer(x, np.int64) for x in group["totals"].to_pylist())
            return pa.table({"totals": pa.array([np.asarray(sums).tobytes()], pa.binary())})

        firsts = answers.where("totals IS NOT NULL").select("totals", F.pmod("shard", F.lit(64)).alias("part"))
        parts = firsts.groupBy("part").applyInArrow(add, "totals binary").collect()  # 64 rows at most
        sums = sum((np.frombuffer(r.totals, np.int64).reshape(2, -1) for r in parts), np.zeros((2, CLASSES + 1), np.int64))
        once, twice = sums[:, CLASSES].tolist()
        self.off = min(max(once / (once + 2 * twice), 0.1), 0.95) if once else 0.5
        sizes = sums[:, :CLASSES]
        self.tokens, self.distinct = int(sizes[0].sum()), int(sizes[1].sum())
        #: Of each class, what (count + 1) is divided by.
        self.room = sizes[0] + sizes[1] + 1.0
        prior = sizes[0] + 1.0
        self.prior = np.log(prior / prior.sum()).astype(np.float32)


def in_class(alone: np.ndarray, n: np.ndarray, total: np.ndarray, follow: np.ndarray, off: float) -> np.ndarray:
    """Probability of each word in its class: ``alone`` by class counts, ``n`` times seen after the word before it,
    after which the class was seen ``total`` times with ``follow`` words."""
    whole = np.maximum(total, 1)
    return np.where(total > 0, (np.maximum(n - off, 0) + off * follow * alone) / whole, alone)


def train(docs: DataFrame, counts: Counts, rounds: int) -> np.ndarray:
    """Weights (CLASSES x ROWS). Each learning document belongs to one round; a round's tasks start from
    the same weights, and their changes are averaged, weighted by tokens, class by class."""
    spark = docs.sparkSession
    weights = np.zeros((CLASSES, ROWS), np.float32)
    weights[:, 0] = counts.prior
    for k in range(rounds):
        shared = spark.sparkContext.broadcast(weights)

        def run(batches: Iterator[dict], shared=shared) -> Iterator[dict]:
            own, squares, seen = shared.value.copy(), np.ones(ROWS, np.float32), 0
            for b in batches:
                for a, z in pieces(b["text"], 1_000_000):
                    code, sizes = tokens(b["text"][a:z])
                    gradient_steps(own, code, sizes, squares)
                    seen += len(code)
            if seen:
                change = (own - shared.value) * np.float32(seen)
                yield {"class": range(CLASSES), "change": [x.tobytes() for x in change], "seen": [seen] * CLASSES}

        def add(group: pa.Table) -> pa.Table:
            change = np.zeros(ROWS)
            for x in group["change"]:
                change += np.frombuffer(x.as_buffer(), np.float32)
            seen = sum(group["seen"].to_pylist())
            return pa.table({"class": group["class"].slice(0, 1).cast(pa.int64()), "change": pa.array([(change / seen).astype(np.float32).tobytes()], pa.binary())})

        mine = docs.where(F.pmod(F.xxhash64("text", "doc_id"), F.lit(rounds)) == k).select(F.col("text").cast("binary").alias("text"))
        changes = arrow_map(mine, run, "class long, change binary, seen long").groupBy("class").applyInArrow(add, "class long, change binary")
        weights = weights.copy()
        for r in changes.collect():  # a row for each class
            weights[r["class"]] += np.frombuffer(r.change, np.float32)
        shared.unpersist()
    return weights


def score(batched: DataFrame, answers: DataFrame, shards: int, counts: Counts, weights: np.ndarray) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    model = batched.sparkSession.sparkContext.broadcast((weights, counts.room, counts.tokens, counts.distinct, counts.off))
    kind = dict(batched.dtypes)["doc_id"]

    def run(docs: pa.Table, sent: pa.Table) -> pa.Table:
        weights, room, n, v, off = model.value
        texts = docs["text"].to_pylist()
        bounds = list(pieces(texts))
        code, sizes = _whole(texts)
        del texts
        sent = sent.sort_by("shard")
        shard, asked, data = (sent[c].to_pylist() for c in ("shard", "n", "counts"))
        # answers come in the order in which the batch asked
        found, which = np.unique(code, return_inverse=True)
        by, _ = dealt(found, found, shards)
        times = np.empty(len(found), np.int64)
        times[by] = np.concatenate([unpacked(x, k) for s, k, x in zip(shard, asked, data) if s < shards])
        which = which.astype(np.int32)
        found, which_pair = np.unique(pairs(code, sizes), return_inverse=True)
        which_pair = which_pair.astype(np.int32)
        by, _ = dealt(found, found >> WORD_BITS, shards)
        of_pairs = np.empty((3, len(found)), np.int64)
        at = 0
        for s, k, x in zip(shard, asked, data):
            if s >= shards:
                of_pairs[:, by[at : at + k]] = unpacked(x, 3 * k).reshape(3, k)
                at += k
        del found, by, sent, data
        out = np.zeros((3, len(docs)))
        ends = np.append(0, np.cumsum(sizes))
        for a, z in bounds:  # whole texts, a few at a time
            here = slice(ends[a], ends[z])
            c, own = times[which[here]], code[here]
            target, numbers, p = classes_of(own), features(own, sizes[a:z]), np.empty(len(own))
            word = np.log(in_class((c + 1.0) / room[target], *of_pairs[:, which_pair[here]], off))
            for i in range(0, len(own), 4096):
                y = target[i : i + 4096]
                logits = scores(weights, numbers[:, i : i + 4096])
                p[i : i + 4096] = logits[y, np.arange(len(y))] - np.log(np.exp(logits).sum(axis=0))
            for k, x in enumerate((c > 0, np.log10(c + 1.0) - np.log10(n + v + 1.0), (p + word) / np.log(10.0))):
                out[k, a:z] = np.add.reduceat(x.astype(float), ends[a:z] - ends[a])
        return pa.table(
            {
                "doc_id": docs["doc_id"], "held_out": docs["held_out"], "n_tokens": pa.array(sizes.astype(np.int64)),
                "n_known": pa.array(out[0].astype(np.int64)), "train_tokens": pa.array(np.full(len(docs), n, np.int64)),
                "base_score": pa.array(out[1]), "score": pa.array(out[2]),
            }
        )

    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    told = answers.select("batch", "shard", "n", "counts").repartition(shards, "batch")
    return batched.groupBy("batch").cogroup(told.groupBy("batch")).applyInArrow(run, schema)


def score_texts(docs: DataFrame, held_out, *, rounds: int = 4, batch_bytes: int = 16_000_000) -> DataFrame:
    """Log10 probabilities of all texts under a model that learns from those with ``held_out`` false.

    Words are runs of other than ASCII white space, A-Z lower-cased; each text ends in an end token, so a
    null or empty text has one token. ``base_score`` is the add-one unigram's. When no text is held in,
    words are all unknown and the weights stay at the start. Repeated rows are scored, and learned from,
    once each. Other columns are ignored.
    """
    spark = docs.sparkSession
    docs = private(docs, doc_id="doc_id", text="text")
    batches = buckets_for(spark, text_bytes(docs), batch_bytes)
    batched = _batched(docs, held_out, batches).repartition(batches, "batch")
    answers = keep(_answers(_requests(batched, batches), batches))
    counts = Counts(answers)
    weights = train(docs.where(~held_out), counts, rounds)
    return score(batched, answers, batches, counts, weights)


def op7_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    return score_texts(table(spark, sf_dir, "documents"), held_out)
