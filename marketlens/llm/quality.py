"""Quality by perplexity: interpolated modified Kneser-Ney models of character n-grams, trained on trusted
text, score every document; a document whose perplexity lies beyond its language's quantiles is rejected.
A model trained on text labelled toxic finds the stretch of a document that it explains better than the
trusted one by most; where that lies far beyond what trusted texts of the language have, the document is rejected too.

All labelled texts teach. The trusted ones teach two models, each half of the texts (by hash) one, and a document is
scored by the model that its own text did not teach: so every trusted text also serves the quantiles, unseen.

n-grams are dealt into shards by the two symbols before their last one. All n-grams of three symbols and more that
counting, smoothing and backing off bring together then lie in one shard, which does this for itself; pairs and single
symbols are smoothed and looked up by Spark joins, and each shard is sent the pairs it names. The probability of a symbol
follows from the n-gram that it ends, so documents are dealt into batches, each batch asks the shards for its distinct
n-grams and is sent what it asked for. What is shuffled or kept is packed: one row for many n-grams or texts, compressed.
No table goes to the driver or to all tasks. Scoring, and the quantiles, cover all documents and their whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import CHECKPOINT_KEY, release, tidy
from .common import arrow_map, buckets_for, freed, freeing, keep, mix, private, table, text_bytes

START, END = 0x02, 0x03  # control characters stand for the ends of a text
_A = np.uint64(0x9E3779B97F4A7C15)
_PIECE = 200_000
_GRAMS = 1_000_000  # that a shard merges at a time
LOW = 2  # n-grams up to this length are smoothed by joins, longer ones within their shard
TOXIC = 2  # number of the model of toxic text; 0 and 1 are the trusted ones


def symbols(text: str) -> np.ndarray:
    """Code points; all digits become 0, and the two characters that mark ends become blanks."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where((points >= 0x30) & (points <= 0x39), 0x30, points)
    return np.where((points == START) | (points == END), 0x20, points)


def padded(text: str, order: int) -> np.ndarray:
    return np.concatenate([np.full(order - 1, START, np.uint32), symbols(text), np.array([END], np.uint32)])


def raw_codes(points: np.ndarray, order: int) -> list[np.ndarray]:
    """For k = 1..order, unmixed codes of the k-grams that end at each place from ``order - 1`` on."""
    points = points.astype(np.uint64)
    last = len(points) - order + 1
    out, code, power = [], np.zeros(last, np.uint64), np.uint64(1)
    with np.errstate(over="ignore"):
        for k in range(order):
            code = code + points[order - 1 - k : order - 1 - k + last] * power
            power = power * _A
            out.append(code)
    return out


def finished(code: np.ndarray, length: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(code + np.uint64(length)) | np.uint64(1)


def gram_codes(grams: np.ndarray) -> np.ndarray:
    """Finished codes of the rows of a matrix of symbols."""
    length = grams.shape[1]
    code, power = np.zeros(len(grams), np.uint64), np.uint64(1)
    with np.errstate(over="ignore"):
        for k in range(length):
            code = code + grams[:, length - 1 - k].astype(np.uint64) * power
            power = power * _A
    return finished(code, length)


def distinct_grams(parts: list[np.ndarray], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams (a row of symbols each) within padded arrays, and how often they occur."""
    points = np.concatenate(parts)
    present = np.zeros(int(points.max()) + 1, bool)
    present[points] = True
    letters = np.flatnonzero(present).astype(np.uint32)
    if len(letters) ** order >= 1 << 63:  # too many letters for their numbers to fit one word
        rows = np.ascontiguousarray(np.concatenate([np.lib.stride_tricks.sliding_window_view(p, order) for p in parts]))
        found, n = np.unique(rows.view([("", np.uint32)] * order).ravel(), return_counts=True)
        return found.view(np.uint32).reshape(-1, order), n
    number = (np.cumsum(present) - 1)[points]
    last = len(points) - order + 1
    code = np.zeros(last, np.int64)
    for k in range(order):
        code = code * len(letters) + number[k : k + last]
    own = np.ones(len(points), bool)  # n-grams that begin in one array and end in the next are none
    ends = np.cumsum([len(p) for p in parts])
    for k in range(1, order):
        own[ends - k] = False
    found, n = np.unique(code[own[:last]], return_counts=True)
    grams = np.empty((len(found), order), np.uint32)
    for k in range(order - 1, -1, -1):
        found, digit = np.divmod(found, len(letters))
        grams[:, k] = letters[digit]
    return grams, n


def as_text(grams: np.ndarray) -> str:
    return np.ascontiguousarray(grams).astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def from_text(text: str, order: int) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, order)


def _strings(grams: np.ndarray) -> list[str]:
    flat, order = as_text(grams), grams.shape[1]
    return [flat[i : i + order] for i in range(0, len(flat), order)]


def pack(values: np.ndarray) -> bytes:
    """Rows of numbers in few bytes: those bytes that have the same place in their numbers lie side by side, then zstd."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T if len(values) else np.zeros((0, 0), np.uint8)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, kind: type, width: int) -> np.ndarray:
    """The matrix of ``width`` columns that was packed; one column makes an array."""
    n = int.from_bytes(data[:8], "little")
    size = n * width * np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True) if n else b"", np.uint8)
    values = np.ascontiguousarray(planes.reshape(-1, n).T).view(kind) if n else np.zeros((0, width), kind)
    return values.reshape(n, width) if width > 1 else values.reshape(n)


def shard_of(grams: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each n-gram, by the ``LOW`` symbols before its last one."""
    last = grams.shape[1] - 1
    return (mix(gram_codes(grams[:, max(0, last - LOW) : last])) % np.uint64(shards)).astype(np.int64)


def in_order(grams: np.ndarray) -> np.ndarray:
    """Places of the rows in order of their symbols: neighbours begin alike, which packs well."""
    return np.lexsort(grams.T[::-1])


def count_ngrams(texts: DataFrame, order: int) -> DataFrame:
    """Rows (gram, n): the n-grams of the highest order in column ``text``, ends marked; with a column ``model``,
    rows (model, gram, n)."""
    keyed = "model" in texts.columns

    def count(batches: Iterator[dict]) -> Iterator[dict]:
        waiting: dict[int, list[np.ndarray]] = {}
        held: dict[int, int] = {}

        def counted(model: int) -> dict:
            grams, n = distinct_grams(waiting.pop(model), order)
            held.pop(model)
            return ({"model": [model] * len(n)} if keyed else {}) | {"gram": _strings(grams), "n": n}

        for batch in batches:
            for model, text in zip(batch["model"] if keyed else [0] * len(batch["text"]), batch["text"]):
                if text:
                    p = padded(text, order)
                    waiting.setdefault(model, []).append(p)
                    held[model] = held.get(model, 0) + len(p)
                    if held[model] > 10 * _PIECE:
                        yield counted(model)
        for model in list(waiting):
            yield counted(model)

    keys = ["model"] if keyed else []
    schema = ("model int, " if keyed else "") + "gram string, n long"
    return arrow_map(texts.select(*keys, "text"), count, schema, rows=500).groupBy(*keys, "gram").agg(F.sum("n").alias("n"))


class Lessons:
    """What (model, text) rows teach, for ``score``."""

    def __init__(self, texts: DataFrame, order: int):
        self.texts, self.order = texts, order

    def dealt(self, shards: int) -> DataFrame:
        """(model, shard, grams, n): packed n-grams of the highest order and their counts, an n-gram in several rows."""
        order = self.order

        def count(batches: Iterator[dict]) -> Iterator[dict]:
            waiting: dict[int, list[np.ndarray]] = {}
            held: dict[int, int] = {}
            for batch in batches:
                for model, text in zip(batch["model"], batch["text"]):
                    if text:
                        p = padded(text, order)
                        waiting.setdefault(model, []).append(p)
                        held[model] = held.get(model, 0) + len(p)
                        if held[model] > 10 * _PIECE:
                            held.pop(model)
                            yield _dealt(model, *distinct_grams(waiting.pop(model), order), shards)
            for model in list(waiting):
                yield _dealt(model, *distinct_grams(waiting.pop(model), order), shards)

        return arrow_map(self.texts.select("model", "text"), count, _DEALT, rows=500)


_DEALT = "model int, shard long, grams binary, n binary"


def _dealt(model: int, grams: np.ndarray, n: np.ndarray, shards: int) -> dict:
    of = shard_of(grams, shards)
    at = [(s, own) for s in range(shards) if len(own := np.flatnonzero(of == s))]
    return {
        "model": [model] * len(at), "shard": [s for s, _ in at],
        "grams": [pack(grams[own]) for _, own in at], "n": [pack(n[own].astype(np.int64)) for _, own in at],
    }


class Smoothed(list):
    """The tables that ``smooth`` makes, and the counts they come from, for ``score``."""

    def __init__(self, tables: list[tuple[DataFrame, DataFrame]], counts: DataFrame):
        super().__init__(tables)
        self.counts, self.order = counts, len(tables)

    def dealt(self, shards: int) -> DataFrame:
        """As of ``Lessons``."""
        order = self.order

        def deal(batches: Iterator[dict]) -> Iterator[dict]:
            for b in batches:
                model = np.array(b["model"])
                grams, n = from_text("".join(b["gram"]), order), np.array(b["n"])
                for m in np.unique(model):
                    yield _dealt(int(m), grams[model == m], n[model == m], shards)

        return arrow_map(self.counts.select("model", "gram", "n"), deal, _DEALT)


def smooth(counts: DataFrame, order: int) -> Smoothed:
    """For k = 1..order: (gram, p) with the interpolated probability of its last symbol, and (context, g)
    with the weight left to the lower order. With a column ``model``, which all tables then have, one model each."""
    keys = [c for c in counts.columns if c == "model"]
    tables = [keep(counts)]
    for _ in range(order - 1):  # continuation counts: in how many ways a gram is preceded
        tables.insert(0, keep(tables[0].groupBy(*keys, F.expr("substring(gram, 2)").alias("gram")).agg(F.count("*").alias("n"))))
    out: list[tuple[DataFrame, DataFrame]] = []
    for k in range(1, order + 1):
        grams = tables[k - 1]
        many = [F.sum((F.col("n") == i).cast("long")).alias(f"n{i}") for i in (1, 2, 3, 4)]
        off, lower = F.lit(0.0), F.lit(0.0)
        for row in grams.groupBy(*keys).agg(*many, F.count("*").alias("grams")).collect():  # one row a model
            d = discounts([row[f"n{i}"] or 0 for i in (1, 2, 3, 4)])
            mine = F.col("model") == row["model"] if keys else F.lit(True)
            off = F.when(mine, F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])).otherwise(off)
            lower = F.when(mine, F.lit(1.0 / (row["grams"] + 1))).otherwise(lower)
        keyed = grams.select(*keys, "gram", "n", off.alias("off"), F.expr(f"substring(gram, 1, {k - 1})").alias("context"))
        contexts = keep(keyed.groupBy(*keys, "context").agg(F.sum("n").alias("total"), (F.sum("off") / F.sum("n")).alias("g")))
        joined = keyed.join(contexts, [*keys, "context"])
        own = (F.col("n") - F.col("off")) / F.col("total")
        if k == 1:
            probabilities = joined.select(*keys, "gram", (own + F.col("g") * lower).alias("p"))
        else:
            below = out[-1][0].select(*keys, F.col("gram").alias("suffix"), F.col("p").alias("q"))
            joined = joined.withColumn("suffix", F.expr("substring(gram, 2)")).join(below, [*keys, "suffix"])
            probabilities = joined.select(*keys, "gram", (own + F.col("g") * F.col("q")).alias("p"))
        out.append((keep(probabilities), keep(contexts.select(*keys, "context", "g"))))
        del contexts, keyed, joined, probabilities, grams
        tables[k - 1] = counts  # what is done with need not stay on disk
        tidy(counts.sparkSession)
    return Smoothed(out, counts)


def unseen_symbol(smoothed: list[tuple[DataFrame, DataFrame]]) -> dict[int, float]:
    """Of each model that had any text, the natural log probability of a symbol that it has not seen."""
    grams, contexts = smoothed[0]
    sizes = grams.groupBy("model").agg(F.count("*").alias("grams"))
    return {r.model: float(np.log(r.g / (r.grams + 1))) for r in contexts.join(sizes, "model").collect()}  # one row a model


def log_probabilities(windows: DataFrame, smoothed: list[tuple[DataFrame, DataFrame]], unseen: dict[int, float]) -> DataFrame:
    """(gram, p0, p1, p2): natural log probability, by the model of that number, of the last symbol of each n-gram of
    the distinct (model, gram) in ``windows``. A model without text, which ``unseen`` lacks, gives 0."""
    spark, floor = windows.sparkSession, F.lit(0.0)
    written = bool(spark.conf.get(CHECKPOINT_KEY, None))  # by ``keep``
    for model, p in unseen.items():
        floor = F.when(F.col("model") == model, F.lit(p)).otherwise(floor)
    todo = windows.select("model", "gram", F.col("gram").alias("suffix"), F.lit(0.0).alias("weight"))
    found, cached = [], []
    for k in range(len(smoothed), 0, -1):  # what is not found at one length goes on to the next, with its context's weight
        grams, contexts = smoothed[k - 1]
        grams = grams.withColumnRenamed("gram", "suffix")
        found.append(todo.join(grams, ["model", "suffix"]).select("model", "gram", (F.col("weight") + F.log("p")).alias("p")))
        todo = todo.join(grams, ["model", "suffix"], "left_anti")
        if k > 1:
            todo = todo.withColumn("context", F.expr(f"substring(suffix, 1, {k - 1})")).join(contexts, ["model", "context"], "left")
            todo = todo.select("model", "gram", F.expr("substring(suffix, 2)").alias("suffix"), (F.col("weight") + F.coalesce(F.log("g"), F.lit(0.0))).alias("weight"))
        # packed in memory first; a checkpoint takes several times the space
        todo = todo.persist(StorageLevel.MEMORY_AND_DISK) if written else keep(todo)
        cached.append(todo)
    every = reduce(DataFrame.unionAll, found, todo.select("model", "gram", (F.col("weight") + floor).alias("p")))
    every = keep(every.groupBy("gram").agg(*[F.max(F.when(F.col("model") == m, F.col("p"))).alias(f"p{m}") for m in (0, 1, TOXIC)]))
    if written:  # so nothing reads them any more
        for frame in cached:
            release(frame)
    return every


def discounts(n: list[int]) -> tuple[float, float, float]:
    """What is taken off counts of 1, 2 and more, from the numbers of grams seen 1 to 4 times."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    d = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else k * y for k in (1, 2, 3)]
    return tuple(min(max(x, 0.1), k - 0.05) for k, x in enumerate(d, 1))  # type: ignore[return-value]


class Shard:
    """Codes in order, with their values and, for each run of leading bits, where its codes begin: a join looks at
    one or two places for each code. Takes some 15 bytes a code."""

    def __init__(self, code: np.ndarray, value: np.ndarray):
        bits = max(1, len(code).bit_length() - 1)  # one or two codes a run
        self.shift = np.uint64(64 - bits)
        order = np.argsort(code)
        self.keys, self.values = code[order], value[order]
        runs = np.bincount((self.keys >> self.shift).astype(np.int64), minlength=1 << bits)
        self.starts = np.concatenate([[0], np.cumsum(runs)]).astype(np.int32)

    def join(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which codes are in the shard, and their values (0 for the others)."""
        found, value = np.zeros(len(code), bool), np.zeros(len(code), self.values.dtype)
        run = (code >> self.shift).astype(np.int64)
        at, end = self.starts[run], self.starts[run + 1]
        open_ = np.flatnonzero(at < end)
        at, end, wanted = at[open_], end[open_], code[open_]
        while len(open_):
            key = self.keys[at]
            hit = key == wanted
            found[open_[hit]], value[open_[hit]] = True, self.values[at[hit]]
            go = (key < wanted) & (at + 1 < end)
            open_, at, end, wanted = open_[go], at[go] + 1, end[go], wanted[go]
        return found, value


class Model:
    """The finished tables of a small model in memory, one shard for each length of grams and of contexts; whole
    tables are scored with ``score``, which gives the same."""

    def __init__(self, smoothed: list[tuple[DataFrame, DataFrame]]):
        self.order = len(smoothed)
        self.grams = [self._shard(grams, k) for k, (grams, _) in enumerate(smoothed, 1)]
        self.contexts = [None, *(self._shard(contexts, k) for k, (_, contexts) in enumerate(smoothed[1:], 1))]
        rows = smoothed[0][1].first()
        self.known = rows is not None  # whether there was any text
        self.unknown = np.log((rows.g if rows else 1.0) / (smoothed[0][0].count() + 1))

    @staticmethod
    def _shard(df: DataFrame, length: int) -> Shard:
        """Codes are made by the tasks; the driver gets two packed arrays from each batch."""

        def pack(batches: Iterator[dict]) -> Iterator[dict]:
            for b in batches:
                grams, values = b.values()
                if len(grams):
                    code = gram_codes(from_text("".join(grams), length))
                    yield {"codes": [code.tobytes()], "values": [np.log(np.array(values)).astype(np.float32).tobytes()]}

        rows = arrow_map(df, pack, "codes binary, values binary").collect()
        return Shard(np.frombuffer(b"".join(r.codes for r in rows), np.uint64), np.frombuffer(b"".join(r["values"] for r in rows), np.float32))

    def log_p(self, points: np.ndarray) -> np.ndarray:
        """Natural log probability of each symbol of a padded array from ``order - 1`` on."""
        raw = raw_codes(points, self.order)
        found, total = self.grams[-1].join(finished(raw[-1], self.order))
        open_ = np.flatnonzero(~found)
        for k in range(self.order - 1, 0, -1):
            if not len(open_):
                return total
            # The context of k symbols: the k-gram that ends one place earlier.
            _, weight = self.contexts[k].join(self._context(points, open_, k))
            found, value = self.grams[k - 1].join(finished(raw[k - 1][open_], k))
            total[open_] += weight + value
            open_ = open_[~found]
        total[open_] += self.unknown
        return total

    def _context(self, points: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
        code, power = np.zeros(len(at), np.uint64), np.uint64(1)
        with np.errstate(over="ignore"):
            for k in range(length):
                code = code + points[at + self.order - 2 - k].astype(np.uint64) * power
                power = power * _A
        return finished(code, length)


class Scorer:
    """Symbols, costs and worst stretches of texts under the trusted model and, if there is one, the toxic one."""

    def __init__(self, trusted: Model, toxic: Model | None, window: int):
        self.trusted, self.toxic, self.window = trusted, toxic, window
        self.order = trusted.order

    def both(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        """Log probability of each symbol of a padded array, and the log ratio of the toxic one to it."""
        p = self.trusted.log_p(points).astype(float)
        return p, self.toxic.log_p(points) - p if self.toxic else None

    def score(self, texts: list[str | None]) -> tuple[list[int], list[float], list[float]]:
        """Symbols (the end counts), negative log probability, and the largest log ratio of the toxic to the trusted
        probability of ``window`` symbols in a row (0 at least), of each text, in bounded pieces."""
        order = self.order
        sizes, costs, worst = [0] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
        waiting: list[tuple[int, np.ndarray]] = []
        held, ends = 0, {}

        def flush() -> None:
            if not waiting:
                return
            points = np.concatenate([x for _, x in waiting])
            p, gain = self.both(points)
            at = 0
            for i, x in waiting:
                n = len(x) - order + 1
                costs[i] -= float(p[at : at + n].sum())
                if gain is not None:  # with the end of the piece before, so that no stretch is cut
                    own = np.concatenate([ends.get(i, np.zeros(0)), gain[at : at + n]])
                    total = np.concatenate([[0.0], np.cumsum(own)])
                    width = min(self.window, len(own))
                    worst[i] = max(worst[i], float((total[width:] - total[: len(total) - width]).max()))
                    ends[i] = own[-self.window + 1 :]
                at += len(x)
            waiting.clear()

        for i, text in enumerate(texts):
            if text:
                points = padded(text, order)
                sizes[i] = len(points) - order + 1
                for a in range(0, sizes[i], _PIECE):
                    waiting.append((i, points[a : a + _PIECE + order - 1]))
                    held += len(waiting[-1][1])
                    if held >= _PIECE:
                        flush()
                        held = 0
        flush()
        return sizes, costs, worst


class Told(Scorer):
    """A scorer by n-grams whose log probabilities, and log ratios if there are any, have been sent."""

    def __init__(self, grams: np.ndarray, p: np.ndarray, gain: np.ndarray | None, window: int):
        self.order, self.window, self.p, self.gain = grams.shape[1], window, p, gain
        self.places = Shard(gram_codes(grams), np.arange(len(grams), dtype=np.int32))

    def both(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        _, at = self.places.join(finished(raw_codes(points, self.order)[-1], self.order))
        return self.p[at], None if self.gain is None else self.gain[at]


def in_sample(share: float) -> Column:
    """Whether a text belongs to a share of all, by its hash."""
    return F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < int(1_000_000 * share)


def lessons(docs: DataFrame, good: DataFrame, bad: DataFrame) -> DataFrame:
    """(model, text): what each model learns from, all trusted texts and all toxic ones. A text labelled both
    ways teaches nothing toxic."""
    kinds = good.withColumn("bad", F.lit(False)).unionByName(bad.join(good, "doc_id", "left_anti").withColumn("bad", F.lit(True)))
    model = F.when(F.col("bad"), TOXIC).otherwise(in_sample(0.5).cast("int")).alias("model")
    # by shuffle whatever the size: labels are sent to all tasks only where tables are small, and figures from those tell nothing of others
    return docs.where(F.length("text") > 0).join(kinds.hint("merge"), "doc_id").select(model, "text")


def merged(parts: Iterator[tuple[np.ndarray, np.ndarray]], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of all parts, in order of their codes, and the sums of their counts."""
    grams, n = np.zeros((0, order), np.uint32), np.zeros(0, np.int64)
    waiting, held = [], 0

    def reduced() -> tuple[np.ndarray, np.ndarray]:
        every = np.concatenate([grams, *(g for g, _ in waiting)])
        found, first, place = np.unique(gram_codes(every), return_index=True, return_inverse=True)
        total = np.zeros(len(found), np.int64)
        np.add.at(total, place, np.concatenate([n, *(c for _, c in waiting)]))
        return every[first], total

    for part in parts:
        waiting.append(part)
        held += len(part[0])
        if held > max(_GRAMS, len(grams)):
            grams, n = reduced()
            waiting, held = [], 0
    return reduced() if waiting else (grams, n)


def shorter(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct n-grams without their first symbol, in how many ways each is preceded, and the place of each row's."""
    _, first, place, n = np.unique(gram_codes(grams[:, 1:]), return_index=True, return_inverse=True, return_counts=True)
    return grams[first, 1:], n, place


def merge(dealt: DataFrame, order: int) -> DataFrame:
    """(shard, model, grams, n, low, low_n, seen): packed n-grams and their counts, each n-gram once; those of ``LOW``
    symbols, with what this shard adds to their continuation counts; and how many of each length above, the longest
    first, have the counts 1 to 4."""
    low = min(LOW, order)

    def run(group: pa.Table) -> pa.Table:
        shard, model = (group[c][0].as_py() for c in ("shard", "model"))
        grams, n = merged(((unpack(g.as_py(), np.uint32, order).reshape(-1, order), unpack(c.as_py(), np.int64, 1)) for g, c in zip(group["grams"], group["n"])), order)
        by = in_order(grams)
        short, count, seen = grams, n, []
        for _ in range(order - low):
            seen += [int((count == i).sum()) for i in (1, 2, 3, 4)]
            short, count, _ = shorter(short)
        row = [shard, model, pack(grams[by]), pack(n[by]), pack(short), pack(count.astype(np.int64)), seen]
        kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 4, pa.list_(pa.int64())]
        return pa.table({k: pa.array([v], kind) for k, v, kind in zip(("shard", "model", "grams", "n", "low", "low_n", "seen"), row, kinds)})

    schema = "shard long, model int, grams binary, n binary, low binary, low_n binary, seen array<long>"
    return dealt.groupBy("shard", "model").applyInArrow(freed(run), schema)


def low_counts(taught: DataFrame, low: int) -> DataFrame:
    """(model, gram, n): the counts of the n-grams of ``low`` symbols in all shards."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            for model, grams, n in zip(b["model"], b["low"], b["low_n"]):
                n = unpack(n, np.int64, 1)
                yield {"model": [model] * len(n), "gram": _strings(unpack(grams, np.uint32, low).reshape(-1, low)), "n": n}

    parts = arrow_map(taught.select("model", "low", "low_n"), run, "model int, gram string, n long", rows=10)
    return parts.groupBy("model", "gram").agg(F.sum("n").alias("n"))


def shard_discounts(taught: DataFrame, order: int) -> dict[tuple[int, int], tuple[float, float, float]]:
    """(model, k) -> discounts, for the lengths above ``LOW``; the driver gets one row a model."""
    lengths = range(order, min(LOW, order), -1)
    sums = [F.sum(F.col("seen")[i]).alias(f"s{i}") for i in range(4 * len(lengths))]
    rows = taught.groupBy("model").agg(F.count("*").alias("shards"), *sums).collect() if sums else []
    return {(r.model, k): discounts([r[f"s{4 * i + j}"] for j in range(4)]) for r in rows for i, k in enumerate(lengths)}


class Backoff:
    """What one shard holds of a model: log probabilities of its n-grams above ``LOW`` symbols, and what their contexts
    leave to the next length, by code. ``ends`` and ``below`` have the pairs that the shard names."""

    def __init__(self, grams: np.ndarray, n: np.ndarray, off: dict[int, tuple[float, float, float]], ends: np.ndarray, below: np.ndarray):
        self.order, self.low, self.ends, self.below = grams.shape[1], min(LOW, grams.shape[1]), ends, below
        steps = []
        for k in range(self.order, self.low, -1):
            short, count, place = shorter(grams)
            steps.append((k, grams, n, place))
            grams, n = short, count
        p = np.exp(self._ending(grams))
        self.grams, self.contexts = {}, {}
        for k, grams, n, place in reversed(steps):
            context, of = np.unique(gram_codes(grams[:, :-1]), return_inverse=True)
            take = np.array([0.0, *off[k]])[np.minimum(n, 3)] if len(n) else np.zeros(0)
            total, left = (np.bincount(of, x, len(context)) for x in (n, take))
            p = (n - take) / total[of] + left[of] / total[of] * p[place]
            code = gram_codes(grams)
            by = np.argsort(code)
            self.grams[k], self.contexts[k] = (code[by], np.log(p[by])), (context, np.log(left / total))

    def _ending(self, grams: np.ndarray) -> np.ndarray:
        return _looked_up((self.ends, self.below), gram_codes(grams[:, -self.low :]))[1]

    def log_p(self, grams: np.ndarray) -> np.ndarray:
        """Natural log probability of the last symbol of each n-gram."""
        total, open_ = np.zeros(len(grams)), np.arange(len(grams))
        for k in range(self.order, self.low, -1):
            found, value = _looked_up(self.grams[k], gram_codes(grams[open_, -k:]))
            total[open_[found]] += value[found]
            open_ = open_[~found]
            total[open_] += _looked_up(self.contexts[k], gram_codes(grams[open_, -k:-1]))[1]
        total[open_] += self._ending(grams[open_])
        return total


def _looked_up(known: tuple[np.ndarray, np.ndarray], code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which codes are known, and their values (0 for the others)."""
    codes, values = known
    if not len(codes):
        return np.zeros(len(code), bool), np.zeros(len(code))
    at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
    found = codes[at] == code
    return found, np.where(found, values[at], 0.0)


def _bundles(docs: DataFrame) -> DataFrame:
    """(batch, rows): the rows of ``docs``, which has a column ``batch``, compressed; in a task those of a batch together."""

    def bundled(waiting: list[pa.RecordBatch]) -> pa.RecordBatch:
        every = pa.Table.from_batches(waiting)
        batch = every["batch"].to_numpy()
        by = np.argsort(batch, kind="stable")
        cuts = np.flatnonzero(np.diff(batch[by], prepend=-1))
        rows = []
        for a, z in zip(cuts, [*cuts[1:], len(by)]):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, every.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(every.take(by[a:z]))
            rows.append(sink.getvalue().to_pybytes())
        return pa.RecordBatch.from_arrays([pa.array(batch[by][cuts], pa.int64()), pa.array(rows, pa.binary())], names=["batch", "rows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0
        for b in batches:
            waiting.append(b)
            held += b.nbytes
            if held > 32_000_000:
                yield bundled(waiting)
                waiting, held = [], 0
        if held:
            yield bundled(waiting)

    return docs.mapInArrow(lambda batches: freeing(run(batches)), "batch long, rows binary")


def _opened(bundles: pa.ChunkedArray) -> Iterator[pa.Table]:
    for rows in bundles:
        with pa.ipc.open_stream(rows.as_buffer()) as read:
            yield read.read_all()


def _requests(bundles: DataFrame, order: int, shards: int) -> DataFrame:
    """(batch, model, shard, grams): the distinct n-grams of each batch, dealt into shards, packed."""

    def run(group: pa.Table) -> pa.Table:
        kinds: set[int] = set()

        def parts() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            waiting, held = [], 0
            for texts in _opened(group["rows"]):
                kinds.add(texts["model"][0].as_py())
                for text in texts["text"]:
                    text = text.as_py()
                    if text:
                        points = padded(text, order)
                        for a in range(0, len(points) - order + 1, 5 * _PIECE):
                            waiting.append(points[a : a + 5 * _PIECE + order - 1])
                            held += len(waiting[-1])
                            if held >= 5 * _PIECE:
                                yield distinct_grams(waiting, order)
                                waiting, held = [], 0
            if waiting:
                yield distinct_grams(waiting, order)

        grams, _ = merged(parts(), order)
        grams = grams[in_order(grams)]
        of = shard_of(grams, shards)
        rows = [(s, pack(grams[own])) for s in range(shards) if len(own := np.flatnonzero(of == s))]
        (kind,), batch = kinds, group["batch"][0].as_py()
        return pa.table(
            {
                "batch": pa.array([batch] * len(rows), pa.int64()), "model": pa.array([kind] * len(rows), pa.int32()),
                "shard": pa.array([r[0] for r in rows], pa.int64()), "grams": pa.array([r[1] for r in rows], pa.binary()),
            }
        )

    return bundles.groupBy("batch").applyInArrow(freed(run), "batch long, model int, shard long, grams binary")


def _endings(packed: DataFrame, order: int) -> DataFrame:
    """(shard, gram): the distinct last symbols, ``LOW`` of them, of all n-grams of each shard."""
    low = min(LOW, order)

    def run(group: pa.Table) -> pa.Table:
        ends = np.zeros((0, low), np.uint32)
        for grams in group["grams"]:
            more = unpack(grams.as_py(), np.uint32, order).reshape(-1, order)[:, order - low :]
            ends = np.concatenate([ends, more])
            ends = ends[np.unique(gram_codes(ends), return_index=True)[1]]
        return pa.table({"shard": pa.array([group["shard"][0].as_py()] * len(ends), pa.int64()), "gram": pa.array(_strings(ends), pa.string())})

    return packed.select("shard", "grams").groupBy("shard").applyInArrow(freed(run), "shard long, gram string")


def _answers(requests: DataFrame, taught: DataFrame, known: DataFrame, off: dict, order: int, judged: list[int], gains: bool) -> DataFrame:
    """(batch, grams, p, gain): each request with the log probabilities of its n-grams by its own model, and with what the
    toxic model adds to them, packed. ``known`` (shard, gram, p0, p1, p2) has the endings of the shards."""

    def run(rows: pa.Table, ends: pa.Table) -> pa.Table:
        codes = gram_codes(from_text("".join(ends["gram"].to_pylist()), min(LOW, order)))
        by = np.argsort(codes)
        tables: dict[int, Backoff] = {}
        asked = rows.filter(pa.compute.is_valid(rows["batch"]))
        own = {r["model"]: r for r in rows.filter(pa.compute.is_null(rows["batch"])).to_pylist()}
        for model in {*asked["model"].to_pylist(), *([TOXIC] if gains else [])}:
            grams, n = np.zeros((0, order), np.uint32), np.zeros(0, np.int64)
            if model in own:
                grams, n = unpack(own[model]["grams"], np.uint32, order).reshape(-1, order), unpack(own[model]["n"], np.int64, 1)
            mine = {k: off.get((model, k), (0.0, 0.0, 0.0)) for k in range(1, order + 1)}
            tables[model] = Backoff(grams, n, mine, codes[by], ends[f"p{model}"].to_numpy()[by])
        sent: list[list[bytes]] = [[], []]
        for model, grams in zip(asked["model"].to_pylist(), asked["grams"]):
            grams = unpack(grams.as_py(), np.uint32, order).reshape(-1, order)
            p = tables[model].log_p(grams)
            gain = tables[TOXIC].log_p(grams) - p if gains and model in judged else np.zeros(len(p))
            for out, v in zip(sent, (p, gain)):
                out.append(pack(v.astype(np.float32)))
        return pa.table(
            {"batch": asked["batch"].cast(pa.int64()), "grams": asked["grams"].cast(pa.binary()), "p": pa.array(sent[0], pa.binary()), "gain": pa.array(sent[1], pa.binary())}
        )

    none = F.lit(None)
    rows = requests.select("shard", "batch", "model", "grams", none.cast("binary").alias("n"))
    rows = rows.unionByName(taught.select("shard", none.cast("long").alias("batch"), "model", "grams", "n"))
    return rows.groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(freed(run), "batch long, grams binary, p binary, gain binary")


def score(docs: DataFrame, source: Lessons | Smoothed, window: int, batch_bytes: int = 16_000_000) -> DataFrame:
    """Rows (doc_id, lang, text_key, judged, symbols, cost, worst), one per row of ``docs``: number of symbols, nats, and
    the largest gain of a stretch; 0 for null and empty texts. A text is scored by the trusted model that it did not
    teach; where that had no text at all, ``judged`` is false and cost and gain are 0."""
    spark, order = docs.sparkSession, source.order
    size = text_bytes(docs)
    batches, shards = -(-buckets_for(spark, size, batch_bytes) // 2), buckets_for(spark, size, 16 * batch_bytes)
    taught = keep(merge(source.dealt(shards), order))
    tidy(spark)
    smoothed, off = smooth(low_counts(taught, min(LOW, order)), min(LOW, order)), shard_discounts(taught, order)
    unseen = unseen_symbol(smoothed)
    judged, gains = [m for m in unseen if m != TOXIC], TOXIC in unseen
    model = (1 - F.coalesce(in_sample(0.5), F.lit(False)).cast("int")).alias("model")
    dealt = docs.select("doc_id", "lang", "text", F.xxhash64("text").alias("text_key"), model)
    dealt = _bundles(dealt.withColumn("batch", F.col("model") * batches + F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches))))
    dealt = dealt.repartition(2 * batches, "batch")
    requests = keep(_requests(dealt, order, shards))
    tidy(spark)
    ends = keep(_endings(requests.select("shard", "grams").unionAll(taught.select("shard", "grams")), order))
    models = F.explode(F.array(*map(F.lit, (0, 1, TOXIC)))).alias("model")
    found = log_probabilities(ends.select("gram").distinct().select(models, "gram"), smoothed, unseen)
    known = keep(ends.join(found, "gram"))
    del ends, found, smoothed
    answers = _answers(requests, taught, known, off, order, judged, gains)
    tidy(spark)
    kinds = dict(docs.dtypes)

    def run(bundles: pa.Table, sent: pa.Table) -> pa.Table:
        grams = np.concatenate([np.zeros((0, order), np.uint32), *(unpack(x.as_py(), np.uint32, order).reshape(-1, order) for x in sent["grams"])])
        p, gain = (np.concatenate([np.zeros(0), *(unpack(x.as_py(), np.float32, 1) for x in sent[c])]) for c in ("p", "gain"))
        told = Told(grams, p, gain if gains else None, window)
        parts, rows = [], []
        for texts in _opened(bundles["rows"]):
            parts += [told.score(texts["text"].slice(a, 500).to_pylist()) for a in range(0, len(texts), 500)]
            rows.append(texts.select(["doc_id", "lang", "text_key", "model"]))
        sizes, costs, worst = (np.concatenate(x) for x in zip(*parts))
        texts = pa.concat_tables(rows)
        return pa.table(
            {
                **{c: texts[c] for c in ("doc_id", "lang", "text_key")},
                "judged": pa.array(np.isin(texts["model"].to_numpy(), judged)),
                "symbols": pa.array(sizes.astype(np.int64)), "cost": pa.array(costs), "worst": pa.array(worst),
            }
        )

    schema = f"doc_id {kinds['doc_id']}, lang {kinds['lang']}, text_key long, judged boolean, symbols long, cost double, worst double"
    return dealt.groupBy("batch").cogroup(answers.repartition(2 * batches, "batch").groupBy("batch")).applyInArrow(freed(run), schema)


def _quantiles(rows: list, q: float) -> dict:
    """Language, and ``*`` for all together -> (quantile, texts), from counts per thousandth."""
    by: dict = {}
    for r in rows:
        for lang in {r.lang, "*"}:
            by.setdefault(lang, []).append((r.bin, r.n))
    out = {}
    for lang, bins in by.items():
        left, n = q * sum(c for _, c in bins), sum(c for _, c in bins)
        for b, c in sorted(bins):
            left -= c
            if left <= 0:
                out[lang] = (b / 1000, n)
                break
    return out


def _binned(scored: DataFrame, value: Column) -> list:
    bins = scored.where("symbols > 0").select("lang", F.round(value * 1000).cast("long").alias("bin"))
    return bins.groupBy("lang", "bin").agg(F.count("*").alias("n")).collect()


def thresholds(scored: DataFrame, prior: int, beyond: float, least: int) -> tuple[dict[str | None, tuple[float, float]], tuple[float, float]]:
    """Per language, and for all languages together: (middle, threshold) of the log perplexity.

    ``scored`` holds (lang, symbols, cost) of trusted texts that the model has not seen. Counts per
    thousandth of a nat give exact quantiles of rounded values. First the medians, then, with each text
    drawn to its language's median by ``prior`` symbols, the 95 % quantile; the threshold lies
    ``beyond`` times its distance from the median above the median.
    """
    middles = _quantiles(_binned(scored, F.col("cost") / F.col("symbols")), 0.5)
    if not middles:
        return {}, (0.0, float("inf"))
    own = {lang: m for lang, (m, n) in middles.items() if n >= least and lang != "*"}
    everything = middles["*"][0]
    middle = _lookup({k: v for k, v in own.items() if k is not None}, everything)
    high = _quantiles(_binned(scored, (F.col("cost") + prior * middle) / (F.col("symbols") + prior)), 0.95)
    bound = lambda m, h: m + max(beyond * (h - m), 0.05)
    return {k: (m, bound(m, high[k][0])) for k, m in own.items() if k is not None}, (everything, bound(everything, high["*"][0]))


def stretch_limits(scored: DataFrame, beyond: float, least: int) -> tuple[dict[str, float], float]:
    """Per language, and for all together: the largest ``worst`` that a text may have. It lies ``beyond`` times the
    distance of the 99 % quantile from the median above the median, both of trusted texts not trained on."""
    rows = _binned(scored, F.col("worst"))
    middle, high = _quantiles(rows, 0.5), _quantiles(rows, 0.99)
    limit = {k: m + max(beyond * (high[k][0] - m), 5.0) for k, (m, _) in middle.items()}
    return {k: v for k, v in limit.items() if k not in (None, "*") and middle[k][1] >= least}, limit.get("*", float("inf"))


def _lookup(values: dict[str, float], otherwise: float) -> Column:
    if not values:
        return F.lit(otherwise)
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[F.col("lang")], F.lit(otherwise))


def classify(
    docs: DataFrame, labels: DataFrame, *, order: int = 5, prior: int = 200, beyond: float = 4.0, least: int = 50, window: int = 16, beyond_worst: float = 2.0,
) -> DataFrame:
    """Rows (doc_id, lang, text_key, symbols, perplexity, threshold, worst, worst_limit, rejected), one per row of
    ``docs``. ``text_key`` is a hash of the text.

    Trusted texts are those that ``labels`` calls of good quality and not toxic. ``perplexity`` is per
    symbol, drawn to the language's median by ``prior`` symbols so that short texts are not judged by a
    few letters. ``worst`` is the largest log ratio of the probabilities of ``window`` symbols in a row under the
    model of all texts labelled toxic, of whatever quality, and the trusted one. A document is rejected when either lies
    beyond its limit. A language with fewer than ``least`` trusted texts, and a null one,
    use the quantiles of all languages. Null and empty texts have no perplexity and are rejected.
    Without any trusted text nothing else is rejected, nor where all trusted texts fall into one half; without toxic
    ones ``worst`` is 0. Repeated labels count once, null labels not at all. Other columns are ignored.
    """
    docs = private(docs, doc_id="doc_id", text="text", lang="lang")
    labels = private(labels, doc_id="doc_id", quality="quality", toxic="toxic")
    good = labels.where("quality = 1 AND coalesce(toxic, 0) = 0").select("doc_id").distinct()
    bad = labels.where("toxic = 1").select("doc_id").distinct()
    scored = keep(score(docs, Lessons(lessons(docs, good, bad), order), window))
    taught = scored.join(bad.join(good, "doc_id", "left_anti"), "doc_id", "left_semi").select("text_key").distinct()
    # a trusted text that is a copy of a toxic one is not unseen by the toxic model
    unseen = keep(scored.where("judged").join(good, "doc_id", "left_semi").join(taught, "text_key", "left_anti"))
    by_lang, everything = thresholds(unseen, prior, beyond, least)
    middle = _lookup({k: v[0] for k, v in by_lang.items()}, everything[0])
    limit = F.exp(_lookup({k: v[1] for k, v in by_lang.items()}, everything[1]))
    worst_limit = _lookup(*stretch_limits(unseen, beyond_worst, least))
    perplexity = F.when(F.col("symbols") > 0, F.exp((F.col("cost") + prior * middle) / (F.col("symbols") + prior)))
    out = scored.select(
        "doc_id", "lang", "text_key", "symbols", perplexity.alias("perplexity"), limit.alias("threshold"), "worst", worst_limit.alias("worst_limit")
    )
    return out.withColumn("rejected", F.coalesce((F.col("perplexity") > F.col("threshold")) | (F.col("worst") > F.col("worst_limit")), F.lit(True)))


def op4_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("text_key")
