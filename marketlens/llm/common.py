"""Small helpers that the operators share."""

from __future__ import annotations

import ctypes
import os
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.session import keep

__all__ = ["arrow_map", "buckets_for", "freed", "freeing", "keep", "mix", "pieces", "private", "table", "text_bytes", "token_ids", "word_codes"]

_ARROW = {
    "int": pa.int32(), "long": pa.int64(), "bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(),
    "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def private(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names; whatever else the table holds, under
    whatever name, cannot clash."""
    return df.select(*(F.col(f"`{source}`").alias(own) for own, source in columns.items()))


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
_SLACK = 16_000_000
_level, _at = 0, 0.0  # resident bytes after memory last went back, and when that was


def resident() -> int:
    """Bytes of memory that this process holds; 0 where the system does not tell."""
    try:
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")
    except OSError:
        return 0


def give_back() -> None:
    """Hand memory that is free within this process back to the system, if it was not done a moment ago or there may
    be much of it. Python workers outlive their tasks: an idle one would else hold the most that any of its tasks took,
    beside whatever runs now."""
    global _level, _at
    if _TRIM and (time.monotonic() > _at + 1 or resident() > _level + _SLACK):
        pa.default_memory_pool().release_unused()
        _TRIM(0)
        _level, _at = resident(), time.monotonic()


def freeing(out: Iterator) -> Iterator:
    """The same, and at its end memory goes back."""
    try:
        yield from out
    finally:
        give_back()


def freed(fn: Callable[..., pa.Table]) -> Callable[..., pa.Table]:
    """For ``applyInArrow``, a function of one or two tables: the same, and after each group memory goes back."""

    def one(rows: pa.Table) -> pa.Table:
        try:
            return fn(rows)
        finally:
            give_back()

    def two(left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return fn(left, right)
        finally:
            give_back()

    return two if fn.__code__.co_argcount == 2 else one


def arrow_map(df: DataFrame, fn: Callable[[Iterator[dict]], Iterator[dict]], schema: str, rows: int | None = None) -> DataFrame:
    """``mapInArrow`` with batches as dicts of lists: nulls stay None and whole numbers stay whole.

    ``fn`` turns an iterator of batches into one of batches, for a whole partition. ``rows`` cuts Spark's batches
    into smaller ones, so that fewer texts are Python objects at a time."""
    fields = [c.split(" ", 1) for c in schema.split(", ")]
    out = pa.schema([(name, _ARROW[kind]) for name, kind in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = (b.slice(i, rows or b.num_rows) for b in batches for i in range(0, b.num_rows, rows or b.num_rows or 1))
        for found in fn(b.to_pydict() for b in cut):
            yield pa.RecordBatch.from_arrays([pa.array(found[f.name], f.type) for f in out], schema=out)

    return df.mapInArrow(lambda batches: freeing(run(batches)), schema)


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts: what bucket counts are derived from."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def buckets_for(spark: SparkSession, amount: float, per_bucket: float) -> int:
    """Buckets so that each holds about ``per_bucket``, and no fewer than the shuffle setting."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(-(-amount // per_bucket)))


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: neighbouring inputs give unrelated outputs."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_P = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of ``_P`` and of its inverse, modulo 2^64, from 0 to at least ``n - 1``."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_P, pow(_P, -1, 1 << 64))):
            steps = np.full(max(n, 1 << 18), base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS


def word_codes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit codes of the words of all texts, one text after the other; the code of each word's last three
    bytes; and the number of words of each text.

    Words are runs of other than blank, tab and the ASCII line breaks, A-Z lower-cased. A word's code comes
    from the difference of running sums of its bytes times powers of an odd number, so the texts are worked
    on as whole arrays.
    """
    counts = np.zeros(len(texts), np.int64)
    data = b"\n".join(t or b"" for t in texts)
    raw = _LOWER[np.frombuffer(data, np.uint8)]
    word = np.concatenate([[False], ~_BLANK[raw], [False]])
    edges = np.flatnonzero(word[1:] != word[:-1])
    first, last = edges[0::2], edges[1::2]
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), counts
    power, inverse = _powers(len(raw))
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[: len(raw)])])
        length = (last - first).astype(np.uint64)
        codes = mix((sums[last] - sums[first]) * inverse[first] + length * np.uint64(0xC2B2AE3D27D4EB4F))
        ends = np.zeros(len(first), np.uint64)
        for k in (1, 2, 3):
            at = last - k
            ends = ends * np.uint64(257) + np.where(at >= first, raw[np.maximum(at, 0)].astype(np.uint64) + np.uint64(1), np.uint64(0))
    starts = np.cumsum([0] + [len(t or b"") + 1 for t in texts])
    at = np.searchsorted(first, starts)
    return codes, ends, at[1:] - at[:-1]


def pieces(texts: list[bytes | None], most: int = 250_000) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about ``most`` bytes (a longer text is a run of its own)."""
    a, held = 0, 0
    for z, text in enumerate(texts):
        if held and held + len(text or b"") > most:
            yield a, z
            a, held = z, 0
        held += len(text or b"")
    if a < len(texts):
        yield a, len(texts)


_ENCODERS: dict[str, object] = {}


def encoder(vocabulary: str):
    """``text -> ids`` of a byte-level BPE vocabulary, one encoder per process.

    A ``.json`` path loads that tokenizer. Its special tokens are found in texts, as the file says.
    Where a ``.tiktoken`` file of the same stem lies beside it, ordinary text goes through that one,
    which holds the same merges and is several times faster; only texts that hold a special token's
    string take the first one.
    """
    if vocabulary not in _ENCODERS:
        import base64
        import json
        import os

        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        whole = Tokenizer.from_file(vocabulary)
        ranks_file = vocabulary.removesuffix(".json") + ".tiktoken"
        slow = lambda text: whole.encode(text, add_special_tokens=False).ids
        if os.path.exists(ranks_file):
            with open(ranks_file, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
            with open(vocabulary, encoding="utf-8") as f:
                special = [t["content"] for t in json.load(f).get("added_tokens", [])]
            _ENCODERS[vocabulary] = lambda text: slow(text) if any(s in text for s in special) else fast(text)
        else:
            _ENCODERS[vocabulary] = slow
    return _ENCODERS[vocabulary]


def token_ids(text: str | None, vocabulary: str, end_id: int) -> np.ndarray:
    """Ids of a text (null: empty), then ``end_id``, as little-endian unsigned 32-bit numbers."""
    ids = encoder(vocabulary)(text) if text else []
    return np.asarray([*ids, end_id], "<u4")
