"""Vector bin packing of token sequences: limits on tokens, segments and loss-bearing tokens at once.

Each task tokenizes its documents and packs them as it goes. A document's full sequences are cut off
first; what remains waits in a bounded pool. A bin is filled by the dot-product heuristic: of the
pieces that fit in all dimensions, the one whose demand points most along what the bin has left.
When no whole piece fits, the one is cut that can give the bin most; where its loss-bearing tokens are used
up, that is prompt. A bin that a limit other than tokens has closed, and the last ones of a task, are
trimmed to a power of two, whose tail goes back to the pool: such sequences need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, private, table, token_ids

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "loss_tokens long"
)


class Packer:
    """Packs pieces of documents for one task; holds at most ``pool`` remainders."""

    def __init__(self, tokens: int, segments: int, loss: int, pool: int = 512):
        if tokens & (tokens - 1) or min(tokens, segments, loss) < 1:
            raise ValueError("the token limit is a power of two and every limit is at least 1")
        self.limit, self.pool = np.array([tokens, segments, loss], float), pool
        self.waiting: list[tuple] = []  # (doc_id, start, ids, first position that bears loss, tokens of the document)
        self.need = np.zeros((2 * pool + 8, 3))
        self.sequences = 0

    def add(self, doc_id: int, ids: np.ndarray, loss_from: int = 0) -> Iterator[tuple]:
        """Take a document; give the pieces of the sequences that are full now."""
        start, total, most = 0, len(ids), int(self.limit[0])
        while total - start >= most and total - max(start, loss_from) >= 0:
            piece = (doc_id, start, ids[start : start + most], loss_from, total)
            if self._loss(piece) > self.limit[2]:
                break
            yield from self._emit([piece])
            start += most
        while start < total:  # one remainder, or several where the loss limit is under the token limit
            end = self._end(start, min(total, start + most), loss_from, int(self.limit[2]))
            self._wait((doc_id, start, ids[start:end].copy(), loss_from, total))
            start = end
            if len(self.waiting) >= self.pool:
                yield from self._fill(self.pool // 2)

    def finish(self) -> Iterator[tuple]:
        yield from self._fill(0)

    @staticmethod
    def _end(start: int, end: int, loss_from: int, loss: int) -> int:
        return min(end, max(start, loss_from) + loss)

    @staticmethod
    def _loss(piece: tuple) -> int:
        return max(0, piece[1] + len(piece[2]) - max(piece[1], piece[3]))

    def _wait(self, piece: tuple) -> None:
        if len(self.waiting) == len(self.need):
            self.need = np.concatenate([self.need, np.zeros_like(self.need)])
        self.need[len(self.waiting)] = (len(piece[2]), 1, self._loss(piece))
        self.waiting.append(piece)

    def _take(self, k: int) -> tuple:
        piece, last = self.waiting[k], self.waiting.pop()
        if k < len(self.waiting):
            self.waiting[k] = last
            self.need[k] = self.need[len(self.waiting)]
        return piece

    def _cut(self, piece: tuple, length: int) -> tuple:
        """The first ``length`` ids; the others wait."""
        doc_id, start, ids, loss_from, total = piece
        if length < len(ids):
            self._wait((doc_id, start + length, ids[length:], loss_from, total))
        return (doc_id, start, ids[:length], loss_from, total)

    def _fill(self, down_to: int) -> Iterator[tuple]:
        while len(self.waiting) > down_to:
            left, chosen = self.limit.copy(), []
            while self.waiting and left[:2].min() >= 1:
                need = self.need[: len(self.waiting)]
                fits = (need <= left).all(axis=1)
                if fits.any():
                    along = (need / self.limit) @ (left / self.limit)
                    piece = self._take(int(np.argmax(np.where(fits, along, -1.0))))
                else:
                    # what a piece can give: its prompt comes first, then as much as bears the loss that is left
                    give = np.minimum(need[:, 0] - need[:, 2] + left[2], left[0])
                    best = int(np.lexsort((need[:, 0], give))[-1])
                    if give[best] < 1:
                        break
                    piece = self._take(best)
                    piece = self._cut(piece, self._end(piece[1], piece[1] + min(len(piece[2]), int(left[0])), piece[3], int(left[2])) - piece[1])
                chosen.append(piece)
                left -= (len(piece[2]), 1, self._loss(piece))
            held = int(self.limit[0] - left[0])
            over = held - (1 << (held.bit_length() - 1))
            while over:  # trim to a power of two
                piece = chosen.pop()
                if len(piece[2]) <= over:
                    self._wait(piece)
                    over -= len(piece[2])
                else:
                    chosen.append(self._cut(piece, len(piece[2]) - over))
                    over = 0
            yield from self._emit(chosen)

    def _emit(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for p in pieces:
            yield (p[0], p[1], len(p[2]), zlib.crc32(p[2].tobytes()), p[4], self.sequences, offset, self._loss(p))
            offset += len(p[2])
        self.sequences += 1


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    loss_from_col: str | None = None,
    prompt_chars_col: str | None = None,
    end_id: int = 1,
    max_tokens: int = 2048,
    max_segments: int = 256,
    max_loss: int | None = None,
    pool: int = 512,
) -> DataFrame:
    """One row per piece (``PIECES``): which ids of which document lie where in which sequence.

    A document's ids are its text's ids and then ``end_id``; a null text counts as empty. With
    ``loss_from_col`` the first so many ids of a document bear no loss (a prompt), with ``prompt_chars_col``
    as many as its first so many code points have by themselves; else all do. Null and negative counts are 0.
    ``max_loss`` is ``max_tokens`` if not given. Sequence ids are unique and hold the task's number in
    their upper bits; they have gaps between tasks. Repeated rows are packed once each. Columns other
    than the named ones are ignored. An empty table gives no pieces.
    """
    limits = (max_tokens, max_segments, max_loss or max_tokens, pool)

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        packer, first = Packer(*limits), TaskContext.get().partitionId() << 40

        def frame(rows: list[tuple]) -> dict:
            out = dict(zip((c.split()[0] for c in schema.split(", ")), zip(*rows)))
            return out | {"sequence_id": [first + s for s in out["sequence_id"]]}

        rows: list[tuple] = []
        for batch in batches:
            for doc_id, text, skip, chars in zip(batch["doc_id"], batch["text"], batch["loss_from"], batch["prompt_chars"]):
                if text and chars:
                    skip = len(token_ids(text[:chars], vocabulary, end_id)) - 1
                rows.extend(packer.add(doc_id, token_ids(text, vocabulary, end_id), skip))
                if len(rows) >= 20_000:
                    yield frame(rows)
                    rows = []
        rows.extend(packer.finish())
        if rows:
            yield frame(rows)

    counts = {"loss_from": loss_from_col, "prompt_chars": prompt_chars_col}
    own = private(docs, doc_id=id_col, text=text_col, **{k: c for k, c in counts.items() if c})
    own = own.withColumns({k: F.greatest(F.coalesce(k, F.lit(0)), F.lit(0)) if c else F.lit(0) for k, c in counts.items()})
    schema = PIECES.replace("doc_id long", f"doc_id {dict(own.dtypes)['doc_id']}")
    return arrow_map(own, run, schema)


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pack_with_prompts(docs: DataFrame, vocabulary: str, **limits: int) -> DataFrame:
    """``pack_documents`` of rows (doc_id, text) whose first line is the prompt, where a text has more lines than
    one: at most 8 segments and 1,920 loss-bearing tokens among the 2,048 of a sequence, unless ``limits`` say otherwise."""
    rows = private(docs, doc_id="doc_id", text="text")
    rows = rows.withColumn("prompt_chars", F.greatest(F.instr("text", "\n") - 1, F.lit(0)))
    return pack_documents(rows, vocabulary, prompt_chars_col="prompt_chars", **({"max_segments": 8, "max_loss": 1920} | limits))


def op5_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences, their first lines as prompts; see ``pack_documents``."""
    return pack_with_prompts(table(spark, sf_dir, "documents"), vocabulary_path())
