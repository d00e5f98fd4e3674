"""Language identification by rank order: a text's most frequent letter n-grams are held against each
language's, and the language with the smallest out-of-place distance wins.

N-grams of 1 to 3 characters are taken from the lower-cased text in which every run of characters that
are not letters is one gap; grams made of a gap alone do not count. Learning counts grams per language
over all learning texts in Spark; only the ``size`` best of each language come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_map, private, table

UNKNOWN = "und"
_LETTERS: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTERS


def code_points(text: str | None) -> np.ndarray:
    """Lower-cased code points, gaps as one 0 each, with a 0 at both ends; empty without a letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    points = np.where(_letters()[points], points, 0)
    if not points.any():
        return points[:0]
    points = np.concatenate([[0], points, [0]])
    return points[np.concatenate([[True], (points[1:] != 0) | (points[:-1] != 0)])]


def grams(points: np.ndarray) -> np.ndarray:
    """Codes of all 1- to 3-grams; a gap alone and a gram with a gap inside are left out."""
    two = (points[:-1] << 21) | points[1:]
    three = (two[:-1] << 21) | points[2:]
    return np.concatenate([points[points != 0], two, three[points[1:-1] != 0]])


def ranked(codes: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent codes, most frequent first, ties by code."""
    found, counts = np.unique(codes, return_counts=True)
    return found[np.argsort(-counts, kind="stable")[:size]]


def learn_profiles(docs: DataFrame, size: int = 300) -> DataFrame:
    """Rows (lang, gram, place): the ``size`` most frequent grams of each language, place from 0.

    ``docs`` holds ``text`` and ``lang``; rows without either, and texts without letters, teach nothing.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                waiting, held = [], 0
                for k, text in enumerate(texts, 1):
                    waiting.append(code_points(text))
                    held += len(waiting[-1])
                    if held > 2_000_000 or k == len(texts):
                        if held:
                            found, n = np.unique(grams(np.concatenate(waiting)), return_counts=True)
                            yield pd.DataFrame({"lang": lang, "gram": found, "n": n})
                        waiting, held = [], 0

    own = private(docs, text="text", lang="lang").where("text IS NOT NULL AND lang IS NOT NULL")
    counts = own.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = counts.where("gram <> 0")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return counts.withColumn("place", place).where(F.col("place") <= size).select("lang", "gram", (F.col("place") - 1).alias("place"))


class Profiles:
    """Profiles as one sorted gram array and a rank table (grams x languages)."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int):
        self.size, self.langs = size, sorted({r[0] for r in rows})
        self.grams = np.unique(np.array([r[1] for r in rows], np.int64))
        self.places = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int64)  # the last row: unknown grams
        column = {lang: k for k, lang in enumerate(self.langs)}
        for lang, gram, place in rows:
            self.places[np.searchsorted(self.grams, gram), column[lang]] = place

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and likeness: 1 minus the distance as a share of the largest possible one."""
        points = code_points(text)
        if not len(points) or not self.langs:
            return UNKNOWN, 0.0
        mine = ranked(grams(points), self.size)
        at = np.searchsorted(self.grams, mine)
        at[(at == len(self.grams)) | (self.grams[np.minimum(at, len(self.grams) - 1)] != mine)] = len(self.grams)
        theirs = self.places[at]
        apart = np.where(theirs < 0, self.size, np.abs(theirs - np.arange(len(mine))[:, None])).sum(axis=0)
        best = int(np.argmin(apart))
        return self.langs[best], float(1 - apart[best] / (self.size * len(mine)))


def identify(docs: DataFrame, profiles: DataFrame, size: int = 300) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` to each row's (doc_id): ``und`` and 0 for a null text, one
    without letters, or when no language was learned. Ties go to the first language by name. What the
    driver and the tasks hold is ``size`` rows for each language learned."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(Profiles([tuple(r) for r in profiles.collect()], size))

    def predict(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            found = [model.value.predict(t) for t in batch["text"]]
            yield {"doc_id": batch["doc_id"], "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}

    own = private(docs, doc_id="doc_id", text="text")
    return arrow_map(own, predict, f"doc_id {dict(own.dtypes)['doc_id']}, lang_pred string, score double")


def op8_rank_order_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    found = identify(docs, learn_profiles(docs.where(~out)))
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")
