"""Corpus pipeline: quality, near duplicates, benchmark passages, personal data, packing.

Each stage takes (spark, docs, sf_dir) and gives a frame. All but the last give the columns of
``documents``, whatever others the table holds besides. ``run`` applies the stages one after the other;
what a stage gives is written to the shared folder and read again by the next.

Rows are told apart by ``doc_id`` and text: a null id is an id like any other, except that rows without
an id are never near duplicates. Null and empty texts are rejected by the first stage. Of repeated rows
one stays. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import decontamination, jaccard, packing, pii, quality
from marketlens.llm.common import keep, table
from marketlens.session import CHECKPOINT_KEY, remove_folder, shared_folder, tidy


#: Verdicts that are sent to all tasks at most; more are joined by a shuffle.
SENT_ROWS = 300_000


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose (doc_id, text_key) is not in ``gone``; null ids match null ids. Where few rows
    go, their keys are sent to the texts, which then are not shuffled."""
    gone = keep(gone.select("doc_id", "text_key"))
    same = F.col("d.doc_id").eqNullSafe(F.col("v.doc_id")) & (F.xxhash64(F.col("d.text")) == F.col("v.text_key"))
    side = F.broadcast(gone) if gone.limit(SENT_ROWS + 1).count() <= SENT_ROWS else gone
    return docs.alias("d").join(side.alias("v"), same, "left_anti")


def reject_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose perplexity lies beyond their language's quantiles."""
    found = quality.classify(docs, table(spark, sf_dir, "labels"))
    return _without(docs, found.where("rejected"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of linked documents: the one with the smallest id. Documents link when
    they share at least 0.8 of their shingles of five words."""
    classes = keep(jaccard.jaccard_classes(docs, width=5, num=80, den=100))
    kept = _without(docs, classes.where("component_id IS NOT NULL AND doc_id <> component_id"))
    repeated = classes.where("doc_id IS NOT NULL").groupBy("doc_id", "text_key").count().where("count > 1")
    if repeated.limit(1).count():  # rows that are the same in id and text
        kept = kept.where("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"]).unionByName(kept.where("doc_id IS NULL"))
    return kept


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents of which at least 5 % are passages of the benchmark."""
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, found.where("contaminated"))


def redact_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With personal data replaced by its kind in brackets, and ``n_chars`` of the new text."""
    return pii.redact_documents(docs, pii.fit(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of at most 2048 tokens, with limits on segments and loss."""
    return packing.pack_with_prompts(docs, packing.vocabulary_path())


STAGES = [
    ("quality classifier", reject_poor),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("PII", redact_personal),
    ("packing", pack),
]

ORACLE_SQL = None  # a trained model decides in two stages; tests hold the result against a plain version


def _written(df: DataFrame) -> tuple[DataFrame, str | None]:
    """The rows as written to the shared folder, and where; kept without a folder if the session names none."""
    spark = df.sparkSession
    if not spark.conf.get(CHECKPOINT_KEY, None):
        return keep(df), None
    path = shared_folder(spark, "pipeline")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, at = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            read, (docs, at) = at, _written(docs)
            if read:
                remove_folder(spark, read)  # what the stage has read is not needed again
            tidy(spark)
    return docs
