"""Homomorphic multiset fingerprints of texts, in DataFrame functions only.

A text is the multiset of its paragraphs, long ones cut after sentences. Each paragraph is hashed to
126 bits, and a fingerprint is the sum of the paragraphs' bit vectors, kept as 42 whole numbers of three
21-bit counters, each number modulo 2^62, and the number of paragraphs. Order does not matter, adding or
taking away a paragraph adds or subtracts its vector, and equal texts have equal fingerprints.

Read as votes (a 1 bit is +1, a 0 bit is -1) the product of two sums has, in each of the 126 places, an
expected value equal to the number of paragraphs that both sides have; that gives the likeness.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import private, table

SHIFTS = 21
MODULUS_BITS = 62
_MASK = (1 << MODULUS_BITS) - 1
_BITS = 1 | 1 << 21 | 1 << 42


def paragraphs(text: Column) -> Column:
    """Lines without blanks at their ends; a line is cut after ``.``, ``!`` or ``?`` and a blank. The
    empty text has none."""
    units = F.split(text, r"\s*\n\s*|(?<=[.!?])[ \t]+")
    return F.filter(F.transform(units, lambda u: F.trim(u)), lambda u: u != "")


def hashes(units: Column) -> Column:
    """Two 64-bit hashes of each paragraph."""
    return F.transform(units, lambda u: F.struct(F.xxhash64(F.lit(1), u).alias("a"), F.xxhash64(F.lit(2), u).alias("b")))


def fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """``out``: the fingerprint of column ``text`` as an array of 42 sums and the number of paragraphs."""
    held = f"{out}_hashes"
    df = df.withColumn(held, hashes(paragraphs(F.col(text))))

    def sums(part: str) -> Column:
        bits = lambda h, r: F.shiftrightunsigned(h.getField(part), r).bitwiseAND(F.lit(_BITS))
        add = lambda r: lambda total, h: (total + bits(h, r)).bitwiseAND(F.lit(_MASK))
        return F.array(*(F.aggregate(held, F.lit(0).cast("long"), add(r)) for r in range(SHIFTS)))

    return df.withColumn(out, F.concat(sums("a"), sums("b"), F.array(F.size(held).cast("long")))).drop(held)


def insert(a: Column, b: Column) -> Column:
    """Fingerprint of the union of two multisets: of a text with more paragraphs."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(_MASK)))


def delete(a: Column, b: Column) -> Column:
    """Fingerprint without the paragraphs that ``b`` stands for."""
    return F.zip_with(a, b, lambda x, y: (x - y).bitwiseAND(F.lit(_MASK)))


def votes(a: Column) -> Column:
    """The 126 signed sums of a fingerprint: ones minus zeros in each place."""
    n = F.get(a, F.lit(2 * SHIFTS))
    ones = lambda x, at: F.shiftrightunsigned(x, at).bitwiseAND(F.lit((1 << 21) - 1))
    return F.flatten(F.transform(F.slice(a, 1, 2 * SHIFTS), lambda x: F.array(*((2 * ones(x, at) - n).cast("double") for at in (0, 21, 42)))))


def likeness(a: Column, b: Column) -> Column:
    """``2 a.b / (a.a + b.b)`` of the votes, which estimates the share of paragraphs in common (repeated
    ones weigh by the square of their number); 0 at least, 1 for equal fingerprints and two empty texts."""
    a_sum, b_sum, both = (
        F.aggregate(F.zip_with(votes(x), votes(y), lambda p, q: p * q), F.lit(0.0), lambda t, v: t + v) for x, y in ((a, a), (b, b), (a, b))
    )
    return F.when(a == b, 1.0).otherwise(F.greatest(F.lit(0.0), F.coalesce(F.try_divide(2 * both, a_sum + b_sum), F.lit(1.0))))


def as_text(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def ring(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with ``range`` and ``extra``: ids are dealt into ranges by their quantiles,
    and the first row of each range (of the largest id) comes once more, marked extra, as the end of the
    range before it, that of the first range as the end of the last. One extra row for each range."""
    spark = docs.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.agg(F.percentile_approx("doc_id", [k / ranges for k in range(1, ranges)], 100 * ranges)).first()[0] if ranges > 1 else None
    docs = docs.withColumn("range", _range(F.col("doc_id"), sorted(set(cuts or []), reverse=True)))
    heads = docs.groupBy("range").agg(F.max("doc_id").alias("doc_id")).orderBy("range").collect()  # a row for each range
    whole = docs.withColumn("extra", F.lit(0))
    if not heads:
        return whole
    after = [(heads[(k + 1) % len(heads)].doc_id, h.range) for k, h in enumerate(heads)]
    links = F.broadcast(spark.createDataFrame(after, f"head {dict(docs.dtypes)['doc_id']}, before int"))
    extra = (
        docs.join(links, F.col("doc_id").eqNullSafe(F.col("head"))).groupBy("before").agg(F.max("doc_id").alias("doc_id"), F.min("text").alias("text"))
        .select("doc_id", "text", F.col("before").alias("range"), F.lit(1).alias("extra"))
    )
    return whole.unionByName(extra)


def following(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of ``ring`` that are not extra, with ``next_<column>`` of the following row by descending
    ``doc_id`` (ties: by text; nulls last); each range is one ordered window."""
    order = Window.partitionBy("range").orderBy("extra", F.col("doc_id").desc_nulls_last(), "text")
    return rows.select("*", *(F.lead(c).over(order).alias(f"next_{c}") for c in columns)).where("extra = 0").drop("extra", "range")


def _range(doc_id: Column, cuts: list) -> Column:
    """Number of the id's range, 0 for the largest ids, by halving; null ids are the last."""

    def pick(low: int, high: int) -> Column:  # ranges low..high
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(doc_id > F.lit(cuts[middle]), pick(low, middle)).otherwise(pick(middle + 1, high))

    return F.when(doc_id.isNull(), F.lit(len(cuts) + 1)).otherwise(pick(0, len(cuts))).cast("int")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    A null text counts as empty. The edited text has its last half replaced by the start of the next
    document. One document alone is its own next. Repeated rows stay. Other columns are ignored.
    """
    docs = private(docs, doc_id="doc_id", text="text").withColumn("text", F.coalesce("text", F.lit("")))
    docs = following(fingerprint(ring(docs), "text", "own"), ["text", "own"])
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half))
    docs = fingerprint(docs.withColumn("edited", edited), "edited", "changed")
    return docs.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )


def op10_multiset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
