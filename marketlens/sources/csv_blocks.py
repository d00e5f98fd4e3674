"""CSV with newlines inside quoted fields, read by many tasks per file.

Spark splits a text file at any newline; whether that newline ends a record depends on how many quotes stand before
it. One pass counts the quotes of each block. The parity before a block follows from those before it, so each
block can then be cut into records on its own. Only a record that runs over a block's edge has to be put
together from its pieces. Fields are parsed by Spark's ``from_csv``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.prices import nan_to_null

MAX_BLOCKS = 1_000_000
WHOLE, HEAD, TAIL = 0, 1, 2


def read_csv_blocks(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """Rows of ``schema`` from CSV files whose quoted fields may hold newlines and doubled quotes.

    Blocks are Spark's file splits (``spark.sql.files.maxPartitionBytes``), 1,000,000 at most. Records end in a
    newline, with or without a carriage return before it. Empty lines are skipped; a byte-order mark is part of the
    header, which is dropped. An empty field is null, quoted or not, and so is ``NaN`` in a number column. A quote inside an unquoted field is not
    CSV and shifts what follows it.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"), "value",
    )
    blocks = lines.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"))
    before = F.sum("quotes").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    odd = blocks.select("file", "block", F.coalesce(before % 2 == 1, F.lit(False)).alias("inside")).where("inside")
    many = odd.count()
    if many > MAX_BLOCKS:
        raise ValueError(f"{many} blocks begin inside a field: raise spark.sql.files.maxPartitionBytes")
    marked = lines.join(F.broadcast(odd), ["file", "block"], "left").select("file", "block", "inside", "quotes", "value")
    pieces = marked.mapInArrow(_cutter(header), "file string, block long, kind int, record string")
    whole = pieces.where(F.col("kind") == WHOLE).select("record")
    # pieces of records that run over edges: two a block at most. A tail begins a record, heads go on with it.
    number = F.sum((F.col("kind") == TAIL).cast("int")).over(Window.partitionBy("file").orderBy("block", "kind"))
    parts = pieces.where(F.col("kind") != WHOLE).withColumn("number", number)
    ordered = F.sort_array(F.collect_list(F.struct("block", "record")))
    joined = parts.groupBy("file", "number").agg(F.array_join(F.transform(ordered, lambda p: p["record"]), "\n").alias("record"))
    records = whole.unionByName(joined.select("record")).select(F.regexp_replace("record", "\r$", "").alias("record")).where("record <> ''")
    fields = records.select(F.from_csv("record", schema, {"escape": '"'}).alias("row")).select("row.*")
    return fields.withColumns({c: nan_to_null(F.col(c)) for c, kind in fields.dtypes if kind in ("float", "double")})


def _cutter(header: bool):
    # A nested function travels to the workers by value, so they need not have this package.
    whole, head, tail = WHOLE, HEAD, TAIL

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, open_lines, kind, inside, first = None, [], whole, False, False

        def ended(out: list, complete: bool) -> None:
            """Pass the lines of a record on; those that reach a block's end incomplete, as a piece."""
            nonlocal open_lines, kind, first
            if open_lines:
                what = kind if complete or kind == head else tail
                if not (first and header and what == whole):
                    out.append((*at, what, "\n".join(open_lines)))
                first = False
            open_lines, kind = [], whole

        for batch in batches:
            out: list[tuple] = []
            files, blocks, insides, quotes, values = (batch.column(c).to_pylist() for c in ("file", "block", "inside", "quotes", "value"))
            for file, block, starts_inside, count, value in zip(files, blocks, insides, quotes, values):
                if (file, block) != at:
                    ended(out, not inside)
                    at, inside, first = (file, block), bool(starts_inside), block == 0
                    kind = head if inside else whole
                open_lines.append(value)
                inside ^= bool(count % 2)
                if not inside:
                    ended(out, True)
            yield batch_of(out)
        out = []
        ended(out, not inside)
        yield batch_of(out)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [[], [], [], []]
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["file", "block", "kind", "record"])

    return cut
