"""Stage files: CSV at the edges, parquet between stages, tables for the database load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.prices import nan_to_null

BOM = "﻿"


def read_csv(spark: SparkSession, path: str, schema: str, multi_line: bool = True) -> DataFrame:
    """CSV with a header row, quoted fields that may hold newlines, and an optional byte-order mark.

    The text ``NaN`` in a number column is read as null. Quoted newlines keep a file from being split,
    so a large file is better read by ``csv_blocks.read_csv_blocks``; pass ``multi_line=False`` for files known to
    hold one record per line.
    """
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("enforceSchema", True)
        .csv(path)
    )
    return rows.withColumns({c: nan_to_null(F.col(c)) for c, kind in rows.dtypes if kind in ("float", "double")})


def read_landed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Landed API responses, one JSON record per line."""
    return spark.read.schema(schema).json(path)


def write_csv(df: DataFrame, path: str, bom: bool = False) -> None:
    """CSV with a header row; blanks at a text's ends stay. ``bom`` puts a byte-order mark in front of each part
    file's header."""
    if bom:
        df = df.withColumnRenamed(df.columns[0], BOM + df.columns[0])
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").option("header", True).option("escape", '"').options(**blanks).csv(path)


def write_stage(df: DataFrame, path: str, by_month_of: str | None = None) -> None:
    """Parquet stage; ``by_month_of`` names the timestamp whose month partitions the files.

    Rows are dealt by month, and Spark cuts a busy month into as many tasks as its size asks for
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``) and joins small ones.
    """
    if by_month_of is None:
        df.write.mode("overwrite").parquet(path)
        return
    by_month = df.withColumn("month", F.date_format(by_month_of, "yyyy-MM")).hint("rebalance", "month")
    by_month.write.mode("overwrite").partitionBy("month").parquet(path)


def load_table(df: DataFrame, name: str, jdbc: dict[str, str] | None = None, path: str | None = None) -> None:
    """Replace the whole table. With ``jdbc`` options the target is an outside database; with ``path`` the
    table's files lie there instead of in the warehouse."""
    if jdbc is None:
        writer = df.write.mode("overwrite")
        (writer.option("path", path) if path else writer).saveAsTable(name)
    else:
        df.write.format("jdbc").options(**jdbc, dbtable=name).mode("overwrite").save()


def reconcile_counts(src: DataFrame, dst: DataFrame) -> DataFrame:
    """Row counts of source and target side by side."""
    loaded = dst.agg(F.count(F.lit(1)).alias("n")).scalar()
    return (
        src.agg(F.count(F.lit(1)).alias("source_rows"))
        .withColumn("loaded_rows", loaded)
        .withColumn("matches", F.col("source_rows") == F.col("loaded_rows"))
    )


def select_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the listed columns that exist, in list order."""
    return df.select(*[c for c in columns if c in df.columns])
