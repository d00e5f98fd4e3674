"""Longest-processing-time sharding of documents, with equal texts kept together.

The heap runs over a bounded number of work items, whatever the table: a group larger than
``total / (shards * fine)`` is an item of its own (there are at most ``shards * fine`` of them), and
the smaller groups are dealt by hash into ``shards * fine`` bundles, each an item. Items go, longest
first, to the least-loaded shard. Small tables have about one group in each bundle, so the result is
then plain longest-processing-time over groups.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import keep, private, table


def least_loaded(items: list[tuple[str, int]], shards: int) -> list[tuple[str, int]]:
    """(item, size) -> (item, shard). Ties: smaller item name first, smaller shard first."""
    heap = [(0, s) for s in range(shards)]
    placed = []
    for name, size in sorted(items, key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(heap)
        placed.append((name, shard))
        heapq.heappush(heap, (load + size, shard))
    return placed


def shard_documents(
    docs: DataFrame, shards: int, *, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16, fine: int = 1000
) -> DataFrame:
    """Rows (doc_id, size, text_crc32, shard, slot, text_sha256).

    ``size`` is the UTF-8 length plus ``overhead``. A null text has length and crc32 0, and null texts
    form one group; the empty text forms another. Rows with the same id are kept apart as rows and
    ordered by their text's digest. An empty table gives an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = keep(
        private(docs, doc_id=id_col, text=text_col).select(
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + overhead).cast("long").alias("size"),
            F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"),
            F.coalesce(F.sha2("text", 256), F.lit("null")).alias("text_sha256"),
        )
    )
    total = rows.agg(F.sum("size")).first()[0]
    if total is None:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"), "text_sha256")
    bundle = F.concat(F.lit("bundle "), F.pmod(F.xxhash64("text_sha256"), F.lit(shards * fine)).cast("string"))
    groups = keep(
        rows.groupBy("text_sha256").agg(F.sum("size").alias("size"))
        .withColumn("large", F.col("size") * (shards * fine) > F.lit(total))
    )
    items = groups.groupBy(F.when(F.col("large"), F.col("text_sha256")).otherwise(bundle).alias("item")).agg(F.sum("size").alias("size"))
    placed = least_loaded([(r.item, r.size) for r in items.collect()], shards)  # 2 * shards * fine rows at most
    plan = spark.createDataFrame(placed, "item string, shard int")
    large = F.broadcast(plan.where(~F.col("item").startswith("bundle ")).select(F.col("item").alias("text_sha256"), F.col("shard").alias("own")))
    bundles = F.broadcast(plan.where(F.col("item").startswith("bundle ")))
    placed_rows = (
        rows.join(large, "text_sha256", "left")
        .withColumn("item", F.when(F.col("own").isNull(), bundle))
        .join(bundles, "item", "left")
        .withColumn("shard", F.coalesce("own", "shard"))
    )
    return _slots(placed_rows).select("doc_id", "size", "text_crc32", "shard", "slot", "text_sha256")


def _slots(rows: DataFrame, rows_per_part: int = 50_000) -> DataFrame:
    """``slot``: place within the shard, gapless from 0. A shard is numbered in parts dealt by id, so
    that none is gathered; the parts' offsets come from their row counts."""
    parts = 1 + rows.count() // rows_per_part
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int"))
    order = Window.partitionBy("shard").orderBy("part")
    offsets = (
        rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
        .select("shard", "part", (F.sum("n").over(order) - F.col("n")).alias("before"))
    )
    within = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "text_sha256"))
    return rows.withColumn("within", within).join(offsets, ["shard", "part"]).withColumn("slot", F.col("before") + F.col("within") - 1)


def op2_lpt_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), 40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
