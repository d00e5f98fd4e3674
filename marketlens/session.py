"""Session defaults and the one place that decides how an intermediate result is kept."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "marketlens", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators are planned for. The caller's values win."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, name: str) -> str:
    """Path of a new folder that driver and executors share, for files that an operator writes and reads back.

    It lies under ``spark.checkpoint.dir``, else under the warehouse; a temporary folder serves local mode only.
    """
    base = spark.conf.get(CHECKPOINT_KEY, None)
    if not base:
        local = spark.sparkContext.master.split("[")[0] == "local"
        base = tempfile.mkdtemp(prefix="marketlens-") if local else spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


_CACHED: list[DataFrame] = []


def keep(df: DataFrame) -> DataFrame:
    """Hold a result that several jobs read.

    With a shared checkpoint folder the rows are written there and the lineage is cut, so a lost
    executor costs a re-read; Spark removes the files when the frame is gone. Without one the rows are
    cached with spill to disk and are recomputed from lineage when lost; ``release_all`` frees them.
    """
    spark = df.sparkSession
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if folder:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(folder)
        return df.checkpoint()
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    _CACHED.append(cached)
    return cached


def tidy(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files and checkpoints that nothing refers to any more.

    It learns of them when the driver's heap is collected, which a driver with memory to spare does rarely; work
    with many small shuffles calls this between steps so that its files do not pile up."""
    spark.sparkContext._jvm.System.gc()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that an operator has written and nobody reads any more, wherever Spark can reach it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def release_all() -> None:
    """Free what ``keep`` has cached so far: call it when the results that read it are written."""
    while _CACHED:
        _CACHED.pop().unpersist()


def spread(df: DataFrame) -> DataFrame:
    """Even partitions for work that is heavy per row (model fitting), whatever the row bytes.

    The count follows the session's shuffle setting and is at least the number of cores.
    """
    spark = df.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(parts)


def release(df: DataFrame) -> None:
    """Undo ``keep`` for a cached frame (a checkpoint is cleaned by Spark)."""
    df.unpersist()
