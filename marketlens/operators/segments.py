"""k-means price segments: features, fit, choice of k, ordering and checks."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.prices import log_feature
from ..functions.text import to_number
from ..schemas import CLUSTER_BASE, CLUSTER_LOG
from ..session import keep, release
from .kmeans import Fit, as_array, fit_many, points_of, squared_silhouettes
from .quantiles import medians

SEED = 42
RESTARTS = 10
FEATURES = "features"


def cluster_features(
    df: DataFrame, base: Sequence[str] = CLUSTER_BASE, log: Sequence[str] = CLUSTER_LOG
) -> tuple[DataFrame, list[str]]:
    """Median-filled base columns and log columns, next to the input's columns.

    The input is read several times; keep it first when it is costly. Feature columns are named ``f_<name>``; columns the input lacks are left out. Base columns that
    are null throughout have no median and are left out as well.
    """
    types = dict(df.dtypes)
    base = [c for c in base if c in types]
    log = [c for c in log if c in types]
    number = lambda c: to_number(F.col(c)) if types[c] == "string" else F.col(c).cast("double")
    wide = df.withColumns(
        {f"f_{c}": number(c) for c in base} | {f"f_{c}_log": log_feature(number(c)) for c in log}
    )
    mid = medians(wide, [f"f_{c}" for c in base]) if base else {}
    usable = [c for c, m in mid.items() if m is not None]
    filled = wide.drop(*[c for c in mid if c not in usable]).withColumns(
        {c: F.coalesce(F.col(c), F.lit(mid[c])) for c in usable}
    )
    return filled, usable + [f"f_{c}_log" for c in log]


def standardize(df: DataFrame, columns: Sequence[str], stats_from: DataFrame | None = None) -> DataFrame:
    """Mean 0 and **population** deviation 1; a constant column becomes 0.

    The statistics are fitted in one aggregation and enter the plan as constants; ``stats_from``
    takes them from another frame (fit on training rows, apply to test rows).
    """
    source = df if stats_from is None else stats_from
    stats = source.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
    ).first()

    def scaled(c: str) -> Column:
        mean, deviation = stats[f"m_{c}"], stats[f"s_{c}"]
        if not deviation:
            return F.when(F.col(c).isNotNull(), F.lit(0.0))
        return (F.col(c) - F.lit(mean)) / F.lit(deviation)

    return df.withColumns({c: scaled(c) for c in columns})


def assemble(df: DataFrame, columns: Sequence[str], output: str = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(df)


# --- fixed-start Lloyd steps -----------------------------------------------------------------


def squared_distance(columns: Sequence[str], center: Sequence[float]) -> Column:
    total = F.lit(0.0)
    for c, m in zip(columns, center):
        gap = F.col(c) - F.lit(float(m))
        total = total + gap * gap
    return total


def assign(df: DataFrame, columns: Sequence[str], centers: Sequence[Sequence[float]], output: str = "cluster") -> DataFrame:
    """Nearest centre per row, lowest number on ties: a projection over ``k`` literals, no join."""
    options = [
        F.struct(squared_distance(columns, c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centers)
    ]
    nearest = options[0] if len(options) == 1 else F.least(*options)
    return df.withColumn(output, nearest["i"])


def lloyd(
    df: DataFrame, columns: Sequence[str], centers: Sequence[Sequence[float]], steps: int
) -> tuple[DataFrame, list[list[float]]]:
    """``steps`` k-means steps from given centres: assigned rows and the final centres.

    Each step is one aggregation; only the ``k`` centre rows come back to the driver, so the plan
    does not grow with the steps. A cluster that loses all rows keeps its centre.
    """
    centers = [list(map(float, c)) for c in centers]
    for _ in range(steps):
        means = assign(df, columns, centers).groupBy("cluster").agg(*[F.avg(c).alias(c) for c in columns])
        for row in means.collect():  # at most k rows
            centers[row["cluster"]] = [row[c] for c in columns]
    return assign(df, columns, centers), centers


def inertia(df: DataFrame, columns: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Sum of squared distances to the own cluster's mean, from one aggregation per cluster."""
    spread = [F.var_pop(c) * F.count(c) for c in columns]
    total = spread[0]
    for s in spread[1:]:
        total = total + s
    return df.groupBy(cluster).agg(total.alias("_sse")).agg(F.sum("_sse").alias("inertia"))


# --- fit and choice of k ---------------------------------------------------------------------


def kmeans_fit(
    df: DataFrame, k: int, restarts: int = RESTARTS, seed: int = SEED, features: str = FEATURES, id_col: str | None = None
) -> Fit:
    """Best of ``restarts`` fits by cost; all of them share their scans."""
    return fit_many(df, [k], restarts, seed, features, id_col)[k]


def k_sweep(
    df: DataFrame,
    ks: Sequence[int],
    id_col: str,
    restarts: int = RESTARTS,
    seed: int = SEED,
    metric: str = "squared",
    features: str = FEATURES,
) -> DataFrame:
    """``(k, inertia, silhouette)`` for each k; see ``sweep_fits``."""
    return sweep_fits(df, ks, id_col, restarts, seed, metric, features)[0]


def sweep_fits(
    df: DataFrame,
    ks: Sequence[int],
    id_col: str,
    restarts: int = RESTARTS,
    seed: int = SEED,
    metric: str = "squared",
    features: str = FEATURES,
) -> tuple[DataFrame, dict[int, Fit]]:
    """``(k, inertia, silhouette)`` for each k, and the fits.

    All (k, restart) pairs share each scan of the rows. The ``squared`` silhouette of every k comes from one
    more scan. The ``euclidean`` one is the published method's; its values come from one pass over the
    distances, which do not depend on k, but that pass costs the square of the row count.
    """
    kept = keep(df.select(id_col, as_array(df, features).alias(features)))
    fits = fit_many(kept, ks, restarts, seed, features, id_col)
    if metric == "squared":
        scores = squared_silhouettes(points_of(kept, features, id_col), fits)
    else:
        labelled = kept
        for k, fit in fits.items():
            labelled = fit.transform(labelled, features, f"k{k}")
        names = [f"k{k}" for k in ks]
        found = silhouette(labelled, id_col, names, features, metric).collect()  # one row a k
        scores = {int(r["labels"][1:]): r["silhouette"] for r in found}
    release(kept)
    rows = [(k, fits[k].cost, scores[k]) for k in ks]
    return df.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double"), fits


def k_range(df: DataFrame, low: int = 2, high: int = 7) -> list[int]:
    """k values to try, never as many as there are rows."""
    rows = df.limit(high + 1).count()
    return list(range(low, min(high, rows - 1) + 1))


def best_k(sweep: DataFrame) -> DataFrame:
    """k with the top silhouette, the lowest such k on ties."""
    return sweep.agg(F.max_by("k", F.struct(F.col("silhouette"), -F.col("k"))).alias("k"))


# --- silhouette ------------------------------------------------------------------------------


def silhouette(
    df: DataFrame, id_col: str, labels: Sequence[str], features: str = FEATURES, metric: str = "euclidean"
) -> DataFrame:
    """Mean silhouette per label column: ``(labels, silhouette)``."""
    if metric == "squared":
        rows = [
            (c, float(ClusteringEvaluator(predictionCol=c, featuresCol=features).evaluate(df))) for c in labels
        ]
        return df.sparkSession.createDataFrame(rows, "labels string, silhouette double")
    if metric != "euclidean":
        raise ValueError(f"unknown metric {metric!r}")
    return silhouette_rows(df, id_col, labels, features).groupBy("labels").agg(F.avg("silhouette").alias("silhouette"))


def silhouette_rows(
    df: DataFrame, id_col: str, labels: Sequence[str], features: str = FEATURES, tile_rows: int = 8192
) -> DataFrame:
    """Exact Euclidean silhouette of every row, for several labellings at once.

    Rows are hashed into row tiles and, eight times larger, into column tiles. Each pair of a row
    tile and a column tile is one bounded task that turns its distances into sums per row and
    cluster at once, so no row pair leaves a task. ``id_col`` must be unique. Tiles depend on the id
    only: a cluster that holds most rows is spread like any other.
    """
    labels = list(labels)
    rows = df.count()
    row_tiles = max(1, math.ceil(rows / tile_rows))
    column_tiles = max(1, math.ceil(rows / (8 * tile_rows)))
    points = df.select(
        F.col(id_col).alias("id"), as_array(df, features).alias("x"), F.array(*[F.col(c).cast("int") for c in labels]).alias("y")
    )
    tile = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = points.withColumn("a", tile(row_tiles, 1)).withColumn("b", every(column_tiles))
    # own names keep the two sides apart in the plan, which otherwise prunes one by the other's needs
    right = points.withColumn("b", tile(column_tiles, 2)).select(
        F.col("id").alias("id_b"), F.col("x").alias("x_b"), F.col("y").alias("y_b"), F.col("b"), every(row_tiles).alias("a")
    )
    id_type = dict(points.dtypes)["id"]
    sums = left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInPandas(
        _tile_function(), f"id {id_type}, labelling int, cluster int, own boolean, n bigint, total double"
    )
    per_cluster = sums.groupBy("id", "labelling", "cluster", "own").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total")
    )
    near = F.min(F.when(~F.col("own"), F.col("total") / F.col("n")))
    own_n = F.max(F.when(F.col("own"), F.col("n")))
    own_mean = F.max(F.when(F.col("own"), F.try_divide(F.col("total"), F.col("n") - 1)))
    scored = per_cluster.groupBy("id", "labelling").agg(own_mean.alias("a"), near.alias("b"), own_n.alias("own_n"))
    widest = F.greatest("a", "b")
    value = F.when((F.col("own_n") == 1) | (widest == 0), F.lit(0.0)).otherwise((F.col("b") - F.col("a")) / widest)
    name = F.get(F.array(*[F.lit(c) for c in labels]), F.col("labelling"))
    return scored.select(F.col("id").alias(id_col), name.alias("labels"), value.alias("silhouette"))


def _tile_function():
    # A nested function travels to the workers by value, so they need not have this package.
    def tile_sums(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        """Distance sums of the rows of one tile to each cluster of another tile."""
        columns = ["id", "labelling", "cluster", "own", "n", "total"]
        if a.empty or b.empty:
            return pd.DataFrame({c: [] for c in columns})
        xa, xb = np.stack(a["x"].to_numpy()).astype(float), np.stack(b["x_b"].to_numpy()).astype(float)
        ya, yb = np.stack(a["y"].to_numpy()), np.stack(b["y_b"].to_numpy())
        ida, idb = a["id"].to_numpy(), b["id_b"].to_numpy()
        clusters = [(j, c) for j in range(yb.shape[1]) for c in np.unique(yb[:, j])]
        member = np.stack([yb[:, j] == c for j, c in clusters], axis=1)
        middle = xb.mean(0)  # norms minus products lose their digits far from the origin
        xa, xb = xa - middle, xb - middle
        weights, sizes, norms = member.astype(float), member.sum(0), (xb**2).sum(1)
        totals = np.empty((len(xa), len(clusters)))
        chunk = max(1, (1 << 23) // len(xb))  # at most 64 MB of distances at a time
        for start in range(0, len(xa), chunk):
            part = slice(start, start + chunk)
            squared = (xa[part] ** 2).sum(1)[:, None] + norms[None, :] - 2 * xa[part] @ xb.T
            distance = np.sqrt(np.maximum(squared, 0.0))
            distance[ida[part][:, None] == idb[None, :]] = 0.0
            totals[part] = distance @ weights
        out = [
            pd.DataFrame(
                {"id": a["id"], "labelling": j, "cluster": int(c), "own": ya[:, j] == c, "n": int(sizes[i]), "total": totals[:, i]}
            )
            for i, (j, c) in enumerate(clusters)
        ]
        return pd.concat(out, ignore_index=True)[columns]

    return tile_sums


# --- order and names -------------------------------------------------------------------------


def cluster_order(df: DataFrame, cluster: str, price: str, start: int = 0) -> DataFrame:
    """``(cluster, cluster_rank)`` by ascending mean price; one row per cluster."""
    means = df.where(F.col(cluster).isNotNull()).groupBy(cluster).agg(F.avg(price).alias("_mean"))
    by_price = Window.orderBy(F.col("_mean").asc_nulls_last(), cluster)  # k rows only
    return means.select(cluster, (F.row_number().over(by_price) - 1 + start).cast("int").alias("cluster_rank"))


def relabel_clusters(
    df: DataFrame, cluster: str, price: str, start: int = 0, names: Mapping[int, str] | None = None
) -> DataFrame:
    """Add ``cluster_rank`` and ``segment``: named by ``names``, else ``Cluster <rank>``.

    The rank table has one row per cluster and is read as one map value, so the rows themselves are
    neither joined nor shuffled.
    """
    entry = F.collect_list(F.struct(cluster, "cluster_rank"))
    ranks = cluster_order(df, cluster, price, start).agg(F.map_from_entries(entry)).scalar()
    out = df.withColumn("cluster_rank", F.try_element_at(ranks, F.col(cluster)))
    if names is None:
        label = F.concat(F.lit("Cluster "), F.col("cluster_rank").cast("string"))
    else:
        pairs = [F.lit(x) for pair in names.items() for x in pair]
        label = F.try_element_at(F.create_map(*pairs), F.col("cluster_rank"))
    return out.withColumn("segment", label)
