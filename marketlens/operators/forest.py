"""Random regression forest over binned features, all trees grown level by level from shared scans.

A level costs one scan: a task routes its rows through what the trees are so far and adds weights and targets up
per (tree, node, feature, bin). The parts are summed by (tree, node), where the best split is searched; one row a
node comes back. A tree's bootstrap weights are Poisson counts taken from a hash of row key and tree, so they
are the same in every scan and however the rows are dealt. Rows that are equal in features and target are grouped
before the first scan: m of them together draw a Poisson count of mean m, which is what they would draw singly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import keep
from .kmeans import as_array

MAX_BINS = 32
TASK_BYTES = 256_000_000  # of sums that a task holds; more trees than fit take more scans


class Forest(NamedTuple):
    """Trees as heaps: node i has the children 2i+1 and 2i+2. ``feature`` is -1 in a leaf."""

    feature: np.ndarray  # (trees x nodes)
    cut: np.ndarray  # values up to it go left
    value: np.ndarray  # mean target of the node
    rows: np.ndarray  # weight of the node's rows
    gain: np.ndarray  # squared error that the split removes

    @property
    def importances(self) -> np.ndarray:
        """Gains summed by feature, as shares: of each tree, then of the forest."""
        width = int(self.feature.max(initial=-1)) + 1
        per_tree = np.stack([np.bincount(f[f >= 0], g[f >= 0], width) for f, g in zip(self.feature, self.gain)])
        shares = per_tree / np.maximum(per_tree.sum(axis=1, keepdims=True), 1e-300)
        return shares.sum(axis=0) / max(shares.sum(), 1e-300)

    def transform(self, df: DataFrame, features: str = "features", output: str = "prediction") -> DataFrame:
        return df.withColumn(output, _predictor(self)(as_array(df, features)))


def _predictor(forest: Forest):
    feature, cut, value, _, _ = forest
    depth = (feature.shape[1] + 1).bit_length() - 2

    @F.pandas_udf("double")
    def predict(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=float)
        rows = np.stack(x.to_numpy()).astype(float)
        total, every = np.zeros(len(rows)), np.arange(len(rows))
        for f, c, v in zip(feature, cut, value):
            node = np.zeros(len(rows), np.int64)
            for _ in range(depth):
                split = f[node]
                node = np.where(split >= 0, 2 * node + 1 + (rows[every, split] > c[node]), node)
            total += v[node]
        return pd.Series(total / len(feature))

    return predict


def bin_edges(rows: DataFrame, width: int, max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """Cut values per element of the array column ``x``: its distinct quantiles, ``max_bins - 1`` at most."""
    shares = F.array(*[F.lit(i / max_bins) for i in range(1, max_bins)])
    found = rows.agg(*[F.percentile_approx(F.get("x", F.lit(j)), shares, F.lit(100 * max_bins)).alias(f"e{j}") for j in range(width)]).first()
    return [np.unique(np.array(found[j] or [], float)) for j in range(width)]


def fit(
    df: DataFrame,
    target: str,
    *,
    features: str = "features",
    row_key: Sequence[str] | Column | None = None,
    trees: int = 100,
    depth: int = 8,
    min_rows: int = 5,
    seed: int = 42,
    bootstrap: bool = True,
    edges: Sequence[Sequence[float]] | None = None,
    weight: str | None = None,
) -> Forest:
    """Fit ``trees`` trees on the rows with features and target.

    With ``row_key``, columns or a hash, rows stay single and its hash decides their bootstrap weights; rows with
    the same key have the same. Without it equal rows are grouped (counts from 16 up by the normal
    approximation with its skewness term); a row with ``weight`` n stands for n such rows. ``edges`` are the cut values of each feature if not the quantiles. A
    split has at least ``min_rows`` rows (bootstrap weights counted) on either side; among equal gains the first
    feature and lowest cut win. Without rows there is nothing to fit and an error is raised.
    """
    x, y = as_array(df, features), F.col(target).cast("double")
    if row_key is None:
        alike = F.col(weight) if weight else F.lit(1)
        rows = df.select(x.alias("x"), y.alias("y"), alike.cast("long").alias("m")).where("x IS NOT NULL AND y IS NOT NULL")
        rows = rows.groupBy("x", "y").agg(F.sum("m").alias("m"))
        rows = keep(rows.select(F.xxhash64("x", "y").alias("h"), "x", "y", "m"))
    else:
        key = row_key if isinstance(row_key, Column) else F.xxhash64(*row_key)
        rows = keep(df.select(key.alias("h"), x.alias("x"), y.alias("y"), F.lit(1).cast("long").alias("m")).where("x IS NOT NULL AND y IS NOT NULL"))
    shape = rows.agg(F.max(F.size("x")).alias("width"), (F.sum(F.col("y") * F.col("m")) / F.sum("m")).alias("mean")).first()
    if shape.width is None:
        raise ValueError("no rows with features and target")
    cuts = [np.array(e, float) for e in edges] if edges is not None else bin_edges(rows, shape.width)
    bins = max(map(len, cuts)) + 1
    nodes = 2 ** (depth + 1) - 1
    forest = Forest(
        np.full((trees, nodes), -1), np.full((trees, nodes), -1.0), np.zeros((trees, nodes)), np.zeros((trees, nodes)), np.zeros((trees, nodes))
    )
    open_nodes = {t: [0] for t in range(trees)}
    bin_cut = np.full((trees, nodes), -1)
    for level in range(depth):
        per_tree = 16 * bins * shape.width * 2**level
        group = max(1, TASK_BYTES // per_tree)
        growing = sorted(t for t, at in open_nodes.items() if at)
        found = []
        for a in range(0, len(growing), group):
            found += _best_splits(rows, forest.feature, bin_cut, growing[a : a + group], level, cuts, bins, shape.mean, min_rows, seed, bootstrap)
        open_nodes = {t: [] for t in range(trees)}
        for r in found:
            t, i = r.tree, r.node
            forest.rows[t, i], forest.value[t, i] = r.n, shape.mean + r.total / r.n
            if r.feature < 0:
                continue
            forest.feature[t, i], bin_cut[t, i], forest.cut[t, i], forest.gain[t, i] = r.feature, r.bin, cuts[r.feature][r.bin], r.gain
            for child, n, total in ((2 * i + 1, r.left_n, r.left), (2 * i + 2, r.n - r.left_n, r.total - r.left)):
                forest.rows[t, child], forest.value[t, child] = n, shape.mean + total / n
                open_nodes[t].append(child)
        if not any(open_nodes.values()):
            break
    return forest


def _best_splits(rows, feature, bin_cut, growing, level, cuts, bins, mean, min_rows, seed, bootstrap) -> list:
    """One row (tree, node, n, total, feature, bin, gain, left_n, left) per node of a level; targets about the mean."""
    width, first, count = len(cuts), 2**level - 1, 2**level
    # levels from 0 up are settled: routes of rows whose node is no leaf above end in this level
    routes = [(feature[t, : max(first, 1)].copy(), bin_cut[t, : max(first, 1)].copy()) for t in growing]
    salts = [((seed + 1) * 0x9E3779B97F4A7C15 + t * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF for t in growing]
    steps = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(12)])

    def hashed(h: np.ndarray, salt: int) -> np.ndarray:
        """Numbers between 0 and 1 from a 64-bit mixer of row hash and salt."""
        with np.errstate(over="ignore"):
            u = (h ^ np.uint64(salt)) * np.uint64(0xBF58476D1CE4E5B9)
            u = (u ^ (u >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            u = (u ^ (u >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        return ((u >> np.uint64(11)).astype(float) + 0.5) / 2.0**53

    def counts(h: np.ndarray, m: np.ndarray, salt: int) -> np.ndarray:
        """Poisson counts of mean ``m``."""
        u = hashed(h, salt)
        if (m == 1).all():
            return np.searchsorted(steps, u, side="right")
        out, many = np.zeros(len(m), np.int64), m >= 16
        for k in np.unique(m[~many]):  # by the cumulated probabilities of each mean
            at = np.flatnonzero(m == k)
            term = np.exp(np.array([-float(k)]))
            below, sums = term.copy(), []
            for i in range(1, 64):
                sums.append(below[0])
                term = term * k / i
                below += term
            out[at] = np.searchsorted(sums, u[at], side="left")
        z = np.sqrt(-2 * np.log(u[many])) * np.cos(2 * np.pi * hashed(h[many], salt ^ 0x5851F42D4C957F2D))
        out[many] = np.maximum(np.rint(m[many] + np.sqrt(m[many]) * z + (z * z - 1) / 6), 0)
        return out

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(growing), 2, count * width * bins))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            y = batch.column("y").to_numpy(zero_copy_only=False) - mean
            h, m = batch.column("h").to_numpy(zero_copy_only=False).view(np.uint64), batch.column("m").to_numpy(zero_copy_only=False)
            binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
            place = np.arange(width) * bins + binned
            for k, (split, cut) in enumerate(routes):
                weight = counts(h, m, salts[k]) if bootstrap else m
                at = np.flatnonzero(weight)
                node = np.zeros(len(at), np.int64)
                for _ in range(level):
                    f = split[node]
                    inner = f >= 0
                    at, node, f = at[inner], node[inner], f[inner]
                    node = 2 * node + 1 + (binned[at, f] > cut[node])
                if len(at):
                    flat = ((node - first)[:, None] * (width * bins) + place[at]).ravel()
                    w = weight[at].astype(float)
                    sums[k, 0] += np.bincount(flat, np.repeat(w, width), count * width * bins)
                    sums[k, 1] += np.bincount(flat, np.repeat(w * y[at], width), count * width * bins)
        whole = sums.reshape(len(growing), 2, count, width, bins)
        for k, tree in enumerate(growing):
            held = np.flatnonzero(whole[k, 0, :, 0].sum(axis=1))
            data = [whole[k, :, i].tobytes() for i in held]
            yield pa.RecordBatch.from_arrays(
                [pa.array([tree] * len(held), pa.int32()), pa.array(held + first, pa.int32()), pa.array(data, pa.binary())], names=["tree", "node", "sums"]
            )

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("tree", "node", "sums"))))
        out = []
        for (tree, node), same in groupby(parts, key=lambda r: r[:2]):
            total = np.zeros(2 * width * bins)
            for _, _, data in same:
                total += np.frombuffer(data)
            n, s = np.cumsum(total.reshape(2, width, bins), axis=2)
            all_n, all_s = n[0, -1], s[0, -1]
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = s * s / n + (all_s - s) ** 2 / (all_n - n) - all_s * all_s / all_n
            gain = np.where((n >= min_rows) & (all_n - n >= min_rows), gain, -1.0)
            j, b = np.unravel_index(int(gain.argmax()), gain.shape)
            if gain[j, b] > 1e-9 * max(1.0, all_s * all_s / all_n):
                out.append((tree, node, all_n, all_s, int(j), int(b), gain[j, b], n[j, b], s[j, b]))
            else:
                out.append((tree, node, all_n, all_s, -1, -1, 0.0, 0.0, 0.0))
        columns = list(zip(*out)) if out else [[]] * 9
        kinds = [pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    names = ["tree", "node", "n", "total", "feature", "bin", "gain", "left_n", "left"]
    schema = "tree int, node int, n double, total double, feature int, bin int, gain double, left_n double, left double"
    sums = rows.mapInArrow(add, "tree int, node int, sums binary")
    return sums.repartition("tree", "node").sortWithinPartitions("tree", "node").mapInArrow(best, schema).collect()  # one row a node
