"""k-means for many models at once: every scan of the rows serves all (k, restart) pairs.

The centres of all models travel in one array. A task turns its rows into one row of sums per (model,
cluster), so a Lloyd step is one scan and one small aggregation, whatever the number of models. Models that have
settled leave the next scan.

Starts are chosen as in k-means||, by hashes of the row ids instead of random numbers: they are the same however
the rows are dealt. Each round draws ``2k`` rows per model without replacement, in proportion to the squared
distance to what is chosen so far (the smallest values of -ln(u) / distance). The candidates are weighted by the
rows near them and reduced to k on the driver by k-means++.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import keep, spread

ROUNDS = 2
CHUNK = 4096
PARTIAL_ROWS = 50_000


class Fit(NamedTuple):
    """Centres, and about them: rows, sums and squared distances of the rows nearest to each."""

    centers: np.ndarray
    rows: np.ndarray
    sums: np.ndarray
    squares: np.ndarray
    steps: int

    @property
    def cost(self) -> float:
        return float(self.squares.sum())

    def transform(self, df: DataFrame, features: str = "features", output: str = "cluster") -> DataFrame:
        """Add the number of the nearest centre, the lowest on ties; null for null features."""
        x = F.col("_x_of_row")
        near = []
        for i, center in enumerate(self.centers.tolist()):
            gaps = [F.get(x, F.lit(j)) - F.lit(v) for j, v in enumerate(center)]
            total = gaps[0] * gaps[0]
            for g in gaps[1:]:
                total = total + g * g
            near.append(F.struct(total.alias("d"), F.lit(i).alias("i")))
        nearest = near[0] if len(near) == 1 else F.least(*near)
        cluster = F.when(x.isNotNull(), nearest["i"])
        return df.withColumn("_x_of_row", as_array(df, features)).withColumn(output, cluster).drop("_x_of_row")


def as_array(df: DataFrame, features: str) -> Column:
    """A vector or array column as an array of doubles."""
    if dict(df.dtypes)[features].startswith("array"):
        return F.col(features).cast("array<double>")
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(F.col(features))


def points_of(df: DataFrame, features: str = "features", id_col: str | None = None) -> DataFrame:
    """(h, x): hash of the id, or of the features without one, and the features. Rows without features are left out."""
    x = as_array(df, features)
    return df.select(F.xxhash64(id_col if id_col else x).alias("h"), x.alias("x")).where("x IS NOT NULL")


def _tools():
    # Nested functions travel to the workers by value, so they need not have this package.
    def matrix(batch: pa.RecordBatch) -> np.ndarray:
        flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
        return flat.reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, 1))

    def distances(x: np.ndarray, stack: np.ndarray) -> np.ndarray:
        """Squared distances (rows x centres); norms minus products, about the centres' middle."""
        middle = stack.mean(axis=0)
        x, stack = x - middle, stack - middle
        return np.maximum((x * x).sum(axis=1)[:, None] + (stack * stack).sum(axis=1)[None, :] - 2 * (x @ stack.T), 0.0)

    def nearest(x: np.ndarray, stack: np.ndarray, sizes: list[int]) -> np.ndarray:
        """(rows x models): place in ``stack`` of each model's nearest centre."""
        gap, first = distances(x, stack), 0
        out = np.empty((len(x), len(sizes)), np.int64)
        for m, k in enumerate(sizes):
            out[:, m] = first + gap[:, first : first + k].argmin(axis=1)
            first += k
        return out

    return matrix, distances, nearest


def _stacked(centers: Sequence[np.ndarray]) -> tuple[np.ndarray, list[int]]:
    return np.concatenate(centers), [len(c) for c in centers]


def assigned_sums(
    points: DataFrame, centers: Sequence[np.ndarray], tasks: int = PARTIAL_ROWS, squared: bool = True
) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, sums, squared distances) of the rows nearest to each centre of each model, from one scan. Without
    ``squared`` the distances are left at 0: steps need none.

    With the number of ``tasks`` known to be small, their sums come back without a shuffle in between."""
    stack, sizes = _stacked(centers)
    width = stack.shape[1]
    matrix, _, nearest = _tools()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, squares, sums = np.zeros(len(stack)), np.zeros(len(stack)), np.zeros((len(stack), width))
        for batch in batches:
            whole = matrix(batch)
            for at in range(0, len(whole), CHUNK):
                x = whole[at : at + CHUNK]
                near = nearest(x, stack, sizes)
                member = np.zeros((len(x), len(stack)))
                np.put_along_axis(member, near, 1.0, axis=1)
                rows += np.bincount(near.ravel(), minlength=len(stack))
                sums += member.T @ x
                for m in range(len(sizes) if squared else 0):  # differences, not products, so that no digits are lost
                    gap = x - stack[near[:, m]]
                    squares += np.bincount(near[:, m], (gap * gap).sum(axis=1), len(stack))
        held = np.flatnonzero(rows)
        columns = [held, rows[held].astype(np.int64), squares[held], *sums[held].T]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    names = ["c", "n", "squares", *[f"s{j}" for j in range(width)]]
    schema = "c long, n long, squares double, " + ", ".join(f"s{j} double" for j in range(width))
    parts = points.select("x").mapInArrow(run, schema)
    if tasks * len(stack) > PARTIAL_ROWS:
        parts = parts.groupBy("c").agg(*[F.sum(n).alias(n) for n in names[1:]])
    rows, squares, sums = np.zeros(len(stack)), np.zeros(len(stack)), np.zeros((len(stack), width))
    for r in parts.collect():  # one row a centre, or a centre and task where these are few
        rows[r.c] += r.n
        squares[r.c] += r.squares
        sums[r.c] += r[3:]
    cuts = np.cumsum(sizes)[:-1]
    return list(zip(np.split(rows, cuts), np.split(sums, cuts), np.split(squares, cuts)))


def lloyd_many(points: DataFrame, starts: Sequence[np.ndarray], max_steps: int = 300, tol: float = 0.0, tasks: int = PARTIAL_ROWS) -> list[Fit]:
    """Each start refined until the squared moves of its centres add up to ``tol`` or less. A centre that loses
    all rows stays where it is."""
    centers = [np.array(c, float) for c in starts]
    steps, moving = [0] * len(centers), list(range(len(centers)))
    for _ in range(max_steps):
        found = assigned_sums(points, [centers[m] for m in moving], tasks, False)
        still = []
        for m, (rows, sums, _) in zip(moving, found):
            new = np.where(rows[:, None] > 0, sums / np.maximum(rows, 1)[:, None], centers[m])
            moved = ((new - centers[m]) ** 2).sum()
            centers[m], steps[m] = new, steps[m] + 1
            if moved > tol:
                still.append(m)
        moving = still
        if not moving:
            break
    found = assigned_sums(points, centers, tasks)
    return [Fit(c, rows, sums, squares, n) for c, n, (rows, sums, squares) in zip(centers, steps, found)]


# --- starts ----------------------------------------------------------------------------------


def _drawn(points: DataFrame, chosen: Sequence[np.ndarray] | None, take: Sequence[int], salts: Sequence[int]) -> list[np.ndarray]:
    """``take`` rows for each model, in proportion to the squared distance to ``chosen`` (any row without it)."""
    stack, sizes = _stacked(chosen) if chosen else (None, None)
    matrix, distances, _ = _tools()
    many, salt = list(take), np.array([s & 0xFFFFFFFFFFFFFFFF for s in salts], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0), np.zeros((0, 0)))] * len(many)
        for batch in batches:
            whole, ids = matrix(batch), batch.column("h").to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(whole), CHUNK):
                x, h = whole[at : at + CHUNK], ids[at : at + CHUNK]
                with np.errstate(over="ignore"):  # a 64-bit mixer of id and model
                    u = (h[:, None] ^ salt[None, :]) * np.uint64(0x9E3779B97F4A7C15)
                    u = (u ^ (u >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
                    u = (u ^ (u >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
                    u = ((u ^ (u >> np.uint64(31))) >> np.uint64(11)).astype(float) + 0.5
                value = -np.log(u / 2.0**53)
                if stack is not None:
                    gap = np.minimum.reduceat(distances(x, stack), np.cumsum([0, *sizes[:-1]]), axis=1)
                    with np.errstate(divide="ignore"):
                        value = value / gap
                for m, k in enumerate(many):
                    held, rows = best[m]
                    near = np.flatnonzero(value[:, m] < held[-1]) if len(held) == k else np.arange(len(x))
                    values = np.concatenate([held, value[near, m]])
                    by = np.argsort(values, kind="stable")[:k]
                    best[m] = values[by], (np.concatenate([rows, x[near]]) if len(held) else x[near])[by]
        m = np.repeat(np.arange(len(many)), [len(v) for v, _ in best])
        rows = [r for _, x in best for r in x.tolist()]
        columns = [pa.array(m), pa.array(np.concatenate([v for v, _ in best])), pa.array(rows, pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["m", "value", "x"])

    found = points.mapInArrow(run, "m long, value double, x array<double>").where("value < double('infinity')")
    place = F.row_number().over(Window.partitionBy("m").orderBy("value", "x"))
    first = found.withColumn("place", place).where(F.col("place") <= max(many))
    out: list[list] = [[] for _ in many]
    for r in first.orderBy("m", "place").collect():  # ``take`` rows a model
        if r.place <= many[r.m]:
            out[r.m].append(r.x)
    return [np.array(x, float) for x in out]


def _reduced(candidates: np.ndarray, weights: np.ndarray, k: int, seed: int, steps: int = 30) -> np.ndarray:
    """k-means++ over weighted candidates, and some Lloyd steps over them."""
    rng = np.random.default_rng(seed)
    weights = weights + (weights.sum() == 0)
    picked = [int(rng.choice(len(candidates), p=weights / weights.sum()))]
    for _ in range(k - 1):
        gap = ((candidates[:, None] - candidates[picked][None]) ** 2).sum(axis=2).min(axis=1) * weights
        picked.append(int(rng.choice(len(candidates), p=gap / gap.sum())) if gap.sum() > 0 else picked[0])
    centers = candidates[picked].copy()
    for _ in range(steps):
        near = ((candidates[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        for c in range(k):
            if weights[near == c].sum() > 0:
                centers[c] = np.average(candidates[near == c], axis=0, weights=weights[near == c])
    return centers


def starts(points: DataFrame, ks: Sequence[int], seeds: Sequence[int], tasks: int = PARTIAL_ROWS) -> list[np.ndarray]:
    """Start centres of one model per (k, seed): 2 + ``ROUNDS`` scans for all models together. Fewer rows than
    k repeat a centre."""
    salts = [(seed * 1_000_003 + k) * 0x9E3779B97F4A7C15 for k, seed in zip(ks, seeds)]
    chosen = _drawn(points, None, [1] * len(ks), salts)
    if any(not len(c) for c in chosen):
        raise ValueError("no rows with features")
    for r in range(1, ROUNDS + 1):
        more = _drawn(points, chosen, [2 * k for k in ks], [s + r * 0xD1B54A32D192ED03 for s in salts])
        chosen = [np.concatenate([a, b]) if len(b) else a for a, b in zip(chosen, more)]
    weights = [rows for rows, _, _ in assigned_sums(points, chosen, tasks, False)]
    return [_reduced(c, w, k, seed) for c, w, k, seed in zip(chosen, weights, ks, seeds)]


def fit_many(
    df: DataFrame, ks: Sequence[int], restarts: int, seed: int, features: str = "features", id_col: str | None = None,
    max_steps: int = 300, tol: float = 1e-4,
) -> dict[int, Fit]:
    """For each k the fit with the least cost among ``restarts``; the first of equals. ``tol`` is in units of
    the mean variance of the features."""
    points = keep(points_of(df, features, id_col))
    tasks = points.rdd.getNumPartitions()
    if tasks < df.sparkSession.sparkContext.defaultParallelism:  # too few to use the cores
        points = keep(spread(points))
        tasks = points.rdd.getNumPartitions()
    jobs = [(k, seed + r) for k in ks for r in range(restarts)]
    first = starts(points, [k for k, _ in jobs], [s for _, s in jobs], tasks)
    ((rows, sums, squares),) = assigned_sums(points, [first[0].mean(axis=0)[None]], tasks)
    off = sums[0] / rows[0] - first[0].mean(axis=0)
    variance = (squares[0] / rows[0] - (off * off).sum()) / len(off)
    fits = lloyd_many(points, first, max_steps, tol * variance, tasks)
    best: dict[int, Fit] = {}
    for (k, _), fit in zip(jobs, fits):
        if k not in best or fit.cost < best[k].cost:
            best[k] = fit
    return best


# --- silhouette ------------------------------------------------------------------------------


def squared_silhouettes(points: DataFrame, fits: Mapping[int, Fit]) -> dict[int, float]:
    """Mean silhouette by squared distance of each fit's assignment, from one scan for all.

    The mean squared distance of a row to a cluster follows from the cluster's count, sum and squares. A row
    that is alone in its cluster, or has no other cluster to compare with, counts 0.
    """
    keys, order = list(fits), list(fits.values())
    stack, sizes = _stacked([f.centers for f in order])
    rows = np.concatenate([f.rows for f in order])
    spread = np.concatenate([f.squares for f in order]) / np.maximum(rows, 1)
    drift = np.concatenate([f.sums - f.rows[:, None] * f.centers for f in order]) / np.maximum(rows, 1)[:, None]
    matrix, distances, nearest = _tools()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(len(sizes)), 0
        for batch in batches:
            whole = matrix(batch)
            for at in range(0, len(whole), CHUNK):
                x = whole[at : at + CHUNK]
                near = nearest(x, stack, sizes)
                mean = distances(x, stack) + spread - 2 * (x @ drift.T - (stack * drift).sum(axis=1))
                mean = np.where(rows > 0, np.maximum(mean, 0.0), np.inf)
                first, every = 0, np.arange(len(x))
                for m, k in enumerate(sizes):
                    own, n = mean[every, near[:, m]], rows[near[:, m]]
                    a = own * n / np.maximum(n - 1, 1)
                    others = mean[:, first : first + k].copy()
                    others[every, near[:, m] - first] = np.inf
                    b = others.min(axis=1)
                    widest = np.maximum(a, b)
                    good = (n > 1) & np.isfinite(b) & (widest > 0)
                    total[m] += ((b - a)[good] / widest[good]).sum()
                    first += k
                seen += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sizes))), pa.array(total), pa.array([seen] * len(sizes), pa.int64())], names=["m", "total", "seen"])

    parts = points.select("x").mapInArrow(run, "m long, total double, seen long")
    found = parts.groupBy("m").agg((F.sum("total") / F.sum("seen")).alias("s")).collect()  # one row a fit
    return {keys[r.m]: r.s for r in found}
