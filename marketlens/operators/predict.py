"""Sales prediction: a split that keeps products whole, two models, metrics."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from decimal import Decimal
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import keep
from . import forest
from .forest import Forest
from .kmeans import as_array
from .segments import assemble

SEED = 42
TEST_SHARE = 0.2


def key_digest(key: str, seed: int, digest: str = "xxhash64") -> Column:
    """Fixed-width hexadecimal digest of key and seed; text order is the shuffle order."""
    seeded = F.concat_ws("#", F.col(key).cast("string"), F.lit(str(seed)))
    if digest == "md5":
        return F.md5(seeded)
    if digest == "xxhash64":
        return F.lpad(F.hex(F.xxhash64(seeded)), 16, "0")
    raise ValueError(f"unknown digest {digest!r}")


def split_sides(
    df: DataFrame, key: str, test_share: float = TEST_SHARE, seed: int = SEED, digest: str = "xxhash64", side: str = "side"
) -> DataFrame:
    """Rows with a key, tagged ``train`` or ``test``: every row of a key on one side, and
    ``ceil(share * keys)`` test keys.

    The test keys are those with the smallest digests. Only the last of them has to be known: it is
    found from counts per digest prefix, so neither the keys nor the rows pass through one task. The
    digest of a row is taken once.
    """
    known = df.where(F.col(key).isNotNull())
    last = _last_test_key(known, key, test_share, seed, digest)
    if last is None:
        return known.withColumn(side, F.lit("train"))
    at = F.struct(key_digest(key, seed, digest).alias("d"), F.col(key).cast("string").alias("k"))
    bound = F.struct(F.lit(last[0]).alias("d"), F.lit(last[1]).alias("k"))
    return known.withColumn(side, F.when(at <= bound, "test").otherwise("train"))


def group_split(
    df: DataFrame, key: str, test_share: float = TEST_SHARE, seed: int = SEED, digest: str = "xxhash64"
) -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` of ``split_sides``. Rows without a key are left out."""
    tagged = split_sides(df, key, test_share, seed, digest, "_side")
    return tuple(tagged.where(F.col("_side") == name).drop("_side") for name in ("train", "test"))


_DIGITS = 4  # hexadecimal digits more per round: at most 65,536 counters
_FEW_KEYS = 65_536


def _last_test_key(known: DataFrame, key: str, share: float, seed: int, digest: str, few: int = _FEW_KEYS) -> tuple[str, str] | None:
    """The test key with the largest digest: prefixes grow until the one that holds it has ``few`` keys."""
    keys = keep(
        known.select(key).distinct().select(key_digest(key, seed, digest).alias("d"), F.col(key).cast("string").alias("k"))
    )
    prefix, left = "", None
    while True:
        inside = keys.where(F.col("d").startswith(prefix)) if prefix else keys
        longer = F.substring("d", 1, len(prefix) + _DIGITS)
        counts = sorted(inside.groupBy(longer.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
        if left is None:
            # exact arithmetic: 0.2 * 10 must give 2, not the next whole number
            left = math.ceil(sum(n for _, n in counts) * Decimal(str(share)))
        if left == 0 or not counts:
            return None
        for p, n in counts:
            if left <= n:
                break
            left -= n
        if n <= few or p == prefix:
            break
        prefix = p
    first = sorted((r.d, r.k) for r in inside.where(longer == p).collect())  # ``few`` keys
    return first[left - 1]


def fit_scaling(train: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of each mean-filled feature, from one aggregation.

    Filling with the mean leaves the mean as it is and spreads the same squared error over all
    rows. A feature without any value has no mean to fill with and is left out.
    """
    x = {c: F.col(c).cast("double") for c in features}
    row = train.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.avg(x[c]).alias(f"m_{c}") for c in features],
        *[F.sqrt(F.try_divide(F.var_pop(x[c]) * F.count(x[c]), F.count(F.lit(1)))).alias(f"s_{c}") for c in features],
    ).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in features if row[f"m_{c}"] is not None}


def impute_standardize(df: DataFrame, scaling: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Nulls to the training mean, then standardise by training statistics (constant features to 0)."""
    def scaled(c: str, mean: float, deviation: float) -> Column:
        if deviation == 0:
            return F.lit(0.0)
        return (F.coalesce(F.col(c).cast("double"), F.lit(mean)) - F.lit(mean)) / F.lit(deviation)

    return df.withColumns({c: scaled(c, mean, deviation) for c, (mean, deviation) in scaling.items()})


def prepare(df: DataFrame, scaling: Mapping[str, tuple[float, float]]) -> DataFrame:
    return assemble(impute_standardize(df, scaling), list(scaling))


class Linear(NamedTuple):
    """Least squares with intercept. ``kept`` are the features that entered, ``dropped`` the ones that others
    determine; their coefficients are 0."""

    coefficients: list[float]
    intercept: float
    kept: list[int]
    dropped: list[int]
    rows: int

    def transform(self, df: DataFrame, features: str = "features", output: str = "prediction") -> DataFrame:
        total = F.lit(self.intercept)
        for j in self.kept:
            total = total + F.get(F.col("_x_of_row"), F.lit(j)) * F.lit(self.coefficients[j])
        value = F.when(F.col("_x_of_row").isNotNull(), total)
        return df.withColumn("_x_of_row", as_array(df, features)).withColumn(output, value).drop("_x_of_row")


def gram(
    df: DataFrame, target: str, features: str, center: Sequence[float] | None = None, weight: str | None = None
) -> tuple[int, np.ndarray]:
    """Row count, and the matrix of products of (1, features, target) summed over the rows that have both.

    One aggregation with a map-side step over the distinct products. ``center`` is taken off features and
    target first. A row with ``weight`` n stands for n rows.
    """
    alike = F.col(weight) if weight else F.lit(1)
    rows = df.select(as_array(df, features).alias("x"), F.col(target).cast("double").alias("y"), alike.cast("long").alias("w")).where("x IS NOT NULL AND y IS NOT NULL")
    if center is None:
        width = (rows.select(F.max(F.size("x"))).first()[0] or 0) + 1
        center = [0.0] * width
    width = len(center)
    one = lambda i: (F.get("x", F.lit(i)) if i < width - 1 else F.col("y")) - F.lit(center[i])
    names = [f"v{i}" for i in range(width)]
    narrow = rows.select("w", *[one(i).alias(n) for i, n in enumerate(names)])
    w = F.col("w")
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    found = narrow.agg(
        F.coalesce(F.sum(w), F.lit(0)), *[F.sum(F.col(n) * w) for n in names], *[F.sum(F.col(names[i]) * F.col(names[j]) * w) for i, j in pairs]
    ).first()
    out = np.zeros((width + 1, width + 1))
    if found[0]:
        out[0, 0], out[0, 1:] = found[0], found[1 : width + 1]
        for (i, j), v in zip(pairs, found[width + 1 :]):
            out[i + 1, j + 1] = v
    return found[0], np.triu(out) + np.triu(out, 1).T


def fit_linear(train: DataFrame, target: str, features: str = "features", tol: float = 1e-10, weight: str | None = None) -> Linear:
    """Ordinary least squares with intercept from sums of products, with pivoting.

    Two aggregations: the means, then the products about them, which keeps the digits of columns far from 0.
    The feature with the most variance left enters next; one whose variance is explained by those before it, down
    to a share of ``tol``, is dropped and reported, so collinear features do no harm. A row with ``weight`` n
    stands for n rows. Without rows there is nothing to fit and an error is raised.
    """
    n, sums = gram(train, target, features, weight=weight)
    if not n:
        raise ValueError("no rows with features and target")
    means = sums[0, 1:] / n
    products = gram(train, target, features, means.tolist(), weight)[1]
    drift = products[0, 1:] / n  # what the rounded means left
    cov = products[1:, 1:] / n - np.outer(drift, drift)
    means = means + drift
    left, kept, dropped = cov.copy(), [], []
    own = np.diag(cov)[:-1].copy()
    todo = list(range(len(own)))
    while todo:
        share = [left[j, j] / own[j] if own[j] > 0 else 0.0 for j in todo]
        j = todo.pop(int(np.argmax(share)))
        if max(share) <= tol:
            dropped.append(j)
            continue
        left = left - np.outer(left[:, j], left[j]) / left[j, j]
        kept.append(j)
    kept, dropped = sorted(kept), sorted(dropped)
    coefficients = np.zeros(len(own))
    if kept:
        scale = np.sqrt(own[kept])  # equal scales, so that the solution is as good as the data allow
        inner = cov[np.ix_(kept, kept)] / np.outer(scale, scale)
        coefficients[kept] = np.linalg.solve(inner, cov[kept, -1] / scale) / scale
    intercept = means[-1] - coefficients @ means[:-1]
    return Linear(coefficients.tolist(), float(intercept), kept, dropped, int(n))


def fit_forest(
    train: DataFrame, target: str, seed: int = SEED, trees: int = 100, bootstrap: bool = True, row_key: Sequence[str] | None = None,
    weight: str | None = None,
) -> Forest:
    """Random forest; one tree without ``bootstrap`` is a plain regression tree. See ``forest.fit``."""
    return forest.fit(train, target, trees=trees, seed=seed, bootstrap=bootstrap, row_key=row_key, weight=weight)


def ols_simple(df: DataFrame, x: str, y: str) -> DataFrame:
    """Slope and intercept of a one-feature fit, as one aggregation."""
    return df.agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2")
    )


def regression_metrics(df: DataFrame, actual: str, predicted: str = "prediction", weight: str | None = None) -> DataFrame:
    """Mean absolute error, root mean squared error and R squared in one pass; a row with ``weight`` n stands
    for n rows, and takes a pass more for the mean.

    Constant actual values give R squared 1 when every prediction is right and 0 otherwise.
    """
    gap = F.col(actual) - F.col(predicted)
    if weight is None:
        mean, spread = F.avg, F.var_pop(actual)
    else:
        mean = lambda x: F.try_divide(F.sum(x * F.col(weight)), F.sum(F.when(x.isNotNull(), F.col(weight))))
        middle = df.agg(mean(F.col(actual).cast("double"))).first()[0]
        off = F.col(actual) - F.lit(middle).cast("double")
        spread = F.when(F.min(actual) == F.max(actual), F.lit(0.0)).otherwise(mean(off * off))
    sums = df.agg(
        mean(F.abs(gap)).alias("mae"),
        mean(gap * gap).alias("_mse"),
        spread.alias("_var"),
    )
    r2 = F.when(F.col("_var") > 0, 1 - F.try_divide(F.col("_mse"), F.col("_var"))).otherwise(
        F.when(F.col("_mse") == 0, 1.0).when(F.col("_mse").isNotNull(), 0.0)
    )
    return sums.select("mae", F.sqrt("_mse").alias("rmse"), r2.alias("r2"))


def model_comparison(predictions: Mapping[str, DataFrame], target: str, digits: int = 4, weight: str | None = None) -> DataFrame:
    """One row of rounded metrics per model."""
    out = None
    for name, frame in predictions.items():
        row = regression_metrics(frame, target, weight=weight).select(
            F.lit(name).alias("model"), *[F.round(c, digits).alias(c) for c in ("mae", "rmse", "r2")]
        )
        out = row if out is None else out.unionAll(row)
    return out


def feature_importance(model: Forest, features: Sequence[str], like: DataFrame) -> DataFrame:
    """Feature names and importances, highest first (one row per feature)."""
    found = model.importances.tolist()
    values = found + [0.0] * (len(features) - len(found))
    rows = sorted(zip(features, values), key=lambda r: (-r[1], r[0]))
    return like.sparkSession.createDataFrame(rows, "feature string, importance double")
