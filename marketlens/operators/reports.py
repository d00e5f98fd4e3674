"""Report tables and chart-ready data."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.prices import nan_to_null
from .merge import join_small
from .quantiles import exact_quantiles, medians


# --- row picks -------------------------------------------------------------------------------


def high_sellers(
    df: DataFrame, sales: str = "sales_volume_num", min_sales: float = 5000, tie: Sequence[str] = ("asin",), ordered: bool = True
) -> DataFrame:
    """Rows at or above the threshold, highest first; in no order with ``ordered=False``.

    Sales repeat a lot; the ``tie`` columns also let the sort split a value that many rows share.
    """
    chosen = df.where(F.col(sales) >= min_sales)
    return chosen.orderBy(F.col(sales).desc(), *tie) if ordered else chosen


def key_series(history: DataFrame, keys: Sequence[str] | DataFrame, key: str = "asin", ts: str = "date") -> DataFrame:
    """History of the listed keys in time order. ``keys`` is a list, or a frame with the key column."""
    if isinstance(keys, DataFrame):
        chosen = history.join(keys.select(key).distinct(), key, "left_semi")
    else:
        chosen = history.where(F.col(key).isin(*keys))
    return chosen.orderBy(key, ts)


def top_k(df: DataFrame, col: str, k: int = 10, tie: Sequence[str] = ()) -> DataFrame:
    """The ``k`` highest rows; each task keeps ``k`` rows, nothing is sorted as a whole."""
    return df.orderBy(F.col(col).desc(), *tie).limit(k)


def row_at_extreme(df: DataFrame, col: str, largest: bool = True, tie: Sequence[str] = ()) -> DataFrame:
    """First row (by ``tie``) that holds the largest or smallest value."""
    known = df.where(F.col(col).isNotNull())
    first = F.col(col).desc() if largest else F.col(col).asc()
    return known.orderBy(first, *tie).limit(1)


def series_change(df: DataFrame, value: str, order: Sequence[str]) -> DataFrame:
    """First and last value in ``order`` and the change in percent."""
    at = F.struct(*order)
    ends = df.agg(F.min_by(value, at).alias("first_value"), F.max_by(value, at).alias("last_value"))
    moved = F.try_divide(F.col("last_value") - F.col("first_value"), F.col("first_value")) * 100
    return ends.withColumn("change_pct", moved)


# --- aggregates ------------------------------------------------------------------------------


def segment_summary(df: DataFrame, by: str, value: str, digits: int | None = None) -> DataFrame:
    """Count of non-null values, mean, minimum and maximum per segment; rows without one are left out."""
    shown = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    return df.where(F.col(by).isNotNull()).groupBy(by).agg(
        F.count(value).alias("n"),
        shown(F.avg(value)).alias("mean_price"),
        shown(F.min(value)).alias("min_price"),
        shown(F.max(value)).alias("max_price"),
    )


def brand_sales(df: DataFrame, brand: str = "product_byline", sales: str = "sales_volume_num") -> DataFrame:
    """Sum per brand; a brand with null sales only has 0. Rows without a brand are left out."""
    zero = F.lit(0).cast(dict(df.dtypes)[sales])
    return (
        df.where(F.col(brand).isNotNull())
        .groupBy(brand)
        .agg(F.coalesce(F.sum(sales), zero).alias(sales))
    )


def share_of_total(totals: DataFrame, value: str, name: str = "share_pct") -> DataFrame:
    """Percent of the total over **all** rows of a grouped table; take the top after this step."""
    whole = totals.agg(F.sum(value)).scalar()
    return totals.withColumn(name, F.try_divide(F.col(value), whole) * 100)


def price_trend(df: DataFrame, ts: str = "date", value: str = "price", grain: str | None = None) -> DataFrame:
    """Mean per exact timestamp, or per ``grain`` (``month``, ``day``, ...), in time order."""
    known = df.where(F.col(ts).isNotNull() & F.col(value).isNotNull())
    if grain is None:
        moment = F.col(ts)
    else:
        moment = F.date_trunc(grain, F.col(ts)).cast(dict(df.dtypes)[ts])
    return known.groupBy(moment.alias(ts)).agg(F.avg(value).alias(value)).orderBy(ts)


def cluster_profile(df: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    """Group size and the mean of each column; rows without a group are left out."""
    return df.where(F.col(by).isNotNull()).groupBy(by).agg(
        F.count(F.lit(1)).alias("n_products"), *[F.avg(c).alias(c) for c in columns]
    )


def crosstab_counts(df: DataFrame, rows: str, columns: str) -> DataFrame:
    """Counts of all pairs that occur, in long form; rows in which either value is null do not count."""
    known = df.where(F.col(rows).isNotNull() & F.col(columns).isNotNull())
    return known.groupBy(rows, columns).agg(F.count(F.lit(1)).alias("n"))


def crosstab(df: DataFrame, rows: str, columns: str, values: Sequence = (), limit: int = 1000) -> DataFrame:
    """Counts of ``rows`` against **all** values of ``columns``, one column each; an absent pair is 0.

    ``values`` come first and are there even when they do not occur; the others are found in the data.
    More than ``limit`` values in the data are an error, as in a pivot, and no more come to the driver;
    ``crosstab_counts`` is the long form for any number of them.
    """
    counts = crosstab_counts(df, rows, columns)
    found = [r[0] for r in counts.select(columns).distinct().limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"more than {limit} values in {columns}: use crosstab_counts")
    names = [*values, *sorted(v for v in found if v not in set(values))]
    wide = counts.groupBy(rows).pivot(columns, names).agg(F.sum("n"))
    return wide.na.fill(0, [c for c in wide.columns if c != rows])


def pair_corr(a: Column, b: Column) -> Column:
    """Pearson correlation over the rows where both are present; null for a constant column. NaN counts as null."""
    a, b = nan_to_null(a.cast("double")), nan_to_null(b.cast("double"))
    x, y = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All pairs of columns in long form ``(a, b, corr)``, from one aggregation."""
    columns = list(columns)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    stats = df.agg(*[pair_corr(F.col(a), F.col(b)).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        for left, right in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(left).alias("a"), F.lit(right).alias("b"), F.col(f"_{i}").alias("corr")))
    return stats.select(F.inline(F.array(*cells)))


def corr_table(df: DataFrame, columns: Sequence[str], digits: int = 3) -> DataFrame:
    """The correlation matrix as a table, with the row label as its first column."""
    columns = list(columns)
    stats = df.agg(
        *[
            F.struct(*[F.round(pair_corr(F.col(a), F.col(b)), digits).alias(b) for b in columns]).alias(a)
            for a in columns
        ]
    )
    rows = F.array(*[F.struct(F.lit(a).alias("column"), *[F.col(a)[b].alias(b) for b in columns]) for a in columns])
    return stats.select(F.inline(rows))


def column_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact median, mean and population deviation, one row per column; NaN counts as null."""
    columns = list(columns)
    wide = df.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in columns])
    mid = medians(wide, columns)
    stats = wide.agg(
        *[F.struct(F.lit(c).alias("column"), F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("stddev_pop"),
                   F.lit(mid[c]).cast("double").alias("median")).alias(f"_{i}") for i, c in enumerate(columns)]
    )
    return stats.select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(columns))])))


# --- chart data ------------------------------------------------------------------------------


def _boxes(df: DataFrame, by: str, value: str, whisker: float) -> DataFrame:
    quart = exact_quantiles(df, value, [0.25, 0.5, 0.75], [by])
    q = lambda i: F.get("quantiles", F.lit(i))
    spread = whisker * (q(2) - q(0))
    return quart.select(
        F.col(by),
        q(0).alias("q1"),
        q(1).alias("median"),
        q(2).alias("q3"),
        (q(0) - spread).alias("_low"),
        (q(2) + spread).alias("_high"),
    ).where(F.col(by).isNotNull())


def box_stats(df: DataFrame, by: str, value: str, whisker: float = 1.5) -> DataFrame:
    """Quartiles, whisker ends, outlier count, mean and size per group.

    The input is read three times (sketch, exact ranks, whiskers); keep it first when it is costly.
    """
    x = F.col(value)
    known = df.where(F.col(by).isNotNull() & x.isNotNull()).select(by, value)
    fenced = join_small(known, _boxes(known, by, value, whisker), [by])
    inside = x.between(F.col("_low"), F.col("_high"))
    return fenced.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(x).alias("mean"),
        F.first("q1").alias("q1"),
        F.first("median").alias("median"),
        F.first("q3").alias("q3"),
        F.min(F.when(inside, x)).alias("whisker_low"),
        F.max(F.when(inside, x)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def box_outliers(df: DataFrame, by: str, value: str, whisker: float = 1.5) -> DataFrame:
    """The rows outside the whiskers of their group."""
    known = df.where(F.col(by).isNotNull() & F.col(value).isNotNull())
    fenced = join_small(known, _boxes(known, by, value, whisker), [by])
    outside = ~F.col(value).between(F.col("_low"), F.col("_high"))
    return fenced.where(outside).select(*df.columns)


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Equal-width bins over the value range; the last bin includes its upper edge, empty bins stay.

    A column of one value gets a range of width 1 around it; NaN counts as null.
    """
    x = F.col("_x")
    values = df.select(nan_to_null(F.col(col).cast("double")).alias("_x")).where(x.isNotNull())
    span = values.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    flat = F.col("lo") == F.col("hi")
    span = span.select(
        F.struct(
            F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        )
    ).scalar()
    lo, hi = F.col("_s.lo"), F.col("_s.hi")
    step = (hi - lo) / bins
    bin_of = F.least(F.floor((x - lo) / step), F.lit(bins - 1)).cast("int")
    counts = values.withColumn("_s", span).groupBy(bin_of.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    axis = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"), span.alias("_s"))
    edges = axis.select("bin", (lo + step * F.col("bin")).alias("bin_start"), (lo + step * (F.col("bin") + 1)).alias("bin_end"))
    return edges.join(counts, "bin", "left").na.fill(0, ["n"])


def kde_grid(df: DataFrame, col: str, points: int = 200) -> DataFrame:
    """Gaussian kernel density on an even grid over the value range; NaN counts as null.

    Bandwidth is ``n^(-1/5)`` times the sample deviation; a column of one value has no density (null).
    Equal values are counted first (prices repeat). Each batch of values is then turned into one sum per
    grid point inside its task, so no row is made for a pair of value and point.
    """
    x = F.col("_x")
    values = df.select(nan_to_null(F.col(col).cast("double")).alias("_x")).where(x.isNotNull())
    row = values.agg(
        F.min(x).alias("lo"), F.max(x).alias("hi"), F.stddev_samp(x).alias("sd"), F.count(F.lit(1)).alias("n")
    ).first()
    n, width = row["n"], (row["sd"] or 0.0) * row["n"] ** -0.2 if row["n"] else 0.0
    spark = df.sparkSession
    if not n:
        return spark.createDataFrame([], "point int, x double, density double")
    step = (row["hi"] - row["lo"]) / (points - 1) if points > 1 else 0.0
    grid = [row["lo"] + step * i for i in range(points)]
    axis = spark.createDataFrame([(i, x) for i, x in enumerate(grid)], "point int, x double")
    if not width > 0:
        return axis.withColumn("density", F.lit(None).cast("double"))

    def kernels(batches):
        import numpy as np
        import pyarrow as pa

        at = np.array(grid)
        for batch in batches:
            v, c = batch.column("_x").to_numpy(), batch.column("_c").to_numpy()
            total = np.zeros(len(at))
            for k in range(0, len(v), 4096):
                z = (v[k : k + 4096, None] - at) / width
                total += c[k : k + 4096] @ np.exp(-0.5 * z * z)
            yield pa.RecordBatch.from_pydict({"point": pa.array(range(len(at)), pa.int32()), "total": total})

    sums = values.groupBy("_x").agg(F.count(F.lit(1)).alias("_c")).mapInArrow(kernels, "point int, total double")
    summed = sums.groupBy("point").agg(F.sum("total").alias("total"))
    scale = n * width * math.sqrt(2 * math.pi)
    return summed.join(axis, "point").select("point", "x", (F.col("total") / scale).alias("density"))


def bar_means(df: DataFrame, by: str, value: str) -> DataFrame:
    """Mean per category with a normal 95 % interval."""
    stats = df.where(F.col(by).isNotNull() & F.col(value).isNotNull()).groupBy(by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("_sd")
    )
    half = F.lit(1.96) * F.col("_sd") / F.sqrt(F.col("n").cast("double"))
    return stats.select(by, "n", "mean", (F.col("mean") - half).alias("low"), (F.col("mean") + half).alias("high"))


def scatter_points(
    df: DataFrame,
    x: str = "price",
    y: str = "product_star_rating",
    size: str = "sales_volume_num",
    hue: str | None = None,
    sizes: tuple[float, float] = (40.0, 900.0),
    mark_at: float = 4.4,
) -> DataFrame:
    """Point table: position, marker size scaled between ``sizes``, hue, and a rating flag."""
    small, big = sizes
    span = df.agg(F.min(size).cast("double").alias("lo"), F.max(size).cast("double").alias("hi"))
    span = span.select(F.struct("lo", "hi")).scalar()
    unit = F.try_divide(F.col(size) - F.col("_s.lo"), F.col("_s.hi") - F.col("_s.lo"))
    extra = [F.col(hue).alias("hue")] if hue else []
    return df.withColumn("_s", span).select(
        *[c for c in ("asin",) if c in df.columns],
        F.col(x).alias("x"),
        F.col(y).alias("y"),
        (F.lit(small) + unit * (big - small)).alias("size"),
        *extra,
        (F.col("product_star_rating") >= mark_at).alias("above_mark"),
    )
