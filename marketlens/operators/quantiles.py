"""Exact quantiles at scale.

The built-in exact percentile keeps every distinct value of a group in one task. Here a mergeable sketch
first brackets each wanted rank. A pass over the rows then counts what lies below and inside each
bracket, and takes the nearest values outside it; no row is copied. A bracket that still holds many values is
narrowed by a sketch of its inside, one that missed its rank is opened, until each holds its rank and a
bounded number of values. Only those values are put in order, so the result is exact at any size and
for any skew.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import keep
from .merge import join_small

SKETCH_ACCURACY = 10_000
# Rank slack around each bracket, as a multiple of the sketch's error bound (1 / accuracy).
SLACK = 4
# Values inside a bracket that are put in order in one task.
MOST_INSIDE = 200_000
_STEPS = 64  # a bracket's inside is cut into so many parts
_ROUNDS = 40  # each cuts a bracket to a twentieth or less, so this many are never needed


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int = SKETCH_ACCURACY,
    most_inside: int = MOST_INSIDE,
) -> DataFrame:
    """Linearly interpolated quantiles: ``by`` columns, ``n`` and ``quantiles`` (array, as ``probs``).

    Nulls and NaN do not count. The input is read three times or more; keep it first when it is costly.
    """
    by, wanted = list(by), range(len(probs))
    x = F.col("_x")
    known = df.select(*by, F.col(value).cast("double").alias("_x")).where(x.isNotNull() & ~F.isnan(x))
    slack = SLACK / accuracy
    edges = [e for p in probs for e in (max(p - slack, 0.0), min(p + slack, 1.0))]
    brackets = known.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx(x, edges, accuracy).alias("_edges"))
    brackets = brackets.select(
        *by, "_n", *[F.get("_edges", F.lit(2 * i + k)).alias(f"_{name}{i}") for i in wanted for k, name in enumerate(("lo", "hi"))]
    )
    for _ in range(_ROUNDS):
        rows = _beside(known, brackets, by)
        measured = keep(rows.groupBy(*by).agg(F.first("_n").alias("_n"), *[m for i in wanted for m in _measures(x, i)]))
        lost = [_missed(i, p) for i, p in enumerate(probs)]
        wide = [F.col(f"_in{i}") > most_inside for i in wanted]
        if not measured.where(_any([*lost, *[w & (F.col(f"_lo{i}") < F.col(f"_hi{i}")) for i, w in enumerate(wide)]])).limit(1).count():
            break
        grid = [k / _STEPS for k in range(_STEPS + 1)]
        inside = [F.percentile_approx(F.when(_is_inside(x, i), x), grid, SKETCH_ACCURACY).alias(f"_grid{i}") for i in wanted]
        sketched = keep(rows.groupBy(*by).agg(*inside))
        new = _beside(measured, sketched, by)
        new = keep(new.select(*by, "_n", *[c for i, p in enumerate(probs) for c in _narrower(i, p, lost[i], wide[i])], *[F.struct(f"_lo{i}", f"_hi{i}").alias(f"_was{i}") for i in wanted]))
        if not new.where(_any([F.col(f"_was{i}") != F.struct(f"_lo{i}", f"_hi{i}") for i in wanted])).limit(1).count():
            break  # brackets of a few values that are there many times
        brackets = new.drop(*[f"_was{i}" for i in wanted])
    ends = [F.struct(F.lit(i).alias("i"), F.col(f"_lo{i}").alias("lo"), F.col(f"_hi{i}").alias("hi")) for i in wanted]
    near = _beside(known, measured, by).where(_any([_is_inside(x, i) for i in wanted]))
    counted = (
        near.withColumn("_t", F.explode(F.array(*ends))).where(x.between(F.col("_t.lo"), F.col("_t.hi")))
        .groupBy(*by, F.col("_t.i").alias("_i"), x.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    )
    running = Window.partitionBy(*by, "_i").orderBy("_v")  # most_inside values at most, or one value many times
    ranked = _beside(counted.withColumn("_to", F.sum("_c").over(running)), measured, by)
    pick = lambda name: F.element_at(F.array(*[F.col(f"_{name}{i}") for i in wanted]), F.col("_i") + 1)
    rank = (F.col("_n") - 1) * F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("_i") + 1)
    ranked = ranked.select(*by, "_i", "_v", "_n", (F.col("_to") + pick("below")).alias("_to"), pick("before").alias("_before"),
                           pick("after").alias("_after"), pick("below").alias("_below"), rank.alias("_rank"))

    def at(r: Column) -> Column:
        inside = F.min(F.when(F.col("_to") > r, F.col("_v")))
        return F.when(F.min(r) < F.min("_below"), F.min("_before")).otherwise(F.coalesce(inside, F.min("_after")))

    low, high = at(F.floor("_rank")), at(F.ceil("_rank"))
    exact = ranked.groupBy(*by, "_i").agg(F.first("_n").alias("_n"), low.alias("_low"), high.alias("_high"), F.min("_rank").alias("_rank"))
    value_of = F.col("_low") + (F.col("_rank") - F.floor("_rank")) * (F.col("_high") - F.col("_low"))
    return (
        exact.withColumn("_q", value_of).groupBy(*by)
        .agg(F.max("_n").alias("n"), F.array(*[F.max(F.when(F.col("_i") == i, F.col("_q"))) for i in wanted]).alias("quantiles"))
        .where(F.col("n").isNotNull())
    )


def _beside(rows: DataFrame, side: DataFrame, by: list[str]) -> DataFrame:
    """Each row with its group's columns of ``side`` (one row in all when there are no groups)."""
    own = [c for c in side.columns if c not in rows.columns or c in by]
    if by:
        return join_small(rows, side.select(*own), by)
    return rows.withColumn("_all", side.select(F.struct(*own)).scalar()).select(*rows.columns, "_all.*")


def _any(conditions: Sequence[Column]) -> Column:
    return F.exists(F.array(*[F.coalesce(c, F.lit(False)) for c in conditions]), lambda c: c)


def _is_inside(x: Column, i: int) -> Column:
    return x.between(F.col(f"_lo{i}"), F.col(f"_hi{i}"))


def _measures(x: Column, i: int) -> list[Column]:
    below, above = x < F.col(f"_lo{i}"), x > F.col(f"_hi{i}")
    return [
        F.first(f"_lo{i}").alias(f"_lo{i}"),
        F.first(f"_hi{i}").alias(f"_hi{i}"),
        F.count_if(below).alias(f"_below{i}"),
        F.count_if(~below & ~above).alias(f"_in{i}"),
        F.max(F.when(below, x)).alias(f"_before{i}"),
        F.min(F.when(above, x)).alias(f"_after{i}"),
    ]


def _missed(i: int, p: float) -> Column:
    """The rank, or its upper neighbour, lies more than one value outside the bracket."""
    rank = (F.col("_n") - 1) * float(p)
    return (F.floor(rank) < F.col(f"_below{i}") - 1) | (F.ceil(rank) > F.col(f"_below{i}") + F.col(f"_in{i}"))


def _narrower(i: int, p: float, missed: Column, wide: Column) -> list[Column]:
    """The bracket for the next round: open when it missed, cut to the parts around the rank when wide."""
    lo, hi, n = F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_in{i}")
    part = ((F.col("_n") - 1) * float(p) - F.col(f"_below{i}")) / n * _STEPS
    edge = lambda k: F.element_at(f"_grid{i}", (F.greatest(F.lit(0), F.least(F.lit(_STEPS), k)) + 1).cast("int"))
    return [
        F.when(missed, F.lit(float("-inf"))).when(wide, F.when(F.floor(part) < 2, lo).otherwise(edge(F.floor(part) - 1))).otherwise(lo).alias(f"_lo{i}"),
        F.when(missed, F.lit(float("inf"))).when(wide, F.when(F.ceil(part) > _STEPS - 2, hi).otherwise(edge(F.ceil(part) + 1))).otherwise(hi).alias(f"_hi{i}"),
    ]


def medians(df: DataFrame, columns: Sequence[str], accuracy: int = SKETCH_ACCURACY, most_inside: int = 2_000) -> dict[str, float | None]:
    """Exact medians of several columns, all from the same passes: a sketch, a count around each bracket
    (more of them, with narrower brackets, for very large tables), and the values inside. The driver
    gets a few numbers per column and at most ``most_inside`` values inside its bracket."""
    wide = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    wide = wide.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in wide.columns])
    slack = SLACK / accuracy
    row = wide.agg(
        *[F.count(c).alias(f"n_{c}") for c in wide.columns],
        *[F.percentile_approx(c, [0.5 - slack, 0.5 + slack], accuracy).alias(f"e_{c}") for c in wide.columns],
    ).first()
    size = {c: row[f"n_{c}"] for c in wide.columns}
    bracket = {c: tuple(row[f"e_{c}"]) for c in wide.columns if size[c]}
    for _ in range(_ROUNDS if bracket else 0):
        stats = [m.alias(f"{k}_{c}") for c in bracket for k, m in enumerate(_around(F.col(c), *bracket[c]))]
        grid = [k / (8 * _STEPS) for k in range(8 * _STEPS + 1)]
        inside = [F.percentile_approx(F.when(F.col(c).between(*bracket[c]), F.col(c)), grid, SKETCH_ACCURACY).alias(f"g_{c}") for c in bracket]
        measured = wide.agg(*stats, *inside).first()
        narrower = dict(bracket)
        for c, (lo, hi) in bracket.items():
            below, held, parts = measured[f"0_{c}"], measured[f"1_{c}"], measured[f"g_{c}"]
            rank = (size[c] - 1) / 2
            if math.floor(rank) < below - 1 or math.ceil(rank) > below + held:
                narrower[c] = (-math.inf, math.inf)
            elif held > most_inside and lo < hi:
                at = (rank - below) / held * (len(parts) - 1)
                low, high = math.floor(at) - 1, math.ceil(at) + 1
                narrower[c] = (parts[low] if low > 0 else lo, parts[high] if high < len(parts) - 1 else hi)
        if narrower == bracket:
            break
        bracket = narrower
    if not bracket:
        return dict.fromkeys(columns)
    entries = F.array(*[F.when(F.col(c).between(*bracket[c]), F.struct(F.lit(c).alias("c"), F.col(c).alias("v"))) for c in bracket])
    near = wide.where(_any([F.col(c).between(*bracket[c]) for c in bracket]))
    near = near.select(F.explode(F.filter(entries, lambda e: e.isNotNull())).alias("e")).groupBy("e.c", "e.v").count()
    held = {c: [] for c in bracket}
    for r in near.collect():  # most_inside values for each column, unless one value fills a bracket
        held[r["c"]].append((r["v"], r["count"]))
    out = {}
    for i, c in enumerate(columns):
        name = f"c{i}"
        out[c] = _middle(size[name], measured[f"0_{name}"], measured[f"2_{name}"], measured[f"3_{name}"], sorted(held[name])) if size[name] else None
    return out


def _around(x: Column, lo: float, hi: float) -> list[Column]:
    """Number of values below and inside, the nearest below and the nearest above."""
    return [F.count_if(x < lo), F.count_if(x.between(lo, hi)), F.max(F.when(x < lo, x)), F.min(F.when(x > hi, x))]


def _middle(n: int, below: int, before: float | None, after: float | None, inside: list[tuple[float, int]]) -> float:
    def at(rank: int) -> float:
        left = rank - below
        if left < 0:
            return before
        for v, count in inside:
            if left < count:
                return v
            left -= count
        return after

    rank = (n - 1) / 2
    low, high = at(math.floor(rank)), at(math.ceil(rank))
    return low + (rank - math.floor(rank)) * (high - low)


def fill_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace nulls by the column's exact median (a column of nulls stays null)."""
    mid = medians(df, columns)
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(mid[c]).cast("double")) for c in columns}
    )
