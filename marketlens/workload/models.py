"""Segmentation and prediction queries."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ..functions.prices import price_band
from ..functions.text import STAR_KEYS
from ..operators import forest as T
from ..operators import kmeans as K
from ..operators import predict as M
from ..operators import reports as R
from ..operators import segments as S
from ..plans.enrichment import build_enriched
from ..plans.sales_model import predict_sales
from ..plans.segmentation import segment_products
from ..schemas import MODEL_FEATURES, MODEL_TARGET
from ..session import keep
from .registry import query, rounded
from .tables import BOUNDS, PRODUCTS_SQL, SNAPSHOT_SQL, enriched_sql

_BASE = ["price", "product_star_rating", "discount_pct", "rating_balance"]
_LOG = ["product_num_ratings", "sales_volume_num"]
_F = [f"f_{c}" for c in _BASE] + [f"f_{c}_log" for c in _LOG]

_MATRIX_SQL = f"""{SNAPSHOT_SQL}, med AS (SELECT {", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in _BASE)} FROM snapshot),
  matrix AS (SELECT s.asin, s.price, {", ".join(f"coalesce(s.{c}, med.{c}) AS f_{c}" for c in _BASE)},
    {", ".join(f"ln(1 + greatest(coalesce(s.{c}, 0), 0)) AS f_{c}_log" for c in _LOG)} FROM snapshot s, med)"""

_SCALED_SQL = f"""{_MATRIX_SQL},
  moments AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _F)} FROM matrix),
  scaled AS (SELECT asin, price, {", ".join(f"({c} - m_{c}) / s_{c} AS {c}" for c in _F)} FROM matrix, moments)"""


def matrix(t):
    wide, columns = S.cluster_features(keep(t.snapshot.select("asin", *_BASE, *_LOG)))
    return wide.select("asin", "price", *columns)


def scaled(t):
    return S.standardize(matrix(t), _F)


@query("cluster_features", f"WITH {_MATRIX_SQL} SELECT asin, {', '.join(f'round({c}, 8) AS {c}' for c in _F)} FROM matrix")
def cluster_features(t):
    return rounded(matrix(t).drop("price"), 8, *_F)


@query("standardize", f"WITH {_SCALED_SQL} SELECT asin, {', '.join(f'round({c}, 7) AS {c}' for c in _F)} FROM scaled")
def standardize(t):
    return rounded(scaled(t).drop("price"), 7, *_F)


# Start centres in standardised units: cheap, middle and dear products.
_START = [[-1.0, 0.0, 0.0, 0.0, 0.0, 0.0], [0.0, 0.0, 0.0, 0.0, 0.0, 0.0], [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]]
_STEPS = 3


def _lloyd_sql() -> str:
    first = " UNION ALL ".join(
        f"SELECT {i} AS c, " + ", ".join(f"CAST({v} AS DOUBLE) AS {name}" for v, name in zip(center, _F))
        for i, center in enumerate(_START)
    )
    parts = [f"c0 AS ({first})"]
    gap = " + ".join(f"(s.{c} - k.{c}) * (s.{c} - k.{c})" for c in _F)
    for step in range(_STEPS + 1):
        parts.append(
            f"a{step} AS (SELECT asin, price, {', '.join(_F)}, c AS cluster FROM (SELECT s.*, k.c, row_number() OVER "
            f"(PARTITION BY s.asin ORDER BY {gap}, k.c) AS rn FROM scaled s, c{step} k) WHERE rn = 1)"
        )
        if step < _STEPS:
            means = ", ".join(f"avg({c}) AS {c}" for c in _F)
            parts.append(f"c{step + 1} AS (SELECT cluster AS c, {means} FROM a{step} GROUP BY cluster)")
    return ", ".join(parts)


@query(
    "kmeans_lloyd",
    f"WITH {_SCALED_SQL}, {_lloyd_sql()} SELECT cluster, count(*) AS n, "
    + ", ".join(f"round(avg({c}), 5) AS {c}" for c in _F)
    + f" FROM a{_STEPS} GROUP BY cluster",
)
def kmeans_lloyd(t):
    assigned, _ = S.lloyd(keep(scaled(t)), _F, _START, _STEPS)
    profile = assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in _F])
    return rounded(profile, 5, *_F)


# by rating
_TWO_STARTS = [[[0.0, v, 0.0, 0.0, 0.0, 0.0] for v in values] for values in ((-1.0, 0.0, 1.0), (0.9, -0.6))]


def _two_models_sql() -> str:
    gap = " + ".join(f"(s.{c} - k.{c}) * (s.{c} - k.{c})" for c in _F)
    parts = []
    for m, start in enumerate(_TWO_STARTS):
        rows = [f"SELECT {i} AS c, " + ", ".join(f"CAST({v} AS DOUBLE) AS {f}" for v, f in zip(center, _F)) for i, center in enumerate(start)]
        parts.append(f"m{m}c0 AS ({' UNION ALL '.join(rows)})")
        for step in range(2):
            near = f"SELECT s.*, k.c, row_number() OVER (PARTITION BY s.asin ORDER BY {gap}, k.c) AS rn FROM scaled s, m{m}c{step} k"
            parts.append(f"m{m}c{step + 1} AS (SELECT c, {', '.join(f'avg({f}) AS {f}' for f in _F)} FROM ({near}) WHERE rn = 1 GROUP BY c)")
        parts.append(
            f"m{m}n AS (SELECT c, count(*) AS n, sum(gap) AS squares FROM (SELECT c, gap, row_number() OVER (PARTITION BY asin ORDER BY gap, c) AS rn "
            f"FROM (SELECT s.asin, k.c, {gap} AS gap FROM scaled s, m{m}c2 k)) WHERE rn = 1 GROUP BY c)"
        )
    return ", ".join(parts)


@query(
    "kmeans_two_models",
    f"WITH {_SCALED_SQL}, {_two_models_sql()} "
    + " UNION ALL ".join(
        f"SELECT {m} AS model, k.c AS cluster, n, round(squares, 4) AS squares, {', '.join(f'round({f}, 5) AS {f}' for f in _F)} FROM m{m}c2 k JOIN m{m}n n ON k.c = n.c"
        for m in range(len(_TWO_STARTS))
    ),
)
def kmeans_two_models(t):
    """Two steps of two models that share their scans: centres, and the rows nearest to them."""
    points = K.points_of(S.assemble(keep(scaled(t)), _F), id_col="asin")
    fits = K.lloyd_many(keep(points), [np.array(start) for start in _TWO_STARTS], max_steps=2)
    rows = [
        (m, c, int(fit.rows[c]), float(fit.squares[c]), *map(float, center)) for m, fit in enumerate(fits) for c, center in enumerate(fit.centers)
    ]
    found = t.spark.createDataFrame(rows, "model int, cluster int, n long, squares double, " + ", ".join(f"{f} double" for f in _F))
    return rounded(rounded(found, 4, "squares"), 5, *_F)


_BAND_OF = f"CASE WHEN price <= {BOUNDS[0]} THEN 'economy' WHEN price <= {BOUNDS[1]} THEN 'mid' ELSE 'premium' END"


@query(
    "crosstab_clusters",
    f"WITH {_SCALED_SQL}, {_lloyd_sql()} SELECT {_BAND_OF} AS segment, "
    + ", ".join(f'count(*) FILTER (WHERE cluster = {i}) AS "{i}"' for i in range(3))
    + f" FROM a{_STEPS} GROUP BY 1",
)
def crosstab_clusters(t):
    """Price band against k-means cluster."""
    assigned, _ = S.lloyd(keep(scaled(t)), _F, _START, _STEPS)
    return R.crosstab(assigned.withColumn("segment", price_band(F.col("price"), BOUNDS)), "segment", "cluster", [0, 1, 2])


@query(
    "silhouette_exact",
    """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
      d AS (SELECT a.vec_id, a.label AS own, b.label AS other, list_distance(a.x, b.x) AS dist, a.vec_id = b.vec_id AS self
        FROM e a, e b),
      g AS (SELECT vec_id, own, other, sum(dist) AS total, count(*) AS n FROM d WHERE NOT self GROUP BY ALL),
      s AS (SELECT vec_id, max(total / n) FILTER (WHERE own = other) AS a, min(total / n) FILTER (WHERE own <> other) AS b
        FROM g GROUP BY vec_id)
      SELECT vec_id, 'label' AS labels, round(coalesce((b - a) / greatest(a, b), 0), 6) AS silhouette FROM s""",
)
def silhouette_exact(t):
    points = t.embeddings.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("features"))
    return rounded(S.silhouette_rows(points, "vec_id", ["label"]), 6, "silhouette")


@query(
    "silhouette_squared",
    """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
      g AS (SELECT a.vec_id, a.label AS own, b.label AS other, sum(pow(list_distance(a.x, b.x), 2)) AS total, count(*) AS n
        FROM e a, e b WHERE a.vec_id <> b.vec_id GROUP BY ALL),
      s AS (SELECT vec_id, max(total / n) FILTER (WHERE own = other) AS a, min(total / n) FILTER (WHERE own <> other) AS b
        FROM g GROUP BY vec_id)
      SELECT 'label' AS labels, round(avg(coalesce((b - a) / greatest(a, b), 0)), 6) AS silhouette FROM s""",
)
def silhouette_squared(t):
    points = t.embeddings.select("vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    return rounded(S.silhouette(points, "vec_id", ["label"], metric="squared"), 6, "silhouette")


@query(
    "best_k",
    """SELECT k FROM (SELECT p_size AS k, round(avg(p_retailprice), 4) AS silhouette FROM part GROUP BY p_size)
      ORDER BY silhouette DESC, k LIMIT 1""",
)
def best_k(t):
    sweep = t.part.groupBy(F.col("p_size").alias("k")).agg(F.round(F.avg("p_retailprice"), 4).alias("silhouette"))
    return S.best_k(sweep)


@query(
    "relabel_clusters",
    """WITH e AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS price FROM embeddings),
      r AS (SELECT label, row_number() OVER (ORDER BY avg(price), label) AS cluster_rank FROM e GROUP BY label)
      SELECT vec_id, e.label, CAST(cluster_rank AS INTEGER) AS cluster_rank, 'Cluster ' || cluster_rank AS segment
      FROM e JOIN r ON e.label = r.label""",
)
def relabel_clusters(t):
    rows = t.embeddings.select("vec_id", "label", F.get("embedding", F.lit(0)).cast("double").alias("price"))
    return S.relabel_clusters(rows, "label", "price", start=1).drop("price")


@query(
    "inertia",
    """WITH e AS (SELECT label, vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
      m AS (SELECT label, i, avg(CAST(v AS DOUBLE)) AS m FROM e GROUP BY label, i)
      SELECT round(sum((v - m) * (v - m)), 6) AS inertia FROM e JOIN m ON e.label = m.label AND e.i = m.i""",
)
def inertia(t):
    names = [f"x{i}" for i in range(64)]
    wide = t.embeddings.select("label", *[F.get("embedding", F.lit(i)).cast("double").alias(n) for i, n in enumerate(names)])
    return rounded(S.inertia(wide, names, "label"), 6, "inertia")


_PLANTED = "SELECT p_partkey, p_partkey % 3 AS g, (p_partkey % 3) * 1e4 + p_size AS price, (2 - p_partkey % 3) * 5e3 + p_size % 7 AS x FROM part"


def planted(t):
    """Three groups of products far apart, so that one grouping is the best."""
    group = F.col("p_partkey") % 3
    return t.part.select(
        "p_partkey", (group * 1e4 + F.col("p_size")).alias("price"), ((2 - group) * 5e3 + F.col("p_size") % 7).alias("x")
    )


@query(
    "kmeans_planted",
    f"SELECT p_partkey, CAST(g AS INTEGER) AS cluster_rank, 'Cluster ' || g AS segment FROM ({_PLANTED})",
)
def kmeans_planted(t):
    rows, _ = segment_products(planted(t), "p_partkey", k=3, base=["price", "x"], log=[], restarts=3)
    return rows.select("p_partkey", "cluster_rank", "segment")


@query(
    "k_sweep_planted",
    f"""WITH p AS ({_PLANTED}), m AS (SELECT g, avg(price) AS a, avg(x) AS b FROM p GROUP BY g)
      SELECT 3 AS k, round(sum((price - a) * (price - a) + (x - b) * (x - b)), 3) AS inertia FROM p JOIN m ON p.g = m.g""",
)
def k_sweep_planted(t):
    """The best of several k and its inertia."""
    sweep = S.k_sweep(S.assemble(planted(t), ["price", "x"]), [2, 3, 4], "p_partkey", restarts=3)
    best = sweep.join(S.best_k(sweep), "k")
    return rounded(best.select("k", "inertia"), 3, "inertia")


@query("kmeans_segments")
def kmeans_segments(t):
    """Products of the latest snapshot in three k-means segments, ordered by price."""
    names = {0: "economy (k-means)", 1: "mid (k-means)", 2: "premium (k-means)"}
    rows, _ = segment_products(t.snapshot, k=3, names=names)
    return rows.select("asin", "price", "cluster_rank", "segment")


@query("k_sweep")
def k_sweep(t):
    """Inertia and silhouette for each k over the whole latest snapshot."""
    wide = keep(S.assemble(scaled(t), _F))
    return S.k_sweep(wide, S.k_range(wide), "asin")


# --- prediction ------------------------------------------------------------------------------

_HASH_SQL = "md5(concat(CAST(l_partkey AS VARCHAR), '#42'))"


@query(
    "group_split_by_md5",
    f"""WITH k AS (SELECT l_partkey, row_number() OVER (ORDER BY {_HASH_SQL}, CAST(l_partkey AS VARCHAR)) AS r,
        count(*) OVER () AS g FROM (SELECT DISTINCT l_partkey FROM lineitem))
      SELECT l.l_partkey, l_linenumber, CASE WHEN r <= ceil(g * 0.2) THEN 'test' ELSE 'train' END AS side,
        count(*) AS n FROM lineitem l JOIN k ON l.l_partkey = k.l_partkey GROUP BY ALL""",
)
def group_split_by_md5(t):
    both = M.split_sides(t.lineitem.select("l_partkey", "l_linenumber"), "l_partkey", digest="md5")
    return both.groupBy("l_partkey", "l_linenumber", "side").agg(F.count(F.lit(1)).alias("n"))


_M = ["product_price", "discount", "discount_pct", "product_star_rating", "premium_badge_count"]


@query(
    "impute_standardize",
    f"""WITH {PRODUCTS_SQL}, {enriched_sql('0')}, m AS (SELECT {", ".join(f"avg({c}) AS {c}" for c in _M)} FROM enriched),
      f AS (SELECT asin, {", ".join(f"coalesce(e.{c}, m.{c}) AS {c}" for c in _M)} FROM enriched e, m),
      s AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _M)} FROM f)
      SELECT asin, {", ".join(f"round(({c} - m_{c}) / s_{c}, 7) AS {c}" for c in _M)} FROM f, s""",
)
def impute_standardize(t):
    from ..operators.columns import enrich

    rows = enrich(t.products, keys=STAR_KEYS).select("asin", *_M)
    rows = M.impute_standardize(rows, M.fit_scaling(rows, _M))
    return rounded(rows, 7, *_M)


@query(
    "ols_simple",
    """SELECT round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
      round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
      round(regr_r2(l_extendedprice, l_quantity), 8) AS r2 FROM lineitem""",
)
def ols_simple(t):
    fit = rounded(M.ols_simple(t.lineitem, "l_quantity", "l_extendedprice"), 6, "slope")
    return rounded(rounded(fit, 4, "intercept"), 8, "r2")


@query(
    "regression_metrics",
    """WITH p AS (SELECT l_extendedprice AS y, l_quantity * 1500 AS q FROM lineitem), m AS (SELECT avg(y) AS ybar FROM p)
      SELECT round(avg(abs(y - q)), 4) AS mae, round(sqrt(avg((y - q) * (y - q))), 4) AS rmse,
        round(1 - sum((y - q) * (y - q)) / sum((y - ybar) * (y - ybar)), 8) AS r2 FROM p, m""",
)
def regression_metrics(t):
    rows = t.lineitem.select(F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500).alias("prediction"))
    return rounded(rounded(M.regression_metrics(rows, "y"), 4, "mae", "rmse"), 8, "r2")


@query(
    "linear_fit",
    """WITH m AS (SELECT covar_pop(l_extendedprice, l_quantity) AS c1, covar_pop(l_extendedprice, l_discount) AS c2,
        var_pop(l_quantity) AS v1, var_pop(l_discount) AS v2, covar_pop(l_quantity, l_discount) AS c12,
        avg(l_extendedprice) AS my, avg(l_quantity) AS m1, avg(l_discount) AS m2 FROM lineitem),
      b AS (SELECT (c1 * v2 - c2 * c12) / (v1 * v2 - c12 * c12) AS b1, (c2 * v1 - c1 * c12) / (v1 * v2 - c12 * c12) AS b2, * FROM m)
      SELECT round(b1, 4) AS b_quantity, round(b2, 3) AS b_discount, round(my - b1 * m1 - b2 * m2, 3) AS intercept FROM b""",
)
def linear_fit(t):
    """Least squares on two features; the coefficients come back as one row."""
    rows = S.assemble(t.lineitem.select("l_quantity", "l_discount", "l_extendedprice"), ["l_quantity", "l_discount"])
    model = M.fit_linear(rows, "l_extendedprice")
    b1, b2 = map(float, model.coefficients)
    fit = t.spark.createDataFrame([(b1, b2, float(model.intercept))], "b_quantity double, b_discount double, intercept double")
    return rounded(rounded(fit, 4, "b_quantity"), 3, "b_discount", "intercept")


_COLLINEAR = ["l_quantity", "l_discount", "twice", "same"]


@query(
    "linear_collinear",
    """WITH m AS (SELECT covar_pop(l_extendedprice, l_quantity) AS c1, covar_pop(l_extendedprice, l_discount) AS c2,
        var_pop(l_quantity) AS v1, var_pop(l_discount) AS v2, covar_pop(l_quantity, l_discount) AS c12,
        avg(l_extendedprice) AS my, avg(l_quantity) AS m1, avg(l_discount) AS m2 FROM lineitem),
      b AS (SELECT (c1 * v2 - c2 * c12) / (v1 * v2 - c12 * c12) AS b1, (c2 * v1 - c1 * c12) / (v1 * v2 - c12 * c12) AS b2, * FROM m),
      p AS (SELECT l_extendedprice AS y, my + b1 * (l_quantity - m1) + b2 * (l_discount - m2) AS q FROM lineitem, b)
      SELECT 2 AS dropped, round(avg(abs(y - q)), 3) AS mae, round(sqrt(avg((y - q) * (y - q))), 3) AS rmse,
        round(1 - avg((y - q) * (y - q)) / var_pop(y), 6) AS r2 FROM p""",
)
def linear_collinear(t):
    """Four features of which two follow from the others: two are dropped and the fit is that of the rest."""
    rows = t.lineitem.select("l_quantity", "l_discount", (2 * F.col("l_quantity") + 5).alias("twice"), F.lit(3.0).alias("same"), "l_extendedprice")
    rows = S.assemble(rows, _COLLINEAR)
    model = M.fit_linear(rows, "l_extendedprice")
    fit = M.regression_metrics(model.transform(rows), "l_extendedprice").withColumn("dropped", F.lit(len(model.dropped)))
    return rounded(rounded(fit, 3, "mae", "rmse"), 6, "r2")


_METRICS_SQL = """round(avg(abs(y - q)), 4) AS mae, round(sqrt(avg((y - q) * (y - q))), 4) AS rmse,
  round(1 - avg((y - q) * (y - q)) / var_pop(y), 4) AS r2"""


@query(
    "comparison_table",
    f"""SELECT 'by quantity' AS model, {_METRICS_SQL} FROM (SELECT l_extendedprice AS y, l_quantity * 1500 AS q FROM lineitem)
      UNION ALL SELECT 'flat', {_METRICS_SQL} FROM (SELECT l_extendedprice AS y, 38000e0 AS q FROM lineitem)""",
)
def comparison_table(t):
    y = F.col("l_extendedprice").alias("y")
    by_quantity = t.lineitem.select(y, (F.col("l_quantity") * 1500).alias("prediction"))
    flat = t.lineitem.select(y, F.lit(38000.0).alias("prediction"))
    return M.model_comparison({"by quantity": by_quantity, "flat": flat}, "y")


def _sales(t):
    rows = build_enriched(t.history.select("asin", "date", "price"), t.products, keys=STAR_KEYS)
    return predict_sales(keep(rows.select("asin", MODEL_TARGET, *MODEL_FEATURES)))


@query("model_comparison")
def model_comparison(t):
    """Both sales models, fitted and scored on the enriched price history."""
    return _sales(t).comparison


@query("feature_importance")
def feature_importance(t):
    return _sales(t).importance


_FLAGS_SQL = "CAST(l_returnflag = 'R' AS DOUBLE) AS returned, CAST(l_linestatus = 'O' AS DOUBLE) AS open"


def _flagged(t):
    flag = lambda c, v: (F.col(c) == v).cast("double")
    return t.lineitem.select(
        flag("l_returnflag", "R").alias("returned"), flag("l_linestatus", "O").alias("open"),
        (F.col("l_quantity") + 100 * flag("l_linestatus", "O") + 30 * flag("l_returnflag", "R")).alias("y"), F.lit(1.0).alias("same"),
    )


@query(
    "forest_group_means",
    f"""SELECT returned, open, round(avg(l_quantity + 100 * open + 30 * returned), 6) AS prediction
      FROM (SELECT l_quantity, {_FLAGS_SQL} FROM lineitem) GROUP BY ALL""",
)
def forest_group_means(t):
    """One tree without bootstrap on two flags predicts the mean of each group."""
    rows = S.assemble(_flagged(t), ["returned", "open"])
    model = M.fit_forest(rows, "y", trees=1, bootstrap=False)
    found = model.transform(rows).groupBy("returned", "open").agg(F.max("prediction").alias("prediction"))
    return rounded(found, 6, "prediction")


@query("forest_importance", "SELECT 'open' AS feature, 1e0 AS importance UNION ALL SELECT 'same', 0e0")
def forest_importance(t):
    """A feature that is the same in all rows has no importance; the other has all of it."""
    rows = S.assemble(_flagged(t), ["open", "same"])
    return M.feature_importance(M.fit_forest(rows, "y", trees=5), ["open", "same"], rows)


_CUTS = [[10.0, 20.0, 30.0, 40.0], [0.02, 0.04, 0.06, 0.08], [0.01, 0.03, 0.05]]
_TREE_FEATURES = ["l_quantity", "l_discount", "l_tax"]


def _tree_sql() -> str:
    """CTEs of a tree of depth 2 over ``_CUTS``: ``b0`` is the root's split, ``b1`` its children's."""
    cuts = ", ".join(f"({j}, CAST({e} AS DOUBLE))" for j, edges in enumerate(_CUTS) for e in edges)
    of = lambda f: "CASE " + f + " " + " ".join(f"WHEN {j} THEN {c}" for j, c in enumerate(_TREE_FEATURES)) + " END"
    best = (
        "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, e) AS place FROM (SELECT *, "
        "sl * sl / nl + (s - sl) * (s - sl) / (n - nl) - s * s / n AS gain FROM (SELECT node, f, e, count(*) AS n, sum(y) AS s, "
        "count(*) FILTER (WHERE v <= e) AS nl, sum(y) FILTER (WHERE v <= e) AS sl FROM (SELECT r.node, y, k.f, k.e, {v} AS v FROM {r} r, cuts k) "
        "GROUP BY ALL) WHERE nl >= 5 AND n - nl >= 5)) WHERE place = 1"
    )
    down = "r.node * 2 + 1 + CAST({v} > b.e AS INTEGER)"
    return f"""cuts(f, e) AS (VALUES {cuts}),
      r0 AS (SELECT 0 AS node, {', '.join(_TREE_FEATURES)}, l_extendedprice - (SELECT avg(l_extendedprice) FROM lineitem) AS y, l_extendedprice AS target FROM lineitem),
      b0 AS ({best.format(v=of('k.f'), r='r0')}),
      r1 AS (SELECT r.* REPLACE ({down.format(v=of('b.f'))} AS node) FROM r0 r, b0 b),
      b1 AS ({best.format(v=of('k.f'), r='r1')}),
      r2 AS (SELECT r.* REPLACE ({down.format(v=of('b.f'))} AS node) FROM r1 r JOIN b1 b ON r.node = b.node)"""


def _small_tree(t):
    rows = S.assemble(t.lineitem.select(*_TREE_FEATURES, "l_extendedprice"), _TREE_FEATURES)
    return T.fit(rows, "l_extendedprice", trees=1, depth=2, bootstrap=False, edges=_CUTS)


@query(
    "forest_depth_two",
    f"""WITH {_tree_sql()}, every AS (SELECT node, target FROM r0 UNION ALL SELECT node, target FROM r1 UNION ALL SELECT node, target FROM r2)
      SELECT e.node, coalesce(b.f, -1) AS feature, coalesce(b.e, -1) AS cut, count(*) AS n, round(avg(target), 4) AS value, round(coalesce(any_value(b.gain), 0) / 1e6, 2) AS gain
      FROM every e LEFT JOIN (FROM b0 UNION ALL FROM b1) b ON e.node = b.node GROUP BY ALL""",
)
def forest_depth_two(t):
    """Splits, counts and means of one tree of depth 2."""
    forest = _small_tree(t)
    rows = [
        (i, int(forest.feature[0, i]), float(forest.cut[0, i]), int(forest.rows[0, i]), float(forest.value[0, i]), float(forest.gain[0, i]) / 1e6)
        for i in range(7)
        if forest.rows[0, i]
    ]
    found = t.spark.createDataFrame(rows, "node int, feature int, cut double, n long, value double, gain double")
    return rounded(rounded(found, 4, "value"), 2, "gain")


@query(
    "forest_gain_shares",
    f"""WITH {_tree_sql()}, g AS (SELECT f, gain FROM b0 UNION ALL SELECT f, gain FROM b1)
      SELECT n.feature, round(coalesce(sum(gain), 0) / (SELECT sum(gain) FROM g), 8) AS importance
      FROM (VALUES {', '.join(f"({j}, '{c}')" for j, c in enumerate(_TREE_FEATURES))}) n(f, feature) LEFT JOIN g ON g.f = n.f GROUP BY n.feature""",
)
def forest_gain_shares(t):
    """Importance is the share of the gains of a feature's splits."""
    return rounded(M.feature_importance(_small_tree(t), _TREE_FEATURES, t.lineitem), 8, "importance")
