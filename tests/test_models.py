import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from marketlens import schemas
from marketlens.operators import forest as T
from marketlens.operators import kmeans as K
from marketlens.operators import predict as M
from marketlens.operators import segments as S
from marketlens.plans.sales_model import predict_sales
from marketlens.plans.segmentation import segment_products


def blobs(n=60, seed=1):
    rng = np.random.default_rng(seed)
    centers = np.array([[0, 0], [6, 0], [0, 8]])
    labels = np.arange(n) % 3
    return centers[labels] + rng.normal(0, 0.7, (n, 2)), labels


def brute_silhouette(x, y):
    out = []
    for i in range(len(x)):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        own = (y == y[i]).sum()
        if own == 1:
            out.append(0.0)
            continue
        a = d[y == y[i]].sum() / (own - 1)
        b = min(d[y == c].mean() for c in np.unique(y) if c != y[i])
        out.append((b - a) / max(a, b))
    return np.array(out)


@pytest.mark.parametrize("tile_rows", [2, 7, 1000])
def test_silhouette_of_several_labellings(spark, tile_rows):
    x, y = blobs()
    other = (np.arange(len(x)) % 4 == 0).astype(int)
    lonely = np.where(np.arange(len(x)) == 5, 9, y)
    df = spark.createDataFrame(
        [(i, x[i].tolist(), int(y[i]), int(other[i]), int(lonely[i])) for i in range(len(x))],
        "id int, features array<double>, y int, other int, lonely int",
    )
    got = {(r.labels, r.id): r.silhouette for r in S.silhouette_rows(df, "id", ["y", "other", "lonely"], tile_rows=tile_rows).collect()}
    for name, labels in (("y", y), ("other", other), ("lonely", lonely)):
        want = brute_silhouette(x, labels)
        assert [got[(name, i)] for i in range(len(x))] == pytest.approx(want.tolist())


def test_silhouette_rows_can_be_counted(spark):
    x, y = blobs()
    df = spark.createDataFrame([(i, x[i].tolist(), int(y[i])) for i in range(len(x))], "id int, features array<double>, y int")
    assert S.silhouette_rows(df, "id", ["y"]).count() == len(x)


def test_silhouette_metrics(spark):
    x, y = blobs()
    df = spark.createDataFrame([(i, Vectors.dense(x[i]), int(y[i])) for i in range(len(x))], ["id", "features", "y"])
    euclid = S.silhouette(df, "id", ["y"]).first().silhouette
    assert euclid == pytest.approx(brute_silhouette(x, y).mean())
    assert S.silhouette(df, "id", ["y"], metric="squared").first().silhouette > euclid
    with pytest.raises(ValueError):
        S.silhouette(df, "id", ["y"], metric="cosine")


def test_sweep_and_choice_of_k(spark):
    x, _ = blobs()
    df = spark.createDataFrame([(i, Vectors.dense(x[i])) for i in range(len(x))], ["id", "features"])
    sweep = S.k_sweep(df, [2, 3, 4], "id", restarts=3)
    rows = sweep.orderBy("k").collect()
    assert [r.k for r in rows] == [2, 3, 4]
    assert rows[0].inertia > rows[1].inertia > rows[2].inertia
    assert S.best_k(sweep).first().k == 3
    ties = spark.createDataFrame([(2, 0.5), (3, 0.5), (4, 0.1)], "k int, silhouette double")
    assert S.best_k(ties).first().k == 2
    assert S.k_range(df.limit(4)) == [2, 3] and S.k_range(df) == [2, 3, 4, 5, 6, 7]


def numpy_lloyd(x, centers, steps):
    centers = np.array(centers, float)
    for _ in range(steps):
        near = ((x[:, None] - centers[None]) ** 2).sum(2).argmin(1)
        for c in range(len(centers)):
            if (near == c).any():
                centers[c] = x[near == c].mean(0)
    return ((x[:, None] - centers[None]) ** 2).sum(2).argmin(1), centers


def test_lloyd_agrees_with_numpy(spark):
    x, _ = blobs()
    start = [[0.0, 1.0], [1.0, 1.0], [1.0, 2.0], [99.0, 99.0]]  # the last one stays empty
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id int, a double, b double")
    rows, centers = S.lloyd(df, ["a", "b"], start, 3)
    want, want_centers = numpy_lloyd(x, start, 3)
    assert [r.cluster for r in rows.orderBy("id").collect()] == want.tolist()
    assert np.allclose(centers, want_centers)
    sse = ((x - np.array([x[want == c].mean(0) if (want == c).any() else [0, 0] for c in range(4)])[want]) ** 2).sum()
    assert S.inertia(rows, ["a", "b"]).first().inertia == pytest.approx(sse)


def test_many_models_share_scans_and_agree_with_numpy(spark, monkeypatch):
    x, _ = blobs(400, seed=4)
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(len(x))], "id int, features array<double>").repartition(5)
    points = K.points_of(df, "features", "id").cache()
    starts = [x[:2], x[10:13], np.vstack([x[20:23], [[99.0, 99.0]]]), x[:1]]  # the last centre of the third stays empty
    scans = []
    whole = K.assigned_sums
    monkeypatch.setattr(K, "assigned_sums", lambda *a: scans.append(len(a[1])) or whole(*a))
    for tasks in (5, K.PARTIAL_ROWS):  # summed on the driver, and by Spark
        fits = K.lloyd_many(points, starts, tasks=tasks)
        for start, fit in zip(starts, fits):
            near, centers = numpy_lloyd(x, start, 300)
            assert np.allclose(fit.centers, centers) and fit.rows.tolist() == np.bincount(near, minlength=len(start)).tolist()
            assert fit.cost == pytest.approx(((x - centers[near]) ** 2).sum())
        assert len(scans) == max(f.steps for f in fits) + 1 and scans[0] == scans[-1] == len(starts)
        scans.clear()
    two = K.lloyd_many(points, starts, max_steps=2)
    for start, fit in zip(starts, two):
        assert np.allclose(fit.centers, numpy_lloyd(x, start, 2)[1])


def test_starts_do_not_depend_on_the_partitions(spark):
    x, _ = blobs(300, seed=9)
    rows = [(i, x[i].tolist()) for i in range(len(x))]
    frames = [spark.createDataFrame(r, "id int, features array<double>").repartition(n) for r, n in ((rows, 1), (rows[::-1], 7))]
    a, b = (K.starts(K.points_of(f, "features", "id"), [3, 3, 5], [1, 2, 1]) for f in frames)
    assert [c.shape for c in a] == [(3, 2), (3, 2), (5, 2)]
    assert all(np.allclose(p, q) for p, q in zip(a, b)) and not np.allclose(a[0], a[1])
    few = spark.createDataFrame([(1, [0.0]), (2, [0.0]), (3, [1.0])], "id int, features array<double>")
    fit = K.fit_many(few, [3], 2, 42)[3]
    assert fit.cost == 0 and fit.rows.sum() == 3
    with pytest.raises(ValueError):
        K.fit_many(few.limit(0), [2], 1, 42)


def test_shared_silhouette_equals_the_evaluator(spark):
    x, _ = blobs(200, seed=3)
    x = x + 1e5
    df = spark.createDataFrame([(i, Vectors.dense(x[i])) for i in range(len(x))], ["id", "features"])
    fits = K.fit_many(df, [2, 3, 6], 2, 42, id_col="id")
    got = K.squared_silhouettes(K.points_of(df, "features", "id"), fits)
    for k, fit in fits.items():
        labelled = fit.transform(df)
        assert np.bincount([r.cluster for r in labelled.collect()], minlength=k).tolist() == fit.rows.tolist()
        assert got[k] == pytest.approx(S.silhouette(labelled, "id", ["cluster"], metric="squared").first().silhouette, abs=1e-6)


def test_standardize_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert sorted(map(tuple, S.standardize(df, ["a", "b"]).collect())) == [(-1.0, 0.0), (1.0, 0.0)]


def test_cluster_features(spark):
    df = spark.createDataFrame(
        [(10.0, None, None, 5), (None, 4.0, None, None), (20.0, 5.0, None, -3)],
        "price double, product_star_rating double, discount_pct double, sales_volume_num int",
    )
    wide, names = S.cluster_features(df)
    assert names == ["f_price", "f_product_star_rating", "f_sales_volume_num_log"]  # no value at all: left out
    got = wide.orderBy("f_price").select(*names).collect()
    assert [r.f_price for r in got] == [10.0, 15.0, 20.0]
    assert [r.f_sales_volume_num_log for r in got] == pytest.approx([math.log1p(5), 0.0, 0.0])


def test_relabel_by_price(spark):
    df = spark.createDataFrame([(0, 90.0), (0, 110.0), (1, 10.0), (2, 50.0), (None, 1.0)], "c int, price double")
    got = {(r.c, r.cluster_rank, r.segment) for r in S.relabel_clusters(df, "c", "price", start=1).collect()}
    assert got == {(0, 3, "Cluster 3"), (1, 1, "Cluster 1"), (2, 2, "Cluster 2"), (None, None, None)}
    names = {0: "low", 1: "mid", 2: "high"}
    got = {(r.c, r.segment) for r in S.relabel_clusters(df.where("c is not null"), "c", "price", names=names).collect()}
    assert got == {(1, "low"), (2, "mid"), (0, "high")}


def test_segment_products(spark):
    rows = [(f"p{i}", 10.0 + i % 5 if i < 20 else 500.0 + i, 4.0 + i % 2, None if i == 3 else 5.0, 0.5, 10 * i, 1000) for i in range(40)]
    df = spark.createDataFrame(
        rows, "asin string, price double, product_star_rating double, discount_pct double, rating_balance double, "
        "product_num_ratings int, sales_volume_num int",
    )
    labelled, sweep = segment_products(df, restarts=2, ks=[2, 3], start=1)
    assert sweep.count() == 2 and labelled.count() == 40
    means = [r.m for r in labelled.groupBy("cluster_rank").agg(F.avg("price").alias("m")).orderBy("cluster_rank").collect()]
    assert means == sorted(means)


# --- prediction ------------------------------------------------------------------------------


@pytest.mark.parametrize("digest", ["xxhash64", "md5"])
@pytest.mark.parametrize("keys", [1, 10, 37, 203])
def test_group_split_keeps_products_whole(spark, digest, keys):
    df = spark.range(keys * 9).select((F.col("id") % keys).alias("k"), "id").unionAll(
        spark.range(500).select(F.lit(0).cast("bigint").alias("k"), "id")
    ).unionAll(spark.createDataFrame([(None, 1)], "k bigint, id bigint"))
    train, test = M.group_split(df, "k", digest=digest)
    a, b = ({r.k for r in side.select("k").distinct().collect()} for side in (train, test))
    assert not a & b and a | b == set(range(keys))
    assert len(b) == math.ceil(keys * 0.2 - 1e-9)
    assert train.count() + test.count() == keys * 9 + 500
    again = {r.k for r in M.group_split(df, "k", digest=digest)[1].select("k").distinct().collect()}
    assert again == b
    if keys == 203:
        other = {r.k for r in M.group_split(df, "k", seed=7, digest=digest)[1].select("k").distinct().collect()}
        assert other != b


def test_scaling_is_fitted_on_training_rows(spark):
    train = spark.createDataFrame([(1.0, None, 5.0), (3.0, None, 5.0), (None, None, 5.0)], "a double, b double, c double")
    scaling = M.fit_scaling(train, ["a", "b", "c"])
    assert scaling == {"a": (2.0, pytest.approx(np.std([1, 3, 2]))), "c": (5.0, 0.0)}
    test = spark.createDataFrame([(None, 1.0, 9.0), (4.0, 1.0, 9.0)], "a double, b double, c double")
    got = M.impute_standardize(test, scaling).collect()
    assert [(r.a, r.c) for r in got] == [(0.0, 0.0), (pytest.approx(2 / np.std([1, 3, 2])), 0.0)]


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, 3.0)], "y double, prediction double")
    got = M.regression_metrics(df, "y").first()
    y, p = np.array([1, 2, 4.0]), np.array([1.5, 2, 3])
    assert tuple(got) == pytest.approx(
        (np.abs(y - p).mean(), np.sqrt(((y - p) ** 2).mean()), 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    )
    flat = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "y double, prediction double")
    assert M.regression_metrics(flat, "y").first().r2 == 1.0


def test_sales_models(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(60):
        price = float(rng.uniform(10, 200))
        for _ in range(5):
            rows.append((f"p{i}", 1000.0 + 30 * price, price, 5.0, None if i % 7 == 0 else 10.0, 4.5, 100.0 * i, 450.0, 2.0, None))
    names = ["asin", schemas.MODEL_TARGET, *schemas.MODEL_FEATURES]
    df = spark.createDataFrame(rows, "asin string, " + ", ".join(f"{n} double" for n in names[1:]))
    result = predict_sales(df, trees=10)
    table = {r.model: r for r in result.comparison.collect()}
    assert table["linear regression"].r2 == 1.0 and table["random forest"].r2 > 0.7
    importance = result.importance.collect()
    assert sum(r.importance for r in importance) == pytest.approx(1.0)
    assert importance[0].feature == "product_price"
    assert {r.feature for r in importance} == set(schemas.MODEL_FEATURES) - {"rating_balance"}
    assert result.linear.select("asin").distinct().count() == 12


# --- forest ----------------------------------------------------------------------------------


def plain_tree(x, y, w, edges, depth, min_rows, node=0, out=None):
    """node -> (feature, cut, weight, mean) by trying every cut."""
    out = {} if out is None else out
    n, s = w.sum(), (w * y).sum()
    out[node] = (-1, -1.0, n, s / n)
    best = (1e-6, None)
    if depth:
        for j, cuts in enumerate(edges):
            for cut in cuts:
                left = x[:, j] <= cut
                a, b = w[left].sum(), w[~left].sum()
                if min(a, b) >= min_rows:
                    gain = (w * y)[left].sum() ** 2 / a + (w * y)[~left].sum() ** 2 / b - s * s / n
                    if gain > best[0] + 1e-9:
                        best = (gain, (j, cut, left))
    if best[1]:
        j, cut, left = best[1]
        out[node] = (j, cut, n, s / n)
        for child, side in ((2 * node + 1, left), (2 * node + 2, ~left)):
            plain_tree(x[side], y[side], w[side], edges, depth - 1, min_rows, child, out)
    return out


@pytest.mark.parametrize("budget", [None, 5000])
def test_trees_against_all_cuts(spark, monkeypatch, budget):
    rng = np.random.default_rng(6)
    x = np.round(rng.uniform(0, 10, (500, 3)))
    y = np.where(x[:, 0] > 4, 10, 0) + np.where(x[:, 1] > 7, 5, 0) * (x[:, 2] < 3) + np.round(rng.normal(0, 1, 500))
    x, y = np.vstack([x, x[:50]]), np.concatenate([y, y[:50]])  # repeated rows
    rows = [(x[i].tolist(), float(y[i])) for i in range(len(x))] + [(None, 1.0), ([1.0, 1.0, 1.0], None)]
    df = spark.createDataFrame(rows, "features array<double>, y double").repartition(3)
    edges = [np.arange(0.0, 10), np.arange(0.0, 10, 2), np.arange(1.0, 9)]
    if budget:
        monkeypatch.setattr(T, "TASK_BYTES", budget)
    scans = []
    whole = T._best_splits
    monkeypatch.setattr(T, "_best_splits", lambda *a: scans.append(len(a[3])) or whole(*a))
    forest = T.fit(df, "y", trees=3, depth=4, min_rows=7, bootstrap=False, edges=edges)
    assert budget or scans == [3] * 4
    want = plain_tree(x, y, np.ones(len(y)), edges, 4, 7)
    for t in range(3):
        grown = {int(i) for i in np.flatnonzero(forest.rows[t])}
        assert grown == set(want)
        for i, (j, cut, n, mean) in want.items():
            assert (forest.feature[t, i], forest.cut[t, i], forest.rows[t, i]) == (j, cut, n) and forest.value[t, i] == pytest.approx(mean)

    def leaf(row):
        i = 0
        while want[i][0] >= 0:
            i = 2 * i + 1 + (row[want[i][0]] > want[i][1])
        return want[i][3]

    got = {tuple(r.features): r.prediction for r in forest.transform(df.where("features IS NOT NULL")).collect()}
    assert all(p == pytest.approx(leaf(f)) for f, p in got.items())


def test_bootstrap_weights(spark):
    rng = np.random.default_rng(8)
    x = rng.uniform(0, 1, (4000, 2))
    rows = [(i, x[i].tolist(), float(10 * x[i, 0])) for i in range(len(x))]
    schema = "id int, features array<double>, y double"
    a, b = (T.fit(spark.createDataFrame(r, schema).repartition(n), "y", trees=20, depth=3, row_key=["id"], edges=[np.arange(0, 1, 0.1)] * 2) for r, n in ((rows, 2), (rows[::-1], 5)))
    assert (a.feature == b.feature).all() and np.allclose(a.value, b.value) and np.allclose(a.rows, b.rows)
    assert len(set(a.rows[:, 0])) > 10 and abs(a.rows[:, 0].mean() - 4000) < 4 * np.sqrt(4000 / 20)
    # copies as one group: the sum of many Poisson counts of 1
    for copies in (3, 40):
        many = spark.createDataFrame(rows[:50], schema).crossJoin(spark.range(copies).select())
        totals = T.fit(many, "y", trees=200, depth=1).rows[:, 0]
        mean, spread = 50 * copies, np.sqrt(50 * copies)
        assert abs(totals.mean() - mean) < 4 * spread / np.sqrt(200) and 0.8 * spread < totals.std() < 1.25 * spread
    with pytest.raises(ValueError):
        T.fit(spark.createDataFrame([], schema), "y")
    flat = T.fit(spark.createDataFrame([(1, [1.0, 2.0], 5.0)] * 9, schema), "y", trees=2)
    assert (flat.feature == -1).all() and flat.value[:, 0].tolist() == [5.0, 5.0] and flat.importances.sum() == 0


# --- least squares ---------------------------------------------------------------------------


def test_least_squares_with_collinear_features(spark):
    rng = np.random.default_rng(12)
    a, b = rng.normal(50, 3, 300), rng.normal(1e6, 2, 300)
    x = np.column_stack([a, b, 2 * a - b + 7, np.full(300, 4.0), rng.normal(0, 1, 300)])
    y = 3 * a - 0.5 * b + 2 * x[:, 4] + rng.normal(0, 0.1, 300)
    rows = [(x[i].tolist(), float(y[i])) for i in range(300)] + [(None, 1.0), (x[0].tolist(), None)]
    df = spark.createDataFrame(rows, "features array<double>, y double").repartition(4)
    model = M.fit_linear(df, "y")
    assert len(model.kept) == 3 and 3 in model.dropped and len(model.dropped) == 2 and model.rows == 300
    design = np.column_stack([x - x.mean(0), np.ones(300)])
    want = design @ np.linalg.lstsq(design, y, rcond=1e-9)[0]
    got = {tuple(r.features): r.prediction for r in model.transform(df.where("y IS NOT NULL")).collect() if r.features}
    assert np.allclose([got[tuple(r)] for r in x.tolist()], want, atol=1e-4)
    assert [r.prediction for r in model.transform(df).where("features IS NULL").collect()] == [None]
    flat = M.fit_linear(spark.createDataFrame([([1.0], 2.0), ([1.0], 4.0)], "features array<double>, y double"), "y")
    assert (flat.kept, flat.dropped, flat.intercept, flat.coefficients) == ([], [0], 3.0, [0.0])
    with pytest.raises(ValueError):
        M.fit_linear(df.limit(0), "y")


def test_weighted_rows_stand_for_repeated_ones(spark):
    rng = np.random.default_rng(5)
    few = [(list(map(float, x)), float(3 * x[0] - x[1] + e), n) for x, e, n in zip(rng.normal(size=(40, 2)), rng.normal(size=40), [1, 2, 7, 15, 16, 40, 3, 1] * 5)]
    schema = "features array<double>, y double, n int"
    weighted = spark.createDataFrame(few, schema)
    repeated = spark.createDataFrame([r for r in few for _ in range(r[2])], schema)
    a, b = M.fit_linear(weighted, "y", weight="n"), M.fit_linear(repeated, "y")
    assert a.rows == b.rows and a.coefficients == pytest.approx(b.coefficients) and a.intercept == pytest.approx(b.intercept)
    f, g = M.fit_forest(weighted, "y", trees=4, weight="n"), M.fit_forest(repeated, "y", trees=4)
    assert (f.feature == g.feature).all() and (f.rows == g.rows).all() and np.allclose(f.value, g.value)
    got = M.regression_metrics(f.transform(weighted), "y", weight="n").first()
    assert tuple(got) == pytest.approx(tuple(M.regression_metrics(f.transform(repeated), "y").first()))
    flat = spark.createDataFrame([(0.1, 0.1, 3), (0.1, 0.1, 7)], "y double, prediction double, n int")
    assert M.regression_metrics(flat, "y", weight="n").first().r2 == 1.0


def test_sales_model_fits_equal_rows_once(spark, monkeypatch):
    from marketlens.plans import sales_model

    seen = {}
    plain = sales_model.M.fit_linear
    monkeypatch.setattr(sales_model.M, "fit_linear", lambda df, *a, **k: seen.update(rows=df.count()) or plain(df, *a, **k))
    rows = [(str(i), float(i % 7), float(i), float(i * i % 11)) for i in range(30)] * 20
    found = sales_model.predict_sales(spark.createDataFrame(rows, "asin string, y double, a double, b double"), target="y", features=["a", "b"], trees=2)
    assert seen["rows"] <= 30 and found.linear.count() == 6 * 20 and found.comparison.count() == 2


def test_steps_without_squares_are_the_same(spark):
    rng = np.random.default_rng(6)
    points = spark.createDataFrame([(int(i), list(map(float, x))) for i, x in enumerate(rng.normal(size=(300, 3)))], "h long, x array<double>")
    centers = [rng.normal(size=(k, 3)) for k in (2, 5)]
    whole, short = (K.assigned_sums(points, centers, squared=s) for s in (True, False))
    for (n, s, q), (n2, s2, q2) in zip(whole, short):
        assert (n == n2).all() and (s == s2).all() and q.sum() > 0 and not q2.any()
