"""Latest products to price segments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from ..operators import segments as S
from ..schemas import CLUSTER_BASE, CLUSTER_LOG
from ..session import keep


def segment_products(
    latest: DataFrame,
    id_col: str = "asin",
    price: str = "price",
    k: int | None = None,
    ks: Sequence[int] | None = None,
    base: Sequence[str] = CLUSTER_BASE,
    log: Sequence[str] = CLUSTER_LOG,
    restarts: int = S.RESTARTS,
    metric: str = "squared",
    start: int = 0,
    names: Mapping[int, str] | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """``(products with cluster, cluster_rank and segment, sweep)``.

    With ``k`` given no sweep is run; otherwise the k with the best silhouette is taken, and its model
    from the sweep. ``metric="euclidean"`` chooses by the exact Euclidean silhouette, whose cost grows
    with the square of the row count.
    """
    wide, columns = S.cluster_features(keep(latest), base, log)
    ready = keep(S.assemble(S.standardize(wide, columns), columns))
    sweep = None
    if k is None:
        sweep, models = S.sweep_fits(ready, ks or S.k_range(ready), id_col, restarts, metric=metric)
        model = models[S.best_k(sweep).first()["k"]]
    else:
        model = S.kmeans_fit(ready, k, restarts, id_col=id_col)
    labelled = model.transform(ready).drop(S.FEATURES, *columns)
    return S.relabel_clusters(labelled, "cluster", price, start, names), sweep
