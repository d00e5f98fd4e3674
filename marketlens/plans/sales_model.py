"""Enriched rows to sales predictions, model comparison and feature importance."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import predict as M
from ..operators.quality import drop_nulls
from ..schemas import MODEL_FEATURES, MODEL_TARGET
from ..session import keep, spread


class SalesModel(NamedTuple):
    comparison: DataFrame
    importance: DataFrame
    linear: DataFrame
    forest: DataFrame


def predict_sales(
    enriched: DataFrame,
    key: str = "asin",
    target: str = MODEL_TARGET,
    features: Sequence[str] = MODEL_FEATURES,
    trees: int = 100,
) -> SalesModel:
    """Split by product, fit both models on the training rows, compare on the test rows.

    Rows that are equal in target and features, as those of one product are, are fitted and scored once, with their
    number as weight; ``linear`` and ``forest`` hold a prediction for each test row.
    ``enriched`` is read several times: pass a written stage, or keep it first.
    """
    rows = drop_nulls(enriched.select(key, target, *features), [target])
    train, test = M.group_split(rows, key)
    scaling = M.fit_scaling(train, features)
    used = list(scaling)
    weight = "_rows_alike"

    def alike(side: DataFrame) -> DataFrame:
        grouped = side.groupBy(target, *features).agg(F.count(F.lit(1)).alias(weight))
        return keep(spread(M.prepare(grouped, scaling).select(target, "features", weight)))

    ready_train, ready_test = alike(train), alike(test)
    linear = M.fit_linear(ready_train, target, weight=weight)
    forest = M.fit_forest(ready_train, target, trees=trees, weight=weight)
    every_test = M.prepare(test, scaling).select(key, target, "features")
    by_linear, by_forest = linear.transform(every_test), forest.transform(every_test)
    compared = {"linear regression": linear.transform(ready_test), "random forest": forest.transform(ready_test)}
    return SalesModel(
        M.model_comparison(compared, target, weight=weight),
        M.feature_importance(forest, used, enriched),
        by_linear,
        by_forest,
    )
