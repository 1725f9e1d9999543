"""Feature importance and selection by tree ensembles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import models, tables
from .encode import keep_features

SELECTION_FACTOR = 0.05


def _session() -> SparkSession:
    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


def feature_importance(fitted: models.Fitted, names: Sequence[str]) -> DataFrame:
    """Mean decrease in impurity per feature, summing to 1. One row per feature."""
    core = fitted.core
    if fitted.name == models.FOREST:
        values = core.featureImportances.toArray()
    elif fitted.name == models.BOOSTING:
        total = sum(m.featureImportances.toArray() for m in core.models)
        values = total / (total.sum() or 1.0)
    else:
        raise ValueError(f"{fitted.name} has no impurity importances; they need a tree ensemble")
    rows = [(n, float(v)) for n, v in zip(names, values, strict=True)]
    return _session().createDataFrame(rows, "feature string, importance double")


@dataclass(frozen=True)
class Selection:
    names: list[str]
    kept: list[str]
    table: DataFrame

    def apply(self, df: DataFrame, out: str = "features") -> DataFrame:
        """The same mask on any table: the feature vector cut to the kept slots."""
        cut = keep_features(df, self.names, self.kept, out="__kept")
        return cut.drop(out).withColumnRenamed("__kept", out)


def select_features(
    train: DataFrame,
    names: Sequence[str],
    label: str = "label",
    factor: float = SELECTION_FACTOR,
    params: Mapping[str, Any] | None = None,
    seed: int = 42,
) -> Selection:
    """Keep the features a quick forest finds at least ``factor`` times as important as the mean."""
    forest = models.fit(train, models.FOREST, {"n_estimators": 100, "max_depth": 10, **(params or {})}, label, seed=seed)
    table = tables.importance_filter(feature_importance(forest, names), factor)
    chosen = {r["feature"] for r in table.where("kept = 1").select("feature").collect()}
    return Selection(list(names), [n for n in names if n in chosen], table)
