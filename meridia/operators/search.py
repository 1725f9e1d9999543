"""Candidate sampling, cross-validated search and model comparison."""

from __future__ import annotations

import itertools
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from hashlib import md5
from typing import Any

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_key
from . import forests, models, stacked
from .metrics import classification_metrics, roc_auc_macro, roc_curve
from .models import Fitted, Shape, build_estimator, describe, with_label_index


class MacroF1(Evaluator):
    """Unweighted mean F1 over classes, which Spark's own metric list lacks."""

    def __init__(self, label: str = "label_index", prediction: str = "prediction"):
        super().__init__()
        self.label, self.prediction = label, prediction

    def _evaluate(self, dataset: DataFrame) -> float:
        return classification_metrics(dataset, self.label, self.prediction).first()["f1_macro"]

    def isLargerBetter(self) -> bool:
        return True


# Searched values per model (fixed values). Parameters without a Spark counterpart are not searched.
GRID_PRESET: dict[str, dict[str, list]] = {
    models.LOGISTIC: {"C": [0.01, 0.1, 1, 10]},
    models.FOREST: {"n_estimators": [100, 200], "max_depth": [10, 20, None]},
    models.BOOSTING: {"n_estimators": [100, 200], "learning_rate": [0.05, 0.1], "max_depth": [3, 5]},
    models.LINEAR_SVM: {"C": [0.1, 1, 10]},
    models.RBF_SVM: {"C": [0.1, 1, 10], "gamma": ["scale", "auto"]},
    models.NETWORK: {"hidden_layer_sizes": [[64, 32], [128, 64]]},
}
RANDOM_PRESET: dict[str, dict[str, list]] = {
    models.LOGISTIC: {"C": [0.001, 0.005, 0.01, 0.05, 0.1, 0.5, 1, 5, 10, 50, 100]},
    models.FOREST: {
        "n_estimators": [100, 150, 200, 300, 500],
        "max_depth": [8, 10, 15, 20, 30, None],
        "min_samples_leaf": [1, 2, 4],
        "max_features": ["sqrt", "log2"],
    },
    models.BOOSTING: {
        "n_estimators": [100, 150, 200, 300, 500],
        "learning_rate": [0.01, 0.03, 0.05, 0.1, 0.2],
        "max_depth": [2, 3, 4, 5],
        "subsample": [0.7, 0.8, 0.9, 1.0],
    },
    models.LINEAR_SVM: {"C": [0.001, 0.01, 0.1, 0.5, 1, 5, 10, 50, 100]},
    models.NETWORK: {"hidden_layer_sizes": [[64, 32], [128, 64], [256, 128], [128, 64, 32], [256, 128, 64]]},
}
N_ITER = 30


def expand_grid(grid: Mapping[str, Sequence]) -> list[dict[str, Any]]:
    """Every combination, keys in name order."""
    names = sorted(grid)
    return [dict(zip(names, values)) for values in itertools.product(*(grid[n] for n in names))]


def draw(grid: Mapping[str, Sequence], n_iter: int = N_ITER, seed: int = 42) -> list[dict[str, Any]]:
    """At most ``n_iter`` combinations without replacement, in the order of their hash."""
    listed = [(json.dumps(c, sort_keys=True), c) for c in expand_grid(grid)]
    ordered = sorted(listed, key=lambda t: (md5(f"{seed}:{t[0]}".encode()).hexdigest(), t[0]))
    return [c for _, c in ordered[: min(n_iter, len(ordered))]]


def sample_candidates(grid: DataFrame, n_iter: int, seed: int = 42, params: str = "params") -> DataFrame:
    """``draw`` for a grid that is a table: ``n_iter`` candidates, or all when there are fewer."""
    order = [hash_key(seed, params), F.col(params)]
    drawn = grid.orderBy(*order).limit(n_iter)
    # at most n_iter rows are numbered
    numbered = F.row_number().over(Window.orderBy(*order)) - 1
    return drawn.withColumn("candidate", numbered.cast("int"))


@dataclass(frozen=True)
class SearchResult:
    candidates: list[dict[str, Any]]
    scores: list[float]
    spreads: list[float]
    best: Fitted

    @property
    def best_score(self) -> float:
        return max(self.scores)

    def table(self, spark) -> DataFrame:
        rows = [
            (self.best.name, i, json.dumps(c), float(m), float(s))
            for i, (c, m, s) in enumerate(zip(self.candidates, self.scores, self.spreads))
        ]
        return spark.createDataFrame(
            rows, "model string, candidate int, params string, cv_f1_macro double, cv_f1_std double"
        )


def search(
    train: DataFrame,
    name: str,
    candidates: Sequence[Mapping[str, Any]],
    label: str = "label",
    fold: str = "fold",
    seed: int = 42,
    parallelism: int = 1,
    fixed: Mapping[str, Any] | None = None,
) -> SearchResult:
    """Cross-validate every candidate on the shared folds by macro F1 and refit the best on all rows.

    A candidate is a whole estimator here, since one parameter can change what the estimator is made
    of (layers, kernel). They are tried as one parameter of a one-stage pipeline. Linear models that differ
    in C alone are fitted together instead, all candidates and folds in one loop over the rows, which refits SVMs too.

    ``parallelism`` stays 1 by default: PySpark 4.1 hands one set of job properties to all fitting
    threads, and two SQL jobs that start at the same moment can then fail.
    """
    shape = describe(train, label)
    folds = train.agg(F.count_distinct(fold)).first()[0]
    inner = shape.with_rows(1 - 1 / folds)
    fixed = dict(fixed or {})
    every = [{**fixed, **c} for c in candidates]
    if stacked.stackable(name, every):
        by_fold, of_all, _ = stacked.cross_validate(train, name, every, shape, label, fold)
        scores = [float(v) for v in by_fold.mean(axis=1)]
        place = scores.index(max(scores))
        if of_all:
            best = Fitted(name, of_all[place], shape.classes, every[place])
        else:
            best = models.fit(train, name, every[place], label, shape, seed)
        return SearchResult([dict(c) for c in candidates], scores, [float(v) for v in by_fold.std(axis=1)], best)
    if forests.shareable(name, train) and every:
        by_fold = forests.cross_validate(train, every, shape, label, fold, seed)
        scores = [float(v) for v in by_fold.mean(axis=1)]
        best = models.fit(train, name, every[scores.index(max(scores))], label, shape, seed)
        return SearchResult([dict(c) for c in candidates], scores, [float(v) for v in by_fold.std(axis=1)], best)
    estimators = [build_estimator(name, c, inner, seed) for c in every]
    indexed = with_label_index(train, label, shape.classes).withColumn(fold, F.col(fold).cast("int")).persist()
    slot = Pipeline(stages=[])
    validator = CrossValidator(
        estimator=slot,
        estimatorParamMaps=[{slot.stages: [e]} for e in estimators],
        evaluator=MacroF1(),
        numFolds=folds,
        foldCol=fold,
        parallelism=parallelism,
        seed=seed,
    )
    made = validator.fit(indexed)
    scores = list(made.avgMetrics)
    place = scores.index(max(scores))
    best = models.fit(train, name, every[place], label, shape, seed)
    indexed.unpersist()
    return SearchResult([dict(c) for c in candidates], scores, list(made.stdMetrics), best)


def fold_scores(
    scored: DataFrame, by: Sequence[str] = ("model",), fold: str = "fold", label: str = "y", pred: str = "pred"
) -> DataFrame:
    """Macro F1 per group and fold, all in one grouped pass."""
    scores = classification_metrics(scored, label, pred, by=[*by, fold])
    return scores.select(*by, F.col(fold).alias("fold"), F.col("f1_macro").alias("score"), "row_count")


def out_of_fold(
    train: DataFrame,
    name: str,
    params: Mapping[str, Any],
    key: str,
    label: str = "label",
    fold: str = "fold",
    seed: int = 42,
    shape: Shape | None = None,
) -> DataFrame:
    """Each training row predicted by the model that did not see its fold."""
    shape = shape or describe(train, label)
    folds = sorted(r[0] for r in train.select(fold).distinct().collect())
    parts = None
    for i in folds:
        inner = shape.with_rows(1 - 1 / len(folds))
        made = models.fit(train.where(F.col(fold) != i), name, params, label, inner, seed)
        part = made.score(train.where(F.col(fold) == i)).select(
            F.lit(name).alias("model"), key, F.col(label).alias("y"), "pred", fold
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts


def score_table(fitted: Mapping[str, Fitted], df: DataFrame, key: str, label: str = "label") -> DataFrame:
    """Predictions and probabilities of every model on the same rows, one row per (model, row)."""
    parts = None
    for name, made in fitted.items():
        scored = made.score(df)
        probabilities = [
            (F.col(p) if made.has_probabilities else F.lit(None).cast("double")).alias(p)
            for p in made.probability_columns().values()
        ]
        part = scored.select(F.lit(name).alias("model"), key, F.col(label).alias("y"), "pred", *probabilities)
        parts = part if parts is None else parts.unionByName(part)
    return parts


def comparison(
    scored: DataFrame, classes: Sequence[str], cv: Mapping[str, tuple[dict, float]], with_auc: bool = True
) -> DataFrame:
    """One row per model: parameters, search score, test scores and macro area under the curve.

    ``scored`` is the table of ``score_table``; it is read once for the labels and once for the
    probabilities, whatever the number of models.
    """
    spark = scored.sparkSession
    found = spark.createDataFrame(
        [(m, i, json.dumps(p), float(s)) for i, (m, (p, s)) in enumerate(cv.items())],
        "model string, place int, best_params string, cv_f1_macro double",
    )
    table = found.join(classification_metrics(scored, by=["model"]), "model")
    if with_auc:
        columns = {c: f"p_{c}" for c in classes}
        complete = scored.where(F.col(f"p_{classes[0]}").isNotNull())
        areas = roc_auc_macro(roc_curve(complete, columns, by=["model"]), by=["model"])
        table = table.join(areas, "model", "left")
    rounded = [c for c in table.columns if c not in ("model", "place", "best_params", "row_count")]
    return table.withColumns({c: F.round(c, 4) for c in rounded})
