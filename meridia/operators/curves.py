"""Learning, validation and regularisation curves, and training progress, as tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ranks import hash_rank
from . import models, stacked
from .metrics import classification_metrics

LEARNING_SHARES = [0.1 + 0.9 * i / 7 for i in range(8)]
# The swept learning rates and regularisation strengths.
LEARNING_RATES = [0.005, 0.01, 0.03, 0.05, 0.1, 0.15, 0.2, 0.3]
C_PATH = [0.001, 0.01, 0.1, 0.5, 1, 5, 10, 50, 100]

_CURVE = "point int, value double, fold int, split string, score double, row_count long"


def _both_sides(fitted: models.Fitted, rows: DataFrame, label: str) -> list[tuple[str, float, int]]:
    """Macro F1 of one model on each value of ``side``, in one pass."""
    scored = classification_metrics(fitted.score(rows), label, "pred", by=["side"])
    return [(r["side"], r["f1_macro"], r["row_count"]) for r in scored.collect()]


def learning_curve(
    train: DataFrame,
    name: str,
    params: Mapping[str, Any],
    key: str,
    label: str = "label",
    fold: str = "fold",
    shares: Sequence[float] = tuple(LEARNING_SHARES),
    seed: int = 42,
) -> DataFrame:
    """Train and validation macro F1 per (size, fold). The training subsets of a fold are nested.

    The rank that decides which subsets a row is in is drawn once per (fold, class) for all folds:
    the subset of a fold's training rows is the union of the prefixes of the other folds.
    """
    shape = models.describe(train, label)
    ranked = hash_rank(train, [fold, label], key, seed, rank="__rank", size="__size").persist()
    folds = sorted(r[0] for r in ranked.select(fold).distinct().collect())
    rows = []
    for i in folds:
        for point, share in enumerate(shares):
            inside = (F.col(fold) != i) & (F.col("__rank") <= F.ceil(F.col("__size") * share - 1e-9))
            subset = ranked.where(inside).persist()
            n = subset.count()
            size = models.Shape(n, shape.n_features, shape.classes, shape.variance)
            made = models.fit(subset, name, params, label, size, seed)
            judged = subset.withColumn("side", F.lit("train")).unionByName(
                ranked.where(F.col(fold) == i).withColumn("side", F.lit("validation"))
            )
            rows += [(point, float(n), int(i), s, f, c) for s, f, c in _both_sides(made, judged, label)]
            subset.unpersist()
    ranked.unpersist()
    return train.sparkSession.createDataFrame(rows, _CURVE)


def validation_curve(
    train: DataFrame,
    name: str,
    params: Mapping[str, Any],
    swept: str,
    values: Sequence[float],
    label: str = "label",
    fold: str = "fold",
    seed: int = 42,
) -> DataFrame:
    """Train and validation macro F1 per (value, fold) while one parameter moves."""
    shape = models.describe(train, label)
    rest = {k: v for k, v in params.items() if k != swept}
    folds = sorted(r[0] for r in train.select(fold).distinct().collect())
    inner = shape.with_rows(1 - 1 / len(folds))
    level = train.storageLevel
    own = not (level.useMemory or level.useDisk)  # a cache the caller made stays the caller's
    cached = train.persist() if own else train
    rows = []
    for i in folds:
        judged = cached.withColumn("side", F.when(F.col(fold) == i, "validation").otherwise("train"))
        for point, value in enumerate(values):
            made = models.fit(cached.where(F.col(fold) != i), name, {**rest, swept: value}, label, inner, seed)
            rows += [(point, float(value), int(i), s, f, c) for s, f, c in _both_sides(made, judged, label)]
    if own:
        cached.unpersist()
    return train.sparkSession.createDataFrame(rows, _CURVE)


def regularization_path(
    df: DataFrame,
    label: str = "label",
    side: str = "split",
    values: Sequence[float] = tuple(C_PATH),
    params: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Train and test macro F1 of the logistic model for each C, all fitted in one loop over the training rows.

    ``side`` is ``train`` for the rows that are fitted on and one other value for those that only judge.
    """
    sides = sorted(r[0] for r in df.select(side).distinct().collect())
    others = [s for s in sides if s != "train"]
    if len(others) > 1 or "train" not in sides:
        raise ValueError(f"expected train and one other side, found {sides}")
    rest = dict(params or {})
    limit = rest.pop("max_iter", None)
    if rest:
        raise ValueError(f"{models.LOGISTIC}: no Spark counterpart for {sorted(rest)}")
    rows = df.withColumn("side", (F.col(side) != "train").cast("int"))
    shape = models.describe(rows.where("side = 0"), label)
    tasks = [stacked.Task(float(c), 1, shape.n_rows) for c in values]
    with stacked.blocks_of(rows, shape.classes, label, "side") as blocks:
        counts = stacked.fit_stacked(blocks, models.LOGISTIC, shape.classes, tasks, limit).pair_counts(blocks)
    points = [
        (point, float(c), 0, s, stacked.macro_f1(counts[point, at]), int(counts[point, at].sum()))
        for point, c in enumerate(values)
        for at, s in enumerate(["train", *others])
    ]
    return df.sparkSession.createDataFrame(points, _CURVE)


def curve_summary(curve: DataFrame) -> DataFrame:
    """Mean and spread over folds per point and side: the line and its band."""
    return curve.groupBy("point", "split").agg(
        F.avg("value").alias("value"),
        F.avg("score").alias("score_mean"),
        F.stddev_pop("score").alias("score_std"),
    )


def network_progress(
    train: DataFrame,
    key: str,
    hidden: Sequence[int] = (128, 64),
    label: str = "label",
    hold_out: float = 0.15,
    step: int = 10,
    max_iter: int = 500,
    patience: int = 3,
    tolerance: float = 1e-4,
    seed: int = 42,
) -> DataFrame:
    """Training loss of every iteration, and hold-out accuracy after every ``step`` of them, until it stops rising.

    Training goes on from the weights reached so far; only weights and two numbers reach the driver.
    """
    shape = models.describe(train, label)
    ranked = hash_rank(train, [label], key, f"{seed}:hold-out", rank="__rank", size="__size")
    side = F.when(F.col("__rank") <= F.floor(F.col("__size") * hold_out), "hold-out").otherwise("train")
    rows = models.with_label_index(ranked, label, shape.classes).withColumn("side", side).persist()
    fitting, judging = rows.where("side = 'train'"), rows.where("side = 'hold-out'")
    layers = [shape.n_features, *hidden, len(shape.classes)]
    weights, done, best, stale, out = None, 0, -1.0, 0, []
    while done < max_iter and stale < patience:
        estimator = MultilayerPerceptronClassifier(
            layers=layers, maxIter=min(step, max_iter - done), seed=seed, labelCol="label_index"
        )
        if weights is not None:
            estimator = estimator.setInitialWeights(weights)
        model = estimator.fit(fitting)
        weights = model.weights
        losses = model.summary().objectiveHistory
        # the first entry of a continued run is the last one of the run before
        out += [(done + i, float(v), None) for i, v in enumerate(losses) if i or not done]
        done += max(1, len(losses) - 1)
        hit = (F.col("prediction") == F.col("label_index")).cast("double")
        accuracy = model.transform(judging).agg(F.avg(hit)).first()[0]
        out[-1] = (out[-1][0], float(losses[-1]), accuracy)
        stale = 0 if accuracy is not None and accuracy > best + tolerance else stale + 1
        best = max(best, accuracy or 0.0)
        if len(losses) <= 1:
            break
    rows.unpersist()
    return train.sparkSession.createDataFrame(
        out, "iteration int, loss double, validation_accuracy double"
    )
