"""Many linear classifiers fitted in one loop over the data.

A search tries the same model at many strengths on many folds. Here all of these are columns of one weight
matrix: a pass multiplies each block of rows with it once, leaves out the rows of each column's own fold, and
returns every loss and gradient. The driver only moves the weights. Passes grow with the slowest column, not with
the number of columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.blocks import Block, Blocks, dense_blocks
from ..functions.descent import descent, run_together
from . import models

# Numbers of scores that a task holds at once.
SCORES_AT_ONCE = 1 << 22
# Rows whose wider form a task holds at once, few enough to stay in a core's cache.
LIFTED_AT_ONCE = 256
# From this width on the products of features are not summed up.
WIDEST_TURN = 512


@dataclass(frozen=True)
class Task:
    """One classifier: inverse strength, the fold whose rows it does not see (none: it sees all), and the rows
    that its strength refers to."""

    c: float
    hold: int | None
    rows: int


@dataclass(frozen=True)
class Stacked:
    """``weights``: tasks by classes by features, the intercept last. ``passes``: how often the rows were read."""

    name: str
    classes: list[str]
    tasks: list[Task]
    weights: np.ndarray
    losses: np.ndarray
    passes: int

    def pair_counts(self, blocks: Blocks) -> np.ndarray:
        """Rows by task, side (0 seen in fitting, 1 held out), label and prediction, from one pass for all tasks."""
        m, k, p = self.weights.shape
        flat = self.weights.reshape(m * k, p)
        holds = _holds(self.tasks)

        def work(block: Block) -> np.ndarray:
            total = np.zeros(m * 2 * k * k)
            for x, y, fold in _parts(block, m * k):
                best = (x @ flat.T).reshape(len(x), m, k).argmax(2)
                side = fold[:, None] == holds[None, :]
                cell = ((np.arange(m)[None, :] * 2 + side) * k + y[:, None]) * k + best
                total += np.bincount(cell.ravel(), minlength=len(total))
            return total

        return blocks.sums(work, m * 2 * k * k).reshape(m, 2, k, k)


class MarginModel(Model):
    """Scores of one row of weights per class, the intercept last; the largest is the prediction, the first of equal ones."""

    def __init__(self, weights: np.ndarray, features: str = "features"):
        super().__init__()
        self.weights, self.features = weights, features

    def _transform(self, dataset: DataFrame) -> DataFrame:
        shared = dataset.sparkSession.sparkContext.broadcast(self.weights)

        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            w = shared.value
            for batch in batches:
                if len(batch):
                    yield pd.Series(list(np.stack(batch.to_numpy()) @ w[:, :-1].T + w[:, -1]))
                else:
                    yield pd.Series([], dtype=object)

        score.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
        raw = F.col("__raw")
        scored = dataset.withColumn("__raw", F.pandas_udf(score, "array<double>")(vector_to_array(self.features)))
        return scored.select(
            *dataset.columns,
            array_to_vector(raw).alias("rawPrediction"),
            (F.array_position(raw, F.array_max(raw)) - 1).cast("double").alias("prediction"),
        )


def _holds(tasks: Sequence[Task]) -> np.ndarray:
    nothing = np.iinfo(np.int64).min
    return np.array([nothing if t.hold is None else t.hold for t in tasks], np.int64)


def _parts(block: Block, columns: int, lift: Callable[[np.ndarray], np.ndarray] | None = None):
    """Rows with a column of ones, labels and folds, as many at a time as keep the scores bounded."""
    step = max(1, SCORES_AT_ONCE // max(1, columns))
    if lift is not None:
        step = min(step, LIFTED_AT_ONCE)
    for at in range(0, len(block.x), step):
        x = block.x[at : at + step]
        if lift is not None:
            x = lift(x)
        yield np.hstack([x, np.ones((len(x), 1), x.dtype)]), block.codes[0][at : at + step], block.codes[1][at : at + step]


def blocks_of(train: DataFrame, classes: Sequence[str], label: str = "label", fold: str | None = "fold") -> Blocks:
    """Blocks of features, label numbers and folds; without a fold every row is in fold 0."""
    rows = models.with_label_index(train, label, classes, "__y")
    rows = rows.withColumn("__fold", F.col(fold).cast("long") if fold else F.lit(0).cast("long"))
    return dense_blocks(rows, "features", ["__y", "__fold"])


def fit_stacked(
    blocks: Blocks,
    name: str,
    classes: Sequence[str],
    tasks: Sequence[Task],
    max_iter: int | None = None,
    tolerance: float | None = None,
    lift: Callable[[np.ndarray], np.ndarray] | None = None,
) -> Stacked:
    """Fit all tasks: the multinomial logistic model, or one linear SVM per class.

    The losses are those of ``models``: mean log loss or mean hinge loss over the rows a task sees, plus half the
    squared weights over C times its rows; intercepts are free. The logistic intercepts are centred. Blocks come
    from ``blocks_of``; a task that sees no row keeps weights of zero. ``lift`` makes of the rows of a block those that
    the models see; it is called in every pass.
    """
    k, m = len(classes), len(tasks)
    holds = _holds(tasks)
    counts = rows_by_fold(blocks)
    seen = np.array([blocks.n - (counts.get(t.hold, 0) if t.hold is not None else 0) for t in tasks], float)
    strength = np.array([1.0 / (t.c * max(1, t.rows)) for t in tasks])
    if name == models.LOGISTIC:
        outputs, owner, target, slopes = k, np.arange(m), np.zeros(m, np.int64), _log_loss
    elif name == models.LINEAR_SVM:
        outputs, owner, target, slopes = 1, np.repeat(np.arange(m), k), np.tile(np.arange(k), m), _hinge
    else:
        raise ValueError(f"{name} is not linear")
    width = blocks.width if lift is None else lift(np.zeros((1, blocks.width))).shape[1]
    p = width + 1
    size = outputs * p
    # a smooth loss is descended in coordinates in which its curvature is much the same every way
    turn = _even_axes(blocks, tasks, strength, k) if name == models.LOGISTIC and 0 < width < WIDEST_TURN and lift is None else None
    lifted = blocks.broadcast(lift)

    def answer(active: list[int], points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a = len(active)
        weights = points.reshape(a, outputs, p)
        if turn is not None:
            weights = weights @ turn[active]
        held, wanted = holds[owner[active]], target[active]
        flat = weights.reshape(a * outputs, p)
        shared = blocks.broadcast(flat)

        def work(block: Block) -> np.ndarray:
            total = np.zeros(a * size + a)
            for x, y, fold in _parts(block, a * outputs, lifted.value):
                inside = fold[:, None] != held[None, :]
                scores = (x @ shared.value.T.astype(x.dtype, copy=False)).reshape(len(x), a, outputs)
                loss, push = slopes(scores, y, wanted)
                push *= inside[:, :, None]
                total[: a * size] += (push.reshape(len(x), a * outputs).T.astype(x.dtype, copy=False) @ x).ravel()
                total[a * size :] += (loss * inside).sum(0)
            return total

        sums = blocks.sums(work, a * size + a)
        shared.destroy()
        n = np.maximum(seen[owner[active]], 1.0)
        reg = strength[owner[active]]
        free = weights.copy()
        free[:, :, -1] = 0.0
        values = sums[a * size :] / n + reg / 2 * (free**2).sum((1, 2))
        gradients = sums[: a * size].reshape(a, outputs, p) / n[:, None, None] + reg[:, None, None] * free
        if turn is not None:
            gradients = gradients @ turn[active].transpose(0, 2, 1)
        return values, gradients.reshape(a, size)

    is_logistic = name == models.LOGISTIC
    limit = max_iter if max_iter is not None else (200 if is_logistic else 100)
    # the hinge loss has edges, so its descents end when they gain little
    fine = tolerance if tolerance is not None else (1e-7 if is_logistic else 1e-4)
    found, passes = run_together([descent(np.zeros(size), limit, fine) for _ in owner], answer)
    lifted.destroy()
    weights = np.stack([f.point for f in found]).reshape(m, k, p) if found else np.zeros((0, k, p))
    if turn is not None:
        weights = weights @ turn
    if is_logistic:
        weights[:, :, -1] -= weights[:, :, -1].mean(1, keepdims=True)
    losses = np.array([f.value for f in found]).reshape(m, -1).sum(1)
    return Stacked(name, list(classes), list(tasks), weights, losses, passes + 1)


def _even_axes(blocks: Blocks, tasks: Sequence[Task], strength: np.ndarray, k: int) -> np.ndarray:
    """Per task the matrix that turns coordinates of about even curvature into weights.

    The curvature of the log loss at weights of zero is that of the features' products, which one pass sums up by
    fold, plus the strength. Where its root cannot be taken the coordinates stay as they are.
    """
    p = blocks.width + 1
    # folds that no task holds out are one
    holds = sorted({t.hold for t in tasks if t.hold is not None})

    def work(block: Block) -> np.ndarray:
        total = np.zeros((len(holds) + 1, p, p))
        for x, _, fold in _parts(block, p):
            for i, hold in enumerate(holds):
                own = x[fold == hold]
                total[i] += own.T @ own
            rest = x[~np.isin(fold, holds)]
            total[-1] += rest.T @ rest
        return total.ravel()

    made = blocks.sums(work, (len(holds) + 1) * p * p).reshape(-1, p, p)
    turns = []
    for task, reg in zip(tasks, strength, strict=True):
        seen = made.sum(0) - (made[holds.index(task.hold)] if task.hold is not None else 0.0)
        curve = seen / max(1.0, seen[-1, -1]) * (1 / k) * (1 - 1 / k) + np.diag([*[reg] * (p - 1), 0.0])
        try:
            turns.append(np.linalg.inv(np.linalg.cholesky(curve + np.eye(p) * (1e-12 * np.trace(curve)))))
        except np.linalg.LinAlgError:
            turns.append(np.eye(p))
    turns = np.stack(turns) if turns else np.zeros((0, p, p))
    return np.where(np.isfinite(turns).all((1, 2))[:, None, None], turns, np.eye(p))


def fit_svms(
    train: DataFrame, params: Mapping, shape: models.Shape, folds: Sequence[int], label: str = "label", fold: str = "fold"
) -> list[MarginModel]:
    """One linear SVM without each of the folds, then one of all rows, in one loop over the rows."""
    left = dict(params)
    c, limit = float(left.pop("C", 1.0)), left.pop("max_iter", None)
    models.refuse(models.LINEAR_SVM, left)
    inner = shape.with_rows(1 - 1 / len(folds)).n_rows
    tasks = [*(Task(c, f, inner) for f in folds), Task(c, None, shape.n_rows)]
    with blocks_of(train, shape.classes, label, fold) as blocks:
        _whole(blocks, shape)
        made = fit_stacked(blocks, models.LINEAR_SVM, shape.classes, tasks, limit)
    return [MarginModel(w) for w in made.weights]


def _whole(blocks: Blocks, shape: models.Shape) -> None:
    if blocks.n != shape.n_rows:
        raise ValueError(f"{shape.n_rows - blocks.n} rows have no features, label or fold")


def rows_by_fold(blocks: Blocks) -> dict[int, int]:
    def count(block: Block) -> pa.RecordBatch:
        folds, n = np.unique(block.codes[1], return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(folds), pa.array(n)], names=["fold", "n"])

    rows = blocks.map(count, "fold long, n long").groupBy("fold").agg(F.sum("n").alias("n")).collect()
    return {r["fold"]: r["n"] for r in rows}


def _log_loss(scores: np.ndarray, y: np.ndarray, _: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    scores = scores - scores.max(2, keepdims=True)
    at = np.arange(len(y))
    own = scores[at, :, y]
    chance = np.exp(scores)
    whole = chance.sum(2)
    loss = np.log(whole) - own
    chance /= whole[:, :, None]
    chance[at, :, y] -= 1.0
    return loss, chance


def _hinge(scores: np.ndarray, y: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sign = np.where(y[:, None] == wanted[None, :], 1.0, -1.0)
    gap = 1.0 - sign * scores[:, :, 0]
    return np.maximum(gap, 0.0), np.where(gap > 0, -sign, 0.0)[:, :, None]


def macro_f1(counts: np.ndarray) -> float:
    """Unweighted mean F1 over the classes that occur as a label or a prediction."""
    hits, either = np.diag(counts), counts.sum(0) + counts.sum(1)
    there = either > 0
    return float((2 * hits[there] / either[there]).mean()) if there.any() else 0.0


STACKABLE = (models.LOGISTIC, models.LINEAR_SVM)


def stackable(name: str, candidates: Sequence[dict]) -> bool:
    """Whether candidates differ in C alone, so that one loop fits them all."""
    rest = [{k: v for k, v in c.items() if k != "C"} for c in candidates]
    return name in STACKABLE and all(r == rest[0] and set(r) <= {"max_iter"} for r in rest)


def cross_validate(
    train: DataFrame,
    name: str,
    candidates: Sequence[dict],
    shape: models.Shape,
    label: str = "label",
    fold: str = "fold",
) -> tuple[np.ndarray, list[MarginModel], int]:
    """Macro F1 of every candidate on every fold it did not see, its SVM of all rows, and the passes it took.

    The SVMs of all rows are more columns of the same loop. Logistic models of all rows are not made here.
    """
    refit = name == models.LINEAR_SVM
    with blocks_of(train, shape.classes, label, fold) as blocks:
        if refit:
            _whole(blocks, shape)
        folds = sorted(rows_by_fold(blocks))
        inner = shape.with_rows(1 - 1 / len(folds)).n_rows
        strengths = [float(c.get("C", 1.0)) for c in candidates]
        tasks = [Task(c, f, inner) for c in strengths for f in folds]
        more = [Task(c, None, shape.n_rows) for c in strengths] if refit else []
        limit = candidates[0].get("max_iter") if candidates else None
        made = fit_stacked(blocks, name, shape.classes, [*tasks, *more], limit)
        counts = made.pair_counts(blocks)[: len(tasks)]
    scores = np.array([macro_f1(c[1]) for c in counts]).reshape(len(candidates), len(folds))
    return scores, [MarginModel(w) for w in made.weights[len(tasks) :]], made.passes + 1
