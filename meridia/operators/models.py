"""Classifiers: Spark ML estimators behind one set of parameter names, and their scores as tables."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property
from typing import Any

import numpy as np
import pandas as pd
from pyspark import InheritableThread, keyword_only
from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    OneVsRest,
    OneVsRestModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.blocks import dense_blocks
from .encode import class_index

LOGISTIC = "Logistic Regression"
FOREST = "Random Forest"
BOOSTING = "Gradient Boosting"
SOFTMAX_BOOSTING = "Gradient Boosting (softmax)"
LINEAR_SVM = "SVM (Linear)"
RBF_SVM = "SVM (RBF)"
NETWORK = "Neural Network (MLP)"
MODELS = [LOGISTIC, FOREST, BOOSTING, LINEAR_SVM, RBF_SVM, NETWORK]
UNLIMITED_DEPTH = 30


@dataclass(frozen=True)
class Shape:
    """What parameter translation must know about the training table."""

    n_rows: int
    n_features: int
    classes: list[str]
    variance: float = 1.0

    def with_rows(self, share: float) -> Shape:
        return Shape(max(1, round(self.n_rows * share)), self.n_features, self.classes, self.variance)


def describe(train: DataFrame, label: str, features: str = "features") -> Shape:
    """Rows, features, sorted classes and the overall variance of the feature values."""
    row = train.agg(
        F.count(F.lit(1)).alias("n"), Summarizer.metrics("mean", "normL2").summary(F.col(features)).alias("s")
    ).first()
    mean, norm = row["s"]["mean"].toArray(), row["s"]["normL2"].toArray()
    second = float((norm**2 / row["n"]).mean())
    classes = sorted(r[0] for r in train.select(label).distinct().collect())
    return Shape(row["n"], len(mean), classes, second - float(mean.mean()) ** 2)


def with_label_index(df: DataFrame, label: str, classes: Sequence[str], out: str = "label_index") -> DataFrame:
    return df.withColumn(out, class_index(F.col(label), classes).cast("double"))


@dataclass(frozen=True)
class Cosines:
    """Rows of features to rows of random cosines."""

    directions: np.ndarray
    offsets: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(2 / len(self.offsets)) * np.cos(x @ self.directions + self.offsets)

    @cached_property
    def _turns(self) -> tuple[np.ndarray, np.ndarray]:
        return self.directions / (2 * math.pi), self.offsets / (2 * math.pi)

    def single(self, x: np.ndarray) -> np.ndarray:
        """The same to single precision: angles are doubles until whole turns are taken off."""
        directions, offsets = self._turns
        turned = x @ directions
        turned += offsets
        turned -= np.rint(turned)
        made = turned.astype(np.float32)
        made *= np.float32(2 * math.pi)
        np.cos(made, out=made)
        made *= np.float32(math.sqrt(2 / len(self.offsets)))
        return made


class FourierFeatures(Transformer, HasInputCol, HasOutputCol, HasSeed):
    """Random cosine features whose inner product approximates exp(-gamma |x - y|^2) (Rahimi & Recht 2007)."""

    gamma = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)
    components = Param(Params._dummy(), "components", "number of random features", TypeConverters.toInt)
    width = Param(Params._dummy(), "width", "number of input features", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, width, inputCol="features", outputCol="kernel_features", gamma=1.0, components=256, seed=42):
        super().__init__()
        self._set(
            inputCol=inputCol, outputCol=outputCol, gamma=gamma, components=components, width=width, seed=seed
        )

    def cosines(self) -> Cosines:
        p = self.getOrDefault(self.width)
        rng = np.random.default_rng(self.getSeed())
        m = self.getOrDefault(self.components)
        directions = rng.standard_normal((p, m)) * math.sqrt(2 * self.getOrDefault(self.gamma))
        return Cosines(directions, rng.uniform(0, 2 * math.pi, m))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        shared = dataset.sparkSession.sparkContext.broadcast(self.cosines())

        def project(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                if len(batch):
                    yield pd.Series(list(shared.value(np.stack(batch.to_numpy()))))
                else:
                    yield pd.Series([], dtype=object)

        project.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
        arrays = F.pandas_udf(project, "array<double>")(vector_to_array(self.getInputCol()))
        return dataset.withColumn(self.getOutputCol(), array_to_vector(arrays))


# That of Spark's own linear SVM. Cosines are small and many, so the wider one of plain features ends too early.
TOLERANCE = 1e-6


class KernelSvm(Estimator):
    """One-vs-rest linear SVM over ``FourierFeatures``, whose classes are fitted in one loop over the plain rows.

    The cosines of a block are made anew in each pass, so nothing wider than the features is kept or sent. The fit has them
    in single precision, sums and weights in double; scores are made of doubles.
    """

    def __init__(self, kernel: FourierFeatures, c: float, rows: int, max_iter: int = 100, labelCol: str = "label_index"):
        super().__init__()
        self.kernel, self.c, self.rows, self.max_iter, self.label = kernel, c, rows, max_iter, labelCol

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        from . import stacked

        found = dataset.agg(F.count(F.lit(1)).alias("n"), F.max(self.label).alias("last")).first()
        classes = [str(i) for i in range(int(found["last"]) + 1)]
        rows = dataset.select(self.kernel.getInputCol(), self.label, F.lit(0).alias("__fold"))
        with dense_blocks(rows, self.kernel.getInputCol(), [self.label, "__fold"]) as blocks:
            if blocks.n != found["n"]:
                raise ValueError(f"{found['n'] - blocks.n} rows have no features or label")
            task = stacked.Task(self.c, None, self.rows)
            made = stacked.fit_stacked(blocks, LINEAR_SVM, classes, [task], self.max_iter, TOLERANCE, self.kernel.cosines().single)
        return PipelineModel([self.kernel, stacked.MarginModel(made.weights[0], self.kernel.getOutputCol())])


class ClassParallelOneVsRest(OneVsRest):
    """One-vs-rest that fits its classes at the same time, each thread with job properties of its own.

    PySpark 4.1 hands one set of properties to all threads when ``parallelism`` is above 1, and two SQL
    jobs that start at the same moment can then fail.
    """

    def _fit(self, dataset: DataFrame) -> OneVsRestModel:
        classifier, label = self.getClassifier(), self.getLabelCol()
        k = int(dataset.agg(F.max(label)).first()[0]) + 1
        rows = dataset.select(label, self.getFeaturesCol()).persist()
        fitted: list = [None] * k
        failures: list[BaseException] = []

        def fit_class(i: int) -> None:
            try:
                columns = {
                    classifier.labelCol: f"is_class_{i}",
                    classifier.featuresCol: self.getFeaturesCol(),
                    classifier.predictionCol: self.getPredictionCol(),
                }
                of_class = rows.withColumn(f"is_class_{i}", (F.col(label) == i).cast("double"))
                fitted[i] = classifier.fit(of_class, columns)
            except BaseException as error:  # noqa: BLE001 - raised again below
                failures.append(error)

        threads = [InheritableThread(fit_class, args=(i,), session=dataset.sparkSession) for i in range(k)]
        for thread in threads:
            thread.start()
        for thread in threads:
            thread.join()
        rows.unpersist()
        if failures:
            raise failures[0]
        return self._copyValues(OneVsRestModel(models=fitted))


def refuse(name: str, left: Mapping[str, Any]) -> None:
    if left:
        raise ValueError(f"{name}: no Spark counterpart for {sorted(left)}")


def _depth(value: int | None) -> int:
    """Depth of a tree; none means as deep as Spark allows, and more than that is refused."""
    if value is not None and int(value) > UNLIMITED_DEPTH:
        raise ValueError(f"trees can be {UNLIMITED_DEPTH} levels deep at most")
    return UNLIMITED_DEPTH if value is None else int(value)


def build_estimator(name: str, params: Mapping[str, Any], shape: Shape, seed: int = 42) -> Estimator:
    """Estimator for a model name and parameters under their usual Python names.

    A parameter without a Spark counterpart raises; nothing is dropped in silence. Values that leave
    the default behaviour as it is (``min_samples_split=2``) pass.
    """
    left = dict(params)
    max_bins = int(left.pop("max_bins", 128))
    if left.get("min_samples_split") == 2:
        left.pop("min_samples_split")
    columns = {"featuresCol": "features", "labelCol": "label_index"}
    k = len(shape.classes)
    if name == LOGISTIC:
        reg = 1.0 / (float(left.pop("C", 1.0)) * shape.n_rows)
        made = LogisticRegression(
            family="multinomial", regParam=reg, standardization=False, maxIter=int(left.pop("max_iter", 200)), **columns
        )
    elif name == FOREST:
        # a row's node in every tree is kept from level to level; else each level walks all trees from their roots
        made = RandomForestClassifier(
            cacheNodeIds=True,
            numTrees=int(left.pop("n_estimators", 100)),
            maxDepth=_depth(left.pop("max_depth", None)),
            minInstancesPerNode=int(left.pop("min_samples_leaf", 1)),
            featureSubsetStrategy=str(left.pop("max_features", "sqrt")),
            maxBins=max_bins,
            seed=seed,
            **columns,
        )
    elif name == BOOSTING:
        tree = GBTClassifier(
            maxIter=int(left.pop("n_estimators", 100)),
            stepSize=float(left.pop("learning_rate", 0.1)),
            maxDepth=_depth(left.pop("max_depth", 3)),
            subsamplingRate=float(left.pop("subsample", 1.0)),
            maxBins=max_bins,
            seed=seed,
            **columns,
        )
        made = ClassParallelOneVsRest(classifier=tree, **columns)
    elif name == SOFTMAX_BOOSTING:
        from .boosting import SoftmaxBooster

        made, left = SoftmaxBooster({**left, "max_bins": max_bins}, k, seed=seed), {}
    elif name == LINEAR_SVM:
        made = _one_vs_rest_svm(left, shape, columns)
    elif name == RBF_SVM:
        gamma = left.pop("gamma", "scale")
        if gamma == "scale":
            gamma = 1.0 / (shape.n_features * (shape.variance or 1.0))
        elif gamma == "auto":
            gamma = 1.0 / shape.n_features
        kernel = FourierFeatures(width=shape.n_features, gamma=float(gamma), components=int(left.pop("components", 256)), seed=seed)
        made = KernelSvm(kernel, float(left.pop("C", 1.0)), shape.n_rows, int(left.pop("max_iter", 100)))
    elif name == NETWORK:
        layers = [shape.n_features, *[int(h) for h in left.pop("hidden_layer_sizes", (100,))], k]
        made = MultilayerPerceptronClassifier(
            layers=layers, maxIter=int(left.pop("max_iter", 100)), seed=seed, **columns
        )
        if "learning_rate_init" in left:
            made = made.setSolver("gd").setStepSize(float(left.pop("learning_rate_init")))
    else:
        raise ValueError(f"unknown model {name!r}")
    refuse(name, left)
    return made


def _one_vs_rest_svm(left: dict, shape: Shape, columns: dict) -> OneVsRest:
    svm = LinearSVC(
        regParam=1.0 / (float(left.pop("C", 1.0)) * shape.n_rows),
        standardization=False,
        maxIter=int(left.pop("max_iter", 100)),
        **columns,
    )
    return ClassParallelOneVsRest(classifier=svm, **columns)


@dataclass(frozen=True)
class Fitted:
    """A model with the class order of its outputs. ``scaling`` holds Platt's (slope, offset) per class."""

    name: str
    model: Model
    classes: list[str]
    params: dict = field(default_factory=dict)
    scaling: list[tuple[float, float]] | None = None

    @property
    def has_probabilities(self) -> bool:
        return self.name not in (LINEAR_SVM, RBF_SVM) or self.scaling is not None

    @property
    def core(self) -> Model:
        """The classifier itself, without feature steps before it."""
        return self.model.stages[-1] if hasattr(self.model, "stages") else self.model

    def score(self, df: DataFrame, pred: str = "pred") -> DataFrame:
        """Predicted class and, where the model has them, one probability column ``p_<class>`` per class."""
        listed = F.array(*[F.lit(c) for c in self.classes])
        made = self.model.transform(df)
        named = made.withColumn(pred, F.element_at(listed, F.col("prediction").cast("int") + 1))
        probabilities = {}
        if self.scaling is not None or self.name == BOOSTING:
            # two-sided margins of a booster enter its logistic link doubled
            lines = self.scaling or [(2.0, 0.0)] * len(self.classes)
            raw = vector_to_array("rawPrediction")
            each = [1.0 / (1.0 + F.exp(-(raw[i] * a + b))) for i, (a, b) in enumerate(lines)]
            named = named.withColumns({f"__e{i}": e for i, e in enumerate(each)})
            whole = sum((F.col(f"__e{i}") for i in range(1, len(each))), F.col("__e0"))
            even = F.lit(1.0 / len(each))
            probabilities = {
                f"p_{c}": F.coalesce(F.try_divide(F.col(f"__e{i}"), whole), even) for i, c in enumerate(self.classes)
            }
        elif self.has_probabilities:
            values = vector_to_array("probability")
            probabilities = {f"p_{c}": values[i] for i, c in enumerate(self.classes)}
        return named.select(*df.columns, pred, *[v.alias(n) for n, v in probabilities.items()])

    def probability_columns(self) -> dict[str, str]:
        return {c: f"p_{c}" for c in self.classes}


def fit(
    train: DataFrame,
    name: str,
    params: Mapping[str, Any] | None = None,
    label: str = "label",
    shape: Shape | None = None,
    seed: int = 42,
) -> Fitted:
    """Fit one model on a table with ``features`` and a label column."""
    shape = shape or describe(train, label)
    estimator = build_estimator(name, params or {}, shape, seed)
    model = estimator.fit(with_label_index(train, label, shape.classes))
    return Fitted(name, model, shape.classes, dict(params or {}))


def majority(train: DataFrame, label: str) -> str:
    """The class a constant model would predict."""
    order = [F.col("n").desc(), F.col(label)]
    return train.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(*order).first()[0]


def platt_scaling(
    train: DataFrame, name: str, params: Mapping[str, Any], label: str = "label", fold: str = "fold", seed: int = 42
) -> Fitted:
    """Margin classifier whose margins become probabilities.

    Margins come from models that did not see the row's fold; a one-feature logistic fit per class
    turns them into probabilities. Linear SVMs of all folds and of all rows are fitted in one loop.
    """
    shape = describe(train, label)
    indexed = with_label_index(train, label, shape.classes).persist()
    folds = sorted(r[0] for r in indexed.select(fold).distinct().collect())
    if name == LINEAR_SVM:
        from .stacked import fit_svms

        *by_fold, final = fit_svms(train, params, shape, folds, label, fold)
    else:
        inner = shape.with_rows(1 - 1 / len(folds))
        by_fold = [build_estimator(name, params, inner, seed).fit(indexed.where(F.col(fold) != i)) for i in folds]
        final = build_estimator(name, params, shape, seed).fit(indexed)
    outside = None
    for i, model in zip(folds, by_fold):
        part = model.transform(indexed.where(F.col(fold) == i)).select("label_index", "rawPrediction")
        outside = part if outside is None else outside.unionByName(part)
    outside = outside.persist()
    raw = vector_to_array("rawPrediction")
    lines = []
    for i in range(len(shape.classes)):
        one = outside.select(
            array_to_vector(F.array(raw[i])).alias("margin"),
            (F.col("label_index") == i).cast("double").alias("is_class"),
        )
        line = LogisticRegression(featuresCol="margin", labelCol="is_class", maxIter=50).fit(one)
        lines.append((float(line.coefficients[0]), float(line.intercept)))
    outside.unpersist()
    indexed.unpersist()
    return Fitted(name, final, shape.classes, dict(params), lines)
