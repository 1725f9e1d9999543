"""The kernel SVM: all classes in one loop over the plain rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from meridia.operators import models


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 3))
    y = np.where((x**2).sum(1) < 1.5, "in", np.where(x[:, 0] > 0, "east", "west"))
    data = [(i, [float(v) for v in r], str(c)) for i, (r, c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(data, "row_id long, x array<double>, label string")
    return df.withColumn("features", array_to_vector("x")).coalesce(1).persist()


def test_cosines_of_single_precision(rows):
    made = models.FourierFeatures(width=3, gamma=2.0, components=64).cosines()
    x = np.random.default_rng(0).normal(size=(50, 3)) * 30
    assert np.abs(made.single(x) - made(x)).max() < 1e-6


def test_kernel_svm_reaches_the_minimum_of_sparks_own_in_one_loop(monkeypatch, rows):
    shape = models.describe(rows, "label")
    params = {"components": 32, "max_iter": 100}
    kernel = models.build_estimator(models.RBF_SVM, params, shape).kernel
    svm = models._one_vs_rest_svm({}, shape, {"featuresCol": "kernel_features", "labelCol": "label_index"})
    indexed = models.with_label_index(rows, "label", shape.classes)
    alone = Pipeline(stages=[kernel, svm]).fit(indexed).stages[1].models

    def refused(*args):
        raise AssertionError("classes are fitted one by one")

    monkeypatch.setattr(models, "_one_vs_rest_svm", refused)
    made = models.fit(rows, models.RBF_SVM, params)
    kept = kernel.transform(indexed).collect()
    z = np.array([[*r["kernel_features"].toArray(), 1.0] for r in kept])
    for i, (own, spark_own) in enumerate(zip(made.core.weights, alone, strict=True)):
        sign = np.where([r["label_index"] == i for r in kept], 1.0, -1.0)
        found, best = (
            np.maximum(0, 1 - sign * (z @ w)).mean() + (w[:-1] ** 2).sum() / 2 / len(z)
            for w in (own, np.array([*spark_own.coefficients, spark_own.intercept]))
        )
        assert found < best * 1.01 + 1e-4
    hits = made.score(rows).agg(F.avg((F.col("pred") == F.col("label")).cast("int"))).first()[0]
    assert hits > 0.8


def test_kernel_svm_passes_over_no_row(rows):
    holed = rows.withColumn("label", F.when(F.col("row_id") > 4, F.col("label")))
    with pytest.raises(ValueError, match="5 rows"):
        models.fit(holed, models.RBF_SVM, {"components": 4}, shape=models.describe(rows, "label"))
