"""Fits and clusterings that share their passes over the rows, against one at a time."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from meridia.functions.blocks import dense_blocks
from meridia.functions import blocks as blocks_module
from meridia.functions.descent import descent, run_together
from meridia.operators import cluster, curves, lloyd, models, search, split, stacked


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 5))
    noisy = x + 0.6 * rng.normal(size=x.shape)
    y = np.where(noisy[:, 0] > 0.5, "hi", np.where(noisy[:, 1] > 0, "mid", "low"))
    data = [(i, [float(v) for v in r], str(c)) for i, (r, c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(data, "row_id long, x array<double>, label string").repartition(3, "row_id")
    df = split.stratified_kfold(df.withColumn("features", array_to_vector("x")), "label", "row_id", 5)
    return df.persist()


def test_sums_are_the_same_at_the_driver_and_in_spark(rows, monkeypatch):
    with dense_blocks(rows, "x", ["row_id"]) as made:
        assert (made.n, made.width) == (600, 5) and made.blocks >= 1
        near = made.sums(lambda b: np.append(b.x.sum(0), b.codes[0].sum()), 6)
        monkeypatch.setattr(blocks_module, "DRIVER_BYTES", 0)
        far = made.sums(lambda b: np.append(b.x.sum(0), b.codes[0].sum()), 6)
    assert near == pytest.approx(far) and near[5] == 600 * 599 / 2


def test_blocks_of_nothing_and_with_nulls(spark):
    kind = "x array<double>, c long"
    with dense_blocks(spark.createDataFrame([], kind), "x", ["c"]) as made:
        assert made.n == 0 and made.sums(lambda b: b.x.sum(0), 3).tolist() == [0, 0, 0]
    odd = spark.createDataFrame([([1.0, 2.0], 1), (None, 2), ([3.0, 4.0], None)], kind)
    with dense_blocks(odd, "x", ["c"]) as made:
        assert made.n == 1 and made.sums(lambda b: b.x.sum(0), 2).tolist() == [1, 2]


def test_descents_share_their_calls():
    centers = np.array([[1.0, -2.0], [30.0, 4.0], [0.0, 0.0]])
    scale = np.array([1.0, 50.0])

    def answer(active, points):
        gap = points - centers[active]
        return (scale * gap**2).sum(1), 2 * scale * gap

    found, calls = run_together([descent(np.zeros(2)) for _ in centers], answer)
    assert np.abs(np.stack([f.point for f in found]) - centers).max() < 1e-5
    assert calls <= max(f.turns for f in found) * 4 + 1


def test_descent_reaches_a_minimum_with_edges():
    def answer(active, points):
        return np.abs(points - 3.0).sum(1) + 0.1 * (points**2).sum(1), np.sign(points - 3.0) + 0.2 * points

    found, _ = run_together([descent(np.full(4, 9.0), tolerance=1e-6)], answer)
    assert np.abs(found[0].point - 3.0).max() < 1e-3


def test_many_logistic_fits_equal_single_ones(rows):
    shape = models.describe(rows, "label")
    inner = shape.with_rows(0.8)
    strengths = search.RANDOM_PRESET[models.LOGISTIC]["C"]
    tasks = [stacked.Task(c, f, inner.n_rows) for c in strengths for f in range(5)]
    with stacked.blocks_of(rows, shape.classes) as blocks:
        made = stacked.fit_stacked(blocks, models.LOGISTIC, shape.classes, tasks)
    assert len(tasks) == 55 and made.passes <= 60
    for at in (0, 17, 54):
        single = models.fit(
            rows.where(F.col("fold") != tasks[at].hold), models.LOGISTIC, {"C": tasks[at].c}, shape=inner
        )
        core = single.core
        alone = np.hstack([core.coefficientMatrix.toArray(), core.interceptVector.toArray()[:, None]])
        assert np.abs(made.weights[at] - alone).max() < 1e-4


def test_features_that_nearly_repeat_each_other_do_not_add_passes(spark):
    rng = np.random.default_rng(31)
    base = rng.normal(size=(600, 3))
    x = np.hstack([base, base + 0.02 * rng.normal(size=(600, 3)), 30 * rng.normal(size=(600, 1))])
    y = (x @ rng.normal(size=(7, 3)) * 0.3 + rng.gumbel(size=(600, 3))).argmax(1)
    made = [(str(c), Vectors.dense(r), i % 3) for i, (r, c) in enumerate(zip(x.tolist(), y.tolist()))]
    df = spark.createDataFrame(made, ["label", "features", "fold"])
    shape = models.describe(df, "label")
    tasks = [stacked.Task(c, f, shape.n_rows) for c in (0.1, 100.0) for f in (0, 1, None)]
    with stacked.blocks_of(df, shape.classes) as blocks:
        fitted = stacked.fit_stacked(blocks, models.LOGISTIC, shape.classes, tasks)
    assert fitted.passes <= 60
    for at, task in enumerate(tasks):
        seen = np.array([task.hold is None or i % 3 != task.hold for i in range(600)])
        ones = np.hstack([x[seen], np.ones((seen.sum(), 1))])
        each = np.exp(ones @ fitted.weights[at].T)
        push = each / each.sum(1, keepdims=True) - np.eye(3)[y[seen]]
        free = np.hstack([fitted.weights[at][:, :-1], np.zeros((3, 1))])
        slope = push.T @ ones / seen.sum() + free / (task.c * shape.n_rows)
        assert np.abs(slope).max() < 1e-5


def test_many_svm_fits_are_no_worse_than_single_ones(rows):
    shape = models.describe(rows, "label")
    tasks = [stacked.Task(c, f, shape.n_rows) for c in (0.01, 1.0) for f in (0, None)]
    with stacked.blocks_of(rows, shape.classes) as blocks:
        made = stacked.fit_stacked(blocks, models.LINEAR_SVM, shape.classes, tasks)
    single = models.fit(rows, models.LINEAR_SVM, {"C": 1.0}, shape=shape)
    alone = np.array([[*m.coefficients, m.intercept] for m in single.core.models])
    data = rows.collect()
    x = np.array([[*r["x"], 1.0] for r in data])
    y = np.array([shape.classes.index(r["label"]) for r in data])

    def loss(w: np.ndarray) -> float:
        sign = np.where(y[:, None] == np.arange(len(w)), 1.0, -1.0)
        return np.maximum(0, 1 - sign * (x @ w.T)).mean(0).sum() + (w[:, :-1] ** 2).sum() / (2 * shape.n_rows)

    assert loss(made.weights[3]) == pytest.approx(made.losses[3], rel=1e-9)
    assert made.losses[3] <= loss(alone) * (1 + 1e-3)


def test_search_of_linear_models_takes_the_loop(rows, monkeypatch):
    alone = search.search(rows, models.LOGISTIC, [{"C": 0.01}, {"C": 10}], fixed={"max_iter": 50})
    monkeypatch.setattr(stacked, "stackable", lambda *_: False)
    one_by_one = search.search(rows, models.LOGISTIC, [{"C": 0.01}, {"C": 10}], fixed={"max_iter": 50})
    assert alone.scores == pytest.approx(one_by_one.scores, abs=2e-3)
    assert alone.spreads == pytest.approx(one_by_one.spreads, abs=2e-3)
    assert alone.best.params == one_by_one.best.params


def test_only_candidates_that_differ_in_strength_are_stacked():
    assert stacked.stackable(models.LOGISTIC, [{"C": 1, "max_iter": 5}, {"C": 2, "max_iter": 5}])
    assert not stacked.stackable(models.LOGISTIC, [{"C": 1, "max_iter": 5}, {"C": 2, "max_iter": 6}])
    assert not stacked.stackable(models.LOGISTIC, [{"penalty": "l1"}])
    assert not stacked.stackable(models.FOREST, [{}])


def test_regularization_path_counts_both_sides(rows):
    both = rows.withColumn("split", F.when(F.col("fold") == 4, "test").otherwise("train"))
    made = curves.regularization_path(both, values=[0.01, 10.0]).collect()
    n = {"test": both.where("fold = 4").count(), "train": both.where("fold <> 4").count()}
    assert [(r["point"], r["split"]) for r in made] == [(p, s) for p in (0, 1) for s in ("train", "test")]
    assert all(r["row_count"] == n[r["split"]] and 0.5 < r["score"] <= 1 for r in made)
    with pytest.raises(ValueError, match="one other side"):
        curves.regularization_path(both.withColumn("split", F.col("fold").cast("string")))


@pytest.fixture(scope="module")
def clouds(spark):
    rng = np.random.default_rng(9)
    centers = np.array([[0, 0, 0], [9, 0, 0], [0, 9, 0], [0, 0, 9], [9, 9, 9]], float)
    x = np.concatenate([c + rng.normal(size=(80, 3)) for c in centers]) + 1000.0
    data = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(data, "row_id long, x array<double>").repartition(3, "row_id").persist()


def test_all_runs_together(clouds):
    x = np.array([r["x"] for r in clouds.collect()])
    with dense_blocks(clouds, "x") as blocks:
        runs = lloyd.many_runs(blocks, [2, 5], starts=4)
        assert [(r.k, r.start) for r in runs] == [(k, s) for k in (2, 5) for s in range(4)]
        best = lloyd.best_runs(runs)
        shapes = lloyd.silhouettes(blocks, list(best.values()))
        counts, sums, costs = lloyd.step(blocks, [best[5].centers, best[2].centers], x.mean(0))
    for run in runs:
        d = ((x[:, None] - run.centers[None]) ** 2).sum(2)
        assert run.inertia == pytest.approx(d.min(1).sum(), rel=1e-9)
        own = d.argmin(1)
        moved = np.array([x[own == c].mean(0) for c in range(run.k)])
        assert ((moved - run.centers) ** 2).sum() <= 1e-4 * x.var(0).mean() * 1.001
    assert best[5].inertia == min(r.inertia for r in runs if r.k == 5) < 1500
    own = ((x[:, None] - best[5].centers[None]) ** 2).sum(2).argmin(1)
    assert counts[0].tolist() == [80.0] * 5 == np.bincount(own).tolist()
    assert np.allclose(sums[0], [x[own == c].sum(0) for c in range(5)])
    assert costs[0] == pytest.approx(best[5].inertia)
    for run, value in zip(best.values(), shapes, strict=True):
        placed = run.transform(cluster.as_vectors(clouds, "x"))
        assert value == pytest.approx(cluster.silhouette_squared(placed), abs=1e-9)


def test_as_good_as_sparks_own(clouds):
    from pyspark.ml.clustering import KMeans

    vectors = cluster.as_vectors(clouds, "x").persist()
    alone = min(KMeans(k=4, seed=42 + s, maxIter=100).fit(vectors).summary.trainingCost for s in range(4))
    _, cost, placed = cluster.kmeans(vectors, 4, starts=4)
    assert cost <= alone * (1 + 1e-6)
    assert placed.select("cluster").distinct().count() == 4


def test_few_rows_copies_and_none(spark):
    kind = "row_id long, x array<double>"
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(30)], kind)
    with dense_blocks(same, "x") as blocks:
        runs = lloyd.many_runs(blocks, [3], starts=2)
        assert all(len(r.centers) == 1 and r.inertia == 0 for r in runs) and lloyd.silhouettes(blocks, runs) == [None, None]
    with dense_blocks(same.limit(0), "x") as blocks, pytest.raises(ValueError, match="no row"):
        lloyd.many_runs(blocks, [2])
    run = lloyd.Run(2, 0, np.array([[0.0], [5.0]]), 0.0, 1)
    odd = spark.createDataFrame([(1, [1.0]), (2, None), (3, [4.0])], kind)
    got = {r["row_id"]: r["cluster"] for r in run.transform(odd, "x").collect()}
    assert got == {1: 0, 2: None, 3: 1}


def test_platt_scaling_fits_its_linear_svms_in_one_loop(rows, monkeypatch):
    shape = models.describe(rows, "label")
    alone = models.fit(rows, models.LINEAR_SVM, {"C": 0.5}, shape=shape)

    def refused(*_):
        raise AssertionError("fitted one by one")

    monkeypatch.setattr(models, "build_estimator", refused)
    made = models.platt_scaling(rows, models.LINEAR_SVM, {"C": 0.5})
    both = made.score(rows).join(alone.score(rows).select("row_id", F.col("pred").alias("single")), "row_id").collect()
    assert sum(r["pred"] == r["single"] for r in both) >= 0.97 * len(both) == 0.97 * 600
    assert all(sum(r[f"p_{c}"] for c in made.classes) == pytest.approx(1) for r in both)
    assert all(slope > 0 for slope, _ in made.scaling)
    with pytest.raises(ValueError, match="no Spark counterpart"):
        models.platt_scaling(rows, models.LINEAR_SVM, {"gamma": 1})
    odd = rows.unionByName(rows.limit(1).withColumn("fold", F.lit(None).cast("int")))
    with pytest.raises(ValueError, match="1 rows have no"):
        stacked.fit_svms(odd, {}, models.describe(odd, "label"), [0, 1, 2, 3, 4])


def test_search_of_linear_svms_refits_in_the_loop(rows, monkeypatch):
    alone = models.fit(rows, models.LINEAR_SVM, {"C": 1.0})

    def refused(*_):
        raise AssertionError("fitted one by one")

    monkeypatch.setattr(models, "fit", refused)
    best = search.search(rows, models.LINEAR_SVM, [{"C": 1.0}]).best
    both = best.score(rows).join(alone.score(rows).select("row_id", F.col("pred").alias("single")), "row_id").collect()
    assert best.params == {"C": 1.0} and len(both) == 600 and not best.has_probabilities
    assert sum(r["pred"] == r["single"] for r in both) >= 0.97 * 600
