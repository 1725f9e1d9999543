"""Forests of a search share their trees; every candidate is judged as if it had been grown alone."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from meridia.operators import forests, models, search, shapley, split


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 5))
    x[:, 4] = x[:, 4] > 0
    y = np.where(x[:, 0] + 0.7 * rng.normal(size=300) > 0.5, "hi", np.where(x[:, 1] + x[:, 4] > 0.5, "mid", "low"))
    data = [(i, [float(v) for v in r], str(c)) for i, (r, c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(data, "row_id long, x array<double>, label string")
    return split.stratified_kfold(df.withColumn("features", array_to_vector("x")), "label", "row_id", 2).persist()


def test_depths_cut_from_one_forest_score_like_forests_of_their_own(monkeypatch, rows):
    # without drawn features a forest depends on its rows alone, so a shallower one is the deeper one cut off
    candidates = [{"max_depth": d} for d in (2, None, 1)]
    fixed = {"n_estimators": 5, "max_features": "all", "min_samples_leaf": 2}
    shared = search.search(rows, models.FOREST, candidates, fixed=fixed)
    monkeypatch.setattr(forests, "shareable", lambda *args: False)
    alone = search.search(rows, models.FOREST, candidates, fixed=fixed)
    assert shared.scores == pytest.approx(alone.scores, abs=1e-12)
    assert shared.spreads == pytest.approx(alone.spreads, abs=1e-12)
    assert shared.best.params == alone.best.params


def test_one_forest_is_grown_for_candidates_that_differ_in_trees_and_depth(monkeypatch, rows):
    grown = []
    grow = forests.grow

    def counted(indexed, params, shape, seed):
        grown.append(params)
        return grow(indexed, params, shape, seed)

    monkeypatch.setattr(forests, "grow", counted)
    candidates = [{"n_estimators": n, "max_depth": d, "min_samples_leaf": m} for n in (2, 4) for d in (2, 3) for m in (1, 2)]
    found = search.search(rows, models.FOREST, candidates)
    assert [(g["n_estimators"], g["max_depth"], g["min_samples_leaf"]) for g in grown] == [(4, 3, 1)] * 2 + [(4, 3, 2)] * 2
    assert len(found.scores) == 8 and all(0.3 < s <= 1 for s in found.scores)


@pytest.mark.parametrize("nominal", [False, True])
def test_first_trees_at_a_depth_predict_like_sparks_own(rows, nominal):
    """Slots marked as codes of two values are split by value, not by size."""
    marks = {"ml_attr": {"attrs": {"numeric": [{"idx": i} for i in range(4)], "binary": [{"idx": 4}]}, "num_attrs": 5}}
    marked = rows.withColumn("features", F.col("features").alias("features", metadata=marks)) if nominal else rows
    assert forests.shareable(models.FOREST, marked)
    made = models.fit(marked, models.FOREST, {"n_estimators": 6})
    trees = forests.Trees.read(shapley.tree_nodes(made).toArrow(), 3)
    kept = marked.orderBy("row_id").collect()
    x = np.array([r["x"] for r in kept])
    found = dict(trees.predictions(x, [30], trees.answers([30]), {3, 6}))
    own = [r["prediction"] for r in made.model.transform(marked).orderBy("row_id").collect()]
    assert found[6][0].tolist() == own and set(found) == {3, 6}
    votes = np.array([[t.predictProbability(r["features"]).toArray() for t in made.model.trees[:3]] for r in kept[:40]])
    assert found[3][0][:40].tolist() == votes.sum(1).argmax(1).tolist()


def test_large_forests_grow_in_parts(monkeypatch, rows):
    monkeypatch.setattr(forests, "PAIRS_AT_ONCE", 1)
    monkeypatch.setattr(forests, "FEWEST", 2)
    shape = models.describe(rows, "label")
    indexed = models.with_label_index(rows, "label", shape.classes)
    trees = forests.grow(indexed, {"n_estimators": 5, "max_depth": 3}, shape, 42)
    ends = [*trees.roots[1:], len(trees.cut)]
    assert len(trees.roots) == 5
    parts = [tuple(trees.cut[a:b]) for a, b in zip(trees.roots, ends)]
    assert len(set(parts)) == 5
    for a, b in zip(trees.roots, ends):
        assert trees.kids[2 * a : 2 * b].min() >= a and trees.kids[2 * a : 2 * b].max() < b


def test_rows_without_a_fold_and_wider_codes_are_not_passed_over(rows):
    holed = rows.withColumn("fold", F.when(F.col("row_id") > 3, F.col("fold")))
    with pytest.raises(ValueError, match="4 rows"):
        search.search(holed, models.FOREST, [{"max_depth": 1}], fixed={"n_estimators": 2})
    marks = {"ml_attr": {"attrs": {"nominal": [{"idx": 4, "vals": ["a", "b", "c"]}]}, "num_attrs": 5}}
    assert not forests.shareable(models.FOREST, rows.withColumn("features", F.col("features").alias("features", metadata=marks)))
