from __future__ import annotations

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from meridia.operators import curves, encode, explain, models, search, shapley, split


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(240, 4))
    y = np.where(x[:, 0] > 0.5, "hi", np.where(x[:, 1] > 0, "mid", "low"))
    data = [(i, [float(v) for v in r], str(c)) for i, (r, c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(data, "row_id long, x array<double>, label string")
    df = split.stratified_kfold(df.withColumn("features", array_to_vector("x")), "label", "row_id", 2)
    return df.persist()


def _accuracy(made, df):
    return made.score(df).agg(F.avg((F.col("pred") == F.col("label")).cast("int"))).first()[0]


@pytest.mark.parametrize(
    "name, params",
    [
        (models.LOGISTIC, {"C": 10, "max_iter": 30}),
        (models.FOREST, {"n_estimators": 10, "max_depth": 4, "min_samples_split": 2}),
        (models.BOOSTING, {"n_estimators": 5, "max_depth": 2}),
        (models.LINEAR_SVM, {"max_iter": 10}),
        (models.RBF_SVM, {"gamma": "scale", "components": 32, "max_iter": 10}),
        (models.NETWORK, {"hidden_layer_sizes": [6], "max_iter": 40}),
    ],
)
def test_every_model_beats_the_majority(rows, name, params):
    made = models.fit(rows, name, params)
    common = models.majority(rows, "label")
    base = rows.agg(F.avg((F.col("label") == common).cast("int"))).first()[0]
    assert _accuracy(made, rows) > base + 0.15
    if made.has_probabilities:
        total = sum((F.col(p) for p in made.probability_columns().values()), F.lit(0.0))
        low, high = made.score(rows).agg(F.min(total), F.max(total)).first()
        assert low == pytest.approx(1) and high == pytest.approx(1)


def test_platt_scaling_gives_probabilities(rows):
    made = models.platt_scaling(rows, models.LINEAR_SVM, {"max_iter": 5})
    scored = made.score(rows).collect()
    assert all(sum(r[f"p_{c}"] for c in made.classes) == pytest.approx(1) for r in scored)


def test_a_parameter_without_counterpart_is_refused():
    shape = models.Shape(10, 2, ["a", "b"])
    for name, params in [
        (models.FOREST, {"min_samples_split": 5}),
        (models.NETWORK, {"alpha": 0.1}),
        (models.LOGISTIC, {"penalty": "l1"}),
    ]:
        with pytest.raises(ValueError, match="no Spark counterpart"):
            models.build_estimator(name, params, shape)


def test_logistic_strength_follows_the_row_count():
    shape = models.Shape(200, 2, ["a", "b"])
    assert models.build_estimator(models.LOGISTIC, {"C": 0.5}, shape).getRegParam() == pytest.approx(0.01)


def test_kernel_features_approximate_the_kernel(rows):
    x = rows.limit(20).orderBy("row_id")
    made = models.FourierFeatures(width=4, gamma=0.3, components=4000).transform(x).collect()
    z = np.array([r["kernel_features"].toArray() for r in made])
    a = np.array([r["x"] for r in made])
    exact = np.exp(-0.3 * ((a[:, None] - a[None]) ** 2).sum(axis=2))
    assert np.abs(z @ z.T - exact).max() < 0.1


def test_search_keeps_the_best_and_refits(rows):
    found = search.search(rows, models.FOREST, [{"max_depth": 1}, {"max_depth": 5}], fixed={"n_estimators": 5})
    assert found.best.params["max_depth"] == 5 and found.best_score == found.scores[1]
    table = found.table(rows.sparkSession).collect()
    assert [r["params"] for r in table] == ['{"max_depth": 1}', '{"max_depth": 5}']


def test_draw_without_replacement():
    grid = search.RANDOM_PRESET[models.BOOSTING]
    assert len(search.expand_grid(grid)) == 400
    drawn = search.draw(grid, 30)
    assert len({str(d) for d in drawn}) == 30 and drawn == search.draw(grid, 30)
    assert len(search.draw({"C": [1, 2]}, 30)) == 2


def test_forest_keeps_nodes_between_levels_and_grows_the_same_trees(rows):
    shape = models.describe(rows, "label")
    kept = models.build_estimator(models.FOREST, {"n_estimators": 5}, shape)
    assert kept.getCacheNodeIds()
    indexed = models.with_label_index(rows, "label", shape.classes)
    walked = kept.copy().setCacheNodeIds(False)
    # the first line of a tree has an id of its own
    first, second = ([t.toDebugString.split("\n")[1:] for t in e.fit(indexed).trees] for e in (kept, walked))
    assert first == second


def test_out_of_fold_covers_every_row_once(rows):
    part = search.out_of_fold(rows, models.FOREST, {"n_estimators": 3, "max_depth": 3}, "row_id")
    assert part.count() == part.select("row_id").distinct().count() == 240
    assert search.fold_scores(part).count() == 2


def test_preprocessor_scales_by_population_spread_and_ignores_new_levels(spark):
    train = spark.createDataFrame([(1.0, 2, "a"), (3.0, 2, "b"), (8.0, 2, "b")], "v double, c int, s string")
    test = spark.createDataFrame([(4.0, 3, "new")], "v double, c int, s string")
    made = encode.fit_preprocessor(train, ["v", "c"], ["s"])
    assert made.names == ["numeric__v", "numeric__c", "categorical__s_a", "categorical__s_b"]
    got = made.apply(test).first()["features"].toArray()
    assert got == pytest.approx([0.0, 1.0, 0.0, 0.0])
    x = np.array([r["features"].toArray()[0] for r in made.apply(train).collect()])
    assert x.std() == pytest.approx(1.0)


def _paths(leaves):
    """(conditions, value) of every leaf."""
    ends = np.cumsum(leaves.sizes)
    conditions = list(zip(leaves.feature, leaves.low, leaves.high, leaves.share))
    return [(conditions[e - s : e], v) for e, s, v in zip(ends, leaves.sizes, leaves.value)]


@pytest.mark.parametrize("name, params", [(models.FOREST, {"n_estimators": 3, "max_depth": 3}), (models.BOOSTING, {"n_estimators": 2, "max_depth": 2})])
def test_tree_shap_against_brute_force(rows, name, params):
    made = models.fit(rows, name, params)
    few = rows.limit(6)
    got = {}
    values = shapley.tree_shap(made, few, ["f0", "f1", "f2", "f3"], "row_id").collect()
    for r in values:
        got[r["row_id"], r["class"], int(r["feature"][1])] = (r["shap"], r["base"])
    outputs = len(made.classes)
    leaves = _paths(shapley.Leaves.read(shapley.ensemble_leaves(made).toArrow(), outputs))
    for row in few.collect():
        x = np.array(row["x"])

        def worth(inside):
            total = np.zeros(outputs)
            for leaf in leaves:
                part = 1.0
                for f, low, high, share in leaf[0]:
                    part *= float(low < x[f] <= high) if f in inside else share
                total = total + part * leaf[1]
            return total

        for f in range(4):
            rest = [j for j in range(4) if j != f]
            phi = np.zeros(outputs)
            for size in range(4):
                w = math.factorial(size) * math.factorial(3 - size) / 24
                for s in itertools.combinations(rest, size):
                    phi += w * (worth({*s, f}) - worth(set(s)))
            for c, k in enumerate(made.classes):
                assert got[row["row_id"], k, f][0] == pytest.approx(phi[c], abs=1e-9)
    scored = {r["row_id"]: r for r in made.score(few).collect()}
    for (row_id, k, f), (_, base) in got.items():
        if f == 0:
            total = base + sum(got[row_id, k, j][0] for j in range(4))
            output = scored[row_id][f"p_{k}"]
            if name == models.FOREST:
                assert total == pytest.approx(output, abs=1e-9)
            else:
                others = [base_k + sum(got[row_id, j, i][0] for i in range(4)) for j in made.classes for base_k in [got[row_id, j, 0][1]]]
                each = [1 / (1 + math.exp(-2 * m)) for m in others]
                assert output == pytest.approx((1 / (1 + math.exp(-2 * total))) / sum(each), abs=1e-9)


def test_importances_and_selection(rows):
    chosen = explain.select_features(rows, ["f0", "f1", "f2", "f3"], factor=0.9, params={"n_estimators": 10, "max_depth": 4})
    table = {r["feature"]: r for r in chosen.table.collect()}
    assert sum(r["importance"] for r in table.values()) == pytest.approx(1.0)
    assert chosen.kept == ["f0", "f1"]
    assert len(chosen.apply(rows).first()["features"]) == 2


def test_learning_curve_sizes_and_summary(rows):
    made = curves.learning_curve(rows, models.FOREST, {"n_estimators": 2, "max_depth": 2}, "row_id", shares=[0.2, 1.0])
    got = made.collect()
    assert {(r["point"], r["fold"], r["split"]) for r in got} == set(itertools.product((0, 1), (0, 1), ("train", "validation")))
    assert sum(r["row_count"] for r in got if r["split"] == "train" and r["point"] == 1) == 240
    assert curves.curve_summary(made).count() == 4


def test_network_progress_stops(rows):
    got = curves.network_progress(rows, "row_id", hidden=(4,), step=5, max_iter=60, patience=2).collect()
    losses = [r["loss"] for r in got]
    assert losses[-1] < losses[0]
    assert [r["iteration"] for r in got] == list(range(got[0]["iteration"], got[0]["iteration"] + len(got)))
    judged = [r["validation_accuracy"] for r in got if r["validation_accuracy"] is not None]
    assert 1 <= len(judged) < len(got) and all(0 <= a <= 1 for a in judged)


def test_softmax_boosting_follows_the_multinomial_deviance(rows):
    """Losses fall every round, and a round of stumps equals the same round worked out by hand."""
    y = np.array([r["label"] for r in rows.orderBy("row_id").collect()])
    losses = []
    for n in (1, 3, 6):
        made = models.fit(rows, models.SOFTMAX_BOOSTING, {"n_estimators": n, "max_depth": 2, "learning_rate": 0.3})
        scored = made.score(rows).orderBy("row_id").collect()
        losses.append(-np.mean([math.log(r[f"p_{c}"]) for r, c in zip(scored, y)]))
    assert losses[0] > losses[1] > losses[2]
    one = models.fit(rows, models.SOFTMAX_BOOSTING, {"n_estimators": 1, "max_depth": 1, "learning_rate": 1.0})
    share = {c: (y == c).mean() for c in one.classes}
    x = np.array([r["x"] for r in rows.orderBy("row_id").collect()])

    def leaves_of(made, tree):
        bins = np.stack([np.searchsorted(e, x[:, i], side="left") for i, e in enumerate(made.edges)], axis=1)
        return tree.leaf_of(bins, made.depth)

    for tree, c in zip(one.model.rounds[0], one.classes):
        r = (y == c) - share[c]
        leaf = leaves_of(one.model, tree)
        assert len(set(leaf)) == 2
        for value in set(leaf):
            part = r[leaf == value]
            expected = 2 / 3 * part.sum() / (np.abs(part) * (1 - np.abs(part))).sum()
            assert tree.value[value] == pytest.approx(expected)
    stepped = made.model
    by_hand = np.tile(np.array(stepped.start), (len(x), 1))
    for trees in stepped.rounds:
        for i, tree in enumerate(trees):
            by_hand[:, i] += tree.value[leaves_of(stepped, tree)]
    walked = np.array([r["rawPrediction"].toArray() for r in stepped.transform(rows).orderBy("row_id").collect()])
    assert walked == pytest.approx(by_hand)
    sampled = models.fit(rows, models.SOFTMAX_BOOSTING, {"n_estimators": 2, "max_depth": 2, "subsample": 0.5})
    assert _accuracy(sampled, rows) > 0.6
    found = search.search(rows, models.SOFTMAX_BOOSTING, [{"max_depth": 1}, {"max_depth": 2}], fixed={"n_estimators": 1})
    assert len(found.scores) == 2 and found.best.has_probabilities
