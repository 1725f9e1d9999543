from __future__ import annotations

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from meridia.operators import models, shapley

NAMES = [f"f{i}" for i in range(12)]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 12))
    y = np.where(x[:, :4].sum(1) + rng.normal(size=400) > 0.5, "hi", np.where(x[:, 4:].sum(1) > 0, "mid", "low"))
    data = [(i, [float(v) for v in r], str(c)) for i, (r, c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(data, "row_id long, x array<double>, label string")
    return df.withColumn("features", array_to_vector("x")).persist()


@pytest.fixture(scope="module")
def forest(rows):
    return models.fit(rows, models.FOREST, {"n_estimators": 200, "max_depth": 10})


def _table(df):
    return {(r["row_id"], r["class"], r["feature"]): r for r in df.collect()}


def test_quadrature_equals_sum_over_coalitions():
    rng = np.random.default_rng(1)
    for d in range(1, 9):
        share = rng.uniform(0.01, 0.99, d)
        flags = rng.integers(0, 2, (5, d))
        want = np.zeros((5, d))
        for row, f in itertools.product(range(5), range(d)):
            rest = [j for j in range(d) if j != f]
            for size in range(d):
                weight = math.factorial(size) * math.factorial(d - 1 - size) / math.factorial(d)
                for inside in itertools.combinations(rest, size):
                    part = math.prod(flags[row, j] if j in inside else share[j] for j in rest)
                    want[row, f] += weight * part * (flags[row, f] - share[f])
        assert shapley.leaf_values(flags, share) == pytest.approx(want, abs=1e-12)


def test_thirty_conditions_add_up():
    rng = np.random.default_rng(3)
    share = rng.uniform(0.05, 1.0, 30)
    flags = rng.integers(0, 2, (50, 30))
    flags[0] = 1
    total = shapley.leaf_values(flags, share).sum(1) + share.prod()
    assert total == pytest.approx(flags.prod(1), abs=1e-12)


def test_large_forest_adds_up_and_parts_equal_broadcast(spark, rows, forest):
    few = rows.where("row_id < 40")
    size = shapley.ensemble_leaves(forest).agg(F.sum("bytes")).first()[0]
    whole = _table(shapley.tree_shap(forest, few, NAMES, "row_id"))
    parts = _table(shapley.tree_shap(forest, few.repartition(3), NAMES, "row_id", shared_bytes=0, part_bytes=size // 5))
    assert set(parts) == set(whole) and len(whole) == 40 * 12 * 3
    for k, r in whole.items():
        assert parts[k]["shap"] == pytest.approx(r["shap"], abs=1e-9)
        assert parts[k]["feature_value"] == r["feature_value"]
    for r in forest.score(few).collect():
        for c in forest.classes:
            mine = [whole[r["row_id"], c, f] for f in NAMES]
            assert mine[0]["base"] + sum(m["shap"] for m in mine) == pytest.approx(r[f"p_{c}"], abs=1e-9)


def test_many_row_blocks_meet_every_part(rows, forest, monkeypatch):
    monkeypatch.setattr(shapley, "ROWS_A_BLOCK", 7)
    monkeypatch.setattr(shapley, "BLOCKS_A_GROUP", 2)
    few = rows.where("row_id < 60")
    size = shapley.ensemble_leaves(forest).agg(F.sum("bytes")).first()[0]
    made = shapley.tree_shap(forest, few, NAMES, "row_id", shared_bytes=0, part_bytes=size // 3)
    assert made.count() == 60 * 12 * 3
    one = shapley.tree_shap(forest, few, NAMES, "row_id")
    off = made.join(one.select("row_id", "class", "feature", F.col("shap").alias("other")), ["row_id", "class", "feature"])
    assert off.where(F.abs(F.col("shap") - F.col("other")) > 1e-9).count() == 0


@pytest.mark.parametrize("shared_bytes", [shapley.SHARED_BYTES, 0])
def test_repeated_null_and_absent_rows(spark, rows, forest, shared_bytes):
    one = rows.where("row_id = 1")
    odd = one.unionAll(one).unionAll(one.withColumn("row_id", F.lit(None).cast("long")))
    odd = odd.unionAll(one.withColumn("features", F.lit(None).cast(one.schema["features"].dataType)))
    made = shapley.tree_shap(forest, odd, NAMES, "row_id", shared_bytes=shared_bytes)
    counts = {r["row_id"]: r["count"] for r in made.groupBy("row_id").count().collect()}
    assert counts == {1: 2 * 36, None: 36}
    assert shapley.tree_shap(forest, rows.where("false"), NAMES, "row_id", shared_bytes=shared_bytes).count() == 0


def test_missing_numbers_go_right(rows, forest):
    gap = rows.where("row_id < 3").withColumn("x", F.transform("x", lambda v: F.lit(float("nan"))))
    gap = gap.withColumn("features", array_to_vector("x"))
    made = shapley.tree_shap(forest, gap, NAMES, "row_id").groupBy("row_id", "class").agg(
        (F.sum("shap") + F.first("base")).alias("total")
    )
    want = {r["row_id"]: r for r in forest.score(gap).collect()}
    for r in made.collect():
        assert r["total"] == pytest.approx(want[r["row_id"]][f"p_{r['class']}"], abs=1e-9)


def test_other_models_are_refused(rows):
    made = models.fit(rows, models.LOGISTIC, {"max_iter": 3})
    with pytest.raises(ValueError):
        shapley.tree_shap(made, rows, NAMES, "row_id")
