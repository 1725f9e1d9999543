"""Edges that once gave wrong answers: odd numbers, lone classes, labels outside a list, caches, other folders."""

from __future__ import annotations

import math
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from meridia.functions.quantiles import exact_quantiles
from meridia.operators import balance, cluster, metrics, outliers, stats


def test_quantiles_leave_nan_out(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),), (None,), (2.0,)], "v double")
    assert exact_quantiles(df, ["v"], [0.0, 0.5, 1.0])["v"] == [1.0, 2.0, 3.0]
    wide = spark.createDataFrame([(1.0,), (math.inf,), (math.inf,)], "v double")
    assert exact_quantiles(wide, ["v"], [0.0, 0.75])["v"] == [1.0, math.inf]


def test_a_class_of_one_row_can_not_be_balanced_by_adasyn(spark):
    rows = [(i, "big", [float(i), 0.0]) for i in range(10)] + [(10, "one", [4.5, 0.1])]
    df = spark.createDataFrame(rows, "id long, y string, x array<double>")
    with pytest.raises(ValueError, match="one"):
        balance.adasyn(df, "y", "id", "x", neighbors=3)


def test_confusion_matrix_counts_every_row(spark):
    df = spark.createDataFrame([("a", "a"), ("z", "a"), (None, "b"), ("b", None)], "y string, pred string")
    cells = metrics.confusion_matrix(df, ["a", "b"]).collect()
    assert sum(r["row_count"] for r in cells) == 4
    assert {(r["actual"], r["predicted"]): r["row_count"] for r in cells if r["row_count"]} == {
        ("a", "a"): 1, (None, "a"): 1, (None, "b"): 1, ("b", None): 1,
    }
    assert {r["actual_order"] for r in cells if r["actual"] is None} == {2}


def test_mean_curve_is_null_when_a_class_has_one_side_only(spark):
    rows = [("a", 0.9, 0.1, 0.0), ("b", 0.2, 0.8, 0.0)]
    df = spark.createDataFrame(rows, "y string, pa double, pb double, pc double")
    curve = metrics.roc_curve(df, {"a": "pa", "b": "pb", "c": "pc"})
    assert metrics.roc_auc_macro(curve).first()[0] is None
    assert metrics.roc_interpolated(curve, 5).where("tpr IS NOT NULL").count() == 0
    two = metrics.roc_curve(df, {"a": "pa", "b": "pb"})
    assert metrics.roc_interpolated(two, 5).where("tpr IS NULL").count() == 0


def test_trees_are_sampled_from_the_whole_table(spark):
    df = spark.range(30_000).select(F.col("id").alias("k"), F.rand(3).alias("v"))
    nodes = outliers.isolation_trees(df, ["v"], "k", trees=60, sample=256).toPandas()
    assert nodes.groupby("tree")["sampled"].first().tolist() == [256] * 60
    small = outliers.isolation_trees(df.where("k < 300"), ["v"], "k", trees=5, sample=256).toPandas()
    assert set(small["sampled"]) == {256}


def test_signed_ranks_by_both_methods_agree_for_many_pairs(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([("m", float(v), 0.0) for v in rng.normal(0.1, 1, 90)], "model string, x double, y double")
    exact = stats.wilcoxon_test(df, ["model"]).first()["p_value"]
    limit = stats.wilcoxon_test(df, ["model"], method="normal").first()["p_value"]
    assert exact == pytest.approx(limit, abs=0.01)
    with pytest.raises(ValueError, match="unknown"):
        stats.wilcoxon_test(df, ["model"], method="other")


def test_ward_is_the_same_rule_for_few_and_many_rows(spark):
    rng = np.random.default_rng(10)
    for copies in (1, 20):
        x = [[float(v) for v in p] for c in (0, 5, 10) for p in rng.normal(c, 0.2, (30 * copies, 2))]
        df = spark.createDataFrame(list(enumerate(x)), "id long, x array<double>")
        rows = cluster.hierarchical(df, 3, "x", "id", micro=20).collect()
        assert len({(r["id"] // (30 * copies), r["cluster"]) for r in rows}) == 3


def test_functions_for_workers_work_from_another_folder(tmp_path):
    program = tmp_path / "program.py"
    program.write_text(
        "import sys\n"
        f"sys.path.insert(0, {str(Path(__file__).parents[1])!r})\n"
        "from meridia.session import local_session\n"
        "from meridia.operators import stats\n"
        "spark = local_session(2)\n"
        "t = spark.createDataFrame([(3, 2, 9, 1)],\n"
        "    'both_right long, only_second_right long, only_first_right long, both_wrong long')\n"
        "print('ANSWER', stats.mcnemar_test(t).first()['verdict'])\n"
    )
    got = subprocess.run([sys.executable, str(program)], cwd=tmp_path, capture_output=True, text=True, timeout=240)
    assert "ANSWER none" in got.stdout, got.stderr[-2000:]
