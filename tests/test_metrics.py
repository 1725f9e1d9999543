from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from meridia.operators import metrics, stats, tables
from meridia.plans import reports, study

CLASSES = ["High", "Low", "Medium"]
# Confusion matrices (rows actual, columns predicted) and the scores published for them.
PUBLISHED = {
    "II logistic": ([[105, 0, 0], [0, 97, 2], [3, 3, 100]], (0.9742, 0.9742, 0.9744, 0.9741, 0.9741)),
    "II forest": ([[104, 0, 1], [0, 99, 0], [1, 1, 104]], (0.9903, 0.9903, 0.9905, 0.9904, 0.9903)),
    "II boosting": ([[103, 0, 2], [0, 99, 0], [0, 1, 105]], (0.9903, 0.9904, 0.9905, 0.9904, 0.9903)),
    "II linear": ([[105, 0, 0], [0, 97, 2], [4, 3, 99]], (0.9710, 0.9712, 0.9713, 0.9709, 0.9708)),
    "II rbf": ([[104, 0, 1], [0, 97, 2], [4, 4, 98]], (0.9645, 0.9646, 0.9649, 0.9645, 0.9643)),
    "II mlp": ([[104, 0, 1], [0, 97, 2], [5, 1, 100]], (0.9710, 0.9716, 0.9712, 0.9712, 0.9709)),
    "III logistic": ([[104, 0, 1], [0, 97, 2], [0, 3, 103]], (0.9806, 0.9806, 0.9807, 0.9806, 0.9807)),
    "III linear": ([[104, 0, 1], [0, 98, 1], [0, 3, 103]], (0.9839, 0.9837, 0.9840, 0.9838, 0.9839)),
    "III mlp": ([[104, 0, 1], [0, 98, 1], [4, 2, 100]], (0.9742, 0.9745, 0.9746, 0.9743, 0.9741)),
}


def _rows(matrix):
    return [(a, p) for i, a in enumerate(CLASSES) for j, p in enumerate(CLASSES) for _ in range(matrix[i][j])]


@pytest.fixture(scope="module")
def published(spark):
    rows = [(m, a, p) for m, (matrix, _) in PUBLISHED.items() for a, p in _rows(matrix)]
    return spark.createDataFrame(rows, "model string, y string, pred string").repartition(6).cache()


def test_published_scores(published):
    got = {r["model"]: r for r in metrics.classification_metrics(published, by=["model"]).collect()}
    names = ["accuracy", "precision_macro", "recall_macro", "f1_macro", "f1_weighted"]
    for model, (_, scores) in PUBLISHED.items():
        assert [got[model][n] for n in names] == pytest.approx(scores, abs=1e-4)


def test_published_class_report_text(published):
    report = metrics.classification_report(published.where("model = 'II logistic'"), by=["model"])
    lines = [r["text"] for r in reports.class_reports(report, {"II logistic": []}).orderBy("line_no").collect()]
    assert lines[3:12] == [
        "              precision    recall  f1-score   support",
        "",
        "        High       0.97      1.00      0.99       105",
        "         Low       0.97      0.98      0.97        99",
        "      Medium       0.98      0.94      0.96       106",
        "",
        "    accuracy                           0.97       310",
        "   macro avg       0.97      0.97      0.97       310",
        "weighted avg       0.97      0.97      0.97       310",
    ]


def test_confusion_has_empty_cells(published):
    cells = metrics.confusion_matrix(published.where("model = 'II forest'"), CLASSES, by=["model"])
    got = {(r["actual"], r["predicted"]): r["row_count"] for r in cells.collect()}
    assert len(got) == 9 and got["High", "Low"] == 0 and got["Medium", "Medium"] == 104
    wide = metrics.confusion_wide(cells, CLASSES, by=["model"]).orderBy("actual").collect()
    assert [[r[c] for c in CLASSES] for r in wide] == PUBLISHED["II forest"][0]


def test_a_class_that_is_never_predicted_scores_zero(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "d")], "y string, pred string")
    got = metrics.classification_metrics(df).first()
    assert got["precision_macro"] == pytest.approx(0.5 / 4)
    assert got["recall_macro"] == pytest.approx(1 / 4)


def _auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    d = pos[:, None] - neg[None, :]
    return ((d > 0) + 0.5 * (d == 0)).mean()


def test_roc_against_brute_force_with_ties(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400)
    s = np.round(np.clip(0.3 * y + rng.random(400) * 0.7, 0, 1), 2)
    df = spark.createDataFrame([("p" if a else "n", float(b), 1 - float(b)) for a, b in zip(y, s)], "y string, p double, n double")
    curve = metrics.roc_curve(df, {"p": "p", "n": "n"})
    got = {r["class"]: r["auc"] for r in metrics.auc_per_class(curve).collect()}
    assert got["p"] == pytest.approx(_auc(y, s)) and got["n"] == pytest.approx(got["p"])
    moved = metrics.roc_curve(df.withColumn("p", F.pow("p", F.lit(3.0))), {"p": "p"})
    assert metrics.roc_auc_macro(moved).first()[0] == pytest.approx(got["p"])
    fpr, tpr = [0.0], [0.0]
    for cut in sorted(set(s), reverse=True):
        fpr.append(((s >= cut) & (y == 0)).sum() / (y == 0).sum())
        tpr.append(((s >= cut) & (y == 1)).sum() / (y == 1).sum())
    grid = np.linspace(0, 1, 50)
    points = metrics.roc_interpolated(metrics.roc_curve(df, {"p": "p"}), 50).orderBy("point").collect()
    assert [r["tpr"] for r in points] == pytest.approx(np.interp(grid, fpr, tpr), abs=1e-9)


def test_auc_is_null_for_a_single_class(spark):
    df = spark.createDataFrame([("a", 0.2), ("a", 0.4)], "y string, p double")
    assert metrics.roc_auc_macro(metrics.roc_curve(df, {"a": "p"})).first()[0] is None


def test_calibration_edges(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 0.9), ("b", 0.0)], "y string, p double")
    got = {r["bin"]: r for r in metrics.calibration_curve(df, {"a": "p"}).collect()}
    assert set(got) == {0, 5} and got[5]["row_count"] == 2 and got[0]["fraction_positive"] == 0.0


@pytest.mark.parametrize(
    "diffs, expected",
    [
        ([1, 2, 3, 4, 5], (15, 0.03125)),
        ([1, 2, 3, 4, 0], (10, 0.0625)),
        ([1, 0, 0, 0, 0], (1, 0.5)),
        ([0, 0, 0], (None, None)),
    ],
)
def test_published_signed_ranks(spark, diffs, expected):
    df = spark.createDataFrame([("m", float(d), 0.0) for d in diffs], "model string, x double, y double")
    got = stats.wilcoxon_test(df, ["model"]).first()
    assert (got["statistic"], got["p_value"]) == expected and got["pairs"] == len(diffs)


def test_signed_ranks_against_enumeration_with_ties(spark):
    diffs = [0.5, -0.5, 1.0, 2.0, 2.0, -3.0, 4.0]
    df = spark.createDataFrame([("m", d, 0.0) for d in diffs], "model string, x double, y double")
    got = stats.wilcoxon_test(df, ["model"]).first()
    size = sorted(abs(d) for d in diffs)
    ranks = [np.mean([i + 1 for i, s in enumerate(size) if s == abs(d)]) for d in diffs]
    w = sum(r for r, d in zip(ranks, diffs) if d > 0)
    sums = [sum(r for i, r in enumerate(ranks) if m >> i & 1) for m in range(2**7)]
    assert got["statistic"] == w and got["p_value"] == pytest.approx(np.mean([s >= w for s in sums]))


def test_signed_ranks_of_many_pairs_use_the_normal_limit(spark):
    df = spark.range(400).select(
        F.lit("m").alias("model"), (F.col("id") % 7 - 2).cast("double").alias("x"), F.lit(0.0).alias("y")
    )
    got = stats.wilcoxon_test(df, ["model"], method="normal").first()
    d = np.array([i % 7 - 2 for i in range(400)], dtype=float)
    d = d[d != 0]
    order = np.sort(np.abs(d))
    ranks = np.array([(np.searchsorted(order, a) + np.searchsorted(order, a, "right") + 1) / 2 for a in np.abs(d)])
    n, w = len(d), ranks[d > 0].sum()
    _, t = np.unique(np.abs(d), return_counts=True)
    z = (w - n * (n + 1) / 4) / math.sqrt(n * (n + 1) * (2 * n + 1) / 24 - (t**3 - t).sum() / 48)
    assert got["p_value"] == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)), rel=1e-9)


@pytest.mark.parametrize("b, c", [(0, 0), (3, 0), (5, 5), (2, 9), (1400, 1500)])
def test_mcnemar_exact(spark, b, c):
    table = spark.createDataFrame([(307, b, c, 3)], "both_right long, only_second_right long, only_first_right long, both_wrong long")
    got = stats.mcnemar_test(table).first()
    n, k = b + c, min(b, c)
    tail = sum(math.comb(n, i) for i in range(k + 1)) * 2 / 2**n
    assert got["statistic"] == k and got["p_value"] == pytest.approx(min(1.0, tail), rel=1e-9)
    if (b, c) == (0, 0):
        assert got["verdict"] == "none"


def test_published_deltas(spark):
    now = spark.createDataFrame(
        [
            ("Logistic Regression", 0.9872, 0.9806, 0.9806),
            ("Random Forest", 0.9984, 0.9903, 0.9904),
            ("Gradient Boosting", 0.9992, 0.9903, 0.9904),
            ("SVM (Linear)", 0.9904, 0.9839, 0.9838),
            ("Neural Network (MLP)", 0.9871, 0.9742, 0.9743),
            ("New", 0.9, 0.9, 0.9),
        ],
        "model string, cv_f1_macro double, accuracy double, f1_macro double",
    )
    got = tables.phase_comparison(now, study.earlier_results(now), ["cv_f1_macro", "accuracy", "f1_macro"], "f1_macro")
    rows = {r["model"]: r for r in got.collect()}
    assert {m: r["delta_f1_macro"] for m, r in rows.items()} == {
        "Logistic Regression": "+0.0065", "Random Forest": "+0.0", "Gradient Boosting": "+0.0",
        "SVM (Linear)": "+0.0129", "Neural Network (MLP)": "+0.0031", "New": "+0.9",
    }
    assert rows["New"]["before_f1_macro"] == "-" and rows["SVM (Linear)"]["before_accuracy"] == "0.9710"


def test_best_model_takes_the_first_of_a_tie(spark):
    df = spark.createDataFrame([("a", 0.5, 0), ("b", 0.9, 1), ("c", 0.9, 2)], "model string, f1 double, place int")
    assert stats.best_model(df, "f1", "place").first()["best_model"] == "b"


def _counted(ranks: list[tuple[int, int]], at_least: int) -> float:
    """Share of all signs with at least that sum, in whole numbers."""
    ways = {0: 1}
    for rank, n in ranks:
        for _ in range(n):
            more = dict(ways)
            for total, count in ways.items():
                more[total + rank] = more.get(total + rank, 0) + count
            ways = more
    signs = 2 ** sum(n for _, n in ranks)
    return sum(c for total, c in ways.items() if total >= at_least) / signs


@pytest.mark.parametrize(
    "ranks", [[(2, 1)], [(3, 2), (6, 1)], [(2 * i, 1) for i in range(1, 60)], [(11, 10), (31, 10), (50, 9)], [(101, 100)]]
)
def test_signed_ranks_against_counting(ranks):
    made = stats._positive_ranks(ranks)
    whole = sum(r * n for r, n in ranks)
    for at in {0, 1, whole // 3, whole // 2, whole * 3 // 4, whole}:
        assert made.chances[max(0, at - made.first) :].sum() == pytest.approx(_counted(ranks, at), rel=1e-9)


def _p(ranks, doubled, method="exact"):
    n = sum(c for _, c in ranks)
    ties = [{"mid": r / 2, "n": c} for r, c in ranks]
    if method == "normal":
        ties = [{"mid": float(sum(c**3 - c for _, c in ranks)), "n": 0}]
    columns = [[n], [doubled / 2], [ties], [method == "exact"]]
    return stats._signed_rank_p(*map(pd.Series, columns))[0]


@pytest.mark.parametrize(("n", "copies"), [(1023, 1), (1024, 1), (5000, 1), (40, 50), (2, 3000)])
def test_long_signed_rank_tests(n, copies):
    ranks = [(2 * copies * i + copies + 1, copies) for i in range(n)]
    signs = np.random.default_rng(n).binomial(copies, 0.51, n)
    doubled = sum(r * int(s) for (r, _), s in zip(ranks, signs))
    exact, normal = _p(ranks, doubled), _p(ranks, doubled, "normal")
    if n <= 1024 and n * copies <= 2000:
        assert exact == pytest.approx(_by_floats(ranks, doubled), rel=1e-9)
    # the limit is off by about half the chance of the sum itself, and by more where there are few ranks
    assert exact == pytest.approx(normal, abs=2e-4 if n > 100 else 1e-2)


@pytest.mark.parametrize(("n", "copies"), [(600, 1), (40, 50), (2, 3000)])
def test_both_tails_add_up(n, copies):
    ranks = [(2 * copies * i + copies + 1, copies) for i in range(n)]
    made = stats._positive_ranks(ranks)
    whole = sum(r * c for r, c in ranks)
    assert made.chances.sum() == pytest.approx(1.0, abs=1e-9)
    assert made.first + len(made.chances) - 1 == whole - made.first or len(made.chances) < whole
    assert (made.chances * (made.first + np.arange(len(made.chances)))).sum() == pytest.approx(whole / 2)


def test_a_group_of_many_pairs(spark):
    rows = [(float(d if d % 7 % 2 else -d), 0.0) for d in range(1, 1101)]
    found = stats.wilcoxon_test(spark.createDataFrame(rows, "x double, y double"), []).first()
    assert found["used"] == 1100 and found["statistic"] == sum(d for d in range(1, 1101) if d % 7 % 2)
    assert found["p_value"] == pytest.approx(_p([(2 * i, 1) for i in range(1, 1101)], 2 * found["statistic"]), rel=1e-9)


def _by_floats(ranks, at_least):
    chances = np.array([1.0])
    for rank, n in ranks:
        for _ in range(n):
            chances = (np.pad(chances, (0, rank)) + np.pad(chances, (rank, 0))) / 2
    return chances[int(round(at_least)) :].sum()
