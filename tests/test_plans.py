from __future__ import annotations

import pytest

from meridia.operators import models
from meridia.plans import prepare, study
from meridia.session import materialize
from workload import views

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def features(spark):
    made = prepare.prepare(views.readings(spark, SF))
    assert made.flagged.where("outlier_consensus_flag = 1").count() < made.flagged.count() * 0.2
    text = "\n".join(r["text"] for r in made.report().orderBy("line_no").collect())
    assert "## Missing values" in text and "carbon_direct" in text
    assert made.monthly.count() > 12 and made.null_profile.count() == 7
    return materialize(made.features, "features")


FIXED = {
    models.LOGISTIC: {"max_iter": 15},
    models.FOREST: {"n_estimators": 5, "max_depth": 4},
    models.BOOSTING: {"n_estimators": 2},
}


def test_grid_study(spark, features, tmp_path):
    grids = {models.LOGISTIC: {"C": [0.1, 10]}, models.FOREST: {"max_features": ["sqrt"]}}
    made = study.grid_study(
        features,
        grids=grids,
        fixed=FIXED,
        shares=[1.0],
        strengths=[1.0],
        clusters=(2, 3),
        starts=1,
        curve_forest={"n_estimators": 2, "max_depth": 3},
        network_steps=10,
    )
    rows = {r["model"]: r for r in made.results.collect()}
    assert set(rows) == set(grids) and all(r["f1_macro"] > 0.6 for r in rows.values())
    assert made.dataset.strategy == "Skipped (already balanced)"
    assert made.tables["feature_importance"].count() == 15
    assert made.tables["learning_curve"].count() == 2 and made.tables["regularization_path"].count() == 2
    assert made.tables["elbow_and_silhouette"].count() == 2 and made.tables["network_progress"].count() >= 1
    for r in made.tables["clustering_results"].collect():
        assert -1 <= r["silhouette"] <= 1 and r["metric"] == "squared"
    study.write_study(made, str(tmp_path))
    text = "\n".join(r["value"] for r in spark.read.text(f"{tmp_path}/report").collect())
    assert "## Best model" in text and "Agglomerative (k=3)" in text
    both = spark.read.parquet(f"{tmp_path}/inputs/balanced")
    assert both.count() == features.count()


def test_random_study(spark, features):
    grids = {models.FOREST: {"max_features": ["sqrt", "log2"]}, models.LOGISTIC: {"C": [1.0]}}
    made = study.random_study(
        features, grids=grids, n_iter=2, fixed=FIXED, shares=[1.0], rates=[0.3], earlier_booster={"n_estimators": 1}
    )
    rows = {r["model"]: r for r in made.results.collect()}
    assert all(r["roc_auc_macro"] > 0.7 for r in rows.values())
    assert made.tables["fold_scores"].count() == 10
    assert made.tables["wilcoxon"].count() == 1
    assert 0 < len(made.selection.kept) <= len(made.selection.names)
    assert {r["model"] for r in made.tables["comparison"].collect()} == set(grids)
    assert made.tables["roc_interpolated"].count() == 400
    test = made.tables["mcnemar"].first()
    cells = ("both_right", "only_second_right", "only_first_right", "both_wrong")
    assert sum(test[c] for c in cells) == made.dataset.test.count()
    assert made.tables["learning_curve"].count() == 2 and made.tables["validation_curve"].count() == 2
    if made.best_row()["model"] == models.FOREST:
        assert made.tables["shap_importance"].count() == min(15, len(made.selection.kept))
    text = "\n".join(r["text"] for r in study.report(made).orderBy("line_no").collect())
    assert "## Fold scores compared" in text and "## Errors compared" in text and "features kept" in text


def test_entry_gives_one_row(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() == 1
