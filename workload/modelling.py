"""Queries that fit models. SQL can't fit them; it recomputes what any right fit must give: rows scored per
class, rows of every fold and subset, probabilities that add up, scores beyond the majority's share."""

from __future__ import annotations

import json

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meridia.operators import curves, encode, explain, metrics, models, prep, search, shapley
from meridia.plans import study

from . import views
from .judging import _SPLIT_SQL
from .registry import query

_TEST_SQL = f"{_SPLIT_SQL}, test AS (SELECT * FROM split WHERE split = 'test')"
# Train rows in folds; the classes are thirds, so balancing adds none.
_FOLDS_SQL = f"""{_SPLIT_SQL}, folded AS (
  SELECT row_id, target_quantile_class AS label,
         (row_number() OVER (PARTITION BY target_quantile_class ORDER BY md5('42:' || row_id), row_id) - 1) % 2 AS fold
  FROM split WHERE split = 'train'
), sizes_of AS (SELECT fold, label, count(*) AS n FROM folded GROUP BY ALL)"""


def _class_facts_sql(*names: str) -> str:
    listed = ", ".join(f"'{n}'" for n in names)
    return f"""WITH {_TEST_SQL}
    SELECT model, target_quantile_class AS class, count(*) AS support, (SELECT count(*) FROM test) AS scored_rows,
           0::BIGINT AS bad_probabilities, true AS beats_majority
    FROM test, (SELECT unnest([{listed}]) AS model) GROUP BY ALL"""


def _class_facts(scored: DataFrame, probabilities: list[str], label: str = "label") -> DataFrame:
    """Per model and class: rows, rows whose probabilities do not add up to 1, and whether the model's accuracy
    is a tenth above the share of the largest class."""
    total = sum((F.col(p) for p in probabilities[1:]), F.col(probabilities[0])) if probabilities else F.lit(1.0)
    # a model without probabilities has nulls
    below = F.least(*probabilities, F.lit(0.0), F.lit(0.0)) < 0
    off = (F.abs(total - 1) > 1e-6) | below if probabilities else F.lit(False)
    rows = scored.groupBy("model", F.col(label).alias("class")).agg(
        F.count("*").alias("support"),
        F.count_if(off).alias("bad_probabilities"),
        F.count_if(F.col("pred") == F.col(label)).alias("hits"),
    )
    of_model = Window.partitionBy("model")
    n = F.sum("support").over(of_model)
    better = F.sum("hits").over(of_model) / n > F.max("support").over(of_model) / n + 0.1
    return rows.select(
        "model", "class", "support", n.alias("scored_rows"), "bad_probabilities", better.alias("beats_majority")
    )


def _fitted_facts(made: models.Fitted, data: study.Dataset) -> DataFrame:
    columns = list(made.probability_columns().values()) if made.has_probabilities else []
    return _class_facts(made.score(data.test).withColumn("model", F.lit(made.name)), columns)


def _dataset(spark, sf_dir, folds: int = 2) -> study.Dataset:
    return study.build_dataset(
        views.labeled(spark, sf_dir).select("row_id", *prep.FEATURE_ORDER, prep.TARGET), folds=folds
    )


def _test_scores(made: models.Fitted, data: study.Dataset) -> DataFrame:
    scored = made.score(data.test)
    return metrics.classification_metrics(scored, "label", "pred").select(F.lit(made.name).alias("model"), "*")


def flagship(spark, sf_dir) -> DataFrame:
    """Readings to classes to a fitted classifier to its test scores."""
    data = _dataset(spark, sf_dir)
    return _test_scores(models.fit(data.train, models.LOGISTIC), data)


def _fit_query(key: str, name: str) -> None:
    @query(key, _class_facts_sql(name))
    def run(spark, sf_dir):
        data = _dataset(spark, sf_dir)
        return _fitted_facts(models.fit(data.train, name), data)


for _key, _name in {
    "fit_logreg": models.LOGISTIC,
    "fit_random_forest": models.FOREST,
    "fit_gbt": models.BOOSTING,
    "fit_linear_svm": models.LINEAR_SVM,
    "fit_rbf_svm": models.RBF_SVM,
    "fit_mlp": models.NETWORK,
}.items():
    _fit_query(_key, _name)


@query("fit_gbt_softmax", _class_facts_sql(models.SOFTMAX_BOOSTING))
def fit_gbt_softmax(spark, sf_dir):
    data = _dataset(spark, sf_dir)
    return _fitted_facts(models.fit(data.train, models.SOFTMAX_BOOSTING), data)


@query("platt_scaling", _class_facts_sql(models.LINEAR_SVM))
def platt_scaling(spark, sf_dir):
    data = _dataset(spark, sf_dir)
    made = models.platt_scaling(data.train, models.LINEAR_SVM, {})
    return _fitted_facts(made, data)


@query("score_table", _class_facts_sql(models.LOGISTIC, models.FOREST))
def score_table(spark, sf_dir):
    data = _dataset(spark, sf_dir)
    names = (models.LOGISTIC, models.FOREST)
    fitted = {n: models.fit(data.train, n) for n in names}
    columns = list(next(iter(fitted.values())).probability_columns().values())
    return _class_facts(search.score_table(fitted, data.test, "row_id"), columns, "y")


@query(
    "grid_search",
    """SELECT 'Random Forest' AS model, candidate, params, true AS scored
       FROM (VALUES (0, '{"max_depth": 2}'), (1, '{"max_depth": 5}')) AS t(candidate, params)""",
)
def grid_search(spark, sf_dir):
    data = _dataset(spark, sf_dir, folds=3)
    grid = search.expand_grid({"max_depth": [2, 5]})
    found = search.search(data.train, models.FOREST, grid, fixed={"n_estimators": 5})
    scored = ((F.col("cv_f1_macro") > 0.4) & (F.col("cv_f1_macro") <= 1)).alias("scored")
    return found.table(spark).select("model", "candidate", "params", scored)


_GRID_SQL = ", ".join(
    "('" + json.dumps(c, sort_keys=True) + "')" for c in search.expand_grid(search.RANDOM_PRESET[models.FOREST])
)


@query(
    "random_search",
    f"""SELECT 'Random Forest' AS model, params, true AS scored,
               CAST(row_number() OVER (ORDER BY md5('42:' || params), params) - 1 AS int) AS candidate
        FROM (VALUES {_GRID_SQL}) AS t(params) ORDER BY md5('42:' || params), params LIMIT {search.N_ITER}""",
)
def random_search(spark, sf_dir):
    data = _dataset(spark, sf_dir)
    drawn = search.draw(search.RANDOM_PRESET[models.FOREST])
    found = search.search(data.train, models.FOREST, drawn)
    scored = ((F.col("cv_f1_macro") > 0.4) & (F.col("cv_f1_macro") <= 1)).alias("scored")
    return found.table(spark).select("model", "candidate", "params", scored)


def _listed_sql(name: str, candidates: list[dict]) -> str:
    return ", ".join(f"('{name}', {i}, '{json.dumps(c)}')" for i, c in enumerate(candidates))


_LINEAR = (models.LOGISTIC, models.LINEAR_SVM)
_LINEAR_SQL = ", ".join(_listed_sql(n, search.expand_grid(search.GRID_PRESET[n])) for n in _LINEAR)


def _scored_candidates(found: search.SearchResult, spark) -> DataFrame:
    """Candidates with whether their scores, on folds and in the mean, can be those of a model that has learned."""
    scored = F.col("cv_f1_macro").between(0, 1) & (F.col("cv_f1_std") <= 0.5) & (F.max("cv_f1_macro").over(Window.partitionBy("model")) > 0.4)
    return found.table(spark).select("model", "candidate", "params", scored.alias("scored"))


@query(
    "grid_search_linear",
    f"SELECT model, candidate, params, true AS scored FROM (VALUES {_LINEAR_SQL}) AS t(model, candidate, params)",
)
def grid_search_linear(spark, sf_dir):
    """Both linear models over the whole grid preset, each in one loop."""
    data = _dataset(spark, sf_dir, folds=3)
    found = [search.search(data.train, n, search.expand_grid(search.GRID_PRESET[n])) for n in _LINEAR]
    return _scored_candidates(found[0], spark).unionByName(_scored_candidates(found[1], spark))


_DRAWN_SQL = ", ".join(
    "('" + json.dumps(c, sort_keys=True) + "')" for c in search.expand_grid(search.RANDOM_PRESET[models.LOGISTIC])
)


@query(
    "random_search_linear",
    f"""SELECT '{models.LOGISTIC}' AS model, params, true AS scored,
               CAST(row_number() OVER (ORDER BY md5('42:' || params), params) - 1 AS int) AS candidate
        FROM (VALUES {_DRAWN_SQL}) AS t(params) ORDER BY md5('42:' || params), params LIMIT {search.N_ITER}""",
)
def random_search_linear(spark, sf_dir):
    """The logistic model over all that its random preset gives, on five folds."""
    data = _dataset(spark, sf_dir, folds=5)
    drawn = search.draw(search.RANDOM_PRESET[models.LOGISTIC])
    return _scored_candidates(search.search(data.train, models.LOGISTIC, drawn), spark)


@query(
    "model_study",
    f"""WITH {_TEST_SQL}, n AS (SELECT target_quantile_class, count(*) AS c FROM test GROUP BY 1)
    SELECT model, (SELECT sum(c) FROM n)::BIGINT AS row_count, true AS beats_majority, true AS f1_below_one
    FROM (VALUES ('Random Forest'), ('Logistic Regression')) AS t(model)""",
)
def model_study(spark, sf_dir):
    data = _dataset(spark, sf_dir)
    candidates = {models.FOREST: [{"n_estimators": 5, "max_depth": 4}], models.LOGISTIC: [{"C": 10}]}
    results = study.model_study(data, candidates, fixed={models.LOGISTIC: {"max_iter": 20}}).results
    # the classes are thirds of the rows
    return results.select(
        "model", "row_count", (F.col("accuracy") > 0.44).alias("beats_majority"), (F.col("f1_macro") <= 1).alias("f1_below_one")
    )


_SHARES_SQL = ", ".join(f"{{'point': {i}, 'share': {s!r}::double}}" for i, s in enumerate(curves.LEARNING_SHARES))


@query(
    "learning_curve",
    f"""WITH {_FOLDS_SQL}, points AS (SELECT unnest([{_SHARES_SQL}], recursive := true)),
    held AS (SELECT DISTINCT fold AS held FROM sizes_of)
    SELECT CAST(point AS int) AS point, CAST(held AS int) AS fold, 'train' AS split,
           CAST(sum(ceil(n * share - 1e-9::double)) AS BIGINT) AS row_count
    FROM sizes_of, points, held WHERE fold <> held GROUP BY ALL
    UNION ALL
    SELECT CAST(point AS int), CAST(held AS int), 'validation', CAST(sum(n) AS BIGINT)
    FROM sizes_of, points, held WHERE fold = held GROUP BY ALL""",
)
def learning_curve(spark, sf_dir):
    data = _dataset(spark, sf_dir)
    small = {"n_estimators": 5, "max_depth": 4}
    made = curves.learning_curve(data.train, models.FOREST, small, "row_id")
    return made.select("point", "fold", "split", "row_count")


@query(
    "validation_curve",
    f"""WITH {_FOLDS_SQL}, points AS (SELECT unnest([0, 1]) AS point), held AS (SELECT DISTINCT fold AS held FROM sizes_of)
    SELECT point, CAST(held AS int) AS fold, CASE WHEN fold = held THEN 'validation' ELSE 'train' END AS split,
           CAST(sum(n) AS BIGINT) AS row_count
    FROM sizes_of, points, held GROUP BY ALL""",
)
def validation_curve(spark, sf_dir):
    data = _dataset(spark, sf_dir)
    rows = curves.validation_curve(data.train, models.FOREST, {"n_estimators": 5}, "max_depth", [1, 3])
    return rows.select("point", "fold", "split", "row_count")


_STRENGTHS_SQL = ", ".join(f"({i}, {c!r}::double)" for i, c in enumerate(curves.C_PATH))


@query(
    "regularization_path",
    f"""WITH {_SPLIT_SQL}
    SELECT point, c AS value, split, count(*) AS row_count
    FROM split, (VALUES {_STRENGTHS_SQL}) AS t(point, c) GROUP BY ALL""",
)
def regularization_path(spark, sf_dir):
    data = _dataset(spark, sf_dir)
    both = data.train.select("row_id", "label", "features", F.lit("train").alias("split")).unionByName(
        data.test.select("row_id", "label", "features", F.lit("test").alias("split"))
    )
    made = curves.regularization_path(both)
    return made.select("point", "value", "split", "row_count")


@query("mlp_loss_curve", "SELECT true AS loss_falls, true AS every_iteration_once, true AS beats_majority")
def mlp_loss_curve(spark, sf_dir):
    data = _dataset(spark, sf_dir)
    made = curves.network_progress(data.train, "row_id")
    first, last = F.min_by("loss", "iteration"), F.max_by("loss", "iteration")
    return made.agg(
        (last < first).alias("loss_falls"),
        ((F.count_distinct("iteration") == F.count("*")) & (F.max("iteration") - F.min("iteration") + 1 == F.count("*")))
        .alias("every_iteration_once"),
        (F.max("validation_accuracy") > 0.44).alias("beats_majority"),
    )


@query(
    "retrain_compare",
    f"WITH {_TEST_SQL} SELECT count(*) AS row_count, true AS p_value_in_bounds, true AS verdict_known FROM test",
)
def retrain_compare(spark, sf_dir):
    data = _dataset(spark, sf_dir)
    now = models.fit(data.train, models.FOREST)
    made = study.retrain_compare(data.train, data.test, (models.BOOSTING, study.EARLIER_BOOSTER), now)
    cells = F.col("both_right") + F.col("both_wrong") + F.col("only_first_right") + F.col("only_second_right")
    return made.select(
        cells.alias("row_count"),
        F.col("p_value").between(0, 1).alias("p_value_in_bounds"),
        F.col("verdict").isin("first", "second", "none").alias("verdict_known"),
    )


@query("feature_importance", "SELECT true AS adds_up_to_one, true AS none_negative, true AS one_per_feature")
def feature_importance(spark, sf_dir):
    data = _dataset(spark, sf_dir)
    made = explain.feature_importance(models.fit(data.train, models.FOREST), data.names)
    return made.agg(
        (F.abs(F.sum("importance") - 1) < 1e-9).alias("adds_up_to_one"),
        (F.min("importance") >= 0).alias("none_negative"),
        (F.count_distinct("feature") == len(data.names)).alias("one_per_feature"),
    )


@query("feature_selection", "SELECT true AS kept_from_threshold, true AS means_of_kept_only, true AS some_kept")
def feature_selection(spark, sf_dir):
    data = _dataset(spark, sf_dir)
    chosen = explain.select_features(data.train, data.names)
    values = chosen.apply(data.test).select(encode.slots("features", chosen.kept))
    means = values.groupBy("feature").agg(F.avg("value").alias("test_mean"))
    both = chosen.table.join(means, "feature", "left")
    return both.agg(
        F.bool_and((F.col("kept") == 1) == (F.col("importance") >= F.col("threshold"))).alias("kept_from_threshold"),
        F.bool_and((F.col("kept") == 1) == F.col("test_mean").isNotNull()).alias("means_of_kept_only"),
        (F.sum("kept") > 0).alias("some_kept"),
    )


def _shap(spark, sf_dir):
    data = _dataset(spark, sf_dir)
    made = models.fit(data.train, models.BOOSTING)
    return made, data, shapley.tree_shap(made, data.test, data.names, "row_id")


@query(
    "tree_shap",
    f"""WITH {_TEST_SQL} SELECT class, (SELECT count(*) FROM test) AS row_count, 0::BIGINT AS rows_off,
           true AS all_features
    FROM (SELECT DISTINCT target_quantile_class AS class FROM labeled)""",
)
def tree_shap(spark, sf_dir):
    """Rows whose base and values do not add up to the margin that the booster itself gives the class."""
    made, data, values = _shap(spark, sf_dir)
    added = values.groupBy("row_id", "class").agg(
        (F.sum("shap") + F.first("base")).alias("added"), F.count_distinct("feature").alias("features")
    )
    raw = made.model.transform(data.test).select("row_id", F.posexplode(vector_to_array("rawPrediction")))
    margins = raw.select("row_id", F.get(F.lit(made.classes), "pos").alias("class"), F.col("col").alias("margin"))
    return margins.join(added, ["row_id", "class"], "left").groupBy("class").agg(
        F.count("*").alias("row_count"),
        F.count_if(~F.coalesce(F.abs(F.col("added") - F.col("margin")) < 1e-9, F.lit(False))).alias("rows_off"),
        F.coalesce(F.min("features") == len(data.names), F.lit(False)).alias("all_features"),
    )


@query("shap_importance", "SELECT true AS at_most_fifteen, true AS falling, true AS none_negative")
def shap_importance(spark, sf_dir):
    made = shapley.shap_importance(_shap(spark, sf_dir)[2])
    return made.agg(
        (F.count("*") <= 15).alias("at_most_fifteen"),
        (F.max("mean_abs_shap") > F.min("mean_abs_shap")).alias("falling"),
        (F.min("mean_abs_shap") >= 0).alias("none_negative"),
    )


@query("shap_points", f"WITH {_TEST_SQL} SELECT row_id, true AS each_feature_once FROM test")
def shap_points(spark, sf_dir):
    made, _, values = _shap(spark, sf_dir)
    points = shapley.shap_points(values, "row_id", made.classes[0])
    return points.groupBy("row_id").agg(
        (F.count("*") == F.count_distinct("feature")).alias("each_feature_once")
    )
