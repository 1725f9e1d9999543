"""Queries on splits, metrics, statistical tests and result tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from meridia.functions import naming
from meridia.operators import metrics, prep, search, split, stats, tables

from . import views
from .registry import fix, fix_sql, fixed_sql, query

_PROBS = {c: f"p_{c}" for c in views.CLASSES}
_METRICS = ["accuracy", "precision_macro", "recall_macro", "f1_macro", "f1_weighted"]

# --- splits ------------------------------------------------------------------------------------

_RANKED_SQL = """
ranked AS (
  SELECT row_id, target_quantile_class,
         row_number() OVER (PARTITION BY target_quantile_class ORDER BY md5('42:' || row_id), row_id) AS r,
         count(*) OVER (PARTITION BY target_quantile_class) AS n
  FROM labeled
)"""

_SPLIT_SQL = f"""{views.LABELED_SQL}, {_RANKED_SQL},
sizes AS (SELECT target_quantile_class, count(*) AS n_k FROM labeled GROUP BY 1),
whole AS (SELECT sum(n_k) AS n, sum(n_k) - ceil(sum(n_k) * 0.2) AS n_train FROM sizes),
quota AS (SELECT target_quantile_class, floor(n_k * n_train / n) AS base, n_k * n_train / n - floor(n_k * n_train / n)
            AS remainder, n_train FROM sizes, whole),
allotted AS (SELECT target_quantile_class, base
               + CASE WHEN row_number() OVER (ORDER BY remainder DESC, target_quantile_class)
                           <= n_train - (SELECT sum(base) FROM quota) THEN 1 ELSE 0 END AS n_train_k FROM quota),
split AS (SELECT row_id, target_quantile_class, CASE WHEN r <= n_train_k THEN 'train' ELSE 'test' END AS split
          FROM ranked JOIN allotted USING (target_quantile_class))"""


@query("stratified_split", f"WITH {_SPLIT_SQL} SELECT * FROM split")
def stratified_split(spark, sf_dir):
    labeled = views.labeled(spark, sf_dir).select("row_id", prep.TARGET)
    return split.stratified_split(labeled, prep.TARGET, "row_id")


@query(
    "stratified_kfold",
    """SELECT o_orderkey, o_orderstatus, CAST((row_number() OVER (PARTITION BY o_orderstatus
         ORDER BY md5('42:' || o_orderkey), o_orderkey) - 1) % 5 AS int) AS fold,
         CAST(floor((row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1) * 3
              / count(*) OVER (PARTITION BY o_orderstatus)) AS int) AS row_order_fold
       FROM orders""",
)
def stratified_kfold(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    shuffled = split.stratified_kfold(orders, "o_orderstatus", "o_orderkey", 5)
    return split.stratified_kfold(
        shuffled, "o_orderstatus", "o_orderkey", 3, shuffle=False, out="row_order_fold"
    )


_SHARES = [0.1 + 0.9 * i / 7 for i in range(8)]
_SHARES_SQL = ", ".join(f"{{'point': {i}, 'share': {s!r}::double}}" for i, s in enumerate(_SHARES))


@query(
    "learning_subsets",
    f"""WITH {views.LABELED_SQL}, {_RANKED_SQL},
    points AS (SELECT unnest([{_SHARES_SQL}], recursive := true))
    SELECT row_id, CAST(point AS int) AS point FROM ranked, points WHERE r <= floor(share * n + 1e-9::double)""",
)
def learning_subsets(spark, sf_dir):
    labeled = views.labeled(spark, sf_dir).select("row_id", prep.TARGET)
    return split.learning_subsets(labeled, [prep.TARGET], "row_id", _SHARES).select("row_id", "point")


# --- scores ------------------------------------------------------------------------------------


def _scores_sql(by: str) -> str:
    return f"""
pairs AS (SELECT {by}, y, pred, count(*) AS n FROM scored_long GROUP BY ALL),
roles AS (SELECT {by}, y AS class, n AS support, 0 AS predicted, CASE WHEN y = pred THEN n ELSE 0 END AS hits FROM pairs
          UNION ALL SELECT {by}, pred, 0, n, 0 FROM pairs),
sums AS (SELECT {by}, class, sum(support)::bigint AS support, sum(predicted) AS predicted, sum(hits) AS hits
         FROM roles GROUP BY ALL),
class_scores AS (
  SELECT {by}, class, support, hits, CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END AS precision,
         CASE WHEN support = 0 THEN 0 ELSE hits / support END AS recall, 2 * hits / (support + predicted) AS f1
  FROM sums),
metrics AS (
  SELECT {by}, sum(hits) / sum(support) AS accuracy, avg(precision) AS precision_macro, avg(recall) AS recall_macro,
         avg(f1) AS f1_macro, sum(f1 * support) / sum(support) AS f1_weighted, sum(support)::bigint AS row_count
  FROM class_scores GROUP BY ALL)"""


_SCORES_SQL = f"{views.SCORED_LONG_SQL}, {_scores_sql('model, priority')}"
_FOLD_SQL = f"{views.SCORED_LONG_SQL}, {_scores_sql('model, fold')}"


@query(
    "accuracy",
    f"""WITH {views.SCORED_LONG_SQL} SELECT model, {fixed_sql("avg((y = pred)::int)", 6)} AS accuracy
        FROM scored_long GROUP BY model""",
)
def accuracy(spark, sf_dir):
    scores = metrics.classification_metrics(views.scored_long(spark, sf_dir), by=["model"])
    return fix(scores.select("model", "accuracy"), ["accuracy"], 6)


@query("classification_metrics", f"WITH {_SCORES_SQL} SELECT {fix_sql(_METRICS, 6)} FROM metrics")
def classification_metrics(spark, sf_dir):
    scores = metrics.classification_metrics(views.scored_long(spark, sf_dir), by=["model", "priority"])
    return fix(scores, _METRICS, 6)


@query("macro_f1", f"WITH {_FOLD_SQL} SELECT model, fold, {fixed_sql('f1_macro', 6)} AS f1_macro FROM metrics")
def macro_f1(spark, sf_dir):
    scores = metrics.classification_metrics(views.scored_long(spark, sf_dir), by=["model", "fold"])
    return fix(scores.select("model", "fold", "f1_macro"), ["f1_macro"], 6)


@query(
    "fold_scores", f"WITH {_FOLD_SQL} SELECT model, fold, {fixed_sql('f1_macro', 6)} AS score, row_count FROM metrics"
)
def fold_scores(spark, sf_dir):
    scores = search.fold_scores(views.scored_long(spark, sf_dir), by=["model"])
    return fix(scores.select("model", "fold", "score", "row_count"), ["score"], 6)


_SUMMARY = ["score_mean", "score_std"]


@query(
    "fold_summary",
    f"""WITH {_FOLD_SQL} SELECT {fix_sql(_SUMMARY, 6)} FROM
        (SELECT model, avg(f1_macro) AS score_mean, stddev_pop(f1_macro) AS score_std, count(*) AS folds
         FROM metrics GROUP BY model)""",
)
def fold_summary(spark, sf_dir):
    scores = search.fold_scores(views.scored_long(spark, sf_dir), by=["model"])
    return fix(metrics.fold_summary(scores, ["model"]), _SUMMARY, 6)


_REPORT = ["precision", "recall", "f1"]


@query(
    "classification_report",
    f"""WITH {_SCORES_SQL},
    report AS (
      SELECT model, priority, class AS entry, 0 AS line, precision, recall, f1, support FROM class_scores
      UNION ALL SELECT model, priority, 'accuracy', 1, NULL, NULL, sum(hits) / sum(support), sum(support)::bigint
        FROM class_scores GROUP BY ALL
      UNION ALL SELECT model, priority, 'macro avg', 2, avg(precision), avg(recall), avg(f1), sum(support)::bigint
        FROM class_scores GROUP BY ALL
      UNION ALL SELECT model, priority, 'weighted avg', 3, sum(precision * support) / sum(support),
        sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support)::bigint
        FROM class_scores GROUP BY ALL)
    SELECT {fix_sql(_REPORT, 6)} FROM report""",
)
def classification_report(spark, sf_dir):
    report = metrics.classification_report(views.scored_long(spark, sf_dir), by=["model", "priority"])
    return fix(report, _REPORT, 6)


@query(
    "confusion_matrix",
    f"""WITH {views.SCORED_LONG_SQL}, c AS (SELECT unnest(['F', 'O', 'P', 'X']) AS class),
    cells AS (SELECT model, a.class AS actual, b.class AS predicted
              FROM (SELECT DISTINCT model FROM scored_long), c a, c b)
    SELECT cells.model, actual, predicted, count(row_id) AS row_count
    FROM cells LEFT JOIN scored_long s ON s.model = cells.model AND y = actual AND pred = predicted GROUP BY ALL""",
)
def confusion_matrix(spark, sf_dir):
    cells = metrics.confusion_matrix(views.scored_long(spark, sf_dir), ["F", "O", "P", "X"], by=["model"])
    return cells.select("model", "actual", "predicted", "row_count")


_CURVE_SQL = f"""{views.SCORED_SQL},
long AS (
  SELECT 'F' AS class, p_F AS score, (y = 'F')::int AS positive FROM scored
  UNION ALL SELECT 'O', p_O, (y = 'O')::int FROM scored
  UNION ALL SELECT 'P', p_P, (y = 'P')::int FROM scored),
counts AS (SELECT class, score, sum(positive) AS pos, sum(1 - positive) AS neg FROM long GROUP BY ALL),
curve AS (
  SELECT class, score, pos, neg,
         sum(neg) OVER w / sum(neg) OVER (PARTITION BY class) AS fpr,
         sum(pos) OVER w / sum(pos) OVER (PARTITION BY class) AS tpr
  FROM counts WINDOW w AS (PARTITION BY class ORDER BY score DESC))"""


@query(
    "roc_curve",
    f"""WITH {_CURVE_SQL} SELECT class, {fixed_sql("score", 8)} AS score, {fixed_sql("fpr", 8)} AS fpr,
        {fixed_sql("tpr", 8)} AS tpr FROM curve""",
)
def roc_curve(spark, sf_dir):
    curve = metrics.roc_curve(views.scored(spark, sf_dir), _PROBS)
    return fix(curve.select("class", "score", "fpr", "tpr"), ["score", "fpr", "tpr"], 8)


@query(
    "roc_auc_macro",
    f"""WITH {_CURVE_SQL},
    ranks AS (SELECT class, positive, (rank() OVER w + (count(*) OVER (PARTITION BY class, score) - 1) / 2.0::double) AS r
              FROM long WINDOW w AS (PARTITION BY class ORDER BY score)),
    areas AS (SELECT class, (sum(r) FILTER (positive = 1) - sum(positive) * (sum(positive) + 1.0::double) / 2)
                            / (sum(positive)::double * sum(1 - positive)) AS auc FROM ranks GROUP BY class)
    SELECT {fixed_sql("avg(auc)", 8)} AS roc_auc_macro FROM areas""",
)
def roc_auc_macro(spark, sf_dir):
    curve = metrics.roc_curve(views.scored(spark, sf_dir), _PROBS)
    return fix(metrics.roc_auc_macro(curve), ["roc_auc_macro"], 8)


@query(
    "roc_interpolated",
    f"""WITH {_CURVE_SQL},
    points AS (SELECT class, fpr, tpr FROM curve UNION ALL SELECT DISTINCT class, 0.0, 0.0 FROM curve),
    grid AS (SELECT CAST(i AS int) AS point, i / 199.0::double AS x, class
             FROM range(200) t(i), (SELECT DISTINCT class FROM curve)),
    ends AS (SELECT g.class, point, x, max(fpr) FILTER (fpr <= x + 1e-12::double) AS x0,
                    max(tpr) FILTER (fpr <= x + 1e-12::double) AS y0,
                    min(fpr) FILTER (fpr > x + 1e-12::double) AS x1, min(tpr) FILTER (fpr > x + 1e-12::double) AS y1
             FROM grid g JOIN points p ON p.class = g.class GROUP BY ALL)
    SELECT point, {fixed_sql("x", 8)} AS fpr,
           {fixed_sql("avg(CASE WHEN x1 IS NULL THEN y0 ELSE y0 + (y1 - y0) / (x1 - x0) * (x - x0) END)", 6)} AS tpr
    FROM ends GROUP BY point, x""",
)
def roc_interpolated(spark, sf_dir):
    curve = metrics.roc_curve(views.scored(spark, sf_dir), _PROBS)
    return fix(fix(metrics.roc_interpolated(curve), ["fpr"], 8), ["tpr"], 6)


_CAL = ["mean_predicted", "fraction_positive"]


@query(
    "calibration_curve",
    f"""WITH {_CURVE_SQL}
    SELECT {fix_sql(_CAL, 6)} FROM (
      SELECT class, CAST(least(floor(score * 6), 5) AS int) AS bin, avg(score) AS mean_predicted,
             avg(positive) AS fraction_positive, count(*) AS row_count FROM long GROUP BY ALL)""",
)
def calibration_curve(spark, sf_dir):
    return fix(metrics.calibration_curve(views.scored(spark, sf_dir), _PROBS), _CAL, 6)


# --- tests -------------------------------------------------------------------------------------

_MCNEMAR_SQL = """
cells AS (
  SELECT priority, count(*) FILTER (pred_a = y AND pred_b = y) AS both_right,
         count(*) FILTER (pred_a <> y AND pred_b = y) AS only_second_right,
         count(*) FILTER (pred_a = y AND pred_b <> y) AS only_first_right,
         count(*) FILTER (pred_a <> y AND pred_b <> y) AS both_wrong
  FROM scored GROUP BY priority)"""


@query("mcnemar_table", f"WITH {views.SCORED_SQL}, {_MCNEMAR_SQL} SELECT * FROM cells")
def mcnemar_table(spark, sf_dir):
    return stats.mcnemar_table(views.scored(spark, sf_dir), "y", "pred_a", "pred_b", by=["priority"])


@query(
    "mcnemar_test",
    f"""WITH {views.SCORED_SQL}, {_MCNEMAR_SQL},
    named AS (SELECT *, least(only_first_right, only_second_right) AS k,
                     only_first_right + only_second_right AS n FROM cells),
    tail AS (SELECT priority, sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) - n * ln(2))) AS s
             FROM (SELECT priority, n, k, unnest(range(k + 1)) AS i FROM named) GROUP BY priority),
    tested AS (SELECT named.*, CASE WHEN 2 * k = n THEN 1.0::double ELSE least(1.0::double, 2 * s) END AS p
               FROM named JOIN tail USING (priority))
    SELECT priority, both_right, only_second_right, only_first_right, both_wrong, k::double AS statistic,
           {fixed_sql("p", 8)} AS p_value, CASE WHEN p < 0.05 THEN 1 ELSE 0 END AS significant,
           CASE WHEN p < 0.05 AND only_second_right > only_first_right
                THEN 'second'
                WHEN p < 0.05 AND only_first_right > only_second_right
                THEN 'first'
                ELSE 'none' END AS verdict
    FROM tested""",
)
def mcnemar_test(spark, sf_dir):
    cells = stats.mcnemar_table(views.scored(spark, sf_dir), "y", "pred_a", "pred_b", by=["priority"])
    return fix(stats.mcnemar_test(cells), ["p_value"], 8)


_PRIORITY_FOLD_SQL = f"{views.SCORED_LONG_SQL}, {_scores_sql('model, priority, fold')}"


@query(
    "wilcoxon_test",
    f"""WITH {_PRIORITY_FOLD_SQL},
    paired AS (SELECT b.model, b.priority, fold, a.f1_macro - b.f1_macro AS d FROM metrics a
               JOIN metrics b USING (priority, fold) WHERE a.model = 'A' AND b.model = 'B'),
    ranked AS (SELECT *, rank() OVER (PARTITION BY priority ORDER BY abs(d))
                      + (count(*) OVER (PARTITION BY priority, abs(d)) - 1) / 2.0::double AS r,
                      row_number() OVER (PARTITION BY priority ORDER BY fold) - 1 AS place
               FROM paired WHERE d <> 0),
    seen AS (SELECT model, priority, count(*) AS used, sum(CASE WHEN d > 0 THEN r ELSE 0 END) AS w
             FROM ranked GROUP BY ALL),
    masks AS (SELECT priority, mask, sum(CASE WHEN (mask >> place) & 1 = 1 THEN r ELSE 0 END) AS total
              FROM (SELECT r.priority, r, place, unnest(range(1 << used)) AS mask FROM ranked r
                    JOIN seen s ON r.priority = s.priority) GROUP BY ALL),
    tested AS (SELECT model, s.priority, used, w AS statistic, avg((total >= w)::int) AS p
               FROM seen s JOIN masks m ON s.priority = m.priority GROUP BY ALL)
    SELECT model, priority, 5::bigint AS pairs, used, statistic, {fixed_sql("p", 8)} AS p_value,
           CASE WHEN p < 0.05 THEN 1 ELSE 0 END AS significant FROM tested""",
)
def wilcoxon_test(spark, sf_dir):
    scores = search.fold_scores(views.scored_long(spark, sf_dir), by=["model", "priority"])
    paired = stats.paired_scores(scores, "A", by=["priority"])
    return fix(stats.wilcoxon_test(paired, ["model", "priority"]), ["p_value"], 8)


# --- result tables -----------------------------------------------------------------------------


@query(
    "best_model",
    f"""WITH {_SCORES_SQL}
    SELECT priority, arg_max(model, f1_macro) AS best_model, {fixed_sql("max(f1_macro)", 6)} AS best_score
    FROM metrics GROUP BY priority""",
)
def best_model(spark, sf_dir):
    scores = metrics.classification_metrics(views.scored_long(spark, sf_dir), by=["model", "priority"])
    placed = scores.withColumn("place", F.ascii("model"))
    return fix(stats.best_model(placed, "f1_macro", "place", by=["priority"]), ["best_score"], 6)


@query(
    "metrics_long",
    f"""WITH {_SCORES_SQL}
    SELECT model, priority, metric, {fixed_sql("score", 6)} AS score
    FROM (UNPIVOT (SELECT model, priority, accuracy, precision_macro, recall_macro, f1_macro FROM metrics)
          ON accuracy, precision_macro, recall_macro, f1_macro INTO NAME metric VALUE score)""",
)
def metrics_long(spark, sf_dir):
    scores = metrics.classification_metrics(views.scored_long(spark, sf_dir), by=["model", "priority"])
    return fix(tables.metrics_long(scores, by=["model", "priority"]), ["score"], 6)


@query(
    "phase_comparison",
    f"""WITH {_SCORES_SQL},
    after AS (SELECT priority AS model, round(f1_macro, 4) AS f1, round(accuracy, 4) AS acc FROM metrics
              WHERE model = 'A'),
    before AS (SELECT priority AS model, round(f1_macro, 4) AS f1, round(accuracy, 4) AS acc FROM metrics
               WHERE model = 'B' AND priority <> '1-URGENT'),
    both_runs AS (SELECT after.*, before.f1 AS old_f1, before.acc AS old_acc,
                         round(after.f1 - coalesce(before.f1, 0), 4) AS d
                  FROM after LEFT JOIN before USING (model))
    SELECT model, coalesce(printf('%.4f', old_f1), '-') AS before_f1_macro, printf('%.4f', f1) AS after_f1_macro,
           coalesce(printf('%.4f', old_acc), '-') AS before_accuracy, printf('%.4f', acc) AS after_accuracy,
           CASE WHEN d >= 0 THEN '+' ELSE '-' END
             || regexp_replace(printf('%.4f', abs(d)), '(\\.\\d+?)0+$', '\\1') AS delta_f1_macro
    FROM both_runs""",
)
def phase_comparison(spark, sf_dir):
    """Run A of every priority against run B, where B knows no urgent orders."""
    scores = metrics.classification_metrics(views.scored_long(spark, sf_dir), by=["model", "priority"])
    rounded = scores.withColumns({m: F.round(m, 4) for m in ("f1_macro", "accuracy")}).withColumnRenamed("model", "run")
    runs = rounded.withColumnRenamed("priority", "model")
    after = runs.where("run = 'A'")
    before = runs.where("run = 'B' and model <> '1-URGENT'")
    return tables.phase_comparison(after, before, ["f1_macro", "accuracy"], "f1_macro")


_SPREAD_SQL = f"""{views.VECTORS_SQL},
slots AS (SELECT unnest(range(1, {views.DIMENSIONS + 1})) AS i, x FROM vectors),
spread AS (SELECT CASE WHEN i <= 32 THEN 'numeric__' ELSE 'categorical__' END || 'dim_' || i AS feature,
                  var_pop(x[i]) AS v FROM slots GROUP BY i),
shares AS (SELECT feature, v / sum(v) OVER () AS importance FROM spread)"""


def _shares(spark, sf_dir):
    """Every dimension's share of the total variance: importances that SQL can recompute."""
    slots = views.vectors(spark, sf_dir).select(F.posexplode("x").alias("i", "v"))
    block = F.when(F.col("i") < 32, "numeric__dim_").otherwise("categorical__dim_")
    spread = slots.groupBy("i").agg(F.var_pop("v").alias("v"))
    return spread.select(
        F.concat(block, (F.col("i") + 1).cast("string")).alias("feature"),
        stats.total_share(spread, "v").alias("importance"),
    )


@query(
    "topk_importance",
    f"""WITH {_SPREAD_SQL} SELECT feature, {fixed_sql("importance", 8)} AS importance FROM shares
        ORDER BY shares.importance DESC, feature LIMIT 15""",
)
def topk_importance(spark, sf_dir):
    return fix(tables.topk(_shares(spark, sf_dir), "importance", 15, "feature"), ["importance"], 8)


@query(
    "importance_filter",
    f"""WITH {_SPREAD_SQL}, cut AS (SELECT avg(importance) * 0.98::double AS threshold FROM shares)
    SELECT feature, {fixed_sql("importance", 8)} AS importance, {fixed_sql("threshold", 8)} AS threshold,
           CASE WHEN importance >= threshold THEN 1 ELSE 0 END AS kept FROM shares, cut""",
)
def importance_filter(spark, sf_dir):
    kept = tables.importance_filter(_shares(spark, sf_dir), factor=0.98)
    return fix(kept, ["importance", "threshold"], 8)


@query(
    "clean_feature_names",
    f"""WITH {_SPREAD_SQL} SELECT feature, 'dim_' || split_part(feature, 'dim_', 2) AS clean_name FROM shares""",
)
def clean_feature_names(spark, sf_dir):
    shares = _shares(spark, sf_dir)
    return shares.select("feature", naming.clean_feature_name(F.col("feature")).alias("clean_name"))


@query(
    "param_sample",
    """WITH grid AS (SELECT DISTINCT p_brand, p_size FROM part),
    listed AS (SELECT '{"brand":"' || p_brand || '","size":"' || p_size || '"}' AS params FROM grid)
    SELECT params, CAST(row_number() OVER (ORDER BY md5('42:' || params), params) - 1 AS int) AS candidate
    FROM listed ORDER BY md5('42:' || params), params LIMIT 30""",
)
def param_sample(spark, sf_dir):
    """Candidates drawn without replacement from a parameter grid that is itself a table."""
    grid = views.table(spark, sf_dir, "part").select("p_brand", "p_size").distinct()
    params = F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("size"), F.col("p_size").cast("string"))
    return search.sample_candidates(grid.select(naming.params_to_json(params).alias("params")), 30, seed=42)


