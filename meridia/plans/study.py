"""Train, search, judge and explain classifiers on a finished table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..functions.naming import clean_feature_name, clean_feature_text
from ..operators import (
    balance,
    cluster,
    curves,
    encode,
    explain,
    metrics,
    models,
    prep,
    search,
    shapley,
    split,
    stats,
    tables,
)
from ..session import materialize
from ..sources import writers
from . import reports

# Scores of the earlier grid study, and the earlier booster that is fitted again.
EARLIER_RESULTS = {
    models.LOGISTIC: (0.9847, 0.9742, 0.9741),
    models.FOREST: (0.9968, 0.9903, 0.9904),
    models.BOOSTING: (0.9984, 0.9903, 0.9904),
    models.LINEAR_SVM: (0.9863, 0.9710, 0.9709),
    models.NETWORK: (0.9766, 0.9710, 0.9712),
}
EARLIER_BOOSTER = {
    "n_estimators": 200,
    "learning_rate": 0.1,
    "max_depth": 3,
    "subsample": 1.0,
    "min_samples_split": 2,
}


# Tables with one or more lines per row of data: written by as many tasks as they have.
ROW_TABLES = ("shap_points", "pca_clusters")


@dataclass(frozen=True)
class Dataset:
    """Both sides of the split with their feature vectors; the balanced training rows have folds."""

    train: DataFrame
    test: DataFrame
    names: list[str]
    strategy: str
    prepared: encode.Prepared
    raw: DataFrame


def build_dataset(
    features: DataFrame,
    target: str = prep.TARGET,
    key: str = "row_id",
    folds: int = 5,
    shuffle: bool = True,
    exclude: Sequence[str] = (),
    test_share: float = 0.2,
    seed: int = 42,
) -> Dataset:
    """Split by class, scale and encode as learned on the training rows, balance those rows, deal folds."""
    names, _ = encode.split_features_and_target(features, target)
    # What the readings go through is computed once; the split, its ranks and the classes read the result.
    features = materialize(features.select(*names, target), "features")
    sides = materialize(split.stratified_split(features, target, key, test_share, seed), "split")
    numeric, texts = encode.typed_columns(sides, [target, key, "split", *exclude])
    prepared = encode.fit_preprocessor(sides.where("split = 'train'"), numeric, texts)
    shaped = prepared.apply(sides).select(key, F.col(target).alias("label"), "features", "split")
    train, test = (shaped.where(F.col("split") == s).drop("split") for s in ("train", "test"))
    balanced, strategy = _balanced(train, key, seed)
    if shuffle:
        folded = split.stratified_kfold(balanced, "label", key, folds, seed)
    else:
        # consecutive runs in the order of the key's own hash rank: the table has no row numbers
        ordered = split.hash_rank(balanced, [], key, f"{seed}:row-order", rank="__row")
        folded = split.stratified_kfold(ordered, "label", "__row", folds, shuffle=False).drop("__row")
    return Dataset(
        materialize(folded, "train").persist(StorageLevel.MEMORY_AND_DISK),
        materialize(test, "test").persist(StorageLevel.MEMORY_AND_DISK),
        prepared.names,
        strategy,
        prepared,
        sides,
    )


def _balanced(train: DataFrame, key: str, seed: int) -> tuple[DataFrame, str]:
    arrays = train.withColumn("x", vector_to_array("features"))
    rows, strategy = balance.balance(arrays, "label", key, "x", seed)
    if strategy == balance.SKIPPED:
        return train, strategy
    return cluster.as_vectors(rows, "x").drop("x"), strategy


@dataclass
class Study:
    dataset: Dataset
    searches: dict[str, search.SearchResult]
    scored: DataFrame
    results: DataFrame
    selection: explain.Selection | None = None
    tables: dict[str, DataFrame] = field(default_factory=dict)

    @property
    def fitted(self) -> dict[str, models.Fitted]:
        return {name: s.best for name, s in self.searches.items()}

    def best_row(self, by: str = "cv_f1_macro") -> Row:
        return self.results.orderBy(F.col(by).desc(), "place").first()


def model_study(
    dataset: Dataset,
    candidates: Mapping[str, Sequence[Mapping[str, Any]]],
    key: str = "row_id",
    fixed: Mapping[str, Mapping[str, Any]] | None = None,
    platt: bool = False,
    seed: int = 42,
    parallelism: int = 1,
) -> Study:
    """Search every model on the same folds and judge the winners on the same test rows.

    The test rows are predicted once per model; every table reads that one scored table.
    """
    searches = {}
    for name, options in candidates.items():
        extra = (fixed or {}).get(name, {})
        found = search.search(dataset.train, name, options, seed=seed, parallelism=parallelism, fixed=extra)
        if platt and not found.best.has_probabilities:
            calibrated = models.platt_scaling(dataset.train, name, found.best.params, seed=seed)
            found = search.SearchResult(found.candidates, found.scores, found.spreads, calibrated)
        searches[name] = found
    fitted = {n: s.best for n, s in searches.items()}
    classes = next(iter(fitted.values())).classes
    scored = materialize(search.score_table(fitted, dataset.test, key), "scored")
    cv = {n: (s.best.params, s.best_score) for n, s in searches.items()}
    made = Study(dataset, searches, scored, search.comparison(scored, classes, cv))
    made.tables["results"] = made.results
    made.tables["classification_report"] = metrics.classification_report(scored, by=["model"])
    made.tables["confusion_matrix"] = metrics.confusion_matrix(scored, classes, by=["model"])
    made.tables["algorithm_comparison"] = tables.metrics_long(made.results)
    return made


def retrain_compare(
    train: DataFrame,
    test: DataFrame,
    first: tuple[str, Mapping[str, Any]],
    second: models.Fitted,
    key: str = "row_id",
    seed: int = 42,
) -> DataFrame:
    """Fit an earlier configuration again and test it against a fitted model on the same rows."""
    earlier = models.fit(train, first[0], first[1], seed=seed)
    paired = second.score(earlier.score(test, "pred_first").select(key, "label", "features", "pred_first"), "pred_second")
    return stats.mcnemar_test(stats.mcnemar_table(paired, "label", "pred_first", "pred_second"))


def earlier_results(
    df: DataFrame, baseline: Mapping[str, tuple[float, float, float]] | None = None
) -> DataFrame:
    rows = [(m, *v) for m, v in (EARLIER_RESULTS if baseline is None else baseline).items()]
    return df.sparkSession.createDataFrame(rows, "model string, cv_f1_macro double, accuracy double, f1_macro double")


def unsupervised(
    df: DataFrame,
    train: DataFrame,
    key: str = "row_id",
    ks: Sequence[int] = tuple(range(2, 9)),
    k: int = 3,
    starts: int = 10,
    seed: int = 42,
    metric: str = "squared",
) -> dict[str, DataFrame]:
    """K sweep on the training rows; final clusters, their silhouettes and a projection of ``df``.

    Silhouettes use squared distances at every size, whose work is linear; ``metric="euclidean"`` asks for
    the other form, whose work grows with the square of the rows.
    """
    to_array = vector_to_array("features")
    fit_rows = train.select(key, to_array.alias("x"))
    sweep = cluster.elbow_sweep(fit_rows, ks, "x", key, starts, seed, metric)
    rows = df.select(key, "label", "features").withColumn("x", to_array).persist()
    _, _, by_kmeans = cluster.kmeans(rows, k, starts=starts, seed=seed, out="kmeans_cluster")
    by_ward = cluster.hierarchical(by_kmeans, k, "x", key, seed=seed, out="ward_cluster")
    projected, shares = cluster.pca_project(by_ward)
    points = materialize(encode.label_encode(projected, "label"), "clusters")
    scores = []
    for name, column in (("K-Means", "kmeans_cluster"), ("Agglomerative", "ward_cluster")):
        if metric == "euclidean":
            each = cluster.silhouette_euclidean(points, key, "x", column)
            value = each.agg(F.avg("silhouette")).first()[0]
        else:
            value = cluster.silhouette_squared(points, cluster=column)
        scores.append((f"{name} (k={k})", round(float(value), 4), metric))
    spark = df.sparkSession
    return {
        "elbow_and_silhouette": sweep,
        "clustering_results": spark.createDataFrame(scores, "algorithm string, silhouette double, metric string"),
        "pca_clusters": points.select(key, "label", "label_index", "pc1", "pc2", "kmeans_cluster", "ward_cluster"),
        "explained_variance": spark.createDataFrame(
            [(i + 1, s) for i, s in enumerate(shares)], "component int, share double"
        ),
    }


def grid_study(
    features: DataFrame,
    target: str = prep.TARGET,
    grids: Mapping[str, Mapping[str, Sequence]] | None = None,
    key: str = "row_id",
    fixed: Mapping[str, Mapping[str, Any]] | None = None,
    diagnostics: bool = True,
    shares: Sequence[float] = tuple(curves.LEARNING_SHARES),
    strengths: Sequence[float] = tuple(curves.C_PATH),
    clusters: Sequence[int] = tuple(range(2, 9)),
    starts: int = 10,
    curve_forest: Mapping[str, Any] | None = None,
    exclude: Sequence[str] = (),
    network_steps: int = 500,
    seed: int = 42,
) -> Study:
    """Exhaustive search over three folds in row order, diagnostics, clusterings."""
    dataset = build_dataset(features, target, key, folds=3, shuffle=False, exclude=exclude, seed=seed)
    candidates = {m: search.expand_grid(g) for m, g in (grids or search.GRID_PRESET).items()}
    made = model_study(dataset, candidates, key, fixed, seed=seed)
    if models.FOREST in made.fitted:
        importances = explain.feature_importance(made.fitted[models.FOREST], dataset.names)
        named = importances.withColumn("feature", clean_feature_name(F.col("feature")))
        made.tables["feature_importance"] = tables.topk(named, "importance", 15, "feature")
    if diagnostics:
        forest = curve_forest or {"n_estimators": 100, "max_depth": 20}
        curve = curves.learning_curve(dataset.train, models.FOREST, forest, key, shares=shares, seed=seed)
        made.tables["learning_curve"] = curves.curve_summary(curve)
        both = dataset.train.select(key, "label", "features", F.lit("train").alias("split")).unionByName(
            dataset.test.select(key, "label", "features", F.lit("test").alias("split"))
        )
        made.tables["regularization_path"] = curves.regularization_path(
            both, values=strengths, params=(fixed or {}).get(models.LOGISTIC)
        )
        made.tables["network_progress"] = curves.network_progress(
            dataset.train, key, max_iter=network_steps, seed=seed
        )
        made.tables |= unsupervised(dataset.test, dataset.train, key, clusters, starts=starts, seed=seed)
    return made


def random_study(
    features: DataFrame,
    target: str = prep.TARGET,
    grids: Mapping[str, Mapping[str, Sequence]] | None = None,
    key: str = "row_id",
    n_iter: int = search.N_ITER,
    fixed: Mapping[str, Mapping[str, Any]] | None = None,
    diagnostics: bool = True,
    factor: float = explain.SELECTION_FACTOR,
    shares: Sequence[float] = tuple(curves.LEARNING_SHARES),
    rates: Sequence[float] = tuple(curves.LEARNING_RATES),
    earlier_booster: Mapping[str, Any] | None = None,
    baseline: Mapping[str, tuple[float, float, float]] | None = None,
    exclude: Sequence[str] = (),
    seed: int = 42,
) -> Study:
    """Feature selection, random search over five shared folds, tests, explanations, comparison.

    ``baseline`` has the earlier scores to compare with per model (search F1, accuracy, F1); by default those
    of the published grid study.
    """
    dataset = build_dataset(features, target, key, folds=5, exclude=exclude, seed=seed)
    chosen = explain.select_features(dataset.train, dataset.names, factor=factor, seed=seed)
    cut = Dataset(
        materialize(chosen.apply(dataset.train), "train").persist(StorageLevel.MEMORY_AND_DISK),
        materialize(chosen.apply(dataset.test), "test").persist(StorageLevel.MEMORY_AND_DISK),
        chosen.kept,
        dataset.strategy,
        dataset.prepared,
        dataset.raw,
    )
    candidates = {m: search.draw(g, n_iter, seed) for m, g in (grids or search.RANDOM_PRESET).items()}
    made = model_study(cut, candidates, key, fixed, platt=True, seed=seed)
    made.selection = chosen
    made.tables["feature_selection"] = tables.topk(chosen.table, "importance", 25, "feature")
    metrics_compared = ["cv_f1_macro", "accuracy", "f1_macro"]
    made.tables["comparison"] = tables.phase_comparison(
        made.results, earlier_results(made.results, baseline), metrics_compared, "f1_macro"
    )
    classes = next(iter(made.fitted.values())).classes
    probabilities = {c: f"p_{c}" for c in classes}
    complete = made.scored.where(F.col(f"p_{classes[0]}").isNotNull())
    curve = metrics.roc_curve(complete, probabilities, by=["model"])
    made.tables["roc_interpolated"] = metrics.roc_interpolated(curve, by=["model"])
    made.tables["calibration_curve"] = metrics.calibration_curve(complete, probabilities, by=["model"])
    if models.FOREST in made.fitted:
        importances = explain.feature_importance(made.fitted[models.FOREST], cut.names)
        named = importances.withColumn("feature", clean_feature_name(F.col("feature")))
        made.tables["feature_importance"] = tables.topk(named, "importance", 15, "feature")
    by_fold = None
    for name, fitted in made.fitted.items():
        part = search.out_of_fold(cut.train, name, fitted.params, key, seed=seed)
        by_fold = part if by_fold is None else by_fold.unionByName(part)
    scores = materialize(search.fold_scores(by_fold), "fold-scores")
    made.tables["fold_scores"] = scores
    best = made.best_row()["model"]
    made.tables["wilcoxon"] = stats.wilcoxon_test(stats.paired_scores(scores, best), ["model"])
    if diagnostics:
        if best in (models.FOREST, models.BOOSTING):
            shown = [clean_feature_text(n) for n in cut.names]
            values = shapley.tree_shap(made.fitted[best], cut.test, shown, key)
            made.tables["shap_importance"] = shapley.shap_importance(values)
            made.tables["shap_points"] = shapley.shap_points(values, key, classes[0])
        earlier = earlier_booster or EARLIER_BOOSTER
        made.tables["mcnemar"] = retrain_compare(
            cut.train, cut.test, (models.BOOSTING, earlier), made.fitted[best], key, seed
        )
        booster = made.fitted[best].params if best == models.BOOSTING else earlier
        learning = curves.learning_curve(cut.train, models.BOOSTING, booster, key, shares=shares, seed=seed)
        made.tables["learning_curve"] = curves.curve_summary(learning)
        sweep = curves.validation_curve(
            cut.train, models.BOOSTING, booster, "learning_rate", rates, seed=seed
        )
        made.tables["validation_curve"] = curves.curve_summary(sweep)
    return made


def report(made: Study) -> DataFrame:
    """The study as text."""
    facts = [
        f"training balance: {made.dataset.strategy}",
        f"training set: {made.dataset.train.count()} rows x {len(made.dataset.names)} features",
        f"test set: {made.dataset.test.count()} rows",
    ]
    if made.selection:
        facts.append(f"features kept: {len(made.selection.kept)} of {len(made.selection.names)}")
    best = made.best_row()
    sections = {}
    if "comparison" in made.tables:
        table = made.tables["comparison"]
        sections["Comparison with the earlier study"] = reports.plain_table(table, table.columns, "model")
    if "wilcoxon" in made.tables:
        sections["Fold scores compared"] = reports.paired_scores_section(made.tables["wilcoxon"], best["model"])
    if "mcnemar" in made.tables:
        earlier = f"{models.BOOSTING} (earlier)"
        sections["Errors compared"] = reports.error_rates_section(made.tables["mcnemar"], earlier, best["model"])
    if "clustering_results" in made.tables:
        table = made.tables["clustering_results"]
        sections["Clusterings"] = reports.plain_table(table, table.columns)
        total = made.tables["explained_variance"].agg(F.sum("share")).first()[0]
        sections["Projection"] = [f"explained variance of both components: {100 * total:.2f}%"]
    return reports.study_report(made.results, facts, best, sections)


def write_study(made: Study, path: str) -> None:
    """All tables, reports and prepared inputs of a study below one folder."""
    root = path.rstrip("/")
    writers.write_split(made.dataset.raw, f"{root}/inputs", "raw")
    both = made.dataset.train.select("label", "features", F.lit("train").alias("split")).unionByName(
        made.dataset.test.select("label", "features", F.lit("test").alias("split"))
    )
    writers.write_split(both, f"{root}/inputs", "balanced")
    writers.write_split(
        made.dataset.prepared.apply(made.dataset.raw), f"{root}/inputs", "processed"
    )
    for name, table in made.tables.items():
        writers.write_table(table, f"{root}/{name}", single_file=name not in ROW_TABLES)
    headings = {
        n: [f"Best params: {s.best.params}", f"CV F1: {s.best_score:.4f}"] for n, s in made.searches.items()
    }
    text = reports.class_reports(made.tables["classification_report"], headings)
    writers.write_report(text, f"{root}/classification_reports_text")
    writers.write_report(report(made), f"{root}/report")
