"""Classification scores as grouped aggregates over (label, prediction) rows.

Every function takes ``by`` columns, so many models, folds or splits are scored in one pass. The
rows are reduced to counts per (label, prediction) before anything else happens to them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranks import running_totals


def _ratio(part: Column, whole: Column) -> Column:
    """0 when undefined."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def pair_counts(df: DataFrame, label: str = "y", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, F.col(label).alias("y"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(
    df: DataFrame, classes: Sequence, label: str = "y", pred: str = "pred", by: Sequence[str] = ()
) -> DataFrame:
    """One row per (group, actual, predicted) cell in the given class order, empty cells included.

    Labels and predictions outside the list, null ones too, are counted as null, last in the order; such
    cells are there only where there are such rows, so the counts always add up to the rows.
    """
    listed = F.array(*[F.lit(c) for c in classes])
    inside = [F.when(F.col(c).isin(list(classes)), F.col(c)).alias(c) for c in ("y", "pred")]
    counts = pair_counts(df, label, pred, by).select(*by, *inside, "n")
    counts = counts.groupBy(*by, "y", "pred").agg(F.sum("n").alias("n"))
    grid = (
        counts.select(*by)
        .distinct()
        .select(*by, F.posexplode(listed).alias("actual_order", "y"))
        .select("*", F.posexplode(listed).alias("predicted_order", "pred"))
    )
    order = [
        F.coalesce(F.array_position(listed, F.col(c)) - 1, F.lit(len(classes))).cast("int").alias(o)
        for c, o in (("y", "actual_order"), ("pred", "predicted_order"))
    ]
    other = counts.where("y IS NULL OR pred IS NULL").select(*by, order[0], "y", order[1], "pred", "n")
    cells = grid.join(counts, [*by, "y", "pred"], "left").unionByName(other)
    return cells.select(
        *by,
        F.col("y").alias("actual"),
        F.col("pred").alias("predicted"),
        F.coalesce("n", F.lit(0)).alias("row_count"),
        "actual_order",
        "predicted_order",
    )


def confusion_wide(cells: DataFrame, classes: Sequence, by: Sequence[str] = ()) -> DataFrame:
    """One row per actual class, one column per predicted class."""
    return cells.groupBy(*by, "actual").pivot("predicted", list(classes)).agg(F.sum("row_count"))


def class_scores(df: DataFrame, label: str = "y", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support of every class seen as a label or a prediction."""
    hit = F.when(F.col("y") == F.col("pred"), F.col("n")).otherwise(0)
    roles = F.array(
        F.struct(F.col("y").alias("class"), F.col("n").alias("support"), F.lit(0).alias("predicted"), hit.alias("hits")),
        F.struct(F.col("pred").alias("class"), F.lit(0).alias("support"), F.col("n").alias("predicted"), F.lit(0).alias("hits")),
    )
    sums = (
        pair_counts(df, label, pred, by)
        .select(*by, F.inline(roles))
        .groupBy(*by, "class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )
    return sums.select(
        *by,
        "class",
        _ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        _ratio(F.col("hits"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("hits"), F.col("support") + F.col("predicted")).alias("f1"),
        "support",
        "hits",
    )


def classification_metrics(df: DataFrame, label: str = "y", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, macro precision, recall and F1, support-weighted F1: one row per group."""
    support = F.sum("support")
    return (
        class_scores(df, label, pred, by)
        .groupBy(*by)
        .agg(
            _ratio(F.sum("hits"), support).alias("accuracy"),
            F.avg("precision").alias("precision_macro"),
            F.avg("recall").alias("recall_macro"),
            F.avg("f1").alias("f1_macro"),
            (F.sum(F.col("f1") * F.col("support")) / support).alias("f1_weighted"),
            support.alias("row_count"),
        )
    )


def classification_report(df: DataFrame, label: str = "y", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """Per-class rows followed by accuracy, macro average and weighted average."""
    rows = class_scores(df, label, pred, by)
    support = F.sum("support")

    def weighted(c: str) -> Column:
        return F.sum(F.col(c) * F.col("support")) / support

    measures = ("precision", "recall", "f1")
    averages = rows.groupBy(*by).agg(
        _ratio(F.sum("hits"), support).alias("__accuracy"),
        *[F.avg(c).alias(f"__macro_{c}") for c in measures],
        *[weighted(c).alias(f"__weighted_{c}") for c in measures],
        support.alias("support"),
    )
    accuracy = F.col("__accuracy")
    no_value = F.lit(None).cast("double")
    lines = F.array(
        F.struct(F.lit("accuracy").alias("entry"), F.lit(1).alias("line"), no_value.alias("precision"),
                 no_value.alias("recall"), accuracy.alias("f1")),
        *[
            F.struct(F.lit(f"{kind} avg").alias("entry"), F.lit(line).alias("line"),
                     *[F.col(f"__{kind}_{c}").alias(c) for c in measures])
            for line, kind in ((2, "macro"), (3, "weighted"))
        ],
    )
    per_class = rows.select(
        *by, F.col("class").cast("string").alias("entry"), F.lit(0).alias("line"), *measures, "support"
    )
    return per_class.unionByName(averages.select(*by, "support", F.inline(lines)))


# --- scores against probabilities --------------------------------------------------------------


def class_score_rows(df: DataFrame, probabilities: dict[str, str], label: str = "y", by: Sequence[str] = ()) -> DataFrame:
    """One row per (row, class) with the class's probability and whether the row is of that class."""
    listed = F.array(
        *[
            F.struct(
                F.lit(c).alias("class"),
                (F.col(p) + F.lit(0.0)).alias("score"),
                F.coalesce(F.col(label) == F.lit(c), F.lit(False)).cast("int").alias("positive"),
            )
            for c, p in probabilities.items()
        ]
    )
    return df.select(*by, F.inline(listed))


def roc_curve(df: DataFrame, probabilities: dict[str, str], label: str = "y", by: Sequence[str] = ()) -> DataFrame:
    """fpr and tpr at every distinct score of every class, highest score first.

    Equal scores are merged before the running sums, which go over score ranges, not one task.
    """
    keys = [*by, "class"]
    counts = (
        class_score_rows(df, probabilities, label, by)
        .groupBy(*keys, "score")
        .agg(F.sum("positive").alias("pos"), F.sum(1 - F.col("positive")).alias("neg"))
    )
    cum = running_totals(counts, keys, "score", ["pos", "neg"], descending=True)
    return cum.select(
        *keys,
        "score",
        "pos",
        "neg",
        F.try_divide("cum_neg", "total_neg").alias("fpr"),
        F.try_divide("cum_pos", "total_pos").alias("tpr"),
        "cum_pos",
        "total_pos",
        "total_neg",
    )


def auc_per_class(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Area by trapezoids, which gives tied scores their middle rank. Null when a class has one side only."""
    strip = F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2.0)
    pairs = F.max(F.col("total_pos").cast("double") * F.col("total_neg").cast("double"))
    both = (F.max("total_pos") > 0) & (F.max("total_neg") > 0)
    return curve.groupBy(*by, "class").agg(F.when(both, F.try_divide(F.sum(strip), pairs)).alias("auc"))


def roc_auc_macro(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean one-vs-rest area; null as soon as one class has none."""
    per_class = auc_per_class(curve, by)
    return per_class.groupBy(*by).agg(
        F.when(F.count("auc") == F.count(F.lit(1)), F.avg("auc")).alias("roc_auc_macro")
    )


def roc_interpolated(curve: DataFrame, points: int = 200, by: Sequence[str] = ()) -> DataFrame:
    """Macro-average curve on an even fpr grid.

    Curve points are first reduced to at most one span per grid cell and class. A grid value lies
    between the last point at or before it and the first point after it; both are running extremes
    over the grid, since fpr and tpr never fall along a curve.
    """
    step = F.lit(float(points - 1))
    keys = [*by, "class"]
    cell = F.ceil(F.col("fpr") * step - F.lit(1e-9)).cast("int")
    spans = (
        curve.select(*keys, cell.alias("i"), "fpr", "tpr")
        .groupBy(*keys, "i")
        .agg(
            F.min("fpr").alias("first_fpr"),
            F.min("tpr").alias("first_tpr"),
            F.max("fpr").alias("last_fpr"),
            F.max("tpr").alias("last_tpr"),
        )
    )
    sides = curve.groupBy(*by).agg(F.min(F.least("total_pos", "total_neg")).alias("least"))
    grid = spans.select(*keys).distinct().select(*keys, F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    along = Window.partitionBy(*keys).orderBy("i")
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    beyond = along.rowsBetween(1, Window.unboundedFollowing)
    ends = grid.join(spans, [*keys, "i"], "left").select(
        *keys,
        "i",
        F.coalesce(F.max("last_fpr").over(upto), F.lit(0.0)).alias("x0"),
        F.coalesce(F.max("last_tpr").over(upto), F.lit(0.0)).alias("y0"),
        F.min("first_fpr").over(beyond).alias("x1"),
        F.min("first_tpr").over(beyond).alias("y1"),
    )
    x = F.col("i") / step
    slope = F.try_divide(F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0"))
    tpr = F.coalesce(F.col("y0") + slope * (x - F.col("x0")), F.col("y0"))
    mean = ends.select(*by, F.col("i").alias("point"), x.alias("fpr"), tpr.alias("tpr")).groupBy(
        *by, "point", "fpr"
    ).agg(F.avg("tpr").alias("tpr"))
    # As with the area: a class with rows on one side only has no curve, so the mean has none.
    sides = sides.withColumn("__all", F.lit(0))
    mean = mean.withColumn("__all", F.lit(0)).join(sides, [*by, "__all"])
    return mean.select(*by, "point", "fpr", F.when(F.col("least") > 0, F.col("tpr")).alias("tpr"))


def calibration_curve(
    df: DataFrame, probabilities: dict[str, str], label: str = "y", bins: int = 6, by: Sequence[str] = ()
) -> DataFrame:
    """Mean predicted probability and share of positives per class and equal-width bin."""
    place = F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)).cast("int")
    return (
        class_score_rows(df, probabilities, label, by)
        .groupBy(*by, "class", place.alias("bin"))
        .agg(
            F.avg("score").alias("mean_predicted"),
            F.avg("positive").alias("fraction_positive"),
            F.count(F.lit(1)).alias("row_count"),
        )
    )


def fold_summary(scores: DataFrame, by: Sequence[str], score: str = "score") -> DataFrame:
    """Mean and population standard deviation over folds."""
    return scores.groupBy(*by).agg(
        F.avg(score).alias("score_mean"), F.stddev_pop(score).alias("score_std"), F.count(score).alias("folds")
    )
