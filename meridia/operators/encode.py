"""Column roles, scaling, one-hot, label codes and the ML feature vector."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def typed_columns(df: DataFrame, leave_out: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """Names of numeric (with boolean) and of text columns, in table order."""
    numeric, texts = [], []
    for field in df.schema.fields:
        if field.name in leave_out:
            continue
        if isinstance(field.dataType, (T.NumericType, T.BooleanType)):
            numeric.append(field.name)
        elif isinstance(field.dataType, T.StringType):
            texts.append(field.name)
    return numeric, texts


def split_features_and_target(df: DataFrame, target: str) -> tuple[list[str], str]:
    """Feature names and the target name; the label stays beside its features in one table."""
    if target not in df.columns:
        raise ValueError(f"target column `{target}` not found")
    return [c for c in df.columns if c != target], target


@dataclass(frozen=True)
class Scaling:
    """Means and population standard deviations learned on one table."""

    mean: dict[str, float]
    std: dict[str, float]

    def apply(self, df: DataFrame, prefix: str = "") -> DataFrame:
        scaled = {
            f"{prefix}{c}": (F.col(c).cast("double") - F.lit(m)) / F.lit(self.std[c]) for c, m in self.mean.items()
        }
        return df.withColumns(scaled)


def fit_scaling(train: DataFrame, columns: Sequence[str]) -> Scaling:
    """One aggregate over the training rows; a constant column is only centred."""
    exprs = []
    for c in columns:
        value = F.col(c).cast("double")
        exprs += [F.avg(value).alias(f"m_{c}"), F.stddev_pop(value).alias(f"s_{c}")]
    row = train.agg(*exprs).first()
    return Scaling({c: row[f"m_{c}"] for c in columns}, {c: row[f"s_{c}"] or 1.0 for c in columns})


def levels(df: DataFrame, column: str) -> list[str]:
    """Sorted distinct values of a category column, for what makes one column per level."""
    return sorted(r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().collect())


def one_hot(df: DataFrame, column: str, known: Sequence[str], prefix: str = "") -> DataFrame:
    """One 0/1 column per known level, named ``column_level``; an unseen level is 0 everywhere."""
    return df.withColumns(
        {f"{prefix}{column}_{v}": F.coalesce(F.col(column) == F.lit(v), F.lit(False)).cast("int") for v in known}
    )


def label_encode(df: DataFrame, label: str, out: str = "label_index", classes: Sequence[str] | None = None) -> DataFrame:
    """Labels to 0..K-1 in sorted order; without a class list by a dictionary joined to the rows."""
    if classes is not None:
        return df.withColumn(out, class_index(F.col(label), classes))
    known = df.select(F.col(label).alias("__level")).where("__level IS NOT NULL").distinct()
    known = known.withColumn(out, F.row_number().over(Window.orderBy("__level")) - 1)
    return df.drop(out).join(known, F.col(label) == F.col("__level"), "left").drop("__level")


def class_index(label: Column, classes: Sequence) -> Column:
    """Position of a label in a class list; null for a label outside it."""
    position = F.array_position(F.array(*[F.lit(c) for c in classes]), label)
    return F.when(position > 0, (position - 1).cast("int"))


def ovr_binarize(df: DataFrame, label: str, classes: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One 0/1 row per row and class, in long form."""
    listed = F.array(*[F.lit(c) for c in classes])
    return df.select(*keep, label, F.explode(listed).alias("class")).select(
        *keep, "class", (F.col(label) == F.col("class")).cast("int").alias("is_class")
    )


def preprocessor(scaled: Sequence[str], texts: Sequence[str], out: str = "features") -> Pipeline:
    """Already scaled numeric block, then one-hot text block, in one vector.

    ``handleInvalid="keep"`` adds a last slot for unseen levels and ``dropLast`` drops that slot, so
    all known levels stay and an unseen one is zero everywhere.
    """
    stages = []
    blocks = list(scaled)
    if texts:
        indexed = [f"__i_{c}" for c in texts]
        encoded = [f"__e_{c}" for c in texts]
        stages.append(
            StringIndexer(
                inputCols=list(texts), outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"
            )
        )
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True))
        blocks += encoded
    stages.append(VectorAssembler(inputCols=blocks, outputCol=out))
    return Pipeline(stages=stages)


@dataclass(frozen=True)
class Prepared:
    """A fitted preprocessor together with the names of the vector's slots."""

    scaling: Scaling
    model: PipelineModel
    names: list[str]

    def apply(self, df: DataFrame) -> DataFrame:
        made = self.model.transform(self.scaling.apply(df, prefix="__s_"))
        return made.select(*df.columns, "features")


def fit_preprocessor(train: DataFrame, numeric: Sequence[str], texts: Sequence[str]) -> Prepared:
    """Learn scaling and levels on the training rows only."""
    scaling = fit_scaling(train, numeric)
    scaled = [f"__s_{c}" for c in numeric]
    model = preprocessor(scaled, texts).fit(scaling.apply(train, prefix="__s_"))
    names = [f"numeric__{c}" for c in numeric]
    if texts:
        indexer = next(s for s in model.stages if hasattr(s, "labelsArray"))
        for c, known in zip(texts, indexer.labelsArray):
            names += [f"categorical__{c}_{v}" for v in known]
    return Prepared(scaling, model, names)


def keep_features(df: DataFrame, names: Sequence[str], kept: Sequence[str], out: str = "selected") -> DataFrame:
    """The sub-vector of the kept names, in their given order."""
    place = {n: i for i, n in enumerate(names)}
    return VectorSlicer(inputCol="features", outputCol=out, indices=[place[k] for k in kept]).transform(df)


def slots(vector: str, names: Sequence[str]) -> Column:
    """Explode a vector into (feature, value) rows."""
    listed = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("feature"), vector_to_array(vector).alias("value"))
    return F.inline(listed)
