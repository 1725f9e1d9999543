"""Stratified splits, folds and nested training subsets, all drawn by hash order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranks import hash_rank, running_totals


def train_sizes(class_sizes: dict[str, int], test_share: float = 0.2) -> dict[str, int]:
    """Training rows per class by largest remainder; the test side takes ceil(n * share) rows in all."""
    n = sum(class_sizes.values())
    n_test = -int(-(n * test_share) // 1)
    n_train = n - n_test
    exact = {c: k * n_train / n for c, k in class_sizes.items()}
    sizes = {c: int(v) for c, v in exact.items()}
    short = n_train - sum(sizes.values())
    by_remainder = sorted(exact, key=lambda c: (-(exact[c] - sizes[c]), str(c)))
    for c in by_remainder[:short]:
        sizes[c] += 1
    return sizes


def stratified_split(
    df: DataFrame, label: str, key: str, test_share: float = 0.2, seed: int = 42, out: str = "split"
) -> DataFrame:
    """``train`` or ``test`` per row, class shares kept; the first rows of each class in hash order train."""
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return df.withColumn(out, F.lit("train"))
    sizes = train_sizes(counts, test_share)
    limit = _per_class(F.col(label), sizes)
    ranked = hash_rank(df, [label], key, seed, rank="__rank")
    side = F.when(F.col("__rank") <= limit, F.lit("train")).otherwise(F.lit("test"))
    return ranked.withColumn(out, side).drop("__rank")


def _per_class(label: Column, sizes: dict) -> Column:
    chosen = F.lit(0)
    for c, n in sizes.items():
        match = label.isNull() if c is None else F.coalesce(label == F.lit(c), F.lit(False))
        chosen = F.when(match, F.lit(n)).otherwise(chosen)
    return chosen


def stratified_kfold(
    df: DataFrame, label: str, key: str, folds: int, seed: int = 42, shuffle: bool = True, out: str = "fold"
) -> DataFrame:
    """Fold 0..K-1 per row; per class the fold sizes differ by at most one.

    Shuffled folds deal the hash order round-robin. Unshuffled folds cut each class into K runs of
    consecutive rows in the order of a numeric key.
    """
    if shuffle:
        ranked = hash_rank(df, [label], key, seed, rank="__rank")
        return ranked.withColumn(out, F.pmod(F.col("__rank") - 1, F.lit(folds)).cast("int")).drop("__rank")
    counted = running_totals(df.withColumn("__one", F.lit(1)), [label], key, ["__one"])
    return counted.withColumn(
        out, F.floor((F.col("cum___one") - 1) * folds / F.col("total___one")).cast("int")
    ).drop("__one", "cum___one", "total___one")


def learning_subsets(
    df: DataFrame, by: Sequence[str], key: str, shares: Sequence[float], seed: int = 42
) -> DataFrame:
    """Nested subsets: one row per (row, point) it belongs to; point i holds the first share of each group."""
    points = F.array(
        *[F.struct(F.lit(i).alias("point"), F.lit(float(s)).alias("share")) for i, s in enumerate(shares)]
    )
    ranked = hash_rank(df, by, key, seed, rank="__rank", size="__size")
    wide = ranked.select("*", F.inline(points))
    return wide.where(F.col("__rank") <= F.floor(F.col("share") * F.col("__size") + F.lit(1e-9))).drop(
        "__rank", "__size"
    )
