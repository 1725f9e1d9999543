"""Class balance: the rule, SMOTE and ADASYN."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_key
from ..functions.ranks import hash_rank
from ..session import materialize
from .neighbors import knn_join

# The label of a skipped balancing and the limits that decide on it.
SKIPPED = "Skipped (already balanced)"
MIN_SHARE = 0.2
MIN_COUNT = 6
NEIGHBORS = 5


def balance_decision(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Smallest class, its share, and what to do about it, per group."""
    counts = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n"))
    least = counts.groupBy(*by).agg(
        F.min("n").alias("min_count"), F.sum("n").alias("row_count"), F.max("n").alias("max_count")
    )
    share = F.col("min_count") / F.col("row_count")
    strategy = (
        F.when(share >= MIN_SHARE, SKIPPED).when(F.col("min_count") < MIN_COUNT, "ADASYN").otherwise("SMOTE")
    )
    return least.withColumn("min_share", share).withColumn("strategy", strategy)


def balance(df: DataFrame, label: str, key: str, vector: str, seed: int = 42) -> tuple[DataFrame, str]:
    """The training rows with synthetic ones added where the rule asks for them, and the rule's name."""
    rule = balance_decision(df, label).first()
    if rule["strategy"] == SKIPPED:
        return df.select(key, label, vector), SKIPPED
    if rule["strategy"] == "ADASYN":
        made = adasyn(df, label, key, vector, neighbors=max(1, rule["min_count"] - 1), seed=seed)
    else:
        made = smote(df, label, key, vector, seed=seed)
    keyed = df.select(F.col(key).cast("string").alias(key), label, vector)
    return keyed.unionByName(made.select(F.col("synthetic_id").alias(key), label, vector)), rule["strategy"]


def _class_sizes(df: DataFrame, label: str) -> dict:
    rows = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()
    return {r[label]: r["n"] for r in rows}


def _lookup(column: Column, values: dict) -> Column:
    chosen = F.lit(None).cast("bigint")
    for key, value in values.items():
        chosen = F.when(column == F.lit(key), F.lit(value).cast("bigint")).otherwise(chosen)
    return chosen


def smote(
    df: DataFrame, label: str, key: str, vector: str, neighbors: int = NEIGHBORS, seed: int = 42
) -> DataFrame:
    """Synthetic rows that raise every smaller class to the size of the largest.

    The synthetic rows are dealt over the rows of the class in hash order.
    """
    sizes = _class_sizes(df, label)
    most = max(sizes.values())
    small = {c: n for c, n in sizes.items() if n < most}
    if any(n < 2 for n in small.values()):
        raise ValueError("a class with a single row has no neighbour to move towards")
    minority = df.where(F.col(label).isin(list(small))).select(key, label, vector)
    ranked = hash_rank(minority, [label], key, seed, rank="__rank")
    need = _lookup(F.col(label), {c: most - n for c, n in small.items()})
    size = _lookup(F.col(label), small)
    share = F.floor(need / size) + (F.col("__rank") <= F.pmod(need, size)).cast("bigint")
    dealt = ranked.withColumn("copies", share.cast("int")).select(key, label, vector, "copies")
    near = knn_join(minority, key, vector, neighbors, group=label)
    return interpolate(dealt, near, minority, label, key, vector, seed)


def interpolate(
    dealt: DataFrame, near: DataFrame, donors: DataFrame, label: str, key: str, vector: str, seed: int
) -> DataFrame:
    """``copies`` new rows per row, each a hash-drawn step towards a hash-drawn neighbour."""
    lists = near.groupBy(key).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "neighbor"))), lambda n: n["neighbor"]).alias("near")
    )
    draws = (
        dealt.where(F.col("copies") > 0)
        .join(lists, key)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .withColumn("__h", hash_key(seed, F.col(key), F.col("copy")))
    )
    pick = F.conv(F.substring("__h", 1, 8), 16, 10).cast("bigint")
    step = F.conv(F.substring("__h", 9, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
    chosen = draws.select(
        key,
        label,
        vector,
        "copy",
        F.element_at("near", (F.pmod(pick, F.size("near")) + 1).cast("int")).alias("neighbor"),
        step.alias("step"),
    )
    donor = donors.select(F.col(key).alias("neighbor"), F.col(vector).alias("__to"))
    moved = F.zip_with(vector, "__to", lambda a, b: a + F.col("step") * (b - a))
    return chosen.join(donor, "neighbor").select(
        F.concat_ws("#", F.col(key).cast("string"), F.col("copy").cast("string")).alias("synthetic_id"),
        F.col(key).alias("base"),
        "neighbor",
        "copy",
        label,
        moved.alias(vector),
    )


def adasyn_weights(
    df: DataFrame, label: str, key: str, vector: str, neighbors: int = NEIGHBORS
) -> DataFrame:
    """Per row of a smaller class: share of other-class neighbours, its weight, and its synthetic rows."""
    sizes = _class_sizes(df, label)
    most = max(sizes.values())
    small = {c: n for c, n in sizes.items() if n < most}
    rows = df.where(F.col(label).isin(list(small))).select(key, label, vector)
    near = knn_join(df, key, vector, neighbors, queries=rows)
    classes = df.select(F.col(key).alias("neighbor"), F.col(label).alias("__theirs"))
    other = (
        near.join(classes, "neighbor")
        .join(rows.select(key, label), key)
        .groupBy(key, label)
        .agg((F.count_if(F.col("__theirs") != F.col(label)) / F.lit(neighbors)).alias("other_share"))
    )
    # written, so that the neighbours are not searched again after the totals
    other = materialize(other, "adasyn-shares")
    totals = other.groupBy(label).agg(F.sum("other_share").alias("t")).collect()
    total = F.lit(None).cast("double")
    for r in totals:
        total = F.when(F.col(label) == F.lit(r[label]), F.lit(r["t"])).otherwise(total)
    need = _lookup(F.col(label), {c: most - n for c, n in small.items()})
    weighted = other.withColumn("weight", F.try_divide(F.col("other_share"), total))
    return weighted.withColumn("copies", F.rint(F.coalesce(F.col("weight"), F.lit(0.0)) * need).cast("int"))


def adasyn(
    df: DataFrame, label: str, key: str, vector: str, neighbors: int = NEIGHBORS, seed: int = 42
) -> DataFrame:
    """Synthetic rows, more of them where a smaller class lies among other classes."""
    weights = adasyn_weights(df, label, key, vector, neighbors).persist()
    if not weights.where(F.col("copies") > 0).take(1):
        raise ValueError("no row of a smaller class has a neighbour of another class; use SMOTE")
    classes = [r[0] for r in weights.select(label).distinct().collect()]
    lone = [c for c, n in _class_sizes(df, label).items() if c in classes and n < 2]
    if lone:
        raise ValueError(f"classes of one row have no neighbour of their own: {lone}")
    minority = df.where(F.col(label).isin(classes)).select(key, label, vector)
    near = knn_join(minority, key, vector, neighbors, group=label)
    dealt = weights.select(key, label, "copies").join(minority.select(key, vector), key)
    return interpolate(dealt, near, minority, label, key, vector, seed)
