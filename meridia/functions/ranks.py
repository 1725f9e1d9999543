"""Ranks and running totals over whole tables without a one-task window.

``row_number() over (partition by class order by key)`` puts a whole class into one task. Here the
order is first cut into buckets; every bucket is ranked on its own and shifted by the number of
rows in the buckets before it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .hashing import hash_key

_BEFORE = "__before"


def _group_keys(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Text copies of the group columns in which null is a value, so that joins keep null groups."""
    names = [f"__g{i}" for i in range(len(by))]
    for name, source in zip(names, by):
        text = F.col(f"`{source}`").cast("string")
        df = df.withColumn(name, F.when(text.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), text)))
    return df, names


def hash_rank(
    df: DataFrame,
    by: Sequence[str],
    key: str,
    seed: int | str = 42,
    rank: str = "rank",
    size: str | None = None,
    bucket_digits: int | None = None,
) -> DataFrame:
    """1-based position of each row inside its group, in the order of its hash.

    The leading hex digits of the hash are the bucket: uniform whatever the data, known without
    sampling, and the same after a retry. The join back needs no second shuffle of the rows, because
    the window already placed them by the join key.
    """
    if bucket_digits is None:
        # at least 16 buckets per shuffle partition
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        bucket_digits = max(3, math.ceil(math.log(max(2, partitions), 16)) + 1)
    keyed, groups = _group_keys(df, by)
    keyed = keyed.withColumn("__h", hash_key(seed, key))
    keyed = keyed.withColumn("__b", F.substring("__h", 1, bucket_digits))
    offsets = _bucket_offsets(keyed.groupBy(*groups, "__b").agg(F.count(F.lit(1)).alias("__n")), groups, ["__n"])
    local = F.row_number().over(Window.partitionBy(*groups, "__b").orderBy("__h", key))
    ranked = keyed.withColumn("__r", local).join(offsets, [*groups, "__b"])
    result = ranked.withColumn(rank, F.col("__r") + F.col(f"{_BEFORE}__n"))
    if size:
        result = result.withColumn(size, F.col("__total__n"))
    return result.select(*df.columns, rank, *([size] if size else []))


def _bucket_offsets(counts: DataFrame, groups: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Per bucket: the totals of all earlier buckets and of the whole group."""
    whole = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    earlier = whole.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    before = [F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"{_BEFORE}{v}") for v in values]
    total = [F.sum(v).over(whole).alias(f"__total{v}") for v in values]
    return counts.select(*groups, "__b", *before, *total)


def running_totals(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    values: Sequence[str],
    descending: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Inclusive running sums ``cum_x`` and group totals ``total_x`` in the order of a numeric column.

    ``df`` holds one row per (group, order value). The order is cut at approximate quantiles; only
    the balance of the work depends on them, never the result.
    """
    splits = range_splits(df, order, buckets)
    keyed, groups = _group_keys(df, by)
    keyed = keyed.withColumn("__o", F.col(order).cast("double") + F.lit(0.0))
    keyed = Bucketizer(splits=splits, inputCol="__o", outputCol="__b", handleInvalid="keep").transform(keyed)
    if descending:
        keyed = keyed.withColumn("__b", -F.col("__b"))
    internal = [f"__v{i}" for i in range(len(values))]
    for name, source in zip(internal, values):
        keyed = keyed.withColumn(name, F.col(source))
    counts = keyed.groupBy(*groups, "__b").agg(*[F.sum(v).alias(v) for v in internal])
    offsets = _bucket_offsets(counts, groups, internal)
    direction = F.col(order).desc() if descending else F.col(order).asc()
    window = (
        Window.partitionBy(*groups, "__b").orderBy(direction).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = keyed
    for name in internal:
        summed = summed.withColumn(f"__c{name}", F.sum(name).over(window))
    joined = summed.join(offsets, [*groups, "__b"])
    out = [F.col(f"`{c}`") for c in df.columns]
    for name, source in zip(internal, values):
        out.append((F.col(f"__c{name}") + F.col(f"{_BEFORE}{name}")).alias(f"cum_{source}"))
        out.append(F.col(f"__total{name}").alias(f"total_{source}"))
    return joined.select(*out)


def range_splits(df: DataFrame, column: str, buckets: int | None = None) -> list[float]:
    """Strictly increasing cut points, from -inf to inf, that split a column about evenly."""
    if buckets is None:
        buckets = min(4096, max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    grid = [i / buckets for i in range(1, buckets)]
    narrow = df.select((F.col(column).cast("double") + F.lit(0.0)).alias("x"))
    found = narrow.approxQuantile("x", grid, 1.0 / (4 * buckets))
    return [float("-inf"), *(sorted(set(found)) or [0.0]), float("inf")]


def even_grid(start: float, stop: float, n: int) -> Column:
    """Array of ``n`` evenly spaced doubles, both ends included."""
    if n < 2:
        raise ValueError("a grid needs at least two points")
    step = (stop - start) / (n - 1)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.lit(start) + i * F.lit(step))
