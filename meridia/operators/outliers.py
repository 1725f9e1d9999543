"""Outlier flags: fences, z-scores, isolation forest and their consensus."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_int, hash_key
from ..functions.quantiles import exact_quantiles
from ..functions.trees import TreeTable


def _count_true(conditions: list[Column]) -> Column:
    return reduce(add, [F.coalesce(c, F.lit(False)).cast("int") for c in conditions], F.lit(0))


def iqr_outliers(
    df: DataFrame, columns: Sequence[str], factor: float = 1.5, out: str = "iqr_outlier_count"
) -> DataFrame:
    """Number of columns outside [Q1 - f*IQR, Q3 + f*IQR]."""
    fences = exact_quantiles(df, columns, [0.25, 0.75])
    conditions = []
    for c, (q1, q3) in fences.items():
        if q1 is not None:
            width = factor * (q3 - q1)
            conditions.append((F.col(c) < F.lit(q1 - width)) | (F.col(c) > F.lit(q3 + width)))
    return df.withColumn(out, _count_true(conditions))


def zscore_outliers(
    df: DataFrame, columns: Sequence[str], limit: float = 3.0, out: str = "zscore_outlier_count"
) -> DataFrame:
    """Number of columns with abs((x - mean) / population std) over the limit."""
    stats = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
    ).first()
    conditions = [
        F.abs((F.col(c) - F.lit(stats[f"m_{c}"])) / F.lit(stats[f"s_{c}"])) > limit
        for c in columns
        if stats[f"s_{c}"]
    ]
    return df.withColumn(out, _count_true(conditions))


def outlier_consensus(
    df: DataFrame, signals: Sequence[str], at_least: int = 2
) -> DataFrame:
    """How many methods fire on a row, and whether enough of them do."""
    fired = _count_true([F.col(s) > 0 for s in signals])
    return df.withColumn("outlier_consensus_count", fired).withColumn(
        "outlier_consensus_flag", (F.col("outlier_consensus_count") >= at_least).cast("int")
    )


# --- isolation forest (Liu, Ting & Zhou 2008) --------------------------------------------------

_TREE_SCHEMA = "tree int, node int, feature int, cut double, left_child int, right_child int, path double, sampled int"


def _expected_path(n: np.ndarray | int) -> np.ndarray:
    """Mean depth of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    harmonic = np.log(np.maximum(n - 1, 1)) + 0.5772156649015329
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def _grow_tree(tree: int, x: np.ndarray, seed: int) -> pd.DataFrame:
    """Random splits of at most a few hundred rows down to the mean search depth."""
    rng = np.random.default_rng([seed, tree])
    limit = int(np.ceil(np.log2(max(2, len(x)))))
    nodes: list[list] = []
    stack = [(np.arange(len(x)), 0, -1, 0)]
    while stack:
        rows, depth, parent, side = stack.pop()
        at = len(nodes)
        if parent >= 0:
            nodes[parent][4 + side] = at
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        open_features = np.flatnonzero(high > low)
        if depth >= limit or len(rows) < 2 or not len(open_features):
            nodes.append([tree, at, -1, 0.0, -1, -1, depth + float(_expected_path(len(rows)))])
            continue
        feature = int(rng.choice(open_features))
        # below the highest value even when the two differ by one bit, so that no side is empty
        cut = float(min(rng.uniform(low[feature], high[feature]), np.nextafter(high[feature], low[feature])))
        goes_left = x[rows, feature] <= cut
        nodes.append([tree, at, feature, cut, -1, -1, 0.0])
        stack.append((rows[goes_left], depth + 1, at, 0))
        stack.append((rows[~goes_left], depth + 1, at, 1))
    names = ["tree", "node", "feature", "cut", "left_child", "right_child", "path"]
    return pd.DataFrame(nodes, columns=names).assign(sampled=len(x))


def isolation_trees(
    df: DataFrame, columns: Sequence[str], key: str, trees: int = 100, sample: int = 256, seed: int = 42
) -> DataFrame:
    """One row per node. Each tree sees its own hash sample, so no task holds more than ``sample`` rows.

    Every row of the table may be drawn: a hash says how many trees it is offered to, so that each tree is
    offered about half again as many rows as it takes, and other hashes say which. A row offered to no
    tree, in a large table nearly all, costs one hash.
    """
    values = F.array(*[F.col(c).cast("double") for c in columns])
    each = min(1.0, (1.5 * sample + 60) / max(1, df.count())) * trees
    draw = F.pmod(F.xxhash64(F.lit(f"{seed}:offers"), F.col(key)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    offers = F.least(F.lit(trees), F.floor(F.lit(each) + draw).cast("int"))
    places = F.transform(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda t: F.struct(F.xxhash64(F.lit(f"{seed}:tree"), t, F.col("id")).alias("h"), t.alias("tree")),
    )
    pool = (
        df.select(F.col(key).alias("id"), values.alias("x"), offers.alias("offers"))
        .where("offers > 0")
        .select("id", "x", F.inline(F.slice(F.sort_array(places), F.lit(1), F.col("offers"))))
    )
    ranked = pool.withColumn("rn", F.row_number().over(Window.partitionBy("tree").orderBy("h", "id")))

    def grow(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        ordered = rows.sort_values("rn")
        return _grow_tree(int(group[0]), np.stack(ordered["x"].to_numpy()), seed)

    return ranked.where(F.col("rn") <= sample).groupBy("tree").applyInPandas(grow, _TREE_SCHEMA)


def isolation_forest(
    df: DataFrame,
    columns: Sequence[str],
    key: str,
    contamination: float = 0.05,
    trees: int = 100,
    sample: int = 256,
    seed: int = 42,
    score: str = "isolation_score",
    flag: str = "isolation_forest_flag",
) -> DataFrame:
    """Adds the anomaly score and a flag on the share ``contamination`` of highest scores.

    The forest is at most ``trees * 2 * sample`` small nodes, whatever the table; every batch of
    rows is walked through all trees at once.
    """
    nodes = isolation_trees(df, columns, key, trees, sample, seed).toPandas().sort_values(["tree", "node"])
    start = nodes.groupby("tree")["node"].size().cumsum().shift(fill_value=0)
    shift = nodes["tree"].map(start).to_numpy()
    leaf = nodes["feature"].to_numpy() < 0
    forest = TreeTable(
        roots=start.to_numpy(),
        output=np.zeros(len(start), dtype=int),
        feature=np.where(leaf, 0, nodes["feature"]),
        above=np.full(len(nodes), -np.inf),
        upto=nodes["cut"].to_numpy(),
        left=np.where(leaf, shift + nodes["node"], shift + nodes["left_child"]),
        right=np.where(leaf, shift + nodes["node"], shift + nodes["right_child"]),
        value=nodes["path"].to_numpy(),
        depth=int(np.ceil(np.log2(max(2, sample)))),
    )
    norm = max(1e-12, float(_expected_path(nodes["sampled"].max())))
    shared = df.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def walk(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for batch in batches:
            x = np.column_stack([s.to_numpy(dtype=float) for s in batch])
            mean_path = shared.value.score(x)[:, 0] / len(shared.value.roots)
            yield pd.Series(np.power(2.0, -mean_path / norm))

    scored = df.withColumn(score, walk(*[F.col(c).cast("double") for c in columns]))
    scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
    cut = exact_quantiles(scored, [score], [1 - contamination])[score][0]
    return scored.withColumn(flag, (F.col(score) > F.lit(cut)).cast("int"))
