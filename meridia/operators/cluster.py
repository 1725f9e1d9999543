"""Clusterings, projections and how well they fit."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.blocks import dense_blocks
from ..functions.hashing import hash_int, hash_key
from . import lloyd
from .neighbors import MEETING_PARTITIONS, NARROW, as_udf, bundle_rows, fresh, matrix, pair_distances, squared_distances
from .neighbors import nearest as closest

MICRO_CLUSTERS = 400
# Below this share of the norms a squared distance is taken from the differences, not from the product.
CANCELS = 1e-4
TILE = (512, 2048)


def as_vectors(df: DataFrame, array: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(array)))


def kmeans(
    df: DataFrame, k: int, features: str = "features", starts: int = 10, seed: int = 42, out: str = "cluster"
):
    """The best of several starts by inertia: (its run, inertia, rows with their cluster)."""
    with dense_blocks(df, features) as blocks:
        best = lloyd.best_runs(lloyd.many_runs(blocks, [k], starts, seed))[k]
    return best, best.inertia, best.transform(df, features, out)


def class_centers(df: DataFrame, label: str, array: str) -> dict:
    """Mean vector per class: K arrays."""
    means = df.groupBy(label).agg(Summarizer.mean(array_to_vector(array)).alias("c")).collect()
    return {r[label]: r["c"].toArray().tolist() for r in sorted(means, key=lambda r: r[label])}


def assign_to_centers(df: DataFrame, centers: dict, array: str, out: str = "cluster") -> DataFrame:
    """Nearest of K fixed centres (the first on a tie) and the squared distance to it."""
    names = list(centers)
    shared = df.sparkSession.sparkContext.broadcast(np.array([centers[c] for c in names], dtype=float))

    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                yield pd.DataFrame({"i": [], "d2": []})
                continue
            at, d2 = closest(np.stack(batch.to_numpy()), shared.value)
            yield pd.DataFrame({"i": at, "d2": d2})

    found = df.withColumn("__n", F.pandas_udf(as_udf(nearest), "i int, d2 double")(F.col(array)))
    listed = F.array(*[F.lit(c) for c in names])
    return found.withColumn(out, F.element_at(listed, F.col("__n.i") + 1)).withColumn(
        "squared_distance", F.col("__n.d2")
    ).drop("__n")


def inertia(assigned: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return assigned.groupBy(*by).agg(
        F.sum("squared_distance").alias("inertia"), F.count(F.lit(1)).alias("row_count")
    )


def silhouette_squared(df: DataFrame, features: str = "features", cluster: str = "cluster") -> float:
    """Mean silhouette under squared Euclidean distance: linear in the rows, from cluster sums alone."""
    return ClusteringEvaluator(
        featuresCol=features, predictionCol=cluster, metricName="silhouette", distanceMeasure="squaredEuclidean"
    ).evaluate(df)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances of two blocks by a matrix product; where much would cancel, from the differences."""
    if a.shape[1] <= NARROW:
        return np.sqrt(squared_distances(a, b))
    middle = b.mean(axis=0)
    a0, b0 = a - middle, b - middle
    a2, b2 = np.einsum("ij,ij->i", a0, a0), np.einsum("ij,ij->i", b0, b0)
    norms = a2[:, None] + b2[None, :]
    total = a0 @ (-2.0 * b0.T)
    total += norms
    norms *= CANCELS
    close = np.flatnonzero(~(total > norms))
    if 4 * len(close) > total.size:
        return np.sqrt(squared_distances(a, b))
    for at in range(0, len(close), 1 << 16):
        i, j = np.divmod(close[at : at + (1 << 16)], len(b))
        total[i, j] = pair_distances(a[i], b[j])
    return np.sqrt(total, out=total)


def silhouette_euclidean(df: DataFrame, key: str, array: str, cluster: str, block_rows: int = 1024) -> DataFrame:
    """Per row: a (own cluster), b (nearest other cluster) and the silhouette under Euclidean distance.

    Mean Euclidean distances have no closed form, so the work is quadratic in the distinct rows; use
    ``silhouette_squared`` on large tables. Two blocks of bounded size meet once in one task, which
    returns a sum per row and cluster for the rows of both, never the pairs; copies are merged into weights first.
    """
    sites = df.groupBy(F.col(array).alias("x"), F.col(cluster).alias("c")).agg(
        F.count(F.lit(1)).alias("w"), F.min(key).alias("rep")
    ).persist()
    found = sites.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("width")).first()
    blocks = max(1, math.ceil(found["n"] / bundle_rows(found["n"], found["width"] or 1, block_rows)))
    placed = sites.withColumn("block", F.pmod(hash_int(hash_key("block", "rep")), F.lit(blocks)).cast("int"))
    every = F.sequence(F.lit(0), F.lit(blocks - 1))
    meetings = min(MEETING_PARTITIONS, blocks * (blocks + 1) // 2)
    # a row goes to the pairs (smaller block, larger block) that hold its own
    meeting = placed.withColumn("other", F.explode(every)).select(
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        (F.col("block") <= F.col("other")).alias("first"),
        *fresh("rep", "x", "c", "w"),
    ).repartition(meetings, "i", "j")
    rep_kind = df.schema[key].dataType.simpleString()
    c_kind = df.schema[cluster].dataType.simpleString()

    def sums(rows: pa.Table) -> pa.Table:
        made = pa.schema([("rep", rows.schema.field("rep").type), ("to", rows.schema.field("c").type), ("total", pa.float64())])
        first = rows.column("first").to_numpy()
        within = rows.column("i")[0] == rows.column("j")[0]
        x, rep = matrix(rows.column("x")).astype(float), rows.column("rep").combine_chunks()
        coded = rows.column("c").combine_chunks().dictionary_encode()
        codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        names = coded.dictionary
        if not len(names):
            return made.empty_table()
        weight = np.zeros((len(x), len(names)))
        known = np.flatnonzero(codes >= 0)
        weight[known, codes[known]] = rows.column("w").to_numpy()[known]
        left = np.flatnonzero(first)
        right = left if within else np.flatnonzero(~first)
        totals = np.zeros((len(x), len(names)))
        for a in range(0, len(left), TILE[0]):
            mine = left[a : a + TILE[0]]
            for b in range(0, len(right), TILE[1]):
                theirs = right[b : b + TILE[1]]
                d = _distances(x[mine], x[theirs])
                totals[mine] += d @ weight[theirs]
                if not within:
                    totals[theirs] += d.T @ weight[mine]
        # clusters of the other block only
        row, to = [], []
        for ours, others in ((left, right),) if within else ((left, right), (right, left)):
            there = np.unique(codes[others][codes[others] >= 0])
            row.append(np.repeat(ours, len(there)))
            to.append(np.tile(there, len(ours)))
        row, to = np.concatenate(row), np.concatenate(to)
        columns = [rep.take(pa.array(row)), names.take(pa.array(to)), pa.array(totals[row, to])]
        return pa.table(columns, schema=made)

    totals = (
        meeting.groupBy("i", "j")
        .applyInArrow(sums, f"rep {rep_kind}, to {c_kind}, total double")
        .groupBy("rep", "to")
        .agg(F.sum("total").alias("total"))
    )
    sizes = sites.groupBy(F.col("c").alias("to")).agg(F.sum("w").alias("size"))
    own = F.col("to") == F.col("c")
    per_site = (
        totals.join(sizes, "to")
        .join(sites.select(*fresh("rep", "c")), "rep")
        .groupBy("rep", "c")
        .agg(
            F.max(F.when(own, F.try_divide(F.col("total"), F.col("size") - 1))).alias("a"),
            F.min(F.when(~own, F.col("total") / F.col("size"))).alias("b"),
            F.max(F.when(own, F.col("size"))).alias("own_size"),
        )
    )
    value = F.when(F.col("own_size") == 1, 0.0).otherwise(
        F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    )
    scored = sites.select(*fresh("x", "c", "rep")).join(per_site.drop("c"), "rep")
    return (
        df.select(key, F.col(array).alias("x"), F.col(cluster).alias("c"))
        .join(scored.select("x", "c", "a", "b", value.alias("silhouette")), ["x", "c"])
        .select(key, F.col("c").alias(cluster), "a", "b", "silhouette")
    )


def covariance_matrix(df: DataFrame, array: str) -> DataFrame:
    """Population covariance of every pair of dimensions ``i <= j``.

    Each task returns one centred product matrix of p x p numbers, so rows are not shuffled.
    """
    mean = df.select(Summarizer.mean(array_to_vector(array)).alias("m")).first()["m"].toArray()
    shared = df.sparkSession.sparkContext.broadcast(mean)
    p = len(mean)

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros((p, p)), 0
        for batch in batches:
            if len(batch):
                x = np.stack(batch["x"].to_numpy()) - shared.value
                total += x.T @ x
                n += len(x)
        if n:
            i, j = np.triu_indices(p)
            yield pd.DataFrame({"i": i.astype("int32"), "j": j.astype("int32"), "s": total[i, j], "n": n})

    parts = df.select(F.col(array).alias("x")).mapInPandas(products, "i int, j int, s double, n long")
    return parts.groupBy("i", "j").agg((F.sum("s") / F.sum("n")).alias("covariance"))


def pca_project(df: DataFrame, k: int = 2, features: str = "features") -> tuple[DataFrame, list[float]]:
    """Centred projection ``pc1..pck`` and the explained share of variance of each.

    Signs are fixed by making the largest loading of every component positive.
    """
    centred_model = StandardScaler(inputCol=features, outputCol="__c", withMean=True, withStd=False).fit(df)
    centred = centred_model.transform(df)
    model = PCA(k=k, inputCol="__c", outputCol="__p").fit(centred)
    loadings = model.pc.toArray()
    signs = np.sign(loadings[np.abs(loadings).argmax(axis=0), np.arange(k)])
    values = model.transform(centred).withColumn("__a", vector_to_array("__p"))
    projected = values.withColumns({f"pc{i + 1}": F.col("__a")[i] * F.lit(float(signs[i])) for i in range(k)})
    return projected.drop("__c", "__p", "__a"), [float(v) for v in model.explainedVariance]


def _ward(centers: np.ndarray, weights: np.ndarray, k: int) -> list[int]:
    """Merge weighted centres by least growth of within-cluster variance until k are left."""
    n = len(centers)
    centers, weights = centers.copy(), weights.astype(float)
    owner = np.arange(n)
    cost = squared_distances(centers, centers) * np.outer(weights, weights) / np.add.outer(weights, weights)
    np.fill_diagonal(cost, np.inf)
    for _ in range(max(0, n - k)):
        a, b = sorted(np.unravel_index(cost.argmin(), cost.shape))
        both = weights[a] + weights[b]
        centers[a] = (weights[a] * centers[a] + weights[b] * centers[b]) / both
        weights[a], weights[b] = both, 0.0
        owner[owner == b] = a
        cost[b, :] = cost[:, b] = np.inf
        alive = (weights > 0) & (np.arange(n) != a)
        grown = squared_distances(centers[a : a + 1], centers[alive])[0] * both * weights[alive] / (both + weights[alive])
        cost[a, alive] = cost[alive, a] = grown
    order = {o: i for i, o in enumerate(dict.fromkeys(owner))}
    return [order[o] for o in owner]


def hierarchical(
    df: DataFrame, k: int, array: str, key: str, micro: int = MICRO_CLUSTERS, seed: int = 42, out: str = "cluster"
) -> DataFrame:
    """Ward clusters: K-means brings a table of any size to at most ``micro`` weighted centres on the
    cluster, and those are merged.
    """
    model = KMeans(k=micro, seed=seed, featuresCol="__v").fit(as_vectors(df, array, "__v"))
    sizes = model.summary.clusterSizes
    used = [i for i, n in enumerate(sizes) if n]
    centers = np.array([model.clusterCenters()[i] for i in used])
    weights = np.array([sizes[i] for i in used])
    owner = _ward(centers, weights, k)
    placed = assign_to_centers(df, dict(enumerate(centers.tolist())), array, out="__micro").drop("squared_distance")
    listed = F.array(*[F.lit(o) for o in owner])
    return placed.withColumn(out, F.element_at(listed, F.col("__micro") + 1)).drop("__micro")


def elbow_sweep(
    df: DataFrame, ks: Sequence[int], array: str, key: str, starts: int = 10, seed: int = 42, metric: str = "squared"
) -> DataFrame:
    """Inertia and silhouette for each k, all starts of all k in one loop over the rows.

    ``metric="euclidean"`` is quadratic in the rows.
    """
    if metric not in ("squared", "euclidean"):
        raise ValueError(f"unknown silhouette metric {metric!r}")
    vectors = df.select(key, array)
    with dense_blocks(vectors, array) as blocks:
        best = lloyd.best_runs(lloyd.many_runs(blocks, list(ks), starts, seed))
        if metric == "squared":
            scores = lloyd.silhouettes(blocks, list(best.values()))
        else:
            placed = (run.transform(vectors, array) for run in best.values())
            each = (silhouette_euclidean(p, key, array, "cluster") for p in placed)
            scores = [e.agg(F.avg("silhouette")).first()[0] for e in each]
    rows = [(k, best[k].inertia, s, metric) for k, s in zip(best, scores, strict=True)]
    return df.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double, metric string")
