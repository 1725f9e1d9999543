"""Shapley values of tree ensembles: blocks of rows meet blocks of leaves.

A leaf adds its value to a row that passes all conditions on its path, so the values of an ensemble are sums
over leaves, and leaves can be dealt out. The paths are built on Spark, a tree in a task, and written. While all
of them are small they are broadcast and rows need no shuffle; beyond that every block of rows meets every block
of leaves under a salted key and Spark adds up the partial sums.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, shared_folder
from . import models, tables

# Leaves are broadcast while all of them together take no more bytes than this.
SHARED_BYTES = 1 << 25
# Bytes of leaves, and blocks of rows, that one task brings together beyond it.
PART_BYTES = 1 << 25
BLOCKS_A_GROUP = 16
ROWS_A_BLOCK = 2048
# Leaves in one row of the written table.
LEAVES_A_PIECE = 4096

_FIELDS = {"sizes": np.int32, "feature": np.int32, "low": np.float64, "high": np.float64, "share": np.float64,
           "value": np.float64}


@dataclass(frozen=True)
class Leaves:
    """Root-to-leaf paths, one after the other, with the conditions of a path merged per feature.

    A row passes a condition if ``low < x <= high``; ``share`` is the part of the training rows that does.
    Leaf i has ``sizes[i]`` conditions and adds ``value[i]`` to the outputs.
    """

    sizes: np.ndarray
    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    value: np.ndarray

    @staticmethod
    def read(table: pa.Table, outputs: int) -> Leaves:
        """All leaves of the rows of a table written by ``ensemble_leaves``."""
        columns = {}
        for name, kind in _FIELDS.items():
            parts = [np.frombuffer(v, kind) for v in table.column(name).to_pylist()]
            columns[name] = np.concatenate(parts) if parts else np.zeros(0, kind)
        columns["value"] = columns["value"].reshape(-1, outputs)
        return Leaves(**columns)


def tree_nodes(fitted: models.Fitted) -> DataFrame:
    """All nodes of the ensemble, one row each, from Spark's own saved form in the shared folder."""
    core = fitted.core
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    made = None
    for i, part in enumerate([core] if fitted.name == models.FOREST else core.models):
        path = f"{shared_folder(spark).rstrip('/')}/trees-{uuid.uuid4().hex}"
        part.write().save(path)
        rows = spark.read.parquet(f"{path}/data").select(
            F.lit(i).alias("output"),
            F.col("treeID").alias("tree"),
            F.col("nodeData.id").alias("node"),
            F.col("nodeData.prediction").alias("prediction"),
            F.col("nodeData.impurityStats").alias("stats"),
            F.col("nodeData.rawCount").cast("double").alias("cover"),
            F.col("nodeData.leftChild").alias("left"),
            F.col("nodeData.rightChild").alias("right"),
            F.col("nodeData.split.featureIndex").alias("feature"),
            F.col("nodeData.split.leftCategoriesOrThreshold").alias("cut"),
            F.col("nodeData.split.numCategories").alias("categories"),
            F.get(F.lit([float(w) for w in part.treeWeights]), F.col("treeID")).alias("weight"),
        )
        made = rows if made is None else made.unionAll(rows)
    return made


def ensemble_leaves(fitted: models.Fitted) -> DataFrame:
    """Paths of all leaves in pieces of at most ``LEAVES_A_PIECE``, with their part of every output's mean.

    A leaf's value is a class probability (forest) or a margin (booster).
    """
    if fitted.name not in (models.FOREST, models.BOOSTING):
        raise ValueError(f"{fitted.name} is no tree ensemble")
    nodes = tree_nodes(fitted)
    if (nodes.agg(F.max("categories")).first()[0] or 0) > 2:
        raise ValueError("splits over more than two categories are not explained; one-hot such features")
    outputs = len(fitted.classes)
    trees = len(fitted.core.treeWeights) if fitted.name == models.FOREST else None

    def value_of(node) -> np.ndarray:
        value = np.zeros(outputs)
        if trees:
            stats = np.asarray(node.stats, dtype=float)
            value[: len(stats)] = stats / stats.sum() / trees
        else:
            value[node.output] = node.prediction * node.weight
        return value

    def walk(tree: pd.DataFrame) -> pd.DataFrame:
        by_id = {n.node: n for n in tree.itertuples()}
        stack, found, pieces = [(by_id[0], {})], [], []
        while stack:
            node, seen = stack.pop()
            if node.left < 0:
                found.append((seen, value_of(node)))
                if len(found) == LEAVES_A_PIECE or not stack:
                    pieces.append(_piece(found))
                    found = []
                continue
            for child, (above, upto) in zip((by_id[node.left], by_id[node.right]), _sides(node)):
                low, high, share = seen.get(node.feature, (-np.inf, np.inf, 1.0))
                met = (max(low, above), min(high, upto), share * child.cover / node.cover)
                stack.append((child, {**seen, node.feature: met}))
        made = pd.DataFrame(pieces)
        made.insert(0, "piece", range(len(made)))
        made.insert(0, "tree", tree["tree"].iloc[0])
        made.insert(0, "output", tree["output"].iloc[0])
        return made

    packed = ", ".join(f"{name} binary" for name in _FIELDS)
    schema = f"output int, tree int, piece int, bytes long, {packed}, base array<double>"
    return materialize(nodes.groupBy("output", "tree").applyInPandas(walk, schema), "leaves")


def _piece(found: Sequence[tuple[dict, np.ndarray]]) -> dict:
    conditions = [(f, *seen[f]) for seen, _ in found for f in sorted(seen)]
    feature, low, high, share = zip(*conditions) if conditions else ((), (), (), ())
    value = np.array([v for _, v in found])
    columns = {"sizes": [len(seen) for seen, _ in found], "feature": feature, "low": low, "high": high,
               "share": share, "value": value.reshape(-1)}
    packed = {name: np.asarray(columns[name], kind).tobytes() for name, kind in _FIELDS.items()}
    reached = np.array([math.prod(c[2] for c in seen.values()) for seen, _ in found])
    return {"bytes": sum(map(len, packed.values())), **packed, "base": (reached @ value).tolist()}


def _sides(node) -> tuple[tuple[float, float], tuple[float, float]]:
    """Value intervals (above, up to] of the left and the right child. One-hot slots split by 0 or 1."""
    if node.categories < 0:
        at = float(node.cut[0])
        return (-np.inf, at), (at, np.inf)
    zero_side, one_side = (-np.inf, 0.5), (0.5, np.inf)
    return (zero_side, one_side) if 0.0 in list(node.cut) else (one_side, zero_side)


def leaf_values(passes: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Shapley value of each condition of one leaf of value 1, for each row of pass/fail flags.

    A coalition without a feature follows both branches by their shares, so its worth is the product of flags
    inside and shares outside. The weight s! (d - 1 - s)! / d! of a coalition of s members is the integral of
    t^s (1 - t)^(d - 1 - s) over 0 to 1. So the sum over coalitions is the integral of one product of linear
    terms, which Gauss-Legendre nodes give exactly. Every factor is above 0, so one can be divided out.
    """
    d = len(share)
    nodes, weights = np.polynomial.legendre.leggauss((d + 1) // 2)
    t = (nodes + 1) / 2
    factors = share * (1 - t)[:, None] + passes[:, None, :] * t[:, None]
    whole = factors.prod(axis=-1) * (weights / 2)
    return (passes - share) * np.einsum("rq,rqd->rd", whole, 1 / factors)


def shapley_matrix(x: np.ndarray, leaves: Leaves) -> np.ndarray:
    """One row of (feature, output) values per row of ``x``. A missing number goes right, as Spark sends it.

    Rows that pass the same conditions of a leaf are worked out once: the flags are read as a number, which finds
    the values in a table of all patterns, or of those that occur if there could be more patterns than rows.
    """
    n, p = x.shape
    outputs = leaves.value.shape[1]
    columns = np.where(np.isnan(x.T), np.inf, x.T)
    total = np.zeros((p, outputs, n))
    stop = 0
    for size, value in zip(leaves.sizes, leaves.value):
        start, stop = stop, stop + size
        if not size:
            continue
        features = leaves.feature[start:stop]
        code = np.zeros(n, np.int64)
        for j, f in enumerate(features):
            code |= ((columns[f] > leaves.low[start + j]) & (columns[f] <= leaves.high[start + j])).astype(np.int64) << j
        if 1 << int(size) <= n:
            patterns, which = np.arange(1 << int(size)), code
        else:
            patterns, which = np.unique(code, return_inverse=True)
        phi = leaf_values((patterns[:, None] >> np.arange(size)) & 1, leaves.share[start:stop])
        for j, f in enumerate(features):
            for o in np.flatnonzero(value):
                total[f, o] += (phi[:, j] * value[o])[which]
    return total.reshape(p * outputs, n).T


def _lists(matrix: np.ndarray) -> pa.ListArray:
    n, width = matrix.shape
    flat = np.ascontiguousarray(matrix).reshape(-1)
    return pa.ListArray.from_arrays(np.arange(0, n * width + 1, width, dtype=np.int32), pa.array(flat))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1)


def tree_shap(
    fitted: models.Fitted,
    df: DataFrame,
    names: Sequence[str],
    key: str,
    shared_bytes: int = SHARED_BYTES,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Path-dependent Shapley values: one row per (row, class, feature) with ``base``, the mean output.

    ``base`` plus the row's values is the model's output for the class. Leaves of more than ``shared_bytes``
    are not broadcast but meet the rows in parts of about ``part_bytes``. Rows without features are left out;
    rows with equal keys each get their values.
    """
    leaves = ensemble_leaves(fitted)
    outputs = len(fitted.classes)
    size = leaves.agg(F.sum("bytes")).first()[0]
    means = leaves.select(F.posexplode("base")).groupBy("pos").agg(F.sum("col").alias("mean")).orderBy("pos").collect()
    rows = df.where(F.col("features").isNotNull()).select(key, vector_to_array("features").alias("x"))
    kind = df.schema[key].dataType.simpleString()
    if size <= shared_bytes:
        cells = _with_shared(rows, key, kind, leaves, outputs).select(key, "x", F.posexplode("phi"))
        cells = cells.withColumn("feature_value", F.get("x", _slot(outputs)))
    else:
        cells = _in_parts(rows, key, kind, leaves, outputs, math.ceil(size / part_bytes))
    output = (F.col("pos") % outputs).cast("int")
    return cells.select(
        key,
        F.get(F.lit(list(names)), _slot(outputs)).alias("feature"),
        F.get(F.lit(list(fitted.classes)), output).alias("class"),
        F.col("col").alias("shap"),
        "feature_value",
        F.get(F.lit([float(m["mean"]) for m in means]), output).alias("base"),
    )


def _slot(outputs: int):
    return F.floor(F.col("pos") / outputs).cast("int")


def _with_shared(rows: DataFrame, key: str, kind: str, leaves: DataFrame, outputs: int) -> DataFrame:
    """(key, x, phi) of every row, with all leaves in every executor."""
    shared = rows.sparkSession.sparkContext.broadcast(Leaves.read(leaves.select(*_FIELDS).toArrow(), outputs))

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_A_BLOCK):
                cut = batch.slice(start, ROWS_A_BLOCK)
                phi = shapley_matrix(_matrix(cut.column(1)), shared.value)
                yield pa.RecordBatch.from_arrays([*cut.columns, _lists(phi)], names=[key, "x", "phi"])

    return rows.mapInArrow(explain, f"`{key}` {kind}, x array<double>, phi array<double>")


def _in_parts(rows: DataFrame, key: str, kind: str, leaves: DataFrame, outputs: int, parts: int) -> DataFrame:
    """(key, pos, col, feature_value): blocks of rows meet parts of leaves; partial sums are added up.

    A group holds one part of the leaves and about ``BLOCKS_A_GROUP`` blocks of rows, so no task sees more,
    whatever the table or the ensemble.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_A_BLOCK):
                cut = batch.slice(start, ROWS_A_BLOCK)
                x = _matrix(cut.column(1))
                keys = pa.concat_arrays([cut.column(0)])
                packed = [pa.array([x.tobytes()], pa.binary()), pa.array([x.shape[1]], pa.int32())]
                listed = pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys)
                yield pa.RecordBatch.from_arrays([listed, *packed], names=["keys", "x", "width"])

    blocks = rows.mapInArrow(pack, f"keys array<{kind}>, x binary, width int")
    # the number of a block is fixed by writing it
    blocks = materialize(blocks.withColumn("block", F.monotonically_increasing_id()), "row-blocks")
    salts = max(1, math.ceil(blocks.count() / BLOCKS_A_GROUP))
    asking = blocks.withColumns(
        {
            "salt": F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int"),
            "part": F.explode(F.sequence(F.lit(0), F.lit(parts - 1))),
        }
    )
    giving = leaves.select(
        *_FIELDS,
        F.pmod(F.xxhash64("output", "tree", "piece"), F.lit(parts)).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
    )

    def meet(asked: pa.Table, given: pa.Table) -> pa.Table:
        held = Leaves.read(given, outputs)
        made = []
        for block in asked.to_batches():
            for i in range(block.num_rows):
                keys = block.column("keys")[i].values
                x = np.frombuffer(block.column("x")[i].as_py(), np.float64).reshape(len(keys), -1)
                n = len(keys)
                number = pa.array(np.full(n, block.column("block")[i].as_py()), pa.int64())
                columns = [number, pa.array(np.arange(n), pa.int32()), keys, _lists(x), _lists(shapley_matrix(x, held))]
                made.append(pa.RecordBatch.from_arrays(columns, schema=result))
        return pa.Table.from_batches(made, result)

    key_type = rows.select(key).limit(0).toArrow().schema.field(0).type
    doubles = pa.list_(pa.float64())
    result = pa.schema(
        [("block", pa.int64()), ("at", pa.int32()), (key, key_type), ("x", doubles), ("phi", doubles)]
    )
    met = asking.groupBy("part", "salt").cogroup(giving.groupBy("part", "salt")).applyInArrow(
        meet, f"block long, at int, `{key}` {kind}, x array<double>, phi array<double>"
    )
    cells = met.select("block", "at", key, "x", F.posexplode("phi"))
    cells = cells.withColumn("feature_value", F.get("x", _slot(outputs)))
    return cells.groupBy("block", "at", key, "pos", "feature_value").agg(F.sum("col").alias("col"))


def shap_importance(values: DataFrame, k: int = 15) -> DataFrame:
    """Mean absolute Shapley value per feature over rows and classes, the highest k."""
    mean = values.groupBy("feature").agg(F.avg(F.abs("shap")).alias("mean_abs_shap"))
    return tables.topk(mean, "mean_abs_shap", k, "feature")


def shap_points(values: DataFrame, key: str, first_class: str) -> DataFrame:
    """(row, feature, Shapley value, feature value) of one class."""
    return values.where(F.col("class") == first_class).select(key, "feature", "shap", "feature_value")
