"""Multinomial gradient boosting on histograms: the trees of all classes of a round grow together.

The one-vs-rest booster of ``models`` fits its classes independently; here they share one deviance
(Friedman 2001). Features are cut into bins once. A level of a round's trees then takes one pass over the
rows, whatever the number of classes: it returns the sums of residuals, of their Newton weights and of rows per
(class, node, feature, bin). Only one child of each split is summed up, its sibling is what the parent has left.
Raw scores move along with the packed rows and are written to the shared folder every few rounds, so that lineage
and plans stay short.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.blocks import Block, Blocks, dense_blocks
from ..functions.trees import TreeTable
from ..session import materialize
from . import models

WRITE_EVERY = 10
# A bin's number is kept in a byte.
MOST_BINS = 256


@dataclass(frozen=True)
class BinnedTree:
    """Nodes in arrays; children are positions, a leaf points to itself. Rows go left up to bin ``cut``."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def leaf_of(self, bins: np.ndarray, depth: int) -> np.ndarray:
        at = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins))
        for _ in range(depth):
            at = np.where(bins[rows, self.feature[at]] <= self.cut[at], self.left[at], self.right[at])
        return at


class SoftmaxBoosting(Model):
    """Fitted booster.

    Scoring walks all trees in one pass: their size is set by the parameters, not by the data.
    """

    def __init__(self, rounds: list[list[BinnedTree]], edges: list[np.ndarray], start: list[float], depth: int):
        super().__init__()
        self.rounds, self.edges, self.start, self.depth = rounds, edges, start, depth

    def _transform(self, dataset: DataFrame) -> DataFrame:
        df = dataset
        k, first = len(self.start), np.array(self.start)
        shared = df.sparkSession.sparkContext.broadcast(self._table())

        def walk(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                if len(batch):
                    yield pd.Series(list(shared.value.score(np.stack(batch.to_numpy()), k) + first))
                else:
                    yield pd.Series([], dtype=object)

        walk.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
        scored = df.withColumn("__raw", F.pandas_udf(walk, "array<double>")(vector_to_array("features")))
        raw = F.col("__raw")
        chance = _softmax([raw[i] for i in range(k)])
        return scored.select(
            *df.columns,
            array_to_vector(raw).alias("rawPrediction"),
            array_to_vector(F.array(*chance)).alias("probability"),
            (F.array_position(raw, F.array_max(raw)) - 1).cast("double").alias("prediction"),
        )

    def _table(self) -> TreeTable:
        """All nodes in one set of arrays, split at values instead of bins."""
        trees = [(output, tree) for made in self.rounds for output, tree in enumerate(made)]
        sizes = [len(tree.value) for _, tree in trees]
        roots = np.concatenate([[0], np.cumsum(sizes)])[:-1].astype(np.int64)

        def joined(part) -> np.ndarray:
            return np.concatenate([part(tree, root) for (_, tree), root in zip(trees, roots)] or [np.zeros(0)])

        def upto(tree: BinnedTree) -> np.ndarray:
            ends = [self.edges[f][c] if c < len(self.edges[f]) else np.inf for f, c in zip(tree.feature, tree.cut)]
            return np.array(ends, float)

        return TreeTable(
            roots, np.array([o for o, _ in trees], np.int64), joined(lambda t, _: t.feature),
            joined(lambda t, _: np.full(len(t.value), -np.inf)), joined(lambda t, _: upto(t)),
            joined(lambda t, r: t.left + r), joined(lambda t, r: t.right + r), joined(lambda t, _: t.value),
            max(1, self.depth),
        )


def _softmax(scores: list[Column]) -> list[Column]:
    top = F.greatest(*scores)
    each = [F.exp(s - top) for s in scores]
    whole = sum(each[1:], each[0])
    return [e / whole for e in each]


def _chances(scores: np.ndarray) -> np.ndarray:
    each = np.exp(scores - scores.max(1, keepdims=True))
    return each / each.sum(1, keepdims=True)


def bin_edges(blocks_of: DataFrame, width: int, max_bins: int, features: str = "features") -> list[np.ndarray]:
    """Increasing upper ends of all bins but the last, per feature, from approximate quantiles of every row."""
    values = blocks_of.select(vector_to_array(features).alias("x"))
    names = [f"x{i}" for i in range(width)]
    flat = values.select(*[F.col("x")[i].alias(n) for i, n in enumerate(names)])
    grid = [i / max_bins for i in range(max_bins + 1)]
    found = flat.approxQuantile(names, grid, 1.0 / (4 * max_bins))
    return [np.unique(q)[:-1][: max_bins - 1] for q in found]


def _open(block: Block, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bins by feature, scores, labels and the numbers to draw by."""
    n = len(block.x)
    return block.codes[2].view(np.uint8)[: width * n].reshape(width, n), block.x, block.codes[0], block.codes[1]


def _packed(x: np.ndarray, codes: list[np.ndarray]) -> pa.RecordBatch:
    parts = [pa.array([v.tobytes()], pa.binary()) for v in (x, *codes)]
    sizes = [pa.array([v], pa.int32()) for v in x.shape]
    return pa.RecordBatch.from_arrays([*sizes, *parts], names=["n", "width", "x", "code0", "code1", "code2"])


_PACKED = "n int, width int, x binary, code0 binary, code1 binary, code2 binary"


class _Rows:
    """Packed rows with the scores of all classes so far, label, a number to draw by, and bins of a byte each."""

    def __init__(self, frame: DataFrame, width: int, k: int, before: _Rows | None = None) -> None:
        self.blocks, self.width, self.k = Blocks(frame, before and before.blocks), width, k
        # the rows that these are made of are kept until the first pass has made these
        self.before = before

    def moved(self, trees: list[BinnedTree], depth: int, write: bool) -> _Rows:
        """The same rows with the scores of one more round."""
        shared, width = self.blocks.broadcast(trees), self.width

        def step(block: Block) -> pa.RecordBatch:
            x = block.x.copy()
            bins = _open(block, width)[0].T
            for i, tree in enumerate(shared.value):
                x[:, i] += tree.value[tree.leaf_of(bins, depth)]
            return _packed(x, block.codes)

        frame = self.blocks.map(step, _PACKED)
        return _Rows(materialize(frame, "boosting") if write else frame, self.width, self.k, self)

    def _passed(self) -> None:
        if self.before is not None:
            self.before.close()
            self.before = None

    def close(self) -> None:
        self._passed()
        self.blocks.__exit__()

    def histograms(self, trees: list[BinnedTree], wanted: list[list[int]], depth: int, bins: int, share: float, at: int):
        """Per class: (wanted node, feature, bin, [residual, weight, rows]) over the drawn rows in the wanted nodes."""
        shared = self.blocks.broadcast((trees, wanted))
        width = self.width
        sizes = [len(w) * width * bins * 3 for w in wanted]
        begin = np.concatenate([[0], np.cumsum(sizes)])
        limit = int(share * (1 << 32))

        def work(block: Block) -> np.ndarray:
            total = np.zeros(begin[-1])
            cut, scores, label, draw = _open(block, width)
            chance = _chances(scores)
            inside = _drawn(draw, at) < limit if share < 1.0 else np.ones(len(label), bool)
            for i, tree in enumerate(shared.value[0]):
                place = np.full(len(tree.value), -1)
                place[shared.value[1][i]] = np.arange(len(shared.value[1][i]))
                node = place[tree.leaf_of(cut.T, depth)]
                rows = np.flatnonzero(inside & (node >= 0))
                if not len(rows):
                    continue
                r = (label[rows] == i) - chance[rows, i]
                weight = np.abs(r) * (1 - np.abs(r))
                first, n = node[rows] * bins, len(shared.value[1][i])
                sums = total[begin[i] : begin[i + 1]].reshape(n, width, bins, 3)
                for f in range(width):
                    key = first + cut[f, rows]
                    for which, stat in enumerate((r, weight, None)):
                        sums[:, f, :, which] = np.bincount(key, stat, minlength=n * bins).reshape(n, bins)
            return total

        made = self.blocks.sums(work, int(begin[-1])) if begin[-1] else np.zeros(0)
        if begin[-1]:
            self._passed()
        shared.destroy()
        return [made[a:b].reshape(-1, width, bins, 3) for a, b in zip(begin[:-1], begin[1:])]

    def deviance(self) -> float:
        """Mean log loss of the scores so far."""
        width = self.width

        def work(block: Block) -> np.ndarray:
            _, scores, label, _ = _open(block, width)
            top = scores.max(1)
            whole = np.log(np.exp(scores - top[:, None]).sum(1)) + top
            return np.array([(whole - scores[np.arange(len(label)), label]).sum()])

        total = float(self.blocks.sums(work, 1)[0])
        self._passed()
        return total / max(1, self.blocks.n)


def _drawn(number: np.ndarray, at: int) -> np.ndarray:
    """32 bits for each row's number and this round."""
    x = number.astype(np.uint64) ^ np.uint64((at + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))) >> np.uint64(32)


class _Growing:
    """One class's tree of a round while it grows."""

    def __init__(self) -> None:
        self.nodes: list[list] = [[0, MOST_BINS, 0, 0, 0.0]]
        self.open = [0]
        self.sums: dict[int, np.ndarray] = {}
        # residuals, weights and rows of a node as a whole
        self.totals: dict[int, np.ndarray] = {}

    def tree(self) -> BinnedTree:
        feature, cut, left, right, value = (np.array(c) for c in zip(*self.nodes))
        return BinnedTree(feature, cut, left, right, value.astype(float))

    def split(self, least: int) -> list[tuple[int, int, int]]:
        """Split every open node that gains; returns (parent, smaller child, other child) of the new ones."""
        made = []
        for node in self.open:
            self.totals.setdefault(node, self.sums[node][0].sum(0))
            found = _best_split(self.sums[node], least)
            if found is None:
                continue
            feature, cut = found
            left, right = len(self.nodes), len(self.nodes) + 1
            self.nodes[node][:4] = [feature, cut, left, right]
            self.nodes += [[0, MOST_BINS, left, left, 0.0], [0, MOST_BINS, right, right, 0.0]]
            self.totals[left] = self.sums[node][feature, : cut + 1].sum(0)
            self.totals[right] = self.sums[node][feature, cut + 1 :].sum(0)
            left_is_smaller = self.totals[left][2] <= self.totals[right][2]
            made.append((node, left, right) if left_is_smaller else (node, right, left))
        self.open = [child for _, a, b in made for child in sorted((a, b))]
        return made

    def finish(self, factor: float) -> BinnedTree:
        """One Newton step per leaf: (K-1)/K * sum(r) / sum(|r| (1 - |r|)), times the learning rate."""
        for i, node in enumerate(self.nodes):
            if node[2] == i:
                up, down, _ = self.totals.get(i, np.zeros(3))
                node[4] = factor * up / down if down > 1e-150 else 0.0
        return self.tree()


def _best_split(sums: np.ndarray, least: int) -> tuple[int, int] | None:
    """Feature and bin with the largest fall in squared error of the residuals; the first of equal ones."""
    below = sums.cumsum(1)[:, :-1]
    if not below.size:
        return None
    whole = sums[:1].sum(1)[:, None]
    above = whole - below
    fits = (below[..., 2] >= least - 0.5) & (above[..., 2] >= least - 0.5)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = below[..., 0] ** 2 / below[..., 2] + above[..., 0] ** 2 / above[..., 2]
        gain = gain - whole[..., 0] ** 2 / whole[..., 2]
    gain = np.where(fits, gain, -np.inf)
    best = int(gain.argmax())
    feature, cut = divmod(best, gain.shape[1])
    if not gain[feature, cut] > 1e-12 * max(1.0, float(whole[0, 0, 2])):
        return None
    return feature, cut


class SoftmaxBooster(Estimator):
    """Parameters: n_estimators, learning_rate, max_depth, subsample, min_samples_leaf, max_bins.

    Reads ``features``, ``label_index`` and, to draw a share of the rows each round, a row key. Rows with a null
    among them are left out.
    """

    def __init__(self, params: Mapping[str, Any], classes: int, key: str = "row_id", seed: int = 42):
        super().__init__()
        left = dict(params)
        self.n_rounds = int(left.pop("n_estimators", 100))
        self.rate = float(left.pop("learning_rate", 0.1))
        self.share = float(left.pop("subsample", 1.0))
        self.depth = int(left.pop("max_depth", 3))
        self.least = int(left.pop("min_samples_leaf", 1))
        self.bins = min(MOST_BINS, int(left.pop("max_bins", 128)))
        if left.get("min_samples_split") == 2:
            left.pop("min_samples_split")
        if left:
            raise ValueError(f"{models.SOFTMAX_BOOSTING}: no Spark counterpart for {sorted(left)}")
        self.classes, self.key, self.seed = classes, key, seed

    def _fit(self, dataset: DataFrame) -> SoftmaxBoosting:
        return self.fit_with_progress(dataset)[0]

    def fit_with_progress(self, dataset: DataFrame, progress: bool = False) -> tuple[SoftmaxBoosting, list[float]]:
        """The model and, if asked for, the mean log loss before the first and after every round."""
        k = self.classes
        counts = {int(r["label_index"]): r["count"] for r in dataset.groupBy("label_index").count().collect()}
        n = sum(counts.values())
        # a class's first score is the logarithm of its share; one that is absent starts far below
        start = [math.log(counts[i] / n) if i in counts else -30.0 for i in range(k)]
        # only a share of the rows per round needs their key
        draw = F.xxhash64(F.lit(self.seed), self.key) if self.share < 1.0 else F.lit(0).cast("long")
        prepared = dataset.select("features", "label_index", draw.alias("__draw"))
        with dense_blocks(prepared, "features", ["label_index", "__draw"]) as raw:
            edges = bin_edges(prepared, raw.width, self.bins)
            first = _Rows(_binned(raw, edges, start), raw.width, k)
        rows, rounds, losses = first, [], []
        if progress:
            losses.append(rows.deviance())
        for at in range(self.n_rounds):
            trees = self._round(rows, at)
            rounds.append(trees)
            if progress or at + 1 < self.n_rounds:
                rows = rows.moved(trees, self.depth, (at + 1) % WRITE_EVERY == 0)
            if progress:
                losses.append(rows.deviance())
        rows.close()
        return SoftmaxBoosting(rounds, edges, start, self.depth), losses

    def _round(self, rows: _Rows, at: int) -> list[BinnedTree]:
        growing = [_Growing() for _ in range(self.classes)]
        wanted = [[0] for _ in growing]
        families: list[list[tuple[int, int, int]]] = [[] for _ in growing]
        for level in range(self.depth):
            trees = [g.tree() for g in growing]
            found = rows.histograms(trees, wanted, max(1, level), self.bins, self.share, at)
            for i, g in enumerate(growing):
                for place, node in enumerate(wanted[i]):
                    g.sums[node] = found[i][place]
                for parent, summed, other in families[i]:
                    g.sums[other] = g.sums[parent] - g.sums[summed]
                families[i] = g.split(self.least)
                wanted[i] = [summed for _, summed, _ in families[i]]
            if not any(wanted):
                break
        factor = self.rate * (self.classes - 1) / self.classes
        return [g.finish(factor) for g in growing]


def _binned(raw: Blocks, edges: list[np.ndarray], start: list[float]) -> DataFrame:
    shared, first = raw.broadcast(edges), np.array(start)

    def cut(block: Block) -> pa.RecordBatch:
        bins = [np.searchsorted(e, block.x[:, i], side="left") for i, e in enumerate(shared.value)]
        flat = np.concatenate([np.zeros(0, np.uint8), *(b.astype(np.uint8) for b in bins)])
        # codes are read as whole numbers of eight bytes
        flat = np.append(flat, np.zeros(-len(flat) % 8, np.uint8))
        return _packed(np.tile(first, (len(block.x), 1)), [*block.codes, flat])

    return materialize(raw.map(cut, _PACKED), "boosting")
