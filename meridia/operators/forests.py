"""Random forests of a search, grown once for all candidates that can share their trees.

Trees of a forest are grown one without the other, level by level. So the first n trees of a larger forest are a forest
of n trees, and a tree cut off at a depth is the tree of that depth. Candidates that differ in ``n_estimators`` and
``max_depth`` alone share one forest a fold, of the most trees and the greatest depth among them; every candidate is
judged on every row of the fold by its own trees at its own depth, all of them in one pass.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from hashlib import md5
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import InheritableThread
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.blocks import Block, Blocks
from . import models, shapley, stacked

SHARED = ("n_estimators", "max_depth")
# Spark keeps 8 bytes for every row in every tree that grow together: a forest grows in parts of about this many
# (row, tree) pairs, but of no fewer trees than FEWEST unless it has fewer.
PAIRS_AT_ONCE = 1 << 28
FEWEST = 50
# Folds whose forests grow at the same time: between the jobs of one the driver has work of its own to do.
FOLDS_AT_ONCE = 2
# Rows that are walked through the trees at once.
ROWS_AT_ONCE = 2048


@dataclass(frozen=True)
class Trees:
    """Nodes of trees one after the other. A row goes to ``kids[2 i]`` if ``x[feature] <= cut``, else to ``kids[2 i + 1]``;
    a leaf is its own child. ``share``: classes of the training rows of a node, ``pred`` the largest.
    """

    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    kids: np.ndarray
    share: np.ndarray
    pred: np.ndarray

    @staticmethod
    def read(nodes: pa.Table, k: int) -> Trees:
        """From the rows of ``shapley.tree_nodes``, which number the nodes of each tree from its root, 0."""
        nodes = nodes.sort_by([("tree", "ascending"), ("node", "ascending")])
        column = {n: nodes.column(n).to_numpy() for n in ("tree", "node", "left", "right", "feature", "categories", "prediction")}
        at = np.arange(len(nodes))
        roots = np.flatnonzero(column["node"] == 0)
        first = at - column["node"]
        inner = column["left"] >= 0
        left, right = (np.where(inner, first + column[n], at) for n in ("left", "right"))
        cuts = nodes.column("cut").combine_chunks()
        ends = np.append(cuts.offsets.to_numpy(), 0)
        values = np.append(cuts.values.to_numpy(zero_copy_only=False), 0.0)
        cut = np.where(inner, values[np.minimum(ends[: len(at)], len(values) - 1)], 0.0)
        # slots of 0 and 1 are split by the one value that goes left
        coded = inner & (column["categories"] >= 0)
        one_left = coded & (cut == 1.0)
        left, right = np.where(one_left, right, left), np.where(one_left, left, right)
        cut = np.where(coded, 0.5, cut)
        share = np.zeros((len(at), k))
        stats = nodes.column("stats").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(at), -1)
        share[:, : stats.shape[1]] = stats / np.maximum(stats.sum(1, keepdims=True), 1e-300)
        kids = np.stack([left, right], 1).ravel().astype(np.int32)
        feature = np.where(inner, column["feature"], 0).astype(np.int32)
        return Trees(roots, feature, cut, kids, share, column["prediction"].astype(np.int32))

    @staticmethod
    def joined(parts: Sequence[Trees]) -> Trees:
        starts = np.cumsum([0, *(len(p.cut) for p in parts)])
        moved = {"roots": [p.roots + s for p, s in zip(parts, starts)], "kids": [p.kids + np.int32(s) for p, s in zip(parts, starts)]}
        rest = {n: [getattr(p, n) for p in parts] for n in ("feature", "cut", "share", "pred")}
        return Trees(**{n: np.concatenate(v) for n, v in {**moved, **rest}.items()})

    def answers(self, depths: Sequence[int]) -> list[np.ndarray]:
        """For each depth, the node that speaks for a row that stands at a node after as many steps: the node itself, or
        the one above it whose children all predict the same class, since Spark makes one leaf of those.
        """
        left, right = self.kids[::2], self.kids[1::2]
        inner = left != np.arange(len(left))
        levels = [self.roots]
        while len(below := levels[-1][inner[levels[-1]]]):
            levels.append(np.concatenate([left[below], right[below]]))
        found = []
        for depth in depths:
            leaf = ~inner
            for level in levels[depth : depth + 1]:
                leaf[level] = True
            for level in reversed(levels[:depth]):
                open_ = level[inner[level]]
                l, r = left[open_], right[open_]
                leaf[open_] = leaf[l] & leaf[r] & (self.pred[l] == self.pred[r])
            answer = np.arange(len(left), dtype=np.int32)
            for level in levels[:depth]:
                open_ = level[inner[level]]
                ended = leaf[open_] | (answer[open_] != open_)
                for child in (left, right):
                    answer[child[open_[ended]]] = answer[open_[ended]]
            found.append(answer)
        return found

    def predictions(self, x: np.ndarray, depths: Sequence[int], answers: Sequence[np.ndarray], sizes: Sequence[int]):
        """Pairs of a number of trees and the predictions of that many, one row of them for each of the rising ``depths``."""
        inner = self.kids[::2] != np.arange(len(self.cut))
        width, flat = x.shape[1], x.ravel()
        votes = np.zeros((len(depths), len(x), self.share.shape[1]))
        for t, root in enumerate(self.roots[: max(sizes)]):
            at = np.full(len(x), root)
            moving, step = np.arange(len(x) if inner[root] else 0), 0
            for i, depth in enumerate(depths):
                while step < depth and len(moving):
                    here = at[moving]
                    right = ~(flat[moving * width + self.feature[here]] <= self.cut[here])
                    there = self.kids[2 * here + right]
                    at[moving] = there
                    moving = moving[inner[there]]
                    step += 1
                votes[i] += self.share[answers[i][at]]
            if t + 1 in sizes:
                yield t + 1, votes.argmax(2)


def shareable(name: str, train: DataFrame) -> bool:
    """Whether ``cross_validate`` takes the model: a forest over numbers and slots of 0 and 1, not over wider codes."""
    attributes = train.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    return name == models.FOREST and not attributes.get("nominal")


def groups(candidates: Sequence[Mapping[str, Any]]) -> list[list[int]]:
    """Numbers of the candidates that differ in ``SHARED`` alone."""
    made: dict[str, list[int]] = {}
    for i, c in enumerate(candidates):
        made.setdefault(json.dumps({k: v for k, v in c.items() if k not in SHARED}, sort_keys=True), []).append(i)
    return list(made.values())


def grow(indexed: DataFrame, params: Mapping[str, Any], shape: models.Shape, seed: int) -> Trees:
    """A forest, in parts when it is large for its rows; each part has a seed of its own."""
    estimator = models.build_estimator(models.FOREST, params, shape, seed)
    whole = estimator.getNumTrees()
    size = min(whole, max(FEWEST, PAIRS_AT_ONCE // shape.n_rows))
    parts = []
    for start in range(0, whole, size):
        own = seed if not start else int(md5(f"{seed}:{start}".encode()).hexdigest()[:12], 16)
        made = estimator.copy({estimator.numTrees: min(size, whole - start), estimator.seed: own}).fit(indexed)
        nodes = shapley.tree_nodes(models.Fitted(models.FOREST, made, shape.classes))
        parts.append(Trees.read(nodes.toArrow(), len(shape.classes)))
    return Trees.joined(parts)


def cross_validate(
    train: DataFrame,
    candidates: Sequence[Mapping[str, Any]],
    shape: models.Shape,
    label: str = "label",
    fold: str = "fold",
    seed: int = 42,
) -> np.ndarray:
    """Macro F1 of every candidate on every fold that its forest did not see."""
    # a parameter that is not known is refused before anything is grown
    made = [models.build_estimator(models.FOREST, c, shape, seed) for c in candidates]
    sizes, depths = [e.getNumTrees() for e in made], [e.getMaxDepth() for e in made]
    with stacked.blocks_of(train, shape.classes, label, fold) as blocks:
        if blocks.n != shape.n_rows:
            raise ValueError(f"{shape.n_rows - blocks.n} rows have no features, label or fold")
        folds = sorted(stacked.rows_by_fold(blocks))
        if len(folds) < 2 or folds != list(range(len(folds))):
            raise ValueError(f"folds must be numbered from 0 and be two at least, not {folds}")
        inner = shape.with_rows(1 - 1 / len(folds))
        indexed = models.with_label_index(train, label, shape.classes).withColumn(fold, F.col(fold).cast("int")).persist()
        scores = np.zeros((len(candidates), len(folds)))
        for members in groups(candidates):
            largest = {**candidates[members[0]], "n_estimators": max(sizes[i] for i in members), "max_depth": max(depths[i] for i in members)}
            wanted = [(sizes[i], depths[i]) for i in members]

            def judge(hold: int) -> None:
                trees = grow(indexed.where(F.col(fold) != hold), largest, inner, seed)
                scores[members, hold] = [stacked.macro_f1(c) for c in _pair_counts(blocks, trees, wanted, hold)]

            for start in range(0, len(folds), FOLDS_AT_ONCE):
                _together(judge, folds[start : start + FOLDS_AT_ONCE], train)
        indexed.unpersist()
    return scores


def _together(run: Callable[[int], None], items: Sequence[int], df: DataFrame) -> None:
    """All items at the same time, each in a thread with job properties of its own; see ``ClassParallelOneVsRest``."""
    failures: list[BaseException] = []

    def guarded(item: int) -> None:
        try:
            run(item)
        except BaseException as error:  # noqa: BLE001 - raised again below
            failures.append(error)

    threads = [InheritableThread(guarded, args=(i,), session=df.sparkSession) for i in items]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    if failures:
        raise failures[0]


def _pair_counts(blocks: Blocks, trees: Trees, wanted: Sequence[tuple[int, int]], hold: int) -> np.ndarray:
    """Rows of a fold by label and prediction, for each wanted number of trees and depth."""
    k, m = trees.share.shape[1], len(wanted)
    depths = sorted({d for _, d in wanted})
    sizes = {n for n, _ in wanted}
    shared = blocks.broadcast((trees, trees.answers(depths)))

    def work(block: Block) -> np.ndarray:
        forest, answers = shared.value
        y, of = block.codes
        inside = np.flatnonzero(of == hold)
        total = np.zeros((m, k * k))
        for start in range(0, len(inside), ROWS_AT_ONCE):
            part = inside[start : start + ROWS_AT_ONCE]
            for n, predicted in forest.predictions(block.x[part], depths, answers, sizes):
                for i, (size, depth) in enumerate(wanted):
                    if size == n:
                        total[i] += np.bincount(y[part] * k + predicted[depths.index(depth)], minlength=k * k)
        return total.ravel()

    counts = blocks.sums(work, m * k * k).reshape(m, k, k)
    shared.destroy()
    return counts
