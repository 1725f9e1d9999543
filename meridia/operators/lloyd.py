"""K-means for many numbers of clusters and many starts in one loop over the data.

All centres of all runs are stacked: a pass multiplies a block of rows with them once, finds each run's nearest
centre, and returns counts, sums and costs per (run, cluster). Starts are drawn by oversampling (Bahmani et al.
2012): a few passes draw rows in proportion to their distance from what was drawn before, for all starts
together, and the few drawn rows are weighed and thinned out to k centres on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.blocks import Block, Blocks
from .neighbors import nearest

ROUNDS = 2
DISTANCES_AT_ONCE = 1 << 22


@dataclass(frozen=True)
class Run:
    """One finished run. ``inertia`` is the sum of squared distances to the nearest of its centres."""

    k: int
    start: int
    centers: np.ndarray
    inertia: float
    steps: int

    def clusterCenters(self) -> list[np.ndarray]:  # noqa: N802 - the name Spark's models have
        return list(self.centers)

    def transform(self, df: DataFrame, features: str = "features", out: str = "cluster") -> DataFrame:
        """Adds each row's nearest centre, the first on a tie; null for a null vector."""
        shared = df.sparkSession.sparkContext.broadcast(self.centers)

        def place(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                there = batch.notna()
                at = batch.map(lambda _: None).astype("Int32")
                if there.any():
                    at[there] = nearest(np.stack(batch[there].to_numpy()), shared.value)[0]
                yield at

        is_array = df.schema[features].dataType.typeName() == "array"
        x = F.col(features) if is_array else vector_to_array(features)
        place.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
        return df.withColumn(out, F.pandas_udf(place, "int")(x))


def _chunks(block: Block, columns: int) -> Iterator[np.ndarray]:
    step = max(1, DISTANCES_AT_ONCE // max(1, columns))
    for at in range(0, len(block.x), step):
        yield block.x[at : at + step]


def _squared(x: np.ndarray, centers: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """Squared distances, computed around ``shift`` so that little cancels."""
    x, centers = x - shift, centers - shift
    d = (x**2).sum(1)[:, None] - 2 * x @ centers.T + (centers**2).sum(1)[None, :]
    return np.maximum(d, 0.0)


def _mean(blocks: Blocks) -> np.ndarray:
    if not blocks.n:
        raise ValueError("no row to cluster")
    return blocks.sums(lambda block: block.x.sum(0), blocks.width) / blocks.n


def _draw(blocks: Blocks, known: list[np.ndarray], totals: np.ndarray, wanted: float, seed: str, mean: np.ndarray):
    """Rows drawn for every start, each with probability ``wanted`` times its share of the start's cost."""
    shared = blocks.broadcast(known)

    def draw(block: Block) -> pa.RecordBatch:
        # the block's content seeds its draws, so that a repeated task draws the same rows
        rng = np.random.default_rng(crc32(block.x.tobytes(), crc32(seed.encode())))
        starts, rows = [], []
        for x in _chunks(block, max(map(len, shared.value))):
            for s, centers in enumerate(shared.value):
                cost = _squared(x, centers, mean).min(1)
                hit = np.flatnonzero(rng.random(len(x)) * totals[s] < wanted * cost)
                starts += [s] * len(hit)
                rows += [x[i].tobytes() for i in hit]
        return pa.RecordBatch.from_arrays([pa.array(starts, pa.int32()), pa.array(rows, pa.binary())], names=["s", "x"])

    found = blocks.map(draw, "s int, x binary").orderBy("s", "x").collect()
    shared.destroy()
    out = [[] for _ in known]
    for r in found:
        out[r["s"]].append(np.frombuffer(r["x"], np.float64))
    return out


def _costs(blocks: Blocks, known: list[np.ndarray], mean: np.ndarray) -> np.ndarray:
    shared = blocks.broadcast(known)

    def work(block: Block) -> np.ndarray:
        total = np.zeros(len(shared.value))
        for x in _chunks(block, max(map(len, shared.value))):
            total += [_squared(x, c, mean).min(1).sum() for c in shared.value]
        return total

    made = blocks.sums(work, len(known))
    shared.destroy()
    return made


def _weights(blocks: Blocks, known: list[np.ndarray], mean: np.ndarray) -> list[np.ndarray]:
    """How many rows are nearest to each drawn row, per start."""
    sizes = np.array([len(c) for c in known])
    begin = np.concatenate([[0], np.cumsum(sizes)])
    shared = blocks.broadcast(known)

    def work(block: Block) -> np.ndarray:
        total = np.zeros(begin[-1])
        for x in _chunks(block, int(sizes.max())):
            for s, c in enumerate(shared.value):
                total[begin[s] : begin[s + 1]] += np.bincount(_squared(x, c, mean).argmin(1), minlength=len(c))
        return total

    made = blocks.sums(work, int(begin[-1]))
    shared.destroy()
    return [made[a:b] for a, b in zip(begin[:-1], begin[1:], strict=True)]


def _thin_out(points: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k of the drawn rows by weighted k-means++, then a few weighted Lloyd steps among them."""
    chosen = [int(rng.choice(len(points), p=weights / weights.sum()))]
    d = ((points - points[chosen[0]]) ** 2).sum(1)
    while len(chosen) < min(k, len(points)):
        cost = d * weights
        if cost.sum() <= 0:
            break
        chosen.append(int(rng.choice(len(points), p=cost / cost.sum())))
        d = np.minimum(d, ((points - points[chosen[-1]]) ** 2).sum(1))
    centers = points[chosen]
    for _ in range(10):
        at = nearest(points, centers)[0]
        for c in range(len(centers)):
            w = weights * (at == c)
            if w.sum() > 0:
                centers[c] = (points * w[:, None]).sum(0) / w.sum()
    return centers


def _seeds(blocks: Blocks, mean: np.ndarray, ks: Sequence[int], starts: int, seed: int):
    """First centres of every (k, start)."""
    wanted = 2.0 * max(ks)
    known = [mean[None, :] for _ in range(starts)]
    drawn: list[list[np.ndarray]] = [[] for _ in range(starts)]
    for turn in range(ROUNDS + 1):
        costs = _costs(blocks, known, mean)
        if not costs.any():
            break
        more = _draw(blocks, known, np.maximum(costs, 1e-300), wanted, f"{seed}:{turn}", mean)
        for s in range(starts):
            drawn[s] += more[s]
            if drawn[s]:
                known[s] = np.unique(np.stack(drawn[s]), axis=0)
    weights = _weights(blocks, known, mean)
    return {
        (k, s): _thin_out(known[s], np.maximum(weights[s], 1e-9), k, np.random.default_rng([seed, k, s]))
        for k in ks
        for s in range(starts)
    }


def step(blocks: Blocks, centers: list[np.ndarray], mean: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """One Lloyd step of every run: sizes and sums of its clusters, and its cost before the step."""
    p = len(mean)
    sizes = np.array([len(c) for c in centers])
    begin = np.concatenate([[0], np.cumsum(sizes)])
    total_centers = int(begin[-1])
    shared = blocks.broadcast(np.concatenate(centers))

    def work(block: Block) -> np.ndarray:
        counts, sums, costs = np.zeros(total_centers), np.zeros((total_centers, p)), np.zeros(len(sizes))
        for x in _chunks(block, total_centers):
            d = _squared(x, shared.value, mean)
            member = np.zeros((len(x), total_centers), np.float32)
            rows = np.arange(len(x))
            for r, (a, b) in enumerate(zip(begin[:-1], begin[1:], strict=True)):
                at = d[:, a:b].argmin(1) + a
                costs[r] += d[rows, at].sum()
                member[rows, at] = 1.0
            counts += member.sum(0)
            sums += member.T @ x
        return np.concatenate([counts, sums.ravel(), costs])

    made = blocks.sums(work, total_centers * (p + 1) + len(sizes))
    shared.destroy()
    counts, sums = made[:total_centers], made[total_centers : total_centers * (p + 1)].reshape(-1, p)
    cut = list(zip(begin[:-1], begin[1:], strict=True))
    return [counts[a:b] for a, b in cut], [sums[a:b] for a, b in cut], made[total_centers * (p + 1) :]


def many_runs(
    blocks: Blocks, ks: Sequence[int], starts: int = 10, seed: int = 42, max_iter: int = 300, tolerance: float = 1e-4
) -> list[Run]:
    """All (k, start) runs over ``dense_blocks``, in the order of ``ks`` and starts.

    A run ends when its centres' squared moves add up to at most ``tolerance`` times the mean variance of a
    dimension, or after ``max_iter`` steps. A cluster that loses all its rows keeps its centre. Fewer distinct
    rows than k give fewer centres. Starts repeat for a seed as long as the rows come in the same blocks.
    """
    mean = _mean(blocks)
    spread = blocks.sums(lambda block: np.array([((block.x - mean) ** 2).sum()]), 1)[0]
    least = tolerance * spread / blocks.n / max(1, blocks.width)
    current = _seeds(blocks, mean, ks, starts, seed)
    order = [(k, s) for k in ks for s in range(starts)]
    active, done = list(order), {}
    steps = 0
    while active:
        counts, sums, costs = step(blocks, [current[r] for r in active], mean)
        left = []
        for r, c, total, cost in zip(active, counts, sums, costs, strict=True):
            moved = np.where(c[:, None] > 0, total / np.maximum(c, 1)[:, None], current[r])
            if ((moved - current[r]) ** 2).sum() <= least or steps >= max_iter:
                done[r] = Run(r[0], r[1], current[r], float(cost), steps)
            else:
                current[r] = moved
                left.append(r)
        active = left
        steps += 1
    return [done[r] for r in order]


def best_runs(runs: Sequence[Run]) -> dict[int, Run]:
    """The run with the least inertia for each k; the earliest start wins a tie."""
    return {k: min((r for r in runs if r.k == k), key=lambda r: (r.inertia, r.start)) for k in sorted({r.k for r in runs})}


def silhouettes(blocks: Blocks, runs: Sequence[Run]) -> list[float | None]:
    """Mean silhouette under squared distance for every run, in two passes for all of them.

    The mean squared distance from a row to a cluster follows from the cluster's size, sum and sum of squared
    norms. A row alone in its cluster counts 0; a run with one cluster in use has none.
    """
    mean = _mean(blocks)
    centers = [r.centers for r in runs]
    counts, sums, costs = step(blocks, centers, mean)
    p = len(mean)
    sizes = np.array([len(c) for c in centers])
    begin = np.concatenate([[0], np.cumsum(sizes)])
    total_centers = int(begin[-1])
    stacked = np.concatenate(centers)

    def spread(block: Block) -> np.ndarray:
        out = np.zeros(total_centers)
        for x in _chunks(block, total_centers):
            d, norms = _squared(x, stacked, mean), ((x - mean) ** 2).sum(1)
            for a, b in zip(begin[:-1], begin[1:], strict=True):
                out[a:b] += np.bincount(d[:, a:b].argmin(1), weights=norms, minlength=b - a)
        return out

    norms = blocks.sums(spread, total_centers)
    n = np.concatenate(counts)
    used = n > 0
    middle = np.where(used[:, None], np.concatenate(sums) / np.maximum(n, 1)[:, None] - mean, 0.0)
    own_norm = norms / np.maximum(n, 1)

    def score(block: Block) -> np.ndarray:
        out = np.zeros(len(sizes))
        for x in _chunks(block, total_centers):
            d = _squared(x, stacked, mean)
            shifted = x - mean
            far = (shifted**2).sum(1)[:, None] + own_norm[None, :] - 2 * shifted @ middle.T
            rows = np.arange(len(x))
            for r, (a, b) in enumerate(zip(begin[:-1], begin[1:], strict=True)):
                at = d[:, a:b].argmin(1)
                to = np.where(used[a:b][None, :], far[:, a:b], np.inf)
                size = n[a:b][at]
                inside = to[rows, at] * size / np.maximum(size - 1, 1)
                to[rows, at] = np.inf
                outside = to.min(1)
                top = np.maximum(inside, outside)
                value = np.where(top > 0, (outside - inside) / np.where(top > 0, top, 1), 0.0)
                out[r] += np.where((size > 1) & np.isfinite(outside), value, 0.0).sum()
        return out

    totals = blocks.sums(score, len(sizes))
    return [
        float(t / counts[r].sum()) if (counts[r] > 0).sum() > 1 else None for r, t in enumerate(totals)
    ]

