"""Principal components of wide and sparse vectors.

No table of width times width is made anywhere: a few random directions are turned towards the leading
components, one pass over the rows at a time, and the driver holds the width times these directions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.blocks import DRIVER_BYTES
from ..session import ship

# Directions beyond the wanted ones, and the change of a share from pass to pass that ends the turning.
SPARE = 10
SETTLED = 1e-9
MOST_PASSES = 100


@dataclass(frozen=True)
class WidePca:
    """``components``: width by k, largest loading positive; ``shares`` of the variance; ``mean`` and ``variance`` of
    the rows (sample variance over all slots). ``settled`` tells whether the shares stopped moving within ``passes``.
    """

    components: np.ndarray
    shares: list[float]
    mean: np.ndarray
    variance: float
    passes: int
    settled: bool

    def apply(self, df: DataFrame, features: str = "features") -> DataFrame:
        """Columns ``pc1..pck`` added; rows without features get nulls."""
        components, shift = self.components, self.mean @ self.components

        @F.pandas_udf("array<double>")
        def project(at: pd.Series, value: pd.Series) -> pd.Series:
            known = at.notna()
            if not known.any():
                return pd.Series([None] * len(at), dtype=object)
            scores = iter(_Rows.of_lists(at[known], value[known]).times(components) - shift)
            return pd.Series([next(scores) if k else None for k in known], dtype=object)

        made = df.withColumn("__nonzero", _nonzero(df, features))
        made = made.withColumn("__pc", project(F.col("__nonzero.i"), F.col("__nonzero.v")))
        named = {f"pc{i + 1}": F.get("__pc", F.lit(i)) for i in range(components.shape[1])}
        return made.withColumns(named).drop("__nonzero", "__pc")


class _Rows:
    """Rows by their non-zero slots: ``start`` of each row, then slot and value of every entry."""

    def __init__(self, start: np.ndarray, at: np.ndarray, value: np.ndarray):
        self.n, self.at, self.value = len(start) - 1, at, value
        self.row = np.repeat(np.arange(self.n), np.diff(start))

    @staticmethod
    def of_lists(at: pd.Series, value: pd.Series) -> _Rows:
        start = np.concatenate([[0], np.cumsum([len(v) for v in at])])
        return _Rows(start, np.concatenate(at.to_list()).astype(np.int64), np.concatenate(value.to_list()))

    @staticmethod
    def of_batch(batch: pa.RecordBatch) -> _Rows:
        i, v = batch.column(0), batch.column(1)
        start = i.offsets.to_numpy().astype(np.int64)
        return _Rows(start - start[0], i.flatten().to_numpy().astype(np.int64), v.flatten().to_numpy())

    def times(self, directions: np.ndarray) -> np.ndarray:
        """Rows by directions."""
        return np.stack(
            [np.bincount(self.row, self.value * d[self.at], minlength=self.n) for d in directions.T], axis=1
        )

    def back(self, scores: np.ndarray, width: int) -> np.ndarray:
        """Transposed rows by scores: width by directions."""
        return np.stack(
            [np.bincount(self.at, self.value * s[self.row], minlength=width) for s in scores.T], axis=1
        )


def _nonzero(df: DataFrame, features: str) -> Column:
    """Struct of slots and values of the entries that are not 0; null for a null vector."""
    is_array = df.schema[features].dataType.typeName() == "array"
    dense = F.col(features).cast("array<double>") if is_array else vector_to_array(features)
    entries = F.filter(F.transform(dense, lambda v, i: F.struct(i.alias("i"), v.alias("v"))), lambda e: e["v"] != 0)
    return F.struct(entries["i"].alias("i"), entries["v"].alias("v"))


def _sums(rows: DataFrame, tasks: int, work: Callable[[_Rows], np.ndarray], size: int) -> np.ndarray:
    """Sum of ``work`` over all batches; added up by Spark once all tasks' totals outgrow ``DRIVER_BYTES``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += work(_Rows.of_batch(batch))
        slot = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int64()), pa.array(total[slot])], names=["i", "v"])

    made = rows.mapInArrow(run, "i long, v double")
    if 16 * size * tasks > DRIVER_BYTES:
        made = made.groupBy("i").agg(F.sum("v").alias("v"))
    made = made.toArrow()
    return np.bincount(made.column("i").to_numpy(), made.column("v").to_numpy(), minlength=size)


def fit(df: DataFrame, k: int = 2, features: str = "features", seed: int = 42) -> WidePca:
    """The ``k`` leading components by subspace iteration from random directions.

    Every pass multiplies the centred rows with the directions and back, which also gives the directions'
    own shares; it ends when these settle. Rows without features are left out. Fewer than two rows, or rows
    that are all equal, have no components and raise an error.
    """
    ship(df.sparkSession)
    entries = df.where(F.col(features).isNotNull()).select(_nonzero(df, features).alias("e")).select("e.i", "e.v")
    is_array = df.schema[features].dataType.typeName() == "array"
    dense = F.col(features) if is_array else vector_to_array(features)
    found = df.where(F.col(features).isNotNull()).agg(F.count("*").alias("n"), F.max(F.size(dense)).alias("p")).first()
    n, p = found["n"], found["p"] or 0
    if n < 2 or k > p:
        raise ValueError(f"{k} components need at least {k} slots and two rows; found {p} and {n}")
    rows = entries.persist()
    try:
        tasks = rows.rdd.getNumPartitions()

        def moments(block: _Rows) -> np.ndarray:
            return np.concatenate(
                [np.bincount(block.at, block.value, minlength=p), np.bincount(block.at, minlength=p)]
            )

        first = _sums(rows, tasks, moments, 2 * p)
        mean, filled = first[:p] / n, first[p:]

        def spread(block: _Rows) -> np.ndarray:
            return np.array([((block.value - mean[block.at]) ** 2).sum()])

        whole = _sums(rows, tasks, spread, 1)[0] + ((n - filled) * mean**2).sum()
        if not whole > 0:
            raise ValueError("rows that are all equal have no components")
        width = min(p, k + SPARE)
        basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(p, width)))[0]
        shares, settled, passes = np.zeros(k), False, 0
        while not settled and passes < MOST_PASSES:
            passes += 1
            shift = mean @ basis

            def turn(block: _Rows, basis=basis, shift=shift) -> np.ndarray:
                scores = block.times(basis) - shift
                return np.concatenate([block.back(scores, p).reshape(-1), scores.sum(0)])

            made = _sums(rows, tasks, turn, p * width + width)
            turned = made[: p * width].reshape(p, width) - np.outer(mean, made[p * width :])
            inner = basis.T @ turned
            values, vectors = np.linalg.eigh((inner + inner.T) / 2)
            now = values[::-1][:k] / whole
            settled = bool(np.abs(now - shares).max() < SETTLED) or width == p
            shares, components = now, basis @ vectors[:, ::-1][:, :k]
            basis = np.linalg.qr(turned)[0]
    finally:
        rows.unpersist()
    signs = np.sign(components[np.abs(components).argmax(axis=0), np.arange(k)])
    return WidePca(components * signs, [float(s) for s in shares], mean, float(whole / (n - 1)), passes, settled)
