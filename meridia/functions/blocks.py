"""Rows as dense numpy blocks, and sums of fixed size over all of them.

Algorithms that pass over the same numeric table many times read rows packed into blocks once; a pass then
costs one multiplication a block. What a pass returns has a size set by the model, not by the data: every task
adds up its blocks and Spark adds up the tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Block:
    """``x``: rows by features. ``codes``: one array of whole numbers for each extra column."""

    x: np.ndarray
    codes: list[np.ndarray]


# Totals of single tasks are added up in one task while all of them together take no more bytes than this.
DRIVER_BYTES = 1 << 25
# The driver adds them up itself while they take no more bytes than this.
DIRECT_BYTES = 1 << 18


class Blocks:
    """Packed rows, kept in executors until ``close``: their number ``n``, their width and the number of blocks."""

    def __init__(self, frame: DataFrame, like: Blocks | None = None) -> None:
        """``like``: blocks of as many rows and of the same width, so that nothing need be counted."""
        self.frame = frame.persist()
        if like is not None:
            self.blocks, self.n, self.width = like.blocks, like.n, like.width
            return
        found = self.frame.agg(F.count("*").alias("blocks"), F.sum("n").alias("n"), F.max("width").alias("width")).first()
        self.blocks, self.n, self.width = found["blocks"], found["n"] or 0, found["width"] or 0

    def __enter__(self) -> Blocks:
        return self

    def __exit__(self, *_: object) -> None:
        self.frame.unpersist()

    def broadcast(self, value):
        return self.frame.sparkSession.sparkContext.broadcast(value)

    def map(self, run: Callable[[Block], pa.RecordBatch | None], schema: str) -> DataFrame:
        """One batch of rows from each block."""

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in _read(batches):
                made = run(block)
                if made is not None:
                    yield made

        return self.frame.mapInArrow(each, schema)

    def sums(self, work: Callable[[Block], np.ndarray], size: int) -> np.ndarray:
        """Sum of ``work`` over all blocks: ``size`` numbers, zeros where there is no block.

        Every task with a block gives one total, so there are no more totals than blocks. Unless they are few
        and small, one task adds them up and the driver gets ``size`` numbers. While they fit in ``DRIVER_BYTES``
        they are added in the order of the tasks; beyond that Spark adds them, number by number.
        """
        if 16 * size * self.blocks > DRIVER_BYTES:
            return self._sums_by_number(work, size)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = _total(work, batches)
            if total is not None:
                task = TaskContext.get().partitionId()
                yield pa.RecordBatch.from_arrays([pa.array([task]), pa.array([np.asarray(total, np.float64).tobytes()])], names=["task", "v"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = [(t, v) for batch in batches for t, v in zip(batch["task"].to_pylist(), batch["v"].to_pylist())]
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([_added(parts, size).tobytes()])], names=["task", "v"])

        made = self.frame.mapInArrow(run, "task long, v binary")
        if 8 * size * self.blocks > DIRECT_BYTES:
            made = made.repartition(1).mapInArrow(add, "task long, v binary")
        return _added([(r["task"], bytes(r["v"])) for r in made.collect()], size)

    def _sums_by_number(self, work: Callable[[Block], np.ndarray], size: int) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = _total(work, batches)
            if total is not None:
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["i", "v"])

        made = self.frame.mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
        return np.bincount(made.column("i").to_numpy(), made.column("v").to_numpy(), minlength=size)


def _total(work: Callable[[Block], np.ndarray], batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
    total = None
    for block in _read(batches):
        total = work(block) if total is None else total + work(block)
    return total


def _added(parts: list[tuple[int, bytes]], size: int) -> np.ndarray:
    """Sum of the tasks' totals in the order of the tasks, so that it repeats."""
    total = np.zeros(size)
    for _, values in sorted(parts):
        total += np.frombuffer(values, np.float64)
    return total


def dense_blocks(df: DataFrame, features: str = "features", codes: Sequence[str] = ()) -> Blocks:
    """Blocks of the rows of ``df``: a vector or array column, and whole-number columns.

    A block holds the rows of one Arrow batch. Rows with a null among these columns are left out.
    """
    names = [f"code{i}" for i in range(len(codes))]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
            columns = [batch.column(i + 1).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(len(names))]
            packed = [pa.array([c.tobytes()], pa.binary()) for c in (x, *columns)]
            sizes = [pa.array([v], pa.int32()) for v in (n, len(x) // n)]
            yield pa.RecordBatch.from_arrays([*sizes, *packed], names=["n", "width", "x", *names])

    is_array = df.schema[features].dataType.typeName() == "array"
    x = F.col(features).cast("array<double>") if is_array else vector_to_array(features)
    rows = df.select(x.alias("x"), *[F.col(c).cast("long").alias(n) for c, n in zip(codes, names, strict=True)]).dropna()
    return Blocks(rows.mapInArrow(pack, ", ".join(["n int, width int, x binary", *(f"{n} binary" for n in names)])))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            n = batch.column(0)[i].as_py()
            # copied, since a block's bytes may start anywhere in its batch
            x, *codes = (np.frombuffer(batch.column(j)[i].as_buffer(), np.uint8).copy() for j in range(2, batch.num_columns))
            yield Block(x.view(np.float64).reshape(n, -1), [c.view(np.int64) for c in codes])
