"""Exact quantiles of many columns without sorting a column in one task.

The built-in exact ``percentile`` keeps every distinct value of a group in one aggregation buffer.
Here a rank is located by narrowing: approximate quantiles give a value bracket that must contain
it, one aggregate counts the rows below and inside, and this repeats until the bracket is small.
The last bracket is counted value by value, so copies of one value weigh nothing.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_SMALL = 1_000_000
_ERROR = 0.0005


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], small: int = _SMALL
) -> dict[str, list[float | None]]:
    """Linear-interpolation quantiles (position ``(n - 1) * p``) of each column, nulls and NaN left out."""
    names = [f"q{i}" for i in range(len(columns))]
    values = [F.col(f"`{c}`").cast("double") + F.lit(0.0) for c in columns]
    narrow = df.select(*[F.when(~F.isnan(v), v).alias(n) for v, n in zip(values, names)])
    narrow = narrow.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = _locate(narrow, names, list(probabilities), small)
    finally:
        narrow.unpersist()
    return dict(zip(columns, found))


def _locate(df: DataFrame, names: list[str], probabilities: list[float], small: int) -> list[list[float | None]]:
    sizes = df.agg(*[F.count(n).alias(n) for n in names]).first().asDict()
    targets: dict[tuple[str, int], tuple[int, int]] = {}
    for name in names:
        if sizes[name]:
            for i, p in enumerate(probabilities):
                at = (sizes[name] - 1) * p
                targets[name, i] = (math.floor(at), math.ceil(at))
    # (low, high, rows below, rows inside)
    brackets = {t: (-math.inf, math.inf, 0, sizes[t[0]]) for t in targets}
    open_targets = {t for t in targets if sizes[t[0]] > small}
    while open_targets:
        open_targets = _narrow(df, targets, brackets, open_targets, small)
    return _select(df, names, probabilities, sizes, targets, brackets)


def _inside(name: str, low: float, high: float):
    value = F.col(name)
    return F.when((value >= F.lit(low)) & (value <= F.lit(high)), value)


def _narrow(df, targets, brackets, open_targets, small) -> set:
    """One round for all open targets: propose brackets, then keep those that hold their ranks."""
    order = sorted(open_targets)
    views = df.select(*[_inside(t[0], *brackets[t][:2]).alias(f"b{i}") for i, t in enumerate(order)])
    proposed, still_open = {}, set()
    for i, t in enumerate(order):
        _, _, below, m = brackets[t]
        first, last = ((r - below) / max(1, m - 1) for r in targets[t])
        ends = [max(0.0, first - 2 * _ERROR), min(1.0, last + 2 * _ERROR)]
        proposed[t] = views.approxQuantile(f"b{i}", ends, _ERROR)
    checks = []
    for i, (t, (low, high)) in enumerate(proposed.items()):
        value = F.col(t[0])
        checks.append(F.count_if(value < F.lit(low)).alias(f"l{i}"))
        checks.append(F.count_if((value >= F.lit(low)) & (value <= F.lit(high))).alias(f"m{i}"))
    row = df.agg(*checks).first()
    for i, (t, (low, high)) in enumerate(proposed.items()):
        below, m = row[f"l{i}"], row[f"m{i}"]
        first, last = targets[t]
        holds = below <= first and last < below + m
        shrinks = (low, high) != brackets[t][:2]
        if holds and shrinks:
            brackets[t] = (low, high, below, m)
            if m > small and low < high:
                still_open.add(t)
    return still_open


def _select(df, names, probabilities, sizes, targets, brackets) -> list[list[float | None]]:
    """Values at the wanted ranks, from value counts inside the final brackets."""
    result: list[list[float | None]] = [[None] * len(probabilities) for _ in names]
    if not targets:
        return result
    # targets of one column that share a bracket share its counts
    shared: dict[tuple[str, float, float, int], list[tuple[str, int]]] = {}
    for t, (low, high, below, _) in brackets.items():
        shared.setdefault((t[0], low, high, below), []).append(t)
    parts = [
        F.struct(F.lit(i).alias("g"), _inside(name, low, high).alias("v"), F.lit(below).cast("bigint").alias("below"))
        for i, (name, low, high, below) in enumerate(shared)
    ]
    counted = (
        df.select(F.inline(F.array(*parts)))
        .where("v is not null")
        .groupBy("g", "below", "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    window = Window.partitionBy("g").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = counted.withColumn("upto", F.col("below") + F.sum("n").over(window))
    wanted = F.lit(False)
    for i, members in enumerate(shared.values()):
        for rank in sorted({r for t in members for r in targets[t]}):
            covers = (F.col("g") == i) & (F.col("upto") - F.col("n") <= rank) & (F.col("upto") > rank)
            wanted = wanted | covers
    rows = upto.where(wanted).select("g", "v", "n", "upto").collect()
    for i, members in enumerate(shared.values()):
        spans = [(r["upto"] - r["n"], r["upto"], r["v"]) for r in rows if r["g"] == i]
        for name, slot in members:
            first, last = targets[name, slot]
            low = next(v for a, b, v in spans if a <= first < b)
            high = next(v for a, b, v in spans if a <= last < b)
            at = (sizes[name] - 1) * probabilities[slot]
            # Equal ends need no step, which between infinities would be none.
            result[names.index(name)][slot] = low if low == high else low + (high - low) * (at - first)
    return result
