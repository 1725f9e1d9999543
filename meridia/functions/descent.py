"""Quasi-Newton descent as a conversation: many minimisations share each pass over the data.

A ``descent`` asks for the value and gradient at one point at a time. ``run_together`` keeps any number of
them going and answers all their questions of one turn with one call, which is one pass over the rows.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Callable, Generator, Sequence
from dataclasses import dataclass

import numpy as np

MEMORY = 10
ENOUGH_DECREASE, ENOUGH_CURVATURE = 1e-4, 0.9
STEPS_A_SEARCH = 30
# A function with edges has no small gradient at its minimum: it is done when this many turns in a row gain little.
STALE = 3


@dataclass(frozen=True)
class Minimum:
    point: np.ndarray
    value: float
    turns: int


Descent = Generator[np.ndarray, tuple[float, np.ndarray], Minimum]


def descent(start: np.ndarray, max_iter: int = 200, tolerance: float = 1e-7) -> Descent:
    """L-BFGS with a bisecting search for the weak Wolfe conditions, which also holds for functions with edges."""
    x = start
    value, slope = yield x
    pairs: deque[tuple[np.ndarray, np.ndarray, float]] = deque(maxlen=MEMORY)
    stale = turns = 0
    while turns < max_iter and stale < STALE:
        if np.abs(slope).max() <= tolerance * max(1.0, np.abs(x).max()):
            break
        way = -_scaled(slope, pairs)
        fall = float(slope @ way)
        if fall >= 0:
            pairs.clear()
            way, fall = -slope, -float(slope @ slope)
        low, high = 0.0, math.inf
        step = 1.0 if pairs else min(1.0, 1.0 / np.linalg.norm(slope))
        best = None
        for _ in range(STEPS_A_SEARCH):
            there = x + step * way
            found, gradient = yield there
            if not found <= value + ENOUGH_DECREASE * step * fall:
                high = step
            else:
                best = (there, found, gradient)
                if gradient @ way >= ENOUGH_CURVATURE * fall:
                    break
                low = step
            step = (low + high) / 2 if high < math.inf else 2 * low
        if best is None:
            break
        there, found, gradient = best
        moved, turned = there - x, gradient - slope
        bend = float(moved @ turned)
        if bend > 1e-12 * float(turned @ turned):
            pairs.append((moved, turned, bend))
        stale = stale + 1 if value - found <= tolerance * 1e-3 * max(1.0, abs(value)) else 0
        x, value, slope = there, found, gradient
        turns += 1
    return Minimum(x, value, turns)


def _scaled(slope: np.ndarray, pairs: Sequence[tuple[np.ndarray, np.ndarray, float]]) -> np.ndarray:
    """Approximate inverse curvature times the slope."""
    out = slope.copy()
    kept = []
    for moved, turned, bend in reversed(pairs):
        a = float(moved @ out) / bend
        out -= a * turned
        kept.append(a)
    if pairs:
        _, turned, bend = pairs[-1]
        out *= bend / float(turned @ turned)
    for (moved, turned, bend), a in zip(pairs, reversed(kept), strict=True):
        out += (a - float(turned @ out) / bend) * moved
    return out


def run_together(
    descents: Sequence[Descent], answer: Callable[[list[int], np.ndarray], tuple[np.ndarray, np.ndarray]]
) -> tuple[list[Minimum], int]:
    """Minima of all descents, and how often ``answer`` was called.

    ``answer`` gets the numbers of those that ask and their points, and returns the values and gradients there.
    """
    asked = {i: next(d) for i, d in enumerate(descents)}
    done: dict[int, Minimum] = {}
    calls = 0
    while asked:
        active = sorted(asked)
        values, gradients = answer(active, np.stack([asked[i] for i in active]))
        calls += 1
        for i, value, gradient in zip(active, values, gradients, strict=True):
            try:
                asked[i] = descents[i].send((float(value), gradient))
            except StopIteration as stop:
                done[i] = stop.value
                del asked[i]
    return [done[i] for i in range(len(descents))], calls
