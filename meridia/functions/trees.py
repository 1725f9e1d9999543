"""Scoring many small binary trees at once on a batch of rows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class TreeTable:
    """All nodes of all trees in one set of arrays; children are positions, a leaf points to itself.

    A row goes left when ``above < x[feature] <= upto``.
    """

    roots: np.ndarray
    output: np.ndarray
    feature: np.ndarray
    above: np.ndarray
    upto: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray, outputs: int = 1) -> np.ndarray:
        """Sum of the leaf values per output, one row per row of ``x``."""
        rows = np.arange(len(x))
        total = np.zeros((len(x), outputs))
        for root, out in zip(self.roots, self.output):
            at = np.full(len(x), root)
            for _ in range(self.depth):
                seen = x[rows, self.feature[at]]
                goes_left = (seen > self.above[at]) & (seen <= self.upto[at])
                at = np.where(goes_left, self.left[at], self.right[at])
            total[:, out] += self.value[at]
        return total
