"""An R-tree over count vectors, packed bottom-up.

A point is a set of tokens as counts by group (tokens are hashed into groups).
The overlap of two sets is at most the sum over groups of the smaller count,
and for a box of points the sum of minima with its largest counts bounds the
overlap with each of them.
"""

from __future__ import annotations

import numpy as np

GROUPS, FANOUT = 256, 16
FINE, FINE_SIZE = 2048, 1024  # groups of large sets, and where these begin


def needed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of sets of sizes a and b with 100 * overlap >= percent *
    union: overlap * (100 + percent) >= percent * (a + b)."""
    return -(-(percent * (a + b)) // (100 + percent))


class CountTree:
    """counts: points x groups; sizes: tokens of each point. Points are packed
    in order of size, then of their fullest group, FANOUT to a box."""

    def __init__(self, counts: np.ndarray, sizes: np.ndarray):
        self.order = np.lexsort((counts.argmax(1), sizes)) if len(sizes) else np.zeros(0, np.int64)
        high, low = counts[self.order], sizes[self.order]
        self.levels = [(high, low, low)]  # (largest counts, least size, largest size)
        while len(low) > FANOUT:
            cuts = np.arange(0, len(low), FANOUT)
            high, low = np.maximum.reduceat(high, cuts), np.minimum.reduceat(low, cuts)
            self.levels.append((high, low, np.maximum.reduceat(self.levels[-1][2], cuts)))

    def search(self, counts: np.ndarray, size: int, percent: int) -> np.ndarray:
        """Points whose bound lets them reach the percentage with the query."""
        boxes = np.arange(len(self.levels[-1][1]))
        for depth in range(len(self.levels) - 1, -1, -1):
            high, low, top = self.levels[depth]
            fits = (100 * low[boxes] <= size * 10000 // percent) & (100 * top[boxes] >= percent * size)
            boxes = boxes[fits]
            bound = np.minimum(high[boxes], counts).sum(1)
            boxes = boxes[bound >= needed(np.maximum(low[boxes], percent * size // 100), size, percent)]
            if depth:
                children = (boxes[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                boxes = children[children < len(self.levels[depth - 1][1])]
        return self.order[boxes]
