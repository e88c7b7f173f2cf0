"""An isolation forest over a small table of numbers."""

from __future__ import annotations

import math

import numpy as np


def usual_path(n: int) -> float:
    """Mean path length of an unsuccessful search among ``n`` values."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


class Forest:
    """Random trees as flat arrays: feature (-1: leaf), cut, children, path length at a leaf."""

    def __init__(self, trees: list[tuple[np.ndarray, ...]], usual: float):
        self.trees, self.usual = trees, usual

    @classmethod
    def grow(cls, rows: np.ndarray, trees: int, size: int, seed: int) -> Forest:
        random = np.random.default_rng(seed)
        size = min(size, len(rows))
        depth = max(1, math.ceil(math.log2(max(size, 2))))
        return cls([cls._tree(random, rows[random.choice(len(rows), size, replace=False)], depth) for _ in range(trees)],
                   usual_path(size))

    @staticmethod
    def _tree(random: np.random.Generator, rows: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
        feature, cut, left, right, length = [], [], [], [], []
        todo = [(rows, 0, None)]
        while todo:
            part, depth, link = todo.pop()
            at = len(feature)
            if link:
                link[0][link[1]] = at
            low, high = part.min(axis=0), part.max(axis=0)
            wide = np.flatnonzero(high > low)
            done = depth >= most or len(part) <= 1 or not len(wide)
            f = -1 if done else int(random.choice(wide))
            c = 0.0 if done else float(random.uniform(low[f], high[f]))
            feature.append(f)
            cut.append(c)
            left.append(at)
            right.append(at)
            length.append(depth + usual_path(len(part)) if done else 0.0)
            if not done:
                below = part[:, f] < c
                todo.append((part[~below], depth + 1, (right, at)))
                todo.append((part[below], depth + 1, (left, at)))
        return tuple(np.array(x) for x in (feature, cut, left, right, length))

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Between 0 and 1; the higher, the sooner random splits isolate the row."""
        total, each = np.zeros(len(rows)), np.arange(len(rows))
        for feature, cut, left, right, length in self.trees:
            at = np.zeros(len(rows), dtype=np.int64)
            while True:
                f = feature[at]
                if (f < 0).all():
                    break
                at = np.where(f < 0, at, np.where(rows[each, np.maximum(f, 0)] < cut[at], left[at], right[at]))
            total += length[at]
        return 2.0 ** -(total / max(1, len(self.trees)) / max(self.usual, 1e-9))
