"""Gradient-boosted trees for two classes, small enough to be trained on a driver's bounded sample."""

from __future__ import annotations

import numpy as np


class Boosted:
    """Trees of depth `depth` over at most 32 cuts a feature, fitted to the logistic loss."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2):
        self.rate = rate
        self.trees: list[tuple] = []
        self.base = 0.0
        if not len(y) or y.min() == y.max():
            self.base = 20.0 if len(y) and y[0] > 0.5 else -20.0
            return
        p = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
        self.base = float(np.log(p / (1 - p)))
        cuts = [np.unique(np.quantile(x[:, k], np.linspace(0.02, 0.98, 32))) for k in range(x.shape[1])]
        score = np.full(len(y), self.base)
        for _ in range(rounds):
            q = 1 / (1 + np.exp(-score))
            tree = self._grow(x, y - q, q * (1 - q), cuts, np.arange(len(y)), depth)
            self.trees.append(tree)
            score += rate * self._one(tree, x)

    def _grow(self, x, g, h, cuts, rows, depth):
        value = g[rows].sum() / (h[rows].sum() + 1.0)
        if depth == 0 or len(rows) < 20:
            return (value,)
        best, gain = None, 1e-3
        total_g, total_h = g[rows].sum(), h[rows].sum()
        for k, c in enumerate(cuts):
            where = np.searchsorted(c, x[rows, k], side="right")
            left_g = np.cumsum(np.bincount(where, g[rows], len(c) + 1))[:-1]
            left_h = np.cumsum(np.bincount(where, h[rows], len(c) + 1))[:-1]
            better = left_g**2 / (left_h + 1) + (total_g - left_g) ** 2 / (total_h - left_h + 1) - total_g**2 / (total_h + 1)
            if len(better) and better.max() > gain:
                at = int(better.argmax())
                best, gain = (k, float(c[at])), float(better[at])
        if best is None:
            return (value,)
        right = x[rows, best[0]] >= best[1]
        if right.all() or not right.any():
            return (value,)
        return (*best, self._grow(x, g, h, cuts, rows[~right], depth - 1), self._grow(x, g, h, cuts, rows[right], depth - 1))

    def _one(self, tree, x) -> np.ndarray:
        if len(tree) == 1:
            return np.full(len(x), tree[0])
        right = x[:, tree[0]] >= tree[1]
        out = np.empty(len(x))
        out[~right] = self._one(tree[2], x[~right])
        out[right] = self._one(tree[3], x[right])
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.base)
        for tree in self.trees:
            score += self.rate * self._one(tree, x)
        return 1 / (1 + np.exp(-np.clip(score, -30, 30)))
