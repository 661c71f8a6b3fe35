"""Gradient-boosted trees for a yes/no outcome, on binned features, with Platt calibration."""

from __future__ import annotations

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class BoostedTrees:
    """Second-order boosting: each tree is grown level by level to a fixed depth.

    A tree is stored as a full binary tree: inner node i has children 2i+1 and 2i+2, a feature and
    a bin; rows with a larger bin go right. A node without a useful split sends all rows left.
    """

    def __init__(self, trees: int = 80, depth: int = 4, rate: float = 0.2, bins: int = 32, ridge: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.ridge = trees, depth, rate, bins, ridge
        self.edges: list[np.ndarray] = []
        self.grown: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.start, self.slope, self.shift = 0.0, 1.0, 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        binned, features = self._binned(x), x.shape[1]
        rate = np.clip(y.mean(), 1e-6, 1 - 1e-6)
        self.start = float(np.log(rate / (1 - rate)))
        score = np.full(len(y), self.start)
        for _ in range(self.trees):
            p = _sigmoid(score)
            slope, curve = p - y, p * (1 - p)
            node = np.zeros(len(y), np.int64)
            feature = np.zeros(2**self.depth - 1, np.int64)
            cut = np.full(2**self.depth - 1, self.bins)
            for level in range(self.depth):
                first, count = 2**level - 1, 2**level
                best = np.full(count, 1e-9)
                for j in range(features):
                    key = (node - first) * self.bins + binned[:, j]
                    g = np.bincount(key, slope, count * self.bins).reshape(count, self.bins).cumsum(1)
                    h = np.bincount(key, curve, count * self.bins).reshape(count, self.bins).cumsum(1)
                    whole_g, whole_h = g[:, -1:], h[:, -1:]
                    gain = g**2 / (h + self.ridge) + (whole_g - g) ** 2 / (whole_h - h + self.ridge) - whole_g**2 / (whole_h + self.ridge)
                    gain[(h < 1e-3) | (whole_h - h < 1e-3)] = 0
                    at = gain.argmax(1)
                    better = gain[np.arange(count), at] > best
                    best = np.where(better, gain[np.arange(count), at], best)
                    feature[first : first + count][better] = j
                    cut[first : first + count][better] = at[better]
                node = 2 * node + 1 + (binned[np.arange(len(y)), feature[node]] > cut[node])
            leaf = node - (2**self.depth - 1)
            value = -self.rate * np.bincount(leaf, slope, 2**self.depth) / (np.bincount(leaf, curve, 2**self.depth) + self.ridge)
            score += value[leaf]
            self.grown.append((feature, cut, value))
        return self

    def raw(self, x: np.ndarray) -> np.ndarray:
        binned, rows, score = self._binned(x), np.arange(len(x)), np.full(len(x), self.start)
        for feature, cut, value in self.grown:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (binned[rows, feature[node]] > cut[node])
            score += value[node - (2**self.depth - 1)]
        return score

    def calibrate(self, x: np.ndarray, y: np.ndarray, steps: int = 50) -> BoostedTrees:
        """Platt scaling on rows that the trees were not grown on, by Newton steps.

        A step that would raise the loss is halved: where the trees tell all rows apart, whole steps run away
        and would make every probability 0 or 1.
        """
        z = np.stack([self.raw(x), np.ones(len(x))], axis=1)
        target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))

        def loss(w):
            m = z @ w
            return (np.logaddexp(0, m) - target * m).sum()

        w = np.array([1.0, 0.0])
        for _ in range(steps):
            p = _sigmoid(z @ w)
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2), z.T @ (p - target))
            while np.abs(step).max() > 1e-12 and loss(w - step) > loss(w):
                step = step / 2
            w = w - step
        self.slope, self.shift = map(float, w)
        return self

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * self.raw(x) + self.shift) if len(x) else np.zeros(0)


def precise_threshold(probability: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The lowest probability from which on the rows reach ``precision``; above 1 if none do."""
    order = np.argsort(-probability, kind="stable")
    right = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    last = np.append(probability[order][1:] != probability[order][:-1], True)
    good = np.flatnonzero((right >= precision) & last)
    return float(probability[order][good[-1]]) if len(good) else 1.1
