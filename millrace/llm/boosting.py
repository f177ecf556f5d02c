"""Histogram gradient-boosted trees for two classes, flattened into arrays.

Training takes a bounded sample in one process. A trained forest is a few small arrays; scoring
walks all rows down all trees one level at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """Nodes of all trees one after another; a leaf is its own child."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int

    def margins(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))
        total = np.full(len(x), self.base)
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                low = x[rows, self.feature[node]] <= self.threshold[node]
                node = np.where(low, self.left[node], self.right[node])
            total += self.value[node]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Chance of class 1 for each row."""
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -30, 30)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    """Upper edges of at most ``bins`` bins with about as many rows each."""
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="lower"))


def _best_split(hist: np.ndarray, ridge: float, least: float):
    """Best (gain, feature, bin) of a node; ``hist`` is features x bins x (gradient, curvature)."""
    low = np.cumsum(hist, axis=1)[:, :-1]
    total = hist.sum(axis=1)[:1]
    high = total[:, None] - low
    gain = low[..., 0] ** 2 / (low[..., 1] + ridge) + high[..., 0] ** 2 / (high[..., 1] + ridge)
    gain -= total[..., 0, None] ** 2 / (total[..., 1, None] + ridge)
    gain = np.where((low[..., 1] >= least) & (high[..., 1] >= least), gain, -np.inf)
    at = int(gain.argmax())
    feature, split = divmod(at, gain.shape[1])
    return gain[feature, split], feature, split


def train(
    x: np.ndarray,
    y: np.ndarray,
    trees: int = 80,
    depth: int = 4,
    rate: float = 0.15,
    bins: int = 64,
    ridge: float = 1.0,
    least: float = 2.0,
) -> Forest:
    """A forest for labels 0 and 1. Without rows, or with one class only, it is the (smoothed) base rate."""
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    base = float(np.log(share / (1 - share)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def leaf(v: float) -> int:
        k = len(feature)
        for column, item in zip((feature, threshold, left, right, value), (0, 0.0, k, k, v), strict=True):
            column.append(item)
        return k

    if 0 < y.sum() < len(y):
        edges = [_edges(x[:, j], bins) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)
        flat = binned + np.arange(x.shape[1]) * bins
        margin = np.full(len(y), base)

        def grow(rows: np.ndarray, level: int) -> int:
            grad = gradient[rows].sum()
            k = leaf(-rate * grad / (curvature[rows].sum() + ridge))
            if level == depth:
                return k
            cells, shape = flat[rows].ravel(), (x.shape[1], bins)
            both = [
                np.bincount(cells, np.repeat(w[rows], x.shape[1]), bins * x.shape[1]).reshape(shape)
                for w in (gradient, curvature)
            ]
            gain, j, split = _best_split(np.stack(both, axis=-1), ridge, least)
            if not gain > 1e-6:
                return k
            low = binned[rows, j] <= split
            feature[k], threshold[k] = j, edges[j][split]
            left[k], right[k] = grow(rows[low], level + 1), grow(rows[~low], level + 1)
            return k

        for _ in range(trees):
            chance = 1 / (1 + np.exp(-margin))
            gradient, curvature = chance - y, chance * (1 - chance)
            roots.append(grow(np.arange(len(y)), 0))
            forest = Forest(*map(np.array, (feature, threshold, left, right, value, roots[-1:])), 0.0, depth)
            margin += forest.margins(x)
    columns = (feature or [0], threshold or [0.0], left or [0], right or [0], value or [0.0])
    return Forest(*map(np.array, columns), np.array(roots, np.int64), base, depth)
