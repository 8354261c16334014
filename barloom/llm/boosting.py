"""Small gradient-boosted trees for functions that run inside tasks."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass(frozen=True)
class Trees:
    feature: np.ndarray  # tree x inner node
    border: np.ndarray
    value: np.ndarray  # tree x leaf
    start: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row."""
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, border, value in zip(self.feature, self.border, self.value):
            at = np.zeros(len(x), np.int64)
            for _ in range(inner.bit_length()):
                at = 2 * at + 1 + (x[rows, feature[at]] > border[at])
            total += value[at - inner]
        return total


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.2, ridge: float = 1.0) -> Trees:
    """Logistic boosting of complete trees with histogram splits, of rows x and labels 0 and 1."""
    n, d = x.shape
    borders = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(d)]
    binned = np.stack([np.searchsorted(b, x[:, j], "left") for j, b in enumerate(borders)], axis=1)
    flat = binned + np.arange(d) * BINS
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    start = float(np.log(share / (1 - share)))
    margin, inner = np.full(n, start), (1 << depth) - 1
    out = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        slope, curve = y - p, p * (1 - p)
        feature, border, at = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(n, np.int64)
        for level in range(depth):
            first, nodes = (1 << level) - 1, 1 << level
            cell = ((at - first)[:, None] * (d * BINS) + flat).ravel()
            sums = [
                np.bincount(cell, np.repeat(v, d), nodes * d * BINS).reshape(nodes, d, BINS).cumsum(axis=2)
                for v in (slope, curve)
            ]
            (g, h), (all_g, all_h) = sums, (s[:, :, -1:] for s in sums)
            gain = g**2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g**2 / (all_h + ridge)
            best = gain.reshape(nodes, -1).argmax(axis=1)
            for node in range(nodes):
                j, b = divmod(int(best[node]), BINS)
                if gain[node, j, b] > 1e-9 and b < len(borders[j]):
                    feature[first + node], border[first + node] = j, borders[j][b]
            at = 2 * at + 1 + (x[np.arange(n), feature[at]] > border[at])
        leaf = at - inner
        value = rate * np.bincount(leaf, slope, inner + 1) / (np.bincount(leaf, curve, inner + 1) + ridge)
        margin += value[leaf]
        out.append((feature, border, value))
    return Trees(*(np.stack([t[i] for t in out]) for i in range(3)), start)
