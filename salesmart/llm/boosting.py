"""Gradient-boosted trees on binned values, for probabilities (logistic loss)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

TREES, DEPTH, RATE, BINS, LEAST, PENALTY = 60, 4, 0.25, 32, 20, 1.0


@dataclass
class Trees:
    edges: list[np.ndarray]
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray
    leaf: np.ndarray  # trees x leaves
    start: float

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, k], "left") for k, e in enumerate(self.edges)]).astype(np.uint8)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        value = np.full(len(x), self.start)
        b = self.binned(x)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (b[rows, feature[at]] > cut[at])
            value += leaf[at - (2**DEPTH - 1)]
        return 1 / (1 + np.exp(-value))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
    """``y`` may be any share from 0 to 1."""
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(x.shape[1])]
    mean = np.clip(np.average(y, weights=weight), 1e-4, 1 - 1e-4)
    inner, n_features = 2**DEPTH - 1, x.shape[1]
    model = Trees(edges, np.zeros((TREES, inner), np.int64), np.full((TREES, inner), 255, np.int64), np.zeros((TREES, 2**DEPTH)), float(np.log(mean / (1 - mean))))
    b = model.binned(x).astype(np.int64)
    flat = b + np.arange(n_features) * BINS
    value = np.full(len(x), model.start)
    for tree in range(TREES):
        p = 1 / (1 + np.exp(-value))
        slope, bend = weight * (y - p), weight * np.maximum(p * (1 - p), 1e-6)
        at = np.zeros(len(x), np.int64)
        for level in range(DEPTH):
            low = 2**level - 1
            for node in range(low, 2 * low + 1):
                rows = np.flatnonzero(at == node)
                if len(rows) < 2 * LEAST:
                    continue
                index = flat[rows].ravel()
                g, h, c = (np.bincount(index, np.repeat(v, n_features), n_features * BINS).reshape(n_features, BINS).cumsum(axis=1) for v in (slope[rows], bend[rows], np.ones(len(rows))))
                g_all, h_all = g[0, -1], h[0, -1]
                gain = g**2 / (h + PENALTY) + (g_all - g) ** 2 / (h_all - h + PENALTY) - g_all**2 / (h_all + PENALTY)
                gain[(c < LEAST) | (len(rows) - c < LEAST)] = -np.inf
                best = int(gain.argmax())
                if gain.ravel()[best] > 1e-6:
                    model.feature[tree, node], model.cut[tree, node] = divmod(best, BINS)
            at = 2 * at + 1 + (b[np.arange(len(x)), model.feature[tree, at]] > model.cut[tree, at])
        leaves = at - inner
        g, h = (np.bincount(leaves, v, 2**DEPTH) for v in (slope, bend))
        model.leaf[tree] = RATE * g / (h + PENALTY)
        value += model.leaf[tree][leaves]
    return model
