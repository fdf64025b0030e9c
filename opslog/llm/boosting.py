"""Gradient-boosted regression trees for a yes/no target, on binned features."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

BINS = 32


@dataclass
class Boosted:
    """Bin edges, and trees in heap order: feature (-1: leaf), bin, value."""

    edges: list[np.ndarray]
    bias: float
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def binned(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, np.uint8)
        for f, e in enumerate(self.edges):
            out[:, f] = np.searchsorted(e, x[:, f], "left")
        return out

    def logit(self, x: np.ndarray) -> np.ndarray:
        b, rows, z = self.binned(x), np.arange(len(x)), np.full(len(x), self.bias)
        for feature, cut, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(len(feature).bit_length() - 1):
                f = feature[at]
                inner = f >= 0
                right = b[rows, np.maximum(f, 0)] > cut[at]
                at = np.where(inner, 2 * at + 1 + right, at)
            z += value[at]
        return z


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 40, depth: int = 5, rate: float = 0.25,
        least: float = 8.0, ridge: float = 1.0) -> Boosted:
    """Newton boosting of the logistic loss; every tree has at most ``depth`` levels."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    share = float(np.clip((weight @ y + 1) / (weight.sum() + 2), 1e-3, 1 - 1e-3))
    m = Boosted(edges, float(np.log(share / (1 - share))))
    if len(np.unique(y)) < 2:
        return m
    b, n, k = m.binned(x).astype(np.int64), len(x), x.shape[1]
    flat = b + np.arange(k) * BINS
    z = np.full(n, m.bias)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-z))
        g, h = weight * (y - p), weight * p * (1 - p)
        size = (1 << (depth + 1)) - 1
        feature, cut, value = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)
        todo = [(0, np.arange(n), 0)]
        while todo:
            node, rows, level = todo.pop()
            sg, sh = g[rows].sum(), h[rows].sum()
            value[node] = rate * sg / (sh + ridge)
            z[rows] += value[node]
            if level == depth or len(rows) < 2 * least:
                continue
            where = flat[rows].reshape(-1)
            hg = np.bincount(where, np.repeat(g[rows], k), k * BINS).reshape(k, BINS).cumsum(axis=1)
            hh = np.bincount(where, np.repeat(h[rows], k), k * BINS).reshape(k, BINS).cumsum(axis=1)
            hn = np.bincount(where, minlength=k * BINS).reshape(k, BINS).cumsum(axis=1)
            gain = hg ** 2 / (hh + ridge) + (sg - hg) ** 2 / (sh - hh + ridge) - sg ** 2 / (sh + ridge)
            gain[(hn < least) | (len(rows) - hn < least)] = -1
            f, c = np.unravel_index(gain.argmax(), gain.shape)
            if gain[f, c] <= 1e-6:
                continue
            feature[node], cut[node] = f, c
            right = b[rows, f] > c
            z[rows] -= value[node]
            todo += [(2 * node + 1, rows[~right], level + 1), (2 * node + 2, rows[right], level + 1)]
        m.trees.append((feature, cut, value))
    return m
