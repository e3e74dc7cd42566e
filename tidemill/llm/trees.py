"""Gradient-boosted regression trees for a yes-or-no target, on binned features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass(frozen=True)
class Forest:
    """Complete trees of one depth: ``feature[t, k]`` and ``cut[t, k]`` of inner node ``k``, ``leaf[t, j]`` of leaf ``j``."""

    start: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        depth = int(np.log2(self.leaf.shape[1]))
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            out += leaf[at - (2**depth - 1)]
        return out


def fit(x: np.ndarray, y: np.ndarray, *, rounds: int = 60, depth: int = 4, rate: float = 0.2, shrink: float = 1.0) -> Forest:
    """Trees fitted one after the other to the gradient of the logistic loss, splits by gain over ``BINS`` quantiles of each feature."""
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.arange(1, BINS) / BINS)) for f in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    score = np.full(n, start)
    inner = 2**depth - 1
    features, cuts, leaves = [], [], []
    offsets = np.arange(width) * BINS
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        gradient, weight = y - p, np.maximum(p * (1 - p), 1e-6)
        feature, cut, at = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(n, np.int64)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            cell = ((at - first)[:, None] * (width * BINS) + offsets + binned).ravel()
            size = nodes * width * BINS
            g = np.bincount(cell, np.repeat(gradient, width), size).reshape(nodes, width, BINS).cumsum(axis=2)
            h = np.bincount(cell, np.repeat(weight, width), size).reshape(nodes, width, BINS).cumsum(axis=2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + shrink) + (all_g - g) ** 2 / (all_h - h + shrink) - all_g**2 / (all_h + shrink)
            gain[(h < 1) | (all_h - h < 1)] = -1
            for node in range(nodes):
                f, b = divmod(int(gain[node].argmax()), BINS)
                if gain[node, f, b] > 1e-6 and b < len(edges[f]):
                    feature[first + node], cut[first + node] = f, edges[f][b]
            at = 2 * at + 1 + (x[np.arange(n), feature[at]] > cut[at])
        own = at - inner
        g, h = np.bincount(own, gradient, 2**depth), np.bincount(own, weight, 2**depth)
        leaf = rate * g / (h + shrink)
        score += leaf[own]
        features.append(feature)
        cuts.append(cut)
        leaves.append(leaf)
    return Forest(start, np.array(features), np.array(cuts), np.array(leaves))
