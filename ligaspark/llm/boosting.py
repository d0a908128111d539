"""Histogram gradient-boosted trees, in NumPy: trained on binned features, flattened into arrays, and evaluated for many rows at once.

Training is the second-order boosting of Friedman (2001) and Chen and Guestrin (2016) with logistic loss: features are cut into at most 255 bins by quantiles of
the training rows, a tree grows level by level, and a node's split comes from histograms of gradients over bins, all nodes of a level in one pass.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """Trees as flat arrays, one complete binary tree of ``depth`` levels after another: feature, threshold (go right if greater), leaf values."""

    base: float
    depth: int
    feature: np.ndarray  # (trees, 2**depth - 1) int16
    threshold: np.ndarray  # (trees, 2**depth - 1) float32
    value: np.ndarray  # (trees, 2**depth) float32

    def margin(self, x: np.ndarray) -> np.ndarray:
        rows, total = np.arange(len(x)), np.full(len(x), self.base)
        for f, t, v in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            total += v[node - (len(t))]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -30, 30)))


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64, ridge: float = 2.0, least: float = 5.0) -> Forest:
    """``x`` (rows, features) float32, ``y`` 0 or 1. ``least`` is the smallest weight of rows in a child. One class only: a constant score."""
    x = np.asarray(x, dtype=np.float32)
    w = np.ones(len(y)) if weight is None else weight
    share = float(np.clip(np.average(y, weights=w), 0.01, 0.99)) if len(y) else 0.5
    base = float(np.log(share / (1 - share)))
    inner, leaves = 2**depth - 1, 2**depth
    if not len(y) or y.min() == y.max():
        return Forest(base, depth, np.zeros((0, inner), np.int16), np.zeros((0, inner), np.float32), np.zeros((0, leaves), np.float32))
    k = x.shape[1]
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1]).astype(np.float32)) for j in range(k)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)  # bin b: at most cuts[b]
    margin = np.full(len(y), base)
    features, thresholds, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(y), dtype=np.int64)
        feature, threshold = np.zeros(inner, np.int16), np.full(inner, np.inf, np.float32)
        for level in range(depth):
            n, at = 2**level, 2**level - 1
            best, where, cut = np.full(n, 1e-6), np.zeros(n, np.int64), np.full(n, -1)
            sums = [np.bincount(node, weights=v, minlength=n) for v in (g, h)]
            whole = sums[0] ** 2 / (sums[1] + ridge)
            for j in range(k):
                if not len(cuts[j]):
                    continue
                key = node * bins + binned[:, j]
                left = [np.bincount(key, weights=v, minlength=n * bins).reshape(n, bins).cumsum(axis=1)[:, : len(cuts[j])] for v in (g, h, w)]
                right_g, right_h = sums[0][:, None] - left[0], sums[1][:, None] - left[1]
                count = np.bincount(node, weights=w, minlength=n)[:, None]
                gain = left[0] ** 2 / (left[1] + ridge) + right_g**2 / (right_h + ridge) - whole[:, None]
                gain[(left[2] < least) | (count - left[2] < least)] = -1
                b = gain.argmax(axis=1)
                top = gain[np.arange(n), b]
                better = top > best + 1e-12
                best[better], where[better], cut[better] = top[better], j, b[better]
            goes = np.zeros(len(y), dtype=np.int64)
            for i in np.flatnonzero(cut >= 0):
                feature[at + i], threshold[at + i] = where[i], cuts[where[i]][cut[i]]
                mine = node == i
                goes[mine] = x[mine, where[i]] > threshold[at + i]
            node = 2 * node + goes
        value = -rate * np.bincount(node, weights=g, minlength=leaves) / (np.bincount(node, weights=h, minlength=leaves) + ridge)
        margin += value[node]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value.astype(np.float32))
    return Forest(base, depth, np.array(features), np.array(thresholds), np.array(values))
