"""Gradient-boosted trees for a few classes, in numpy: binned features, softmax loss."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

BINS = 24


class Forest(NamedTuple):
    edges: list[np.ndarray]  # bin limits by feature
    feature: np.ndarray  # rounds x classes x inner nodes
    cut: np.ndarray
    leaf: np.ndarray  # rounds x classes x leaves
    start: np.ndarray
    depth: int


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1).astype(np.int32)


def fit(x: np.ndarray, y: np.ndarray, classes: int, rounds: int = 30, depth: int = 4, rate: float = 0.3, least: float = 3.0) -> Forest:
    """Trees of one depth for each class and round, split by the gain of second-order sums."""
    quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = [np.unique(np.quantile(x[:, j], quantiles)) for j in range(x.shape[1])]
    b = binned(x, edges)
    n, f = b.shape
    start = np.log(np.bincount(y, minlength=classes) / n + 1e-3)
    score = np.tile(start, (n, 1))
    inner = 2**depth - 1
    feature = np.zeros((rounds, classes, inner), np.int32)
    cut = np.full((rounds, classes, inner), BINS, np.int32)
    leaf = np.zeros((rounds, classes, 2**depth))
    flat = b + np.arange(f, dtype=np.int32) * BINS  # cells of a histogram over all features
    for r in range(rounds):
        e = np.exp(score - score.max(1, keepdims=True))
        p = e / e.sum(1, keepdims=True)
        for k in range(classes):
            g, h = p[:, k] - (y == k), p[:, k] * (1 - p[:, k]) + 1e-6
            at = np.zeros(n, np.int64)
            for level in range(depth):
                first = 2**level - 1
                for i in range(first, 2**level * 2 - 1):
                    rows = np.flatnonzero(at == i)
                    if len(rows) < 2:
                        continue
                    cells = flat[rows].ravel()
                    gh = [np.bincount(cells, np.repeat(v[rows], f), f * BINS).reshape(f, BINS) for v in (g, h)]
                    left = [np.cumsum(v, 1) for v in gh]
                    all_ = [v[:, -1:] for v in left]
                    right = [t - v for t, v in zip(all_, left)]
                    gain = left[0] ** 2 / (left[1] + 1) + right[0] ** 2 / (right[1] + 1) - all_[0] ** 2 / (all_[1] + 1)
                    gain[(left[1] < least) | (right[1] < least)] = -1
                    j, c = np.unravel_index(np.argmax(gain), gain.shape)
                    if gain[j, c] > 1e-3:
                        feature[r, k, i], cut[r, k, i] = j, c
                at = 2 * at + 1 + (b[np.arange(n), feature[r, k][at]] > cut[r, k][at])
            leaves = at - inner
            sums = [np.bincount(leaves, v, 2**depth) for v in (g, h)]
            leaf[r, k] = -rate * sums[0] / (sums[1] + 1)
            score[:, k] += leaf[r, k][leaves]
    return Forest(edges, feature, cut, leaf, start, depth)


def log_probabilities(model: Forest, x: np.ndarray) -> np.ndarray:
    b = binned(x, model.edges)
    rows = np.arange(len(b))
    rounds, classes, inner = model.feature.shape
    score = np.tile(model.start, (len(b), 1))
    for r in range(rounds):
        for k in range(classes):
            at = np.zeros(len(b), np.int64)
            feature, cut = model.feature[r, k], model.cut[r, k]
            for _ in range(model.depth):
                at = 2 * at + 1 + (b[rows, feature[at]] > cut[at])
            score[:, k] += model.leaf[r, k][at - inner]
    top = score.max(1, keepdims=True)
    return score - top - np.log(np.exp(score - top).sum(1, keepdims=True))
