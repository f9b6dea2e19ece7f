"""Gradient-boosted trees with several classes, fitted on the driver to a bounded sample and applied to arrays."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Trees(NamedTuple):
    """Complete trees: ``feature`` and ``limit`` of the inner nodes (rounds x classes x nodes), ``leaf`` values, start ``base``."""

    feature: np.ndarray
    limit: np.ndarray
    leaf: np.ndarray
    base: np.ndarray


def apply(trees: Trees, x: np.ndarray) -> np.ndarray:
    """Log probabilities of the classes for every row of ``x``."""
    rounds, classes, inner = trees.feature.shape
    depth = (inner + 1).bit_length() - 1
    rows = np.arange(len(x))
    score = np.tile(trees.base, (len(x), 1))
    for r in range(rounds):
        for k in range(classes):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, trees.feature[r, k, at]] > trees.limit[r, k, at])
            score[:, k] += trees.leaf[r, k, at - inner]
    score -= score.max(1, keepdims=True)
    return score - np.log(np.exp(score).sum(1, keepdims=True))


def fit(x: np.ndarray, y: np.ndarray, classes: int, rounds: int = 30, depth: int = 4, rate: float = 0.3, l2: float = 1.0,
        bins: int = 32, smallest: float = 1.0) -> Trees:
    """Newton boosting of the softmax loss; splits at quantiles, ``smallest`` is the least curvature of a side."""
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(width)]
    coded = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)]) if n else np.zeros((width, 0), int)
    onehot = np.eye(classes)[y]
    base = np.log((onehot.sum(0) + 1) / (n + classes))
    score = np.tile(base, (n, 1))
    inner = (1 << depth) - 1
    feature = np.zeros((rounds, classes, inner), np.int64)
    limit = np.full((rounds, classes, inner), np.inf)
    leaf = np.zeros((rounds, classes, inner + 1))
    for r in range(rounds):
        p = np.exp(score - score.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        grad, curve = p - onehot, p * (1 - p)
        for k in range(classes):
            g, h = grad[:, k], curve[:, k]
            at = np.zeros(n, np.int64)  # node within its level
            for level in range(depth):
                nodes, first = 1 << level, (1 << level) - 1
                best = np.full(nodes, 1e-9)
                for f in range(width):
                    if not len(edges[f]):
                        continue
                    wide = len(edges[f]) + 1
                    place = at * wide + coded[f]
                    gs = np.bincount(place, g, nodes * wide).reshape(nodes, wide)
                    hs = np.bincount(place, h, nodes * wide).reshape(nodes, wide)
                    left_g, left_h = gs.cumsum(1)[:, :-1], hs.cumsum(1)[:, :-1]
                    all_g, all_h = gs.sum(1, keepdims=True), hs.sum(1, keepdims=True)
                    right_g, right_h = all_g - left_g, all_h - left_h
                    gain = left_g**2 / (left_h + l2) + right_g**2 / (right_h + l2) - all_g**2 / (all_h + l2)
                    gain[(left_h < smallest) | (right_h < smallest)] = 0
                    cut = gain.argmax(1)
                    value = gain[np.arange(nodes), cut]
                    for node in np.flatnonzero(value > best):
                        best[node] = value[node]
                        feature[r, k, first + node] = f
                        limit[r, k, first + node] = edges[f][cut[node]]
                goes = x[np.arange(n), feature[r, k, first + at]] > limit[r, k, first + at]
                at = 2 * at + goes
            gs, hs = np.bincount(at, g, inner + 1), np.bincount(at, h, inner + 1)
            leaf[r, k] = -rate * gs / (hs + l2)
            score[:, k] += leaf[r, k, at]
    return Trees(feature, limit, leaf, base)
