"""Histogram gradient-boosted trees for two classes, kept as flat arrays.

Training takes a bounded sample of feature rows and runs in numpy; scoring walks all rows of
a batch through all trees at once, level by level, and so runs inside Spark tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """Nodes of all trees in flat arrays. A leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def margin(self, rows: np.ndarray) -> np.ndarray:
        """Log-odds of class 1 for each row."""
        total = np.full(len(rows), self.base)
        at = np.arange(len(rows))
        for root in self.roots:
            node = np.full(len(rows), root)
            for _ in range(self.depth):
                goes_left = rows[at, self.feature[node]] <= self.threshold[node]
                node = np.where(goes_left, self.left[node], self.right[node])
            total += self.value[node]
        return total

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return sigmoid(self.margin(rows))


def sigmoid(margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -60, 60)))


def fit(rows: np.ndarray, labels: np.ndarray, *, trees: int = 120, depth: int = 4, rate: float = 0.1,
        bins: int = 64, least_rows: int = 10, l2: float = 1.0) -> Forest:
    """Trees for the logistic loss. Without rows of both classes, a constant."""
    y = np.asarray(labels, dtype=float)
    x = np.asarray(rows, dtype=float)
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    builder = _Builder(depth, float(np.log(share / (1 - share))))
    if len(y) < 2 * least_rows or y.min() == y.max():
        return builder.forest()
    n, n_features = x.shape
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T]
    codes = np.stack([np.searchsorted(c, column, "left") for c, column in zip(cuts, x.T)], axis=1)
    flat = codes + np.arange(n_features) * bins
    margin = np.full(n, builder.base)
    for _ in range(trees):
        p = sigmoid(margin)
        gradient, hessian = p - y, np.maximum(p * (1 - p), 1e-9)
        members = [(builder.new_tree(), np.arange(n))]
        for level in range(depth + 1):
            following = []
            for node, own in members:
                split = None if level == depth or len(own) < 2 * least_rows else _best_split(
                    flat[own], gradient[own], hessian[own], n_features, bins, least_rows, l2)
                if split is None:
                    builder.value[node] = -rate * gradient[own].sum() / (hessian[own].sum() + l2)
                    margin[own] += builder.value[node]
                    continue
                feature, cut = split
                goes_left = codes[own, feature] <= cut
                left, right = builder.split(node, feature, cuts[feature][cut])
                following += [(left, own[goes_left]), (right, own[~goes_left])]
            members = following
    return builder.forest()


def _best_split(flat, gradient, hessian, n_features, bins, least_rows, l2):
    """(feature, last bin that goes left) of the largest gain, or None."""
    size = n_features * bins
    at = flat.ravel()
    shape = (n_features, bins)
    g = np.bincount(at, np.repeat(gradient, n_features), size).reshape(shape).cumsum(axis=1)[:, :-1]
    h = np.bincount(at, np.repeat(hessian, n_features), size).reshape(shape).cumsum(axis=1)[:, :-1]
    c = np.bincount(at, minlength=size).reshape(shape).cumsum(axis=1)[:, :-1]
    g_all, h_all, c_all = gradient.sum(), hessian.sum(), len(gradient)
    gain = g * g / (h + l2) + (g_all - g) ** 2 / (h_all - h + l2) - g_all * g_all / (h_all + l2)
    gain[(c < least_rows) | (c_all - c < least_rows)] = 0.0
    best = int(gain.argmax())
    return divmod(best, bins - 1) if gain.flat[best] > 1e-6 else None


class _Builder:
    def __init__(self, depth: int, base: float):
        self.depth, self.base = depth, base
        self.feature: list[int] = []
        self.threshold: list[float] = []
        self.left: list[int] = []
        self.right: list[int] = []
        self.value: list[float] = []
        self.roots: list[int] = []

    def _leaf(self) -> int:
        node = len(self.feature)
        self.feature.append(0)
        self.threshold.append(0.0)
        self.left.append(node)
        self.right.append(node)
        self.value.append(0.0)
        return node

    def new_tree(self) -> int:
        self.roots.append(self._leaf())
        return self.roots[-1]

    def split(self, node: int, feature: int, threshold: float) -> tuple[int, int]:
        self.feature[node], self.threshold[node] = feature, float(threshold)
        self.left[node], self.right[node] = self._leaf(), self._leaf()
        return self.left[node], self.right[node]

    def forest(self) -> Forest:
        return Forest(np.asarray(self.feature, dtype=np.int64), np.asarray(self.threshold, dtype=float),
                      np.asarray(self.left, dtype=np.int64), np.asarray(self.right, dtype=np.int64),
                      np.asarray(self.value, dtype=float), np.asarray(self.roots, dtype=np.int64),
                      self.depth, self.base)


@dataclass
class Isotonic:
    """Non-decreasing map from margins to probabilities."""

    margins: np.ndarray
    values: np.ndarray

    def __call__(self, margin: np.ndarray) -> np.ndarray:
        return np.interp(margin, self.margins, self.values) if len(self.margins) else sigmoid(margin)


def isotonic(margins: np.ndarray, labels: np.ndarray, prior: float = 1.0) -> Isotonic:
    """Pool adjacent violators; interpolates between the centres of the pooled blocks.

    ``prior`` is the weight of one pseudo-label at each end, which keeps scores off 0 and 1.
    """
    if not len(margins):
        return Isotonic(np.zeros(0), np.zeros(0))
    order = np.argsort(margins, kind="stable")
    x = np.r_[margins[order[0]] - 1.0, margins[order], margins[order[-1]] + 1.0]
    y = np.r_[0.0, np.asarray(labels, dtype=float)[order], 1.0]
    weight = np.r_[prior, np.ones(len(order)), prior]
    blocks: list[list[float]] = []      # mean, weight, weighted sum of margins
    for xi, yi, wi in zip(x, y, weight):
        blocks.append([yi, wi, xi * wi])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            mean, w, s = blocks.pop()
            last = blocks[-1]
            last[0] = (last[0] * last[1] + mean * w) / (last[1] + w)
            last[1] += w
            last[2] += s
    return Isotonic(np.array([s / w for _, w, s in blocks]), np.array([m for m, _, _ in blocks]))
