"""A small random forest for two classes, fitted on a bounded table in memory."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

TREES = 40
DEPTH = 8
LEAST_ROWS = 4
SEED = 7


@dataclass(frozen=True)
class Tree:
    """Nodes in order; a leaf has feature -1 and holds the share of positive rows."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), dtype=np.int64)
        rows = np.arange(len(x))
        while True:
            feature = self.feature[at]
            inner = feature >= 0
            if not inner.any():
                return self.share[at]
            go_left = x[rows, np.maximum(feature, 0)] <= self.cut[at]
            at = np.where(inner, np.where(go_left, self.left[at], self.right[at]), at)


def _best_split(values: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Gini impurity after the best cut of one feature, and the cut; inf if there is none."""
    order = np.argsort(values, kind="stable")
    v, positive = values[order], np.cumsum(y[order])
    n = len(v)
    left = np.arange(1, n)
    usable = (v[1:] > v[:-1]) & (left >= LEAST_ROWS) & (n - left >= LEAST_ROWS)
    if not usable.any():
        return np.inf, 0.0
    p_left = positive[:-1] / left
    p_right = (positive[-1] - positive[:-1]) / (n - left)
    gini = left * p_left * (1 - p_left) + (n - left) * p_right * (1 - p_right)
    gini = np.where(usable, gini, np.inf)
    at = int(np.argmin(gini))
    return float(gini[at]), float((v[at] + v[at + 1]) / 2)


def _grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> Tree:
    nodes: list[list[float]] = []
    tried = max(1, int(np.ceil(np.sqrt(x.shape[1]))))

    def add(rows: np.ndarray, depth: int) -> int:
        share = float(y[rows].mean())
        number = len(nodes)
        nodes.append([-1, 0.0, 0, 0, share])
        if depth == DEPTH or share in (0.0, 1.0):
            return number
        features = rng.choice(x.shape[1], size=tried, replace=False)
        splits = [(*_best_split(x[rows, f], y[rows]), int(f)) for f in features]
        impurity, cut, feature = min(splits)
        if not np.isfinite(impurity):
            return number
        below = x[rows, feature] <= cut
        left = add(rows[below], depth + 1)
        right = add(rows[~below], depth + 1)
        nodes[number] = [feature, cut, left, right, share]
        return number

    add(np.arange(len(y)), 0)
    table = np.array(nodes)
    return Tree(
        table[:, 0].astype(np.int64), table[:, 1], table[:, 2].astype(np.int64),
        table[:, 3].astype(np.int64), table[:, 4],
    )


def fit_forest(x: np.ndarray, y: np.ndarray) -> list[Tree]:
    """TREES trees on bootstrap samples, each split from a random square root of the features."""
    rng = np.random.default_rng(SEED)
    trees = []
    for _ in range(TREES):
        rows = rng.integers(0, len(y), len(y))
        trees.append(_grow(x[rows], y[rows].astype(float), rng))
    return trees


def predict_forest(trees: list[Tree], x: np.ndarray) -> np.ndarray:
    """Mean share of positive rows over the trees' leaves."""
    return np.mean([tree.predict(x) for tree in trees], axis=0)
