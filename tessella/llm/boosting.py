"""Gradient-boosted trees for small labelled sets, applied as Spark expressions.

Trees are fitted by Newton steps on the logistic loss. A fitted forest becomes
one nested CASE expression a tree, so rows are scored inside the JVM.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def _grow(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, depth: int, ridge: float):
    def gain(g, h):
        return g * g / (h + ridge)

    if depth:
        best = (1e-6, None, None)
        for j in range(x.shape[1]):
            order = np.argsort(x[:, j], kind="stable")
            v, g, h = x[order, j], np.cumsum(grad[order]), np.cumsum(hess[order])
            cut = np.flatnonzero(v[1:] > v[:-1])
            if len(cut):
                rise = gain(g[cut], h[cut]) + gain(g[-1] - g[cut], h[-1] - h[cut]) - gain(g[-1], h[-1])
                k = int(np.argmax(rise))
                if rise[k] > best[0]:
                    best = (float(rise[k]), j, float(v[cut[k]] + v[cut[k] + 1]) / 2)
        if best[1] is not None:
            left = x[:, best[1]] <= best[2]
            return (best[1], best[2], _grow(x[left], grad[left], hess[left], depth - 1, ridge), _grow(x[~left], grad[~left], hess[~left], depth - 1, ridge))
    return float(-grad.sum() / (hess.sum() + ridge))


def _apply(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    left = x[:, tree[0]] <= tree[1]
    return np.where(left, _apply(tree[2], x), _apply(tree[3], x))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 25, depth: int = 3, rate: float = 0.3, ridge: float = 1.0) -> list:
    margin, forest = np.zeros(len(y)), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        tree = _grow(x, p - y, p * (1 - p), depth, ridge)
        forest.append(tree)
        margin += rate * _apply(tree, x)
    return [(rate, t) for t in forest]


def margins(forest: list, x: np.ndarray) -> np.ndarray:
    return sum(rate * _apply(t, x) for rate, t in forest)


def expression(forest: list, features: list[Column]) -> Column:
    """The forest's margin of a row."""

    def of(tree) -> Column:
        if not isinstance(tree, tuple):
            return F.lit(tree)
        return F.when(features[tree[0]] <= F.lit(tree[1]), of(tree[2])).otherwise(of(tree[3]))

    total = F.lit(0.0)
    for rate, tree in forest:
        total = total + F.lit(rate) * of(tree)
    return total
