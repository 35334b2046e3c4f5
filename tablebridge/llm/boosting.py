"""Gradient-boosted trees for small tables in numpy, and calibration."""

from __future__ import annotations

import numpy as np

BINS = 32


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, l2: float = 1.0,
          weight: np.ndarray | float = 1.0) -> list[list[tuple]]:
    """Trees on the logistic loss; a tree is a list of (feature, cut, left, right) or (-1, value, 0, 0) nodes."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for c in x.T]
    bins = np.stack([np.searchsorted(q, c, side="left") for q, c in zip(cuts, x.T, strict=True)], axis=1)
    margin, trees = np.zeros(len(y)), []
    for _ in range(rounds):
        p = sigmoid(margin)
        g, h = weight * (y - p), weight * p * (1 - p) + 1e-6
        tree: list[tuple] = []

        def grow(rows: np.ndarray, left_depth: int) -> int:
            here = len(tree)
            value = g[rows].sum() / (h[rows].sum() + l2)
            tree.append((-1, rate * value, 0, 0))
            best = (1e-3, -1, 0)
            if left_depth and len(rows) > 4:
                whole = g[rows].sum() ** 2 / (h[rows].sum() + l2)
                for f, q in enumerate(cuts):
                    if not len(q):
                        continue
                    gs = np.cumsum(np.bincount(bins[rows, f], weights=g[rows], minlength=len(q) + 1))
                    hs = np.cumsum(np.bincount(bins[rows, f], weights=h[rows], minlength=len(q) + 1))
                    gain = gs[:-1] ** 2 / (hs[:-1] + l2) + (gs[-1] - gs[:-1]) ** 2 / (hs[-1] - hs[:-1] + l2) - whole
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (gain[k], f, k)
            if best[1] >= 0:
                _, f, k = best
                low = bins[rows, f] <= k
                if low.any() and not low.all():
                    tree[here] = (f, float(cuts[f][k]), grow(rows[low], left_depth - 1), grow(rows[~low], left_depth - 1))
            return here

        grow(np.arange(len(y)), depth)
        trees.append(tree)
        margin += _tree(tree, x)
    return trees


def _tree(tree: list[tuple], x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x))
    todo = [(0, np.arange(len(x)))]
    while todo:
        at, rows = todo.pop()
        f, cut, left, right = tree[at]
        if f < 0:
            out[rows] = cut
        else:
            low = x[rows, f] <= cut
            todo += [(left, rows[low]), (right, rows[~low])]
    return out


def margins(trees: list[list[tuple]], x: np.ndarray) -> np.ndarray:
    return sum((_tree(t, x) for t in trees), np.zeros(len(x)))


def platt(margin: np.ndarray, y: np.ndarray, weight: np.ndarray | float = 1.0) -> tuple[float, float]:
    """Slope and offset that turn margins into probabilities."""
    x, b = np.stack([margin, np.ones(len(margin))], axis=1), np.array([1.0, 0.0])
    for _ in range(25):
        p = sigmoid(x @ b)
        b += np.linalg.solve(x.T @ (x * (weight * p * (1 - p))[:, None]) + 0.1 * np.eye(2), x.T @ (weight * (y - p)) - 0.1 * (b - [1, 0]))
    return float(b[0]), float(b[1])


def least_threshold(p: np.ndarray, y: np.ndarray, precision: float, lowest: float, weight: np.ndarray | None = None) -> float:
    """The least threshold, at least ``lowest``, at which what passes has the precision; above 1 if there is none."""
    order = np.argsort(-p, kind="stable")
    w = np.ones(len(p)) if weight is None else weight[order]
    right = np.cumsum(w * y[order]) / np.cumsum(w)
    good = np.flatnonzero((right >= precision) & (p[order] >= lowest) & np.append(p[order][1:] != p[order][:-1], True)) if len(p) else []
    return float(p[order][good[-1]]) if len(good) else 2.0
