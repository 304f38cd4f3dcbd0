"""Gradient-boosted trees on a bounded numpy sample, flattened for vectorised scoring.

The trainer fits logistic loss on quantile-binned features, level by level, with optional
monotonic constraints. A fitted model is three arrays (feature, threshold and leaf value per
tree of complete depth), small enough to travel in a task's closure; scoring walks all rows of
a batch down one level at a time, with no per-row Python.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """Complete binary trees of one depth: node k has children 2k+1 (<= threshold) and 2k+2."""

    base: float
    feature: np.ndarray  # (trees, inner nodes) int
    threshold: np.ndarray  # (trees, inner nodes) float; +inf where a node was not split
    value: np.ndarray  # (trees, leaves) float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            while inner and node[:1].size and node[0] < inner:  # all rows are on the same level
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += value[node - inner]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -40, 40)))


def fit_trees(
    x: np.ndarray,
    y: np.ndarray,
    *,
    trees: int = 60,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 48,
    l2: float = 1.0,
    least: float = 1.0,
    monotone: dict[int, int] | None = None,
) -> Trees:
    """Fit on x (rows, features) and y (0 or 1).

    monotone: feature -> +1 (the score may only rise with it) or -1 (only fall). A split
    against the sign is refused, and each child's values are bounded by the middle of the two
    children, so the whole tree keeps the sign. least: hessian that a child must keep. With no
    rows, or one class alone, the model is the constant prior.
    """
    n, width = x.shape
    share = (y.sum() + 0.5) / (n + 1.0)
    base = float(np.log(share / (1 - share)))
    inner, leaves = 2**depth - 1, 2**depth
    feature = np.zeros((trees, inner), dtype=np.int64)
    threshold = np.full((trees, inner), np.inf)
    value = np.zeros((trees, leaves))
    if n == 0 or y.min() == y.max():
        return Trees(base, feature[:0], threshold[:0], value[:0])
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    sign = np.array([(monotone or {}).get(f, 0) for f in range(width)])
    margin = np.full(n, base)
    for t in range(trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        low, high = np.array([-np.inf]), np.array([np.inf])
        for level in range(depth):
            at, wide = 2**level - 1, 2**level
            best = np.full(wide, 1e-9)
            split = np.full((wide, 2), -1, dtype=np.int64)
            middle = np.zeros(wide)
            rising = np.zeros(wide)
            for f in range(width):
                if not len(edges[f]):
                    continue
                slot = node * bins + binned[:, f]
                g = np.bincount(slot, grad, wide * bins).reshape(wide, bins).cumsum(axis=1)
                h = np.bincount(slot, hess, wide * bins).reshape(wide, bins).cumsum(axis=1)
                gl, hl = g[:, :-1], h[:, :-1]
                gr, hr = g[:, -1:] - gl, h[:, -1:] - hl
                wl = np.clip(-gl / (hl + l2), low[:, None], high[:, None])
                wr = np.clip(-gr / (hr + l2), low[:, None], high[:, None])
                w0 = np.clip(-g[:, -1:] / (h[:, -1:] + l2), low[:, None], high[:, None])
                cost = lambda w, a, b: a * w + 0.5 * (b + l2) * w * w
                gain = cost(w0, g[:, -1:], h[:, -1:]) - cost(wl, gl, hl) - cost(wr, gr, hr)
                gain = np.where((hl >= least) & (hr >= least) & (sign[f] * (wr - wl) >= 0), gain, -1.0)
                gain[:, len(edges[f]) :] = -1.0
                k = gain.argmax(axis=1)
                found = gain[np.arange(wide), k]
                better = found > best
                best[better] = found[better]
                split[better, 0], split[better, 1] = f, k[better]
                middle[better] = 0.5 * (wl + wr)[np.arange(wide), k][better]
                rising[better] = sign[f]
            go_right = np.zeros(n, dtype=np.int64)
            for k in range(wide):
                f, cut = split[k]
                if f >= 0:
                    feature[t, at + k], threshold[t, at + k] = f, edges[f][cut]
                    mine = node == k
                    go_right[mine] = binned[mine, f] > cut
            node = 2 * node + go_right
            low, high = np.repeat(low, 2), np.repeat(high, 2)
            up, down = rising > 0, rising < 0
            high[0::2] = np.where(up, np.minimum(high[0::2], middle), high[0::2])
            low[1::2] = np.where(up, np.maximum(low[1::2], middle), low[1::2])
            low[0::2] = np.where(down, np.maximum(low[0::2], middle), low[0::2])
            high[1::2] = np.where(down, np.minimum(high[1::2], middle), high[1::2])
        g, h = np.bincount(node, grad, leaves), np.bincount(node, hess, leaves)
        value[t] = rate * np.clip(-g / (h + l2), low, high)
        margin += value[t][node]
    return Trees(base, feature, threshold, value)


@dataclass(frozen=True)
class Isotonic:
    """A non-decreasing map from margins to probabilities, linear between its knots."""

    knots: np.ndarray
    levels: np.ndarray

    def __call__(self, margin: np.ndarray) -> np.ndarray:
        return np.interp(margin, self.knots, self.levels)


def fit_isotonic(margin: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> Isotonic:
    """Pool adjacent violators over margins; each pooled level is smoothed by half a row of each class.

    weight: how many rows an entry stands for, of which y have label 1; one each by default. With no
    rows the map is the logistic function itself.
    """
    if not len(margin):
        knots = np.linspace(-8, 8, 65)
        return Isotonic(knots, 1 / (1 + np.exp(-knots)))
    at, inverse = np.unique(margin, return_inverse=True)
    pools: list[list[float]] = []  # rows, ones, sum of margins
    for m, n, ones in zip(at, np.bincount(inverse, weight), np.bincount(inverse, y), strict=True):
        pools.append([float(n), float(ones), float(n * m)])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            n_, ones_, sum_ = pools.pop()
            pools[-1] = [pools[-1][0] + n_, pools[-1][1] + ones_, pools[-1][2] + sum_]
    n, ones, total = np.array(pools).T
    levels = np.maximum.accumulate((ones + 0.5) / (n + 1.0))
    return Isotonic(total / n, levels)
