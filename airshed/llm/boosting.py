"""Gradient-boosted trees of fixed depth, in numpy node arrays, with monotonic constraints.

All trees are complete binary trees of one depth.  ``feature`` and ``threshold`` hold the inner
nodes of all trees in heap order (node k has children 2k+1 and 2k+2), ``value`` the leaves, so that
scoring a block of rows is ``depth`` indexed comparisons per tree.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from airshed.llm.common import ship_by_value

ship_by_value(__name__)


@dataclass
class Trees:
    base: float
    depth: int
    feature: np.ndarray    # trees x (2^depth - 1)
    threshold: np.ndarray  # trees x (2^depth - 1); a row goes right if its value is larger
    value: np.ndarray      # trees x 2^depth

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row."""
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            total += v[node - len(f)]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -35, 35)))


def fit(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, trees: int = 60, depth: int = 3,
        rate: float = 0.2, l2: float = 2.0, least_rows: int = 10, bins: int = 64) -> Trees:
    """Logistic loss, second-order gains over quantile bins.

    ``monotone`` has -1, 0 or 1 by feature: a split on a constrained feature must order its
    children's values, whose midpoint then bounds all values below either child; so the sum of
    trees is monotone in that feature."""
    n, width = x.shape if x.ndim == 2 else (0, len(monotone))
    inner, leaves = 2 ** depth - 1, 2 ** depth
    mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if n else 1 - 1e-3
    base = float(np.log(mean / (1 - mean)))
    if not n or y.min() == y.max():  # nothing to tell apart
        return Trees(base, depth, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1)
    margin = np.full(n, base)
    out_f, out_t, out_v = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        low, high = np.full(inner + leaves, -np.inf), np.full(inner + leaves, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2 ** level - 1, 2 ** level
            at = node - first
            gain, where = np.full(count, 1e-6), np.zeros((count, 2), np.int64)
            mid = np.zeros(count)
            for j in range(width):
                if not len(edges[j]):
                    continue
                m = len(edges[j]) + 1
                cell = at * m + binned[:, j]
                sums = [np.bincount(cell, w, minlength=count * m).reshape(count, m).cumsum(1)
                        for w in (g, h, np.ones(n))]
                (gl, hl, cl), (ga, ha, ca) = [s[:, :-1] for s in sums], [s[:, -1:] for s in sums]
                lo, hi = low[first:first + count, None], high[first:first + count, None]
                left = np.clip(gl / (hl + l2), lo, hi)
                right = np.clip((ga - gl) / (ha - hl + l2), lo, hi)
                stay = np.clip(ga / (ha + l2), lo, hi)
                worth = lambda v, gs, hs: 2 * v * gs - v * v * (hs + l2)
                better = worth(left, gl, hl) + worth(right, ga - gl, ha - hl) - worth(stay, ga, ha)
                fine = (cl >= least_rows) & (ca - cl >= least_rows) & (monotone[j] * (right - left) >= 0)
                better = np.where(fine, better, 0)
                k = better.argmax(1)
                take = better[np.arange(count), k] > gain
                gain[take] = better[np.arange(count), k][take]
                where[take] = np.stack([np.full(count, j), k], 1)[take]
                mid[take] = ((left + right) / 2)[np.arange(count), k][take]
            for c in np.flatnonzero(gain > 1e-6):
                j, k = where[c]
                feature[first + c], threshold[first + c] = j, edges[j][k]
            for c in range(count):
                p_, (a, b) = first + c, (2 * (first + c) + 1, 2 * (first + c) + 2)
                low[a] = low[b] = low[p_]
                high[a] = high[b] = high[p_]
                sign = monotone[feature[p_]] if np.isfinite(threshold[p_]) else 0
                if sign > 0:
                    high[a] = low[b] = mid[c]
                elif sign < 0:
                    low[a] = high[b] = mid[c]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        leaf = node - inner
        value = np.bincount(leaf, g, minlength=leaves) / (np.bincount(leaf, h, minlength=leaves) + l2)
        value = rate * np.clip(value, low[inner:], high[inner:])
        margin += value[leaf]
        out_f.append(feature)
        out_t.append(threshold)
        out_v.append(value)
    return Trees(base, depth, np.array(out_f), np.array(out_t), np.array(out_v))
