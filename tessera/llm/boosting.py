"""Gradient-boosted trees of fixed depth for a binary label, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Boosted:
    """Trees in heap order: node k has children 2k+1 (value <= cut) and 2k+2."""

    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray
    leaf: np.ndarray  # trees x leaves
    bias: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        depth = int(np.log2(self.leaf.shape[1]))
        rows = np.arange(len(x))
        for f, c, v in zip(self.feature, self.cut, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, f[at]] > c[at])
            out += v[at - (len(v) - 1)]
        return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.25, lam: float = 1.0, least: float = 2.0) -> Boosted:
    """Second-order boosting over binned features; a node without a gain sends all rows left."""
    n, k = x.shape
    cuts = [np.unique(np.quantile(c, np.linspace(0.01, 0.99, 33))) for c in x.T]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    wide = max(len(c) for c in cuts) + 1
    flat = binned + np.arange(k) * wide
    past = np.stack([np.arange(wide) >= len(c) for c in cuts])
    p0 = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    bias = float(np.log(p0 / (1 - p0)))
    score = np.full(n, bias)
    inner = 2**depth - 1
    fs, cs, vs = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1))
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        groups = {0: np.arange(n)}

        def sums(rows):
            at = flat[rows].ravel()
            return tuple(np.bincount(at, np.repeat(v[rows], k), k * wide).reshape(k, wide) for v in (g, h))

        hist = {0: sums(groups[0])}  # of g and h by bin; a node's is its parent's less its sibling's
        for node in range(inner):
            rows = groups.pop(node)
            right, (sg, sh) = rows[:0], hist.pop(node)
            if len(rows):
                gs, hs = np.cumsum(sg, axis=1), np.cumsum(sh, axis=1)
                tg, th = gs[0, -1], hs[0, -1]
                gain = gs**2 / (hs + lam) + (tg - gs) ** 2 / (th - hs + lam) - tg**2 / (th + lam)
                gain[(hs < least * 0.1) | (th - hs < least * 0.1)] = 0
                gain[past] = 0
                j, b = divmod(int(np.argmax(gain)), wide)
                if gain[j, b] > 1e-6:
                    fs[t, node], cs[t, node] = j, cuts[j][b]
                    above = binned[rows, j] > b
                    rows, right = rows[~above], rows[above]
            groups[2 * node + 1], groups[2 * node + 2] = rows, right
            if 2 * node + 1 < inner:
                few = sums(min(rows, right, key=len))
                many = tuple(x - y for x, y in zip((sg, sh), few))
                hist[2 * node + 1], hist[2 * node + 2] = (few, many) if len(rows) <= len(right) else (many, few)
        for leaf in range(inner + 1):
            rows = groups[inner + leaf]
            if len(rows):
                vs[t, leaf] = -rate * g[rows].sum() / (h[rows].sum() + lam)
                score[rows] += vs[t, leaf]
    return Boosted(fs, cs, vs, bias)
