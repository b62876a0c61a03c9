"""Gradient-boosted trees with a logistic loss: histogram training on a bounded sample, scoring over flat numpy node arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """All trees as one set of node arrays; a leaf points to itself, so every row takes ``depth`` steps in every tree."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row of features."""
        node = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
        return self.base + self.value[node].sum(axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def train(
    x: np.ndarray, y: np.ndarray, monotone: np.ndarray | None = None, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64, smoothing: float = 5.0, least: int = 10
) -> Forest:
    """Fit ``trees`` trees. ``monotone`` has +1 or -1 for features whose effect may only rise or fall, else 0.

    A split on such a feature is taken only if its leaf values are in order; both sides then keep to their side of the middle, so no
    split further down breaks the order. No rows, or one class only, give a forest without trees.
    """
    x, y = np.asarray(x, float), np.asarray(y, float)
    mean = min(max(y.mean() if len(y) else 0.5, 1e-3), 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    nodes: list[list[float]] = []
    roots: list[int] = []
    if len(np.unique(y)) == 2:
        signs = np.zeros(x.shape[1], int) if monotone is None else np.asarray(monotone, int)
        cuts = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T]
        binned = np.stack([np.searchsorted(c, column, "left") for c, column in zip(cuts, x.T, strict=True)], 1)
        margin = np.full(len(y), base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            roots.append(_grow(nodes, binned, cuts, p - y, p * (1 - p), margin, signs, depth, rate, bins, smoothing, least))
    else:
        depth = 0
    table = np.array(nodes, float).reshape(-1, 5)
    feature, left, right = (table[:, k].astype(np.int64) for k in (0, 2, 3))
    return Forest(base, np.array(roots, np.int64), feature, table[:, 1], left, right, table[:, 4], depth)


def _grow(nodes, binned, cuts, gradient, weight, margin, signs, depth, rate, bins, smoothing, least) -> int:
    """Add one tree to the nodes and its values to the margin; gives its root."""

    def leaf(value: float) -> int:
        nodes.append([0, np.inf, len(nodes), len(nodes), value])
        return len(nodes) - 1

    def value_of(g, h, low, high):
        return np.clip(-g / (h + smoothing), low, high)

    def build(rows: np.ndarray, level: int, low: float, high: float) -> int:
        g, h = gradient[rows], weight[rows]
        total_g, total_h = g.sum(), h.sum()
        own = float(value_of(total_g, total_h, low, high))
        best = (1e-6, None)
        if level < depth and len(rows) >= 2 * least:
            for k, cut in enumerate(cuts):
                if not len(cut):
                    continue
                b = binned[rows, k]
                gl, hl, nl = (np.cumsum(np.bincount(b, w, bins))[: len(cut)] for w in (g, h, None))
                gr, hr = total_g - gl, total_h - hl
                vl, vr = value_of(gl, hl, low, high), value_of(gr, hr, low, high)
                # Loss that the two clipped values take away, beyond that of the node's own.
                gain = -(gl * vl + (hl + smoothing) * vl**2 / 2) - (gr * vr + (hr + smoothing) * vr**2 / 2) + total_g * own + (total_h + smoothing) * own**2 / 2
                allowed = (nl >= least) & (len(rows) - nl >= least) & (signs[k] * (vr - vl) >= 0)
                gain = np.where(allowed, gain, -np.inf)
                at = int(np.argmax(gain))
                if gain[at] > best[0]:
                    best = (float(gain[at]), (k, at, float(vl[at]), float(vr[at])))
        if best[1] is None:
            margin[rows] += rate * own
            return leaf(rate * own)
        k, at, vl, vr = best[1]
        middle = (vl + vr) / 2
        limits = ((low, high), (low, high)) if not signs[k] else ((low, middle), (middle, high)) if signs[k] > 0 else ((middle, high), (low, middle))
        below = binned[rows, k] <= at
        here = len(nodes)
        nodes.append([k, cuts[k][at], 0, 0, 0.0])
        nodes[here][2] = build(rows[below], level + 1, *limits[0])
        nodes[here][3] = build(rows[~below], level + 1, *limits[1])
        return here

    return build(np.arange(len(margin)), 0, -4.0, 4.0)


def isotonic(score: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: points ``(score, probability)`` of a rising calibration, for ``calibrated``."""
    score, y = np.asarray(score, float), np.asarray(y, float)
    weight = np.ones(len(y)) if weight is None else np.asarray(weight, float)
    # Equal scores are one point.
    score, group = np.unique(score, return_inverse=True)
    total, mass = np.bincount(group, y * weight, len(score)), np.bincount(group, weight, len(score))
    blocks: list[list[float]] = []
    for s, v, w in zip(score.tolist(), total.tolist(), mass.tolist(), strict=True):
        blocks.append([v, w, s, s])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + last[0], blocks[-1][1] + last[1], blocks[-1][2], last[3]]
    if not blocks:
        return np.array([0.0]), np.array([0.5])
    points = [(s, b[0] / b[1]) for b in blocks for s in dict.fromkeys((b[2], b[3]))]
    return np.array([p[0] for p in points]), np.array([p[1] for p in points])


def calibrated(points: tuple[np.ndarray, np.ndarray], score: np.ndarray) -> np.ndarray:
    return np.clip(np.interp(score, *points), 0.0, 1.0)
