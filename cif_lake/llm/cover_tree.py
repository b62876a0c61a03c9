"""A cover tree over norm-augmented vectors, for exact searches by inner product.

Vectors of whole numbers get one more coordinate that brings all of them to the length of the longest, ``radius``. On that sphere a
larger inner product with a query is a smaller angle. A node covers the vectors within an angle of its centre; the children of a node
cover theirs at half its distance or less, and their centres are further apart than that. So a query whose angle to a centre is phi
meets the node's vectors at angles from phi - cover to phi + cover only, which bounds their inner products from both sides.

Nodes are kept level by level in flat arrays; the vectors lie in the order of the leaves, so each node is a stretch of rows.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

#: Rows that are not split further, and the share by which bounds are widened for rounding.
LEAF, SLACK = 24, 1e-9


@dataclass
class Tree:
    """``vectors`` and ``ids`` by leaf order; nodes with their centre's row, covering angle, rows and children."""

    vectors: np.ndarray
    ids: np.ndarray
    radius: float
    centre: np.ndarray
    cover: np.ndarray
    rows: np.ndarray
    children: np.ndarray


def build(vectors: np.ndarray, ids: np.ndarray) -> Tree:
    """The tree of some thousand rows at most; rows come by id, so equal sets give equal trees."""
    order = np.lexsort(ids[None, :])
    vectors, ids = np.asarray(vectors, np.int64)[order], np.asarray(ids, np.int64)[order]
    real = vectors.astype(np.float64)
    squares = (real * real).sum(axis=1)
    radius = float(np.sqrt(squares.max(initial=0.0)))
    points = np.column_stack([real, np.sqrt(np.maximum(0, radius * radius - squares))])
    scaled = points / radius if radius else points
    centre, cover, children, out = [], [], [], []

    apart = np.arccos(np.clip(scaled @ scaled.T, -1, 1)) if radius else np.zeros((len(ids), len(ids)))

    # A level of the tree at a time: (centre, members, their angles to it).
    first = np.arange(len(ids))
    level = [(0, first, apart[0])] if len(ids) else []
    spans: list[tuple[int, np.ndarray]] = []
    while level:
        below = []
        for at, members, far in level:
            node, widest = len(centre), float(far.max(initial=0.0))
            centre.append(at)
            cover.append(widest)
            children.append([0, 0])
            spans.append((node, members))
            if len(members) <= LEAF or widest <= 1e-7:
                continue
            # The centre is a child of itself; others open where no child covers them yet.
            left, parts = members, []
            pivot, pivot_far = at, far
            while True:
                inside = pivot_far <= widest / 2
                parts.append((pivot, left[inside], pivot_far[inside]))
                left = left[~inside]
                if not len(left):
                    break
                pivot = int(left[0])
                pivot_far = apart[pivot, left]
                pivot_far[0] = 0.0
            children[node] = [len(below), len(parts)]
            below += parts
        # Children of this level get their numbers behind all of its nodes.
        start = len(centre)
        for node, _ in spans[-len(level) :]:
            if children[node][1]:
                children[node][0] += start
        level = below
    # Rows in the order of the leaves, found from the root down.
    rows = [[0, 0] for _ in centre]
    stack = [0] if centre else []
    while stack:
        node = stack.pop()
        start, n = children[node]
        if n:
            stack += range(start + n - 1, start - 1, -1)
        else:
            rows[node] = [len(out), len(out) + len(spans[node][1])]
            out += spans[node][1].tolist()
    for node in range(len(centre) - 1, -1, -1):
        start, n = children[node]
        if n:
            rows[node] = [min(rows[c][0] for c in range(start, start + n)), max(rows[c][1] for c in range(start, start + n))]
    leaves = np.array(out, np.int64)
    place = np.empty(len(out), np.int64)
    place[leaves] = np.arange(len(out))
    return Tree(
        vectors[leaves], ids[leaves], radius, place[np.array(centre, np.int64)], np.array(cover, np.float64),
        np.array(rows, np.int64).reshape(-1, 2), np.array(children, np.int64).reshape(-1, 2),
    )


class Window:
    """The best ``k`` rows whose scores lie from ``low`` to ``high``: highest first, ties by the smaller id."""

    def __init__(self, low: int | None, high: int | None, k: int):
        self.low, self.high, self.k = low, high, k
        self.best: list[tuple[int, int]] = []

    def open(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which of some nodes, by their bounds, may hold a row of the result."""
        out = np.ones(len(low), bool)
        if self.low is not None:
            out &= high >= self.low
        if self.high is not None:
            out &= low <= self.high
        if len(self.best) == self.k:
            out &= high >= -self.best[-1][0]
        return out

    def takes(self, low: float, high: float) -> bool:
        """As ``open``, for one node."""
        if (self.low is not None and high < self.low) or (self.high is not None and low > self.high):
            return False
        return len(self.best) < self.k or high >= -self.best[-1][0]

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fits = np.ones(len(scores), bool)
        if self.low is not None:
            fits &= scores >= self.low
        if self.high is not None:
            fits &= scores <= self.high
        if len(self.best) == self.k:
            fits &= scores >= -self.best[-1][0]
        at = np.flatnonzero(fits)
        if len(at) > 4 * self.k:
            at = at[np.lexsort((ids[at], -scores[at]))[: self.k]]
        if len(at):
            self.best = sorted(self.best + list(zip((-scores[at]).tolist(), ids[at].tolist())))[: self.k]


class Forest:
    """Several trees side by side, for searches in some or all of them."""

    def __init__(self, trees: list[Tree]):
        rows = np.cumsum([0, *(len(t.ids) for t in trees)])
        nodes = np.cumsum([0, *(len(t.centre) for t in trees)])
        whole = lambda parts, empty: np.concatenate(parts) if parts else empty
        none, pairs = np.zeros(0, np.int64), np.zeros((0, 2), np.int64)
        self.roots = np.array([n if len(t.ids) else -1 for n, t in zip(nodes, trees)], np.int64)
        self.ids = whole([t.ids for t in trees], none)
        self.centres = whole([t.vectors[t.centre].astype(np.float64) for t in trees], np.zeros((0, 0)))
        self.cover = whole([t.cover for t in trees], np.zeros(0))
        self.radius = whole([np.full(len(t.centre), t.radius) for t in trees], np.zeros(0))
        self.rows = whole([t.rows + r for r, t in zip(rows, trees)], pairs)
        self.children = whole([t.children + np.outer(t.children[:, 1] > 0, [n, 0]) for n, t in zip(nodes, trees)], pairs)
        vectors = whole([t.vectors for t in trees], np.zeros((0, 0), np.int64))
        # Sums of products that a double holds exactly go through BLAS; larger ones are added as 64-bit numbers.
        self.largest = int(np.abs(vectors).max(initial=0))
        self.real = self.largest**2 * max(1, vectors.shape[1]) < 1 << 52
        self.vectors = vectors.astype(np.float64) if self.real else vectors

    def _scores(self, at: np.ndarray, query: np.ndarray, exact: bool) -> np.ndarray:
        """Inner products of rows, in ascending order, with a query as whole numbers."""
        low, high = int(at[0]), int(at[-1]) + 1
        near = high - low <= 4 * len(at)
        some = self.vectors[low:high] if near else self.vectors[at]
        out = (some @ query.astype(np.float64)).astype(np.int64) if exact else (some.astype(np.int64) * query).sum(axis=1)
        return out[at - low] if near else out

    def search(self, query: np.ndarray, windows: list[Window], without: int | None = None, among: np.ndarray | None = None) -> int:
        """Fill the windows, best bound first; rows with the id ``without`` don't count. Gives the number of rows scored.

        ``among`` are the numbers of the trees to look in. Leaves are scored with the node above them.
        """
        real = query.astype(np.float64)
        length, scored = float(np.sqrt(real @ real)), 0
        exact = self.real and int(np.abs(query).max(initial=0)) * self.largest * max(1, len(query)) < 1 << 52
        heap: list[tuple[float, int, float]] = []

        def visit(nodes: slice | np.ndarray) -> None:
            nonlocal scored
            most = length * self.radius[nodes]
            angle = np.arccos(np.clip((self.centres[nodes] @ real) / np.where(most, most, 1.0), -1, 1))
            cover, wide = self.cover[nodes], SLACK * most + 1e-6
            low = most * np.cos(np.minimum(np.pi, angle + cover + 1e-7)) - wide
            high = most * np.cos(np.maximum(0, angle - cover - 1e-7)) + wide
            some = windows[0].open(low, high)
            for w in windows[1:]:
                some |= w.open(low, high)
            leaf = self.children[nodes, 1] == 0
            spans = self.rows[nodes][some & leaf]
            if len(spans):
                sizes = spans[:, 1] - spans[:, 0]
                at = np.repeat(spans[:, 0] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
                at.sort()
                scores, ids = self._scores(at, query, exact), self.ids[at]
                scored += len(at)
                if without is not None:
                    other = ids != without
                    scores, ids = scores[other], ids[other]
                for w in windows:
                    w.offer(scores, ids)
            first = nodes.start if isinstance(nodes, slice) else 0
            for k in np.flatnonzero(some & ~leaf).tolist():
                heapq.heappush(heap, (-float(high[k]), first + k if isinstance(nodes, slice) else int(nodes[k]), float(low[k])))

        roots = self.roots if among is None else self.roots[among]
        roots = roots[roots >= 0]
        if len(roots) and windows:
            visit(roots)
        while heap:
            high, node, low = heapq.heappop(heap)
            if any(w.takes(low, -high) for w in windows):
                start, n = self.children[node].tolist()
                visit(slice(start, start + n))
        return scored
