"""An M-tree over integer vectors, for the largest inner products.

A vector x of squared length at most `top` is lifted by one more component,
sqrt(top - x.x), and a query by 0. Then the squared Euclidean distance of query and
vector is q.q + top - 2 q.x, so the nearest vectors are those of largest inner
product, and the triangle inequality holds for bounds. Scores themselves are exact
integer products; bounds carry a small slack, so a tie is never cut off.

A node is a page of at most `PAGE` entries. Each entry has its distance to the
node's routing vector; entries of inner nodes also have a covering radius.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np

PAGE = 256
SLACK = 1e-6


@dataclass
class Node:
    """Entries are vectors (`children` empty) or routing vectors of child pages; `points` are their components."""

    entries: np.ndarray
    points: np.ndarray
    parent_distance: np.ndarray
    radius: np.ndarray
    children: list[Node] = field(default_factory=list)


def lifted_distance(x: np.ndarray, y: np.ndarray, top: float) -> np.ndarray:
    """Distances of all lifted rows of x to all lifted rows of y."""
    x, y = x.astype(np.float64), y.astype(np.float64)
    xx, yy = (x * x).sum(axis=1), (y * y).sum(axis=1)
    more = np.sqrt(np.maximum(top - xx, 0))[:, None] * np.sqrt(np.maximum(top - yy, 0))[None, :]
    # The lifted squared lengths are `top` for both.
    return np.sqrt(np.maximum(2 * top - 2 * (x @ y.T + more), 0))


class MTree:
    def __init__(self, vectors: np.ndarray, top: float):
        self.vectors, self.top, self.computed = vectors, top, 0
        n = len(vectors)
        # Products of whole numbers are exact in floating point up to 2**53.
        self.largest = float(np.abs(vectors).max()) if vectors.size else 0.0
        self.root = self._page(np.arange(n), 0) if n else None

    def _page(self, rows: np.ndarray, routing: int) -> Node:
        """The page for `rows`, under the routing vector `routing`."""
        base = self.vectors[[routing]]
        if len(rows) <= PAGE:
            to = lifted_distance(self.vectors[rows], base, self.top)[:, 0]
            return Node(rows, self.vectors[rows].astype(np.float64), to, np.zeros(len(rows)))
        groups = min(PAGE, -(-len(rows) // PAGE))
        pivots = rows[np.linspace(0, len(rows) - 1, groups).astype(np.int64)]
        apart = lifted_distance(self.vectors[rows], self.vectors[pivots], self.top)
        near = apart.argmin(axis=1)
        if (near == near[0]).all():  # pivots that don't tell the rows apart: cut them evenly
            near = np.arange(len(rows)) * groups // len(rows)
        children, kept, radius = [], [], []
        for g in range(groups):
            own = near == g
            if own.any():
                children.append(self._page(rows[own], int(pivots[g])))
                kept.append(pivots[g])
                radius.append(apart[own, g].max())
        entries = np.array(kept)
        to = lifted_distance(self.vectors[entries], base, self.top)[:, 0]
        return Node(entries, self.vectors[entries].astype(np.float64), to, np.array(radius), children)

    def search(self, query: np.ndarray, k: int, least: int | None = None) -> list[tuple[int, int]]:
        """(score, row) of rows that may be among the k best; all rows tied with the k-th are given.

        `least` is a score known to be reached by k rows elsewhere.
        """
        if self.root is None:
            return []
        real = query.astype(np.float64)
        qq = float((real**2).sum())
        exact = float(np.abs(real).sum()) * self.largest < 2.0**53
        scores: list[int] = []  # the k best so far, a heap
        found: list[tuple[int, int]] = []

        def limit() -> float:
            low = scores[0] if len(scores) == k else None
            low = least if low is None else low if least is None else max(low, least)
            if low is None:
                return np.inf
            far = max(qq + self.top - 2.0 * low, 0.0)
            return float(np.sqrt(far)) * (1 + SLACK) + SLACK

        def distance(node: Node, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            self.computed += len(near)
            if not exact:
                products = self.vectors[node.entries[near]] @ query
            else:
                products = (node.points if len(near) == len(node.points) else node.points[near]) @ real
            return products, np.sqrt(np.maximum(qq + self.top - 2.0 * products, 0.0))

        start = np.sqrt(max(qq + self.top - 2.0 * float(self.vectors[0].astype(np.float64) @ real), 0.0))
        heap: list[tuple[float, int, Node, float]] = [(0.0, 0, self.root, float(start))]
        pushed = 0
        while heap:
            bound, _, node, to_parent = heapq.heappop(heap)
            most = limit()
            if bound > most:
                break
            near = np.flatnonzero(np.abs(to_parent - node.parent_distance) - node.radius <= most)
            if not len(near):
                continue
            products, away = distance(node, near)
            if node.children:
                lower = np.maximum(away - node.radius[near], bound)
                for i in np.flatnonzero(lower <= most).tolist():
                    pushed += 1
                    heapq.heappush(heap, (float(lower[i]), pushed, node.children[int(near[i])], float(away[i])))
                continue
            good = away <= most
            if len(products) > k:  # of a page only its k best and their ties can matter
                good &= products >= np.partition(products, -k)[-k]
            for i in np.flatnonzero(good).tolist():
                score = int(products[i])
                found.append((score, int(node.entries[near[i]])))
                if len(scores) < k:
                    heapq.heappush(scores, score)
                elif score > scores[0]:
                    heapq.heapreplace(scores, score)
        low = scores[0] if len(scores) == k else None
        return [f for f in found if low is None or f[0] >= low]
