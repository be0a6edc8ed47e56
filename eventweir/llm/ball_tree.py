"""A ball tree over sparse vectors of non-negative numbers, searched best-first by inner product.

Rows are halved again and again between two far-apart rows, as a small sketch of them shows, down to
leaves of ``LEAF`` rows.  A node knows the centroid of its rows and the radius around it: a query's
inner product with any of them is at most that with the centroid plus the query's length times the
radius.  Bounds are computed in doubles and rounded up by more than their rounding error, so a subtree
is only passed over when no row of it can reach the score asked for.  Scores at leaves are exact sums
of whole numbers.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np

LEAF = 64
#: Numbers in the sketch of a row that the tree is built by.
SKETCH = 16
#: Columns of centroids and queries that are held as dense matrices at a time.
CHUNK = 4096
_UNIT = 2.0**-52
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _sketches(rows: np.ndarray, cols: np.ndarray, vals: np.ndarray, n: int) -> np.ndarray:
    """Each row's columns added up, with signs, in a few places that their numbers hash to."""
    mixed = (cols.astype(np.uint64) + np.uint64(1)) * _MIX
    place = (mixed >> np.uint64(48)).astype(np.int64) % SKETCH
    signed = np.where((mixed >> np.uint64(40)) & np.uint64(1), vals, -vals)
    return np.bincount(rows * SKETCH + place, signed, n * SKETCH).reshape(n, SKETCH)


def _halved(points: np.ndarray) -> np.ndarray:
    """The order that puts rows near one of two far-apart rows before those near the other."""

    def farthest(row: np.ndarray) -> np.ndarray:
        return points[np.square(points - row).sum(axis=1).argmax()]

    one = farthest(points.mean(axis=0))
    return np.argsort(points @ (farthest(one) - one), kind="stable")


class BallTree:
    """The tree over rows given as runs of columns and values between ``starts``.

    ``weights`` by column scale the space that balls are measured in: a row's coordinate is its value
    times the root of the column's weight, a query's is the root of its weight there.
    """

    def __init__(
        self, starts: np.ndarray, cols: np.ndarray, vals: np.ndarray, weights: np.ndarray
    ):
        n = len(starts) - 1
        sizes = np.diff(starts)
        roots = np.sqrt(weights)
        rows = np.repeat(np.arange(n), sizes)
        points = _sketches(rows, cols, vals * roots[cols], n)
        order = np.arange(n)
        #: First row, end, left child (the right one follows it; 0 at leaves), by node.
        self.low, self.high, self.child = [0], [n], [0]
        node = 0
        while node < len(self.low):
            low, high = self.low[node], self.high[node]
            if high - low > LEAF:
                own = order[low:high]
                order[low:high] = own[_halved(points[own])]
                middle = (low + high) // 2
                self.child[node] = len(self.low)
                self.low += [low, middle]
                self.high += [middle, high]
                self.child += [0, 0]
            node += 1
        #: The rows' numbers in the order of the leaves, and their content in this order.
        self.order = order
        take = np.repeat(starts[:-1][order] - np.r_[0, np.cumsum(sizes[order])[:-1]], sizes[order])
        take += np.arange(len(cols))
        self.starts = np.r_[0, np.cumsum(sizes[order])]
        self.cols, self.vals = cols[take], vals[take]
        self._weights, self._width = roots, len(weights)
        self._measure()

    def _chunks(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For some columns at a time: the first, the entries in them, the dense sums of each node."""
        nodes, coords = len(self.low), self.vals * self._weights[self.cols]
        leaves = [k for k in range(nodes) if not self.child[k]]
        leaf = np.empty(len(self.order), np.int64)
        for k in leaves:
            leaf[self.low[k] : self.high[k]] = k
        leaf = np.repeat(leaf, np.diff(self.starts))
        for first in range(0, self._width, CHUNK):
            width = min(CHUNK, self._width - first)
            if width == self._width:
                entries = np.arange(len(self.cols))
            else:
                entries = np.flatnonzero((self.cols >= first) & (self.cols < first + width))
            place = leaf[entries] * width + self.cols[entries] - first
            sums = np.bincount(place, coords[entries], nodes * width).reshape(nodes, width)
            for k in reversed(range(nodes)):
                if self.child[k]:
                    sums[k] = sums[self.child[k]] + sums[self.child[k] + 1]
            yield first, entries, sums

    def _measure(self) -> None:
        """The radius of each node, rounded up."""
        n, count = len(self.order), np.array(self.high) - np.array(self.low)
        coords = self.vals * self._weights[self.cols]
        row = np.repeat(np.arange(n), np.diff(self.starts))
        own = np.bincount(row, coords * coords, n)
        levels, level = [], [0]
        while level:
            levels.append(level)
            level = [c for k in level if self.child[k] for c in (self.child[k], self.child[k] + 1)]
        node_of = np.zeros((len(levels), n), np.int64)
        for depth, nodes in enumerate(levels):
            node_of[depth] = node_of[depth - 1]
            for k in nodes:
                node_of[depth, self.low[k] : self.high[k]] = k
        across, centre = np.zeros((len(levels), n)), np.zeros(len(count))
        for first, entries, sums in self._chunks():
            means = sums / count[:, None]
            centre += np.square(means).sum(axis=1)
            cols, rows = self.cols[entries] - first, row[entries]
            for depth in range(len(levels)):
                products = coords[entries] * means[node_of[depth, rows], cols]
                across[depth] += np.bincount(rows, products, n)
        # (x - c)^2 = x^2 - 2 x c + c^2, each term with its own rounding error
        error = _UNIT * (np.diff(self.starts).max(initial=0) + self._width + 64)
        self.radius = np.zeros(len(count))
        for depth, nodes in enumerate(levels):
            c = centre[node_of[depth]]
            far = own - 2 * across[depth] + c + error * (own + 2 * across[depth] + c)
            for k in nodes:
                most = far[self.low[k] : self.high[k]].max()
                self.radius[k] = np.sqrt(max(most, 0.0)) * (1 + 4 * _UNIT)

    def bounds(self, queries: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """By query and node, what no score of the node's rows exceeds; 0 only if all of them are 0.

        A query is its columns and their whole-number weights.
        """
        count = np.array(self.high) - np.array(self.low)
        dots = np.zeros((len(queries), len(count)))
        length = np.sqrt([float(w.sum()) for _, w in queries]) * (1 + 4 * _UNIT)
        for first, _, sums in self._chunks():
            width = sums.shape[1]
            dense = np.zeros((len(queries), width))
            for i, (cols, weights) in enumerate(queries):
                here = (cols >= first) & (cols < first + width)
                dense[i, cols[here] - first] = np.sqrt(weights[here])
            dots += dense @ (sums / count[:, None]).T
        error = 1 + _UNIT * (4 * self._width + len(self.order) + 64)
        return np.where(dots > 0, (dots * error + length[:, None] * self.radius) * error, 0.0)

    def scores(self, node: int, weights: np.ndarray) -> np.ndarray:
        """The exact scores of a leaf's rows, for a query's weights by column."""
        start, end = self.starts[self.low[node]], self.starts[self.high[node]]
        products = weights[self.cols[start:end]] * self.vals[start:end]
        return np.add.reduceat(products, self.starts[self.low[node] : self.high[node]] - start)

    def visit(
        self, bounds: np.ndarray, weights: np.ndarray, least: Callable[[], int]
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows and scores, leaf by leaf from the most promising on.

        ``least`` tells what a row has to reach by then; the search ends when no node left can.  A
        node's bound is never above its parent's.
        """
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < least():
                return
            child = self.child[node]
            if child:
                for k in (child, child + 1):
                    own = max(bound, -bounds[k])
                    if -own >= least():
                        heapq.heappush(heap, (own, k))
                continue
            yield self.order[self.low[node] : self.high[node]], self.scores(node, weights)
