"""Count-vector R-tree over sets, packed by size.

A set's tokens are hashed into groups; the counts per group are its point.
The overlap of two sets is at most the sum of the coordinate minima of their
points, and for two rectangles at most that of their upper corners.  A node
pair whose bound is below the overlap the threshold asks for is cut off;
points that survive are verified on the tokens themselves.
"""

from __future__ import annotations

import numpy as np

from unilake.llm.textkit import U

#: Points in a leaf, and leaves in a branch.
FANOUT = 16


def count_points(flat: np.ndarray, off: np.ndarray, groups: int) -> np.ndarray:
    """One row of token counts per group for each set; ``groups`` is a power of two."""
    n = np.diff(off)
    group = ((flat * U(0x9E3779B97F4A7C15)) >> U(40)).astype(np.int64) % groups
    points = np.bincount(np.repeat(np.arange(len(n)), n) * groups + group,
                         minlength=len(n) * groups).reshape(-1, groups)
    return points.astype(np.int16 if points.max(initial=0) < 1 << 15 else np.int32)


def group_number(n: int) -> int:
    """Groups for sets of ``n`` tokens: about two tokens each, a power of two."""
    return int(min(2048, max(16, 1 << int(np.log2(max(n / 2, 1))))))


class CountTree:
    """Points (sets) in ascending size, with the rectangles' upper corners."""

    def __init__(self, n: np.ndarray, points: np.ndarray):
        self.n, self.points = n, points
        at = np.arange(0, len(n), FANOUT)
        self.leaf_top = np.maximum.reduceat(points, at, axis=0)
        self.leaf_low = n[at]
        high = np.arange(0, len(at), FANOUT)
        self.branch_top = np.maximum.reduceat(self.leaf_top, high, axis=0)
        self.branch_low = self.leaf_low[high]

    def candidates(self, point: np.ndarray, n: int, start: int) -> np.ndarray:
        """Rows from ``start`` on that the bounds leave over for a set of
        ``n`` tokens: 7 * overlap >= 3 * (n + m) and 4 * n >= 3 * m."""
        stop = int(np.searchsorted(self.n, 4 * n // 3, side="right"))
        if start >= stop:
            return np.zeros(0, np.int64)
        step = FANOUT * FANOUT
        b = np.arange(start // step, (stop - 1) // step + 1)
        if len(b) > 1:
            top = np.minimum(self.branch_top[b], point).sum(axis=1)
            b = b[7 * top >= 3 * (n + np.maximum(self.branch_low[b], 0))]
        leaf = (b[:, None] * FANOUT + np.arange(FANOUT)).reshape(-1)
        leaf = leaf[(leaf >= start // FANOUT) & (leaf <= (stop - 1) // FANOUT)]
        if len(leaf) > 1:
            top = np.minimum(self.leaf_top[leaf], point).sum(axis=1)
            leaf = leaf[7 * top >= 3 * (n + self.leaf_low[leaf])]
        row = (leaf[:, None] * FANOUT + np.arange(FANOUT)).reshape(-1)
        return row[(row >= start) & (row < stop)]

    def survivors(self, i: int, root: Roots, side: np.ndarray | None) -> np.ndarray:
        """Rows after ``i``, of another root (and side), that the bounds leave."""
        point, n = self.points[i], int(self.n[i])
        rows = self.candidates(point, n, i + 1)
        rows = rows[root.of(rows) != root.one(i)]
        if side is not None:
            rows = rows[side[rows] != side[i]]
        if not len(rows):
            return rows
        step = max(1, (1 << 20) // len(point))
        bound = np.concatenate([np.minimum(self.points[rows[k:k + step]], point).sum(axis=1)
                                for k in range(0, len(rows), step)])
        return rows[7 * bound >= 3 * (n + self.n[rows])]


def overlaps(own: np.ndarray, flat: np.ndarray, off: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact overlap of a sorted set with the sets of some rows."""
    lens = off[rows + 1] - off[rows]
    first = np.cumsum(lens) - lens
    tokens = flat[np.arange(int(lens.sum())) - np.repeat(first - off[rows], lens)]
    hit = own[np.minimum(np.searchsorted(own, tokens), len(own) - 1)] == tokens
    return np.add.reduceat(hit, first)


class Roots:
    """Union-find over rows; ``of`` gives current roots of an array of rows."""

    def __init__(self, root: np.ndarray):
        # rows that share a root at the start share their first row
        _, first, which = np.unique(root, return_index=True, return_inverse=True)
        self.up = first[which]

    def of(self, rows: np.ndarray) -> np.ndarray:
        at = self.up[rows]
        while True:
            nxt = self.up[at]
            if (nxt == at).all():
                self.up[rows] = at  # shorter ways from here on
                return at
            at = nxt

    def one(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return int(i)

    def join(self, i: int, j: int) -> bool:
        """Unite two rows' roots; whether they differed."""
        a, b = self.one(i), self.one(j)
        self.up[max(a, b)] = min(a, b)
        return a != b


def linked_roots(flat: np.ndarray, off: np.ndarray, root: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (row, row) of verified links that join different roots.

    Every pair of rows of different roots is decided: by a bound, by exact
    overlap, or because earlier links already joined their roots.  Sets are
    sorted arrays; rows ascend by size and none is empty.
    """
    n = np.diff(off)
    if len(n) < 2:
        return []
    tree = CountTree(n, count_points(flat, off, min(1024, group_number(int(n[-1])))))
    root, out = Roots(root), []
    for i in range(len(n) - 1):
        rows = tree.survivors(i, root, None)
        while len(rows):
            part, rows = rows[:64], rows[64:]
            both = overlaps(flat[off[i]:off[i + 1]], flat, off, part)
            for j in part[7 * both >= 3 * (n[i] + n[part])]:
                if root.join(i, int(j)):
                    out.append((i, int(j)))
            rows = rows[root.of(rows) != root.one(i)]
    return out


def surviving_pairs(n: np.ndarray, points: np.ndarray, root: np.ndarray, side: np.ndarray | None,
                    forest: bool) -> list[tuple[int, int]]:
    """Pairs of rows of different roots that the bounds leave to be verified;
    with ``forest`` only as many as connect what all of them connect."""
    tree, root, out = CountTree(n, points), Roots(root), []
    for i in range(len(n) - 1):
        for j in tree.survivors(i, root, side):
            if not forest:
                out.append((i, int(j)))
            elif root.join(i, int(j)):
                out.append((i, int(j)))
    return out
