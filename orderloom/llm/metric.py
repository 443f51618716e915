"""Exact Jaccard joins inside one region of moderate size, by pivots, Voronoi cells and triangle inequalities."""

from __future__ import annotations

import numpy as np

LEAF, PIVOTS, SHRINK = 48, 8, 0.7


class Region:
    """Sets of 64-bit values with an inverted index; `root` joins the sets that are linked."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent = percent
        self.size = np.array([len(s) for s in sets], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.size)])
        _, self.terms = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), self.size)
        order = np.argsort(self.terms, kind="stable")
        self.postings, self.frequency = owner[order], np.bincount(self.terms)
        self.heads = np.concatenate([[0], np.cumsum(self.frequency)])
        self.parent = list(range(len(sets)))
        self.seen: dict[int, np.ndarray] = {}

    def shared(self, x: int) -> np.ndarray:
        """Members that every set has in common with set x."""
        terms = self.terms[self.starts[x] : self.starts[x + 1]]
        count = self.frequency[terms]
        at = np.repeat(self.heads[terms] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        return np.bincount(self.postings[at], minlength=len(self.size))

    def meet(self, x: int) -> np.ndarray:
        """Distances of all sets from x; sets close enough are linked with it."""
        both = self.shared(x)
        union = self.size + self.size[x] - both
        for y in np.flatnonzero(100 * both >= self.percent * union):
            self.join(x, int(y))
        return 1 - both / np.maximum(union, 1)

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        self.parent[max(x, y)] = min(x, y)

    def density(self, members: np.ndarray) -> int:
        """The member whose elements the region shares most: the middle of a group of near copies."""
        mean = [self.frequency[self.terms[self.starts[x] : self.starts[x + 1]]].mean() for x in members]
        return int(members[int(np.argmax(mean))])

    def sweep(self, members: np.ndarray) -> None:
        """Link all pairs of members. Pairs inside the largest component so far are connected and need no look."""
        if len(members) < 2:
            return
        self.meet(self.density(members))
        roots = np.array([self.root(int(x)) for x in members])
        names, count = np.unique(roots, return_counts=True)
        core = names[count.argmax()] if count.max() > 1 else -1
        for x in members[roots != core]:
            self.meet(int(x))

    def divide(self, members: np.ndarray, radius: float) -> None:
        """Voronoi cells around pivots; a set near a border goes to every cell it may have partners in.

        If x lies in the cell of p, y in that of q and d(x, y) <= radius, then d(y, p) <= d(y, q) + 2 * radius. So each
        cell joined by itself, with such guests, finds every link.
        """
        if len(members) <= LEAF:
            self.sweep(members)
            return
        pivot, rows, nearest = self.density(members), [], np.full(len(members), np.inf)
        for _ in range(PIVOTS):
            rows.append(self.meet(pivot)[members])
            nearest = np.minimum(nearest, rows[-1])
            if nearest.max() <= radius:
                break
            pivot = int(members[int(nearest.argmax())])
        distance = np.array(rows)
        cells = [members[row <= nearest + 2 * radius] for row in distance]
        if max(len(c) for c in cells) > SHRINK * len(members):
            self.sweep(members)
            return
        for cell in cells:
            self.divide(cell, radius)


def linked(sets: list[np.ndarray], percent: int) -> list[int]:
    """For each set the first set of its component; sets link when 100 * intersection >= percent * union."""
    region = Region(sets, percent)
    region.divide(np.arange(len(sets)), 1 - percent / 100)
    return [region.root(x) for x in range(len(sets))]
