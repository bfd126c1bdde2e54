"""Rings from the ways of a relation: joined end to end, closed over small gaps, flattened.

A segment is a chain of ways. Ends meet by coordinate, not by id, and in the order of members, so
the result depends on that order only.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field
from heapq import heapify, heappop, heappush
from math import hypot

#: Gaps are closed up to the diagonal of all ways by this.
GAP_PART = 10
#: A closed ring's points at least, its first and last the same.
LEAST_POINTS = 4

Place = tuple[int, int]


@dataclass
class Segment:
    """Positions in order and the ways that they come from (none for a closed gap)."""

    points: list[Place]
    ways: list[int] = field(default_factory=list)

    @property
    def start(self) -> Place:
        return self.points[0]

    @property
    def end(self) -> Place:
        return self.points[-1]

    def joined(self, other: Segment) -> Segment:
        """Both end to end, either turned around where that is needed."""
        mine, theirs = self.points, other.points
        if mine[-1] == theirs[0]:
            points = mine + theirs[1:]
        elif mine[-1] == theirs[-1]:
            points = mine + theirs[-2::-1]
        elif mine[0] == theirs[-1]:
            points = theirs + mine[1:]
        elif mine[0] == theirs[0]:
            points = theirs[::-1] + mine[1:]
        else:
            raise ValueError("segments that do not meet")
        return Segment(points, self.ways + other.ways)


class Chains:
    """Open chains by the places where they end, and the rings that have closed."""

    def __init__(self) -> None:
        self.closed: list[Segment] = []
        self.ends: dict[Place, Segment] = {}

    def take(self, place: Place) -> Segment | None:
        """The chain that ends at a place, no longer open."""
        chain = self.ends.pop(place, None)
        if chain is not None:
            self.ends.pop(chain.end if place == chain.start else chain.start, None)
        return chain

    def put(self, chain: Segment) -> None:
        """Joins what meets the chain's start, else its end, until neither meets anything or it closes."""
        while chain.start != chain.end:
            met = self.take(chain.start) or self.take(chain.end)
            if met is None:
                self.ends |= {chain.start: chain, chain.end: chain}
                return
            chain = chain.joined(met)
        self.closed.append(chain)

    def bridge(self, p: Place, q: Place) -> None:
        """Joins the chains that end at two places, or the two ends of one."""
        first = self.take(p)
        chain = first.joined(Segment([p, q]))
        self.put(chain)


class Nearest:
    """The closest two of some places again and again, while places go."""

    def __init__(self, places) -> None:
        self.left = set(places)
        rows = [p[0] for p in self.left], [p[1] for p in self.left]
        self.low = tuple(min(r, default=0) for r in rows)
        size = max((max(r, default=0) - min(r, default=0) for r in rows), default=0)
        #: Cells hold a place each, about.
        self.side = max(1, size / max(1, len(self.left)) ** 0.5)
        self.reach = int(size / self.side) + 2
        self.cells: dict[Place, set[Place]] = defaultdict(set)
        for p in self.left:
            self.cells[self._cell(p)].add(p)
        self.heap = [x for p in self.left if (x := self._of(p))]
        heapify(self.heap)

    def _cell(self, p: Place) -> Place:
        return int((p[0] - self.low[0]) / self.side), int((p[1] - self.low[1]) / self.side)

    def _of(self, p: Place) -> tuple[float, Place, Place] | None:
        """(distance, the two places in order) of a place and the one closest to it, cells around it first."""
        x, y = self._cell(p)
        best = None
        for r in range(self.reach + 1):
            if best and best[0] < (r - 1) * self.side:
                break
            ring = [(x + i, y + j) for i in range(-r, r + 1) for j in ((-r, r) if abs(i) < r else range(-r, r + 1))]
            for cell in ring if len(ring) < len(self.cells) else self.cells:
                for q in self.cells.get(cell, ()):
                    if q != p:
                        found = (hypot(p[0] - q[0], p[1] - q[1]), min(p, q), max(p, q))
                        best = min(best, found) if best else found
            if len(ring) >= len(self.cells):
                break
        return best

    def drop(self, p: Place) -> None:
        self.left.discard(p)
        self.cells[self._cell(p)].discard(p)

    def best(self) -> tuple[float, Place, Place] | None:
        """The closest two; of equals, the least places."""
        while self.heap:
            d, p, q = self.heap[0]
            if p in self.left and q in self.left:
                return d, p, q
            heappop(self.heap)
            for one in (p, q):
                if one in self.left and (again := self._of(one)):
                    heappush(self.heap, again)
        return None


def bridge_gaps(chains: Chains, most: float) -> None:
    """Joins the closest ends again and again while they are no further than `most` apart."""
    near = Nearest(chains.ends)
    while (best := near.best()) and best[0] <= most:
        chains.bridge(best[1], best[2])
        near.drop(best[1])
        near.drop(best[2])


def diagonal(ways: list[list[Place]]) -> float:
    """Diagonal of the bounds of all positions."""
    flat = [p for w in ways for p in w]
    if not flat:
        return 0.0
    return hypot(max(p[0] for p in flat) - min(p[0] for p in flat), max(p[1] for p in flat) - min(p[1] for p in flat))


def assemble(ways: list[tuple[int, list[Place]]], close_gaps: bool = True) -> tuple[list[Segment], list[Place]]:
    """(rings, open ends left) of (way id, positions) in member order.

    Of ways that repeat, the first counts; ways without a position are skipped; rings of fewer than
    LEAST_POINTS points are dropped.
    """
    out, seen = Chains(), set()
    for way_id, points in ways:
        if way_id in seen or not points:
            continue
        seen.add(way_id)
        out.put(Segment(list(points), [way_id]))
    if close_gaps and out.ends:
        bridge_gaps(out, diagonal([p for w, p in ways if w in seen]) / GAP_PART)
    rings = [Segment(_distinct(s.points), s.ways) for s in out.closed]
    return [r for r in rings if len(r.points) >= LEAST_POINTS], sorted(out.ends)


def _distinct(points: list[Place]) -> list[Place]:
    """Without positions that repeat the one before."""
    return [p for k, p in enumerate(points) if not k or p != points[k - 1]]
