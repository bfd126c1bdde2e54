"""Simplification, rings and overlay against figures with known results."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.operators import overlay, simplify
from tessera.operators.multipolygon import build
from tessera.operators.rings import assemble

S = 1000
A, B, C, D = (0, 0), (S, 0), (S, S), (0, S)
E, G = (2 * S, 0), (2 * S, S)


def square(x, y, s):
    return [(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)]


def areas(ways):
    return [(r.area, [h.area for h in r.holes], sorted(r.ways)) for r in build(ways)[0]]


@pytest.mark.parametrize(
    "ways",
    [
        [(1, [A, B, C, D, A])],
        [(1, [A, B, C]), (2, [C, D, A])],
        [(1, [A, B, C]), (2, [A, D, C])],
        [(1, [C, D]), (2, [A, B]), (3, [D, A]), (4, [B, C])],
    ],
)
def test_one_square(ways):
    assert areas(ways) == [(S * S, [], sorted(w for w, _ in ways))]


def test_order_of_members_does_not_change_the_ring():
    ways = [(1, [C, D]), (2, [A, B]), (3, [D, A]), (4, [B, C])]
    for seed in range(10):
        random.Random(seed).shuffle(ways)
        assert areas(ways) == [(S * S, [], [1, 2, 3, 4])]


def test_hole_and_island():
    assert areas([(1, square(0, 0, 1000)), (2, square(200, 200, 500))]) == [(10**6, [250000], [1])]
    assert areas([(1, square(0, 0, 1000)), (2, square(200, 200, 500)), (3, square(300, 300, 250))]) == [(10**6, [250000], [1]), (62500, [], [3])]


def test_gaps():
    assert areas([(1, [A, B, C, D, (0, 50)])]) == [(S * S, [], [1])]
    found, warnings = build([(1, [A, B]), (2, [C, D])])
    assert not found and "open ends" in warnings[0]
    assert assemble([(1, [A, B, C, D, (0, 50)])], close_gaps=False)[0] == []


def test_touching_rings():
    assert areas([(1, square(0, 0, S)), (2, [B, E, G, C, B])]) == [(2 * S * S, [], [1, 2])]
    assert areas([(1, square(0, 0, S)), (2, square(0, 0, 500))]) == [(750000, [], [1, 2])]
    found, warnings = build([(1, square(0, 0, S)), (2, square(0, 0, S)[::-1])])
    assert [(r.area, sorted(r.ways)) for r in found] == [(S * S, [1, 2])] and "identical" in warnings[0]


def test_members_that_do_not_count():
    assert areas([(1, square(0, 0, S)), (1, square(0, 0, S)), (2, [])]) == [(S * S, [], [1])]
    assert areas([(1, [A, B, A])]) == []


def test_bow_tie_keeps_one_lobe():
    (ring,) = overlay.healed([(0, 0), (10, 10), (10, 0), (0, 10), (0, 0)])
    assert set(ring) == {(5, 5), (10, 10), (10, 0)}


def star(rnd, cx, cy):
    angles = sorted(rnd.random() * 2 * math.pi for _ in range(9))
    points = [(cx + round(40 * rnd.random() * math.cos(t)), cy + round(40 * rnd.random() * math.sin(t))) for t in angles]
    return [*points, points[0]]


def test_areas_add_up():
    rnd, seen = random.Random(4), 0
    for _ in range(120):
        a, b = overlay.healed(star(rnd, 0, 0)), overlay.healed(star(rnd, 15, 10))
        if len(a) == len(b) == 1:
            a, b = overlay.counter_clockwise(a[0]), overlay.counter_clockwise(b[0])
            rest = sum(map(overlay.signed_area, overlay.difference(b, a)))
            assert sum(map(overlay.signed_area, overlay.union(a, b))) == overlay.signed_area(a) + rest
            seen += 1
    assert seen > 20


def test_relations():
    rel = overlay.Relation(square(0, 0, 10), square(2, 2, 3))
    assert rel.contains and not rel.shared_edge and not rel.equal
    rel = overlay.Relation(square(0, 0, 10), square(10, 0, 10))
    assert rel.shared_edge and not rel.both
    rel = overlay.Relation(square(0, 0, 10), square(10, 10, 10))
    assert not rel.shared_edge and not rel.both
    assert overlay.Relation(square(0, 0, 10), square(0, 0, 10)).equal
    assert overlay.Relation(square(0, 0, 10), square(5, 5, 10)).overlap


@pytest.mark.parametrize("tolerance,n", [(5, 2), (4, 3)])
def test_simplify_is_strict(tolerance, n):
    assert len(simplify.simplified(np.array([(0, 0), (50, 4), (100, 0)]), tolerance)) == n


@settings(deadline=None, max_examples=60)
@given(st.lists(st.tuples(st.integers(0, 1000), st.integers(0, 1000)), min_size=2, max_size=40), st.integers(1, 200))
def test_simplified_lines_stay_near_and_settle(points, tolerance):
    line = np.array(points)
    kept = simplify.kept_points(line.astype(float), tolerance)
    assert kept[0] == 0 and kept[-1] == len(line) - 1
    for a, b in zip(kept, kept[1:], strict=False):
        if b - a > 1:
            assert simplify._far(line.astype(float), a, b)[1] < tolerance**2
    again = simplify.simplified(line, tolerance)
    assert (simplify.simplified(again, tolerance) == again).all()


def test_overlays_of_long_rings_end():
    import time

    def wave(n, shift):
        points = [(round(1e6 * (1 + 0.2 * math.sin(40 * t)) * math.cos(t)) + shift, round(1e6 * (1 + 0.2 * math.sin(40 * t)) * math.sin(t))) for t in (2 * math.pi * k / n for k in range(n))]
        return [*points, points[0]]

    began = time.monotonic()
    a, b = wave(20_000, 0), wave(20_000, 300_001)
    whole = sum(map(overlay.signed_area, overlay.union(a, b)))
    assert whole == overlay.signed_area(a) + sum(map(overlay.signed_area, overlay.difference(b, a)))
    assert time.monotonic() - began < 120


def test_gaps_close_nearest_first():
    from itertools import combinations

    from tessera.operators.rings import Nearest

    rnd = random.Random(2)
    for _ in range(40):
        places = {(rnd.randint(-50, 50), rnd.randint(-50, 50)) for _ in range(rnd.randint(1, 30))}
        near = Nearest(places)
        while len(places) > 1:
            want = min((math.hypot(p[0] - q[0], p[1] - q[1]), p, q) for p, q in combinations(sorted(places), 2))
            assert near.best() == want
            for p in want[1:]:
                near.drop(p)
                places.discard(p)
        assert near.best() is None


def test_simplified_rings_do_not_cross():
    rnd = random.Random(8)
    for _ in range(40):
        n = 60
        ring = [(round((500 + 300 * rnd.random()) * math.cos(2 * math.pi * k / n)), round((500 + 300 * rnd.random()) * math.sin(2 * math.pi * k / n))) for k in range(n)]
        ring = np.array([*ring, ring[0]])
        if simplify._crossings(ring):
            continue
        out = simplify.simplified_ring(ring, 150)
        assert not simplify._crossings(out) and len(out) >= 4 and (out[0] == out[-1]).all()


def test_pyramid_is_cumulative_and_ends_below_a_pixel():
    side = 20_000
    ring = np.array([(0, 0), (side, 0), (side, side), (side // 2, side + 10), (0, side), (0, 0)])
    levels = simplify.pyramid([ring], True, [5, 9, 10, 24])
    assert [z for z, _ in levels] == [24, 10]
    assert len(levels[0][1][0]) == 6 and len(levels[1][1][0]) < 6
    assert simplify.pyramid([ring], True, [24], lod=False)[0][1][0] is ring
