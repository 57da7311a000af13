"""Insets that lose edges on the way: convex outlines against half planes, others against known results."""

import math
import random

import pytest
from pyspark.sql import types as T
from test_shapes import CORNER

from linkscout.functions import geo

SCHEMA = T.StructType([T.StructField("i", T.LongType()), T.StructField("ring", T.ArrayType(CORNER))])


def inset(spark, rings, distance):
    df = geo.with_clean_ring(spark.createDataFrame(list(enumerate(rings)), SCHEMA), "ring")
    out = {r.i: r.inset for r in geo.with_inset_ring(df, "ring", "inset", distance).collect()}
    return [None if out[i] is None else [(p.lon, p.lat) for p in out[i]] for i in range(len(rings))]


def half_planes(ring, distance):
    """A convex counter-clockwise ring cut by each of its edges, moved inwards."""
    left = [(-1e3, -1e3), (1e3, -1e3), (1e3, 1e3), (-1e3, 1e3)]
    for a, b in zip(ring, ring[1:] + ring[:1]):
        n = math.dist(a, b)
        nx, ny = -(b[1] - a[1]) / n, (b[0] - a[0]) / n

        def side(p):
            return (p[0] - a[0]) * nx + (p[1] - a[1]) * ny - distance

        cut = []
        for p, q in zip(left, left[1:] + left[:1]):
            if side(p) >= 0:
                cut.append(p)
            if (side(p) >= 0) != (side(q) >= 0):
                t = side(p) / (side(p) - side(q))
                cut.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
        left = cut
    return left


def alike(got, want, eps=1e-7):
    distinct = []
    for p in want:
        if all(math.dist(p, q) > eps for q in distinct):
            distinct.append(p)
    return all(min(math.dist(p, q) for q in distinct) < eps for p in got) and all(min(math.dist(p, q) for q in got) < eps for p in distinct)


def convex(draw, n):
    turns = sorted(draw.uniform(0, 2 * math.pi) for _ in range(n))
    a, b = draw.uniform(0.5, 2), draw.uniform(0.5, 2)
    return [(a * math.cos(t), b * math.sin(t)) for t in turns]


@pytest.mark.parametrize("distance", [0.02, 0.15, 0.4])
def test_convex_against_half_planes(spark, distance):
    draw = random.Random(int(distance * 100))
    rings = [convex(draw, draw.randrange(3, 14)) for _ in range(120)]
    lost = 0
    for ring, got in zip(rings, inset(spark, rings, distance)):
        want = half_planes(ring, distance)
        area = sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(want, want[1:] + want[:1])) / 2 if want else 0
        if got is None:
            assert area < 1e-6
        else:
            assert alike(got, want)
            lost += len(got) <= len(ring) - 2
    assert distance < 0.1 or lost > 10


def test_parts_thinner_than_twice_the_distance_go(spark):
    tab = [(0, 0), (10, 0), (10, 6), (5.5, 6), (5.5, 9), (5, 9), (5, 6), (0, 6)]
    # A thin arm with a bent end, which takes several edges to vanish.
    arm = [(0, 0), (10, 0), (10, 8), (9.2, 8), (9.2, 12), (8.9, 12.2), (8.6, 12), (8.6, 8), (0, 8)]
    corner = [(0, 0), (8, 0), (8, 0.9), (8.2, 1.1), (8.2, 1.2), (8, 1.4), (8, 6), (0, 6)]
    l_shape = [(0, 0), (10, 0), (10, 4), (4, 4), (4, 10), (0, 10)]
    rounded = [(0, 0), (10, 0), *[(9 + math.cos(t), 9 + math.sin(t)) for t in [k * math.pi / 40 for k in range(21)]], (0, 10)]
    thin = [(0, 0), (10, 0), (10, 1.5), (0, 1.5)]
    rings = [[(float(x), float(y)) for x, y in r] for r in (tab, arm, corner, l_shape, rounded, thin)]
    out = inset(spark, rings, 1.0)
    assert alike(out[0], [(1, 1), (9, 1), (9, 5), (1, 5)])
    assert alike(out[1], [(1, 1), (9, 1), (9, 7), (1, 7)])
    assert alike(out[2], [(1, 1), (7, 1), (7, 5), (1, 5)])
    assert alike(out[3], [(1, 1), (9, 1), (9, 3), (3, 3), (3, 9), (1, 9)])
    assert out[4] is not None and alike(out[4], half_planes(rings[4], 1.0), 1e-6)
    assert out[5] is None
