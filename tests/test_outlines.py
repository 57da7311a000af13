"""Validity and repair of outlines against exact areas of the even-odd rule and a comparison of all edges."""

import math
import random

import pytest
from test_shapes import CORNER, closed, crossing, polygon, turn
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkscout.operators import outlines

SCHEMA = T.StructType([T.StructField("i", T.LongType()), T.StructField("ring", T.ArrayType(CORNER))])


def judged(spark, *rings):
    df = outlines.with_validity(spark.createDataFrame(list(enumerate(rings)), SCHEMA), "ring", "why", "parts")
    out = {r.i: r for r in df.withColumn("text", outlines.parts_wkt(F.col("parts"))).collect()}
    return [out[i] for i in range(len(rings))]


def flat(parts):
    return [[[(p.lon, p.lat) for p in ring] for ring in polygon_] for polygon_ in parts]


def signed(ring):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:])) / 2


def even_odd_area(ring):
    """Area between the lines, strip by strip: strips end at every corner and every crossing."""
    edges = closed(ring)
    heights = {p[1] for p in ring}
    for k, (a, b) in enumerate(edges):
        for c, d in edges[k + 1 :]:
            if crossing(a, b, c, d):
                t = ((c[0] - a[0]) * (d[1] - c[1]) - (c[1] - a[1]) * (d[0] - c[0])) / ((b[0] - a[0]) * (d[1] - c[1]) - (b[1] - a[1]) * (d[0] - c[0]))
                heights.add(a[1] + t * (b[1] - a[1]))
    total, levels = 0.0, sorted(heights)
    for lo, hi in zip(levels, levels[1:]):
        spans = [(a, b) for a, b in edges if min(a[1], b[1]) <= lo and hi <= max(a[1], b[1]) and a[1] != b[1]]

        def at(e, y):
            return e[0][0] + (y - e[0][1]) * (e[1][0] - e[0][0]) / (e[1][1] - e[0][1])

        spans.sort(key=lambda e: at(e, (lo + hi) / 2))
        for e, g in zip(spans[::2], spans[1::2]):
            total += (at(g, lo) - at(e, lo) + at(g, hi) - at(e, hi)) / 2 * (hi - lo)
    return total


def valid(polygons):
    """Rings closed and simple, outer ones counter-clockwise, holes clockwise, and no two edges that cross."""
    edges = []
    for rings in polygons:
        for k, ring in enumerate(rings):
            assert ring[0] == ring[-1] and len(set(ring)) == len(ring) - 1 >= 3
            assert (signed(ring) > 0) == (k == 0)
            edges += list(zip(ring, ring[1:]))
    assert len({tuple(sorted(e)) for e in edges}) == len(edges)
    if len(edges) < 400:
        # Cut points are rounded: pieces of one line, or lines that meet, may seem to cross by a last bit.
        for k, (a, b) in enumerate(edges):
            for c, d in edges[k + 1 :]:
                assert not crossing(a, b, c, d) or min(map(abs, (turn(a, b, c), turn(a, b, d), turn(c, d, a), turn(c, d, b)))) < 1e-12


def test_known_outlines(spark):
    square = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]
    bow = [(0.0, 0.0), (1.0, 1.0), (1.0, 0.0), (0.0, 1.0)]
    spike = [(0.0, 0.0), (1.0, 0.0), (1.0, 0.5), (2.0, 0.5), (1.0, 0.5), (1.0, 1.0), (0.0, 1.0)]
    twice = [(0.0, 0.0), (3.0, 0.0), (3.0, 3.0), (0.0, 3.0), (0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]
    inner = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0), (1.0, 2.0), (2.0, 2.0), (2.0, 1.0)]
    line = [(0.0, 0.0), (1.0, 1.0), (0.0, 0.0)]
    flat_ = [(0.0, 0.0), (1.0, 1.0), (2.0, 2.0)]
    bad = [(0.0, 0.0), (float("nan"), 1.0), (1.0, 1.0)]
    out = judged(spark, square, bow, spike, twice, inner, line, flat_, bad, None, [], square[::-1] + [square[-1]], bow)
    why = [r.why for r in out]
    assert why[0] == "Valid Geometry" and out[0].text.startswith("POLYGON((0.000000000 0.000000000, 1.0")
    assert why[1] == "Self-intersection[0.500000000 0.500000000]" and flat(out[1].parts) == [
        [[(0.0, 0.0), (0.5, 0.5), (0.0, 1.0), (0.0, 0.0)]], [[(0.5, 0.5), (1.0, 0.0), (1.0, 1.0), (0.5, 0.5)]]]
    assert out[1].text.startswith("MULTIPOLYGON(((0.0") and out[11].text == out[1].text
    assert why[2].startswith("Self-intersection[") and [signed(p[0]) for p in flat(out[2].parts)] == [1.0]
    assert why[3].startswith("Self-intersection[") and sum(signed(r) for p in flat(out[3].parts) for r in p) == 5.0
    assert why[4].startswith("Self-intersection[") and [len(p) for p in flat(out[4].parts)] == [2]
    assert sum(signed(r) for r in flat(out[4].parts)[0]) == 16 - 2
    assert why[5] == "Too few points in geometry component[0.000000000 0.000000000]" and out[5].parts is None
    assert why[6].startswith("Self-intersection[") and out[6].parts == [] and out[6].text == "MULTIPOLYGON EMPTY"
    assert why[7] == "Invalid Coordinate" and out[7].parts is None and out[7].text is None
    assert out[8].why is None and out[8].parts is None and why[9] == "Too few points in geometry component"
    assert why[10] == "Valid Geometry" and signed(flat(out[10].parts)[0][0]) == 1.0


@pytest.mark.parametrize("n", [5, 9, 20, 60])
def test_areas_against_the_even_odd_rule(spark, n):
    draw, rings = random.Random(n), []
    for _ in range(25):
        rings.append([(draw.uniform(0, 1), draw.uniform(0, 1)) for _ in range(n)])
    # On a small lattice edges touch and overlap.
    rings += [[(float(draw.randrange(4)), float(draw.randrange(4))) for _ in range(min(n, 12))] for _ in range(25)]
    rings += [polygon(draw, 0, 0, 1, n) for _ in range(10)]
    seen = set()
    for ring, r in zip(rings, judged(spark, *rings)):
        if r.parts is None:
            assert "Too few" in r.why
            continue
        polygons = flat(r.parts)
        valid(polygons)
        assert math.isclose(sum(signed(x) for p in polygons for x in p), even_odd_area(ring), abs_tol=1e-9)
        seen.add(r.why.split("[")[0])
    assert "Self-intersection" in seen


def test_place_is_where_the_first_edges_meet(spark):
    draw = random.Random(11)
    rings = [[(draw.uniform(0, 1), draw.uniform(0, 1)) for _ in range(n)] for n in (8, 50, 100) for _ in range(5)]
    for ring, r in zip(rings, judged(spark, *rings)):
        edges = closed(ring)
        met = [(*e, *g) for k, e in enumerate(edges) for g in edges[k + 1 :] if crossing(*e, *g)]
        assert bool(met) == (r.why != "Valid Geometry")
        if not met:
            continue
        a, b, c, d = met[0]
        t = ((c[0] - a[0]) * (d[1] - c[1]) - (c[1] - a[1]) * (d[0] - c[0])) / ((b[0] - a[0]) * (d[1] - c[1]) - (b[1] - a[1]) * (d[0] - c[0]))
        x, y = map(float, r.why.split("[")[1][:-1].split())
        assert math.isclose(x, a[0] + t * (b[0] - a[0]), abs_tol=1e-8) and math.isclose(y, a[1] + t * (b[1] - a[1]), abs_tol=1e-8)


def test_ten_thousand_corners(spark):
    """Round, comb-shaped (all edges long one way) and crossed once; pairs stay near the number of corners."""
    n = 10_000
    draw = random.Random(5)
    turns = [2 * math.pi * k / n for k in range(n)]
    round_ = [((1 + 0.01 * draw.random()) * math.cos(t), (1 + 0.01 * draw.random()) * math.sin(t)) for t in turns]
    comb = [(k / n, 1.0 if k % 2 else 0.5) for k in range(n)] + [(1.0, 0.0), (0.0, 0.0)]
    crossed = list(round_)
    crossed[7000], crossed[7001] = crossed[7001], crossed[7000]
    out = judged(spark, round_, comb, crossed)
    exact = [signed(r + r[:1]) for r in (round_, comb)]
    assert [r.why == "Valid Geometry" for r in out] == [not outlines_cross(r) for r in (round_, comb, crossed)]
    assert abs(sum(signed(x) for p in flat(out[1].parts) for x in p)) == pytest.approx(abs(exact[1]))
    frame = spark.createDataFrame([(b"a", comb)], T.StructType([T.StructField("key", T.BinaryType()), T.StructField("_open", SCHEMA["ring"].dataType)]))
    assert outlines._edge_rows(frame).count() < 3 * n


def outlines_cross(ring):
    """Edges sorted by west end; each is compared with those that begin before it ends."""
    edges = sorted((min(a, b), max(a, b)) for a, b in closed(ring))
    for k, (a, b) in enumerate(edges):
        for c, d in edges[k + 1 :]:
            if c[0] > b[0]:
                break
            if crossing(a, b, c, d):
                return True
    return False
