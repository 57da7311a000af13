"""Lines, areas and points near outlines against a comparison of every pair."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkscout.functions import geo
from linkscout.operators import rank, shapes

BUFFER = 0.0004
CORNER = T.StructType([T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())])
PATHS = T.ArrayType(T.ArrayType(CORNER))
LICENCES = T.StructType([
    T.StructField("licence", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("lon", T.DoubleType()),
    T.StructField("lat", T.DoubleType()), T.StructField("paths", PATHS),
])
OUTLINES = T.StructType([T.StructField("buildingid", T.LongType()), T.StructField("ring", T.ArrayType(CORNER))])


def closed(path):
    return list(zip(path, path[1:] + path[:1]))


def gap(p, a, b):
    dx, dy = b[0] - a[0], b[1] - a[1]
    t = min(1, max(0, ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / (dx * dx + dy * dy))) if dx or dy else 0
    return math.hypot(p[0] - a[0] - t * dx, p[1] - a[1] - t * dy)


def turn(a, b, p):
    return (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])


def crossing(a, b, c, d):
    return turn(a, b, c) * turn(a, b, d) < 0 and turn(c, d, a) * turn(c, d, b) < 0


def inside(p, edges):
    odd = False
    for a, b in edges:
        if (a[1] > p[1]) != (b[1] > p[1]) and p[0] < a[0] + (p[1] - a[1]) * (b[0] - a[0]) / (b[1] - a[1]):
            odd = not odd
    return odd


def meets(ring, kind, paths):
    own = closed(ring)
    if kind == "line":
        edges = [e for p in paths for e in (zip(p, p[1:]) if len(p) > 1 else [(p[0], p[0])])]
    else:
        edges = [e for p in paths for e in closed(p)]
    for a, b in edges:
        if inside(a, own) or any(
            crossing(a, b, c, d) or min(gap(a, c, d), gap(b, c, d), gap(c, a, b), gap(d, a, b)) <= BUFFER for c, d in own
        ):
            return True
    return kind == "area" and inside(ring[0], edges)


def polygon(draw, x, y, r, n):
    """A star-shaped polygon, often not convex."""
    turns = sorted(draw.uniform(0, 2 * math.pi) for _ in range(n))
    return [(x + draw.uniform(0.4, 1) * r * math.cos(t), y + draw.uniform(0.4, 1) * r * math.sin(t)) for t in turns]


def world(seed, lat):
    draw = random.Random(seed)
    outlines = {i: polygon(draw, draw.uniform(9.9, 10.1), lat + draw.uniform(-0.1, 0.1), draw.uniform(1e-4, 3e-3), draw.randrange(3, 8)) for i in range(150)}
    licences = []
    for i in range(120):
        x, y, r = draw.uniform(9.9, 10.1), lat + draw.uniform(-0.1, 0.1), 10 ** draw.uniform(-4, -1)
        if i % 3 == 0:
            paths = [[(draw.uniform(x - r, x + r), draw.uniform(y - r, y + r)) for _ in range(draw.randrange(1, 6))] for _ in range(draw.randrange(1, 4))]
            licences.append(("line", paths))
        else:
            paths = [polygon(draw, x, y, r, draw.randrange(3, 9))]
            if i % 2:
                paths.append(polygon(draw, x, y, r * 0.35, 5))
            if i % 5 == 0:
                paths.append(polygon(draw, x + 2.5 * r, y, r, 5))
            if i % 7 == 0:
                paths[0].append(paths[0][0])
            licences.append(("area", paths))
    # Larger than MOST_ACROSS cells of the finer levels, with a hole; and a line across everything.
    licences += [("area", [polygon(draw, 10, lat, 0.9, 12), polygon(draw, 10, lat, 0.05, 7)]), ("line", [[(8.0, lat - 0.3), (12.0, lat + 0.31)]])]
    licences += [licences[5], licences[6], licences[6]]
    return outlines, licences


def frames(spark, outlines, licences):
    rows = [(i, kind, None, None, paths) for i, (kind, paths) in enumerate(licences)]
    own = spark.createDataFrame([(i, ring) for i, ring in outlines.items()], OUTLINES)
    return own, spark.createDataFrame(rows, LICENCES).repartition(3)


@pytest.mark.parametrize("lat", [0.01, 47.3, -71.0])
def test_against_every_pair(spark, lat):
    outlines, licences = world(int(lat), lat)
    own, shaped = frames(spark, outlines, licences)
    found = {r.buildingid: r.n for r in rank.licence_counts(own, shaped, BUFFER).collect()}
    want = Counter(i for i, ring in outlines.items() for kind, paths in licences if meets(ring, kind, paths))
    assert found == dict(want) and len(want) > 100 and sum(want.values()) >= 200
    assert shapes.grouped(shaped.select("kind", "paths"))[1] in ([0, 2], [0, 1, 2])


def test_points_lines_and_areas_together(spark):
    outlines, licences = world(3, 40.0)
    own, shaped = frames(spark, outlines, licences)
    draw = random.Random(1)
    spots = [(draw.uniform(9.9, 10.1), 40 + draw.uniform(-0.1, 0.1)) for _ in range(3000)]
    points = spark.createDataFrame([(i, draw.choice(["point", None]), x, y, None) for i, (x, y) in enumerate(spots)], LICENCES)
    found = {r.buildingid: r.n for r in rank.licence_counts(own, shaped.union(points), BUFFER).collect()}
    alone = Counter({r.buildingid: r.n for r in rank.licence_counts(own, shaped, BUFFER).collect()})
    old = Counter({r.buildingid: r.n for r in rank.licence_counts(own, points.select("lon", "lat"), BUFFER).collect()})
    near = Counter(i for i, ring in outlines.items() for p in spots if inside(p, closed(ring)) or any(gap(p, a, b) <= BUFFER for a, b in closed(ring)))
    assert old == near and found == dict(alone + near)


def test_bad_shapes(spark):
    ring = [(0.0, 0.0), (0.01, 0.0), (0.01, 0.01)]
    bad = float("nan")
    rows = [
        (1, "line", None, None, [[(bad, 0.0), (0.005, 0.001)]]), (2, "area", None, None, [[]]), (3, "line", None, None, None),
        (4, "area", None, None, [[(0.005, 0.002)]]), (5, "line", None, None, [[(0.005, 0.002)], [(9.0, 9.0)]]),
    ]
    own = spark.createDataFrame([(1, ring), (2, None), (3, [])], OUTLINES)
    found = rank.licence_counts(own, spark.createDataFrame(rows, LICENCES), BUFFER).collect()
    assert [(r.buildingid, r.n) for r in found] == [(1, 2)]
    odd = spark.createDataFrame([(1, "circle", None, None, [ring])], LICENCES)
    with pytest.raises(Exception, match="no shape of kind circle"):
        rank.licence_counts(own, odd, BUFFER).collect()
    assert rank.licence_counts(own, odd.limit(0), BUFFER).count() == 0


def test_pieces_share_their_corners(spark):
    frame = spark.createDataFrame([(1, "line", 2, 0.1, 0.2, 0.7, -0.13)], "shape long, kind string, level int, ax double, ay double, bx double, by double")
    rows = shapes.pieces(frame, 2).select("px", "py", "qx", "qy").distinct().orderBy("px").collect()
    assert len(rows) == math.ceil(0.6 / (0.25 / 110)) and (rows[0].px, rows[-1].qx, rows[-1].qy) == (0.1, 0.7, -0.13)
    assert all((a.qx, a.qy) == (b.px, b.py) for a, b in zip(rows, rows[1:]))


def test_segment_near_ring(spark):
    draw, rows = random.Random(4), []
    for i in range(400):
        ring = polygon(draw, 0, 0, 1, 6)
        a, b = [(draw.uniform(-2, 2), draw.uniform(-2, 2)) for _ in range(2)]
        rows.append((i, ring, *a, *(a if i % 9 == 0 else b)))
    schema = T.StructType([*OUTLINES, *[T.StructField(c, T.DoubleType()) for c in ("ax", "ay", "bx", "by")]])
    df = spark.createDataFrame(rows, schema).select("buildingid", geo.segment_near_ring("ax", "ay", "bx", "by", "ring", BUFFER).alias("hit"))
    found = {r.buildingid: r.hit for r in df.collect()}
    assert all(found[i] == meets(ring, "line", [[(ax, ay), (bx, by)]]) for i, ring, ax, ay, bx, by in rows)
    assert 50 < sum(found.values()) < 350


def test_discs_decide_as_the_edges_do(spark):
    """Points in the inner disc are near, those beyond the outer one are not, and few of a grown box are left for the edges."""
    draw = random.Random(5)
    rings = [[(draw.uniform(-2, 2), draw.uniform(-1, 1)) for _ in range(draw.choice((1, 2, 3, 4, 7)))] for _ in range(60)]
    rings += [[(0.0, -h), (w, 0.0), (0.0, h), (-w, 0.0)] for w in (0.5, 1.0) for h in (0.5, 1.0)]
    rows = [(i, [{"lon": -73.9 + x / 5000, "lat": 40.7 + y / 5000} for x, y in ring]) for i, ring in enumerate(rings)]
    boxes = shapes.grown_boxes(spark.createDataFrame(rows, "buildingid long, ring array<struct<lon:double,lat:double>>"), BUFFER)
    spots = spark.range(-12, 13).selectExpr("id / 12.3D as u").crossJoin(spark.range(-12, 13).selectExpr("id / 12.7D as v"))
    pairs = boxes.crossJoin(spots).selectExpr("*", "mid_lon + u * (east - mid_lon) as x", "mid_lat + v * (north - mid_lat) as y")
    pairs = pairs.withColumn("near", geo.point_near_ring("x", "y", "ring", BUFFER)).selectExpr(
        "buildingid", "near", "in_sq", "out_sq", "(x - mid_lon) * (x - mid_lon) + (y - mid_lat) * (y - mid_lat) as gap"
    ).collect()
    assert all(p.near for p in pairs if p.gap <= p.in_sq) and not any(p.near for p in pairs if p.gap > p.out_sq)
    assert any(p.in_sq < 0 for p in pairs)
    between = [p.in_sq < p.gap <= p.out_sq for p in pairs if p.buildingid >= 60]
    assert sum(between) < len(between) / 3


def test_crowded_cell_is_split(spark, monkeypatch):
    """A third of all lines in one cell: the join splits it and gives the same counts."""
    from linkscout.operators import skew

    outlines, licences = world(8, 10.0)
    draw = random.Random(2)
    licences += [("line", [[(10 + draw.uniform(0, 1e-3), 10 + draw.uniform(0, 1e-3)) for _ in range(2)]]) for _ in range(300)]
    outlines[999] = [(10.0, 10.0), (10.001, 10.0), (10.001, 10.001)]
    own, shaped = frames(spark, outlines, licences)
    plain = sorted(map(tuple, rank.licence_counts(own, shaped, BUFFER).collect()))
    monkeypatch.setattr(shapes, "skewed_join", lambda *a, **k: skew.skewed_join(*a, rows_per_task=50, **k))
    assert sorted(map(tuple, rank.licence_counts(own, shaped, BUFFER).collect())) == plain


def test_areas_without_an_edge_nearby_are_counted_per_cell(spark, monkeypatch):
    """Outlines that fit a cell form no pair with the areas that hold them: only the number of areas per cell is joined."""
    def formed(*_):
        raise AssertionError("pairs of outlines that fit a cell")

    draw = random.Random(5)
    spots = [(5 + draw.uniform(0, 0.004), 50 + draw.uniform(0, 0.004)) for _ in range(60)]
    outlines = {i: [(x, y), (x + 1e-4, y), (x, y + 1e-4)] for i, (x, y) in enumerate(spots)}
    # A hole around some of them, and a shape whose second path alone lies inside an outline.
    wide = [("area", [[(4 - i / 100, 49.0), (6.0, 49.0), (6.0, 51.0), (4.0, 51.0)], [(5.001, 50.001), (5.003, 50.001), (5.003, 50.003), (5.001, 50.003)]]) for i in range(40)]
    wide += [("line", [[(9.0, 9.0), (9.1, 9.0)], [(spots[7][0] + 2e-5, spots[7][1] + 2e-5)] * 2])]
    own, shaped = frames(spark, outlines, wide)
    monkeypatch.setattr(shapes, "_inside", formed)
    found = {r.buildingid: r.n for r in rank.licence_counts(own, shaped, 1e-6).collect()}
    monkeypatch.setitem(globals(), "BUFFER", 1e-6)
    want = Counter(i for i, ring in outlines.items() for kind, paths in wide if meets(ring, kind, paths))
    assert found == dict(want) and 40 in want.values() and 7 in want and len(want) < 60


def test_outlines_of_many_cells_and_without_id(spark):
    """An outline without an id counts like any other, and so does one that fits no cell."""
    far = [(5.001, 50.0), (5.0011, 50.0), (5.001, 50.0001)]
    rows = [(3, far), (None, far), (4, [(5.0, 50.0), (5.2, 50.0), (5.2, 50.2), (5.0, 50.2)])]
    licences = [("area", [[(4.9, 49.9), (5.1, 49.9), (5.1, 50.1), (4.9, 50.1)]]), ("line", [[(5.00105, 49.9), (5.00105, 50.1)]]), ("line", [[(5.1, 50.1), (5.11, 50.1)]])]
    _, shaped = frames(spark, {}, licences)
    found = {r.buildingid: r.n for r in rank.licence_counts(spark.createDataFrame(rows, OUTLINES), shaped, 1e-6).collect()}
    assert found == {3: 2, None: 2, 4: 3}
