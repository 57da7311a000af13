"""Terrain along paths against Vincenty's formula and a bilinear interpolation point by point."""

import math
import random

import pytest
from pyspark.sql import functions as F

from linkscout.operators import enrich, terrain

GRID = terrain.Grid(west=9.0, south=46.0, step=0.01, side=4)


def posts(draw, rows=range(-10, 60), cols=range(-10, 60), missing=()):
    return {(i, j): draw.uniform(0, 500) for i in rows for j in cols if (i, j) not in missing}


def frame(spark, held):
    return spark.createDataFrame([(i, j, e) for (i, j), e in held.items()], "row long, col long, elev double").repartition(4)


def bilinear(held, lon, lat):
    x, y = (lon - GRID.west) / GRID.step, (lat - GRID.south) / GRID.step
    j, i = math.floor(x), math.floor(y)
    u, v = x - j, y - i
    e = [held.get((i + a, j + b)) for a in (0, 1) for b in (0, 1)]
    return None if None in e else (1 - v) * ((1 - u) * e[0] + u * e[1]) + v * ((1 - u) * e[2] + u * e[3])


def paths(draw, n):
    return [(k, draw.uniform(9, 9.4), draw.uniform(46, 46.4), draw.uniform(9, 9.4), draw.uniform(46, 46.4)) for k in range(n)]


def geodesic_m(lon1, lat1, lon2, lat2):
    """Vincenty, iterated to the end."""
    a, f = 6378137.0, 1 / 298.257223563
    b, u1, u2, dl = a * (1 - f), math.atan((1 - f) * math.tan(math.radians(lat1))), math.atan((1 - f) * math.tan(math.radians(lat2))), math.radians(lon2 - lon1)
    lam = dl
    for _ in range(30):
        ss = math.hypot(math.cos(u2) * math.sin(lam), math.cos(u1) * math.sin(u2) - math.sin(u1) * math.cos(u2) * math.cos(lam))
        if not ss:
            return 0.0
        cs = math.sin(u1) * math.sin(u2) + math.cos(u1) * math.cos(u2) * math.cos(lam)
        sg = math.atan2(ss, cs)
        sa = math.cos(u1) * math.cos(u2) * math.sin(lam) / ss
        c2 = 1 - sa * sa
        cm = cs - 2 * math.sin(u1) * math.sin(u2) / c2 if c2 else 0
        c = f / 16 * c2 * (4 + f * (4 - 3 * c2))
        lam = dl + (1 - c) * f * sa * (sg + c * ss * (cm + c * cs * (2 * cm * cm - 1)))
    q = c2 * (a * a - b * b) / (b * b)
    big = 1 + q / 16384 * (4096 + q * (-768 + q * (320 - 175 * q)))
    small = q / 1024 * (256 + q * (-128 + q * (74 - 47 * q)))
    return b * big * (sg - small * ss * (cm + small / 4 * (cs * (2 * cm * cm - 1) - small / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3))))


def test_points_lie_on_the_geodesic_at_equal_distances(spark):
    draw = random.Random(1)
    rows = [(k, x, y, x + draw.uniform(-0.2, 0.2), y + draw.uniform(-0.1, 0.1)) for k in range(60) for x, y in [(draw.uniform(-180, 180), draw.uniform(-85, 85))]]
    rows.append((60, 5.0, 50.0, 5.0, 50.0))
    df = spark.createDataFrame(rows, "k int, x1 double, y1 double, x2 double, y2 double")
    for r in terrain.with_path_points(df, ("x1", "y1"), ("x2", "y2"), "points", 21).collect():
        total = geodesic_m(r.x1, r.y1, r.x2, r.y2)
        assert len(r.points) == 21 and geodesic_m(r.x1, r.y1, r.points[0].lon, r.points[0].lat) < 1e-3
        for i, p in enumerate(r.points):
            before, after = geodesic_m(r.x1, r.y1, p.lon, p.lat), geodesic_m(p.lon, p.lat, r.x2, r.y2)
            assert abs(before + after - total) < 1e-3 and abs(before - total * i / 20) < 0.01 + 1e-6 * total


@pytest.mark.parametrize("side", [1, 3, 4, 16])
def test_elevations_against_bilinear(spark, side):
    draw = random.Random(side)
    held = posts(draw, missing={(7, 9), (20, 20)})
    grid = terrain.Grid(GRID.west, GRID.south, GRID.step, side)
    df = spark.createDataFrame(paths(draw, 40) + [(99, 9.0, 46.0, 9.3, 46.3), (100, None, 46.0, 9.3, 46.3)], "k int, x1 double, y1 double, x2 double, y2 double")
    out = terrain.path_elevations(df, terrain.tiles(frame(spark, held), grid), grid, ["k"], ("x1", "y1"), ("x2", "y2"), 50)
    points = {r.k: r.points for r in terrain.with_path_points(df, ("x1", "y1"), ("x2", "y2"), "points", 50).collect()}
    found = {r.k: r.elevations for r in out.collect()}
    assert set(found) == set(range(40)) | {99}
    for k, got in found.items():
        want = [bilinear(held, p.lon, p.lat) for p in points[k]]
        assert len(got) == 50 and all((a is None) == (b is None) and (a is None or abs(a - b) < 1e-6) for a, b in zip(got, want))
    assert any(None in got for got in found.values())


def test_tiles_share_their_edges(spark):
    held = {(i, j): float(100 * i + j) for i in range(-8, 9) for j in range(-8, 9)}
    twice = frame(spark, held).unionByName(frame(spark, {(0, 0): -5.0}))
    out = {r.tile: r.elevations for r in terrain.tiles(twice, GRID).collect()}
    for ti in (-2, -1, 0, 1):
        for tj in (-2, -1, 0, 1):
            want = [held.get((ti * 4 + i, tj * 4 + j)) for i in range(5) for j in range(5)]
            got = out[ti * terrain.TILE_ROW + tj]
            assert [(-5.0 if w == 0.0 else w) for w in want] == got


def test_clearance(spark):
    draw = random.Random(7)
    held = posts(draw, missing={(i, 15) for i in range(10, 20)})
    df = spark.createDataFrame(paths(draw, 30), "k int, x1 double, y1 double, x2 double, y2 double")
    out = terrain.path_elevations(df, terrain.tiles(frame(spark, held), GRID), GRID, ["k"], ("x1", "y1"), ("x2", "y2"))
    rows = out.select("k", "elevations", terrain.path_clearance(F.col("elevations")).alias("c")).collect()
    for r in rows:
        e = r.elevations
        if None in e:
            assert r.c is None
            continue
        line = [e[0] + i * (e[-1] - e[0]) / 199 for i in range(200)]
        assert abs(r.c - min(a - b for a, b in zip(line, e))) < 1e-9
    assert 0 < sum(r.c is None for r in rows) < 30
    scored = {r.k: r.clearance_score for r in enrich.with_clearance(df.withColumn("height", F.lit(200.0)), out.select("k", terrain.path_clearance(F.col("elevations")).alias("clearance")), ["k"]).collect()}
    assert set(scored.values()) <= {"Pass", "Fail", "Delete", None} and len(set(scored.values())) >= 3


def test_bounds(spark):
    df = spark.createDataFrame(paths(random.Random(1), 1), "k int, x1 double, y1 double, x2 double, y2 double")
    for samples in (1, 201):
        with pytest.raises(ValueError):
            terrain.with_path_points(df, ("x1", "y1"), ("x2", "y2"), "points", samples)
    long = spark.range(201).select(F.lit(1).alias("p"), F.col("id").alias("sample_idx"), F.lit(1.0).alias("elev"))
    with pytest.raises(Exception, match="more than 200 samples"):
        enrich.elevation_arrays(long, ["p"]).collect()
    assert len(enrich.elevation_arrays(long.where("sample_idx < 200"), ["p"]).first().elevations) == 200


def test_samples_of_many_paths_over_one_tile(spark, monkeypatch):
    """All paths over few tiles: their samples are not brought together by tile, or else in small parts; the elevations are the same."""
    draw = random.Random(11)
    held = frame(spark, posts(draw))
    df = spark.createDataFrame(paths(draw, 60), "k int, x1 double, y1 double, x2 double, y2 double")

    def found():
        out = terrain.path_elevations(df, terrain.tiles(held, GRID), GRID, ["k"], ("x1", "y1"), ("x2", "y2"), 50)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        return plan, sorted((r.k, tuple(r.elevations)) for r in out.collect())

    plan, few = found()
    assert "_s#" not in plan and "broadcast" in plan
    monkeypatch.setattr(terrain, "BROADCAST_POSTS", 0)
    monkeypatch.setattr(terrain, "PARTS_PER_TASK", 5)
    plan, many = found()
    assert "_s#" in plan and many == few
