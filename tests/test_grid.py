"""The grid joins give what comparing everything with everything gives."""

import math
import random

import pytest
from pyspark.sql import functions as F

from linkscout.functions import geo
from linkscout.operators import grid, skew


def lambert_m(lon1, lat1, lon2, lat2):
    f = geo.FLATTENING
    b1, b2 = (math.atan((1 - f) * math.tan(math.radians(v))) for v in (lat1, lat2))
    p, q, dl = (b1 + b2) / 2, (b2 - b1) / 2, math.radians(lon2 - lon1)
    s = 2 * math.asin(min(1, math.sqrt(math.sin(q) ** 2 + math.cos(b1) * math.cos(b2) * math.sin(dl / 2) ** 2)))
    if s == 0:
        return 0.0
    x = (s - math.sin(s)) * (math.sin(p) * math.cos(q) / math.cos(s / 2)) ** 2
    y = (s + math.sin(s)) * (math.cos(p) * math.sin(q) / math.sin(s / 2)) ** 2
    return geo.SEMI_MAJOR_M * (s - f / 2 * (x + y))


def world(rng, centre, spread, n_sources, n_points, limit=7):
    lon0, lat0 = centre

    def place():
        lon = lon0 + rng.uniform(-spread, spread) / math.cos(math.radians(lat0))
        return ((lon + 180) % 360) - 180, max(-89.99, min(89.99, lat0 + rng.uniform(-spread, spread)))

    sources = [(f"s{i}", "k", *place(), rng.choice([0.05, 0.4, 2.0, 5.0, 11.0]), limit) for i in range(n_sources)]
    points = [("k", f"p{i:05d}", *place()) for i in range(n_points)]
    # A third of all points at one place, next to the first source.
    lon, lat = sources[0][2] + 0.0004, sources[0][3]
    points[: n_points // 3] = [("k", f"p{i:05d}", lon, lat) for i in range(n_points // 3)]
    return sources, points


def frames(spark, sources, points):
    s = spark.createDataFrame(sources, "site_id string, kind string, lon double, lat double, radius_km double, top int")
    return s, spark.createDataFrame(points, "kind string, id string, lon double, lat double")


def expected_pairs(sources, points):
    return {
        (s[0], p[1]) for s in sources for p in points if lambert_m(s[2], s[3], p[2], p[3]) < s[4] * 1000
    }


def expected_nearest(sources, points):
    out = set()
    for s in sources:
        near = []
        for p in points:
            m = lambert_m(s[2], s[3], p[2], p[3])
            if m < s[4] * 1000:
                near.append((math.floor(m / 10 + 0.5) / 100, p[1]))
        out |= {(s[0], i, km) for km, i in sorted(near)[: s[5]]}
    return out


CENTRES = [(-74.0, 40.7), (179.995, -17.0), (10.0, 0.0), (25.0, 78.0)]


@pytest.mark.parametrize("centre", CENTRES)
def test_radius_join_is_brute_force(spark, centre):
    sources, points = world(random.Random(5), centre, 0.08, 12, 300)
    s, p = frames(spark, sources, points)
    found = grid.radius_join(s.drop("kind"), p.drop("kind"))
    assert {(r.site_id, r.id) for r in found.select("site_id", "id").collect()} == expected_pairs(sources, points)
    assert found.count() == len(expected_pairs(sources, points))


@pytest.mark.parametrize("centre", CENTRES)
@pytest.mark.parametrize("shuffled", [True, False])
def test_nearest_is_brute_force(spark, monkeypatch, centre, shuffled):
    if shuffled:
        monkeypatch.setattr(grid, "BROADCAST_ROWS", 0)
    sources, points = world(random.Random(9), centre, 0.06, 10, 600)
    s, p = frames(spark, sources, points)
    found = grid.nearest_within(s, p, ["id"])
    assert {(r.site_id, r.id, r.cand_dist_km) for r in found.collect()} == expected_nearest(sources, points)


def polar_world(rng, sign, n_sources, n_points, widest):
    """Places around a pole, on all meridians, among them the pole itself."""
    def place():
        r = widest * math.sqrt(rng.random())
        return rng.uniform(-180, 180), sign * (90 - r)

    sources = [(f"s{i}", "k", *place(), rng.choice([0.05, 0.4, 2.0, 5.0, 11.0]), 7) for i in range(n_sources)]
    sources += [("pole", "k", 12.0, sign * 90.0, 5.0, 7), ("line", "k", 180.0, sign * 89.0, 11.0, 7), ("west", "k", -180.0, sign * 89.0, 11.0, 7)]
    points = [("k", f"p{i:05d}", *place()) for i in range(n_points)]
    # Some close to a source, on the other side of the pole or of the antimeridian as well.
    for i, s in enumerate(sources):
        points += [("k", f"q{i}{j}", (s[2] + rng.uniform(-1, 1) + 180) % 360 - 180, s[3] - sign * rng.uniform(0, 3e-4)) for j in range(5)]
    return sources, points + [("k", "top", -100.0, sign * 90.0), ("k", "over", -168.0, sign * 89.98)]


@pytest.mark.parametrize("sign", [1, -1])
@pytest.mark.parametrize("widest", [0.12, 0.7, 1.3])
def test_poles(spark, sign, widest):
    sources, points = polar_world(random.Random(int(widest * 10) + sign), sign, 25, 500, widest)
    s, p = frames(spark, sources, points)
    found = grid.radius_join(s.drop("kind"), p.drop("kind"))
    want = expected_pairs(sources, points)
    assert {(r.site_id, r.id) for r in found.select("site_id", "id").collect()} == want and found.count() == len(want) > 50
    assert {(r.site_id, r.id, r.cand_dist_km) for r in grid.nearest_within(s, p, ["id"]).collect()} == expected_nearest(sources, points)


def test_cells_at_the_poles_are_few(spark):
    rows = [(f"{lat}/{km}", 33.0, sign * lat, km) for lat in (88.9, 89.2, 89.5, 89.9, 89.99, 89.9999, 90.0) for km in (0.005, 0.04, 0.15, 0.6, 2.5, 11.0) for sign in (1, -1)]
    frame = spark.createDataFrame(rows, "site_id string, lon double, lat double, radius_km double")
    cells = grid.cover(frame, "lon", "lat", "radius_km").groupBy("site_id", "lat").count().collect()
    assert max(r["count"] for r in cells) <= 100 and len(cells) == len(rows)


def test_nearest_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(grid, "BROADCAST_ROWS", 0)
    sources, points = world(random.Random(3), (-74.0, 40.7), 0.05, 8, 400)
    s, p = frames(spark, sources, points)
    found = grid.nearest_within(s, p, ["id"])
    assert {(r.site_id, r.id, r.cand_dist_km) for r in found.collect()} == expected_nearest(sources, points)


def test_reach_limits_pairs(spark):
    """With many points around, a source joins a small multiple of its limit and not everything in its radius."""
    rng = random.Random(1)
    sources = [("s", "k", -74.0, 40.7, 11.0, 5)]
    points = [("k", f"p{i}", -74.0 + rng.uniform(-0.05, 0.05), 40.7 + rng.uniform(-0.05, 0.05)) for i in range(4000)]
    s, p = frames(spark, sources, points)
    reach = grid.search_reach(s, grid.cell_counts(p), "radius_km", "top").first().reach_km
    kth = sorted(lambert_m(-74.0, 40.7, q[2], q[3]) for q in points)[4] / 1000
    assert kth <= reach < 1.5


def test_no_all_pairs_join(spark):
    sources, points = world(random.Random(2), (-74.0, 40.7), 0.05, 4, 50)
    s, p = frames(spark, sources, points)
    plan = grid.radius_join(s.drop("kind"), p.drop("kind"))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_skewed_join(spark):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40).cast("int").alias("k"),
        F.col("id").alias("l"),
    )
    right = spark.range(60).select((F.col("id") % 30).cast("int").alias("k"), F.col("id").alias("r"))
    for how in ("inner", "left"):
        plain = left.join(right, "k", how)
        salted = skew.skewed_join(left, right, ["k"], how, rows_per_task=100)
        assert sorted(salted.select("k", "l", "r").collect(), key=str) == sorted(plain.select("k", "l", "r").collect(), key=str)
    # Salts follow the counted rows of either side.
    many = right.union(right).where("k = 9").crossJoin(spark.range(50)).select("k", "r")
    counts = [skew.key_counts(df, ["k"]) for df in (left, many, right)]
    hot = skew.hot_keys((counts[0], counts[1]), ["k"], 100)
    assert {r.k: (r._a, r._b) for r in hot.collect()} == {7: (11, 1), 9: (1, 2)}
    assert skew.hot_keys((counts[0], counts[2]), ["k"], 2000) is None
    # Without a hot key nothing is split, and rows without a key still do not meet.
    plain = skew.skewed_join(left, right, ["k"], rows_per_task=5000)
    assert "explode" not in plain._jdf.queryExecution().optimizedPlan().toString().lower()
    loose = skew.skewed_join(left, right, ["k"], "left", rows_per_task=5000)
    assert sorted(loose.select("k", "l", "r").collect(), key=str) == sorted(left.join(right, "k", "left").select("k", "l", "r").collect(), key=str)


def test_bad_corners_have_no_cells(spark):
    rows = [(1, -74.0, 40.7, -73.999, 40.701), (2, float("nan"), 40.7, -73.9, 40.8), (3, -74.0, 40.7, -73.9, float("inf")), (4, None, 40.7, -73.9, 40.8)]
    df = spark.createDataFrame(rows, "id int, w double, s double, e double, n double")
    cells = grid.box_cells(df, "w", "s", "e", "n", 2)
    assert {r.id for r in cells.collect()} == {1} and cells.count() <= 9


def test_cells_of_all_levels_are_compiled(spark, capsys):
    """A generated method of more than 8,000 bytes is interpreted, which takes many times as long; the cells are the same."""
    import re

    from pyspark.sql import functions as F

    from linkscout.operators import grid

    points = spark.range(500).selectExpr("'a' as kind", "cast(id * 37 % 361 - 180 as double) as lon", "id * 0.361 - 90 as lat").localCheckpoint()
    want = points.select("kind", F.explode(grid.cells_of("lon", "lat")).alias("cell")).groupBy("cell").count()
    found = grid.cell_counts(points)
    assert sorted((r.cell, r.n) for r in found.collect()) == sorted(map(tuple, want.collect()))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        grid.cell_counts(points).explain("codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


def test_points_get_only_cells_of_used_levels(spark, monkeypatch):
    """A search looks at one or two levels: in the shuffled join a point has no rows at others, and no count is taken again."""
    rng = random.Random(5)
    sources, points = world(rng, (-74.0, 40.7), 0.02, 30, 2000)
    s, p = frames(spark, sources, points)
    seen = {}

    def join(left, right, keys, **known):
        seen.update(rows=left.count(), columns=left.columns, **known)
        return skew.skewed_join(left, right, keys, **known)

    monkeypatch.setattr(grid, "BROADCAST_ROWS", 5)
    monkeypatch.setattr(grid, "skewed_join", join)
    found = grid.nearest_within(s, p, ["id"])
    got = {(r.site_id, r.id, r.cand_dist_km) for r in found.collect()}
    assert got == expected_nearest(sources, points)
    kept = grid.trim_copies(p, [F.col("id").asc()], 7).count()
    assert seen["rows"] <= 4 * kept and "p_sin" not in seen["columns"]
    known = {(r.kind, r.cell): r._n for r in seen["left_counts"].collect()}
    assert sum(known.values()) == seen["rows"] and seen["right_counts"] is not None
