import math
import re
import struct

import pytest
from pyspark.sql import functions as F

from linkscout.functions import geo


def rings(spark, *corner_lists):
    rows = [(i, [{"lon": x, "lat": y} for x, y in c]) for i, c in enumerate(corner_lists)]
    return spark.createDataFrame(rows, "i int, ring array<struct<lon:double,lat:double>>")


SQUARE = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]


def test_point_in_ring_counts_the_boundary(spark):
    df = rings(spark, SQUARE).crossJoin(
        spark.createDataFrame([(0.5, 0.5, True), (1.0, 0.5, True), (0.0, 0.0, True), (0.5, 1.0, True), (1.1, 0.5, False),
                               (-0.1, 0.0, False), (0.5, 1.0000001, False)], "x double, y double, inside boolean")
    )
    for r in df.select("inside", geo.point_in_ring("x", "y", "ring").alias("got")).collect():
        assert r.got == r.inside


def test_point_in_concave_ring(spark):
    u = [(0.0, 0.0), (3.0, 0.0), (3.0, 3.0), (2.0, 3.0), (2.0, 1.0), (1.0, 1.0), (1.0, 3.0), (0.0, 3.0)]
    df = rings(spark, u).selectExpr("ring", "1.5D as x", "2D as y", "0.5D as x2")
    row = df.select(geo.point_in_ring("x", "y", "ring").alias("notch"), geo.point_in_ring("x2", "y", "ring").alias("arm")).first()
    assert (row.notch, row.arm) == (False, True)


def test_near_ring(spark):
    df = rings(spark, SQUARE).selectExpr("ring", "1.1D as x", "0.5D as y", "1.08D as cx", "1.08D as cy")
    row = df.select(
        geo.point_near_ring("x", "y", "ring", 0.11).alias("near"), geo.point_near_ring("x", "y", "ring", 0.09).alias("far"),
        geo.point_near_ring("cx", "cy", "ring", 0.11).alias("corner"),
    ).first()
    assert (row.near, row.far, row.corner) == (True, False, False)


def test_clean_ring_opens_and_orients(spark):
    closed_clockwise = [(0.0, 0.0), (0.0, 1.0), (0.0, 1.0), (1.0, 1.0), (1.0, 0.0), (0.0, 0.0)]
    ring = geo.with_clean_ring(rings(spark, closed_clockwise)).first().ring
    assert len(ring) == 4
    area = sum(a.lon * b.lat - b.lon * a.lat for a, b in zip(ring, ring[1:] + ring[:1]))
    assert area > 0


def test_inset(spark):
    chamfered = [(0.0, 0.0), (10.0, 0.0), (10.0, 9.9), (9.9, 10.0), (0.0, 10.0)]
    tiny = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]
    df = geo.with_inset_ring(geo.with_clean_ring(rings(spark, chamfered, tiny, SQUARE)), "ring", "inset", 1.0)
    got = {r.i: r.inset for r in df.collect()}
    # The short edge vanishes, so its neighbours meet in the corner.
    assert sorted((round(p.lon, 6), round(p.lat, 6)) for p in got[0]) == [(1, 1), (1, 9), (9, 1), (9, 9)]
    assert got[1] is None
    small = geo.with_inset_ring(geo.with_clean_ring(rings(spark, SQUARE)), "ring", "inset", 0.25).first().inset
    assert sorted((p.lon, p.lat) for p in small) == [(0.25, 0.25), (0.25, 0.75), (0.75, 0.25), (0.75, 0.75)]


def test_cardinal_vertices(spark):
    diamond = [(0.0, -1.0), (2.0, 0.0), (0.0, 1.0), (-2.0, 0.0)]
    got = rings(spark, diamond).select(F.inline(geo.cardinal_vertices("ring"))).collect()
    assert {(r.vertex, r.lon, r.lat) for r in got} == {("N", 0, 1), ("S", 0, -1), ("E", 2, 0), ("W", -2, 0)}


def test_line_length(spark):
    # One degree of latitude at the equator, one degree of longitude on it, and no distance at all (known values).
    rows = [(0.0, 0.0, 0.0, 1.0, 110574.39), (0.0, 0.0, 1.0, 0.0, 111319.49), (5.0, 5.0, 5.0, 5.0, 0.0), (None, 0.0, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, want double")
    for r in geo.with_line_length(df, "a", "b", "c", "d", "got").collect():
        assert r.got == r.want


def test_line_length_is_compiled(spark, capsys):
    """The virtual machine interprets methods of more than 8,000 bytes."""
    df = spark.range(10).selectExpr("id", "id / 10 as a", "id / 7 as b", "id / 9 as c", "id / 8 as d")
    geo.with_line_length(df, "a", "b", "c", "d", "length").explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


def test_transform(spark):
    mercator = math.log(math.tan(math.radians(45 + 40.7 / 2))) * 6378137.0
    # The UTM rows: a central meridian, and a known point of zone 18 (published example, to the metre).
    df = spark.createDataFrame(
        [(500000.0, 0.0, 32631, 3.0, 0.0), (math.radians(-74.0) * 6378137.0, mercator, 3857, -74.0, 40.7),
         (585628.0, 4511322.0, 32618, -73.986, 40.748)],
        "x double, y double, e int, lon double, lat double",
    )
    lon, lat = geo.to_wgs84(F.col("x"), F.col("y"), F.col("e"))
    for r in df.select("lon", "lat", lon.alias("glon"), lat.alias("glat")).collect():
        assert math.isclose(r.lon, r.glon, abs_tol=1e-3) and math.isclose(r.lat, r.glat, abs_tol=1e-3)
    with pytest.raises(Exception, match="no transform"):
        df.select(geo.to_wgs84(F.lit(1.0), F.lit(1.0), F.lit(2154))[0]).collect()
