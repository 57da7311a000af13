"""Round trip of every kind of geometry in both byte orders; what is no geometry raises; replies that do not parse."""

import random
import struct

import pytest
from pyspark.sql import functions as F

from linkscout.functions import geo, text
from linkscout.sources import wkb


def packed(shape, order="<", srid=None, z=False, iso=False):
    """Extended WKB of ('point', corner), ('line', corners), ('area', rings), ('points' | 'lines' | 'areas' | 'all', members)."""
    kind, body = shape
    codes = {"point": 1, "line": 2, "area": 3, "points": 4, "lines": 5, "areas": 6, "all": 7}
    number = codes[kind] + (1000 if z and iso else 0) | (0x80000000 if z and not iso else 0) | (0x20000000 if srid is not None else 0)
    out = struct.pack("B", order == "<") + struct.pack(order + "I", number) + (struct.pack(order + "i", srid) if srid is not None else b"")

    def corners(path):
        return b"".join(struct.pack(order + "d" * (3 if z else 2), *p, *([7.5] if z else [])) for p in path)

    if kind == "point":
        return out + corners([body])
    out += struct.pack(order + "I", len(body))
    if kind == "line":
        return out + corners(body)
    if kind == "area":
        return out + b"".join(struct.pack(order + "I", len(r)) + corners(r) for r in body)
    return out + b"".join(packed(m, random.choice("<>"), None, z, iso) for m in body)


def flat(shape):
    kind, body = shape
    if kind in ("point", "line", "area"):
        return [(kind, [[body]] if kind == "point" else [body] if kind == "line" else body)]
    parts = [s for m in body for s in flat(m)]
    return parts if kind == "all" else [(kind[:-1], [p for _, paths in parts for p in paths])]


def made(draw):
    def path(n):
        return [(draw.uniform(-180, 180), draw.choice([0.0, -0.0, 1e-310, 5e-324, draw.uniform(-90, 90)])) for _ in range(n)]

    point, line, area = ("point", path(1)[0]), ("line", path(4)), ("area", [path(5), path(3)])
    some = [point, line, area, ("points", [point, ("point", path(1)[0])]), ("lines", [line, line]), ("areas", [area, area])]
    return [*some, ("all", some), ("all", [("all", [point]), line]), ("all", [])]


@pytest.mark.parametrize("order", ["<", ">"])
def test_round_trip(spark, order):
    draw, shapes, rows = random.Random(3), [], []
    for srid in (None, 4326, 26918):
        for z, iso in ((False, False), (True, False), (True, True)):
            for s in made(draw):
                shapes.append((srid, flat(s)))
                rows.append((len(rows), packed(s, order, srid, z, iso).hex().upper()))
    df = spark.createDataFrame([*rows, (999, None)], "i long, geom string").repartition(3)
    out = {r.i: r.g for r in df.select("i", wkb.shapes(F.col("geom")).alias("g")).collect()}
    for i, (srid, want) in enumerate(shapes):
        got = [(s.kind, [[(p.lon, p.lat) for p in path] for path in s.paths]) for s in out[i].shapes]
        assert (out[i].srid, got) == (srid, want)
    assert out[999].shapes is None
    kinds = wkb.decode_shapes(df, "geom").groupBy("kind").count().collect()
    assert {r.kind for r in kinds} == {"point", "line", "area"}


@pytest.mark.parametrize("bad", [
    "", "01", "0201000000", "010100000000", "zz", packed(("point", (1.0, 2.0))).hex() + "00", packed(("line", [(1.0, 2.0)] * 3)).hex()[:-2],
    "0111000000", "0109000000", "0104000000010000000102000000" + "00000000",
])
def test_what_is_no_geometry_raises(bad):
    with pytest.raises(ValueError):
        wkb.decode(bad)


@pytest.mark.parametrize("order,srid", [("<", 4326), (">", 4326), ("<", None), (">", None)])
def test_native_points(spark, order, srid):
    values = [(-73.9913778, 40.7390831), (0.0, -0.5), (179.25, 1e-300), (5e-324, -90.0)]
    df = spark.createDataFrame([(x, y, packed(("point", (x, y)), order, srid).hex()) for x, y in values] + [(None, None, None)], "x double, y double, h string")
    for r in df.select("x", "y", geo.decode_ewkb_point(F.col("h")).alias("p")).collect():
        assert r.p is None if r.x is None else (r.p.lon, r.p.lat, r.p.srid) == (r.x, r.y, srid)
    line = spark.createDataFrame([(packed(("line", [(1.0, 2.0)] * 2)).hex(),)], "h string")
    with pytest.raises(Exception, match="no point in extended WKB"):
        line.select(geo.decode_ewkb_point(F.col("h"))).collect()


def test_empty_point():
    assert wkb.decode(packed(("point", (float("nan"), float("nan")))).hex()) == (None, [("point", [])])


def test_replies_that_do_not_parse(spark):
    rows = [(1, '{"capacity": 300, "model": "x"}'), (2, '{"capacity": 300'), (3, '{"capacity": "many"}'), (4, None), (5, "{}"), (6, "")]
    good, bad = text.quarantined(text.parse_link_reply(spark.createDataFrame(rows, "id int, reply string"), "reply"))
    assert {r.id: r.capacity for r in good.collect()} == {1: 300, 4: None, 5: None, 6: None}
    assert {r.id: r.reply_error for r in bad.collect()} == {2: rows[1][1], 3: rows[2][1]} and bad.columns == ["id", "reply_error"]
    heights = [(1, '{"results": [{"elevation": 2.5}, {"elevation": 3}]}'), (2, '{"results": [{"elevation": 2.5'), (3, "no")]
    good, bad = text.quarantined(text.parse_elevation_reply(spark.createDataFrame(heights, "id int, reply string"), "reply"))
    assert [(r.id, r.elevations) for r in good.collect()] == [(1, [2.5, 3.0])] and {r.id for r in bad.collect()} == {2, 3}
