"""Validity of outlines with the place of the fault, and repair of those that cross themselves.

Small outlines are tested inside their row. Those that fail, and large ones, become rows: edges meet where they span the same
strip of their outline, so an outline of any number of corners is compared piece by piece. Crossings cut the edges, and the
pieces are traced into rings by the even-odd rule. Tracing needs a walk from corner to corner, which no expression offers; it
runs in Arrow batches on the outlines that do cross, and on nothing else.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkscout.functions import geo
from linkscout.functions.geo import once
from linkscout.functions.steps import steps

#: Corners up to which an outline is tested inside its row.
SMALL = 32
#: Edges that a strip would hold if they were spread evenly.
STRIP_EDGES = 8

Point = tuple[float, float]
RING = "array<struct<lon: double, lat: double>>"


def _edge_rows(outlines: DataFrame) -> DataFrame:
    """Edges with the strips they span: ``(key, i, n, ax .. by, lo, hi, first, last)``.

    Strips cut the outline across the axis along which its edges are short, so that an edge spans few.
    """
    rows = steps(
        outlines,
        ["key", "_open", "size(_open) as n", *[f"array_{e}(transform(_open, p -> p.{c})) as {n}_{c}" for c in ("lon", "lat") for n, e in (("low", "min"), ("high", "max"))]],
        ["*", f"posexplode({geo._edges('_open')}) as (i, e)"],
        ["key", "n", "i", "e.*", "low_lon", "high_lon", "low_lat", "high_lat"],
        [
            "*", f"sum(abs(bx - ax)) over (partition by key) / greatest(high_lon - low_lon, {geo.TINY!r}D) as _along_lon",
            f"sum(abs(by - ay)) over (partition by key) / greatest(high_lat - low_lat, {geo.TINY!r}D) as _along_lat",
        ],
        ["*", "_along_lon < _along_lat as _by_lon", f"cast(ceil(n / {STRIP_EDGES}) as int) as _strips"],
        [
            "key", "n", "i", "ax", "ay", "bx", "by", "_strips", "if(_by_lon, low_lon, low_lat) as _low",
            f"greatest(if(_by_lon, high_lon - low_lon, high_lat - low_lat), {geo.TINY!r}D) as _size",
            "if(_by_lon, least(ax, bx), least(ay, by)) as _from", "if(_by_lon, greatest(ax, bx), greatest(ay, by)) as _to",
        ],
        [
            "key", "n", "i", "ax", "ay", "bx", "by",
            "cast(least(_strips - 1, floor((_from - _low) / _size * _strips)) as int) as first",
            "cast(least(_strips - 1, floor((_to - _low) / _size * _strips)) as int) as last",
        ],
    )
    return rows.withColumn("strip", F.explode(F.sequence("first", "last")))


def crossings(outlines: DataFrame) -> DataFrame:
    """``(key, i, j, x, y)``: points at which edges i < j of an outline meet, but for the corner that neighbours share.

    A pair that spans several strips in common is compared in the first of them. Edges on one line give the ends of what
    they share, so a spike is found as well.
    """
    rows = _edge_rows(outlines)
    e = rows.select("key", "strip", "first", *[F.col(c).alias(f"e_{c}") for c in ("i", "n", "ax", "ay", "bx", "by")])
    g = rows.select("key", "strip", F.col("first").alias("g_first"), *[F.col(c).alias(f"g_{c}") for c in ("i", "ax", "ay", "bx", "by")])
    met = e.join(g, ["key", "strip"]).where(
        "e_i < g_i and strip = greatest(first, g_first)"
        " and least(e_ax, e_bx) <= greatest(g_ax, g_bx) and least(g_ax, g_bx) <= greatest(e_ax, e_bx)"
        " and least(e_ay, e_by) <= greatest(g_ay, g_by) and least(g_ay, g_by) <= greatest(e_ay, e_by)"
    )
    both = ["named_struct('ax', e_ax, 'ay', e_ay, 'bx', e_bx, 'by', e_by) as e", "named_struct('ax', g_ax, 'ay', g_ay, 'bx', g_bx, 'by', g_by) as g"]
    proper = (
        f"({geo._side('e', 'g.ax', 'g.ay')} * {geo._side('e', 'g.bx', 'g.by')} < 0"
        f" and {geo._side('g', 'e.ax', 'e.ay')} * {geo._side('g', 'e.bx', 'e.by')} < 0)"
    )
    along = "((g.ax - e.ax) * (g.by - g.ay) - (g.ay - e.ay) * (g.bx - g.ax)) / ((e.bx - e.ax) * (g.by - g.ay) - (e.by - e.ay) * (g.bx - g.ax))"
    touching = ", ".join(
        f"if({geo._on_edge(o, f'{o2}.{c}x', f'{o2}.{c}y')}, named_struct('x', {o2}.{c}x, 'y', {o2}.{c}y), null)"
        for o, o2 in (("e", "g"), ("g", "e")) for c in "ab"
    )
    points = f"if({proper}, array(named_struct('x', e.ax + _t * (e.bx - e.ax), 'y', e.ay + _t * (e.by - e.ay))), array_compact(array({touching})))"
    # Neighbours share a corner; only more than that counts.
    shared = "(e_i + 1 = g_i and p.x = e.bx and p.y = e.by) or (e_i = 0 and g_i = e_n - 1 and p.x = e.ax and p.y = e.ay)"
    return steps(
        met,
        ["key", "e_i", "g_i", "e_n", *both],
        ["*", f"if({proper}, {along}, null) as _t"],
        ["key", "e_i", "g_i", "e_n", "e", "g", once("_points", points)],
        ["key", "e_i as i", "g_i as j", f"inline(filter(array_distinct(_points), p -> not ({shared})))"],
    )


def traced(corners: list[Point], cuts: list[tuple[int, float, float]]) -> list[list[list[Point]]]:
    """The inside of a closed line by the even-odd rule: polygons, each an outer ring and its holes, all closed.

    ``cuts`` are points on edge i. Pieces that are covered an even number of times cancel out. The others bound faces, of
    which neighbours are in turn inside and outside, so each inside face is a polygon.
    """
    snap = _snapping(corners)
    corners = [snap(p) for p in corners]
    on: dict[int, list[Point]] = {}
    for i, x, y in cuts:
        on.setdefault(i, []).append(snap((x, y)))
    pieces: Counter[tuple[Point, Point]] = Counter()
    for i, a in enumerate(corners):
        b = corners[(i + 1) % len(corners)]
        line = [a, *sorted(on.get(i, []), key=lambda p: math.dist(a, p)), b]
        pieces.update(tuple(sorted(s)) for s in zip(line, line[1:]) if s[0] != s[1])
    kept = [s for s, n in pieces.items() if n % 2]
    out: dict[Point, list[Point]] = {}
    for a, b in kept:
        out.setdefault(a, []).append(b)
        out.setdefault(b, []).append(a)
    turn: dict[tuple[Point, Point], Point] = {}
    for v, ends in out.items():
        ends.sort(key=lambda p: math.atan2(p[1] - v[1], p[0] - v[0]))
        for k, u in enumerate(ends):
            turn[u, v] = ends[k - 1]
    rings, done = [], set()
    for start in turn:
        if start in done:
            continue
        walk, at, place = [], start, {}
        while at not in done:
            done.add(at)
            # A corner met again closes a ring of its own.
            if at[0] in place:
                k = place[at[0]]
                rings.append(walk[k:])
                for p in walk[k:]:
                    place.pop(p, None)
                del walk[k:]
            place[at[0]] = len(walk)
            walk.append(at[0])
            at = at[1], turn[at]
        rings.append(walk)
    outer, holes = [], []
    for ring in rings:
        area = _area(ring)
        if area and _inside_left(ring, kept):
            (outer if area > 0 else holes).append(_from_least(ring))
    outer.sort(key=lambda r: (_area(r), r))
    polygons = [[r] for r in outer]
    for hole in sorted(holes):
        mid = _middle(hole[0], hole[1])
        for polygon in polygons:
            if _contains(polygon[0], mid):
                polygon.append(hole)
                break
    return sorted([[*r, r[0]] for r in polygon] for polygon in polygons)


def _snapping(corners: list[Point]) -> Callable[[Point], Point]:
    """Points that rounding alone tells apart become the first of them: several lines may meet at one point."""
    size = 1e-13 * max(abs(c) for p in corners for c in p) or 1.0
    known: dict[tuple[int, int], list[Point]] = {}

    def snap(p: Point) -> Point:
        x, y = math.floor(p[0] / size), math.floor(p[1] / size)
        for i in (x - 1, x, x + 1):
            for j in (y - 1, y, y + 1):
                for q in known.get((i, j), ()):
                    if abs(p[0] - q[0]) <= size and abs(p[1] - q[1]) <= size:
                        return q
        known.setdefault((x, y), []).append(p)
        return p

    return snap


def _area(ring: list[Point]) -> float:
    x, y = ring[0]
    return sum((a[0] - x) * (b[1] - y) - (b[0] - x) * (a[1] - y) for a, b in zip(ring, ring[1:] + ring[:1])) / 2


def _from_least(ring: list[Point]) -> list[Point]:
    k = ring.index(min(ring))
    return ring[k:] + ring[:k]


def _middle(a: Point, b: Point) -> Point:
    return (a[0] + b[0]) / 2, (a[1] + b[1]) / 2


def _east(p: Point, segments: list[tuple[Point, Point]]) -> int:
    """Segments that a ray to the east from ``p`` crosses."""
    return sum(
        (a[1] > p[1]) != (b[1] > p[1]) and p[0] < a[0] + (p[1] - a[1]) * (b[0] - a[0]) / (b[1] - a[1]) for a, b in segments
    )


def _contains(ring: list[Point], p: Point) -> bool:
    return bool(_east(p, list(zip(ring, ring[1:] + ring[:1]))) % 2)


def _inside_left(ring: list[Point], kept: list[tuple[Point, Point]]) -> bool:
    """Whether the face on the left of a ring is inside: the parity of what lies east of the middle of one of its edges."""
    a, b = max(zip(ring, ring[1:] + ring[:1]), key=lambda s: abs(s[1][1] - s[0][1]))
    own = tuple(sorted((a, b)))
    beyond = _east(_middle(a, b), [s for s in kept if s != own]) % 2
    return beyond == 1 if b[1] < a[1] else beyond == 0


def _repaired(faulty: DataFrame) -> DataFrame:
    """``(key, place, parts)`` from ``(key, _open, place, cuts)``."""
    schema = f"key binary, place struct<x: double, y: double>, parts array<array<{RING}>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for r in batch.to_pylist():
                found = traced([(p["lon"], p["lat"]) for p in r["_open"]], [(c["i"], c["x"], c["y"]) for c in r["cuts"]])
                parts.append([[[{"lon": x, "lat": y} for x, y in ring] for ring in polygon] for polygon in found])
            corner = pa.struct([("lon", pa.float64()), ("lat", pa.float64())])
            kind = pa.list_(pa.list_(pa.list_(corner)))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("place"), pa.array(parts, kind)], ["key", "place", "parts"])

    return faulty.select("key", "place", "_open", "cuts").mapInArrow(run, schema)


def with_validity(df: DataFrame, ring: str, reason: str, parts: str) -> DataFrame:
    """Add the validity of an outline and its valid form, polygons of closed rings (the outer one first).

    The reason of a fault ends with its place: the first corner, or the meeting point of the first two edges that meet. A valid
    outline stays one polygon, without repeated corners, counter-clockwise. One that crosses, touches or overlaps itself becomes the
    polygons of its inside by the even-odd rule; what has no area goes, so it may become none. A NULL ordinate, one that is not
    finite, or fewer than three different corners give NULL. A NULL outline has neither.
    """
    keep = [c for c in df.columns if c not in (reason, parts)]
    finite = f"not exists({ring}, p -> not {geo._finite('p.lon')} or not {geo._finite('p.lat')})"
    opened = steps(df, [*keep, once("_open", f"if({finite}, {geo.distinct_corners(ring)}, null)")])
    enough = "(_open is not null and size(array_distinct(_open)) >= 3)"
    failing = f"({enough} and (size(_open) > {SMALL} or {geo.self_crossing('_open')}))"
    # Rows are told apart by their outline, so equal ones are looked at once.
    sorted_out = steps(opened, ["*", once("_look", failing)])
    key = F.sha2(F.to_json("_open"), 256).cast("binary")
    looked = sorted_out.where("_look").withColumn("_key", key)
    outlines = looked.select(F.col("_key").alias("key"), "_open").dropDuplicates(["key"])
    met = crossings(outlines)
    cut = F.array(F.struct("i", "x", "y"), F.struct(F.col("j").alias("i"), "x", "y"))
    found = met.groupBy("key").agg(
        F.flatten(F.collect_list(cut)).alias("cuts"), F.min_by(F.struct("x", "y"), F.struct("i", "j", "x", "y")).alias("place")
    )
    repaired = _repaired(outlines.join(found, "key"))
    whole = f"if({enough}, array(array(transform(array({geo.counter_clockwise('_open')}), r -> concat(r, slice(r, 1, 1)))[0])), null)"
    text = (
        f"case when {ring} is null then null when _open is null then 'Invalid Coordinate'"
        f" when not {enough} then concat('Too few points in geometry component', {_place('get(_open, 0).lon', 'get(_open, 0).lat')}) else 'Valid Geometry' end"
    )
    plain = steps(sorted_out.where("not coalesce(_look, false)"), [*keep, f"{text} as {reason}", once(parts, whole)])
    joined = looked.join(repaired, F.col("_key") == F.col("key"), "left")
    judged = joined.selectExpr(
        *[f"`{c}`" for c in keep], f"if(place is null, 'Valid Geometry', concat('Self-intersection', {_place('place.x', 'place.y')})) as {reason}",
        f"if(place is null, {whole}, parts) as {parts}",
    )
    return plain.unionByName(judged)


def _place(lon: str, lat: str) -> str:
    # An outline without corners has no place.
    return f"if({lon} is null, '', format_string('[%.9f %.9f]', {lon}, {lat}))"


def parts_wkt(parts: Column) -> Column:
    """Text of the polygons: POLYGON for one, MULTIPOLYGON for several or none."""
    def ring(r: Column) -> Column:
        return F.concat(F.lit("("), F.array_join(F.transform(r, lambda p: F.format_string("%.9f %.9f", p.lon, p.lat)), ", "), F.lit(")"))

    polygons = F.transform(parts, lambda p: F.concat(F.lit("("), F.array_join(F.transform(p, ring), ", "), F.lit(")")))
    joined = F.array_join(polygons, ", ")
    return F.when(F.size(parts) == 1, F.concat(F.lit("POLYGON"), joined)).when(
        F.size(parts) == 0, F.lit("MULTIPOLYGON EMPTY")
    ).when(parts.isNotNull(), F.concat(F.lit("MULTIPOLYGON("), joined, F.lit(")")))
