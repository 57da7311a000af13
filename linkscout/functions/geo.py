"""Geometry as native column expressions.

Points are (lon, lat) columns in WGS84 degrees, outlines are ``array<struct<lon, lat>>``. Nothing here runs Python
on executors.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkscout.functions.steps import steps

# WGS84 ellipsoid (fixed values).
SEMI_MAJOR_M = 6378137.0
FLATTENING = 1 / 298.257223563
SEMI_MINOR_M = SEMI_MAJOR_M * (1 - FLATTENING)

TINY = 1e-300

# Point and buffer distances in degrees (fixed values): roof inset and licence buffer.
ROOF_INSET_DEG = 0.000012
LICENCE_BUFFER_DEG = 0.000278


def round_half_up(value: Column, digits: int) -> Column:
    """Decimal rounding that any engine reproduces bit for bit (``round`` breaks ties differently between them)."""
    scale = 10**digits
    return F.floor(value * float(scale) + 0.5) / float(scale)


def once(name: str, expression: str) -> str:
    """Select item for a column that is computed here, once per row.

    A later filter or explode on a derived column makes Catalyst repeat the column's whole definition below it; for array
    expressions built in steps that multiplies at every step. A one-row generator keeps the definition in one place.
    """
    return f"inline_outer(array(named_struct('{name}', {expression})))"


# ---------------------------------------------------------------- distance


def with_geodetic(df: DataFrame, lon: str, lat: str, prefix: str) -> DataFrame:
    """Add the per-point terms of the distance formula once per point, so that a join only pays per pair."""
    return steps(
        df,
        ["*", f"radians({lon}) as {prefix}_lam", f"atan({1 - FLATTENING!r}D * tan(radians({lat}))) as {prefix}_beta"],
        ["*", f"sin({prefix}_beta) as {prefix}_sin", f"cos({prefix}_beta) as {prefix}_cos"],
    )


def geodetic_columns(prefix: str) -> list[str]:
    return [f"{prefix}_{part}" for part in ("lam", "beta", "sin", "cos")]


def with_geodesic(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """Add Lambert's long-line distance in metres between two sides prepared by :func:`with_geodetic`.

    Within about 2 cm of the exact geodesic up to 11 km. P and Q of the textbook form are eliminated with
    sinP cosQ = (sin b2 + sin b1) / 2 and cosP sinQ = (sin b2 - sin b1) / 2. Each step is computed once per pair, which
    also keeps the generated method small enough to be compiled.
    """
    half_lat, half_lon = f"sin(({b}_beta - {a}_beta) / 2)", f"sin(({b}_lam - {a}_lam) / 2)"
    bend = (
        f"(_sig - sin(_sig)) * pow(({b}_sin + {a}_sin) / 2, 2) / greatest(1 - _h, {TINY!r}D)"
        f" + (_sig + sin(_sig)) * pow(({b}_sin - {a}_sin) / 2, 2) / greatest(_h, {TINY!r}D)"
    )
    return steps(
        df,
        ["*", f"{half_lat} as _y", f"{half_lon} as _x"],
        ["*", once("_h", f"least(1D, _y * _y + {a}_cos * {b}_cos * _x * _x)")],
        ["*", once("_sig", "2 * asin(sqrt(_h))")],
        [*df.columns, once(out, f"{SEMI_MAJOR_M!r}D * (_sig - {FLATTENING / 2!r}D * ({bend}))")],
    )


def metres_to_km(metres: Column) -> Column:
    """Kilometres with two decimals, half up."""
    return F.floor(metres / 10 + 0.5) / 100


def with_line_length(
    df: DataFrame, lon1: str, lat1: str, lon2: str, lat2: str, out: str, iterations: int = 5
) -> DataFrame:
    """Add the Vincenty length in metres (two decimals) of the straight line between two points; NULL if one is missing.

    The fixed-point loop is unrolled, so each step is generated code. Five steps reach sub-millimetre for anything but nearly
    antipodal ends.
    """
    keep, f = df.columns, f"{FLATTENING!r}D"
    ends = [*keep, "_dl", "_s1", "_c1", "_s2", "_c2"]
    stages: list[list[str]] = [
        [
            "*",
            f"atan((1 - {f}) * tan(radians({lat1}))) as _u1",
            f"atan((1 - {f}) * tan(radians({lat2}))) as _u2",
            f"radians({lon2} - {lon1}) as _dl",
        ],
        [*keep, "_dl", "sin(_u1) as _s1", "cos(_u1) as _c1", "sin(_u2) as _s2", "cos(_u2) as _c2", "_dl as _lam"],
    ]
    for step in range(iterations + 1):
        stages += [
            [*ends, "sin(_lam) as _sl", "cos(_lam) as _cl"],
            [
                *ends,
                "sqrt((_c2 * _sl) * (_c2 * _sl) + (_c1 * _s2 - _s1 * _c2 * _cl) * (_c1 * _s2 - _s1 * _c2 * _cl)) as _ss",
                "_s1 * _s2 + _c1 * _c2 * _cl as _cs",
                "_c1 * _c2 * _sl as _n",
            ],
            [*ends, "_ss", "_cs", "atan2(_ss, _cs) as _sig", f"_n / greatest(_ss, {TINY!r}D) as _sa"],
            [*ends, "_ss", "_cs", "_sig", "_sa", "1 - _sa * _sa as _c2a"],
            [
                *ends, "_ss", "_cs", "_sig", "_sa", "_c2a",
                f"if(_c2a > 1e-12D, _cs - 2 * _s1 * _s2 / greatest(_c2a, {TINY!r}D), 0D) as _cm",
                f"{f} / 16 * _c2a * (4 + {f} * (4 - 3 * _c2a)) as _cc",
            ],
        ]
        if step < iterations:
            turn = f"_dl + (1 - _cc) * {f} * _sa * (_sig + _cc * _ss * (_cm + _cc * _cs * (2 * _cm * _cm - 1)))"
            # A generated method of more than 8,000 bytes is interpreted; a generator starts a new one.
            stages.append([*ends, once("_lam", turn)])
    axis_ratio = (SEMI_MAJOR_M**2 - SEMI_MINOR_M**2) / SEMI_MINOR_M**2
    delta = (
        "_B * _ss * (_cm + _B / 4 * (_cs * (2 * _cm * _cm - 1)"
        " - _B / 6 * _cm * (4 * _ss * _ss - 3) * (4 * _cm * _cm - 3)))"
    )
    metres = f"{SEMI_MINOR_M!r}D * _A * (_sig - {delta})"
    stages += [
        [*keep, "_ss", "_cs", "_sig", "_cm", f"_c2a * {axis_ratio!r}D as _q"],
        [
            *keep, "_ss", "_cs", "_sig", "_cm",
            "1 + _q / 16384 * (4096 + _q * (-768 + _q * (320 - 175 * _q))) as _A",
            "_q / 1024 * (256 + _q * (-128 + _q * (74 - 47 * _q))) as _B",
        ],
        # Computed once here: see once().
        [*keep, once(out, f"floor({metres} * 100D + 0.5D) / 100D")],
    ]
    return steps(df, *stages)


# ---------------------------------------------------------------- coordinate systems


def _krueger_inverse(x: Column, y: Column, zone: Column, south: Column) -> tuple[Column, Column]:
    """UTM easting/northing to lon/lat degrees, Krueger series to the fourth order of the third flattening."""
    n = FLATTENING / (2 - FLATTENING)
    radius = SEMI_MAJOR_M / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    # Series coefficients (fixed values of the transverse Mercator projection).
    beta = (
        n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360,
        n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440,
        17 * n**3 / 480 - 37 * n**4 / 840,
        4397 * n**4 / 161280,
    )
    delta = (
        2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45,
        7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45,
        56 * n**3 / 15 - 136 * n**4 / 35,
        4279 * n**4 / 630,
    )
    xi = (y - F.when(south, F.lit(10000000.0)).otherwise(0.0)) / (0.9996 * radius)
    eta = (x - 500000.0) / (0.9996 * radius)
    xi_p, eta_p = xi, eta
    for j, b in enumerate(beta, start=1):
        xi_p = xi_p - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta_p = eta_p - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi_p) / F.cosh(eta_p))
    lat = chi
    for j, d in enumerate(delta, start=1):
        lat = lat + d * F.sin(2 * j * chi)
    lon = F.degrees(F.atan2(F.sinh(eta_p), F.cos(xi_p))) + (zone * 6 - 183)
    return lon, F.degrees(lat)


def _mercator_inverse(x: Column, y: Column) -> tuple[Column, Column]:
    return F.degrees(x / SEMI_MAJOR_M), F.degrees(2 * F.atan(F.exp(y / SEMI_MAJOR_M))) - 90


def to_wgs84(x: Column, y: Column, epsg: Column | int) -> tuple[Column, Column]:
    """(lon, lat) of a point given in EPSG 4326, 3857 or a UTM zone (326zz, 327zz); any other code raises.

    With one fixed code for the whole table only its own formula enters the plan.
    """
    if isinstance(epsg, int) and epsg == 4326:
        return x, y
    if isinstance(epsg, int) and epsg == 3857:
        return _mercator_inverse(x, y)
    epsg = F.lit(epsg) if isinstance(epsg, int) else epsg
    zone = (epsg % 100).cast("double")
    utm = epsg.between(32601, 32660) | epsg.between(32701, 32760)
    utm_lon, utm_lat = _krueger_inverse(x, y, zone, epsg >= 32700)
    unknown = F.raise_error(F.concat(F.lit("no transform to EPSG 4326 from EPSG "), epsg.cast("string"))).cast("double")
    degrees, mercator = epsg == 4326, epsg == 3857
    flat_lon, flat_lat = _mercator_inverse(x, y)
    lon = F.when(degrees, x).when(mercator, flat_lon).when(utm, utm_lon).otherwise(unknown)
    lat = F.when(degrees, y).when(mercator, flat_lat).when(utm, utm_lat).otherwise(unknown)
    return lon, lat


def mercator_to_wgs84(x: float, y: float) -> tuple[float, float]:
    """Same transform for literals, for instance the corners of a map extent."""
    return math.degrees(x / SEMI_MAJOR_M), math.degrees(2 * math.atan(math.exp(y / SEMI_MAJOR_M))) - 90


# ---------------------------------------------------------------- text forms


def point_wkt(lon: Column, lat: Column) -> Column:
    return F.format_string("POINT(%.9f %.9f)", lon, lat)


def line_wkt(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Two-point line, NULL if any ordinate is missing. Nine decimals keep the text the same in every engine."""
    known = lon1.isNotNull() & lat1.isNotNull() & lon2.isNotNull() & lat2.isNotNull()
    return F.when(known, F.format_string("LINESTRING(%.9f %.9f, %.9f %.9f)", lon1, lat1, lon2, lat2))


def ring_wkt(ring: Column) -> Column:
    corners = F.transform(ring, lambda p: F.format_string("%.9f %.9f", p.lon, p.lat))
    return F.when(ring.isNotNull(), F.concat(F.lit("POLYGON(("), F.array_join(corners, ", "), F.lit("))")))


def _ieee_double(big: Column) -> Column:
    """A hex double, first byte first, as a number: 12 bits of sign and exponent, 52 bits of fraction."""
    head = F.conv(F.substring(big, 1, 3), 16, 10).cast("int")
    fraction = F.conv(F.substring(big, 4, 13), 16, 10).cast("long").cast("double") / float(2**52)
    sign = F.when(head >= 2048, -1.0).otherwise(1.0)
    exponent = head % 2048
    return F.when(exponent == 0, sign * fraction * F.pow(F.lit(2.0), F.lit(-1022.0))).otherwise(
        sign * (1 + fraction) * F.pow(F.lit(2.0), (exponent - 1023).cast("double"))
    )


def decode_ewkb_point(hex_text: Column) -> Column:
    """Extended WKB point (hex text, either byte order, with or without SRID) to ``struct<lon, lat, srid>``; NULL stays NULL.

    Anything else raises. Other kinds of geometry are read by :mod:`linkscout.sources.wkb`.
    """
    text = F.upper(hex_text)
    little, named = F.substring(text, 1, 2) == "01", F.substring(text, 3, 8).isin("01000020", "20000001")
    is_point = text.rlike("^(0101000020[0-9A-F]{40}|0101000000[0-9A-F]{32}|0020000001[0-9A-F]{40}|0000000001[0-9A-F]{32})$")

    def number(start: int, size: int) -> Column:
        """Hex digits of a number, first byte first; what follows an SRID stands four bytes further on."""
        def digits(first: int) -> Column:
            turned = F.concat(*[F.substring(text, i, 2) for i in range(first + 2 * size - 2, first - 1, -2)])
            return F.when(little, turned).otherwise(F.substring(text, first, 2 * size))

        return digits(start) if size == 4 else F.when(named, digits(start + 8)).otherwise(digits(start))

    point = F.struct(
        _ieee_double(number(11, 8)).alias("lon"),
        _ieee_double(number(27, 8)).alias("lat"),
        F.when(named, F.conv(number(11, 4), 16, 10).cast("int")).alias("srid"),
    )
    wrong = F.raise_error(F.concat(F.lit("no point in extended WKB: "), F.substring(hex_text, 1, 18))).cast(
        "struct<lon: double, lat: double, srid: int>"
    )
    return F.when(hex_text.isNull(), F.lit(None)).when(is_point, point).otherwise(wrong)


# ---------------------------------------------------------------- outlines


def point_struct(lon: Column, lat: Column) -> Column:
    return F.struct(lon.cast("double").alias("lon"), lat.cast("double").alias("lat"))


def _edges(ring: str) -> str:
    """Edges of an open ring as ``array<struct<ax, ay, bx, by>>``, the last one closing it."""
    following = f"concat(slice({ring}, 2, greatest(size({ring}) - 1, 0)), slice({ring}, 1, 1))"
    return (
        f"zip_with({ring}, {following}, (a, b) -> "
        "named_struct('ax', a.lon, 'ay', a.lat, 'bx', b.lon, 'by', b.lat))"
    )


def distinct_corners(ring: str) -> str:
    """Open ring without repeated neighbours and without a closing copy of the first corner."""
    kept = f"filter({ring}, (p, i) -> i = 0 or p != get({ring}, i - 1))"
    return (
        f"transform(array({kept}), k -> if(size(k) > 1 and get(k, 0) = get(k, size(k) - 1), slice(k, 1, size(k) - 1), k))[0]"
    )


def doubled_area(ring: str) -> str:
    """Twice the signed area, positive when counter-clockwise. Taken relative to the first corner to keep digits."""
    x0, y0 = f"get({ring}, 0).lon", f"get({ring}, 0).lat"
    return (
        f"aggregate({_edges(ring)}, 0D, (total, e) -> "
        f"total + ((e.ax - {x0}) * (e.by - {y0}) - (e.bx - {x0}) * (e.ay - {y0})))"
    )


def counter_clockwise(ring: str) -> str:
    return f"if({doubled_area(ring)} < 0, reverse({ring}), {ring})"


def with_clean_ring(df: DataFrame, ring: str = "ring") -> DataFrame:
    """Normalise an outline column once at scan, so that later expressions may assume an open, counter-clockwise ring."""
    keep = [c for c in df.columns if c != ring]
    return steps(
        df,
        [*keep, once("_corners", distinct_corners(ring))],
        [*keep, once(ring, counter_clockwise("_corners"))],
    )


def ring_box(ring: str) -> dict[str, Column]:
    lons, lats = f"transform({ring}, p -> p.lon)", f"transform({ring}, p -> p.lat)"
    return {
        "west": F.expr(f"array_min({lons})"),
        "east": F.expr(f"array_max({lons})"),
        "south": F.expr(f"array_min({lats})"),
        "north": F.expr(f"array_max({lats})"),
    }


def _on_edge(e: str, x: str, y: str) -> str:
    return (
        f"(({e}.bx - {e}.ax) * ({y} - {e}.ay) = ({e}.by - {e}.ay) * ({x} - {e}.ax)"
        f" and {x} between least({e}.ax, {e}.bx) and greatest({e}.ax, {e}.bx)"
        f" and {y} between least({e}.ay, {e}.by) and greatest({e}.ay, {e}.by))"
    )


def crosses_ray(e: str, lon: str, lat: str) -> str:
    """The edge crosses the ray from the point to the west; an odd number of them means that the point is inside."""
    left = f"(({lon} - {e}.ax) * ({e}.by - {e}.ay) < ({e}.bx - {e}.ax) * ({lat} - {e}.ay))"
    return f"((({e}.ay > {lat}) != ({e}.by > {lat})) and ({left} = ({e}.by > {e}.ay)))"


def point_in_ring_text(lon: str, lat: str, ring: str) -> str:
    """True inside the outline or on its boundary. Crossing parity without a division, plus the edge test."""
    return (
        f"(aggregate({_edges(ring)}, false, (odd, e) -> odd != {crosses_ray('e', lon, lat)})"
        f" or exists({_edges(ring)}, e -> {_on_edge('e', lon, lat)}))"
    )


def point_in_ring(lon: str, lat: str, ring: str) -> Column:
    return F.expr(point_in_ring_text(lon, lat, ring))


def ring_distance_sq(lon: str, lat: str, ring: str) -> Column:
    """Squared planar distance in degrees from a point to the nearest edge."""
    dx, dy = "(e.bx - e.ax)", "(e.by - e.ay)"
    along = f"((({lon} - e.ax) * {dx} + ({lat} - e.ay) * {dy}) / greatest({dx} * {dx} + {dy} * {dy}, {TINY!r}D))"
    t = f"least(1D, greatest(0D, {along}))"
    ex, ey = f"({lon} - (e.ax + {t} * {dx}))", f"({lat} - (e.ay + {t} * {dy}))"
    return F.expr(f"array_min(transform({_edges(ring)}, e -> {ex} * {ex} + {ey} * {ey}))")


def point_near_ring(lon: str, lat: str, ring: str, buffer_deg: float) -> Column:
    """Point inside the outline grown by ``buffer_deg`` planar degrees."""
    return point_in_ring(lon, lat, ring) | (ring_distance_sq(lon, lat, ring) <= F.lit(buffer_deg * buffer_deg))


def _point_segment_sq(x: str, y: str, ax: str, ay: str, bx: str, by: str) -> str:
    """Squared planar distance from a point to a segment, which may have no length."""
    dx, dy = f"({bx} - {ax})", f"({by} - {ay})"
    along = f"((({x} - {ax}) * {dx} + ({y} - {ay}) * {dy}) / greatest({dx} * {dx} + {dy} * {dy}, {TINY!r}D))"
    t = f"least(1D, greatest(0D, {along}))"
    ex, ey = f"({x} - ({ax} + {t} * {dx}))", f"({y} - ({ay} + {t} * {dy}))"
    return f"({ex} * {ex} + {ey} * {ey})"


def point_near_edges(lon: str, lat: str, edges: str, buffer_deg: float) -> str:
    """The same as :func:`point_near_ring` for an outline whose edges are at hand (:func:`_edges`)."""
    near = _point_segment_sq(lon, lat, "e.ax", "e.ay", "e.bx", "e.by")
    return (
        f"(exists({edges}, e -> {near} <= {buffer_deg * buffer_deg!r}D)"
        f" or aggregate({edges}, false, (odd, e) -> odd != {crosses_ray('e', lon, lat)}))"
    )


def discs(ring: str, x: str, y: str, buffer_deg: float) -> str:
    """``struct<in_sq, out_sq>``: squared distances from ``(x, y)`` that decide on nearness to an outline without its edges.

    What comes within the first of them meets the outline grown by ``buffer_deg``, as a disc around ``(x, y)`` lies inside; without
    such a disc it is negative. What stays beyond the second does not meet it. Between them the edges decide. Both leave room for
    rounding.
    """
    to_edge = _point_segment_sq(x, y, "e.ax", "e.ay", "e.bx", "e.by")
    odd = f"aggregate({_edges(ring)}, false, (odd, e) -> odd != {crosses_ray('e', x, y)})"
    inner = f"if({odd}, {buffer_deg!r}D + sqrt(array_min(transform({_edges(ring)}, e -> {to_edge}))), 0D) * 0.999999D - 1e-12D"
    outer = f"({buffer_deg!r}D + sqrt(array_max(transform({ring}, p -> (p.lon - {x}) * (p.lon - {x}) + (p.lat - {y}) * (p.lat - {y}))))) * 1.000001D + 1e-12D"
    return f"named_struct('in_sq', {_let(inner, 'r', 'if(r > 0, r * r, -1D)')}, 'out_sq', {_let(outer, 'r', 'r * r')})"


def segment_near_edge(ax: str, ay: str, bx: str, by: str, e: str, buffer_deg: float) -> str:
    """A segment that crosses the edge ``e`` or comes within ``buffer_deg`` planar degrees of it."""

    def left(x: str, y: str) -> str:
        return f"signum(({e}.bx - {e}.ax) * ({y} - {e}.ay) - ({e}.by - {e}.ay) * ({x} - {e}.ax))"

    def own(x: str, y: str) -> str:
        return f"signum(({bx} - {ax}) * ({y} - {ay}) - ({by} - {ay}) * ({x} - {ax}))"

    crosses = f"({left(ax, ay)} * {left(bx, by)} < 0 and {own(f'{e}.ax', f'{e}.ay')} * {own(f'{e}.bx', f'{e}.by')} < 0)"
    near = " or ".join(
        f"{d} <= {buffer_deg * buffer_deg!r}D" for d in (
            _point_segment_sq(ax, ay, f"{e}.ax", f"{e}.ay", f"{e}.bx", f"{e}.by"), _point_segment_sq(bx, by, f"{e}.ax", f"{e}.ay", f"{e}.bx", f"{e}.by"),
            _point_segment_sq(f"{e}.ax", f"{e}.ay", ax, ay, bx, by), _point_segment_sq(f"{e}.bx", f"{e}.by", ax, ay, bx, by),
        )
    )
    return f"({crosses} or {near})"


def segment_near_ring(ax: str, ay: str, bx: str, by: str, ring: str, buffer_deg: float) -> Column:
    """A segment that lies inside the outline, crosses it, or comes within ``buffer_deg`` planar degrees of it."""
    near = segment_near_edge(ax, ay, bx, by, "e", buffer_deg)
    return F.expr(f"exists({_edges(ring)}, e -> {near})") | point_in_ring(ax, ay, ring)


def measured(ax: str, ay: str, bx: str, by: str, buffer_deg: float) -> dict[str, str]:
    """What :func:`segments_near` wants to know of each segment: squared length, and the buffer times the length."""
    sq = f"(({bx} - {ax}) * ({bx} - {ax}) + ({by} - {ay}) * ({by} - {ay}))"
    return {"sq": sq, "far": f"if({sq} > 0, {buffer_deg!r}D * sqrt({sq}), -1D)"}


def segments_near(a: tuple[str, str, str, str], a_sq: str, a_far: str, b: tuple[str, str, str, str], b_sq: str, b_far: str, buffer_deg: float) -> list[str]:
    """The same as :func:`segment_near_edge`, as three tests of which one must hold.

    Segments that do not cross are nearest at two ends, or at an end and the foot of its perpendicular on the other one. The tests
    are apart because a generated method of more than 8,000 bytes is interpreted.
    """
    limit = f"{buffer_deg * buffer_deg!r}D"

    def side(s: tuple[str, str, str, str], x: str, y: str) -> str:
        return f"(({s[2]} - {s[0]}) * ({y} - {s[1]}) - ({s[3]} - {s[1]}) * ({x} - {s[0]}))"

    def foot(s: tuple[str, str, str, str], sq: str, far: str, x: str, y: str) -> str:
        along = f"(({s[2]} - {s[0]}) * ({x} - {s[0]}) + ({s[3]} - {s[1]}) * ({y} - {s[1]}))"
        return f"(abs(2 * {along} - {sq}) <= {sq} and abs({side(s, x, y)}) <= {far})"

    ends = [(a[:2], b[:2]), (a[:2], b[2:]), (a[2:], b[:2]), (a[2:], b[2:])]
    close = [f"({p[0]} - {q[0]}) * ({p[0]} - {q[0]}) + ({p[1]} - {q[1]}) * ({p[1]} - {q[1]}) <= {limit}" for p, q in ends]
    feet = [foot(b, b_sq, b_far, *a[:2]), foot(b, b_sq, b_far, *a[2:]), foot(a, a_sq, a_far, *b[:2]), foot(a, a_sq, a_far, *b[2:])]
    crosses = f"((({side(a, *b[:2])} < 0) != ({side(a, *b[2:])} < 0)) and (({side(b, *a[:2])} < 0) != ({side(b, *a[2:])} < 0)))"
    return [f"({' or '.join(tests)})" for tests in (close, feet, [crosses])]


def _edge_lines(ring: str) -> str:
    """Edges with their inward unit normal (ring counter-clockwise)."""
    length = f"greatest(sqrt((e.bx - e.ax) * (e.bx - e.ax) + (e.by - e.ay) * (e.by - e.ay)), {TINY!r}D)"
    return (
        f"transform({_edges(ring)}, e -> named_struct('ax', e.ax, 'ay', e.ay, 'bx', e.bx, 'by', e.by,"
        f" 'nx', -(e.by - e.ay) / {length}, 'ny', (e.bx - e.ax) / {length}))"
    )


def _offset_corners(lines: str, distance: float) -> str:
    """Corner i of the inset ring: where the offset of line i-1 meets the offset of line i.

    Neighbouring edges share a corner and use the mitre point; edges that became neighbours by dropping a collapsed one
    use the general intersection of their offset lines, written relative to the start of the second edge.
    """
    previous = f"concat(slice({lines}, size({lines}), 1), slice({lines}, 1, greatest(size({lines}) - 1, 0)))"
    d = f"{distance!r}D"
    shares = "(p.bx = e.ax and p.by = e.ay)"
    mitre = f"({d} / greatest(1 + p.nx * e.nx + p.ny * e.ny, {TINY!r}D))"
    cross = "(p.nx * e.ny - p.ny * e.nx)"
    safe = f"if(abs({cross}) < 1e-12D, null, {cross})"
    cp = f"(p.nx * (p.ax - e.ax) + p.ny * (p.ay - e.ay) + {d})"
    return (
        f"zip_with({previous}, {lines}, (p, e) -> named_struct("
        f"'lon', if({shares}, e.ax + {mitre} * (p.nx + e.nx), e.ax + ({cp} * e.ny - {d} * p.ny) / {safe}),"
        f"'lat', if({shares}, e.ay + {mitre} * (p.ny + e.ny), e.ay + ({d} * p.nx - {cp} * e.nx) / {safe})))"
    )


def _surviving(lines: str, corners: str) -> str:
    """Lines whose inset edge still runs in the direction of the original edge."""
    here, there = f"get({corners}, i)", f"get({corners}, (i + 1) % size({corners}))"
    return (
        f"filter({lines}, (e, i) -> ({there}.lon - {here}.lon) * (e.bx - e.ax)"
        f" + ({there}.lat - {here}.lat) * (e.by - e.ay) > 0)"
    )


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` for a value that is computed once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _less_one(lines: str, distance: float) -> str:
    """The lines without the next one to vanish on the way to ``distance``; all of them if none does.

    Neighbours on one line are one line. Neighbours that run against each other have met, and both go. Otherwise each edge
    shrinks evenly, and the first whose length reaches nothing goes.
    """
    cross = "(p.nx * e.ny - p.ny * e.nx)"
    previous = f"concat(slice({lines}, size({lines}), 1), slice({lines}, 1, size({lines}) - 1))"
    kinds = (
        f"zip_with({previous}, {lines}, (p, e) -> case when abs({cross}) > 1e-9D then 0 when p.nx * e.nx + p.ny * e.ny > 0 then 1 else 2 end)"
    )
    parallel = f"filter({lines}, (l, i) -> not (i = _at and get(_kinds, _at) > 0) and not (get(_kinds, _at) = 2 and i = pmod(_at - 1, size({lines}))))"

    def length(corners: str) -> str:
        here, there = f"get({corners}, i)", f"get({corners}, (i + 1) % size({lines}))"
        return f"(({there}.lon - {here}.lon) * e.ny - ({there}.lat - {here}.lat) * e.nx)"

    # Along an edge whose inward normal is (nx, ny) one moves by (ny, -nx).
    events = (
        f"transform({lines}, (e, i) -> if({length('_near')} > 0, null,"
        f" named_struct('t', {length('_own')} / greatest({length('_own')} - {length('_near')}, {TINY!r}D), 'i', i)))"
    )
    vanish = _let(f"array_min({events})", "_next", f"if(_next is null, {lines}, filter({lines}, (l, i) -> i <> _next.i))")
    shrink = _let(_offset_corners(lines, distance), "_near", _let(_offset_corners(lines, 0.0), "_own", vanish))
    step = _let("cast(array_position(transform(_kinds, k -> k > 0), true) as int) - 1", "_at", f"if(_at >= 0, {parallel}, {shrink})")
    return f"if(size({lines}) < 3, {lines}, {_let(kinds, '_kinds', step)})"


def _inset_stages(ring: str, distance: float) -> list[tuple[str, str]]:
    """``(name, text)`` of the steps of an inset, each over the names before it; the last is the result."""
    whole = (
        "size(_l1) >= 3 and not exists(_c1, p -> p.lon is null or p.lat is null)"
        f" and size({_surviving('_l1', '_c1')}) = size(_l1)"
    )
    fewer = f"aggregate(sequence(1, 2 * size(_l0)), _l0, (_ls, _k) -> {_less_one('_ls', distance)})"
    again = f"if(size(_l1) = size(_l0), _c0, if(size(_l1) >= 3, {_offset_corners('_l1', distance)}, null))"
    return [
        ("_l0", _edge_lines(ring)),
        ("_c0", _offset_corners("_l0", distance)),
        ("_l1", f"if(size({_surviving('_l0', '_c0')}) = size(_l0), _l0, {fewer})"),
        ("_c1", again),
        ("_inset", f"if({whole}, _c1, null)"),
    ]


def with_inset_ring(df: DataFrame, ring: str, out: str, distance: float = ROOF_INSET_DEG) -> DataFrame:
    """Add the outline shrunk by ``distance`` degrees, or NULL when nothing is left of it.

    Edges that vanish on the way are dropped one by one, in the order in which they do, and their neighbours joined, until
    none is left that would. An outline that comes apart in several is not followed and counts as collapsed. Expects a
    clean ring.
    """
    keep = [c for c in df.columns if c != out]
    (_, l0), (_, c0), (_, l1), (_, c1), (_, inset) = _inset_stages(ring, distance)
    return steps(
        df,
        [*keep, once("_l0", l0)],
        [*keep, "_l0", once("_c0", c0)],
        [*keep, "_l0", "_c0", once("_l1", l1)],
        [*keep, "_l1", once("_c1", c1)],
        [*keep, once(out, inset)],
    )


def roof_vertices_text(ring: str, distance: float = ROOF_INSET_DEG) -> str:
    """The cardinal vertices of an outline's inset as one expression over any outline, for functions in SQL."""
    stages = [("_corners", distinct_corners(ring)), ("_ring", counter_clockwise("_corners")), *_inset_stages("_ring", distance)]
    body = _cardinal_text("_inset")
    for name, text in reversed(stages):
        body = _let(text, name, body)
    return body


def _cardinal_text(ring: str) -> str:
    """Northern, southern, eastern and western corner as ``array<struct<vertex, lon, lat>>``; ties take the smallest (lon, lat)."""

    def extreme(name: str, key: str) -> str:
        best = f"array_min(transform({ring}, p -> named_struct('k', {key}, 'lon', p.lon, 'lat', p.lat)))"
        return f"named_struct('vertex', '{name}', 'lon', {best}.lon, 'lat', {best}.lat)"

    corners = [extreme("N", "-p.lat"), extreme("S", "p.lat"), extreme("E", "-p.lon"), extreme("W", "p.lon")]
    return f"if({ring} is not null, array({', '.join(corners)}), null)"


def cardinal_vertices(ring: str) -> Column:
    return F.expr(_cardinal_text(ring))


def _finite(value: str) -> str:
    return f"({value} is not null and not isnan({value}) and abs({value}) < double('inf'))"


def _side(e: str, x: str, y: str) -> str:
    return f"signum(({e}.bx - {e}.ax) * ({y} - {e}.ay) - ({e}.by - {e}.ay) * ({x} - {e}.ax))"


def self_crossing(ring: str) -> str:
    """True if two edges meet but for the corner that neighbours share. Quadratic in the corners of one outline, never in rows."""
    proper = (
        f"({_side('e', 'g.ax', 'g.ay')} * {_side('e', 'g.bx', 'g.by')} < 0"
        f" and {_side('g', 'e.ax', 'e.ay')} * {_side('g', 'e.bx', 'e.by')} < 0)"
    )
    touch = " or ".join(
        [_on_edge("e", "g.ax", "g.ay"), _on_edge("e", "g.bx", "g.by"), _on_edge("g", "e.ax", "e.ay"), _on_edge("g", "e.bx", "e.by")]
    )
    apart = f"j > i + 1 and not (i = 0 and j = size({ring}) - 1)"
    # Neighbours that run back over each other.
    next_to = f"(j = i + 1 or (i = size({ring}) - 1 and j = 0))"
    back = (
        f"({_side('e', 'g.bx', 'g.by')} = 0 and (e.bx - e.ax) * (g.bx - g.ax) + (e.by - e.ay) * (g.by - g.ay) < 0)"
    )
    edges = _edges(ring)
    return (
        f"exists(transform({edges}, (e, i) -> exists(transform({edges}, (g, j) -> ({apart} and ({proper} or {touch}))"
        f" or ({next_to} and {back})), hit -> hit)), hit -> hit)"
    )
