"""Terrain along a path: points on the geodesic, elevations from tiles of a regular grid, clearance of the line of sight."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkscout.functions import geo
from linkscout.functions.geo import once
from linkscout.functions.steps import steps
from linkscout.operators.enrich import MOST_SAMPLES, array_clearance
from linkscout.operators.skew import skewed_join
from linkscout.operators.storage import counted

#: Tile keys are ``row * TILE_ROW + column`` of the tile, both of either sign.
TILE_ROW = 1 << 26
#: Posts (8 bytes each) of the tiles that a join may broadcast; they are counted first.
BROADCAST_POSTS = 2_000_000
#: Parts of paths that one task is asked to join with one tile; a part holds up to MOST_SAMPLES samples, about 10 KB.
PARTS_PER_TASK = 10_000


@dataclass(frozen=True)
class Grid:
    """Posts at ``west + column * step``, ``south + row * step`` degrees; a tile covers ``side`` by ``side`` spaces between posts."""

    west: float
    south: float
    step: float
    side: int = 16


def _tile(row: str, column: str, side: int) -> str:
    return f"(floor({row} / {side}) * {TILE_ROW}L + floor({column} / {side}))"


def tiles(posts: DataFrame, grid: Grid) -> DataFrame:
    """``(tile, elevations)`` from posts ``(row, col, elev)``: the posts of each tile with those on all its edges, row by row.

    A post on an edge stands in two tiles, on a corner in four, so every space between four posts lies in one tile. Missing
    posts are NULL; of posts at one place the lowest counts.
    """
    n, across = grid.side, grid.side + 1
    spread = steps(
        posts.select("row", "col", "elev"),
        ["*", f"explode(if(pmod(row, {n}) = 0, array(0, 1), array(0))) as _up"],
        ["*", f"explode(if(pmod(col, {n}) = 0, array(0, 1), array(0))) as _left"],
        [
            f"{_tile('(row - _up)', '(col - _left)', n)} as tile", "elev",
            f"cast((pmod(row - _up, {n}) + _up) * {across} + pmod(col - _left, {n}) + _left as int) as _at",
        ],
    )
    single = spread.groupBy("tile", "_at").agg(F.min("elev").alias("elev"))
    held = F.map_from_entries(F.collect_list(F.struct("_at", "elev")))
    cells = F.array(*[F.lit(i) for i in range(across * across)])
    return single.groupBy("tile").agg(held.alias("_held")).select(
        "tile", F.transform(cells, lambda at: F.try_element_at("_held", at)).alias("elevations")
    )


def with_path_points(df: DataFrame, a: tuple[str, str], b: tuple[str, str], out: str, samples: int) -> DataFrame:
    """Add ``out``, ``samples`` points (lon, lat) at equal distances along the geodesic from ``a`` to ``b``, ends included.

    The geodesic is the great circle of the sphere that the ellipsoid's reduced latitudes lie on; over the longest link it is
    within millimetres of the exact one. NULL if an ordinate is missing.
    """
    if not 2 <= samples <= MOST_SAMPLES:
        raise ValueError(f"a path has 2 to {MOST_SAMPLES} samples")
    flat = f"{1 - geo.FLATTENING!r}D"
    ends = []
    for i, (lon, lat) in enumerate((a, b)):
        ends += [f"radians({lon}) as _l{i}", f"atan({flat} * tan(radians({lat}))) as _b{i}"]
    vector = [f"{e} as _{c}{i}" for i in (0, 1) for c, e in (("x", f"cos(_b{i}) * cos(_l{i})"), ("y", f"cos(_b{i}) * sin(_l{i})"), ("z", f"sin(_b{i})"))]
    arc = "2 * asin(least(1D, sqrt(pow(_x0 - _x1, 2) + pow(_y0 - _y1, 2) + pow(_z0 - _z1, 2)) / 2))"
    share = f"(k / {samples - 1}D)"
    first = f"if(_arc < 1e-12D, 1 - {share}, sin((1 - {share}) * _arc) / sin(_arc))"
    second = f"if(_arc < 1e-12D, {share}, sin({share} * _arc) / sin(_arc))"
    where = ", ".join(f"'{c}', {first} * _{c}0 + {second} * _{c}1" for c in "xyz")
    turned = f"transform(sequence(0, {samples - 1}), k -> named_struct({where}))"
    degrees = (
        "transform(_turned, p -> named_struct('lon', degrees(atan2(p.y, p.x)),"
        f" 'lat', degrees(atan2(p.z, {flat} * sqrt(p.x * p.x + p.y * p.y)))))"
    )
    keep = df.columns
    return steps(
        df,
        ["*", *ends],
        [*keep, *vector],
        ["*", once("_arc", f"if(_x0 + _x1 is null, null, {arc})")],
        [*keep, "_arc", once("_turned", f"if(_arc is null, null, {turned})")],
        [*keep, once(out, degrees)],
    )


def _bilinear(side: int) -> str:
    """Elevation of sample ``p`` inside its tile, NULL if one of the four posts around it is missing."""
    def post(up: int, right: int) -> str:
        return f"get(elevations, p.at + {up * (side + 1) + right})"

    return (
        f"(1 - p.v) * ((1 - p.u) * {post(0, 0)} + p.u * {post(0, 1)}) + p.v * ((1 - p.u) * {post(1, 0)} + p.u * {post(1, 1)})"
    )


def path_elevations(
    paths: DataFrame, terrain: DataFrame, grid: Grid, keys: list[str], a: tuple[str, str], b: tuple[str, str], samples: int = MOST_SAMPLES
) -> DataFrame:
    """``(keys, elevations)``: elevations at equal distances along each path, by bilinear interpolation between posts.

    A path becomes one row per tile it touches, with its samples there, and meets the tiles by key; tiles that are few
    are broadcast, and of more those that many paths touch are split. Samples without terrain are NULL. ``keys`` name one path each. A path without ends has no row.
    """
    n, across = grid.side, grid.side + 1
    placed = (
        f"transform(_points, (p, k) -> named_struct('k', k, 'x', (p.lon - {grid.west!r}D) / {grid.step!r}D,"
        f" 'y', (p.lat - {grid.south!r}D) / {grid.step!r}D))"
    )
    local = (
        f"transform(_placed, p -> named_struct('k', p.k, 'tile', {_tile('floor(p.y)', 'floor(p.x)', n)}, 'u', p.x - floor(p.x), 'v', p.y - floor(p.y),"
        f" 'at', cast(pmod(floor(p.y), {n}) * {across} + pmod(floor(p.x), {n}) as int)))"
    )
    touched = steps(
        with_path_points(paths.select(*keys, *dict.fromkeys([*a, *b])), a, b, "_points", samples),
        "_points is not null",
        [*keys, once("_placed", placed)],
        [*keys, once("_local", local)],
        [*keys, "_local", "explode(array_distinct(transform(_local, p -> p.tile))) as tile"],
        [*keys, "tile", once("_own", "filter(_local, p -> p.tile = tile)")],
    )
    # Terrain under the paths alone; in a small area all paths meet few tiles, which need no shuffle of the samples.
    held, n_held = counted(terrain.join(touched.select("tile").distinct(), "tile", "left_semi"))
    if n_held * across * across <= BROADCAST_POSTS:
        met = touched.join(F.broadcast(held), "tile", "left")
    else:
        met = skewed_join(touched, held, ["tile"], "left", PARTS_PER_TASK)
    found = f"transform(_own, p -> named_struct('k', p.k, 'e', {_bilinear(n)}))"
    parts = met.select(*keys, F.expr(found).alias("_part"))
    whole = F.sort_array(F.flatten(F.collect_list("_part")))
    return parts.groupBy(*keys).agg(F.transform(whole, lambda s: s.getField("e")).alias("elevations"))


def path_clearance(elevations: Column) -> Column:
    """Smallest gap between the line from first to last sample and the terrain; NULL where part of the terrain is unknown."""
    return F.when(~F.exists(elevations, lambda e: e.isNull()), array_clearance(elevations))
