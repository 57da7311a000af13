"""Lines and areas near outlines: segments in grid cells, areas filled cell by cell, one owner cell per pair.

A shape is ``paths``, an array of arrays of (lon, lat), with a ``kind``: the paths of a line, or the rings of an area, whose
inside follows the even-odd rule, so holes and several parts need no further mark. All distances are planar degrees. A shape
of any size becomes rows: pieces of its edges no longer than a cell, and, for an area, the cells whose centre is inside. No
task holds a whole shape against a whole outline table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkscout.functions import geo
from linkscout.functions.steps import steps
from linkscout.operators import grid, near
from linkscout.operators.skew import cogrouped, skewed_join
from linkscout.operators.storage import counted, materialise, observed

LINE, AREA = "line", "area"
#: What is known of an outline to decide on most pairs without its edges.
DISCS = ("mid_lon", "mid_lat", "in_sq", "out_sq")
#: Grid levels for shapes, coarse to fine. A shape goes to the finest one at which it is at most MOST_ACROSS cells wide and high;
#: on the coarsest it may be of any size.
LEVELS = (0, 1, 2)
MOST_ACROSS = 64


def _height(level: int) -> str:
    return f"{grid.HEIGHTS[level]!r}D"


def grouped(shapes: DataFrame) -> tuple[DataFrame, list[int]]:
    """Equal shapes as one row: ``(shape, kind, paths, n, level)``, without corners that are no finite number; and their levels.

    Unknown kinds raise. Paths without a corner go, and so do shapes without a path.
    """
    known = F.col("kind").isin(LINE, AREA)
    kind = F.when(known, F.col("kind")).otherwise(F.raise_error(F.concat(F.lit("no shape of kind "), F.coalesce("kind", F.lit("null")))))
    finite = F.expr(
        "filter(transform(paths, path -> filter(path, p -> p.lon is not null and not isnan(p.lon) and abs(p.lon) < double('inf')"
        " and p.lat is not null and not isnan(p.lat) and abs(p.lat) < double('inf'))), path -> size(path) > 0)"
    )
    same = shapes.select(kind.alias("kind"), finite.alias("paths")).where(F.size("paths") > 0)
    same = same.groupBy("kind", "paths").agg(F.count(F.lit(1)).alias("n"))
    across = "greatest(array_max(_lons) - array_min(_lons), array_max(_lats) - array_min(_lats))"
    arms = " ".join(f"when {across} <= {MOST_ACROSS} * {_height(i)} then {i}" for i in reversed(LEVELS[1:]))
    # Numbered where they are written, so that the numbers stay.
    known = steps(
        same,
        ["*", "transform(flatten(paths), p -> p.lon) as _lons", "transform(flatten(paths), p -> p.lat) as _lats"],
        ["monotonically_increasing_id() as shape", "kind", "paths", "n", f"case {arms} else {LEVELS[0]} end as level"],
    )
    written, seen = observed(known, {f"l{i}": F.max((F.col("level") == i).cast("int")) for i in LEVELS})
    return written, [i for i in LEVELS if seen[f"l{i}"]]


def edges(shapes: DataFrame) -> DataFrame:
    """``(shape, kind, level, n, path_key, ax, ay, bx, by)`` per edge; rings are closed, a line of one corner is an edge without length.

    ``path_key`` is a hash of the path's number on the first edge of a path, and 0 on the others.
    """
    following = "concat(slice(path, 2, greatest(size(path) - 1, 0)), if(kind = 'area' or size(path) = 1, slice(path, 1, 1), array()))"
    pairs = f"zip_with(path, {following}, (a, b) -> named_struct('ax', a.lon, 'ay', a.lat, 'bx', b.lon, 'by', b.lat))"
    kept = f"filter({pairs}, e -> e.bx is not null and (kind = 'line' or e.ax <> e.bx or e.ay <> e.by))"
    return steps(
        shapes,
        ["shape", "kind", "level", "n", "posexplode(paths) as (path_no, path)"],
        ["shape", "kind", "level", "n", "path_no", f"posexplode({kept}) as (edge_no, e)"],
        ["shape", "kind", "level", "n", "if(edge_no = 0, xxhash64(path_no), 0L) as path_key", "e.*"],
    )


def pieces(edge_rows: DataFrame, level: int, reach: tuple[float, float, float, float] = (0.0, 0.0, 0.0, 0.0)) -> DataFrame:
    """Each edge cut into pieces no longer than a cell, once per cell that a piece's box meets; ``k`` numbers an edge's pieces.

    Neighbouring pieces share their corner to the last bit: both compute it alike. The edge stays beside the piece. ``reach``
    grows the boxes to the west, south, east and north before the cells are taken.
    """
    def at(k: str, a: str, b: str) -> str:
        return f"if({k} = _n, {b}, {a} + ({b} - {a}) * ({k} / _n))"

    cut = steps(
        edge_rows,
        ["*", f"cast(greatest(1, ceil(greatest(abs(bx - ax), abs(by - ay)) / {_height(level)})) as int) as _n"],
        ["*", "explode(sequence(0, _n - 1)) as _k"],
        [*edge_rows.columns, "_k as k", *[f"{at(k, f'a{c}', f'b{c}')} as {p}{c}" for p, k in (("p", "_k"), ("q", "(_k + 1)")) for c in "xy"]],
        ["*", "least(px, qx) as p_west", "least(py, qy) as p_south", "greatest(px, qx) as p_east", "greatest(py, qy) as p_north"],
    )
    sides = [f"(p_{c} {sign} {r!r}D)" for c, sign, r in zip(("west", "south", "east", "north"), "--++", reach)]
    return grid.box_cells(cut, *sides, level)


def _near(rows: DataFrame, n_rows: int, cells: DataFrame, n_cells: int, buffer_deg: float, level: int) -> DataFrame:
    """``(buildingid, shape)``: pairs with an edge inside or within ``buffer_deg`` of the outline.

    A piece and an outline that share several cells are compared only in the one that holds the south-west corner of what
    their boxes have in common.
    """
    met = skewed_join(rows, cells, ["cell"], left_counts=n_rows, right_counts=n_cells).where(
        "p_west <= east and west <= p_east and p_south <= north and south <= p_north"
    )
    met = met.withColumns({"_x": F.greatest("west", "p_west"), "_y": F.greatest("south", "p_south")})
    met = met.where(F.col("cell") == grid.cell_of("_x", "_y", level))
    return met.where(geo.segment_near_ring("px", "py", "qx", "qy", "ring", buffer_deg)).select("buildingid", "shape")


def filled(edge_rows: DataFrame, level: int, wrapped: bool = True) -> DataFrame:
    """``(shape, n, cell)``: cells whose centre is inside an area; ``wrapped`` closes the columns at the antimeridian.

    Each edge gives the places at which it crosses the centre lines of the bands it spans; per area and band these are sorted
    and taken in pairs, between which the columns lie inside.
    """
    height = _height(level)
    crossings = steps(
        edge_rows.where(F.col("kind") == AREA),
        ["*", f"floor((least(ay, by) + 90) / {height}) as _b0", f"floor((greatest(ay, by) + 90) / {height}) as _b1"],
        ["*", "explode(sequence(_b0, _b1)) as _band"],
        ["*", f"((_band + 0.5D) * {height} - 90) as _mid"],
        "(ay > _mid) != (by > _mid)",
        ["shape", "n", "_band", f"{_crossing_lon('_mid')} as _x"],
    )
    rows = crossings.groupBy("shape", "n", "_band").agg(F.sort_array(F.collect_list("_x")).alias("_xs"))
    return steps(
        rows,
        ["shape", "n", "_band", f"{grid._columns_in('_band', height)} as _columns", "inline(transform(sequence(0, size(_xs) - 2, 2),"
         " i -> named_struct('_x0', get(_xs, i), '_x1', get(_xs, i + 1))))"],
        ["*", "ceil((_x0 + 180) * _columns / 360 - 0.5D) as _first", "ceil((_x1 + 180) * _columns / 360 - 0.5D) - 1 as _last"],
        "_first <= _last",
        ["shape", "n", "_band", "_columns", "explode(sequence(_first, _last)) as _raw"],
        ["shape", "n", f"{grid._key(level, '_band', 'pmod(_raw, _columns)' if wrapped else '_raw')} as cell"],
    )


def _crossing_lon(lat: str) -> str:
    return f"(ax + ({lat} - ay) * (bx - ax) / (by - ay))"


def _from_centre(corners: DataFrame, keep: list[str], level: int) -> DataFrame:
    """``keep`` of rows with a point ``(x, y)``, and the centre ``(_centre, _mid)`` of the cell that the point lies in."""
    height = _height(level)
    return steps(
        corners,
        ["*", f"{grid._band('y', height)} as _band"],
        ["*", f"{grid._columns_in('_band', height)} as _columns", f"((_band + 0.5D) * {height} - 90) as _mid"],
        [*keep, "_mid", "((floor((x + 180) * _columns / 360) + 0.5D) * 360 / _columns - 180) as _centre"],
    )


def _flips() -> tuple[str, str]:
    """Whether a piece is crossed on the way from the cell's centre along the centre line, and then north or south to ``(x, y)``."""
    lon, lat = _crossing_lon("_mid"), "(ay + (x - ax) * (by - ay) / (bx - ax))"
    along = f"((py > _mid) != (qy > _mid) and ({lon} <= _centre) != ({lon} <= x))"
    across = f"((px > x) != (qx > x) and ({lat} <= _mid) != ({lat} <= y))"
    return along, across


def _inside(rows: DataFrame, n_rows: int, edge_rows: DataFrame, corners: DataFrame, n_corners: int, level: int) -> DataFrame:
    """``(buildingid, shape)``: areas that hold the corner ``(x, y)`` of an outline.

    The corner is on the side of its cell's centre, if the way there (along the centre line, then north or south) crosses
    the area's edges an even number of times. Only edges in that cell can be on the way.
    """
    placed = _from_centre(corners.withColumn("cell", grid.cell_of("x", "y", level)), ["buildingid", "cell", "x", "y"], level)
    along, across = _flips()
    areas = rows.where(F.col("kind") == AREA).select("shape", "cell", "ax", "ay", "bx", "by", "px", "py", "qx", "qy")
    turns = skewed_join(areas, placed, ["cell"], left_counts=n_rows, right_counts=n_corners).selectExpr(
        "buildingid", "shape", f"if({along}, 1, 0) + if({across}, 1, 0) as odd"
    ).where("odd > 0")
    inner, n_inner = counted(filled(edge_rows, level))
    centred = skewed_join(inner, placed, ["cell"], left_counts=n_inner, right_counts=n_corners).selectExpr("buildingid", "shape", "1 as odd")
    return turns.unionByName(centred).groupBy("buildingid", "shape").agg(F.sum("odd").alias("odd")).where("odd % 2 = 1").drop("odd")


def grown_boxes(outlines: DataFrame, buffer_deg: float) -> DataFrame:
    """Outlines (buildingid and a clean ``ring``) with their boxes grown by ``buffer_deg``, written.

    With them are the middle of the box (``mid_lon``, ``mid_lat``) and the discs around it (:func:`geo.discs`).
    """
    grown = [f"{c} {sign} {buffer_deg!r}D as {c}" for c, sign in (("west", "-"), ("south", "-"), ("east", "+"), ("north", "+"))]
    return materialise(steps(
        outlines.withColumns(geo.ring_box("ring")),
        ["*", "(west + east) / 2 as mid_lon", "(south + north) / 2 as mid_lat"],
        [*outlines.columns, *grown, "mid_lon", "mid_lat", geo.once("_discs", geo.discs("ring", "mid_lon", "mid_lat", buffer_deg))],
        [*outlines.columns, "west", "east", "south", "north", *DISCS[:2], "_discs.in_sq", "_discs.out_sq"],
    ))


def box_cells(boxes: DataFrame, level: int) -> tuple[DataFrame, int]:
    """The boxes once per cell that they meet, written, and their number."""
    return counted(grid.box_cells(boxes, "west", "south", "east", "north", level))


def placed_outlines(boxes: DataFrame, levels: list[int], buffer_deg: float) -> tuple[DataFrame, dict[int, tuple[int, tuple[float, float, float, float]]], dict[int, int]]:
    """Outlines with their first corner ``(x, y)``, ``_edges`` and per level ``fits{level}``: written.

    An outline fits a level if its grown box is on the globe and no larger than a cell, and no other row has its id. Per level
    come the number of those that fit, with how far their boxes reach east, north, west and south of the corner, and the number of
    the others.
    """
    once = boxes.select("buildingid", "ring", "west", "south", "east", "north", *DISCS).where(F.size("ring") > 0)
    several = once.groupBy("buildingid").count().where("count > 1").select(F.col("buildingid").alias("_id"), F.lit(True).alias("_several"))
    marked = once.join(several, F.col("buildingid").eqNullSafe(F.col("_id")), "left")
    size = "greatest(east - west, north - south)"
    globe = "west >= -720 and east <= 720 and south >= -90 and north <= 90 and _several is null"
    known = steps(
        marked,
        [*once.columns, "get(ring, 0).lon as x", "get(ring, 0).lat as y", f"{geo._edges('ring')} as _edges",
         *[f"coalesce({globe} and {size} <= {_height(i)}, false) as fits{i}" for i in levels]],
    )
    metrics = {}
    for i in levels:
        fits = F.col(f"fits{i}")
        metrics |= {f"n{i}": F.count(F.when(fits, 1)), f"m{i}": F.count(F.when(~fits, 1))}
        metrics |= {f"{side}{i}": F.max(F.when(fits, F.expr(far))) for side, far in (("e", "east - x"), ("u", "north - y"), ("w", "x - west"), ("s", "y - south"))}
    written, seen = observed(known, metrics)
    # A little more, as sums of these are rounded.
    reach = {i: tuple((seen[f"{side}{i}"] or 0.0) * 1.000001 + 1e-12 for side in "euws") for i in levels}
    return written, {i: (seen[f"n{i}"], reach[i]) for i in levels}, {i: seen[f"m{i}"] for i in levels}


def _counted_in_cells(
    edge_rows: DataFrame, outlines: DataFrame, n_outlines: int, reach: tuple[float, float, float, float], buffer_deg: float, level: int
) -> DataFrame:
    """``(buildingid, n)``, several rows each: shapes of one level that meet outlines which fit it; n may be negative.

    Every outline is in one cell, that of its first corner, and the pieces of the edges are in all cells whose outlines they
    can reach. So what decides on a shape and an outline meets in one cell and is put together there (:mod:`.near`). An area without an
    edge nearby holds all outlines of a cell or none, as it does the cell's centre: these are only counted, per cell. Shapes with an
    edge nearby correct that count by whether they really meet.
    """
    inner = materialise(filled(edge_rows, level, wrapped=False))
    centred = inner.select("shape", "cell", F.lit(1).alias("centre"))
    rows, n_rows = counted(pieces(edge_rows, level, reach).join(centred, ["shape", "cell"], "left").selectExpr(
        "cell", "shape", "n", "kind = 'area' as is_area", "coalesce(centre, 0) as centre", "ax", "ay", "bx", "by", "px", "py", "qx", "qy",
    ))
    homes = grid.box_cells(outlines, "x", "y", "x", "y", level)
    homes = materialise(_from_centre(homes, ["cell", "buildingid", "x", "y", "west", "south", "east", "north", *DISCS, "_edges"], level))
    corrected = cogrouped(
        rows, homes, "cell", lambda a, b: near.count_shapes(a, b, buffer_deg), near.counts_schema(homes), n_rows, n_outlines, "shape"
    )
    by_cell = inner.groupBy("cell").agg(F.sum("n").alias("n"))
    held = homes.select("cell", "buildingid").join(by_cell, "cell").select("buildingid", "n")
    return corrected.unionByName(held)


def shape_counts(boxes: DataFrame, shapes: DataFrame, buffer_deg: float) -> DataFrame:
    """``(buildingid, n)``: lines and areas that meet the outline grown by ``buffer_deg``; outlines without any are absent.

    ``boxes`` are the outlines by :func:`grown_boxes`; ``shapes`` has kind and paths. An area counts if one of its edges comes near or
    if it holds the outline. Equal shapes are one in the joins. Outlines that do not fit a cell are in all that they meet, and their
    pairs are made different after. Shapes across the antimeridian must be split there.
    """
    known, levels = grouped(shapes)
    if not levels:
        return boxes.select("buildingid", F.lit(0).cast("long").alias("n")).limit(0)
    outlines, fitting, others = placed_outlines(boxes, levels, buffer_deg)
    counts, pairs = [], []
    for level in levels:
        own = edges(known.where(F.col("level") == level))
        n_fitting, reach = fitting[level]
        if n_fitting:
            counts.append(_counted_in_cells(own, outlines.where(f"fits{level}"), n_fitting, reach, buffer_deg, level))
        if others[level]:
            large = outlines.where(f"not fits{level}")
            rows, n_rows = counted(pieces(own, level))
            reached, n_reached = box_cells(large, level)
            pairs.append(_near(rows, n_rows, reached, n_reached, buffer_deg, level))
            pairs.append(_inside(rows, n_rows, own, large.where("x is not null"), others[level], level))
    if pairs:
        found = reduce(DataFrame.unionByName, pairs).distinct()
        counts.append(found.join(known.select("shape", "n"), "shape").select("buildingid", "n"))
    if not counts:
        return boxes.select("buildingid", F.lit(0).cast("long").alias("n")).limit(0)
    return reduce(DataFrame.unionByName, counts).groupBy("buildingid").agg(F.sum("n").alias("n")).where("n > 0")
