"""Distance joins over a multi-resolution grid.

A distance predicate alone makes Spark compare every source with every point. Here both sides get a cell key, the join
is an equi-join on that key, and the exact distance only refines. A level is a grid of bands of equal height; within a
band the columns widen with the cosine of the latitude so that a cell stays about square, and they close at +-180
degrees. A key is one long: level, band, column.

For a nearest-k search the points within the radius may be far more than k. ``search_reach`` therefore first counts
points per cell at every level (a map-side combined aggregate) and derives for each source a distance that certainly
covers its k nearest. Only cells within that reach are joined, so the pairs follow k and not the density of the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkscout.functions import geo
from linkscout.functions.steps import steps
from linkscout.operators.skew import key_counts, skewed_join
from linkscout.operators.storage import counted, materialise

# Cell heights of the levels in km, each a quarter of the one before.
CELL_KM = (4.0, 1.0, 0.25, 0.0625, 0.015625)
LEVELS = tuple(range(len(CELL_KM)))
FINEST = LEVELS[-1]

# One km is at least 1/110 of a degree short of any degree of latitude: a band of k / 110 degrees is at least k km high.
KM_PER_DEGREE = 110.0
# Bounds of the length in km of one degree along a meridian and along the equator (WGS84, rounded outwards).
MERIDIAN_KM = (110.5, 111.7)
PARALLEL_KM = (111.2, 111.7)
POLE_CAP = 89.0

# Distances are ranked after rounding to 10 m, so a reach needs that much slack to keep ties of the k-th row.
ROUNDING_SLACK_KM = 0.0111

# Rows allowed in an explicitly broadcast side (about 100 bytes each); they are counted first.
BROADCAST_ROWS = 500_000


@dataclass(frozen=True)
class SourceStats:
    """One-row summary of a sources table, taken before planning a search."""

    rows: int
    max_limit: int
    min_radius: float
    max_radius: float

    @property
    def radius_levels(self) -> tuple[int, ...]:
        """Levels a plain radius join uses: only these need a key on the point side."""
        fitting = [max(i for i in LEVELS if i == 0 or r <= 2.5 * CELL_KM[i]) for r in (self.max_radius, self.min_radius)]
        return tuple(range(fitting[0], fitting[1] + 1))


def source_stats(sources: DataFrame, *limits: str, radius_km: str = "radius_km") -> SourceStats:
    tops = [F.max(F.col(c)).alias(f"m{i}") for i, c in enumerate(limits)]
    row = sources.agg(
        F.count(F.lit(1)).alias("n"), F.min(radius_km).alias("r0"), F.max(radius_km).alias("r1"), *tops
    ).first()
    top = max([row[f"m{i}"] or 0 for i in range(len(limits))], default=0)
    return SourceStats(row["n"], top, float(row["r0"] or 0), float(row["r1"] or 0))


# The grid arithmetic is written as SQL text: one parsed expression instead of hundreds of Column objects.
HEIGHTS = tuple(km / KM_PER_DEGREE for km in CELL_KM)
BAND_HEIGHTS = "array(" + ", ".join(f"{h!r}D" for h in HEIGHTS) + ")"


def _columns_in(band: str, height: str) -> str:
    """Number of columns of a band: as many as keep a column at least as wide as the band is high; one at a pole."""
    far = f"least(greatest(abs({band} * {height} - 90), abs(({band} + 1) * {height} - 90)), 90D)"
    return f"greatest(1L, floor(360 * cos(radians({far})) / {height}))"


def _band(lat: str, height: str) -> str:
    return f"floor(({lat} + 90) / {height})"


#: The level in a cell key.
LEVEL_OF_CELL = "cast(shiftright(cell, 46) as int)"


def _key(level: int | str, band: str, column: str) -> str:
    return f"(cast({level} as bigint) * {1 << 46}L + {band} * {1 << 23}L + {column})"


def cell_of(lon: str, lat: str, level: int) -> Column:
    """Cell key of a point at one level."""
    return F.expr(_cell_text(lon, lat, level))


def _cell_text(lon: str, lat: str, level: int) -> str:
    height = f"{HEIGHTS[level]!r}D"
    band = _band(lat, height)
    columns = _columns_in(band, height)
    return _key(level, band, f"pmod(floor(({lon} + 180) * {columns} / 360), {columns})")


def cells_of(lon: str, lat: str, levels=LEVELS) -> Column:
    return F.expr("array(" + ", ".join(_cell_text(lon, lat, level) for level in levels) + ")")


def with_cells(df: DataFrame, lon: str, lat: str, levels=LEVELS, keep: list[str] | None = None) -> DataFrame:
    """One row per level, as column ``cell``. The level is a value and not spelled out, as a long generated method is interpreted.

    With None as ``levels`` the rows carry theirs as an array ``_levels``. ``keep`` names the columns to return, or else all are.
    """
    if levels is None:
        placed = ["*", "explode(_levels) as _level"], ["*", f"get({BAND_HEIGHTS}, _level) as _height"]
    else:
        each = ", ".join(f"named_struct('_level', {level}, '_height', {HEIGHTS[level]!r}D)" for level in levels)
        placed = (["*", f"inline(array({each}))"],)
    return steps(
        df,
        *placed,
        ["*", f"{_band(lat, '_height')} as _band"],
        ["*", f"{_columns_in('_band', '_height')} as _columns"],
        [*(keep or df.columns), f"{_key('_level', '_band', f'pmod(floor(({lon} + 180) * _columns / 360), _columns)')} as cell"],
    )


def level_for(reach_km: str) -> str:
    """Finest level at which a circle of that reach spans at most six cells (about seven at the coarsest)."""
    arms = " ".join(f"when {reach_km} <= {2.5 * CELL_KM[i]!r}D then {i}" for i in reversed(LEVELS[1:]))
    return f"case {arms} else 0 end"


def _gap_km(lon: str, lat: str) -> tuple[str, str]:
    """Lower and upper bound of the distance from a source to any point of the cell ``_band``/``_raw``."""
    south, north = "(_band * _height - 90)", "((_band + 1) * _height - 90)"
    west, east = "(_raw * 360 / _columns - 180)", "((_raw + 1) * 360 / _columns - 180)"
    lat_far = f"greatest(abs({lat} - {south}), abs({lat} - {north}))"
    lat_near = f"greatest(0D, {south} - {lat}, {lat} - {north})"
    lon_far = f"greatest(abs({lon} - {west}), abs({lon} - {east}))"
    lon_near = f"greatest(0D, {west} - {lon}, {lon} - {east})"
    # The parallel is longest at the latitude nearest the equator and shortest at the one nearest the pole.
    same_side = f"(signum({south}) = signum({north}) and signum({south}) = signum({lat}))"
    low = f"if({same_side}, least(abs({south}), abs({north}), abs({lat})), 0D)"
    high = f"least(greatest(abs({south}), abs({north}), abs({lat})) + 0.25D, 90D)"
    near = (
        f"sqrt(pow({lat_near} * {MERIDIAN_KM[0]!r}D, 2) + pow({lon_near} * {PARALLEL_KM[0]!r}D * cos(radians({high})), 2))"
    )
    far = f"sqrt(pow({lat_far} * {MERIDIAN_KM[1]!r}D, 2) + pow({lon_far} * {PARALLEL_KM[1]!r}D * cos(radians({low})), 2))"
    return near, far


def cover(df: DataFrame, lon: str, lat: str, reach_km: str, level: int | None = None) -> DataFrame:
    """One row per cell that may hold a point within ``reach_km`` of each row, as column ``cell``.

    Only a circle that holds a pole touches whole rings, which are short there. Close to a pole the meridians that touch the
    circle bound it; elsewhere a plain quotient, which is a little more, does.
    """
    near, _ = _gap_km(lon, lat)
    touching = f"1.001D * degrees(asin(least(1D, sin(radians(_deg)) / greatest(cos(radians({lat})), {geo.TINY!r}D))))"
    return steps(
        df,
        ["*", f"{level_for(reach_km) if level is None else level} as _level"],
        ["*", f"get({BAND_HEIGHTS}, _level) as _height", f"{reach_km} / {KM_PER_DEGREE!r}D as _deg"],
        ["*", f"greatest(abs({lat} - _deg), abs({lat} + _deg)) as _top"],
        [
            "*",
            f"case when _top >= 90 then 180D when _top >= {POLE_CAP!r}D then {touching}"
            f" else least(180D, _deg / cos(radians(least(_top, {POLE_CAP!r}D)))) end as _half",
            f"explode(sequence(greatest(0L, {_band(f'({lat} - _deg)', '_height')}),"
            f" least({_band('90D', '_height')}, {_band(f'({lat} + _deg)', '_height')}))) as _band",
        ],
        ["*", f"{_columns_in('_band', '_height')} as _columns"],
        [
            "*",
            f"floor(({lon} - _half + 180) * _columns / 360) as _first",
            f"floor(({lon} + _half + 180) * _columns / 360) as _last",
        ],
        ["*", "explode(sequence(_first, least(_last, _first + _columns - 1))) as _raw"],
        # Near a pole the planar bound does not hold for a full circle of columns, so nothing is dropped there.
        f"_half >= 180 or {near} <= {reach_km}",
        [*df.columns, f"{_key('_level', '_band', 'pmod(_raw, _columns)')} as cell"],
    )


def box_cells(df: DataFrame, west: str, south: str, east: str, north: str, level: int) -> DataFrame:
    """One row per cell of a small box (an outline, say), as column ``cell``. A box with a corner that is no finite
    number, or outside the globe, has no cells.
    """
    height = f"{HEIGHTS[level]!r}D"
    first, last = (f"floor(({c} + 180) * _columns / 360)" for c in (west, east))
    on_globe = f"{west} between -720 and {east} and {east} <= 720 and {south} between -90 and {north} and {north} <= 90"
    return steps(
        df,
        on_globe,
        ["*", f"explode(sequence({_band(south, height)}, {_band(north, height)})) as _band"],
        ["*", f"{_columns_in('_band', height)} as _columns"],
        ["*", f"explode(sequence({first}, {last})) as _raw"],
        [*df.columns, f"{_key(level, '_band', 'pmod(_raw, _columns)')} as cell"],
    )


def near_sources(points: DataFrame, sources: DataFrame, radius_km: str = "radius_km") -> DataFrame:
    """Points in a coarse cell that some source can reach: a cheap filter before costly work on the points.

    The cells are broadcast if they were counted to be few, and shuffled otherwise.
    """
    cells, n = counted(cover(sources.select("lon", "lat", radius_km), "lon", "lat", radius_km, 0).select("cell").distinct())
    marked = points.withColumn("cell", cell_of("lon", "lat", 0))
    return marked.join(F.broadcast(cells) if n <= BROADCAST_ROWS else cells, "cell", "left_semi").drop("cell")


def cell_counts(points: DataFrame) -> DataFrame:
    """Points per kind and cell at every level: partial sums per task, then one small row per occupied cell."""
    return (
        with_cells(points.select("kind", "lon", "lat"), "lon", "lat")
        .groupBy("kind", "cell")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def search_reach(sources: DataFrame, counts: DataFrame, radius_km: str, limit: str) -> DataFrame:
    """Add ``reach_km`` <= radius: a distance that certainly covers the ``limit`` nearest points of each source.

    At every level the 25 cells around a source are looked up. Sorted by the distance of their farthest corner, the first
    ones that together hold ``limit`` points give an upper bound for the k-th distance; the best level wins. A source
    keeps at most 25 rows per level here, whatever the data.
    """
    keep = sources.columns
    own, last = _band("lat", "_height"), _band("90D", "_height")
    _, far = _gap_km("lon", "lat")
    df = steps(
        sources,
        ["*", f"posexplode({BAND_HEIGHTS}) as (_level, _height)"],
        ["*", f"explode(sequence(greatest({own} - 2, 0L), least({own} + 2, {last}))) as _band"],
        ["*", f"{_columns_in('_band', '_height')} as _columns"],
        ["*", "floor((lon + 180) * _columns / 360) as _middle", "least(2L, floor((_columns - 1) / 2)) as _spread"],
        ["*", "explode(sequence(_middle - _spread, _middle + _spread)) as _raw"],
        [*keep, "_level", f"{far} as _far", f"{_key('_level', '_band', 'pmod(_raw, _columns)')} as cell"],
    )
    df = df.join(counts, ["kind", "cell"], "left")
    df = df.groupBy(*keep).agg(
        F.expr("sort_array(collect_list(named_struct('level', _level, 'far', _far, 'n', coalesce(n, 0L))))").alias("_cells")
    )
    held = "(if(s.level = e.level, s.n, 0L) + e.n)"
    bound = (
        "aggregate(_cells, named_struct('level', -1, 'n', 0L, 'best', double('inf')), (s, e) -> named_struct("
        f"'level', e.level, 'n', {held}, 'best', if({held} >= {limit}, least(s.best, e.far), s.best)), s -> s.best)"
    )
    return df.selectExpr(*keep, f"least({radius_km}, {bound} + {ROUNDING_SLACK_KM!r}D) as reach_km")


def trim_copies(points: DataFrame, order: list[Column], max_limit: int) -> DataFrame:
    """Drop points that no nearest-k search can return because enough points at the very same place go before them.

    Points at one place have one distance, so ``order`` alone decides between them and the first ``max_limit`` suffice.
    Each task applies the limit before the shuffle, so a place of any number of points sends few rows.
    """
    place = Window.partitionBy("kind", "lon", "lat").orderBy(*order)
    return points.withColumn("_rn", F.row_number().over(place)).where(F.col("_rn") <= max_limit).drop("_rn")


def levels_used(cells: DataFrame, also: tuple[str, ...]) -> DataFrame:
    """``(also, _levels)``: the levels of the sources' cells, at most one row per value of ``also``."""
    return cells.groupBy(*also).agg(F.collect_set(F.expr(LEVEL_OF_CELL)).alias("_levels"))


def _refine(pairs: DataFrame, radius_km: str, inclusive: bool) -> DataFrame:
    helpers = [*geo.geodetic_columns("s"), *geo.geodetic_columns("p"), "cell"]
    within = f"dist_m {'<=' if inclusive else '<'} {radius_km} * 1000"
    return geo.with_geodesic(pairs, "s", "p", "dist_m").where(within).drop(*helpers)


def radius_join(
    sources: DataFrame, points: DataFrame, radius_km: str = "radius_km", inclusive: bool = False,
    stats: SourceStats | None = None, reach_km: str | None = None, also: tuple[str, ...] = (), counts: DataFrame | None = None,
) -> DataFrame:
    """All (source, point) pairs closer than the radius of the source, with ``dist_m``.

    Both sides need ``lon`` and ``lat``; the point's come back as ``p_lon`` and ``p_lat``. ``also`` names further columns
    both sides must agree on. The cells of the sources are counted and broadcast if they are few; otherwise both sides
    shuffle on the cell key, and cells that hold many points or are reached by many sources are split. With ``reach_km`` a point
    gets only the cells of levels that some source (of the same ``also``) looks at. ``counts`` are the points per key and cell, if
    known: ``(also, cell, _n)``.
    """
    stats = stats or source_stats(sources, radius_km=radius_km)
    left, n = counted(cover(geo.with_geodetic(sources, "lon", "lat", "s"), "lon", "lat", reach_km or radius_km))
    right = points.withColumnsRenamed({"lon": "p_lon", "lat": "p_lat"})
    # Many pairs share a point in a plain join; in a nearest-k search they are few, and the columns would only be shuffled.
    late = reach_km is not None and n > BROADCAST_ROWS
    if not late:
        right = geo.with_geodetic(right, "p_lon", "p_lat", "p")
    keys = [*also, "cell"]
    used, n_used = counted(levels_used(left, also)) if reach_km else (None, 0)
    if reach_km and n_used <= BROADCAST_ROWS:
        used, columns = F.broadcast(used), right.columns
        right = with_cells(right.join(used, list(also)) if also else right.crossJoin(used), "p_lon", "p_lat", None, columns)
        if counts is not None and also:
            counts = counts.join(used, list(also)).where(f"array_contains(_levels, {LEVEL_OF_CELL})").drop("_levels")
    else:
        right = with_cells(right, "p_lon", "p_lat", LEVELS if reach_km else stats.radius_levels)
    if n <= BROADCAST_ROWS:
        pairs = right.join(F.broadcast(left), keys)
    else:
        # Written, as hot keys are looked up in them again.
        reaching = materialise(key_counts(left, keys))
        pairs = skewed_join(right, left, keys, left_counts=counts, right_counts=reaching)
    if late:
        pairs = geo.with_geodetic(pairs, "p_lon", "p_lat", "p")
    return _refine(pairs, radius_km, inclusive)


def nearest_within(
    sources: DataFrame, points: DataFrame, tie: list[str], inclusive: bool = False, stats: SourceStats | None = None,
) -> DataFrame:
    """For each source and kind the nearest points within its radius, by the rounded distance, then ``tie``.

    ``sources`` has site_id, kind, lon, lat, radius_km and top (the row limit); ``points`` has kind, lon, lat and its own
    columns. Adds ``cand_dist_km``. The way is the same at every size: points at one place are cut to those that can be
    returned, cells are counted, and only cells within the reach of a source are joined.
    """
    stats = stats or source_stats(sources, "top")
    sources = sources.select("site_id", "kind", "lon", "lat", "radius_km", "top").where("top > 0")
    order = [F.col(c).asc_nulls_first() for c in tie]
    points = materialise(trim_copies(points, order, stats.max_limit))
    counts = materialise(cell_counts(points))
    reached = search_reach(sources, counts, "radius_km", "top")
    known = counts.withColumnRenamed("n", "_n")
    pairs = radius_join(reached, points, "radius_km", inclusive, stats, "reach_km", ("kind",), known)
    nearest = Window.partitionBy("site_id", "kind").orderBy("cand_dist_km", *order)
    return (
        pairs.withColumn("cand_dist_km", geo.metres_to_km(F.col("dist_m")))
        .withColumn("_rn", F.row_number().over(nearest))
        .where((F.col("_rn") <= stats.max_limit) & (F.col("_rn") <= F.col("top")))
        .drop("_rn", "dist_m", "lon", "lat", "radius_km", "top", "reach_km")
    )
