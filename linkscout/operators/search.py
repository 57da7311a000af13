"""Candidate searches: buildings, towers and real estate around each search site."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkscout import schemas
from linkscout.functions import geo
from linkscout.operators import grid
from linkscout.operators.grid import SourceStats
from linkscout.operators.skew import key_counts, skewed_join
from linkscout.operators.storage import counted

DEFAULT_HEIGHT_M = 30.0
ROOF_LEVEL = 2

# Eligible tower types and the provider names that make a tower lit.
TOWER_TYPES = ("TW", "RT")
LIT_PROVIDERS = ("%FPL%", "%CROWN CASTLE%", "%LIGHTOWER%")


def eligible_towers(sites: DataFrame) -> DataFrame:
    """Towers and rooftops that are marketed outside and have open space."""
    return sites.where(
        F.col("s_bu_type_code").isin(*TOWER_TYPES) & (F.col("s_external_flag") == 1) & F.col("s_open_space").isNotNull()
    )


def lit_provider(provider: Column) -> Column:
    return reduce(lambda a, b: a | b, [provider.like(p) for p in LIT_PROVIDERS])


def lit_units(scrub: DataFrame) -> DataFrame:
    """Scrub rows whose fibre provider counts as lit (case-sensitive)."""
    return scrub.where(lit_provider(F.col("fiber_provider")))


def lit_towers(sites: DataFrame, scrub: DataFrame) -> DataFrame:
    """Sites with at least one lit scrub row."""
    return sites.join(lit_units(scrub).select("bus_unit"), F.col("s_bus_unit") == F.col("bus_unit"), "left_semi")


def roof_points(buildings: DataFrame, keep: int | None = None, owners: DataFrame | None = None) -> DataFrame:
    """Roof vertices of each building.

    Building o gets the four cardinal vertices of every building x of the same name whose location lies in o's outline
    (usually o itself). Name alone may be shared by any number of buildings, so the join key is the name plus the grid cell
    of the location: pairs are only formed where outlines and locations meet.

    ``keep`` is the largest row limit of a nearest-k search that will read the result, which ranks equal distances by id as
    text, vertex and x. Of buildings of one name, place and outline, and of vertices from one name and place, only the
    first ``keep`` in that order can then matter. The others go before the join, by a limit that each task applies first.
    ``owners`` narrows the buildings o (not x).
    """

    def named(df: DataFrame, *more: str) -> DataFrame:
        known = df.where(F.col("name").isNotNull()).select("buildingid", "name", "lon", "lat", "ring", *more)
        return geo.with_clean_ring(known)

    def first(df: DataFrame, same: list[str], order: Column) -> DataFrame:
        if keep is None:
            return df
        place = Window.partitionBy(*same).orderBy(order)
        return df.withColumn("_rn", F.row_number().over(place)).where(F.col("_rn") <= keep).drop("_rn")

    outlines = first(
        named(buildings if owners is None else owners), ["name", "lon", "lat", "ring"], F.col("buildingid").cast("string").asc()
    )
    o, n_cells = counted(grid.box_cells(
        outlines.withColumns(geo.ring_box("ring")), "west", "south", "east", "north", ROOF_LEVEL
    ).drop("west", "south", "east", "north"))
    # Roofs are inset only where an outline of their name reaches.
    keys = ["name", "cell"]
    placed = buildings.where(F.col("name").isNotNull()).withColumn("cell", grid.cell_of("lon", "lat", ROOF_LEVEL))
    reached = named(placed.join(o.select(*keys).distinct(), keys, "left_semi"), "cell")
    x = geo.with_inset_ring(reached, "ring", "inset").select(
        *keys,
        F.col("buildingid").alias("x_id"),
        F.col("lon").alias("x_lon"),
        F.col("lat").alias("x_lat"),
        geo.cardinal_vertices("inset").alias("vertices"),
    )
    x = first(x.where(F.col("vertices").isNotNull()), ["name", "x_lon", "x_lat"], F.col("x_id").asc())
    matched = skewed_join(o, x, keys, left_counts=n_cells, right_counts=key_counts(placed, keys)).where(
        geo.point_in_ring("x_lon", "x_lat", "ring")
    )
    return matched.select("buildingid", "lon", "lat", "x_id", F.inline("vertices").alias("vertex", "v_lon", "v_lat"))


# ---------------------------------------------------------------- points and limits per candidate type
# All candidate types share one point layout, so that a whole search is one pass: kind, id, lon and lat the distance is
# measured from, the reported out_lon, out_lat, height and vertex, and seq as a last tie-break.


def _points(
    df: DataFrame, kind: str, identity: str, lon: str, lat: str, out_lon: str, out_lat: str, height: str,
    vertex: str = "null", seq: str = "null",
) -> DataFrame:
    return df.selectExpr(
        f"'{kind}' as kind", f"cast({identity} as string) as id", f"cast({lon} as double) as lon",
        f"cast({lat} as double) as lat", f"cast({out_lon} as double) as out_lon", f"cast({out_lat} as double) as out_lat",
        f"cast({height} as double) as height", f"cast({vertex} as string) as vertex", f"cast({seq} as bigint) as seq",
    )


def lit_points(buildings: DataFrame, sources: DataFrame, stats: SourceStats) -> DataFrame:
    """Roof vertices; distance from the building's location, position from the vertex, height always 30 m."""
    near = grid.near_sources(buildings, sources)
    roofs = roof_points(buildings, stats.max_limit, owners=near)
    return _points(
        roofs, "ospi", "buildingid", "lon", "lat", "v_lon", "v_lat", str(DEFAULT_HEIGHT_M), "vertex", "x_id"
    )


def asd_points(estates: DataFrame) -> DataFrame:
    """Real estate A: distance from the geometry, reported position from the attribute columns."""
    return _points(estates, "re_asd", "mastersiteid", "lon", "lat", "londec", "latdec", "height")


def mgt_points(estates: DataFrame, epsg: int = 3857) -> DataFrame:
    """Real estate B, whose geometry is stored in another coordinate system."""
    lon, lat = geo.to_wgs84(F.col("geom_x"), F.col("geom_y"), epsg)
    placed = estates.withColumns({"lon": lon, "lat": lat})
    return _points(placed, "re_mgt", "esri_prinx", "lon", "lat", "lng_num", "lat_num", "bld_hgt_num")


def tower_points(sites: DataFrame, scrub: DataFrame | None, kind: str = "cci_sites") -> DataFrame:
    """Eligible towers; with ``scrub`` given only lit ones."""
    towers = eligible_towers(sites)
    if scrub is not None:
        towers = lit_towers(towers, scrub)
    return _points(
        towers, kind, "s_bus_unit", "s_long_dec", "s_lat_dec", "s_long_dec", "s_lat_dec", "s_hgt_no_appurt"
    )


def _limited(sources: DataFrame, limits: dict[str, str], wanted: dict[str, str] | None = None) -> DataFrame:
    """One row per site and candidate type it searches, with the row limit as ``top``."""
    kinds = [
        f"if({(wanted or {}).get(kind, 'true')}, named_struct('kind', '{kind}', 'top', {limit}), null)"
        for kind, limit in limits.items()
    ]
    return sources.selectExpr(
        "site_id", "lon", "lat", "radius_km", f"inline(array_compact(array({', '.join(kinds)}))) as (kind, top)"
    )


def _search(sources: DataFrame, points: DataFrame, inclusive: bool, stats: SourceStats) -> DataFrame:
    found = grid.nearest_within(sources, points, ["id", "vertex", "seq"], inclusive, stats)
    return schemas.conform(
        found.selectExpr(
            "site_id", f"if(kind = '{LIT_TOWER}', 'cci_sites', kind) as candidate_type", "id", "cand_dist_km",
            "out_lon as long", "out_lat as lat", "height", "vertex",
        ),
        schemas.CANDIDATES,
    )


LIT_TOWER = "cci_sites_lit"


def lit_search(sources: DataFrame, buildings: DataFrame, inclusive: bool = False) -> DataFrame:
    """Nearest roof vertices of buildings within the radius. The limit counts vertices; the distance is the building's."""
    stats = grid.source_stats(sources, "lit_limit")
    wanted = _limited(sources, {"ospi": "lit_limit"})
    return _search(wanted, lit_points(buildings, sources, stats), inclusive, stats)


def asd_search(sources: DataFrame, estates: DataFrame, inclusive: bool = False) -> DataFrame:
    stats = grid.source_stats(sources, "re_limit")
    return _search(_limited(sources, {"re_asd": "re_limit"}), asd_points(estates), inclusive, stats)


def mgt_search(sources: DataFrame, estates: DataFrame, inclusive: bool = False) -> DataFrame:
    stats = grid.source_stats(sources, "re_limit")
    return _search(_limited(sources, {"re_mgt": "re_limit"}), mgt_points(estates), inclusive, stats)


def tower_search(sources: DataFrame, sites: DataFrame, scrub: DataFrame | None, inclusive: bool = False) -> DataFrame:
    """Nearest eligible towers; with ``scrub`` given only lit ones."""
    stats = grid.source_stats(sources, "cci_limit")
    wanted = _limited(sources, {"cci_sites": "cci_limit"})
    return _search(wanted, tower_points(sites, scrub), inclusive, stats)


def initial_search(
    sources: DataFrame, buildings: DataFrame, asd: DataFrame, mgt: DataFrame, sites: DataFrame, scrub: DataFrame
) -> DataFrame:
    """All candidates of each search site in one table; missing heights become 30 m.

    Sites that ask for non-lit results also get the two real-estate sources and towers of any provider. All types go
    through one search: the type is part of the join key and of the top-k groups.
    """
    stats = grid.source_stats(sources, "lit_limit", "re_limit", "cci_limit")
    points = reduce(
        DataFrame.unionByName,
        [
            lit_points(buildings, sources, stats),
            asd_points(asd),
            mgt_points(mgt),
            tower_points(sites, None),
            tower_points(sites, scrub, LIT_TOWER),
        ],
    )
    limits = {
        "ospi": "lit_limit", "re_asd": "re_limit", "re_mgt": "re_limit", "cci_sites": "cci_limit", LIT_TOWER: "cci_limit",
    }
    open_only = dict.fromkeys(("re_asd", "re_mgt", "cci_sites"), "include_non_lit")
    wanted = _limited(sources, limits, {**open_only, LIT_TOWER: "not include_non_lit"})
    found = _search(wanted, points, False, stats)
    return found.fillna({"height": DEFAULT_HEIGHT_M})


def with_geometry(candidates: DataFrame) -> DataFrame:
    """Add ``pnt_geom``, the roof corner of a building candidate as text; other candidates carry none."""
    point = geo.point_wkt(F.col("long"), F.col("lat"))
    return candidates.withColumn("pnt_geom", F.when(F.col("candidate_type") == "ospi", point))


def with_sequence(candidates: DataFrame) -> DataFrame:
    """Number the candidates of a site in search order (``cand_seq``); at most the sum of the site's limits."""
    order = F.array_position(F.array(*[F.lit(t) for t in schemas.CANDIDATE_TYPES]), F.col("candidate_type"))
    window = Window.partitionBy("site_id").orderBy(
        order, "cand_dist_km", "id", F.col("vertex").asc_nulls_first(), "long", "lat"
    )
    return candidates.withColumn("cand_seq", F.row_number().over(window).cast("long"))


def ids_by_type(candidates: DataFrame) -> DataFrame:
    """Candidate ids per site and type, in search order, and their number (bounded by the search limits)."""
    return (
        with_sequence(candidates)
        .groupBy("site_id", "candidate_type")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.array_join(
                F.transform(F.sort_array(F.collect_list(F.struct("cand_seq", "id"))), lambda p: p.id), ","
            ).alias("ids"),
        )
    )


def type_flags(candidates: DataFrame) -> DataFrame:
    """Which candidate types each site has."""
    return candidates.groupBy("site_id").agg(
        *[F.max(F.col("candidate_type") == t).alias(f"has_{t}") for t in schemas.CANDIDATE_TYPES]
    )


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Rows per site after each stage."""
    parts = [df.select("site_id", F.lit(name).alias("stage")) for name, df in stages.items()]
    return reduce(DataFrame.unionByName, parts).groupBy("site_id", "stage").agg(F.count(F.lit(1)).alias("n"))
