"""Every query by name. Each takes (spark, data directory) and returns a DataFrame over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkscout.functions import colours, geo, text
from linkscout.operators import (
    buildings as bld, classify, enrich, grid, links, outputs, parameters, rank, ranker, search, terrain,
)
from linkscout.operators.skew import key_counts
from linkscout.operators.storage import materialise
from linkscout.plans import site_search, sql_functions
from linkscout.sources import readers
from linkscout.sources.fixtures import Fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

MAP_EXTENT = (-8243000.0, 4970000.0, -8230000.0, 4985000.0)


def query(fn: Callable[["Data"], DataFrame]) -> Callable[["Data"], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Data(spark, sf_dir))
    return fn


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: geo.round_half_up(F.col(n), digits) for n in names})


class Data:
    """Input tables of one data directory, in the shape the operators expect."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.fx = spark, Fixtures(spark, sf_dir)

    def __getitem__(self, name: str) -> DataFrame:
        return self.fx[f"fx_{name}"]

    @property
    def sources(self) -> DataFrame:
        return parameters.with_parameters(self["sources"])

    def outlined(self, name: str) -> DataFrame:
        corners = [geo.point_struct(F.col(f"x{i}"), F.col(f"y{i}")) for i in range(4)]
        return self[name].withColumn("ring", F.array(*corners)).drop(*[f"{a}{i}" for a in "xy" for i in range(4)])

    @property
    def buildings(self) -> DataFrame:
        return self.outlined("buildings")

    @property
    def licences(self) -> DataFrame:
        """Licences with the paths of those that are no points; the hole of an area is half as wide and high."""
        def path(corners: list[tuple[Column, Column]]) -> Column:
            return F.array(*[geo.point_struct(x, y) for x, y in corners])

        corners = [(F.col(f"x{i}"), F.col(f"y{i}")) for i in range(4)]
        hole = path([(x / 2 + F.col("lon") / 2, y / 2 + F.col("lat") / 2) for x, y in corners])
        ring = F.array(path(corners))
        paths = F.when(F.col("kind") == "line", F.array(path(corners[:3])))
        paths = paths.when(F.col("has_hole") == 1, F.concat(ring, F.array(hole))).when(F.col("kind") == "area", ring)
        return self["fcc"].select("license_id", "kind", "lon", "lat", paths.alias("paths"))

    @property
    def clearance(self) -> DataFrame:
        return enrich.profile_clearance(self["profiles"], ["profile_id"])

    def candidates(self) -> DataFrame:
        return search.initial_search(
            self.sources, self.buildings, self["asd"], self["mgt"], self["cci_sites"], self["scrub"]
        )

    def tables(self) -> site_search.Tables:
        return site_search.Tables(
            self.sources, self.buildings, self["asd"], self["mgt"], self["cci_sites"], self["scrub"], self["lit"],
            self.licences, self["rankings"], self["link_budget"], self.clearance,
        )

    def with_profile(self, candidates: DataFrame) -> DataFrame:
        """The test profiles stand for many paths: each candidate id reads one of them, and every profile is read."""
        n = self["masts"].agg(F.max("profile_id") + 1).scalar()
        return candidates.withColumn("_n", n).withColumn("profile_id", F.col("id").cast("bigint") % F.col("_n")).drop("_n")

    def cleared(self) -> DataFrame:
        t = self.tables()
        return site_search.clear_paths(t, self.with_profile(site_search.find_candidates(t)), ["profile_id"])

    def run(self) -> site_search.Result:
        t = self.tables()
        return site_search.qualify(t, self.cleared(), ["candidate_type", "id"])


# ---------------------------------------------------------------- scans


@query
def building_scan(d: Data) -> DataFrame:
    return rounded(d["buildings"].select("buildingid", "name", "clli", "street", "city", "state", "building_type", "pop_tf", "lon", "lat"), 9, "lon", "lat")


@query
def building_sample(d: Data) -> DataFrame:
    return readers.building_sample(d["buildings"])


@query
def query_to_table(d: Data) -> DataFrame:
    text_ = "select state, count(*) as n, count(name) as named from {buildings} group by state"
    return readers.query(d.spark, text_, {"buildings": d["buildings"]})


@query
def decoded_points(d: Data) -> DataFrame:
    return readers.query_points(
        d.spark, "select point_id, pnt_geom from {points}", {"points": d["hex_points"]}, "pnt_geom"
    )


@query
def decoded_shapes(d: Data) -> DataFrame:
    parts = readers.query_shapes(d.spark, "select shape_id, geom from {shapes}", {"shapes": d["hex_shapes"]}, "geom")
    corners = F.transform(F.flatten("paths"), lambda p: F.format_string("%.12f %.12f", p.lon, p.lat))
    return parts.select("shape_id", "srid", "part", "kind", F.array_join(corners, ", ").alias("corners"))


@query
def site_reader(d: Data) -> DataFrame:
    return rounded(parameters.read_sites(d["site_features"]), 8, "lon", "lat")


@query
def score_lookup(d: Data) -> DataFrame:
    return d["rankings"]


# ---------------------------------------------------------------- filters


@query
def unlit_filter(d: Data) -> DataFrame:
    return search.eligible_towers(d["cci_sites"]).select("s_bus_unit", "s_bu_type_code", "s_site_name")


@query
def lit_filter(d: Data) -> DataFrame:
    return search.lit_units(d["scrub"]).select("bus_unit", "structure_id", "fiber_provider")


@query
def like_any(d: Data) -> DataFrame:
    patterns = ", ".join(f"'{p}'" for p in search.LIT_PROVIDERS)
    return d["scrub"].where(f"fiber_provider like any ({patterns})").select("bus_unit", "structure_id", "fiber_provider")


@query
def any_array(d: Data) -> DataFrame:
    return rounded(
        search.lit_towers(d["cci_sites"], d["scrub"]).select("s_bus_unit", "s_long_dec", "s_lat_dec"),
        9, "s_long_dec", "s_lat_dec",
    )


@query
def hub_lookup(d: Data) -> DataFrame:
    return rounded(bld.hub_lookup(d["buildings"], d["crm"], MAP_EXTENT, 3857), 9, "Lat Dec", "Long Dec")


# ---------------------------------------------------------------- searches


@query
def tower_search_lit(d: Data) -> DataFrame:
    return rounded(search.tower_search(d.sources, d["cci_sites"], d["scrub"]), 9, "long", "lat")


@query
def tower_search_all(d: Data) -> DataFrame:
    return rounded(search.tower_search(d.sources, d["cci_sites"], None), 9, "long", "lat")


@query
def lit_search(d: Data) -> DataFrame:
    return rounded(search.lit_search(d.sources, d.buildings), 9, "long", "lat")


@query
def lit_geometry(d: Data) -> DataFrame:
    return rounded(search.with_geometry(search.lit_search(d.sources, d.buildings)), 9, "long", "lat").select(
        "site_id", "candidate_type", "id", "vertex", "pnt_geom"
    )


@query
def lit_search_dwithin(d: Data) -> DataFrame:
    return rounded(search.lit_search(d.sources, d.buildings, inclusive=True), 9, "long", "lat")


@query
def asd_search(d: Data) -> DataFrame:
    return rounded(search.asd_search(d.sources, d["asd"]), 9, "long", "lat")


@query
def asd_search_dwithin(d: Data) -> DataFrame:
    return rounded(search.asd_search(d.sources, d["asd"], inclusive=True), 9, "long", "lat")


@query
def mgt_search(d: Data) -> DataFrame:
    return rounded(search.mgt_search(d.sources, d["mgt"]), 9, "long", "lat")


@query
def initial_search(d: Data) -> DataFrame:
    return rounded(d.candidates(), 9, "long", "lat")


@query
def search_parameters(d: Data) -> DataFrame:
    return rounded(parameters.search_parameters(d["sources"]), 9, "Latitude", "Longitude")


@query
def planner_row(d: Data) -> DataFrame:
    rows = parameters.planner_rows(parameters.search_parameters(d["sources"]))
    return rounded(rows, 9, "Latitude", "Longitude")


@query
def ids_by_type(d: Data) -> DataFrame:
    return search.ids_by_type(d.candidates())


@query
def type_flags(d: Data) -> DataFrame:
    return search.type_flags(d.candidates())


@query
def radius_join(d: Data) -> DataFrame:
    points = d["buildings"].select("buildingid", "lon", "lat")
    pairs = grid.radius_join(d.sources.select("site_id", "lon", "lat", "radius_km"), points)
    return pairs.select("site_id", "buildingid", geo.metres_to_km(F.col("dist_m")).alias("dist_km"))


# ---------------------------------------------------------------- geometry


@query
def point_in_polygon(d: Data) -> DataFrame:
    """Buildings whose location lies in their own outline."""
    return geo.with_clean_ring(d.buildings).select(
        "buildingid", geo.point_in_ring("lon", "lat", "ring").alias("inside")
    )


@query
def cardinal_vertices(d: Data) -> DataFrame:
    inset = geo.with_inset_ring(geo.with_clean_ring(d.buildings), "ring", "inset")
    corners = inset.select("buildingid", F.inline(geo.cardinal_vertices("inset")).alias("vertex", "lon", "lat"))
    return rounded(corners, 9, "lon", "lat")


@query
def roof_points(d: Data) -> DataFrame:
    return rounded(search.roof_points(d.buildings).drop("lon", "lat"), 9, "v_lon", "v_lat")


@query
def roof_points_lateral(d: Data) -> DataFrame:
    """The same as hand-written SQL over the functions of :mod:`.sql_functions`."""
    sql_functions.register(d.spark)
    text_ = """
select o.buildingid, x.buildingid as x_id, v.vertex, v.lon as v_lon, v.lat as v_lat
from {buildings} o join {buildings} x on o.name = x.name and point_in_outline(x.lon, x.lat, o.ring), lateral roof_vertices(x.ring) v"""
    return rounded(readers.query(d.spark, text_, {"buildings": d.buildings}), 9, "v_lon", "v_lat")


@query
def fcc_buffer_join(d: Data) -> DataFrame:
    return rank.licence_counts(d.buildings, d.licences)


@query
def building_export(d: Data) -> DataFrame:
    outlines = d.outlined("outlines")
    closed = F.concat("ring", F.slice("ring", 1, 1))
    return bld.building_export(outlines.withColumn("ring", F.when(F.col("is_closed") == 1, closed).otherwise(F.col("ring"))))


@query
def line_length(d: Data) -> DataFrame:
    located = links.located_circuits(d["circuits"], d.buildings)
    table = geo.with_line_length(located, "a_longitude", "a_latitude", "z_longitude", "z_latitude", "length_meters")
    return table.where("length_meters is not null").groupBy("circuit_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("length_meters").alias("shortest"), F.max("length_meters").alias("longest")
    )


# ---------------------------------------------------------------- rank attributes


@query
def lit_rank(d: Data) -> DataFrame:
    ids = search.lit_search(d.sources, d.buildings).select("id")
    return rank.lit_rank(d.buildings, d["lit"], d.licences, ids)


@query
def building_rank_all(d: Data) -> DataFrame:
    return rank.lit_rank(d.buildings, d["lit"], d.licences, with_type=True)


@query
def cci_rank(d: Data) -> DataFrame:
    ids = search.tower_search(d.sources, d["cci_sites"], None).select("id")
    return rank.cci_rank(d["scrub"], d["cci_sites"], d["rankings"], ids)


@query
def asd_rank(d: Data) -> DataFrame:
    ids = search.asd_search(d.sources, d["asd"]).select("id")
    return rank.asd_rank(d["asd"], d["rankings"], ids)


@query
def mgt_rank(d: Data) -> DataFrame:
    ids = search.mgt_search(d.sources, d["mgt"]).select("id")
    return rank.mgt_rank(d["mgt"], ids)


# ---------------------------------------------------------------- enrichment


@query
def open_levels(d: Data) -> DataFrame:
    return d["scrub"].select("bus_unit", "structure_id", "open_levels", text.open_level_agl(F.col("open_levels")).alias("tx_agl"))


@query
def path_clearance(d: Data) -> DataFrame:
    scored = enrich.with_clearance(d["masts"], d.clearance, ["profile_id"])
    return rounded(scored, 6, "min_clearance")


@query
def terrain_clearance(d: Data) -> DataFrame:
    """Terrain clearance of the path from each site to each tower found for it."""
    grid_ = terrain.Grid(west=-74.1163778, south=40.7390831, step=0.0025)
    found = search.tower_search(d.sources, d["cci_sites"], None).withColumnsRenamed({"long": "to_lon", "lat": "to_lat"})
    paths = found.join(d.sources.select("site_id", "lon", "lat"), "site_id").fillna({"height": search.DEFAULT_HEIGHT_M})
    elevations = terrain.path_elevations(
        paths, terrain.tiles(d["posts"], grid_), grid_, ["site_id", "id"], ("lon", "lat"), ("to_lon", "to_lat")
    )
    clearance = elevations.select("site_id", "id", terrain.path_clearance(F.col("elevations")).alias("clearance"))
    scored = enrich.with_clearance(paths.select("site_id", "id", "height"), clearance, ["site_id", "id"])
    return rounded(scored, 6, "min_clearance")


@query
def elevation_profile(d: Data) -> DataFrame:
    arrays = enrich.elevation_arrays(d["profiles"], ["profile_id"])
    listed = F.array_join(F.transform("elevations", lambda e: F.format_string("%.3f", e)), ",")
    return arrays.select("profile_id", F.size("elevations").alias("n"), listed.alias("elevations"))


@query
def clearance_filter(d: Data) -> DataFrame:
    table = d.cleared().select("site_id", "candidate_type", "id", "vertex", "cand_seq", "min_clearance", "clearance_score")
    return rounded(table, 6, "min_clearance")


@query
def link_budget_join(d: Data) -> DataFrame:
    joined = enrich.join_link_budget(d.candidates(), d["link_budget"], ["candidate_type", "id"])
    return enrich.linked(joined).select(
        "site_id", "candidate_type", "id", "vertex", "antenna", "speed", "d_km", "link_margin", "equipment", "modulation"
    )


@query
def link_replies(d: Data) -> DataFrame:
    """Stored link-budget replies, as the columns that join the candidates."""
    good, _ = text.quarantined(text.parse_link_reply(d["link_replies"], "reply"))
    return good.select("reply_id", "capacity", "d_km", "link_margin", "model", "modulation", "rain_attenuation_km")


@query
def bad_link_replies(d: Data) -> DataFrame:
    """Replies that do not parse, with their ids."""
    return text.quarantined(text.parse_link_reply(d["link_replies"], "reply"))[1]


@query
def elevation_replies(d: Data) -> DataFrame:
    """Stored terrain replies, with the clearance of each path."""
    good, _ = text.quarantined(text.parse_elevation_reply(d["elevation_replies"], "reply"))
    return good.select(
        "path_id", F.size("elevations").alias("n"), enrich.array_clearance(F.col("elevations")).alias("clearance")
    )


@query
def bad_elevation_replies(d: Data) -> DataFrame:
    return text.quarantined(text.parse_elevation_reply(d["elevation_replies"], "reply"))[1]


@query
def sites_without_links(d: Data) -> DataFrame:
    joined = enrich.join_link_budget(d.candidates(), d["link_budget"], ["candidate_type", "id"])
    return enrich.sites_without_links(d.sources, joined)


@query
def assembled(d: Data) -> DataFrame:
    t = d.tables()
    candidates = materialise(site_search.find_candidates(t))
    table = enrich.assemble(candidates, site_search.rank_tables(t, candidates))
    return rounded(table, 9, "long", "lat")


@query
def unranked_sites(d: Data) -> DataFrame:
    t = d.tables()
    candidates = materialise(site_search.find_candidates(t))
    return enrich.unranked_sites(t.sources, candidates, site_search.rank_tables(t, candidates))


@query
def candidate_pairs(d: Data) -> DataFrame:
    return enrich.candidate_pairs(d.candidates(), 10, seed=7).select("pair", "site_id", "candidate_type", "id", "vertex")


# ---------------------------------------------------------------- ranking and result tables

_RANK_VIEW = ("site_id", "candidate_type", "id", "vertex", "cand_dist_km", "score", "antenna", "speed", "fi_dist",
              "fcc_cnt", "fiber_on_site", "pt_id", "revshare", "tx_agl")


@query
def fw_rank(d: Data) -> DataFrame:
    """Ranking without the clearance check."""
    t = d.tables()
    candidates = materialise(site_search.find_candidates(t))
    table = enrich.assemble(candidates, site_search.rank_tables(t, candidates))
    joined = enrich.linked(enrich.join_link_budget(table, t.replies, ["candidate_type", "id"]))
    return ranker.rank(joined).select(*_RANK_VIEW, "fw_rank")


@query
def fw_rank_clearance(d: Data) -> DataFrame:
    return d.run().ranked.select(*_RANK_VIEW, "clearance_score", "fw_rank")


@query
def rank_joinback(d: Data) -> DataFrame:
    return d.run().all_ranked.select("site_id", "candidate_type", "id", "vertex", "cand_seq", "tx_agl", "fw_rank")


def _sheet(kind: str, name: str) -> None:
    def sheet(d: Data) -> DataFrame:
        run = d.run()
        return ranker.rank_sheet(run.ranks[kind], kind, run.all_ranked)

    sheet.__name__ = name
    query(sheet)


_sheet("ospi", "rank_sheet_buildings")
_sheet("re_asd", "rank_sheet_asd")
_sheet("re_mgt", "rank_sheet_mgt")
_sheet("cci_sites", "rank_sheet_towers")


@query
def candidate_file(d: Data) -> DataFrame:
    return rounded(outputs.candidate_file(d.run().all_ranked), 9, "lat", "long")


@query
def sorted_report(d: Data) -> DataFrame:
    ranked = d.run().ranked.drop("profile_id", "min_clearance", "clearance_score")
    return rounded(outputs.sorted_report(ranked), 6, "long", "lat")


@query
def tower_scrub(d: Data) -> DataFrame:
    """Scrub sheet of the towers that were ranked."""
    towers = d.run().ranked.where("candidate_type = 'cci_sites'").select("id")
    return classify.scrub_sheet(d["scrub"], towers)


@query
def sink_rows(d: Data) -> DataFrame:
    return rounded(outputs.sink_rows(d.run().ranked), 9, "long", "lat")


@query
def candidate_points(d: Data) -> DataFrame:
    points = outputs.candidate_points(d.run().ranked)
    return points.select("site_id", "candidate_type", "id", "fw_rank", "shape")


@query
def spider_lines(d: Data) -> DataFrame:
    return outputs.spider_lines(d.run().ranked, d.sources)


@query
def stage_counts(d: Data) -> DataFrame:
    run = d.run()
    return search.stage_counts({"candidates": run.candidates, "linked": run.assembled, "ranked": run.ranked})


@query
def column_widths(d: Data) -> DataFrame:
    return text.column_widths(classify.scrub_sheet(d["scrub"]))


@query
def name_sanitise(d: Data) -> DataFrame:
    return d["sources"].select("site_id", text.sanitise_name(F.col("project_name")).alias("project"))


# ---------------------------------------------------------------- classification reports


@query
def vector_base(d: Data) -> DataFrame:
    columns = [c for c in classify.SALES if c not in ("crown_ae", "legal_issue_flag")]
    return classify.in_report_order(classify.sales_base(d["scrub"], d["cci_sites"], columns))


def _report(name: str) -> None:
    def report(d: Data) -> DataFrame:
        table = classify.classification(name, d["scrub"], d["cci_sites"])
        return rounded(table, 9, "s_long_dec", "s_lat_dec") if name == "e" else table

    report.__name__ = f"vector_{name}"
    query(report)


for _name in classify.REPORTS:
    _report(_name)


# Days before the lease end, one per row group: ended, nearly ended, on the five-year mark, beyond it.
ASOF_DAYS = (-1, 10, 1825, 2000)


def _with_asof(d: Data) -> DataFrame:
    last = d["scrub"].select(F.max("fle")).scalar()
    days = F.element_at(F.array(*[F.lit(n) for n in ASOF_DAYS]), (F.col("active_apps_count_on_site") % 4) + 1)
    return d["scrub"].withColumn("asof", last - F.make_dt_interval(days, F.lit(6)))


def _units(name: str) -> None:
    def report(d: Data) -> DataFrame:
        units = d["cci_sites"].where("s_pop_tier_id = '1'").select("s_bus_unit")
        out = classify.classification(name, d["scrub"], d["cci_sites"], units)
        return rounded(out, 9, "s_long_dec", "s_lat_dec") if name == "e" else out

    report.__name__ = f"vector_{name}_units"
    query(report)


_units("a")
_units("e")


@query
def vector_f(d: Data) -> DataFrame:
    asof = F.lit("1993-08-01 06:00:00").cast("timestamp")
    return classify.detailed_classification(d["scrub"], d["cci_sites"], asof)


@query
def fle_days(d: Data) -> DataFrame:
    return classify.lease_report(_with_asof(d), F.col("asof"), whole=True)


@query
def fle_fraction(d: Data) -> DataFrame:
    return classify.lease_report(_with_asof(d), F.col("asof"), whole=False)


@query
def lease_colours(d: Data) -> DataFrame:
    days = classify.whole_lease_days(F.col("asof"))
    return _with_asof(d).select(
        "bus_unit", "structure_id", "active_apps_count_on_site",
        F.when(F.col("fle").isNull(), "").otherwise(colours.lease_colour(days)).alias("fle_clr"),
    )


@query
def vector_g(d: Data) -> DataFrame:
    return classify.structure_classification(d["scrub"], d["site"], d["structure"], d["us_structure"])


@query
def structure_base(d: Data) -> DataFrame:
    return classify.structure_base(d["scrub"], d["site"], d["structure"], d["us_structure"])


@query
def cell_highlights(d: Data) -> DataFrame:
    return classify.cell_highlights(
        classify.structure_colours(d["scrub"], d["site"], d["structure"], d["us_structure"])
    )


# ---------------------------------------------------------------- links


@query
def link_view(d: Data) -> DataFrame:
    return links.link_view(d["circuits"], d.buildings)


@query
def link_public_view(d: Data) -> DataFrame:
    return links.register_link_views(d["circuits"], d.buildings)


@query
def disjunctive_join(d: Data) -> DataFrame:
    known = d["buildings"].where("name is not null").select("buildingid", "name")
    joined = links.either_name_join(
        d["circuits"], known, materialise(key_counts(known, ["name"])), "a_location_clli",
        links.name_part(F.col("name"), links.A_PART), {"buildingid": "buildingid"},
    )
    return joined.select("circuit_id", "buildingid")

