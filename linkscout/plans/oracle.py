"""The SQL each query is checked against, for DuckDB on the same tables.

Written on purpose in another way than the operators: every source against every point instead of grid cells, real
fan-out joins instead of multiplied counts, lookup tables instead of rule objects, four explicit corners instead of
arrays. Texts are assembled from named common table expressions.
"""

from __future__ import annotations

import re

from linkscout.schemas import RANKS

# Report columns, stated here apart from the operators.
REPORT_A = """
bus_unit crown_area crown_ae site_status consent_summary crown_district lats longs portfolio site_city site_county site_state site_zip marketable
fiber_on_site fiber_provider is_cci_power_available if_no_cci_power_is_meter_avail power_company available_telco_provider revshare revshare_split
landlord_name primary_property_interest tower_only fle leased_area_sq_ft compound_sq_ft compnd_expand avail_ground_space_com add_land_option
option_sq_ft sublease_consent_type config_changes_consent_type loa_required zoning_jurisdiction zoning_collo_process_type
zoning_ant_add_process_type zoning_ant_swap_process_type zoning_ground_process_type permit_jurisdiction bp_collo_permit_type
bp_ant_add_permit_type bp_ant_swap_permit_type bp_ground_permit_type tower_lighted largest_length stealth_tower_ind stealth_structure_type
faa_study_number faa_approved_height structure_id ground_elevation faa_lighting_requirement man_lift_req nearest_airport_distance
site_on_si_tracker am_study_required abandoned_equipment_on_tower sa_on_file current_tower_capacity modification_expected can_it_be_ibm
hist_migratory_bird_issues open_bird_ticket validated_fcc_registration legal_issue_flag s_structure_type s_hgt_with_appurt s_site_flag
""".split()
REPORT_B = """
bus_unit crown_area crown_ae site_status consent_summary crown_district lats longs portfolio site_city site_county site_state site_zip marketable
fiber_provider is_cci_power_available if_no_cci_power_is_meter_avail power_company available_telco_provider revshare revshare_split
landlord_name primary_property_interest fle leased_area_sq_ft compound_sq_ft compnd_expand avail_ground_space_com add_land_option
option_sq_ft sublease_consent_type config_changes_consent_type loa_required zoning_jurisdiction zoning_collo_process_type
zoning_ant_add_process_type zoning_ant_swap_process_type zoning_ground_process_type permit_jurisdiction bp_collo_permit_type
bp_ant_add_permit_type bp_ant_swap_permit_type bp_ground_permit_type tower_lighted largest_length tower_only stealth_structure_type
faa_study_number faa_approved_height structure_id ground_elevation nearest_airport_distance site_on_si_tracker am_study_required
abandoned_equipment_on_tower sa_on_file current_tower_capacity modification_expected can_it_be_ibm hist_migratory_bird_issues
open_bird_ticket validated_fcc_registration legal_issue_flag fiber_on_site empty_shelter_avail is_there_ccishelter_on_site
meter_account_owner meter_account_number meter_local_utility_number faa_lighting_requirement stealth_tower_ind s_structure_type
s_hgt_with_appurt s_site_flag
""".split()
REPORT_G = """
bus_unit crown_area site_status consent_summary crown_district lats longs portfolio site_city site_county site_state site_zip marketable
fiber_on_site fiber_provider is_cci_power_available if_no_cci_power_is_meter_avail power_company available_telco_provider revshare revshare_split
landlord_name primary_property_interest tower_only fle leased_area_sq_ft compound_sq_ft compnd_expand avail_ground_space_com add_land_option
option_sq_ft sublease_consent_type config_changes_consent_type loa_required zoning_jurisdiction zoning_collo_process_type
zoning_ant_add_process_type zoning_ant_swap_process_type zoning_ground_process_type permit_jurisdiction bp_collo_permit_type
bp_ant_add_permit_type bp_ant_swap_permit_type bp_ground_permit_type tower_lighted largest_length largest_width site_flag structure_type
stealth_tower_ind structure_id faa_approved_height tower_height_w_appurt tower_height_wout_appurt ground_elevation faa_lighting_requirement
man_lift_req nearest_airport_distance site_on_si_tracker am_study_required faa_study_number stealth_tower_type_lkup_code
abandoned_equipment_on_tower sa_on_file current_tower_capacity modification_expected can_it_be_ibm hist_migratory_bird_issues
open_bird_ticket validated_fcc_registration
""".split()
REPORT_F = [c for c in REPORT_A if c != "legal_issue_flag"]
TOWER_SHEET = """
bus_unit crown_area crown_district lats longs marketable tower_height_w_appurt portfolio structure_type current_tower_capacity open_levels
avail_ground_space_com is_cci_power_available zoning_jurisdiction zoning_collo_process_type zoning_collo_duration permit_jurisdiction
bp_collo_permit_type bp_collo_duration consent_summary revshare loa_required loa_notes
""".split()
from linkscout.sources.fixtures import VIEWS, duckdb_view

CTES: dict[str, str] = {}
SQL: dict[str, str] = {}


def _needed(text: str, seen: dict[str, str]) -> None:
    for name in re.findall(r"\b(?:fx|q)_\w+", text):
        if name in seen or (name not in VIEWS and name not in CTES):
            continue
        body = duckdb_view(name) if name in VIEWS else CTES[name]
        _needed(body, seen)
        seen[name] = body


def with_ctes(text: str) -> str:
    seen: dict[str, str] = {}
    _needed(text, seen)
    if not seen:
        return text
    return "with " + ",\n".join(f"{name} as ({body})" for name, body in seen.items()) + "\n" + text


def all_sql() -> dict[str, str]:
    return {name: with_ctes(text) for name, text in SQL.items()}


def half_up(value: str, digits: int) -> str:
    return f"floor(({value}) * 1e{digits} + 0.5) / 1e{digits}"


def listed(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# ---------------------------------------------------------------- distance

F = "(1 / 298.257223563)"


def with_distance(table: str, lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    """``table`` with ``dist_m``: Lambert's formula in its textbook form."""
    return f"""
select *, 6378137.0 * (g_s - {F} / 2 * ((g_s - sin(g_s)) * pow(sin(g_p) * cos(g_q) / cos(g_s / 2), 2)
    + case when g_s = 0 then 0 else (g_s + sin(g_s)) * pow(cos(g_p) * sin(g_q) / sin(g_s / 2), 2) end)) as dist_m
from (select *, 2 * asin(sqrt(least(1.0, pow(sin(g_q), 2) + cos(g_b1) * cos(g_b2) * pow(sin(g_dl / 2), 2)))) as g_s
  from (select *, (g_b1 + g_b2) / 2 as g_p, (g_b2 - g_b1) / 2 as g_q
    from (select *, atan((1 - {F}) * tan(radians({lat1}))) as g_b1, atan((1 - {F}) * tan(radians({lat2}))) as g_b2,
        radians({lon2} - {lon1}) as g_dl
      from {table}) g0) g1) g2"""


CTES["q_src"] = """
select *, cast(case when radius_raw < 0 then 0 when radius_raw = 0 or radius_raw > 11 then 11 else radius_raw end as double) as radius_km,
  4 * case when limit_by_type then max_lit else max_neighbors end as lit_limit,
  case when limit_by_type then max_re else max_neighbors end as re_limit,
  case when limit_by_type then max_cci else max_neighbors end as cci_limit
from fx_sources"""


def nearest(points: str, limit: str, tie: str, inclusive: bool = False) -> str:
    """The nearest rows of ``points`` (id, lon, lat, out_lon, out_lat, height, vertex, kind) for every source."""
    pairs = (
        f"(select s.site_id, s.lon as s_lon, s.lat as s_lat, s.radius_km, s.{limit} as top, p.* "
        f"from q_src s, ({points}) p) pairs"
    )
    op = "<=" if inclusive else "<"
    return f"""
select site_id, kind as candidate_type, id, cand_dist_km, cast(out_lon as double) as long, cast(out_lat as double) as lat,
  cast(height as double) as height, vertex
from (select *, row_number() over (partition by site_id order by cand_dist_km, {tie}) as rn
  from (select *, floor(dist_m / 10 + 0.5) / 100 as cand_dist_km
    from ({with_distance(pairs, 's_lon', 's_lat', 'lon', 'lat')}) d where dist_m {op} radius_km * 1000) e) f
where rn <= top"""


def searched(text: str) -> str:
    return (
        f"select site_id, candidate_type, id, cand_dist_km, {half_up('long', 9)} as long, {half_up('lat', 9)} as lat, "
        f"height, vertex from {text}"
    )


# ---------------------------------------------------------------- outlines (convex quadrilaterals, counter-clockwise)


def in_quad(px: str, py: str, q: str = "") -> str:
    """Point left of, or on, all four edges."""
    tests = []
    for i in range(4):
        j = (i + 1) % 4
        tests.append(
            f"({q}x{j} - {q}x{i}) * ({py} - {q}y{i}) - ({q}y{j} - {q}y{i}) * ({px} - {q}x{i}) >= 0"
        )
    return "(" + " and ".join(tests) + ")"


def quad_distance_sq(px: str, py: str, q: str = "") -> str:
    parts = []
    for i in range(4):
        j = (i + 1) % 4
        ax, ay, bx, by = f"{q}x{i}", f"{q}y{i}", f"{q}x{j}", f"{q}y{j}"
        t = (
            f"least(1.0, greatest(0.0, (({px} - {ax}) * ({bx} - {ax}) + ({py} - {ay}) * ({by} - {ay}))"
            f" / (pow({bx} - {ax}, 2) + pow({by} - {ay}, 2))))"
        )
        parts.append(f"pow({px} - ({ax} + {t} * ({bx} - {ax})), 2) + pow({py} - ({ay} + {t} * ({by} - {ay})), 2)")
    return "least(" + ", ".join(parts) + ")"


_normals = ", ".join(
    f"-(y{j} - y{i}) / sqrt(pow(x{j} - x{i}, 2) + pow(y{j} - y{i}, 2)) as nx{i}, "
    f"(x{j} - x{i}) / sqrt(pow(x{j} - x{i}, 2) + pow(y{j} - y{i}, 2)) as ny{i}"
    for i, j in ((0, 1), (1, 2), (2, 3), (3, 0))
)
_inset = ", ".join(
    f"x{i} + 0.000012 * (nx{h} + nx{i}) / (1 + nx{h} * nx{i} + ny{h} * ny{i}) as ix{i}, "
    f"y{i} + 0.000012 * (ny{h} + ny{i}) / (1 + nx{h} * nx{i} + ny{h} * ny{i}) as iy{i}"
    for h, i in ((3, 0), (0, 1), (1, 2), (2, 3))
)
CTES["q_corners"] = f"""
select buildingid, name, lon, lat, i, case i when 0 then ix0 when 1 then ix1 when 2 then ix2 else ix3 end as cx,
  case i when 0 then iy0 when 1 then iy1 when 2 then iy2 else iy3 end as cy
from (select *, {_inset} from (select *, {_normals} from fx_buildings) a) b, (values (0), (1), (2), (3)) as c(i)"""
CTES["q_vertices"] = """
select buildingid, name, lon, lat, v.vertex, case v.vertex when 'N' then n.cx when 'S' then s.cx when 'E' then e.cx else w.cx end as v_lon,
  case v.vertex when 'N' then n.cy when 'S' then s.cy when 'E' then e.cy else w.cy end as v_lat
from (select buildingid, any_value(name) as name, any_value(lon) as lon, any_value(lat) as lat,
    arg_max({'cx': cx, 'cy': cy}, cy) as n, arg_min({'cx': cx, 'cy': cy}, cy) as s,
    arg_max({'cx': cx, 'cy': cy}, cx) as e, arg_min({'cx': cx, 'cy': cy}, cx) as w
  from q_corners group by buildingid) k, (values ('N'), ('S'), ('E'), ('W')) as v(vertex)"""
CTES["q_roofs"] = f"""
select o.buildingid, o.lon, o.lat, x.buildingid as x_id, x.vertex, x.v_lon, x.v_lat
from fx_buildings o join q_vertices x on o.name = x.name where {in_quad('x.lon', 'x.lat', 'o.')}"""

LIT_POINTS = "select cast(buildingid as varchar) as id, lon, lat, v_lon as out_lon, v_lat as out_lat, 30.0 as height, vertex, x_id, 'ospi' as kind from q_roofs"
ASD_POINTS = "select mastersiteid as id, lon, lat, londec as out_lon, latdec as out_lat, height, null::varchar as vertex, 're_asd' as kind from fx_asd"
MGT_POINTS = """select cast(esri_prinx as varchar) as id, degrees(geom_x / 6378137.0) as lon,
  degrees(2 * atan(exp(geom_y / 6378137.0)) - pi() / 2) as lat, lng_num as out_lon, lat_num as out_lat, bld_hgt_num as height,
  null::varchar as vertex, 're_mgt' as kind from fx_mgt"""
TOWER_POINTS = """select s_bus_unit as id, s_long_dec as lon, s_lat_dec as lat, s_long_dec as out_lon, s_lat_dec as out_lat,
  s_hgt_no_appurt as height, null::varchar as vertex, 'cci_sites' as kind from fx_cci_sites
  where (s_bu_type_code = 'TW' or s_bu_type_code = 'RT') and s_external_flag = 1 and s_open_space is not null"""
LIT_CLAUSE = "(contains(fiber_provider, 'FPL') or contains(fiber_provider, 'CROWN CASTLE') or contains(fiber_provider, 'LIGHTOWER'))"
LIT_TOWERS = f"{TOWER_POINTS} and exists (select 1 from fx_scrub b where b.bus_unit = s_bus_unit and {LIT_CLAUSE})"

CTES["q_lit_search"] = nearest(LIT_POINTS, "lit_limit", "id, vertex, x_id")
CTES["q_asd_search"] = nearest(ASD_POINTS, "re_limit", "id")
CTES["q_mgt_search"] = nearest(MGT_POINTS, "re_limit", "id")
CTES["q_towers_all"] = nearest(TOWER_POINTS, "cci_limit", "id")
CTES["q_towers_lit"] = nearest(LIT_TOWERS, "cci_limit", "id")
SQL["lit_search"] = searched("q_lit_search")
SQL["lit_search_dwithin"] = searched(f"({nearest(LIT_POINTS, 'lit_limit', 'id, vertex, x_id', True)}) r")
SQL["lit_geometry"] = f"""
select site_id, candidate_type, id, vertex, printf('POINT(%.9f %.9f)', long, lat) as pnt_geom from ({searched("q_lit_search")}) g"""
SQL["link_replies"] = """
select l_orderkey * 10 + l_linenumber as reply_id, cast(100 * (1 + l_partkey % 10) as int) as capacity, l_suppkey % 9 + 0.5::double as d_km,
  l_partkey % 40 + 0.25::double as link_margin, 'EH-' || l_linenumber as model,
  case when l_partkey % 7 <> 0 then 'QAM' || (l_suppkey % 4) end as modulation, l_linenumber + 0.125::double as rain_attenuation_km
from lineitem where l_orderkey % 50 <> 7"""
SQL["bad_link_replies"] = "select reply_id, reply as reply_error from fx_link_replies where right(reply, 1) <> '}'"
SQL["elevation_replies"] = """
select o_orderkey as path_id, 3 as n,
  least(0.0::double, (o_custkey % 90 + 0.5::double + o_custkey % 50) / 2 - (o_orderkey % 70 + 0.25::double)) as clearance
from orders where o_orderkey % 64 <> 5"""
SQL["bad_elevation_replies"] = "select path_id, reply as reply_error from fx_elevation_replies where contains(reply, '.x')"
_corner = "printf('%.12f %.12f', -(64 + k{0} / 1024::double), 32 + j{0} / 2048::double)"
_c = [_corner.format(i) for i in range(3)]
SQL["decoded_shapes"] = f"""
select shape_id, case when shape_id % 4 < 3 then 4326::int end as srid, 0::int as part,
  case shape_id % 4 when 1 then 'area' when 2 then 'point' else 'line' end as kind,
  case shape_id % 4 when 0 then {_c[0]} || ', ' || {_c[1]} when 1 then {_c[0]} || ', ' || {_c[1]} || ', ' || {_c[2]} || ', ' || {_c[0]}
    when 2 then {_c[0]} else {_c[0]} || ', ' || printf('%.12f %.12f', -64::double, 32::double) end as corners
from fx_hex_shapes
union all
select shape_id, 4326::int, 1::int, 'line', {_c[1]} || ', ' || {_c[2]} from fx_hex_shapes where shape_id % 4 = 2"""
SQL["asd_search"] = searched("q_asd_search")
SQL["asd_search_dwithin"] = searched(f"({nearest(ASD_POINTS, 're_limit', 'id', True)}) r")
SQL["mgt_search"] = searched("q_mgt_search")
SQL["tower_search_all"] = searched("q_towers_all")
SQL["tower_search_lit"] = searched("q_towers_lit")
_open = "site_id in (select site_id from q_src where include_non_lit)"
CTES["q_found"] = f"""
select site_id, candidate_type, id, cand_dist_km, long, lat, coalesce(height, 30.0) as height, vertex from (
  select * from q_lit_search
  union all select * from q_asd_search where {_open}
  union all select * from q_mgt_search where {_open}
  union all select * from q_towers_all where {_open}
  union all select * from q_towers_lit where not {_open}) u"""
CTES["q_cand"] = """
select *, row_number() over (partition by site_id order by
    case candidate_type when 'ospi' then 1 when 're_asd' then 2 when 're_mgt' then 3 else 4 end,
    cand_dist_km, id, vertex nulls first, long, lat) as cand_seq
from q_found"""
SQL["initial_search"] = searched("q_found")
SQL["ids_by_type"] = """
select site_id, candidate_type, count(*) as n, string_agg(id, ',' order by cand_seq) as ids from q_cand
group by site_id, candidate_type"""
SQL["type_flags"] = "select site_id, " + ", ".join(
    f"count(*) filter (where candidate_type = '{t}') > 0 as has_{t}" for t in RANKS
) + " from q_found group by site_id"
CTES["q_project"] = "select *, regexp_replace(replace(project_name, ' ', '_'), '[^A-Za-z0-9_]', '', 'g') as project from q_src"
_extra = "include_non_lit or limit_by_type"
SQL["search_parameters"] = f"""
select site_id, project as "Project Name", {half_up('lat', 9)} as "Latitude", {half_up('lon', 9)} as "Longitude",
  min_speed as "Minimum Speed", max_neighbors as "Max Candidates", radius_km as "Distance (km)",
  case when {_extra} then include_non_lit end as "Non-Lit?", case when {_extra} then limit_by_type end as "Extra Control?",
  case when {_extra} then lit_limit end as "Lit Number", case when {_extra} then re_limit end as "RE Number",
  case when {_extra} then cci_limit end as "CCI Sites Number"
from q_project"""
SQL["planner_row"] = f"""
select site_id, project as "Site Name", {half_up('lat', 9)} as "Latitude", {half_up('lon', 9)} as "Longitude",
  'False' as "Site Enabled", project as "Device Name", '40' as "Max Power (dBm)", '0' as "Misc Loss (dB)",
  'EBAND_ISO' as "Antenna Type", 0 as "Mechanical Azimuth (deg)", 0 as "Mechanical Downtilt (deg)",
  0 as "Electrical Downtilt (deg)", 0 as "Antenna Height AGL (m)", 0 as "Beamforming Gain (dB)",
  0 as "LTE PDSCH Offset (dB)", 0 as "Cell Load (%)"
from q_project"""
SQL["name_sanitise"] = "select site_id, project from q_project"
_pairs = "(select s.site_id, s.lon as s_lon, s.lat as s_lat, s.radius_km, b.buildingid, b.lon, b.lat from q_src s, fx_buildings b) pairs"
SQL["radius_join"] = f"""
select site_id, buildingid, floor(dist_m / 10 + 0.5) / 100 as dist_km
from ({with_distance(_pairs, 's_lon', 's_lat', 'lon', 'lat')}) d where dist_m < radius_km * 1000"""

# ---------------------------------------------------------------- scans and filters

SQL["building_scan"] = f"""
select buildingid, name, clli, street, city, state, building_type, pop_tf, {half_up('lon', 9)} as lon, {half_up('lat', 9)} as lat
from fx_buildings"""
SQL["building_sample"] = "select buildingid, name, clli from fx_buildings order by buildingid limit 5"
SQL["query_to_table"] = "select state, count(*) as n, count(name) as named from fx_buildings group by state"
SQL["decoded_points"] = """
select point_id, -(64 + k / 1024.0::double) as lon, 32 + j / 2048.0::double as lat, 4326 as srid from fx_hex_points"""
SQL["score_lookup"] = "select candidate_source, candidate_type, score from fx_rankings"
SQL["unlit_filter"] = """
select s_bus_unit, s_bu_type_code, s_site_name from fx_cci_sites
where s_bu_type_code in ('TW', 'RT') and s_external_flag = 1 and s_open_space is not null"""
SQL["lit_filter"] = f"select bus_unit, structure_id, fiber_provider from fx_scrub where {LIT_CLAUSE}"
SQL["like_any"] = """
select bus_unit, structure_id, fiber_provider from fx_scrub
where regexp_matches(fiber_provider, 'FPL|CROWN CASTLE|LIGHTOWER')"""
SQL["any_array"] = f"""
select s_bus_unit, {half_up('s_long_dec', 9)} as s_long_dec, {half_up('s_lat_dec', 9)} as s_lat_dec from fx_cci_sites
where s_bus_unit = any (select bus_unit from fx_scrub where {LIT_CLAUSE})"""
SQL["hub_lookup"] = f"""
select b.buildingid, b.name_raw as name, b.building_type, c.on_net_status, {half_up('b.lat', 9)} as "Lat Dec",
  {half_up('b.lon', 9)} as "Long Dec"
from fx_buildings b left join fx_crm c on upper(trim(b.name_raw)) = c.clli
where coalesce(c.on_net_status, '') not in ('TYPE II', 'ON-NET (Type II)', 'OFF-NET', 'OFF-NET (Restricted)', '13', '14', '15')
  and b.lon * 6378137.0 * pi() / 180 between -8243000 and -8230000
  and ln(tan(radians(45 + b.lat / 2))) * 6378137.0 between 4970000 and 4985000"""

# Transverse Mercator by its series, unrolled (fixed coefficients).
_n = "0.0016792203863837047e0"
_xi, _eta = "((y) / (0.9996e0 * 6367449.145823415e0))", "((x - 500000e0) / (0.9996e0 * 6367449.145823415e0))"
_beta = (
    f"({_n}/2 - 2*pow({_n},2)/3 + 37*pow({_n},3)/96 - pow({_n},4)/360)",
    f"(pow({_n},2)/48 + pow({_n},3)/15 - 437*pow({_n},4)/1440)",
    f"(17*pow({_n},3)/480 - 37*pow({_n},4)/840)", f"(4397*pow({_n},4)/161280)",
)
_delta = (
    f"(2*{_n} - 2*pow({_n},2)/3 - 2*pow({_n},3) + 116*pow({_n},4)/45)",
    f"(7*pow({_n},2)/3 - 8*pow({_n},3)/5 - 227*pow({_n},4)/45)",
    f"(56*pow({_n},3)/15 - 136*pow({_n},4)/35)", f"(4279*pow({_n},4)/630)",
)
_cosh, _sinh = "((exp({0}) + exp(-({0}))) / 2)", "((exp({0}) - exp(-({0}))) / 2)"
_xip = _xi + "".join(f" - {b} * sin({2*j} * {_xi}) * {_cosh.format(f'{2*j} * {_eta}')}" for j, b in enumerate(_beta, 1))
_etap = _eta + "".join(f" - {b} * cos({2*j} * {_xi}) * {_sinh.format(f'{2*j} * {_eta}')}" for j, b in enumerate(_beta, 1))
_utm_lat = "degrees(chi" + "".join(f" + {d} * sin({2*j} * chi)" for j, d in enumerate(_delta, 1)) + ")"
SQL["site_reader"] = f"""
select site_id, {half_up("case epsg when 4326 then x when 3857 then x / 6378137.0 * 180 / pi() else degrees(atan2(" + _sinh.format('etap') + ", cos(xip))) - 75 end", 8)} as lon,
  {half_up("case epsg when 4326 then y when 3857 then 2 * degrees(atan(exp(y / 6378137.0))) - 90 else " + _utm_lat + " end", 8)} as lat
from (select *, asin(sin(xip) / {_cosh.format('etap')}) as chi
  from (select *, case when epsg > 30000 then {_xip} end as xip, case when epsg > 30000 then {_etap} end as etap
    from fx_site_features) a) b"""

# ---------------------------------------------------------------- geometry

SQL["point_in_polygon"] = f"select buildingid, {in_quad('lon', 'lat')} as inside from fx_buildings"
SQL["cardinal_vertices"] = f"select buildingid, vertex, {half_up('v_lon', 9)} as lon, {half_up('v_lat', 9)} as lat from q_vertices"
SQL["roof_points"] = f"select buildingid, x_id, vertex, {half_up('v_lon', 9)} as v_lon, {half_up('v_lat', 9)} as v_lat from q_roofs"
SQL["roof_points_lateral"] = SQL["roof_points"]
CTES["q_licence_points"] = f"""
select b.buildingid, f.license_id from fx_buildings b join fx_fcc f
  on f.lon between b.x0 - 0.001 and b.x2 + 0.001 and f.lat between b.y1 - 0.001 and b.y3 + 0.001
where coalesce(f.kind, 'point') = 'point' and ({in_quad('f.lon', 'f.lat', 'b.')} or {quad_distance_sq('f.lon', 'f.lat', 'b.')} <= 0.000278 * 0.000278)"""


def _licence_edge(i: int, j: int, half: bool) -> str:
    mid = (lambda c, axis: f"({c} + {axis}) / 2") if half else (lambda c, axis: c)
    ends = ", ".join(f"{mid(f'{c}{k}', axis)} as {e}{c}" for e, k in (("a", i), ("b", j)) for c, axis in (("x", "lon"), ("y", "lat")))
    which = "has_hole = 1" if half else "kind = 'area'" if j == 0 or i == 2 else "kind in ('line', 'area')"
    return f"select license_id, {ends} from fx_fcc where {which}"


CTES["q_licence_edges"] = " union all ".join(
    _licence_edge(i, (i + 1) % 4, half) for half in (False, True) for i in range(4)
)


def _gap_sq(x: str, y: str, ax: str, ay: str, bx: str, by: str) -> str:
    t = (
        f"least(1.0, greatest(0.0, (({x} - {ax}) * ({bx} - {ax}) + ({y} - {ay}) * ({by} - {ay}))"
        f" / (pow({bx} - {ax}, 2) + pow({by} - {ay}, 2))))"
    )
    return f"pow({x} - ({ax} + {t} * ({bx} - {ax})), 2) + pow({y} - ({ay} + {t} * ({by} - {ay})), 2)"


def edge_meets_quad(buffer: str) -> str:
    """Edge (ax, ay, bx, by) of a licence against the four edges of building b."""
    tests = [in_quad("e.ax", "e.ay", "b.")]
    for i in range(4):
        p = [f"b.x{i}", f"b.y{i}", f"b.x{(i + 1) % 4}", f"b.y{(i + 1) % 4}"]
        e = ["e.ax", "e.ay", "e.bx", "e.by"]
        tests += [f"{_gap_sq(*pt, *seg)} <= {buffer} * {buffer}" for pt, seg in ((p[:2], e), (p[2:], e), (e[:2], p), (e[2:], p))]

        def turn(s, x, y):
            return f"sign(({s[2]} - {s[0]}) * ({y} - {s[1]}) - ({s[3]} - {s[1]}) * ({x} - {s[0]}))"

        tests.append(f"({turn(p, *e[:2])} * {turn(p, *e[2:])} < 0 and {turn(e, *p[:2])} * {turn(e, *p[2:])} < 0)")
    return "(" + " or ".join(tests) + ")"


_hole = re.sub(r"f\.([xy])(\d)", lambda m: f"((f.{m[1]}{m[2]} + f.{'lon' if m[1] == 'x' else 'lat'}) / 2)", in_quad("b.x0", "b.y0", "f."))
CTES["q_near_fcc"] = f"""
select * from q_licence_points
union all
select distinct buildingid, license_id from (
  select b.buildingid, e.license_id from fx_buildings b join q_licence_edges e
    on least(e.ax, e.bx) <= b.x2 + 0.001 and b.x0 - 0.001 <= greatest(e.ax, e.bx)
      and least(e.ay, e.by) <= b.y3 + 0.001 and b.y1 - 0.001 <= greatest(e.ay, e.by)
  where {edge_meets_quad("0.000278")}
  union all
  select b.buildingid, f.license_id from fx_buildings b join fx_fcc f
    on f.x0 <= b.x0 and b.x0 <= f.x1 and f.y0 <= b.y0 and b.y0 <= f.y2
  where f.kind = 'area' and {in_quad("b.x0", "b.y0", "f.")} and not (f.has_hole = 1 and {_hole})) n"""
SQL["fcc_buffer_join"] = "select buildingid, count(*) as n from q_near_fcc group by buildingid"


def _cross(a: int, b: int, c: int) -> str:
    return f"((x{b} - x{a}) * (y{c} - y{a}) - (y{b} - y{a}) * (x{c} - x{a}))"


def _proper(a: int, b: int, c: int, d: int) -> str:
    return (
        f"(sign({_cross(a, b, c)}) * sign({_cross(a, b, d)}) < 0 and sign({_cross(c, d, a)}) * sign({_cross(c, d, b)}) < 0)"
    )


_area = " + ".join(f"((x{i} - x0) * (y{j} - y0) - (x{j} - x0) * (y{i} - y0))" for i, j in ((0, 1), (1, 2), (2, 3), (3, 0)))


def _meeting(a: int, b: int, c: int, d: int) -> str:
    """Where line a-b meets line c-d."""
    t = (
        f"(((x{c} - x{a}) * (y{d} - y{c}) - (y{c} - y{a}) * (x{d} - x{c}))"
        f" / ((x{b} - x{a}) * (y{d} - y{c}) - (y{b} - y{a}) * (x{d} - x{c})))"
    )
    return f"{{'x': x{a} + {t} * (x{b} - x{a}), 'y': y{a} + {t} * (y{b} - y{a})}}"


def _ring_text(ring: str) -> str:
    return f"'((' || array_to_string(list_transform(list_concat({ring}, [({ring})[1]]), lambda p: printf('%.9f %.9f', p.x, p.y)), ', ') || '))'"


def _triangle(p: str, i: int, j: int) -> str:
    """Triangle of a meeting point and two corners, counter-clockwise."""
    return (
        f"case when ({p}.x - c4[{i}].x) * (c4[{j}].y - c4[{i}].y) - (c4[{j}].x - c4[{i}].x) * ({p}.y - c4[{i}].y) > 0"
        f" then [c4[{i}], {p}, c4[{j}]] else [{p}, c4[{i}], c4[{j}]] end"
    )


SQL["building_export"] = f"""
select id, buildingid, name, clli, street, city, state, pop_tf, zip, workorder, security_level, address_notes, building_type,
  legacy_fid, legacy_owner,
  case when bad then 'Invalid Coordinate' when corners < 3 then 'Too few points in geometry component' || printf('[%.9f %.9f]', x0, y0)
    when place is not null then 'Self-intersection' || printf('[%.9f %.9f]', place.x, place.y) else 'Valid Geometry' end as geom_reason,
  case when bad or corners < 3 then null when place is null then 'POLYGON' || {_ring_text('ring')}
    when halves is null then 'MULTIPOLYGON EMPTY'
    else 'MULTIPOLYGON(' || array_to_string(list_transform(list_sort(list_transform(halves, lambda t:
      list_concat(t[list_position(t, list_min(t)):], t[:list_position(t, list_min(t)) - 1]))), lambda t: {_ring_text('t')}), ', ') || ')' end as geom
from (select *, case when {_area} < 0 then list_reverse(open_ring) else open_ring end as ring,
    case when split = 1 then [{_triangle('place', 2, 3)}, {_triangle('place', 4, 1)}]
      when split = 2 then [{_triangle('place', 3, 4)}, {_triangle('place', 1, 2)}] end as halves
  from (select *, case split when 1 then {_meeting(0, 1, 2, 3)} when 2 then {_meeting(1, 2, 3, 0)} when 3 then c4[2] when 4 then c4[1] end as place
    from (select *, case when corners = 4 and {_proper(0, 1, 2, 3)} then 1 when corners = 4 and {_proper(1, 2, 3, 0)} then 2
        when c4[2] = c4[4] then 3 when c4[1] = c4[3] then 4 end as split
      from (select *, isnan(x0) or isnan(x1) or isnan(x2) or isnan(x3) or isnan(y0) or isnan(y1) or isnan(y2) or isnan(y3) as bad,
          list_unique(c4) as corners, case when c4[4] = c4[3] then c4[1:3] else c4 end as open_ring
        from (select *, [{{'x': x0, 'y': y0}}, {{'x': x1, 'y': y1}}, {{'x': x2, 'y': y2}}, {{'x': x3, 'y': y3}}] as c4 from fx_outlines) a) b) c) d) e"""

# ---------------------------------------------------------------- links


def end_join(code: str, part: int, alias: str) -> str:
    return f"left join fx_buildings {alias} on c.{code} = {alias}.name or split_part(c.name, '-', {part}) = {alias}.name"


CTES["q_located"] = f"""
select c.*, a.lon as a_lon, a.lat as a_lat, z.lon as z_lon, z.lat as z_lat from fx_circuits c
{end_join('a_location_clli', 3, 'a')} {end_join('z_location_clli', 4, 'z')}
where c.circuit_type = 'Fixed Wireless Link'"""


def vincenty(table: str) -> str:
    text = f"""select *, atan((1 - {F}) * tan(radians(a_lat))) as u1, atan((1 - {F}) * tan(radians(z_lat))) as u2,
      radians(z_lon - a_lon) as dl, radians(z_lon - a_lon) as lam0 from {table}"""
    for i in range(7):
        prev = f"lam{i}"
        text = f"""select *, sqrt(pow(cos(u2) * sin({prev}), 2) + pow(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos({prev}), 2)) as ss{i},
          sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos({prev}) as cs{i} from ({text}) t{i}"""
        text = f"""select *, atan2(ss{i}, cs{i}) as sg{i}, case when ss{i} = 0 then 0 else cos(u1) * cos(u2) * sin({prev}) / ss{i} end as sa{i} from ({text}) v{i}"""
        text = f"""select *, case when sa{i} * sa{i} >= 1 then 0 else cs{i} - 2 * sin(u1) * sin(u2) / (1 - sa{i} * sa{i}) end as cm{i},
          {F} / 16 * (1 - sa{i} * sa{i}) * (4 + {F} * (4 - 3 * (1 - sa{i} * sa{i}))) as cc{i} from ({text}) w{i}"""
        if i < 6:
            text = f"""select *, dl + (1 - cc{i}) * {F} * sa{i} * (sg{i} + cc{i} * ss{i} * (cm{i} + cc{i} * cs{i} * (2 * cm{i} * cm{i} - 1))) as lam{i + 1} from ({text}) y{i}"""
    b = f"(6378137.0 * (1 - {F}))"
    text = f"select *, (1 - sa6 * sa6) * (pow(6378137.0, 2) - pow({b}, 2)) / pow({b}, 2) as us from ({text}) k"
    text = f"""select *, 1 + us / 16384 * (4096 + us * (-768 + us * (320 - 175 * us))) as big_a,
      us / 1024 * (256 + us * (-128 + us * (74 - 47 * us))) as big_b from ({text}) l"""
    return f"""select *, {half_up(f"{b} * big_a * (sg6 - big_b * ss6 * (cm6 + big_b / 4 * (cs6 * (2 * cm6 * cm6 - 1) - big_b / 6 * cm6 * (4 * ss6 * ss6 - 3) * (4 * cm6 * cm6 - 3))))", 2)} as length_meters from ({text}) m"""


CTES["q_measured"] = vincenty("q_located")
SQL["line_length"] = """
select circuit_id, count(*) as n, min(length_meters) as shortest, max(length_meters) as longest from q_measured
where length_meters is not null group by circuit_id"""
SQL["link_view"] = """
select name, cast(case when bandwidth <> '' then bandwidth end as int) as bandwidth_mbps,
  case when a_location_clli is null then split_part(name, '-', 3) else a_location_clli end as a_loc_clli,
  case when z_location_clli is null then split_part(name, '-', 4) else z_location_clli end as z_loc_clli, circuit_type,
  case when a_lon is null then 'Missing A-Location Lat/Long' when z_lon is null then 'Missing Z-Location Lat/Long'
    else 'All Geometries Present' end as geom_info,
  length_meters, case when a_lon is not null and z_lon is not null then
    printf('LINESTRING(%.9f %.9f, %.9f %.9f)', a_lon, a_lat, z_lon, z_lat) end as geom
from q_measured"""
SQL["link_public_view"] = SQL["link_view"]
SQL["disjunctive_join"] = f"select c.circuit_id, a.buildingid from fx_circuits c {end_join('a_location_clli', 3, 'a')}"

# ---------------------------------------------------------------- rank attributes


def lit_rank(restriction: str, kind: bool) -> str:
    extra = ", c_type" if kind else ""
    return f"""
select cast(l.id as varchar) as id, l.name, l.clli, l.street, l.city, l.state, l.structure, l.on_net_status,
  case when bool_or(j.clli is not null) then 'True' else 'False' end as data_consistency, count(f.license_id) as fcc_cnt{extra}
from (select buildingid as id, name, clli, street, city, state,
    case when l_type is null or pop_tf then building_type else l_type end as structure,
    case when l_type is null or pop_tf then 'ospi_buildings' else 'private_lit' end as c_type, on_net_status
  from (select n.*, l.building_type as l_type, l.on_net_status, row_number() over (partition by n.buildingid
      order by l.on_net_status nulls first, l.building_type nulls first) as rn
    from fx_buildings n left join fx_lit l on l.clli = n.name {restriction}) a where rn = 1) l
left join q_near_fcc f on f.buildingid = l.id
join (select b.name, t.clli from fx_buildings b left join fx_lit t on b.name = t.clli) j on l.name = j.name
group by l.id, l.name, l.clli, l.street, l.city, l.state, l.structure, l.on_net_status{extra}"""


def cci_rank(ids: str) -> str:
    return f"""
select distinct bus_unit as id, crown_ae, s_bu_type_code as structure, revshare, s_site_name as name, open_levels, current_tower_capacity,
  last_sa_tia_code_revision, fiber_on_site, fiber_provider, is_cci_power_available, if_no_cci_power_is_meter_avail,
  power_company, active_apps_count_on_site, cast(s_pop_tier_id as int) as pt_id, s_pop_tier_name as poptier,
  site_address as street, site_city as city, site_county, site_state as state, r.score
from fx_scrub left join fx_cci_sites on bus_unit = s_bus_unit left join fx_rankings r on s_bu_type_code = r.candidate_type
where r.candidate_source = 'cci_sites' and bus_unit in ({ids})"""


def asd_rank(ids: str) -> str:
    return f"""
select distinct mastersiteid as id, macrodealstatus as uid2, sourcesitename as name, streetaddress as street, city, state,
  structuretype as structure, cast(fiberdistance as double) as fi_dist, r.score
from fx_asd left join fx_rankings r on structuretype = r.candidate_type
where r.candidate_source = 'cci_sites' and mastersiteid in ({ids})"""


def mgt_rank(ids: str) -> str:
    return f"""
select cast(esri_prinx as varchar) as id, partner as uid2, alt_site_name as name, city, state, bu_type as structure,
  cast(nearest_cci_any_fib_dist_m as double) as fi_dist from fx_mgt where cast(esri_prinx as varchar) in ({ids})"""


SQL["lit_rank"] = lit_rank("where cast(n.buildingid as varchar) in (select id from q_lit_search)", False)
SQL["building_rank_all"] = lit_rank("", True)
SQL["cci_rank"] = cci_rank("select id from q_towers_all")
SQL["asd_rank"] = asd_rank("select id from q_asd_search")
SQL["mgt_rank"] = mgt_rank("select id from q_mgt_search")


def ranks_for(prefix: str, candidates: str) -> None:
    """Rank tables for one candidate set, and their union by name."""

    def ids(kind: str) -> str:
        return f"select id from {candidates} where candidate_type = '{kind}'"

    CTES[f"{prefix}_ospi"] = lit_rank(f"where cast(n.buildingid as varchar) in ({ids('ospi')})", False)
    CTES[f"{prefix}_re_asd"] = asd_rank(ids("re_asd"))
    CTES[f"{prefix}_re_mgt"] = mgt_rank(ids("re_mgt"))
    CTES[f"{prefix}_cci_sites"] = cci_rank(ids("cci_sites"))
    CTES[f"{prefix}_all"] = " union all by name ".join(
        f"select '{kind}' as candidate_type, * from {prefix}_{kind}" for kind in RANKS
    )


_rank_columns = list(dict.fromkeys(c for schema in RANKS.values() for c in schema if c != "id"))


def assembled(candidates: str, ranks: str, extra: str = "") -> str:
    shown = ", ".join(f"r.{c}" for c in _rank_columns if c != "open_levels")
    return f"""
select c.site_id, c.candidate_type, c.id, c.cand_dist_km, c.long, c.lat, c.height, c.vertex, c.cand_seq{extra}, {shown},
  coalesce(r.open_levels, 'NULL') as open_levels,
  case when r.open_levels is null or r.open_levels in ('NULL', 'None', 'nan') then 30.0
    else coalesce(try_cast(regexp_replace(string_split(r.open_levels, '-')[-1], '[^0-9]', '', 'g') as double) - 5, 30.0) end as tx_agl
from {candidates} c left join {ranks} r on c.candidate_type = r.candidate_type and c.id = r.id"""


ranks_for("q_plain", "q_cand")
CTES["q_plain_assembled"] = assembled("q_cand", "q_plain_all")
SQL["assembled"] = f"""
select * replace ({half_up('long', 9)} as long, {half_up('lat', 9)} as lat) from q_plain_assembled"""
SQL["unranked_sites"] = """
select site_id from q_src where site_id not in (select c.site_id from q_cand c join q_plain_all r
  on c.candidate_type = r.candidate_type and c.id = r.id)"""

# ---------------------------------------------------------------- clearance and link budget

SQL["open_levels"] = """
select bus_unit, structure_id, open_levels, case when open_levels in ('NULL', 'None', 'nan') then 30.0 else
  coalesce(try_cast(regexp_replace(string_split(open_levels, '-')[-1], '[^0-9]', '', 'g') as double) - 5, 30.0) end as tx_agl
from fx_scrub"""
CTES["q_clearance"] = """
select profile_id, case when count(*) >= 2 then min(e0 + sample_idx * (e1 - e0) / (n - 1) - elev) end as clearance
from (select *, first_value(elev) over w as e0, last_value(elev) over w as e1, count(*) over w as n from fx_profiles
  window w as (partition by profile_id order by sample_idx rows between unbounded preceding and unbounded following)) p
group by profile_id"""


def label(value: str) -> str:
    return f"case when {value} < -300 then 'Delete' when {value} < 0 then 'Fail' when {value} >= 0 then 'Pass' end"


SQL["path_clearance"] = f"""
select profile_id, height, {half_up('total', 6)} as min_clearance, {label('total')} as clearance_score
from (select m.profile_id, m.height, c.clearance + m.height as total from fx_masts m left join q_clearance c using (profile_id)) t"""
_flat = f"(1 - {F})"
CTES["q_path_points"] = f"""
select site_id, id, height, k, (degrees(atan2(y, x)) + 74.1163778) / 0.0025 as gx,
  (degrees(atan(z / ({_flat} * sqrt(x * x + y * y)))) - 40.7390831) / 0.0025 as gy
from (select *, p * cos(b1) * cos(l1) + q * cos(b2) * cos(l2) as x, p * cos(b1) * sin(l1) + q * cos(b2) * sin(l2) as y, p * sin(b1) + q * sin(b2) as z
  from (select *, case when arc = 0 then 1 - k / 199.0 else sin((1 - k / 199.0) * arc) / sin(arc) end as p,
      case when arc = 0 then k / 199.0 else sin(k / 199.0 * arc) / sin(arc) end as q
    from (select *, 2 * asin(sqrt(pow(sin((b2 - b1) / 2), 2) + cos(b1) * cos(b2) * pow(sin((l2 - l1) / 2), 2))) as arc
      from (select t.site_id, t.id, coalesce(t.height, 30) as height, radians(s.lon) as l1, radians(t.long) as l2,
          atan({_flat} * tan(radians(s.lat))) as b1, atan({_flat} * tan(radians(t.lat))) as b2
        from q_towers_all t join q_src s using (site_id)) a) b, (select cast(unnest(range(200)) as double) as k) c) d) e"""
CTES["q_path_samples"] = """
select site_id, id, height, k, case when count(elev) = 4 then sum(weight * elev) end as e
from (select p.*, t.elev, case c.i when 0 then 1 - (gy - floor(gy)) else gy - floor(gy) end * case c.j when 0 then 1 - (gx - floor(gx)) else gx - floor(gx) end as weight
  from q_path_points p, (values (0, 0), (0, 1), (1, 0), (1, 1)) as c(i, j)
  left join fx_posts t on t.row = floor(gy) + c.i and t.col = floor(gx) + c.j) w
group by site_id, id, height, k"""
SQL["terrain_clearance"] = f"""
select site_id, id, height, {half_up('total', 6)} as min_clearance, {label('total')} as clearance_score
from (select site_id, id, height, case when count(e) = 200 then min(e0 + k * (e1 - e0) / 199 - e) + height end as total
  from (select *, first_value(e) over w as e0, last_value(e) over w as e1 from q_path_samples
    window w as (partition by site_id, id order by k rows between unbounded preceding and unbounded following)) p
  group by site_id, id, height) t"""
SQL["elevation_profile"] = """
select profile_id, cast(count(*) as int) as n, string_agg(printf('%.3f', elev), ',' order by sample_idx) as elevations
from fx_profiles group by profile_id"""
CTES["q_cleared"] = f"""
select *, {label('min_clearance')} as clearance_score
from (select c.*, s.check_clearance, cast(c.id as bigint) % (select max(profile_id) + 1 from fx_masts) as profile_id,
    case when s.check_clearance then k.clearance + c.height end as min_clearance
  from q_cand c join q_src s using (site_id) left join q_clearance k on k.profile_id = cast(c.id as bigint) % (select max(profile_id) + 1 from fx_masts)) t
where min_clearance is null or min_clearance >= -300"""
SQL["clearance_filter"] = f"""
select site_id, candidate_type, id, vertex, cand_seq, {half_up('min_clearance', 6)} as min_clearance, clearance_score from q_cleared"""
SQL["link_budget_join"] = """
select c.site_id, c.candidate_type, c.id, c.vertex, b.antenna, b.capacity as speed, b.d_km, b.link_margin, b.model as equipment,
  b.modulation
from q_found c join fx_link_budget b on c.candidate_type = b.candidate_type and c.id = b.id where b.capacity is not null"""
SQL["sites_without_links"] = """
select site_id from q_src where site_id not in (select c.site_id from q_found c join fx_link_budget b
  on c.candidate_type = b.candidate_type and c.id = b.id where b.capacity is not null)"""


def linked(assembled_table: str) -> str:
    return f"""
select a.*, b.antenna, b.capacity as speed, b.d_km, b.link_margin, b.model as equipment, b.modulation
from {assembled_table} a join fx_link_budget b on a.candidate_type = b.candidate_type and a.id = b.id
where b.capacity is not null"""


def ranked(linked_table: str, clearance: str | None) -> str:
    """One row per candidate, ranked within its site by the key list of the types it has."""
    tie = ", ".join(["cand_seq", *[f"{c} nulls first" for c in sorted(_rank_columns)]])
    lead = f"case when {clearance} then clearance_score end desc nulls last, " if clearance else ""
    return f"""
select * exclude (rn, real_estate_only), row_number() over (partition by site_id order by {lead}
    fiber_on_site asc nulls last, is_cci_power_available asc nulls last, if_no_cci_power_is_meter_avail asc nulls last,
    pt_id desc nulls last, case when real_estate_only then null else score end asc nulls last, antenna asc nulls last,
    revshare desc nulls last, speed desc nulls last, fi_dist asc nulls last, fcc_cnt desc nulls last,
    {tie}, candidate_type, id) as fw_rank
from (select *, row_number() over (partition by site_id, candidate_type, id order by {tie}) as rn,
    count(*) filter (where candidate_type in ('ospi', 'cci_sites')) over (partition by site_id) = 0 as real_estate_only
  from {linked_table}) t where rn = 1"""


CTES["q_plain_linked"] = linked("q_plain_assembled")
CTES["q_plain_ranked"] = ranked("q_plain_linked", None)
ranks_for("q_run", "q_cleared")
CTES["q_run_assembled"] = assembled("q_cleared", "q_run_all", ", c.profile_id, c.check_clearance, c.min_clearance, c.clearance_score")
CTES["q_run_linked"] = linked("q_run_assembled")
CTES["q_run_ranked"] = ranked("q_run_linked", "check_clearance")
CTES["q_run_placed"] = "select a.*, r.fw_rank from q_run_linked a left join q_run_ranked r using (site_id, candidate_type, id)"
_rank_view = (
    "site_id, candidate_type, id, vertex, cand_dist_km, score, antenna, speed, fi_dist, fcc_cnt, fiber_on_site, pt_id, "
    "revshare, tx_agl"
)
SQL["fw_rank"] = f"select {_rank_view}, fw_rank from q_plain_ranked"
SQL["fw_rank_clearance"] = f"select {_rank_view}, clearance_score, fw_rank from q_run_ranked"
SQL["rank_joinback"] = "select site_id, candidate_type, id, vertex, cand_seq, tx_agl, fw_rank from q_run_placed"
for _kind, _name in (("ospi", "buildings"), ("re_asd", "asd"), ("re_mgt", "mgt"), ("cci_sites", "towers")):
    SQL[f"rank_sheet_{_name}"] = f"""
select t.*, p.site_id, p.fw_rank from q_run_{_kind} t
left join (select site_id, id, fw_rank from q_run_placed where candidate_type = '{_kind}') p on t.id = p.id"""
SQL["candidate_file"] = f"""
select site_id, candidate_type, id, {half_up('lat', 9)} as lat, {half_up('long', 9)} as long, fw_rank from q_run_placed"""
SQL["tower_scrub"] = f"select {', '.join(TOWER_SHEET)}" + " from fx_scrub where bus_unit in (select id from q_run_ranked where candidate_type = 'cci_sites')"
_sink = {
    "fw_rank": "smallint", "candidate_type": "", "id": "", "cand_dist_km": "", "long": "", "lat": "", "height": "smallint",
    "clearance_score": "", "antenna": "", "speed": "smallint", "d_km": "", "link_margin": "", "equipment": "",
    "modulation": "", "name": "", "clli": "", "street": "", "city": "", "state": "", "structure": "", "score": "double",
    "crown_ae": "", "revshare": "", "open_levels": "", "current_tower_capacity": "", "last_sa_tia_code_revision": "",
    "fiber_on_site": "", "fiber_provider": "", "is_cci_power_available": "", "if_no_cci_power_is_meter_avail": "",
    "power_company": "", "active_apps_count_on_site": "double", "pt_id": "smallint", "poptier": "", "site_county": "",
    "tx_agl": "smallint", "uid2": "", "fi_dist": "",
}


def _sunk(name: str, dtype: str) -> str:
    if name in ("long", "lat"):
        return f"{half_up(name, 9)} as {name}"
    return f"cast({name} as {dtype}) as {name}" if dtype else name


SQL["sink_rows"] = "select site_id, " + ", ".join(_sunk(n, t) for n, t in _sink.items()) + " from q_run_ranked"
SQL["candidate_points"] = """
select site_id, candidate_type, id, cast(fw_rank as smallint) as fw_rank, printf('POINT(%.9f %.9f)', long, lat) as shape from q_run_ranked"""
SQL["spider_lines"] = """
select r.site_id, r.candidate_type, r.id, printf('LINESTRING(%.9f %.9f, %.9f %.9f)', r.long, r.lat, s.lon, s.lat) as shape,
  cast(r.speed as smallint) as speed
from q_run_ranked r join q_src s using (site_id)"""
SQL["sorted_report"] = f"""
select * exclude (height, profile_id, min_clearance, clearance_score)
  replace ({half_up('long', 6)} as long, {half_up('lat', 6)} as lat)
from q_run_ranked"""
SQL["stage_counts"] = """
select site_id, stage, count(*) as n from (select site_id, 'candidates' as stage from q_cleared
  union all select site_id, 'linked' from q_run_linked union all select site_id, 'ranked' from q_run_ranked) t
group by site_id, stage"""
SQL["candidate_pairs"] = """
select cast(floor((row_number() over (order by h) - 1) / 2) as bigint) as pair, site_id, candidate_type, id, vertex
from (select *, md5(concat_ws('|', site_id, candidate_type, id, vertex, '7')) as h from q_cand order by h limit 10) t"""
SQL["column_widths"] = " union all ".join(
    f"select '{c}' as column_name, cast(greatest(max(length(coalesce(cast({c} as varchar), 'None'))), {len(c)}) + 1 as int) as width from fx_scrub"
    for c in TOWER_SHEET
)

# ---------------------------------------------------------------- classification reports
# Colours by lookup: (rule, value, colour); values that are not listed take the rule's default.

_COLOURS = {
    "masts": {"GUYED": "GREEN", "MONOPOLE": "GREEN", "SELF SUPPORT": "GREEN", "DAS NODE": "RED", "ROOFTOP": "RED",
              "SINGLE USE": "RED", "STEALTH": "RED", "COMPOUND": "YELLOW", "OTHER": "YELLOW", "UNCLASSIFIED": "YELLOW"},
    "old_masts": {"GUYED": "GREEN", "MONOPOLE": "GREEN", "SELF SUPPORT": "GREEN", "DAS": "RED", "ROOFTOP": "RED",
                  "SINGLE USE": "RED", "STEALTH": "RED", "COMPOUND": "YELLOW", "OTHER": "YELLOW", "UNCLASSIFIED": "YELLOW"},
    "consent": {"Consent - No Standard Specified (NTBUW)": "YELLOW", "Consent - Non-Standard Requirement": "YELLOW",
                "Consent - NTBUW": "YELLOW", "Notice": "YELLOW", "Consent - Sole Discretion": "RED"},
    "consent_exact": {"Consent - No Standard Specified (NTBUW)": "YELLOW", "Consent - Non-Standard Requirement": "YELLOW",
                      "Consent - NTBUW": "YELLOW", "Notice": "YELLOW", "Consent - Sole Discretion": "RED",
                      "Consent - Intercompany": "GREEN", "No Consent or Notice Required": "GREEN",
                      "No Consent or Notice Required - IC Blanket Agreement": "GREEN",
                      "No Consent or Notice Required - Silent": "GREEN"},
    "zoning": {"Admin": "YELLOW", "Concurrent": "YELLOW", "Full": "YELLOW", "Over Counter": "YELLOW", "No Zoning": "GREEN"},
    "permit": {"BP": "YELLOW", "BP + EP": "YELLOW", "Other": "YELLOW", "BP + Other": "YELLOW", "Electrical": "YELLOW",
               "None": "GREEN"},
    "permit_red": {"None": "GREEN"},
    "permit_graded": {"BP + EP": "YELLOW", "Other": "YELLOW", "BP + Other": "YELLOW", "Electrical": "YELLOW", "None": "GREEN"},
    "yes_no": {"No": "GREEN", "Yes": "RED"},
    "property": {"MANAGED": "YELLOW", "LEASED": "GREEN"},
}


def painted(rule: str, column: str, default: str | None) -> str:
    pairs = ", ".join(f"'{v}': '{c}'" for v, c in _COLOURS[rule].items())
    found = f"(map {{{pairs}}})[{column}]"
    return f"coalesce({found}, '{default}')" if default is not None else found


def ten(bird_null: str | None, faa_other: str, permit: str) -> dict[str, str]:
    bird = "if(open_bird_ticket = 'Y', 'RED', 'GREEN')"
    if bird_null is None:
        bird = f"case when open_bird_ticket is not null then {bird} end"
    return {
        "struc_type_clr": painted("masts", "s_structure_type", "RED"),
        "bird_ticket_clr": bird,
        "faa_clr": f"if(coalesce(faa_study_number, '') = '', 'GREEN', '{faa_other}')",
        "consent_clr": painted("consent", "sublease_consent_type", "GREEN"),
        "capacity_clr": "if(current_tower_capacity is null, 'RED', 'GREEN')",
        "legal_clr": painted("yes_no", "coalesce(legal_issue_flag, 'No')", None),
        "zoning_clr": painted("zoning", "zoning_collo_process_type", "GREEN"),
        "permit_clr": painted(permit, "bp_collo_permit_type", "RED"),
        "status_clr": "if(coalesce(site_status, '') = 'Active', 'GREEN', 'RED')",
        "am_study_clr": painted("yes_no", "coalesce(am_study_required, 'No')", None),
    }


def base(columns) -> str:
    return ", ".join(columns)


_structures = f"structure_id in ({listed([*'ABCDEFG', *[f'C{i}' for i in range(1, 21)]])})"
CTES["q_sales"] = f"select * from fx_scrub join fx_cci_sites on bus_unit = s_bus_unit where {_structures}"
_no_scrub = [c for c in REPORT_A if c not in ("crown_ae", "legal_issue_flag")]
SQL["vector_base"] = f"select {base(_no_scrub)} from q_sales"


def report(columns, colours: dict[str, str], towers: bool, category: bool, fibre: bool, shown: bool = True) -> str:
    text = f"select {base(columns)}, {', '.join(f'{v} as {k}' for k, v in colours.items())} from q_sales"
    if towers:
        text += " where s_bu_type_code in ('TW', 'RT')"
    extra = ""
    if category:
        greens = " + ".join(f"if({c} = 'GREEN', 1, 0)" for c in colours)
        reds = " + ".join(f"if({c} = 'RED', 1, 0)" for c in colours)
        extra += f", case when {greens} = {len(colours)} then 'GREEN' when {reds} > 0 then 'RED' else 'YELLOW' end as vector_category"
    if fibre:
        named = "regexp_matches(lower(fiber_provider), 'fiber app|crown castle|lightower|sunesys|wilcon')"
        extra += f""", case when fiber_on_site = 'No' then 'UNLIT' when fiber_on_site is distinct from 'Yes' then null
          when {named} then 'LIT' when not {named} then 'LIT RESTRICTED' end as fw_type"""
    hidden = "" if shown else f" exclude ({', '.join(colours)})"
    return f"select *{hidden}{extra} from ({text}) t"


_b = ten("GREEN", "RED", "permit_red")
_e = ten(None, "RED", "permit_red")
SQL["vector_a"] = report(REPORT_A, dict(list(_e.items())[:8]), False, False, False)
SQL["vector_b"] = report(REPORT_B, _b, True, True, True)
SQL["vector_c"] = report(REPORT_B, _b, False, True, True)
SQL["vector_d"] = report(REPORT_B, ten("GREEN", "YELLOW", "permit_graded"), True, True, True, False)
SQL["vector_e"] = (
    f"select * replace ({half_up('s_long_dec', 9)} as s_long_dec, {half_up('s_lat_dec', 9)} as s_lat_dec),"
    " printf('POINT(%.9f %.9f)', s_long_dec, s_lat_dec) as geom from ("
    + report((*REPORT_B, "s_bu_type_code", "s_long_dec", "s_lat_dec"), _e, True, True, False) + ") e"
)
_tier = "(select s_bus_unit from fx_cci_sites where s_pop_tier_id = '1')"
SQL["vector_a_units"] = f"select * from ({SQL['vector_a']}) a where bus_unit in {_tier}"
SQL["vector_e_units"] = f"select * from ({SQL['vector_e']}) e where bus_unit in {_tier}"
_capacity = """case when current_tower_capacity is null or current_tower_capacity = 'N/A' then ''
  when current_tower_capacity >= '200' then 'RED' else 'GREEN' end"""


def y_red(column: str) -> str:
    return f"case when {column} is null then '' when {column} = 'Y' then 'RED' else 'GREEN' end"


def one_green(column: str) -> str:
    return f"case when {column} is null then '' when {column} = '1' then 'GREEN' else 'RED' end"


def blank_green(column: str) -> str:
    return f"case when {column} is null then '' when length({column}) = 0 then 'GREEN' else 'RED' end"


def day_span(later: str, earlier: str) -> str:
    """Whole days towards zero."""
    return f"cast(trunc((epoch_us({later}) - epoch_us({earlier})) / 86400e6) as bigint)"


_lease = """case when fle is null then '' when {d} >= 1825 then 'GREEN' when {d} > 0 then 'YELLOW' end"""
_f_rules = {
    "struc_type_clr": painted("old_masts", "s_structure_type", ""),
    "stealth_twr_ind_clr": y_red("stealth_tower_ind"),
    "site_flag_clr": one_green("s_site_flag"),
    "faa_study_clr": blank_green("faa_study_number"),
    "open_bird_ticket_clr": y_red("open_bird_ticket"),
    "property_interest_clr": painted("property", "primary_property_interest", ""),
    **{f"{c}_clr": painted("zoning", c, "") for c in
       ("zoning_collo_process_type", "zoning_ant_add_process_type", "zoning_ant_swap_process_type")},
    "bp_collo_permit_type_clr": painted("permit", "bp_collo_permit_type", ""),
    "bp_ant_add_permit_type_clr": painted("permit", "bp_ant_add_permit_type", ""),
    "bp_ant_swap_permit_type_clr": painted("permit", "bp_collo_permit_type", ""),
    "consent_summary_clr": painted("consent_exact", "sublease_consent_type", ""),
    "current_twr_capacity_clr": _capacity,
    "fle_clr": _lease.format(d=day_span("fle", "timestamp '1993-08-01 06:00:00'")),
}
SQL["vector_f"] = report(REPORT_F, _f_rules, False, False, False)

CTES["q_asof"] = """
select *, (select max(fle) from fx_scrub) - to_days(cast([-1, 10, 1825, 2000][1 + active_apps_count_on_site % 4] as int))
  - to_hours(6) as as_of from fx_scrub"""
_two_way = "if(diff >= 1825, 'GREEN', 'YELLOW') as fle_clr"
SQL["fle_days"] = f"""
select *, {_two_way} from (select bus_unit, structure_id, {day_span('fle', 'as_of')} as diff from q_asof where fle is not null) t"""
SQL["fle_fraction"] = f"""
select *, {_two_way} from (select bus_unit, structure_id, (epoch_us(fle) - epoch_us(as_of)) / 86400e6 as diff from q_asof
  where fle is not null) t"""
SQL["lease_colours"] = f"""
select bus_unit, structure_id, active_apps_count_on_site, {_lease.format(d=day_span('fle', 'as_of'))} as fle_clr from q_asof"""

_renamed = {
    "site_flag": "si.site_flag", "structure_type": "st.structure_type", "stealth_tower_ind": "st.stealth_tower_ind",
    "structure_id": "st.structure_id", "faa_approved_height": "st.faa_apprv_hgt", "tower_height_w_appurt": "st.hgt_with_appurt",
    "tower_height_wout_appurt": "st.hgt_no_appurt", "ground_elevation": "st.ground_elev",
    "faa_lighting_requirement": "st.faa_twr_lighting_req", "man_lift_req": "us.man_lift_rqrd_ind",
    "nearest_airport_distance": "st.airport_dist", "am_study_required": "st.am_dtnng_eqpt_ind", "faa_study_number": "st.faa_study_num",
    "stealth_tower_type_lkup_code": "st.stealth_tower_type_lkup_code",
}
CTES["q_structures"] = f"""
select {', '.join(f"{_renamed.get(c, 'm.' + c)} as {c}" for c in REPORT_G)}
from fx_scrub m, fx_site si, fx_structure st, fx_us_structure us
where m.bus_unit = si.bus_unit and si.site_flag = '1' and m.bus_unit = st.bus_unit and st.bus_unit = us.bus_unit
  and st.structure_id = us.structure_id and st.{_structures}"""
SQL["structure_base"] = "select * from q_structures"
_old_consent = {
    "Consent - Deemed Approved": "YELLOW", "Consent - Intercompany": "GREEN", "Consent - No Standard Specified (NTBUW)": "YELLOW",
    "Consent - Non-Standard Requirement": "YELLOW", "Consent  NTBUW": "YELLOW", "Consent - Sole Discretion": "RED",
    "No Consent or Notice Required": "GREEN", "No Consent or Notice Required - IC Blanket Agreement": "GREEN",
    "No Consent or Notice Required  Silent": "GREEN", "Notice": "YELLOW",
}
_COLOURS["old_consent"] = _old_consent
_fle_num = "date_diff('day', date '2021-06-20', cast(fle as date))"
_g_rules = {
    "structure_type_col": painted("old_masts", "structure_type", ""),
    "stealth_tower_ind_col": y_red("stealth_tower_ind"),
    "site_flag_col": one_green("site_flag"),
    "faa_study_number_col": blank_green("faa_study_number"),
    "open_bird_ticket_col": y_red("open_bird_ticket"),
    **{f"{c}_col": painted("zoning", c, "") for c in
       ("zoning_collo_process_type", "zoning_ant_add_process_type", "zoning_ant_swap_process_type")},
    **{f"{c}_col": painted("permit", c, "") for c in
       ("bp_collo_permit_type", "bp_ant_add_permit_type", "bp_ant_swap_permit_type")},
    "consent_summary_col": painted("old_consent", "bp_ant_swap_permit_type", ""),
    "current_tower_capacity_col": _capacity,
    "primary_property_interest_col": """case when primary_property_interest = 'MANAGED' then 'YELLOW'
      when primary_property_interest >= 'LEASED' then 'GREEN' else '' end""",
    "fle_num": _fle_num,
    "fle_col": f"case when fle is null then '' when {_fle_num} >= 1825 then 'GREEN' else 'YELLOW' end",
}
CTES["q_structure_report"] = f"select *, {', '.join(f'{v} as {k}' for k, v in _g_rules.items())} from q_structures"
SQL["vector_g"] = "select * from q_structure_report"
_cells = {
    "structure_type_col": "structure_type", "stealth_tower_ind_col": "stealth_tower_ind", "site_flag_col": "site_flag",
    "current_tower_capacity_col": "current_tower_capacity", "faa_study_number_col": "faa_study_number",
    "open_bird_ticket_col": "open_bird_ticket", "fle_col": "fle", "primary_property_interest_col": "primary_property_interest",
    "zoning_collo_process_type_col": "zoning_collo_process_type", "zoning_ant_add_process_type_col": "zoning_ant_add_process_type",
    "zoning_ant_swap_process_type_col": "zoning_ant_swap_process_type", "bp_collo_permit_type_col": "bp_collo_permit_type",
    "bp_ant_add_permit_type_col": "bp_ant_add_permit_type", "bp_ant_swap_permit_type_col": "bp_ant_swap_permit_type",
    "consent_summary_col": "consent_summary",
}
SQL["cell_highlights"] = f"""
select bus_unit, structure_id, case when rule = 'fle_col' and background = 'YELLOW' then 'open_bird_ticket' else cell end as cell,
  rule, background, if(background = 'YELLOW', 'BLACK', 'WHITE') as foreground
from ({' union all '.join(f"select bus_unit, structure_id, '{cell}' as cell, '{rule}' as rule, {rule} as background from q_structure_report" for rule, cell in _cells.items())}) t
where background <> ''"""
