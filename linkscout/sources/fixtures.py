"""Test views derived from the driver tables.

Every view is one SELECT that Spark and DuckDB both accept, so an oracle can use the same text as a CTE.
Table names are written as ``{table}``; Spark binds them to DataFrames, DuckDB sees the bare name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from linkscout.operators.skew import read_spread


def _lon(key: str) -> str:
    return f"(cast(-73.9913778 as double) + ((({key}) * 7919) % 20011 - 10005) * cast(0.00001 as double))"


def _lat(key: str) -> str:
    return f"(cast(40.7390831 as double) + ((({key}) * 6271) % 20021 - 10010) * cast(0.00001 as double))"


def _pick(key: str, *values: str | None) -> str:
    arms = " ".join(
        f"when {i} then " + ("null" if v is None else "'" + v + "'") for i, v in enumerate(values)
    )
    return f"case ({key}) % {len(values)} {arms} end"


# The business vocabulary the colour rules react to, plus one unknown value and NULL each.
CONSENT_TYPES = (
    "No Consent or Notice Required", "Consent - Intercompany", "Consent - No Standard Specified (NTBUW)",
    "Consent - Non-Standard Requirement", "Consent - NTBUW", "Notice", "Consent - Sole Discretion",
    "No Consent or Notice Required - Silent", "Unknown", None,
)
ZONING_TYPES = ("Admin", "Concurrent", "Full", "Over Counter", "No Zoning", "Odd", None)
PERMIT_TYPES = ("BP", "BP + EP", "Other", "BP + Other", "Electrical", "None", "Odd", None)

VIEWS: dict[str, str] = {}

VIEWS["fx_sources"] = f"""
select cast(s_suppkey as string) as site_id, {_lon('s_suppkey * 13 + 5')} as lon, {_lat('s_suppkey * 13 + 5')} as lat,
  cast(s_suppkey % 14 - 1 as int) as radius_raw, cast(5 + s_suppkey % 20 as int) as max_neighbors,
  (s_suppkey % 2 = 0) as include_non_lit, (s_suppkey % 3 = 0) as limit_by_type,
  cast(3 as int) as max_lit, cast(4 as int) as max_re, cast(5 as int) as max_cci,
  cast(900 as int) as min_speed, (s_suppkey % 4 = 0) as check_clearance,
  'Site (' || cast(s_suppkey as string) || ')/' || s_name as project_name
from {{supplier}}"""

VIEWS["fx_buildings"] = f"""
select buildingid, name, name_raw, name as clli, street, city, state, building_type, pop_tf,
  case when buildingid % 31 = 0 then clon + 3 * hw else clon end as lon, clat as lat,
  clon - hw as x0, clat - hh * 0.8 as y0, clon + hw * 0.9 as x1, clat - hh as y1,
  clon + hw as x2, clat + hh * 0.7 as y2, clon - hw * 0.6 as x3, clat + hh as y3
from (select p_partkey as buildingid,
    case when p_partkey % 97 = 0 then null else 'B' || cast(k as string) end as name,
    case when p_partkey % 97 = 0 then null when p_partkey % 3 = 0 then ' b' || cast(k as string) || ' '
      else 'B' || cast(k as string) end as name_raw,
    cast(p_partkey as string) || ' Main St' as street, p_brand as city, 'NY' as state, p_type as building_type,
    (p_size % 5 = 0) as pop_tf, {_lon('k')} as clon, {_lat('k')} as clat,
    (1 + p_size % 7) * cast(0.00003 as double) as hw, (1 + p_size % 5) * cast(0.00003 as double) as hh
  from (select *, case when p_partkey % 20 = 1 then p_partkey - 1 else p_partkey end as k from {{part}}) p0) p1"""

VIEWS["fx_lit"] = f"""
select 'B' || cast(c_custkey - c_custkey % 2 as string) as clli,
  case when c_custkey % 5 = 0 then null else c_mktsegment end as building_type,
  {_pick('c_custkey', 'ON-NET', 'NEAR-NET', 'OFF-NET', None)} as on_net_status
from {{customer}}"""

VIEWS["fx_crm"] = f"""
select 'B' || cast(c_custkey as string) as clli,
  {_pick('c_custkey', 'TYPE II', 'ON-NET', 'OFF-NET (Restricted)', None, '13', 'NEAR-NET')} as on_net_status
from {{customer}}"""

# Licences: points, lines of three corners, and areas of four, a third of which have a hole of half their size.
VIEWS["fx_fcc"] = f"""
select license_id, lon, lat, kind, case when kind = 'area' and license_id % 3 = 0 then 1 else 0 end as has_hole,
  lon - w as x0, lat - h as y0, lon + w as x1, case when kind = 'line' then lat + h * 0.3 else lat - h * 0.8 end as y1,
  case when kind = 'line' then lon + w * 0.2 else lon + w * 0.9 end as x2, lat + h as y2, lon - w * 0.7 as x3, lat + h * 0.9 as y3
from (select o_orderkey as license_id, {_pick('o_orderkey', 'point', 'point', 'point', 'line', 'point', 'area', 'point', 'point', None, 'point')} as kind,
    {_lon('o_custkey')} + ((o_orderkey * 31) % 201 - 100) * cast(0.000005 as double) as lon,
    {_lat('o_custkey')} + ((o_orderkey * 17) % 201 - 100) * cast(0.000005 as double) as lat,
    case when o_orderkey % 500 in (5, 13) then cast(0.02 as double) else (1 + o_custkey % 20) * cast(0.00013 as double) end as w,
    case when o_orderkey % 500 in (5, 13) then cast(0.017 as double) else (1 + o_custkey % 17) * cast(0.00011 as double) end as h
  from {{orders}}) o"""

VIEWS["fx_asd"] = f"""
select cast(o_orderkey as string) as mastersiteid, {_lon('o_orderkey')} as lon, {_lat('o_orderkey')} as lat,
  floor({_lon('o_orderkey')} * 10000 + 0.5) / 10000 as londec, floor({_lat('o_orderkey')} * 10000 + 0.5) / 10000 as latdec,
  case when o_orderkey % 3 = 0 then null else cast(20 + o_orderkey % 200 as double) end as height,
  o_orderstatus as macrodealstatus, 'ASD ' || cast(o_orderkey as string) as sourcesitename,
  'Street ' || cast(o_custkey as string) as streetaddress, 'City' as city, 'NY' as state,
  {_pick('o_custkey', 'TW', 'RT', 'DN', None)} as structuretype, floor(o_totalprice / 10) / 10 as fiberdistance
from {{orders}}"""

VIEWS["fx_mgt"] = f"""
select o_orderkey as esri_prinx,
  floor({_lon('o_orderkey')} * 111319.49079327358 * 1000 + 0.5) / 1000 as geom_x,
  floor(ln(tan(radians(45 + {_lat('o_orderkey')} / 2))) * 6378137.0 * 1000 + 0.5) / 1000 as geom_y,
  {_lon('o_orderkey')} as lng_num, {_lat('o_orderkey')} as lat_num,
  case when o_orderkey % 4 = 0 then null else cast(50 + o_orderkey % 300 as double) end as bld_hgt_num,
  o_orderpriority as partner, 'MGT ' || cast(o_orderkey as string) as alt_site_name, 'City' as city, 'NY' as state,
  {_pick('o_custkey', 'RT', 'TW', 'OF')} as bu_type, floor(o_totalprice / 5) / 10 as nearest_cci_any_fib_dist_m
from {{orders}}"""

VIEWS["fx_cci_sites"] = f"""
select cast(800000 + c_custkey as string) as s_bus_unit, {_lon('c_custkey * 3 + 1')} as s_long_dec,
  {_lat('c_custkey * 3 + 1')} as s_lat_dec,
  case when c_custkey % 6 = 0 then null else cast(30 + c_custkey % 120 as double) end as s_hgt_no_appurt,
  cast(40 + c_custkey % 120 as double) as s_hgt_with_appurt,
  {_pick('c_custkey', 'TW', 'RT', 'DN', 'TW', 'RT')} as s_bu_type_code,
  case when c_custkey % 7 = 0 then 0 else 1 end as s_external_flag,
  case when c_custkey % 11 = 0 then null else 'Y' end as s_open_space, c_name as s_site_name,
  {_pick('c_custkey', '1', '0', None)} as s_site_flag, cast(c_custkey % 4 as string) as s_pop_tier_id,
  'Tier' as s_pop_tier_name,
  case when c_custkey % 5 = 0 then 'MONOPOLE' else
    {_pick('c_custkey', 'GUYED', 'MONOPOLE', 'SELF SUPPORT', 'DAS NODE', 'DAS', 'ROOFTOP', 'SINGLE USE',
           'STEALTH', 'COMPOUND', 'OTHER', 'UNCLASSIFIED', 'SILO', None)} end as s_structure_type
from {{customer}}"""

# Columns that reports only pass through.
PLAIN_COLUMNS = """
consent_summary crown_district lats longs portfolio site_county site_state site_zip marketable power_company available_telco_provider
revshare_split landlord_name leased_area_sq_ft compound_sq_ft compnd_expand avail_ground_space_com add_land_option option_sq_ft
config_changes_consent_type loa_required zoning_jurisdiction zoning_ground_process_type permit_jurisdiction bp_ground_permit_type
tower_lighted largest_length largest_width tower_only stealth_structure_type faa_approved_height ground_elevation
nearest_airport_distance site_on_si_tracker abandoned_equipment_on_tower sa_on_file modification_expected can_it_be_ibm
hist_migratory_bird_issues validated_fcc_registration empty_shelter_avail is_there_ccishelter_on_site meter_account_owner
meter_account_number meter_local_utility_number faa_lighting_requirement man_lift_req structure_type tower_height_w_appurt
zoning_collo_duration bp_collo_duration last_sa_tia_code_revision loa_notes site_address
""".split()


def _plain(key: str, names: list[str]) -> str:
    """Text that differs from column to column and row to row, NULL now and then."""
    return ",\n  ".join(
        f"case when ({key}) % {5 + i % 7} = 0 then null else '{n[:4]} ' || cast(({key} + {i}) % {11 + i % 13} as string) end as {n}"
        for i, n in enumerate(names)
    )


VIEWS["fx_scrub"] = f"""
select cast(800000 + c_custkey as string) as bus_unit,
  {_pick('h', 'A', 'B', 'C1', 'C20', 'G', 'Z9', 'C7')} as structure_id, c_name as crown_ae,
  case when g then 'Active' else {_pick('h', 'Active', 'Inactive', None)} end as site_status,
  case when g then {_pick('h', 'N', None)} else {_pick('h', 'Y', 'N', None)} end as open_bird_ticket,
  case when g then {_pick('h', '', None)} else {_pick('h', '', 'FAA-1', None, 'FAA-2')} end as faa_study_number,
  {_pick('h', *CONSENT_TYPES)} as sublease_consent_type,
  case when g then '90' else {_pick('h', 'N/A', '90', '150', '1000', '200', None)} end as current_tower_capacity,
  case when g then {_pick('h', 'No', None, 'Maybe', 'No')} else {_pick('h', 'Yes', 'No', None, 'Maybe')} end as legal_issue_flag,
  case when g then {_pick('h', 'No', None)} else {_pick('h', 'Yes', 'No', None)} end as am_study_required,
  {_pick('h', *ZONING_TYPES)} as zoning_collo_process_type,
  {_pick('h + 1', *ZONING_TYPES)} as zoning_ant_add_process_type,
  {_pick('h + 2', *ZONING_TYPES)} as zoning_ant_swap_process_type,
  case when g then {_pick('h', 'None', 'None', 'BP + EP')} else {_pick('h', *PERMIT_TYPES)} end as bp_collo_permit_type,
  {_pick('h + 1', *PERMIT_TYPES)} as bp_ant_add_permit_type,
  {_pick('h + 2', *PERMIT_TYPES)} as bp_ant_swap_permit_type,
  {_pick('h', 'MANAGED', 'LEASED', 'OWNED', None)} as primary_property_interest,
  {_pick('h', 'Y', 'N', None)} as stealth_tower_ind,
  {_pick('h', 'Yes', 'No', None)} as fiber_on_site,
  {_pick('h', 'CROWN CASTLE', 'Lightower East', 'FPL FiberNet', 'Sunesys', 'Zayo', 'WILCON / Fiber App', None)} as fiber_provider,
  {_pick('h', 'Yes', 'No', None)} as is_cci_power_available,
  {_pick('h', 'No', 'Yes', None)} as if_no_cci_power_is_meter_avail,
  {_pick('h', '30 - 115 FT , 117 - 125 FT , 129 - 150 FT', '10 - 45 FT', 'NULL', 'none', '60 FT', None)} as open_levels,
  cast(h % 3 as string) as revshare, cast(h % 9 as int) as active_apps_count_on_site,
  case when h % 8 = 0 then null
    else (select max(o_orderdate) from {{orders}}) + interval '1' day * cast((h * 53) % 13001 - 2000 as int) end as fle,
  {_plain('h', PLAIN_COLUMNS)},
  'Area ' || cast(h % 5 as string) as crown_area, 'City ' || cast(h % 13 as string) as site_city
from (select c_custkey, c_name, n, c_custkey * 11 + n * 5 as h, (c_custkey % 5 = 0) as g
  from (select c_custkey, c_name, 0 as n from {{customer}}
    union all select c_custkey, c_name, 1 as n from {{customer}}) s) t"""

VIEWS["fx_rankings"] = """
select case when r_regionkey < 2 then 'cci_sites' else 'ospi' end as candidate_source,
  case r_regionkey when 0 then 'TW' when 1 then 'RT' when 2 then 'DN' when 3 then 'OF' else null end as candidate_type,
  cast(r_regionkey + 1 as int) as score
from {region}"""

VIEWS["fx_circuits"] = """
select l_orderkey * 10 + l_linenumber as circuit_id,
  'FW-' || cast(l_orderkey as string) || '-B' || cast(l_partkey as string) || '-B' || cast(l_suppkey * 3 as string) as name,
  case when l_partkey % 5 = 0 then '' else cast(cast(l_quantity as int) * 100 as string) end as bandwidth,
  case when l_partkey % 4 = 3 then 'Dark Fiber' else 'Fixed Wireless Link' end as circuit_type,
  case when l_partkey % 3 = 0 then null else 'B' || cast(l_partkey + l_linenumber % 2 as string) end as a_location_clli,
  case when l_suppkey % 3 = 0 then null else 'B' || cast(l_suppkey * 3 as string) end as z_location_clli
from {lineitem}"""

# A stored terrain profile has a bounded length (the lookup service returns 200 samples); here 64.
VIEWS["fx_profiles"] = """
select cast((event_id - event_id % 64) / 64 as bigint) as profile_id, cast(event_id % 64 as int) as sample_idx,
  value * 12 as elev
from {events}"""

# Posts of a terrain grid, 100 to a row; rows lie north and south of the middle in turn. One in 400 is missing.
VIEWS["fx_posts"] = """
select cast(case when r % 2 = 0 then r / 2 else -(r + 1) / 2 end as bigint) as row, cast(event_id % 100 as bigint) as col, value * 3 as elev
from (select event_id, value, floor(event_id / 100) as r from {events}) e where event_id % 400 <> 111"""

VIEWS["fx_masts"] = """
select distinct cast((event_id - event_id % 64) / 64 as bigint) as profile_id,
  cast(10 + cast((event_id - event_id % 64) / 64 as bigint) % 50 as double) as height
from {events}"""

VIEWS["fx_link_budget"] = f"""
select candidate_type, id, 'ANT' || cast(h % 4 as string) as antenna,
  case when h % 9 = 0 then null else cast(100 * (1 + h % 10) as int) end as capacity, (h % 997) / cast(100 as double) as d_km,
  (h % 41) / cast(4 as double) as link_margin, 'EH-8010' as model, 'QAM' || cast(h % 3 as string) as modulation
from (select 'ospi' as candidate_type, cast(p_partkey as string) as id, p_partkey as h from {{part}}
  union all select 'cci_sites', cast(800000 + c_custkey as string), c_custkey from {{customer}}
  union all select 're_asd', cast(o_orderkey as string), o_orderkey from {{orders}}
  union all select 're_mgt', cast(o_orderkey as string), o_orderkey from {{orders}}) t"""

# Replies of the link-budget and elevation services as they were stored, one text per candidate and path.
VIEWS["fx_link_replies"] = """
select l_orderkey * 10 + l_linenumber as reply_id,
  '{{"capacity": ' || cast(100 * (1 + l_partkey % 10) as string) || ', "d_km": ' || cast(l_suppkey % 9 as string) || '.5'
  || ', "link_margin": ' || cast(l_partkey % 40 as string) || '.25, "model": "EH-' || cast(l_linenumber as string) || '"'
  || case when l_partkey % 7 = 0 then '' else ', "modulation": "QAM' || cast(l_suppkey % 4 as string) || '"' end
  || case when l_orderkey % 50 = 7 then '' else ', "rain_attenuation_km": ' || cast(l_linenumber as string) || '.125}}' end as reply
from {lineitem}"""

VIEWS["fx_elevation_replies"] = """
select o_orderkey as path_id, '{{"results": [{{"elevation": ' || cast(o_custkey % 90 as string) || '.5}}, {{"elevation": '
  || cast(o_orderkey % 70 as string) || '.25, "resolution": 9.5}}, {{"elevation": ' || cast(o_custkey % 50 as string) || case when o_orderkey % 64 = 5 then '.x' else '' end || '}}], "status": "OK"}}' as reply
from {orders}"""

# Search sites as drawn in three coordinate systems (degrees, web mercator metres, UTM zone 18N metres).
VIEWS["fx_site_features"] = f"""
select cast(s_suppkey as string) as site_id,
  cast(case s_suppkey % 3 when 0 then 4326 when 1 then 3857 else 32618 end as int) as epsg,
  case s_suppkey % 3 when 0 then {_lon('s_suppkey')} when 1 then -8236000 + (s_suppkey * 37) % 5000
    else 585000.5 + (s_suppkey * 53) % 9000 end as x,
  case s_suppkey % 3 when 0 then {_lat('s_suppkey')} when 1 then 4975000 + (s_suppkey * 41) % 5000
    else 4510000.25 + (s_suppkey * 59) % 9000 end as y
from {{supplier}}"""

# Building outlines with damage: self-crossing, repeated corners, a corner missing, a bad number.
VIEWS["fx_outlines"] = """
select buildingid, name, clli, street, city, state, pop_tf, building_type, x0, y0,
  buildingid + 1000000 as id, cast(10000 + buildingid % 900 as string) as zip, 'WO-' || cast(buildingid % 77 as string) as workorder,
  case when buildingid % 3 = 0 then null else 'L' || cast(buildingid % 4 as string) end as security_level,
  case when buildingid % 7 = 0 then 'rear, door ' || cast(buildingid % 9 as string) else null end as address_notes,
  buildingid * 3 as legacy_fid, case when buildingid % 5 = 0 then 'OLD CO' else null end as legacy_owner,
  case when buildingid % 41 = 0 then x2 when buildingid % 43 = 0 then x0 else x1 end as x1,
  case when buildingid % 41 = 0 then y2 when buildingid % 43 = 0 then y0 else y1 end as y1,
  case when buildingid % 41 = 0 then x1 when buildingid % 43 = 0 then x0 else x2 end as x2,
  case when buildingid % 41 = 0 then y1 when buildingid % 43 = 0 then y0 else y2 end as y2,
  case when buildingid % 47 = 0 then cast('NaN' as double) when buildingid % 37 = 0 then x2 else x3 end as x3,
  case when buildingid % 37 = 0 then y2 else y3 end as y3,
  case when buildingid % 5 = 0 then 1 else 0 end as is_closed
from {fx_buildings}"""

VIEWS["fx_site"] = """
select s_bus_unit as bus_unit, s_site_flag as site_flag from {fx_cci_sites}"""

VIEWS["fx_structure"] = """
select bus_unit, structure_id, s_structure_type as structure_type, stealth_tower_ind, faa_study_number as faa_study_num,
  s_hgt_with_appurt as hgt_with_appurt, s_hgt_no_appurt as hgt_no_appurt, am_study_required as am_dtnng_eqpt_ind,
  faa_approved_height as faa_apprv_hgt, ground_elevation as ground_elev, faa_lighting_requirement as faa_twr_lighting_req,
  nearest_airport_distance as airport_dist, stealth_structure_type as stealth_tower_type_lkup_code
from {fx_scrub} b join {fx_cci_sites} s on b.bus_unit = s.s_bus_unit"""

VIEWS["fx_us_structure"] = """
select bus_unit, structure_id, case when active_apps_count_on_site % 2 = 0 then 'Y' else 'N' end as man_lift_rqrd_ind
from {fx_scrub}"""

# Hex points with coordinates -(64 + k / 1024) and 32 + j / 2048, whose bit patterns are simple: sign and exponent take
# three hex digits, k or j the next four, and the rest is zero.
VIEWS["fx_hex_points"] = """
select point_id, k, j, '0101000020E6100000'
  || '00000000' || substr(hk, 4, 1) || '0' || substr(hk, 2, 2) || '5' || substr(hk, 1, 1) || 'C0'
  || '00000000' || substr(hj, 4, 1) || '0' || substr(hj, 2, 2) || '4' || substr(hj, 1, 1) || '40' as pnt_geom
from (select point_id, k, j, lpad(hex(k), 4, '0') as hk, lpad(hex(j), 4, '0') as hj
  from (select p_partkey as point_id, (p_partkey * 37) % 65536 as k, (p_partkey * 101) % 65536 as j from {part}) a) b"""

# Lines, areas and collections from the same points, and lines with the first byte first and without SRID.
VIEWS["fx_hex_shapes"] = """
select shape_id, k0, j0, k1, j1, k2, j2, case shape_id % 4
  when 0 then '0102000020E610000002000000' || t0 || t1
  when 1 then '0103000020E61000000100000004000000' || t0 || t1 || t2 || t0
  when 2 then '0107000020E6100000020000000101000000' || t0 || '010200000002000000' || t1 || t2
  else '000000000200000002' || 'C05' || substr(hk, 1, 1) || substr(hk, 2, 2) || substr(hk, 4, 1) || '000000000'
    || '404' || substr(hj, 1, 1) || substr(hj, 2, 2) || substr(hj, 4, 1) || '000000000' || 'C050000000000000' || '4040000000000000' end as geom
from (select a.point_id as shape_id, a.k as k0, a.j as j0, b.k as k1, b.j as j1, c.k as k2, c.j as j2, substr(a.pnt_geom, 19) as t0,
    substr(b.pnt_geom, 19) as t1, substr(c.pnt_geom, 19) as t2, lpad(hex(a.k), 4, '0') as hk, lpad(hex(a.j), 4, '0') as hj
  from {fx_hex_points} a join {fx_hex_points} b on b.point_id = a.point_id + 1 join {fx_hex_points} c on c.point_id = a.point_id + 2) p"""

TABLES = ("region", "supplier", "part", "customer", "orders", "lineitem", "events")
DEPENDS = {
    "fx_outlines": ("fx_buildings",), "fx_site": ("fx_cci_sites",), "fx_structure": ("fx_scrub", "fx_cci_sites"),
    "fx_us_structure": ("fx_scrub",), "fx_hex_shapes": ("fx_hex_points",),
}


# Schemas of the read-only driver tables, so that each is inferred once per process.
_SCHEMAS: dict[str, StructType] = {}


class Fixtures:
    """Lazily built views over one data directory: ``fx["fx_buildings"]`` is a DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._made = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            if name in TABLES:
                path = f"{self.sf_dir}/{name}.parquet"
                self._made[name] = read_spread(self.spark, path, _SCHEMAS.get(path))
                _SCHEMAS[path] = self._made[name].schema
            else:
                text = VIEWS[name]
                used = {t: self[t] for t in (*TABLES, *DEPENDS.get(name, ())) if "{" + t + "}" in text}
                self._made[name] = self.spark.sql(text, **used)
        return self._made[name]


def duckdb_view(name: str) -> str:
    return VIEWS[name].format(**{t: t for t in (*TABLES, *VIEWS)})
