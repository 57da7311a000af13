"""Tower classification reports: one shared join, one projection of colour rules per report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkscout import schemas
from linkscout.functions import colours as c
from linkscout.functions import geo, text
from linkscout.operators.search import TOWER_TYPES

# Structures that are reported.
STRUCTURE_IDS = (*"ABCDEFG", *[f"C{i}" for i in range(1, 21)])

# The columns of the reports, each in the order of its report: a, then b to e, then g.
SALES = tuple("""
bus_unit crown_area crown_ae site_status consent_summary crown_district lats longs portfolio site_city site_county site_state site_zip marketable
fiber_on_site fiber_provider is_cci_power_available if_no_cci_power_is_meter_avail power_company available_telco_provider revshare revshare_split
landlord_name primary_property_interest tower_only fle leased_area_sq_ft compound_sq_ft compnd_expand avail_ground_space_com add_land_option
option_sq_ft sublease_consent_type config_changes_consent_type loa_required zoning_jurisdiction zoning_collo_process_type
zoning_ant_add_process_type zoning_ant_swap_process_type zoning_ground_process_type permit_jurisdiction bp_collo_permit_type
bp_ant_add_permit_type bp_ant_swap_permit_type bp_ground_permit_type tower_lighted largest_length stealth_tower_ind stealth_structure_type
faa_study_number faa_approved_height structure_id ground_elevation faa_lighting_requirement man_lift_req nearest_airport_distance
site_on_si_tracker am_study_required abandoned_equipment_on_tower sa_on_file current_tower_capacity modification_expected can_it_be_ibm
hist_migratory_bird_issues open_bird_ticket validated_fcc_registration legal_issue_flag s_structure_type s_hgt_with_appurt s_site_flag
""".split())
SHELTERED = tuple("""
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
""".split())
STRUCTURES = tuple("""
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
""".split())
# Report f is laid out as report a, without the legal flag.
DETAILED = tuple(n for n in SALES if n != "legal_issue_flag")
SCRUB_SHEET = (
    "bus_unit", "crown_area", "crown_district", "lats", "longs", "marketable", "tower_height_w_appurt", "portfolio",
    "structure_type", "current_tower_capacity", "open_levels", "avail_ground_space_com", "is_cci_power_available",
    "zoning_jurisdiction", "zoning_collo_process_type", "zoning_collo_duration", "permit_jurisdiction",
    "bp_collo_permit_type", "bp_collo_duration", "consent_summary", "revshare", "loa_required", "loa_notes",
)


def sales_base(
    scrub: DataFrame, sites: DataFrame, columns, towers_only: bool = False, ids: DataFrame | None = None
) -> DataFrame:
    """Scrub rows of the reported structures joined with their site.

    Filters go below the join and only the columns of the report are read; a table without one of them raises. ``ids``
    narrows to some units by semi-join.
    """
    scrub_side, site_side = [n for n in columns if n[:2] != "s_"], [n for n in columns if n[:2] == "s_"]
    left = schemas.required(scrub.where(F.col("structure_id").isin(*STRUCTURE_IDS)), scrub_side)
    if ids is not None:
        left = left.join(ids.select(F.col(ids.columns[0]).alias("bus_unit")), "bus_unit", "left_semi")
    right = schemas.required(sites, site_side)
    if towers_only:
        right = right.where(F.col("s_bu_type_code").isin(*TOWER_TYPES))
    joined = left.select(*scrub_side).join(right.select("s_bus_unit", *site_side), F.col("bus_unit") == F.col("s_bus_unit"))
    return joined.select(*columns)


def in_report_order(df: DataFrame, unit: str = "bus_unit") -> DataFrame:
    """Sort by unit and structure. A hash of the row comes last, so range partitioning can split a unit of any size."""
    tied = df.withColumn("_tie", F.xxhash64(*[F.col(f"`{n}`") for n in df.columns]))
    return tied.orderBy(unit, "structure_id", "_tie").drop("_tie")


def whole_lease_days(asof: Column) -> Column:
    return text.whole_days(F.col("fle"), asof)


_TEN = (
    "struc_type_clr", "bird_ticket_clr", "faa_clr", "consent_clr", "capacity_clr", "legal_clr", "zoning_clr",
    "permit_clr", "status_clr", "am_study_clr",
)


def _ten_colours(bird_null: str | None, faa_other: str = c.RED, permit: c.Rule = c.PERMIT) -> dict[str, c.Rule]:
    return {
        "struc_type_clr": c.structure(),
        "bird_ticket_clr": c.yes_is_red("open_bird_ticket", bird_null),
        "faa_clr": c.blank_is_green("faa_study_number", faa_other, c.GREEN),
        "consent_clr": c.CONSENT,
        "capacity_clr": c.CAPACITY_KNOWN,
        "legal_clr": c.no_is_green("legal_issue_flag"),
        "zoning_clr": c.ZONING,
        "permit_clr": permit,
        "status_clr": c.STATUS,
        "am_study_clr": c.no_is_green("am_study_required"),
    }


@dataclass(frozen=True)
class Report:
    """One classification report: its columns, its colour rules and what is derived from the colours."""

    columns: tuple[str, ...]
    rules: dict[str, c.Rule]
    towers_only: bool = False
    category: bool = False
    fibre: bool = False
    show_colours: bool = True
    geometry: bool = False


_EIGHT = {k: v for k, v in _ten_colours(None).items() if k in _TEN[:8]}

REPORTS = {
    "a": Report(SALES, _EIGHT),
    "b": Report(SHELTERED, _ten_colours(c.GREEN), towers_only=True, category=True, fibre=True),
    "c": Report(SHELTERED, _ten_colours(c.GREEN), category=True, fibre=True),
    "d": Report(
        SHELTERED, _ten_colours(c.GREEN, c.YELLOW, c.PERMIT_GRADED), towers_only=True, category=True, fibre=True,
        show_colours=False,
    ),
    "e": Report(
        (*SHELTERED, "s_bu_type_code", "s_long_dec", "s_lat_dec"), _ten_colours(None), towers_only=True, category=True,
        geometry=True,
    ),
}


def classification(report: str, scrub: DataFrame, sites: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Reports a to e. The category reads the colours, which are computed one projection earlier."""
    spec = REPORTS[report]
    base = sales_base(scrub, sites, spec.columns, spec.towers_only, ids)
    table = base.withColumns({name: rule.column() for name, rule in spec.rules.items()})
    extra = {}
    if spec.category:
        extra["vector_category"] = c.category(list(spec.rules))
    if spec.fibre:
        extra["fw_type"] = c.fibre_type()
    if spec.geometry:
        extra["geom"] = geo.point_wkt(F.col("s_long_dec"), F.col("s_lat_dec"))
    if extra:
        table = table.withColumns(extra)
    return in_report_order(table if spec.show_colours else table.drop(*spec.rules))


def detailed_classification(scrub: DataFrame, sites: DataFrame, asof: Column) -> DataFrame:
    """Report f: fifteen colours, blank instead of a default colour. ``asof`` is the day the lease is measured from.

    The colour of the antenna-swap permit reads the collocation permit, as this report always has.
    """
    table = sales_base(scrub, sites, DETAILED)
    days = whole_lease_days(asof)
    rules: dict[str, c.Rule] = {
        "struc_type_clr": c.structure(c.OLD_NODE_TYPES, c.BLANK, c.BLANK),
        "stealth_twr_ind_clr": c.yes_is_red("stealth_tower_ind", c.BLANK),
        "site_flag_clr": c.site_flag("s_site_flag"),
        "faa_study_clr": c.blank_is_green("faa_study_number", c.RED, c.BLANK),
        "open_bird_ticket_clr": c.yes_is_red("open_bird_ticket", c.BLANK),
        "property_interest_clr": c.PROPERTY,
        "zoning_collo_process_type_clr": c.zoning_step("zoning_collo_process_type"),
        "zoning_ant_add_process_type_clr": c.zoning_step("zoning_ant_add_process_type"),
        "zoning_ant_swap_process_type_clr": c.zoning_step("zoning_ant_swap_process_type"),
        "bp_collo_permit_type_clr": c.permit_step("bp_collo_permit_type"),
        "bp_ant_add_permit_type_clr": c.permit_step("bp_ant_add_permit_type"),
        "bp_ant_swap_permit_type_clr": c.permit_step("bp_collo_permit_type"),
        "consent_summary_clr": c.CONSENT_SUMMARY,
    }
    table = table.withColumns(
        {
            **{name: rule.column() for name, rule in rules.items()},
            "current_twr_capacity_clr": c.capacity_text(),
            "fle_clr": F.when(F.col("fle").isNull(), c.BLANK).otherwise(c.lease_colour(days)),
        }
    )
    return in_report_order(table)


def lease_report(scrub: DataFrame, asof: Column, whole: bool) -> DataFrame:
    """Days until the lease ends and their colour, for rows that have an end; whole days or fractional ones."""
    known = scrub.where(F.col("fle").isNotNull())
    diff = whole_lease_days(asof) if whole else text.fractional_days(F.col("fle"), asof)
    return known.select("bus_unit", "structure_id", diff.alias("diff")).withColumn(
        "fle_clr", c.lease_colour_two_way(F.col("diff"))
    )


def scrub_sheet(scrub: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """The tower scrub sheet for the given units."""
    chosen = scrub
    if ids is not None:
        chosen = scrub.join(ids.select(F.col(ids.columns[0]).alias("bus_unit")), "bus_unit", "left_semi")
    return schemas.required(chosen, SCRUB_SHEET).select(*SCRUB_SHEET)


# ---------------------------------------------------------------- the oldest report, on the normalised site tables

# Columns of the structure table, with their names in the report.
STRUCTURE_PART = {
    "structure_type": "structure_type", "stealth_tower_ind": "stealth_tower_ind", "structure_id": "structure_id",
    "faa_apprv_hgt": "faa_approved_height", "hgt_with_appurt": "tower_height_w_appurt",
    "hgt_no_appurt": "tower_height_wout_appurt", "ground_elev": "ground_elevation",
    "faa_twr_lighting_req": "faa_lighting_requirement", "airport_dist": "nearest_airport_distance",
    "am_dtnng_eqpt_ind": "am_study_required", "faa_study_num": "faa_study_number",
    "stealth_tower_type_lkup_code": "stealth_tower_type_lkup_code",
}
# The rest comes from the scrub table, but for the site flag and the lift.
SCRUB_PART = tuple(n for n in STRUCTURES if n not in (*STRUCTURE_PART.values(), "site_flag", "man_lift_req"))
LEASE_ASOF = "2021-06-20"


def structure_base(
    scrub: DataFrame, sites: DataFrame, structures: DataFrame, us_structures: DataFrame, ids: DataFrame | None = None
) -> DataFrame:
    """Flagged sites with their reported structures.

    The outer mark on the structure join is void, as later conditions need a structure: four tables, three inner joins.
    """
    if ids is not None:
        sites = sites.join(ids.select(F.col(ids.columns[0]).alias("bus_unit")), "bus_unit", "left_semi")
    flagged = sites.where(F.col("site_flag") == "1").select("bus_unit", "site_flag")
    reported = schemas.required(structures.where(F.col("structure_id").isin(*STRUCTURE_IDS)), STRUCTURE_PART).select("bus_unit", *[F.col(old).alias(new) for old, new in STRUCTURE_PART.items()])
    lifts = us_structures.select("bus_unit", "structure_id", F.col("man_lift_rqrd_ind").alias("man_lift_req"))
    return (
        schemas.required(scrub, SCRUB_PART).select(*SCRUB_PART)
        .join(flagged, "bus_unit")
        .join(reported, "bus_unit")
        .join(lifts, ["bus_unit", "structure_id"])
        .select(*STRUCTURES)
    )


def structure_colours(
    scrub: DataFrame, sites: DataFrame, structures: DataFrame, us_structures: DataFrame, ids: DataFrame | None = None
) -> DataFrame:
    """Report g before it is sorted: colours on the normalised tables, lease measured from a fixed day."""
    table = structure_base(scrub, sites, structures, us_structures, ids)
    rules = {
        "structure_type_col": c.structure(c.OLD_NODE_TYPES, c.BLANK, c.BLANK, "structure_type"),
        "stealth_tower_ind_col": c.yes_is_red("stealth_tower_ind", c.BLANK),
        "site_flag_col": c.site_flag("site_flag"),
        "faa_study_number_col": c.blank_is_green("faa_study_number", c.RED, c.BLANK),
        "open_bird_ticket_col": c.yes_is_red("open_bird_ticket", c.BLANK),
        **{f"{n}_col": c.zoning_step(n) for n in _ZONING},
        **{f"{n}_col": c.permit_step(n) for n in _PERMITS},
        # This report tests the antenna-swap permit for consent texts.
        "consent_summary_col": c.Rule(
            "bp_ant_swap_permit_type",
            {c.GREEN: c.OLD_CONSENT_FREE, c.YELLOW: c.OLD_CONSENT_NEEDED, c.RED: c.SOLE_DISCRETION}, c.BLANK, c.BLANK,
        ),
    }
    days = F.datediff(F.col("fle"), F.lit(LEASE_ASOF).cast("date"))
    table = table.withColumns(
        {
            **{name: rule.column() for name, rule in rules.items()},
            "current_tower_capacity_col": c.capacity_text(),
            "primary_property_interest_col": c.property_text(),
            "fle_num": days.cast("long"),
            "fle_col": F.coalesce(c.lease_colour_two_way(days), F.lit(c.BLANK)),
        }
    )
    return table


def structure_classification(
    scrub: DataFrame, sites: DataFrame, structures: DataFrame, us_structures: DataFrame, ids: DataFrame | None = None
) -> DataFrame:
    """Report g."""
    return in_report_order(structure_colours(scrub, sites, structures, us_structures, ids))


_ZONING = ("zoning_collo_process_type", "zoning_ant_add_process_type", "zoning_ant_swap_process_type")
_PERMITS = ("bp_collo_permit_type", "bp_ant_add_permit_type", "bp_ant_swap_permit_type")

# Which cell a colour paints, and which rule column decides. A YELLOW lease paints the bird-ticket cell.
HIGHLIGHTS = (
    ("structure_type", "structure_type_col", (c.GREEN, c.RED, c.YELLOW)),
    ("stealth_tower_ind", "stealth_tower_ind_col", (c.GREEN, c.RED)),
    ("site_flag", "site_flag_col", (c.GREEN, c.RED)),
    ("current_tower_capacity", "current_tower_capacity_col", (c.GREEN, c.RED)),
    ("faa_study_number", "faa_study_number_col", (c.GREEN, c.RED)),
    ("open_bird_ticket", "open_bird_ticket_col", (c.GREEN, c.RED)),
    ("fle", "fle_col", (c.GREEN,)),
    ("open_bird_ticket", "fle_col", (c.YELLOW,)),
    ("primary_property_interest", "primary_property_interest_col", (c.GREEN, c.YELLOW)),
    *[(n, f"{n}_col", (c.GREEN, c.YELLOW)) for n in (*_ZONING, *_PERMITS)],
    ("consent_summary", "consent_summary_col", (c.GREEN, c.RED, c.YELLOW)),
)


def cell_highlights(report: DataFrame) -> DataFrame:
    """Painted cells of report g, one row each: cell column, background and text colour."""
    cells = [
        F.when(
            F.col(rule).isin(*colours),
            F.struct(
                F.lit(cell).alias("cell"),
                F.lit(rule).alias("rule"),
                F.col(rule).alias("background"),
                F.when(F.col(rule) == c.YELLOW, "BLACK").otherwise("WHITE").alias("foreground"),
            ),
        )
        for cell, rule, colours in HIGHLIGHTS
    ]
    return report.select("bus_unit", "structure_id", F.inline(F.array_compact(F.array(*cells))))
