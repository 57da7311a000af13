"""Golden values of scalar rules, colours, clearance, parameters and ranking."""

import datetime as dt
import itertools
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from linkscout.functions import colours, text
from linkscout.operators import classify, enrich, parameters, rank, ranker, search
from linkscout.plans import catalog


def column(spark, values, dtype, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r.got for r in df.select("i", build(F.col("v")).alias("got")).orderBy("i").collect()]


def test_open_levels(spark):
    levels = ["30 - 115 FT , 117 - 125 FT , 129 - 150 FT", None, "None", "none", "60 FT", "150.5 FT", "NULL", "nan", ""]
    assert column(spark, levels, "string", text.open_level_agl) == [145, 30, 30, 30, 55, 1500, 30, 30, 30]


def test_radius_clamp(spark):
    assert column(spark, [-1, 0, 2, 11, 12], "int", parameters.clamp_radius) == [0, 11, 2, 11, 11]


def test_limits(spark):
    df = spark.createDataFrame(
        [(2, 25, False, 3, 4, 5), (2, 25, True, 3, 4, 5)],
        "radius_raw int, max_neighbors int, limit_by_type boolean, max_lit int, max_re int, max_cci int",
    )
    got = [(r.lit_limit, r.re_limit, r.cci_limit) for r in parameters.with_parameters(df).collect()]
    assert got == [(100, 25, 25), (12, 4, 5)]


def test_names_and_flags(spark):
    assert column(spark, ["My Site (1)/a"], "string", text.sanitise_name) == ["My_Site_1a"]
    assert text.sanitise_field("TX AGL (m)") == "TX_AGL__m_"
    assert column(spark, ["true", "false"], "string", text.parse_flag) == [True, False]
    with pytest.raises(Exception, match="not a flag"):
        column(spark, ["yes"], "string", text.parse_flag)


def test_clearance(spark):
    profiles = {1: [10, 10, 10], 2: [0, 20, 0], 3: [0, 400, 0], 4: [0, 10], 5: [3]}
    rows = [(k, i, float(e)) for k, v in profiles.items() for i, e in enumerate(v)]
    df = spark.createDataFrame(rows, "k int, sample_idx int, elev double")
    masts = spark.createDataFrame([(k, 5.0) for k in profiles], "k int, height double")
    long_form = enrich.with_clearance(masts, enrich.profile_clearance(df, ["k"]), ["k"])
    got = {r.k: (r.min_clearance, r.clearance_score) for r in long_form.collect()}
    assert got == {1: (5, "Pass"), 2: (-15, "Fail"), 3: (-395, "Delete"), 4: (5, "Pass"), 5: (None, None)}
    arrays = enrich.elevation_arrays(df, ["k"]).select("k", enrich.array_clearance(F.col("elevations")).alias("c"))
    assert {r.k: r.c for r in arrays.collect()} == {1: 0, 2: -20, 3: -400, 4: 0, 5: None}
    left = enrich.drop_blocked(long_form)
    assert sorted(r.k for r in left.collect()) == [1, 2, 4, 5]


def test_replies(spark):
    df = spark.createDataFrame([("a", '{"antenna":"X","capacity":900,"model":"M"}'), ("b", None)], "id string, reply string")
    got = {r.id: (r.antenna, r.capacity) for r in text.parse_link_reply(df, "reply").collect()}
    assert got == {"a": ("X", 900), "b": (None, None)}
    heights = spark.createDataFrame([("a", '{"results":[{"elevation":1.5},{"elevation":2.0}]}')], "id string, reply string")
    assert [(r.elevations, r.reply_error) for r in text.parse_elevation_reply(heights, "reply").collect()] == [([1.5, 2.0], None)]


def test_days(spark):
    asof = F.lit("2021-01-01").cast("timestamp")
    moments = [dt.datetime(2022, 1, 3, 12), dt.datetime(2020, 12, 30, 12)]
    assert column(spark, moments, "timestamp", lambda c: text.whole_days(c, asof)) == [367, -1]
    assert column(spark, moments, "timestamp", lambda c: text.fractional_days(c, asof)) == [367.5, -1.5]
    assert column(spark, [1824, 1825, 0, None], "int", colours.lease_colour) == ["YELLOW", "GREEN", None, None]


def test_category(spark):
    df = spark.createDataFrame(
        [("GREEN", "GREEN", "GREEN"), ("GREEN", None, "YELLOW"), ("RED", None, "RED"), ("YELLOW", "GREEN", "YELLOW")],
        "a string, b string, want string",
    )
    for r in df.select("want", colours.category(["a", "b"]).alias("got")).collect():
        assert r.got == r.want


def test_rules(spark):
    def paint(rule, values):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {rule.source} string")
        return [r.got for r in df.select("i", rule.column().alias("got")).orderBy("i").collect()]

    assert paint(colours.structure(), ["MONOPOLE", "DAS NODE", "DAS", "OTHER", "x", None]) == [
        "GREEN", "RED", "RED", "YELLOW", "RED", "RED"]
    assert paint(colours.structure(colours.OLD_NODE_TYPES, "", ""), ["DAS NODE", "DAS", None]) == ["", "RED", ""]
    assert paint(colours.CONSENT, ["No Consent x", "Notice", "Consent - Sole Discretion", "?", None]) == [
        "GREEN", "YELLOW", "RED", "GREEN", "GREEN"]
    assert paint(colours.PERMIT, ["BP", "None", "?", None]) == ["RED", "GREEN", "RED", "RED"]
    assert paint(colours.PERMIT_GRADED, ["BP", "Other", "None", "?"]) == ["RED", "YELLOW", "GREEN", "RED"]
    assert paint(colours.no_is_green("legal_issue_flag"), ["No", "Yes", "Maybe", None]) == ["GREEN", "RED", None, "GREEN"]
    assert paint(colours.yes_is_red("open_bird_ticket", None), ["Y", "N", None]) == ["RED", "GREEN", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(["N/A", "90", "150", "1000", "200", None])], "i int, current_tower_capacity string")
    got = [r.got for r in df.select("i", colours.capacity_text().alias("got")).orderBy("i").collect()]
    assert got == ["", "RED", "GREEN", "GREEN", "RED", ""]


# The eight key lists by candidate types present (fixed values): what the single list must equal.
T = ("fiber_on_site", "is_cci_power_available", "if_no_cci_power_is_meter_avail", "pt_id", "score", "antenna", "revshare", "speed")
BRANCHES = {
    ("cci_sites", "ospi", "re_asd"): (*T, "fi_dist", "fcc_cnt"),
    ("cci_sites", "re_asd"): (*T, "fi_dist"),
    ("cci_sites", "ospi"): (*T, "fcc_cnt"),
    ("cci_sites",): T,
    ("ospi", "re_asd"): ("score", "antenna", "speed", "fi_dist", "fcc_cnt"),
    ("ospi",): ("score", "antenna", "speed", "fcc_cnt"),
    ("re_asd",): ("antenna", "speed", "fi_dist"),
    ("other",): ("antenna", "speed"),
}
OWN = {"cci_sites": {*T}, "ospi": {"antenna", "speed", "fcc_cnt"}, "re_asd": {"score", "antenna", "speed", "fi_dist"}, "other": {"antenna", "speed"}}


def test_ranker_equals_each_branch(spark):
    rng = random.Random(4)
    values = {
        "fiber_on_site": ["Yes", "No", None], "is_cci_power_available": ["Yes", "No", None],
        "if_no_cci_power_is_meter_avail": ["Yes", "No", None], "pt_id": [0, 1, 2, None], "score": [1, 2, 3, None],
        "antenna": ["A", "B", None], "revshare": ["0", "1", None], "speed": [100, 900], "fi_dist": [1.5, 2.5, None],
        "fcc_cnt": [0, 4, None],
    }
    rows = []
    for (types, clear), n in itertools.product(itertools.product(BRANCHES, (True, False)), range(3)):
        site = f"{'-'.join(types)}/{clear}/{n}"
        for seq in range(1, 13):
            kind = types[seq % len(types)]
            row = {c: (rng.choice(v) if c in OWN[kind] else None) for c, v in values.items()}
            rows.append({"site_id": site, "candidate_type": kind, "id": f"i{seq % 10}", "cand_seq": seq, "check": clear,
                         "clearance_score": rng.choice(["Pass", "Fail", None]), **row})
    schema = "site_id string, candidate_type string, id string, cand_seq long, check boolean, clearance_score string, " + ", ".join(
        f"{c} {'int' if c in ('pt_id', 'score', 'speed') else 'long' if c == 'fcc_cnt' else 'double' if c == 'fi_dist' else 'string'}" for c in values)
    df = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    extra = [c for c in ranker._FAN_OUT if c not in df.columns]
    df = df.withColumns({c: F.lit(None).cast("string") for c in extra})
    got = {(r.site_id, r.candidate_type, r.id): r.fw_rank for r in ranker.rank(df, F.col("check")).collect()}
    want = {}
    for site, table in pd.DataFrame(rows).groupby("site_id"):
        types = tuple(site.split("/")[0].split("-"))
        keys = list(BRANCHES[types])
        ascending = [dict(ranker.RANK_KEYS)[k] for k in keys]
        if "True" in site:
            keys, ascending = ["clearance_score", *keys], [False, *ascending]
        table = table.drop_duplicates(["candidate_type", "id"]).copy()
        ordered = table.sort_values([*keys, "cand_seq"], ascending=[*ascending, True], na_position="last")
        want |= {(site, t, i): n for n, (t, i) in enumerate(zip(ordered.candidate_type, ordered.id), start=1)}
    assert got == want


def test_report_lists():
    assert len(classify.STRUCTURE_IDS) == 27
    assert [len(x) for x in (classify.SALES, classify.DETAILED, classify.SHELTERED, classify.STRUCTURES)] == [70, 69, 74, 70]
    assert all(len(x) == len(set(x)) for x in (classify.SALES, classify.SHELTERED, classify.STRUCTURES))


# The first columns, a stretch of the middle and the last column of each report, as its readers know them.
ORDER = {
    "a": ("bus_unit crown_area crown_ae site_status", "marketable fiber_on_site fiber_provider is_cci_power_available", "s_site_flag"),
    "b": ("bus_unit crown_area crown_ae site_status", "marketable fiber_provider is_cci_power_available", "s_site_flag"),
    "f": ("bus_unit crown_area crown_ae site_status", "validated_fcc_registration s_structure_type s_hgt_with_appurt", "s_site_flag"),
    "g": ("bus_unit crown_area site_status consent_summary", "largest_width site_flag structure_type stealth_tower_ind structure_id", "validated_fcc_registration"),
}


@pytest.mark.parametrize("report", sorted(ORDER))
def test_report_order(spark, sf_dir, report):
    columns = catalog.QUERIES[f"vector_{report}"](spark, sf_dir).columns
    first, middle, last = ORDER[report]
    n = {"a": 70, "b": 74, "f": 69, "g": 70}[report]
    assert columns[: len(first.split())] == first.split() and middle in " ".join(columns) and columns[n - 1] == last


@pytest.mark.parametrize("name", ["a", "b", "f", "g"])
def test_report_rows_are_sorted(spark, sf_dir, name):
    rows = [(r.bus_unit, r.structure_id) for r in catalog.QUERIES[f"vector_{name}"](spark, sf_dir).collect()]
    assert rows == sorted(rows)


def test_absent_columns_raise(spark, sf_dir):
    d = catalog.Data(spark, sf_dir)
    with pytest.raises(ValueError, match="faa_study_number"):
        classify.classification("b", d["scrub"].drop("faa_study_number"), d["cci_sites"])
    with pytest.raises(ValueError, match="power_company"):
        rank.cci_rank(d["scrub"].drop("power_company"), d["cci_sites"], d["rankings"])
    with pytest.raises(ValueError, match="loa_notes"):
        classify.scrub_sheet(d["scrub"].drop("loa_notes"))


def test_no_column_of_a_report_is_empty(spark, sf_dir):
    for name in ("a", "b", "f", "g"):
        df = catalog.QUERIES[f"vector_{name}"](spark, sf_dir)
        row = df.agg(*[F.count(c).alias(c) for c in df.columns]).first()
        assert [c for c in df.columns if not row[c]] == []
    leases = catalog.QUERIES["vector_g"](spark, sf_dir).select("fle_col").distinct().collect()
    assert {r.fle_col for r in leases} == {"GREEN", "YELLOW", ""}
    leases = catalog.QUERIES["vector_f"](spark, sf_dir).select("fle_clr").distinct().collect()
    assert {"GREEN", "YELLOW", ""} <= {r.fle_clr for r in leases}


def test_lit_rows_per_building(spark, sf_dir):
    """At most four vertices per building and matched building of its name."""
    roofs = catalog.QUERIES["roof_points"](spark, sf_dir)
    assert roofs.groupBy("buildingid", "x_id").count().where("count <> 4").count() == 0


@pytest.mark.parametrize("collapsed", [False, True])
def test_namesakes_at_one_place(spark, collapsed):
    """More buildings of one name at one place than the limit: the first by id as text, whatever comes first as number."""
    def ring(half):
        return [(-74.0 - half, 40.7 - half), (-74.0 + half, 40.7 - half), (-74.0 + half, 40.7 + half), (-74.0 - half, 40.7 + half)]

    # Outlines of one millimetre give no roof corners.
    rows = [(i, "HQ", -74.0, 40.7, ring(1e-8 if collapsed and i <= 11 else 0.0002)) for i in range(2, 61)]
    frame = spark.createDataFrame(rows, "buildingid long, name string, lon double, lat double, ring array<struct<lon:double,lat:double>>")
    site = spark.createDataFrame([("s", -74.0005, 40.7)], "site_id string, lon double, lat double").selectExpr(
        "*", "2D as radius_km", "4 as lit_limit"
    )
    found = search.lit_search(site, frame).collect()
    every = search.roof_points(frame).selectExpr("cast(buildingid as string) as id", "vertex", "x_id").collect()
    want = sorted((r.id, r.vertex, r.x_id) for r in every)[:4]
    assert sorted((r.id, r.vertex) for r in found) == sorted((i, v) for i, v, _ in want) and len(found) == 4


def test_inclusive_contains_strict(spark, sf_dir):
    strict = catalog.QUERIES["asd_search"](spark, sf_dir)
    wide = catalog.QUERIES["asd_search_dwithin"](spark, sf_dir)
    assert strict.select("site_id", "id").subtract(wide.select("site_id", "id")).count() == 0
