"""Rank attributes per candidate source."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkscout import schemas
from linkscout.functions import geo
from linkscout.functions.steps import steps
from linkscout.operators import grid, near, shapes
from linkscout.operators.skew import cogrouped
from linkscout.operators.storage import counted, materialise

LICENCE_LEVEL = 2
SCORE_SOURCE = "cci_sites"


def _only(df: DataFrame, column: str, ids: DataFrame | None) -> DataFrame:
    """Rows whose ``column`` is among the ids (a one-column table); all rows without ids."""
    if ids is None:
        return df
    keys = ids.select(F.col(ids.columns[0]).cast("string").alias("_id"))
    return df.join(keys, F.col(column).cast("string") == F.col("_id"), "left_semi")


def place_counts(cells: DataFrame, n_cells: int, licences: DataFrame, buffer_deg: float) -> DataFrame:
    """(buildingid, n): licences at points inside or within ``buffer_deg`` of each outline.

    Licences at one place are counted first, so a crowded place is one row in the join. The outline side is repeated per
    cell of its grown box, the licence side has one cell, so no pair occurs twice.
    """
    places, n_places = counted(
        licences.groupBy("lon", "lat")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("cell", grid.cell_of("lon", "lat", LICENCE_LEVEL))
    )
    tested = cogrouped(
        places, cells, "cell", lambda a, b: near.count_points(a, b, buffer_deg), near.counts_schema(cells), n_places, n_cells
    )
    return tested.groupBy("buildingid").agg(F.sum("n").alias("n"))


def licence_counts(buildings: DataFrame, licences: DataFrame, buffer_deg: float = geo.LICENCE_BUFFER_DEG) -> DataFrame:
    """(buildingid, n): licences that meet each outline grown by ``buffer_deg``; buildings without any are absent.

    A licence is a point (``lon``, ``lat``), or a line or an area by its ``kind`` and ``paths`` (see :mod:`.shapes`). A table without
    a kind holds points only, and so do rows without one.
    """
    outlines = geo.with_clean_ring(buildings.select("buildingid", "ring"))
    boxes = shapes.grown_boxes(outlines, buffer_deg)
    cells = shapes.box_cells(boxes.withColumn("_edges", F.expr(geo._edges("ring"))).drop("ring"), LICENCE_LEVEL)
    if "kind" not in licences.columns:
        return place_counts(*cells, licences, buffer_deg)
    is_point = F.coalesce(F.col("kind") == "point", F.lit(True))
    points = place_counts(*cells, licences.where(is_point), buffer_deg)
    others = shapes.shape_counts(boxes, licences.where(~is_point), buffer_deg)
    return points.unionByName(others).groupBy("buildingid").agg(F.sum("n").alias("n"))


def _lit_by_name(lit: DataFrame) -> DataFrame:
    """One row per lit-list code: the attributes of its first row (NULLs first) and its number of rows."""
    first = F.min(F.struct("on_net_status", "building_type"))
    return (
        lit.where(F.col("clli").isNotNull())
        .groupBy(F.col("clli").alias("name"))
        .agg(first.alias("lit"), F.count(F.lit(1)).alias("lit_rows"))
    )


def lit_rank(
    buildings: DataFrame, lit: DataFrame, licences: DataFrame, ids: DataFrame | None = None, with_type: bool = False
) -> DataFrame:
    """Rank attributes of buildings with the number of licences nearby; ``ids`` narrows to those buildings.

    The count is multiplied by the number of (building, lit row) combinations of the building's name, as in a join with
    that lookup. That factor is a product of two per-name counts, so the join itself is never formed. Buildings without a
    name drop out.
    """
    chosen = _only(buildings, "buildingid", ids).where(F.col("name").isNotNull())
    by_name = _lit_by_name(lit)
    namesakes = (
        buildings.where(F.col("name").isNotNull()).groupBy("name").agg(F.count(F.lit(1)).alias("name_rows"))
    )
    attributes = chosen.drop("lon", "lat").join(by_name, "name", "left")
    own = F.col("lit.building_type").isNull() | F.coalesce(F.col("pop_tf"), F.lit(False))
    attributes = attributes.withColumns(
        {
            "structure": F.when(own, F.col("building_type")).otherwise(F.col("lit.building_type")),
            "c_type": F.when(own, "ospi_buildings").otherwise("private_lit"),
            "on_net_status": F.col("lit.on_net_status"),
        }
    )
    first = Window.partitionBy("buildingid").orderBy(
        *[F.col(c).asc_nulls_first() for c in ("on_net_status", "structure", "name", "clli", "street", "city", "state")],
        F.hash("ring"),
    )
    # One row per building, with the outline its licences are counted for.
    attributes = materialise(attributes.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn"))
    chosen_outlines = attributes.select("buildingid", "ring")
    counts = licence_counts(chosen_outlines, licences)
    # Inner join: every name that is not NULL has at least one building.
    joined = attributes.join(namesakes, "name").join(counts, "buildingid", "left")
    fan_out = F.col("name_rows") * F.coalesce(F.col("lit_rows"), F.lit(1))
    out = joined.select(
        F.col("buildingid").cast("string").alias("id"),
        "name", "clli", "street", "city", "state", "structure", "on_net_status",
        F.when(F.col("lit_rows").isNotNull(), "True").otherwise("False").alias("data_consistency"),
        (F.coalesce(F.col("n"), F.lit(0)) * fan_out).alias("fcc_cnt"),
        "c_type",
    )
    return out if with_type else out.drop("c_type")


def _scores(rankings: DataFrame) -> DataFrame:
    """Distinct (type, score) pairs of the one scoring source in use."""
    return (
        rankings.where(F.col("candidate_source") == SCORE_SOURCE)
        .select(F.col("candidate_type").alias("_type"), F.col("score").cast("int").alias("score"))
        .distinct()
    )


def cci_rank(scrub: DataFrame, sites: DataFrame, rankings: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Distinct rank rows of towers; towers without a scored type drop out."""
    left = schemas.required(
        _only(scrub, "bus_unit", ids),
        ("last_sa_tia_code_revision", "power_company", "site_address", "site_city", "site_county", "site_state"),
    )
    right = sites.select("s_bus_unit", "s_bu_type_code", "s_site_name", "s_pop_tier_id", "s_pop_tier_name")
    joined = left.join(right, F.col("bus_unit") == F.col("s_bus_unit")).join(
        _scores(rankings), F.col("s_bu_type_code") == F.col("_type")
    )
    renamed = joined.withColumnsRenamed(
        {
            "bus_unit": "id", "s_bu_type_code": "structure", "s_site_name": "name", "s_pop_tier_id": "pt_id",
            "s_pop_tier_name": "poptier", "site_address": "street", "site_city": "city", "site_state": "state",
        }
    )
    return schemas.conform(renamed, schemas.CCI_RANK).distinct()


def asd_rank(estates: DataFrame, rankings: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Distinct rank rows of real estate A; the score lookup is the towers' one."""
    chosen = _only(estates, "mastersiteid", ids).join(_scores(rankings), F.col("structuretype") == F.col("_type"))
    renamed = chosen.withColumnsRenamed(
        {
            "mastersiteid": "id", "macrodealstatus": "uid2", "sourcesitename": "name", "streetaddress": "street",
            "structuretype": "structure", "fiberdistance": "fi_dist",
        }
    )
    return schemas.conform(renamed, schemas.ASD_RANK).distinct()


def mgt_rank(estates: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Rank rows of real estate B: no score, no grouping."""
    renamed = _only(estates, "esri_prinx", ids).withColumnsRenamed(
        {
            "esri_prinx": "id", "partner": "uid2", "alt_site_name": "name", "bu_type": "structure",
            "nearest_cci_any_fib_dist_m": "fi_dist",
        }
    )
    return schemas.conform(renamed, schemas.MGT_RANK)


def combined_ranks(ranks: dict[str, DataFrame]) -> DataFrame:
    """All rank rows in one table, tagged with their candidate type."""
    if not ranks:
        raise ValueError("no rank table to combine")
    parts = [df.withColumn("candidate_type", F.lit(kind)) for kind, df in ranks.items()]
    columns = {c: t for kind in schemas.RANKS for c, t in schemas.RANKS[kind].items()}
    combined = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return schemas.conform(combined, {"candidate_type": "string", **columns})


def rank_candidates(
    candidates: DataFrame, buildings: DataFrame, lit: DataFrame, licences: DataFrame, asd: DataFrame, mgt: DataFrame,
    sites: DataFrame, scrub: DataFrame, rankings: DataFrame,
) -> dict[str, DataFrame]:
    """The four rank tables, each narrowed to the ids found by the search."""

    def found(kind: str) -> DataFrame:
        return candidates.where(F.col("candidate_type") == kind).select("id").distinct()

    return {
        "ospi": lit_rank(buildings, lit, licences, found("ospi")),
        "re_asd": asd_rank(asd, rankings, found("re_asd")),
        "re_mgt": mgt_rank(mgt, found("re_mgt")),
        "cci_sites": cci_rank(scrub, sites, rankings, found("cci_sites")),
    }
