"""Final ranking of the candidates of each search site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkscout import schemas

# The ranking keys in order (fixed values): column and whether it sorts ascending. Missing values always go last.
RANK_KEYS = (
    ("fiber_on_site", True), ("is_cci_power_available", True), ("if_no_cci_power_is_meter_avail", True),
    ("pt_id", False), ("score", True), ("antenna", True), ("revshare", False), ("speed", False), ("fi_dist", True),
    ("fcc_cnt", False),
)
ENTITY = ["site_id", "candidate_type", "id"]
# Decides between several rank rows of one tower.
_FAN_OUT = sorted({c for schema in schemas.RANKS.values() for c in schema} - {"id"})


def _tie_break() -> list[Column]:
    return [F.col("cand_seq"), *[F.col(c).asc_nulls_first() for c in _FAN_OUT]]


def first_per_id(assembled: DataFrame) -> DataFrame:
    """The first row of each candidate id of a site, in search order."""
    window = Window.partitionBy(*ENTITY).orderBy(*_tie_break())
    return assembled.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def rank(assembled: DataFrame, check_clearance: Column | None = None) -> DataFrame:
    """One row per candidate with ``fw_rank`` from 1, best first within each site.

    One key list serves every mix of candidate types: keys of absent types are NULL throughout and only tie. The one
    exception is the score, which counts only where the site has towers or buildings. ``check_clearance`` tells for which
    rows the clearance score leads.
    """
    scored = F.max(F.col("candidate_type").isin("cci_sites", "ospi")).over(Window.partitionBy("site_id"))
    table = first_per_id(assembled.withColumn("_scored", scored))
    keys = []
    if check_clearance is not None:
        keys.append(F.when(check_clearance, F.col("clearance_score")).desc_nulls_last())
    for name, ascending in RANK_KEYS:
        key = F.when(F.col("_scored"), F.col("score")) if name == "score" else F.col(name)
        keys.append(key.asc_nulls_last() if ascending else key.desc_nulls_last())
    window = Window.partitionBy("site_id").orderBy(*keys, *_tie_break(), "candidate_type", "id")
    return table.withColumn("fw_rank", F.row_number().over(window)).drop("_scored")


def join_back(assembled: DataFrame, ranked: DataFrame) -> DataFrame:
    """All assembled rows (vertices included) with the rank of their candidate."""
    return assembled.join(ranked.select(*ENTITY, "fw_rank"), ENTITY, "left")


def rank_sheet(rank_table: DataFrame, kind: str, all_ranked: DataFrame) -> DataFrame:
    """A rank table with the ranks its ids got at every site; several rows per id (vertices, sites) are kept."""
    places = all_ranked.where(F.col("candidate_type") == kind).select("site_id", "id", "fw_rank")
    return rank_table.join(places, "id", "left")
