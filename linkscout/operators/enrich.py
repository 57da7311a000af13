"""Enrichment of candidates: rank attributes, terrain clearance and link budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkscout.functions import text
from linkscout.operators.rank import combined_ranks
from linkscout.operators.skew import skewed_join
from linkscout.operators.storage import materialise

DELETE_BELOW = -300.0
#: Samples of one path that the elevation lookup returns at most.
MOST_SAMPLES = 200
CANDIDATE_KEY = ["site_id", "candidate_type", "id", "vertex"]


def clearance_label(clearance: Column) -> Column:
    """Pass, Fail (path blocked) or Delete (blocked by more than 300); NULL stays NULL."""
    return F.when(clearance < DELETE_BELOW, "Delete").when(clearance < 0, "Fail").when(clearance >= 0, "Pass")


def array_clearance(elevations: Column) -> Column:
    """Smallest gap between the straight line from first to last sample and the terrain, at mast height zero.

    The mast adds the same height at both ends, so it is simply added to the result. NULL for fewer than two samples.
    """
    n = F.size(elevations)
    first = F.get(elevations, F.lit(0))
    slope = (F.get(elevations, n - 1) - first) / F.greatest(n - 1, F.lit(1))
    gaps = F.transform(elevations, lambda e, i: first + i * slope - e)
    return F.when(n >= 2, F.array_min(gaps))


def profile_clearance(profiles: DataFrame, keys: list[str]) -> DataFrame:
    """Same for profiles stored one sample per row (``sample_idx``, ``elev``): columns ``keys`` and ``clearance``.

    Two aggregates with map-side combine instead of collecting a profile, so its length is not limited.
    """
    ends = materialise(profiles.groupBy(*keys).agg(
        F.min_by("elev", "sample_idx").alias("_first"),
        F.max_by("elev", "sample_idx").alias("_last"),
        F.min("sample_idx").alias("_from"),
        F.count(F.lit(1)).alias("_n"),
    ))
    counts, alone = ends.select(*keys, "_n"), ends.select(*keys, F.lit(1).alias("_n"))
    ends = ends.withColumn("_slope", (F.col("_last") - F.col("_first")) / F.greatest(F.col("_n") - 1, F.lit(1)))
    samples = skewed_join(profiles, ends.where("_n >= 2").drop("_last", "_n"), keys, left_counts=counts, right_counts=alone)
    gap = F.col("_first") + (F.col("sample_idx") - F.col("_from")) * F.col("_slope") - F.col("elev")
    return samples.groupBy(*keys).agg(F.min(gap).alias("clearance"))


def elevation_arrays(profiles: DataFrame, keys: list[str]) -> DataFrame:
    """The samples themselves, in order, of profiles of the lookup service; more than MOST_SAMPLES in one raise."""
    few = F.when(F.count(F.lit(1)) <= MOST_SAMPLES, F.sort_array(F.collect_list(F.struct("sample_idx", "elev"))))
    pairs = few.otherwise(F.raise_error(F.lit(f"a profile of more than {MOST_SAMPLES} samples")))
    return profiles.groupBy(*keys).agg(F.transform(pairs, lambda p: p.elev).alias("elevations"))


def with_clearance(candidates: DataFrame, clearance: DataFrame, keys: list[str], wanted: Column | None = None) -> DataFrame:
    """Add ``min_clearance`` and ``clearance_score``. Where ``wanted`` is false both stay NULL."""
    joined = candidates.join(clearance, keys, "left")
    total = F.col("clearance") + F.col("height")
    if wanted is not None:
        total = F.when(wanted, total)
    return joined.withColumn("min_clearance", total).drop("clearance").withColumn(
        "clearance_score", clearance_label(F.col("min_clearance"))
    )


def drop_blocked(candidates: DataFrame) -> DataFrame:
    """Remove candidates marked Delete; unchecked ones stay."""
    return candidates.where(F.col("clearance_score").isNull() | (F.col("clearance_score") != "Delete"))


def assemble(candidates: DataFrame, ranks: dict[str, DataFrame]) -> DataFrame:
    """Candidates with their rank attributes and the transmitter height, unranked ones included.

    Matching is on type and id, as ids of different sources may be the same text. Several rank rows per id fan out.
    """
    joined = candidates.join(combined_ranks(ranks), ["candidate_type", "id"], "left")
    return joined.withColumns(
        {
            "tx_agl": text.open_level_agl(F.col("open_levels")),
            "open_levels": F.coalesce(F.col("open_levels"), F.lit("NULL")),
        }
    )


def unranked_sites(sources: DataFrame, candidates: DataFrame, ranks: dict[str, DataFrame]) -> DataFrame:
    """Search sites for which no rank row exists at all."""
    keys = combined_ranks(ranks).select("candidate_type", "id").distinct()
    ranked = candidates.join(keys, ["candidate_type", "id"], "left_semi").select("site_id")
    return sources.select("site_id").join(ranked, "site_id", "left_anti")


def join_link_budget(candidates: DataFrame, replies: DataFrame, keys: list[str]) -> DataFrame:
    """Add the link-budget reply of each candidate (``speed``, ``equipment`` and the rest) by key."""
    renamed = replies.withColumnsRenamed({"capacity": "speed", "model": "equipment"})
    return candidates.join(renamed, keys, "left")


def linked(candidates: DataFrame) -> DataFrame:
    """Candidates for which the link budget gave a speed."""
    return candidates.where(F.col("speed").isNotNull())


def sites_without_links(sources: DataFrame, candidates: DataFrame) -> DataFrame:
    """Search sites that no candidate can serve."""
    return sources.select("site_id").join(linked(candidates).select("site_id"), "site_id", "left_anti")


def candidate_pairs(candidates: DataFrame, n: int, seed: int) -> DataFrame:
    """A sample of ``n`` candidates put into pairs, as ends of a test path.

    The order is a hash of the row's key and the seed, so a re-run draws the same sample.
    """
    drawn = F.md5(F.concat_ws("|", *CANDIDATE_KEY, F.lit(str(seed))))
    sample = candidates.withColumn("_draw", drawn).orderBy("_draw", *CANDIDATE_KEY, "long", "lat").limit(n)
    # At most n rows are left here.
    position = F.row_number().over(Window.orderBy("_draw", *CANDIDATE_KEY, "long", "lat")) - 1
    return sample.withColumn("pair", F.floor(position / 2)).drop("_draw")
