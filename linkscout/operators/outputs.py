"""Shapes of the result tables and layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkscout import schemas
from linkscout.functions import geo, text


def candidate_file(all_ranked: DataFrame) -> DataFrame:
    return all_ranked.select("site_id", "candidate_type", "id", "lat", "long", "fw_rank")


def filled(df: DataFrame) -> dict[str, Column]:
    """Per column the number of its values, as aggregates to observe while the table is written."""
    return {c: F.count(F.col(f"`{c}`")) for c in df.columns}


def without_empty_columns(df: DataFrame, counts: dict[str, int] | None = None) -> DataFrame:
    """Drop columns that are NULL in every row, by their observed ``counts``; without these, by one aggregate over the table."""
    if counts is None:
        counts = df.agg(*[n.alias(c) for c, n in filled(df).items()]).first().asDict()
    return df.select(*[F.col(f"`{c}`") for c in df.columns if counts[c] > 0])


def sorted_report(ranked: DataFrame, counts: dict[str, int] | None = None) -> DataFrame:
    """Ranked candidates in rank order, without height and without empty columns."""
    return without_empty_columns(ranked, counts).drop("height").orderBy("site_id", "fw_rank")


def sink_rows(ranked: DataFrame) -> DataFrame:
    """Ranked candidates under sanitised names, restricted and cast to the sink's field map.

    Fields that only some runs have may be absent; any other absent field raises.
    """
    clean = ranked.withColumnsRenamed({c: text.sanitise_field(c) for c in ranked.columns})
    schemas.required(clean, [c for c in schemas.SINK_FIELDS if c not in schemas.SINK_OPTIONAL])
    kept = {c: t for c, t in schemas.SINK_FIELDS.items() if c in clean.columns}
    return clean.select("site_id", *[F.col(c).cast(t).alias(c) for c, t in kept.items()])


def candidate_points(ranked: DataFrame) -> DataFrame:
    """Point layer."""
    return sink_rows(ranked).withColumn("shape", geo.point_wkt(F.col("long"), F.col("lat")))


def spider_lines(ranked: DataFrame, sources: DataFrame) -> DataFrame:
    """Line layer: from each candidate to its search site, with the link speed."""
    ends = sources.select("site_id", F.col("lon").alias("_lon"), F.col("lat").alias("_lat"))
    return ranked.join(ends, "site_id").select(
        "site_id",
        "candidate_type",
        "id",
        geo.line_wkt(F.col("long"), F.col("lat"), F.col("_lon"), F.col("_lat")).alias("shape"),
        F.col("speed").cast("short").alias("speed"),
    )
