"""Link lines between the buildings at both ends of a circuit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkscout.functions import geo
from linkscout.operators.skew import NULL_SALTS, key_counts, skewed_join
from linkscout.operators.storage import counted, materialise

LINK_TYPE = "Fixed Wireless Link"
A_PART, Z_PART = 3, 4


def name_part(name: Column, part: int) -> Column:
    return F.split_part(name, F.lit("-"), F.lit(part))


def either_name_join(
    df: DataFrame, buildings: DataFrame, names: DataFrame, code: str, part: Column, out: dict[str, str]
) -> DataFrame:
    """Left join on ``code = name OR part = name`` as equi-joins.

    ``names`` holds the names of the buildings with their rows, ``(name, _n)``. The two possible keys are first checked
    against them, so each row knows which of them hit. Rows then
    carry an array of zero, one or two different keys, exploded for an inner join; rows without a key are added as
    unmatched. A row that matches by one key gets no spurious NULL row from the other.
    ``out`` maps building columns to output names. A row without a code is checked under one of many names that do not
    exist, so that such rows do not meet in one task. The marked table is written once, as hot names are counted and split.
    """
    nowhere = F.concat(F.lit("\0"), F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(NULL_SALTS)).cast("string"))
    marked, own = df, {"_code_hit": F.col(code), "_part_hit": part}
    for hit, key in own.items():
        known = names.select(F.col("name").alias("_probe"), F.lit(True).alias(hit))
        marked = marked.withColumn("_probe", F.coalesce(key, nowhere)).join(known, "_probe", "left").drop("_probe")
    # The keys are taken from their columns again, so that no copy of them is shuffled.
    keys = F.array_distinct(F.array_compact(F.array(*[F.when(F.col(hit), key) for hit, key in own.items()])))
    marked, n = counted(marked.select(*df.columns, keys.alias("_keys")))
    ends = buildings.select(F.col("name").alias("_key"), *[F.col(old).alias(new) for old, new in out.items()])
    hits = marked.where(F.size("_keys") > 0).withColumn("_key", F.explode("_keys")).drop("_keys")
    matched = skewed_join(hits, ends, ["_key"], left_counts=2 * n, right_counts=names.withColumnRenamed("name", "_key")).drop("_key")
    missed = marked.where(F.size("_keys") == 0).drop("_keys")
    return matched.unionByName(missed, allowMissingColumns=True)


def located_circuits(circuits: DataFrame, buildings: DataFrame) -> DataFrame:
    """Link circuits with the coordinates of both ends; several buildings of one name fan out."""
    links = circuits.where(F.col("circuit_type") == LINK_TYPE)
    known = buildings.where(F.col("name").isNotNull()).select("name", "lon", "lat")
    names = materialise(key_counts(known, ["name"]))
    located = either_name_join(
        links, known, names, "a_location_clli", name_part(F.col("name"), A_PART),
        {"lon": "a_longitude", "lat": "a_latitude"},
    )
    return either_name_join(
        located, known, names, "z_location_clli", name_part(F.col("name"), Z_PART),
        {"lon": "z_longitude", "lat": "z_latitude"},
    )


def link_view(circuits: DataFrame, buildings: DataFrame) -> DataFrame:
    """One row per located circuit with end codes, bandwidth, completeness, length in metres and line geometry."""
    shown = circuits.select("name", "bandwidth", "circuit_type", "a_location_clli", "z_location_clli")
    located = located_circuits(shown, buildings)
    a = [F.col("a_longitude"), F.col("a_latitude")]
    z = [F.col("z_longitude"), F.col("z_latitude")]
    measured = geo.with_line_length(located, "a_longitude", "a_latitude", "z_longitude", "z_latitude", "length_meters")
    return measured.select(
        "name",
        F.nullif(F.col("bandwidth"), F.lit("")).cast("int").alias("bandwidth_mbps"),
        F.coalesce(F.col("a_location_clli"), name_part(F.col("name"), A_PART)).alias("a_loc_clli"),
        F.coalesce(F.col("z_location_clli"), name_part(F.col("name"), Z_PART)).alias("z_loc_clli"),
        "circuit_type",
        F.when(a[0].isNull() | a[1].isNull(), "Missing A-Location Lat/Long")
        .when(z[0].isNull() | z[1].isNull(), "Missing Z-Location Lat/Long")
        .otherwise("All Geometries Present")
        .alias("geom_info"),
        "length_meters",
        geo.line_wkt(*a, *z).alias("geom"),
    )


def register_link_views(circuits: DataFrame, buildings: DataFrame) -> DataFrame:
    """Source view and the public view over it; returns the public one."""
    link_view(circuits, buildings).createOrReplaceTempView("link_lines_source")
    spark = circuits.sparkSession
    public = spark.sql("select * from link_lines_source")
    public.createOrReplaceTempView("link_lines")
    return public
