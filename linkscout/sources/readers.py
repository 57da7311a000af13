"""Table readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkscout.functions import geo
from linkscout.sources import wkb

CANDIDATE_CSV = T.StructType(
    [
        T.StructField("row", T.LongType()),
        T.StructField("candidate_type", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("cand_dist_km", T.DoubleType()),
        T.StructField("long", T.DoubleType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("height", T.DoubleType()),
        T.StructField("pnt_geom", T.StringType()),
        T.StructField("clearance_score", T.StringType()),
    ]
)


def query(spark: SparkSession, text: str, tables: dict[str, DataFrame]) -> DataFrame:
    """Run a SELECT over the given tables, written as ``{name}`` in the text. Errors propagate."""
    return spark.sql(text, **tables)


def query_points(spark: SparkSession, text: str, tables: dict[str, DataFrame], geometry: str) -> DataFrame:
    """Same, with a hex point column decoded into ``lon``, ``lat`` and ``srid``."""
    return decode_points(query(spark, text, tables), geometry)


def decode_points(df: DataFrame, geometry: str) -> DataFrame:
    point = geo.decode_ewkb_point(F.col(geometry))
    return df.withColumn("_point", point).select(
        *[c for c in df.columns if c != geometry], "_point.lon", "_point.lat", "_point.srid"
    )


def query_shapes(spark: SparkSession, text: str, tables: dict[str, DataFrame], geometry: str) -> DataFrame:
    """Same, with a hex column of any geometry decoded into rows of ``srid``, ``part``, ``kind`` and ``paths``."""
    return wkb.decode_shapes(query(spark, text, tables), geometry)


def read_jdbc(
    spark: SparkSession, url: str, table: str, partition_column: str, lower: int, upper: int, partitions: int,
    fetch_size: int = 10_000, **options: str,
) -> DataFrame:
    """Read a database table in parallel ranges, fetched in batches. Credentials come from the caller's options."""
    return (
        spark.read.format("jdbc")
        .options(
            url=url, dbtable=table, partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper),
            numPartitions=str(partitions), fetchsize=str(fetch_size), **options,
        )
        .load()
    )


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """A stored candidate file with a fixed schema."""
    return spark.read.csv(path, header=True, schema=CANDIDATE_CSV)


def building_sample(buildings: DataFrame, n: int = 5) -> DataFrame:
    return buildings.select("buildingid", "name", "clli").orderBy("buildingid").limit(n)


def read_rankings(spark: SparkSession, path: str) -> DataFrame:
    """Score lookup kept as a CSV."""
    return spark.read.csv(path, header=True, schema="candidate_source string, candidate_type string, score int")
