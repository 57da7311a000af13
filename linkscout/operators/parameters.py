"""Search parameters: one row per search site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkscout.functions import geo, text

MAX_RADIUS_KM = 11
VERTICES_PER_BUILDING = 4

# Constant columns of the network planner's import sheet (fixed values).
PLANNER_CONSTANTS = {
    "Max Power (dBm)": "40",
    "Misc Loss (dB)": "0",
    "Antenna Type": "EBAND_ISO",
    "Mechanical Azimuth (deg)": 0,
    "Mechanical Downtilt (deg)": 0,
    "Electrical Downtilt (deg)": 0,
    "Antenna Height AGL (m)": 0,
    "Beamforming Gain (dB)": 0,
    "LTE PDSCH Offset (dB)": 0,
    "Cell Load (%)": 0,
}


def clamp_radius(radius: Column) -> Column:
    """Radius in km: kept within (0, 11], negative becomes 0, anything else (0 included) becomes 11."""
    return F.when((radius > 0) & (radius <= MAX_RADIUS_KM), radius).when(radius < 0, 0).otherwise(MAX_RADIUS_KM)


def with_parameters(sources: DataFrame, radius: str = "radius_raw") -> DataFrame:
    """Add ``radius_km`` and the three row limits.

    The lit limit counts roof vertices, hence the factor four; the other limits count rows.
    """
    by_type = F.col("limit_by_type")
    neighbours = F.col("max_neighbors")
    return sources.withColumns(
        {
            "radius_km": clamp_radius(F.col(radius)).cast("double"),
            "lit_limit": (VERTICES_PER_BUILDING * F.when(by_type, F.col("max_lit")).otherwise(neighbours)).cast("int"),
            "re_limit": F.when(by_type, F.col("max_re")).otherwise(neighbours).cast("int"),
            "cci_limit": F.when(by_type, F.col("max_cci")).otherwise(neighbours).cast("int"),
        }
    )


def search_parameters(sources: DataFrame) -> DataFrame:
    """The parameter sheet. The five extra columns are NULL for sites that use neither extra switch."""
    extra = F.col("include_non_lit") | F.col("limit_by_type")

    def only_extra(name: str) -> Column:
        return F.when(extra, F.col(name))

    return with_parameters(sources).select(
        "site_id",
        text.sanitise_name(F.col("project_name")).alias("Project Name"),
        F.col("lat").alias("Latitude"),
        F.col("lon").alias("Longitude"),
        F.col("min_speed").alias("Minimum Speed"),
        F.col("max_neighbors").alias("Max Candidates"),
        F.col("radius_km").alias("Distance (km)"),
        only_extra("include_non_lit").alias("Non-Lit?"),
        only_extra("limit_by_type").alias("Extra Control?"),
        only_extra("lit_limit").alias("Lit Number"),
        only_extra("re_limit").alias("RE Number"),
        only_extra("cci_limit").alias("CCI Sites Number"),
    )


def planner_rows(parameters: DataFrame) -> DataFrame:
    """Import sheet of the network planner, one row per search site."""
    return parameters.select(
        "site_id",
        F.col("Project Name").alias("Site Name"),
        "Latitude",
        "Longitude",
        F.lit("False").alias("Site Enabled"),
        F.col("Project Name").alias("Device Name"),
        *[F.lit(value).alias(name) for name, value in PLANNER_CONSTANTS.items()],
    )


def read_sites(features: DataFrame) -> DataFrame:
    """Search sites drawn in any supported coordinate system, as WGS84 degrees."""
    lon, lat = geo.to_wgs84(F.col("x"), F.col("y"), F.col("epsg"))
    return features.select("site_id", lon.alias("lon"), lat.alias("lat"))
