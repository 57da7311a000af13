"""Building lookups and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkscout import schemas
from linkscout.functions import geo
from linkscout.operators import outlines

# Network states that rule a building out as a hub.
EXCLUDED_STATES = ("TYPE II", "ON-NET (Type II)", "OFF-NET", "OFF-NET (Restricted)", "13", "14", "15")
EXPORT_COLUMNS = (
    "id", "buildingid", "name", "clli", "street", "city", "state", "pop_tf", "zip", "workorder", "security_level",
    "address_notes", "building_type", "legacy_fid", "legacy_owner",
)


def extent_degrees(extent: tuple[float, float, float, float], epsg: int) -> tuple[float, float, float, float]:
    """Map extent (west, south, east, north) in degrees. Exact for web mercator, whose axes stay parallel."""
    if epsg == 4326:
        return extent
    if epsg == 3857:
        west, south = geo.mercator_to_wgs84(*extent[:2])
        east, north = geo.mercator_to_wgs84(*extent[2:])
        return west, south, east, north
    raise ValueError(f"no axis-aligned transform from EPSG {epsg}")


def hub_lookup(buildings: DataFrame, crm: DataFrame, extent: tuple[float, float, float, float], epsg: int) -> DataFrame:
    """Buildings of a map extent that may serve as hub: status not excluded, or unknown.

    The extent becomes four range predicates on plain columns, which reach the scan.
    """
    west, south, east, north = extent_degrees(extent, epsg)
    seen = buildings.where(F.col("lon").between(west, east) & F.col("lat").between(south, north))
    keyed = seen.withColumn("_clli", F.trim(F.upper(F.col("name_raw"))))
    status = crm.select(F.col("clli").alias("_clli"), "on_net_status")
    state = F.col("on_net_status")
    return (
        keyed.join(status, "_clli", "left")
        .where(~state.isin(*EXCLUDED_STATES) | state.isNull())
        .select(
            "buildingid", F.col("name_raw").alias("name"), "building_type", "on_net_status",
            F.col("lat").alias("Lat Dec"), F.col("lon").alias("Long Dec"),
        )
    )


def building_export(buildings: DataFrame) -> DataFrame:
    """Building attributes with the validity of the outline, the place of a fault, and its valid form as text."""
    attributes = schemas.required(buildings, EXPORT_COLUMNS)
    checked = outlines.with_validity(attributes, "ring", "geom_reason", "geom_parts")
    return checked.select(*EXPORT_COLUMNS, "geom_reason", outlines.parts_wkt(F.col("geom_parts")).alias("geom"))
