"""The geometry helpers as functions of Spark SQL, for hand-written queries."""

from __future__ import annotations

from pyspark.sql import SparkSession

from linkscout.functions import geo

RING = "array<struct<lon: double, lat: double>>"


def register(spark: SparkSession) -> None:
    """Temporary functions of the session, all over native expressions.

    ``point_in_outline(lon, lat, outline)`` is true inside and on the boundary; ``roof_corners(outline)`` gives the cardinal
    vertices of the outline's inset as an array, and the table function ``roof_vertices(outline)`` as rows, for lateral joins.
    """
    spark.sql(
        f"create or replace temporary function point_in_outline(lon double, lat double, outline {RING}) returns boolean"
        f" return {geo.point_in_ring_text('lon', 'lat', 'outline')}"
    )
    spark.sql(
        f"create or replace temporary function roof_corners(outline {RING}) returns array<struct<vertex: string, lon: double, lat: double>>"
        f" return {geo.roof_vertices_text('outline')}"
    )
    spark.sql(
        f"create or replace temporary function roof_vertices(outline {RING}) returns table (vertex string, lon double, lat double)"
        f" return select c.vertex, c.lon, c.lat from explode({geo.roof_vertices_text('outline')}) as t(c)"
    )
