"""Extended well-known binary of any simple geometry and of collections, in both byte orders."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a geometry column becomes. The paths of an area are its rings, of several areas the rings of all.
SHAPES = (
    "struct<srid: int, shapes: array<struct<kind: string, paths: array<array<struct<lon: double, lat: double>>>>>>"
)
# Fixed values of the format: flags in the type number, and the numbers of the kinds. A multi-geometry has the number of its
# members plus three, a collection seven.
HAS_Z, HAS_M, HAS_SRID = 0x80000000, 0x40000000, 0x20000000
KINDS = {1: "point", 2: "line", 3: "area"}
COLLECTION = 7

Path = list[tuple[float, float]]


class _Bytes:
    def __init__(self, data: bytes):
        self.data, self.at, self.order = data, 0, "<"

    def take(self, form: str) -> tuple:
        size = struct.calcsize(form)
        if self.at + size > len(self.data):
            raise ValueError("a geometry ends before its last corner")
        out = struct.unpack_from(self.order + form, self.data, self.at)
        self.at += size
        return out

    def corners(self, n: int, ordinates: int) -> Path:
        flat = self.take("d" * (n * ordinates))
        return [(flat[i], flat[i + 1]) for i in range(0, len(flat), ordinates)]


def _geometry(data: _Bytes) -> tuple[int | None, list[tuple[str, list[Path]]]]:
    order = data.take("B")[0]
    if order > 1:
        raise ValueError(f"no byte order {order}")
    outer, data.order = data.order, "><"[order]
    number = data.take("I")[0]
    srid = data.take("i")[0] if number & HAS_SRID else None
    # Further dimensions are flagged, or counted in thousands; only the first two ordinates are kept.
    more, code = divmod(number & 0x1FFFFFFF, 1000)
    if more > 3:
        raise ValueError(f"no geometry type {number}")
    n = 2 + (bool(number & HAS_Z) or more in (1, 3)) + (bool(number & HAS_M) or more in (2, 3))
    if code == 1:
        path = data.corners(1, n)
        # An empty point has ordinates that are no numbers.
        found = [("point", [path] if not any(c != c for c in path[0]) else [])]
    elif code == 2:
        path = data.corners(data.take("I")[0], n)
        found = [("line", [path] if path else [])]
    elif code == 3:
        found = [("area", [data.corners(data.take("I")[0], n) for _ in range(data.take("I")[0])])]
    elif code - 3 in KINDS:
        members = [_geometry(data)[1] for _ in range(data.take("I")[0])]
        found = [(KINDS[code - 3], [path for (kind, paths), *_ in members for path in paths])]
        if any(kind != KINDS[code - 3] for (kind, _), *_ in members):
            raise ValueError(f"a member of another kind in geometry type {code}")
    elif code == COLLECTION:
        found = [shape for _ in range(data.take("I")[0]) for shape in _geometry(data)[1]]
    else:
        raise ValueError(f"no geometry type {number}")
    data.order = outer
    return srid, found


def decode(hex_text: str) -> tuple[int | None, list[tuple[str, list[Path]]]]:
    """SRID and simple geometries of a hex text; anything that is not one whole geometry raises."""
    data = _Bytes(bytes.fromhex(hex_text))
    out = _geometry(data)
    if data.at != len(data.data):
        raise ValueError("bytes after a geometry")
    return out


def _decoded(column: pd.Series) -> pd.DataFrame:
    rows = []
    for value in column:
        if value is None:
            rows.append((None, None))
            continue
        srid, shapes = decode(value)
        rows.append((srid, [{"kind": k, "paths": [[{"lon": x, "lat": y} for x, y in p] for p in paths]} for k, paths in shapes]))
    out = pd.DataFrame(rows, columns=["srid", "shapes"])
    return out.astype({"srid": "Int32"})


def shapes(column: Column) -> Column:
    """The geometry of a hex column as :data:`SHAPES`; NULL has no shapes, and what is no geometry raises."""
    return F.pandas_udf(_decoded, SHAPES)(column)


def decode_shapes(df: DataFrame, geometry: str) -> DataFrame:
    """One row per simple geometry: ``srid``, ``part`` (its number), ``kind`` and ``paths`` in place of the hex column."""
    kept = [c for c in df.columns if c != geometry]
    parsed = df.withColumn("_geometry", shapes(F.col(geometry))).select(
        *kept, F.col("_geometry.srid").alias("srid"), F.posexplode("_geometry.shapes").alias("part", "_shape")
    )
    return parsed.select(*kept, "srid", "part", "_shape.kind", "_shape.paths")
