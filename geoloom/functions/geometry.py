"""The geometry column: one struct for all six types, and text encoders for it.

    struct<type, srid, parts: array<array<array<struct<x, y>>>>>
                          part   ring/line  vertex

A Point is [[[p]]], a MultiPoint has one part per point, a line one part per
line, a polygon one part per shell (ring 0 is the shell, the others its holes).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VERTEX_DDL = "struct<x:double,y:double>"
PARTS_DDL = f"array<array<array<{VERTEX_DDL}>>>"
GEOMETRY_DDL = f"struct<type:string,srid:int,parts:{PARTS_DDL}>"

# The six geometry type names of the simple-feature model.
GEOMETRY_TYPES = ("Point", "MultiPoint", "LineString", "MultiLineString", "Polygon", "MultiPolygon")

BBOX = ("_xmin", "_ymin", "_xmax", "_ymax")
#: Columns that are kept for filters and statistics and are no attributes: the box and the stored epoch milliseconds.
HIDDEN = (*BBOX, "_time_ms")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it several times inside one expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def vertex(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def geometry(kind: Column, srid: Column, parts: Column) -> Column:
    return F.struct(kind.alias("type"), srid.cast("int").alias("srid"), parts.alias("parts"))


def point(x: Column, y: Column, srid: int | None = 4326) -> Column:
    return geometry(F.lit("Point"), F.lit(srid), F.array(F.array(F.array(vertex(x, y)))))


def box(xmin: Column, ymin: Column, xmax: Column, ymax: Column, srid: int | None = 4326) -> Column:
    """Rectangle as a closed polygon ring, counter-clockwise from the lower left."""
    corners = [(xmin, ymin), (xmax, ymin), (xmax, ymax), (xmin, ymax), (xmin, ymin)]
    return geometry(F.lit("Polygon"), F.lit(srid), F.array(F.array(F.array(*[vertex(a, b) for a, b in corners]))))


def line(*xy: tuple[Column, Column], srid: int | None = 4326) -> Column:
    return geometry(F.lit("LineString"), F.lit(srid), F.array(F.array(F.array(*[vertex(a, b) for a, b in xy]))))


def vertices(geom: Column) -> Column:
    """All vertices in one flat array."""
    return F.flatten(F.flatten(geom["parts"]))


def map_vertices(geom: Column, fn: Callable[[Column], Column], srid: Column | None = None) -> Column:
    """Rewrite every vertex; `fn` gets a vertex struct and returns one."""
    moved = F.transform(geom["parts"], lambda part: F.transform(part, lambda ring: F.transform(ring, fn)))
    return F.when(geom.isNotNull(), geometry(geom["type"], geom["srid"] if srid is None else srid, moved))


def bounds(geom: Column) -> dict[str, Column]:
    """Bounding box as four columns, NULL for an empty or missing geometry."""
    xs, ys = vertices(geom).getField("x"), vertices(geom).getField("y")
    return dict(zip(BBOX, (F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))))


def with_column_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column so that it is computed once per row.

    A plain column would be copied into every later filter that uses it; a
    generated one is a boundary that filters stay above.
    """
    return df.withColumn(name, F.explode(F.array(value)))


def with_bounds(df: DataFrame, geom: str = "geom") -> DataFrame:
    """Add or refresh the flat box columns that Parquet statistics can use."""
    return df.withColumns(bounds(F.col(geom)))


def envelope(df: DataFrame, out: str = "envelope", srid: int = 4326) -> DataFrame:
    """Box of each geometry as a polygon; a box without area stays a point or line."""
    x0, y0, x1, y1 = (F.col(c) for c in BBOX)
    shape = (
        F.when((x0 == x1) & (y0 == y1), point(x0, y0, srid))
        .when((x0 == x1) | (y0 == y1), line((x0, y0), (x1, y1), srid=srid))
        .otherwise(box(x0, y0, x1, y1, srid))
    )
    return df.withColumn(out, F.when(x0.isNotNull(), shape))


def type_name(geom: Column) -> Column:
    """Type name; anything unknown or missing reads as Point."""
    return F.when(geom["type"].isin(*GEOMETRY_TYPES), geom["type"]).otherwise("Point")


def dimension(geom: Column) -> Column:
    """0 for points, 1 for lines, 2 for polygons."""
    kind = geom["type"]
    return F.when(kind.endswith("Polygon"), 2).when(kind.endswith("LineString"), 1).when(kind.endswith("Point"), 0)


def _number_text(value: Column) -> Column:
    return F.regexp_replace(value.cast("string"), r"\.0$", "")


def as_wkt(geom: Column) -> Column:
    """Well-known text of a geometry."""

    def pair(v: Column) -> Column:
        return F.concat(_number_text(v["x"]), F.lit(" "), _number_text(v["y"]))

    def ring(vs: Column) -> Column:
        return F.concat(F.lit("("), F.array_join(F.transform(vs, pair), ", "), F.lit(")"))

    def part(rs: Column) -> Column:
        return F.concat(F.lit("("), F.array_join(F.transform(rs, ring), ", "), F.lit(")"))

    kind, parts = geom["type"], geom["parts"]
    every_ring = F.concat(F.lit("("), F.array_join(F.transform(F.flatten(parts), ring), ", "), F.lit(")"))
    body = (
        F.when(kind.isin("Point", "LineString"), ring(vertices(geom)))
        .when(kind.isin("MultiPoint", "MultiLineString", "Polygon"), every_ring)
        .otherwise(F.concat(F.lit("("), F.array_join(F.transform(parts, part), ", "), F.lit(")")))
    )
    return F.concat(F.upper(kind), F.when(F.size(vertices(geom)) == 0, F.lit(" EMPTY")).otherwise(body))


def as_ewkt(geom: Column) -> Column:
    """Well-known text with the SRID in front, as secondary geometry columns are written."""
    return F.concat(F.lit("SRID="), F.coalesce(geom["srid"], F.lit(0)).cast("string"), F.lit(";"), as_wkt(geom))


def as_geojson(geom: Column) -> Column:
    """GeoJSON geometry text; coordinates nest as deep as the type asks for."""

    def pair(v: Column) -> Column:
        return F.array(v["x"], v["y"])

    def pairs(ring: Column) -> Column:
        return F.transform(ring, pair)

    def text(coordinates: Column) -> Column:
        return F.to_json(F.struct(kind.alias("type"), coordinates.alias("coordinates")))

    kind, parts, flat = geom["type"], geom["parts"], vertices(geom)
    rings = F.flatten(parts)
    return (
        F.when(kind == "Point", text(F.coalesce(pair(F.get(flat, F.lit(0))), F.array().cast("array<double>"))))
        .when(kind.isin("LineString", "MultiPoint"), text(pairs(flat)))
        .when(kind.isin("Polygon", "MultiLineString"), text(F.transform(rings, pairs)))
        .when(kind == "MultiPolygon", text(F.transform(parts, lambda rs: F.transform(rs, pairs))))
    )
