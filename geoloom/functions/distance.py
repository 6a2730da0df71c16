"""Planar distance from a geometry to a position, in the JVM for every type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from geoloom.functions.geometry import let, vertices
from geoloom.functions.predicates import point_place_in


def _to_segment(a: Column, b: Column, px: Column, py: Column) -> Column:
    """Squared distance from a position to one segment."""
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    length = dx * dx + dy * dy
    along = F.when(length == 0, F.lit(0.0)).otherwise(
        ((px - a["x"]) * dx + (py - a["y"]) * dy) / F.when(length == 0, F.lit(1.0)).otherwise(length))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
    ex, ey = a["x"] + t * dx - px, a["y"] + t * dy - py
    return ex * ex + ey * ey


def distance_to(geom: Column, x: float, y: float, geometry_type: str | None = None) -> Column:
    """Distance to (x, y); 0 inside a polygon. Point layers use their box columns only."""
    px, py = F.lit(float(x)), F.lit(float(y))
    dx, dy = F.col("_xmin") - px, F.col("_ymin") - py
    straight = F.sqrt(dx * dx + dy * dy)
    if geometry_type == "Point":
        return straight

    def ring_gap(ring: Column) -> Column:
        n = F.greatest(F.size(ring) - 1, F.lit(0))
        return F.array_min(F.zip_with(F.slice(ring, F.lit(1), n), F.slice(ring, F.lit(2), n),
                                      lambda a, b: _to_segment(a, b, px, py)))

    spread = F.sqrt(F.array_min(F.transform(vertices(geom), lambda v: (v["x"] - px) * (v["x"] - px) + (v["y"] - py) * (v["y"] - py))))
    outline = F.sqrt(F.array_min(F.transform(F.flatten(geom["parts"]), ring_gap)))
    kind = geom["type"]
    return (
        F.when(kind == "Point", straight)
        .when(kind == "MultiPoint", spread)
        .when(kind.endswith("LineString"), outline)
        .otherwise(let(point_place_in(px, py, geom), lambda place: F.when(place > 0, F.lit(0.0)).otherwise(outline)))
    )
