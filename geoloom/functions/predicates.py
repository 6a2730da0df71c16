"""Spatial predicates of a geometry column (A) against a filter shape or another column (B).

Points are tested with plain column arithmetic that stays inside generated code;
lines and polygons go to the exact relation function only when the box columns
leave the answer open.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from geoloom.functions.geometry import BBOX, dimension, let
from geoloom.functions.relate import relation, relation_to
from geoloom.functions.shapes import FilterShape

# Relation names of feature requests, with their short names.
RELATIONS = {
    "esriSpatialRelIntersects": "intersects",
    "esriSpatialRelContains": "contains",
    "esriSpatialRelWithin": "within",
    "esriSpatialRelTouches": "touches",
    "esriSpatialRelOverlaps": "overlaps",
    "esriSpatialRelCrosses": "crosses",
}

_UNROLL = 8
_ON = 1 << 24  # share of an edge that the point lies on: even, and more than any number of crossings


def relation_name(name: str) -> str:
    short = RELATIONS.get(name, name)
    if short not in RELATIONS.values():
        raise ValueError(f"Unsupported spatial relation: {name}")
    return short


def _from_table(name: str, m: Column, dim_a: Column, dim_b: Column, strict: bool) -> Column:
    """A predicate from the relation table `m`."""
    met = F.greatest(m["ii"], m["ib"], m["bi"], m["bb"])
    touches = (m["ii"] < 0) & (met >= 0)
    a_in_b = (m["ie"] < 0) & (m["be"] < 0)
    b_in_a = (m["ei"] < 0) & (m["eb"] < 0)
    if name == "intersects":
        return met >= 0
    if name == "touches":
        return touches
    if name == "within":
        return (m["ii"] >= 0) & a_in_b
    if name == "contains":
        return (m["ii"] >= 0) & b_in_a
    if name == "overlaps":
        same = (dim_a == dim_b) & (met >= 0) & ~a_in_b & ~b_in_a & ~touches
        return same & ((dim_a != 1) | (m["ii"] == 1)) if strict else same
    apart = (met >= 0) & ~touches & ~((m["ii"] >= 0) & (a_in_b | b_in_a))
    return apart & (met < F.greatest(dim_a, dim_b))


def _edges(shape: FilterShape) -> list[tuple[float, float, float, float]]:
    return [(*p, *q) for part in shape.parts for ring in part for p, q in zip(ring, ring[1:]) if p != q]


def _line_ends(shape: FilterShape) -> list[tuple[float, float]]:
    tips = [ring[i] for part in shape.parts for ring in part for i in (0, -1)]
    return sorted({t for t in tips if tips.count(t) % 2 == 1})


def _any(terms: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, terms) if terms else F.lit(False)


def _side(x1, y1, x2, y2, x, y) -> Column:
    """Which side of an edge a point lies on: positive left, negative right, zero on it."""
    return (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)


def _point_place(x: Column, y: Column, shape: FilterShape) -> Column:
    """2 inside, 1 on the boundary, 0 outside, for a point against a fixed shape."""
    if shape.dimension == 0:
        return F.when(_any([(x == px) & (y == py) for px, py in shape.vertices]), 2).otherwise(0)
    if shape.is_box:
        x0, y0, x1, y1 = shape.bounds
        return F.when((x > x0) & (x < x1) & (y > y0) & (y < y1), 2).when(
            x.between(x0, x1) & y.between(y0, y1), 1).otherwise(0)
    ends = _any([(x == px) & (y == py) for px, py in _line_ends(shape)]) if shape.dimension == 1 else F.lit(False)
    edges = _edges(shape)
    if len(edges) <= _UNROLL:
        total = reduce(lambda a, b: a + b, [_edge_share(*map(F.lit, e), x, y) for e in edges])
        if shape.dimension == 1:
            return F.when(ends, 1).when(total >= _ON, 2).otherwise(0)
        return F.when(total >= _ON, 1).when(total % 2 == 1, 2).otherwise(0)
    total = _banded_share(edges, shape.bounds, x, y)
    if shape.dimension == 1:
        return F.when(ends, 1).otherwise(let(total, lambda n: F.when(n >= _ON, 2).otherwise(0)))
    return let(total, lambda n: F.when(n >= _ON, 1).when(n % 2 == 1, 2).otherwise(0))


def _edge_share(x1, y1, x2, y2, x, y) -> Column:
    """1 if the ray from the point towards +x crosses the edge, a huge even number if the point lies on it, else 0."""
    side = _side(x1, y1, x2, y2, x, y)
    low, high = F.least(y1, y2), F.greatest(y1, y2)
    beyond = (y < low) | (y > high) | (x > F.greatest(x1, x2))
    rising = F.when(y2 > y1, side > 0).otherwise(side < 0)
    return F.when(beyond, 0).when((side == 0) & (x >= F.least(x1, x2)), _ON).when((y < high) & rising, 1).otherwise(0)


def _banded_share(edges: list[tuple], bounds: tuple[float, float, float, float], x: Column, y: Column) -> Column:
    """Sum of the edge shares, looking only at the edges listed for the band of y the point lies in.

    The bands are narrowed as long as the lists stay about as long as the outline.
    """
    low, high = bounds[1], bounds[3]
    count = min(len(edges), 4096)

    def listing(n: int) -> list[list]:
        def band(v: float) -> int:
            return min(max(int(math.floor((v - low) / (high - low) * n)), 0), n - 1) if high > low else 0
        bands: list[list] = [[] for _ in range(n)]
        for e in edges:
            # One band more on either side keeps rounding of the band number harmless.
            for k in range(max(band(min(e[1], e[3])) - 1, 0), min(band(max(e[1], e[3])) + 1, n - 1) + 1):
                bands[k].append(list(map(float, e)))
        return bands

    bands = listing(count)
    while count > 1 and sum(map(len, bands)) > 8 * len(edges):
        count //= 2
        bands = listing(count)
    table = F.from_json(F.lit(json.dumps(bands)), "array<array<array<double>>>")
    place = F.floor((y - F.lit(low)) / F.lit((high - low) or 1.0) * F.lit(float(count))).cast("int")
    near = F.get(table, F.greatest(F.least(place, F.lit(count - 1)), F.lit(0)))
    return F.aggregate(near, F.lit(0), lambda n, e: n + _edge_share(*[F.get(e, F.lit(i)) for i in range(4)], x, y))


def _point_answer(name: str, place: Callable[[], Column], x: Column, y: Column, shape: FilterShape) -> Column:
    """Predicate for a single point; it never overlaps nor crosses anything."""
    if name == "intersects":
        return place() > 0
    if name == "within":
        return place() == 2
    if name == "touches":
        return place() == 1
    if name == "contains" and shape.dimension == 0 and len(set(shape.vertices)) == 1:
        px, py = shape.vertices[0]
        return (x == px) & (y == py)
    return F.lit(False)


def bounds_test(name: str, box: tuple[float, float, float, float]) -> Column:
    """What the box columns must satisfy; these comparisons reach the Parquet scan."""
    x0, y0, x1, y1 = (F.lit(float(v)) for v in box)
    xmin, ymin, xmax, ymax = (F.col(c) for c in BBOX)
    if name == "within":
        return (xmin >= x0) & (ymin >= y0) & (xmax <= x1) & (ymax <= y1)
    if name == "contains":
        return (xmin <= x0) & (ymin <= y0) & (xmax >= x1) & (ymax >= y1)
    return (xmin <= x1) & (ymin <= y1) & (xmax >= x0) & (ymax >= y0)


def matches(geom: Column, shape: FilterShape, spatial_rel: str = "intersects", strict: bool = False,
            geometry_type: str | None = None) -> Column:
    """Exact predicate of a geometry column against one shape. Needs the box columns next to it.

    `geometry_type="Point"` promises single points and keeps the whole test in the JVM.
    """
    name = relation_name(spatial_rel)
    xmin, ymin, xmax, ymax = (F.col(c) for c in BBOX)
    box = bounds_test(name, shape.bounds)
    on_point = _point_answer(name, lambda: _point_place(xmin, ymin, shape), xmin, ymin, shape)
    if geometry_type == "Point":
        return box & on_point
    single = geom["type"] == "Point"
    settled, answer = single, F.when(single, on_point)
    if shape.is_box:
        x0, y0, x1, y1 = (F.lit(float(v)) for v in shape.bounds)
        deep = (xmin > x0) & (ymin > y0) & (xmax < x1) & (ymax < y1)
        settled, answer = settled | deep, answer.when(deep, F.lit(name in ("intersects", "within")))
    open_case = F.when(box & ~settled, geom)
    table = relation_to(open_case, (shape.kind, shape.parts))
    exact = _from_table(name, table, dimension(geom), F.lit(shape.dimension), strict)
    return box & answer.otherwise(exact)


def matches_column(geom: Column, other: Column, spatial_rel: str = "intersects", strict: bool = False) -> Column:
    """Exact predicate of two geometry columns."""
    name = relation_name(spatial_rel)
    return _from_table(name, relation(geom, other), dimension(geom), dimension(other), strict)


def st_intersects(a: Column, b: Column) -> Column:
    return matches_column(a, b, "intersects")


def st_contains(a: Column, b: Column) -> Column:
    return matches_column(a, b, "contains")


def st_within(a: Column, b: Column) -> Column:
    return matches_column(a, b, "within")


def st_touches(a: Column, b: Column) -> Column:
    return matches_column(a, b, "touches")


def st_overlaps(a: Column, b: Column, strict: bool = False) -> Column:
    return matches_column(a, b, "overlaps", strict)


def st_crosses(a: Column, b: Column) -> Column:
    return matches_column(a, b, "crosses")


def edge_list(polygon: Column) -> Column:
    """All edges of a polygon column as one flat array."""

    def edges(ring: Column) -> Column:
        n = F.greatest(F.size(ring) - 1, F.lit(0))
        return F.zip_with(F.slice(ring, F.lit(1), n), F.slice(ring, F.lit(2), n), lambda p, q: F.struct(
            p["x"].alias("a"), p["y"].alias("b"), q["x"].alias("c"), q["y"].alias("d")))

    return F.flatten(F.transform(F.flatten(polygon["parts"]), edges))


def place_among(edges: Column, x: Column, y: Column) -> Column:
    """2 inside, 1 on the boundary, 0 outside, for a point against the edges of a polygon."""
    total = F.aggregate(edges, F.lit(0), lambda n, e: n + _edge_share(e["a"], e["b"], e["c"], e["d"], x, y))
    return let(total, lambda n: F.when(n >= _ON, 1).when(n % 2 == 1, 2).otherwise(0))


def point_place_in(x: Column, y: Column, polygon: Column) -> Column:
    """The same against a polygon column."""
    return place_among(edge_list(polygon), x, y)
