"""Hexagons that nest: every cell has one parent and seven children, known from its id alone.

Centres are whole numbers a + b*u of the hexagonal lattice (u is a sixth of a turn) over the Web Mercator plane. The centres
one resolution up are the multiples of 2 + u or of its mirror image 3 - u, in turn; both have the norm 7, so edge lengths
shrink by sqrt(7) as those of the flat grid do, and the turns cancel: at even resolutions a cell is the one of the flat grid,
at odd ones the grid is turned by 19.1 degrees. A parent covers about, not exactly, the area of its children.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from geoloom.functions.cells import _ROOT3, _SHIFT, hex_axis, hex_edge
from geoloom.functions.crs import WEB_MERCATOR_MAX, to_degrees, to_mercator
from geoloom.functions.geometry import geometry, let, vertex

#: Angle of 2 + u, by which odd resolutions are turned.
TURN = math.atan2(_ROOT3 / 2, 2.5)


def _times(a: int, b: int, q: Column, r: Column) -> tuple[Column, Column]:
    """(a + b*u) * (q + r*u), where u*u = u - 1."""
    return q * a - r * b, r * (a + b) + q * b


def _nearest(q0: Column, r0: Column) -> Column:
    """The lattice point whose hexagon holds a place: the rounded pair, or the one next to it on the axis that was rounded further."""

    def settle(p: Column) -> Column:
        q, r = F.rint(p["q"]), F.rint(p["r"])
        dq, dr = p["q"] - q, p["r"] - r
        along_q = (F.abs(dq) >= F.abs(dr)).cast("double")
        return F.struct((q + along_q * F.rint(dq + dr / 2)).cast("long").alias("q"), (r + (1 - along_q) * F.rint(dr + dq / 2)).cast("long").alias("r"))

    return let(F.struct(q0.cast("double").alias("q"), r0.cast("double").alias("r")), settle)


def _id(place: Column, resolution: int) -> Column:
    return F.lit(resolution).cast("long") * (1 << 58) + (place["q"] + _SHIFT) * (1 << 29) + place["r"] + _SHIFT


def nested_cell(lon: Column, lat: Column, resolution: int) -> Column:
    """Cell id of a point, resolutions 0 to 15. Latitudes beyond the Mercator square belong to its edge cells; NULL where a number is missing."""
    edge = hex_edge(resolution - resolution % 2)
    mx, my = to_mercator(lon, lat)
    my = F.greatest(F.least(my, F.lit(WEB_MERCATOR_MAX)), F.lit(-WEB_MERCATOR_MAX))

    def place(p: Column) -> Column:
        q, r = (p["x"] * (_ROOT3 / 3) - p["y"] / 3) / edge, p["y"] * (2 / 3) / edge
        return _nearest(*(_times(2, 1, q, r) if resolution % 2 else (q, r)))

    found = let(let(F.struct(mx.alias("x"), my.alias("y")), place), lambda p: _id(p, resolution))
    return F.when(lon.isNotNull() & lat.isNotNull(), found)


def _up(place: Column, a: int, b: int) -> Column:
    return let(place, lambda p: _nearest(*[axis / 7 for axis in _times(a, b, p["q"], p["r"])]))


def nested_parent(cell: Column, resolution: int, parent: int) -> Column:
    """The cell at a coarser (or the same) resolution that a cell belongs to, by whole-number steps."""
    hex_edge(resolution)
    if not 0 <= parent <= resolution:
        raise ValueError(f"A parent of resolution {resolution} is at 0 to {resolution}, got {parent}")
    place = F.struct(*[axis.cast("long").alias(n) for n, axis in zip("qr", hex_axis(cell))])
    for level in range(resolution, parent, -1):
        # Division by 2 + u is the product with its mirror image over seven, and the other way round.
        place = _up(place, *((3, -1) if level % 2 else (2, 1)))
    return F.when(cell.isNotNull(), let(place, lambda p: _id(p, parent)))


def _centre(cell: Column, resolution: int) -> tuple[Column, Column]:
    q, r = hex_axis(cell)
    if resolution % 2:
        q, r = (axis / 7 for axis in _times(3, -1, q, r))
    edge = hex_edge(resolution - resolution % 2)
    return (q + r / 2) * (edge * _ROOT3), r * (edge * 1.5)


def nested_polygon(cell: Column, resolution: int) -> Column:
    """Outline of a cell in degrees."""
    edge, turn = hex_edge(resolution), -TURN if resolution % 2 else 0.0
    angles = [turn - math.pi / 6 + i % 6 * math.pi / 3 for i in range(7)]

    def outline(c: Column) -> Column:
        return F.array(*[vertex(*to_degrees(c["x"] + edge * math.cos(a), c["y"] + edge * math.sin(a))) for a in angles])

    x, y = _centre(cell, resolution)
    return geometry(F.lit("Polygon"), F.lit(4326), F.array(F.array(let(F.struct(x.alias("x"), y.alias("y")), outline))))
