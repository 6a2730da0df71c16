"""Cell keys: a flat hexagon grid, Morton keys and square cells in power-of-two sizes.

The hexagons tile the Web Mercator plane. They are not cells of any published
global grid and not equal in area on the ground; edge lengths shrink by sqrt(7)
per resolution so that a resolution number means about the usual cell size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from geoloom.functions.crs import WEB_MERCATOR_MAX, to_degrees, to_mercator
from geoloom.functions.geometry import geometry, let, vertex

EDGE_AT_ZERO = 1281256.011  # metres
_SHIFT = 1 << 28
_ROOT3 = math.sqrt(3)


def hex_edge(resolution: int) -> float:
    """Edge length in Mercator metres; resolutions 0 to 15."""
    if not 0 <= resolution <= 15:
        raise ValueError(f"Resolution must be 0 to 15, got {resolution}")
    return EDGE_AT_ZERO / math.sqrt(7) ** resolution


def hex_cell(lon: Column, lat: Column, resolution: int) -> Column:
    """Cell id of a point. Latitudes beyond the Mercator square belong to its edge cells."""
    edge = hex_edge(resolution)
    mx, my = to_mercator(lon, lat)
    my = F.greatest(F.least(my, F.lit(WEB_MERCATOR_MAX)), F.lit(-WEB_MERCATOR_MAX))
    q0 = (mx * (_ROOT3 / 3) - my / 3) / edge
    r0 = my * (2 / 3) / edge
    q, r = F.rint(q0), F.rint(r0)
    dq, dr = q0 - q, r0 - r
    # The rounded pair is the nearest centre or next to it, along the axis that was rounded further.
    along_q = (F.abs(dq) >= F.abs(dr)).cast("double")
    qq = q + along_q * F.rint(dq + dr / 2)
    rr = r + (1 - along_q) * F.rint(dr + dq / 2)
    return (F.lit(resolution).cast("long") * (1 << 58)
            + (qq.cast("long") + _SHIFT) * (1 << 29) + rr.cast("long") + _SHIFT)


def hex_axis(cell: Column) -> tuple[Column, Column]:
    """Axial coordinates (q, r) of a cell id."""
    low = F.lit((1 << 29) - 1)
    return F.shiftright(cell, 29).bitwiseAND(low) - _SHIFT, cell.bitwiseAND(low) - _SHIFT


def hex_polygon(cell: Column, resolution: int) -> Column:
    """Outline of a cell in degrees."""
    edge = hex_edge(resolution)
    q, r = hex_axis(cell)
    cx = (q + r / 2) * (edge * _ROOT3)
    cy = r * (edge * 1.5)
    # Pointy-top corners share three longitudes and four latitudes.
    half = edge * _ROOT3 / 2
    places = F.struct(
        *[to_degrees(cx + d, cy)[0].alias(f"x{i}") for i, d in enumerate((-half, 0.0, half))],
        *[to_degrees(cx, cy + d)[1].alias(f"y{i}") for i, d in enumerate((-edge, -edge / 2, edge / 2, edge))],
    )
    corners = ((2, 1), (2, 2), (1, 3), (0, 2), (0, 1), (1, 0), (2, 1))
    return geometry(F.lit("Polygon"), F.lit(4326), F.array(F.array(let(
        places, lambda p: F.array(*[vertex(p[f"x{i}"], p[f"y{j}"]) for i, j in corners])))))


def morton(x: Column, y: Column, xmin: float = -180.0, ymin: float = -90.0, xmax: float = 180.0, ymax: float = 90.0) -> Column:
    """Z-order key: 31 bits of each axis interleaved, x in the even places."""

    def scaled(v: Column, lo: float, hi: float) -> Column:
        span = F.floor((v - lo) / (hi - lo) * float(1 << 31)).cast("long")
        return F.greatest(F.least(span, F.lit((1 << 31) - 1)), F.lit(0).cast("long"))

    def spread(v: Column) -> Column:
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                            (2, 0x3333333333333333), (1, 0x5555555555555555)):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        return v

    return spread(scaled(x, xmin, xmax)).bitwiseOR(F.shiftleft(spread(scaled(y, ymin, ymax)), 1))


def square_cells(xmin: Column, ymin: Column, xmax: Column, ymax: Column, level: Column) -> Column:
    """Squares of side 2^level that a box reaches, as array of (_level, _cx, _cy)."""
    side = F.pow(F.lit(2.0), level)

    def span(lo: Column, hi: Column) -> Column:
        return F.sequence(F.floor(lo / side), F.floor(hi / side))

    return F.flatten(F.transform(span(xmin, xmax), lambda cx: F.transform(span(ymin, ymax), lambda cy: F.struct(
        level.cast("int").alias("_level"), cx.alias("_cx"), cy.alias("_cy")))))
