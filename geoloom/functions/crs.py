"""Coordinates: reprojection, dateline unwrapping and longitude wrapping."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from geoloom.functions.geometry import GEOMETRY_DDL, geometry, let, map_vertices, vertex

WEB_MERCATOR_MAX = 20037508.342789244
RADIUS = WEB_MERCATOR_MAX / math.pi

# Codes that all mean spherical Web Mercator.
MERCATOR_CODES = (3857, 102100, 102113, 900913)

# The ellipsoid of WGS 84 (half axis in metres, flattening) and the scale and false origins of the UTM zones.
HALF_AXIS, FLATTENING = 6378137.0, 1 / 298.257223563
UTM_SCALE, UTM_EAST, UTM_NORTH = 0.9996, 500_000.0, {326: 0.0, 327: 10_000_000.0}

# Krueger's series in the third flattening n, coefficients of n, n**2, n**3, n**4 (forward, inverse, latitude).
FORWARD = ((1 / 2, -2 / 3, 5 / 16, 41 / 180), (0, 13 / 48, -3 / 5, 557 / 1440), (0, 0, 61 / 240, -103 / 140), (0, 0, 0, 49561 / 161280))
INVERSE = ((1 / 2, -2 / 3, 37 / 96, -1 / 360), (0, 1 / 48, 1 / 15, -437 / 1440), (0, 0, 17 / 480, -37 / 840), (0, 0, 0, 4397 / 161280))
LATITUDE = ((2, -2 / 3, -2, 116 / 45), (0, 7 / 3, -8 / 5, -227 / 45), (0, 0, 56 / 15, -136 / 35), (0, 0, 0, 4279 / 630))

_N = FLATTENING / (2 - FLATTENING)
_ECCENTRICITY = math.sqrt(FLATTENING * (2 - FLATTENING))
#: Metres of UTM per radian along the meridian.
_METRES = UTM_SCALE * HALF_AXIS / (1 + _N) * (1 + _N ** 2 / 4 + _N ** 4 / 64 + _N ** 6 / 256)
#: Degrees off a zone's meridian from which a vertex has no image in it.
UTM_REACH = 80.0


def same_system(srid: int) -> int:
    """One code per coordinate system."""
    return 3857 if srid in MERCATOR_CODES else srid


def point_to_degrees(x: float, y: float) -> tuple[float, float]:
    return math.degrees(x / RADIUS), math.degrees(2 * math.atan(math.exp(y / RADIUS)) - math.pi / 2)


def point_to_mercator(x: float, y: float) -> tuple[float, float]:
    return x * RADIUS * math.pi / 180, RADIUS * math.log(math.tan(math.radians(y) / 2 + math.pi / 4))


def to_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    return x * F.lit(RADIUS * math.pi / 180), F.log(F.tan(F.radians(y) / 2 + F.lit(math.pi / 4))) * F.lit(RADIUS)


def to_degrees(x: Column, y: Column) -> tuple[Column, Column]:
    return F.degrees(x / F.lit(RADIUS)), F.degrees(F.atan(F.exp(y / F.lit(RADIUS))) * 2 - F.lit(math.pi / 2))


def _series(coefficients: tuple) -> list[float]:
    return [sum(c * _N ** (k + 1) for k, c in enumerate(row)) for row in coefficients]


def _summed(terms) -> Column:
    total = F.lit(0.0)
    for term in terms:
        total = total + term
    return total


def is_utm(srid: int) -> bool:
    return srid // 100 in UTM_NORTH and 1 <= srid % 100 <= 60


def utm_meridian(zone: Column | int) -> Column | int:
    """Central meridian of a zone in degrees."""
    return zone * 6 - 183


def off_meridian(x: Column, zone: Column | int) -> Column:
    """Degrees of longitude from the zone's meridian, -180 to 180."""
    return F.pmod(x - utm_meridian(zone) + 180, F.lit(360.0)) - 180


def to_utm(x: Column, y: Column, srid: int) -> tuple[Column, Column]:
    """Easting and northing of a place in degrees, within a thousandth of a millimetre near the zone."""
    sine = F.sin(F.radians(y))
    t = F.sinh(F.atanh(sine) - F.atanh(sine * _ECCENTRICITY) * _ECCENTRICITY)
    away = F.radians(off_meridian(x, srid % 100))

    def projected(at: Column) -> Column:
        xi, eta = at["xi"], at["eta"]
        terms = list(enumerate(_series(FORWARD), 1))
        east = eta + _summed(F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j)) * a for j, a in terms)
        north = xi + _summed(F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j)) * a for j, a in terms)
        return F.struct((east * _METRES + UTM_EAST).alias("x"), (north * _METRES + UTM_NORTH[srid // 100]).alias("y"))

    sphere = let(t, lambda v: F.struct(F.atan2(v, F.cos(away)).alias("xi"), F.atanh(F.sin(away) / F.sqrt(v * v + 1)).alias("eta")))
    out = let(sphere, projected)
    return out["x"], out["y"]


def from_utm(x: Column, y: Column, code: Column) -> tuple[Column, Column]:
    """Degrees of an easting and northing in the zone that a column of codes names."""
    north = F.when(F.floor(code / 100) == 327, F.lit(UTM_NORTH[327])).otherwise(F.lit(UTM_NORTH[326]))
    grid = F.struct(((y - north) / _METRES).alias("xi"), ((x - UTM_EAST) / _METRES).alias("eta"))
    terms = list(enumerate(_series(INVERSE), 1))

    def sphere(at: Column) -> Column:
        xi, eta = at["xi"], at["eta"]
        return F.struct((xi - _summed(F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j)) * b for j, b in terms)).alias("xi"),
                        (eta - _summed(F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j)) * b for j, b in terms)).alias("eta"))

    def place(at: Column) -> Column:
        chi = F.asin(F.sin(at["xi"]) / F.cosh(at["eta"]))
        latitude = let(chi, lambda c: c + _summed(F.sin(c * (2 * j)) * d for j, d in enumerate(_series(LATITUDE), 1)))
        longitude = F.degrees(F.atan2(F.sinh(at["eta"]), F.cos(at["xi"]))) + utm_meridian(code % 100)
        return F.struct((F.pmod(longitude + 180, F.lit(360.0)) - 180).alias("x"), F.degrees(latitude).alias("y"))

    out = let(let(grid, sphere), place)
    return out["x"], out["y"]


def reproject(geom: Column, to: int, source: Column | None = None) -> Column:
    """Geometry in another system: 4326, Web Mercator and the UTM zones of WGS 84 (326xx, 327xx), from any to any; others are an error.

    A vertex with no image (a pole in Web Mercator, 80 degrees or more off the
    meridian of a UTM zone) leaves no geometry.
    """
    target = same_system(to)

    def move(g: Column) -> Column:
        code = g["srid"] if source is None else source
        code = F.when(code.isin(*MERCATOR_CODES), 3857).otherwise(code)
        stamp = F.lit(target)
        utm = F.floor(code / 100).isin(*UTM_NORTH) & (code % 100).between(1, 60)
        degrees = {
            4326: (code == 4326, lambda v: (v["x"], v["y"])),
            3857: (code == 3857, lambda v: to_degrees(v["x"], v["y"])),
            326: (utm, lambda v: from_utm(v["x"], v["y"], code)),
        }
        cases = F.when(code == target, geometry(g["type"], stamp, g["parts"]))
        if target in (4326, 3857) or is_utm(target):
            for system, (here, place) in degrees.items():
                if system != target:
                    cases = cases.when(here, _moved(g, place, target))
        message = F.concat(F.lit("No transform from SRID "), F.coalesce(code.cast("string"), F.lit("unknown")), F.lit(f" to {target}"))
        return cases.otherwise(F.raise_error(message).cast(GEOMETRY_DDL))

    return F.when(geom.isNotNull(), let(geom, move))


def _moved(g: Column, place: Callable[[Column], tuple[Column, Column]], target: int) -> Column:
    """The geometry with each vertex taken to degrees by `place` and from there to the target."""
    stamp = F.lit(target)

    def at(v: Column) -> Column:
        return vertex(*place(v))

    if target == 4326:
        return map_vertices(g, at, stamp)
    if target == 3857:
        usable = F.forall(F.flatten(F.flatten(g["parts"])), lambda v: F.abs(place(v)[1]) < 90)
        return F.when(usable, map_vertices(g, lambda v: let(at(v), lambda p: vertex(*to_mercator(p["x"], p["y"]))), stamp))
    usable = F.forall(F.flatten(F.flatten(g["parts"])), lambda v: let(at(v), lambda p: (F.abs(off_meridian(p["x"], target % 100)) < UTM_REACH) & (F.abs(p["y"]) < 90)))
    return F.when(usable, map_vertices(g, lambda v: let(at(v), lambda p: vertex(*to_utm(p["x"], p["y"], target))), stamp))


def unwrap_dateline(geom: Column) -> Column:
    """Shift shapes that cross the dateline to one side of it (negative longitudes +360).

    Only degrees or unset SRID; per part, its first ring decides: some edge must
    jump more than 180 degrees and no vertex may lie beyond 85 degrees latitude.
    """

    def crosses(ring: Column) -> Column:
        n = F.greatest(F.size(ring) - 1, F.lit(0))
        steps = F.zip_with(F.slice(ring, F.lit(1), n), F.slice(ring, F.lit(2), n), lambda p, q: F.abs(q["x"] - p["x"]))
        return ~F.exists(ring, lambda v: F.abs(v["y"]) > 85) & F.exists(steps, lambda d: d > 180)

    def shift(ring: Column) -> Column:
        return F.transform(ring, lambda v: vertex(F.when(v["x"] < 0, v["x"] + 360).otherwise(v["x"]), v["y"]))

    def part(rings: Column) -> Column:
        return F.when(crosses(F.get(rings, F.lit(0))), F.transform(rings, shift)).otherwise(rings)

    def unwrap(g: Column) -> Column:
        wraps = g["srid"].isNull() | g["srid"].isin(0, 4326)
        wide = F.exists(F.flatten(g["parts"]), crosses)
        return F.when(wraps & wide, geometry(g["type"], g["srid"], F.transform(g["parts"], part))).otherwise(g)

    return let(geom, unwrap)


def wrap_longitudes(geom: Column) -> Column:
    """The inverse before saving: longitudes back into [-180, 180]; degrees only."""

    def back(v: Column) -> Column:
        x = v["x"]
        return vertex(F.when(x > 180, x - 360).when(x < -180, x + 360).otherwise(x), v["y"])

    return let(geom, lambda g: F.when(g["srid"] == 4326, map_vertices(g, back)).otherwise(g))
