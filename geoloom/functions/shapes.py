"""Filter shapes and areas of interest: text in many forms to geometries in the layer's coordinates."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions.crs import point_to_degrees, point_to_mercator, reproject, same_system
from geoloom.functions.decode import ESRI_DDL, json_shape
from geoloom.functions.geometry import bounds, box, geometry, let, point, with_bounds, with_column_once
from geoloom.plans.guard import parse_integer

_SPATIAL_REFERENCE_DDL = "wkid string, latestWkid string, spatialReference struct<wkid:string,latestWkid:string>"


FILTER_FORMS = ("rings", "paths", "envelope", "point", "geojson")


def parse_shape(text: Column) -> Column:
    """`x,y`, `xmin,ymin,xmax,ymax`, JSON arrays of those, {xmin..}, {x,y}, rings, paths or GeoJSON to geometry.

    The SRID is left open (NULL); NULL geometry means the text is not a shape.
    """
    numbers = F.transform(F.split(F.regexp_replace(text, r"^\s*\[|\]\s*$", ""), ","), lambda s: F.trim(s).try_cast("double"))

    def plain(n: Column) -> Column:
        at = [F.get(n, F.lit(i)) for i in range(4)]
        return F.when(F.forall(n, lambda v: v.isNotNull()), (
            F.when(F.size(n) == 2, point(at[0], at[1], None)).when(F.size(n) == 4, box(*at, None))))

    return F.when(text.rlike(r"^\s*\{"), let(F.from_json(text, ESRI_DDL), lambda g: json_shape(
        g, F.lit(None).cast("int"), FILTER_FORMS))).otherwise(let(numbers, plain))


def _code(*candidates: Column) -> Column:
    """First usable spatial reference code, as in leading digits of the text."""
    found = [F.regexp_extract(c, r"^\s*([-+]?\d+)", 1).try_cast("int") for c in candidates]
    return F.coalesce(*[F.when(c != 0, c) for c in found])


def parse_srid(text: Column) -> Column:
    """inSR: a number, a number as text, or JSON that carries wkid / latestWkid."""
    spatial = F.from_json(text, _SPATIAL_REFERENCE_DDL)
    return let(spatial, lambda s: F.coalesce(
        _code(s["spatialReference"]["latestWkid"], s["spatialReference"]["wkid"], s["latestWkid"], s["wkid"]), _code(text)))


def resolve_srid(text: Column, shape: Column, layer_srid: int, in_sr: Column | None = None) -> Column:
    """Code of the shape's coordinates: inSR, its own reference, a Mercator guess, or the layer's."""
    own = F.from_json(text, ESRI_DDL)["spatialReference"]
    embedded = let(own, lambda s: F.when(
        s["wkt"].isNotNull() & s["wkid"].isNull() & s["latestWkid"].isNull(),
        F.raise_error(F.lit("A WKT spatial reference is not supported; send a wkid")).cast("int"),
    ).otherwise(_code(s["latestWkid"], s["wkid"])))
    guess = F.lit(None).cast("int")
    if layer_srid == 4326:
        b = bounds(shape)
        wide = (F.greatest(F.abs(b["_xmin"]), F.abs(b["_xmax"])) > 360) | (F.greatest(F.abs(b["_ymin"]), F.abs(b["_ymax"])) > 90)
        guess = F.when(wide, 3857)
    asked = F.lit(None).cast("int") if in_sr is None else parse_srid(in_sr.cast("string"))
    return F.coalesce(asked, embedded, guess, F.lit(layer_srid))


def normalize_shapes(df: DataFrame, column: str, srid: int = 4326, in_sr: str | None = None, out: str = "geom") -> DataFrame:
    """Turn a table of shape texts into geometries in `srid`, with box columns.

    Rows whose text is not a shape keep a NULL geometry. `in_sr` names an
    optional column that holds the spatial reference of each row.
    """
    text = F.col(column).cast("string")
    shape = F.col("_shape")
    code = resolve_srid(text, shape, srid, None if in_sr is None else F.col(in_sr))
    placed = let(code, lambda c: F.when(shape.isNotNull(), geometry(shape["type"], c, shape["parts"])))
    staged = with_column_once(df, "_shape", parse_shape(text))
    return with_bounds(with_column_once(staged, out, reproject(placed, srid)).drop("_shape"), out)


@dataclass(frozen=True)
class FilterShape:
    """One query shape as plain values, ready to be used as literals."""

    kind: str
    srid: int
    parts: list

    @property
    def vertices(self) -> list[tuple[float, float]]:
        return [v for part in self.parts for ring in part for v in ring]

    @property
    def bounds(self) -> tuple[float, float, float, float]:
        xs, ys = zip(*self.vertices)
        return min(xs), min(ys), max(xs), max(ys)

    @property
    def dimension(self) -> int:
        return 2 if self.kind.endswith("Polygon") else 1 if self.kind.endswith("LineString") else 0

    @property
    def is_box(self) -> bool:
        """A rectangle with sides along the axes and some area."""
        if self.kind != "Polygon" or len(self.parts) != 1 or len(self.parts[0]) != 1:
            return False
        x0, y0, x1, y1 = self.bounds
        ring = self.parts[0][0]
        corners = {(x0, y0), (x1, y0), (x1, y1), (x0, y1)}
        return len(ring) == 5 and set(ring) == corners and len(corners) == 4 and all(
            p[0] == q[0] or p[1] == q[1] for p, q in zip(ring, ring[1:]))


def _numbers(values) -> list[float]:
    if any(isinstance(v, bool) or not isinstance(v, (int, float)) or not math.isfinite(v) for v in values):
        raise ValueError("not a number")
    return [float(v) for v in values]


def _runs(lines) -> list[list[tuple[float, float]]]:
    return [[tuple(_numbers(v[:2])) for v in run] for run in lines]


def _turns_left(ring: list[tuple[float, float]]) -> bool:
    return sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:])) >= 0


def _read_shape(shape) -> tuple[str, list]:
    """Type and parts of one request shape, in the same forms as `parse_shape`."""
    if isinstance(shape, list):
        values = _numbers(shape)
        if len(values) == 2:
            return "Point", [[[tuple(values)]]]
        shape = dict(zip(("xmin", "ymin", "xmax", "ymax"), values)) if len(values) == 4 else {}
    if "rings" in shape:
        parts: list = []
        for ring in _runs(shape["rings"]):
            if parts and _turns_left(ring):
                parts[-1].append(ring)
            else:
                parts.append([ring])
        return ("Polygon" if len(parts) == 1 else "MultiPolygon"), parts
    if "paths" in shape:
        lines = _runs(shape["paths"])
        return ("LineString" if len(lines) == 1 else "MultiLineString"), [[line] for line in lines]
    if "xmin" in shape:
        x0, y0, x1, y1 = _numbers([shape[k] for k in ("xmin", "ymin", "xmax", "ymax")])
        return "Polygon", [[[(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]]]
    if "x" in shape:
        return "Point", [[[tuple(_numbers([shape["x"], shape["y"]]))]]]
    kind, at = shape["type"], shape["coordinates"]
    lift = {
        "Point": lambda: [_runs([[at]])], "MultiPoint": lambda: [[r] for r in _runs([[v] for v in at])],
        "LineString": lambda: [_runs([at])], "MultiLineString": lambda: [[r] for r in _runs(at)],
        "Polygon": lambda: [_runs(at)], "MultiPolygon": lambda: [_runs(part) for part in at],
    }
    return kind, lift[kind]()


def _check_rings(kind: str, parts: list) -> None:
    for ring in (r for part in parts for r in part):
        if kind.endswith("Polygon") and (len(ring) < 4 or ring[0] != ring[-1]) or kind.endswith("LineString") and len(ring) < 2:
            raise ValueError("ring is not closed or line is too short")


def _wkid(reference) -> int | None:
    """Code in a spatial reference of a request: number, text, or object."""
    if isinstance(reference, str):
        try:
            reference = json.loads(reference)
        except ValueError:
            pass
    if isinstance(reference, dict):
        inner = reference.get("spatialReference") or reference
        return parse_integer(inner.get("latestWkid") or inner.get("wkid") or 0) or None
    return parse_integer(reference) or None


def filter_shape(shape: str | dict | list, srid: int, in_sr: str | int | dict | None = None) -> FilterShape:
    """One request shape as literals in the layer's coordinates: `normalize_shapes` for a single value."""
    text = shape if isinstance(shape, str) else json.dumps(shape)
    try:
        try:
            given = json.loads(text)
        except ValueError:
            given = [float(v) for v in text.split(",")]
        kind, parts = _read_shape(given)
        _check_rings(kind, parts)
        if not any(ring for part in parts for ring in part):
            raise ValueError("empty")
    except (ValueError, KeyError, TypeError, IndexError):
        raise ValueError(f"Geometry filter cannot be read: {text[:200]}") from None
    own = given.get("spatialReference") if isinstance(given, dict) else None
    if in_sr in (None, "") and isinstance(own, dict) and "wkt" in own and not (own.get("wkid") or own.get("latestWkid")):
        raise ValueError("A WKT spatial reference is not supported; send a wkid")
    code = (_wkid(in_sr) if in_sr not in (None, "") else None) or (_wkid(own) if own else None)
    found = FilterShape(kind, same_system(srid), parts)
    if code is None:
        x0, y0, x1, y1 = found.bounds
        wide = max(abs(x0), abs(x1)) > 360 or max(abs(y0), abs(y1)) > 90
        code = 3857 if srid == 4326 and wide else srid
    source, target = same_system(code), same_system(srid)
    if source == target:
        return found
    moves = {(3857, 4326): point_to_degrees, (4326, 3857): point_to_mercator}
    if (source, target) not in moves:
        raise ValueError(f"No transform from SRID {source} to {target}")
    move = moves[source, target]
    return FilterShape(kind, target, [[[move(*v) for v in ring] for ring in part] for part in parts])
