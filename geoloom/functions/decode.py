"""Decoders from WKT, WKB, GeoJSON and Esri JSON into the geometry struct.

Every decoder gives NULL for text or bytes it cannot read, so a bad row never
fails a job. WKT and both JSON forms are built from Spark's own string, JSON and
array functions; only WKB, whose doubles Spark SQL cannot read, uses Arrow.
"""

from __future__ import annotations

import struct
import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from geoloom.functions.geometry import GEOMETRY_DDL, GEOMETRY_TYPES, PARTS_DDL, geometry, let, point, vertex

# The Arrow function travels to the executors by value, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMATS = ("WKT", "WKB", "GEOJSON", "ESRIJSON", "GEOMETRY")

_NUMBER = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"
_POINT_TEXT = rf"(?is)^\s*POINT\s*(?:Z|M|ZM)?\s*\(\s*({_NUMBER}\s+{_NUMBER})(?:\s+{_NUMBER}){{0,2}}\s*\)\s*$"
_TYPES_TEXT = "|".join(t.upper() for t in GEOMETRY_TYPES)
_ANY_TEXT = rf"(?is)^\s*(?:SRID=(\d+);)?\s*({_TYPES_TEXT})\s*(?:\s(?:Z|M|ZM))?\s*(EMPTY|\([-+0-9.eE\s(),]+\))\s*$"


def _sound(kind: Column, parts: Column) -> Column:
    """Finite numbers everywhere, closed rings of four vertices or more, lines of two or more."""

    def finite(v: Column) -> Column:
        big = F.lit(float("inf"))
        return (v["x"] > -big) & (v["x"] < big) & (v["y"] > -big) & (v["y"] < big)

    def ring_ok(ring: Column) -> Column:
        closed = F.get(ring, F.lit(0)) == F.try_element_at(ring, F.lit(-1))
        return F.when(kind.endswith("Polygon"), (F.size(ring) >= 4) & closed).when(
            kind.endswith("LineString"), F.size(ring) >= 2
        ).otherwise(F.size(ring) == 1)

    def part_ok(part: Column) -> Column:
        return F.forall(part, lambda ring: F.coalesce(ring_ok(ring), F.lit(False)) & F.forall(
            ring, lambda v: F.coalesce(finite(v), F.lit(False))))

    return F.coalesce(F.forall(parts, lambda p: F.coalesce(part_ok(p), F.lit(False))), F.lit(False))


def _checked(kind: Callable[[Column], Column], srid: Column, parts: Column) -> Column:
    """Geometry of the parts if they are sound; `kind` gives the type, which may depend on the parts."""
    return let(parts, lambda p: let(kind(p), lambda k: F.when(_sound(k, p), geometry(k, srid, p))))


def parse_wkt(text: Column, srid: int | None = 4326) -> Column:
    """WKT (or EWKT, whose own SRID wins) to geometry."""

    def coordinate(piece: Column) -> Column:
        words = F.split(F.trim(piece), r"\s+")
        return let(words, lambda w: F.when(F.size(w).between(2, 4), vertex(
            F.get(w, F.lit(0)).try_cast("double"), F.get(w, F.lit(1)).try_cast("double"))))

    def run(body: Column) -> Column:
        return F.transform(F.split(body, ","), coordinate)

    def rings(body: Column) -> Column:
        return F.transform(F.split(body, r"\),\("), run)

    def parts(kind: Column, body: Column) -> Column:
        def inner(depth: int) -> Column:
            return F.regexp_extract(body, r"(?s)^\({%d}([^(].*[^)])\){%d}$" % (depth, depth), 1)

        single = F.regexp_replace(body, r"(?<=[(,])\(([^(),]+)\)", "$1")
        return (
            F.when(F.upper(body) == "EMPTY", F.array().cast(PARTS_DDL))
            .when(kind.isin("Point", "LineString"), F.array(F.array(run(inner(1)))))
            .when(kind == "Polygon", F.array(rings(inner(2))))
            .when(kind == "MultiPoint", F.transform(
                F.split(F.regexp_extract(single, r"(?s)^\((.+)\)$", 1), ","), lambda s: F.array(F.array(coordinate(s)))))
            .when(kind == "MultiLineString", F.transform(rings(inner(2)), lambda r: F.array(r)))
            .when(kind == "MultiPolygon", F.transform(F.split(inner(3), r"\)\),\(\("), rings))
        )

    names = F.create_map(*[F.lit(v) for t in GEOMETRY_TYPES for v in (t.upper(), t)])
    own = F.regexp_extract(text, _ANY_TEXT, 1)
    head = F.struct(
        F.try_element_at(names, F.upper(F.regexp_extract(text, _ANY_TEXT, 2))).alias("kind"),
        F.when(own != "", own.try_cast("int")).otherwise(F.lit(srid).cast("int")).alias("srid"),
        F.regexp_replace(F.regexp_extract(text, _ANY_TEXT, 3), r"\s*([(),])\s*", "$1").alias("body"),
    )
    general = let(head, lambda h: F.when(h["kind"].isNotNull(), _checked(
        lambda _: h["kind"], h["srid"], parts(h["kind"], h["body"]))))

    def quick(pair: Column) -> Column:
        return let(coordinate(pair), lambda v: F.when(
            F.abs(v["x"]) + F.abs(v["y"]) < F.lit(float("inf")), point(v["x"], v["y"], srid)))

    return F.when(text.isNotNull(), let(F.regexp_extract(text, _POINT_TEXT, 1), lambda pair: F.when(
        pair != "", quick(pair)).otherwise(general)))


def _nested(coordinates: Column, depth: int) -> Column:
    """JSON coordinate text to vertex structs under `depth` array levels."""
    ddl = "double"
    for _ in range(depth + 1):
        ddl = f"array<{ddl}>"

    def build(value: Column, level: int) -> Column:
        if level == 0:
            return F.when(F.size(value) >= 2, vertex(F.get(value, F.lit(0)), F.get(value, F.lit(1))))
        return F.transform(value, lambda item: build(item, level - 1))

    return build(F.from_json(coordinates, ddl), depth)


def _geojson_parts(kind: Column, coordinates: Column) -> Column:
    return (
        F.when(kind == "Point", F.array(F.array(F.array(_nested(coordinates, 0)))))
        .when(kind == "MultiPoint", F.transform(_nested(coordinates, 1), lambda v: F.array(F.array(v))))
        .when(kind == "LineString", F.array(F.array(_nested(coordinates, 1))))
        .when(kind == "MultiLineString", F.transform(_nested(coordinates, 2), lambda r: F.array(r)))
        .when(kind == "Polygon", F.array(_nested(coordinates, 2)))
        .when(kind == "MultiPolygon", _nested(coordinates, 3))
    )


def parse_geojson(text: Column, srid: int | None = 4326) -> Column:
    """GeoJSON geometry text to geometry. Stored GeoJSON is SRID 4326 by definition."""
    return let(
        F.from_json(text, "type string, coordinates string"),
        lambda g: F.when(g["type"].isin(*GEOMETRY_TYPES), _checked(
            lambda _: g["type"], F.lit(srid), _geojson_parts(g["type"], g["coordinates"]))),
    )


def signed_area(ring: Column) -> Column:
    """Twice the shoelace area: negative for clockwise rings."""
    n = F.greatest(F.size(ring) - 1, F.lit(0))
    terms = F.zip_with(F.slice(ring, F.lit(1), n), F.slice(ring, F.lit(2), n),
                       lambda p, q: p["x"] * q["y"] - q["x"] * p["y"])
    return F.aggregate(terms, F.lit(0.0), lambda total, term: total + term)


def group_rings(rings: Column) -> Column:
    """Flat ring list to polygon parts: a clockwise ring opens a polygon, others are its holes."""

    def step(done: Column, ring: Column) -> Column:
        opens = (signed_area(ring) < 0) | (F.size(done) == 0)
        last = F.try_element_at(done, F.lit(-1))
        before = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(opens, F.concat(done, F.array(F.array(ring)))).otherwise(
            F.concat(before, F.array(F.concat(last, F.array(ring)))))

    return F.aggregate(rings, F.array().cast(PARTS_DDL), step)


ESRI_DDL = (
    "type string, coordinates string, x double, y double, rings string, paths string, "
    "xmin double, ymin double, xmax double, ymax double, "
    "spatialReference struct<wkid:string,latestWkid:string,wkt:string>"
)


def json_shape(g: Column, srid: Column, forms: tuple[str, ...]) -> Column:
    """Geometry from parsed shape JSON; the first of `forms` that the object carries decides."""
    carried = {
        "geojson": g["type"].isNotNull() & g["coordinates"].isNotNull(),
        "envelope": g["xmin"].isNotNull(),
        "point": g["x"].isNotNull() & g["y"].isNotNull(),
        "rings": g["rings"].isNotNull(),
        "paths": g["paths"].isNotNull(),
    }
    sides = [("xmin", "ymin"), ("xmax", "ymin"), ("xmax", "ymax"), ("xmin", "ymax"), ("xmin", "ymin")]
    read = {
        "geojson": lambda: F.when(g["type"].isin(*GEOMETRY_TYPES), _geojson_parts(g["type"], g["coordinates"])),
        "envelope": lambda: F.array(F.array(F.array(*[vertex(g[a], g[b]) for a, b in sides]))),
        "point": lambda: F.array(F.array(F.array(vertex(g["x"], g["y"])))),
        "rings": lambda: group_rings(_nested(g["rings"], 2)),
        "paths": lambda: F.transform(_nested(g["paths"], 2), lambda r: F.array(r)),
    }

    def several(p: Column, name: str) -> Column:
        return F.when(F.size(p) == 1, name).otherwise("Multi" + name)

    def kind(p: Column) -> Column:
        names = {"geojson": g["type"], "envelope": F.lit("Polygon"), "point": F.lit("Point"),
                 "rings": several(p, "Polygon"), "paths": several(p, "LineString")}
        return _first([(carried[f], names[f]) for f in forms])

    return _checked(kind, srid, _first([(carried[f], read[f]()) for f in forms]))


def _first(cases: list[tuple[Column, Column]]) -> Column:
    chain = F.when(*cases[0])
    for test, value in cases[1:]:
        chain = chain.when(test, value)
    return chain


def parse_esri_json(text: Column, srid: int | None = 4326) -> Column:
    """Esri JSON ({x,y}, rings, paths) or GeoJSON to geometry."""
    return let(F.from_json(text, ESRI_DDL), lambda g: json_shape(
        g, F.lit(srid).cast("int"), ("geojson", "point", "rings", "paths")))


# -- WKB ---------------------------------------------------------------------------------------------------------------

# WKB type codes, in code order from 1.
_WKB_TYPES = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon"}


class _Wkb:
    """Cursor over one WKB value; any malformed read raises and the row becomes NULL. It notes where coordinates and SRIDs lie."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0
        self.runs: list[tuple[int, str, int, int]] = []
        self.srids: list[tuple[int, str]] = []

    def header(self) -> tuple[str, int, int | None, str]:
        order = {0: ">", 1: "<"}[self.data[self.at]]
        (code,) = struct.unpack_from(order + "I", self.data, self.at + 1)
        self.at += 5
        base, srid = code & 0x0FFFFFFF, None
        if code & 0x20000000:
            (srid,) = struct.unpack_from(order + "i", self.data, self.at)
            self.srids.append((self.at, order))
            self.at += 4
        extra = (0, 1, 1, 2)[base // 1000] if base < 4000 else 9
        width = 2 + extra + bool(code & 0x80000000) + bool(code & 0x40000000)
        return _WKB_TYPES[base % 1000], width, srid, order

    def count(self, order: str) -> int:
        (n,) = struct.unpack_from(order + "I", self.data, self.at)
        self.at += 4
        return n

    def run(self, order: str, width: int, n: int) -> np.ndarray:
        block = np.frombuffer(self.data, order + "f8", n * width, self.at).reshape(n, width)[:, :2].astype("f8")
        self.runs.append((self.at, order, width, n))
        self.at += n * width * 8
        if not np.isfinite(block).all():
            raise ValueError("coordinate is not finite")
        return block

    def read(self) -> tuple[str, int | None, list[list[np.ndarray]]]:
        kind, width, srid, order = self.header()
        if kind == "Point":
            return kind, srid, [[self.run(order, width, 1)]]
        n = self.count(order)
        if kind == "LineString":
            rings = [self.run(order, width, n)]
            if n < 2:
                raise ValueError("line is too short")
            return kind, srid, [rings]
        if kind == "Polygon":
            rings = [self.run(order, width, self.count(order)) for _ in range(n)]
            if any(len(r) < 4 or (r[0] != r[-1]).any() for r in rings):
                raise ValueError("ring is not closed")
            return kind, srid, [rings] if rings else []
        members = [self.read() for _ in range(n)]
        if any("Multi" + m[0] != kind for m in members):
            raise ValueError("member type does not fit the collection")
        return kind, srid, [part for m in members for part in m[2]]


def _read_wkb(value: bytes) -> tuple[_Wkb, tuple] | None:
    try:
        cursor = _Wkb(value)
        shape = cursor.read()
        return (cursor, shape) if cursor.at == len(value) else None
    except (ValueError, KeyError, IndexError, struct.error):
        return None


def _shapes(kinds: pa.Array, srids: pa.Array, xy: np.ndarray, sizes: tuple[np.ndarray, np.ndarray, np.ndarray], missing: np.ndarray) -> pa.Array:
    """Geometries from vertices in a row and the sizes of runs, parts and rows."""
    nested = pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], names=["x", "y"])
    for lengths in sizes:
        nested = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype("i4")), nested)
    return pa.StructArray.from_arrays([kinds, srids, nested], names=["type", "srid", "parts"], mask=pa.array(missing, pa.bool_()))


def _decode_alike(block: np.ndarray, default: int | None) -> tuple[np.ndarray, pa.Array | None]:
    """Values of one length that have the layout of the first of them: which they are, and their geometries by one array view.

    The layout is every byte that is neither a coordinate nor an SRID: byte orders, types and counts. Without geometries
    only the first is told, and it cannot be read.
    """
    first = _read_wkb(block[0].tobytes())
    if first is None:
        return np.arange(len(block)) == 0, None
    cursor, (kind, srid, parts) = first
    layout = np.ones(block.shape[1], bool)
    for at, _, width, n in cursor.runs:
        layout[at:at + n * width * 8] = False
    for at, _ in cursor.srids:
        layout[at:at + 4] = False
    alike = (block[:, layout] == block[0, layout]).all(axis=1)
    same = np.ascontiguousarray(block[alike])
    bad, runs = np.zeros(len(same), bool), []
    for at, order, width, n in cursor.runs:
        xy = np.ascontiguousarray(same[:, at:at + n * width * 8]).view(order + "f8").reshape(len(same), n, width)[:, :, :2].astype("f8")
        bad |= ~np.isfinite(xy).all(axis=(1, 2))
        if kind.endswith("Polygon"):
            bad |= (xy[:, 0] != xy[:, -1]).any(axis=1)
        runs.append(xy)
    every = np.concatenate(runs, axis=1) if runs else np.empty((len(same), 0, 2))
    every[bad] = 0.0
    if srid is None:
        srids = pa.array([default] * len(same), pa.int32())
    else:
        at, order = cursor.srids[0]
        srids = pa.array(np.ascontiguousarray(same[:, at:at + 4]).view(order + "i4")[:, 0].astype("i4"))
    sizes = ([len(ring) for part in parts for ring in part], [len(part) for part in parts], [len(parts)])
    return alike, _shapes(pa.array([kind] * len(same), pa.string()), srids, every.reshape(-1, 2),
                          tuple(np.tile(np.array(n, "i8"), len(same)) for n in sizes), bad)


def _decode_apart(values: list[bytes], default: int | None) -> pa.Array:
    """Geometries of values that share no layout, one by one."""
    read = [_read_wkb(v) for v in values]
    shapes = [r[1] if r else (None, None, []) for r in read]
    rings = [part for s in shapes for part in s[2]]
    runs = [ring for part in rings for ring in part]
    return _shapes(
        pa.array([s[0] for s in shapes], pa.string()), pa.array([default if s[1] is None else s[1] for s in shapes], pa.int32()),
        np.concatenate(runs) if runs else np.empty((0, 2)), ([len(r) for r in runs], [len(p) for p in rings], [len(s[2]) for s in shapes]),
        np.array([r is None for r in read], bool))


# Longer values are read one by one, which costs little beside their own bytes; so are those beyond some layouts of one length.
_LONGEST_ALIKE, _LAYOUTS = 4096, 4


def _decode_wkb(values: pa.Array, default: int | None) -> pa.Array:
    """Values of one batch: those of the same byte order, type and length together, as far as their layouts agree."""
    values = values.cast(pa.large_binary())
    present = np.flatnonzero(np.asarray(values.is_valid()))
    lengths = np.asarray(pc.fill_null(pc.binary_length(values), 0)).astype("i8")
    found, at, apart = [], [], [present[(lengths[present] < 5) | (lengths[present] > _LONGEST_ALIKE)]]
    short = present[(lengths[present] >= 5) & (lengths[present] <= _LONGEST_ALIKE)]
    if len(short):
        data = np.frombuffer(values.buffers()[2], "u1")
        starts = np.frombuffer(values.buffers()[1], "i8")[values.offset:values.offset + len(values)]
        heads = np.lib.stride_tricks.sliding_window_view(data, 5)[starts[short]].astype("i8")
        keys = (heads << np.array([0, 8, 16, 24, 32])).sum(axis=1) + (lengths[short] << 40)
        order = np.argsort(keys, kind="stable")
        cuts = np.flatnonzero(np.diff(keys[order])) + 1
        for group in np.split(short[order], cuts):
            for _ in range(_LAYOUTS):
                if len(group) < 2:
                    break
                block = np.lib.stride_tricks.sliding_window_view(data, int(lengths[group[0]]))[starts[group]]
                alike, shapes = _decode_alike(block, default)
                if shapes is not None:
                    found.append(shapes)
                    at.append(group[alike])
                group = group[~alike]
            apart.append(group)
    rest = np.concatenate(apart)
    found.append(_decode_apart(values.take(pa.array(rest)).to_pylist(), default))
    at.append(rest)
    # A row without a place has no geometry.
    places = np.full(len(values), -1, "i8")
    places[np.concatenate(at)] = np.arange(sum(len(rows) for rows in at))
    return pa.concat_arrays(found).take(pa.array(places, mask=places < 0))


def parse_wkb(data: Column, srid: int | None = 4326) -> Column:
    """WKB (or EWKB, whose own SRID wins) to geometry, one Arrow batch at a time; values that are laid out alike are read together."""
    default = srid

    @F.arrow_udf(GEOMETRY_DDL)
    def decode(values: pa.Array) -> pa.Array:
        return _decode_wkb(values, default)

    return decode(data)


def decode(column: Column, fmt: str, srid: int | None = 4326) -> Column:
    """Decode one stored form. GeoJSON ignores the layer SRID: it is 4326."""
    fmt = fmt.upper()
    if fmt == "WKT":
        return parse_wkt(column, srid)
    if fmt == "WKB":
        return parse_wkb(column, srid)
    if fmt == "GEOJSON":
        return parse_geojson(column)
    if fmt == "ESRIJSON":
        return parse_esri_json(column, srid)
    if fmt == "GEOMETRY":
        return column
    raise ValueError(f"Unknown geometry format {fmt!r}; expected one of {', '.join(FORMATS)}")
