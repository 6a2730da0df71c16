"""Spatial joins by square cells.

Each geometry is listed under the squares its box reaches. Squares come in sizes
sixteen times apart; a geometry uses the size that fits it, so it reaches at most
17 x 17 of them, and a match is an equi-join on the square followed by the box
and the exact test.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, BinaryType, BooleanType, DatetimeType, NumericType, StringType, VariantType

from geoloom.functions.cells import square_cells
from geoloom.functions.geometry import BBOX, vertices
from geoloom.functions.predicates import edge_list, matches_column, place_among, relation_name
from geoloom.operators.quadtree import SQUARE_ROWS, Quadtree, dealt
from geoloom.runtime import BROADCAST_BYTES, broadcast_if_small, checkpoint, fits

_STEP = 4
_LOWEST, _HIGHEST = -24, 40
_HOT_PARTS = 1000
_LONG = 500
_SQUARE = ["_level", "_cx", "_cy"]
_LEFT = tuple(f"_l{c}" for c in BBOX)
_RIGHT = tuple(f"_r{c}" for c in BBOX)


def _box(names: tuple[str, ...]) -> list[Column]:
    return [F.col(n) for n in names]


def _own_level(names: tuple[str, ...], geom: str) -> Column:
    """Size of square for a geometry; long outlines take the next one, to be copied to four squares at most."""
    x0, y0, x1, y1 = _box(names)
    size = F.greatest(x1 - x0, y1 - y0, F.lit(2.0 ** _LOWEST))
    finer = F.when(F.size(vertices(F.col(geom))) > _LONG, 0).otherwise(_STEP)
    level = F.ceil(F.log2(size) / _STEP) * _STEP - finer
    return F.greatest(F.least(level, F.lit(_HIGHEST)), F.lit(_LOWEST)).cast("int")


def _levels(df: DataFrame, names: tuple[str, ...], geom: str) -> list[int]:
    """Levels in use: at most one per step, 17 in all."""
    return sorted(r.level for r in df.select(_own_level(names, geom).alias("level")).distinct().collect())


def _prepare(left: DataFrame, right: DataFrame, right_geom: str) -> tuple[DataFrame, DataFrame, str, list[str]]:
    """Both sides with box columns of their own names; clashing right columns get the prefix `right_`."""
    taken = {c.lower() for c in left.columns}
    renamed = {c: f"right_{c}" if c.lower() in taken else c for c in right.columns if c not in BBOX}
    l = left.filter(F.col(BBOX[0]).isNotNull()).withColumnsRenamed(dict(zip(BBOX, _LEFT)))
    r = right.filter(F.col(BBOX[0]).isNotNull()).withColumnsRenamed({**dict(zip(BBOX, _RIGHT)), **renamed})
    keep = [*[c for c in left.columns if c not in BBOX], *renamed.values()]
    return l, r, renamed[right_geom], keep


def _listed(df: DataFrame, squares: Column) -> DataFrame:
    return df.withColumn("_square", F.explode(squares)).select("*", "_square.*").drop("_square")


def _row_bytes(geom: str, squares: Column) -> Column:
    """What the copies of one row weigh."""
    return F.size(squares) * (F.size(vertices(F.col(geom))) * 48 + 300)


def _pairs(left: DataFrame, right: DataFrame, small: bool, spread_by: list[str] | None) -> DataFrame:
    """Equi-join on the square.

    A right side of small measured size is broadcast and the left one is not
    shuffled. Otherwise squares that hold more than a thousandth of the rows of
    either side (so at most a thousand of each) are split over several tasks and
    the other side's rows of those squares are copied to each. Left rows are spread
    by a hash of `spread_by`, by default of all columns with plain values.
    """
    if small:
        return left.join(F.broadcast(right), _SQUARE)

    def hot(df: DataFrame, name: str) -> DataFrame:
        sizes = checkpoint(df.groupBy(*_SQUARE).agg(F.count(F.lit(1)).alias("_n")))
        share = (sizes.agg(F.sum("_n").alias("n")).first().n or 0) / _HOT_PARTS
        return sizes.filter(F.col("_n") > share).select(*_SQUARE, F.ceil(F.col("_n") / share).cast("int").alias(name))

    full = hot(left, "_salt_parts").join(hot(right, "_salt_right_parts"), _SQUARE, "full")

    def side(df: DataFrame, own: str, other: str, spread: list[str]) -> DataFrame:
        n, copies = F.coalesce(F.col(f"{own}_parts"), F.lit(1)), F.coalesce(F.col(f"{other}_parts"), F.lit(1))
        mine = F.pmod(F.xxhash64(*spread), n).cast("int")
        return df.join(F.broadcast(full), _SQUARE, "left").withColumns({own: mine, other: F.explode(F.sequence(F.lit(0), copies - 1))}).drop("_salt_parts", "_salt_right_parts")

    return side(left, "_salt", "_salt_right", spread_by or _plain_columns(left)).join(side(right, "_salt_right", "_salt", _plain_columns(right)), [*_SQUARE, "_salt", "_salt_right"]).drop("_salt", "_salt_right")


def _boxes_meet() -> Column:
    lx0, ly0, lx1, ly1 = _box(_LEFT)
    rx0, ry0, rx1, ry1 = _box(_RIGHT)
    return (lx0 <= rx1) & (lx1 >= rx0) & (ly0 <= ry1) & (ly1 >= ry0)


def _plain_columns(df: DataFrame) -> list[str]:
    """Columns whose values can be hashed."""
    return [f.name for f in df.schema if isinstance(f.dataType, AtomicType) and not isinstance(f.dataType, VariantType)]


def _attribute_bytes(df: DataFrame, geom: str) -> Column:
    """What the attributes of a row weigh, texts and nested values by their length."""
    long = [f for f in df.schema if f.name != geom and not f.name.startswith("_") and not isinstance(f.dataType, (NumericType, BooleanType, DatetimeType))]
    texts = [F.octet_length(F.col(f.name)) if isinstance(f.dataType, (StringType, BinaryType)) else F.length(F.to_json(F.struct(f.name))) for f in long]
    return sum((F.coalesce(t, F.lit(0)) for t in texts), F.lit(16 * len(df.columns)))


def points_in_polygons(points: DataFrame, zones: DataFrame, spatial_rel: str = "within", zone_geom: str = "geom",
                       broadcast_bytes: int = BROADCAST_BYTES, spread_by: list[str] | None = None, square_rows: int = SQUARE_ROWS) -> DataFrame:
    """All (point, zone) pairs with the point within, touching or intersecting the zone.

    A point lies in one square per level, so each pair meets exactly once. The
    test runs in the JVM; zone columns that clash get the prefix `right_`. Left
    rows that are no points (told by a column `geom`) and zones that are no
    polygons are joined by `spatial_join` instead.

    Zones whose measured bytes fit, attributes included, are broadcast. Otherwise
    points and zones meet in the leaves of a quadtree that is refined until a
    square holds at most `square_rows` of either side, as far as places differ; the
    zones' side of that exchange has only boxes, and outlines and attributes are
    fetched once per pair of box and point, by the row's number.
    """
    name = relation_name(spatial_rel)
    polygon = F.col(zone_geom)["type"].endswith("Polygon")
    odd_zones = zones.filter(~polygon)
    parts = []
    # One pass over the zones tells all that the plan depends on.
    l, r, geom, keep = _prepare(points, zones, zone_geom)
    own, flat = _own_level(_RIGHT, geom), F.col(geom)["type"].endswith("Polygon")
    weight = _row_bytes(geom, square_cells(*_box(_RIGHT), own)) + _attribute_bytes(r, geom) * F.size(square_cells(*_box(_RIGHT), own))
    about = r.agg(
        F.count_if(~flat).alias("odd"), F.sum(F.when(flat, weight.cast("double"))).alias("bytes"), F.collect_set(F.when(flat, own)).alias("levels"),
        *(pick(F.when(flat, F.col(c))).alias(c) for pick, c in zip((F.min, F.min, F.max, F.max), _RIGHT))).first()
    if "geom" in points.columns:
        if not points.filter(F.col("geom")["type"] != "Point").isEmpty():
            parts.append(spatial_join(points.filter(F.col("geom")["type"] != "Point"), zones, spatial_rel, "geom", zone_geom, broadcast_bytes=broadcast_bytes, spread_by=spread_by))
            l = l.filter(F.col("geom")["type"] == "Point")
            points = points.filter(F.col("geom")["type"] == "Point")
        if about.odd:
            parts.append(spatial_join(points, odd_zones, spatial_rel, "geom", zone_geom, broadcast_bytes=broadcast_bytes, spread_by=spread_by))
    elif about.odd:
        raise ValueError("Zones that are no polygons need the points in a column geom")
    wanted = {"intersects": (1, 2), "within": (2,), "touches": (1,)}
    if name not in wanted:
        raise ValueError(f"A point cannot stand in relation {name} to a polygon")
    r = r.filter(flat).withColumn("_edges", edge_list(F.col(geom)))
    x, y = F.col(_LEFT[0]), F.col(_LEFT[1])
    if not about.levels:
        pairs = l.select("*", *(F.lit(None).cast(r.schema[c].dataType).alias(c) for c in r.columns if c in keep)).limit(0)
        return reduce(DataFrame.unionByName, parts, pairs.select(*keep))
    if about.bytes <= broadcast_bytes:
        here = [F.struct(F.lit(v).alias("_level"), F.floor(x / 2.0 ** v).alias("_cx"), F.floor(y / 2.0 ** v).alias("_cy")) for v in sorted(about.levels)]
        pairs = _listed(l, F.array(*here)).join(F.broadcast(_listed(r, square_cells(*_box(_RIGHT), own))), _SQUARE).filter(_boxes_meet())
    else:
        pairs = _quadtree_pairs(l, r, geom, tuple(about[c] for c in _RIGHT), broadcast_bytes, spread_by or _plain_columns(l), square_rows)
    pairs = pairs.filter(place_among(F.col("_edges"), x, y).isin(*wanted[name])).select(*keep)
    return reduce(DataFrame.unionByName, parts, pairs)


def _quadtree_pairs(l: DataFrame, r: DataFrame, geom: str, extent: tuple[float, float, float, float], broadcast_bytes: int, spread_by: list[str], square_rows: int) -> DataFrame:
    """Points with the zones whose box holds them, by the leaves of a quadtree; `extent` is the box around the zones."""
    x, y = F.col(_LEFT[0]), F.col(_LEFT[1])
    # Numbered after it is fixed, so that a number means the same row in every stage.
    zones = checkpoint(r).withColumn("_zone", F.monotonically_increasing_id())
    boxes = zones.select("_zone", *_RIGHT)
    near = l.filter(x.between(extent[0], extent[2]) & y.between(extent[1], extent[3]))
    tree = Quadtree(extent, near, (x, y), boxes, _box(_RIGHT), square_rows)
    left, right, keys = dealt(tree, tree.of_points(near, x, y), tree.of_boxes(boxes, _box(_RIGHT)), spread_by, ["_zone"], square_rows)
    met = left.join(right, keys).filter(_boxes_meet()).drop(*keys, *_RIGHT)
    return met.join(zones.drop(*_RIGHT), "_zone") if broadcast_bytes <= 0 else met.join(broadcast_if_small(zones.drop(*_RIGHT), F.size("_edges") * 32 + _attribute_bytes(r, geom)), "_zone")


def spatial_join(left: DataFrame, right: DataFrame, spatial_rel: str = "intersects", left_geom: str = "geom",
                 right_geom: str = "geom", strict: bool = False, broadcast_bytes: int = BROADCAST_BYTES,
                 spread_by: list[str] | None = None) -> DataFrame:
    """All pairs of geometries of any type in the relation, each once.

    Besides its own squares a geometry is listed under those of every coarser
    size in use. A pair meets at the coarser of its two sizes, in the one square
    with the lower left corner of what both boxes share.
    """
    l, r, geom, keep = _prepare(left, right, right_geom)
    sizes = F.array(*[F.lit(v) for v in sorted({*_levels(l, _LEFT, left_geom), *_levels(r, _RIGHT, geom)})]).cast("array<int>")

    def squares(names: tuple[str, ...], own: str) -> Column:
        return F.flatten(F.transform(F.filter(sizes, lambda v: v >= F.col(own)), lambda v: square_cells(*_box(names), v)))

    l, r = l.withColumn("_left_own", _own_level(_LEFT, left_geom)), r.withColumn("_right_own", _own_level(_RIGHT, geom))
    left_squares, right_squares = squares(_LEFT, "_left_own"), squares(_RIGHT, "_right_own")
    small = fits(r, _row_bytes(geom, right_squares), broadcast_bytes)
    pairs = _pairs(_listed(l, left_squares), _listed(r, right_squares), small, spread_by)
    side = F.pow(F.lit(2.0), F.col("_level"))
    here = (
        (F.col("_level") == F.greatest("_left_own", "_right_own"))
        & (F.col("_cx") == F.floor(F.greatest(F.col(_LEFT[0]), F.col(_RIGHT[0])) / side))
        & (F.col("_cy") == F.floor(F.greatest(F.col(_LEFT[1]), F.col(_RIGHT[1])) / side))
    )
    near = pairs.filter(_boxes_meet() & here)
    return near.filter(matches_column(F.col(left_geom), F.col(geom), spatial_rel, strict)).select(*keep)
