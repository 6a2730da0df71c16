"""Reading and writing geometry, predicates, coordinates and spatial joins."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom import (
    Layer, export_features, ingest_geometry, normalize_shapes, points_in_polygons, profile_geometry, reproject, spatial_join,
    unwrap_dateline, with_point, wrap_longitudes, write_clustered,
)
from geoloom.functions.geometry import as_geojson, as_wkt, box, dimension, envelope, line, type_name, vertices, with_bounds
from geoloom.operators.filters import distance_filter, spatial_filter
from geoloom.runtime import scratch_path
from geoloom.sources.ingest import scan_table, with_geometry
from workload.registry import case
from workload.tables import (
    HALF_HEIGHT, HALF_WIDTH, WITH, box_values, boxes, mixed_text, position_layer, positions, read, segments, zones,
)

WINDOW = "-60,-30,60,30"


def first(axis: str) -> Column:
    """Coordinate of the first vertex."""
    return F.element_at(vertices(F.col("geom")), 1)[axis]


def xy() -> list[Column]:
    return [first("x").alias("x"), first("y").alias("y")]


def _shape_row(df: DataFrame) -> DataFrame:
    """What a decoded geometry holds, as plain numbers."""
    g = F.col("geom")
    return df.select("oid", g["type"].alias("kind"), g["srid"].alias("srid"), F.size(vertices(g)).alias("n_vertices"),
                     *[F.col(c).alias(c[1:]) for c in ("_xmin", "_ymin", "_xmax", "_ymax")])


@case("a1_table_scan", "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def table_scan(spark, sf_dir):
    read(spark, sf_dir, "orders").createOrReplaceTempView("geoloom_orders")
    return scan_table(spark, "geoloom_orders").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@case("a2_ingest_wkt_points", WITH + "SELECT oid, CAST(4326 AS INT) AS srid, lon AS x, lat AS y FROM positions")
def ingest_wkt_points(spark, sf_dir):
    text = F.format_string("POINT(%s %s)", F.col("lon").cast("string"), F.col("lat").cast("string"))
    good, _ = ingest_geometry(positions(spark, sf_dir).withColumn("shape_wkt", text), "shape_wkt")
    return good.select("oid", F.col("geom.srid").alias("srid"), *xy())


SHAPE_SQL = (WITH + "SELECT oid, '{kind}' AS kind, CAST({srid} AS INT) AS srid, CAST({n} AS INT) AS n_vertices, "
             "x0 AS xmin, y0 AS ymin, x1 AS xmax, y1 AS ymax FROM boxes")


def _ring(order: tuple[str, ...], pattern: str) -> Column:
    pairs = [p.split() for p in order]
    return F.concat_ws(",", *[F.format_string(pattern, F.col(x).cast("string"), F.col(y).cast("string")) for x, y in pairs])


COUNTER_CLOCKWISE = ("x0 y0", "x1 y0", "x1 y1", "x0 y1", "x0 y0")
CLOCKWISE = ("x0 y0", "x0 y1", "x1 y1", "x1 y0", "x0 y0")


@case("a2_ingest_wkt_polygons", SHAPE_SQL.format(kind="Polygon", srid=3857, n=5))
def ingest_wkt_polygons(spark, sf_dir):
    text = F.concat(F.lit("polygon (("), _ring(COUNTER_CLOCKWISE, "%s %s"), F.lit(") )"))
    return _shape_row(with_geometry(box_values(spark, sf_dir).withColumn("outline", text), "outline", "WKT", srid=3857))


def _fixed_bytes(rows: np.ndarray) -> pa.Array:
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(rows.itemsize), len(rows), [None, pa.py_buffer(rows.tobytes())]).cast(pa.binary())


def polygon_wkb(*sides: str) -> Column:
    """Stored test data: rectangles as WKB."""

    def pack(x0: pa.Array, y0: pa.Array, x1: pa.Array, y1: pa.Array) -> pa.Array:
        rows = np.zeros(len(x0), [("order", "u1"), ("type", "<u4"), ("rings", "<u4"), ("n", "<u4"), ("xy", "<f8", (10,))])
        rows["order"], rows["type"], rows["rings"], rows["n"] = 1, 3, 1, 5
        rows["xy"] = np.stack([np.asarray(a) for a in (x0, y0, x1, y0, x1, y1, x0, y1, x0, y0)], axis=1)
        return _fixed_bytes(rows)

    return F.arrow_udf(pack, "binary")(*sides)


def point_wkb(x: str, y: str, srid: int | None = None, order: str = "<") -> Column:
    """Stored test data: points as WKB, or as EWKB with an SRID."""

    def pack(xs: pa.Array, ys: pa.Array) -> pa.Array:
        own = [("srid", order + "i4")] if srid else []
        rows = np.zeros(len(xs), [("order", "u1"), ("type", order + "u4"), *own, ("xy", order + "f8", (2,))])
        rows["order"], rows["type"] = int(order == "<"), 0x20000001 if srid else 1
        if srid:
            rows["srid"] = srid
        rows["xy"] = np.stack([np.asarray(xs), np.asarray(ys)], axis=1)
        return _fixed_bytes(rows)

    return F.arrow_udf(pack, "binary")(x, y)


@case("a3_ingest_wkb", SHAPE_SQL.format(kind="Polygon", srid=4326, n=5))
def ingest_wkb(spark, sf_dir):
    stored = box_values(spark, sf_dir).withColumn("shape", polygon_wkb("x0", "y0", "x1", "y1"))
    good, _ = ingest_geometry(stored, "shape")
    return _shape_row(good)


@case("a3_ingest_wkb_points", WITH + "SELECT oid, CAST(CASE oid % 3 WHEN 2 THEN 3857 ELSE 4326 END AS INT) AS srid, lon AS x, lat AS y FROM positions")
def ingest_wkb_points(spark, sf_dir):
    """Both byte orders, and EWKB whose own SRID wins, mixed in one column."""
    kinds = F.when(F.col("oid") % 3 == 0, point_wkb("lon", "lat")).when(F.col("oid") % 3 == 1, point_wkb("lon", "lat", order=">"))
    stored = positions(spark, sf_dir).withColumn("shape", kinds.otherwise(point_wkb("lon", "lat", 3857)))
    good, _ = ingest_geometry(stored, "shape")
    return good.select("oid", F.col("geom.srid").alias("srid"), *xy())


@case("a4_ingest_geojson", SHAPE_SQL.format(kind="Polygon", srid=4326, n=5))
def ingest_geojson(spark, sf_dir):
    text = F.concat(F.lit('{"type":"Polygon","coordinates":[['), _ring(COUNTER_CLOCKWISE, "[%s,%s]"), F.lit("]]}"))
    return _shape_row(with_geometry(box_values(spark, sf_dir).withColumn("geojson", text), "geojson", srid=3857))


NATIVE_SRID = "CASE oid % 3 WHEN 0 THEN 4326 WHEN 1 THEN 3857 ELSE 0 END"


def native_boxes(spark, sf_dir) -> DataFrame:
    """Rectangles as Spark's own geometry type, with two spatial references and without one."""
    spark.conf.set("spark.sql.geospatial.enabled", "true")
    stored = box_values(spark, sf_dir).withColumn("raw", polygon_wkb("x0", "y0", "x1", "y1"))
    return stored.withColumn("shape", F.expr(f"st_setsrid(st_geomfromwkb(raw), {NATIVE_SRID})")).drop("raw")


@case("a5_ingest_native", SHAPE_SQL.format(kind="Polygon", srid=NATIVE_SRID, n=5))
def ingest_native(spark, sf_dir):
    return _shape_row(with_geometry(native_boxes(spark, sf_dir), "shape"))


@case("a6_profile_native", WITH + f"""
SELECT 'GEOMETRY' AS format, 'Polygon' AS type, CAST({NATIVE_SRID} AS INT) AS srid, CASE WHEN {NATIVE_SRID} = 0 THEN 'no srid' ELSE 'ok' END AS state, count(*) AS n_rows
FROM boxes GROUP BY ALL
""")
def native_profile(spark, sf_dir):
    return profile_geometry(native_boxes(spark, sf_dir), "shape")


@case("a5_ingest_struct", SHAPE_SQL.format(kind="Polygon", srid=4326, n=5))
def ingest_struct(spark, sf_dir):
    """A column that holds the decoded form already."""
    stored = boxes(spark, sf_dir).withColumnRenamed("geom", "shape")
    return _shape_row(with_geometry(stored, "shape"))


@case("a6_geometry_profile", """
SELECT 'WKT' AS format, CASE event_type WHEN 'view' THEN 'Point' WHEN 'click' THEN 'MultiPoint' WHEN 'purchase' THEN 'LineString' END AS type,
       CASE WHEN event_type IN ('view', 'click', 'purchase') THEN CAST(4326 AS INT) END AS srid,
       CASE event_type WHEN 'signup' THEN 'unreadable' WHEN 'error' THEN 'missing' ELSE 'ok' END AS state, count(*) AS n_rows
FROM events GROUP BY ALL
""")
def geometry_profile(spark, sf_dir):
    return profile_geometry(mixed_text(spark, sf_dir), "shape_text")


@case("a7_points_from_lonlat", WITH + "SELECT oid, lon AS x, lat AS y FROM positions WHERE event_type <> 'error'")
def points_from_lonlat(spark, sf_dir):
    gaps = positions(spark, sf_dir).withColumn("lat", F.when(F.col("event_type") != "error", F.col("lat")))
    return with_point(gaps, "lon", "lat").select("oid", *xy())


@case("a8_ingest_esri_json", WITH + """
SELECT oid, CASE segment WHEN 'BUILDING' THEN 'MultiPolygon' WHEN 'MACHINERY' THEN 'LineString' WHEN 'FURNITURE' THEN 'MultiLineString'
                         WHEN 'HOUSEHOLD' THEN 'Point' ELSE 'Polygon' END AS kind,
       CAST(CASE segment WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 2 ELSE 1 END AS INT) AS n_parts,
       CAST(CASE segment WHEN 'BUILDING' THEN 3 WHEN 'AUTOMOBILE' THEN 2 WHEN 'FURNITURE' THEN 2 ELSE 1 END AS INT) AS n_rings,
       x0 AS xmin, y0 AS ymin,
       CASE segment WHEN 'HOUSEHOLD' THEN x0 WHEN 'BUILDING' THEN x1 + 100 WHEN 'FURNITURE' THEN x1 + 100 ELSE x1 END AS xmax,
       CASE segment WHEN 'HOUSEHOLD' THEN y0 ELSE y1 END AS ymax
FROM boxes
""")
def ingest_esri_json(spark, sf_dir):
    """Shell, hole and second shell by winding; single and several paths; points."""
    df = box_values(spark, sf_dir).withColumns({
        "hx0": F.col("x0") + 1, "hy0": F.col("y0") + 1, "hx1": F.col("x1") - 1, "hy1": F.col("y1") - 1,
        "sx0": F.col("x0") + 100, "sx1": F.col("x1") + 100})
    shell = F.concat(F.lit("["), _ring(CLOCKWISE, "[%s,%s]"), F.lit("]"))
    hole = F.concat(F.lit("["), _ring(tuple(f"h{p.replace(' ', ' h')}" for p in COUNTER_CLOCKWISE), "[%s,%s]"), F.lit("]"))
    second = F.concat(F.lit("["), _ring(tuple(f"s{p}" for p in CLOCKWISE), "[%s,%s]"), F.lit("]"))
    kind = F.col("segment")
    text = (
        F.when(kind == "BUILDING", F.concat(F.lit('{"rings":['), shell, F.lit(","), hole, F.lit(","), second, F.lit("]}")))
        .when(kind == "AUTOMOBILE", F.concat(F.lit('{"rings":['), shell, F.lit(","), hole, F.lit("]}")))
        .when(kind == "MACHINERY", F.concat(F.lit('{"paths":['), shell, F.lit("]}")))
        .when(kind == "FURNITURE", F.concat(F.lit('{"paths":['), shell, F.lit(","), second, F.lit("]}")))
        .otherwise(F.format_string('{"x":%s,"y":%s}', F.col("x0").cast("string"), F.col("y0").cast("string"))))
    out = with_geometry(df.withColumn("shape", text), "shape", "ESRIJSON")
    parts = F.col("geom.parts")
    return out.select("oid", F.col("geom.type").alias("kind"), F.size(parts).alias("n_parts"), F.size(F.flatten(parts)).alias("n_rings"),
                      *[F.col(c).alias(c[1:]) for c in ("_xmin", "_ymin", "_xmax", "_ymax")])


@case("a9_export_geojson", WITH + """
SELECT 'Feature' AS feature, 'Point' AS kind, oid, entity, event_type, lon AS x, lat AS y FROM positions
""")
def export_geojson(spark, sf_dir):
    path = scratch_path(spark, "export")
    export_features(position_layer(spark, sf_dir).df.select("oid", "entity", "event_type", "ts", "geom"), path, id_field="oid")
    back = spark.read.schema(
        "type string, properties struct<oid:bigint,entity:bigint,event_type:string,ts:string>, "
        "geometry struct<type:string,coordinates:array<double>>").json(path)
    return back.select(F.col("type").alias("feature"), F.col("geometry.type").alias("kind"), "properties.oid", "properties.entity",
                       "properties.event_type", F.col("geometry.coordinates")[0].alias("x"), F.col("geometry.coordinates")[1].alias("y"))


@case("a9_export_wkt", SHAPE_SQL.format(kind="Polygon", srid=4326, n=5))
def export_wkt(spark, sf_dir):
    path = scratch_path(spark, "export")
    export_features(boxes(spark, sf_dir).select("oid", "geom", "_xmin", "_ymin", "_xmax", "_ymax"), path, "wkt")
    return _shape_row(with_geometry(spark.read.parquet(path).withColumnRenamed("geom", "text"), "text", "WKT"))


def stored_layer(spark, sf_dir) -> Layer:
    """Positions written in clusters by day and place and opened again."""
    path = scratch_path(spark, "layer")
    dated = position_layer(spark, sf_dir).df.withColumn("event_date", F.to_date("ts"))
    write_clustered(dated, path, "event_date", "oid")
    return Layer.path(spark, path, "geom", id_field="oid", time_field="ts", date_field="event_date", geometry_type="Point")


@case("a10_quarantine", """
SELECT event_type, count(*) AS n_rows, CAST(count_if(event_type = 'signup') AS BIGINT) AS n_unreadable, CAST(count_if(event_type IN ('signup', 'error')) AS BIGINT) AS n_without
FROM events GROUP BY 1
""")
def quarantined(spark, sf_dir):
    rows, _ = ingest_geometry(mixed_text(spark, sf_dir), "shape_text")
    missing = F.col("geom").isNull()
    return rows.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(missing & F.col("shape_text").isNotNull()).alias("n_unreadable"),
        F.count_if(missing).alias("n_without"))


@case("a10_quarantine_rows", WITH + """
SELECT oid, event_type, 'POLYGON((' AS begin, ', 0 0, 1 1, 2 2))' AS rest FROM positions WHERE event_type = 'signup'
""")
def quarantine_rows(spark, sf_dir):
    """The unreadable rows with their value as it came, also where the decoded column takes its name."""
    stored = mixed_text(spark, sf_dir).withColumnRenamed("shape_text", "geom")
    _, bad = ingest_geometry(stored, "geom", "WKT")
    return bad.select("oid", "event_type", F.substring("geom", 1, 9).alias("begin"), F.regexp_extract("geom", r", 0 0.*", 0).alias("rest"))


@case("a11_stored_page", WITH + """
SELECT oid, entity, speed FROM positions WHERE event_type = 'view' AND ts >= TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-20'
  AND lon BETWEEN -60 AND 60 AND lat BETWEEN -30 AND 30 ORDER BY speed DESC NULLS LAST, oid LIMIT 100
""")
def stored_page(spark, sf_dir):
    """Time, box and condition on clustered files."""
    return stored_layer(spark, sf_dir).query(
        time="1704844800000,1705708800000", geometry=WINDOW, where="event_type = 'view'", order_by_fields="speed DESC",
        result_record_count=100, out_fields="oid,entity,speed", return_geometry=False)


@case("a11_stored_count", WITH + "SELECT count(*) AS count FROM positions WHERE lon BETWEEN -60 AND 60 AND lat BETWEEN -30 AND 30 AND ts <= TIMESTAMP '2024-01-20'")
def stored_count(spark, sf_dir):
    return stored_layer(spark, sf_dir).query(time="null,1705708800000", geometry=WINDOW, return_count_only=True)


@case("a11_clustered_write", WITH + """
SELECT strftime(ts, '%Y-%m-%d') AS event_date, count(*) AS n, CAST(sum(oid) AS BIGINT) AS oids, round(sum(lon), 4) AS lons, round(sum(lat), 4) AS lats
FROM positions GROUP BY 1
""")
def clustered_write(spark, sf_dir):
    path = scratch_path(spark, "clustered")
    dated = position_layer(spark, sf_dir).df.withColumn("event_date", F.to_date("ts"))
    write_clustered(dated, path, "event_date", "oid")
    return spark.read.parquet(path).groupBy(F.col("event_date").cast("string").alias("event_date")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("oid").alias("oids"), F.round(F.sum("lon"), 4).alias("lons"),
        F.round(F.sum("lat"), 4).alias("lats"))


# -- predicates --------------------------------------------------------------------------------------------------------

OPEN = "x0 < 60 AND x1 > -60 AND y0 < 30 AND y1 > -30"
MEETS = "x0 <= 60 AND x1 >= -60 AND y0 <= 30 AND y1 >= -30"
WITHIN = "x0 >= -60 AND x1 <= 60 AND y0 >= -30 AND y1 <= 30"
COVERS = "x0 <= -60 AND x1 >= 60 AND y0 <= -30 AND y1 >= 30"


def _box_case(name: str, relation: str, condition: str, window: str = WINDOW) -> None:
    @case(name, f"{WITH} SELECT oid, x0, y0, x1, y1 FROM boxes WHERE {condition}")
    def run(spark, sf_dir):
        return spatial_filter(boxes(spark, sf_dir), window, relation).select("oid", "x0", "y0", "x1", "y1")


_box_case("c1_intersects", "esriSpatialRelIntersects", MEETS)
_box_case("c2_contains", "esriSpatialRelContains", "x0 <= -5 AND x1 >= 5 AND y0 <= -5 AND y1 >= 5", "-5,-5,5,5")
_box_case("c3_within", "esriSpatialRelWithin", WITHIN)
_box_case("c4_touches", "esriSpatialRelTouches", f"{MEETS} AND NOT ({OPEN})")
_box_case("c5_overlaps", "esriSpatialRelOverlaps", f"{OPEN} AND NOT ({WITHIN}) AND NOT ({COVERS})")


@case("c15_crosses", WITH + """
SELECT oid, x0, x1, y FROM segments WHERE y > -30 AND y < 30 AND x0 < 60 AND x1 > -60 AND NOT (x0 >= -60 AND x1 <= 60)
""")
def crosses(spark, sf_dir):
    return spatial_filter(segments(spark, sf_dir), WINDOW, "esriSpatialRelCrosses").select("oid", "x0", "x1", "y")


@case("c9_envelope_points", WITH + "SELECT oid, lon, lat FROM positions WHERE lon BETWEEN -60 AND 60 AND lat BETWEEN -30 AND 30")
def envelope_points(spark, sf_dir):
    shape = {"xmin": -60, "ymin": -30, "xmax": 60, "ymax": 30, "spatialReference": {"wkid": 4326}}
    layer = position_layer(spark, sf_dir)
    return spatial_filter(layer.df, shape, geometry_type=layer.geometry_type).select("oid", "lon", "lat")


@case("b7_spatial_polygon", WITH + """
SELECT oid, lon, lat FROM positions WHERE abs(lon - 10) / 50.007e0 + abs(lat - 5) / 40.003e0 < 1e0
""")
def spatial_polygon(spark, sf_dir):
    """Points within a diamond given as rings, tested in the JVM."""
    ring = [[60.007, 5], [10, 5 - 40.003], [10 - 50.007, 5], [10, 45.003], [60.007, 5]]
    layer = position_layer(spark, sf_dir)
    return spatial_filter(layer.df, {"rings": [ring]}, "esriSpatialRelWithin", geometry_type="Point").select("oid", "lon", "lat")


@case("c6_normalize_shapes", WITH + """
SELECT oid, CASE WHEN segment IN ('AUTOMOBILE', 'FURNITURE') THEN 'Point' ELSE 'Polygon' END AS kind, x0 AS xmin, y0 AS ymin,
       CASE WHEN segment IN ('AUTOMOBILE', 'FURNITURE') THEN x0 ELSE x1 END AS xmax,
       CASE WHEN segment IN ('AUTOMOBILE', 'FURNITURE') THEN y0 ELSE y1 END AS ymax
FROM boxes
""")
def normalized_shapes(spark, sf_dir):
    """One way of writing a shape per segment: x,y; four numbers; envelope; {x,y}; rings."""
    sides = [F.col(c).cast("string") for c in ("x0", "y0", "x1", "y1")]
    kind = F.col("segment")
    text = (
        F.when(kind == "AUTOMOBILE", F.concat_ws(",", *sides[:2]))
        .when(kind == "BUILDING", F.concat_ws(", ", *sides))
        .when(kind == "MACHINERY", F.format_string('{"xmin":%s,"ymin":%s,"xmax":%s,"ymax":%s}', *sides))
        .when(kind == "FURNITURE", F.format_string('{"x":%s,"y":%s}', *sides[:2]))
        .otherwise(F.concat(F.lit('{"rings":[['), _ring(CLOCKWISE, "[%s,%s]"), F.lit("]]}"))))
    texts = box_values(spark, sf_dir).withColumns({"shape": text, "in_sr": F.lit("4326")})
    out = normalize_shapes(texts, "shape", 4326, "in_sr")
    return out.select("oid", F.col("geom.type").alias("kind"), *[F.col(c).alias(c[1:]) for c in ("_xmin", "_ymin", "_xmax", "_ymax")])


RADIUS = "(20037508.342789244 / pi())"
MERCATOR_X = f"(radians({{x}}) * {RADIUS})"
MERCATOR_Y = f"(asinh(tan(radians({{y}}))) * {RADIUS})"


@case("c7_mixed_srid", WITH + """
SELECT oid, CAST(4326 AS INT) AS srid, round(x0 / 2, 6) AS xmin, round(y0 / 2, 6) AS ymin, round(x1 / 2, 6) AS xmax, round(y1 / 2, 6) AS ymax FROM boxes
""")
def mixed_srid(spark, sf_dir):
    """The same boxes in degrees and in metres, declared in four ways or not at all; all end up in degrees."""
    halves = box_values(spark, sf_dir).withColumns({c: F.col(c) / 2 for c in ("x0", "y0", "x1", "y1")})
    metres = reproject(box(*map(F.col, ("x0", "y0", "x1", "y1"))), 3857)
    staged = with_bounds(halves.select("oid", "segment", "x0", "y0", "x1", "y1", metres.alias("geom")))
    degrees = [F.col(c).cast("string") for c in ("x0", "y0", "x1", "y1")]
    projected = [F.col(c).cast("string") for c in ("_xmin", "_ymin", "_xmax", "_ymax")]
    kind = F.col("segment")
    envelope_text = '{"xmin":%s,"ymin":%s,"xmax":%s,"ymax":%s'
    text = (
        F.when(kind == "AUTOMOBILE", F.format_string(envelope_text + ',"spatialReference":{"wkid":102100,"latestWkid":3857}}', *projected))
        .when(kind == "BUILDING", F.format_string(envelope_text + ',"spatialReference":{"wkid":102113}}', *projected))
        .when(kind.isin("MACHINERY", "FURNITURE"), F.concat_ws(",", *projected))
        .otherwise(F.concat_ws(",", *degrees)))
    code = F.when(kind == "FURNITURE", '{"spatialReference":{"wkid":102100}}').when(kind == "HOUSEHOLD", "4326")
    shaped = staged.select("oid", text.alias("shape"), code.alias("in_sr"))
    out = normalize_shapes(shaped, "shape", 4326, "in_sr")
    return out.select("oid", F.col("geom.srid").alias("srid"), *[F.round(c, 6).alias(c[1:]) for c in ("_xmin", "_ymin", "_xmax", "_ymax")])


@case("c8_reproject", WITH + f"""
SELECT oid, CAST(3857 AS INT) AS srid, round({MERCATOR_X.format(x='lon')}, 3) AS x, round({MERCATOR_Y.format(y='lat')}, 3) AS y FROM positions
""")
def reprojected(spark, sf_dir):
    layer = position_layer(spark, sf_dir)
    moved = layer.df.select("oid", reproject(F.col("geom"), 102100).alias("geom"))
    return moved.select("oid", F.col("geom.srid").alias("srid"), F.round(first("x"), 3).alias("x"), F.round(first("y"), 3).alias("y"))


@case("c8_reproject_back", WITH + "SELECT oid, round(lon, 9) AS x, round(lat, 9) AS y FROM positions")
def reprojected_back(spark, sf_dir):
    layer = position_layer(spark, sf_dir)
    moved = layer.df.select("oid", reproject(reproject(F.col("geom"), 3857), 4326).alias("geom"))
    return moved.select("oid", F.round(first("x"), 9).alias("x"), F.round(first("y"), 9).alias("y"))


def utm_sql(srid: int) -> str:
    """Easting and northing by the series, with the conformal latitude in its other form."""
    ecc, n = "sqrt(0.00669437999014131699613723)", 0.0016792203863837045
    meridian, north = (srid % 100) * 6 - 183, 0 if srid < 32700 else 10_000_000
    metres = 0.9996 * 6378137.0 / (1 + n) * (1 + n ** 2 / 4 + n ** 4 / 64)
    a = (n / 2 - 2 * n ** 2 / 3 + 5 * n ** 3 / 16 + 41 * n ** 4 / 180, 13 * n ** 2 / 48 - 3 * n ** 3 / 5 + 557 * n ** 4 / 1440, 61 * n ** 3 / 240 - 103 * n ** 4 / 140, 49561 * n ** 4 / 161280)
    east = " + ".join(f"{c!r} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, c in enumerate(a, 1))
    up = " + ".join(f"{c!r} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, c in enumerate(a, 1))
    return f"""
SELECT oid, {srid} AS srid, CASE WHEN abs(off) < 80 THEN round(500000 + {metres!r} * (eta + {east}), 3) END AS x, CASE WHEN abs(off) < 80 THEN round({north} + {metres!r} * (xi + {up}), 3) END AS y
FROM (SELECT oid, off, atan2(t, cos(radians(off))) AS xi, asinh(sin(radians(off)) / sqrt(t * t + cos(radians(off)) * cos(radians(off)))) AS eta
      FROM (SELECT oid, fmod(lon - {meridian} + 540, 360) - 180 AS off, sinh(asinh(tan(radians(lat))) - {ecc} * atanh({ecc} * sin(radians(lat)))) AS t FROM positions))"""


@case("c8_reproject_utm", WITH + " UNION ALL ".join(utm_sql(srid) for srid in (32633, 32718)))
def reprojected_to_utm(spark, sf_dir):
    """All positions in a northern and a southern zone."""
    layer = position_layer(spark, sf_dir)
    parts = [layer.df.select("oid", F.lit(srid).alias("srid"), reproject(F.col("geom"), srid).alias("geom")) for srid in (32633, 32718)]
    return parts[0].unionByName(parts[1]).select("oid", "srid", F.round(first("x"), 3).alias("x"), F.round(first("y"), 3).alias("y"))


@case("c8_utm_round_trip", WITH + "SELECT oid, round(lon, 8) AS x, round(lat, 8) AS y FROM positions WHERE lon > -12 AND lon < 42 AND lat > 0")
def utm_round_trip(spark, sf_dir):
    """Positions around one zone into it, on to a neighbouring one, and back to degrees."""
    near = position_layer(spark, sf_dir).df.filter("lon > -12 AND lon < 42 AND lat > 0")
    moved = near.select("oid", reproject(reproject(reproject(F.col("geom"), 32633), 32634), 4326).alias("geom"))
    return moved.select("oid", F.round(first("x"), 8).alias("x"), F.round(first("y"), 8).alias("y"))


@case("c10_unwrap_dateline", WITH + """
SELECT oid, CASE WHEN lon > 150 THEN 'yes' ELSE 'no' END AS unwrapped, round(lon + lon + 30, 6) AS x_sum FROM positions
""")
def unwrapped(spark, sf_dir):
    """Lines 30 degrees long; those that pass 180 are stored with a negative end."""
    end = F.when(F.col("lon") > 150, F.col("lon") + 30 - 360).otherwise(F.col("lon") + 30)
    lines = positions(spark, sf_dir).withColumn("geom", line((F.col("lon"), F.col("lat")), (end, F.col("lat"))))
    shown = lines.select("oid", F.col("geom").alias("stored"), unwrap_dateline(F.col("geom")).alias("geom"))
    xs = vertices(F.col("geom")).getField("x")
    return shown.select("oid", F.when(F.col("stored") != F.col("geom"), "yes").otherwise("no").alias("unwrapped"),
                        F.round(F.aggregate(xs, F.lit(0.0), lambda a, b: a + b), 6).alias("x_sum"))


@case("c11_wrap_longitudes", WITH + """
SELECT oid, round(CASE WHEN lon * 1.5e0 > 180 THEN lon * 1.5e0 - 360 WHEN lon * 1.5e0 < -180 THEN lon * 1.5e0 + 360 ELSE lon * 1.5e0 END, 6) AS x,
       lat AS y FROM positions
""")
def wrapped(spark, sf_dir):
    wide = positions(spark, sf_dir).withColumn("far", F.col("lon") * F.lit(1.5))
    back = with_point(wide, "far", "lat").select("oid", wrap_longitudes(F.col("geom")).alias("geom"))
    return back.select("oid", F.round(first("x"), 6).alias("x"), first("y").alias("y"))


@case("c12_distance_points", WITH + """
SELECT oid, round(sqrt((lon - 10) * (lon - 10) + (lat - 20) * (lat - 20)), 6) AS distance
FROM positions WHERE sqrt((lon - 10) * (lon - 10) + (lat - 20) * (lat - 20)) < 25e0
""")
def distance_points(spark, sf_dir):
    near = distance_filter(position_layer(spark, sf_dir).df, 10, 20, 25, geometry_type="Point")
    return near.orderBy("distance", "oid").select("oid", F.round("distance", 6).alias("distance"))


@case("c12_distance_shapes", WITH + """
, d AS (
  SELECT oid, 'box' AS kind, greatest(x0 - 10, 10 - x1, 0e0) AS dx, greatest(y0 - 20, 20 - y1, 0e0) AS dy FROM boxes
  UNION ALL SELECT oid, 'segment', greatest(x0 - 10, 10 - x1, 0e0), abs(y - 20) FROM segments)
SELECT oid, kind, round(sqrt(dx * dx + dy * dy), 6) AS distance FROM d WHERE sqrt(dx * dx + dy * dy) < 30e0
""")
def distance_shapes(spark, sf_dir):
    box_rows = boxes(spark, sf_dir).select("oid", F.lit("box").alias("kind"), "geom", "_xmin", "_ymin", "_xmax", "_ymax")
    line_rows = segments(spark, sf_dir).select("oid", F.lit("segment").alias("kind"), "geom", "_xmin", "_ymin", "_xmax", "_ymax")
    near = distance_filter(box_rows.unionByName(line_rows), 10, 20, 30)
    return near.select("oid", "kind", F.round("distance", 6).alias("distance"))


@case("c13_envelope", WITH + """
SELECT oid, 'box' AS source, 'Polygon' AS kind, CAST(5 AS INT) AS n_vertices, x0 AS xmin, y1 AS ymax FROM boxes
UNION ALL SELECT oid, 'segment', 'LineString', CAST(2 AS INT), x0, y FROM segments
UNION ALL SELECT oid, 'position', 'Point', CAST(1 AS INT), lon, lat FROM positions
""")
def envelopes(spark, sf_dir):
    def rows(df, name):
        e = F.col("envelope")
        return envelope(df).select("oid", F.lit(name).alias("source"), e["type"].alias("kind"), F.size(vertices(e)).alias("n_vertices"),
                                   F.col("_xmin").alias("xmin"), F.col("_ymax").alias("ymax"))
    return rows(boxes(spark, sf_dir), "box").unionByName(rows(segments(spark, sf_dir), "segment")).unionByName(
        rows(position_layer(spark, sf_dir).df, "position"))


@case("c14_type_and_dimension", """
SELECT CASE event_type WHEN 'click' THEN 'MultiPoint' WHEN 'purchase' THEN 'LineString' ELSE 'Point' END AS kind,
       CAST(CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 0 WHEN 'purchase' THEN 1 END AS INT) AS dimension, count(*) AS n
FROM events GROUP BY ALL
""")
def type_and_dimension(spark, sf_dir):
    rows = with_geometry(mixed_text(spark, sf_dir), "shape_text")
    g = F.col("geom")
    return rows.groupBy(type_name(g).alias("kind"), dimension(g).alias("dimension")).agg(F.count(F.lit(1)).alias("n"))


@case("j_geometry_text", WITH + """
SELECT oid, concat('POINT(', regexp_replace(CAST(lon AS VARCHAR), '\\.0$', ''), ' ', regexp_replace(CAST(lat AS VARCHAR), '\\.0$', ''), ')') AS wkt,
       lon AS x, lat AS y FROM positions
""")
def geometry_text(spark, sf_dir):
    rows = position_layer(spark, sf_dir).df.select("oid", as_wkt(F.col("geom")).alias("wkt"), as_geojson(F.col("geom")).alias("json"))
    at = F.from_json("json", "type string, coordinates array<double>")["coordinates"]
    return rows.select("oid", "wkt", at[0].alias("x"), at[1].alias("y"))


# -- joins -------------------------------------------------------------------------------------------------------------

@case("d1_point_in_zone", WITH + f"""
SELECT oid, zone_id, zone_name FROM positions JOIN zones ON abs(lon - cx) / {HALF_WIDTH}e0 + abs(lat - cy) / {HALF_HEIGHT}e0 < 1e0
""")
def point_in_zone(spark, sf_dir):
    return points_in_polygons(position_layer(spark, sf_dir).df, zones(spark, sf_dir)).select("oid", "zone_id", "zone_name")


@case("d1_point_in_zone_shuffled", WITH + f"""
SELECT zone_id, count(*) AS n_points, round(sum(speed), 4) AS total FROM positions
JOIN zones ON abs(lon - cx) / {HALF_WIDTH}e0 + abs(lat - cy) / {HALF_HEIGHT}e0 < 1e0 GROUP BY 1
""")
def point_in_zone_shuffled(spark, sf_dir):
    """The same join as for zones too large to broadcast: by square, with full squares split."""
    pairs = points_in_polygons(position_layer(spark, sf_dir).df, zones(spark, sf_dir), broadcast_bytes=0)
    return pairs.groupBy("zone_id").agg(F.count(F.lit(1)).alias("n_points"), F.round(F.sum("speed"), 4).alias("total"))


@case("d1_shapes_in_zones", WITH + f"""
SELECT oid, zone_id FROM boxes JOIN zones
ON greatest(x0 - cx, cx - x1, 0e0) / {HALF_WIDTH}e0 + greatest(y0 - cy, cy - y1, 0e0) / {HALF_HEIGHT}e0 <= 1e0
""")
def shapes_in_zones(spark, sf_dir):
    """A layer of polygons against a table of areas of interest."""
    areas = zones(spark, sf_dir).select("zone_id", "geom", "_xmin", "_ymin", "_xmax", "_ymax")
    return spatial_join(boxes(spark, sf_dir), areas, "intersects").select("oid", "zone_id")
