"""Extents, bins, tracks, audits, ids and the catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoloom import (
    Layer, assign_ids, cell_bins, cut_tracks, daily_tracks, discover_columns, id_audit, latest_per_entity, finished_bins, layer_extent, minimum_scale,
    nested_bins, parent_bins, refresh_catalog, roll_up, stored_profile, table_profile, time_extent, write_profile,
)
from geoloom.functions.cells import hex_edge
from geoloom.functions.geometry import vertices
from geoloom.functions.times import epoch_ms
from geoloom.operators.sketches import distinct_error
from geoloom.runtime import scratch_path
from workload.registry import case
from workload.tables import WITH, boxes, position_layer, positions, read, segments

RESOLUTION = 2
EDGE = repr(hex_edge(RESOLUTION))

# Positions in a tenth of the world each way, so that a cell holds many of them. The hexagon of a point is the one with the nearest centre; the SQL tries the four centres around it.
HEXAGONS = WITH + f""", crowded AS (SELECT * REPLACE (lon / 1e1 AS lon, lat / 1e1 AS lat) FROM positions),
projected AS (
  SELECT *, radians(lon) * 20037508.342789244 / pi() / {EDGE} AS u, asinh(tan(radians(lat))) * 20037508.342789244 / pi() / {EDGE} AS v FROM crowded),
axial AS (SELECT *, u / sqrt(3e0) - v / 3e0 AS q0, v * 2e0 / 3e0 AS r0 FROM projected),
centres AS (
  SELECT *, floor(q0) + a AS q, floor(r0) + b AS r FROM axial, (VALUES (0), (1)) AS s(a), (VALUES (0), (1)) AS t(b)),
nearest AS (
  SELECT oid, arg_min(CAST(q AS BIGINT), power(u - sqrt(3e0) * (q + r / 2e0), 2) + power(v - 1.5e0 * r, 2)) AS q,
         arg_min(CAST(r AS BIGINT), power(u - sqrt(3e0) * (q + r / 2e0), 2) + power(v - 1.5e0 * r, 2)) AS r
  FROM centres GROUP BY oid),
placed AS (
  SELECT p.*, n.q, n.r, CAST({RESOLUTION} * 288230376151711744 + (n.q + 268435456) * 536870912 + n.r + 268435456 AS BIGINT) AS cell
  FROM crowded p JOIN nearest n USING (oid))
"""


def bins_of(spark, sf_dir, **options):
    given = {"entity": "entity", "speed": "speed", "category": "event_type", "time": "ts", **options}
    crowded = positions(spark, sf_dir).withColumns({"lon": F.col("lon") / 10, "lat": F.col("lat") / 10})
    return cell_bins(crowded, "lon", "lat", RESOLUTION, **given)


@case("e2_layer_extent", WITH + "SELECT min(lon) AS xmin, min(lat) AS ymin, max(lon) AS xmax, max(lat) AS ymax, CAST(4326 AS INT) AS wkid FROM positions")
def extent(spark, sf_dir):
    return layer_extent(position_layer(spark, sf_dir).df)


@case("e2_layer_extent_shapes", WITH + "SELECT min(x0) AS xmin, min(y0) AS ymin, max(x1) AS xmax, max(y1) AS ymax, CAST(4326 AS INT) AS wkid FROM boxes")
def extent_of_shapes(spark, sf_dir):
    return layer_extent(boxes(spark, sf_dir))


@case("e3_time_extent", "SELECT epoch_us(min(ts)) // 1000 AS t0, epoch_us(max(ts)) // 1000 AS t1 FROM events")
def times(spark, sf_dir):
    return time_extent(read(spark, sf_dir, "events"), "ts")


@case("e4_cell_bins", HEXAGONS + f"""
SELECT cell, count(*) AS total_positions, count(DISTINCT entity) AS unique_entities, round(avg(speed), 6) AS avg_speed, max(speed) AS max_speed,
       string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS categories, epoch_us(min(ts)) // 1000 AS t0, epoch_us(max(ts)) // 1000 AS t1,
       CAST(7 AS INT) AS n_vertices, round(degrees((sqrt(3e0) * (min(q) + min(r) / 2e0) - sqrt(3e0) / 2e0) * {EDGE} * pi() / 20037508.342789244), 6) AS cell_xmin
FROM placed GROUP BY cell
""")
def bins(spark, sf_dir):
    rows = bins_of(spark, sf_dir)
    kind = rows.schema["earliest"].dataType
    outline = vertices(F.col("cell_polygon"))
    return rows.select(
        "cell", "total_positions", "unique_entities", F.round("avg_speed", 6).alias("avg_speed"), "max_speed",
        F.array_join("categories", ",").alias("categories"), epoch_ms(F.col("earliest"), kind).alias("t0"),
        epoch_ms(F.col("latest"), kind).alias("t1"), F.size(outline).alias("n_vertices"),
        F.round(F.array_min(outline.getField("x")), 6).alias("cell_xmin"))


@case("e4_cell_bins_lists", HEXAGONS + """
, per_value AS (SELECT cell, event_type, count(*) AS n FROM placed GROUP BY ALL)
SELECT cell, CAST(sum(n) AS BIGINT) AS total_positions, string_agg(concat(event_type, '=', n), ',' ORDER BY event_type) AS categories FROM per_value GROUP BY cell
""")
def bins_with_lists(spark, sf_dir):
    rows = bins_of(spark, sf_dir, with_counts=True, entity=None, speed=None, time=None)
    pairs = F.transform("categories", lambda c: F.concat_ws("=", c["value"], c["n"].cast("string")))
    return rows.select("cell", "total_positions", F.array_join(pairs, ",").alias("categories"))


def _nearest_sql(source: str, q: str, r: str, name: str) -> str:
    """SQL for the lattice points nearest to places on hexagonal axes, out of the four around each."""
    away = "power(q0 - a + (r0 - b) / 2e0, 2) + power((r0 - b) * sqrt(3e0) / 2e0, 2)"
    return f"""{name}_at AS (SELECT oid, {q} AS q0, {r} AS r0 FROM {source}),
{name}_near AS (SELECT oid, q0, r0, floor(q0) + s.i AS a, floor(r0) + t.i AS b FROM {name}_at, (VALUES (0), (1)) AS s(i), (VALUES (0), (1)) AS t(i)),
{name} AS (SELECT oid, arg_min(CAST(a AS BIGINT), {away}) AS q, arg_min(CAST(b AS BIGINT), {away}) AS r FROM {name}_near GROUP BY oid)"""


# Cells at resolution 4, their parents at 3 and those of these at 2.
FINE, COARSE = 4, 2
FINE_EDGE = repr(hex_edge(FINE))
PARENTS = WITH + f""", crowded AS (SELECT * REPLACE (lon / 1e1 AS lon, lat / 1e1 AS lat) FROM positions),
plane AS (SELECT oid, radians(lon) * 20037508.342789244 / pi() / {FINE_EDGE} AS u, asinh(tan(radians(lat))) * 20037508.342789244 / pi() / {FINE_EDGE} AS v FROM crowded),
""" + ",\n".join([
    _nearest_sql("plane", "u / sqrt(3e0) - v / 3e0", "v * 2e0 / 3e0", "fine"),
    _nearest_sql("fine", "(2 * q - r) / 7e0", "(q + 3 * r) / 7e0", "middle"),
    _nearest_sql("middle", "(3 * q + r) / 7e0", "(2 * r - q) / 7e0", "coarse")]) + "\n"


@case("e4_parent_bins", PARENTS + f"""
SELECT CAST({COARSE} * 288230376151711744 + (q + 268435456) * 536870912 + r + 268435456 AS BIGINT) AS cell, count(*) AS total_positions,
       round(avg(speed), 6) AS avg_speed, max(speed) AS max_speed, epoch_us(min(ts)) // 1000 AS t0, epoch_us(max(ts)) // 1000 AS t1, CAST(7 AS INT) AS n_vertices
FROM coarse JOIN positions USING (oid) GROUP BY q, r
""")
def bins_by_parent(spark, sf_dir):
    """Bins of one resolution, merged two resolutions up without the points."""
    crowded = positions(spark, sf_dir).withColumns({"lon": F.col("lon") / 10, "lat": F.col("lat") / 10})
    rows = finished_bins(parent_bins(nested_bins(crowded, "lon", "lat", FINE, speed="speed", time="ts"), FINE, COARSE), COARSE)
    kind = rows.schema["earliest"].dataType
    return rows.select("cell", "total_positions", F.round("avg_speed", 6).alias("avg_speed"), "max_speed", epoch_ms(F.col("earliest"), kind).alias("t0"),
                       epoch_ms(F.col("latest"), kind).alias("t1"), F.size(vertices(F.col("cell_polygon"))).alias("n_vertices"))


@case("e5_roll_up", HEXAGONS + """
, bins AS (SELECT cell, count(*) AS n, count(DISTINCT entity) AS e FROM placed GROUP BY cell)
SELECT count(*) AS total_cells, CAST(sum(n) AS BIGINT) AS total_positions, CAST(sum(e) AS BIGINT) AS unique_entities FROM bins WHERE n > 10
""")
def rolled_up(spark, sf_dir):
    return roll_up(bins_of(spark, sf_dir), least=10)


TRACKS = WITH + """
SELECT entity, strftime(ts, '%Y-%m-%d') AS track_date, CAST(0 AS BIGINT) AS part, epoch_us(min(ts)) // 1000 AS t0, epoch_us(max(ts)) // 1000 AS t1,
       count(*) AS position_count, round(avg(speed), 6) AS avg_speed, max(event_type) AS entity_name,
       string_agg(concat(round(lon * 100), '/', round(lat * 100)), ' ' ORDER BY ts, oid) AS path
FROM positions GROUP BY ALL
"""


def _track_rows(rows):
    kind = rows.schema["start_time"].dataType

    def stop(v):
        return F.concat_ws("/", F.round(v["x"] * 100, 0).cast("string"), F.round(v["y"] * 100, 0).cast("string"))

    return rows.select(
        "entity", F.col("track_date").cast("string").alias("track_date"), "part", epoch_ms(F.col("start_time"), kind).alias("t0"),
        epoch_ms(F.col("end_time"), kind).alias("t1"), "position_count", F.round("avg_speed", 6).alias("avg_speed"), "entity_name",
        F.array_join(F.transform(vertices(F.col("geom")), stop), " ").alias("path"))


@case("e6_daily_tracks", TRACKS)
def tracks(spark, sf_dir):
    return _track_rows(daily_tracks(positions(spark, sf_dir), "entity", "ts", "lon", "lat", "speed", "event_type", "oid"))


@case("e6_daily_tracks_sliced", WITH + """
, stops AS (SELECT *, strftime(ts, '%Y-%m-%d') AS track_date, CAST(date_part('hour', ts) // 6 AS BIGINT) AS part FROM positions),
slices AS (
  SELECT entity, track_date, part, min(ts) AS t0, max(ts) AS t1, count(*) AS position_count, avg(speed) AS avg_speed, max(event_type) AS entity_name,
         string_agg(concat(round(lon * 100), '/', round(lat * 100)), ' ' ORDER BY ts, oid) AS path,
         arg_min(concat(round(lon * 100), '/', round(lat * 100)), (ts, oid)) AS first_stop FROM stops GROUP BY ALL)
SELECT entity, track_date, part, epoch_us(t0) // 1000 AS t0, epoch_us(t1) // 1000 AS t1, position_count, round(avg_speed, 6) AS avg_speed, entity_name,
       concat_ws(' ', path, lead(first_stop) OVER (PARTITION BY entity, track_date ORDER BY part)) AS path FROM slices
""")
def tracks_sliced(spark, sf_dir):
    """Quarters of days, each line reaching to the first stop of the next quarter."""
    return _track_rows(daily_tracks(positions(spark, sf_dir), "entity", "ts", "lon", "lat", "speed", "event_type", "oid", slice_minutes=360))


@case("e6_daily_tracks_cut", WITH + """
, ranked AS (
  SELECT entity, strftime(ts, '%Y-%m-%d') AS track_date, oid, lon, lat,
         row_number() OVER (PARTITION BY entity, strftime(ts, '%Y-%m-%d') ORDER BY ts, oid) - 1 AS k,
         count(*) OVER (PARTITION BY entity, strftime(ts, '%Y-%m-%d')) AS n FROM positions),
pieces AS (
  SELECT *, k // 2 AS part FROM ranked WHERE n > 2
  UNION ALL SELECT *, k // 2 - 1 FROM ranked WHERE n > 2 AND k % 2 = 0 AND k > 0
  UNION ALL SELECT *, 0 FROM ranked WHERE n <= 2)
SELECT entity, track_date, CAST(part AS BIGINT) AS part, max(n) AS position_count, count(*) AS n_vertices, round(sum(lon), 4) AS lons, round(sum(lat), 4) AS lats
FROM pieces GROUP BY entity, track_date, part
""")
def tracks_cut(spark, sf_dir):
    """Days above the vertex limit come in parts that share their joints."""
    rows = cut_tracks(positions(spark, sf_dir), "entity", "ts", "lon", "lat", 2, tie="oid")
    xs, ys = vertices(F.col("geom")).getField("x"), vertices(F.col("geom")).getField("y")
    return rows.select(
        "entity", F.col("track_date").cast("string").alias("track_date"), "part", "position_count",
        F.size(xs).cast("long").alias("n_vertices"), F.round(F.aggregate(xs, F.lit(0.0), lambda a, b: a + b), 4).alias("lons"),
        F.round(F.aggregate(ys, F.lit(0.0), lambda a, b: a + b), 4).alias("lats"))


@case("e7_table_profile", WITH + """
SELECT count(*) AS total_rows, count(DISTINCT entity) AS unique_entities, epoch_us(min(ts)) // 1000 AS earliest_ms, epoch_us(max(ts)) // 1000 AS latest_ms,
       min(lat) AS min_lat, max(lat) AS max_lat, min(lon) AS min_lon, max(lon) AS max_lon FROM positions
""")
def profile(spark, sf_dir):
    return table_profile(positions(spark, sf_dir), "entity", "ts", "lon", "lat")


@case("e7_profile_merged", WITH + """
SELECT count(*) AS total_rows, true AS entities_within_bound, epoch_us(min(ts)) // 1000 AS earliest_ms, epoch_us(max(ts)) // 1000 AS latest_ms,
       min(lat) AS min_lat, max(lat) AS max_lat, min(lon) AS min_lon, max(lon) AS max_lon FROM positions
""")
def merged(spark, sf_dir):
    """Sketches of all days, the last of them stored before its errors came in and then once more; the estimate is held against the exact count."""
    rows = positions(spark, sf_dir).withColumn("event_date", F.to_date("ts"))
    path, last = scratch_path(spark, "profile"), F.lit(rows.agg(F.max("event_date")).first()[0])
    names = ("event_date", "entity", "ts", "lon", "lat")
    write_profile(rows.filter((F.col("event_date") < last) | (F.col("event_type") != "error")), path, *names)
    write_profile(rows.filter(F.col("event_date") == last), path, *names)
    exact = rows.agg(F.count_distinct("entity")).first()[0]
    close = F.abs(F.col("unique_entities") - exact) <= exact * distinct_error()
    return stored_profile(spark, path).select(
        "total_rows", close.alias("entities_within_bound"), "earliest_ms", "latest_ms", "min_lat", "max_lat", "min_lon", "max_lon")


AUDIT = """SELECT '{name}' AS id_field, CAST(min({x}) AS BIGINT) AS min_id, CAST(max({x}) AS BIGINT) AS max_id, count(*) - count({x}) AS null_ids,
count({x}) - count(DISTINCT {x}) AS duplicate_ids, '{cls}' AS id_class FROM positions"""


@case("e8_id_audit", WITH + " UNION ALL ".join([
    AUDIT.format(name="oid", x="oid", cls="ok"), AUDIT.format(name="raw_id", x="raw_id", cls="low"),
    AUDIT.format(name="wide", x="(oid + 3000000000)", cls="over32"), AUDIT.format(name="huge", x="(oid + 9007199254740991)", cls="over53"),
    AUDIT.format(name="gaps", x="(CASE WHEN event_type <> 'error' THEN entity + 1 END)", cls="low")]))
def audits(spark, sf_dir):
    base = positions(spark, sf_dir).withColumns({
        "wide": F.col("oid") + 3000000000, "huge": F.col("oid") + 9007199254740991,
        "gaps": F.when(F.col("event_type") != "error", F.col("entity") + 1)})
    rows = [id_audit(base, c).select(F.lit(c).alias("id_field"), "*") for c in ("oid", "raw_id", "wide", "huge", "gaps")]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out


@case("i1_assign_ids", "SELECT row_number() OVER (ORDER BY value DESC, event_id) AS objectid, event_id, value FROM events")
def ids(spark, sf_dir):
    rows = read(spark, sf_dir, "events").select("event_id", "value", (-F.col("value")).alias("down"))
    return assign_ids(rows, ["down", "event_id"]).drop("down")


@case("i2_latest_per_entity", WITH + """
SELECT entity, oid, epoch_us(ts) // 1000 AS ts_ms, event_type, lon, lat FROM positions
QUALIFY row_number() OVER (PARTITION BY entity ORDER BY ts DESC, oid DESC) = 1
""")
def latest(spark, sf_dir):
    rows = latest_per_entity(positions(spark, sf_dir), "entity", "ts", "oid")
    return rows.select("entity", "oid", epoch_ms(F.col("ts"), rows.schema["ts"].dataType).alias("ts_ms"), "event_type", "lon", "lat")


@case("m1_layer_catalog", WITH + """
SELECT 'positions' AS name, 'oid' AS id_field, CAST(4326 AS INT) AS srid, 'Point' AS geometry_type, CAST(8 AS INT) AS n_fields,
       'speed:esriFieldTypeDouble' AS speed_field, count(*) AS row_count, min(lon) AS xmin, max(lat) AS ymax, epoch_us(min(ts)) // 1000 AS t0, epoch_us(max(ts)) // 1000 AS t1,
       min(oid) AS min_id, max(oid) AS max_id, 'ok' AS id_class FROM positions
UNION ALL SELECT 'boxes', 'oid', 4326, 'Polygon', 6, NULL, count(*), min(x0), max(y1), NULL, NULL, min(oid), max(oid), 'low' FROM boxes
UNION ALL SELECT 'segments', 'oid', 4326, 'LineString', 4, NULL, count(*), min(x0), max(y), NULL, NULL, min(oid), max(oid), 'low' FROM segments
UNION ALL SELECT 'gone', NULL, 4326, NULL, NULL, NULL, NULL, -180, 90, NULL, NULL, NULL, NULL, NULL
""")
def catalog(spark, sf_dir):
    layers = {
        "positions": position_layer(spark, sf_dir), "boxes": Layer(boxes(spark, sf_dir), "oid", name="boxes"),
        "segments": Layer(segments(spark, sf_dir), "oid", name="segments"), "gone": lambda: Layer.table(spark, "no.such.table"),
    }
    rows = refresh_catalog(spark, layers)
    speed = F.get(F.filter("fields", lambda f: f["name"] == "speed"), F.lit(0))
    return rows.select("name", "id_field", "srid", "geometry_type", F.when(F.col("fields").isNotNull(), F.size("fields")).alias("n_fields"),
                       F.concat(speed["name"], F.lit(":"), speed["type"]).alias("speed_field"), "row_count", "xmin", "ymax", "t0", "t1",
                       "min_id", "max_id", "id_class")


@case("m1_layers_apart", WITH + """
SELECT 'positions' AS name, 4326 AS srid, true AS extent_known, count(*) AS row_count, min(lon) AS xmin, max(lat) AS ymax, true AS is_ok FROM positions
UNION ALL SELECT 'boxes', 4326, true, count(*), min(x0), max(y1), true FROM boxes
UNION ALL SELECT 'failing', 3857, false, NULL, -20037508.342789244, 20037508.342789244, false
UNION ALL SELECT 'gone', 3857, false, NULL, -20037508.342789244, 20037508.342789244, false
""")
def layers_apart(spark, sf_dir):
    """A layer that fails while it is read and one that cannot be opened, between two sound ones."""
    bad = position_layer(spark, sf_dir, name="failing")
    broken = bad.df.withColumn("_xmin", F.when(F.col("oid") > 0, F.raise_error(F.lit("cannot be read")).cast("double")))
    layers = {
        "positions": position_layer(spark, sf_dir), "failing": Layer(broken, "oid", srid=3857, time_field="ts", name="failing"),
        "boxes": Layer(boxes(spark, sf_dir), "oid", name="boxes"), "gone": lambda: Layer.table(spark, "no.such.table"),
    }
    return refresh_catalog(spark, layers, srids={"gone": 3857}).select(
        "name", "srid", "extent_known", "row_count", "xmin", "ymax", (F.col("status") == "ok").alias("is_ok"))


@case("m2_discover_columns", WITH + """
SELECT 'id' AS role, 'raw_id' AS name, CAST(1 AS INT) AS preference, CAST(0 AS BIGINT) AS nulls, min(raw_id) AS low, CAST(NULL AS BOOLEAN) AS is_unique,
       false AS usable, false AS chosen FROM positions
UNION ALL SELECT 'id', 'oid', 2, 0, min(oid), count(*) = count(DISTINCT oid), true, true FROM positions
UNION ALL SELECT 'id', 'entity', 3, 0, min(entity), count(*) = count(DISTINCT entity), false, false FROM positions
UNION ALL SELECT 'time', 'event_date', 1, 0, NULL, NULL, true, true
UNION ALL SELECT 'time', 'ts', 2, 0, NULL, NULL, true, false
""")
def discovered(spark, sf_dir):
    return discover_columns(positions(spark, sf_dir).withColumn("event_date", F.to_date("ts")))


@case("m3_minimum_scale", """
SELECT c_nationkey, count(*) * 200000 AS row_count, CAST(CASE WHEN count(*) * 200000 < 10000000 THEN NULL WHEN count(*) * 200000 <= 1000000000 THEN 8 ELSE 11 END AS INT) AS zoom_from,
       CAST(CASE WHEN count(*) * 200000 < 10000000 THEN NULL WHEN count(*) * 200000 <= 1000000000 THEN 2311162 ELSE 288895 END AS BIGINT) AS min_scale
FROM customer GROUP BY 1
""")
def scales(spark, sf_dir):
    sizes = read(spark, sf_dir, "customer").groupBy("c_nationkey").agg((F.count(F.lit(1)) * 200000).alias("row_count"))
    return minimum_scale(sizes).select("c_nationkey", "row_count", "zoom_from", "min_scale")


@case("j_scalar_functions", """
SELECT o_orderkey, epoch_ms(o_orderdate) AS ms, strftime(o_orderdate, '%Y-%m-%d') AS day, epoch_ms(o_orderdate) AS back_ms,
       greatest(o_orderkey, o_custkey) AS larger, abs(o_orderkey + 9007199254740000) <= 9007199254740991 AS safe FROM orders
""")
def scalars(spark, sf_dir):
    df = read(spark, sf_dir, "orders")
    kind = df.schema["o_orderdate"].dataType
    ms = epoch_ms(F.col("o_orderdate"), kind)
    return df.select("o_orderkey", ms.alias("ms"), F.to_date("o_orderdate").cast("string").alias("day"),
                     F.unix_millis(F.timestamp_millis(ms)).alias("back_ms"), F.greatest("o_orderkey", "o_custkey").alias("larger"),
                     (F.abs(F.col("o_orderkey") + 9007199254740000) <= 9007199254740991).alias("safe"))
