"""Feature queries: filters, projection, paging, ids, distinct values and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoloom import FeatureQuery, feature_page
from geoloom.functions.geometry import as_geojson, point
from geoloom.functions.times import epoch_ms
from geoloom.operators.filters import drop_unusable_ids, id_filter, quality_filter, time_filter, where_filter
from geoloom.operators.paging import count_rows, order_by, page, sort_columns, top_k
from geoloom.operators.projection import normalize_columns
from workload.registry import case
from workload.tables import WITH, position_layer, positions, read

DAY_10, DAY_20 = 1704844800000, 1705708800000  # 2024-01-10 and 2024-01-20, UTC
PURCHASES = {
    "where": "event_type = 'purchase'", "time": f"{DAY_10},{DAY_20}", "geometry": "-120,-60,120,60",
    "spatialRel": "esriSpatialRelIntersects", "outFields": "oid,entity,speed", "orderByFields": "oid", "resultRecordCount": "100",
}


def purchases_page(spark, sf_dir):
    """Purchases in one box and ten days, ordered by id, 100 per page, as GeoJSON."""
    rows = position_layer(spark, sf_dir).query(PURCHASES)
    return rows.select("oid", "entity", "speed", as_geojson(F.col("geom")).alias("geometry"))


@case("feature_query_page", WITH + """
SELECT oid, entity, speed, lon, lat FROM positions
WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-20'
  AND lon BETWEEN -120 AND 120 AND lat BETWEEN -60 AND 60
ORDER BY oid LIMIT 100
""")
def feature_query_page(spark, sf_dir):
    at = F.from_json("geometry", "type string, coordinates array<double>")["coordinates"]
    return purchases_page(spark, sf_dir).select("oid", "entity", "speed", at[0].alias("lon"), at[1].alias("lat"))


def everything(spark, sf_dir, **request):
    """A layer query whose page takes every row."""
    return position_layer(spark, sf_dir, max_record_count=0).query(**request)


@case("b1_field_list", WITH + "SELECT event_type, entity, oid, lon AS x, lat AS y FROM positions")
def field_list(spark, sf_dir):
    rows = everything(spark, sf_dir, out_fields=" event_type ,ENTITY")
    v = F.col("geom.parts")[0][0][0]
    return rows.select(*rows.columns[:-1], v["x"].alias("x"), v["y"].alias("y"))


@case("b2_star", WITH + "SELECT oid, raw_id, entity, epoch_us(ts) // 1000 AS ts_ms, event_type, speed, lon, lat, 'Point' AS kind FROM positions")
def star(spark, sf_dir):
    rows = everything(spark, sf_dir)
    kind = rows.schema["ts"].dataType
    return rows.withColumns({"ts_ms": epoch_ms(F.col("ts"), kind), "kind": F.col("geom.type")}).drop("ts", "geom")


@case("b3_without_geometry", WITH + "SELECT entity, speed, oid FROM positions")
def without_geometry(spark, sf_dir):
    return everything(spark, sf_dir, out_fields="entity,speed", return_geometry=False)


@case("b4_where", WITH + """
SELECT oid, entity, speed FROM positions
WHERE (event_type = 'purchase' OR speed > 200 AND event_type LIKE 'v%') AND lon BETWEEN -60 AND 60 AND lat BETWEEN -30 AND 30
""")
def where(spark, sf_dir):
    """An OR in the condition stays apart from the other filters; words inside quotes are data."""
    kept = where_filter(position_layer(spark, sf_dir).df, "event_type = 'purchase' OR speed > 200 AND event_type LIKE 'v%' AND event_type <> 'x; drop'")
    return kept.filter("_xmin BETWEEN -60 AND 60 AND _ymin BETWEEN -30 AND 30").select("oid", "entity", "speed")


@case("b5_object_ids", WITH + "SELECT oid, entity FROM positions WHERE oid IN (3, 7, 11, 200, 999)")
def object_ids(spark, sf_dir):
    return id_filter(position_layer(spark, sf_dir).df, "oid", "3, 7,,11,abc,1.5,200,9007199254740993,999,99999999").select("oid", "entity")


@case("b6_time_range", WITH + """
SELECT oid, epoch_us(ts) // 1000 AS ts_ms FROM positions WHERE ts >= TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-20'
""")
def time_range(spark, sf_dir):
    df = time_filter(position_layer(spark, sf_dir).df, "ts", f"{DAY_10},{DAY_20}")
    return df.select("oid", epoch_ms(F.col("ts"), df.schema["ts"].dataType).alias("ts_ms"))


@case("b6_time_open", WITH + "SELECT oid, entity FROM positions WHERE ts <= TIMESTAMP '2024-01-05 12:00:00'")
def time_open(spark, sf_dir):
    return time_filter(position_layer(spark, sf_dir).df, "ts", "null,1704456000000").select("oid", "entity")


@case("b6_time_instant", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate = TIMESTAMP '1997-05-28'")
def time_instant(spark, sf_dir):
    return time_filter(read(spark, sf_dir, "orders"), "o_orderdate", "864777600000").select("o_orderkey", "o_custkey")


@case("b6_time_dates", """
SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1997-05-28' AND CAST(o_orderdate AS DATE) <= DATE '1997-06-30'
""")
def time_dates(spark, sf_dir):
    """On a date column a bound inside a day takes in the whole day."""
    dated = read(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    return time_filter(dated, "day", "864810000000,867672000000").select("o_orderkey")


@case("b8_unusable_ids", "SELECT event_id FROM events WHERE event_id <> 0")
def unusable_ids(spark, sf_dir):
    return drop_unusable_ids(read(spark, sf_dir, "events").select("event_id"), "event_id")


@case("b8_unusable_ids_page", "SELECT event_id FROM events WHERE event_id <> 0 ORDER BY event_id LIMIT 49")
def unusable_ids_page(spark, sf_dir):
    """The page is cut first, so it may come out one row short."""
    layer = position_layer(spark, sf_dir, id_field="raw_id")
    rows = layer.query(FeatureQuery(result_record_count=50, drop_unusable_ids=True, out_fields="raw_id", return_geometry=False))
    return rows.select(F.col("raw_id").alias("event_id"))


@case("b9_quality", WITH + "SELECT oid, lon * 1.1e0 AS x, lat * 1.2e0 AS y FROM positions WHERE abs(lat * 1.2e0) <= 85 AND abs(lon * 1.1e0) <= 180")
def quality(spark, sf_dir):
    wide = positions(spark, sf_dir).select("oid", (F.col("lon") * F.lit(1.1)).alias("x"), (F.col("lat") * F.lit(1.2)).alias("y"))
    return quality_filter(wide, "x", "y")


@case("b10_output_columns", WITH + r"""
SELECT oid, concat('{"entity":', entity, ',"raw_id":', raw_id, '}') AS info, concat('[', entity, ',', oid, ']') AS list, upper(hex(event_type)) AS bytes,
       concat('SRID=4326;POINT(', regexp_replace(CAST(lon AS VARCHAR), '\.0$', ''), ' ', regexp_replace(CAST(lat AS VARCHAR), '\.0$', ''), ')') AS other
FROM positions
""")
def output_columns(spark, sf_dir):
    nested = positions(spark, sf_dir).select(
        "oid", F.struct("entity", "raw_id").alias("info"), F.array("entity", "oid").alias("list"),
        F.col("event_type").cast("binary").alias("bytes"), point(F.col("lon"), F.col("lat")).alias("other"))
    return normalize_columns(nested)


@case("b10_layer_answer", WITH + r"""
SELECT oid, concat('{"entity":', entity, ',"raw_id":', raw_id, '}') AS info, upper(hex(event_type)) AS bytes,
       concat('SRID=4326;POINT(', regexp_replace(CAST(lat AS VARCHAR), '\.0$', ''), ' ', regexp_replace(CAST(lat AS VARCHAR), '\.0$', ''), ')') AS other
FROM positions WHERE lon BETWEEN -60 AND 60
""")
def layer_answer(spark, sf_dir):
    """Nested values, bytes and a second geometry in the answer of a layer."""
    layer = position_layer(spark, sf_dir)
    wide = layer.df.withColumns({"info": F.struct("entity", "raw_id"), "bytes": F.col("event_type").cast("binary"), "other": point(F.col("lat"), F.col("lat"))})
    return layer.over(wide).query({"outFields": "oid,info,bytes,other", "geometry": "-60,-90,60,90", "returnGeometry": "false"})


@case("e1_count", WITH + "SELECT count(*) AS count FROM positions WHERE event_type IN ('view', 'click') AND lon BETWEEN -90 AND 90 AND lat BETWEEN -45 AND 45")
def count(spark, sf_dir):
    return position_layer(spark, sf_dir).query({
        "where": "event_type IN ('view', 'click')", "geometry": "-90,-45,90,45", "returnCountOnly": "true",
        "orderByFields": "ts", "resultOffset": "10"})


@case("e1_count_all", "SELECT count(*) AS count FROM lineitem")
def count_all(spark, sf_dir):
    return count_rows(read(spark, sf_dir, "lineitem"))


@case("e1_count_distinct", "SELECT count(DISTINCT event_type) AS count FROM events")
def count_distinct(spark, sf_dir):
    return position_layer(spark, sf_dir).query(
        out_fields="event_type", return_geometry=False, return_count_only=True, return_distinct_values=True, count_distinct=True)


@case("d3_large_id_list", WITH + "SELECT oid, entity FROM positions WHERE oid IN (SELECT l_partkey * 3 FROM lineitem)")
def large_id_list(spark, sf_dir):
    wanted = read(spark, sf_dir, "lineitem").select((F.col("l_partkey") * 3).alias("id"))
    return id_filter(position_layer(spark, sf_dir).df, "oid", wanted).select("oid", "entity")


@case("g1_order_by", WITH + "SELECT event_type, speed, oid FROM positions")
def ordered(spark, sf_dir):
    return order_by(positions(spark, sf_dir).select("event_type", "speed", "oid"), "event_type, speed DESC, o;id asc")


@case("g2_page", WITH + """
SELECT oid, speed FROM positions WHERE event_type <> 'error' ORDER BY speed DESC NULLS LAST, oid LIMIT 50 OFFSET 100
""")
def second_page(spark, sf_dir):
    return position_layer(spark, sf_dir).query(
        where="event_type <> 'error'", order_by_fields="speed DESC", result_offset=100, result_record_count=50,
        out_fields="oid,speed", return_geometry=False)


@case("g2_exceeded", "SELECT count(*) > 150 AS exceeded_transfer_limit FROM events WHERE event_type <> 'error'")
def exceeded(spark, sf_dir):
    return feature_page(position_layer(spark, sf_dir), FeatureQuery(
        where="event_type <> 'error'", result_offset=100, result_record_count=50)).exceeded


@case("g2_page_with_flag", WITH + """
, kept AS (SELECT oid, speed FROM positions WHERE event_type <> 'error')
SELECT oid, speed, (SELECT count(*) FROM kept) > 150 AS exceeded_transfer_limit FROM kept ORDER BY speed DESC NULLS LAST, oid LIMIT 50 OFFSET 100
""")
def flagged_second_page(spark, sf_dir):
    """The page tells whether more rows follow, out of one run."""
    return position_layer(spark, sf_dir).query(
        where="event_type <> 'error'", order_by_fields="speed DESC", result_offset=100, result_record_count=50,
        out_fields="oid,speed", return_geometry=False, with_exceeded=True)


@case("g2_far_page", "SELECT l_orderkey, l_partkey, l_linenumber, l_quantity FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_suppkey, l_extendedprice LIMIT 500 OFFSET 4000")
def far_page(spark, sf_dir):
    """A page far down, cut by counted positions instead of a sort of all rows before it."""
    df = read(spark, sf_dir, "lineitem")
    keys = sort_columns(df, "l_orderkey, l_linenumber, l_partkey, l_quantity, l_suppkey, l_extendedprice")
    names = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_suppkey", "l_extendedprice"]
    return page(df, keys, 500, 4000, top_rows=1000, names=names).rows.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")


@case("g3_tile_sample", "SELECT least(count(*), 2000) AS n_rows, CAST(0 AS BIGINT) AS n_outside FROM events WHERE event_type = 'view'")
def tile_sample(spark, sf_dir):
    rows = position_layer(spark, sf_dir).query({"where": "event_type = 'view'", "resultType": "tile", "orderByFields": "oid"})
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("event_type") != "view").alias("n_outside"))


@case("g4_ids_only", WITH + "SELECT oid FROM positions WHERE speed > 100")
def all_ids(spark, sf_dir):
    return position_layer(spark, sf_dir).query({"where": "speed > 100", "returnIdsOnly": "true", "resultOffset": "5"})


@case("g5_distinct_values", "SELECT DISTINCT user_id AS entity, event_type FROM events")
def distinct(spark, sf_dir):
    return position_layer(spark, sf_dir).query({
        "outFields": "entity,event_type", "returnGeometry": "false", "returnDistinctValues": "true"})


@case("g6_top_k", WITH + "SELECT oid, speed FROM positions ORDER BY speed DESC NULLS LAST, oid LIMIT 25")
def top(spark, sf_dir):
    return top_k(positions(spark, sf_dir).select("oid", "speed"), "speed", 25, "oid")
