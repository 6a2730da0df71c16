"""Geometry tables derived from the given ones, in Spark and as SQL with the same arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom import Layer
from geoloom.functions.geometry import box, line, with_bounds

POSITIONS = """
SELECT event_id + 1 AS oid, event_id AS raw_id, user_id AS entity, ts, event_type, value AS speed,
       ((event_id * 7919) % 36000) / 1e2 - 180e0 AS lon, ((event_id * 104729) % 17000) / 1e2 - 85e0 AS lat
FROM events
"""

ZONES = """
SELECT n_nationkey AS zone_id, n_name AS zone_name, (n_nationkey % 5) * 70e0 - 140e0 AS cx,
       CAST(floor(n_nationkey / 5e0) AS INT) * 28e0 - 56e0 AS cy
FROM nation
"""

BOXES = """
SELECT c_custkey AS oid, c_mktsegment AS segment, CAST((c_custkey * 37) % 300 - 150 AS DOUBLE) AS x0,
       CAST((c_custkey * 53) % 120 - 60 AS DOUBLE) AS y0,
       CAST((c_custkey * 37) % 300 - 150 + 5 + (c_custkey * 7) % 90 AS DOUBLE) AS x1,
       CAST((c_custkey * 53) % 120 - 60 + 5 + (c_custkey * 11) % 50 AS DOUBLE) AS y1
FROM customer
"""

SEGMENTS = """
SELECT c_custkey AS oid, CAST((c_custkey * 41) % 300 - 150 AS DOUBLE) AS x0,
       CAST((c_custkey * 41) % 300 - 150 + 3 + (c_custkey * 13) % 120 AS DOUBLE) AS x1,
       CAST((c_custkey * 59) % 120 - 60 AS DOUBLE) AS y
FROM customer
"""

WITH = f"WITH positions AS ({POSITIONS}), zones AS ({ZONES}), boxes AS ({BOXES}), segments AS ({SEGMENTS}) "

HALF_WIDTH, HALF_HEIGHT = 31.007, 12.003


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points in time from events."""
    e = F.col("event_id")
    return read(spark, sf_dir, "events").select(
        (e + 1).alias("oid"), e.alias("raw_id"), F.col("user_id").alias("entity"), "ts", "event_type", F.col("value").alias("speed"),
        (((e * 7919) % 36000) / F.lit(100.0) - 180).alias("lon"), (((e * 104729) % 17000) / F.lit(100.0) - 85).alias("lat"))


def position_layer(spark: SparkSession, sf_dir: str, **options) -> Layer:
    given = {"id_field": "oid", "time_field": "ts", "name": "positions", **options}
    return Layer.points(positions(spark, sf_dir), "lon", "lat", **given)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diamonds from nations."""
    k = F.col("n_nationkey")
    cx, cy = F.col("cx"), F.col("cy")
    base = read(spark, sf_dir, "nation").select(
        k.alias("zone_id"), F.col("n_name").alias("zone_name"), ((k % 5) * F.lit(70.0) - 140).alias("cx"),
        (F.floor(k / 5).cast("int") * F.lit(28.0) - 56).alias("cy"))
    corners = [(cx + HALF_WIDTH, cy), (cx, cy + HALF_HEIGHT), (cx - HALF_WIDTH, cy), (cx, cy - HALF_HEIGHT), (cx + HALF_WIDTH, cy)]
    ring = line(*corners)["parts"]
    shape = F.struct(F.lit("Polygon").alias("type"), F.lit(4326).alias("srid"), ring.alias("parts"))
    return with_bounds(base.withColumn("geom", shape))


def box_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    x0, y0 = (k * 37) % 300 - 150, (k * 53) % 120 - 60
    return read(spark, sf_dir, "customer").select(
        k.alias("oid"), F.col("c_mktsegment").alias("segment"), x0.cast("double").alias("x0"), y0.cast("double").alias("y0"),
        (x0 + 5 + (k * 7) % 90).cast("double").alias("x1"), (y0 + 5 + (k * 11) % 50).cast("double").alias("y1"))


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rectangles from customers."""
    return with_bounds(box_values(spark, sf_dir).withColumn("geom", box(*map(F.col, ("x0", "y0", "x1", "y1")))))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Horizontal lines from customers."""
    k = F.col("c_custkey")
    x0 = (k * 41) % 300 - 150
    values = read(spark, sf_dir, "customer").select(
        k.alias("oid"), x0.cast("double").alias("x0"), (x0 + 3 + (k * 13) % 120).cast("double").alias("x1"),
        ((k * 59) % 120 - 60).cast("double").alias("y"))
    return with_bounds(values.withColumn("geom", line((F.col("x0"), F.col("y")), (F.col("x1"), F.col("y")))))


def mixed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geometry text of several kinds, some of it broken, one kind per event type."""
    at = F.concat_ws(" ", F.col("lon").cast("string"), F.col("lat").cast("string"))
    kind = F.col("event_type")
    text = (
        F.when(kind == "view", F.concat(F.lit("POINT("), at, F.lit(")")))
        .when(kind == "click", F.concat(F.lit("MULTIPOINT("), at, F.lit(", 0 0)")))
        .when(kind == "purchase", F.concat(F.lit("LINESTRING("), at, F.lit(", 0 0)")))
        .when(kind == "signup", F.concat(F.lit("POLYGON(("), at, F.lit(", 0 0, 1 1, 2 2))")))
    )
    return positions(spark, sf_dir).withColumn("shape_text", text)
