"""Layer catalog, column discovery and minimum scale."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType,
    TimestampNTZType, TimestampType,
)

from geoloom.functions.crs import MERCATOR_CODES, WEB_MERCATOR_MAX
from geoloom.functions.geometry import GEOMETRY_TYPES, type_name
from geoloom.functions.times import epoch_ms
from geoloom.operators.aggregates import extent_columns, id_class
from geoloom.operators.projection import attribute_columns
from geoloom.plans.layer import Layer

INTEGERS = (ByteType, ShortType, IntegerType, LongType)
#: Relative standard deviation of the sketched distinct counts that tell which columns repeat.
DISTINCT_DEVIATION = 0.02
ZOOM_ZERO_SCALE = 591657527.591555

# Row-count bands with the zoom range suggested for point layers, without and with a time window.
SCALE_BANDS = ((10_000_000, None, None), (1_000_000_000, (8, 8), (8, 8)), (None, (11, 12), (8, 10)))

CATALOG_DDL = (
    "name string, id_field string, geometry_field string, srid int, max_record_count int, "
    "fields array<struct<name:string,type:string,nullable:boolean>>, geometry_type string, row_count bigint, "
    "xmin double, ymin double, xmax double, ymax double, t0 bigint, t1 bigint, min_id bigint, max_id bigint, "
    "null_ids bigint, id_class string, extent_known boolean, computed_at timestamp, status string"
)


def field_type(kind: DataType) -> str:
    """Field type name in layer information."""
    if isinstance(kind, (*INTEGERS, BooleanType)):
        return "esriFieldTypeInteger"
    if isinstance(kind, (FloatType, DoubleType, DecimalType)):
        return "esriFieldTypeDouble"
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        return "esriFieldTypeDate"
    return "esriFieldTypeString"


def layer_fields(layer: Layer) -> list[tuple[str, str, bool]]:
    """Name, type and nullability of each attribute; only the id is required."""
    names = set(attribute_columns(layer.df, layer.geometry))
    return [(f.name, field_type(f.dataType), f.name.lower() != layer.id_field.lower()) for f in layer.df.schema if f.name in names]


def world_extent(srid: int) -> tuple[float, float, float, float] | None:
    """The whole world where that has a meaning: degrees and Web Mercator."""
    if srid == 4326:
        return -180.0, -90.0, 180.0, 90.0
    if srid in MERCATOR_CODES:
        return -WEB_MERCATOR_MAX, -WEB_MERCATOR_MAX, WEB_MERCATOR_MAX, WEB_MERCATOR_MAX
    return None


def _fixed(layer: Layer) -> list[Column]:
    fields = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(t).alias("type"), F.lit(z).alias("nullable"))
                       for n, t, z in layer_fields(layer)])
    return [F.lit(layer.name).alias("name"), F.lit(layer.id_field).alias("id_field"), F.lit(layer.geometry).alias("geometry_field"),
            F.lit(layer.srid).alias("srid"), F.lit(layer.max_record_count).alias("max_record_count"), fields.alias("fields")]


def layer_information(layer: Layer) -> DataFrame:
    """One catalog row from one pass over the layer."""
    geom, id_field = F.col(layer.geometry), F.col(layer.id_field)
    kinds = [F.count_if(geom.isNotNull() & (type_name(geom) == t)).alias(f"_{t}") for t in GEOMETRY_TYPES]
    times = [F.min(layer.time_field).alias("_t0"), F.max(layer.time_field).alias("_t1")] if layer.time_field else []
    one = layer.df.agg(
        F.count(F.lit(1)).alias("row_count"), *kinds, *extent_columns(layer.srid), *times,
        F.min(id_field).try_cast("long").alias("min_id"), F.max(id_field).try_cast("long").alias("max_id"),
        F.count_if(id_field.isNull()).alias("null_ids"),
    )
    most = F.greatest(*[F.col(f"_{t}") for t in GEOMETRY_TYPES])
    kind = F.lit("Point")
    for t in reversed(GEOMETRY_TYPES):
        kind = F.when((F.col(f"_{t}") == most) & (most > 0), t).otherwise(kind)
    if layer.time_field:
        time_kind = layer.df.schema[layer.time_field].dataType
        t0, t1 = epoch_ms(F.col("_t0"), time_kind), epoch_ms(F.col("_t1"), time_kind)
    else:
        t0 = t1 = F.lit(None).cast("long")
    return one.select(
        *_fixed(layer), kind.alias("geometry_type"), "row_count", "xmin", "ymin", "xmax", "ymax", t0.alias("t0"), t1.alias("t1"),
        "min_id", "max_id", "null_ids", id_class(F.col("min_id"), F.col("max_id"), F.col("null_ids")).alias("id_class"),
        F.lit(True).alias("extent_known"), F.current_timestamp().alias("computed_at"))


def unknown_information(spark: SparkSession, name: str, srid: int = 4326, status: str = "unknown") -> DataFrame:
    """Row of a layer that could not be read: the world as extent where there is one."""
    box = world_extent(srid) or (None,) * 4
    values = {"name": F.lit(name), "srid": F.lit(srid), "extent_known": F.lit(False), "computed_at": F.current_timestamp(), "status": F.lit(status),
              **{side: F.lit(v) for side, v in zip(("xmin", "ymin", "xmax", "ymax"), box)}}
    schema = spark.createDataFrame([], CATALOG_DDL).schema
    return spark.range(1).select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def refresh_catalog(spark: SparkSession, layers: dict[str, Layer | Callable[[], Layer]], path: str | None = None, srids: dict[str, int] | None = None,
                    at_once: int = 4) -> DataFrame:
    """One row per layer, each from a job of its own, `at_once` of them at a time; stored as Parquet under a new path if one is given.

    A layer may be given as a function that opens it. One that cannot be opened, or fails while it is read, gets a row marked
    `extent_known = false` with the reason in `status`, and does not stop the others. Its coordinate system is that of the
    layer or, if it could not be opened, the one that `srids` names (by default 4326). The jobs of a layer are a job group
    named after it, so they can be told apart and cancelled alone. Only the rows of the catalog pass through the driver.
    """
    schema = spark.createDataFrame([], CATALOG_DDL).schema

    def row_of(name: str, layer: Layer | Callable[[], Layer]) -> Row:
        srid = (srids or {}).get(name, 4326)
        spark.sparkContext.setJobGroup(f"catalog {name}", f"Layer information of {name}")
        try:
            opened = layer if isinstance(layer, Layer) else layer()
            srid = opened.srid
            found = layer_information(opened).withColumn("status", F.lit("ok"))
            return found.select(*[F.col(f.name).cast(f.dataType) for f in schema]).first()
        except (PySparkException, Py4JJavaError, ValueError) as error:
            logging.getLogger(__name__).warning("Layer %s cannot be read: %s", name, error)
            return unknown_information(spark, name, srid, str(error).strip().split("\n")[0][:500]).first()

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        # Each job runs under the session and the properties of the caller.
        running = [pool.submit(inheritable_thread_target(spark)(row_of), name, layer) for name, layer in layers.items()]
        rows = [job.result() for job in running]
    catalog = spark.createDataFrame(rows, schema)
    if path:
        catalog.write.parquet(path)
        return spark.read.parquet(path)
    return catalog


def _rank_ids(names: list[str]) -> list[str]:
    """objectid, id, then names ending in _id, then the others, each in table order."""
    def rank(name: str) -> int:
        low = name.lower()
        return 0 if low == "objectid" else 1 if low == "id" else 2 if low.endswith("_id") else 3
    return sorted(names, key=rank)


# Words for a moment, at the end of a word of the name.
_TIME_WORD = re.compile(r"(?i)(time|stamp|date|day|when)(?![a-z])|(_(ts|at)|(?<![a-z])dt)$")


def _rank_times(columns: list[tuple[str, DataType]]) -> list[str]:
    """Names with a word for a moment first; within those, timestamps before dates."""
    def rank(item: tuple[str, DataType]) -> tuple[bool, bool]:
        name, kind = item
        return not _TIME_WORD.search(name), isinstance(kind, DateType)
    return [name for name, _ in sorted(columns, key=rank)]


def discover_columns(df: DataFrame) -> DataFrame:
    """Candidate id and time columns in order of preference, checked on the data.

    One pass gives counts, ranges and sketched distinct counts of all candidates. An id must have no NULLs, start at 1 or
    above and be unique. A column whose range is narrower than its row count repeats, and so does one whose sketch falls
    short of the row count by six deviations. Of the others the first in order is counted distinct exactly; another one
    only where that shows repeats too few for a sketch to tell (NULL in `is_unique` means not needed).
    """
    ids = _rank_ids([f.name for f in df.schema if isinstance(f.dataType, INTEGERS)])
    times = _rank_times([(f.name, f.dataType) for f in df.schema if isinstance(f.dataType, (DateType, TimestampType, TimestampNTZType))])
    measures = [F.count(F.lit(1)).alias("n")]
    for i, name in enumerate(ids):
        measures += [F.min(name).cast("long").alias(f"lo{i}"), F.max(name).cast("long").alias(f"hi{i}"), F.count(name).alias(f"c{i}"),
                     F.approx_count_distinct(name, DISTINCT_DEVIATION).alias(f"d{i}")]
    measures += [F.count(name).alias(f"t{i}") for i, name in enumerate(times)]
    seen = df.agg(*measures).first()
    rows, chosen = [], None
    for i, name in enumerate(ids):
        lo, hi, present = seen[f"lo{i}"], seen[f"hi{i}"], seen[f"c{i}"]
        sound = present == seen.n and present > 0 and lo >= 1
        unique = None
        if present and (hi - lo + 1 < present or seen[f"d{i}"] < (1 - 6 * DISTINCT_DEVIATION) * present):
            unique = False
        elif sound and chosen is None:
            unique = df.agg(F.count_distinct(F.col(name)).alias("d")).first().d == present
        good = bool(sound and unique)
        rows.append(("id", name, i + 1, seen.n - present, lo, unique, good, good and chosen is None))
        chosen = chosen or (name if good else None)
    picked = None
    for i, name in enumerate(times):
        good = seen[f"t{i}"] > 0
        rows.append(("time", name, i + 1, seen.n - seen[f"t{i}"], None, None, good, good and picked is None))
        picked = picked or (name if good else None)
    return df.sparkSession.createDataFrame(
        rows, "role string, name string, preference int, nulls bigint, low bigint, is_unique boolean, usable boolean, chosen boolean")


def zoom_scale(zoom: Column) -> Column:
    """Map scale at a zoom level."""
    return F.round(F.lit(ZOOM_ZERO_SCALE) / F.pow(F.lit(2.0), zoom)).cast("long")


def minimum_scale(catalog: DataFrame, windowed: bool = False, rows: str = "row_count") -> DataFrame:
    """Suggested zoom range and its scales by row count; NULL below ten million rows."""
    low = high = F.lit(None).cast("int")
    for limit, free, timed in reversed(SCALE_BANDS):
        span = timed if windowed else free
        inside = F.col(rows) < limit if limit == 10_000_000 else F.col(rows) <= limit if limit else F.lit(True)
        low = F.when(inside, F.lit(span[0] if span else None).cast("int")).otherwise(low)
        high = F.when(inside, F.lit(span[1] if span else None).cast("int")).otherwise(high)
    staged = catalog.withColumns({"zoom_from": low, "zoom_to": high})
    return staged.withColumns({"min_scale": zoom_scale(F.col("zoom_from")), "min_scale_to": zoom_scale(F.col("zoom_to"))})
