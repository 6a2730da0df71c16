"""Ingest: one distributed pass from a stored geometry form to the geometry struct and its box columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructType

from geoloom.functions.decode import FORMATS, decode
from geoloom.functions.geometry import BBOX, bounds, let, point, type_name, with_column_once

TABLE_NAME = re.compile(r"[A-Za-z0-9_]+(\.[A-Za-z0-9_]+){0,2}")


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by a name of one to three plain parts."""
    if not TABLE_NAME.fullmatch(name or ""):
        raise ValueError(f"Invalid table name: {name!r}; expected catalog.schema.table")
    return spark.table(name)


def resolve_format(df: DataFrame, column: str, fmt: str | None = None) -> str:
    """Stored form of a geometry column: as configured, else by a hint in its name, else by its type."""
    if fmt:
        if fmt.upper() not in FORMATS:
            raise ValueError(f"Unknown geometry format {fmt!r}; expected one of {', '.join(FORMATS)}")
        return fmt.upper()
    for hint in ("wkt", "wkb", "geojson"):
        if hint in column.lower():
            return hint.upper()
    kind = next(f.dataType for f in df.schema if f.name.lower() == column.lower())
    if isinstance(kind, StringType):
        return "WKT"
    return "WKB" if isinstance(kind, BinaryType) else "GEOMETRY"


def decode_column(df: DataFrame, column: str, fmt: str | None = None, srid: int = 4326) -> Column:
    """The decoding expression; a native geometry column passes through Spark's own WKB functions."""
    form = resolve_format(df, column, fmt)
    kind = next(f.dataType for f in df.schema if f.name.lower() == column.lower())
    if form == "GEOMETRY" and not isinstance(kind, StructType):
        return decode(F.st_asbinary(F.col(column)), "WKB", srid).withField("srid", F.st_srid(F.col(column)).cast("int"))
    return decode(F.col(column), form, srid)


def with_geometry(df: DataFrame, column: str, fmt: str | None = None, srid: int = 4326, out: str = "geom") -> DataFrame:
    """All rows with the decoded geometry and its box; rows that cannot be read keep a NULL geometry.

    The value is decoded once per row, however many filters on the geometry and
    its box follow.
    """
    decoded = decode_column(df, column, fmt, srid)
    if resolve_format(df, column, fmt) in ("WKT", "GEOJSON", "ESRIJSON"):
        staged = with_column_once(df, "_decoded", let(decoded, _boxed))
    else:
        staged = with_column_once(df.withColumn("_raw", decoded), "_decoded", _boxed(F.col("_raw"))).drop("_raw")
    names = {out: "geom", **{c: c for c in BBOX}}
    return staged.withColumns({name: F.col("_decoded")[field] for name, field in names.items()}).drop("_decoded")


def _boxed(geom: Column) -> Column:
    return F.struct(geom.alias("geom"), *[value.alias(name) for name, value in bounds(geom).items()])


def ingest_geometry(df: DataFrame, column: str, fmt: str | None = None, srid: int = 4326,
                    out: str = "geom") -> tuple[DataFrame, DataFrame]:
    """Decode a column; give (all rows, the rows whose value could not be read).

    The first result keeps every row, as a layer must; the second is the
    quarantine to count or to look at, with the value as it came. Write the first one to Parquet before
    heavy use, so that the decoding happens once.
    """
    if out.lower() != column.lower():
        rows = with_geometry(df, column, fmt, srid, out)
        return rows, quarantine(rows, column, out)
    rows = with_geometry(df.withColumn("_value", F.col(column)), column, fmt, srid, out)
    return rows.drop("_value"), quarantine(rows, "_value", out).drop(out).withColumnRenamed("_value", column)


def quarantine(df: DataFrame, column: str, out: str = "geom") -> DataFrame:
    """Rows that hold a value which did not decode."""
    return df.filter(F.col(column).isNotNull() & F.col(out).isNull())


def with_point(df: DataFrame, lon: str, lat: str, srid: int = 4326, out: str = "geom") -> DataFrame:
    """Points from two number columns; rows without either are dropped.

    The box columns are the numbers themselves, so a spatial filter becomes a
    range on lon and lat that the scan can use.
    """
    x, y = F.col(lon).cast("double"), F.col(lat).cast("double")
    kept = df.filter(F.col(lon).isNotNull() & F.col(lat).isNotNull())
    return kept.withColumns({out: point(x, y, srid), **dict(zip(BBOX, (x, y, x, y)))})


def profile_geometry(df: DataFrame, column: str, fmt: str | None = None, srid: int = 4326) -> DataFrame:
    """Rows per (format, type, srid) over the whole column, with missing and unreadable rows.

    SRID 0 rows are counted apart: they have a shape but no place on a map.
    """
    form = resolve_format(df, column, fmt)
    shape = F.col("_shape")
    staged = df.select(F.col(column).isNull().alias("_missing"), decode_column(df, column, fmt, srid).alias("_shape"))
    state = F.when(F.col("_missing"), "missing").when(shape.isNull(), "unreadable").when(
        F.coalesce(shape["srid"], F.lit(0)) == 0, "no srid").otherwise("ok")
    return (
        staged.select(F.lit(form).alias("format"), F.when(shape.isNotNull(), type_name(shape)).alias("type"),
                      shape["srid"].alias("srid"), state.alias("state"))
        .groupBy("format", "type", "srid", "state").agg(F.count(F.lit(1)).alias("n_rows"))
    )
