"""Column selection for feature output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StructType, VariantType

from geoloom.functions.crs import unwrap_dateline
from geoloom.functions.geometry import HIDDEN, as_ewkt, with_column_once
from geoloom.plans.guard import check_field


def is_geometry(kind: DataType) -> bool:
    return isinstance(kind, StructType) and kind.names == ["type", "srid", "parts"]


def parse_fields(out_fields: str) -> list[str]:
    return [check_field(f) for f in out_fields.split(",")]


def attribute_columns(df: DataFrame, geom: str) -> list[str]:
    """Everything but the geometry, its box columns and the stored milliseconds."""
    return [c for c in df.columns if c.lower() != geom.lower() and c not in HIDDEN]


def selected_fields(df: DataFrame, out_fields: str, id_field: str, geom: str, add_id: bool = True) -> list[str]:
    """Requested fields in request order, in the layer's spelling; the id is added at the end if it is missing."""
    known = {c.lower(): c for c in df.columns}
    names: list[str] = []
    for field in parse_fields(out_fields):
        if field == "*":
            names += attribute_columns(df, geom)
        elif field.lower() in known:
            names.append(known[field.lower()])
        else:
            raise ValueError(f"Unknown field: {field}")
    if add_id:
        names.append(known[id_field.lower()])
    return list(dict.fromkeys(n for n in names if n.lower() != geom.lower()))


def project(df: DataFrame, out_fields: str, id_field: str, geom: str = "geom", return_geometry: bool = True,
            extra: tuple[str, ...] = ()) -> DataFrame:
    """`*` or a field list; then the geometry, read only when it is asked for, and the columns that are not the table's (`extra`)."""
    if out_fields.strip() == "*":
        names = [c for c in attribute_columns(df, geom) if c not in extra]
    else:
        names = selected_fields(df, out_fields, id_field, geom)
    return df.select(*names, *([geom] if return_geometry else []), *extra)


def display_geometry(df: DataFrame, geom: str = "geom", after_sort: bool = False) -> DataFrame:
    """Geometry as clients draw it: shapes across the dateline are unwrapped. Filters use the stored form.

    Spark moves projections below a limit, and with more than one of them no
    longer sees that a sorted page only needs its best rows. `after_sort` keeps
    the work above the page; an unsorted sample streams and needs no such care.
    """
    shown = unwrap_dateline(F.col(geom))
    return with_column_once(df, geom, shown) if after_sort else df.withColumn(geom, shown)


def _plain(name: str, kind: DataType) -> Column:
    column = F.col(name)
    if is_geometry(kind):
        return as_ewkt(column)
    if isinstance(kind, (StructType, MapType, ArrayType, VariantType)):
        return F.to_json(column)
    if isinstance(kind, BinaryType):
        return F.hex(column)
    return column


def normalize_columns(df: DataFrame, keep: str | None = "geom", nested: bool = True) -> DataFrame:
    """Columns clients can show: bytes as hex, geometries other than `keep` as EWKT text and, with `nested`, other nested values as JSON."""
    def changes(kind: DataType) -> bool:
        return isinstance(kind, BinaryType) or is_geometry(kind) or nested and isinstance(kind, (StructType, MapType, ArrayType, VariantType))

    odd = {f.name for f in df.schema if f.name != keep and changes(f.dataType)}
    if not odd:
        return df
    return df.select(*[_plain(f.name, f.dataType).alias(f.name) if f.name in odd else F.col(f.name) for f in df.schema])
