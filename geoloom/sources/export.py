"""Export: GeoJSON Lines or Parquet with a WKT column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions.crs import unwrap_dateline
from geoloom.functions.geometry import BBOX, as_geojson, as_wkt
from geoloom.operators.projection import normalize_columns

_JSON = {
    "ignoreNullFields": "false",
    "timeZone": "UTC",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'",
}


def feature_json(df: DataFrame, geom: str = "geom", id_field: str | None = None) -> Column:
    """One GeoJSON Feature per row; a missing geometry is null and the id is a whole number."""
    names = [c for c in df.columns if c != geom and c not in BBOX]
    fields = [F.col(c).try_cast("long").alias(c) if c == id_field else F.col(c) for c in names]
    properties = F.to_json(F.struct(*fields), _JSON) if fields else F.lit("{}")
    shape = F.coalesce(as_geojson(F.col(geom)), F.lit("null"))
    return F.concat(F.lit('{"type":"Feature","properties":'), properties, F.lit(',"geometry":'), shape, F.lit("}"))


def export_features(df: DataFrame, path: str, fmt: str = "geojson", geom: str = "geom",
                    id_field: str | None = None) -> None:
    """Write features: `geojson` gives one Feature per line, `wkt` Parquet with the geometry as text.

    Other geometries become EWKT and bytes hex; nested values are JSON in GeoJSON and stay as they are in Parquet.
    """
    df = normalize_columns(df, geom, nested=False)
    if fmt.lower() == "geojson":
        ready = df.withColumn(geom, unwrap_dateline(F.col(geom)))
        ready.select(feature_json(ready, geom, id_field).alias("value")).write.text(path)
    elif fmt.lower() == "wkt":
        df.withColumn(geom, as_wkt(F.col(geom))).drop(*BBOX).write.parquet(path)
    else:
        raise ValueError(f"Unknown export format {fmt!r}; expected geojson or wkt")
