"""Layer: a lazy table with a geometry, an id and optionally a time column."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from geoloom.functions.geometry import BBOX
from geoloom.plans.guard import check_identifier
from geoloom.sources.ingest import scan_table, with_geometry, with_point


@dataclass(frozen=True)
class Layer:
    """What feature queries and edits need to know about a table.

    `df` holds the geometry struct in column `geometry` and its four box columns.
    `geometry_type="Point"` promises single points, which keeps every spatial
    test in the JVM. `date_field` names a partition column with the UTC date of
    `time_field`. `plain` holds the same rows before decoding; queries that need
    no geometry read it instead. Answers are complete unless the request asks for a page
    or the layer has a page size, `max_record_count` (0: none, the default);
    `with_exceeded` in a request, or `page`, tells whether more follow. Id lists
    and distinct values are complete; a layer may refuse answers above `max_ids`
    and `max_distinct` rows (0: never).
    """

    df: DataFrame
    id_field: str = "id"
    geometry: str = "geom"
    srid: int = 4326
    time_field: str | None = None
    date_field: str | None = None
    geometry_type: str | None = None
    max_record_count: int = 0
    max_ids: int = 0
    max_distinct: int = 0
    editable: bool = True
    name: str = "layer"
    plain: DataFrame | None = None

    def __post_init__(self) -> None:
        for column in (self.id_field, self.geometry, self.time_field):
            if column:
                check_identifier(column)
        known = {c.lower() for c in self.df.columns}
        needed = [self.id_field, self.geometry, *BBOX, *([self.time_field] if self.time_field else [])]
        missing = [c for c in needed if c.lower() not in known]
        if missing:
            raise ValueError(f"Layer {self.name} has no column {', '.join(missing)}")

    @staticmethod
    def table(spark: SparkSession, name: str, geometry: str = "geometry", fmt: str | None = None, **options) -> "Layer":
        """A layer over a catalog table; a stored text or binary geometry is decoded on the way."""
        return Layer.frame(scan_table(spark, name), geometry, fmt, name=name.split(".")[-1], **options)

    @staticmethod
    def path(spark: SparkSession, path: str, geometry: str = "geometry", fmt: str | None = None, **options) -> "Layer":
        """A layer over Parquet files."""
        return Layer.frame(spark.read.parquet(path), geometry, fmt, **options)

    @staticmethod
    def frame(df: DataFrame, geometry: str = "geometry", fmt: str | None = None, srid: int = 4326, **options) -> "Layer":
        """A layer over any DataFrame; already ingested tables (with box columns) are used as they are."""
        check_identifier(geometry)
        if set(BBOX) <= set(df.columns):
            return Layer(df, geometry=geometry, srid=srid, **options)
        return Layer(with_geometry(df, geometry, fmt, srid, out=geometry), geometry=geometry, srid=srid, plain=df, **options)

    @staticmethod
    def points(df: DataFrame, lon: str, lat: str, srid: int = 4326, geometry: str = "geom", **options) -> "Layer":
        """A point layer over two number columns."""
        return Layer(with_point(df, lon, lat, srid, geometry), geometry=geometry, srid=srid, geometry_type="Point", **options)

    def over(self, df: DataFrame) -> "Layer":
        """The same layer over other rows."""
        return replace(self, df=df, plain=None)

    def query(self, request=None, **parameters) -> DataFrame:
        """Rows for a FeatureQuery, a dict of request parameters, or keyword parameters."""
        from geoloom.plans.feature_query import run

        return run(self, request, **parameters)

    def page(self, request=None, **parameters):
        """The same as a Page: the rows and whether more follow."""
        from geoloom.plans.feature_query import feature_page, parse

        return feature_page(self, parse(request, **parameters))
