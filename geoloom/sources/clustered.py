"""Clustered writing: files ordered by date, then by place, so that a filter on either skips files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, VariantType

from geoloom.functions.cells import morton
from geoloom.functions.geometry import BBOX


Extent = tuple[float, float, float, float]


def measured_extent(df: DataFrame) -> Extent:
    """The box around all rows, whatever their coordinates."""
    lows, highs = [F.min(c) for c in BBOX[:2]], [F.max(c) for c in BBOX[2:]]
    row = df.agg(*lows, *highs).first()
    return tuple(row) if row[0] is not None else (-180.0, -90.0, 180.0, 90.0)


def clustered(df: DataFrame, by: str, tie: str, extent: Extent | None = None, partitions: int | None = None) -> DataFrame:
    """Range-partition and sort on (date, place, tie); places are cells of `extent`, by default the box around all rows.

    Ranges are cut on all three, so a day or a single place that holds a large
    share of the rows still spreads over many files.
    """
    x0, y0, x1, y1 = extent or measured_extent(df)
    extent = (x0, y0, x1 if x1 > x0 else x0 + 1, y1 if y1 > y0 else y0 + 1)  # all in one column or row of places
    xmin, ymin, xmax, ymax = (F.col(c) for c in BBOX)
    keyed = df.withColumn("_place", morton((xmin + xmax) / 2, (ymin + ymax) / 2, *extent))
    order = [F.col(by), F.col("_place"), F.col(tie)]
    spread = keyed.repartitionByRange(partitions, *order) if partitions else keyed.repartitionByRange(*order)
    return spread.sortWithinPartitions(*order).drop("_place")


def write_clustered(df: DataFrame, path: str, by: str, tie: str, extent: Extent | None = None, partitions: int | None = None) -> None:
    """Write Parquet in folders per date, clustered by place inside them; `compact` merges the files that later writes add."""
    clustered(df, by, tie, extent, partitions).write.partitionBy(by).parquet(path)


def write_clustered_table(df: DataFrame, name: str, by: str, tie: str, extent: Extent | None = None) -> None:
    """The same as a catalog table, with statistics for the planner."""
    spark: SparkSession = df.sparkSession
    clustered(df, by, tie, extent).write.partitionBy(by).format("parquet").saveAsTable(name)
    plain = [f"`{f.name}`" for f in df.schema if isinstance(f.dataType, AtomicType) and not isinstance(f.dataType, VariantType)]
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {', '.join(plain)}")
