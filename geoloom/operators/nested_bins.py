"""Bins over nested hexagons that are merged to coarser ones without the points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.functions.nested import nested_cell, nested_parent, nested_polygon
from geoloom.operators.sketches import DISTINCT_REGISTERS, _key


def nested_bins(df: DataFrame, lon: str, lat: str, resolution: int, entity: str | None = None, speed: str | None = None, time: str | None = None) -> DataFrame:
    """Points per cell in a form that adds up: counts, sums, ranges and a sketch of the entities.

    Rows without a place are left out; NULL speeds, times and entities count as positions only. One aggregate with a partial
    step, so a cell may hold any share of the rows.
    """
    cell = nested_cell(F.col(lon).cast("double"), F.col(lat).cast("double"), resolution)
    measures = [F.count(F.lit(1)).alias("total_positions")]
    if entity:
        measures.append(F.hll_sketch_agg(_key(df, entity), F.lit(DISTINCT_REGISTERS)).alias("entity_sketch"))
    if speed:
        measures += [F.coalesce(F.sum(F.col(speed).cast("double")), F.lit(0.0)).alias("speed_sum"), F.count(speed).alias("speed_count"), F.max(speed).alias("max_speed")]
    if time:
        measures += [F.min(time).alias("earliest"), F.max(time).alias("latest")]
    kept = df.filter(F.col(lon).isNotNull() & F.col(lat).isNotNull())
    return kept.groupBy(cell.alias("cell")).agg(*measures)


def parent_bins(bins: DataFrame, resolution: int, parent: int) -> DataFrame:
    """Bins of a coarser resolution out of finer ones, as direct binning by the parent gives them."""
    merge = {
        "total_positions": F.sum, "speed_sum": F.sum, "speed_count": F.sum, "max_speed": F.max, "earliest": F.min, "latest": F.max,
        "entity_sketch": F.hll_union_agg,
    }
    measures = [merge[c](c).alias(c) for c in bins.columns if c != "cell"]
    return bins.groupBy(nested_parent(F.col("cell"), resolution, parent).alias("cell")).agg(*measures)


def finished_bins(bins: DataFrame, resolution: int) -> DataFrame:
    """What a reader wants of bins: distinct entities (within `distinct_error()`), mean speed, and the outline of each cell."""
    out = bins
    if "entity_sketch" in bins.columns:
        out = out.withColumn("unique_entities", F.hll_sketch_estimate("entity_sketch")).drop("entity_sketch")
    if "speed_sum" in bins.columns:
        out = out.withColumn("avg_speed", F.when(F.col("speed_count") > 0, F.col("speed_sum") / F.col("speed_count"))).drop("speed_sum", "speed_count")
    return out.withColumn("cell_polygon", nested_polygon(F.col("cell"), resolution))
