"""Whole-layer summaries, cell binning and tracks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoloom.functions.cells import hex_cell, hex_polygon
from geoloom.functions.geometry import BBOX, geometry, vertex
from geoloom.functions.times import epoch_ms, utc_date
from geoloom.operators.ranking import with_position
from geoloom.plans.guard import MAX_SAFE_INTEGER
from geoloom.runtime import broadcast_if_small

MAX_OBJECT_ID = 2147483647
DAY_MINUTES = 1440


def _kind(df: DataFrame, column: str):
    return next(f.dataType for f in df.schema if f.name.lower() == column.lower())


def extent_columns(srid: int = 4326) -> list[Column]:
    lows = [F.min(F.col(c)).alias(c[1:]) for c in BBOX[:2]]
    highs = [F.max(F.col(c)).alias(c[1:]) for c in BBOX[2:]]
    return [*lows, *highs, F.when(F.count(BBOX[0]) > 0, F.lit(srid)).alias("wkid")]


def layer_extent(df: DataFrame, srid: int = 4326) -> DataFrame:
    """Box around all rows as one row; NULLs for an empty layer."""
    return df.agg(*extent_columns(srid))


def time_extent(df: DataFrame, time: str) -> DataFrame:
    """First and last time in epoch milliseconds; NULLs when there is none."""
    kind = _kind(df, time)
    return df.agg(F.min(time).alias("lo"), F.max(time).alias("hi")).select(
        epoch_ms(F.col("lo"), kind).alias("t0"), epoch_ms(F.col("hi"), kind).alias("t1"))


def cell_bins(df: DataFrame, lon: str, lat: str, resolution: int, entity: str | None = None, speed: str | None = None,
              category: str | None = None, time: str | None = None, with_counts: bool = False) -> DataFrame:
    """Points per hexagon: totals, distinct entities, speeds, categories, times and the cell outline.

    Categories come as a sorted set, or with `with_counts` as every category
    with its number of rows: the full list of a cell in a form that stays as
    small as the number of categories.
    """
    kept = df.filter(F.col(lon).isNotNull() & F.col(lat).isNotNull())
    binned = kept.withColumn("cell", hex_cell(F.col(lon).cast("double"), F.col(lat).cast("double"), resolution))
    measures = [F.count(F.lit(1)).alias("total_positions")]
    if entity:
        measures.append(F.count_distinct(F.col(entity)).alias("unique_entities"))
    if speed:
        measures += [F.avg(speed).alias("avg_speed"), F.max(speed).alias("max_speed")]
    if category and not with_counts:
        measures.append(F.sort_array(F.collect_set(F.col(category))).alias("categories"))
    if time:
        measures += [F.min(time).alias("earliest"), F.max(time).alias("latest")]
    bins = binned.groupBy("cell").agg(*measures)
    if category and with_counts:
        per_value = binned.filter(F.col(category).isNotNull()).groupBy("cell", category).agg(F.count(F.lit(1)).alias("_n"))
        lists = per_value.groupBy("cell").agg(F.sort_array(F.collect_list(
            F.struct(F.col(category).alias("value"), F.col("_n").alias("n")))).alias("categories"))
        bins = bins.join(lists, "cell", "left").withColumn(
            "categories", F.coalesce("categories", F.array().cast(lists.schema["categories"].dataType)))
    return bins.withColumn("cell_polygon", hex_polygon(F.col("cell"), resolution))


def roll_up(bins: DataFrame, least: int = 0) -> DataFrame:
    """Totals over a binned table, optionally over the cells with more than `least` rows."""
    kept = bins.filter(F.col("total_positions") > least)
    sums = [F.sum("unique_entities").alias("unique_entities")] if "unique_entities" in bins.columns else []
    return kept.agg(F.count(F.lit(1)).alias("total_cells"), F.sum("total_positions").alias("total_positions"), *sums)


def _stops(df: DataFrame, entity: str, time: str, lon: str, lat: str, speed: str | None, name: str | None, tie: str | None) -> DataFrame:
    """Positions with the entity, the UTC day and a stop that sorts by time."""
    kept = df.filter(F.col(lon).isNotNull() & F.col(lat).isNotNull() & F.col(time).isNotNull())
    order = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate([time, *([tie] if tie else []), lon, lat])])
    return kept.select(
        F.col(entity).alias("entity"), utc_date(F.col(time), _kind(df, time)).alias("track_date"), F.col(time).alias("_time"),
        F.struct(order.alias("key"), vertex(F.col(lon), F.col(lat)).alias("at")).alias("_stop"),
        *([F.col(speed).alias("_speed")] if speed else []), *([F.col(name).alias("_name")] if name else []),
    )


def _track_measures(rows: DataFrame) -> list[Column]:
    return [
        F.min("_time").alias("start_time"), F.max("_time").alias("end_time"), F.count(F.lit(1)).alias("position_count"),
        *([F.avg("_speed").alias("avg_speed")] if "_speed" in rows.columns else []),
        *([F.max("_name").alias("entity_name")] if "_name" in rows.columns else [])]


def _track_line() -> Column:
    return geometry(F.when(F.size("_path") > 1, "LineString").otherwise("Point"), F.lit(4326), F.array(F.array(F.col("_path")))).alias("geom")


def daily_tracks(df: DataFrame, entity: str, time: str, lon: str, lat: str, speed: str | None = None,
                 name: str | None = None, tie: str | None = None, slice_minutes: int = DAY_MINUTES) -> DataFrame:
    """One line per entity and UTC day through its positions in time order, with start, end, count, speed and name.

    With a shorter slice a day is cut at fixed times: one row per slice that
    holds positions, `part` is its number within the day, the measures are
    those of the slice, and its line ends at the first stop of the next slice
    of the day. A task holds one slice, so the slice is chosen by how dense the
    positions of one entity can get, never by counting them.
    """
    if slice_minutes < 1 or DAY_MINUTES % slice_minutes:
        raise ValueError(f"A slice must divide the day of {DAY_MINUTES} minutes, got {slice_minutes}")
    rows = _stops(df, entity, time, lon, lat, speed, name, tie)
    in_day = F.pmod(epoch_ms(F.col("_time"), _kind(df, time)), F.lit(DAY_MINUTES * 60_000))
    rows = rows.withColumn("part", F.floor(in_day / (slice_minutes * 60_000)).cast("long"))
    stops = F.sort_array(F.collect_list("_stop"))
    tracks = rows.groupBy("entity", "track_date", "part").agg(*_track_measures(rows), F.transform(stops, lambda s: s["at"]).alias("_path"))
    if slice_minutes < DAY_MINUTES:
        # One row per slice: at most a day's slices are in one group.
        following = F.lead(F.col("_path")[0]).over(W.partitionBy("entity", "track_date").orderBy("part"))
        tracks = tracks.withColumn("_next", following).withColumn(
            "_path", F.when(F.col("_next").isNull(), F.col("_path")).otherwise(F.array_append("_path", F.col("_next")))).drop("_next")
    return tracks.select(*[c for c in tracks.columns if c != "_path"], _track_line())


def cut_tracks(df: DataFrame, entity: str, time: str, lon: str, lat: str, max_vertices: int, speed: str | None = None,
               name: str | None = None, tie: str | None = None) -> DataFrame:
    """Daily tracks as lines of `max_vertices` steps (`part` 0, 1, ...), with the measures of the whole day on each.

    The last vertex of a line is the first of the next and every position is
    kept. All tracks are cut alike, by counted positions in a global sort.
    """
    keys = ["entity", "track_date"]
    rows = _stops(df, entity, time, lon, lat, speed, name, tie)
    summary = rows.groupBy(*keys).agg(*_track_measures(rows))
    ranked = with_position(rows.select(*keys, "_stop"), [F.col(c) for c in (*keys, "_stop")], "_at")
    begins = broadcast_if_small(ranked.groupBy(*keys).agg(F.min("_at").alias("_begin")))
    place = F.col("_at") - F.col("_begin")
    part = F.floor(place / max_vertices)
    cut = ranked.join(begins, keys).withColumn(
        "part", F.explode(F.when((place % max_vertices == 0) & (place > 0), F.array(part, part - 1)).otherwise(F.array(part))))
    path = F.transform(F.sort_array(F.collect_list("_stop")), lambda s: s["at"])
    lines = cut.groupBy(*keys, "part").agg(path.alias("_path"))
    return lines.join(summary, keys).select(*keys, "part", *[c for c in summary.columns if c not in keys], _track_line())


def table_profile(df: DataFrame, entity: str, time: str, lon: str, lat: str, approximate: bool = False) -> DataFrame:
    """Rows, distinct entities, time range and position range in one pass."""
    kind = _kind(df, time)
    distinct = F.approx_count_distinct(entity) if approximate else F.count_distinct(F.col(entity))
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"), distinct.alias("unique_entities"),
        epoch_ms(F.min(time), kind).alias("earliest_ms"), epoch_ms(F.max(time), kind).alias("latest_ms"),
        F.min(lat).alias("min_lat"), F.max(lat).alias("max_lat"), F.min(lon).alias("min_lon"), F.max(lon).alias("max_lon"),
    )


def id_class(low: Column, high: Column, missing: Column) -> Column:
    """over53 > low > over32 > ok, NULL for no rows."""
    return (
        F.when((low < -MAX_SAFE_INTEGER) | (high > MAX_SAFE_INTEGER), "over53")
        .when((low <= 0) | (missing > 0), "low")
        .when(high > MAX_OBJECT_ID, "over32")
        .when(low.isNotNull(), "ok")
    )


def id_audit(df: DataFrame, id_field: str, duplicates: bool = True) -> DataFrame:
    """Range, NULLs and repeated values of an id column, with its class."""
    column = F.col(id_field)
    present = F.count(column)
    measures = [F.min(column).cast("long").alias("min_id"), F.max(column).cast("long").alias("max_id"),
                (F.count(F.lit(1)) - present).alias("null_ids")]
    if duplicates:
        measures.append((present - F.count_distinct(column)).alias("duplicate_ids"))
    audit = df.agg(*measures)
    return audit.withColumn("id_class", id_class(F.col("min_id"), F.col("max_id"), F.col("null_ids")))
