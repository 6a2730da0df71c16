"""Row filters: attributes, ids, time, space and data quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions.predicates import matches
from geoloom.functions.shapes import FilterShape, filter_shape
from geoloom.functions.times import parse_instant, time_literal
from geoloom.plans.guard import check_where, parse_ids
from geoloom.runtime import fits

INLINE_IDS = 1000


def where_filter(df: DataFrame, where: str) -> DataFrame:
    """Attribute condition in Spark SQL, kept as one unit next to the other filters."""
    return df.filter(F.expr(f"({check_where(where)})"))


def id_filter(df: DataFrame, id_field: str, ids: str | list[int] | DataFrame) -> DataFrame:
    """Rows whose id is listed: request text, a list, or a table with the ids in its first column.

    Short lists are a pushed-down IN; long ones join, broadcast only when small.
    """
    if isinstance(ids, str):
        ids = parse_ids(ids)
    if isinstance(ids, DataFrame):
        wanted = ids.select(F.col(ids.columns[0]).cast("long").alias("_wanted")).filter("_wanted IS NOT NULL")
    elif not ids:
        return df.filter(F.lit(False))
    elif len(ids) <= INLINE_IDS:
        return df.filter(F.col(id_field).isin(ids))
    else:
        wanted = df.sparkSession.createDataFrame([(int(i),) for i in ids], "_wanted long")
    # A repeated id must not gather its copies in one task of a shuffled join.
    wanted = F.broadcast(wanted) if fits(wanted) else wanted.distinct()
    return df.join(wanted, F.col(id_field) == F.col("_wanted"), "left_semi")


def time_condition(df: DataFrame, time_field: str, time: str, date_field: str | None = None) -> Column | None:
    """Instant `t` (exact), closed range `t1,t2`, or a range open at `null`, in epoch milliseconds.

    `date_field` names a partition column that holds the UTC date of the time
    column; the same bounds on it prune whole folders.
    """
    pieces = str(time).split(",")
    if len(pieces) > 2:
        raise ValueError(f"Invalid time parameter: {time}")
    try:
        ends = [parse_instant(p) for p in pieces]
    except ValueError:
        raise ValueError(f"Invalid time parameter: {time}") from None
    kinds = {f.name.lower(): f.dataType for f in df.schema}
    kind = kinds[time_field.lower()]
    column = F.col(time_field)
    if len(ends) == 1:
        ends = ends * 2
        exact = [] if ends[0] is None else [column == time_literal(ends[0], kind)]
    else:
        exact = []
    low, high = ends
    terms = exact or [
        t for t in (
            None if low is None else column >= time_literal(low, kind),
            None if high is None else column <= time_literal(high, kind),
        ) if t is not None
    ]
    if date_field:
        day_kind = kinds[date_field.lower()]
        day = F.col(date_field)
        terms += [] if low is None else [day >= time_literal(low, day_kind)]
        terms += [] if high is None else [day <= time_literal(high, day_kind)]
    if not terms:
        return None
    condition = terms[0]
    for term in terms[1:]:
        condition = condition & term
    return condition


def time_filter(df: DataFrame, time_field: str | None, time: str | None, date_field: str | None = None) -> DataFrame:
    """Rows in a time window; no time column or `null,null` leaves all rows."""
    if time is None or time == "" or not time_field:
        return df
    condition = time_condition(df, time_field, time, date_field)
    return df if condition is None else df.filter(condition)


def spatial_filter(df: DataFrame, shape: str | dict | list | FilterShape, spatial_rel: str = "esriSpatialRelIntersects",
                   geom: str = "geom", srid: int = 4326, in_sr: str | int | dict | None = None, strict: bool = False,
                   geometry_type: str | None = None) -> DataFrame:
    """Rows whose geometry stands in the given relation to the shape; the column is the first argument."""
    if not isinstance(shape, FilterShape):
        shape = filter_shape(shape, srid, in_sr)
    return df.filter(matches(F.col(geom), shape, spatial_rel, strict, geometry_type))


def drop_unusable_ids(df: DataFrame, id_field: str) -> DataFrame:
    """Leave out rows whose id is 0, NULL or not a number. Meant for a page that is already cut."""
    number = F.col(id_field).try_cast("double")
    return df.filter(number.isNotNull() & (number != 0) & ~F.isnan(number))


def quality_filter(df: DataFrame, lon: str, lat: str, max_lat: float = 85.0) -> DataFrame:
    """Rows with a position that a web map can show."""
    return df.filter(F.col(lat).between(-max_lat, max_lat) & F.col(lon).between(-180.0, 180.0))


def distance_filter(df: DataFrame, x: float, y: float, radius: float, geom: str = "geom",
                    geometry_type: str | None = None, out: str = "distance") -> DataFrame:
    """Rows nearer than `radius` to a position, in the units of the coordinates, with their distance."""
    from geoloom.functions.distance import distance_to

    px, py, r = (F.lit(float(v)) for v in (x, y, radius))
    near = df.filter((F.col("_xmin") <= px + r) & (F.col("_xmax") >= px - r)
                     & (F.col("_ymin") <= py + r) & (F.col("_ymax") >= py - r))
    return near.withColumn(out, distance_to(F.col(geom), float(x), float(y), geometry_type)).filter(F.col(out) < r)
