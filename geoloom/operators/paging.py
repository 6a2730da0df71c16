"""Sorting, pages, samples, id lists, distinct values and top-k."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoloom.operators.ranking import with_position
from geoloom.runtime import broadcast_if_small

# Sorting the rows before a page in one task is fine up to here; further down, positions are counted instead.
TOP_ROWS = 100_000
# Files that the rows of a far page are looked for in by name; a page from more of them is read from all.
MOST_FILES = 1000
EXCEEDED = "exceeded_transfer_limit"


class TooManyRows(ValueError):
    """A complete answer would pass its ceiling; it is refused rather than cut."""

    code = 400


def sort_columns(df: DataFrame, order_by: str | None, unique: str | None = None) -> list[Column]:
    """`field [ASC|DESC]` list to sort columns, ascending by default, NULLs lowest.

    With `unique` the id follows as last key, so that pages do not overlap.
    """
    known = {c.lower(): c for c in df.columns}
    keys, named = [], set()
    for item in (order_by or "").split(","):
        words = item.split()
        name = re.sub(r"[^A-Za-z0-9_]", "", words[0]).lower() if words else ""
        if not name:
            continue
        if name not in known:
            raise ValueError(f"Unknown sort field: {words[0]}")
        down = len(words) > 1 and words[1].upper() == "DESC"
        keys.append(F.col(known[name]).desc_nulls_last() if down else F.col(known[name]).asc_nulls_first())
        named.add(name)
    if unique and unique.lower() not in named:
        keys.append(F.col(known[unique.lower()]).asc_nulls_first())
    return keys


def order_by(df: DataFrame, fields: str) -> DataFrame:
    keys = sort_columns(df, fields)
    return df.orderBy(*keys) if keys else df


def page_size(requested: int | None, most: int) -> int:
    """Rows per page: as asked for, at most the layer's limit; less than one means the limit. 0 is a page of all rows."""
    if most < 1:
        return max(0, requested or 0)
    return most if requested is None or requested < 1 else min(requested, most)


@dataclass(frozen=True)
class Page:
    """One page and, as a one-row table, whether more rows follow."""

    rows: DataFrame
    exceeded: DataFrame


def _has_locator(df: DataFrame) -> bool:
    """Whether rows come straight from files, so that a file and a row number name them."""
    if {"_file", "_row", "_metadata"} & set(df.columns):
        return False
    try:
        return {"file_path", "row_index"} <= set(df.select("_metadata").schema[0].dataType.names)
    except AnalysisException:
        return False


def between_positions(df: DataFrame, keys: list[Column], low: int, high: int, names: list[str] | None = None) -> DataFrame:
    """Rows at the positions low .. high - 1 in the order of `keys`, with `_position`.

    If `names` are the columns that the keys look at and rows come from files,
    only those columns and a locator (file, row number) are ordered and fixed; the
    rows of the page are then read back from the files it touches.
    """
    place = F.col("_position")
    if names is None or not _has_locator(df):
        return with_position(df, keys, "_position").filter((place >= low) & (place < high))
    locator = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    thin = with_position(df.select(*names, *locator), keys, "_position").filter((place >= low) & (place < high)).select("_file", "_row", "_position")
    files = [r["_file"] for r in thin.select("_file").distinct().limit(MOST_FILES + 1).collect()]
    rows = df.select(*df.columns, *locator)
    if len(files) <= MOST_FILES:
        rows = rows.filter(F.col("_file").isin(files))
    return rows.join(broadcast_if_small(thin, F.octet_length("_file") + 24), ["_file", "_row"]).select(*df.columns, "_position")


def page(df: DataFrame, keys: list[Column], size: int, offset: int = 0, top_rows: int = TOP_ROWS, names: list[str] | None = None) -> Page:
    """Rows offset+1 .. offset+size in the order of `keys`; `names` are the columns that the keys look at, if known.

    Near pages keep only the best rows per partition; far ones are cut by
    counted positions, so no task sorts everything that comes before. Size 0
    takes all rows after the offset, which stay as many tasks as they were.
    """
    offset = max(0, offset)
    if not size:
        rows = with_position(df, keys, "_position").filter(F.col("_position") >= offset).drop("_position") if offset and keys else df
        nothing = df.sparkSession.range(1).select(F.lit(False).alias(EXCEEDED))
        return Page(rows.orderBy(*keys) if keys else rows, nothing)
    if not keys:
        rows = df.offset(offset).limit(size) if offset else df.limit(size)
    elif offset + size <= top_rows:
        ordered = df.orderBy(*keys)
        rows = (ordered.offset(offset) if offset else ordered).limit(size)
    else:
        rows = between_positions(df, keys, offset, offset + size, names).orderBy("_position").drop("_position")
    # For a near page every task stops counting once it has seen enough.
    total = (df.limit(offset + size + 1) if offset + size <= top_rows else df).agg(F.count(F.lit(1)).alias("n"))
    return Page(rows, total.select((F.col("n") > offset + size).alias(EXCEEDED)))


def flagged_page(df: DataFrame, keys: list[Column], size: int, offset: int = 0, names: list[str] | None = None) -> DataFrame:
    """The rows of a page, each with `exceeded_transfer_limit`: one run fetches a row more and looks whether it is there.

    The window of a near page runs over that page alone. Pages that reach further are cut by counted positions, in as many
    tasks as they have ranges, and the flag is whether the position after the page is taken.
    """
    if not size:
        return page(df, keys, 0, offset).rows.withColumn(EXCEEDED, F.lit(False))
    offset = max(0, offset)
    if keys and offset + size >= TOP_ROWS:
        place = F.col("_position")
        cut = between_positions(df, keys, offset, offset + size + 1, names)
        more = not cut.filter(place == offset + size).isEmpty()
        return cut.filter(place < offset + size).orderBy(place).drop("_position").withColumn(EXCEEDED, F.lit(more))
    ahead = page(df, keys, size + 1, offset).rows
    row = F.row_number().over(W.orderBy(*(keys or [F.lit(1)])))
    counted = ahead.withColumns({"_row": row, EXCEEDED: F.count(F.lit(1)).over(W.partitionBy(F.lit(1))) > size})
    return counted.filter(F.col("_row") <= size).drop("_row")


def sample_page(df: DataFrame, size: int) -> DataFrame:
    """Any `size` rows, for map tiles: no sort, and the scan stops early."""
    return df.limit(size) if size else df


def top_k(df: DataFrame, by: str, k: int, tie: str | None = None) -> DataFrame:
    keys = [F.col(by).desc_nulls_last()] + ([F.col(tie).asc_nulls_first()] if tie else [])
    return df.orderBy(*keys).limit(k)


def _checked(df: DataFrame, ceiling: int, what: str) -> DataFrame:
    if ceiling > 0 and df.limit(ceiling + 1).count() > ceiling:
        raise TooManyRows(f"The query matches more than {ceiling} {what}; narrow it with a filter")
    return df


def ids_only(df: DataFrame, id_field: str, ceiling: int = 0) -> DataFrame:
    """Every matching id, or an error above the ceiling (0 = no ceiling)."""
    return _checked(df.select(id_field), ceiling, "ids")


def distinct_values(df: DataFrame, fields: list[str], ceiling: int = 0) -> DataFrame:
    """Distinct combinations of the fields, or an error above the ceiling (0 = no ceiling)."""
    return _checked(df.select(*fields).distinct(), ceiling, "distinct rows")


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("count"))
