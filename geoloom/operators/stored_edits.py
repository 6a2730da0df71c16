"""Edits of stored layers that rewrite only the files with a row that an edit names."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions.times import utc_date
from geoloom.operators.edits import VALUES_DDL, apply_edits, request_number, safe_key
from geoloom.runtime import checkpoint, fits
from geoloom.sources.clustered import clustered
from geoloom.sources.stored import FILE_BYTES, TIME_MS, StoredLayer, listed_files, listed_sizes, with_time_ms


@dataclass(frozen=True)
class StoredEdit:
    """The files of the edited layer, the results per request row, the files that were replaced and the new ones."""

    stored: StoredLayer
    results: DataFrame
    replaced: list[str]
    written: list[str]


def named_ids(stored: StoredLayer, updates: DataFrame | None, deletes: DataFrame | None) -> DataFrame:
    """Distinct ids that updates and deletes name, of those that can be ids."""
    id_field = stored.options.get("id_field", "id").lower()
    keys = []
    if updates is not None:
        sent = F.map_filter(F.from_json("attributes", VALUES_DDL), lambda k, _: F.lower(k) == id_field)
        keys.append(updates.select(safe_key(request_number(F.get(F.map_values(sent), F.lit(0)))).alias("_key")))
    if deletes is not None:
        keys.append(deletes.select(safe_key(request_number(F.col("id"))).alias("_key")))
    named = keys[0] if len(keys) == 1 else keys[0].unionByName(keys[1])
    return named.filter("_key IS NOT NULL").distinct()


def hit_files(stored: StoredLayer, keys: DataFrame) -> DataFrame:
    """Path of each file with a row of a named id: only the id column is read, and of it only the row groups in the range of the ids."""
    id_field = stored.options.get("id_field", "id")
    ends = keys.agg(F.min("_key").alias("low"), F.max("_key").alias("high")).first()
    keys = F.broadcast(keys) if fits(keys) else keys
    ids = stored.rows(F.col("_metadata.file_path").alias("_file")).select(F.col(id_field), "_file")
    if ends.low is not None:
        ids = ids.filter(F.col(id_field).between(ends.low, ends.high))
    return ids.withColumn("_key", F.col(id_field).cast("long")).join(keys, "_key", "left_semi").select("_file").distinct()


def _refreshed(stored: StoredLayer, df: DataFrame) -> DataFrame:
    """Columns that are derived from the time follow it."""
    time, date = stored.options.get("time_field"), stored.options.get("date_field")
    if not time:
        return df
    day: dict[str, Column] = {date: utc_date(F.col(time), df.schema[time].dataType)} if date else {}
    df = df.withColumns(day) if day else df
    return with_time_ms(df, time) if TIME_MS in stored.schema.names else df


def edit_stored(stored: StoredLayer, out: str, adds: DataFrame | None = None, updates: DataFrame | None = None, deletes: DataFrame | None = None,
                rollback: bool = False, file_bytes: int = FILE_BYTES) -> StoredEdit:
    """Adds, updates and deletes as `apply_edits` runs them, at the cost of the files they hit.

    The ids alone are read to find the files that hold a named row. Those files are read, edited and written anew below
    `out`, together with the adds; all others become part of the new version as they are. Nothing is written over, so readers
    of the old version go on, and a failed job leaves it untouched; the caller removes replaced files when no one reads them
    any more. If nothing changes (no row hit and nothing added, or a rollback) the version stays the same.
    """
    spark = stored.spark
    hit: set[str] = set()
    if updates is not None or deletes is not None:
        # A row per file: the files of a version are listed on the driver anyway.
        found = {r["_file"] for r in hit_files(stored, named_ids(stored, updates, deletes)).collect()}
        hit = stored.named(found)
    touched = stored.only(hit)
    top = stored.statistics().first().max_id if adds is not None else None
    layer = stored.layer(touched.rows())
    edit = apply_edits(layer, adds, updates, deletes, rollback, top=0 if adds is not None and top is None else top)
    if edit.rows is layer.df or (not hit and adds is None):
        return StoredEdit(stored, edit.results, [], [])
    old_bytes = 0
    if hit:
        old_bytes = listed_sizes(touched).agg(F.sum("bytes").alias("n")).first().n or 0
    partitions = max(1, -(-old_bytes // file_bytes)) if adds is None else None
    rows = _refreshed(stored, edit.rows).select(*stored.schema.names)
    if stored.by:
        # Fixed before the ranges are drawn: the edits run once.
        rows = clustered(checkpoint(rows), stored.by, stored.options.get("id_field", "id"), partitions=partitions)
        rows.write.partitionBy(stored.by).parquet(out)
    else:
        (rows.coalesce(partitions) if partitions else rows).write.parquet(out)
    written = listed_files(spark.read.schema(stored.schema).parquet(out))
    kept = stored.only(f for f in stored.files if f not in hit)
    groups = (*kept.groups, (out, written)) if written else kept.groups
    return StoredEdit(replace(stored, groups=groups), edit.results, sorted(hit), list(written))
