"""Stored layers: the Parquet files that make up a table, their statistics, and compaction by day."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field, replace
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, StructType

from geoloom.functions.geometry import BBOX
from geoloom.functions.times import epoch_ms
from geoloom.plans.layer import Layer
from geoloom.sources.clustered import clustered

#: Epoch milliseconds of the time column, stored because files keep no statistics of timestamps that Spark can aggregate.
TIME_MS = "_time_ms"
#: Bytes of a file that compaction and edits aim at.
FILE_BYTES = 128 << 20
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def with_time_ms(df: DataFrame, time: str) -> DataFrame:
    """The rows with the epoch milliseconds of their time, for files whose time extent is read off their statistics."""
    return df.withColumn(TIME_MS, epoch_ms(F.col(time), df.schema[time].dataType))


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Path and bytes of each Parquet file under a folder; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    return files.select("path", F.col("length").alias("bytes"))


def listed_files(df: DataFrame) -> tuple[str, ...]:
    """Paths of the files that a table is read from, as a reader takes them."""
    return tuple(sorted(unquote(f) for f in df.inputFiles()))


def _plain(path: str) -> str:
    """A file's path without the differences in how a URI's empty authority is written."""
    return path.replace(":///", ":/")


@dataclass(frozen=True)
class StoredLayer:
    """A layer as a set of Parquet files, in groups of files below one folder: what one version of the table consists of.

    An edit gives another set, which shares the files it has not touched. All files have the same columns in the same order. `by` names the partition column. `options` are those of a Layer.
    """

    spark: SparkSession
    groups: tuple[tuple[str, tuple[str, ...]], ...]
    schema: StructType
    by: str | None = None
    options: dict = field(default_factory=dict)

    @staticmethod
    def open(spark: SparkSession, path: str, by: str | None = None, **options) -> StoredLayer:
        df = spark.read.parquet(path)
        return StoredLayer(spark, ((path, listed_files(df)),), df.schema, by, options)

    @property
    def files(self) -> list[str]:
        return [f for _, files in self.groups for f in files]

    def only(self, files: Iterable[str]) -> StoredLayer:
        kept = set(files)
        groups = ((base, tuple(f for f in held if f in kept)) for base, held in self.groups)
        return replace(self, groups=tuple(g for g in groups if g[1]))

    def named(self, paths: Iterable[str]) -> set[str]:
        """Files of the layer, as it lists them, by the paths that rows carry in `_metadata.file_path`."""
        known = {_plain(f): f for f in self.files}
        return {known.get(_plain(p)) or known[_plain(unquote(p))] for p in paths}

    def _read(self, session: SparkSession, *extra: Column) -> list[DataFrame]:
        """The rows of each group of files; `extra` columns may be those that files have beside their own."""
        return [session.read.schema(self.schema).option("basePath", base).parquet(*files).select(*self.schema.names, *extra) for base, files in self.groups]

    def rows(self, *extra: Column) -> DataFrame:
        parts = self._read(self.spark, *extra)
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], self.schema)

    def layer(self, df: DataFrame | None = None) -> Layer:
        return Layer(self.rows() if df is None else df, **self.options)

    # -- statistics ---------------------------------------------------------------------------------------------------

    @property
    def has_statistics(self) -> bool:
        """Whether the columns to aggregate stand before all nested ones, as `write_stored` puts them: the reader counts columns from the front."""
        names = {self.options.get("id_field", "id").lower(), *BBOX, TIME_MS}
        kinds = [(f.name.lower(), isinstance(f.dataType, AtomicType)) for f in self.schema if f.name != self.by]
        nested = next((i for i, (_, flat) in enumerate(kinds) if not flat), len(kinds))
        return all(i < nested for i, (name, _) in enumerate(kinds) if name in names)

    def _aggregates(self) -> list[Column]:
        """Count, box, ids and times, each as one minimum or maximum of a stored column."""
        id_field = self.options.get("id_field", "id")
        out = [F.count(F.lit(1)).alias("n"), *(F.min(c).alias(c[1:]) for c in BBOX[:2]), *(F.max(c).alias(c[1:]) for c in BBOX[2:]),
               F.min(id_field).alias("min_id"), F.max(id_field).alias("max_id")]
        if TIME_MS in self.schema.names:
            out += [F.min(TIME_MS).alias("t0"), F.max(TIME_MS).alias("t1")]
        return out

    def footer_statistics(self) -> DataFrame:
        """The aggregates as the footers of the files give them, one row per group of files: no data page is read.

        The reader that takes aggregates over is used in a session of its own, so the caller's settings stay as they are.
        """
        session = self.spark.newSession()
        session.conf.set("spark.sql.sources.useV1SourceList", "")
        session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        return reduce(DataFrame.unionByName, [part.agg(*self._aggregates()) for part in self._read(session)])

    def statistics(self) -> DataFrame:
        """One row: n, xmin, ymin, xmax, ymax, wkid, min_id, max_id, t0, t1; NULLs where there is nothing.

        Read from the files' footers, in tasks. Files without usable statistics (a column of NULLs only, or columns in another
        order than `write_stored` gives them) are scanned instead.
        Without a stored time column t0 and t1 are NULL.
        """
        found = None
        if self.groups and self.has_statistics:
            try:
                found = self.footer_statistics().collect()  # a row per group of files
            except (PySparkException, Py4JJavaError) as error:
                if "No min/max found" not in str(error):
                    raise
        if found is None:
            found = self.rows().agg(*self._aggregates()).collect()

        def over(pick, name: str):
            values = [r[name] for r in found if name in r.__fields__ and r[name] is not None]
            return pick(values) if values else None

        lows, highs = ("xmin", "ymin", "min_id", "t0"), ("xmax", "ymax", "max_id", "t1")
        values = {"n": sum(r.n for r in found), **{k: over(min, k) for k in lows}, **{k: over(max, k) for k in highs}}
        values["wkid"] = None if values["xmin"] is None else self.options.get("srid", 4326)
        kinds = {"n": "long", "wkid": "int", "min_id": "long", "max_id": "long", "t0": "long", "t1": "long", **dict.fromkeys(("xmin", "ymin", "xmax", "ymax"), "double")}
        names = ["n", "xmin", "ymin", "xmax", "ymax", "wkid", "min_id", "max_id", "t0", "t1"]
        return self.spark.createDataFrame([tuple(values[k] for k in names)], ", ".join(f"{k} {kinds[k]}" for k in names))

    def count(self) -> DataFrame:
        return self.statistics().select(F.col("n").alias("count"))

    def extent(self) -> DataFrame:
        return self.statistics().select("xmin", "ymin", "xmax", "ymax", "wkid")

    def times(self) -> DataFrame:
        return self.statistics().select("t0", "t1")


def write_stored(df: DataFrame, path: str, by: str, tie: str, extent: tuple[float, float, float, float] | None = None, partitions: int | None = None) -> None:
    """Write the rows clustered by day and place, for a stored layer: plain columns first, nested ones after them."""
    plain = [f.name for f in df.schema if isinstance(f.dataType, AtomicType)]
    df = df.select(*plain, *(c for c in df.columns if c not in plain))
    clustered(df, by, tie, extent, partitions).write.partitionBy(by).parquet(path)


def listed_sizes(stored: StoredLayer) -> DataFrame:
    """Path and bytes of the files of a layer."""
    sizes = reduce(DataFrame.unionByName, [file_sizes(stored.spark, base) for base, _ in stored.groups])
    names = stored.spark.createDataFrame([(f, _plain(f)) for f in stored.files], "path string, _plain string")
    return sizes.select(F.regexp_replace("path", ":///", ":/").alias("_plain"), "bytes").join(names, "_plain").select("path", "bytes")


# -- compaction -------------------------------------------------------------------------------------------------------


def day_files(spark: SparkSession, path: str, by: str) -> DataFrame:
    """Files and bytes per value of the partition column (as text, NULL for none), from the listing alone."""
    value = F.regexp_extract("path", rf"/{re.escape(by)}=([^/]*)/", 1)
    return file_sizes(spark, path).groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))


def compact(spark: SparkSession, path: str, by: str, tie: str, file_bytes: int = FILE_BYTES, srid: int = 4326) -> DataFrame:
    """Rewrite the days that lie in more files than their bytes need, clustered by place; returns (value, files, bytes, wanted) of those days.

    The folders of other days are not touched: the rows are written over their own days only (dynamic partition overwrite),
    and readers of other days see no change. The number of files follows the measured bytes, `wanted` per day; a day may get
    one more where the ranges of two days meet. Places are ordered within the extent that the files' statistics give, in
    whatever coordinates `srid` has. Only one writer may work on the folder.
    """
    wanted = F.greatest(F.ceil(F.col("bytes") / file_bytes), F.lit(1)).cast("int")
    days = day_files(spark, path, by).withColumn("wanted", wanted).filter(F.col("files") > F.col("wanted") + 1)
    chosen = days.collect()  # a row per day
    kinds = "value string, files long, bytes long, wanted int"
    done = spark.createDataFrame([(None if r.value == _NO_VALUE else unquote(r.value), r.files, r.bytes, r.wanted) for r in chosen], kinds)
    if not chosen:
        return done
    stored = StoredLayer.open(spark, path, by, id_field=tie, srid=srid)
    box = stored.statistics().first()
    extent = (box.xmin, box.ymin, box.xmax, box.ymax) if box.xmin is not None else None
    names = {r.value for r in chosen}
    folder = re.compile(rf"/{re.escape(by)}=([^/]*)/")
    rows = stored.only(f for f in stored.files if folder.search(f) and folder.search(f)[1] in names).rows()
    clustered(rows, by, tie, extent, sum(r.wanted for r in chosen)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    spark.catalog.refreshByPath(path)
    return done
