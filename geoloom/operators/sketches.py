"""Profiles kept as mergeable sketches, one row per day, so that a table is profiled again by reading the changed days only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from geoloom.functions.times import epoch_ms

#: Registers of a distinct-count sketch as a power of two (16 KB a sketch), and size parameter of a quantile sketch.
DISTINCT_REGISTERS, QUANTILE_SIZE = 14, 800


def distinct_error(registers: int = DISTINCT_REGISTERS, deviations: float = 5.0) -> float:
    """Relative error of a merged distinct count at so many standard deviations."""
    return deviations * 1.04 / 2 ** (registers / 2)


def _key(df: DataFrame, name: str) -> Column:
    """Any value as the 64 bits that are sketched; both zeros are one value, as they are to a distinct count. NULL stays NULL."""
    kind = df.schema[name].dataType
    value = F.col(name) + F.lit(0.0) if isinstance(kind, (FloatType, DoubleType)) else F.col(name)
    return F.when(F.col(name).isNotNull(), F.xxhash64(value))


def profile_sketches(df: DataFrame, by: str, entity: str, time: str, lon: str, lat: str) -> DataFrame:
    """One row per value of `by` (a day): counts, ranges, a sketch of the entities and one of each coordinate.

    One aggregate with a partial step, whatever share of the rows a day has. Rows with a NULL day are a day of their own;
    NULL values are counted as rows only, and a coordinate
    that is not a number has no rank. An empty table has no rows here.
    """
    kind = df.schema[time].dataType

    def measures(name: str, value: Column) -> list[Column]:
        ranked = F.when(~F.isnan(value), value)
        return [F.min(value).alias(f"min_{name}"), F.max(value).alias(f"max_{name}"), F.count(ranked).alias(f"{name}_count"),
                F.kll_sketch_agg_double(ranked, F.lit(QUANTILE_SIZE)).alias(f"{name}_sketch")]

    places = measures("lon", F.col(lon).cast("double")) + measures("lat", F.col(lat).cast("double"))
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("total_rows"), F.hll_sketch_agg(_key(df, entity), F.lit(DISTINCT_REGISTERS)).alias("entity_sketch"),
        epoch_ms(F.min(time), kind).alias("earliest_ms"), epoch_ms(F.max(time), kind).alias("latest_ms"), *places)


def write_profile(df: DataFrame, path: str, by: str, entity: str, time: str, lon: str, lat: str) -> None:
    """Store the sketches of the days that `df` has, each in a folder of its own; days it does not have stay as stored.

    Give all rows of the days that changed: a day is replaced, never added to.
    """
    sketches = profile_sketches(df, by, entity, time, lon, lat)
    sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def merged_profile(sketches: DataFrame, quantiles: tuple[float, ...] = (0.05, 0.5, 0.95)) -> DataFrame:
    """The profile of all days as one row, from their sketches alone: no row of the table is read.

    Counts and ranges are exact. `unique_entities` is within `distinct_error()` of the truth (five deviations); the quantiles of
    the coordinates are values of the table whose rank is off by about half a percent at most. Without days the counts are 0, the rest NULL.
    """
    names = ("lon", "lat")
    one = sketches.agg(
        F.coalesce(F.sum("total_rows"), F.lit(0)).alias("total_rows"), F.hll_union_agg("entity_sketch").alias("_entities"),
        F.min("earliest_ms").alias("earliest_ms"), F.max("latest_ms").alias("latest_ms"),
        *[F.min(f"min_{n}").alias(f"min_{n}") for n in names], *[F.max(f"max_{n}").alias(f"max_{n}") for n in names],
        *[F.sum(f"{n}_count").alias(f"_{n}_count") for n in names],
        # An empty sketch has no quantiles, so days without a value are left out.
        *[F.kll_merge_agg_double(F.when(F.col(f"{n}_count") > 0, F.col(f"{n}_sketch")), F.lit(QUANTILE_SIZE)).alias(f"_{n}") for n in names])
    ranks = F.array(*[F.lit(float(q)) for q in quantiles])
    return one.select(
        "total_rows", F.coalesce(F.hll_sketch_estimate("_entities"), F.lit(0)).alias("unique_entities"), "earliest_ms", "latest_ms",
        "min_lat", "max_lat", "min_lon", "max_lon",
        *[F.when(F.col(f"_{n}_count") > 0, F.kll_sketch_get_quantile_double(f"_{n}", ranks)).alias(f"{n}_quantiles") for n in names])


def stored_profile(spark: SparkSession, path: str, quantiles: tuple[float, ...] = (0.05, 0.5, 0.95)) -> DataFrame:
    """The profile of a table whose sketches are stored under a path."""
    return merged_profile(spark.read.parquet(path), quantiles)
