"""What the session provides: shared scratch space and size checks before a broadcast."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that spark.checkpoint.dir names, or the session's checkpoint folder."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    raise RuntimeError("Set spark.checkpoint.dir to a folder that every executor can reach")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, for a table written on the way."""
    return f"{scratch_root(spark).rstrip('/')}/geoloom-{name}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows and their order per partition are fixed and survive lost executors."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(scratch_root(df.sparkSession))
    return df.checkpoint(eager=True)


def fits(df: DataFrame, weight: Column | None = None, limit: int = BROADCAST_ROWS) -> bool:
    """Whether the rows (or the sum of `weight` over them) stay within a limit."""
    measure = F.count(F.lit(1)) if weight is None else F.coalesce(F.sum(weight.cast("double")), F.lit(0.0))
    return df.agg(measure.alias("size")).first().size <= limit


def broadcast_if_small(df: DataFrame, weight: Column | None = None) -> DataFrame:
    """Mark a table for broadcast when its measured size allows it; otherwise Spark joins by shuffle.

    Tables of fixed-width keys are counted; others give the bytes of a row as `weight`.
    """
    small = fits(df) if weight is None else fits(df, weight, BROADCAST_BYTES)
    return F.broadcast(df) if small else df
