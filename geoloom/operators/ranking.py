"""Row numbers in a global order without sending all rows through one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoloom.runtime import checkpoint

_IN_PARTITION = (1 << 33) - 1


def with_position(df: DataFrame, order: list[Column], out: str = "position") -> DataFrame:
    """Add the 0-based position of each row in `order` over the whole table.

    Rows are range-partitioned and sorted, fixed by a reliable checkpoint, and
    numbered by their place in the partition plus the rows of the partitions
    before. The only window runs over one row per partition. End `order` with a
    unique column, so that equal leading keys can be cut between partitions too.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    marked = checkpoint(ordered.withColumn("_mark", F.monotonically_increasing_id()))
    marked = marked.withColumns({
        "_slice": F.shiftright("_mark", 33),
        "_offset": F.col("_mark").bitwiseAND(F.lit(_IN_PARTITION)),
    })
    sizes = marked.groupBy("_slice").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_slice", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    return marked.join(F.broadcast(starts), "_slice").select(
        *df.columns, (F.col("_offset") + F.col("_before")).alias(out))


def assign_ids(df: DataFrame, order: list[str], out: str = "objectid", start: int = 1) -> DataFrame:
    """Unique whole-number ids from `start` in the given order, as row_number() over the whole table would give."""
    numbered = with_position(df, [F.col(c) for c in order], "_position")
    return numbered.select((F.col("_position") + start).alias(out), *df.columns)


def latest_per_entity(df: DataFrame, entity: str, time: str, tie: str) -> DataFrame:
    """Newest row of each entity; `tie` decides between equal times.

    One aggregate with a partial step: a single row per entity and input
    partition is shuffled, however many rows an entity has.
    """
    newest = F.max_by(F.struct(*df.columns), F.struct(F.col(time), F.col(tie)))
    return df.filter(F.col(time).isNotNull()).groupBy(F.col(entity).alias("_entity")).agg(newest.alias("_row")).select("_row.*")
