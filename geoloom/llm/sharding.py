"""Shards of nearly equal bytes by histogram sort, in DataFrame functions only.

Documents are ordered by id. Exact bytes below candidate keys are counted over
all partitions; intervals that hold a wanted splitter are probed more finely
until every splitter meets the tolerance or no row is left to move. Then the
rows go to their place in one exchange.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoloom.runtime import checkpoint

#: Shards; bytes beside the text that a document counts; share of a shard's bytes by which a splitter may be off.
SHARDS, OVERHEAD, TOLERANCE = 24, 8, 0.001
#: Intervals of the first histogram, probes inside an interval of a later one.
FIRST, PROBES = 4096, 128
#: A shard is sorted in cells of about so many rows, in MOST_CELLS cells at most.
CELL_ROWS, MOST_CELLS = 100_000, 64


@dataclass
class _Interval:
    """Keys from lo to hi (exclusive) that hold wanted splitters; `tie` is the key if lo and hi are tags of its rows."""

    lo: int
    hi: int
    bytes_below: int
    rows_below: int
    tie: int | None = None
    targets: list[int] = field(default_factory=list)

    def step(self, probes: int) -> int:
        return -(-(self.hi - self.lo) // probes)


@dataclass(frozen=True)
class _Splitter:
    key: int
    tag: int
    rows_below: int


def _bin(key: Column, low: Column, step: Column) -> Column:
    """Whole steps from `low` to `key`; decimals, as the distance may not fit a long."""
    return F.floor((key.cast("decimal(20,0)") - low.cast("decimal(20,0)")) / step.cast("decimal(20,0)")).cast("long")


def _splitters(rows: DataFrame, wanted: list[float], tolerance: float, low: int, high: int, tags: int) -> list[_Splitter]:
    """The splitter of each wanted number of bytes below, in order."""
    spark = rows.sparkSession
    active = [_Interval(low, high + 1, 0, 0, targets=list(range(len(wanted))))]
    found: dict[int, _Splitter] = {}
    probes = FIRST
    place = rows.withColumn("interval", F.lit(0).cast("long"))
    while active:
        table = spark.createDataFrame(
            [(i, str(a.lo), str(a.step(probes)), a.tie is not None) for i, a in enumerate(active)], "interval long, low string, step string, tied boolean")
        # As many rows as there are splitters at most.
        probed = place.join(F.broadcast(table), "interval")
        key = F.when(F.col("tied"), F.col("tag")).otherwise(F.col("key"))
        probed = probed.withColumn("bin", F.col("interval") * probes + _bin(key, F.col("low"), F.col("step"))).drop("interval", "low", "step", "tied")
        counts = probed.groupBy("bin").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).collect()
        bins: dict[int, list] = {}
        for c in sorted(counts, key=lambda c: c.bin):
            bins.setdefault(c.bin // probes, []).append((c.bin % probes, c.bytes, c.rows))
        following: dict[int, _Interval] = {}
        for i, a in enumerate(active):
            step, bytes_below, rows_below, targets = a.step(probes), a.bytes_below, a.rows_below, iter(a.targets)
            target = next(targets, None)
            for b, size, n in bins.get(i, ()):
                lo, hi = a.lo + b * step, min(a.lo + (b + 1) * step, a.hi)
                while target is not None and wanted[target] <= bytes_below + size:
                    before, after = wanted[target] - bytes_below, bytes_below + size - wanted[target]
                    if min(before, after) <= tolerance or n == 1:
                        edge, below = (lo, rows_below) if before <= after else (hi, rows_below + n)
                        found[target] = _Splitter(edge, 0, below) if a.tie is None else _Splitter(a.tie, edge, below)
                    else:
                        # One key left: its rows are told apart by their tags.
                        tied = a.tie if a.tie is not None else lo if hi - lo == 1 else None
                        whole = a.tie is None and tied is not None
                        inner = following.setdefault(i * probes + b, _Interval(0 if whole else lo, tags if whole else hi, bytes_below, rows_below, tied))
                        inner.targets.append(target)
                    target = next(targets, None)
                bytes_below, rows_below = bytes_below + size, rows_below + n
            while target is not None:
                found[target] = _Splitter(a.hi, 0, rows_below) if a.tie is None else _Splitter(a.tie, a.hi, rows_below)
                target = next(targets, None)
        active = list(following.values())
        if active:
            names = spark.createDataFrame([(b, i) for i, b in enumerate(following)], "bin long, interval long")
            place = probed.join(F.broadcast(names), "bin").drop("bin")
        probes = PROBES
    return [found[t] for t in range(len(wanted))]


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per input row: id, size (UTF-8 bytes of the text and 8), text_crc32, shard, slot (from 0, gapless in the shard).

    Shards follow the order of ids and have nearly equal bytes: a splitter is off
    by `tolerance` of a shard, or by half the document it falls into. A null text
    has no bytes; null ids come first; rows that share an id are told apart by
    their place in the input and may lie in several shards. With fewer rows than
    shards some shards stay empty. Other columns are not read.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), F.monotonically_increasing_id().alias("tag"))
    fixed = checkpoint(rows).withColumn("key", F.coalesce("id", F.lit(-(1 << 63))))
    total = fixed.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"), F.min("key").alias("low"), F.max("key").alias("high"), F.max("tag").alias("tag")).first()
    if not total.rows:
        return fixed.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    cells = min(MOST_CELLS, max(1, math.ceil(total.rows / (shards * CELL_ROWS))))
    wanted = [total.bytes * i / (shards * cells) for i in range(1, shards * cells)]
    found = _splitters(fixed.select("key", "tag", "size"), wanted, tolerance * total.bytes / shards, total.low, total.high, total.tag + 1)

    # The splitters of an interval of the first histogram stand with it, so a row looks only at its own.
    step = -(-(total.high + 1 - total.low) // FIRST)
    starts = [0, *(s.rows_below for s in found)]
    spark = docs.sparkSession
    inside: dict[int, list] = {}
    for s in found:
        inside.setdefault(min((s.key - total.low) // step, FIRST), []).append((s.key, s.tag))
    table, passed = [], 0
    for b in range(FIRST):
        table.append((b, passed, inside.get(b, [])))
        passed += len(inside.get(b, []))
    lookup = spark.createDataFrame(table, "bin long, passed int, splitters array<struct<key: long, tag: long>>")
    cell_table = spark.createDataFrame(
        [(c, c // cells, starts[c] - starts[c - c % cells]) for c in range(shards * cells)], "cell int, shard int, first long")
    binned = fixed.withColumn("bin", _bin(F.col("key"), F.lit(str(total.low)), F.lit(str(step)))).join(F.broadcast(lookup), "bin")
    passed_here = F.size(F.filter("splitters", lambda s: (s["key"] < F.col("key")) | ((s["key"] == F.col("key")) & (s["tag"] <= F.col("tag")))))
    placed = binned.withColumn("cell", F.col("passed") + passed_here).join(F.broadcast(cell_table), "cell")
    order = W.partitionBy("cell").orderBy("key", "tag")
    return placed.select(
        F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("first") + F.row_number().over(order) - 1).cast("long").alias("slot"))
