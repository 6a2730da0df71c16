"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.runtime import checkpoint


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row.n, int(row.h or 0)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of each node to the smallest of them: the larger neighbours, or the smaller ones and the node itself.

    `edges` holds each link once, with u > v.
    """
    turned = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    seen = edges.unionByName(turned) if large else edges
    least = seen.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    if large:
        return turned.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    return edges.join(least, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e")) \
        .select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """Smallest reachable id (`component`) of every id of `links` (columns a, b) that has a link to another id.

    Each round contracts the graph by a large and a small star; the number of
    rounds grows with the logarithm of the longest path. Only (id, id) rows are
    shuffled, minima are taken before the shuffle, and each round is fixed by a
    reliable checkpoint. Links of an id to itself and null ids are ignored.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = checkpoint(edges)
    state = _state(edges)
    while state[0]:
        edges = checkpoint(_star(_star(edges, large=True), large=False))
        before, state = state, _state(edges)
        if before == state:
            break
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
