"""Exact top-k inner products with an M-tree.

Inner products become distances by one added coordinate: with M the largest
norm, |(q, 0) - (x, sqrt(M^2 - |x|^2))|^2 = |q|^2 + M^2 - 2 q.x. The tree has
nodes around routing objects from a bounded sample, pages around local routing
objects inside a node, and objects; nodes and pages store their covering radius,
pages and objects the distance to their parent. Every vector is indexed. A query
first searches its most promising node, which gives it a bound, then every node
that the bound does not exclude; inside a node pages are visited best first.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoloom.llm.arrays import runs
from geoloom.runtime import broadcast_if_small, checkpoint

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Factor before rounding down, results per query, divisor of the ids that ask.
SCALE, K, QUERY_EVERY = 256, 5, 50
#: Routing objects at most (drawn from a sample of that size), vectors of a node and of a page, queries of a block.
ROUTES, NODE, PAGE, BLOCK = 1024, 8192, 256, 8192
_SLACK = 1e-7


def _matrix(values: pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers as rows of doubles, short ones filled with zeros."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    offsets = np.asarray(values.offsets)
    flat = np.asarray(values.values)[offsets[0]:offsets[-1]].astype(np.float64)
    lengths = np.diff(offsets)
    out = np.zeros((len(values), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


class _Metric:
    """Distances between stored objects, and from a query to stored objects, for the largest squared norm `top`."""

    def __init__(self, top: float):
        self.top = top

    def stored(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        lift = np.sqrt(np.maximum(self.top - (x * x).sum(1), 0))[:, None] * np.sqrt(np.maximum(self.top - (y * y).sum(1), 0))
        return np.sqrt(np.maximum(2 * (self.top - x @ y.T - lift), 0))

    def asked(self, q: np.ndarray, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum((q * q).sum(1)[:, None] + self.top - 2 * (q @ x.T), 0))

    def reach(self, q: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Distance of an object with the given score; infinite without a score."""
        squared = (q * q).sum(1) + self.top - 2 * np.where(np.isfinite(scores), scores, 0)
        return np.where(np.isfinite(scores), np.sqrt(np.maximum(squared, 0)), np.inf) + _SLACK * (1 + math.sqrt(self.top))


def _pages(ids: np.ndarray, x: np.ndarray, route: np.ndarray, metric: _Metric) -> list[dict]:
    """Cut a node into pages around local routing objects, PAGE objects at most in each."""
    count = -(-len(ids) // PAGE)
    picked = np.linspace(0, len(ids) - 1, count).astype(int)
    nearest = metric.stored(x, x[picked]).argmin(axis=1)
    order = np.lexsort((ids, nearest))
    out = []
    for a, b in zip(starts := runs(nearest[order]), np.append(starts[1:], len(ids)), strict=True):
        centre = x[picked[nearest[order[a]]]][None]
        for c in range(a, b, PAGE):
            members = order[c:min(c + PAGE, b)]
            away = metric.stored(x[members], centre)[:, 0]
            out.append({"centre": centre[0].tobytes(), "radius": float(away.max()), "parent": float(metric.stored(centre, route)[0, 0]),
                        "ids": ids[members].tobytes(), "objects": x[members].tobytes(), "away": away.tobytes()})
    return out


def _search(pages: list[dict], q_ids: np.ndarray, q: np.ndarray, at_route: np.ndarray, floor: np.ndarray, k: int, metric: _Metric) -> tuple[np.ndarray, np.ndarray]:
    """The k best (score, id) of each query in a node. `at_route`: distances to the node's routing object; `floor`: scores that must be reached."""
    width = q.shape[1]
    scores, ids = np.full((len(q), k), -np.inf), np.full((len(q), k), np.iinfo(np.int64).max)
    centres = np.stack([np.frombuffer(p["centre"]) for p in pages])
    radii, parents = (np.array([p[n] for p in pages]) for n in ("radius", "parent"))
    bound = metric.reach(q, np.where(np.isfinite(floor), floor, -np.inf))
    # What the stored distances to the node's routing object exclude needs no distance to the page.
    near = np.abs(at_route[:, None] - parents) - radii <= bound[:, None]
    away = np.full((len(q), len(pages)), np.inf)
    rows = near.any(axis=1)
    if rows.any():
        away[rows] = metric.asked(q[rows], centres)
    least = np.where(near, np.maximum(away - radii, 0), np.inf)
    order = np.argsort(least, axis=1, kind="stable")
    for turn in range(len(pages)):
        page = order[:, turn]
        asking = np.flatnonzero(least[np.arange(len(q)), page] <= bound)
        if not len(asking):
            break
        asking = asking[np.argsort(page[asking], kind="stable")]
        for group in np.split(asking, runs(page[asking])[1:]):
            p = pages[page[group[0]]]
            objects, object_ids = np.frombuffer(p["objects"]).reshape(-1, width), np.frombuffer(p["ids"], np.int64)
            stored = np.frombuffer(p["away"])
            open_ = np.abs(away[group, page[group[0]]][:, None] - stored) <= bound[group][:, None]
            some = open_.any(axis=0)
            if not some.any():
                continue
            found = np.where(open_[:, some], q[group] @ objects[some].T, -np.inf)
            found[object_ids[some] == q_ids[group][:, None]] = -np.inf
            better = (found >= np.maximum(scores[group, -1], floor[group])[:, None]) & np.isfinite(found)
            for i in np.flatnonzero(better.any(axis=1)):
                g = group[i]
                s, o = np.append(scores[g], found[i, better[i]]), np.append(ids[g], object_ids[some][better[i]])
                best = np.lexsort((o, -s))[:k]
                scores[g], ids[g] = s[best], o[best]
            bound[group] = np.minimum(bound[group], metric.reach(q[group], scores[group, -1]))
    return scores, ids


def whole_vector(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * component) of each component; null if the vector or one of its components is null or not finite."""
    numbers = F.transform(vector, lambda c: c.cast("double"))
    bad = F.exists(numbers, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.when(~bad, F.transform(numbers, lambda c: F.floor(c * scale)))


def top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, query_every: int = QUERY_EVERY, scale: int = SCALE) -> DataFrame:
    """Rows (query_id, rank, id, score): for each id divisible by `query_every` the k highest inner products with the other rows, ties to the smaller id.

    Scores are inner products of floor(scale * component), exact as long as they
    stay below 2**53. Vectors that are null or hold a null or non-finite
    component, and rows of a null id, take no part. Vectors of fewer components
    count as filled with zeros. Rows that share an id are candidates each, and
    ask once, with the smallest of their vectors; none of them answers their own
    id. With fewer than k other rows all are returned. Other columns are not read.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), whole_vector(F.col(vector_col), scale).alias("x")).filter("id IS NOT NULL AND x IS NOT NULL")
    square = F.aggregate("x", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("width"), F.max(square).alias("top"),
                     F.count(F.when(F.col("id") % query_every == 0, 1)).alias("asked")).first()
    if facts.n < 2:
        return rows.sparkSession.createDataFrame([], f"query_id long, rank int, `{id_col}` long, score long")
    if not facts.width:
        return _all_zero(rows, k, query_every).withColumnRenamed("id", id_col)
    n, width, metric = facts.n, facts.width, _Metric(facts.top)
    count = min(ROUTES, max(1, math.ceil(n / NODE)))
    # A sample of bounded size (ROUTES rows): the smallest hashes of the ids.
    sample = rows.select("x", F.xxhash64("id", "x").alias("h")).orderBy("h").limit(count).select("x").toArrow()
    routes = _matrix(sample.column("x"), width)

    def nearest(batches):
        for batch in batches:
            x = _matrix(batch.column(1), width)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(metric.stored(x, routes).argmin(axis=1).astype(np.int64))], names=["id", "x", "route"])

    routed = rows.mapInArrow(nearest, "id long, x array<bigint>, route long")
    sizes = routed.groupBy("route").count().collect()  # ROUTES rows at most
    parts = F.create_map(*[F.lit(v) for r in sizes for v in (r.route, math.ceil(r["count"] / NODE))])
    # A route with many vectors becomes several nodes, also if the vectors are equal.
    dealt = routed.withColumn("node", F.col("route") + len(routes) * F.pmod(F.xxhash64("id", "x"), F.element_at(parts, F.col("route"))))

    def build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        x, route = _matrix(table.column("x"), width), routes[table.column("route")[0].as_py()][None]
        found = _pages(table.column("id").to_numpy(), x, route, metric)
        radius = float(metric.stored(x, route).max())
        return pa.Table.from_pylist([p | {"node": key[0].as_py(), "route": table.column("route")[0].as_py(), "reach": radius} for p in found], schema=pages_schema)

    pages_schema = pa.schema([("node", pa.int64()), ("route", pa.int64()), ("reach", pa.float64()), ("centre", pa.binary()), ("radius", pa.float64()),
                              ("parent", pa.float64()), ("ids", pa.binary()), ("objects", pa.binary()), ("away", pa.binary())])
    pages = checkpoint(dealt.select("node", "route", "id", "x").groupBy("node").applyInArrow(
        build, "node long, route long, reach double, centre binary, radius double, parent double, ids binary, objects binary, away binary"))
    nodes = pages.groupBy("route").agg(F.collect_set(F.struct("node", "reach")).alias("nodes"))
    queries = rows.filter(F.col("id") % query_every == 0).groupBy("id").agg(F.min("x").alias("x")).withColumn("floor", F.lit(float("-inf")))
    blocks = max(1, math.ceil(facts.asked / BLOCK))

    def measured(batches):
        for batch in batches:
            q = _matrix(batch.column("x"), width)
            away = metric.asked(q, routes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("x"), batch.column("floor"), pa.array(list(away), pa.list_(pa.float64()))], names=["id", "x", "floor", "away"])

    def ask(asked: DataFrame) -> DataFrame:
        """Search rows (node, id, x, floor, at) in their nodes, in blocks of queries: rows (query_id, id, score)."""
        block = F.pmod(F.xxhash64("id"), F.lit(blocks))
        copies = pages.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        return asked.withColumn("block", block).groupBy("node", "block").cogroup(copies.groupBy("node", "block")).applyInArrow(search, "query_id long, id long, score long")

    def search(asked: pa.Table, held: pa.Table) -> pa.Table:
        empty = pa.table({"query_id": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        if not asked.num_rows or not held.num_rows:
            return empty
        q_ids, q = asked.column("id").to_numpy(), _matrix(asked.column("x"), width)
        scores, ids = _search(held.to_pylist(), q_ids, q, asked.column("at").to_numpy(), asked.column("floor").to_numpy(), k, metric)
        row, column = np.nonzero(np.isfinite(scores))
        return pa.table({"query_id": q_ids[row], "id": ids[row, column], "score": scores[row, column].astype(np.int64)})

    # Distances from each query to the routes (ROUTES at most), then the nodes behind them.
    far = queries.mapInArrow(measured, "id long, x array<bigint>, floor double, away array<double>")
    far = checkpoint(far)
    listed = broadcast_if_small(nodes.select("route", F.explode("nodes").alias("n")).select("route", "n.node", "n.reach"))
    ways = far.select("id", "x", "floor", F.posexplode("away").alias("route", "at")).withColumn("route", F.col("route").cast("long")).join(listed, "route")
    first = W.partitionBy("id").orderBy(F.col("at") - F.col("reach"), "at", "node")
    best = ways.withColumn("turn", F.row_number().over(first)).filter("turn = 1").select("node", "id", "x", "floor", "at")
    opening = checkpoint(ask(best).withColumn("first", F.lit(True)))
    bounds = opening.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").cast("double").alias("least"))
    reached = ways.drop("floor").join(bounds.withColumnRenamed("query_id", "id"), "id", "left") \
        .withColumn("floor", F.when(F.col("n") >= k, F.col("least")).otherwise(F.lit(float("-inf")))).drop("n", "least")
    norm = F.aggregate("x", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    squared = norm + facts.top - 2 * F.col("floor")
    near = (F.col("floor") == float("-inf")) | (F.col("at") - F.col("reach") <= F.sqrt(F.greatest(squared, F.lit(0.0))) + _SLACK * (1 + math.sqrt(facts.top)))
    others = reached.filter(near).join(best.select("id", "node"), ["id", "node"], "left_anti").select("node", "id", "x", "floor", "at")
    every = opening.drop("first").unionByName(ask(others))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return every.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")


def _all_zero(rows: DataFrame, k: int, query_every: int) -> DataFrame:
    """Vectors without components: every score is 0, so the smallest other ids answer."""
    smallest = rows.select("id").orderBy("id").limit(k + 1).collect()
    asked = rows.filter(F.col("id") % query_every == 0).select(F.col("id").alias("query_id")).distinct()
    answers = F.array(*[F.lit(r.id) for r in smallest]).cast("array<bigint>")
    others = F.slice(F.filter(answers, lambda a: a != F.col("query_id")), 1, k)
    return asked.select("query_id", F.posexplode(others).alias("place", "id")).select("query_id", (F.col("place") + 1).alias("rank"), "id", F.lit(0).cast("long").alias("score"))
