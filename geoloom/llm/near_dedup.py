"""Near duplicates by bottom-k sketches from one hash function.

1. Each text becomes its set of shingle hashes; equal sets are one class, represented by its smallest id.
2. A class keeps the k smallest hashes (its sketch). Inverted lists of retained values bring classes together: small sets
   are listed under the prefix of values of which two linked sets must share one, larger sets under pairs of neighbouring
   retained values, which a common passage alone seldom preserves.
3. Inside a list the union sketch estimates the similarity; a list answers with a forest of its estimated links, never with
   all pairs. Classes connected by them form a candidate group.
4. The full sets of a candidate group come together once, in blocks of bounded size, and exact similarity decides.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.arrays import binaries, map_arrow, mix, shingle_sets, slices
from geoloom.llm.components import components
from geoloom.runtime import checkpoint

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words of a shingle; similarity in hundredths; values a sketch retains; retained values whose neighbour pairs are list keys.
WIDTH, PERCENT, RETAINED, LISTED = 5, 75, 64, 24
#: Sets below SMALL are listed by a prefix that must share a value; sets from 75 % of it on (the smallest partner) by neighbour pairs too.
SMALL = 60
#: An estimate over n values of the union may fall this many standard deviations short.
SLACK = 6.0
#: Members of a list compared in one task; shingles of a candidate group compared in one task.
LIST_BLOCK, GROUP_BLOCK = 1024, 1 << 21

_KEYS = pa.schema([("key", pa.int64()), ("id", pa.int64())])


def _forest_of(n: int, linked) -> list[tuple[int, int]]:
    """Members (row, root) of the groups that `linked(i, others)` makes of n rows; `others` are rows after i not yet in its group."""
    parent = np.arange(n)

    for i in range(n - 1):
        others = np.flatnonzero(parent[i + 1:] != parent[i]) + i + 1
        if not len(others):
            continue
        hits = others[linked(i, others)]
        if len(hits):
            old = np.unique(np.append(parent[hits], parent[i]))
            parent[np.isin(parent, old)] = old[0]
    return [(i, int(p)) for i, p in enumerate(parent) if i != p]


def _sketch_links(sizes: np.ndarray, sketches: list[np.ndarray], percent: int, across: np.ndarray | None) -> list[tuple[int, int]]:
    """Forest of the pairs whose union sketch does not rule them out."""
    lengths = np.array([len(s) for s in sketches])
    values, which = np.unique(np.concatenate(sketches), return_inverse=True)
    width = lengths.max()
    cells = np.full((len(sketches), width), len(values))
    cells[np.arange(width) < lengths[:, None]] = which
    whole = lengths == sizes
    limit = np.where(whole, len(values), cells[np.arange(len(sketches)), lengths - 1])
    mark = np.zeros(len(values) + 1, bool)
    need = percent / 100

    def linked(i: int, others: np.ndarray) -> np.ndarray:
        near = (100 * np.minimum(sizes[i], sizes[others]) >= percent * np.maximum(sizes[i], sizes[others]))
        if across is not None:
            near &= across[others] != across[i]
        out = np.zeros(len(others), bool)
        others = others[near]
        if not len(others):
            return out
        mark[cells[i, :lengths[i]]] = True
        bound = np.minimum(limit[i], limit[others])
        common = mark[cells[others]].sum(axis=1)
        mark[cells[i, :lengths[i]]] = False
        union = np.searchsorted(cells[i, :lengths[i]], bound, side="right") + (cells[others] <= bound[:, None]).sum(axis=1) - common
        union -= np.where(bound == len(values), width - lengths[others], 0)
        exact = whole[i] & whole[others]
        slack = np.where(exact, 0.0, SLACK * np.sqrt(need * (1 - need) / union))
        out[near] = common >= (need - slack) * union - 1e-9
        return out

    return _forest_of(len(sketches), linked)


def _exact_links(sets: list[np.ndarray], percent: int, across: np.ndarray | None) -> list[tuple[int, int]]:
    """Forest of the pairs whose full sets are similar enough."""
    sizes = np.array([len(s) for s in sets])
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    values, which = np.unique(np.concatenate(sets), return_inverse=True)
    mark = np.zeros(len(values), bool)

    def linked(i: int, others: np.ndarray) -> np.ndarray:
        near = (100 * np.minimum(sizes[i], sizes[others]) >= percent * np.maximum(sizes[i], sizes[others]))
        if across is not None:
            near &= across[others] != across[i]
        out = np.zeros(len(others), bool)
        others = others[near]
        if not len(others):
            return out
        mark[which[offsets[i]:offsets[i + 1]]] = True
        if len(others) > (len(sets) - i) // 2:
            first = others[0]
            at = offsets[first:-1] - offsets[first]
            common = np.add.reduceat(mark[which[offsets[first]:]].astype(np.int32), at)[others - first]
        else:
            lengths = sizes[others]
            ends = np.cumsum(lengths)
            index = np.arange(ends[-1]) + np.repeat(offsets[others] - (ends - lengths), lengths)
            common = np.add.reduceat(mark[which[index]].astype(np.int32), ends - lengths)
        mark[which[offsets[i]:offsets[i + 1]]] = False
        out[near] = 100 * common >= percent * (sizes[i] + sizes[others] - common)
        return out

    return _forest_of(len(sets), linked)


def _list_keys(sketch: np.ndarray, size: int, percent: int) -> np.ndarray:
    keys = []
    if size < SMALL:
        keys.append(mix(sketch[: size - -(-percent * size // 100) + 1] ^ np.uint64(1)))
    if 100 * size >= percent * SMALL:
        head = sketch[:LISTED]
        keys.append(mix(head[:-1] * np.uint64(0x9E3779B97F4A7C15) + head[1:]))
    return np.concatenate(keys)


def _cells(members: DataFrame, group: str, blocks) -> DataFrame:
    """Deal the rows of each group to cells (i, j) of a triangle: each pair of blocks meets in one cell, rows of a small group in one cell only."""
    blocked = members.withColumn("_blocks", blocks).withColumn("_block", F.pmod(F.xxhash64("id", F.lit(7)), F.col("_blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), (F.col("_blocks") - 1).cast("int")))
    return blocked.withColumn("_other", other).withColumns({"_i": F.least("_block", "_other"), "_j": F.greatest("_block", "_other")}) \
        .drop("_other", "_blocks").withColumnRenamed(group, "_group")


def _cell_links(table: pa.Table, find) -> pa.Table:
    ids = table.column("id").to_numpy()
    order = np.argsort(ids, kind="stable")
    if len(order) < 2:
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    i, j = table.column("_i")[0].as_py(), table.column("_j")[0].as_py()
    across = table.column("_block").to_numpy()[order] if i != j else None
    values = [np.frombuffer(v.as_buffer(), "<u8") for v in table.column("values").take(pa.array(order))]
    links = find(table, order, values, across)
    return pa.table({"a": pa.array(ids[order][[a for a, _ in links]], pa.int64()), "b": pa.array(ids[order][[b for _, b in links]], pa.int64())})


def shingle_table(docs: DataFrame, id_col: str, text_col: str, retained: int | None, width: int = WIDTH) -> DataFrame:
    """One row per document: id, size of its shingle set, 128-bit class of equal sets, and its smallest `retained` hashes (all: None) as bytes."""

    def rows(batches):
        for batch in slices(batches, 1024):
            ids = batch.column(0)
            for first, offsets, hashes in shingle_sets(batch.column(1), width):
                sizes = np.diff(offsets)
                # Sums of two independent values per shingle identify the set whatever its order.
                totals = [np.concatenate([[np.uint64(0)], np.cumsum(mix(hashes ^ np.uint64(seed)))]).astype(np.uint64) for seed in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
                high, low = ((t[offsets[1:]] - t[offsets[:-1]]).view(np.int64) for t in totals)
                if retained is not None:
                    rank = np.arange(len(hashes)) - np.repeat(offsets[:-1], sizes)
                    kept = rank < retained
                    offsets, hashes = np.concatenate([[0], np.cumsum(kept)])[offsets], hashes[kept]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, len(sizes)), pa.array(sizes.astype(np.int64)), pa.array(high), pa.array(low), binaries(hashes, offsets)],
                    names=["id", "n_shingles", "high", "low", "values"])

    return map_arrow(
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")), rows, "id long, n_shingles long, high long, low long, values binary")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (smallest id reachable by links), kept (the id is its component's).

    Two texts are linked when 100 * shared shingles >= percent * all shingles
    of both. Links count only if the full sets confirm them; with sketches of
    64 and 24 listed values a pair exactly at the threshold is missed with a
    chance of at most three in a million (the list keys 2.6e-6, the estimate
    2.5e-8, one set inside the other), similar pairs less. A null or empty
    text, or one without words, has no shingles and is linked with nothing.
    Rows of a null id keep their size, have a null component and are not kept.
    Rows that share an id are one document of one component, linked with
    whatever one of its texts is linked with. Other columns are not read.
    """
    table = checkpoint(shingle_table(docs, id_col, text_col, RETAINED))
    filled = table.filter("n_shingles > 0 AND id IS NOT NULL")
    # Equal sets: one row per class travels on.
    classes = checkpoint(filled.groupBy("n_shingles", "high", "low").agg(F.min("id").alias("representative")))
    sketches = filled.join(classes.select(F.col("representative").alias("id"), "n_shingles", "high", "low"), ["id", "n_shingles", "high", "low"], "left_semi") \
        .select("id", "n_shingles", "values")

    def keys(batches):
        for batch in slices(batches, 1024):
            sizes = batch.column(1).to_numpy()
            found = [_list_keys(np.frombuffer(v.as_buffer(), "<u8"), n, percent) for v, n in zip(batch.column(2), sizes, strict=True)]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found).view(np.int64)), pa.array(np.repeat(batch.column(0).to_numpy(), [len(k) for k in found]))], schema=_KEYS)

    listed = checkpoint(map_arrow(sketches, keys, "key long, id long").distinct())
    # Lists of the same members answer alike: one of them is enough.
    chosen = listed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("id")).alias("x"), F.sum(F.xxhash64("id", F.lit(3)).bitwiseAND(F.lit((1 << 40) - 1))).alias("y")) \
        .filter("n > 1").groupBy("n", "x", "y").agg(F.min("key").alias("key"))
    lists = listed.join(chosen.select("key", "n"), "key").join(sketches.withColumnRenamed("n_shingles", "size"), "id")
    cells = _cells(lists, "key", F.ceil(F.col("n") / LIST_BLOCK).cast("int"))

    def estimated(table: pa.Table) -> pa.Table:
        return _cell_links(table, lambda t, order, values, across: _sketch_links(t.column("size").to_numpy()[order], values, percent, across))

    candidates = components(cells.select("_group", "_i", "_j", "_block", "id", "size", "values").groupBy("_group", "_i", "_j").applyInArrow(estimated, "a long, b long"))
    candidates = checkpoint(candidates)

    # Full sets only of classes in a candidate group, read again from the texts of their representatives.
    wanted = candidates.select("id", "component")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).join(wanted.select("id"), "id", "left_semi")
    full = shingle_table(texts, "id", "text", None)
    members = full.join(wanted, "id").join(classes.select(F.col("representative").alias("id"), "n_shingles", "high", "low"), ["id", "n_shingles", "high", "low"], "left_semi")
    sizes = classes.select(F.col("representative").alias("id"), "n_shingles").join(wanted, "id").groupBy("component").agg(F.sum("n_shingles").alias("n"))
    exact_cells = _cells(members.join(sizes, "component"), "component", F.ceil(F.col("n") / GROUP_BLOCK).cast("int"))

    def confirmed(table: pa.Table) -> pa.Table:
        return _cell_links(table, lambda t, order, values, across: _exact_links(values, percent, across))

    links = exact_cells.select("_group", "_i", "_j", "_block", "id", "values").groupBy("_group", "_i", "_j").applyInArrow(confirmed, "a long, b long")
    # Ids with several sets, or with a set and none, link all their classes.
    of_class = F.struct("n_shingles", "high", "low")
    split = checkpoint(table.filter("id IS NOT NULL").groupBy("id").agg(F.min(of_class).alias("first"), F.max(of_class).alias("last")).filter("first <> last").select("id"))
    own = filled.join(split, "id", "left_semi").join(classes, ["n_shingles", "high", "low"]).select(F.col("id").alias("a"), F.col("representative").alias("b"))
    joined = components(links.unionByName(own))
    named = classes.join(joined.withColumnRenamed("id", "representative"), "representative", "left") \
        .select("n_shingles", "high", "low", F.lit(0).cast("long").alias("_empty"), F.coalesce("component", "representative").alias("class_component"))
    bare = joined.join(split, "id", "left_semi").select(*(F.lit(0).cast("long").alias(c) for c in ("n_shingles", "high", "low")), F.col("id").alias("_empty"), "component")
    named = named.unionByName(bare.withColumnRenamed("component", "class_component"))
    component = F.when(F.col("id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("class_component", "id"))
    rows = table.drop("values").withColumn("_empty", F.when(F.col("n_shingles") == 0, F.col("id")).otherwise(F.lit(0)))
    return rows.join(named, ["n_shingles", "high", "low", "_empty"], "left").select(
        F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
