"""Product quantisation of vectors, its codebooks refined over metric trees.

Vectors are cut into parts. Each task builds, for the parts of a few thousand
vectors, an anchors hierarchy: anchors take over the points that are nearer to
them than to their present anchor (the triangle inequality tells which ones need
no look), balls are merged from the middle outwards and refined inwards, and each
ball keeps the count and the sum of its points. A ball inherits the list of
entries that can own a point of it; an entry leaves the list when another one is
nearer to the whole ball. A ball with one entry left is owned as a whole: its
cached sum goes to the entry and no point of it is looked at.
"""

from __future__ import annotations

import hashlib
import io
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.llm.arrays import map_arrow, slices
from geoloom.runtime import broadcast_if_small, checkpoint

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Vectors whose trees are built together; points of a ball that is not refined further.
CHUNK, LEAF = 4096, 64
#: Components are below this in size after scaling, so that squared distances are exact in 64 bits.
LARGEST = 1 << 26


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    return vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of numbers as a matrix, short ones filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(lengths), width), values.dtype)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def scaled(column: pa.Array, width: int, scale: int) -> np.ndarray:
    values = np.floor(matrix(column, width) * scale)
    if np.abs(values).max(initial=0) >= LARGEST:
        raise ValueError(f"A component passes {LARGEST // scale}")
    return values.astype(np.int64)


class Forest:
    """One tree per part over the distinct points of a chunk. A ball holds the points from `lo` to `hi`; `left` is -1 in a leaf.

    `at` gives the point of each vector and part.
    """

    FIELDS = ("left", "right", "lo", "hi", "points", "weights", "n", "sums", "radius", "roots", "at")

    def __init__(self, vectors: np.ndarray, parts: int):
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 50_000))  # balls nest deeply around far outliers
        width = vectors.shape[1] // parts
        self._balls: list[list[int]] = []
        order, weights, roots, places = [], [], [], []
        total = 0
        for p in range(parts):
            distinct, inverse, count = np.unique(vectors[:, p * width:(p + 1) * width], axis=0, return_inverse=True, return_counts=True)
            self._order: list[np.ndarray] = []
            self._placed = 0
            roots.append(self._grow(distinct.astype(float), np.arange(len(distinct)), total))
            placed = np.concatenate(self._order)
            rank = np.empty(len(placed), np.int64)
            rank[placed] = np.arange(total, total + len(placed))
            order.append(distinct[placed])
            weights.append(count[placed])
            places.append(rank[inverse.ravel()])
            total += len(placed)
        self.left, self.right, self.lo, self.hi = np.array(self._balls, np.int64).T
        self.points, self.weights = np.concatenate(order), np.concatenate(weights)
        self.roots, self.at = np.array(roots), np.stack(places)
        running = np.concatenate([np.zeros((1, width + 1), np.int64), np.cumsum(np.hstack([self.weights[:, None], self.weights[:, None] * self.points]), axis=0)])
        cached = running[self.hi] - running[self.lo]
        self.n, self.sums = cached[:, 0], cached[:, 1:]
        sizes = self.hi - self.lo
        starts = np.cumsum(sizes) - sizes
        ball = np.repeat(np.arange(len(sizes)), sizes)
        inside = np.arange(len(ball)) - starts[ball] + self.lo[ball]
        away = ((self.points[inside] - self.centres()[ball]) ** 2).sum(axis=1)
        self.radius = np.sqrt(np.maximum.reduceat(away, starts))

    def centres(self) -> np.ndarray:
        return self.sums / self.n[:, None]

    @staticmethod
    def _anchors(points: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchors (places of points), the anchor of each point, and its distance."""
        owner = np.zeros(len(points), np.int64)
        away = np.sqrt(((points - points[0]) ** 2).sum(axis=1))
        anchors = [0]
        for new in range(1, count):
            far = int(away.argmax())  # the farthest point of the largest ball
            if away[far] == 0:
                break
            between = np.sqrt(((points[anchors] - points[far]) ** 2).sum(axis=1))
            # A point nearer to its anchor than half the way to the new one stays.
            look = np.flatnonzero(away > between[owner] / 2)
            to_new = np.sqrt(((points[look] - points[far]) ** 2).sum(axis=1))
            won = to_new < away[look]
            owner[look[won]], away[look[won]] = new, to_new[won]
            anchors.append(far)
        return np.array(anchors), owner, away

    def _grow(self, points: np.ndarray, members: np.ndarray, base: int) -> int:
        """Balls over the points `members`, the outermost one's number."""
        if len(members) <= LEAF:
            self._order.append(members)
            self._balls.append([-1, -1, base + self._placed, base + self._placed + len(members)])
            self._placed += len(members)
            return len(self._balls) - 1
        anchors, owner, away = self._anchors(points[members], max(2, int(np.ceil(np.sqrt(len(members))))))
        count = len(anchors)
        radius = np.zeros(count)
        np.maximum.at(radius, owner, away)
        by_owner = np.argsort(owner, kind="stable")
        cuts = np.searchsorted(owner[by_owner], np.arange(count + 1))
        nested: list = [members[by_owner[a:b]] for a, b in zip(cuts, cuts[1:])]
        # Merge the two balls whose common ball is smallest, until one is left.
        centre = points[members[anchors]].copy()
        mass = np.diff(cuts).astype(float)
        apart = np.sqrt(((centre[:, None] - centre) ** 2).sum(axis=2))
        joint = np.maximum((apart + radius[:, None] + radius) / 2, np.maximum(radius[:, None], radius))
        np.fill_diagonal(joint, np.inf)
        for _ in range(count - 1):
            a, b = divmod(int(joint.argmin()), count)
            nested[a] = (nested[a], nested[b])
            radius[a] = joint[a, b]
            centre[a] = (centre[a] * mass[a] + centre[b] * mass[b]) / (mass[a] + mass[b])
            mass[a] += mass[b]
            joint[b], joint[:, b], radius[b] = np.inf, np.inf, np.inf
            to_a = np.sqrt(((centre - centre[a]) ** 2).sum(axis=1))
            joint[a] = joint[:, a] = np.where(np.isfinite(radius), np.maximum((to_a + radius[a] + radius) / 2, np.maximum(radius[a], radius)), np.inf)
            joint[a, a] = np.inf
            top = nested[a]
        return self._emit(points, top, base)

    def _emit(self, points: np.ndarray, ball, base: int) -> int:
        if not isinstance(ball, tuple):
            return self._grow(points, ball, base)
        place = len(self._balls)
        self._balls.append([0, 0, base + self._placed, 0])
        left = self._emit(points, ball[0], base)
        right = self._emit(points, ball[1], base)
        self._balls[place] = [left, right, self._balls[place][2], base + self._placed]
        return place

    def dump(self) -> bytes:
        out = io.BytesIO()
        small = {f: getattr(self, f) for f in self.FIELDS}
        np.savez(out, **{f: v.astype(np.int32) if f not in ("n", "sums", "radius") else v for f, v in small.items()})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Forest:
        forest = cls.__new__(cls)
        with np.load(io.BytesIO(data)) as held:
            for f in cls.FIELDS:
                setattr(forest, f, held[f].astype(np.int64) if held[f].dtype == np.int32 else held[f])
        return forest

    def owners(self, books: np.ndarray) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        """("balls", balls, entries) owned as a whole and ("points", points, entries) of the leaves that are not; an entry counts through all parts.

        `books` has parts x entries x width.
        """
        parts, entries, width = books.shape
        flat, centres = books.reshape(-1, width), self.centres()
        ball, lists = self.roots, np.arange(parts * entries)
        sizes = np.full(parts, entries)
        while len(ball):
            starts = np.cumsum(sizes) - sizes
            which = np.repeat(np.arange(len(ball)), sizes)
            away = ((centres[ball[which]] - flat[lists]) ** 2).sum(axis=1)
            nearest = np.minimum.reduceat(away, starts)
            # The first entry at the smallest distance; another one goes if the whole ball lies on its side of the plane between them.
            at = np.flatnonzero(away == nearest[which])
            first = lists[at[np.searchsorted(which[at], np.arange(len(ball)))]]
            between = np.sqrt(((flat[lists] - flat[first[which]]) ** 2).sum(axis=1))
            slack = 1e-9 * (1 + away)
            stays = away - nearest[which] <= 2 * self.radius[ball[which]] * between + slack
            lists, which = lists[stays], which[stays]
            sizes = np.bincount(which, minlength=len(ball))
            starts = np.cumsum(sizes) - sizes
            owned = sizes == 1
            yield "balls", ball[owned], lists[starts[owned]]
            leaf = ~owned & (self.left[ball] < 0)
            if leaf.any():
                yield self._looked_at(ball[leaf], lists[leaf[which]], sizes[leaf], flat)
            inner = ~owned & ~leaf
            kept = lists[inner[which]]
            ball, sizes = ball[inner], sizes[inner]
            ball, sizes, lists = np.concatenate([self.left[ball], self.right[ball]]), np.concatenate([sizes, sizes]), np.concatenate([kept, kept])

    def _looked_at(self, ball: np.ndarray, lists: np.ndarray, sizes: np.ndarray, flat: np.ndarray) -> tuple[str, np.ndarray, np.ndarray]:
        """The nearest listed entry of each point of the balls, exactly; of equal ones the first."""
        held = self.hi[ball] - self.lo[ball]
        owner = np.repeat(np.arange(len(ball)), held)
        points = np.arange(len(owner)) - (np.cumsum(held) - held)[owner] + self.lo[ball][owner]
        options = sizes[owner]
        starts = np.cumsum(options) - options
        which = np.repeat(np.arange(len(points)), options)
        entry = lists[np.arange(len(which)) - starts[which] + (np.cumsum(sizes) - sizes)[owner[which]]]
        away = ((self.points[points[which]] - flat[entry]) ** 2).sum(axis=1)
        hits = np.flatnonzero(away == np.minimum.reduceat(away, starts)[which])
        return "points", points, entry[hits[np.searchsorted(which[hits], np.arange(len(points)))]]

    def totals(self, books: np.ndarray) -> np.ndarray:
        """Count and sum of the points of each entry: entries of all parts x (1 + width)."""
        out = np.zeros((books.shape[0] * books.shape[1], 1 + books.shape[2]), np.int64)
        for kind, which, entry in self.owners(books):
            if kind == "balls":
                np.add.at(out, entry, np.hstack([self.n[which, None], self.sums[which]]))
            else:
                weight = self.weights[which, None]
                np.add.at(out, entry, np.hstack([weight, weight * self.points[which]]))
        return out

    def codes(self, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry of each vector and part (within its part), and the squared distances summed over the parts."""
        label = np.empty(len(self.points), np.int64)
        for kind, which, entry in self.owners(books):
            if kind == "balls":
                sizes = self.hi[which] - self.lo[which]
                inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes - self.lo[which], sizes)
                label[inside] = np.repeat(entry, sizes)
            else:
                label[which] = entry
        error = ((self.points - books.reshape(-1, books.shape[2])[label]) ** 2).sum(axis=1)
        return (label % books.shape[1])[self.at].T, error[self.at].sum(axis=0)


def _books(first: list[list[float]], width: int, parts: int, scale: int) -> np.ndarray:
    """Codebooks of the parts: parts x entries x width of a part."""
    rows = scaled(pa.array(first, pa.list_(pa.float64())), width, scale)
    return rows.reshape(len(rows), parts, width // parts).transpose(1, 0, 2)


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """One row per vector that is there and finite: id, label, code (two hex digits per part), error, label_error, codebooks_sha256.

    Components are scaled by `scale` and floored. The length of a vector is the
    largest one's, rounded up to a multiple of `parts`: shorter ones are filled
    up with zeros, so vectors without components are all zero. The codebooks
    start as the parts of the `entries` vectors with the smallest ids (null ids
    last, equal ids in the order of their components) or of all, if fewer. Rows
    that repeat are rows of their own; null ids and labels are kept, null labels
    are equal to each other. An empty table has no rows. A component of 2**26 or
    more after scaling is an error. Other columns are not read.

    What goes through the driver are codebooks: parts x entries rows.
    """
    if not 1 <= entries <= 256:
        raise ValueError("A code of two hex digits names at most 256 entries")
    label = F.col(label_col)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), label.alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.filter(usable(F.col("v")))
    longest = rows.agg(F.max(F.size("v")).alias("n")).first().n or 1
    width = -(-longest // parts) * parts
    books = _books([r.v for r in rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()], width, parts, scale)
    label_type = rows.schema["label"].dataType.simpleString()
    result = f"`{id_col}` long, `{label_col}` {label_type}, code string, error long"
    if not books.size:
        return vectors.sparkSession.createDataFrame([], f"{result}, label_error long, codebooks_sha256 string")

    def built(batches):
        waiting: list[pa.RecordBatch] = []

        def chunk() -> pa.RecordBatch:
            table = pa.Table.from_batches(waiting)
            forest = Forest(scaled(table.column("v").combine_chunks(), width, scale), parts)
            ids, labels = (table.column(c).combine_chunks() for c in ("id", "label"))
            whole = pa.array([0, len(ids)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(whole, ids), pa.ListArray.from_arrays(whole, labels), pa.array([forest.dump()], pa.binary())], names=["ids", "labels", "forest"])

        for batch in slices(batches, CHUNK):
            if waiting and sum(b.num_rows for b in waiting) + batch.num_rows > CHUNK:
                yield chunk()
                waiting.clear()
            waiting.append(batch)
        if waiting:
            yield chunk()

    forests = checkpoint(map_arrow(rows, built, f"ids array<long>, labels array<{label_type}>, forest binary"))
    part_width = width // parts
    names = ["n", *(f"s{i}" for i in range(part_width))]
    for _ in range(rounds):

        def summed(batches, books=books):
            total = np.zeros((books.shape[0] * books.shape[1], 1 + part_width), np.int64)
            for batch in batches:
                for data in batch.column(0):
                    total += Forest.load(data.as_py()).totals(books)
            used = np.flatnonzero(total[:, 0])
            yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(total[used, i]) for i in range(1 + part_width))], names=["entry", *names])

        found = map_arrow(forests.select("forest"), summed, ", ".join(["entry long", *(f"{c} long" for c in names)]))
        sums = found.groupBy("entry").agg(*(F.sum(c).cast("long").alias(c) for c in names)).collect()
        flat = books.reshape(-1, part_width).copy()
        for r in sums:
            flat[r.entry] = [r[c] // r.n for c in names[1:]]
        books = flat.reshape(books.shape)

    def coded(batches, books=books):
        for batch in batches:
            for i in range(batch.num_rows):
                which, error = Forest.load(batch.column(2)[i].as_py()).codes(books)
                digits = which.astype(np.uint8).tobytes().hex()
                codes = [digits[k:k + 2 * parts] for k in range(0, len(digits), 2 * parts)]
                for a in range(0, len(codes), 1024):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0)[i].values.slice(a, 1024), batch.column(1)[i].values.slice(a, 1024), pa.array(codes[a:a + 1024]), pa.array(error[a:a + 1024])],
                        names=["id", "label", "code", "error"])

    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    codes = checkpoint(map_arrow(forests, coded, f"id long, label {label_type}, code string, error long"))
    return with_group_sum(codes, "label", "error", "label_error").select(
        F.col("id").alias(id_col), F.col("label").alias(label_col), "code", "error", "label_error").withColumn("codebooks_sha256", F.lit(digest))


def with_group_sum(rows: DataFrame, group: str, value: str, name: str, hot: int = 1000) -> DataFrame:
    """The rows with the sum of `value` over the rows of their group, nulls together.

    Sums are aggregated before they are shuffled. Groups of more than a `hot`th of all rows, at most `hot` of them, are joined
    by broadcast; the rest by broadcast where its measured size allows, else by shuffle.
    """
    sums = checkpoint(rows.groupBy(F.col(group).alias("_group")).agg(F.sum(value).alias(name), F.count(F.lit(1)).alias("_n")))
    total = sums.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).first().n
    large = F.col("_n") * hot > total

    def joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        return left.join(right.drop("_n"), F.col(group).eqNullSafe(F.col("_group")), how)

    if sums.filter(~large).isEmpty():
        return joined(rows, F.broadcast(sums.filter(large)), "inner").drop("_group")
    first = joined(rows, F.broadcast(sums.filter(large)), "inner").drop("_group")
    rest = joined(rows, F.broadcast(sums.filter(large)), "left_anti")
    return first.unionByName(joined(rest, broadcast_if_small(sums.filter(~large), F.coalesce(F.octet_length(F.col("_group").cast("string")), F.lit(0)) + 32), "inner").drop("_group"))
