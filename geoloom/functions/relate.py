"""Exact relation of two geometries, as one Arrow function over a batch of rows.

The result is the 3x3 table of dimensions (interior, boundary, exterior of A
against those of B; -1 for empty) from which every predicate follows. Both
shapes are cut where their segments meet, and each piece is placed inside, on or
outside the other shape. A whole batch is handled by index arithmetic; the pair
tests go in blocks so that two long outlines never form one large matrix.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# The Arrow functions travel to the executors by value, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

I, B, E = 0, 1, 2
MATRIX = ("ii", "ib", "ie", "bi", "bb", "be", "ei", "eb")
RELATION_DDL = "struct<" + ",".join(f"{name}:int" for name in MATRIX) + ">"
_BLOCK = 1_000_000
_ROWS = 256
_EPS = 3.3306690738754716e-16


@dataclass
class Shapes:
    """Geometries of one batch as flat arrays; `row` says which geometry an item belongs to."""

    dim: np.ndarray  # per row: 0, 1, 2, or -1 for missing
    seg_row: np.ndarray
    seg: np.ndarray  # n x 4: x1, y1, x2, y2
    seg_side: np.ndarray  # ring segments: +1 if the interior lies left of the segment, -1 if right
    ends: np.ndarray  # n x 2 flags: this segment end is a boundary point of its line
    pt_row: np.ndarray  # points of point geometries, and boundary points of lines
    pt: np.ndarray

    @staticmethod
    def from_arrow(batch: pa.StructArray) -> "Shapes":
        n = len(batch)
        present = np.flatnonzero(batch.is_valid().to_numpy(zero_copy_only=False))
        if not len(present):
            none = np.empty(0, int)
            return Shapes(np.full(n, -1), none, np.empty((0, 4)), none, np.empty((0, 2), bool), none, np.empty((0, 2)))
        batch = batch.take(pa.array(present))
        counts, level = [], batch.field("parts")
        for _ in range(3):
            offsets = level.offsets.to_numpy()
            counts.append(np.diff(offsets))
            level = level.values.slice(offsets[0], offsets[-1] - offsets[0])
        xy = np.column_stack([level.field(0).to_numpy(zero_copy_only=False), level.field(1).to_numpy(zero_copy_only=False)])
        part_row = np.repeat(present, counts[0])
        ring_part = np.repeat(np.arange(len(part_row)), counts[1])
        ring_no = np.arange(len(ring_part)) - np.searchsorted(ring_part, ring_part)
        ring = np.repeat(np.arange(len(ring_part)), counts[2])
        row = part_row[ring_part][ring] if len(ring) else np.empty(0, int)
        dim = np.full(n, -1)
        dim[present] = [2 if k.endswith("Polygon") else 1 if k.endswith("String") else 0 for k in batch.field("type").to_pylist()]
        dim[np.bincount(row, minlength=n) == 0] = -1

        joined = np.flatnonzero(ring[1:] == ring[:-1]) if len(ring) else np.empty(0, int)
        seg = np.column_stack([xy[joined], xy[joined + 1]]).reshape(-1, 4)
        keep = (seg[:, :2] != seg[:, 2:]).any(axis=1) & (dim[row[joined]] > 0)
        joined, seg = joined[keep], seg[keep]
        seg_row, seg_ring = row[joined], ring[joined]
        doubled = np.bincount(seg_ring, seg[:, 0] * seg[:, 3] - seg[:, 2] * seg[:, 1], minlength=len(ring_part))
        turn = np.where(doubled < 0, -1, 1) * np.where(ring_no == 0, 1, -1)

        # A line end is a boundary point if an odd number of the row's line ends meet there.
        first = np.flatnonzero(np.r_[True, ring[1:] != ring[:-1]]) if len(ring) else joined[:0]
        last = np.r_[first[1:], len(ring)] - 1 if len(ring) else first
        tips = np.concatenate([first, last])
        tips = tips[dim[row[tips]] == 1] if len(tips) else tips
        keyed, times = np.unique(np.column_stack([row[tips], xy[tips]]).reshape(-1, 3), axis=0, return_counts=True)
        odd = keyed[times % 2 == 1]
        ends = np.column_stack([_among(seg_row, seg[:, :2], odd), _among(seg_row, seg[:, 2:], odd)])
        dots = np.flatnonzero(dim[row] == 0) if len(row) else joined[:0]
        pt_row = np.concatenate([row[dots], odd[:, 0].astype(int)])
        order = np.argsort(pt_row, kind="stable")
        return Shapes(dim, seg_row, seg, turn[seg_ring], ends, pt_row[order], np.concatenate([xy[dots], odd[:, 1:]])[order])

    def tile(self, n: int) -> "Shapes":
        """Repeat a single geometry for n rows."""
        def rows(a):
            return np.repeat(np.arange(n), len(a))

        def copies(a):
            return np.concatenate([a] * n) if n else a[:0]
        return Shapes(np.repeat(self.dim, n), rows(self.seg), copies(self.seg), copies(self.seg_side),
                      copies(self.ends), rows(self.pt), copies(self.pt))

    @property
    def size(self) -> int:
        return len(self.seg) + len(self.pt)


def _among(row: np.ndarray, xy: np.ndarray, table: np.ndarray) -> np.ndarray:
    def keys(a):
        return np.ascontiguousarray(a + 0.0).view("V24").ravel()
    if not len(table) or not len(row):
        return np.zeros(len(row), bool)
    return np.isin(keys(np.column_stack([row, xy])), keys(table))


def _pairs(left: np.ndarray, right: np.ndarray):
    """Index pairs of items with equal (sorted) row numbers, in blocks of bounded size."""
    start, stop = np.searchsorted(right, left, "left"), np.searchsorted(right, left, "right")
    width = stop - start
    filled = np.cumsum(width)
    at = 0
    while at < len(left):
        base = filled[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(filled, base + _BLOCK, "right")))
        w = width[at:end]
        i = np.repeat(np.arange(at, end), w)
        yield i, np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w) + np.repeat(start[at:end], w)
        at = end


def _turn(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Determinant of (b-a, c-a) and its exact sign; doubtful signs are recomputed with fractions."""
    p = (b[:, 0] - a[:, 0]) * (c[:, 1] - a[:, 1])
    q = (b[:, 1] - a[:, 1]) * (c[:, 0] - a[:, 0])
    det = p - q
    sign = np.sign(det).astype(int)
    for k in np.flatnonzero((np.abs(det) <= _EPS * (np.abs(p) + np.abs(q))) & ((p != 0) | (q != 0))):
        (ax, ay), (bx, by), (cx, cy) = (tuple(map(Fraction, v[k].tolist())) for v in (a, b, c))
        exact = (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)
        sign[k] = (exact > 0) - (exact < 0)
    return det, sign


def _between(seg: np.ndarray, p: np.ndarray) -> np.ndarray:
    """p within the box of the segment."""
    lo, hi = np.minimum(seg[:, :2], seg[:, 2:]), np.maximum(seg[:, :2], seg[:, 2:])
    return ((p >= lo) & (p <= hi)).all(axis=1)


def _along(seg: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Position of a point on its segment, 0 at the start and 1 at the end."""
    d = seg[:, 2:] - seg[:, :2]
    k = (np.abs(d[:, 1]) > np.abs(d[:, 0])).astype(int)
    at = np.arange(len(seg))
    return (p[at, k] - seg[at, k]) / d[at, k]


def _locate(row: np.ndarray, p: np.ndarray, other: Shapes, pieces: bool = False) -> np.ndarray:
    """Interior, boundary or exterior of the other shape, for one point per entry.

    `pieces` are middles of segments already cut at every contact: they lie
    inside or outside an area, and never on anything.
    """
    crossings, touch = np.zeros(len(p), int), np.full(len(p), E)
    for i, j in _pairs(row, other.seg_row):
        seg, q = other.seg[j], p[i]
        near = (np.minimum(seg[:, 1], seg[:, 3]) <= q[:, 1]) & (np.maximum(seg[:, 1], seg[:, 3]) >= q[:, 1]) & (
            np.maximum(seg[:, 0], seg[:, 2]) >= q[:, 0])
        i, j, seg, q = i[near], j[near], seg[near], q[near]
        _, sign = _turn(seg[:, :2], seg[:, 2:], q)
        on = (sign == 0) & _between(seg, q)
        edge = ((q == seg[:, :2]).all(axis=1) & other.ends[j, 0]) | ((q == seg[:, 2:]).all(axis=1) & other.ends[j, 1])
        place = np.where((other.dim[row[i]] == 2) | edge, B, I)
        np.minimum.at(touch, i[on & (place == I)], I)
        touch[i[on & (place == B)]] = B
        up = (seg[:, 1] <= q[:, 1]) & (seg[:, 3] > q[:, 1])
        down = (seg[:, 3] <= q[:, 1]) & (seg[:, 1] > q[:, 1])
        hit = (up & (sign > 0)) | (down & (sign < 0))
        crossings += np.bincount(i[hit], minlength=len(p))
    if pieces:
        return np.where((crossings % 2 == 1) & (other.dim[row] == 2), I, E) if len(p) else touch
    for i, j in _pairs(row, other.pt_row):
        same = (p[i] == other.pt[j]).all(axis=1) & (other.dim[row[i]] == 0)
        touch[i[same]] = I
    inside = (touch == E) & (crossings % 2 == 1) & (other.dim[row] == 2) if len(p) else touch == I
    return np.where(inside, I, touch)


def _half(a: Shapes, b: Shapes, table: np.ndarray, cuts: np.ndarray, spans: np.ndarray) -> None:
    """Enter what the pieces of A say about A against B."""
    def put(rows, la, lb, dim):
        np.maximum.at(table, (rows, la, lb), dim)

    place = _locate(a.pt_row, a.pt, b)
    put(a.pt_row, np.where(a.dim[a.pt_row] == 0, I, B), place, 0)

    ends = np.arange(len(a.seg))
    cuts = np.concatenate([cuts, np.column_stack([ends, np.zeros(len(ends))]), np.column_stack([ends, np.ones(len(ends))])])
    cuts = cuts[np.lexsort((cuts[:, 1], cuts[:, 0]))]
    piece = np.flatnonzero((cuts[1:, 0] == cuts[:-1, 0]) & (cuts[1:, 1] > cuts[:-1, 1]))
    which, middle = cuts[piece, 0].astype(int), (cuts[piece, 1] + cuts[piece + 1, 1]) / 2
    order = np.argsort(spans[:, 0], kind="stable")
    spans, side = spans[order], np.zeros(len(which), int)
    for i, j in _pairs(which, spans[:, 0].astype(int)):
        on = (middle[i] > spans[j, 1]) & (middle[i] < spans[j, 2])
        side[i[on]] = spans[j[on], 3]
    free = side == 0
    rows, seg = a.seg_row[which], a.seg[which]
    spot = np.full(len(which), B)
    spot[free] = _locate(rows[free], (seg[:, :2] + middle[:, None] * (seg[:, 2:] - seg[:, :2]))[free], b, True)
    ring, area = a.dim[rows] == 2, b.dim[rows] == 2
    spot = np.where(~free, np.where(area, B, I), spot)
    put(rows, np.where(ring, B, I), spot, 1)
    both = ring & area
    for mask, la, lb in (
        (both & free & (spot == I), I, I), (both & free & (spot == I), E, I), (both & free & (spot == E), I, E),
        (both & (side == 1), I, I), (both & (side == -1), I, E), (both & (side == -1), E, I),
    ):
        put(rows[mask], la, lb, 2)


def relate(a: Shapes, b: Shapes) -> np.ndarray:
    """Dimension table per row, shape (rows, 3, 3)."""
    n = len(a.dim)
    table = np.full((n, 3, 3), -1)
    known = (a.dim >= 0) & (b.dim >= 0)
    table[known & (a.dim < b.dim), E, I] = b.dim[known & (a.dim < b.dim)]
    table[known & (a.dim > b.dim), I, E] = a.dim[known & (a.dim > b.dim)]
    cuts_a, cuts_b, spans_a, spans_b = [], [], [], []
    for i, j in _pairs(a.seg_row, b.seg_row):
        p, q = a.seg[i], b.seg[j]
        near = ((np.minimum(p[:, :2], p[:, 2:]) <= np.maximum(q[:, :2], q[:, 2:]))
                & (np.maximum(p[:, :2], p[:, 2:]) >= np.minimum(q[:, :2], q[:, 2:]))).all(axis=1)
        i, j, p, q = i[near], j[near], p[near], q[near]
        p1, p2, q1, q2 = p[:, :2], p[:, 2:], q[:, :2], q[:, 2:]
        (d1, s1), (d2, s2), (d3, s3), (d4, s4) = (_turn(*v) for v in ((p1, p2, q1), (p1, p2, q2), (q1, q2, p1), (q1, q2, p2)))
        rows, ring_a, ring_b = a.seg_row[i], a.dim[a.seg_row[i]] == 2, b.dim[a.seg_row[i]] == 2

        x = (s1 * s2 < 0) & (s3 * s4 < 0)
        cuts_a.append(np.column_stack([i[x], d3[x] / (d3[x] - d4[x])]))
        cuts_b.append(np.column_stack([j[x], d1[x] / (d1[x] - d2[x])]))
        np.maximum.at(table, (rows[x], np.where(ring_a[x], B, I), np.where(ring_b[x], B, I)), 0)

        for sign, point, own, flag in ((s3, p1, a, a.ends[i, 0]), (s4, p2, a, a.ends[i, 1]),
                                       (s1, q1, b, b.ends[j, 0]), (s2, q2, b, b.ends[j, 1])):
            at_a = own is a
            on = (sign == 0) & _between(q if at_a else p, point)
            across, cut, k = (q, cuts_b, j) if at_a else (p, cuts_a, i)
            cut.append(np.column_stack([k[on], _along(across[on], point[on])]))
            far = b.ends[j] if at_a else a.ends[i]
            edge = ((point == across[:, :2]).all(axis=1) & far[:, 0]) | ((point == across[:, 2:]).all(axis=1) & far[:, 1])
            la, lb = (flag, edge) if at_a else (edge, flag)
            np.maximum.at(table, (rows[on], np.where(ring_a | la, B, I)[on], np.where(ring_b | lb, B, I)[on]), 0)

        flat = (s1 == 0) & (s2 == 0) & (s3 == 0) & (s4 == 0)
        same = np.where(((p2 - p1) * (q2 - q1)).sum(axis=1) > 0, 1, -1) * a.seg_side[i] * b.seg_side[j]
        for spans, k, seg, u, v in ((spans_a, i, p, q1, q2), (spans_b, j, q, p1, p2)):
            t = np.column_stack([_along(seg[flat], u[flat]), _along(seg[flat], v[flat])])
            spans.append(np.column_stack([k[flat], t.min(axis=1, initial=np.inf), t.max(axis=1, initial=-np.inf), same[flat]]))

    def stack(blocks, width):
        return np.concatenate(blocks) if blocks else np.empty((0, width))

    _half(a, b, table, _inner(stack(cuts_a, 2)), stack(spans_a, 4))
    _half(b, a, table.transpose(0, 2, 1), _inner(stack(cuts_b, 2)), stack(spans_b, 4))
    return table


def _inner(cuts: np.ndarray) -> np.ndarray:
    return cuts[(cuts[:, 1] > 0) & (cuts[:, 1] < 1)]


_EMPTY = pa.array([], pa.struct([(name, pa.int32()) for name in MATRIX]))


def _answer(a: Shapes, b: Shapes) -> pa.Array:
    table = relate(a, b)
    unknown = pa.array((a.dim < 0) | (b.dim < 0))
    cells = [pa.array(table[:, "ibe".index(name[0]), "ibe".index(name[1])].astype("i4")) for name in MATRIX]
    return pa.StructArray.from_arrays(cells, names=list(MATRIX), mask=unknown)


def relation(geom: Column, other: Column) -> Column:
    """Relation table of two geometry columns.

    Decode stored text before (`with_geometry`), not inside the arguments.
    """

    @F.arrow_udf(RELATION_DDL)
    def related(a: pa.Array, b: pa.Array) -> pa.Array:
        return _in_steps(len(a), _ROWS, lambda at, n: _answer(
            Shapes.from_arrow(a.slice(at, n)), Shapes.from_arrow(b.slice(at, n))))

    return related(geom, other)


def relation_to(geom: Column, shape: tuple[str, list]) -> Column:
    """Relation table against one fixed shape (type, nested (x, y) parts), sent once with the function."""
    kind, parts = shape
    nested = [[[{"x": x, "y": y} for x, y in ring] for ring in part] for part in parts]
    vertex = pa.struct([("x", pa.float64()), ("y", pa.float64())])
    layout = pa.struct([("type", pa.string()), ("parts", pa.list_(pa.list_(pa.list_(vertex))))])
    fixed = Shapes.from_arrow(pa.array([{"type": kind, "parts": nested}], layout))
    step = max(1, min(4 * _ROWS, _BLOCK // max(1, fixed.size)))

    @F.arrow_udf(RELATION_DDL)
    def related(a: pa.Array) -> pa.Array:
        return _in_steps(len(a), step, lambda at, n: _answer(
            Shapes.from_arrow(a.slice(at, n)), fixed.tile(min(n, len(a) - at))))

    return related(geom)


def _in_steps(rows: int, step: int, answer: Callable[[int, int], pa.Array]) -> pa.Array:
    """A batch in slices, so that what is held at once depends on the slice and not on the batch."""
    answers = [answer(at, step) for at in range(0, rows, step)]
    return pa.concat_arrays(answers) if answers else _EMPTY
