"""Whitening of vectors by an incremental eigendecomposition of their covariance.

Each task centres its vectors block by block and applies them to its
eigendecomposition as rank-one updates: the new eigenvalues are the roots of a
secular equation over the old ones. Directions that an update does not touch, and all but one of
the directions of a repeated eigenvalue, are deflated before. The spectra of the
tasks are combined, a few at a time, by rank-one updates too. A last pass over all
vectors projects the exact covariance on the resulting basis and diagonalises it
there (Rayleigh-Ritz), which removes what the updates lost to rounding.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.arrays import map_arrow
from geoloom.llm.quantise import scaled, usable
from geoloom.runtime import checkpoint

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Components returned; a vector's component c becomes floor(SCALE * c) + SHIFT.
COMPONENTS, SCALE, SHIFT = 8, 1024, 100_000
#: Vectors whose triangular factor is taken together.
BLOCK = 4096
#: Partial results that one task combines.
FAN_IN = 16
#: Eigenvalues below this share of the largest one are zero: there is nothing to divide by.
ZERO = 1e-13
_EPS = np.finfo(float).eps


def secular_roots(d: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(a / (d - x)) for ascending d and positive a, and the matrix d[i] - root[j], exact to rounding.

    Root j lies between d[j] and d[j + 1], the last one at most sum(a) above the last d. Each is found as its distance from
    the nearer of the two, by rational interpolation that keeps both neighbouring poles, inside a bracket that only shrinks.
    """
    k, total = len(d), a.sum()
    own = np.arange(k)
    gap = np.append(np.diff(d), total)
    term = a[:, None] / (d[:, None] - (d + gap / 2))
    value = 1 + term.sum(axis=0)
    right = (value < 0) & (own < k - 1)  # the root is nearer to the upper pole
    origin = np.where(right, np.append(d[1:], 0.0), d)
    low = np.where(right, -gap / 2, 0.0)
    high = np.where(right, 0.0, np.append(gap[:-1] / 2, total))
    delta = d[:, None] - origin
    pole, following = delta[own, own], np.append(delta[own[1:], own[:-1]], 2 * total)
    # The first guess takes all but the two neighbouring poles as they are in the middle.
    above = np.append(a[1:], 0.0)
    rest = value - term[own, own] - np.append(term[own[1:], own[:-1]], 0.0)
    x = _root_inside(rest, rest * (pole + following) + a + above, a * following + above * pole, 0.0, low, high)
    going = own
    for _ in range(80):
        away = delta[:, going] - x[going]
        term = a[:, None] / away
        value = 1 + term.sum(axis=0)
        open_ = np.abs(value) > _EPS * k * (1 + np.abs(term).sum(axis=0))
        if not open_.any():
            break
        going, away, term, value = going[open_], away[:, open_], term[:, open_], value[open_]
        now = x[going]
        high[going], low[going] = np.where(value > 0, now, high[going]), np.where(value <= 0, now, low[going])
        slope = term / away
        all_slopes = slope.sum(axis=0)
        below = np.where(own[:, None] <= going, slope, 0).sum(axis=0)
        p, q = pole[going] - now, following[going] - now
        x[going] = _root_inside(value - p * below - q * (all_slopes - below), (p + q) * value - p * q * all_slopes, p * q * value, now, low[going], high[going])
    return origin + x, delta - x


def _root_inside(c: np.ndarray, b: np.ndarray, e: np.ndarray, start, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """start + the root of c x x - b x + e that ends inside the bracket, else the middle of the bracket."""
    sum_ = b + np.copysign(np.sqrt(np.maximum(b * b - 4 * e * c, 0)), b)
    out = (low + high) / 2
    for root in (start + sum_ / (2 * c), start + 2 * e / sum_):
        out = np.where((root > low) & (root < high), root, out)
    return out


class Spectrum:
    """Count, mean and eigendecomposition (values ascending) of the scatter matrix of the vectors seen."""

    def __init__(self, width: int):
        self.n, self.mean = 0, np.zeros(width)
        self.values, self.vectors = np.zeros(width), np.eye(width)

    def add(self, block: np.ndarray) -> None:
        """Take in a block of vectors. A block of more rows than dimensions has the scatter matrix of its triangular factor, whose rows are then the updates."""
        mean = block.mean(axis=0)
        away = block - mean
        self._absorb(len(block), mean, np.linalg.qr(away, mode="r") if len(away) > len(mean) else away)

    def combine(self, other: Spectrum) -> None:
        """Take in another spectrum, direction by direction."""
        if other.n:
            self._absorb(other.n, other.mean, (other.vectors * np.sqrt(np.maximum(other.values, 0))).T)

    def _absorb(self, n: int, mean: np.ndarray, directions: np.ndarray) -> None:
        for v in directions:
            self._update(v)
        away, total = mean - self.mean, self.n + n
        self._update(np.sqrt(self.n * n / total) * away)
        self.mean = self.mean + away * (n / total)
        self.n = total

    def _update(self, v: np.ndarray) -> None:
        """Add the outer product of v with itself."""
        z = self.vectors.T @ v
        weight = z @ z
        if weight == 0:
            return
        tolerance = 8 * _EPS * max(self.values[-1], weight)
        # Deflation: directions the update leaves alone ...
        z[np.abs(z) * np.sqrt(weight) <= tolerance] = 0
        left = np.flatnonzero(z)
        # ... and all but one direction of equal values, after a reflection that gathers z in that one.
        cuts = np.flatnonzero(np.diff(self.values[left]) > tolerance) + 1
        if len(cuts) + 1 < len(left):
            for run in np.split(left, cuts):
                if len(run) > 1:
                    mirror = z[run]
                    size = np.sqrt(mirror @ mirror)
                    sign = 1.0 if mirror[-1] >= 0 else -1.0
                    mirror[-1] += sign * size
                    held = self.vectors[:, run]
                    self.vectors[:, run] = held - np.outer(held @ mirror, mirror * (2 / (mirror @ mirror)))
                    z[run] = 0
                    z[run[-1]] = -sign * size
            left = np.flatnonzero(z)
        if len(left) == 1:
            self.values[left] += z[left] ** 2
        elif len(left):
            d = self.values[left]
            with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
                roots, away = secular_roots(d, z[left] ** 2)
                # The update whose exact roots these are: its vectors are orthogonal to rounding.
                k = len(d)
                apart = d - d[:, None]
                apart = np.where(np.arange(k) < np.arange(k)[:, None], apart, np.hstack([apart[:, 1:], np.full((k, 1), 1.0)]))
                near = np.sqrt(np.abs((-away / apart).prod(axis=1))) * np.sign(z[left])
                turned = near[:, None] / away
                turned /= np.sqrt((turned * turned).sum(axis=0))
            self.vectors[:, left] = self.vectors[:, left] @ turned
            self.values[left] = roots
        order = np.argsort(self.values, kind="stable")
        self.values, self.vectors = self.values[order], self.vectors[:, order]


class Whitening(NamedTuple):
    """What the whitening of a table is made of: `basis` has a component per column, by falling eigenvalue."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    basis: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n, from whole numbers up to the division."""
        return (self.n * x - self.sums) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Projections over the roots of the eigenvalues; NaN where an eigenvalue is zero."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.values > ZERO * self.values.max(initial=0), self.centred(x) @ self.basis / np.sqrt(self.values), np.nan)


_PART = "part long, n long, sums array<long>, data binary"


def _part(n: int, sums: np.ndarray, *arrays: np.ndarray, part: int = 0) -> dict:
    return {"part": [part], "n": [n], "sums": [sums.tolist()], "data": [np.concatenate([a.ravel() for a in arrays]).astype("<f8").tobytes()]}


_PART_TYPES = pa.schema([("part", pa.int64()), ("n", pa.int64()), ("sums", pa.list_(pa.int64())), ("data", pa.binary())])


def _reduced(parts: DataFrame, combine: Callable[[list[tuple[int, np.ndarray, np.ndarray]]], tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray] | None:
    """One result out of one per task: a few at a time are combined, in the order of their tasks, until one is left."""
    parts = checkpoint(parts)

    def together(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        held = [(n, np.array(s, np.int64), np.frombuffer(d, "<f8")) for n, s, d in zip(*(table.column(c).to_pylist() for c in ("n", "sums", "data")), strict=True)]
        n, sums, data = combine(held)
        return pa.table(_part(n, sums, data, part=table.column("part")[0].as_py() // FAN_IN), _PART_TYPES)

    while parts.count() > 1:
        parts = checkpoint(parts.groupBy(F.floor(F.col("part") / FAN_IN).alias("_into")).applyInArrow(together, _PART))
    row = parts.first()
    return (row.n, np.array(row.sums, np.int64), np.frombuffer(row.data, "<f8")) if row else None


def _spectrum(n: int, data: np.ndarray, width: int) -> Spectrum:
    out = Spectrum(width)
    out.n, out.mean, out.values = n, data[:width].copy(), data[width:2 * width].copy()
    out.vectors = data[2 * width:].reshape(width, width).copy()
    return out


def _rows(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.filter(usable(F.col("v")))


def fit_whitening(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> Whitening | None:
    """The whitening of all vectors that are there and finite, each once for each of its rows; None if there are none.

    Shorter vectors are filled up with zeros. Through the driver go a width x width matrix and sums, whatever the number of rows.
    """
    rows = _rows(vectors, id_col, vector_col)
    width = rows.agg(F.max(F.size("v")).alias("n")).first().n
    if width is None:
        return None
    width = max(1, width)
    only = rows.select("v")

    def numbers(batch: pa.RecordBatch) -> np.ndarray:
        return scaled(batch.column(0), width, SCALE) + SHIFT

    def spectra(batches):
        held, sums = Spectrum(width), np.zeros(width, np.int64)
        for batch in batches:
            x = numbers(batch)
            sums += x.sum(axis=0)
            for at in range(0, len(x), BLOCK):
                held.add((x[at:at + BLOCK] - SHIFT).astype(float))
        if held.n:
            yield pa.RecordBatch.from_pydict(_part(held.n, sums, held.mean, held.values, held.vectors, part=TaskContext.get().partitionId()), _PART_TYPES)

    def combined(parts):
        first, sums = _spectrum(parts[0][0], parts[0][2], width), parts[0][1].copy()
        for n, s, data in parts[1:]:
            first.combine(_spectrum(n, data, width))
            sums += s
        return first.n, sums, np.concatenate([first.mean, first.values, first.vectors.ravel()])

    n, sums, data = _reduced(map_arrow(only, spectra, _PART), combined)
    basis, _ = np.linalg.qr(_spectrum(n, data, width).vectors)
    exact = Whitening(n, sums, np.ones(width), basis, 1.0)

    def projected(batches):
        total, count = np.zeros((width, width)), 0
        for batch in batches:
            y = exact.centred(numbers(batch)) @ basis
            total += y.T @ y
            count += len(y)
        if count:
            yield pa.RecordBatch.from_pydict(_part(count, np.zeros(1, np.int64), total, part=TaskContext.get().partitionId()), _PART_TYPES)

    def added(parts):
        return sum(p[0] for p in parts), parts[0][1], np.sum([p[2] for p in parts], axis=0)

    _, _, data = _reduced(map_arrow(only, projected, _PART), added)
    covariance = data.reshape(width, width) / n
    values, turned = np.linalg.eigh((covariance + covariance.T) / 2)
    basis, _ = np.linalg.qr(basis @ turned[:, ::-1])
    return Whitening(n, sums, np.maximum(values[::-1], 0), basis, float(np.trace(covariance)))


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, fitted: Whitening | None = None) -> DataFrame:
    """Rows (id, component, n, deviation, whitened, explained, identity_error): the first components of each vector that is there and finite.

    `deviation` is the sum over dimensions of (n * x - S) ** 2, exact, null where
    it passes 64 bits. A component without variance (all of them, where all
    vectors are equal) has a null `whitened`; `explained` is null if no component
    has any. `identity_error` is taken over the components with variance, null
    without. Null ids are kept and repeated rows are rows of their own. An empty
    table has no rows. Shorter vectors are filled up with zeros. Other columns are
    not read. `fitted` is a whitening fitted before.
    """
    schema = f"`{id_col}` long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fitted = fitted or fit_whitening(vectors, id_col, vector_col)
    if fitted is None:
        return vectors.sparkSession.createDataFrame([], schema)
    width, n = len(fitted.sums), fitted.n
    first = fitted._replace(values=fitted.values[:components], basis=fitted.basis[:, :components])
    count = len(first.values)
    rows = _rows(vectors, id_col, vector_col)

    def moments(batches):
        """Count, mean and centred second moments of the whitened vectors."""
        held = (0, np.zeros(1, np.int64), np.zeros(count * (count + 1)))
        for batch in batches:
            w = np.nan_to_num(first.whitened(scaled(batch.column(0), width, SCALE) + SHIFT))
            if len(w):
                mean = w.mean(axis=0)
                held = pooled([held, (len(w), held[1], np.concatenate([mean, ((w - mean).T @ (w - mean)).ravel()]))])
        if held[0]:
            yield pa.RecordBatch.from_pydict(_part(*held, part=TaskContext.get().partitionId()), _PART_TYPES)

    def pooled(parts):
        n, mean, second = 0, np.zeros(count), np.zeros((count, count))
        for m, _, data in parts:
            if m:
                away = data[:count] - mean
                second = second + data[count:].reshape(count, count) + np.outer(away, away) * (n * m / (n + m))
                mean = mean + away * (m / (n + m))
                n += m
        return n, np.zeros(1, np.int64), np.concatenate([mean, second.ravel()])

    some = first.values > ZERO * first.values.max(initial=0)
    error = None
    if some.any():
        _, _, data = _reduced(map_arrow(rows.select("v"), moments, _PART), pooled)
        error = float(np.abs(data[count:].reshape(count, count)[np.ix_(some, some)] / n - np.eye(int(some.sum()))).max())
    explained = [float(v / fitted.trace) if fitted.trace > 0 else None for v in first.values]

    def projections(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x = scaled(part.column(1), width, SCALE) + SHIFT
                away = n * x - fitted.sums
                rough = (away.astype(float) ** 2).sum(axis=1)
                deviation = (away * away).sum(axis=1).tolist()
                for i in np.flatnonzero(rough > 2.0 ** 62):
                    value = sum(int(v) ** 2 for v in away[i])
                    deviation[i] = value if value < 1 << 63 else None
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(np.repeat(np.arange(len(x)), count))), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(x) * count, n)), pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), count))),
                    pa.array(first.whitened(x).ravel(), from_pandas=True), pa.array(explained * len(x), pa.float64()),
                    pa.array([error] * (len(x) * count), pa.float64())],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return map_arrow(rows, projections, schema.replace(f"`{id_col}`", "id", 1)).withColumnRenamed("id", id_col)
