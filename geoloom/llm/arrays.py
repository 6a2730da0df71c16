"""Words, word hashes and shingles of whole Arrow batches, as numpy arrays.

Texts are read as UTF-8 bytes straight from the Arrow buffers, in blocks of a
few documents, so memory follows the block and not the batch. All hashes are
fixed functions of the bytes: they agree between tasks, machines and runs.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame

# Functions that Spark sends to its workers travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of text that one block of documents holds at least (a longer document is a block of its own).
BLOCK_BYTES = 1 << 20

#: Bytes of the Arrow batches that a Python task is handed, at most (a longer row is a batch of its own).
BATCH_BYTES = 8 << 20
_BATCH_SETTING, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"

#: The six bytes of white space that separate words.
WHITE_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"

_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values evenly (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_table(folded: bool) -> np.ndarray:
    """A 64-bit value for each byte; with `folded`, A-Z have the values of a-z."""
    table = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _STEP)
    if folded:
        table[65:91] = table[97:123]
    return table


def release() -> None:
    """Hand memory that nothing uses any more back to the system: workers are reused by later tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def bound_batches(df: DataFrame) -> None:
    """From here on the session hands Python tasks batches of at most BATCH_BYTES, unless a bound was set before."""
    conf = df.sparkSession.conf
    if conf.get(_BATCH_SETTING) == _BATCH_DEFAULT:
        conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def map_arrow(df: DataFrame, rows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """mapInArrow with batches of bounded bytes; what a task held goes back to the system at its end."""
    bound_batches(df)

    def released(batches):
        try:
            yield from rows(batches)
        finally:
            release()

    return df.mapInArrow(released, schema)


def separators(extra: bytes = b"") -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(WHITE_SPACE + extra)] = True
    return table


_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size, root = max(n, 2 * BLOCK_BYTES), 0xD1342543DE82EF95
        both = []
        for r in (root, pow(root, -1, 1 << 64)):
            factors = np.full(size, np.uint64(r))
            factors[0] = 1
            both.append(np.cumprod(factors))
        _powers[:] = both
    return _powers[0], _powers[1]


class Words:
    """The words of a block of documents: `hashes` in order, `offsets` (documents + 1) into them, `starts` and `ends` as bytes of `data`."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, table: np.ndarray, breaks: np.ndarray):
        self.data = data
        inside = ~breaks[data]
        before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edges = bounds[(bounds > 0) & (bounds < len(data))]
        before[edges], after[edges - 1] = False, False
        self.starts, self.ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        self.offsets = np.searchsorted(self.starts, bounds)
        power, inverse = _power_tables(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(table[data] * power[: len(data)], out=sums[1:])
        spans = (sums[self.ends] - sums[self.starts]) * inverse[self.starts]
        self.hashes = mix(spans + (self.ends - self.starts).astype(np.uint64) * _STEP)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def documents(self) -> np.ndarray:
        """The document (row of the block) of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    def windows(self, width: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each run of `width` words that lies in one document, and the index of its first word."""
        n = len(self.hashes) - width + 1
        if n <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        factor = np.uint64(0xDA942042E4DD58B5 + 2 * salt)
        rolled = np.full(n, np.uint64(salt))
        for j in range(width):
            rolled = rolled * factor + self.hashes[j:j + n]
        last = np.repeat(self.offsets[1:], self.counts)
        at = np.flatnonzero(last[:n] >= np.arange(width, width + n))
        return mix(rolled[at]), at


def blocks(texts: pa.Array, least: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a text column (null: empty) into blocks: first row, row after the last, bytes, bounds of the rows in them."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.empty(0, np.uint8)
    first = 0
    while first < len(texts):
        end = int(np.searchsorted(offsets, offsets[first] + least))
        end = min(max(end, first + 1), len(texts))
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of a few rows, for work that makes Python objects of each."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal neighbours."""
    if not len(sorted_keys):
        return np.empty(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))


def shingle_sets(texts: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Distinct shingles of lower-cased (A-Z) words, per block: first row, offsets of the rows, sorted hashes.

    A text of fewer words than `width` has its whole sequence as its only
    shingle; one without words has none.
    """
    table, breaks = byte_table(folded=True), separators()
    for first, end, data, bounds in blocks(texts):
        words = Words(data, bounds, table, breaks)
        hashed, at = words.windows(width)
        owner = words.documents()[at] if len(at) else np.empty(0, np.int64)
        short = np.flatnonzero((words.counts > 0) & (words.counts < width))
        if len(short):
            whole = words.counts[short].astype(np.uint64)
            for j in range(width - 1):
                there = words.counts[short] > j
                whole[there] = mix(whole[there] * _STEP + words.hashes[words.offsets[short[there]] + j])
            hashed, owner = np.concatenate([hashed, whole]), np.concatenate([owner, short])
        order = np.lexsort((hashed, owner))
        hashed, owner = hashed[order], owner[order]
        fresh = np.ones(len(hashed), bool)
        fresh[1:] = (hashed[1:] != hashed[:-1]) | (owner[1:] != owner[:-1])
        hashed, owner = hashed[fresh], owner[fresh]
        yield first, np.searchsorted(owner, np.arange(end - first + 1)), hashed


def binaries(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Slices of an array as a binary column, without a loop."""
    values = np.ascontiguousarray(values)
    byte_offsets = (np.asarray(offsets, np.int64) * values.itemsize).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(byte_offsets), pa.py_buffer(values)]).cast(pa.binary())
