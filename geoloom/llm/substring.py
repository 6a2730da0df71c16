"""Removal of word runs that an earlier document already holds, with a count-min prefilter.

Pass 1 counts the cells of every 13-word window in a count-min sketch that is
cut into segments: each chunk of documents sends its occupied cells to the
segments (two bytes a window and sketch row), a segment merges the counts and
answers one bit per cell. The sketch overestimates, so a window that occurs
twice is never lost. Pass 2 sends only windows estimated repeated, groups them
exactly, and answers whether a smaller document id holds them too. Pass 3
removes the covered words. The texts are exchanged once: all passes read the
same exchange by chunk.
"""

from __future__ import annotations

import itertools
import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.arrays import Words, blocks, byte_table, runs, separators

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Cells of a sketch row per window, rows of the sketch.
CELLS_PER_WINDOW, ROWS = 4, 2
#: Bytes of text in a chunk, windows merged by one segment. Rows exchanged grow with chunks times segments: raise both with the input.
CHUNK_BYTES, SEGMENT_WINDOWS = 8 << 20, 2 << 20
_BYTES_PER_WORD = 6


def _squeeze(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values).tobytes(), codec="zstd", asbytes=True)


def _gaps(sorted_values: np.ndarray) -> tuple[int, bytes]:
    """Sorted distinct numbers as compressed differences; width in bytes first."""
    gaps = np.diff(sorted_values, prepend=sorted_values[:1] * 0)
    width = 2 if not len(gaps) or gaps.max() < 1 << 16 else 4 if gaps.max() < 1 << 32 else 8
    return width, _squeeze(gaps.astype(f"<u{width}"))


def _unsqueeze(data: bytes, n: int, kind: str) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, n * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind)


def _bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


class _Chunk:
    """Windows of a chunk: distinct windows in order of their hashes, and where each window of the text is among them."""

    def __init__(self, ids: np.ndarray, texts: pa.Array, width: int):
        table, breaks = byte_table(folded=False), separators()
        self.counts, first, second, owner, starts = [], [], [], [], []
        words_before = 0
        for begin, _, data, bounds in blocks(texts):
            words = Words(data, bounds, table, breaks)
            one, at = words.windows(width, 1)
            two, _ = words.windows(width, 2)
            first.append(one), second.append(two)
            starts.append(at + words_before)
            owner.append(begin + words.documents()[at] if len(at) else at)
            self.counts.append(words.counts)
            words_before += len(words.hashes)
        join = lambda parts, kind: np.concatenate(parts).astype(kind, copy=False) if parts else np.empty(0, kind)
        one, two = join(first, np.uint64), join(second, np.uint64)
        self.counts, self.starts, owner = join(self.counts, np.int64), join(starts, np.int64), join(owner, np.int64)
        order = np.argsort(one)
        if ((one[order][1:] == one[order][:-1]) & (two[order][1:] != two[order][:-1])).any():
            order = np.lexsort((two, one))
        one, two, owner, self.starts = one[order], two[order], owner[order], self.starts[order]
        at = runs(one) if len(one) < 2 else np.flatnonzero(np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])]))
        self.one, self.two, self.sizes = one[at], two[at], np.diff(np.append(at, len(one)))
        self.ids = ids[owner]
        self.least = np.minimum.reduceat(self.ids, at) if len(at) else self.ids


class _Cells:
    """Occupied cells of one sketch row in a chunk, cut into segments."""

    def __init__(self, hashed: np.ndarray, sizes: np.ndarray, cell_bits: int, segment_bits: int):
        order = np.argsort(hashed)
        cells = hashed[order] >> np.uint64(64 - cell_bits)
        at = runs(cells)
        self.cells = cells[at]
        self.twice = (np.add.reduceat(sizes[order], at) if len(at) else at) > 1
        self.which = np.empty(len(hashed), np.int64)
        self.which[order] = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(cells))))
        low = np.uint64(cell_bits - segment_bits)
        self.segments = (self.cells >> low).astype(np.int64)
        self.inside = (self.cells & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
        self.cuts = np.append(runs(self.segments), len(self.segments))


def repeated_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13,
                   chunk_bytes: int = CHUNK_BYTES, segment_windows: int = SEGMENT_WINDOWS) -> DataFrame:
    """Remove every word covered by a window that also starts in a document with a smaller id.

    Returns one row per input row: id, n_words, n_removed and the kept words
    joined by one space. Words are runs of anything but ASCII white space. A
    null or empty text has no words and an empty rest; a text shorter than the
    window loses nothing, whatever its length otherwise. Rows that share an id
    are one document to the rule (none removes from the other); a null id is
    larger than every other id. Other columns of the input are not read.
    """
    texts = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), texts.alias("words"))
    size = rows.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    chunks = max(1, math.ceil(size / chunk_bytes))
    windows = max(1, size // _BYTES_PER_WORD)
    segment_bits = max(0, math.ceil(math.log2(max(1, windows / segment_windows))))
    cell_bits = max(segment_bits + 4, math.ceil(math.log2(CELLS_PER_WINDOW * windows)))
    no_id = np.iinfo(np.int64).max

    def chunk_of(table: pa.Table) -> tuple[np.ndarray, _Chunk]:
        ids = table.column("id").fill_null(no_id).to_numpy()
        return ids, _Chunk(ids, table.column("words"), window)

    def occupied(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        _, chunk = chunk_of(table)
        out = []
        for row, hashed in enumerate((chunk.one, chunk.two)):
            cells = _Cells(hashed, chunk.sizes, cell_bits, segment_bits)
            for a, b in itertools.pairwise(cells.cuts):
                width, gaps = _gaps(cells.inside[a:b])
                out.append({"segment": (row << segment_bits) + int(cells.segments[a]), "chunk": key[0].as_py(), "n": int(b - a),
                            "width": width, "cells": gaps, "twice": np.packbits(cells.twice[a:b]).tobytes()})
        return pa.Table.from_pylist(out, schema=counts_schema)

    def merged(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        seen = np.zeros(1 << (cell_bits - segment_bits), np.uint8)
        held = []
        for part in table.to_batches(max_chunksize=64):
            for row in part.to_pylist():
                at = np.cumsum(_unsqueeze(row["cells"], row["n"], f"<u{row['width']}").astype(np.int64))
                seen[at] = np.minimum(seen[at] + np.uint8(1) + _bits(row["twice"], row["n"]), 2)
                held.append((row["chunk"], at.astype(np.uint32)))
        return pa.Table.from_pylist(
            [{"chunk": c, "segment": key[0].as_py(), "n": len(at), "again": np.packbits(seen[at] > 1).tobytes()} for c, at in held],
            schema=again_schema)

    def estimated(key: tuple[pa.Scalar, ...], texts_of: pa.Table, answers: pa.Table) -> pa.Table:
        _, chunk = chunk_of(texts_of)
        answer = {a["segment"]: _bits(a["again"], a["n"]) for a in answers.to_pylist()}
        repeated = np.ones(len(chunk.one), bool)
        for row, hashed in enumerate((chunk.one, chunk.two)):
            cells = _Cells(hashed, chunk.sizes, cell_bits, segment_bits)
            flags = [answer[(row << segment_bits) + int(cells.segments[a])] for a in cells.cuts[:-1]]
            if flags:
                repeated &= np.concatenate(flags)[cells.which]
        segments = chunk.one >> np.uint64(64 - segment_bits) if segment_bits else np.zeros(len(chunk.one), np.uint64)
        out = []
        for a, b in itertools.pairwise(np.append(runs(segments), len(segments))):
            pick = repeated[a:b]
            least = chunk.least[a:b][pick]
            base = int(least.min()) if len(least) else 0
            offsets = least - base
            width = 4 if not len(offsets) or 0 <= offsets.max() < 1 << 32 else 8
            out.append({"segment": int(segments[a]), "chunk": key[0].as_py(), "n": int(pick.sum()), "base": base, "width": width,
                        "one": chunk.one[a:b][pick].tobytes(), "two": (chunk.two[a:b][pick] >> np.uint64(32)).astype("<u4").tobytes(),
                        "least": offsets.astype(f"<u{width}").tobytes(), "all": int(b - a), "picked": np.packbits(pick).tobytes()})
        return pa.Table.from_pylist(out, schema=windows_schema)

    def grouped(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        held, parts = [], []
        for part in table.to_batches(max_chunksize=64):
            for row in part.to_pylist():
                held.append((row["chunk"], row["n"], row["all"], row["picked"]))
                parts.append((np.frombuffer(row["one"], "<u8"), np.frombuffer(row["two"], "<u4"),
                              np.frombuffer(row["least"], f"<u{row['width']}").astype(np.int64) + row["base"]))
        one, two, least = (np.concatenate([p[k] for p in parts]) for k in range(3))
        order = np.lexsort((two, one))
        same = np.zeros(len(order), bool)
        same[1:] = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
        at = np.flatnonzero(~same)
        smallest = np.empty_like(least)
        if len(at):
            smallest[order] = np.repeat(np.minimum.reduceat(least[order], at), np.diff(np.append(at, len(order))))
        earlier, out, a = smallest < least, [], 0
        for chunk, n, total, picked in held:
            out.append({"chunk": chunk, "segment": key[0].as_py(), "n": n, "all": total, "picked": picked,
                        "earlier": np.packbits(earlier[a:a + n]).tobytes()})
            a += n
        return pa.Table.from_pylist(out, schema=earlier_schema)

    def removed(key: tuple[pa.Scalar, ...], texts_of: pa.Table, answers: pa.Table) -> pa.Table:
        ids, chunk = chunk_of(texts_of)
        earlier, answer = np.zeros(len(chunk.one), bool), sorted(answers.to_pylist(), key=lambda a: a["segment"])
        a = 0
        for row in answer:
            picked = np.zeros(row["all"], bool)
            picked[_bits(row["picked"], row["all"])] = _bits(row["earlier"], row["n"])
            earlier[a:a + row["all"]] = picked
            a += row["all"]
        gone = np.repeat(earlier, chunk.sizes) | (chunk.ids > np.repeat(chunk.least, chunk.sizes))
        offsets = np.concatenate([[0], np.cumsum(chunk.counts)])
        change = np.zeros(offsets[-1] + window + 1, np.int32)
        np.add.at(change, chunk.starts[gone], 1)
        np.add.at(change, chunk.starts[gone] + window, -1)
        covered = np.cumsum(change)[:offsets[-1]] > 0
        n_removed = np.diff(np.concatenate([[0], np.cumsum(covered)])[offsets])
        kept = []
        for i, text in enumerate(texts_of.column("words")):
            words = text.as_py().encode().split()
            if n_removed[i]:
                words = itertools.compress(words, ~covered[offsets[i]:offsets[i + 1]])
            kept.append(b" ".join(words))
        return pa.table({"id": texts_of.column("id"), "n_words": chunk.counts, "n_removed": n_removed.astype(np.int64),
                         "kept": pa.array(kept, pa.binary()).cast(pa.string())})

    counts_schema = pa.schema([("segment", pa.int64()), ("chunk", pa.int64()), ("n", pa.int64()), ("width", pa.int64()), ("cells", pa.binary()), ("twice", pa.binary())])
    again_schema = pa.schema([("chunk", pa.int64()), ("segment", pa.int64()), ("n", pa.int64()), ("again", pa.binary())])
    windows_schema = pa.schema([
        ("segment", pa.int64()), ("chunk", pa.int64()), ("n", pa.int64()), ("base", pa.int64()), ("width", pa.int64()),
        ("one", pa.binary()), ("two", pa.binary()), ("least", pa.binary()), ("all", pa.int64()), ("picked", pa.binary())])
    earlier_schema = pa.schema([("chunk", pa.int64()), ("segment", pa.int64()), ("n", pa.int64()), ("all", pa.int64()), ("picked", pa.binary()), ("earlier", pa.binary())])

    # The text takes part in the key, so that neither a null id nor one many rows share lands in one chunk.
    by_chunk = rows.withColumn("chunk", F.pmod(F.xxhash64("id", "words"), F.lit(chunks))).groupBy("chunk")
    counted = by_chunk.applyInArrow(occupied, "segment long, chunk long, n long, width long, cells binary, twice binary")
    again = counted.groupBy("segment").applyInArrow(merged, "chunk long, segment long, n long, again binary")
    candidates = by_chunk.cogroup(again.groupBy("chunk")).applyInArrow(
        estimated, "segment long, chunk long, n long, base long, width long, one binary, two binary, least binary, all long, picked binary")
    found = candidates.groupBy("segment").applyInArrow(
        grouped, "chunk long, segment long, n long, all long, picked binary, earlier binary")
    return by_chunk.cogroup(found.groupBy("chunk")).applyInArrow(
        removed, "id long, n_words long, n_removed long, kept string").withColumnRenamed("id", id_col)
