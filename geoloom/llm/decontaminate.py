"""Benchmark passages in documents, under word edits, by CGK embedding and bit-sampling LSH.

The CGK walk copies the current word and steps on by a random bit of it, so that
texts a few edits apart have embeddings with a small Hamming distance. Equal
samples of a few places of the embedding make an item-sized window of a document
a candidate for an item; enough walks and samples bring the recall to target.
Long items are searched as pieces of bounded length: of the pieces of an item
within the distance at least one is within its own share of the edits, so that
the recall does not fall with the length. Windows that share too few neighbouring word pairs with any item of their length
to be within the distance are left out before (no window within it is lost).
Candidates are verified by the exact edit distance.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.arrays import Words, blocks, byte_table, map_arrow, mix, separators, slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Items of fewer words must occur word by word; edits allowed in hundredths of the words of the others.
LEAST_WORDS, PERCENT = 8, 20
#: Random walks, samples of each walk's embedding, places of a sample: recall of at least 0.99 over distances up to the largest and of at least 0.96 at the largest itself, for up to PIECE words (tests/llm measures it).
WALKS, SAMPLES, PLACES = 8, 12, 3
#: Words of the pieces that an item is searched in, at most.
PIECE = 32
#: Words of the items searched for together; a larger benchmark is searched in several passes.
SLICE_WORDS = 200_000
#: Bytes of text searched together.
BLOCK = 2 << 20
_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_PAIR = np.uint64(0xA24BAED4963EE407)


def _words(texts: pa.Array, least: int) -> Iterator[tuple[int, int, Words]]:
    """Lower-cased words between white space and ASCII punctuation."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    table, breaks = byte_table(folded=False), separators(_PUNCTUATION)
    for first, end, data, bounds in blocks(pc.utf8_lower(texts.cast(pa.large_string())), least):
        yield first, end, Words(data, bounds, table, breaks)


def _allowed(n: int) -> int:
    return PERCENT * n // 100


def best_match(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Smallest word edit distance of the item to a run of words of the text, and start and end of the run that ends first (of those the longest, so that a changed or followed first word is in it)."""
    best, end = _nearest(item, text, anchored=False)
    _, length = _nearest(item[::-1], text[:end][::-1], anchored=True)
    return best, end - length, end


def _nearest(item: np.ndarray, text: np.ndarray, anchored: bool) -> tuple[int, int]:
    """Smallest distance of the item to a run of the text and the first end of such a run; an anchored run starts with the text and has its last end (bit-parallel dynamic programme)."""
    n = len(item)
    masks: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        masks[w] = masks.get(w, 0) | 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, distance = full, 0, n
    best, end = n, 0
    for j, w in enumerate(text.tolist()):
        same = masks.get(w, 0)
        diagonal = (((same & up) + up) ^ up) | same | down
        right_up, right_down = down | ~(diagonal | up) & full, up & diagonal
        distance += bool(right_up & top) - bool(right_down & top)
        right_up, right_down = (right_up << 1 | anchored) & full, (right_down << 1) & full
        up, down = (right_down | ~(diagonal | right_up)) & full, right_up & diagonal
        if distance < best or anchored and distance == best:
            best, end = distance, j + 1
    return best, end


class Search:
    """Finds the items (lists of word hashes) in blocks of documents."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        self.items = items
        #: (item, its words before the piece, words of the piece)
        self.pieces: list[tuple[int, int, np.ndarray]] = []
        short: dict[int, list[int]] = {}
        for member, (_, words) in enumerate(items):
            if len(words) < LEAST_WORDS:
                short.setdefault(len(words), []).append(member)
                continue
            count = -(-len(words) // PIECE)
            cuts = [len(words) * i // count for i in range(count + 1)]
            self.pieces += [(member, a, words[a:b]) for a, b in zip(cuts, cuts[1:])]
        self.by_length: dict[int, list[int]] = {}
        for k, (_, _, words) in enumerate(self.pieces):
            self.by_length.setdefault(len(words), []).append(k)
        # Lengths a quarter apart share a class; a class is a bit of the table of word pairs.
        self.classes: list[list[int]] = []
        for n in sorted(self.by_length):
            if self.classes and 4 * n < 5 * self.classes[-1][0]:
                self.classes[-1].append(n)
            else:
                self.classes.append([n])
        pairs = sum(max(0, len(w) - 1) for _, _, w in self.pieces)
        self.bits = max(16, int(np.ceil(np.log2(64 * max(1, pairs)))))
        self.table = np.zeros(1 << self.bits, np.uint64)
        for c, lengths in enumerate(self.classes):
            for n in lengths:
                for k in self.by_length[n]:
                    at = self._pairs(self.pieces[k][2])
                    self.table[at] |= np.uint64(1) << np.uint64(c % 64)
        # An edit changes two pairs and may join two runs of a repeated word, which then count once.
        self.need = [max(1, min(int(self._fresh(self.pieces[k][2]).sum()) - 3 * _allowed(n) for n in lengths for k in self.by_length[n])) for lengths in self.classes]
        # Places are drawn from the part of the walk that the shortest item of the class fills.
        rng = np.random.default_rng(20240601)
        self.keys = []
        for lengths in self.classes:
            members = np.array([k for n in lengths for k in self.by_length[n]])
            words = np.ones((len(members), lengths[-1]), np.uint64)
            for row, k in enumerate(members):
                words[row, :len(self.pieces[k][2])] = self.pieces[k][2]
            most = max(PLACES, 3 * lengths[0] // 2)
            places = [[np.sort(rng.choice(most, PLACES, replace=False)) for _ in range(SAMPLES)] for _ in range(WALKS)]
            keys = []
            for walk in range(WALKS):
                for found in self._sampled(words, walk, places[walk]):
                    order = np.argsort(found, kind="stable")
                    keys.append((found[order], members[order]))
            self.keys.append((places, keys))

        #: Length of short items, their sorted keys and the items.
        self.short: list[tuple[int, np.ndarray, np.ndarray]] = []
        for n, members in sorted(short.items()):
            found = np.array([self._runs(items[k][1], n)[0] for k in members])
            order = np.argsort(found, kind="stable")
            self.short.append((n, found[order], np.array(members)[order]))

    @staticmethod
    def _runs(words: np.ndarray, n: int) -> np.ndarray:
        """Keys of the runs of n words."""
        key = np.zeros(max(0, len(words) - n + 1), np.uint64)
        for j in range(n):
            key = mix(key * _PAIR + words[j:j + len(key)])
        return key

    def _pairs(self, words: np.ndarray) -> np.ndarray:
        return (mix(words[:-1] * _PAIR + words[1:]) >> np.uint64(64 - self.bits)).astype(np.int64)

    @staticmethod
    def _sampled(words: np.ndarray, walk: int, places: list[np.ndarray]) -> list[np.ndarray]:
        """Keys of the samples of one walk over each row of words."""
        count, width = words.shape
        wanted = {int(p) for sample in places for p in sample}
        seen: dict[int, np.ndarray] = {}
        row, at = np.arange(count) * width, np.zeros(count, np.int64)
        flat = words.ravel()
        for step in range(max(wanted) + 1):
            if step % 64 == 0:
                coins = mix(flat ^ mix(np.full(1, walk * 1_000_003 + step, np.uint64)))
            place = row + at
            if step in wanted:
                seen[step] = flat[place]
            at = np.minimum(at + ((coins[place] >> np.uint64(step % 64)) & np.uint64(1)).astype(np.int64), width - 1)
        out = []
        for sample in places:
            key = np.zeros(count, np.uint64)
            for p in sample:
                key = mix(key * _PAIR + seen[int(p)])
            out.append(key)
        return out

    @staticmethod
    def _fresh(words: np.ndarray) -> np.ndarray:
        """Whether each neighbouring pair differs from the pair before it: a word said over and over counts once."""
        fresh = np.ones(max(0, len(words) - 1), bool)
        if len(words) > 2:
            fresh[1:] = (words[2:] != words[1:-1]) | (words[1:-1] != words[:-2])
        return fresh

    def _starts(self, words: Words, flags: np.ndarray, lengths: list[int], c: int) -> np.ndarray:
        """First words of windows that share enough word pairs with the pieces of a class."""
        low, high = lengths[0], lengths[-1]
        pairs = np.concatenate([[0], np.cumsum((flags >> np.uint64(c % 64)).astype(np.uint8) & np.uint8(1), dtype=np.int32)])
        need = self.need[c]
        reach = high + _allowed(high) - 1
        total = len(words.hashes)
        if pairs[-1] < need:
            return np.empty(0, np.int64)
        # Over all windows first, without regard to where documents end; the few that pass are then cut at the end of theirs.
        ends = np.minimum(np.arange(total) + reach, total - 1)
        some = np.flatnonzero(pairs[ends] - pairs[:total] >= need)
        if not len(some):
            return some
        last = words.offsets[np.searchsorted(words.offsets, some, side="right")] - 1
        some_ends = np.minimum(some + reach, last)
        return some[(pairs[np.maximum(some_ends, some)] - pairs[some] >= need) & (last - some + 1 >= low - _allowed(low))]

    def _word_by_word(self, words: Words) -> Iterator[tuple[int, int, int, int, int]]:
        """The first place of each short item in each document."""
        for n, known, members in self.short:
            found = self._runs(words.hashes, n)
            left, right = np.searchsorted(known, found), np.searchsorted(known, found, side="right")
            at = np.flatnonzero(right > left)
            owner = np.searchsorted(words.offsets, at, side="right") - 1
            inside = at + n <= words.offsets[owner + 1]
            at, owner = at[inside], owner[inside]
            for i in np.unique(owner * len(known) + left[at], return_index=True)[1]:
                place = int(at[i] - words.offsets[owner[i]])
                for member in members[left[at[i]]:right[at[i]]]:
                    yield int(owner[i]), int(member), 0, place, place + n

    def block(self, words: Words) -> Iterator[tuple[int, int, int, int, int]]:
        """(document of the block, item, distance, first word of the match, word after it)."""
        hashes = words.hashes
        yield from self._word_by_word(words)
        if len(hashes) < 2 or not self.pieces:
            return
        flags = np.append(np.where(self._fresh(hashes), self.table[self._pairs(hashes)], np.uint64(0)), np.uint64(0))
        crossing = words.offsets[1:-1] - 1  # pairs over the end of a document
        flags[crossing[crossing >= 0]] = 0
        candidates: dict[tuple[int, int], list[int]] = {}
        for c, lengths in enumerate(self.classes):
            starts = self._starts(words, flags, lengths, c)
            if not len(starts):
                continue
            owner = np.searchsorted(words.offsets, starts, side="right") - 1
            # A window that the end of its document cuts short is filled up with a word of its own.
            place = starts[:, None] + np.arange(lengths[-1])
            windows = np.where(place < words.offsets[owner + 1][:, None], hashes[np.minimum(place, len(hashes) - 1)], np.uint64(1))
            places, keys = self.keys[c]
            for walk in range(WALKS):
                for found, (known, members) in zip(self._sampled(windows, walk, places[walk]), keys[walk * SAMPLES:(walk + 1) * SAMPLES], strict=True):
                    left, right = np.searchsorted(known, found), np.searchsorted(known, found, side="right")
                    for w in np.flatnonzero(right > left):
                        for piece in members[left[w]:right[w]]:
                            member, before, _ = self.pieces[piece]
                            candidates.setdefault((int(owner[w]), member), []).append(int(starts[w]) - before)
        for (doc, member), at in sorted(candidates.items()):
            item = self.items[member][1]
            n, k = len(item), _allowed(len(item))
            base, limit = int(words.offsets[doc]), int(words.offsets[doc + 1])
            # All that a match near a candidate can take up, once where it overlaps.
            regions: list[list[int]] = []
            for s in sorted(set(at)):
                first, last = max(base, s - k), min(limit, s + n + 2 * k)
                if regions and first <= regions[-1][1]:
                    regions[-1][1] = last
                else:
                    regions.append([first, last])
            best = None
            for first, last in regions:
                distance, start, end = best_match(item, hashes[first:last])
                if distance <= k and (best is None or distance < best[0]):
                    best = (distance, first + start, first + end)
            if best:
                yield doc, member, best[0], best[1] - base, best[2] - base


def _passes(benchmark: DataFrame, id_col: str, text_col: str) -> list[list[tuple[int, np.ndarray]]]:
    """Items with their words, cut so that what a pass sends to the executors is bounded by SLICE_WORDS."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).distinct().orderBy(F.col("id").asc_nulls_last(), "text")
    passes, size = [[]], 0
    seen: set[bytes] = set()
    for batch in rows.toArrow().to_batches():
        for first, end, words in _words(batch.column(1).fill_null(""), BLOCK):
            for d in range(end - first):
                item = words.hashes[words.offsets[d]:words.offsets[d + 1]]
                key, id_ = hashlib.blake2b(item.tobytes(), digest_size=16).digest(), batch.column(0)[first + d].as_py()
                if not len(item) or id_ is None and key in seen:
                    continue
                seen.add(key)
                if size and size + len(item) > SLICE_WORDS:
                    passes.append([])
                    size = 0
                passes[-1].append((id_, item))
                size += len(item)
    return [p for p in passes if p]


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Rows (id, item, distance, start_word, end_word): documents with a run of words within 20 % word edits of a benchmark item, and its place.

    Words are lower-cased and lie between white space and ASCII punctuation. An item
    of fewer than 8 words must occur word by word, however short it is; texts and
    items may be null or without words and then hold nothing. A document gives one
    row per item, the best match (of equal ones the one that ends first, of those the longest). Null and repeated ids of
    documents are kept; rows that repeat an item's id are items of their own. Items
    without an id are returned with a null one; if their words are those of an item
    with an id or of another without one, they are that item. Other columns are not read.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"`{id_col}` long, `{item_col}` long, distance long, start_word long, end_word long"
    found = source.sparkSession.createDataFrame([], schema)
    for k, items in enumerate(_passes(benchmark, item_col, item_text_col)):

        def rows(batches, items=items):
            search = Search(items)
            for batch in slices(batches, 1024):
                ids = batch.column(0).to_pylist()
                for first, _, words in _words(batch.column(1).fill_null(""), BLOCK):
                    hits = [(ids[first + d], items[m][0], *rest) for d, m, *rest in search.block(words)]
                    if hits:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*hits, strict=True)], names=["id", "item", "distance", "start_word", "end_word"])

        part = map_arrow(source, rows, "id long, item long, distance long, start_word long, end_word long").toDF(id_col, item_col, "distance", "start_word", "end_word")
        found = part if k == 0 else found.unionByName(part)
    return found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows whose text holds no benchmark item, with all their columns, whatever their names.

    A null or empty text holds nothing and stays. Rows that repeat are judged each by its own text.
    """
    place = docs.columns.index(text_col)
    for items in _passes(benchmark, item_col, item_text_col):

        def rows(batches, items=items):
            search = Search(items)
            for batch in slices(batches, 1024):
                keep = np.ones(batch.num_rows, bool)
                for first, _, words in _words(batch.column(place).fill_null(""), BLOCK):
                    for hit in search.block(words):
                        keep[first + hit[0]] = False
                yield batch.filter(pa.array(keep))

        docs = map_arrow(docs, rows, docs.schema)
    return docs
