"""Cost-balanced packing of tokenised documents into sequences of a fixed size.

A sequence costs `linear` per token and `quadratic` per squared piece length
(attention inside a document). Documents are taken in descending order of cost;
each goes to the cheapest sequence that still has room for it, and is cut only
where none has. Every task packs its own documents group by group and carries
what is left into its next group, so nothing is shuffled and no sequence but the
last few of a task is short; those have power-of-two lengths, which need no padding.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.arrays import Words, blocks, byte_table, map_arrow, separators, slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIZE, END_ID = 4096, 2
#: Costs of a token and of a squared piece length: attention passes the linear part at 8192 tokens.
LINEAR, QUADRATIC = 1.0, 1.0 / 8192
#: Tokens packed together, bytes of text tokenised together, words and runs of letters a task remembers.
GROUP_TOKENS, TEXT_BYTES, KNOWN_WORDS, KNOWN_CORES = 1 << 20, 2 << 20, 600_000, 150_000
_SEQUENCES_PER_TASK = 40  # bits of a sequence id below the task's number


class Tokens:
    """Ids of whole texts. Words between white space are tokenised on their own and remembered by their 64-bit hash: no id spans white space."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()
        self.cores: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.fold = np.arange(256, dtype=np.uint8)
        self.fold[65:91] += 32

    def _forget(self) -> None:
        self.known, self.begins, self.lengths, self.flat = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, "<u4")

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _learn_cores(self, cores: list[bytes]) -> None:
        """Ids of runs of letters, tokenised together and cut where a token ends a word."""
        ids = self._encode(b" ".join(cores).decode())
        cuts = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
        if len(cuts) == len(cores):
            raw = ids.tobytes()
            self.cores.update(zip(cores, [raw[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)], strict=True))
        else:
            self.cores.update((c, self._encode(c.decode()).tobytes()) for c in cores)

    def _ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of new words. Letters with ASCII marks behind them are two pieces of their own, so the letters are looked up alone."""
        cores = [w.rstrip(b"!\"#$%&()*+,-./:;=?@[]^_`{|}~") for w in words]
        plain = [bool(c) and c.decode("utf-8", "replace").isalpha() for c in cores]
        if len(self.cores) > KNOWN_CORES:  # before this block's are looked up: all of them are then learnt together
            self.cores.clear()
        new = {c for c, p in zip(cores, plain, strict=True) if p and c not in self.cores}
        if new:
            self._learn_cores(list(new))
        marks: dict[bytes, bytes] = {b"": b""}
        out = []
        for word, core, letters in zip(words, cores, plain, strict=True):
            if not letters:
                out.append(self._encode(word.decode("utf-8", "replace")).tobytes())
                continue
            rest = word[len(core):]
            if rest not in marks:
                marks[rest] = self._encode(rest.decode()).tobytes()
            if core not in self.cores:
                self._learn_cores([core])
            out.append(self.cores[core] + marks[rest])
        return out

    def of_block(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the documents of a block in a row, and the documents' offsets in them."""
        if b"<|" not in data.tobytes():  # a marker of the tokenizer counts in its own case only
            data = self.fold[data]
        words = Words(data, bounds, byte_table(folded=False), separators())
        if not len(words.hashes):
            return np.empty(0, "<u4"), np.zeros(len(bounds), np.int64)
        hashed, first, which = np.unique(words.hashes, return_index=True, return_inverse=True)
        if len(self.known) > KNOWN_WORDS:
            self._forget()
        at = np.searchsorted(self.known, hashed)
        new = np.ones(len(hashed), bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != hashed[inside]
        if new.any():
            raw, picked = data.tobytes(), first[new]
            ids = self._ids([raw[a:b] for a, b in zip(words.starts[picked].tolist(), words.ends[picked].tolist(), strict=True)])
            sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            self.known = np.insert(self.known, at[new], hashed[new])
            self.begins = np.insert(self.begins, at[new], len(self.flat) + np.cumsum(sizes) - sizes)
            self.lengths = np.insert(self.lengths, at[new], sizes)
            self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(ids), "<u4")])
            at = np.searchsorted(self.known, hashed)
        lengths, begins = self.lengths[at], self.begins[at]
        counts = lengths[which]
        ends = np.cumsum(counts)
        out = self.flat[np.repeat(begins[which] - (ends - counts), counts) + np.arange(ends[-1])]
        return out, np.concatenate([[0], ends])[words.offsets]


def _powers(n: int) -> list[int]:
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


class _Packer:
    """Packs the documents of one task."""

    def __init__(self, size: int, linear: float, quadratic: float, first_id: int):
        self.size, self.linear, self.quadratic, self.next_id = size, linear, quadratic, first_id
        self.pieces: list[tuple[int, int, int]] = []  # (-length, place in docs, start)
        self.docs: list[tuple[int | None, np.ndarray]] = []
        self.waiting = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple]:
        start = 0
        while len(ids) - start >= self.size:
            yield doc_id, start, ids[start:start + self.size], len(ids), self.next_id, 0
            self.next_id += 1
            start += self.size
        if start < len(ids):
            heapq.heappush(self.pieces, (start - len(ids), len(self.docs), start))
            self.docs.append((doc_id, ids))
            self.waiting += len(ids) - start

    def pack(self, last: bool = False) -> Iterator[tuple]:
        rest = self.waiting % self.size
        room = np.array([self.size] * (self.waiting // self.size) + (_powers(rest) if last else []))
        cost, used = np.zeros(len(room)), np.zeros(len(room), np.int64)
        left = int(room.sum())
        while left:
            negative, doc, start = heapq.heappop(self.pieces)
            length = -negative
            fits = room >= length
            s = int(np.argmin(np.where(fits if fits.any() else room > 0, cost, np.inf)))
            taken = min(length, int(room[s]))
            doc_id, ids = self.docs[doc]
            yield doc_id, start, ids[start:start + taken], len(ids), self.next_id + s, int(used[s])
            if taken < length:
                heapq.heappush(self.pieces, (taken - length, doc, start + taken))
            room[s] -= taken
            used[s] += taken
            cost[s] += self.linear * taken + self.quadratic * taken * taken
            left -= taken
        self.next_id += len(room)
        kept = {doc: i for i, doc in enumerate(sorted({p[1] for p in self.pieces}))}
        self.docs = [self.docs[doc] for doc in kept]
        self.pieces = [(n, kept[doc], start) for n, doc, start in self.pieces]
        heapq.heapify(self.pieces)
        self.waiting = sum(-n for n, _, _ in self.pieces)


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, end_id: int = END_ID,
                   linear: float = LINEAR, quadratic: float = QUADRATIC) -> DataFrame:
    """One row per piece: id, start and length in the document's ids, the ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    A document is its text's ids and `end_id`; a null or empty text is `end_id`
    alone. Each id lies in one piece. Sequences have `size` ids; the last ones of
    a task have power-of-two sizes. A document longer than `size` fills whole
    sequences first, its rest is packed with others. Rows that repeat are
    documents of their own; a null id stays null. `tokenizer` is the path of a
    tokenizer file that every executor has. Other columns are not read.
    """

    def rows(batches):
        tokens = Tokens(tokenizer)
        packer = _Packer(size, linear, quadratic, TaskContext.get().partitionId() << _SEQUENCES_PER_TASK)

        def batch_of(pieces: list[tuple]) -> pa.RecordBatch:
            ids, starts, values, totals, sequences, offsets = zip(*pieces, strict=True)
            return pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array([len(v) for v in values], pa.int64()),
                pa.array([v.tobytes() for v in values], pa.binary()), pa.array(totals, pa.int64()), pa.array(sequences, pa.int64()),
                pa.array(offsets, pa.int64())], names=["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        done: list[tuple] = []
        for batch in slices(batches, 1024):
            doc_ids = batch.column(0).to_pylist()
            for first, _, data, bounds in blocks(batch.column(1), TEXT_BYTES):
                values, offsets = tokens.of_block(data, bounds)
                for d in range(len(bounds) - 1):
                    done.extend(packer.add(doc_ids[first + d], np.append(values[offsets[d]:offsets[d + 1]], np.uint32(end_id))))
                    if packer.waiting >= GROUP_TOKENS:
                        done.extend(packer.pack())
                    if len(done) >= 1000:
                        yield batch_of(done)
                        done = []
        done.extend(packer.pack(last=True))
        if done:
            yield batch_of(done)

    return map_arrow(
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")), rows, "id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long").withColumnRenamed("id", id_col)
