"""Best-fit packing with a bounded number of open sequences.

Pieces are packed as they come. Open sequences are found by their free space: a
bitset holds one bit per amount of free space, so the smallest space that still
holds a piece is the lowest bit above its length. If no open sequence has room a
new one is opened; before there are too many, the fullest one is closed. What a
task leaves open is packed again, whole sequences as pieces, together with what
other tasks leave.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.arrays import map_arrow, slices
from geoloom.runtime import broadcast_if_small, scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIZE, END_ID = 2048, 0
#: Sequences a task keeps open, and rows of open sequences that are packed again in one task.
MOST_OPEN, REPACKED = 256, 50_000
_SEQUENCES_PER_TASK = 40  # bits of a sequence id below the task's number
#: Pieces handed on together.
_PIECES = 1000

#: Fixed value: the split of text that byte-level vocabularies were made with.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Ids of whole texts by a tokenizer file, without special tokens around them.

    A plain byte-level vocabulary (no normaliser, the usual split, merges in the order of their ids) is applied by the
    faster of two libraries, which gives the same ids; texts with an added token in them, and all other files, go through the first.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        self.added = [t["content"] for t in content["added_tokens"]]
        self.plain = self._plain(content)

    @staticmethod
    def _plain(content: dict):
        model, split = content["model"], content["pre_tokenizer"] or {}
        kind = (model.get("type"), split.get("type"), split.get("add_prefix_space"), split.get("use_regex"), content.get("normalizer"), content.get("truncation"))
        extras = [model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")]
        if kind != ("BPE", "ByteLevel", False, True, None, None) or any(extras):
            return None
        added = {t["content"] for t in content["added_tokens"]}
        vocabulary = {token: i for token, i in model["vocab"].items() if token not in added}
        merged = [vocabulary.get("".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
        if None in merged or merged != sorted(merged) or len(vocabulary) != 256 + len(set(merged)):
            return None
        # A byte that prints stands for itself, the others for the code points from 256 on.
        printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(b): b for b in printed} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printed)}
        import tiktoken

        ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary.items()}
        return tiktoken.Encoding("plain", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.plain is None or any(token in text for token in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(self.plain.encode_ordinary(text), "<u4")


class OpenSequences:
    """At most `most` open sequences of `size` places, found by their free space."""

    def __init__(self, size: int, most: int):
        self.size, self.most, self.open = size, most, 0
        self.bits = 0  # bit f is set while a sequence with f free places is open
        self.by_space: dict[int, list[int]] = {}

    def _take(self, space: int) -> int:
        names = self.by_space[space]
        name = names.pop()
        self.open -= 1
        if not names:
            del self.by_space[space]
            self.bits &= ~(1 << space)
        return name

    def place(self, length: int, new: int) -> tuple[int, int, list[int]]:
        """The sequence that takes a piece (`new` if it has to be opened), the piece's offset in it, the sequences that closed."""
        closed = []
        room = self.bits >> length
        if room:
            space = length + (room & -room).bit_length() - 1
            name = self._take(space)
        else:
            if self.open == self.most:
                closed.append(self._take((self.bits & -self.bits).bit_length() - 1))
            name, space = new, self.size
        left = space - length
        if left:
            self.by_space.setdefault(left, []).append(name)
            self.bits |= 1 << left
            self.open += 1
        else:
            closed.append(name)
        return name, self.size - space, closed


class _Packer:
    """Packs the documents of one task; a sequence is handed on, all its pieces together, when it closes."""

    def __init__(self, size: int, most: int, first_id: int):
        self.size, self.next_id, self.sequences = size, first_id, OpenSequences(size, most)
        self.content: dict[int, list[tuple]] = {}

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple]:
        start, piece = 0, 0
        while start < len(ids):
            length = min(len(ids), self.size) if start else (len(ids) - 1) % self.size + 1
            name, offset, closed = self.sequences.place(length, self.next_id)
            self.next_id += name == self.next_id
            self.content.setdefault(name, []).append((doc_id, piece, start, length, ids[start:start + length].tobytes(), offset))
            for done in closed:
                yield from self._pieces(done, False)
            start, piece = start + length, piece + 1

    def _pieces(self, name: int, still_open: bool) -> Iterator[tuple]:
        pieces = self.content.pop(name)
        used = sum(p[3] for p in pieces)
        for p in pieces:
            yield *p, name, used, still_open

    def rest(self) -> Iterator[tuple]:
        for name in sorted(self.content):
            yield from self._pieces(name, True)


_TABLE = pa.schema([("id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("offset", pa.int64()),
                    ("sequence_id", pa.int64()), ("used", pa.int64()), ("still_open", pa.bool_())])


def pack_best_fit(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, end_id: int = END_ID,
                  most_open: int = MOST_OPEN) -> DataFrame:
    """One row per piece: id, piece (from 0), start and length in the document's ids, the ids (little-endian unsigned 32-bit), sequence_id, offset.

    A document is its text's ids and `end_id`; a null or empty text is `end_id`
    alone. Documents of up to `size` ids are one piece. Longer ones are cut into
    pieces of `size`, the first one shorter where it does not divide evenly. No
    sequence has more than `size` ids. Rows that repeat are documents of their
    own; a null id stays null; an empty table has no pieces. `tokenizer` is the
    path of a tokenizer file that every executor has. Other columns are not read.

    The pieces are written once, to the shared folder, so that no text is
    tokenised twice and a lost executor changes no sequence.
    """

    def rows(batches):
        encoder, packer = Encoder(tokenizer), _Packer(size, most_open, TaskContext.get().partitionId() << _SEQUENCES_PER_TASK)
        end = np.array([end_id], "<u4")

        def pieces():
            for batch in slices(batches):
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    yield from packer.add(doc_id, np.concatenate([encoder.ids(text.as_py() or ""), end]))
            yield from packer.rest()

        done: list[tuple] = []
        for p in pieces():
            done.append(p)
            if len(done) == _PIECES:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), _TABLE.types, strict=True)], schema=_TABLE)
                done = []
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), _TABLE.types, strict=True)], schema=_TABLE)

    spark = docs.sparkSession
    path = scratch_path(spark, "pieces")
    map_arrow(
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")), rows,
        "id long, piece int, start long, length long, ids binary, offset long, sequence_id long, used long, still_open boolean",
    ).write.option("compression", "zstd").parquet(path)
    pieces = spark.read.parquet(path)
    left = pieces.filter("still_open AND offset = 0").select("sequence_id", "used")
    tasks = 1 + left.count() // REPACKED

    def again(batches):
        sequences = OpenSequences(size, most_open)
        for batch in batches:
            names, lengths = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            placed = [sequences.place(length, name)[:2] for name, length in zip(names, lengths, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in zip(*placed, strict=True))], names=["sequence_id", "_into", "_shift"])

    # In a fixed order, so that a task that runs again places alike.
    moved = map_arrow(left.repartition(tasks, F.xxhash64("sequence_id")).sortWithinPartitions("sequence_id"), again, "sequence_id long, _into long, _shift long")
    columns = ["id", "piece", "start", "length", "ids", "sequence_id", "offset"]
    opened = pieces.filter("still_open").join(broadcast_if_small(moved), "sequence_id") \
        .withColumns({"sequence_id": F.col("_into"), "offset": F.col("offset") + F.col("_shift")})
    return pieces.filter("NOT still_open").select(*columns).unionByName(opened.select(*columns)).withColumnRenamed("id", id_col)
