"""Best-fit packing, vector codes and whitening against plain versions, and their edge cases."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.llm.bestfit import Encoder, OpenSequences, pack_best_fit
from geoloom.llm.quantise import Forest, compress, with_group_sum
from geoloom.llm.queries import BYTE_TOKENIZER, QUERIES, tokenizer_path
from geoloom.llm.whitening import Spectrum, secular_roots, whiten

PATH = tokenizer_path(BYTE_TOKENIZER)


def pieces_of(n: int, size: int) -> list[tuple[int, int]]:
    first = n if n <= size else n % size or size
    return [(0, first), *((at, size) for at in range(first, n, size))]


def check_packing(pieces, docs: list[tuple], size: int, end_id: int = 0):
    """Each document's ids come back, sequences are gapless and hold at most `size`."""
    tokenizer = Encoder(PATH).tokenizer
    want = sorted((i, piece, start, length, zlib.crc32(ids[start:start + length].tobytes()))
                  for i, text in docs for ids in [np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end_id], "<u4")]
                  for piece, (start, length) in enumerate(pieces_of(len(ids), size)))
    assert sorted(zip(pieces.doc_id, pieces.piece, pieces.start, pieces.length, pieces.ids_crc32, strict=True)) == want
    ordered = pieces.sort_values(["sequence_id", "offset"])
    assert (ordered.offset == ordered.groupby("sequence_id").length.cumsum() - ordered.length).all()
    assert pieces.groupby("sequence_id").length.sum().max() <= size


def test_best_fit_query(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    pieces = QUERIES["op13_best_fit"](spark, sf_dir).toPandas()
    check_packing(pieces, docs, 2048)
    assert pieces.sequence_id.nunique() <= 1.05 * math.ceil(pieces.length.sum() / 2048)


def test_best_fit_edges(spark):
    rng = random.Random(2)
    long = " ".join(f"word{i}" for i in range(3000))
    texts = ["", "a", None, long, "<|endoftext|> inside", "  \n\n x \n y  ", "日本 語", *(("ab " * rng.randint(0, 60)) for _ in range(300))]
    docs = spark.createDataFrame([(i, t, 1, "x", 2, 3) for i, t in enumerate([*texts, long, "a"])], "doc_id long, text string, sequence_id int, used string, id int, piece int")
    for parts in (1, 7):
        pieces = pack_best_fit(docs.repartition(parts), PATH, size=64, most_open=8).withColumn("ids_crc32", F.crc32("ids")).toPandas()
        check_packing(pieces, list(enumerate([*texts, long, "a"])), 64)
        assert pieces.sequence_id.nunique() <= 1.1 * pieces.length.sum() / 64 + 8
    again = spark.createDataFrame([(None, "a b"), (None, "a b"), (4, None), (4, None)], "doc_id long, text string")
    assert sorted(r.length for r in pack_best_fit(again, PATH).collect()) == [1, 1, 3, 3] and pack_best_fit(again.limit(0), PATH).count() == 0


def test_open_sequences_take_the_best_fit_and_close_the_fullest():
    rng = random.Random(5)
    for _ in range(20):
        size, most = rng.choice([7, 64, 100]), rng.choice([1, 3, 10])
        ours, plain, closed = OpenSequences(size, most), {}, set()
        for k in range(300):
            length = rng.randint(1, size)
            name, offset, done = ours.place(length, k)
            fitting = {n: s for n, s in plain.items() if s >= length}
            gone = []
            if fitting:
                assert name != k and plain[name] == min(fitting.values())
            else:
                assert name == k
                if len(plain) == most:
                    gone = [done[0]]
                    assert plain.pop(done[0]) <= min(plain.values(), default=size)
            assert offset == size - plain.get(name, size)
            plain[name] = plain.get(name, size) - length
            if not plain[name]:
                gone.append(name)
                del plain[name]
            assert done == gone and not closed & {name}
            closed |= set(done)


def test_the_faster_encoder_gives_the_same_ids():
    encoder = Encoder(PATH)
    assert encoder.plain is not None and Encoder(tokenizer_path()).plain is None
    rng = random.Random(7)
    spaces = [" ", "  ", "\n", "\t ", " ", "　", "\x1c", " \n", "'s", "'LL", "1", "½", "é", "漢字", "👍🏽", "_", "<|", "don't", "X"]
    for _ in range(400):
        text = "".join(rng.choice(spaces) for _ in range(rng.randint(0, 60)))
        assert encoder.ids(text).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    for text in ("a" * 200_000, " " * 200_000, "ab" * 50_000 + "<|endoftext|>"):
        assert encoder.ids(text).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def plain_codes(rows: list[tuple], parts: int, entries: int, rounds: int):
    """(codes, errors, books) of vectors in the order of their ids."""
    x = np.array([v for v in rows])
    cut = x.reshape(len(x), parts, -1)
    books = cut[:entries].transpose(1, 0, 2).copy()

    def nearest():
        away = ((cut[:, :, None] - books[None]) ** 2).sum(axis=3)
        return away.argmin(axis=2), away.min(axis=2).sum(axis=1)

    for _ in range(rounds):
        which, _ = nearest()
        for p in range(parts):
            for e in range(books.shape[1]):
                held = cut[which[:, p] == e, p]
                if len(held):
                    books[p, e] = [int(s) // len(held) for s in held.sum(axis=0)]
    return *nearest(), books


@pytest.mark.parametrize("n,spread", [(3000, 60), (700, 2), (5, 100), (1, 5)])
def test_forest_assigns_like_a_full_search(n, spread):
    rng = np.random.default_rng(n)
    x = np.floor(rng.normal(size=(n, 24)) * spread).astype(np.int64)
    x[n // 2:] = x[0] if n > 1 else x[n // 2:]
    books = x[rng.permutation(n)[:64]].reshape(-1, 6, 4).transpose(1, 0, 2)
    forest = Forest.load(Forest(x, 6).dump())
    codes, error = forest.codes(books)
    away = ((x.reshape(n, 6, 1, 4) - books[None]) ** 2).sum(axis=3)
    assert (codes == away.argmin(axis=2)).all() and (error == away.min(axis=2).sum(axis=1)).all()
    totals = forest.totals(books).reshape(6, -1, 5)
    for p in range(6):
        for e in range(books.shape[1]):
            held = x.reshape(n, 6, 4)[codes[:, p] == e, p]
            assert totals[p, e].tolist() == [len(held), *held.sum(axis=0)]


def test_vector_codes_edges(spark):
    rng = random.Random(3)
    whole = [(i, [rng.uniform(-1, 1) for _ in range(32)], rng.choice(["a", "b", None])) for i in range(150)]
    rows = [*whole, (150, None, "a"), (151, [1.0, None] * 16, "a"), (152, [float("nan")] * 32, None), (153, [float("inf")] * 32, "b"), (7, whole[7][1], "c"), (None, whole[3][1], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").withColumns({"error": F.lit("x"), "code": F.lit(1), "n": F.lit(2), "v": F.lit(3), "id": F.lit(4)})
    got = sorted(((r.vec_id is None, r.vec_id or 0, r.label or "", r.code, r.error, r.label_error, r.codebooks_sha256) for r in compress(df.repartition(3)).collect()))
    kept = sorted([*whole, rows[154], rows[155]], key=lambda r: (r[0] is None, r[0] or 0))
    codes, errors, books = plain_codes([[math.floor(256 * c) for c in v] for _, v, _ in kept], 16, 64, 2)
    sums = {}
    for (_, _, label), e in zip(kept, errors):
        sums[label] = sums.get(label, 0) + int(e)
    want = sorted((i is None, i or 0, label or "", bytes(c.tolist()).hex(), int(e), sums[label]) for (i, _, label), c, e in zip(kept, codes, errors))
    import hashlib

    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    assert [g[:6] for g in got] == want and {g[6] for g in got} == {digest}
    assert compress(df.limit(0)).count() == 0 and compress(df.filter("vec_id = 150")).count() == 0
    odd = spark.createDataFrame([(1, []), (2, [0.5]), (3, [0.5, 0.25])], "vec_id long, embedding array<float>").withColumn("label", F.lit(None).cast("int"))
    assert [(r.vec_id, r.code[:4], r.error) for r in compress(odd).orderBy("vec_id").collect()] == [(1, "0000", 0), (2, "0100", 0), (3, "0102", 0)]


def test_group_sums_of_hot_and_rare_groups(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id")).alias("g"), F.lit(2).alias("x"))
    sums = {(r.g is None, r.s): r["count"] for r in with_group_sum(rows, "g", "x", "s", hot=100).groupBy("g", "s").count().groupBy(F.col("g").isNull().alias("n"), "s").agg(F.sum("count").alias("count")).select(F.when(F.col("n"), None).otherwise(1).alias("g"), "s", "count").collect()}
    assert sums == {(True, 2000): 1000, (False, 2): 2000}


def test_secular_roots_are_eigenvalues():
    rng = np.random.default_rng(4)
    for k in (2, 3, 10, 64):
        for scale in (1e-9, 1.0, 1e9):
            d, z = np.sort(rng.uniform(0, 1e6, k)), rng.normal(size=k) * rng.choice([1e-3, 1, 1e3], k)
            roots, away = secular_roots(d, scale * z * z)
            want = np.linalg.eigvalsh(np.diag(d) + scale * np.outer(z, z))
            assert np.allclose(roots, want, rtol=1e-12, atol=1e-12 * want[-1]) and np.allclose(away, d[:, None] - roots, atol=1e-9 * want[-1])


def test_spectra_are_those_of_the_scatter_matrix():
    rng = np.random.default_rng(6)
    for n, width in ((1, 4), (3, 8), (8, 8), (200, 8), (5000, 16), (60, 64)):
        x = np.floor(rng.normal(size=(n, width)) * 300)
        x[:, -1] = 7
        if n > 100:
            x[::2] = x[0]
        one, two = Spectrum(width), Spectrum(width)
        one.add(x[:n // 2 + 1])
        if n > 1:
            two.add(x[n // 2 + 1:]) if n // 2 + 1 < n else None
        one.combine(two)
        centred = x - x.mean(axis=0)
        scatter = centred.T @ centred
        limit = 1e-12 * max(1, np.abs(scatter).max())
        assert np.abs(one.vectors * one.values @ one.vectors.T - scatter).max() <= limit and np.abs(one.vectors.T @ one.vectors - np.eye(width)).max() < 1e-12


def plain_whitening(x: np.ndarray, count: int):
    n = len(x)
    centred = (n * x - x.sum(axis=0)) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:count], vectors[:, ::-1][:, :count]
    return centred @ vectors / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def test_whitening_query(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas().sort_values("vec_id")
    x = np.floor(np.stack(table.embedding).astype(float) * 1024).astype(np.int64) + 100_000
    want, explained = plain_whitening(x, 8)
    got = QUERIES["op11_whitening"](spark, sf_dir).toPandas().sort_values(["vec_id", "component"])
    n, ours = len(x), got.whitened.to_numpy().reshape(-1, 8)
    assert list(got.vec_id) == [i for i in table.vec_id for _ in range(8)] and (got.n == n).all() and (got.identity_error < 1e-9).all()
    assert np.allclose(ours * np.sign((ours * want).sum(axis=0)), want, atol=1e-8) and np.allclose(got.explained.to_numpy().reshape(-1, 8), explained, rtol=1e-9)
    assert (got.deviation.to_numpy().reshape(-1, 8) == ((n * x - x.sum(axis=0)) ** 2).sum(axis=1)[:, None]).all()


def test_whitening_edges(spark):
    schema = "vec_id long, embedding array<double>"
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [0.0, 5.0]), (3, None), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [3.0])]
    df = spark.createDataFrame(rows, schema).withColumns({"n": F.lit("x"), "id": F.lit(1), "v": F.lit(2), "part": F.lit(3), "component": F.lit(4)})
    got = whiten(df.repartition(3)).toPandas().sort_values(["component", "vec_id"])
    x = np.floor(np.array([[1.0, 2.0], [1.0, 2.0], [3.0, 0.0], [0.0, 5.0]]) * 1024) + 100_000
    want, _ = plain_whitening(x, 2)
    ours = got.whitened.to_numpy().reshape(2, 4).T
    assert got.vec_id.isna().sum() == 2 and np.allclose(np.abs(ours), np.abs(want)) and (got.n == 4).all()
    assert whiten(df.limit(0)).count() == 0 and whiten(df.filter("vec_id = 3")).count() == 0
    same = whiten(spark.createDataFrame([(1, [1.0, 1.0]), (2, [1.0, 1.0])], schema)).collect()
    assert [(r.component, r.deviation, r.whitened, r.explained, r.identity_error) for r in same] == [(1, 0, None, None, None), (2, 0, None, None, None)] * 2
    line = whiten(spark.createDataFrame([(1, [1.0, 1.0]), (2, [2.0, 2.0])], schema)).orderBy("vec_id", "component").collect()
    assert abs(abs(line[0].whitened) - 1) < 1e-9 and line[1].whitened is None and abs(line[0].explained - 1) < 1e-9 and line[0].identity_error < 1e-9
    for size, fits in ((40_000, True), (60_000, False)):
        far = whiten(spark.createDataFrame([(i, [float(size if i % 2 else -size)]) for i in range(60)], schema)).first()
        square = (60 * 1024 * size) ** 2
        assert far.deviation == (square if fits else None) and (square < 1 << 63) == fits


