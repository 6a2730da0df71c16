"""Nulls, empty and long texts, ties, repeated rows, empty tables and columns with clashing names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from geoloom.llm.chat import format_conversations
from geoloom.llm.decontaminate import drop_contaminated, find_contamination
from geoloom.llm.near_dedup import near_duplicates
from geoloom.llm.packing import pack_documents
from geoloom.llm.pii import find_personal_data, mask_personal_data
from geoloom.llm.queries import tokenizer_path
from geoloom.llm.secret_scan import scan_secrets
from geoloom.llm.sharding import shard_documents
from geoloom.llm.substring import repeated_words
from geoloom.llm.topk import top_k
from geoloom.llm.toxicity import drop_toxic, fit_toxicity, score_toxicity

LONG = " ".join(f"word{i}" for i in range(30_000))
PROSE = " ".join(f"alpha{i} beta" for i in range(12))
SCHEMA = "doc_id long, text string, id long, words string, key string, size string, chunk long, `values` string, spans string, part int"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, PROSE), (2, PROSE), (2, PROSE), (3, ""), (4, None), (None, PROSE), (None, None), (5, LONG), (6, " \t\n"), (7, "one word"),
            (8, "mail a@b.cd token = abcdefghijkl0"), (9, "é" * 5 + " +49 (30) 123456-78, 10.0.0.1")]
    return spark.createDataFrame([(i, t, 9, "x", "y", "z", 3, "v", "s", 1) for i, t in rows], SCHEMA)


def by_id(df, column="doc_id"):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_near_duplicates(docs, spark):
    rows = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs).collect()}
    assert (1, 20, 1, True) in rows and (2, 20, 1, False) in rows and (None, 20, None, False) in rows
    assert (3, 0, 3, True) in rows and (4, 0, 4, True) in rows and (6, 0, 6, True) in rows and (7, 1, 7, True) in rows
    assert near_duplicates(docs).count() == docs.count() and near_duplicates(docs.limit(0)).count() == 0


def test_rows_that_share_an_id_are_one_document(spark):
    texts = {k: " ".join(f"{k}{i}" for i in range(40)) for k in "abcdef"}
    rows = [(5, texts["a"]), (5, texts["b"] + " tail"), (2, texts["b"]), (1, texts["c"]), (1, texts["d"]), (3, texts["d"]), (7, None), (7, texts["e"]), (6, texts["e"]), (8, texts["f"]), (8, ""),
            (9, texts["c"] + " tail"), (4, ""), (None, texts["a"])]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, place int")
    got = {(r.doc_id, r.component_id, r.kept) for r in near_duplicates(docs).collect()}
    assert got == {(5, 2, False), (2, 2, True), (1, 1, True), (3, 1, False), (9, 1, False), (7, 6, False), (6, 6, True), (8, 8, True), (4, 4, True), (None, None, False)}
    assert near_duplicates(docs).count() == len(rows)
    more = docs.unionByName(spark.createDataFrame([(10, "short text", 20), (10, "a longer text", 22), (10, "a longer text", 21)], docs.schema))
    for parts in (1, 3):
        stay = {(r.doc_id, r.place) for r in corpus_pipeline.near_dedup(spark, more.repartition(parts, "place"), "").collect()}
        assert stay == {(2, 2), (1, 3), (6, 8), (8, 9), (4, 12), (None, 13), (10, 21)}


def test_repeated_words(docs):
    rows = {(r.doc_id, r.n_words, r.n_removed, r.kept) for r in repeated_words(docs).collect() if r.doc_id != 5}
    assert (1, 24, 0, PROSE) in rows and (2, 24, 24, "") in rows and (None, 24, 24, "") in rows and (4, 0, 0, "") in rows and (7, 2, 0, "one word") in rows
    assert repeated_words(docs.limit(0)).count() == 0


def test_packing(docs):
    pieces = pack_documents(docs, tokenizer_path(), size=64).toPandas()
    assert pieces.groupby("sequence_id").length.sum().isin([1, 2, 4, 8, 16, 32, 64]).all()
    assert (pieces[pieces.doc_id == 4].length == 1).all() and pieces[pieces.doc_id == 5].length.sum() == pieces[pieces.doc_id == 5].doc_tokens.iloc[0]
    assert pack_documents(docs.limit(0), tokenizer_path()).count() == 0


def test_sharding(docs):
    rows = shard_documents(docs, shards=4).toPandas()
    assert len(rows) == docs.count() and all(sorted(g["slot"]) == list(range(len(g))) for _, g in rows.groupby("shard"))
    assert rows[rows.doc_id == 4]["size"].tolist() == [8] and shard_documents(docs.limit(0)).count() == 0


def test_sharding_splits_one_hot_id(spark):
    rows = shard_documents(spark.range(900).select(F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(F.lit(1 << 40)).alias("doc_id"), F.lit("abcd").alias("text")), shards=7)
    sizes = [r.b for r in rows.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 7 and max(sizes) - min(sizes) <= 24


def test_secrets_and_personal_data(docs):
    secrets = {r.doc_id: [(s.rule, s.start, s.end) for s in r.spans] for r in scan_secrets(docs).collect()}
    assert secrets[8] == [("assign", 12, 33)] and secrets[4] == [] and scan_secrets(docs).count() == docs.count() and scan_secrets(docs.limit(0)).count() == 0
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in find_personal_data(docs).collect()}
    assert found[8] == [("email", 5, 11)] and found[9] == [("phone", 6, 24), ("ip", 26, 34)]
    masked = {r.doc_id: r.text for r in mask_personal_data(docs).collect()}
    assert masked[8].startswith("mail [EMAIL] token") and masked[4] is None and mask_personal_data(docs).columns == docs.columns
    assert mask_personal_data(docs.limit(0)).count() == 0


def test_contamination(docs, spark):
    items = spark.createDataFrame([(1, PROSE), (2, None), (3, ""), (4, "too short"), (None, PROSE)], "item_id long, text string")
    rows = by_id(find_contamination(docs, items).select("doc_id", "item_id", "distance"))
    assert rows == sorted([(1, 1, 0), (2, 1, 0), (2, 1, 0), (None, 1, 0)], key=repr)
    assert drop_contaminated(docs, items).count() == docs.count() - 4 and drop_contaminated(docs, items.limit(0)).count() == docs.count()
    assert find_contamination(docs.limit(0), items).count() == 0


def test_contamination_by_short_items_and_items_without_an_id(spark):
    question = "What is the longest river, really?"
    texts = [(1, f"first. {question} yes"), (2, "what is the longest"), (3, "river really what is the longest"), (4, "Paris"), (5, f"x {PROSE} y"), (6, "paris alpha0 beta"), (7, None),
             (8, f"WHAT is the longest - river really; {question}")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    items = spark.createDataFrame([(1, question), (2, "Paris!"), (None, PROSE), (None, PROSE + "."), (None, question), (3, "?!"), (None, None)], "item_id long, text string")
    rows = by_id(find_contamination(docs, items))
    assert rows == sorted([(1, 1, 0, 1, 7), (8, 1, 0, 0, 6), (4, 2, 0, 0, 1), (6, 2, 0, 0, 1), (5, None, 0, 1, 25)], key=repr)
    assert sorted(r.doc_id for r in drop_contaminated(docs, items).collect()) == [2, 3, 7]


def test_toxicity(docs, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = fit_toxicity(docs, none)
    assert model.weights == {} and score_toxicity(docs, model).filter("rejected").count() == 0 and drop_toxic(docs, model).count() == docs.count()
    odd = spark.createDataFrame([(1, 1), (1, None), (None, 1), (3, 0), (4, 0)], "doc_id long, toxic int")
    assert drop_toxic(docs.limit(0), fit_toxicity(docs, odd)).count() == 0


def test_chat(spark):
    log = spark.createDataFrame(
        [(1, 0, "user", "a"), (1, 1, "bot", "b"), (2, 0, "user", "a"), (2, 0, "user", "a"), (3, 0, "user", "a"), (3, 1, "bot", "b"), (3, 2, "user", None),
         (4, 0, "user", "a"), (4, 1, "bot", "c"), (5, None, None, "n"), (None, 0, "user", "a"), (6, 0, "user", "a"), (6, 1, "bot", "c")],
        "conv_id long, turn long, role string, text string").withColumn("conv", F.lit(1)).withColumn("part", F.lit("x"))
    rows = {r.conv_id: (r.part, r.n_turns, r.text) for r in format_conversations(log).collect()}
    assert set(rows) == {3, 4, 5} and rows[3] == (0, 3, "<|user|>\na\n<|bot|>\nb\n<|user|>\n\n") and rows[5] == (0, 1, "<|unknown|>\nn\n")
    assert format_conversations(log.limit(0)).count() == 0
    long = spark.range(600).select((F.col("id") % 2).alias("conv_id"), F.floor(F.col("id") / 2).alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    assert sorted((r.conv_id, r.part, r.n_turns) for r in format_conversations(long).collect()) == [(0, 0, 256), (0, 1, 44), (1, 0, 256), (1, 1, 44)]


def test_top_k(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.5, float("nan")]), (4, None), (5, [0.25, None]), (None, [1.0, 1.0]), (50, [0.0, 1.0]), (7, [2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("x"))
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in top_k(df).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 7, 131072), (0, 2, 1, 65536), (0, 3, 2, 65536), (0, 4, 50, 0), (50, 1, 0, 0), (50, 2, 1, 0), (50, 3, 2, 0), (50, 4, 7, 0)]
    assert top_k(df.limit(0)).count() == 0 and top_k(df.limit(1)).count() == 0
    assert {r.score for r in top_k(spark.createDataFrame([(0, []), (1, [])], "vec_id long, embedding array<float>")).collect()} == {0}
