"""Queries with SQL against it, and the pipeline's contract."""

import pytest

import corpus_pipeline
from geoloom.llm.queries import ORACLES, QUERIES
from tests.oracle import connect, difference


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, sf_dir, name):
    assert difference(spark, con, QUERIES[name], ORACLES[name], sf_dir) is None


def test_pipeline_keeps_clean_documents(spark, sf_dir):
    docs, seen = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, sf_dir)
        assert sorted(out.columns) == sorted(docs.columns)
        kept = spark.createDataFrame(out.select(*docs.columns).toArrow())
        seen.append({r.doc_id for r in kept.select("doc_id").collect()})
    assert seen[0] >= seen[1] >= seen[2] == seen[3] and len(seen[3]) > 0.7 * docs.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, sf_dir).toPandas()
    assert set(pieces.doc_id) == seen[3]
    assert (pieces.groupby("doc_id").length.sum() == pieces.groupby("doc_id").doc_tokens.first()).all()
