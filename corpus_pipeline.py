"""Corpus pipeline: drop toxic documents, near copies and documents with benchmark passages, mask personal data, pack.

Each stage takes what its predecessor kept, as a table that was written and read again.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from geoloom.llm.decontaminate import drop_contaminated  # noqa: E402
from geoloom.llm.near_dedup import near_duplicates  # noqa: E402
from geoloom.llm.packing import pack_documents  # noqa: E402
from geoloom.llm.pii import mask_personal_data  # noqa: E402
from geoloom.llm.queries import read, tokenizer_path  # noqa: E402
from geoloom.llm.toxicity import drop_toxic, fit_toxicity  # noqa: E402
from geoloom.runtime import scratch_path  # noqa: E402


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model, fitted on the labelled ones of them, does not reject.

    Null and empty texts have no telling words. Repeated rows are judged alike. Without labels of both kinds all stay.
    """
    return drop_toxic(docs, fit_toxicity(docs, read(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies. Documents without an id belong to no group and stay.

    Of rows that share an id one stays: the longest text, of equally long ones the first in the order of the columns (a column
    that has no order by its JSON text). A null text is shorter than an empty one. Columns of any type and name are kept.
    """
    kept = near_duplicates(docs).filter("kept").select("doc_id").distinct()
    ordered = [F.to_json(F.struct(c)) if "map<" in kind or "variant" in kind else F.col(c) for c, kind in docs.dtypes]
    order = F.struct(-F.coalesce(F.length("text"), F.lit(-1)), *ordered)
    named = docs.filter("doc_id IS NOT NULL").join(kept, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(F.struct(*docs.columns), order).alias("_row"))
    return named.select(*(F.col("_row")[c].alias(c) for c in docs.columns)).unionByName(docs.filter("doc_id IS NULL"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage. Null and empty texts stay; without a benchmark all do."""
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with personal data masked and their new lengths. A null text stays null and has a null length."""
    return mask_personal_data(docs).withColumn("n_chars", F.length("text").cast("long"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in their sequences. A null or empty text is its end id alone; each of repeated rows is packed."""
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity), ("near_dedup", near_dedup), ("decontamination", decontamination), ("personal_data", personal_data), ("packing", packing),
]

# The model, the embedding, the parsers and the tokenizer are beyond SQL: tests/llm compares each stage and run() with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage returns is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
