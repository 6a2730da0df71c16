"""Severity of toxic language by cumulative-link ordinal regression.

P(grade <= k) = logistic(threshold[k] - weight . x): one weight per word, shared
by all ordered thresholds. x is the count, up to 3, of the words and word
beginnings that tell the grades apart. The model is fitted on a bounded sample of labelled documents; words,
counts and scores of all other steps cover every document.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.arrays import map_arrow, slices
from geoloom.runtime import checkpoint

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Labelled documents to fit on at most, words of the model at most, documents of the sample a word occurs in at least.
SAMPLE, WORDS, LEAST_DOCUMENTS = 20_000, 5_000, 4
#: A word enters the model if its chi-square over toxic and other documents reaches this.
LEAST_CHI_SQUARE = 30.0
#: Further occurrences of a feature in a document add nothing.
MOST_COUNTED = 3
#: A document is rejected if the chance of any grade above 0 reaches this.
REJECT = 0.5

_WORD = re.compile(r"\w+")
#: Letters of the word beginnings that are features beside the word.
STEMS = (4, 5)


def features(text: str | None) -> dict[str, int]:
    """Words of a text and beginnings of its longer words (with a hyphen behind), with their counts."""
    words = Counter(_WORD.findall((text or "").lower()))
    out = Counter(words)
    for word, n in words.items():
        for letters in STEMS:
            if len(word) > letters:
                out[word[:letters] + "-"] += n
    return out


@dataclass(frozen=True)
class OrdinalModel:
    """Weights by feature and ordered thresholds; grades are 0 .. len(thresholds)."""

    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ... per score."""
        return 1 / (1 + np.exp(np.clip(np.array(self.thresholds) - np.asarray(score, float)[:, None], -60, 60)))

    def scores(self, texts) -> np.ndarray:
        weights, out = self.weights, []
        for text in texts:
            counts = {f: n for f, n in features(text).items() if f in weights}
            # In a fixed order: equal texts have equal scores.
            out.append(sum(weights[f] * min(counts[f], MOST_COUNTED) for f in sorted(counts)))
        return np.array(out, float)


def fit_ordinal(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grades: np.ndarray, width: int, ridge: float = 1e-4, steps: int = 800) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds that maximise the likelihood of the grades, by Adam over all rows at once; (rows, columns, values) is a sparse matrix."""
    top = int(grades.max()) if len(grades) else 0
    shares = np.array([(np.sum(grades <= k) + 0.5) / (len(grades) + 1) for k in range(top)])
    cuts = np.log(shares / (1 - shares))
    # Thresholds are a first one and the logarithms of the gaps, so they stay in order.
    state = np.concatenate([np.zeros(width), cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-3))])
    mean, square = np.zeros_like(state), np.zeros_like(state)
    n = max(1, len(grades))

    def logistic(z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))

    for step in range(1, steps + 1):
        weight, gaps = state[:width], np.exp(state[width + 1:])
        limits = np.concatenate([[-np.inf], np.cumsum(np.append(state[width:width + 1], gaps)), [np.inf]])
        score = np.bincount(rows, values * weight[columns], len(grades))
        high, low = logistic(limits[grades + 1] - score), logistic(limits[grades] - score)
        chance = np.maximum(high - low, 1e-12)
        d_high, d_low = high * (1 - high) / chance, low * (1 - low) / chance
        g_score = (d_high - d_low) / n
        g_limit = np.zeros(top + 2)
        np.add.at(g_limit, grades + 1, -d_high / n)
        np.add.at(g_limit, grades, d_low / n)
        g_cut = g_limit[1:-1]
        later = np.cumsum(g_cut[::-1])[::-1]
        gradient = np.concatenate([np.bincount(columns, values * g_score[rows], width) + ridge * weight, later[:1], later[1:] * gaps])
        mean, square = 0.9 * mean + 0.1 * gradient, 0.999 * square + 0.001 * gradient ** 2
        state = state - 0.1 * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
    return state[:width], np.cumsum(np.append(state[width:width + 1], np.exp(state[width + 1:])))


def _counted(texts: DataFrame) -> DataFrame:
    """Rows (doc, word, n) of a table (doc, text): each document's distinct features."""

    def rows(batches):
        for batch in slices(batches):
            docs, words, counts = [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen = features(text)
                docs += [doc] * len(seen)
                words += seen.keys()
                counts += seen.values()
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(words, pa.string()), pa.array(counts, pa.int64())], names=["doc", "word", "n"])

    return map_arrow(texts, rows, "doc long, word string, n long")


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE,
                 words: int = WORDS, least_documents: int = LEAST_DOCUMENTS, least_chi_square: float = LEAST_CHI_SQUARE) -> OrdinalModel:
    """Model of the grades 0 (not toxic), 1 and 2 (toxic, by the number of telling words up to and above the median of the toxic documents).

    `sample` bounds the labelled documents used: those with the smallest hashes
    of their ids. Features are the at most `words` words and word beginnings with the largest chi-square over toxic and other
    documents, of those that stand in `least_documents` of the sample and reach `least_chi_square`: the three bound the model,
    which is all that goes to the tasks; documents are scored by all their words that it holds. Null labels and ids are ignored; of several labels of a document
    the largest counts, of several texts the first in order. Without labelled
    documents of both kinds no word has a weight and nothing is toxic.
    """
    chosen = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc")) \
        .agg(F.max(F.col(label_col).cast("int")).alias("label")).orderBy(F.xxhash64("doc"), "doc").limit(sample)
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")) \
        .join(F.broadcast(chosen), "doc").groupBy("doc", "label").agg(F.min("text").alias("text"))
    texts = checkpoint(texts)
    numbers = texts.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.when(F.col("label") > 0, 1)), F.lit(0)).alias("toxic")).first()
    none = OrdinalModel({}, (10.0, 12.0))
    n, toxic = numbers.n, numbers.toxic
    if not toxic or toxic == n:
        return none
    found = _counted(texts.select("doc", "text")).join(F.broadcast(texts.select("doc", "label")), "doc")
    spread = found.groupBy("word").agg(F.count(F.lit(1)).alias("held"), F.count(F.when(F.col("label") > 0, 1)).alias("t")).filter(F.col("held") >= least_documents)
    # Chi-square of the two-by-two table of word and label.
    t, held = F.col("t").cast("double"), F.col("held").cast("double")
    cross = t * (n - toxic - (held - t)) - (held - t) * (toxic - t)
    chi = cross * cross * n / (held * (n - held) * toxic * (n - toxic))
    telling = spread.withColumn("chi", F.when(held < n, chi)).filter((F.col("chi") >= least_chi_square) & (t * n > held * toxic)) \
        .orderBy(F.desc("chi"), "word").limit(words).select("word")
    vocabulary = {r.word: i for i, r in enumerate(telling.orderBy("word").collect())}
    if not vocabulary:
        return none
    # Rows of the sample with words of the model: both are bounded.
    entries = found.join(F.broadcast(telling), "word").select("doc", "word", "n").toArrow()
    totals = texts.select("doc", "label").orderBy("doc").toArrow()
    ids, label = (totals.column(c).to_numpy() for c in ("doc", "label"))
    row, column = np.searchsorted(ids, entries.column("doc").to_numpy()), np.array([vocabulary[w] for w in entries.column("word").to_pylist()], int)
    order = np.lexsort((column, row))
    row, column, value = row[order], column[order], entries.column("n").to_numpy()[order]
    telling_words = np.bincount(row, value, len(ids))
    is_toxic = label > 0
    grades = np.where(is_toxic, 1 + (telling_words > np.median(telling_words[is_toxic])), 0).astype(int)
    weight, thresholds = fit_ordinal(row, column, np.minimum(value, MOST_COUNTED).astype(float), grades, len(vocabulary))
    return OrdinalModel({w: float(weight[i]) for w, i in vocabulary.items()}, tuple(map(float, thresholds)))


def score_toxicity(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text", reject: float = REJECT) -> DataFrame:
    """One row per input row: id, grade (the most likely), expected_severity, p_toxic, rejected.

    A null or empty text scores as one without telling words. Null and repeated
    ids are kept. Other columns are not read.
    """

    def rows(batches):
        for batch in slices(batches):
            above = model.above(model.scores(batch.column(1).to_pylist()))
            edges = np.hstack([np.ones((len(above), 1)), above, np.zeros((len(above), 1))])
            grade = (edges[:, :-1] - edges[:, 1:]).argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(grade.astype(np.int32)), pa.array(above.sum(axis=1)), pa.array(above[:, 0]), pa.array(above[:, 0] >= reject)],
                names=["id", "grade", "expected_severity", "p_toxic", "rejected"])

    return map_arrow(
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")), rows, "id long, grade int, expected_severity double, p_toxic double, rejected boolean").withColumnRenamed("id", id_col)


def drop_toxic(docs: DataFrame, model: OrdinalModel, text_col: str = "text", reject: float = REJECT) -> DataFrame:
    """The rows that are not rejected, with all their columns, whatever their names.

    A null or empty text has no telling words and is judged by the model's thresholds alone. Rows that repeat are judged each by its own text.
    """
    place = docs.columns.index(text_col)

    def rows(batches):
        for batch in slices(batches):
            yield batch.filter(pa.array(model.above(model.scores(batch.column(place).to_pylist()))[:, 0] < reject))

    return map_arrow(docs, rows, docs.schema)
