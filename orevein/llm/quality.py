"""Quality classifier on supervised subword embeddings, trained by numpy stochastic gradient descent.

A word is the mean of the learned vectors of its hashed features: the word itself and its
character n-grams; a word that repeats its predecessor adds one hashed bigram feature. A document is
the mean of its words, then comes a softmax over the labels. Case and marks are part of a word.

Training takes at most ``SAMPLE`` labelled rows, the first in hash order; executors turn their
texts into sparse features, of which at most ``BUCKETS`` per row reach the driver. Scoring is a narrow map
over all rows: as the model is linear after averaging, each bucket is projected on the softmax direction
once (``BUCKETS`` numbers, a fixed size, are broadcast), and word scores are kept in a cache of bounded size.

Defined cases: a null or empty text has the zero vector and gets the score of the bias. Null labels are
left out; of several labels for an id the highest counts. Without two classes in the training
rows every score is the smoothed share of label 1. Repeated rows are scored each; empty tables give no rows.
"""

from __future__ import annotations

import operator
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orevein.llm.common import checksum
from orevein.plans.tables import table
from orevein.session import Scratch

BUCKETS = 1 << 16
GRAMS = (3, 4)  # characters of an n-gram, word borders included
DIM = 16
SAMPLE = 6000  # labelled rows that train the model
EPOCHS = 6
RATE = 20.0
CACHE = 300_000  # words whose score a worker remembers
_REPEAT = b"\x00same"  # stands for the bigram of a word and itself


def word_features(word: bytes) -> list[int]:
    """Buckets of a word and its character n-grams (byte n-grams of its UTF-8 form)."""
    marked = b"<" + word + b">"
    found = [zlib.crc32(marked)]
    for size in GRAMS:
        found += [zlib.crc32(marked[i:i + size]) for i in range(len(marked) - size + 1)]
    return [h % BUCKETS for h in found]


def text_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def document_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their weights, which add up to 1."""
    words = text_words(text)
    counts = Counter(words)
    repeats = sum(map(operator.eq, words, words[1:]))
    if repeats:
        counts[_REPEAT] += repeats
    total = sum(counts.values())
    weights = np.zeros(BUCKETS)
    for word, n in counts.items():
        ids = word_features(word)
        np.add.at(weights, ids, n / len(ids) / total)
    ids = np.nonzero(weights)[0]
    return ids, weights[ids]


@dataclass
class Model:
    """Embeddings, softmax weights and biases of the two labels."""

    vectors: np.ndarray
    softmax: np.ndarray
    bias: np.ndarray

    def bucket_scores(self) -> np.ndarray:
        """Part of the log-odds of label 1 that each bucket gives."""
        return self.vectors @ (self.softmax[1] - self.softmax[0])

    def offset(self) -> float:
        return float(self.bias[1] - self.bias[0])


def fit_rows(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, rate: float = RATE) -> Model:
    """Stochastic gradient descent on sparse rows ``(buckets, weights, label)``; the same rows give the same model."""
    rng = np.random.default_rng(7)
    model = Model(rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)), np.zeros((2, DIM)), np.zeros(2))
    ones = sum(label for _, _, label in rows)
    share = (ones + 1) / (len(rows) + 2)
    model.bias[:] = np.log([1 - share, share])
    if ones in (0, len(rows)):
        return model
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            ids, weights, label = rows[k]
            pace = rate * (1 - done / steps)
            done += 1
            vectors = model.vectors[ids]
            x = weights @ vectors
            logits = model.softmax @ x + model.bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            back = model.softmax.T @ p
            model.softmax -= pace * 0.05 * np.outer(p, x)
            model.bias -= pace * 0.002 * p
            model.vectors[ids] = vectors - pace * np.outer(weights, back)
    return model


def training_rows(
    docs: DataFrame, labels: DataFrame, learn: Column, id_col: str, text_col: str, label_col: str, sample: int
) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Sparse features of at most ``sample`` labelled rows, in a fixed order."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & learn)
    known = known.groupBy(id_col).agg(F.max(label_col).cast("int").alias("label"))
    # At most ``sample`` rows of 12 bytes, so the broadcast is bounded by the parameter.
    first = known.orderBy(F.xxhash64(id_col), id_col).limit(sample)
    picked = docs.select(id_col, F.col(text_col).alias("text")).join(F.broadcast(first), id_col)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [document_features(t) for t in batch["text"]]
            yield pd.DataFrame({
                "id": batch.iloc[:, 0].astype(str), "label": batch["label"],
                "ids": [r[0].astype(np.uint16).tobytes() for r in rows],
                "weights": [r[1].astype(np.float32).tobytes() for r in rows],
            })

    # Written by the executors and read file by file, so the driver holds the arrays and little else.
    scratch = Scratch(docs.sparkSession, "quality")
    made = scratch.table(picked.mapInPandas(features, "id string, label int, ids binary, weights binary"), "features")
    got = [
        (zlib.crc32(r["id"].encode()), r["id"], bytes(r["ids"]), bytes(r["weights"]), r["label"])
        for r in made.toLocalIterator()
    ]
    scratch.drop(made)
    got.sort()
    return [
        (np.frombuffer(ids, np.uint16), np.frombuffer(weights, np.float32), label) for _, _, ids, weights, label in got
    ]


class _Scores(dict):
    """Word scores, computed when first asked for."""

    def __init__(self, buckets: np.ndarray) -> None:
        super().__init__()
        self.buckets = buckets.tolist()

    def __missing__(self, word: bytes) -> float:
        ids = word_features(word)
        if len(self) >= CACHE:
            self.clear()
        score = self[word] = sum(map(self.buckets.__getitem__, ids)) / len(ids)
        return score


def text_score(text: str | None, scores: _Scores, offset: float) -> float:
    """Probability of label 1."""
    words = text_words(text)
    total, n = sum(map(scores.__getitem__, words)), len(words)
    repeats = sum(map(operator.eq, words, words[1:]))
    if repeats:
        total, n = total + repeats * scores[_REPEAT], n + repeats
    return float(1 / (1 + np.exp(-np.clip((total / n if n else 0.0) + offset, -60, 60))))


def scorer(spark: SparkSession, model: Model):
    """Column function: probability of label 1 of a text."""
    shared = spark.sparkContext.broadcast((model.bucket_scores(), model.offset()))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        buckets, offset = shared.value
        scores = _Scores(buckets)
        for texts in batches:
            yield pd.Series([text_score(t, scores, offset) for t in texts], dtype=float)

    return score


def fit(
    docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", sample: int = SAMPLE,
) -> Model:
    return fit_rows(training_rows(docs, labels, learn, id_col, text_col, label_col, sample))


def held_out(ident: Column) -> Column:
    return checksum(ident) % 3 == 1


def keep_good(docs: DataFrame, labels: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is at least 0.5, all columns; no row is shuffled."""
    score = scorer(docs.sparkSession, fit(docs, labels, ~held_out(F.col("doc_id"))))
    return docs.filter(score(F.col(text_col)) >= 0.5)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    score = scorer(spark, fit(docs, labels, ~held_out(F.col("doc_id"))))
    return docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text")).alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


QUERIES = {"op9_quality_classifier": op9_quality_classifier}
ORACLES: dict[str, str] = {}
