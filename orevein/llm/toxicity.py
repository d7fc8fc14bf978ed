"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

Features are hashed byte n-grams of the distinct words of a text (lower-cased, borders marked), each
counted once per distinct word that holds it. One weight per feature is shared by all thresholds:
``P(grade >= k) = sigmoid(w x - t_k)`` with ``t_1 < t_2 < ...``; the expected severity is the sum over k.
Only features that are significantly more frequent among toxic training rows get a weight (a score test per
feature), so words that say nothing add nothing to long texts; AdaGrad with an L1 penalty trains them.

Labels only tell toxic from clean. Clean rows get grade 0; toxic ones are graded by how often they hold such
features, cut at the terciles of the toxic training rows.

Training takes at most ``SAMPLE`` labelled rows, the first in hash order; executors count and test the features and
return the telling ones of each row, at most ``BUCKETS``. Scoring is a narrow map over all rows with ``BUCKETS`` broadcast
weights and a cache of bounded size; the words of a run of texts that are new to it are hashed together, as arrays.

Defined cases: null and empty texts have no features and get the thresholds alone. Null labels are left out; of several
for an id the highest counts. Without both classes in the training rows all severities are near 0 (or near the top
grade). Repeated rows are scored each; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orevein.llm.common import checksum, lower_words
from orevein.plans.tables import table
from orevein.session import Scratch

BITS = 18
BUCKETS = 1 << BITS
GRAMS = (3, 4, 5, 6)  # bytes of an n-gram
GRADES = 4  # 0 clean, 1 to 3 toxic
SAMPLE = 12_000  # labelled rows that train the model
EPOCHS = 25
RATE = 0.5
PENALTY = 1e-3
SCREEN = 4.8  # standard deviations above the toxic rows that chance would give a feature
LEAST = 4  # toxic training rows that hold a telling feature
CACHE = 300_000  # words whose score a worker remembers from one run of texts to the next
RUN_CHARS = 1 << 20  # characters whose words are held at once
_MARKS = b".,;:!?\"'()[]{}|*#$%&"


def word_buckets(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``(position in words, bucket)`` of every n-gram and whole word, punctuation stripped; a pair may come twice."""
    marked = [b"<" + word.strip(_MARKS) + b">" for word in words]
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    data = np.frombuffer(b"".join(marked), np.uint8)
    owner = np.repeat(np.arange(len(marked), dtype=np.int32), lengths)
    owners = [np.arange(len(marked), dtype=np.int32)]
    codes = [np.fromiter(map(zlib.crc32, marked), np.uint64, len(marked))]
    code = data.astype(np.uint64)
    for size in range(2, max(GRAMS) + 1):
        code = (code[:-1] << np.uint64(8)) | data[size - 1:]
        if size in GRAMS:
            inside = owner[:len(code)] == owner[size - 1:]
            owners.append(owner[:len(code)][inside])
            codes.append(code[inside] | np.uint64(size << 56))
    spread = np.concatenate(codes) * np.uint64(0x9E3779B97F4A7C15)  # wraps around: a multiplicative hash
    return np.concatenate(owners), (spread >> np.uint64(64 - BITS)).astype(np.int64)


def _runs(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Consecutive texts with about ``RUN_CHARS`` characters, so that few words are held at once."""
    run, chars = [], 0
    for text in texts:
        run.append(text)
        chars += len(text or "")
        if chars >= RUN_CHARS:
            yield run
            run, chars = [], 0
    if run:
        yield run


def document_features(texts: list[str | None], kept: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted buckets of each text and how many of its distinct words hold them; buckets outside ``kept`` are left out."""
    for run in _runs(texts):
        sets = [set(lower_words(text)) for text in run]
        vocabulary = list(set().union(*sets))
        place = dict(zip(vocabulary, range(len(vocabulary))))
        owner, bucket = word_buckets(vocabulary)
        pairs = np.unique((owner[kept[bucket]].astype(np.int64) << BITS) | bucket[kept[bucket]])
        first = np.searchsorted(pairs >> BITS, np.arange(len(vocabulary) + 1))
        bucket = pairs & (BUCKETS - 1)
        for words in sets:
            spots = [bucket[first[i]:first[i + 1]] for i in map(place.__getitem__, words)]
            ids, counts = np.unique(np.concatenate(spots) if spots else bucket[:0], return_counts=True)
            yield ids.astype(np.int32), counts.astype(np.float32)


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, total: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... and one row per text."""
        return 1 / (1 + np.exp(-np.clip(np.asarray(total)[..., None] - self.thresholds, -60, 60)))


def severity_grades(rows: list[tuple[np.ndarray, np.ndarray, int]]) -> np.ndarray:
    """Grades 0 to GRADES - 1 of training rows cut down to telling features."""
    toxic = np.array([t for _, _, t in rows], bool)
    amount = np.array([counts.sum() for _, counts, _ in rows])
    grades = np.zeros(len(rows), np.int64)
    if toxic.any():
        cuts = np.quantile(amount[toxic], np.arange(1, GRADES - 1) / (GRADES - 1))
        grades[toxic] = 1 + np.searchsorted(cuts, amount[toxic], "right")
    return grades


def fit_rows(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS) -> Model:
    """AdaGrad on the ordinal log-likelihood of rows ``(buckets, counts, toxic)``; the same rows give the same model."""
    rng, n = np.random.default_rng(5), len(rows)
    grades = severity_grades(rows)
    weights, power = np.zeros(BUCKETS), np.full(BUCKETS, 1e-8)
    above = np.array([((grades >= k).sum() + 0.5) / (n + 1) for k in range(1, GRADES)])
    thresholds = -np.log(above / (1 - above))
    pace = np.full(GRADES - 1, 1.0)
    for _ in range(epochs):
        for r in rng.permutation(n):
            ids, counts, _ = rows[r]
            y, total = grades[r], float(weights[ids] @ counts)
            up = 1 / (1 + np.exp(-np.clip(total - thresholds[y - 1], -60, 60))) if y else 1.0
            down = 1 / (1 + np.exp(-np.clip(total - thresholds[y], -60, 60))) if y < GRADES - 1 else 0.0
            p = max(up - down, 1e-12)
            slope = up + down - 1  # of the negative log-likelihood in ``total``
            if y:
                g = up * (1 - up) / p
                pace[y - 1] += g * g
                thresholds[y - 1] -= 0.1 * g / pace[y - 1] ** 0.5
            if y < GRADES - 1:
                g = -down * (1 - down) / p
                pace[y] += g * g
                thresholds[y] -= 0.1 * g / pace[y] ** 0.5
            thresholds = np.maximum.accumulate(thresholds + np.arange(GRADES - 1) * 1e-9)
            g = slope * counts
            power[ids] += g * g
            step = RATE / np.sqrt(power[ids])
            moved = weights[ids] - step * g
            weights[ids] = np.sign(moved) * np.maximum(np.abs(moved) - step * PENALTY, 0)
    return Model(weights, thresholds)


def _count_features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows that hold each bucket, toxic and clean, of one task."""
    seen, every = np.zeros((2, BUCKETS), np.int64), np.ones(BUCKETS, bool)
    for batch in batches:
        for (ids, _), toxic in zip(document_features(batch["text"].tolist(), every), batch["toxic"]):
            seen[toxic, ids] += 1
    held = np.nonzero(seen.sum(axis=0))[0]
    yield pd.DataFrame({"bucket": held, "clean": seen[0, held], "toxic": seen[1, held]})


def telling_buckets(picked: DataFrame) -> np.ndarray:
    """Sorted buckets that toxic rows of ``picked (toxic, text)`` hold significantly more often; BUCKETS at most."""
    total = picked.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).first()
    share = (total["toxic"] or 0) / max(1, total["n"])
    expected = (F.col("clean") + F.col("toxic")) * share
    found = picked.mapInPandas(_count_features, "bucket bigint, clean bigint, toxic bigint").groupBy("bucket").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")
    ).filter((F.col("toxic") >= LEAST) & (F.col("toxic") - expected >= F.sqrt(expected * (1 - share)) * SCREEN))
    return np.array(sorted(r["bucket"] for r in found.select("bucket").collect()), np.int64)


def training_rows(
    docs: DataFrame, labels: DataFrame, learn: Column, id_col: str, text_col: str, label_col: str, sample: int
) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Telling features of at most ``sample`` labelled rows, in a fixed order."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & learn)
    known = known.groupBy(id_col).agg(F.max((F.col(label_col) > 0).cast("int")).alias("toxic"))
    # At most ``sample`` rows of 12 bytes, so the broadcast is bounded by the parameter.
    first = known.orderBy(F.xxhash64(id_col), id_col).limit(sample)
    scratch = Scratch(docs.sparkSession, "toxicity")
    picked = scratch.table(
        docs.select(id_col, F.col(text_col).alias("text")).join(F.broadcast(first), id_col)
        .select(F.col(id_col).cast("string").alias("id"), "toxic", "text"), "sample",
    )
    telling = telling_buckets(picked)
    mask = np.zeros(BUCKETS, bool)
    mask[telling] = True

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = list(document_features(batch["text"].tolist(), mask))
            yield pd.DataFrame({
                "id": batch["id"], "toxic": batch["toxic"], "ids": [i.tobytes() for i, _ in rows],
                "counts": [c.tobytes() for _, c in rows],
            })

    got = picked.mapInPandas(features, "id string, toxic int, ids binary, counts binary").collect()
    scratch.drop(picked)
    got.sort(key=lambda r: (zlib.crc32(r["id"].encode()), r["id"], bytes(r["ids"])))
    return [(np.frombuffer(r["ids"], np.int32), np.frombuffer(r["counts"], np.float32), r["toxic"]) for r in got]


class _Scores:
    """Sum of the weights of a word's features; words met for the first time are scored together."""

    def __init__(self, weights: np.ndarray) -> None:
        self.weights, self.known = weights, {}

    def totals(self, texts: list[str | None]) -> Iterator[float]:
        for run in _runs(texts):
            sets = [set(lower_words(text)) for text in run]
            if len(self.known) > CACHE:
                self.known.clear()
            new = list(set().union(*sets) - self.known.keys())
            if new:
                self.known.update(zip(new, self._score(new).tolist()))
            for words in sets:
                # Sorted, so that the sum does not depend on the order of a set.
                yield sum(sorted(map(self.known.__getitem__, words)))

    def _score(self, words: list[bytes]) -> np.ndarray:
        owner, bucket = word_buckets(words)
        telling = self.weights[bucket] != 0
        pairs = np.unique((owner[telling].astype(np.int64) << BITS) | bucket[telling])
        return np.bincount(pairs >> BITS, self.weights[pairs & (BUCKETS - 1)], len(words))


def scorer(spark: SparkSession, model: Model):
    """Column function: array of P(grade >= k) for k = 1, 2, ..."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("array<double>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        scores = _Scores(model.weights)
        for texts in batches:
            totals = np.fromiter(scores.totals(texts.tolist()), float, len(texts))
            yield pd.Series(list(model.at_least(totals))) if len(totals) else pd.Series([], dtype=object)

    return score


def grade(
    docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", sample: int = SAMPLE,
) -> DataFrame:
    """``docs`` (all columns) with ``_at_least``: P(grade >= 1), P(grade >= 2), ...; it replaces a column of that name."""
    score = scorer(docs.sparkSession, fit_rows(training_rows(docs, labels, learn, id_col, text_col, label_col, sample)))
    return docs.withColumn("_at_least", score(F.col(text_col)))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = checksum(F.col("doc_id")) % 3 == 1
    graded = grade(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"), ~held_out)
    p = F.col("_at_least")
    return graded.select("doc_id", "_at_least").select(
        "doc_id", held_out.alias("held_out"), p[0].alias("score"),
        F.aggregate(p, F.lit(0.0), lambda s, x: s + x).alias("expected_severity"),
        F.aggregate(p, F.lit(0), lambda s, x: s + F.when(x >= 0.5, 1).otherwise(0)).alias("grade"),
        (p[0] >= 0.5).cast("int").alias("predicted"),
    )


QUERIES = {"op1_toxicity": op1_toxicity}
ORACLES: dict[str, str] = {}
