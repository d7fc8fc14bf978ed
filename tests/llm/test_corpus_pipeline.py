"""Every stage of the pipeline against a brute-force version of its decision, on what the stage before kept."""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from orevein.llm import quality
from orevein.llm.common import lower_words


def test_stages_against_brute_force(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, kept[-1], small).write.parquet(f"{tmp_path}/{number}")
        kept.append(spark.read.parquet(f"{tmp_path}/{number}"))
    assert all(df.columns == columns for df in kept[:-1])
    rows = [{r["doc_id"]: r["text"] for r in df.collect()} for df in kept[:4]]

    labels = spark.read.parquet(f"{small}/labels.parquet")
    model = quality.fit(docs, labels, ~quality.held_out(F.col("doc_id")))
    scores, offset = model.bucket_scores(), model.offset()

    def good(text):
        words = (text or "").encode().split()
        tokens = words + [quality._REPEAT for a, b in zip(words, words[1:]) if a == b]
        parts = [sum(scores[f] for f in quality.word_features(w)) / len(quality.word_features(w)) for w in tokens]
        return 1 / (1 + math.exp(-(sum(parts) / max(1, len(parts)) + offset))) >= 0.5

    assert set(rows[1]) == {i for i, t in rows[0].items() if good(t)} and 0 < len(rows[1]) < len(rows[0])

    best = {}
    for i, t in rows[1].items():
        key = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        best[key] = min(best.get(key, (0, math.inf)), (-len(t or ""), i)) if key in best else (-len(t or ""), i)
    assert set(rows[2]) == {i for _, i in best.values()}

    sets = {}
    for i, t in rows[2].items():
        w = lower_words(t)
        sets[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    low = {i: i for i in sets}
    links = [(i, j) for i in sets for j in sets if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    for _ in sets:
        for i, j in links:
            low[i] = low[j] = min(low[i], low[j])
    assert set(rows[3]) == {i for i in sets if low[i] == i}

    words = {i: len((t or "").split()) for i, t in rows[3].items()}
    copies = Counter(r["doc_id"] for r in kept[4].collect())
    assert set(copies) <= set(words) and max(copies.values()) <= 2
    total = sum(words.values())
    assert abs(sum(words[i] * n for i, n in copies.items()) - 1.5 * total) <= 0.05 * total

    packed = Counter()
    for r in kept[5].collect():
        packed[r["doc_id"]] += r["length"]
        assert r["bin_id"] is None or 0 <= r["offset"] <= r["capacity"] - r["length"]
    assert packed == Counter({i: words[i] * n for i, n in copies.items()})
    assert corpus_pipeline.run(spark, small).count() == kept[5].count()


def stage(number, spark, docs, sf_dir):
    return corpus_pipeline.STAGES[number][1](spark, docs, sf_dir)


def test_stages_take_odd_rows_and_empty_tables(spark, small):
    """Null and repeated ids, null and empty texts, repeated rows and a long text through all stages, and no rows at all."""
    given = spark.read.parquet(f"{small}/documents.parquet")
    some = given.limit(20).collect()
    long = " ".join(r["text"] or "" for r in some) * 20
    odd = [
        r.asDict() | change for r, change in zip(some, [
            {"doc_id": None}, {"doc_id": None, "text": None}, {"text": None}, {"text": ""}, {"text": long}, {"source": None}, {"lang": None},
        ])
    ]
    rows = [tuple(r[c] for c in given.columns) for r in [*odd, *[r.asDict() for r in some[7:]], some[9].asDict(), some[9].asDict()]]
    for part in (rows, []):
        docs = spark.createDataFrame(part, given.schema)
        for number in range(4):
            left = stage(number, spark, docs, small)
            assert left.columns == given.columns
            if number in (1, 2):  # repeated rows and equal empty texts leave one, texts without a partner stay
                texts = [re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "") for r in left.collect()]
                was = {re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "") for r in docs.collect()}
                assert set(texts) <= was and (number == 2 or sorted(texts) == sorted(was))
        packed = stage(4, spark, docs, small).collect()
        assert sum(r["length"] for r in packed) == sum(len((r["text"] or "").split()) for r in docs.collect())
