"""From raw documents to a vocabulary and normalised sparse term vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from orevein.functions import text as T
from orevein.operators.indexing import dense_index
from orevein.session import materialize

SCHEMES = ("freq", "sqrt", "log2")
TASK_CHARS = 1 << 22  # characters of text that one task counts, about 350 MB of hash tables
LEAST_CHARS = 1 << 19  # fewer are not worth a task of their own
TASK_TERMS = 1 << 20  # terms of documents that one task sorts
BROADCAST_STEMS = 1 << 17  # stems of a vocabulary that is broadcast, about 10 MB
TASK_STEMS = 1 << 18  # stems of a larger vocabulary that one task holds, about 25 MB
TASK_LOOKUPS = 1 << 22  # terms that one task looks up in it


def extract_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Keep pages with exactly one heading and a body; add ``topic, title, body``."""
    headings = F.regexp_extract_all(html, F.lit(r"(?is)<h1\b[^>]*>(.*?)</h1>"), 1)
    article = F.regexp_extract(html, r"(?is)<article\b[^>]*>(.*?)</article>", 1)
    return (
        pages.withColumn("_h1", headings)
        .withColumn("_article", article)
        .filter((F.size("_h1") == 1) & (F.col("_article") != ""))
        .withColumn("topic", F.regexp_extract(html, r'(?i)<html\b[^>]*\blang="([^"]*)"', 1))
        .withColumn("title", T.strip_markup(F.element_at("_h1", 1)))
        .withColumn("body", T.strip_markup(F.col("_article")))
        .drop("_h1", "_article")
    )


def topic_counts(docs: DataFrame, topic: str = "topic") -> DataFrame:
    return docs.groupBy(F.col(topic).alias("topic")).agg(F.count("*").alias("n"))


def top_topics(docs: DataFrame, topic: str = "topic", top: int = 20) -> DataFrame:
    """``(topic_id, topic, n)`` of the ``top`` most frequent topics, ties by name.

    Only these ``top`` rows reach the single-task numbering.
    """
    best = topic_counts(docs, topic).orderBy(F.desc("n"), "topic").limit(top)
    number = F.row_number().over(Window.orderBy(F.desc("n"), "topic")) - 1
    return best.select(number.alias("topic_id"), "topic", "n")


def class_map(docs: DataFrame, topics: DataFrame) -> DataFrame:
    """``(doc_id, topic_id, topic)`` of the documents whose topic is in ``topics``.

    ``topics`` comes from :func:`top_topics`, so its size is bounded by that limit.
    """
    return docs.select("doc_id", "topic").join(
        F.broadcast(topics.select("topic_id", "topic")), "topic"
    ).select("doc_id", "topic_id", "topic")


def token_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(doc_id, token, n)`` over whole texts.

    The texts are partitioned by document first: a document is one row, and its raw text
    is smaller than its counts. All later grouping by document and token or stem then
    happens in place, without another shuffle. The number of partitions follows from the
    size of the texts, so that a task's tables stay the same size however many texts there are.
    """
    chars = docs.agg(F.sum(F.char_length(text))).first()[0] or 0
    cores = docs.sparkSession.sparkContext.defaultParallelism
    tasks = max(-(-chars // TASK_CHARS), min(cores, -(-chars // LEAST_CHARS)), 1)
    words = docs.select("doc_id", text).repartition(tasks, "doc_id").select(
        "doc_id", F.explode(T.words(F.col(text))).alias("token")
    )
    return words.filter(T.IS_TOKEN).groupBy("doc_id", "token").agg(F.count("*").alias("n"))


def default_stop_words(spark: SparkSession) -> DataFrame:
    """The built-in list; as one exploded literal its size is known to the planner."""
    return spark.range(1).select(F.explode(F.array(*[F.lit(w) for w in T.STOP_WORDS])).alias("word"))


def drop_stop_words(counts: DataFrame, stop: DataFrame) -> DataFrame:
    """Remove stop words (before stemming). Spark broadcasts ``stop`` by its size."""
    return counts.join(stop.select(F.col("word").alias("token")), "token", "left_anti").select(
        "doc_id", "token", "n"
    )


def stem_counts(counts: DataFrame) -> DataFrame:
    """``(doc_id, stem, n)``. Stems are computed where the counts lie: a join with a
    table of distinct tokens would shuffle every count by a heavily skewed key."""
    return T.with_stem(counts, "token").groupBy("doc_id", "stem").agg(F.sum("n").alias("n"))


def vocabulary(terms: DataFrame, min_count: int = 5) -> DataFrame:
    """``(stem_id, stem, freq)`` of the stems with a corpus count of at least ``min_count``."""
    frequent = terms.groupBy("stem").agg(F.sum("n").alias("freq")).filter(F.col("freq") >= min_count)
    numbered, _ = dense_index(frequent, [F.desc("freq"), F.asc("stem")], "stem_id")
    return numbered.select("stem_id", "stem", "freq")


def doc_terms(terms: DataFrame, vocab: DataFrame, rows: int | None = None) -> DataFrame:
    """``(doc_id, stem_id, n)`` restricted to the vocabulary, which is counted first.

    A vocabulary too large to broadcast is dealt by stem, and the terms stream past a hash table of their
    task's stems. They are not sorted, so a task holds its share of the vocabulary however many terms it reads.
    ``rows``, the number of rows of ``terms`` or more, keeps those a task reads at ``TASK_LOOKUPS`` on average:
    a later shuffle into many parts holds what the task passes on. A stem has at most one term per document.
    """
    lookup, stems = vocab.select("stem", "stem_id"), vocab.count()
    if stems <= BROADCAST_STEMS:
        lookup = F.broadcast(lookup)
    else:
        parts = max(-(-stems // TASK_STEMS), -(-(rows or 0) // TASK_LOOKUPS))
        if parts > int(terms.sparkSession.conf.get("spark.sql.shuffle.partitions")):
            lookup = lookup.repartition(parts, "stem")
        lookup = lookup.hint("shuffle_hash")
    return terms.join(lookup, "stem").select("doc_id", "stem_id", "n")


def _by_document(counts: DataFrame, rows: int | None) -> DataFrame:
    """Rows of ``counts`` by document, in as many partitions as ``rows`` asks for; without it as Spark sees fit."""
    return counts if rows is None else counts.repartition(max(-(-rows // TASK_TERMS), 1), "doc_id")


def top_terms(counts: DataFrame, k: int, rows: int | None = None) -> DataFrame:
    """The ``k`` most frequent terms of each document with their rank ``rk``.

    ``rows``, the number of rows of ``counts`` or more, keeps what a task sorts at ``TASK_TERMS``.
    """
    counts = _by_document(counts, rows)
    by_count = Window.partitionBy("doc_id").orderBy(F.desc("n"), "stem_id")
    return counts.withColumn("rk", F.row_number().over(by_count)).filter(F.col("rk") <= k)


def term_weights(counts: DataFrame, rows: int | None = None) -> DataFrame:
    """``(doc_id, stem_id, freq, sqrt, log2)``: unit-length vectors in three schemes.

    One shuffle by document serves the three norms; a window holds one document's terms.
    ``rows``, the number of rows of ``counts`` or more, keeps what a task sorts at ``TASK_TERMS``.
    """
    n = F.col("n").cast("double")
    raw = _by_document(counts, rows).select(
        "doc_id", "stem_id", n.alias("freq"), (1 + F.sqrt(n)).alias("sqrt"), (1 + F.log2(n)).alias("log2")
    )
    doc = Window.partitionBy("doc_id")
    norm = lambda c: F.sqrt(F.sum(F.col(c) * F.col(c)).over(doc))
    return raw.select("doc_id", "stem_id", *[(F.col(c) / norm(c)).alias(c) for c in SCHEMES])


def weights_by_scheme(weights: DataFrame) -> DataFrame:
    """Long form ``(doc_id, stem_id, scheme, w)``."""
    return weights.unpivot(["doc_id", "stem_id"], list(SCHEMES), "scheme", "w")


def text_vectors(
    docs: DataFrame, stop: DataFrame | None = None, min_count: int = 5, top: int = 20
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The whole preparation: ``(weights, vocabulary, class map)`` of ``(doc_id, topic, text)``."""
    stop = default_stop_words(docs.sparkSession) if stop is None else stop
    topics = top_topics(docs, "topic", top)
    classes = class_map(docs, topics)
    kept = docs.join(F.broadcast(topics.select("topic")), "topic", "left_semi")
    terms = materialize(stem_counts(drop_stop_words(token_counts(kept), stop)), "terms")
    vocab, rows = vocabulary(terms, min_count), terms.count()
    return term_weights(doc_terms(terms, vocab, rows), rows), vocab, classes
