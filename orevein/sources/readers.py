"""Readers of the text formats; every read has an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from orevein.functions import text as T
from orevein.operators import baskets as B


def transactions(spark: SparkSession, path: str) -> DataFrame:
    """Blank-separated ``tid item`` lines as distinct pairs, in any line order."""
    rows = spark.read.schema("tid bigint, item string").csv(path, sep=" ")
    return B.transactions(rows, "tid", "item")


def corpus(spark: SparkSession, path: str, pattern: str = "*.sgm", record_end: str = "</REUTERS>") -> DataFrame:
    """Articles ``(doc_id, topic, text)`` of all markup files below a folder.

    Files are cut at the end tag of a record while they are read, so one large file is
    shared by many tasks. Bytes that are no UTF-8 are dropped. Only articles with exactly
    one topic and a body are kept.
    """
    lines = (
        spark.read.option("lineSep", record_end).option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern).text(path)
    )
    # The end tag in another case does not cut the file; such records are cut here.
    lines = lines.select(F.explode(F.split("value", f"(?i)\\Q{record_end}\\E")).alias("value"))
    record = F.regexp_replace(F.make_valid_utf8("value"), "�", "")
    topics = F.regexp_extract(record, r"(?is)<topics>(.*?)</topics>", 1)
    return (
        lines.select(
            F.regexp_extract(record, r'(?i)\bnewid="(\d+)"', 1).alias("newid"),
            F.regexp_extract_all(topics, F.lit(r"(?is)<d>(.*?)</d>"), 1).alias("topics"),
            F.regexp_extract(record, r"(?is)<body>(.*?)(</body>|$)", 1).alias("body"),
        )
        .filter((F.col("newid") != "") & (F.size("topics") == 1) & (F.col("body") != ""))
        .select(
            F.col("newid").cast("bigint").alias("doc_id"),
            F.element_at("topics", 1).alias("topic"),
            T.unescape(F.col("body")).alias("text"),
        )
    )


def stop_words(spark: SparkSession, path: str) -> DataFrame:
    """Stop words, many per line."""
    words = spark.read.text(path).select(F.explode(F.split(F.trim("value"), r"\s+")).alias("word"))
    return words.filter("word <> ''").distinct()


def triplets(spark: SparkSession, path: str) -> DataFrame:
    """Sparse vectors ``doc,dim,weight`` as ``(id, dim, w)``; the last line of a pair wins."""
    rows = spark.read.schema("id bigint, dim bigint, w double").csv(path)
    line = F.monotonically_increasing_id()  # file and line order
    return (
        rows.withColumn("line", line).groupBy("id", "dim").agg(F.max_by("w", "line").alias("w"))
    )


def class_map(spark: SparkSession, path: str) -> DataFrame:
    """Known classes ``doc,topic`` as ``(id, topic)``."""
    return spark.read.schema("id bigint, topic string").csv(path)


def labelled_matrix(spark: SparkSession, path: str, width: int) -> DataFrame:
    """Header-less CSV, label first, as ``(row_id, label, features)``.

    ``row_id`` rises with file and line order; it is unique but has gaps.
    """
    names = [f"f{i}" for i in range(width)]
    schema = "label int, " + ", ".join(f"{n} double" for n in names)
    rows = spark.read.schema(schema).csv(path)
    return rows.select(
        F.monotonically_increasing_id().alias("row_id"), "label", F.array(*names).alias("features")
    )


def predictions(spark: SparkSession, path: str) -> DataFrame:
    """``label,pred`` lines."""
    return spark.read.schema("label int, pred int").csv(path)


def tree_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Votes ``(row_id, label, pred, tree)`` written by :func:`writers.tree_predictions`."""
    return spark.read.schema("row_id bigint, label int, pred int, tree int").parquet(path)


def model(spark: SparkSession, path: str) -> DataFrame:
    """Tree model written by :func:`writers.model`; ``tree`` and ``depth`` are folders."""
    schema = """node string, is_leaf boolean, a int, split double, gini double, label int, n bigint,
                hist array<bigint>, tree int, depth int"""
    return spark.read.schema(schema).parquet(path)
