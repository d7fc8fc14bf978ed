"""How well clusters match known classes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def contingency(assigned: DataFrame, classes: DataFrame) -> DataFrame:
    """``(k, topic, n)`` over the documents that have a cluster."""
    return assigned.join(classes, "id").groupBy("k", "topic").agg(F.count("*").alias("n"))


def crosstab(counts: DataFrame, topics: list) -> DataFrame:
    """One row per cluster, one column ``t<topic>`` per topic, zeros included."""
    cells = [F.coalesce(F.sum(F.when(F.col("topic") == t, F.col("n"))), F.lit(0)).alias(f"t{t}") for t in topics]
    return counts.groupBy("k").agg(*cells)


def purity_entropy(counts: DataFrame) -> DataFrame:
    """``(k, size, purity, entropy)``; the counts are at most clusters times topics.

    With p = n / size: entropy = -sum(p log2 p) = log2(size) - sum(n log2 n) / size.
    """
    size = F.sum("n")
    return counts.groupBy("k").agg(
        size.alias("size"),
        (F.max("n") / size).alias("purity"),
        (F.log2(size) - F.sum(F.col("n") * F.log2("n")) / size).alias("entropy"),
    )


def global_quality(assigned: DataFrame, classes: DataFrame) -> DataFrame:
    """Size-weighted ``(purity, entropy, unmatched)``; unmatched = classes without a cluster."""
    counts = classes.join(assigned, "id", "left").groupBy("k", "topic").agg(F.count("*").alias("n"))
    matched = F.col("k").isNotNull()
    size = F.sum(F.when(matched, F.col("size")))
    return purity_entropy(counts).agg(
        (F.sum(F.when(matched, F.col("size") * F.col("purity"))) / size).alias("purity"),
        (F.sum(F.when(matched, F.col("size") * F.col("entropy"))) / size).alias("entropy"),
        F.coalesce(F.sum(F.when(~matched, F.col("size"))), F.lit(0)).alias("unmatched"),
    )
