"""Sparse vectors in long form ``(id, dim, w)``: joinable, and as wide as needed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def from_arrays(df: DataFrame, id_col: str, array: str) -> DataFrame:
    """Unit-length ``(id, dim, w)`` of an array column; the norm is taken inside the row."""
    values = F.col(array).cast("array<double>")
    norm = F.sqrt(F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x * x))
    unit = F.when(norm > 0, F.transform(values, lambda x: x / norm)).otherwise(values)
    return df.select(F.col(id_col).alias("id"), F.posexplode(unit).alias("dim", "w"))


def combine(left: DataFrame, a: float, right: DataFrame, b: float) -> DataFrame:
    """Linear combination ``a * left + b * right`` of two vectors ``(dim, w)``."""
    scaled = left.select("dim", (F.lit(float(a)) * F.col("w")).alias("w")).unionByName(
        right.select("dim", (F.lit(float(b)) * F.col("w")).alias("w"))
    )
    return scaled.groupBy("dim").agg(F.sum("w").alias("w"))


def unit(vector: DataFrame) -> DataFrame:
    """Scale one vector ``(dim, w)`` to unit length; only its norm is a scalar here."""
    norm = vector.agg(F.sqrt(F.sum(F.col("w") * F.col("w")))).first()[0] or 1.0
    return vector.select("dim", (F.col("w") / F.lit(norm)).alias("w"))


def total(vectors: DataFrame) -> DataFrame:
    """Sum of all vectors as one vector ``(dim, w)``."""
    return vectors.groupBy("dim").agg(F.sum("w").alias("w"))
