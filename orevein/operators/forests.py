"""Bagged trees: bootstrap draws, one fit for all trees, votes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orevein.functions.hashing import draw
from orevein.operators import trees as T
from orevein.operators.indexing import dense_index
from orevein.session import materialize

SAMPLE_SHARE = 0.4  # fixed value: draws per tree as a share of the rows


def bootstrap(rows: DataFrame, trees: int, share: float = SAMPLE_SHARE) -> tuple[DataFrame, DataFrame]:
    """Draws with replacement: ``(tree, draw, row)`` and the rows with their number ``row``."""
    numbered, n = dense_index(rows, ["row_id"], "row")
    size = int(n * share)
    draws = (
        rows.sparkSession.range(size * trees)
        .select((F.col("id") / F.lit(size)).cast("int").alias("tree"), (F.col("id") % F.lit(size)).alias("draw"))
        .withColumn("row", draw(F.col("draw"), F.col("tree"), max(n, 1)))
    )
    return draws, numbered


def samples(rows: DataFrame, trees: int, share: float = SAMPLE_SHARE) -> DataFrame:
    """Training rows of all trees. A row drawn twice is kept once with multiplicity 2."""
    draws, numbered = bootstrap(rows, trees, share)
    drawn = draws.groupBy("tree", "row").agg(F.count("*").alias("m"))
    return drawn.join(numbered, "row").select("tree", "row_id", "label", "features", "m")


def fit(rows: DataFrame, trees: int, minfreq: int = T.MIN_FREQ, share: float = SAMPLE_SHARE, **options) -> DataFrame:
    """One model with a ``tree`` key; all attributes, re-reduced for every sample."""
    return T.fit(materialize(samples(rows, trees, share), "samples"), minfreq, **options)


def votes(model: DataFrame, rows: DataFrame, trees: int) -> DataFrame:
    """``(tree, row_id, label, pred)`` of every tree for every row."""
    return T.predict_all(model, rows, trees)


def vote(ballots: DataFrame) -> DataFrame:
    """``(row_id, label, pred)``: the most frequent class, whatever the classes are; the lowest one on a tie."""
    return ballots.groupBy("row_id").agg(F.max("label").alias("label"), F.mode("pred", True).alias("pred"))
