"""Confusion matrix and accuracy of predictions ``(label, pred)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orevein.operators.trees import CLASSES
from orevein.session import materialize


def confusion(predictions: DataFrame, classes: int = CLASSES) -> DataFrame:
    """``(label, pred, n)`` for all classes x classes cells, zeros included; more classes if the data has them."""
    # Predictions are counted once; classes x classes rows are left.
    counts = materialize(predictions.groupBy("label", "pred").agg(F.count("*").alias("n")), "confusion")
    highest = counts.agg(F.max(F.greatest("label", "pred"))).first()[0]
    classes = max(classes, (highest if highest is not None else 0) + 1)
    grid = predictions.sparkSession.range(classes * classes).select(
        F.floor(F.col("id") / classes).cast("int").alias("label"), (F.col("id") % classes).cast("int").alias("pred")
    )
    return grid.join(counts, ["label", "pred"], "left").na.fill(0, ["n"])


def confusion_table(predictions: DataFrame, classes: int = CLASSES) -> DataFrame:
    """One row per label, one column ``c<pred>`` per predicted class."""
    grid = confusion(predictions, classes)
    classes = max(classes, grid.agg(F.max("pred")).first()[0] + 1)
    cells = [F.sum(F.when(F.col("pred") == c, F.col("n")).otherwise(0)).alias(f"c{c}") for c in range(classes)]
    return grid.groupBy("label").agg(*cells)


def accuracy(predictions: DataFrame) -> DataFrame:
    """``(total, accuracy)``; 0 predictions have accuracy null."""
    right = F.sum((F.col("label") == F.col("pred")).cast("int"))
    return predictions.agg(F.count("*").alias("total"), (right / F.count("*")).alias("accuracy"))
