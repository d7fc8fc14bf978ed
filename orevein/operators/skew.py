"""Joins on keys of which a few may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

HOT = 1000  # a key with more than 1 / HOT of all rows is hot, so there are fewer than HOT hot keys


def hot_keys(rows: DataFrame, on: list[str], hot: int = HOT) -> DataFrame:
    """Keys that hold more than ``1 / hot`` of all rows: fewer than ``hot`` rows, counted on the map side first."""
    counts = rows.groupBy(*on).agg(F.count("*").alias("_rows_of_key"))
    total = rows.count()
    return counts.filter(F.col("_rows_of_key") * F.lit(hot) > F.lit(total)).select(*on)


def join_measured(rows: DataFrame, lookup: DataFrame, on: list[str], hot: int = HOT) -> DataFrame:
    """``rows.join(lookup, on)`` for a ``lookup`` with one row per key, whatever share of ``rows`` a key holds.

    Rows of hot keys stay where they are and meet their fewer than ``hot`` lookup rows by broadcast; the others
    are joined as Spark sees fit. Rows with a null key match nothing, as in any join.
    """
    hottest = [r[0] for r in hot_keys(rows, on, hot).select(F.struct(*on)).collect()]  # fewer than ``hot``
    if not hottest:
        return rows.join(lookup, on)
    schema = rows.select(*on).schema
    heavy = rows.sparkSession.createDataFrame(hottest, schema)
    few = F.broadcast(lookup.join(F.broadcast(heavy), on, "left_semi"))
    many = rows.join(F.broadcast(heavy), on, "left_anti").join(lookup, on)
    return many.unionByName(rows.join(few, on))
