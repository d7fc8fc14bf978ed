"""Supports of itemsets from vertical bitmaps: which baskets of a range hold an item, as one bit each.

Baskets are dealt evenly over ranges of at most ``RANGE`` baskets. A set that is in a share of all baskets is in at least
that share of some range, so the sets that reach the share in a range are all candidates there are; what a range has not
counted yet of another range's candidates is counted in a second pass. Both passes intersect whole bitmaps, none looks at
a basket again, and the result is exact at every size.

A task holds the frequent items of one range, 4 KB each: with a minimum support of one basket in a thousand
at most a thousand times the mean basket. Only candidates and their counts are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from orevein.operators.baskets import basket_items, item_support, prune
from orevein.operators.indexing import dense_index
from orevein.session import Scratch

RANGE = 32768  # bits of a bitmap, fixed by Spark


def item_bitmaps(baskets: DataFrame, minsup: int, most: int = RANGE) -> tuple[DataFrame, int, int]:
    """``(range, item, bitmap)`` of the frequent items, the number of ranges and of baskets."""
    numbered, total = dense_index(baskets.select("tid", "items"), ["tid"], "n")
    ranges = max(1, -(-total // most))
    cells = basket_items(numbered.withColumnRenamed("tid", "_tid").withColumnRenamed("n", "tid"))
    cells = prune(cells, item_support(cells, minsup))
    bitmaps = cells.groupBy((F.col("tid") % ranges).cast("int").alias("range"), "item").agg(
        F.bitmap_construct_agg((F.col("tid") / ranges).cast("bigint")).alias("bitmap")
    )
    return bitmaps, ranges, total


def _matrix(bitmaps: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(bitmaps), dtype=np.uint64).reshape(len(bitmaps), -1)


def sets_within(bits: np.ndarray, size: int, least: int) -> Iterator[tuple[tuple[int, ...], int]]:
    """Row sets of ``size`` whose bitmaps have at least ``least`` bits in common, with that number."""

    def grow(members: tuple[int, ...], rows: np.ndarray, common: np.ndarray):
        counts = np.bitwise_count(common).sum(axis=1)
        for k in np.flatnonzero(counts >= least):
            chosen = (*members, int(rows[k]))
            if len(chosen) == size:
                yield chosen, int(counts[k])
            else:
                yield from grow(chosen, rows[k + 1:], common[k + 1:] & common[k])

    return grow((), np.arange(len(bits)), bits)


def vertical_supports(baskets: DataFrame, size: int, minsup: int, most: int = RANGE) -> DataFrame:
    """``(items, freq)`` of all sets of ``size`` items in at least ``minsup`` baskets, items in order.

    ``most`` baskets make a range, ``RANGE`` at most. Empty baskets count as baskets. No baskets give no rows.
    """
    if not (1 <= most <= RANGE and minsup >= 1 and size >= 1):
        raise ValueError(f"size and minsup start at 1, most lies between 1 and {RANGE}")
    scratch = Scratch(baskets.sparkSession, "vertical")
    bitmaps, ranges, total = item_bitmaps(baskets, minsup, most)
    bitmaps = scratch.table(bitmaps, "bitmaps")

    def local(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("item")
        number, names = int(pdf["range"].iloc[0]), pdf["item"].tolist()
        held = total // ranges + (number < total % ranges)
        least = max(1, -(-minsup * held // total))
        found = list(sets_within(_matrix(pdf["bitmap"]), size, least))
        return pd.DataFrame({
            "range": np.full(len(found), number, dtype=np.int32),
            "items": [[names[k] for k in rows] for rows, _ in found], "n": [n for _, n in found],
        })

    def count(maps: pd.DataFrame, sets: pd.DataFrame) -> pd.DataFrame:
        bits = _matrix(maps["bitmap"]) if len(maps) else None
        row = {item: k for k, item in enumerate(maps["item"])}
        counts = [
            int(np.bitwise_count(np.bitwise_and.reduce(bits[[row[i] for i in items]])).sum()) if all(i in row for i in items) else 0
            for items in sets["items"]
        ]
        return pd.DataFrame({"range": sets["range"], "items": sets["items"], "n": counts})

    shape = "range int, items array<string>, n bigint"
    found = scratch.table(bitmaps.groupBy("range").applyInPandas(local, shape), "found")
    everywhere = found.select("items").distinct().select(
        F.explode(F.sequence(F.lit(0), F.lit(ranges - 1))).alias("range"), "items"
    )
    missing = everywhere.join(found, ["range", "items"], "left_anti")
    counted = bitmaps.groupBy("range").cogroup(missing.groupBy("range")).applyInPandas(count, shape)
    freq = found.unionByName(counted).groupBy("items").agg(F.sum("n").alias("freq"))
    return freq.filter(F.col("freq") >= minsup)
