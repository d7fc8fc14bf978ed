"""Transactions, baskets, item support and frequent itemsets."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from orevein.operators.indexing import dense_index
from orevein.session import materialize

SORT_OPTIONS = ("1", "2", "3", "default")


def item_rows(rows: DataFrame, tid: str, item: str) -> DataFrame:
    """``(tid, item)`` rows as they come; items repeat if a basket lists them twice."""
    return rows.select(F.col(tid).alias("tid"), F.col(item).cast("string").alias("item")).dropna()


def transactions(rows: DataFrame, tid: str, item: str) -> DataFrame:
    """Distinct ``(tid, item)`` pairs: an item counts once per basket.

    The shuffle key is the pair, so a basket or an item that holds a large share of
    the rows is still spread over all tasks and combined before the shuffle.
    """
    return item_rows(rows, tid, item).distinct()


def assemble_baskets(pairs: DataFrame) -> DataFrame:
    """``(tid, items)`` with the distinct items of each basket as a sorted array.

    Every task first reduces its part of a basket to distinct items, so a basket that
    holds a large share of all rows is small before it is shuffled.
    """
    return pairs.groupBy("tid").agg(F.sort_array(F.collect_set("item")).alias("items"))


def basket_items(baskets: DataFrame) -> DataFrame:
    """The distinct ``(tid, item)`` pairs of assembled baskets, without a shuffle."""
    return baskets.select("tid", F.explode("items").alias("item"))


def item_support(pairs: DataFrame, minsup: int | None = None) -> DataFrame:
    """``(item, freq)``; with ``minsup`` only the frequent items."""
    support = pairs.groupBy("item").agg(F.count("*").alias("freq"))
    return support if minsup is None else support.filter(F.col("freq") >= minsup)


def item_ranks(support: DataFrame) -> DataFrame:
    """``(item, freq, rank, rev_rank)``: rank 0 is the item with the highest support."""
    ranked, total = dense_index(support, [F.desc("freq"), F.asc("item")], "rank")
    return ranked.withColumn("rev_rank", F.lit(total - 1) - F.col("rank"))


def prune(pairs: DataFrame, frequent: DataFrame) -> DataFrame:
    """Drop the items that are not in ``frequent``."""
    return pairs.join(frequent.select("item"), "item", "left_semi").select("tid", "item")


def _items_by(entries: Column, *keys: str) -> Column:
    ordered = F.array_sort(F.transform(entries, lambda e: F.struct(*[e[k].alias(k) for k in keys], e["item"].alias("item"))))
    return F.transform(ordered, lambda e: e["item"])


def ordered_baskets(pairs: DataFrame, ranks: DataFrame) -> DataFrame:
    """Baskets pruned to the ranked items, their items in each of the four sort options.

    Option 1 is numeric item id (items without one by name), 2 is descending support,
    3 and the default are ascending support. Columns: ``tid`` and one array per option.
    """
    numbered = ranks.selectExpr("item", "rank", "rev_rank", "try_cast(item AS BIGINT) AS number")
    entry = F.struct("number", "rank", "rev_rank", "item")
    baskets = pairs.join(numbered, "item").groupBy("tid").agg(F.collect_list(entry).alias("entries"))
    entries = F.col("entries")
    return baskets.select(
        "tid",
        _items_by(entries, "number").alias("1"),
        _items_by(entries, "rank").alias("2"),
        _items_by(entries, "rev_rank").alias("3"),
        _items_by(entries, "rev_rank").alias("default"),
    )


def projected_database(baskets: DataFrame, items: str) -> DataFrame:
    """``(item, prefix, n)``: for every item, the items before it in its baskets, counted.

    Equal prefixes are kept once with a count and combined before the shuffle.
    """
    position = baskets.select(items, F.posexplode(items).alias("pos", "item"))
    return position.groupBy(
        "item", F.array_join(F.slice(F.col(items), F.lit(1), F.col("pos")), ",").alias("prefix")
    ).agg(F.count("*").alias("n"))


def frequent_itemsets(baskets: DataFrame, minsup: int) -> DataFrame:
    """``(items, size, freq)`` for every itemset in at least ``minsup`` baskets.

    FP-growth merges equal prefixes on the map side and mines one conditional tree
    per item group, so no candidate pairs are ever emitted per basket. ``baskets`` is
    read more than once: pass a written table. The result is written once because
    rules read it twice.
    """
    n = baskets.count()
    # Half a basket below minsup makes the relative threshold hit the absolute one.
    share = (minsup - 0.5) / n if n else 1.0
    found = FPGrowth(itemsCol="items", minSupport=min(1.0, max(0.0, share))).fit(baskets.select("items")).freqItemsets
    return materialize(
        found.filter(F.col("freq") >= minsup).select(
            F.sort_array("items").alias("items"), F.size("items").alias("size"), "freq"
        ),
        "itemsets",
    )
