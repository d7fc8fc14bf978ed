"""Association rules with consequents of any size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from orevein.session import materialize

_SUBSETS = """
transform(sequence(1L, shiftleft(1L, size) - 2L),
          mask -> filter(items, (x, i) -> (shiftright(mask, i) & 1L) = 1L))
"""


def rule_candidates(itemsets: DataFrame) -> DataFrame:
    """Every split of every set into antecedent and consequent, both non-empty: 2^size - 2 rows a set.

    :func:`association_rules` does not use it; it grows consequents level by level and lists no set in full.
    """
    return (
        itemsets.filter(F.col("size") > 1)
        .select("items", "size", "freq", F.explode(F.expr(_SUBSETS)).alias("consequent"))
        .withColumn("antecedent", F.array_except("items", "consequent"))
    )


def confident(candidates: DataFrame, itemsets: DataFrame, minconf: float) -> DataFrame:
    """Look up the antecedent's support and keep candidates with confidence > ``minconf``."""
    support = itemsets.select(F.col("items").alias("antecedent"), F.col("freq").alias("ante_freq"))
    return (
        candidates.join(support, "antecedent")
        .filter(F.col("freq") > F.lit(float(minconf)) * F.col("ante_freq"))
        .withColumn("confidence", F.col("freq") / F.col("ante_freq"))
        .select("items", "size", "antecedent", "consequent", "freq", "confidence")
    )


def single_consequents(itemsets: DataFrame) -> DataFrame:
    return (
        itemsets.filter(F.col("size") > 1)
        .select("items", "size", "freq", F.explode("items").alias("item"))
        .select("items", "size", "freq", F.array("item").alias("consequent"))
        .withColumn("antecedent", F.array_except("items", "consequent"))
    )


def grow_consequents(passing: DataFrame) -> DataFrame:
    """Candidates with one more item in the consequent.

    A consequent is extended by a later item of its set if the sibling, which has that
    item in place of its last one, passed as well. The sibling is looked up by key, so
    the consequents of a set are never paired with each other.
    """
    last = F.element_at("consequent", -1)
    extended = (
        passing.filter(F.size("antecedent") > 1)
        .withColumn("_last", last)
        .select(
            "items", "size", "freq", "consequent",
            F.explode(F.expr("filter(antecedent, x -> x > _last)")).alias("item"),
        )
        .select(
            "items", "size", "freq",
            F.array_append("consequent", F.col("item")).alias("consequent"),
            F.array_append(
                F.slice("consequent", F.lit(1), F.size("consequent") - 1), F.col("item")
            ).alias("sibling"),
        )
    )
    siblings = passing.select("items", F.col("consequent").alias("sibling"))
    return (
        extended.join(siblings, ["items", "sibling"], "left_semi")
        .select("items", "size", "freq", "consequent")
        .withColumn("antecedent", F.array_except("items", "consequent"))
    )


def grow_rules(itemsets: DataFrame, minconf: float) -> tuple[DataFrame, DataFrame]:
    """Level-wise rules of the sets with more than one item.

    Returns the rules and the grown candidates (consequents of two or more items).
    One round per consequent size; confidence can only fall as a consequent grows.
    """
    passing = materialize(confident(single_consequents(itemsets), itemsets, minconf), "rules")
    rules, grown = [passing], []
    while True:
        candidates = materialize(grow_consequents(passing), "consequents")
        grown.append(candidates)
        if candidates.isEmpty():
            break
        passing = materialize(confident(candidates, itemsets, minconf), "rules")
        rules.append(passing)
    union = lambda parts: reduce(DataFrame.unionByName, parts)
    return union(rules), union(grown)


def association_rules(itemsets: DataFrame, minconf: float) -> DataFrame:
    """``(items, size, antecedent, consequent, freq, confidence)``, confidence > ``minconf``."""
    return grow_rules(itemsets, minconf)[0]


def rules_per_size(itemsets: DataFrame, rules: DataFrame) -> DataFrame:
    """Number of itemsets and of rules by itemset size."""
    n_sets = itemsets.groupBy("size").agg(F.count("*").alias("n_itemsets"))
    n_rules = rules.groupBy("size").agg(F.count("*").alias("n_rules"))
    return n_sets.join(n_rules, "size", "left").na.fill(0, ["n_rules"])


def rule_lines(rules: DataFrame) -> DataFrame:
    """Text form ``a b  | c  | count | confidence``."""
    conf = F.round("confidence", 6).cast("decimal(10,6)").cast("string")
    return rules.select(
        F.concat(
            F.array_join("antecedent", " "), F.lit("  | "), F.array_join("consequent", " "),
            F.lit("  | "), F.col("freq").cast("string"), F.lit(" | "), conf,
        ).alias("line")
    )


def itemset_lines(itemsets: DataFrame) -> DataFrame:
    """Text form ``a b  |  {} | count | -1`` of the sets with more than one item."""
    return itemsets.filter(F.col("size") > 1).select(
        F.concat(
            F.array_join("items", " "), F.lit("  |  {} | "), F.col("freq").cast("string"), F.lit(" | -1")
        ).alias("line")
    )
