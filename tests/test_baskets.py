from itertools import combinations

import pytest
from pyspark.sql import functions as F

from orevein.operators import baskets as B, rules as R
from orevein.operators.indexing import dense_index
from orevein.operators.vertical import vertical_supports

BASKETS = {1: "abc", 2: "abc", 3: "ab", 4: "cd", 5: "abd"}


def pairs_of(spark, baskets):
    rows = [(tid, item) for tid, items in baskets.items() for item in items]
    return B.transactions(spark.createDataFrame(rows, "tid bigint, item string"), "tid", "item")


def itemsets_of(spark, baskets, minsup):
    return B.frequent_itemsets(B.assemble_baskets(pairs_of(spark, baskets)), minsup)


def as_dict(itemsets):
    return {"".join(r["items"]): r["freq"] for r in itemsets.collect()}


def as_rules(rules):
    return {("".join(r["antecedent"]), "".join(r["consequent"])): (r["freq"], round(r["confidence"], 6)) for r in rules.collect()}


WANTED = {"a": 4, "b": 4, "c": 3, "d": 2, "ab": 4, "ac": 2, "bc": 2, "abc": 2}
WANTED_RULES = {
    ("a", "b"): (4, 1.0), ("b", "a"): (4, 1.0), ("c", "a"): (2, 0.666667), ("c", "b"): (2, 0.666667),
    ("ac", "b"): (2, 1.0), ("bc", "a"): (2, 1.0), ("c", "ab"): (2, 0.666667),
}


def test_itemsets_and_rules(spark):
    found = itemsets_of(spark, BASKETS, 2)
    assert as_dict(found) == WANTED
    assert as_rules(R.association_rules(found, 0.6)) == WANTED_RULES


def test_duplicate_item_changes_nothing(spark):
    assert as_dict(itemsets_of(spark, BASKETS | {3: "aab"}, 2)) == WANTED


def test_confidence_is_strict(spark):
    assert R.association_rules(itemsets_of(spark, BASKETS, 2), 1.0).count() == 0


@pytest.mark.parametrize("minconf", [0.1, 0.6, 0.8])
def test_grown_rules_equal_listed_rules(spark, minconf):
    baskets = BASKETS | {6: "abcde", 7: "bcde", 8: "abcde", 9: "ace"}
    found = itemsets_of(spark, baskets, 2)
    listed = as_rules(R.confident(R.rule_candidates(found), found, minconf))
    assert as_rules(R.grow_rules(found, minconf)[0]) == listed
    assert as_rules(R.association_rules(found, minconf)) == listed


def test_itemsets_equal_brute_force(spark):
    baskets = {t: [f"i{(t * 7 + j * j) % 9}" for j in range(t % 6 + 1)] for t in range(60)}
    counts = {}
    for items in baskets.values():
        for size in range(1, 7):
            for c in combinations(sorted(set(items)), size):
                counts[c] = counts.get(c, 0) + 1
    found = {tuple(r["items"]): r["freq"] for r in itemsets_of(spark, baskets, 5).collect()}
    assert found == {c: n for c, n in counts.items() if n >= 5}


def test_support_never_rises_with_size(spark):
    found = as_dict(itemsets_of(spark, BASKETS, 1))
    for items, freq in found.items():
        for size in range(1, len(items)):
            assert all(found["".join(c)] >= freq for c in combinations(items, size))


def test_lines(spark):
    found = itemsets_of(spark, BASKETS, 2)
    lines = {r["line"] for r in R.rule_lines(R.association_rules(found, 0.6)).collect()}
    assert "c  | a b  | 2 | 0.666667" in lines
    assert {r["line"] for r in R.itemset_lines(found).collect()} == {
        "a b  |  {} | 4 | -1", "a c  |  {} | 2 | -1", "b c  |  {} | 2 | -1", "a b c  |  {} | 2 | -1"}


def test_numeric_item_order(spark):
    rows = pairs_of(spark, {1: ["10", "9", "2"], 2: ["10", "2"], 3: ["2"]})
    got = {r["tid"]: r for r in B.ordered_baskets(rows, B.item_ranks(B.item_support(rows))).collect()}
    assert got[1]["1"] == ["2", "9", "10"]
    assert got[1]["2"] == ["2", "10", "9"]
    assert got[1]["3"] == got[1]["default"] == ["9", "10", "2"]


def test_projected_database(spark):
    rows = pairs_of(spark, {1: "abc", 2: "ab", 3: "ac", 4: "a"})
    wide = B.ordered_baskets(rows, B.item_ranks(B.item_support(rows)))
    got = {(r["item"], r["prefix"]): r["n"] for r in B.projected_database(wide.select(F.col("2").alias("items")), "items").collect()}
    assert got == {("a", ""): 4, ("b", "a"): 2, ("c", "a,b"): 1, ("c", "a"): 1}


def test_dense_index_over_many_partitions(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("x")).repartition(13)
    numbered, total = dense_index(df, ["x"], "pos")
    assert total == 1000
    assert numbered.filter("pos <> x").count() == 0


def test_dense_index_of_nothing(spark):
    numbered, total = dense_index(spark.range(0).toDF("x"), ["x"], "pos")
    assert total == 0 and numbered.count() == 0


@pytest.mark.parametrize(("size", "most"), [(1, 7), (2, 7), (2, 32768), (3, 40), (3, 32768)])
def test_vertical_supports_equal_brute_force(spark, size, most):
    """Items that live in some ranges only, a basket with nothing frequent, an empty one, ties."""
    baskets = {t: sorted({f"i{(t * 7 + j * j) % 9}" for j in range(t % 6 + 1)} | ({"early"} if t < 12 else set())) for t in range(95)}
    baskets |= {200: ["rare"], 201: []}
    counts = {}
    for items in baskets.values():
        for c in combinations(items, size):
            counts[c] = counts.get(c, 0) + 1
    given = spark.createDataFrame(list(baskets.items()), "tid bigint, items array<string>").repartition(5)
    found = [(tuple(r["items"]), r["freq"]) for r in vertical_supports(given, size, 6, most).collect()]
    assert len(found) == len(dict(found)) and dict(found) == {c: n for c, n in counts.items() if n >= 6}


def test_vertical_supports_of_nothing(spark):
    assert vertical_supports(spark.createDataFrame([], "tid bigint, items array<string>"), 2, 1).count() == 0
    with pytest.raises(ValueError):
        vertical_supports(spark.createDataFrame([], "tid bigint, items array<string>"), 2, 0)
