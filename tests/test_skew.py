import pytest

from orevein.operators import skew


@pytest.mark.parametrize("hot", [3, 1000])
def test_measured_join_equals_a_join(spark, hot):
    """One key holds half of all rows; keys may be missing on either side, or null."""
    rows = [("common" if i % 2 else f"k{i % 7}", i) for i in range(200)] + [(None, 999), ("nowhere", 998)]
    big = spark.createDataFrame(rows, "key string, v int")
    lookup = spark.createDataFrame([("common", 1.0), ("unused", 9.0), (None, 5.0)] + [(f"k{i}", float(i)) for i in range(7)], "key string, w double")
    got = sorted(map(tuple, skew.join_measured(big, lookup, ["key"], hot).collect()))
    assert got == sorted(map(tuple, big.join(lookup, ["key"]).collect()))
    assert len(got) == 200


def test_hot_keys_are_those_above_their_share(spark):
    big = spark.createDataFrame([("a",)] * 50 + [("b",)] * 30 + [(f"c{i}",) for i in range(20)], "key string")
    assert {r["key"] for r in skew.hot_keys(big, ["key"], 4).collect()} == {"a", "b"}
    assert skew.hot_keys(big, ["key"], 1).count() == 0
