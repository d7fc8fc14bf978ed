"""Basket queries: a basket is an order, its items are the brands of its parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from orevein.operators import baskets as B, rules as R
from orevein.operators.vertical import vertical_supports
from orevein.plans.tables import table
from orevein.session import materialize

MIN_SUPPORT_FLOOR = 15
BASKETS_PER_SUPPORT = 1000  # minimum support is one basket in a thousand, rounded up
MIN_CONFIDENCE = 0.025


def order_brands(spark: SparkSession, sf: str) -> DataFrame:
    """Baskets ``(tid, items)``, written once."""
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    bought = lines.join(part, lines.l_partkey == part.p_partkey)
    return materialize(B.assemble_baskets(B.item_rows(bought, "l_orderkey", "p_brand")), "baskets")


def minimum_support(baskets: DataFrame) -> int:
    return max(MIN_SUPPORT_FLOOR, -(-baskets.count() // BASKETS_PER_SUPPORT))


def _joined(column: str):
    return F.array_join(column, ",").alias(column)


def _frequent(baskets: DataFrame) -> DataFrame:
    return B.item_support(B.basket_items(baskets), minimum_support(baskets))


def _itemsets(spark: SparkSession, sf: str) -> DataFrame:
    baskets = order_brands(spark, sf)
    return B.frequent_itemsets(baskets, minimum_support(baskets))


def _ordered(spark: SparkSession, sf: str) -> DataFrame:
    baskets = order_brands(spark, sf)
    return B.ordered_baskets(B.basket_items(baskets), B.item_ranks(_frequent(baskets)))


def _of_size(spark: SparkSession, sf: str, size: int) -> DataFrame:
    """From vertical bitmaps, without the mining of ``_itemsets``, so that each checks the other."""
    names = [F.element_at("items", i).alias(f"i{i}") for i in range(1, size + 1)]
    baskets = order_brands(spark, sf)
    return vertical_supports(baskets, size, minimum_support(baskets)).select(*names, "freq")


def fim_baskets(spark, sf):
    return order_brands(spark, sf).select("tid", _joined("items"), F.size("items").alias("n"))


def fim_item_support(spark, sf):
    return _frequent(order_brands(spark, sf)).orderBy(F.desc("freq"), "item")


def fim_item_rank(spark, sf):
    return B.item_ranks(_frequent(order_brands(spark, sf)))


def fim_pruned_baskets(spark, sf):
    baskets = order_brands(spark, sf)
    kept = B.prune(B.basket_items(baskets), _frequent(baskets))
    return B.assemble_baskets(kept).select("tid", _joined("items"))


def fim_basket_order(spark, sf):
    return _ordered(spark, sf).unpivot("tid", list(B.SORT_OPTIONS), "option", "items").select(
        "tid", "option", _joined("items")
    )


def fim_itemsets(spark, sf):
    return _itemsets(spark, sf).select(_joined("items"), "size", "freq")


def fim_pairs(spark, sf):
    return _of_size(spark, sf, 2)


def fim_triples(spark, sf):
    return _of_size(spark, sf, 3)


def fim_projected_db(spark, sf):
    return B.projected_database(_ordered(spark, sf).select(F.col("2").alias("items")), "items")


def fim_rule_candidates(spark, sf):
    return R.rule_candidates(_itemsets(spark, sf)).select(
        _joined("items"), _joined("antecedent"), _joined("consequent")
    )


def fim_consequent_gen(spark, sf):
    _, grown = R.grow_rules(_itemsets(spark, sf), MIN_CONFIDENCE)
    return grown.select(_joined("items"), _joined("antecedent"), _joined("consequent"))


def fim_rules(spark, sf):
    return R.association_rules(_itemsets(spark, sf), MIN_CONFIDENCE).select(
        _joined("antecedent"), _joined("consequent"), "freq", F.round("confidence", 6).alias("confidence")
    )


def fim_rules_text(spark, sf):
    return R.rule_lines(R.association_rules(_itemsets(spark, sf), MIN_CONFIDENCE))


def fim_itemsets_text(spark, sf):
    return R.itemset_lines(_itemsets(spark, sf))


def fim_summary(spark, sf):
    itemsets = _itemsets(spark, sf)
    return R.rules_per_size(itemsets, R.association_rules(itemsets, MIN_CONFIDENCE))


QUERIES = {
    f.__name__: f
    for f in (
        fim_baskets, fim_item_support, fim_item_rank, fim_pruned_baskets, fim_basket_order,
        fim_itemsets, fim_pairs, fim_triples, fim_projected_db, fim_rule_candidates,
        fim_consequent_gen, fim_rules, fim_rules_text, fim_itemsets_text, fim_summary,
    )
}

# ---------------------------------------------------------------- SQL counterparts

_PAIRS = """
pairs AS (SELECT DISTINCT l_orderkey AS tid, p_brand AS item
          FROM lineitem JOIN part ON l_partkey = p_partkey),
bound AS (SELECT CAST(greatest(15, ceil(count(DISTINCT tid) / 1000.0)) AS BIGINT) AS minsup FROM pairs),
support AS (SELECT item, count(*) AS freq FROM pairs GROUP BY item
            HAVING count(*) >= (SELECT minsup FROM bound)),
ranks AS (SELECT item, freq,
                 row_number() OVER (ORDER BY freq DESC, item) - 1 AS rank,
                 count(*) OVER () - row_number() OVER (ORDER BY freq DESC, item) AS rev_rank
          FROM support),
kept AS (SELECT tid, item, rank, rev_rank FROM pairs JOIN ranks USING (item))
"""

_SETS = _PAIRS + """,
sets1 AS (SELECT item AS a, freq FROM support),
sets2 AS (SELECT x.item AS a, y.item AS b, count(*) AS freq
          FROM kept x JOIN kept y ON x.tid = y.tid AND x.item < y.item
          GROUP BY ALL HAVING count(*) >= (SELECT minsup FROM bound)),
sets3 AS (SELECT x.item AS a, y.item AS b, z.item AS c, count(*) AS freq
          FROM kept x JOIN kept y ON x.tid = y.tid AND x.item < y.item
          JOIN kept z ON y.tid = z.tid AND y.item < z.item
          GROUP BY ALL HAVING count(*) >= (SELECT minsup FROM bound)),
sets4 AS (SELECT x.item AS a, y.item AS b, z.item AS c, w.item AS d, count(*) AS freq
          FROM kept x JOIN kept y ON x.tid = y.tid AND x.item < y.item
          JOIN kept z ON y.tid = z.tid AND y.item < z.item
          JOIN kept w ON z.tid = w.tid AND z.item < w.item
          GROUP BY ALL HAVING count(*) >= (SELECT minsup FROM bound)),
sets AS MATERIALIZED (
  SELECT a AS items, [a] AS members, 1 AS size, freq FROM sets1 UNION ALL
  SELECT concat_ws(',', a, b), [a, b], 2, freq FROM sets2 UNION ALL
  SELECT concat_ws(',', a, b, c), [a, b, c], 3, freq FROM sets3 UNION ALL
  SELECT concat_ws(',', a, b, c, d), [a, b, c, d], 4, freq FROM sets4)
"""

_CANDIDATES = _SETS + """,
masks AS (SELECT unnest(generate_series(1, 14)) AS mask),
candidates AS MATERIALIZED (
  SELECT s.items, s.size, s.freq, m.mask,
         array_to_string([s.members[i] FOR i IN range(1, s.size + 1) IF (m.mask >> (i - 1)) & 1 = 0], ',') AS antecedent,
         array_to_string([s.members[i] FOR i IN range(1, s.size + 1) IF (m.mask >> (i - 1)) & 1 = 1], ',') AS consequent,
         CAST(bit_count(m.mask) AS BIGINT) AS consequent_size
  FROM sets s JOIN masks m ON m.mask < (1 << s.size) - 1
  WHERE s.size > 1),
scored AS (SELECT c.*, t.freq AS ante_freq, c.freq / CAST(t.freq AS DOUBLE) AS confidence
           FROM candidates c JOIN sets t ON t.items = c.antecedent),
rules AS (SELECT * FROM scored WHERE freq > CAST(0.025 AS DOUBLE) * ante_freq)
"""

# A consequent of two or more items is a candidate if the two consequents that lack its
# last or its last-but-one item both passed; every prefix of a passing one passes too.
_GROWN = _CANDIDATES + """,
parts AS (SELECT items, antecedent, consequent, consequent_size,
                 string_split(consequent, ',') AS c FROM candidates WHERE consequent_size > 1),
grown AS (
  SELECT p.items, p.antecedent, p.consequent FROM parts p
  WHERE EXISTS (SELECT 1 FROM rules r WHERE r.items = p.items
                AND r.consequent = array_to_string(p.c[1:p.consequent_size - 1], ','))
    AND EXISTS (SELECT 1 FROM rules r WHERE r.items = p.items
                AND r.consequent = array_to_string(list_concat(p.c[1:p.consequent_size - 2],
                                                               [p.c[p.consequent_size]]), ',')))
"""

ORACLES = {
    "fim_baskets": f"WITH {_PAIRS} SELECT tid, string_agg(item, ',' ORDER BY item) AS items, "
                   "CAST(count(*) AS INTEGER) AS n FROM pairs GROUP BY tid",
    "fim_item_support": f"WITH {_PAIRS} SELECT item, freq FROM support ORDER BY freq DESC, item",
    "fim_item_rank": f"WITH {_PAIRS} SELECT item, freq, rank, rev_rank FROM ranks",
    "fim_pruned_baskets": f"WITH {_PAIRS} SELECT tid, string_agg(item, ',' ORDER BY item) AS items "
                          "FROM kept GROUP BY tid",
    "fim_basket_order": f"""WITH {_PAIRS}
        SELECT tid, '1' AS option,
               string_agg(item, ',' ORDER BY TRY_CAST(item AS BIGINT) NULLS FIRST, item) AS items FROM kept GROUP BY tid
        UNION ALL SELECT tid, '2', string_agg(item, ',' ORDER BY rank) FROM kept GROUP BY tid
        UNION ALL SELECT tid, '3', string_agg(item, ',' ORDER BY rank DESC) FROM kept GROUP BY tid
        UNION ALL SELECT tid, 'default', string_agg(item, ',' ORDER BY rank DESC) FROM kept GROUP BY tid""",
    "fim_itemsets": f"WITH {_SETS} SELECT items, size, freq FROM sets",
    "fim_pairs": f"WITH {_SETS} SELECT a AS i1, b AS i2, freq FROM sets2",
    "fim_triples": f"WITH {_SETS} SELECT a AS i1, b AS i2, c AS i3, freq FROM sets3",
    "fim_projected_db": f"""WITH {_PAIRS},
        prefixes AS (SELECT x.tid, x.item, coalesce(string_agg(y.item, ',' ORDER BY y.rank), '') AS prefix
                     FROM kept x LEFT JOIN kept y ON x.tid = y.tid AND y.rank < x.rank
                     GROUP BY x.tid, x.item)
        SELECT item, prefix, count(*) AS n FROM prefixes GROUP BY item, prefix""",
    "fim_rule_candidates": f"WITH {_CANDIDATES} SELECT items, antecedent, consequent FROM candidates",
    "fim_consequent_gen": f"WITH {_GROWN} SELECT items, antecedent, consequent FROM grown",
    "fim_rules": f"WITH {_CANDIDATES} SELECT antecedent, consequent, freq, round(confidence, 6) AS confidence FROM rules",
    "fim_rules_text": f"""WITH {_CANDIDATES}
        SELECT replace(antecedent, ',', ' ') || '  | ' || replace(consequent, ',', ' ') || '  | ' || freq
               || ' | ' || CAST(CAST(round(confidence, 6) AS DECIMAL(10,6)) AS VARCHAR) AS line FROM rules""",
    "fim_itemsets_text": f"WITH {_SETS} SELECT replace(items, ',', ' ') || '  |  {{}} | ' || freq || ' | -1' AS line "
                         "FROM sets WHERE size > 1",
    "fim_summary": f"""WITH {_CANDIDATES}
        SELECT s.size, s.n_itemsets, coalesce(r.n_rules, 0) AS n_rules
        FROM (SELECT size, count(*) AS n_itemsets FROM sets GROUP BY size) s
        LEFT JOIN (SELECT size, count(*) AS n_rules FROM rules GROUP BY size) r USING (size)""",
}
