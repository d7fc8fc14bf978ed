"""Exact top-k search by inner product: norm-sorted blocks, SVD-rotated partial sums, Cauchy-Schwarz bounds.

Equal vectors are one class first (a hot vector costs one row; a class keeps its k + 1 smallest ids, more cannot
appear in a list of k). Classes are sorted by length, falling, and cut into blocks. All vectors are rotated by
the right singular vectors of the table, so that the first coordinates carry most of every product.

The longest block is searched first for every query; its k-th score is a lower bound. A query then goes only to
blocks whose longest vector may reach that bound (length times length), and in a block a pair goes on
only while the products of its leading coordinates plus the lengths of the two remainders may reach
the bound. What is left is multiplied in whole numbers. Rounding is covered by ``_slack``. No candidate
is left out otherwise: the result is exact.

The work is a query set against all rows, in tiles of at most ``BLOCK`` classes x ``ASKING`` queries; a tile
returns at most k + 1 rows per query, never pairs.

Defined cases: vectors that are null or hold null or non-finite components take no part; an empty or zero vector
takes part (score 0), shorter vectors count as followed by zeros, huge components stand at 2**52
(:mod:`orevein.llm.dense`), scores beyond a long stand at its ends. Rows are told apart by row, not by id: with
repeated ids a query finds the other rows of its id, and there is a list for each. A row with null id is a candidate
(it comes after all ids on ties) but no query. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from orevein.llm import dense
from orevein.llm.common import shuffle_partitions
from orevein.operators.indexing import dense_index
from orevein.operators.skew import join_measured
from orevein.plans.tables import table
from orevein.session import Scratch

BLOCK = 65536  # classes of one block
ASKING = 4096  # queries of one tile
STRIP = 1024  # classes of a tile that are multiplied at once
GROUP = 256  # queries that are multiplied with a strip at once
PAIRS = 16384  # pairs whose rows are copied at once
STEPS = (0.25, 0.5, 0.75)  # shares of the coordinates after which pairs are tested
DENSE = 1 / 16  # beyond this share of pairs left, products of all of them take less than copies of the rows left
NO_SCORE = -(2**63)


def _slack(lengths: np.ndarray, width: int) -> np.ndarray:
    """More than the rounding of a rotated product of vectors of these lengths (its square root is exact enough)."""
    return lengths * (16 * (width + 16) * np.finfo(float).eps)


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products of whole numbers; beyond a long they stand at its ends."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if bound < 2**53:
        return np.einsum("ij,ij->i", a.astype(np.float64), b.astype(np.float64)).astype(np.int64)
    if bound < 2**62:
        return np.einsum("ij,ij->i", a, b)
    sums = (sum(p * q for p, q in zip(x, y)) for x, y in zip(a.tolist(), b.tolist()))
    return np.array([min(max(s, NO_SCORE + 1), 2**63 - 1) for s in sums], dtype=np.int64)


class Best:
    """The ``k`` best ``(score, class)`` of every query; on equal scores the lower rank of a class wins."""

    def __init__(self, queries: int, k: int) -> None:
        self.k = k
        self.score = np.full((queries, k), NO_SCORE, np.int64)
        self.place = np.full((queries, k), -1, np.int64)
        self.low = np.full((queries, k), np.iinfo(np.int64).max, np.int64)

    def worst(self) -> np.ndarray:
        return self.score[:, -1]

    def add(self, query: np.ndarray, score: np.ndarray, place: np.ndarray, low: np.ndarray) -> None:
        touched = np.unique(query)
        query = np.concatenate([np.repeat(touched, self.k), query])
        score = np.concatenate([self.score[touched].ravel(), score])
        place = np.concatenate([self.place[touched].ravel(), place])
        low = np.concatenate([self.low[touched].ravel(), low])
        # NO_SCORE has no negative: compare by the complement, which reverses the order of longs.
        order = np.lexsort((low, ~score, query))
        query = query[order]
        first = np.searchsorted(query, touched)
        rank = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
        kept = order[rank < self.k]
        self.score[touched] = score[kept].reshape(-1, self.k)
        self.place[touched] = place[kept].reshape(-1, self.k)
        self.low[touched] = low[kept].reshape(-1, self.k)


def _pair_products(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, product) -> np.ndarray:
    """``product`` of rows ``a[i]`` and ``b[j]``, copied a few at a time."""
    parts = [product(a[i[s:s + PAIRS]], b[j[s:s + PAIRS]]) for s in range(0, len(i), PAIRS)]
    return np.concatenate(parts) if parts else np.zeros(0)


def _row_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", a, b)


def search_block(queries: np.ndarray, least: np.ndarray, rows: np.ndarray, low: np.ndarray, rotation: np.ndarray, k: int) -> Best:
    """Best ``k`` rows per query that score at least ``least``; ``rows`` are sorted by falling length.

    ``low`` orders rows of equal score. All numbers are whole; ``rotation`` is an orthogonal matrix. Besides the
    block itself only the pairs of ``GROUP`` queries and ``STRIP`` rows are held, whatever share of them is left.
    """
    width = rows.shape[1]
    best = Best(len(queries), k)
    turned_q, turned = queries @ rotation, rows @ rotation
    length_q, length = np.linalg.norm(turned_q, axis=1), np.linalg.norm(turned, axis=1)
    ends = sorted({max(1, int(width * s)) for s in STEPS} | {width}) if width else [0]
    # Length of what lies behind each step.
    behind_q = [np.linalg.norm(turned_q[:, e:], axis=1) for e in ends]
    behind = [np.linalg.norm(turned[:, e:], axis=1) for e in ends]
    bound = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(width, 1)
    for start in range(0, len(rows), STRIP):
        part = slice(start, start + STRIP)
        need = np.maximum(least, best.worst())
        need = np.where(need <= NO_SCORE + 1, -np.inf, need.astype(np.float64))  # the end of a long stands for all below
        need = need - np.where(np.isinf(need), 0, np.abs(need)) * 2 * np.finfo(float).eps  # a long may have been rounded up
        top = length[part].max()
        reach = np.flatnonzero(length_q * top + _slack(length_q * top, width) >= need)
        need = need - _slack(length_q * top, width)
        whole = rows[part].astype(np.float64) if len(reach) and bound < 2**53 else None  # exact, sums too
        for first in range(0, len(reach), GROUP):
            live = reach[first:first + GROUP]
            product = turned_q[live, :ends[0]] @ turned[part, :ends[0]].T
            i, j = np.nonzero(product + behind_q[0][live, None] * behind[0][part] >= need[live, None])
            value, dense_left = product[i, j], True
            for e, (begin, end) in enumerate(zip(ends, ends[1:]), 1):
                if not len(i):
                    break
                dense_left = dense_left and len(i) > product.size * DENSE
                if dense_left:
                    product += turned_q[live, begin:end] @ turned[part, begin:end].T
                    value = product[i, j]
                else:
                    value = value + _pair_products(turned_q[:, begin:end], turned[:, begin:end], live[i], start + j, _row_products)
                keep = value + behind_q[e][live[i]] * behind[e][start + j] >= need[live[i]]
                i, j, value = i[keep], j[keep], value[keep]
            if not len(i):
                continue
            if whole is not None and len(i) > product.size * DENSE:
                score = (queries[live].astype(np.float64) @ whole.T)[i, j].astype(np.int64)
            else:
                score = _pair_products(queries, rows, live[i], start + j, exact_products)
            i, j = live[i], start + j
            keep = score >= np.maximum(least, best.worst())[i]
            best.add(i[keep], score[keep], j[keep], low[j[keep]])
    return best


def _tile(queries: pa.Table, rows: pa.Table, rotation: np.ndarray, k: int) -> pa.Table:
    """Best classes of one tile: ``(q, cls, score, ids)``."""
    width = len(rotation)
    rows = rows.take(pa.array(np.argsort(rows["place"].to_numpy()))).combine_chunks()
    x, y = (dense.matrix(t["x"].combine_chunks(), width) for t in (queries, rows))
    best = search_block(x, queries["least"].to_numpy(), y, rows["low"].to_numpy(), rotation, k)
    i, r = np.nonzero(best.place >= 0)
    hit = pa.array(best.place[i, r])
    return pa.table({
        "q": queries["cls"].take(pa.array(i)), "cls": rows["place"].take(hit),
        "score": pa.array(best.score[i, r], pa.int64()), "ids": rows["ids"].take(hit),
    })


def _lists(found: DataFrame, k: int) -> DataFrame:
    """``(q, list)``: of all classes found per query the best k + 1 rows ``(rank, id, score, cls)``; null ids last.

    A tile sends at most k + 1 classes per query; each task keeps the best k + 1 rows before they are shuffled.
    """
    order = [F.desc("score"), F.asc_nulls_last("id"), "cls", "nth"]
    ranked = found.select("q", "score", "cls", F.posexplode("ids").alias("nth", "id")).withColumn(
        "rank", F.row_number().over(Window.partitionBy("q").orderBy(*order))
    )
    return ranked.filter(F.col("rank") <= k + 1).groupBy("q").agg(
        F.sort_array(F.collect_list(F.struct("rank", "id", "score", "cls"))).alias("list")
    )


def _classes(rows: DataFrame, k: int) -> DataFrame:
    """``(x, ids, asking, square)``: different vectors, their k + 1 smallest ids, number of queries, squared length.

    A task keeps k + 1 ids per class before the shuffle, so a hot vector costs that many rows per task.
    """
    order = Window.partitionBy("x").orderBy(F.asc_nulls_last("id"))
    smallest = (
        rows.select("x", "id").withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k + 1)
        .groupBy("x").agg(F.sort_array(F.collect_list(F.struct("nth", "id")))["id"].alias("ids"))
    )
    asking = rows.groupBy("x").agg(F.sum(F.col("asked").cast("bigint")).alias("asking"))
    square = F.aggregate("x", F.lit(0.0), lambda total, v: total + v.cast("double") * v)
    return smallest.join(asking, "x").withColumn("square", square)


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` other rows with the highest product of every query row.

    ``is_query`` is a condition on column ``id``; vectors are taken as ``floor(scale * c)``.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    usable = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    usable = usable.filter(dense.finite(F.col("vector")))
    width = dense.longest(usable, "vector")
    asked = F.coalesce(F.col("id").isNotNull() & is_query, F.lit(False))
    rows = scratch.table(
        usable.select("id", asked.alias("asked"), dense.whole_numbers(F.col("vector"), scale, 0, width).alias("x")), "rows"
    )
    placed, total = dense_index(_classes(rows, k), [F.desc("square"), F.element_at("ids", 1).asc_nulls_last(), "x"], "place")
    rotation = np.eye(width)
    if total and width:
        gram = dense.summed(placed, "x", width, lambda x: x.astype(np.float64).T @ x.astype(np.float64))
        rotation = np.ascontiguousarray(np.linalg.eigh(gram / max(np.abs(gram).max(), 1))[1][:, ::-1])

    # At least one block per task of a shuffle, at most BLOCK classes in each.
    size = max(1, min(BLOCK, -(-total // max(spark.sparkContext.defaultParallelism, shuffle_partitions(vectors)))))
    low = F.coalesce(F.element_at("ids", 1), F.lit(np.iinfo(np.int64).max))
    placed = placed.withColumn("block", F.floor(F.col("place") / size).cast("int")).withColumn("low", low)
    parts = max(1, -(-placed.filter("asking > 0").count() // ASKING))
    part = F.pmod(F.xxhash64("place"), F.lit(parts)).cast("int").alias("part")
    queries = scratch.table(placed.filter("asking > 0").select(part, F.col("place").alias("cls"), "square", "x"), "queries")

    def search(asking: DataFrame, name: str) -> DataFrame:
        # Only blocks that some query goes to are dealt out.
        tiles = asking.select(F.col("block").alias("to_block"), F.col("part").alias("to_part")).distinct()
        dealt = placed.join(tiles, F.col("block") == F.col("to_block")).select("to_block", "to_part", "place", "low", "ids", "x")
        found = asking.groupBy("block", "part").cogroup(dealt.groupBy("to_block", "to_part")).applyInArrow(
            lambda left, right: _tile(left, right, rotation, k + 1), "q bigint, cls bigint, score bigint, ids array<bigint>"
        )
        return scratch.table(found, name)

    # The block of the longest vectors first: its scores bound every query from below.
    nothing = F.lit(NO_SCORE).cast("bigint")
    first = F.when(F.col("cls").isNotNull(), 0).alias("block")  # per row: a constant would turn the join into a nested loop
    head = search(queries.select(first, "part", "cls", "x", nothing.alias("least")), "head")
    least = _lists(head, k).select(
        F.col("q").alias("cls"), F.when(F.size("list") > k, F.element_at("list", k + 1)["score"]).alias("least")
    )
    # One number per block reaches the driver. Lengths fall, so a query goes to leading blocks only.
    tops = [r["top"] for r in placed.groupBy("block").agg(F.max("square").alias("top")).orderBy("block").collect()][1:]
    bounds = F.split(F.lit(",".join(repr(t) for t in tops)), ",").cast("array<double>") if tops else F.array().cast("array<double>")
    bounded = queries.join(least, "cls", "left").withColumn("least", F.coalesce("least", nothing))
    reach = F.filter(bounds, lambda top: F.sqrt("square") * F.sqrt(top) * (1 + 1e-9) >= F.col("least").cast("double"))
    going = bounded.withColumn("last", F.size(reach)).filter("last > 0")
    going = going.select(F.explode(F.sequence(F.lit(1), "last")).alias("block"), "part", "cls", "x", "least")
    lists = _lists(head.union(search(going, "tail")), k) if tops else _lists(head, k)
    lists = scratch.table(lists, "lists").withColumnRenamed("q", "cls")

    # Back to query rows: each leaves its own row out, once.
    found = join_measured(rows.filter("asked").select("id", "x"), queries.select("cls", "x").join(lists, "cls"), ["x"])
    own = F.array_position(F.transform("list", lambda e: (e["cls"] == F.col("cls")) & e["id"].eqNullSafe(F.col("id"))), True)
    others = F.filter("list", lambda e, i: i + 1 != F.col("own"))
    ranked = found.withColumn("own", own).select(
        F.col("id").alias("query_id"), F.posexplode(F.slice(others, 1, k)).alias("place", "hit")
    )
    return ranked.select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("hit.id").alias("vec_id"), F.col("hit.score").alias("score")
    )


def op13_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


QUERIES = {"op13_topk_search": op13_topk_search}
ORACLES = {
    "op13_topk_search": """
        WITH rows_ AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x,
                   row_number() OVER () AS place
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, q.place, r.vec_id,
                   CAST(list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * r.x[i])) AS BIGINT) AS score
            FROM rows_ q JOIN rows_ r ON q.vec_id % 100 = 0 AND q.place <> r.place
        ), ranked AS (
            SELECT query_id, vec_id, score,
                   row_number() OVER (PARTITION BY query_id, place ORDER BY score DESC, vec_id NULLS LAST) AS rank
            FROM scored
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
}
