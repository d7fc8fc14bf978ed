"""Near-duplicate vectors by int8 tile products with error bounds.

Equal vectors are one class first, so a hot vector costs one row. Classes are dealt into
blocks; each pair of blocks is one tile, multiplied as int8 values. For unit vectors u, v with
quantised u', v' and residual norms e, f the product differs from the cosine by at most
``e + f + e f``; only pairs that may reach the threshold are recomputed in double precision.
A tile returns one row per linked class (links and the tile's smallest reachable class), never the pairs.

The work is quadratic in the number of different vectors, as the method is; each tile is bounded
by ``BLOCK`` x ``BLOCK`` products, held ``STRIP`` rows at a time.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link
with nothing; vectors of different lengths never link. Repeated rows link like any equal
vectors; a null id counts as a vector, and the smallest id of a group ignores it. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orevein.llm.components import connected_components
from orevein.plans.tables import table
from orevein.session import Scratch

BLOCK = 8192  # classes of one block
STRIP = 512  # rows of a tile that are multiplied at once
SLACK = 1e-6  # beyond rounding in the bound itself
EXACT_DIM = 1040  # 127 * 127 * dim stays below 2**24, so float32 adds int8 products exactly


def usable(vector: Column) -> Column:
    """True for vectors with only finite components that aren't all zero."""
    inf = F.lit(float("inf"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(vectors: pd.Series) -> np.ndarray:
    """Unit rows; scaling by a power of two first keeps squares inside double precision."""
    x = np.stack(vectors.to_numpy()).astype(np.float64)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Int8 values, scale and residual norm of every unit row."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    return codes, scale, np.linalg.norm(unit - codes * scale[:, None], axis=1)


def linked_rows(a: np.ndarray, b: np.ndarray, threshold: float):
    """Per row of ``a`` that has any: its number and the rows of ``b`` with cosine >= threshold."""
    (qa, sa, ea), (qb, sb, eb) = quantise(a), quantise(b)
    kind = np.float32 if a.shape[1] <= EXACT_DIM else np.float64
    qb_t = np.ascontiguousarray(qb.T.astype(kind))
    # Tested as product * scale >= threshold - e - f - e f, the largest residual of b standing in first.
    worst = eb.max()
    for start in range(0, len(a), STRIP):
        rows = slice(start, start + STRIP)
        product = qa[rows].astype(kind) @ qb_t
        least = threshold - ea[rows] - worst - ea[rows] * worst - SLACK
        least = least / sa[rows] / np.where(least > 0, sb.max(), sb.min())
        i, j = np.nonzero(product >= np.floor(least)[:, None].astype(kind))
        near = product[i, j].astype(np.float64) * sa[rows][i] * sb[j]
        e, f = ea[rows][i], eb[j]
        keep = near >= threshold - e - f - e * f - SLACK
        i, j = i[keep], j[keep]
        for part in range(0, len(i), 1 << 16):
            pi, pj = i[part:part + (1 << 16)], j[part:part + (1 << 16)]
            sure = np.einsum("ij,ij->i", a[rows][pi], b[pj]) >= threshold
            yield start + pi[sure], pj[sure]


def _tile(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links of one tile: ``(cls, n_links, root)`` for linked classes."""
    first = pdf["side"].to_numpy() == 0
    own = bool((pdf["left"] == pdf["right"]).iloc[0])
    a = pdf[first].sort_values("cls")
    b = a if own else pdf[~first].sort_values("cls")
    if not len(a) or not len(b):
        return pd.DataFrame({"cls": [], "n_links": [], "root": []})
    ids = a.cls.to_numpy() if own else np.concatenate([a.cls.to_numpy(), b.cls.to_numpy()])
    weight = a.weight.to_numpy() if own else np.concatenate([a.weight.to_numpy(), b.weight.to_numpy()])
    shift = 0 if own else len(a)
    ua = _unit(a.vector)
    ub = ua if own else _unit(b.vector)
    links, group = np.zeros(len(ids), np.int64), np.arange(len(ids))
    for i, j in linked_rows(ua, ub, threshold):
        if own:
            i, j = i[i < j], j[i < j]
        j = j + shift
        np.add.at(links, i, weight[j])
        np.add.at(links, j, weight[i])
        while len(i):  # merge what still lies in different groups
            gi, gj = group[i], group[j]
            apart = gi != gj
            i, j, gi, gj = i[apart], j[apart], gi[apart], gj[apart]
            if not len(i):
                break
            low, high = np.minimum(gi, gj), np.maximum(gi, gj)
            parent = np.arange(len(ids))
            np.minimum.at(parent, high, low)
            while (parent[parent] != parent).any():
                parent = parent[parent]
            group = parent[group]
    low = np.full(len(ids), np.iinfo(np.int64).max)
    np.minimum.at(low, group, ids)
    hit = links > 0
    return pd.DataFrame({"cls": ids[hit], "n_links": links[hit], "root": low[group][hit]})


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95
) -> DataFrame:
    """``(id, n_links, component_id, kept)``, a row per vector; ``component_id`` is the smallest id reachable."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "embeddings")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    good = rows.filter(usable(F.col("vector")))
    classes = scratch.table(
        good.groupBy("vector").agg(F.min("id").alias("low"), F.count("*").alias("weight"))
        .withColumn("cls", F.monotonically_increasing_id()), "classes",
    )
    # At least enough blocks for every core, at most BLOCK classes in each.
    cores = spark.sparkContext.defaultParallelism
    blocks = max(-(-classes.count() // BLOCK), int((2 * cores) ** 0.5) + 1)
    block = F.pmod(F.xxhash64("cls"), F.lit(blocks)).cast("int")
    dealt = classes.withColumn("block", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    ).select(
        F.size("vector").alias("dim"), F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"),
        (F.col("block") > F.col("other")).cast("int").alias("side"), "cls", "weight", "vector",
    )
    # A block's own tile has one side only; every other tile gets its left block as side 0.
    tiles = scratch.table(
        dealt.groupBy("dim", "left", "right").applyInPandas(
            lambda pdf: _tile(pdf, threshold), "cls bigint, n_links bigint, root bigint"
        ), "tiles",
    )
    linked = tiles.groupBy("cls").agg(F.sum("n_links").alias("n_links"))
    reach = connected_components(tiles.select(F.col("cls").alias("a"), F.col("root").alias("b")), scratch)
    reach = reach.withColumnRenamed("id", "cls")
    lowest = classes.select("cls", "low").join(reach, "cls").groupBy("component").agg(F.min("low").alias("component_id"))
    found = (
        classes.join(linked, "cls", "left").join(reach.join(lowest, "component"), "cls", "left")
        .select(
            "vector", (F.coalesce("n_links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component_id", "low").alias("component_id"),
        )
    )
    met = good.join(found, "vector").select("id", "n_links", "component_id")
    alone = rows.filter(~usable(F.col("vector"))).select(
        "id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id")
    )
    return met.union(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


QUERIES = {"op10_embedding_dedup": op10_embedding_dedup}
ORACLES = {
    "op10_embedding_dedup": """
        WITH RECURSIVE unit AS (
            SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS norm
            FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)
            WHERE v IS NOT NULL AND len(v) > 0
              AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(v, v) > 0
        ), links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
            WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.95
        ), walk AS (
            SELECT a, b FROM links UNION SELECT walk.a, links.b FROM walk JOIN links ON walk.b = links.a
        ), lowest AS (SELECT a, least(a, min(b)) AS component_id FROM walk GROUP BY a),
        counted AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
        SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
               vec_id = coalesce(component_id, vec_id) AS kept
        FROM embeddings LEFT JOIN counted ON vec_id = counted.a LEFT JOIN lowest ON vec_id = lowest.a
    """,
}
