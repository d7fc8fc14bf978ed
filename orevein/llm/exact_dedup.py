"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

One scan keeps a light row per document (id, code points, length and prefix hash of the
normalised text). Rows whose length is unique leave first, then rows whose (length,
prefix hash) is unique. Only the survivors' texts are read in full and hashed.
Groups are counted with map-side partial sums; a hot group is one row per task.

Defined cases: a null text is an empty one; empty texts are equal to each other. Texts
are equal when identical after deleting every character of ``[\\x20\\x09-\\x0D]``. Of equal
texts the row with the most code points in the original text stays, then the smallest id;
a null id comes last. Repeated rows (same id, same text) all count, share one ``keep_id`` and
are cut to one row by :func:`deduplicate`. An empty table gives no rows. Other columns are
never read by the comparison, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orevein.llm.common import SPACE
from orevein.plans.tables import table
from orevein.session import Scratch

PREFIX = 64  # code points of the normalised text in the prefix hash
BITS = 32768  # bits of one bitmap, fixed by Spark
BUCKETS = 256  # bitmaps, 1 MB in all


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", "")


def _facts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Length, prefix hash and normalised text of every document; ``row`` holds its columns, so that no names can meet."""
    plain = docs.select(
        F.struct("*").alias("row"), F.col(id_col).alias("_id"),
        F.char_length(F.coalesce(F.col(text_col), F.lit(""))).alias("_points"), normalised(F.col(text_col)).alias("_norm"),
    )
    return plain.select(
        "row", "_id", "_points", F.octet_length("_norm").alias("_bytes"),
        F.xxhash64(F.substring("_norm", 1, PREFIX)).alias("_prefix"), "_norm",
    )


def _shared_keys(facts: DataFrame, scratch: Scratch) -> DataFrame:
    """The (length, prefix hash) keys of more than one document."""
    light = scratch.table(facts.select("_bytes", "_prefix"), "light")
    by_length = light.groupBy("_bytes").count().filter("count > 1").drop("count")
    left = light.join(by_length, "_bytes", "left_semi")
    shared = scratch.table(
        left.groupBy("_bytes", "_prefix").count().filter("count > 1").drop("count"), "prefixes"
    )
    scratch.drop(light)
    return shared


def _seen_bits(keys: DataFrame) -> DataFrame:
    """Bitmap of the surviving (length, prefix) keys: at most ``BUCKETS`` rows of 4 KB, whatever the input."""
    spot = keys.select(F.pmod(F.xxhash64("_bytes", "_prefix"), F.lit(BUCKETS * BITS)).alias("spot"))
    return spot.groupBy((F.col("spot") / BITS).cast("int").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.col("spot") % BITS).alias("_bitmap")
    )


def _with_survivors(facts: DataFrame, shared: DataFrame) -> DataFrame:
    """``facts`` with ``_survives``: false tells that no other document has the length and the prefix hash."""
    spot = F.pmod(F.xxhash64("_bytes", "_prefix"), F.lit(BUCKETS * BITS))
    facts = facts.withColumn("_spot", spot).withColumn("_bucket", (F.col("_spot") / BITS).cast("int"))
    facts = facts.join(F.broadcast(_seen_bits(shared)), "_bucket", "left")
    byte = F.conv(F.hex(F.expr("substring(_bitmap, cast(_spot % 32768 div 8 as int) + 1, 1)")), 16, 10).cast("int")
    hit = (F.floor(byte / F.pow(F.lit(2), F.expr("_spot % 8").cast("int"))) % 2) == 1
    return facts.withColumn("_survives", F.coalesce(hit, F.lit(False)))


def _digest() -> Column:
    return F.sha2(F.col("_norm").cast("binary"), 256)


def _grouped(full: DataFrame, shared: DataFrame) -> DataFrame:
    best = F.struct(-F.col("_points"), F.col("_id").isNull(), F.col("_id").alias("_id"))
    groups = (
        full.join(shared, ["_bytes", "_prefix"], "left_semi")
        .groupBy(F.col("_sha").alias("_key")).agg(F.min(best)["_id"].alias("_keep"), F.count("*").alias("_size"))
    )
    # Rows without a digest get a key of their own, else all of them would meet in one task.
    own = F.concat_ws("/", "_bytes", "_prefix")
    met = full.withColumn("_key", F.coalesce("_sha", own)).join(groups, "_key", "left")
    found = F.col("_size").isNotNull()
    return met.select(
        "_id", "_points", "_sha", F.when(found, F.col("_keep")).otherwise(F.col("_id")).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("bigint").alias("group_size"),
    ).withColumn("kept", F.col("_id").eqNullSafe(F.col("keep_id")))


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_all: bool = False
) -> DataFrame:
    """``(_id, _points, _sha, keep_id, group_size, kept)``, a row per document.

    ``_sha`` is null where length and prefix already tell the text apart from all others,
    unless ``hash_all`` asks for every digest. No text is shuffled: the second scan tests
    a bitmap of fixed size to see which texts it has to read in full.
    """
    scratch = Scratch(docs.sparkSession, "exact")
    facts = _facts(docs, id_col, text_col)
    shared = _shared_keys(facts, scratch)
    digest = _digest()
    if not hash_all:
        facts, digest = _with_survivors(facts, shared), F.when(F.col("_survives"), digest)
    full = scratch.table(facts.select("_id", "_points", "_bytes", "_prefix", digest.alias("_sha")), "full")
    return _grouped(full, shared)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns; repeated rows are cut to one.

    Documents that length and prefix tell apart go through as they are read: they are not hashed in full, joined or
    shuffled. Only survivors are hashed, and only their rows meet the decisions.
    """
    scratch = Scratch(docs.sparkSession, "exact")
    facts = _facts(docs, id_col, text_col)
    shared = _shared_keys(facts, scratch)
    rows = _with_survivors(facts, shared)
    alone = rows.filter(~F.col("_survives")).select("row.*")
    survivors = rows.filter("_survives").withColumn("_sha", _digest())
    full = scratch.table(survivors.select("_id", "_points", "_bytes", "_prefix", "_sha"), "full")
    # Of a repeated id only the row with the most code points is the one that was meant.
    stays = scratch.table(
        _grouped(full, shared).filter("kept").groupBy("_id", "_sha").agg(F.max("_points").alias("_points")), "stays"
    )
    marked = survivors.select("row", "_id", "_points", "_sha").alias("m")
    same = [F.col("m._id").eqNullSafe(F.col("s._id")), F.col("m._points") == F.col("s._points"), F.col("m._sha") == F.col("s._sha")]
    found = marked.join(stays.alias("s"), same[0] & same[1] & same[2], "left_semi")
    return alone.unionAll(found.dropDuplicates(["_id", "_points", "_sha"]).select("row.*"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_groups(table(spark, sf_dir, "documents"), hash_all=True)
    return groups.select(
        F.col("_id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("_sha").alias("text_sha256")
    )


QUERIES = {"op4_exact_dedup": op4_exact_dedup}
ORACLES = {
    "op4_exact_dedup": r"""
        WITH norm AS (
            SELECT doc_id, length(coalesce(text, '')) AS points,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
            FROM documents
        ), groups AS (
            SELECT text_sha256, count(*) AS group_size,
                   first(doc_id ORDER BY points DESC, doc_id) AS keep_id
            FROM norm GROUP BY text_sha256
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM norm JOIN groups USING (text_sha256)
    """,
}
