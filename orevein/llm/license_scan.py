"""License scan: MinHash bands over overlapping windows retrieve templates, shingle containment verifies them.

A text becomes an array of 3-word shingle hashes. Templates fall into classes by length: class c holds those
with at most 2^c shingles; its windows are 2^(c+1) shingles long and start every 2^c, so each occurrence of a
template lies whole in some window. A window is retrieved by bands of one minimum each; the least
similarity of a window that holds 80 % of a template of its class is 0.8 * 2^(c-1) / (2^(c+1) + 0.2 * 2^c) > 0.18, so
64 bands miss it with a probability below 1 - 0.18 to the 64th power, 3e-6. Retrieved templates count
when the window holds at least ``CONTAINED`` of their shingles exactly.

Only DataFrame functions. A window without any template shingle can't verify, so signatures are made only for windows
around positions that hold one (a bitmap of fixed size, then the exact list of template shingles). Arrays stay in their row until windows
are cut; no text is shuffled. Templates are a bounded list: ``MOST_SHINGLES`` shingles in all.

Defined cases: a null or empty text, or one with fewer than three words, holds nothing. Documents without a license give no
row. Rows that share an id are one document. Templates with fewer than three words are refused. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orevein.plans.tables import table
from orevein.session import Scratch

BANDS = 64
CONTAINED = 0.8
SLOTS = 65536
MOST_SHINGLES = 20_000
TOKEN = r"[\p{L}\p{N}]+(?:[.+-][\p{L}\p{N}]+)*"
# Notices of public licenses.
TEMPLATES = (
    ("all-rights-reserved", "All rights reserved."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("lgpl-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("mit", "Released under the MIT License."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)


def shingles(text: Column) -> Column:
    """Hashes of all 3-word shingles in order."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))
    return _hashed(words)


def _hashed(words: Column) -> Column:
    count = F.greatest(F.size(words) - 2, F.lit(0))
    return F.transform(
        F.slice(words, F.lit(1), count), lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))
    )


def _templates(spark: SparkSession, templates: DataFrame, scratch: Scratch) -> DataFrame:
    """``(license, t, size, class)``: the distinct shingles of every template."""
    words = templates.select("license", F.regexp_extract_all(F.lower("text"), F.lit(TOKEN), F.lit(0)).alias("w"))
    found = words.select("license", F.array_distinct(_hashed(F.col("w"))).alias("t")).filter(F.size("t") > 0)
    found = found.withColumn("size", F.size("t")).withColumn(
        "class", F.ceil(F.log2("size")).cast("int")
    )
    return scratch.table(found, "templates")


def _minima(held: Column) -> Column:
    """The smallest hash of a set under each of BANDS permutations."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.array_min(F.transform(held, lambda x: F.xxhash64(x, b)))
    )


def scan(docs: DataFrame, templates: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, license, containment, first_word, n_windows)``, a row per document and license found."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "licenses")
    known = _templates(spark, templates, scratch)
    # Bounded by MOST_SHINGLES: the shingles of a fixed list of templates.
    marks = sorted({h for r in known.select("t").collect() for h in r["t"]})
    if len(marks) > MOST_SHINGLES:
        raise ValueError(f"templates hold more than {MOST_SHINGLES} different shingles")
    slots = bytearray(SLOTS)
    for mark in marks:
        slots[mark % SLOTS] = 1
    classes = sorted({r["class"] for r in known.select("class").distinct().collect()})
    listed = F.expr("array(" + ", ".join(f"{m}L" if m > -(1 << 63) else "-9223372036854775807L - 1L" for m in marks) + ")") if marks else F.expr("cast(array() as array<bigint>)")
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(TOKEN), F.lit(0))
    rows = docs.select(F.col(id_col).alias("id"), words.alias("w")).select("id", _hashed(F.col("w")).alias("h"))
    table_of_slots = F.lit(bytes(slots))

    def held(h: Column) -> Column:
        spot = F.pmod(h, F.lit(SLOTS)).cast("int") + 1
        return (F.substring(table_of_slots, spot, F.lit(1)) == F.lit(b"\x01")) & F.array_contains(listed, h)

    spots = F.filter(F.transform(F.col("h"), lambda h, i: F.when(held(h), i)), lambda i: i.isNotNull())
    rows = rows.withColumn("hits", spots)
    # No filter on ``hits``: Spark would push it below the arrays and build them anew for each element.
    starts = F.array(*[
        F.struct(
            F.lit(c).alias("class"),
            F.array_distinct(F.filter(
                F.flatten(F.transform("hits", lambda p: F.array((p / (1 << c)).cast("int"), (p / (1 << c)).cast("int") - 1))),
                lambda s: s >= 0,
            )).alias("starts"),
        ) for c in classes
    ]) if classes else F.expr("cast(array() as array<struct<class:int,starts:array<int>>>)")
    windows = (
        rows.select("id", "h", F.explode(starts).alias("at")).select("id", "h", "at.class", F.explode("at.starts").alias("start"))
        .withColumn("stride", F.expr("shiftleft(1, class)"))
        .withColumn("held", F.array_distinct(F.slice("h", F.col("start") * F.col("stride") + 1, F.col("stride") * 2)))
        .select("id", "class", "start", "stride", "held", F.posexplode(_minima(F.col("held"))).alias("band", "value"))
    )
    bands = scratch.table(
        known.select("license", "t", "size", "class", F.posexplode(_minima(F.col("t"))).alias("band", "value")), "bands"
    )
    share = F.size(F.array_intersect("held", "t")) / F.col("size")
    return (
        windows.join(bands, ["class", "band", "value"]).withColumn("share", share).filter(F.col("share") >= CONTAINED)
        .groupBy("id", "license").agg(
            F.max("share").alias("containment"), F.min(F.col("start") * F.col("stride")).cast("bigint").alias("first_word"),
            F.count_distinct("start").alias("n_windows"),
        )
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    templates = spark.createDataFrame(list(TEMPLATES), "license string, text string")
    return scan(table(spark, sf_dir, "documents"), templates).withColumnRenamed("id", "doc_id")


_VALUES = ", ".join(f"('{name}', '{text}')" for name, text in TEMPLATES)
_TOKENS = r"'[\p{L}\p{N}]+(?:[.+-][\p{L}\p{N}]+)*'"
QUERIES = {"op3_license_scan": op3_license_scan}
ORACLES = {
    "op3_license_scan": f"""
        WITH templates(license, text) AS (VALUES {_VALUES}),
        cut AS (
            SELECT license, len(t) AS size, unnest(t) AS s,
                   CASE WHEN len(t) = 1 THEN 1 ELSE (2 ** ceil(log2(len(t))))::BIGINT END AS stride
            FROM (SELECT license, list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) AS t
                  FROM (SELECT license, regexp_extract_all(lower(text), {_TOKENS}) AS w FROM templates))
        ), words AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), {_TOKENS}) AS w FROM documents),
        hits AS (
            SELECT doc_id, i - 1 AS pos, license, size, stride, s
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words)
            JOIN cut ON s = w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]
        ), placed AS (
            SELECT doc_id, license, size, stride, s, unnest([pos // stride, pos // stride - 1]) AS start FROM hits
        ), good AS (
            SELECT doc_id, license, stride, start, count(DISTINCT s) / size AS share FROM placed
            WHERE start >= 0 GROUP BY doc_id, license, stride, start, size HAVING count(DISTINCT s) / size >= 0.8
        )
        SELECT doc_id, license, max(share) AS containment, min(start * stride) AS first_word, count(*) AS n_windows
        FROM good GROUP BY doc_id, license
    """,
}
