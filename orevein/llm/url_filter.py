"""URL rules by a sort-merge range join.

A rule ``(host, path)`` fits its host and all subdomains when the url's path starts with
the rule's; the longest fitting rule wins. The canonical key of a rule is its host with the
labels reversed, a separator that sorts lowest, and the path; the keys that start with it form
one interval, and intervals of two rules are nested or apart. A url is a point under each of
its host's parents that has rules. Rules and points are sorted together and swept once:
a stack holds the rules that contain the current key, its top is the longest.

Scale: only parents that have rules get points. Parents with many points are salted, their
rules copied once per salt, so that a hot host spreads over many tasks; a task streams
sorted rows and keeps nothing but the stack (as deep as rules are nested).

Defined cases: host is what follows the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased
(user names and ports are part of it); path is what follows up to ``? #`` or the end. A null url
or one without ``://`` has an empty host and path and no rule. Of two rules with the same host
and path ``block`` wins; equal lengths go to the longer host. Rules with a null or empty host, path or
verdict are refused. Repeated rows and ids each get their own result; empty tables are fine.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orevein.plans.tables import table
from orevein.session import Scratch

DEFAULT = "allow"  # verdict for urls without a rule
POINTS_EACH = 200_000  # points of one parent that share a salt
# The rules of the registered query.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def url_host(url: Column) -> Column:
    """Host of a url; ``translate`` lower-cases A-Z only."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def _parents(host: Column) -> Column:
    """The host and all its parents, most general first, labels reversed."""
    labels = F.reverse(F.split(host, r"\."))
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, F.lit(1), i), "."))


def _sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by (parent, salt, key, points last): the top of the stack is the longest rule."""
    where, stack = None, []
    for batch in batches:
        out = []
        for parent, salt, key, row, verdict in zip(batch.parent, batch.salt, batch.key, batch.row, batch.verdict):
            if (parent, salt) != where:
                where, stack = (parent, salt), []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if row < 0:
                if not stack or stack[-1][0] != key:
                    stack.append((key, verdict))
            elif stack:
                out.append((row, parent, *stack[-1]))
        yield pd.DataFrame(out, columns=["row", "parent", "key", "verdict"])


def judge(urls: DataFrame, rules: DataFrame, url_col: str = "url", default: str = DEFAULT) -> DataFrame:
    """``urls`` (all columns) with ``_host, _path, _rule, _verdict``; ``rules`` has ``host, path, verdict``.

    The four replace columns of ``urls`` with their names; all others pass through, whatever they are called.
    """
    scratch = Scratch(urls.sparkSession, "urls")
    rules = rules.filter("host <> '' AND path <> '' AND verdict IN ('allow', 'block')").select(
        reversed_host(F.col("host")).alias("parent"), F.col("path").alias("key"), "verdict"
    ).groupBy("parent", "key").agg(F.max("verdict").alias("verdict"))  # 'block' sorts after 'allow'
    # The stamp is stable once written; it ties results to rows also where ids repeat.
    rows = scratch.table(urls.select(
        F.struct("*").alias("given"), F.monotonically_increasing_id().alias("_row"),
        url_host(F.col(url_col)).alias("_host"), url_path(F.col(url_col)).alias("_path"),
    ), "rows")
    parts = rows.select("_row", "_host", "_path")
    points = parts.filter("_host <> ''").select(
        F.explode(_parents(F.col("_host"))).alias("parent"), F.col("_path").alias("key"), F.col("_row").alias("row")
    ).join(rules.select("parent").distinct(), "parent", "left_semi")
    points = scratch.table(points, "points")
    salts = points.groupBy("parent").agg(F.ceil(F.count("*") / POINTS_EACH).cast("int").alias("salts"))
    dealt = points.join(salts, "parent").select(
        "parent", F.pmod(F.xxhash64("row"), F.col("salts")).cast("int").alias("salt"), "key", "row",
        F.lit("").alias("verdict"),
    ).union(
        rules.join(salts, "parent").select(
            "parent", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "key",
            F.lit(-1).cast("bigint").alias("row"), "verdict",
        )
    )
    swept = (
        dealt.repartition("parent", "salt").sortWithinPartitions("parent", "salt", "key", "row")
        .mapInPandas(_sweep, "row bigint, parent string, key string, verdict string")
    )
    size = F.char_length("parent") + F.char_length("key")
    best = swept.groupBy("row").agg(
        F.max(F.struct(size.alias("size"), F.char_length("parent").alias("host_size"), "verdict", "parent", "key")).alias("best")
    ).select(
        F.col("row").alias("_row"), F.concat(reversed_host(F.col("best.parent")), F.col("best.key")).alias("_rule"),
        F.col("best.verdict").alias("_verdict"),
    )
    judged = rows.join(best, "_row", "left")
    added = {"_host", "_path", "_rule", "_verdict"}
    return judged.select(
        *[F.col(f"given.`{c}`") for c in urls.columns if c.lower() not in added],
        "_host", "_path", "_rule", F.coalesce("_verdict", F.lit(default)).alias("_verdict"),
    )


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, rules).select(
        "page_id", F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"),
        F.col("_verdict").alias("verdict"),
    )


QUERIES = {"op6_url_filter": op6_url_filter}
ORACLES = {
    "op6_url_filter": r"""
        WITH parts AS (
            SELECT page_id,
                   translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
            FROM pages
        ), rules(rule_host, rule_path, verdict) AS (
            VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                   ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
        )
        SELECT page_id, host, path,
               (SELECT rule_host || rule_path FROM rules
                WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
                ORDER BY length(rule_host || rule_path) DESC LIMIT 1) AS rule,
               coalesce((SELECT verdict FROM rules
                WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
                ORDER BY length(rule_host || rule_path) DESC LIMIT 1), 'allow') AS verdict
        FROM parts
    """,
}
