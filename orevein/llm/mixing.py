"""Mix sources to target weights by entropy balancing.

Of all document rates the one nearest to 1 in entropy that meets every source's token target is
``min(cap, exp(lambda_s * size / mean size of s))``. The dual is convex with one unknown per source; it
is solved by safeguarded Newton steps, each one aggregate over the histogram (source, size, documents).
Documents of one source and size share a rate, so the histogram is exact; its size is bounded by the
different lengths, not by the documents. Rates become copies in two steps: per histogram cell by
systematic rounding from the longest documents down (a source's error is at most half its longest
document) and a few single copies that close the rest; in a cell by the hash order of ids.

Scale: documents are scanned once and pre-aggregated; unknowns, targets and brackets are tables, only
counts reach the driver. Sums are decimal, so reruns agree whatever the order of rows. A hot cell is cut into
hash buckets of bounded size, so no window holds a source or a cell.

Defined cases: size is the number of words (null text: 0). A null source is a source of its own, last in
order. Empty documents get rate 1 and add nothing. A source whose target is ``cap`` times its size takes every
document ``cap`` times. Repeated rows are documents of their own. Empty tables give no rows. Columns of other names pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from orevein.llm.common import word_count
from orevein.operators.indexing import dense_index
from orevein.plans.tables import table
from orevein.session import Scratch

WEIGHTS = (5, 2, 1)  # given in turn to the sources in code point order
BUDGET = 1.5  # words of the mix as a share of all words
CAP = 2  # most copies of a document
BUCKET = 50_000  # documents of one (source, size) that are ranked together
PRECISION = 1e-9  # of a source's token constraint
MOST_STEPS = 200  # a bracket shrinks below double precision long before
CLOSING = 4  # single copies that close a source's rounding error


def _exact(value: Column) -> Column:
    """Decimal terms add up to the same sum in any order."""
    return value.cast("decimal(38,9)")


def source_targets(
    sources: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET, cap: float = CAP
) -> DataFrame:
    """Add ``target`` to ``(sid, source_size, ...)``: weights share the budget, capped sources' excess is reshared.

    Resharing by weight ends where every source has ``min(cap * size, level * weight)``; each pass raises the level.
    """
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    weighed = sources.withColumn("_weight", turn)
    most = F.col("source_size") * F.lit(cap)
    words = weighed.agg(F.sum("source_size").alias("s")).first()["s"] or 0
    level, before = 0.0, -1
    while True:
        full = most < F.lit(level) * F.col("_weight")
        row = weighed.agg(
            F.sum(F.when(full, most)).alias("taken"), F.sum(F.when(~full, F.col("_weight"))).alias("weight"),
            F.count_if(full).alias("full"),
        ).first()
        if not row["weight"] or row["full"] == before:
            break
        before, level = row["full"], (budget * words - float(row["taken"] or 0)) / row["weight"]
    return weighed.withColumn("target", F.least(most.cast("double"), F.lit(level) * F.col("_weight"))).drop("_weight")


def _rate(cap: float) -> Column:
    return F.when(F.col("full"), F.lit(float(cap))).otherwise(
        F.least(F.lit(float(cap)), F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(700.0))))
    )


def solve(cells: DataFrame, targets: DataFrame, scratch: Scratch, cap: float = CAP) -> DataFrame:
    """``(sid, mean, target, full, lam)``: the dual's solution for histogram ``cells (sid, size, n)``."""
    state = scratch.table(
        targets.filter("source_size > 0").select(
            "sid", "target", (F.col("source_size") / F.col("n_docs")).alias("mean"),
            (F.col("target") >= F.col("source_size") * F.lit(cap) * F.lit(1 - 1e-12)).alias("full"), F.lit(0.0).alias("lam"),
            F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"), F.lit(False).alias("done"),
        ), "dual",
    )
    for _ in range(MOST_STEPS):
        rate, tilt = _rate(cap), F.col("size") / F.col("mean")
        tokens = F.col("n") * F.col("size")
        sums = cells.join(state, "sid").groupBy("sid").agg(
            F.sum(_exact(tokens * rate)).cast("double").alias("f"),
            F.sum(_exact(F.when(rate < cap, tokens * tilt * rate).otherwise(0.0))).cast("double").alias("df"),
        )
        done = F.col("full") | F.col("done") | (F.abs(F.col("f") - F.col("target")) <= F.lit(PRECISION) * F.col("target"))
        # Newton on log f, which is nearly straight in lambda; outside the bracket the step halves it.
        newton = F.col("lam") - F.log(F.col("f") / F.col("target")) * F.col("f") / F.col("df")
        low = F.when(F.col("f") < F.col("target"), F.col("lam")).otherwise(F.col("lo"))
        high = F.when(F.col("f") > F.col("target"), F.col("lam")).otherwise(F.col("hi"))
        inside = newton.isNotNull() & ~F.isnan(newton) & F.coalesce(newton > F.col("lo"), F.lit(True)) & F.coalesce(newton < F.col("hi"), F.lit(True))
        half = F.when(F.col("lo").isNull(), F.col("hi") * 2 - F.abs("hi") - 1).when(
            F.col("hi").isNull(), F.col("lo") + F.abs("lo") + 1
        ).otherwise((F.col("lo") + F.col("hi")) / 2)
        new = (
            state.join(sums, "sid").withColumn("lo", low).withColumn("hi", high).withColumn("done", done)
            .withColumn("lam", F.when(F.col("done"), F.col("lam")).when(inside, newton).otherwise(half))
            .select(*state.columns)
        )
        new = scratch.table(new, "dual")
        scratch.drop(state)
        state = new
        if not state.filter("NOT done").limit(1).count():
            break
    return state.select("sid", "target", "mean", "full", "lam")


def round_cells(cells: DataFrame, solved: DataFrame, scratch: Scratch, cap: float = CAP) -> DataFrame:
    """``(sid, size, n, copies)``: whole copies of all documents of a cell."""
    down = Window.partitionBy("sid").orderBy(F.col("size").desc())
    upto = F.sum(F.col("n") * _rate(cap)).over(down.rowsBetween(Window.unboundedPreceding, 0))
    placed = cells.join(solved, "sid").withColumn("_upto", F.floor(upto + 0.5))
    placed = placed.withColumn(
        "copies", F.least(F.greatest(F.col("_upto") - F.coalesce(F.lag("_upto").over(down), F.lit(0)), F.lit(0)), F.col("n") * cap).cast("bigint")
    ).select("sid", "size", "n", "target", "copies")
    for _ in range(CLOSING):  # one copy more or less of the document nearest in size to what is left
        placed = scratch.table(placed, "copies")
        left = placed.groupBy("sid").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("left"))
        can = F.when(F.col("left") > 0, F.col("copies") < F.col("n") * cap).otherwise(F.col("copies") > 0)
        miss = F.abs(F.abs("left") - F.col("size"))
        pick = (
            placed.join(left, "sid").filter(can & (miss < F.abs("left")) & (F.col("size") > 0))
            .groupBy("sid").agg(F.min(F.struct(miss.alias("miss"), F.col("size").alias("size"), F.signum("left").cast("int").alias("step"))).alias("p"))
            .select("sid", F.col("p.size").alias("size"), F.col("p.step").alias("step"))
        )
        placed = placed.join(pick, ["sid", "size"], "left").withColumn(
            "copies", F.col("copies") + F.coalesce("step", F.lit(0))
        ).drop("step")
    return scratch.table(placed.select("sid", "size", "n", "copies"), "copies")


def mix(
    docs: DataFrame, carry: list[str], id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
    weights: tuple = WEIGHTS, budget: float = BUDGET, cap: int = CAP,
) -> DataFrame:
    """Columns ``carry`` of every document with ``_size, _source_size, _target, _copies``."""
    found = _mix(docs, carry, id_col, source_col, text_col, weights, budget, cap)
    return found.select("row.*", "_size", "_source_size", "_target", "_copies")


def _mix(
    docs: DataFrame, carry: list[str], id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
    weights: tuple = WEIGHTS, budget: float = BUDGET, cap: int = CAP,
) -> DataFrame:
    """As ``mix``, the carried columns in one column ``row``."""
    scratch = Scratch(docs.sparkSession, "mixing")
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(id_col).alias("id"),
        F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
    )
    if text_col not in carry:  # a light table saves the second look at the texts
        base = scratch.table(base, "sizes")
    by_size = scratch.table(
        base.groupBy("source", "size").agg(F.count("*").alias("n")), "histogram"
    )
    totals = by_size.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_docs")
    )
    numbered, _ = dense_index(totals, [F.col("source").isNull(), F.col("source")], "sid")
    targets = scratch.table(source_targets(numbered, weights, budget, cap), "targets")
    same = F.col("h.source").eqNullSafe(F.col("t.source"))
    cells = scratch.table(
        by_size.alias("h").join(targets.alias("t"), same).select("t.sid", "h.size", "h.n"), "cells"
    )
    copies = round_cells(cells, solve(cells, targets, scratch, cap), scratch, cap)
    # Sources without words have no cell in the dual; their documents are taken once, at no words.
    plan = cells.join(copies.drop("n"), ["sid", "size"], "left").select(
        "sid", "size", "n", F.coalesce("copies", "n").alias("copies"), F.ceil(F.col("n") / BUCKET).cast("int").alias("buckets")
    ).join(targets.select("sid", "source", "source_size", "target"), "sid")
    plan = scratch.table(plan, "plan")
    same = F.col("b.source").eqNullSafe(F.col("p.source")) & (F.col("b.size") == F.col("p.size"))
    order = F.xxhash64("id")
    dealt = base.alias("b").join(plan.alias("p"), same).select(
        "b.row", "b.id", "p.*", F.pmod(order, F.col("p.buckets")).alias("bucket")
    )
    extra = F.col("copies") % F.col("n")
    spread = base.select("id", "source", "size").alias("b").join(
        plan.filter("buckets > 1").alias("p"), same
    ).groupBy("p.sid", "p.size", F.pmod(order, F.col("p.buckets")).alias("bucket")).agg(F.count("*").alias("members"))
    across = Window.partitionBy("sid", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = spread.select("sid", "size", "bucket", F.coalesce(F.sum("members").over(across), F.lit(0)).alias("before"))
    inside = Window.partitionBy("sid", "size", "bucket").orderBy(order, "id")
    ranked = dealt.withColumn("place", F.row_number().over(inside)).join(before, ["sid", "size", "bucket"], "left")
    taken = F.floor(F.col("copies") / F.col("n")) + (F.col("place") + F.coalesce("before", F.lit(0)) <= extra).cast("int")
    return ranked.select(
        "row", F.col("size").alias("_size"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"),
        taken.cast("bigint").alias("_copies"),
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it; columns of any name pass through."""
    found = _mix(docs, docs.columns, **options).filter("_copies > 0")
    return found.select("row", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("row.*")


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mix(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select(
        "doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"), (F.col("_copies") * F.col("_size")).alias("taken"),
    )


QUERIES = {"op5_source_mix": op5_source_mix}
ORACLES: dict[str, str] = {}
