"""Connected components of a link table, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orevein.session import Scratch


def connected_components(edges: DataFrame, scratch: Scratch, rounds: list[int] | None = None) -> DataFrame:
    """``(id, component)`` for every id in ``edges (a, b)``: the smallest id it can reach.

    Links point from the larger to the smaller id. A round first hooks every id's larger neighbours to the smallest id
    among its neighbours and itself (large star), then its smaller ones (small star), until nothing moves; then each id
    points at its component. Long paths fold up in about log2(n) rounds in whatever order their ids come. Neighbourhoods
    are never gathered: a step is one aggregate, combined on the map side, and one join with a row per id. Only the
    changed rows' number and a checksum reach the driver; ``rounds`` takes the links left after each round. No links: no rows.
    """
    down = edges.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
    ids = scratch.table(down.select(F.explode(F.array("high", "low")).alias("id")).distinct(), "ids")
    links = scratch.table(down.filter("high <> low").distinct(), "links")
    state = _state(links)
    while True:
        both = links.select(F.col("high").alias("id"), F.col("low").alias("near")).union(
            links.select(F.col("low").alias("id"), F.col("high").alias("near"))
        )
        least = both.groupBy("id").agg(F.min("near").alias("near")).select("id", F.least("id", "near").alias("least"))
        large = scratch.table(
            both.filter("near > id").join(least, "id").select(F.col("near").alias("high"), F.col("least").alias("low")).distinct(),
            "large",
        )
        scratch.drop(links)
        least = large.groupBy("high").agg(F.min("low").alias("least"))
        links = scratch.table(
            large.join(least, "high").select(
                F.when(F.col("low") > F.col("least"), F.col("low")).otherwise(F.col("high")).alias("high"), F.col("least").alias("low")
            ).filter("high <> low").distinct(), "links",
        )
        scratch.drop(large)
        before, state = state, _state(links)
        if rounds is not None:
            rounds.append(state[0])
        if state == before:
            break
    found = scratch.table(
        ids.join(links, ids["id"] == links["high"], "left").select("id", F.coalesce("low", "id").alias("component")), "components"
    )
    scratch.drop(ids, links)
    return found


def _state(links: DataFrame) -> tuple[int, int]:
    """Number of different links and a checksum over them, which tell whether a round changed any."""
    got = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("high", "low").cast("decimal(20,0)")).alias("sum")).first()
    return got["n"], int(got["sum"] or 0)
