"""Pack documents into training sequences of several permitted lengths.

Variable-capacity best fit: pieces go, longest first, into the open bin with the least room that
takes them; if there is none, a bin of the least-cost size is opened, and at the end each bin is cut down to the
smallest permitted size that holds its contents. The sizes are optimised together: every choice of the largest
size to open is packed and the cheapest plan of the shard stays. A sequence of c tokens costs ``OVERHEAD + c + c * c / QUADRATIC``.

Scale: only ids and lengths are packed, never texts. Pieces are dealt by a hash of their position in a written table
into shards of about ``SHARD`` pieces, so a shard is bounded whatever its source or length; shards are independent,
each loses at most a few part-filled bins. Lost tasks repeat the same plan.

Defined cases: a token is a word (null text: none). Documents longer than the largest size are cut into pieces of
that size and a rest. Documents without words give one row with no bin. Repeated rows are packed each; their
pieces stay tied to their own row. Null ids stay null. Empty tables give no rows.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from orevein.llm.common import word_count
from orevein.plans.tables import table
from orevein.session import Scratch

CAPACITIES = (256, 512, 1024, 2048)
OVERHEAD = 8.0  # cost of a sequence besides its tokens
QUADRATIC = 16384.0  # length at which attention costs as much as the tokens
SHARD = 50_000  # pieces packed together


def sequence_cost(capacity: int) -> float:
    return OVERHEAD + capacity + capacity * capacity / QUADRATIC


def opening_size(length: int, rest: int, sizes: tuple) -> int:
    """Permitted size with the least cost per token it can hold, given the tokens still to come."""
    fitting = [c for c in sizes if c >= length]
    return min(fitting, key=lambda c: (sequence_cost(c) / min(c, length + rest), c))


def best_fit(lengths: list[int], sizes: tuple) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of every piece (``lengths`` in descending order) and the final size of every bin."""
    room: dict[int, list[int]] = {}  # free tokens -> open bins
    free_sizes = 0  # bit r is set while a bin has r free tokens
    place, offset, opened, used = [], [], [], []
    rest = sum(lengths)
    for length in lengths:
        rest -= length
        at_least = free_sizes >> length
        if at_least:
            free = length + (at_least & -at_least).bit_length() - 1
            chosen = room[free].pop()
            if not room[free]:
                free_sizes &= ~(1 << free)
        else:
            chosen, free = len(opened), opening_size(length, rest, sizes)
            opened.append(free)
            used.append(0)
        place.append(chosen)
        offset.append(used[chosen])
        used[chosen] += length
        left = free - length
        if left:
            room.setdefault(left, []).append(chosen)
            free_sizes |= 1 << left
    final = [min(c for c in sizes if c >= u) for u in used]
    return place, offset, final


def pack_lengths(lengths: list[int], capacities: tuple = CAPACITIES) -> tuple[list[int], list[int], list[int]]:
    """The cheapest of the plans that open sizes up to each permitted size; long pieces may open the larger ones."""
    best = None
    longest = lengths[0] if lengths else 0
    sizes = tuple(sorted(capacities))
    for most in sizes:
        if most < longest:
            continue
        plan = best_fit(lengths, tuple(c for c in sizes if c <= most))
        cost = sum(map(sequence_cost, plan[2]))
        if best is None or cost < best[0]:
            best = (cost, plan)
    return best[1] if best else ([], [], [])


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacities: tuple = CAPACITIES
) -> DataFrame:
    """A row per piece: ``doc_id, piece, first_word, length, bin_id, capacity, offset``."""
    scratch = Scratch(docs.sparkSession, "packing")
    most = max(capacities)
    sizes = docs.select(F.col(id_col).alias("doc_id"), word_count(F.col(text_col)).alias("words"))
    pieces = scratch.table(
        sizes.select(
            "doc_id", "words", F.explode(F.expr(f"sequence(0, greatest(cast(ceil(words / {most}) as int) - 1, 0))")).alias("piece")
        ).select(
            "doc_id", "piece", (F.col("piece").cast("bigint") * most).alias("first_word"),
            F.least(F.col("words") - F.col("piece") * most, F.lit(most)).cast("int").alias("length"),
        ).withColumn("stamp", F.monotonically_increasing_id()), "pieces",
    )
    shards = max(1, -(-pieces.count() // SHARD))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "stamp"], ascending=[False, True], kind="stable")
        place, offset, final = pack_lengths(pdf["length"].tolist(), capacities)
        pdf["bin_id"] = [(int(pdf["shard"].iloc[0]) << 32) + b for b in place]
        pdf["capacity"] = [final[b] for b in place]
        pdf["offset"] = offset
        pdf["doc_id"] = pdf["doc_id"].astype("Int64")
        return pdf[["doc_id", "piece", "first_word", "length", "bin_id", "capacity", "offset"]]

    shape = "doc_id bigint, piece int, first_word bigint, length int, bin_id bigint, capacity int, offset int"
    packed = (
        pieces.filter("length > 0").withColumn("shard", F.pmod(F.xxhash64("stamp"), F.lit(shards)))
        .withColumn("doc_id", F.col("doc_id").cast("bigint")).groupBy("shard").applyInPandas(one, shape)
    )
    empty = pieces.filter("length <= 0").select(
        F.col("doc_id").cast("bigint"), "piece", "first_word", F.lit(0).alias("length"),
        F.lit(None).cast("bigint").alias("bin_id"), F.lit(None).cast("int").alias("capacity"), F.lit(None).cast("int").alias("offset"),
    )
    return packed.union(empty)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


QUERIES = {"op8_best_fit_packing": op8_best_fit_packing}
ORACLES: dict[str, str] = {}
