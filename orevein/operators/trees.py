"""Exact decision trees grown level by level, for one tree or many at once.

Rows stay one per example: ``(tree, row_id, label, features ARRAY<DOUBLE>, m)`` with a
multiplicity ``m`` (1, or the number of bootstrap draws). Routing a row to a child only
reads its own array, so it is a lookup of the node and never a shuffle of rows.

Single steps (``with_ranges``, ``find_splits``): every attribute is sorted once, its different values get dense ranks, spread over the
numbers ``0 .. 2**bits - 1`` (``codes``). The best split of a level is then found on
integers, from the leading digits of the codes down: a step counts the classes per (node,
attribute, bin), combined on the map side, and adds the bins up. The smallest value of a bin
is a candidate whose counts are exact; the others in it can't be better than a bound,
so only bins whose bound reaches the best candidate are counted again by the next digit.

Whole trees (``fit``): noisy data is cut off at its ends, so that a node loses few rows per level and there are about as many levels as
attributes. A level of nodes beyond ``SUBTREE_ROWS`` rows is one job: tasks pack the values of their rows by (attribute, range
of values), and one stream per attribute scans the ranges in order for all nodes at once, holding the classes left of
the current range. A node of at most ``SUBTREE_ROWS`` rows is grown to its end by one task.

A model is a table of nodes ``(tree, node, depth, n, hist, used, is_leaf, a, split,
gini, label)``; ``node`` is the path from the root ``T`` (``TL``, ``TLR``, ...).
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from orevein.operators.indexing import dense_index
from orevein.operators.skew import join_measured
from orevein.session import Scratch, materialize, scratch_path

CLASSES = 10  # fixed value: labels are the ten classes 0..9
MIN_FREQ = 20  # fixed value: default minimum number of rows a node needs to be split
ROOT = "T"
SCAN_ROWS = 4096  # bins that one step counts per (node, attribute)
RANGE_BITS = 16  # a range of the scan over all values holds at most 2**16 of them
TIE = 1e-12  # bounds this close to the best candidate are looked into, whatever the rounding
MOST_NODES = 1_000_000  # a model up to this size goes to the tasks as arrays, about 32 MB
SUBTREE_ROWS = 8192  # a node of at most so many rows is grown to its end by one task
RANGE_ROWS = 65536  # about as many values of an attribute are scanned at once
PACK_CELLS = 1 << 19  # about as many cells are packed at once
BLOCK_CELLS = 1 << 17  # cells that a subtree's level works on at once

NODE_KEY = ["tree", "node"]


def _class_names(classes: int) -> list[str]:
    return [f"c{c}" for c in range(classes)]


def _class_counts(classes: int) -> list[Column]:
    return [F.expr(f"sum(CASE WHEN label = {c} THEN m ELSE 0 END) AS c{c}") for c in range(classes)]


def single_tree(rows: DataFrame) -> DataFrame:
    """Rows ``(row_id, label, features)`` as the input of one tree.

    The tree number is taken per row: with a constant as join key the lookups of nodes
    would be planned as nested loops.
    """
    return rows.select(_per_row(0).alias("tree"), "row_id", "label", "features", F.lit(1).cast("bigint").alias("m"))


def _per_row(value: int | str) -> Column:
    return F.when(F.col("row_id").isNotNull(), F.lit(value))


def long_features(rows: DataFrame) -> DataFrame:
    """``(row_id, label, a, v)``, one row per cell."""
    return rows.select("row_id", "label", F.posexplode("features").alias("a", "v"))


def _column_maxima(rows: DataFrame) -> DataFrame:
    cells = rows.select("tree", F.posexplode("features").alias("a", "v")).selectExpr("tree", "a", f"{_present('v')} AS v")
    return cells.groupBy("tree", "a").agg(F.max("v").alias("top"))


def kept_columns(rows: DataFrame) -> DataFrame:
    """``(tree, a, orig_a)``: columns with a positive value, renumbered from 0.

    At most one row per tree and column, so the numbering is small.
    """
    number = F.row_number().over(Window.partitionBy("tree").orderBy("orig_a")) - 1
    kept = _column_maxima(rows).filter(F.col("top") > 0).select("tree", F.col("a").alias("orig_a"))
    return kept.select("tree", number.alias("a"), "orig_a")


def apply_columns(rows: DataFrame, kept: list[int]) -> DataFrame:
    """Project the feature arrays onto the columns ``kept`` (test rows follow training rows)."""
    return rows.withColumn(
        "features", F.transform(F.array(*[F.lit(a) for a in kept]), lambda a: F.get("features", a))
    )


# ------------------------------------------------------------------------ node status


def _total(hist: str) -> str:
    return f"aggregate({hist}, 0L, (total, x) -> total + x)"


def _stops(hist: str, minfreq: int, width: int | None, used: str, max_depth: int | None, depth: str) -> str:
    """SQL test whether a node stops: too few rows, one class, no attribute left, too deep."""
    stop = f"{_total(hist)} < {minfreq} OR array_max({hist}) = {_total(hist)}"
    if width is not None:
        stop += f" OR size({used}) >= {width}"
    if max_depth is not None:
        stop += f" OR {depth} >= {max_depth}"
    return f"({stop})"


def node_status(nodes: DataFrame, minfreq: int, width: int | None = None, max_depth: int | None = None) -> DataFrame:
    """Add ``n, pure, label, stop`` from the class histogram ``hist`` of each node.

    The label is the majority class, the lowest one on a tie. A node stops if it has
    fewer than ``minfreq`` rows, one class, or no attribute left.
    """
    return nodes.selectExpr("*", f"{_total('hist')} AS n").selectExpr(
        "*", "array_max(hist) = n AS pure", "CAST(array_position(hist, array_max(hist)) - 1 AS INT) AS label",
        f"{_stops('hist', minfreq, width, 'used', max_depth, 'depth')} AS stop",
    )


def node_histograms(rows: DataFrame, classes: int = CLASSES) -> DataFrame:
    """``(tree, node, hist)``: class counts of rows that carry a node."""
    counts = rows.groupBy(*NODE_KEY).agg(*_class_counts(classes))
    return counts.select(*NODE_KEY, F.array(*_class_names(classes)).alias("hist"))


# --------------------------------------------------------------------- split candidates


def with_ranges(rows: DataFrame, scan_rows: int | None = None) -> DataFrame:
    """Add ``codes``: for every feature value its place among all values of its attribute, and ``bits``, their size.

    The different values of all attributes are range-sorted together once and numbered. A code is the number
    within the attribute times a fixed step, so that codes fill ``bits`` bits; codes are as ordered as values, a missing
    value (null or NaN) comes first. ``bits`` is a multiple of the digit that ``scan_rows`` bins make.
    A value that a large share of all cells holds is looked up by broadcast.
    """
    stamped = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "ranked")
    cells = stamped.select("_row", F.posexplode("features").alias("a", "v")).selectExpr("_row", "a", f"{_present('v')} AS v")
    cells = cells.selectExpr("_row", "a", "v IS NULL AS absent", "coalesce(v, CAST(0 AS DOUBLE)) AS v")
    values, _ = dense_index(cells.select("a", "absent", "v").distinct(), ["a", F.desc("absent"), "v"], "place")
    sizes = materialize(values.groupBy("a").agg(F.min("place").alias("first"), F.count("*").alias("size")), "sizes")
    largest = sizes.agg(F.max("size")).first()[0] or 1
    digit = digit_bits(scan_rows)
    bits = digit * -(-max(1, (largest - 1).bit_length()) // digit)
    # One row per attribute, so the lookup of the step is small.
    step = F.floor(F.lit(float(1 << bits)) / F.col("size")).cast("bigint")
    coded = values.join(F.broadcast(sizes), "a").select("a", "absent", "v", ((F.col("place") - F.col("first")) * step).alias("code"))
    found = join_measured(cells, materialize(coded, "codes"), ["a", "absent", "v"])
    codes = found.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("a", "code")))["code"].alias("codes"))
    return stamped.join(codes, "_row", "left").drop("_row").withColumn("bits", F.lit(bits))


def digit_bits(scan_rows: int | None) -> int:
    """Bits of the bin number of one step."""
    return min(RANGE_BITS, max(1, (scan_rows or SCAN_ROWS).bit_length() - 1))


def _cells(rows: DataFrame) -> DataFrame:
    """``(tree, node, label, m, a, code, v)`` of the attributes not yet used; a missing value is null."""
    cells = rows.selectExpr(*NODE_KEY, "label", "m", "used", "posexplode(arrays_zip(codes, features)) AS (a, cell)")
    return cells.filter("NOT array_contains(used, a)").selectExpr(
        *NODE_KEY, "label", "m", "a", "cell.codes AS code", f"{_present('cell.features')} AS v"
    )


def value_counts(rows: DataFrame, classes: int = CLASSES) -> DataFrame:
    """Class counts per (node, attribute, range, value) of the attributes not yet used.

    A missing value (null or NaN) is smaller than all others, as :func:`branch` sends it left.

    Equal values collapse before the shuffle, so a value that holds a large share of
    all rows costs one record per task.
    """
    cells = _cells(rows).selectExpr("*", f"shiftright(code, {RANGE_BITS}) AS part")
    return cells.groupBy(*NODE_KEY, "a", "part", "code", "v").agg(*_class_counts(classes))


def running_counts(counts: DataFrame, classes: int = CLASSES) -> DataFrame:
    """Class counts on both sides of every value: ``l0, l1, ...`` smaller, ``r0, r1, ...`` the rest.

    A window scans the codes of one range, at most ``2**RANGE_BITS`` of them; the class totals of the
    ranges before it are added; those totals are one row per (node, attribute, range).
    """
    labels = range(classes)
    smaller = "ORDER BY {} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    whole = "ORDER BY {} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
    scan = "PARTITION BY tree, node, a, part " + smaller.format("code")
    inside = [f"coalesce(sum(c{c}) OVER ({scan}), 0) AS i{c}" for c in labels]
    totals = counts.groupBy(*NODE_KEY, "a", "part").agg(*[F.sum(f"c{c}").alias(f"c{c}") for c in labels])
    ranges = "PARTITION BY tree, node, a "
    offsets = totals.selectExpr(
        *NODE_KEY, "a", "part",
        *[f"coalesce(sum(c{c}) OVER ({ranges + smaller.format('part')}), 0) AS o{c}" for c in labels],
        *[f"sum(c{c}) OVER ({ranges + whole.format('part')}) AS t{c}" for c in labels],
    )
    placed = counts.selectExpr(*NODE_KEY, "a", "part", "v", *inside).join(offsets, [*NODE_KEY, "a", "part"])
    return placed.selectExpr(
        *NODE_KEY, "a", "v", *[f"i{c} + o{c} AS l{c}" for c in labels], *[f"t{c} - i{c} - o{c} AS r{c}" for c in labels]
    )


def split_candidates(running: DataFrame, classes: int = CLASSES) -> DataFrame:
    """``(tree, node, a, v, gini, lh, rh)`` for every boundary between two values.

    ``v`` is the value right of the boundary; ``lh`` and ``rh`` are the class counts of
    both sides, which are the histograms of the children. ``gini`` is the impurity of
    both sides weighted by their size. Counts are squared as doubles: exact in any
    practical size and free of overflow.
    """
    def side(name):
        columns = [f"{name}{c}" for c in range(classes)]
        return (
            f"array({', '.join(columns)}) AS {name}h",
            f"CAST({' + '.join(columns)} AS DOUBLE) AS n{name}",
            f"{' + '.join(f'CAST({c} AS DOUBLE) * {c}' for c in columns)} AS s{name}",
        )

    gini = "((nl - sl / nl) + (nr - sr / nr)) / (nl + nr) AS gini"
    return (
        running.selectExpr(*NODE_KEY, "a", "v", *side("l"), *side("r"))
        .filter("nl > 0")
        .selectExpr(*NODE_KEY, "a", "v", gini, "lh", "rh")
    )


_FOUND = """
tree int, node string, a int, open boolean, gini double, split double, bin bigint, lh array<bigint>, rh array<bigint>
"""


def _impurity(counts: np.ndarray) -> np.ndarray:
    """Size times impurity of every row of class counts; 0 without rows."""
    size = counts.sum(axis=1)
    return size - (counts * counts).sum(axis=1) / np.where(size > 0, size, 1)


def _scan_bins(batches, digit: int):
    """Candidates and open bins of sorted bins ``(tree, node, a, bin, low, high, v, counts, before, after)``.

    Bins of one (tree, node, attribute, leading digits) are at most ``2**digit`` rows that follow each other;
    ``before`` and ``after`` are the classes left of the first of them and from there on. The first step has none of
    the two: a group holds all rows of its node. Of a batch only the
    best candidate of a node goes on, and the bins that may hold a better one: without the rows of a bin
    both sides are at most as impure as with them, however the split divides it.
    """
    rest = None
    for batch in itertools.chain(batches, [None]):
        table = pa.Table.from_batches([b for b in (rest, batch) if b is not None]).combine_chunks() if rest or batch else None
        if table is None or not table.num_rows:
            continue
        key = [table[c].combine_chunks().dictionary_encode().indices.to_numpy() for c in ("tree", "node", "a")]
        number = table["bin"].to_numpy()
        change = np.concatenate([[True], np.any([k[1:] != k[:-1] for k in [*key, number >> digit]], axis=0)])
        first = np.flatnonzero(change)
        if batch is not None:  # the last group may go on in the next batch
            rest = table.slice(first[-1]).to_batches()[0]
            table, first = table.slice(0, first[-1]).combine_chunks(), first[:-1]
            key, number = [k[:len(table)] for k in key], number[:len(table)]
        else:
            rest = None
        if not len(table):
            continue
        sides = [table[c].combine_chunks().flatten().to_numpy().reshape(len(table), -1) for c in ("counts", "before", "after") if c in table.column_names]
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(table))))
        counts, before, after = sides if len(sides) == 3 else (sides[0], 0, np.add.reduceat(sides[0], first, axis=0)[group])
        running = np.cumsum(counts, axis=0) - counts
        left = before + running - running[first][group]
        right = before + after - left
        total = (left + right).sum(axis=1)
        size = left.sum(axis=1).astype(float)
        other = right.sum(axis=1).astype(float)
        exact = [(side.astype(float) ** 2).sum(axis=1) for side in (left, right)]
        with np.errstate(divide="ignore", invalid="ignore"):
            gini = ((size - exact[0] / size) + (other - exact[1] / other)) / (size + other)
        gini = np.where((size > 0) & (other > 0), gini, np.inf)
        bound = (_impurity(left.astype(float)) + _impurity((right - counts).astype(float))) / total
        # Nodes follow each other, so a node is a run of rows.
        start = np.flatnonzero(np.concatenate([[True], (key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1])]))
        node = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(table))))
        least = np.minimum.reduceat(gini, start)
        best = np.flatnonzero(np.isfinite(gini) & (gini == least[node]))
        best = best[np.unique(node[best], return_index=True)[1]]  # rows are in the order of attribute and value
        wide = (table["low"].to_numpy() < table["high"].to_numpy()) & (bound <= least[node] * (1 + TIE))
        at = np.concatenate([best, np.flatnonzero(wide)])
        opened = np.arange(len(at)) >= len(best)
        take = pa.array(at)
        yield pa.RecordBatch.from_arrays([
            table["tree"].combine_chunks().take(take), table["node"].combine_chunks().take(take), table["a"].combine_chunks().take(take),
            pa.array(opened), pa.array(np.where(opened, bound[at], gini[at])), table["v"].combine_chunks().take(take),
            pa.array(number[at]), pa.array(list(left[at]), pa.list_(pa.int64())), pa.array(list(right[at]), pa.list_(pa.int64())),
        ], ["tree", "node", "a", "open", "gini", "split", "bin", "lh", "rh"])


def find_splits(
    rows: DataFrame, classes: int = CLASSES, scan_rows: int | None = None, bits: int | None = None, scratch: Scratch | None = None,
) -> DataFrame:
    """``(tree, node, gini, a, split, lh, rh)``: per node the split with the least impurity; ties: lowest attribute, then value.

    ``rows`` carry ``codes`` and a node.
    A step moves at most ``2**digit`` rows per (node, attribute, leading digits), and no task sees more of a group.
    """
    scratch = scratch or Scratch(rows.sparkSession, "splits")
    if bits is None:
        bits = rows.agg(F.max("bits")).first()[0] or digit_bits(scan_rows)
    digit = digit_bits(scan_rows)
    cells = _cells(rows)
    counts = [*_class_counts(classes), F.min("code").alias("low"), F.max("code").alias("high"), F.min("v").alias("v")]
    opened, best = None, None
    for shift in range(bits - digit, -1, -digit):
        at = f"shiftright(code, {shift})"
        level = cells
        if opened is not None:
            level = cells.selectExpr("*", f"shiftright(code, {shift + digit}) AS parent").join(
                opened.select(*NODE_KEY, "a", F.col("bin").alias("parent")), [*NODE_KEY, "a", "parent"], "left_semi"
            )
        bins = level.groupBy(*NODE_KEY, "a", F.expr(at).alias("bin")).agg(*counts)
        bins = bins.select(*NODE_KEY, "a", "bin", "low", "high", "v", F.array(*_class_names(classes)).alias("counts"))
        if opened is not None:
            parents = opened.select(*NODE_KEY, "a", F.col("bin").alias("parent"), F.col("lh").alias("before"), F.col("rh").alias("after"))
            bins = bins.withColumn("parent", F.shiftright("bin", digit)).join(parents, [*NODE_KEY, "a", "parent"])
        dealt = bins.drop("parent").repartition(*NODE_KEY, "a")
        found = dealt.sortWithinPartitions(*NODE_KEY, "a", "bin").mapInArrow(lambda b: _scan_bins(b, digit), _FOUND)
        found = scratch.table(found, "bins") if shift else found  # read twice if a step follows
        candidates = found.filter("NOT open").select(*NODE_KEY, "gini", "a", "split", "lh", "rh")
        best = _least(candidates if best is None else candidates.unionByName(best))
        if not shift:
            break
        least = best.select(*NODE_KEY, F.col("gini").alias("least"))
        worth = F.coalesce(F.col("gini") <= F.col("least") * (1 + TIE), F.lit(True))
        opened = scratch.table(found.filter("open").join(least, NODE_KEY, "left").filter(worth).drop("least"), "open")
        if opened.isEmpty():
            break
    return best


def _least(candidates: DataFrame) -> DataFrame:
    """Per node the candidate with the least impurity; ties: lowest attribute, then value."""
    best = F.expr("min(struct(gini, a, split, lh, rh)) AS best")
    return candidates.groupBy(*NODE_KEY).agg(best).select(*NODE_KEY, "best.*")


def _present(value: str) -> str:
    """SQL: null in place of NaN."""
    return f"nullif({value}, CAST('NaN' AS DOUBLE))"


def _goes_right(a: str, split: str) -> str:
    """SQL: right if the value reaches the split; missing values go left."""
    return f"coalesce({_present(f'get(features, {a})')} >= {split}, false)"


def at_root(rows: DataFrame) -> DataFrame:
    """Put every row at the root, with all attributes free."""
    return rows.withColumn("node", _per_row(ROOT)).withColumn("used", F.array().cast("array<int>"))


def branch(rows: DataFrame, splits: DataFrame) -> DataFrame:
    """Move every row to a child: right if its value reaches the split, else left (missing values too).

    Rows of nodes without a split drop out, and rows of children that stop if ``splits``
    says so (``l_stop``, ``r_stop``). ``splits`` is a small table with known size.
    """
    kept = [c for c in rows.columns if c not in ("node", "used")]
    taken = "used_next" if "used_next" in splits.columns else "array_append(used, a)"
    stops = "if(is_left, l_stop, r_stop)" if "l_stop" in splits.columns else "false"
    return (
        rows.join(splits, NODE_KEY)
        .selectExpr("*", f"NOT {_goes_right('a', 'split')} AS is_left")
        .filter(f"NOT {stops}")
        .selectExpr(*kept, "concat(node, if(is_left, 'L', 'R')) AS node", f"{taken} AS used")
    )


# -------------------------------------------------------------------------------- fit


def root_nodes(rows: DataFrame, classes: int = CLASSES, reduce: bool = True) -> tuple[DataFrame, int]:
    """Root of every tree, and the number of attributes.

    With ``reduce`` the columns without a positive value count as used from the start.
    A label outside ``0 .. classes - 1`` is an error: no row is left out without a word.
    """
    stray = rows.filter(f"label IS NULL OR label < 0 OR label >= {classes}").limit(1).count()
    if stray:
        raise ValueError(f"labels must lie in 0 .. {classes - 1}; pass a larger number of classes")
    counts = rows.groupBy("tree").agg(*_class_counts(classes), F.max(F.size("features")).alias("width"))
    roots = counts.select(
        "tree", F.lit(ROOT).alias("node"), F.lit(0).alias("depth"),
        F.array(*_class_names(classes)).alias("hist"), "width",
    )
    none = F.array().cast("array<int>")
    if reduce:
        dropped = (
            _column_maxima(rows).filter("top IS NULL OR top <= 0")
            .groupBy("tree").agg(F.sort_array(F.collect_list("a")).alias("used"))
        )
        roots = roots.join(dropped, "tree", "left").withColumn("used", F.coalesce("used", none))
    else:
        roots = roots.withColumn("used", none)
    roots = materialize(roots, "roots")
    width = roots.agg(F.max("width")).first()[0] or 0
    return roots.drop("width"), width


_SPLIT_SCHEMA = """
tree int, node string, depth int, n bigint, hist array<bigint>, a int, split double, gini double,
lh array<bigint>, rh array<bigint>, l_stop boolean, r_stop boolean
"""
_SPLIT_NAMES = ["tree", "node", "depth", "n", "hist", "a", "split", "gini", "lh", "rh", "l_stop", "r_stop"]
MODEL_SCHEMA = """
tree int, node string, depth int, is_leaf boolean, a int, split double, gini double, label int, n bigint,
hist array<bigint>
"""


def _children(splits: DataFrame) -> DataFrame:
    child = "struct(concat(node, '{0}') AS node, depth + 1 AS depth, {1} AS hist, {2} AS stop)"
    both = f"inline(array({child.format('L', 'lh', 'l_stop')}, {child.format('R', 'rh', 'r_stop')}))"
    return splits.selectExpr("tree", both)


def _feature_matrix(features: pa.Array, width: int) -> np.ndarray:
    """Feature rows as a matrix of at least ``width`` columns; what a row lacks is NaN."""
    values = features.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = pc.fill_null(pc.list_value_length(features), 0).to_numpy()
    if (sizes == sizes.max(initial=0)).all() and sizes.max(initial=0) >= width:
        return values.reshape(len(features), -1) if len(features) and sizes[0] else np.zeros((len(features), 0))
    out = np.full((len(features), max(width, int(sizes.max(initial=0)))), np.nan)
    row = np.repeat(np.arange(len(features)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def _descend(attribute: np.ndarray, split: np.ndarray, left: np.ndarray, right: np.ndarray, x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The node without an attribute (-1) that each row of ``x`` reaches from node ``at`` (-1 stays)."""
    at = at.copy()
    moving = np.flatnonzero((at >= 0) & (attribute[at] >= 0))
    while len(moving):
        node = at[moving]
        goes_right = x[moving, attribute[node]] >= split[node]  # missing values (NaN) go left
        at[moving] = np.where(goes_right, right[node], left[node])
        moving = moving[attribute[at[moving]] >= 0]
    return at


def _gathered(batches, rows: int, names: tuple[str, ...], key: str | None = None):
    """Tables of at least ``rows`` rows; with ``key`` rows of equal, adjacent keys stay together."""
    held, n = [], 0
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            held.append(batch.select(names))
            n += len(batch)
            if n < rows:
                continue
        if not n:
            continue
        table, held, n = pa.Table.from_batches(held).combine_chunks(), [], 0
        if batch is not None and key:  # the last key may go on in the next batch
            keys = table[key].to_numpy()
            end = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[0] != keys[-1] else 0
            held, n = table.slice(end).to_batches(), len(table) - end
            table = table.slice(0, end).combine_chunks()
        if len(table):
            yield table


def _cells_of(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Matrix of values, number of cells of every row, labels, multiplicities."""
    features = table["features"].combine_chunks()
    sizes = pc.fill_null(pc.list_value_length(features), 0).to_numpy()
    return _feature_matrix(features, width), sizes, table["label"].to_numpy().astype(np.int64), table["m"].to_numpy().astype(np.int64)


def _gini_before(
    no: np.ndarray, first: np.ndarray, key: np.ndarray, m: np.ndarray, held: np.ndarray, total: np.ndarray, classes: int,
) -> np.ndarray:
    """Impurity of a split before every position of every row of ``key``; infinite if a side is empty.

    A row of ``key`` holds (node * ``classes`` + label) of sorted cells; ``no`` is their node and ``first`` the first position of each
    node, the same in all rows. ``m`` are the multiplicities, ``held`` the (node, class) counts left of the first position,
    ``total`` those of both sides. Counts are whole numbers until the last step, so equal splits are equal in every bit.
    """
    kind = np.uint16 if total.shape[1] <= 1 << 16 else np.int64
    by_class = np.argsort(key.astype(kind), axis=1, kind="stable")
    weight = np.take_along_axis(m, by_class, 1)
    group = np.take_along_axis(key, by_class, 1)
    own = _counted(key, m, total.shape[1])
    offset = np.cumsum(own, axis=1) - own - held
    seen = np.empty_like(m)  # rows of the same class on the left
    np.put_along_axis(seen, by_class, np.cumsum(weight, axis=1) - weight - np.take_along_axis(offset, group, 1), 1)

    def before(x, start):
        sums = np.cumsum(x, axis=1) - x
        return sums + (start - sums[:, first])[:, no]

    per_node = [v.reshape(len(key), -1, classes) for v in (held, total)]
    left = before(m, per_node[0].sum(2))
    square = before(m * (2 * seen + m), (per_node[0] ** 2).sum(2))
    cross = before(m * np.take_along_axis(total, key, 1), (per_node[0] * per_node[1]).sum(2))
    right = per_node[1].sum(2)[:, no] - left
    other_square = (per_node[1] ** 2).sum(2)[:, no] - 2 * cross + square
    size, other = left.astype(float), right.astype(float)
    with np.errstate(divide="ignore", invalid="ignore"):
        gini = ((size - square / size) + (other - other_square / other)) / (size + other)
    return np.where((left > 0) & (right > 0), gini, np.inf)


def _counted(key: np.ndarray, m: np.ndarray, size: int) -> np.ndarray:
    """Sums of ``m`` by ``key`` for every row."""
    at = key + np.arange(len(key))[:, None] * size
    return np.bincount(at.ravel(), weights=m.ravel(), minlength=len(key) * size).astype(np.int64).reshape(len(key), size)


def _first_equal(values: np.ndarray, wanted: np.ndarray, no: np.ndarray, nodes: int) -> np.ndarray:
    """Per node the first position whose value is the wanted one; a node that wants none has no meaning."""
    hit = np.flatnonzero(values == wanted[no])
    out = np.zeros(nodes, np.int64)
    out[no[hit][::-1]] = hit[::-1]
    return out


class _Nodes:
    """Nodes on the way to their rows: tree, path, depth and attributes that are used up."""

    def __init__(self, names: list[tuple[int, str, int]], used: np.ndarray) -> None:
        self.names, self.used = names, used

    def __len__(self) -> int:
        return len(self.names)

    def take(self, which) -> "_Nodes":
        return _Nodes([self.names[i] for i in which], self.used[which])

    def children(self, parents: np.ndarray, sides: np.ndarray, a: np.ndarray) -> "_Nodes":
        names = [(t, node + "LR"[side], depth + 1) for (t, node, depth), side in zip((self.names[p] for p in parents), sides)]
        used = self.used[parents].copy()
        used[np.arange(len(parents)), a[parents]] = True
        return _Nodes(names, used)


def _split_rows(nodes: _Nodes, which, a, split, gini, sides, stop) -> list[tuple]:
    """Rows of ``_SPLIT_SCHEMA``; ``sides`` are class counts (node, side, class), ``stop`` flags (node, side)."""
    hist = sides.sum(1)
    return [
        (*nodes.names[i], int(hist[i].sum()), hist[i].tolist(), int(a[i]), float(split[i]), float(gini[i]),
         *sides[i].tolist(), *stop[i].tolist())
        for i in which
    ]


def _stopped(sides: np.ndarray, nodes: _Nodes, minfreq: int, max_depth: int | None) -> np.ndarray:
    """As ``_stops`` for class counts (node, side, class)."""
    n = sides.sum(2)
    stop = (n < minfreq) | (sides.max(2) == n)
    if max_depth is not None:
        stop |= np.array([depth + 1 >= max_depth for _, _, depth in nodes.names], bool)[:, None]
    return stop


def _grow(
    x: np.ndarray, sizes: np.ndarray, label: np.ndarray, m: np.ndarray, at: np.ndarray, nodes: _Nodes,
    minfreq: int, classes: int, max_depth: int | None,
) -> list[tuple]:
    """All splits below ``nodes``, whose rows are ``x`` (``at``: number of the node)."""
    n, width = x.shape
    values = np.ascontiguousarray(x.T)
    order = np.argsort(values, axis=1, kind="stable")
    ordered = np.take_along_axis(values, order, 1)
    step = np.ones((width, n), np.int32)
    step[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
    rank = np.empty((width, n), np.int32)
    np.put_along_axis(rank, order, np.cumsum(step, axis=1, dtype=np.int32), 1)
    missing = np.isnan(values)
    if missing.any():  # they come first; what a row lacks counts for no side
        rank[missing] = 0
        rank[np.arange(width)[:, None] >= sizes] = -1
        order = np.argsort(rank, axis=1, kind="stable")
    del ordered, step, missing
    found_rows = []
    while len(nodes):
        count = len(nodes)
        code = at.astype(np.uint16 if count <= 1 << 16 else np.int64)
        no = np.sort(at[order[0]])
        first = np.searchsorted(no, np.arange(count))
        best, a, at_rank, split = np.full(count, np.inf), np.zeros(count, np.int64), np.zeros(count, np.int64), np.zeros(count)
        each = max(1, BLOCK_CELLS // order.shape[1])
        for start in range(0, width, each):
            block = slice(start, start + each)
            o = order[block]
            o = np.take_along_axis(o, np.argsort(code[o], axis=1, kind="stable"), 1)
            order[block] = o
            r = np.take_along_axis(rank[block], o, 1)
            weight = np.where(r < 0, 0, m[o])
            key = no * classes + label[o]
            total = _counted(key, weight, count * classes)
            gini = _gini_before(no, first, key, weight, np.zeros_like(total), total, classes)
            gini[:, 1:][r[:, 1:] == r[:, :-1]] = np.inf
            gini[nodes.used[:, block].T[:, no]] = np.inf
            least = np.minimum.reduceat(gini, first, axis=1)
            lowest = np.argmin(least, axis=0)  # the lowest attribute on a tie
            least = least[lowest, np.arange(count)]
            better = np.flatnonzero(least < best)
            place = _first_equal(gini[lowest[no], np.arange(len(no))], least, no, count)
            best[better], a[better] = least[better], start + lowest[better]
            at_rank[better] = r[lowest[better], place[better]]
            split[better] = values[a[better], o[lowest[better], place[better]]]
        found = np.isfinite(best)
        rows = order[0]
        rows = rows[found[at[rows]]]
        i = at[rows]
        r = rank[a[i], rows]
        child = 2 * i + (r >= at_rank[i])
        sides = _counted((child * classes + label[rows])[None], np.where(r < 0, 0, m[rows])[None], 2 * count * classes).reshape(count, 2, classes)
        stop = _stopped(sides, nodes, minfreq, max_depth)
        found_rows += _split_rows(nodes, np.flatnonzero(found), a, split, best, sides, stop)
        kept = np.flatnonzero((~stop & found[:, None]).ravel())
        number = np.full(2 * count, -1)
        number[kept] = np.arange(len(kept))
        at = np.full(n, -1)
        at[rows] = number[child]
        order = order[at[order] >= 0].reshape(width, -1)
        nodes = nodes.children(kept // 2, kept % 2, a)
    return found_rows


def _pack(batches, top: dict, number: np.ndarray, free: np.ndarray, cuts: list[np.ndarray], classes: int):
    """Cells of the nodes of a level, sorted by value, one record per (attribute, range).

    ``number`` has the node's number in the level (-1: none) by its number in ``top``, ``free`` the attributes (node, a) not yet used. Range -2
    holds the class counts of all cells of an attribute, range -1 those of missing values. Multiplicities that are all 1 are left out.
    """
    width = free.shape[1]
    for table in _gathered(batches, max(1, PACK_CELLS // max(1, width)), ("at", "label", "features", "m")):
        x, sizes, label, m = _cells_of(table, width)
        node = number[_descend(**top, x=x, at=table["at"].to_numpy())]
        rows = np.flatnonzero(node >= 0)
        out = []
        for a in range(width):
            mine = rows[(sizes[rows] > a) & free[node[rows], a]]
            v, key, w = x[mine, a], node[mine] * classes + label[mine], m[mine]
            sums = np.bincount(key, weights=w, minlength=len(free) * classes).astype(np.int64)
            some = np.flatnonzero(sums)
            if not len(some):
                continue
            out.append((a, -2, np.zeros(0), some, sums[some]))
            if (missing := np.isnan(v)).any():
                sums = np.bincount(key[missing], weights=w[missing], minlength=len(free) * classes).astype(np.int64)
                some = np.flatnonzero(sums)
                out.append((a, -1, np.zeros(0), some, sums[some]))
                v, key, w = v[~missing], key[~missing], w[~missing]
            order = np.argsort(v)
            v, key, w = v[order], key[order], w[order]
            if np.count_nonzero(v[1:] == v[:-1]) * 2 > len(v):  # frequent values are counted here
                order = np.lexsort((key, v))
                v, key, w = v[order], key[order], w[order]
                begin = np.flatnonzero(np.append(True, (v[1:] != v[:-1]) | (key[1:] != key[:-1])))
                v, key, w = v[begin], key[begin], np.add.reduceat(w, begin)
            ends = [0, *np.searchsorted(v, cuts[a]), len(v)]
            out += [(a, part, v[s:e], key[s:e], w[s:e]) for part, (s, e) in enumerate(zip(ends, ends[1:])) if s < e]
        if out:
            a, part, v, key, w = zip(*out)
            yield pa.RecordBatch.from_arrays([
                pa.array(a, pa.int32()), pa.array(part, pa.int32()), *(
                    pa.array([cells.astype(kind).tobytes() for cells in column], pa.binary())
                    for column, kind in ((v, np.float64), (key, np.int32), ([x[:0] if (x == 1).all() else x for x in w], np.int64))
                )
            ], ["a", "part", "v", "key", "m"])


_BEST = "node int, gini double, a int, split double, lh array<bigint>, rh array<bigint>"


class _Scan:
    """The best split of every node by one attribute, from its ranges in order."""

    def __init__(self, nodes: int, classes: int) -> None:
        self.classes = classes
        self.total, self.held = np.zeros(nodes * classes, np.int64), np.zeros(nodes * classes, np.int64)
        self.gini, self.split = np.full(nodes, np.inf), np.zeros(nodes)
        self.left = np.zeros((nodes, classes), np.int64)

    def add(self, part: int, v: np.ndarray, key: np.ndarray, m: np.ndarray) -> None:
        if part < 0:
            np.add.at(self.total if part == -2 else self.held, key, m)
            return
        classes, node = self.classes, key // self.classes
        order = np.argsort(v, kind="stable")
        order = order[np.argsort(node[order].astype(np.uint16 if len(self.gini) <= 1 << 16 else np.int64), kind="stable")]
        v, key, m, node = v[order], key[order], m[order], node[order]
        fresh = np.append(True, node[1:] != node[:-1])
        first, no = np.flatnonzero(fresh), np.cumsum(fresh) - 1
        here = node[first]  # nodes that have values in this range
        short = (no * classes + key % classes)[None]
        held, total = (x.reshape(-1, classes)[here].reshape(1, -1) for x in (self.held, self.total))
        gini = _gini_before(no, first, short, m[None], held, total, classes)[0]
        gini[1:][~fresh[1:] & (v[1:] == v[:-1])] = np.inf
        least = np.minimum.reduceat(gini, first)
        better = least < self.gini[here]  # the lowest value on a tie
        place = _first_equal(gini, least, no, len(here))
        self.gini[here[better]], self.split[here[better]] = least[better], v[place[better]]
        before = np.arange(len(no)) < place[no]
        left = held + _counted(short, np.where(before, m, 0)[None], held.shape[1])
        self.left[here[better]] = left.reshape(-1, classes)[better]
        self.held += np.bincount(key, weights=m, minlength=len(self.held)).astype(np.int64)

    def found(self, a: int) -> pa.RecordBatch:
        at = np.flatnonzero(np.isfinite(self.gini))
        right = self.total.reshape(-1, self.classes) - self.left
        return pa.RecordBatch.from_arrays([
            pa.array(at, pa.int32()), pa.array(self.gini[at]), pa.array(np.full(len(at), a), pa.int32()), pa.array(self.split[at]),
            *(pa.array(list(side[at]), pa.list_(pa.int64())) for side in (self.left, right)),
        ], ["node", "gini", "a", "split", "lh", "rh"])


def _scan_ranges(batches, nodes: int, classes: int):
    """Best split per (node, attribute) from records of ``_pack``, sorted by attribute and range."""
    records = (record for batch in batches for record in zip(batch["a"].to_pylist(), batch["part"].to_pylist(), batch["v"], batch["key"], batch["m"]))
    for a, ranges in itertools.groupby(records, key=lambda record: record[0]):
        scan = _Scan(nodes, classes)
        for part, some in itertools.groupby(ranges, key=lambda record: record[1]):
            cells = [[np.frombuffer(cell.as_buffer(), kind) for cell, kind in zip(r[2:], (np.float64, np.int32, np.int64))] for r in some]
            v, key, m = (np.concatenate(c) for c in zip(*((v, key, m if len(m) else np.ones(len(key), np.int64)) for v, key, m in cells)))
            scan.add(part, v, key.astype(np.int64), m)
        yield scan.found(a)


class _Top:
    """The nodes of more than ``SUBTREE_ROWS`` rows and their children, on the driver: a few numbers per node.

    There are at most as many per level as the rows hold ``SUBTREE_ROWS``.
    """

    def __init__(self) -> None:
        self.attribute, self.split, self.left, self.right = [], [], [], []

    def add(self) -> int:
        for values, x in ((self.attribute, -1), (self.split, 0.0), (self.left, -1), (self.right, -1)):
            values.append(x)
        return len(self.attribute) - 1

    def arrays(self) -> dict:
        return {
            "attribute": np.array(self.attribute, np.int64), "split": np.array(self.split),
            "left": np.array(self.left, np.int64), "right": np.array(self.right, np.int64),
        }


def _level_splits(rows: DataFrame, top: _Top, at: list[int], nodes: _Nodes, cuts: list[np.ndarray], classes: int) -> list:
    """The best split of each of ``nodes`` that has one; ``at`` are their numbers in ``top``. One job."""
    arrays, count = top.arrays(), len(nodes)
    number = np.full(len(arrays["split"]) + 1, -1)  # the last one is of rows that have no node
    number[at] = np.arange(count)
    free = ~nodes.used
    packed = rows.mapInArrow(
        lambda b: _pack(b, arrays, number, free, cuts, classes), "a int, part int, v binary, key binary, m binary"
    )
    dealt = packed.repartition(max(1, free.shape[1]), "a").sortWithinPartitions("a", "part")
    found = dealt.mapInArrow(lambda b: _scan_ranges(b, count, classes), _BEST)
    return found.groupBy("node").agg(F.expr("min(struct(gini, a, split, lh, rh)) AS best")).select("node", "best.*").collect()


def _moved(rows: DataFrame, top: _Top, kept: list[int]) -> DataFrame:
    """Rows that reach the nodes ``kept`` of ``top``, which become their ``at``."""
    arrays = top.arrays()
    stays = np.zeros(len(arrays["split"]) + 1, bool)  # the last one is of rows that have no node
    stays[kept] = True
    width = int(arrays["attribute"].max(initial=-1)) + 1

    def run(batches):
        for batch in batches:
            at = _descend(**arrays, x=_feature_matrix(batch["features"], width), at=batch["at"].to_numpy())
            on = pa.array(np.flatnonzero(stays[at]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(at).take(on), *(batch[c].take(on) for c in ("label", "features", "m"))], ["at", "label", "features", "m"]
            )

    return rows.mapInArrow(run, "at bigint, label int, features array<double>, m bigint")


def _cut_points(rows: DataFrame, width: int, parts: int) -> list[np.ndarray]:
    """Per attribute the values that divide it into about even ranges; any would give the same trees."""
    if parts < 2:
        return [np.zeros(0)] * width
    cells = rows.select(F.posexplode("features").alias("a", "v")).selectExpr("a", f"{_present('v')} AS v").filter("v IS NOT NULL")
    shares = [i / parts for i in range(1, parts)]
    cuts = {r["a"]: np.unique(r["cuts"]) for r in cells.groupBy("a").agg(F.percentile_approx("v", shares, 10_000).alias("cuts")).collect()}
    return [cuts.get(a, np.zeros(0)) for a in range(width)]


def fit(
    rows: DataFrame, minfreq: int = MIN_FREQ, classes: int = CLASSES, max_depth: int | None = None,
    reduce: bool = True, scan_rows: int | None = None,
) -> DataFrame:
    """Grow all trees of ``rows`` together; returns the model.

    Each attribute is used at most once per path. A node whose remaining attributes are
    all constant becomes a leaf. Nodes of more than ``scan_rows`` rows (``SUBTREE_ROWS``) are split level by level, one job per
    level, in ranges of about ``scan_rows`` (``RANGE_ROWS``) values; the others are grown to their end, each by one task.
    """
    spark = rows.sparkSession
    roots, width = root_nodes(rows, classes, reduce)
    scratch = Scratch(spark, "tree")
    active = node_status(roots, minfreq, width, max_depth).filter("NOT stop AND tree IS NOT NULL").collect()  # one row per tree
    used = np.zeros((len(active), width), bool)
    for i, r in enumerate(active):
        used[i, r["used"]] = True
    top, most = _Top(), scan_rows or SUBTREE_ROWS
    nodes, weights = _Nodes([(r["tree"], ROOT, 0) for r in active], used), [r["n"] for r in active]
    at = [top.add() for _ in active]
    total = sum(weights)
    cores = spark.sparkContext.defaultParallelism
    starts = spark.createDataFrame(list(zip([r["tree"] for r in active], at)), "tree int, at bigint")
    # Each task holds a share of the rows for all levels; no order is needed.
    dealt = rows.withColumn("label", F.col("label").cast("int")).join(F.broadcast(starts), "tree").select("at", "label", "features", "m")
    base = scratch.table(dealt.repartition(cores * max(1, -(-total // RANGE_ROWS // cores))), "rows")
    cuts = _cut_points(base, width, -(-total // (scan_rows or RANGE_ROWS))) if any(w > most for w in weights) else []
    splits, small, small_nodes, moved = [], [], {}, total  # small: rows that were moved out of base

    def sorted_out(at, nodes, weights):
        """The nodes that go on level by level; the others are kept for the end."""
        small_nodes.update({at[i]: nodes.take([i]) for i, w in enumerate(weights) if w <= most})
        large = [i for i, w in enumerate(weights) if w > most]
        return [at[i] for i in large], nodes.take(large), [weights[i] for i in large]

    at, nodes, weights = sorted_out(at, nodes, weights)
    while len(nodes):
        found = sorted(_level_splits(base, top, at, nodes, cuts, classes), key=lambda r: r["node"])
        which = np.array([r["node"] for r in found], np.int64)
        if not len(which):
            at, nodes, weights = [], nodes.take([]), []
            break
        some = nodes.take(which)
        a, split, gini = (np.array([r[c] for r in found]) for c in ("a", "split", "gini"))
        sides = np.array([[r["lh"], r["rh"]] for r in found], np.int64).reshape(len(found), 2, classes)
        stop = _stopped(sides, some, minfreq, max_depth)
        splits += _split_rows(some, range(len(some)), a, split, gini, sides, stop)
        new_at, parents, turns, new_weights = [], [], [], []
        for i, node in enumerate(which):
            here, right = at[node], int(sides[i, 1].sum())
            top.attribute[here], top.split[here] = int(a[i]), float(split[i])
            top.left[here], top.right[here] = top.add(), top.add()
            for side, to, weight in ((0, top.left[here], weights[node] - right), (1, top.right[here], right)):
                if not stop[i, side]:
                    new_at, parents, turns, new_weights = [*new_at, to], [*parents, i], [*turns, side], [*new_weights, weight]
        children = some.children(np.array(parents, np.int64), np.array(turns, np.int64), a)
        at, nodes, weights = sorted_out(new_at, children, new_weights)
        if sum(weights) * 2 < moved and len(nodes):  # rows of the other nodes need not be read again
            small.append(scratch.table(_moved(base, top, list(small_nodes)), "small"))
            base, old, moved = scratch.table(_moved(base, top, at), "rows"), base, sum(weights)
            scratch.drop(old)
    if small_nodes:
        rest = _moved(base, top, list(small_nodes))  # rows that were not moved out before
        for part in small:
            rest = rest.unionByName(part)
        parts = max(cores, 2 * total // SUBTREE_ROWS)
        below = scratch.table(_subtrees(rest, small_nodes, parts, width, minfreq, classes, max_depth, most), "splits")
        found = below.unionByName(spark.createDataFrame(splits, _SPLIT_SCHEMA)) if splits else below
    else:
        found = spark.createDataFrame(splits, _SPLIT_SCHEMA)
    return _model(roots, found)


def _subtrees(
    rows: DataFrame, nodes: dict[int, _Nodes], parts: int, width: int, minfreq: int, classes: int, max_depth: int | None, most: int,
) -> DataFrame:
    """Splits (``_SPLIT_SCHEMA``) below ``nodes``, whose rows carry the number ``at``."""
    shared = rows.sparkSession.sparkContext.broadcast(nodes)

    def run(batches):
        for table in _gathered(batches, most, ("at", "label", "features", "m"), "at"):
            x, sizes, label, m = _cells_of(table, width)
            numbers, at = np.unique(table["at"].to_numpy(), return_inverse=True)
            mine = [shared.value[i] for i in numbers.tolist()]
            start = _Nodes([name for n in mine for name in n.names], np.concatenate([n.used for n in mine]))
            found = _grow(x[:, :width], sizes, label, m, at, start, minfreq, classes, max_depth)
            if found:
                columns = [pa.array(c, kind) for c, kind in zip(zip(*found), _SPLIT_TYPES)]
                yield pa.RecordBatch.from_arrays(columns, _SPLIT_NAMES)

    return rows.repartition(max(1, min(len(nodes), parts)), "at").sortWithinPartitions("at").mapInArrow(run, _SPLIT_SCHEMA)


_COUNTS = pa.list_(pa.int64())
_SPLIT_TYPES = [
    pa.int32(), pa.string(), pa.int32(), pa.int64(), _COUNTS, pa.int32(), pa.float64(), pa.float64(), _COUNTS, _COUNTS, pa.bool_(), pa.bool_()
]


def _model(roots: DataFrame, splits: DataFrame) -> DataFrame:
    """All nodes: the splits, and as leaves the roots and children that have no split."""
    leaf = ["tree", "node", "depth", "hist"]
    nodes = roots.select(*leaf).unionByName(_children(splits).select(*leaf))
    leaves = node_status(nodes.join(splits.select(*NODE_KEY), NODE_KEY, "left_anti").selectExpr("*", "array(0) AS used"), 0)
    null = "CAST(NULL AS {}) AS {}"
    model = splits.selectExpr(
        *NODE_KEY, "depth", "false AS is_leaf", "a", "split", "gini", null.format("INT", "label"), "n", "hist"
    ).unionByName(leaves.selectExpr(
        *NODE_KEY, "depth", "true AS is_leaf", null.format("INT", "a"), null.format("DOUBLE", "split"),
        null.format("DOUBLE", "gini"), "label", "n", "hist",
    ))
    path = scratch_path(model.sparkSession, "model")
    write_model(model, path, "depth")
    return model.sparkSession.read.schema(MODEL_SCHEMA).parquet(path)


def write_model(model: DataFrame, path: str, *folders: str) -> None:
    """Write nodes into folders; ranges keep the files of one folder few and even."""
    model.repartitionByRange(*folders, "node").write.partitionBy(*folders).parquet(path)


# ---------------------------------------------------------------------------- predict


class Walk:
    """A model as arrays: per node the attribute (-1: leaf), the split, both children and the label."""

    def __init__(self, nodes: pa.Table) -> None:
        keys = list(zip(nodes["tree"].to_pylist(), nodes["node"].to_pylist()))
        place = {key: i for i, key in enumerate(keys)}
        self.attribute = nodes["a"].fill_null(-1).to_numpy().astype(np.int32)
        self.split = nodes["split"].fill_null(0).to_numpy().astype(np.float64)
        self.label = nodes["label"].fill_null(-1).to_numpy().astype(np.int32)
        left, right = ([place.get((t, n + turn), -1) for t, n in keys] for turn in "LR")
        self.left, self.right = np.array(left, np.int32), np.array(right, np.int32)
        self.roots = {t: place[t, n] for t, n in keys if n == ROOT}

    def labels(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Label of the leaf that each row of ``x`` reaches from node ``at`` (-1: no tree)."""
        at = _descend(self.attribute, self.split, self.left, self.right, x, at)
        return np.where(at >= 0, self.label[at], -1)

    def matrix(self, features: pa.Array) -> np.ndarray:
        """Feature rows as far as the model reads them; what a row lacks is NaN."""
        return _feature_matrix(features, int(self.attribute.max(initial=-1)) + 1)


def compiled(model: DataFrame, most_nodes: int = MOST_NODES) -> Walk | None:
    """The model as arrays, or ``None`` if it has more than ``most_nodes`` nodes."""
    nodes = model.select("tree", "node", "a", "split", "label").limit(most_nodes + 1)
    return None if model.count() > most_nodes else Walk(nodes.toArrow())


def predict(model: DataFrame, rows: DataFrame, most_nodes: int = MOST_NODES) -> DataFrame:
    """``(tree, row_id, label, pred)``: walk every row down its tree.

    ``rows`` holds ``(tree, row_id, label, features)``. The model goes to the tasks as arrays, a few numbers
    per node, and all levels are one projection without a join; a model of more than ``most_nodes`` nodes is
    joined level by level. A row of a tree that the model lacks gets no label.
    """
    walk = compiled(model, most_nodes)
    if walk is None:
        return predict_by_lookup(model, rows)
    shared = rows.sparkSession.sparkContext.broadcast(walk)

    def run(batches):
        walk = shared.value
        for batch in batches:
            start = np.array([walk.roots.get(t, -1) for t in batch["tree"].to_pylist()], np.int64)
            found = walk.labels(walk.matrix(batch["features"]), start)
            yield pa.RecordBatch.from_arrays(
                [batch["tree"], batch["row_id"], batch["label"], pa.array(found, mask=found < 0)], ["tree", "row_id", "label", "pred"]
            )

    return rows.select("tree", "row_id", "label", "features").mapInArrow(run, _walked_schema(rows))


def predict_all(model: DataFrame, rows: DataFrame, trees: int, most_nodes: int = MOST_NODES) -> DataFrame:
    """``(tree, row_id, label, pred)`` of trees ``0 .. trees - 1`` for every row ``(row_id, label, features)``.

    All trees are walked in one projection; the features of a row are not copied per tree.
    """
    walk = compiled(model, most_nodes)
    if walk is None:
        each = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")
        return predict_by_lookup(model, rows.select(each, "row_id", "label", "features"))
    shared = rows.sparkSession.sparkContext.broadcast(walk)

    def run(batches):
        walk = shared.value
        for batch in batches:
            x = walk.matrix(batch["features"])
            for tree in range(trees):
                found = walk.labels(x, np.full(len(x), walk.roots.get(tree, -1)))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(x), tree, np.int32)), batch["row_id"], batch["label"], pa.array(found, mask=found < 0)
                ], ["tree", "row_id", "label", "pred"])

    return rows.select("row_id", "label", "features").mapInArrow(run, _walked_schema(rows))


def _walked_schema(rows: DataFrame) -> str:
    kind = {c: rows.schema[c].dataType.simpleString() for c in ("row_id", "label")}
    return f"tree int, row_id {kind['row_id']}, label {kind['label']}, pred int"


def predict_by_lookup(model: DataFrame, rows: DataFrame) -> DataFrame:
    """As :func:`predict` for models of any size: one lookup per level.

    A step only reads the nodes of one depth (a folder of the model), whose true size decides how Spark joins them.
    """
    deepest = model.agg(F.max("depth")).first()[0] or 0
    walk = rows.select(
        "tree", "row_id", "label", "features", F.lit(ROOT).alias("node"), F.lit(None).cast("int").alias("pred")
    )
    turn = f"CASE WHEN split IS NULL THEN '' WHEN {_goes_right('a', 'split')} THEN 'R' ELSE 'L' END"
    for depth in range(deepest + 1):
        step = model.filter(F.col("depth") == depth).selectExpr(*NODE_KEY, "a", "split", "label AS leaf_label")
        walk = walk.join(step, NODE_KEY, "left").selectExpr(
            "tree", "row_id", "label", "features", f"concat(node, {turn}) AS node", "coalesce(pred, leaf_label) AS pred"
        )
        if depth % 8 == 7 and depth < deepest:
            walk = materialize(walk, "walk")
    return walk.select("tree", "row_id", "label", "pred")
