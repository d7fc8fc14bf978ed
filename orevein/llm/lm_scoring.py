"""Language-model scores by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ``ORDER``. A symbol seen in the longest context gets its
count less one half; the halves are the escape (method D) to the next shorter context, which leaves
out every symbol the longer one could have given; below order 0 the bytes left share the rest
evenly. A shorter context learns a symbol only when it is new to the longer one (update exclusion). The text is its tokens, A-Z lower-cased, joined by one space, and one end symbol.

Scale: documents are dealt into blocks of about ``BLOCK_CHARS`` characters by a hash of their id and sorted by block.
A task streams them and counts their different (context, symbol) pairs in sorted arrays, written out at the end of a block
or as partial counts beyond ``MOST_KEYS``; the trie is a table of counts per order, made by aggregates and joins.
Nothing is broadcast or collected: one sorted stream brings a block the log probabilities of its own pairs only, then
its documents, batch by batch. A task holds one block's pairs and one batch of texts; what is gathered grows with the input.

Defined cases: a null or empty text is the end symbol alone. Repeated rows are learned and scored each. With no
training text all bytes are equally likely and ``base_score`` is that of an empty count table. Empty tables give no rows.
A null id counts as empty text in the checksum and is learned from like any other.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orevein.llm.common import checksum, lower_words
from orevein.plans.tables import table
from orevein.session import Scratch, release_shuffles

ORDER = 5  # bytes of the longest context; 7 at most, as a pair must fit into 64 bits
SYMBOLS = 255  # byte values that a text can hold, the end symbol among them
START, END = b"\xfe", b"\xff"  # bytes that UTF-8 never uses
BLOCK_CHARS = 32_000_000
CHUNK = 1 << 19  # positions that are counted at once
WORD_CHARS = 1 << 22  # characters whose words are held at once
MOST_KEYS = 1 << 21  # different pairs that a block counts before it writes partial counts
WRITTEN = 1 << 17  # rows that are given back at once
TEXT_ROWS = 1024  # rows whose texts are held as Python strings at once
KINDS = 3  # of rows in the stream of a block: pairs, words, documents
LOOKED_UP = 1 << 18  # positions whose probabilities are looked up at once
_END_TOKEN = b"\n"  # no word holds white space


class Trie:
    """Plain trie for one text at a time; ``adaptive`` learns while it reads."""

    def __init__(self, order: int = ORDER) -> None:
        self.order, self.counts = order, [{} for _ in range(order + 1)]

    def learn(self, context: bytes, symbol: int) -> None:
        for size in range(self.order, -1, -1):
            seen = self.counts[size].setdefault(context[len(context) - size:], Counter())
            seen[symbol] += 1
            if seen[symbol] > 1:  # shorter contexts know it already
                break

    def probability(self, context: bytes, symbol: int) -> float:
        share, excluded = 1.0, set()
        for size in range(self.order, -1, -1):
            seen = self.counts[size].get(context[len(context) - size:], {})
            left = {s: n for s, n in seen.items() if s not in excluded}
            total = 2 * sum(left.values())
            if symbol in left:
                return share * (2 * left[symbol] - 1) / total
            if left:
                share *= len(left) / total
            excluded |= set(seen)
        return share / (SYMBOLS - len(excluded))

    def score(self, text: str | None, adaptive: bool = False, learn: bool = False) -> float:
        """log10 probability of a text; ``learn`` adds it to the trie, ``adaptive`` while reading."""
        data = START * self.order + b" ".join(lower_words(text)) + END
        total = 0.0
        for i in range(self.order, len(data)):
            context, symbol = data[i - self.order:i], data[i]
            total += float(np.log10(self.probability(context, symbol)))
            if adaptive or learn:
                self.learn(context, symbol)
        return total


def adaptive_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """``(id, score)``: every text under a trie that starts empty and learns while it reads."""

    @F.pandas_udf("double")
    def one(texts: pd.Series) -> pd.Series:
        return pd.Series([Trie(order).score(t, adaptive=True) for t in texts], dtype=float)

    return docs.select(F.col(id_col).alias("id"), one(F.col(text_col)).alias("score"))


def _symbols(texts: list[str | None], order: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array, each after ``order`` start bytes, and where their first symbols stand."""
    pad, data, starts = START * order, bytearray(), []
    for text in texts:
        data += pad
        starts.append(len(data))
        data += b" ".join(lower_words(text)) + END
    return np.frombuffer(data, np.uint8), np.array(starts, np.int64)


def _pairs(data: np.ndarray, order: int, start: int, stop: int) -> np.ndarray:
    """Codes of (context, symbol) for the positions from ``start`` to ``stop``; the symbol is the low byte."""
    code = np.zeros(stop - start, np.int64)
    for back in range(order, -1, -1):
        code = (code << 8) | data[start - back:stop - back]
    return code


Counts = tuple[np.ndarray, np.ndarray]


def _add_up(counts: list[Counts]) -> Counts:
    """Different keys, sorted, and the sums of their counts."""
    keys = np.concatenate([k for k, _ in counts])
    spot = np.argsort(keys)
    keys, n = keys[spot], np.concatenate([n for _, n in counts])[spot]
    del spot
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)])
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def _count_pairs(texts: list, order: int) -> Counts:
    """Different pairs and their counts; chunks are added up as soon as they outgrow what is known."""
    data, _ = _symbols(texts, order)
    known = np.empty(0, np.int64), np.empty(0, np.int64)
    waiting = []
    for start in range(order, len(data), CHUNK):
        stop = min(start + CHUNK, len(data))
        code = _pairs(data, order, start, stop)
        waiting.append(np.unique(code[data[start:stop] != START[0]], return_counts=True))
        if sum(len(k) for k, _ in waiting) >= len(known[0]) or stop == len(data):
            known, waiting = _add_up([known, *waiting]), []
    return known


def _word_key(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) - (1 << 63)


def _few(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """``rows`` in pieces of at most ``TEXT_ROWS``."""
    for start in range(0, rows.num_rows, TEXT_ROWS):
        yield rows.slice(start, TEXT_ROWS)


def _runs(texts: list) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive texts with about ``WORD_CHARS`` characters, so that few words are held at once."""
    start = chars = 0
    for i, text in enumerate(texts):
        chars += len(text or "")
        if chars >= WORD_CHARS or i == len(texts) - 1:
            yield start, i + 1
            start, chars = i + 1, 0


def _count_words(texts: list) -> Counts:
    """Keys and counts of the different words, an end for every text among them."""
    counts: Counter = Counter({_END_TOKEN: len(texts)})
    for text in texts:
        counts.update(lower_words(text))
    return _add_up([(np.fromiter(map(_word_key, counts), np.int64, len(counts)), np.fromiter(counts.values(), np.int64, len(counts)))])


class _Tally:
    """Counts that grow by sorted parts, added up once the parts outgrow what is known."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.known, self.waiting, self.parts = (np.empty(0, np.int64), np.empty(0, np.int64)), 0, []

    def add(self, part: Counts) -> None:
        self.parts.append(part)
        self.waiting += len(part[0])
        if self.waiting >= max(CHUNK, len(self.known[0])):
            self.total()

    def total(self) -> Counts:
        if self.parts:
            self.known, self.waiting, self.parts = _add_up([self.known, *self.parts]), 0, []
        return self.known


def _parts(batch: pa.RecordBatch, *columns: str) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Runs of rows that agree in ``columns``, which hold small whole numbers or truth values."""
    values = np.stack([batch.column(c).cast(pa.int32()).to_numpy(zero_copy_only=False) for c in columns])
    cuts = [0, *(np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
    for start, stop in zip(cuts, cuts[1:]):
        if stop > start:
            yield tuple(values[:, start].tolist()), batch.slice(start, stop - start)


def _count_blocks(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    """``(block, kind, key, n)`` of rows sorted by block: training counts of its pairs (kind 0) and words (kind 1).

    What only held-out texts hold counts 0; a key may come in several rows, whose counts add up.
    """
    tallies, current = (_Tally(), _Tally()), None

    def written() -> Iterator[pa.RecordBatch]:
        for kind, tally in enumerate(tallies):
            keys, n = tally.total()
            for start in range(0, len(keys), WRITTEN):
                key = keys[start:start + WRITTEN]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), current, np.int32)), pa.array(np.full(len(key), kind, np.int8)),
                     pa.array(key), pa.array(n[start:start + WRITTEN])], ["block", "kind", "key", "n"],
                )
            tally.clear()

    for batch in batches:
        for (block, held_out), rows in _parts(batch, "block", "held_out"):
            if block != current:
                yield from written()
                current = block
            for piece in _few(rows):
                texts = piece.column("text").to_pylist()
                for start, stop in _runs(texts):
                    for tally, (keys, n) in zip(tallies, (_count_pairs(texts[start:stop], order), _count_words(texts[start:stop]))):
                        tally.add((keys, n * 0 if held_out else n))
                    if max(len(tally.known[0]) for tally in tallies) >= MOST_KEYS:
                        yield from written()
    yield from written()


class _Lookup:
    """Values of sorted keys: a table of hashed slots, then a search for keys that share a slot."""

    def __init__(self, held: list[np.ndarray]) -> None:
        """``held`` is keys and values; it is emptied, so that each unsorted array goes as soon as its sorted copy is made."""
        values, keys = held.pop(), held.pop()
        order = np.argsort(keys)
        self.keys = keys[order]
        del keys
        self.values = values[order]
        del values, order
        self.shift = np.uint64(64 - max(10, int(len(self.keys) * 4).bit_length()))
        self.slots = np.zeros(1 << (64 - int(self.shift)), np.int32)
        for start in range(0, len(self.keys), LOOKED_UP):
            stop = min(start + LOOKED_UP, len(self.keys))
            self.slots[self._slot(self.keys[start:stop])] = np.arange(start, stop, dtype=np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        spot = self.slots[self._slot(keys)]
        missed = np.nonzero(self.keys[spot] != keys)[0]
        spot[missed] = np.searchsorted(self.keys, keys[missed])
        return self.values[spot]


def _score_texts(texts: list, look: _Lookup, order: int) -> np.ndarray:
    """log10 probability of every text."""
    data, starts = _symbols(texts, order)
    score = np.zeros(len(texts))
    ends = np.append(starts[1:] - order, len(data))
    # Short chunks: a running sum over each keeps memory at a few arrays of LOOKED_UP positions.
    for start in range(order, len(data), LOOKED_UP):
        stop = min(start + LOOKED_UP, len(data))
        logs = np.zeros(stop - start)
        real = data[start:stop] != START[0]
        logs[real] = look(_pairs(data, order, start, stop)[real])
        sums = np.concatenate([[0.0], np.cumsum(logs)])
        first, last = np.searchsorted(ends, start, "right"), np.searchsorted(starts, stop)
        lo = np.clip(starts[first:last], start, stop) - start
        hi = np.clip(ends[first:last], start, stop) - start
        score[first:last] += sums[hi] - sums[lo]
    return score


def _score_rows(rows: pa.RecordBatch, look: _Lookup, count_of: _Lookup, order: int, total: int, distinct: int) -> Iterator[pa.RecordBatch]:
    bottom = np.log10(0.1) - np.log10(total + 0.1 * (distinct + 1))
    texts = rows.column("text").to_pylist()
    for start, stop in _runs(texts):
        part = texts[start:stop]
        tokens = [[*lower_words(text), _END_TOKEN] for text in part]
        words = set().union(*tokens)
        counts = dict(zip(words, count_of(np.fromiter(map(_word_key, words), np.int64, len(words))).tolist()))
        found = [np.array([counts[t] for t in own]) for own in tokens]
        score = _score_texts(part, look, order)
        yield pa.RecordBatch.from_arrays([
            rows.column("key").slice(start, stop - start),
            rows.column("value").slice(start, stop - start).cast(pa.bool_()),
            pa.array([len(c) for c in found], pa.int64()), pa.array([int((c > 0).sum()) for c in found], pa.int64()),
            pa.array([total] * len(part), pa.int64()),
            pa.array([float(np.log10((c + 0.1) / 0.1).sum() + len(c) * bottom) for c in found], pa.float64()), pa.array(score),
        ], ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def _score_blocks(batches: Iterator[pa.RecordBatch], order: int, total: int, distinct: int) -> Iterator[pa.RecordBatch]:
    """Scores from rows sorted by ``spot``: a block's pairs (kind 0), its words (1), then its documents (2), id as key."""
    current, model, looks = None, ([], []), None
    for batch in batches:
        for (spot,), rows in _parts(batch, "spot"):
            block, kind = divmod(spot, KINDS)
            if block != current:
                current, model, looks = block, ([], []), None
            if kind < 2:
                # Copied, so that the batch they came in can go.
                model[kind].append(tuple(rows.column(c).to_numpy(zero_copy_only=False).copy() for c in ("key", "value")))
                continue
            if looks is None:
                looks = []
                for parts in model:
                    held = [np.concatenate(column) for column in zip(*parts)]
                    parts.clear()  # before the tables are made: the pairs are a task's largest arrays
                    looks.append(_Lookup(held))
            for piece in _few(rows):
                yield from _score_rows(piece, *looks, order, total, distinct)


def _orders(pairs: DataFrame, order: int) -> dict[int, DataFrame]:
    """Training counts ``(ctx, sym, n)`` of every order; shorter contexts count the longer ones that know the symbol."""
    found = {order: pairs.filter("n > 0").select(
        F.shiftright("key", 8).alias("ctx"), F.col("key").bitwiseAND(F.lit(255)).alias("sym"), "n"
    )}
    for size in range(order - 1, -1, -1):
        low = F.col("ctx").bitwiseAND(F.lit((1 << (8 * size)) - 1))
        found[size] = found[size + 1].groupBy(low.alias("ctx"), "sym").agg(F.count("*").alias("n"))
    return found


def _shorter(column: str, size: int) -> Column:
    """The last ``size`` bytes of a context."""
    return F.col(column).bitwiseAND(F.lit((1 << (8 * size)) - 1))


def _after_escape(unseen: DataFrame, counts: dict[int, DataFrame], order: int, scratch: Scratch) -> DataFrame:
    """``(ctx, sym, value)``: log10 probability of a symbol after an escape from its context.

    The next shorter context leaves out the symbols of the longer one, so its totals shrink by their counts. Works
    from order 0 up; only pairs that the training texts don't have are carried.
    """
    needed = {order: unseen}
    for size in range(order - 1, -1, -1):
        needed[size] = needed[size + 1].select(_shorter("ctx", size).alias("ctx"), "sym").distinct()
    stats = {size: df.groupBy("ctx").agg(F.sum("n").alias("t"), F.count("*").alias("d")) for size, df in counts.items()}
    known = counts[0].count()  # a row per symbol
    found = needed[0].withColumn("value", F.lit(-math.log10(SYMBOLS - known) if known < SYMBOLS else 0.0))
    for size in range(1, order + 1):
        low = _shorter("ctx", size - 1).alias("low")
        longer = counts[size].join(needed[size].select("ctx").distinct(), "ctx", "left_semi").select("ctx", low, "sym")
        shorter = counts[size - 1].select(F.col("ctx").alias("low"), "sym", "n")
        cut = longer.join(shorter, ["low", "sym"]).groupBy("ctx").agg(F.sum("n").alias("x"), F.count("*").alias("e"))
        rows = (
            needed[size].select("ctx", low, "sym").join(cut, "ctx", "left")
            .join(stats[size - 1].withColumnRenamed("ctx", "low"), "low", "left").join(shorter, ["low", "sym"], "left")
            .join(found.select(F.col("ctx").alias("low"), "sym", F.col("value").alias("rest")), ["low", "sym"])
        )
        t = F.coalesce("t", F.lit(0)) - F.coalesce("x", F.lit(0))
        d = F.coalesce("d", F.lit(0)) - F.coalesce("e", F.lit(0))
        # A pair that the longer context knows has no use here and may have no counts left: null.
        twice = F.nullif(t * 2, F.lit(0))
        value = F.when(F.col("n").isNotNull(), F.log10((F.col("n") * 2 - 1) / twice)).otherwise(
            F.when(d > 0, F.log10(d / twice)).otherwise(0.0) + F.col("rest")
        )
        found = scratch.table(rows.select("ctx", "sym", value.alias("value")), f"escape{size}")
    return found


def pair_log_probabilities(pairs: DataFrame, scratch: Scratch, order: int = ORDER) -> DataFrame:
    """``(key, value)``: log10 probability of every (context, symbol) pair of ``pairs (key, n)``."""
    counts = {size: scratch.table(df, f"order{size}") for size, df in _orders(pairs, order).items()}
    split = pairs.select("key", F.shiftright("key", 8).alias("ctx"), F.col("key").bitwiseAND(F.lit(255)).alias("sym"), "n")
    escaped = _after_escape(split.filter("n = 0").select("ctx", "sym"), counts, order, scratch)
    stat = counts[order].groupBy("ctx").agg(F.sum("n").alias("t"), F.count("*").alias("d"))
    seen = split.filter("n > 0").join(stat, "ctx").select("key", F.log10((F.col("n") * 2 - 1) / (F.col("t") * 2)).alias("value"))
    escape = F.when(F.col("d").isNotNull(), F.log10(F.col("d") / (F.col("t") * 2))).otherwise(0.0)
    unseen = split.filter("n = 0").join(stat, "ctx", "left").join(escaped, ["ctx", "sym"]).select(
        "key", (escape + F.col("value")).alias("value")
    )
    values = scratch.table(seen.union(unseen), "values")
    scratch.drop(*counts.values())
    return values


def score(
    docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER
) -> DataFrame:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score, score)``, a row per document."""
    scratch = Scratch(docs.sparkSession, "ppm")
    docs = docs.select(F.col(id_col).cast("bigint").alias("id"), held_out.alias("held_out"), F.col(text_col).alias("text"))
    size = docs.agg(F.sum(F.coalesce(F.char_length("text"), F.lit(0)) + 1).alias("chars"), F.count("*").alias("n")).first()
    cores = docs.sparkSession.sparkContext.defaultParallelism
    blocks = max(-(-(size["chars"] or 0) // BLOCK_CHARS), min(cores, size["n"]), 1)
    # The text joins the hash so that rows with one id, or none, spread.
    block = F.pmod(F.xxhash64("id", F.substring("text", 1, 64)), F.lit(blocks)).cast("int")
    docs = docs.withColumn("block", block)
    dealt = docs.repartition("block").sortWithinPartitions("block", "held_out")
    seen = scratch.table(
        dealt.mapInArrow(lambda rows: _count_blocks(rows, order), "block int, kind byte, key bigint, n bigint"), "seen"
    )
    release_shuffles(docs.sparkSession)
    keys = scratch.table(seen.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    totals = keys.filter("kind = 1").agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("v")).first()
    total, distinct = totals["n"] or 0, totals["v"] or 0
    values = pair_log_probabilities(keys.filter("kind = 0").select("key", "n"), scratch, order)
    parts = values.select(F.lit(0).cast("byte").alias("kind"), "key", "value").union(
        keys.filter("kind = 1").select("kind", "key", F.col("n").cast("double"))
    )
    release_shuffles(docs.sparkSession)
    # Few columns and one whole number to sort by, as there are many small rows.
    spot = F.col("block") * KINDS + F.col("kind")
    model = seen.join(parts, ["kind", "key"]).select("block", spot.alias("spot"), "key", "value", F.lit(None).cast("string").alias("text"))
    stream = model.union(docs.select(
        "block", (F.col("block") * KINDS + KINDS - 1).alias("spot"), F.col("id").alias("key"), F.col("held_out").cast("double").alias("value"), "text"
    ))
    stream = stream.repartition("block").sortWithinPartitions("spot").drop("block")
    shape = "id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return stream.mapInArrow(lambda rows: _score_blocks(rows, order, total, distinct), shape)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, checksum(F.col("doc_id")) % 10 == 0).withColumnRenamed("id", "doc_id")


QUERIES = {"op2_lm_scoring": op2_lm_scoring}
ORACLES: dict[str, str] = {}
