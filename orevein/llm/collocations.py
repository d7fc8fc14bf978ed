"""Phrase collocations from sorted count streams.

Counting. Texts are read in blocks of at most ``BLOCK`` bytes, cut between pieces. A block is sorted and its equal
phrases are added up, so a task sends one row per different phrase of a block; Spark adds the rows up by phrase.
Only phrases with ``least`` occurrences are kept. No phrase can occur more often than its parts, so pairs are
counted where both words are frequent, and longer phrases where all their pairs are. Tasks test that
against a bitmap of ``BITS`` bits, whatever the size of the input: it may let through a phrase that is not
frequent (which the exact count drops), never the other way round.

Estimation. The frequent phrases are kept as a stream in prefix order (words from the first) and one in suffix order
(words from the last), each cut into sorted runs. All parts of a frequent phrase are frequent, so in prefix order
the last row with k words is the k-word beginning of every longer row after it: one walk along a run gives
the counts of all beginnings, and of the most frequent phrase one word longer. The suffix order gives ends and
phrases one word longer on the left. What a run needs from the runs before it are at most ``longest - 1``
beginnings of its first row. Both streams are merge-joined by phrase; no hash table of phrases is built for it.

Defined cases: null and empty texts hold no words; a null language is ``und``; repeated rows count as often as
they occur; a phrase never crosses a piece. A language without candidates has no rows, as has an empty table. Ids and
other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from orevein.llm.common import shuffle_partitions
from orevein.plans.tables import table
from orevein.session import Scratch

BLOCK = 2 << 20  # bytes of text that a task holds as words at once
BITS = 1 << 27  # size of the bitmap of frequent phrases: 16 MB
RUN = 500_000  # phrases of a sorted run, about
SALTS = 64  # parts of a language in which the best phrases are picked before all of them are ranked
LONGEST = 4  # words of the longest phrase
# Bytes that end a piece, white space, and A-Z to lower case.
_PLAIN = bytes.maketrans(b".,;:!?\x0b\x0c\r\t" + bytes(range(65, 91)), b"\n" * 9 + b" " + bytes(range(97, 123)))
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))  # odd multipliers

_COUNTS = "lang string, words int, phrase binary, f bigint"


class Words:
    """The words of a block of one language as numbers, with the piece each lies in."""

    def __init__(self, data: bytes) -> None:
        raw = np.frombuffer(data, np.uint8)
        end = raw == 10
        inside = ~(end | (raw == 32))
        edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
        start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.piece = np.cumsum(end, dtype=np.int32)[start] if len(start) else np.zeros(0, np.int32)
        offsets = np.concatenate([[0], np.cumsum(stop - start)]).astype(np.int32)
        spelt = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside])])
        coded = spelt.dictionary_encode()
        self.ids = coded.indices.to_numpy().astype(np.int64)
        self.spelling = coded.dictionary

    def together(self, n: int) -> np.ndarray:
        """Positions where ``n`` words lie in one piece."""
        last = max(len(self.ids) - n + 1, 0)
        return np.flatnonzero(self.piece[:last] == self.piece[n - 1:]) if last else np.zeros(0, np.int64)

    def phrases(self, columns: list[np.ndarray]) -> pa.Array:
        return pc.binary_join_element_wise(*[self.spelling.take(pa.array(c)) for c in columns], pa.scalar(b" "))

    def hashes(self) -> np.ndarray:
        return pd.util.hash_array(self.spelling.to_numpy(zero_copy_only=False).astype(object), categorize=False)


def _slots(lang: str, words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of the bitmap for every phrase, from the hashes of its words."""
    value = np.full(len(words[0]), pd.util.hash_array(np.array([lang], dtype=object))[0], np.uint64)
    for word in words:
        value = (value ^ word) * _MIX[0]
        value ^= value >> np.uint64(29)
    second = value * _MIX[1]
    return (value >> np.uint64(37)).astype(np.int64) % BITS, (second >> np.uint64(37)).astype(np.int64) % BITS


def _frequent_bits(phrases: DataFrame) -> np.ndarray:
    """Bitmap of the phrases ``(lang, phrase)``: bytes are merged by position, so at most its size reaches the driver."""
    def run(batches):
        for batch in batches:
            cells = np.zeros(0, np.int64)
            for lang, rows in _by_language(batch.column(0)):
                found = batch.column(1).take(rows).to_pylist()
                words = pd.DataFrame([p.split(b" ") for p in found])
                hashed = [pd.util.hash_array(words[c].to_numpy(dtype=object), categorize=False) for c in words]
                cells = np.concatenate([cells, *_slots(lang, hashed)])
            cell, which = np.unique(cells >> 5, return_inverse=True)
            bits = np.zeros(len(cell), np.int64)
            np.bitwise_or.at(bits, which, np.int64(1) << (cells & 31))
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(bits)], ["cell", "bits"])

    merged = phrases.select("lang", "phrase").mapInArrow(run, "cell bigint, bits bigint").groupBy("cell").agg(F.bit_or("bits").alias("bits"))
    out = np.zeros(BITS // 32, np.uint32)
    got = merged.toArrow()
    out[got["cell"].to_numpy()] = got["bits"].to_numpy().astype(np.uint32)
    return out


def _by_language(column: pa.Array):
    coded = column.dictionary_encode()
    codes = coded.indices.to_numpy()
    order = np.argsort(codes, kind="stable")
    for lang, rows in zip(coded.dictionary.to_pylist(), np.split(order, np.cumsum(np.bincount(codes, minlength=len(coded.dictionary)))[:-1])):
        yield lang, pa.array(rows)


def _blocks(batches):
    """``(lang, bytes)``: texts of one language in plain form, in blocks cut where a piece ends."""
    held, size = {}, 0
    for batch in batches:
        for lang, rows in _by_language(batch.column(0)):
            for row in rows.to_pylist():
                text = batch.column(1)[row].as_buffer()
                if text is None or not text.size:
                    continue
                plain = text.to_pybytes().translate(_PLAIN)
                while len(plain) > BLOCK:
                    cut = plain.rfind(b"\n", 0, BLOCK)
                    cut = cut if cut >= 0 else plain.find(b"\n", BLOCK)
                    if cut < 0:
                        break
                    yield lang, plain[:cut]
                    plain = plain[cut + 1:]
                held.setdefault(lang, []).append(plain)
                size += len(plain) + 1
                if size > BLOCK:
                    for name, texts in held.items():
                        yield name, b"\n".join(texts)
                    held, size = {}, 0
    for name, texts in held.items():
        yield name, b"\n".join(texts)


def _counted(lang: str, words: Words, ids: list[np.ndarray], keys: np.ndarray) -> pa.RecordBatch:
    """One row per different phrase; ``ids`` are the words of every occurrence, ``keys`` tell phrases apart."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    count = np.diff(np.append(first, len(keys)))
    columns = [c[order[first]] for c in ids]
    return pa.RecordBatch.from_arrays([
        pa.array([lang] * len(first), pa.string()), pa.array(np.full(len(first), len(ids), np.int32)),
        words.phrases(columns) if len(first) else pa.array([], pa.binary()), pa.array(count.astype(np.int64)),
    ], ["lang", "words", "phrase", "f"])


def _single(batches):
    """Counts of words, and for every block the number of all words as a phrase of no words."""
    for lang, data in _blocks(batches):
        words = Words(data)
        if len(words.ids):
            count = np.bincount(words.ids)
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * (len(count) + 1), pa.string()), pa.array(np.append(np.ones(len(count), np.int32), np.int32(0))),
                pa.concat_arrays([words.spelling, pa.array([b""], pa.binary())]), pa.array(np.append(count, count.sum()).astype(np.int64)),
            ], ["lang", "words", "phrase", "f"])


def _has(bits: np.ndarray, lang: str, hashed: list[np.ndarray]) -> np.ndarray:
    one, two = _slots(lang, hashed)
    return (((bits[one >> 5] >> (one & 31).astype(np.uint32)) & (bits[two >> 5] >> (two & 31).astype(np.uint32))) & 1).astype(bool)


def _pairs(batches, bits: np.ndarray):
    """Counts of pairs of words that may both be frequent."""
    for lang, data in _blocks(batches):
        words = Words(data)
        if not len(words.ids):
            continue
        good = _has(bits, lang, [words.hashes()])[words.ids]
        at = words.together(2)
        at = at[good[at] & good[at + 1]]
        ids = [words.ids[at], words.ids[at + 1]]
        yield _counted(lang, words, ids, ids[0] * len(words.spelling) + ids[1])


def _longer(batches, bits: np.ndarray):
    """Counts of phrases of three and more words all of whose pairs may be frequent."""
    for lang, data in _blocks(batches):
        words = Words(data)
        if not len(words.ids):
            continue
        at = words.together(2)
        pair = words.ids[at] * len(words.spelling) + words.ids[at + 1]
        different, which = np.unique(pair, return_inverse=True)
        hashes = words.hashes()
        good = _has(bits, lang, [hashes[different // len(words.spelling)], hashes[different % len(words.spelling)]])
        begins = np.full(len(words.ids) + LONGEST, -1, np.int64)  # number of the frequent pair that begins here
        begins[at[good[which]]] = which[good[which]]
        key = begins[:len(words.ids)].copy()
        for n in range(3, LONGEST + 1):
            at = np.flatnonzero((key >= 0) & (begins[n - 2:n - 2 + len(words.ids)] >= 0))
            ids = [words.ids[at + i] for i in range(n)]
            grown = key[at] * len(words.spelling) + ids[-1]
            yield _counted(lang, words, ids, grown)
            # Phrases of this length become dense numbers, so that keys stay inside a long.
            key = np.full(len(words.ids), -1, np.int64)
            key[at] = np.unique(grown, return_inverse=True)[1]


def frequent_phrases(texts: DataFrame, least: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``(lang, words, phrase, f)`` of all phrases with ``least`` occurrences, and ``(lang, n)``.

    ``texts`` holds ``(lang, text)``, the text as binary.
    """
    context = texts.sparkSession.sparkContext

    def level(run, name: str) -> DataFrame:
        counts = texts.mapInArrow(run, _COUNTS).groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f"))
        return scratch.table(counts.filter((F.col("f") >= least) | (F.col("words") == 0)), name)

    single = level(_single, "words")
    bits = context.broadcast(_frequent_bits(single.filter("words = 1")))
    pairs = level(lambda batches: _pairs(batches, bits.value), "pairs")
    more = context.broadcast(_frequent_bits(pairs))
    longer = level(lambda batches: _longer(batches, more.value), "longer")
    found = single.filter("words > 0").union(pairs).union(longer)
    return found, single.filter("words = 0").select("lang", F.col("f").alias("n"))


_WALKED = """
lang string, phrase binary, words int, f bigint, part1 bigint, part2 bigint, part3 bigint, longer bigint, run int,
carried boolean
"""


def _walk(batches, backwards: bool):
    """Walk one sorted run: counts of the beginnings of every phrase, the best phrase one word longer.

    Beginnings that lie in an earlier run come as rows of their own (``carried``), with the best longer phrase of this run.
    """
    from pyspark import TaskContext

    run = pa.Table.from_batches(batches)
    if not len(run):
        return
    number = TaskContext.get().partitionId()
    words, f = run["words"].to_numpy(), run["f"].to_numpy()
    place = np.arange(len(words))
    parts, longer, carried = [], np.zeros(len(words), np.int64), []
    for k in range(1, LONGEST):
        last = np.maximum.accumulate(np.where(words == k, place, -1))
        known = (last >= 0) & (words > k)
        parts.append(np.where(known, f[last], 0))
        grown = words == k + 1
        np.maximum.at(longer, last[grown & known], f[grown & known])
        if words[0] > k:
            best = f[grown & ~known]
            carried.append((k, int(best.max()) if len(best) else 0))
    columns = [
        run["lang"].combine_chunks(), run["phrase"].combine_chunks(), pa.array(words), pa.array(f),
        *[pa.array(p) for p in parts], pa.array(longer),
        pa.array(np.full(len(words), number, np.int32)), pa.array(np.zeros(len(words), bool)),
    ]
    names = ["lang", "phrase", "words", "f", "part1", "part2", "part3", "longer", "run", "carried"]
    yield pa.RecordBatch.from_arrays(columns, names)
    spelt = run["phrase"][0].as_py().split(b" ")
    for k, best in carried:
        begin = b" ".join(spelt[-k:] if backwards else spelt[:k])
        row = {"lang": run["lang"][0].as_py(), "phrase": begin, "words": k, "f": 0, "longer": best, "run": number, "carried": True}
        yield pa.RecordBatch.from_pylist([row | {f"part{i}": 0 for i in (1, 2, 3)}], schema=pa.schema([
            pa.field(n, c.type) for n, c in zip(names, columns)
        ]))


def _stream(phrases: DataFrame, runs: int, backwards: bool, scratch: Scratch) -> DataFrame:
    """``(lang, phrase, words, f, part1, part2, part3, longer)`` by a walk in prefix or suffix order."""
    spelt = F.split(F.col("phrase").cast("string"), " ")
    order = F.reverse(spelt) if backwards else spelt
    name = "suffixes" if backwards else "prefixes"
    walked = scratch.table(
        phrases.withColumn("order", order).repartitionByRange(runs, "lang", "order").sortWithinPartitions("lang", "order")
        .select("lang", "phrase", "words", "f").mapInArrow(lambda batches: _walk(batches, backwards), _WALKED), name,
    )
    # At most LONGEST - 1 rows per run.
    carried = walked.filter("carried").select("lang", "phrase", "words", "longer", "run")
    known = walked.filter("NOT carried")
    counts = F.broadcast(carried.select("lang", "phrase").distinct())
    counts = known.select("lang", "phrase", "f").join(counts, ["lang", "phrase"])
    open_parts = carried.join(counts, ["lang", "phrase"]).groupBy("run").agg(
        *[F.max(F.when(F.col("words") == k, F.col("f"))).alias(f"open{k}") for k in (1, 2, 3)]
    )
    best = carried.groupBy("lang", "phrase").agg(F.max("longer").alias("best"))
    part = [
        F.when((F.col(f"part{k}") == 0) & (F.col("words") > k), F.col(f"open{k}")).otherwise(F.col(f"part{k}")).alias(f"part{k}")
        for k in (1, 2, 3)
    ]
    return known.join(F.broadcast(open_parts), "run", "left").join(F.broadcast(best), ["lang", "phrase"], "left").select(
        "lang", "phrase", "words", "f", *part, F.greatest("longer", "best").alias("longer")
    )


def _wide(count: Column | str) -> Column:
    """A count as a decimal, so that products pass 64 bits."""
    return (F.col(count) if isinstance(count, str) else count).cast("decimal(19,0)")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 30, covered: int = 80, top: int = 2000,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: per language the ``top`` phrases that hold together best.

    A phrase with ``a`` occurrences is cut where ``floor(2000000 a / (l + r))`` is least. It is left out if a longer
    candidate that holds it has ``covered`` per cent of its occurrences.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "phrases")
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("binary").alias("text"))
    phrases, totals = frequent_phrases(texts, least, scratch)
    runs = max(shuffle_partitions(docs), -(-phrases.count() // RUN))
    left = _stream(phrases, runs, False, scratch).filter("words > 1").select(
        "lang", "phrase", "words", F.col("f").alias("a"), *[F.col(f"part{k}").alias(f"l{k}") for k in (1, 2, 3)], F.col("longer").alias("on_right")
    )
    right = _stream(phrases, runs, True, scratch).filter("words > 1").select(
        "lang", "phrase", *[F.col(f"part{k}").alias(f"r{k}") for k in (1, 2, 3)], F.col("longer").alias("on_left")
    )
    joined = left.hint("merge").join(right, ["lang", "phrase"])
    # All products and sums as decimals, beyond 64 bits; the score itself is at most 1000000.
    ends = F.array("r1", "r2", "r3")
    cuts = F.array(*[
        F.when(F.col("words") > k, F.struct(F.col(f"l{k}").alias("l"), F.get(ends, F.col("words") - k - 1).alias("r"), F.lit(k).alias("k")))
        for k in range(1, LONGEST)
    ])
    scored = F.transform(F.filter(cuts, lambda c: c.isNotNull()), lambda c: F.struct(
        F.call_function("div", _wide("a") * F.lit(2_000_000), _wide(c["l"]) + _wide(c["r"])).alias("score"),
        c["k"].alias("k"), c["l"].alias("l"), c["r"].alias("r"),
    ))
    longer = _wide(F.greatest("on_left", "on_right"))
    kept = joined.filter(longer * F.lit(100) < _wide("a") * F.lit(covered))
    best = kept.withColumn("cut", F.array_min(scored)).select(
        "lang", F.col("phrase").cast("string").alias("phrase"), "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score")
    )
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # The best of every part of a language first, so that one task ranks at most SALTS x top phrases.
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    first = best.withColumn("salt", salt).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    first = first.filter(F.col("rank") <= top).drop("salt", "rank")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


QUERIES = {"op12_phrase_collocations": op12_phrase_collocations}
ORACLES = {
    "op12_phrase_collocations": """
        WITH texts AS (
            SELECT coalesce(lang, 'und') AS lang,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents
        ), pieces AS (
            SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts
        ), spelt AS (
            SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS w FROM pieces
        ), grams AS (
            SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
            FROM spelt, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k
        ), counted AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
        totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE k = 1 GROUP BY lang),
        frequent AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM counted WHERE f >= 30),
        cuts AS (
            SELECT c.lang, c.phrase, c.k, c.f AS a, cut, array_to_string(c.w[1:cut], ' ') AS head, array_to_string(c.w[cut + 1:], ' ') AS rest
            FROM frequent c, (SELECT unnest([1, 2, 3]) AS cut) WHERE cut < c.k
        ), scored AS (
            SELECT x.*, h.f AS l, t.f AS r, CAST((CAST(x.a AS HUGEINT) * 2000000) // (h.f + t.f) AS BIGINT) AS score
            FROM cuts x JOIN frequent h ON h.lang = x.lang AND h.phrase = x.head
            JOIN frequent t ON t.lang = x.lang AND t.phrase = x.rest
        ), lowest AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
        ), inner_phrases AS (
            SELECT lang, f, array_to_string(w[b:b + size - 1], ' ') AS part
            FROM frequent, (SELECT unnest([1, 2, 3]) AS b), (SELECT unnest([2, 3]) AS size) WHERE size < k AND b + size - 1 <= k
        ), covering AS (SELECT lang, part, max(f) AS most FROM inner_phrases GROUP BY ALL),
        ranked AS (
            SELECT p.lang, phrase, a, l, r, n, score,
                   row_number() OVER (PARTITION BY p.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
            FROM lowest p JOIN totals USING (lang) LEFT JOIN covering c ON c.lang = p.lang AND c.part = p.phrase
            WHERE most IS NULL OR 100 * most < 80 * a
        )
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
    """,
}
