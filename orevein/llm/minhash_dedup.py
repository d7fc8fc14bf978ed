"""MinHash near-duplicates by a signature-coordinate inverted join.

Every text becomes its set of 5-word shingles; equal sets are one class. A class has a signature
of ``COORDINATES`` minima and is posted under each (coordinate, value). Two classes are candidates when at
least ``matches`` coordinates agree, so they must share one of the ``prefix`` rarest postings of either;
postings that are frequent everywhere (common lines and passages) are skipped that way and the rest of the
signature is compared only for pairs that met. Links are confirmed on the full shingle sets of the whole texts.

Groups are never expanded into all pairs. First every posting list links its members to its
first class (a star); confirmed stars give components. Then the lists that still hold two components
are swept in tiles: a first sweep finds, by signatures, the members with a candidate partner in another component;
a second one has their shingle sets, confirms every such pair and returns one link for each two components that meet.
Every candidate pair is thus either inside one component already or confirmed itself, and no sweep returns pairs.

A pair at the similarity of ``CONTRACT`` (0.85) is missed with a probability below 2e-5 (fewer than 18 of 32 agreeing,
binomial), one at that of ``WIDER`` (0.80) below 7e-6 (fewer than 15), far less above.

Defined cases: A-Z are lower-cased, words lie between ASCII white space. Fewer than five words: the whole
sequence is the one shingle; no words or a null text: the empty set, which links with nothing. Repeated rows are
equal sets; a null id ranks last. ``component_id`` is the smallest id reachable. Empty tables give no rows; other columns are ignored.
Ids need not be unique: a row is told by its id and the hash of its text, a group by its ``component``, never by an id alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from orevein.llm.common import lower_words, shuffle_partitions
from orevein.llm.components import connected_components
from orevein.plans.tables import table
from orevein.session import Scratch

WORDS = 5
COORDINATES = 32
HUB_MEMBERS = 400  # members that are compared with one copy of their hub
TILE = 1024  # classes on one side of a tile of a long posting list
PAIRS = 1 << 12  # pairs whose postings are compared at once
CACHE = 300_000  # words whose hash a worker remembers

_ODD = [int(x) | 1 for x in np.random.default_rng(11).integers(1, 2**63, WORDS + 2 * COORDINATES + 4)]
_WORD_FACTORS = np.array(_ODD[:WORDS], np.uint64)
_FACTORS = np.array(_ODD[WORDS:WORDS + COORDINATES], np.uint64)[:, None]
_SHIFTS = np.array(_ODD[WORDS + COORDINATES:WORDS + 2 * COORDINATES], np.uint64)[:, None]


class Rule(NamedTuple):
    """What makes a link."""

    percent: int  # links: 100 * intersection >= percent * union
    matches: int  # agreeing coordinates of a candidate pair

    @property
    def prefix(self) -> int:
        """Two classes with ``matches`` agreements share one of so many postings."""
        return COORDINATES - self.matches + 1


CONTRACT = Rule(85, 18)  # op7
WIDER = Rule(80, 15)


class WordHashes(dict):
    """64-bit hashes of words, computed when first asked for."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit numbers (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(_ODD[-1])
    x = (x ^ (x >> np.uint64(29))) * np.uint64(_ODD[-2])
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = lower_words(text)
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(WORDS, len(h))
    total = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        total += _mix(h[k:len(h) - width + 1 + k] * _WORD_FACTORS[k])
    return np.unique(_mix(total))


def fingerprint(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that tell two sets apart."""
    one = _mix(shingles * np.uint64(_ODD[-3])).sum(dtype=np.uint64)
    two = _mix(shingles * np.uint64(_ODD[-4])).sum(dtype=np.uint64)
    return int(one.view(np.int64)), int(two.view(np.int64))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Upper half of the smallest value of each permutation."""
    low = np.full((COORDINATES, 1), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 4096):
        part = shingles[None, start:start + 4096] * _FACTORS + _SHIFTS
        low = np.minimum(low, part.min(axis=1, keepdims=True))
    return (low[:, 0] >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _signatures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    for batch in batches:
        rows = []
        for ident, text_hash, text in zip(batch["id"], batch["text_hash"], batch["text"]):
            s = shingle_set(text, hashes)
            rows.append((ident, text_hash, len(s), *fingerprint(s), signature(s) if len(s) else None))
        out = pd.DataFrame(rows, columns=["id", "text_hash", "n", "f1", "f2", "sig"])
        out["id"] = out["id"].astype("Int64")
        yield out


def _text_hash(text_col: str):
    """Tells rows of one id apart; Spark's 64-bit hash of the text as it is."""
    return F.xxhash64(F.col(text_col))


def _agreements(a: str, b: str):
    return F.expr(f"aggregate(zip_with({a}, {b}, (x, y) -> if(x = y, 1, 0)), 0, (s, x) -> s + x)")


def _near_size(m: str, n: str, rule: Rule):
    """Sets of very different sizes can't reach the similarity."""
    return (F.least(m, n) * 100 >= F.greatest(m, n) * rule.percent)


def _confirm(batches: Iterator[pd.DataFrame], rule: Rule) -> Iterator[pd.DataFrame]:
    """Rows sorted by (hub, salt, kind): the hub's text first, then the members to compare with it."""
    hashes, where, hub = WordHashes(), None, None
    for batch in batches:
        out = []
        for a, salt, kind, b, f1, text in zip(batch.a, batch.salt, batch.kind, batch.b, batch.f1, batch.text):
            if (a, salt) != where:
                where, hub = (a, salt), None
            if kind == 0 and hub is not None:
                continue
            s = shingle_set(text, hashes)
            if not len(s) or fingerprint(s)[0] != f1:  # a row of the same id with another text
                continue
            if kind == 0:
                hub = s
            elif hub is not None:
                both = len(np.intersect1d(hub, s, assume_unique=True))
                if 100 * both >= rule.percent * (len(hub) + len(s) - both):
                    out.append((a, b))
        yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def _texts(wanted: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """``(cls, f1, text)``: a text of every class in ``wanted (cls)``."""
    ends = classes.join(wanted, "cls", "left_semi").select("cls", F.col("low").alias("id"), F.col("low_hash").alias("text_hash"), "f1")
    same = docs.id.eqNullSafe(ends.id) & (docs.text_hash == ends.text_hash)
    return docs.join(ends, same).select("cls", "f1", "text")


def _links(pairs: DataFrame, classes: DataFrame, docs: DataFrame, scratch: Scratch, rule: Rule) -> DataFrame:
    """Those of ``pairs (a, b)`` whose full shingle sets are similar enough."""
    ends = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct()
    texts = scratch.table(_texts(ends, classes, docs), "texts")
    salts = pairs.groupBy("a").agg(F.ceil(F.count("*") / HUB_MEMBERS).cast("int").alias("salts"))
    hubs = texts.join(salts, texts.cls == salts.a).select(
        "a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("kind"),
        F.col("cls").alias("b"), "f1", "text",
    )
    members = pairs.join(salts, "a").join(texts, F.col("b") == F.col("cls")).select(
        "a", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"), F.lit(1).alias("kind"), "b", "f1", "text"
    )
    rows = hubs.union(members).repartition(shuffle_partitions(docs), "a", "salt").sortWithinPartitions("a", "salt", "kind", "b")
    found = scratch.table(rows.mapInPandas(partial(_confirm, rule=rule), "a bigint, b bigint").distinct(), "confirmed")
    scratch.drop(texts)
    return found


def _tiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The tiles of rows sorted by (key, one, two), each whole; one tile and one batch are held at a time."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        spot = batch[["key", "one", "two"]].to_numpy()
        cuts = np.nonzero((spot[1:] != spot[:-1]).any(axis=1))[0] + 1
        if held and (held[-1][["key", "one", "two"]].to_numpy()[-1] != spot[0]).any():
            yield pd.concat(held, ignore_index=True)
            held = []
        for start, stop in zip([0, *cuts], [*cuts, len(batch)]):
            held.append(batch.iloc[start:stop])
            if stop < len(batch):
                yield pd.concat(held, ignore_index=True)
                held = []
    if held:
        yield pd.concat(held, ignore_index=True)


def _first_shared(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The first posting that both rows of each pair have, the largest number without one; rows are filled up with -1."""
    none, found = np.iinfo(np.int64).max, []
    for start in range(0, len(one), PAIRS):
        a, b = one[start:start + PAIRS], two[start:start + PAIRS]
        shared = (a[:, :, None] == b[:, None, :]).any(axis=2) & (a >= 0)
        found.append(np.where(shared, a, none).min(axis=1, initial=none))
    return np.concatenate([np.empty(0, np.int64), *found])


def _candidates(tile: pd.DataFrame, rule: Rule) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of pairs that agree in enough coordinates, lie in different components and meet here first."""
    sig, n, comp = np.stack(tile.sig.to_numpy()), tile.n.to_numpy(), tile.comp.to_numpy()
    first = np.stack([np.pad(p, (0, rule.prefix - len(p)), constant_values=-1) for p in tile.prefix])
    key, side = tile.key.iloc[0], tile.side.to_numpy()
    if tile.one.iloc[0] == tile.two.iloc[0]:
        left = right = np.arange(len(tile))
    else:
        left, right = np.nonzero(side == 0)[0], np.nonzero(side == 1)[0]
    for start in range(0, len(left), 64):
        rows = left[start:start + 64]
        good = (sig[rows][:, None, :] == sig[right][None, :, :]).sum(axis=2) >= rule.matches
        m, k = n[rows][:, None], n[right][None, :]
        good &= (comp[rows][:, None] != comp[right][None, :]) & (np.minimum(m, k) * 100 >= np.maximum(m, k) * rule.percent)
        i, j = np.nonzero(good)
        i, j = rows[i], right[j]
        if left is right:
            i, j = i[i < j], j[i < j]
        here = _first_shared(first[i], first[j]) == key
        yield i[here], j[here]


def _find_members(batches: Iterator[pd.DataFrame], rule: Rule = CONTRACT) -> Iterator[pd.DataFrame]:
    """Rows of every tile that have a candidate partner in it; never the pairs."""
    for tile in _tiles(batches):
        hit = np.zeros(len(tile), bool)
        if len(tile) > 1:
            for i, j in _candidates(tile, rule):
                hit[i] = hit[j] = True
        yield tile[hit]


def _merge_components(batches: Iterator[pd.DataFrame], rule: Rule = CONTRACT) -> Iterator[pd.DataFrame]:
    """Confirmed links of every tile, one for each pair of components that it joins."""
    for tile in _tiles(batches):
        sets = [np.frombuffer(s, np.uint64) for s in tile.shingles]
        size = np.array([len(s) for s in sets])
        _, ids = np.unique(np.concatenate(sets), return_inverse=True)
        ends = np.cumsum(size)
        parts = [ids[e - k:e] for e, k in zip(ends, size)]
        group, cls, out = tile.comp.to_numpy().copy(), tile.cls.to_numpy(), []
        mark = np.zeros(ids.max(initial=0) + 1, bool)
        for i, j in _candidates(tile, rule):
            for row in np.unique(i):
                others = j[i == row]
                others = others[group[others] != group[row]]
                if not len(others):
                    continue
                mark[parts[row]] = True
                held = np.concatenate([parts[o] for o in others])
                both = np.add.reduceat(mark[held].astype(np.int64), np.cumsum([0, *size[others][:-1]]))
                mark[parts[row]] = False
                linked = others[100 * both >= rule.percent * (size[row] + size[others] - both)]
                for o in linked:
                    if group[o] != group[row]:
                        out.append((cls[row], cls[o]))
                        group[group == group[o]] = group[row]
        yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def _shingles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    for batch in batches:
        sets = [shingle_set(t, hashes) for t in batch["text"]]
        keep = [len(s) > 0 and fingerprint(s)[0] == f for s, f in zip(sets, batch["f1"])]
        yield pd.DataFrame({
            "cls": batch["cls"][keep], "shingles": [s.tobytes() for s, k in zip(sets, keep) if k]
        })


def _postings(classes: DataFrame, rule: Rule) -> DataFrame:
    """``(cls, prefix)``: of every class the rarest postings that others share."""
    rows = classes.select("cls", F.posexplode("sig").alias("pos", "value")).select(
        "cls", F.expr("shiftleft(cast(pos as bigint), 32) | (cast(value as bigint) & 4294967295L)").alias("key")
    )
    shared = rows.groupBy("key").agg(F.count("*").alias("times")).filter("times > 1")
    ranked = rows.join(shared, "key").groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("times", "key"))).alias("found"))
    # Postings of one class only are the rarest and use up their part of the prefix.
    left = F.lit(rule.prefix - COORDINATES) + F.size("found")
    return ranked.filter(left > 0).select("cls", F.slice("found", F.lit(1), left)["key"].alias("prefix"))


def near_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Rule = CONTRACT) -> DataFrame:
    """``(id, text_hash, f1, f2, n_shingles, component, component_id, kept)``, a row per document.

    ``component`` tells the groups apart, null without words; two groups can have one ``component_id`` if ids repeat.
    """
    scratch = Scratch(docs.sparkSession, "minhash")
    docs = docs.select(F.col(id_col).cast("bigint").alias("id"), _text_hash(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    sets = scratch.table(
        docs.mapInPandas(_signatures, "id bigint, text_hash bigint, n bigint, f1 bigint, f2 bigint, sig array<int>"), "sets"
    )
    lowest_row = F.min(F.struct(F.col("id").isNull(), "id", "text_hash"))
    classes = scratch.table(
        sets.filter("n > 0").groupBy("f1", "f2", "n").agg(lowest_row.alias("low"), F.min("sig").alias("sig"))
        .select("f1", "f2", "n", F.col("low.id").alias("low"), F.col("low.text_hash").alias("low_hash"), "sig")
        .withColumn("cls", F.monotonically_increasing_id()), "classes",
    )
    prefixes = scratch.table(_postings(classes, rule), "prefixes")
    postings = prefixes.select("cls", F.explode("prefix").alias("key"))
    hubs = postings.groupBy("key").agg(F.min("cls").alias("hub"))
    met = postings.join(hubs, "key").filter("hub <> cls").select(F.col("hub").alias("a"), F.col("cls").alias("b")).distinct()
    one = classes.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa"))
    two = classes.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb"))
    sizes = met.join(one, "a").join(two, "b").filter(_near_size("na", "nb", rule))
    stars = scratch.table(sizes.filter(_agreements("sa", "sb") >= rule.matches).select("a", "b"), "stars")
    links = _links(stars, classes, docs, scratch, rule)
    first = connected_components(links, scratch)
    # Lists that still hold two components, cut into tiles.
    placed = postings.join(first.select(F.col("id").alias("cls"), "component"), "cls", "left").select(
        "key", "cls", F.coalesce("component", "cls").alias("comp")
    )
    mixed = placed.groupBy("key").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("members")
    ).filter("low <> high").select("key", F.ceil(F.col("members") / TILE).cast("int").alias("tiles"))
    facts = classes.select("cls", "n", "sig").join(prefixes, "cls")
    dealt = (
        placed.join(mixed, "key").join(facts, "cls")
        .withColumn("tile", F.pmod(F.xxhash64("cls"), F.col("tiles")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select(
            "key", F.least("tile", "other").alias("one"), F.greatest("tile", "other").alias("two"),
            (F.col("tile") > F.col("other")).cast("int").alias("side"), "cls", "comp", "n", "sig", "prefix",
        )
    )
    shape = "key bigint, one int, two int, side int, cls bigint, comp bigint, n bigint, sig array<int>, prefix array<bigint>"
    spot = ["key", "one", "two"]
    # A stated number of tasks: sweeps cost far more than their bytes tell adaptive execution.
    tasks = shuffle_partitions(docs)
    members = scratch.table(
        dealt.repartition(tasks, *spot).sortWithinPartitions(*spot, "side", "cls").mapInPandas(partial(_find_members, rule=rule), shape), "members"
    )
    sets_of = scratch.table(
        _texts(members.select("cls").distinct(), classes, docs).mapInPandas(_shingles, "cls bigint, shingles binary")
        .dropDuplicates(["cls"]), "shingles",
    )
    second = scratch.table(
        members.join(sets_of, "cls").repartition(tasks, *spot).sortWithinPartitions(*spot, "side", "cls")
        .mapInPandas(partial(_merge_components, rule=rule), "a bigint, b bigint"), "merges",
    )
    reach = connected_components(links.union(second), scratch).withColumnRenamed("id", "cls")
    lowest = classes.select("cls", "low").join(reach, "cls").groupBy("component").agg(F.min("low").alias("component_id"))
    found = (
        classes.join(reach.join(lowest, "component"), "cls", "left")
        .select(
            "f1", "f2", "n", F.coalesce("component", "cls").alias("component"),
            F.coalesce("component_id", "low").alias("component_id"),
        )
    )
    columns = ["id", "text_hash", "f1", "f2", "n", "component", "component_id"]
    met = sets.filter("n > 0").join(found, ["f1", "f2", "n"]).select(*columns)
    alone = sets.filter("n = 0").withColumns({"component": F.lit(None).cast("bigint"), "component_id": F.col("id")}).select(*columns)
    return met.union(alone).withColumnRenamed("n", "n_shingles").withColumn(
        "kept", F.col("id").eqNullSafe(F.col("component_id"))
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Rule = CONTRACT) -> DataFrame:
    """One row of ``docs`` of every group of near-duplicates, all columns; documents without words form no group and stay.

    The row with the smallest id stays (null last), of several with that id the one with the smallest fingerprint,
    then text hash. Rows with one id, or none, and one text are cut to one, those without words or text too. Columns of
    any name pass through. Ids must be whole numbers.
    """
    rows = near_documents(docs, id_col, text_col, rule)
    first = F.min(F.struct(F.col("id").isNull(), "id", "f1", "f2", "n_shingles", "text_hash")).alias("first")
    kept = rows.filter("n_shingles > 0").groupBy("component").agg(first).select("first.id", "first.text_hash")
    kept = kept.union(rows.filter("n_shingles = 0").select("id", "text_hash"))
    # The row travels in one column, so that its names can't meet the operator's own.
    marked = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("bigint").alias("id"), _text_hash(text_col).alias("text_hash"))
    same = F.col("m.id").eqNullSafe(F.col("k.id")) & (F.col("m.text_hash") == F.col("k.text_hash"))
    found = marked.alias("m").join(kept.alias("k"), same, "left_semi")
    return found.dropDuplicates(["id", "text_hash"]).select("row.*")


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_documents(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept"
    )


QUERIES = {"op7_minhash_dedup": op7_minhash_dedup}
ORACLES = {
    "op7_minhash_dedup": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
        ), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        links AS (
            SELECT p.a, p.b FROM (
                SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both
                FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
            ) p JOIN sizes m ON m.doc_id = p.a JOIN sizes n ON n.doc_id = p.b
            WHERE 100 * p.both >= 85 * (m.n + n.n - p.both)
        ), walk AS (
            SELECT a, b FROM links UNION SELECT walk.a, links.b FROM walk JOIN links ON walk.b = links.a
        ), lowest AS (SELECT a, least(a, min(b)) AS component_id FROM walk GROUP BY a)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id,
               d.doc_id = coalesce(component_id, d.doc_id) AS kept
        FROM documents d LEFT JOIN sizes ON sizes.doc_id = d.doc_id LEFT JOIN lowest ON lowest.a = d.doc_id
    """,
}
