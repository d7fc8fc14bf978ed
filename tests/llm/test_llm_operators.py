"""Small cases of every training-data operator: odd rows, ties, brute force."""

from __future__ import annotations

import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from orevein.llm import (
    components, embedding_dedup, exact_dedup, license_scan, lm_scoring, minhash_dedup, mixing, packing, quality,
    toxicity, url_filter,
)
from orevein.llm.common import lower_words
from orevein.session import Scratch

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, n string, size string, kept int"


def documents(spark, rows):
    """Documents with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "en", s, 0, "x", "y", 7) for i, t, s in rows], DOCS)


ODD = [(1, "a b", "s"), (2, None, None), (3, "", "s"), (4, "ab", "s"), (4, "ab", "s"), (None, "a b\tc", None), (6, "word " * 3000, "t")]


def test_exact_groups_odd_rows(spark):
    got = {(r["_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_groups(documents(spark, ODD)).collect()}
    assert (1, 1, 3, True) in got and (4, 1, 3, False) in got
    assert (2, 2, 2, True) in got and (3, 2, 2, False) in got
    assert (None, None, 1, True) in got and (6, 6, 1, True) in got


def test_exact_groups_agree_with_and_without_all_digests(spark):
    docs = documents(spark, [(i, "t" * (i % 7) + str(i % 11), "s") for i in range(120)])
    cols = ["_id", "keep_id", "group_size", "kept"]
    one = sorted(map(tuple, exact_dedup.exact_groups(docs).select(*cols).collect()))
    two = sorted(map(tuple, exact_dedup.exact_groups(docs, hash_all=True).select(*cols).collect()))
    assert one == two


def test_exact_deduplicate_keeps_columns_and_one_row(spark):
    docs = documents(spark, [*ODD, (5, "x", "s"), (5, "x", "s")])
    got = exact_dedup.deduplicate(docs)
    assert got.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in got.collect()) == ["1", "2", "5", "6", "None"]


def test_exact_deduplicate_against_plain_grouping(spark):
    """Texts that share length and opening but not their ends, repeated and null ids, empty texts."""
    rng = np.random.default_rng(4)
    head = "same opening of every text " * 4
    rows = [(int(i), (head if i % 3 else "") + " " * int(rng.integers(0, 3)) + str(rng.integers(10, 40)), "s") for i in range(150)]
    rows += [(None, rows[4][1], "s"), (None, head + "only here", None), (200, None, "s"), (201, "", None), (7, rows[7][1], "s")]
    best = {}
    for i, t, _ in rows:
        key = "".join((t or "").split())
        best[key] = min(best.get(key, (1, True, 0)), (-len(t or ""), i is None, -1 if i is None else i))
    want = Counter(None if none else i for _, none, i in best.values())
    docs = documents(spark, rows).repartition(7)
    assert Counter(r["doc_id"] for r in exact_dedup.deduplicate(docs).collect()) == want
    groups = exact_dedup.exact_groups(docs)
    assert groups.filter("_sha IS NULL").count() > 0 and groups.filter("NOT kept AND _sha IS NULL").count() == 0


@pytest.mark.parametrize("rows", [[], ODD])
def test_operators_take_empty_and_odd_tables(spark, rows):
    docs = documents(spark, rows)
    templates = spark.createDataFrame(list(license_scan.TEMPLATES), "license string, text string")
    labels = spark.createDataFrame([(1, 1, None), (1, None, 0), (None, 0, 1)], "doc_id bigint, quality int, toxic int")
    learn = quality.checksum(docs["doc_id"]) >= 0
    every = quality.checksum(labels["doc_id"]) >= 0
    n = len(rows)
    assert exact_dedup.exact_groups(docs).count() == n
    assert minhash_dedup.near_documents(docs).count() == n
    assert mixing.mix(docs, ["doc_id"]).count() == n
    assert license_scan.scan(docs, templates).count() == 0
    assert lm_scoring.score(docs, learn & False).count() == n
    assert toxicity.grade(docs, labels, every).count() == n
    scores = [r["s"] for r in docs.select(quality.scorer(spark, quality.fit(docs, labels, every))("text").alias("s")).collect()]
    assert len(scores) == n and all(0 <= s <= 1 for s in scores)
    packed = packing.pack(docs)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a bigint, b bigint")
    got = {r["id"]: r["component"] for r in components.connected_components(edges, Scratch(spark, "t")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_url_rules(spark):
    rules = spark.createDataFrame(
        [("org", "/", "allow"), ("a.org", "/x", "block"), ("a.org", "/x", "allow"), ("b.a.org", "/", "allow"), ("", "/", "block"), ("c", None, "block")],
        "host string, path string, verdict string",
    )
    urls = spark.createDataFrame(
        [(1, "http://A.org/x/y?z"), (2, "http://b.a.org/x"), (3, None), (4, "a.org/x"), (5, "s://aorg/"), (6, "s://z.org"), (6, "s://q.b.a.org/1#x"), (7, "s://a.org/x://y")],
        "page_id bigint, url string",
    )
    got = sorted((r["page_id"], r["_host"], r["_path"], r["_rule"], r["_verdict"]) for r in url_filter.judge(urls, rules).collect() if r["page_id"] != 6)
    assert got == [
        (1, "a.org", "/x/y", "a.org/x", "block"), (2, "b.a.org", "/x", "b.a.org/", "allow"), (3, "", "", None, "allow"),
        (4, "", "", None, "allow"), (5, "aorg", "/", None, "allow"), (7, "a.org", "/x://y", "a.org/x", "block"),
    ]
    assert url_filter.judge(urls.filter("page_id > 9"), rules).count() == 0


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(30, 16))
    rows = [(i, (base[i % 30] + rng.normal(size=16) * 0.12 * (i % 4)).tolist()) for i in range(150)]
    rows += [(200, rows[5][1]), (201, [2 * x for x in rows[5][1]]), (202, [0.0] * 16), (203, None), (204, [float("nan")] + [1.0] * 15), (205, []), (206, [1.0]), (207, [None] + [1.0] * 15)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    good = {i: np.array(v) for i, v in rows if v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)}
    links = {i: {j for j in good if j != i and good[i] @ good[j] / np.sqrt((good[i] @ good[i]) * (good[j] @ good[j])) >= 0.95} for i in good}
    assert sum(map(len, links.values())) > 100
    low = {i: i for i, _ in rows}
    for _ in rows:
        low = {i: min([low[i], *[low[j] for j in links.get(i, ())]]) for i in low}
    got = {r["id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.near_vectors(vectors).collect()}
    assert got == {i: (len(links.get(i, ())), low[i], low[i] == i) for i, _ in rows}


def test_quantisation_bound_holds():
    rng = np.random.default_rng(1)
    unit = rng.normal(size=(200, 24))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    codes, scale, error = embedding_dedup.quantise(unit)
    near = (codes.astype(int) @ codes.T.astype(int)) * scale[:, None] * scale[None, :]
    bound = error[:, None] + error[None, :] + error[:, None] * error[None, :]
    assert (np.abs(near - unit @ unit.T) <= bound + 1e-12).all()


def test_minhash_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    base = [f"w{x}" for x in rng.integers(0, 400, 160)]
    rows = [(900, None, "s"), (901, "", "s"), (902, "one two", "s"), (903, "ONE  two", "s"), (904, "one two three four five", "s")]
    for i in range(160):  # one group whose copies differ by more and more words
        words = list(base)
        for _ in range(i % 9):
            words[int(rng.integers(0, len(words)))] = f"z{int(rng.integers(0, 10**6))}"
        rows.append((i, " ".join(words), "s"))
    rows += [(i, " ".join(f"v{x}" for x in rng.integers(0, 10**5, 60)) + " " + " ".join(base[:40]), "s") for i in range(200, 260)]
    sets = {}
    for i, t, _ in rows:
        w = lower_words(t)
        sets[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    link = {i: [j for j in sets if j != i and sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])] for i in sets}
    low = {i: i for i in sets}
    for _ in range(40):
        low = {i: min([low[i], *[low[j] for j in link[i]]]) for i in low}
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in minhash_dedup.near_documents(documents(spark, rows)).collect()}
    assert got == {i: (len(sets[i]), low[i]) for i in sets}
    left = minhash_dedup.keep_one(documents(spark, rows))
    assert left.count() == sum(low[i] == i for i in low) and "kept" in left.columns


def _numbered_text(start, words=60):
    return " ".join(f"t{start + i}" for i in range(words))


def test_keep_one_with_null_and_clashing_ids(spark):
    one, two, three, four, five = (_numbered_text(k * 1000) for k in range(5))
    rows = [
        (1, one, "s"), (None, one + " end", "s"),  # a null id is a near copy of a document with an id
        (None, two, "s"), (None, three, "s"), (None, None, "s"), (None, three + " end", "s"),
        (7, four, "s"), (3, four + " end", "s"), (7, five, "s"),  # of id 7 one text is a near copy, the other is not
    ]
    left = [(r["doc_id"], r["text"]) for r in minhash_dedup.keep_one(documents(spark, rows)).collect()]
    third = [(i, t) for i, t in left if t in (three, three + " end")]
    assert len(third) == 1
    assert sorted(map(str, left)) == sorted(map(str, [(1, one), (None, two), (None, None), (3, four + " end"), (7, five), *third]))


def test_keep_one_when_two_groups_share_their_smallest_id(spark):
    one, two = _numbered_text(0), _numbered_text(1000)
    rows = [(4, one, "s"), (5, one + " end", "s"), (4, two, "s"), (4, two.upper(), "s"), (9, two + " end", "s"), (5, two, "s")]
    for part in (rows, rows[::-1]):
        left = [(r["doc_id"], r["text"].lower()) for r in minhash_dedup.keep_one(documents(spark, part)).collect()]
        assert sorted(left) == [(4, one), (4, two)]


def test_keep_one_by_the_wider_rule(spark):
    # 104 words have 100 shingles, their first 87 words 83 of them and their first 82 words 78.
    rows = []
    for k in range(30):
        words = _numbered_text(k * 1000, 104).split()
        rows += [(4 * k, " ".join(words), "s"), (4 * k + 1, " ".join(words[:87 if k % 2 else 82]), "s")]
    docs = documents(spark, rows)
    assert minhash_dedup.keep_one(docs).count() == 60
    left = {r["doc_id"] for r in minhash_dedup.keep_one(docs, rule=minhash_dedup.WIDER).collect()}
    assert left == {4 * k for k in range(30)} | {4 * k + 1 for k in range(0, 30, 2)}


def test_minhash_tiles_find_links_between_stars():
    """Two components whose hubs are far apart but whose members are close are joined in a tile."""
    import pandas as pd

    hashes = minhash_dedup.WordHashes()
    words = [f"w{i}" for i in range(200)]
    sets = [minhash_dedup.shingle_set(" ".join(words[k:k + 150]), hashes) for k in (0, 4, 45)]
    rows = pd.DataFrame({
        "key": 5, "one": 0, "two": 0, "side": 0, "cls": [1, 2, 3], "comp": [1, 2, 3], "n": [len(s) for s in sets],
        "sig": [minhash_dedup.signature(s) for s in sets], "prefix": [np.array([5])] * 3, "shingles": [s.tobytes() for s in sets],
    })
    got = pd.concat(minhash_dedup._merge_components(iter([rows.iloc[:1], rows.iloc[1:]])))
    assert got.values.tolist() == [[1, 2]]
    assert set(pd.concat(minhash_dedup._find_members(iter([rows]))).cls) >= {1, 2}


@pytest.mark.parametrize("order", [2, 5])
def test_lm_scores_equal_a_plain_trie(spark, order):
    texts = ["the cat sat", "The  cat\tran", None, "", "été naïve", "dog " * 40, "zebra quilt", "the cat sat", "a\x00b"]
    rows = [(i, texts[i % len(texts)] if i % 5 else f"t{i} the", "s") for i in range(60)] + [(None, "the dog", "s")]
    docs = documents(spark, rows)
    got = lm_scoring.score(docs, lm_scoring.checksum(docs["doc_id"]) % 10 == 0, order=order).collect()
    trie, counts = lm_scoring.Trie(order), Counter()
    for i, t, _ in rows:
        if zlib.crc32(str("" if i is None else i).encode()) % 10:
            trie.score(t, learn=True)
            counts.update([*lower_words(t), "end"])
    total, distinct = sum(counts.values()), len(counts)
    text_of = {i: t for i, t, _ in rows}
    assert len(got) == len(rows) and any(r["held_out"] for r in got)
    for r in got:
        tokens = [*lower_words(text_of[r["id"]]), "end"]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in tokens)
        assert r["score"] == pytest.approx(trie.score(text_of[r["id"]]), rel=1e-9)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(counts[w] > 0 for w in tokens), total)


def test_trie_probabilities_add_up_and_adaptive_learns(spark):
    trie = lm_scoring.Trie(3)
    trie.score("abracadabra abracadabra", learn=True)
    for context in (b"abr", b"xyz", b"\xfe\xfe\xfe", b"bra"):
        assert sum(trie.probability(context, s) for s in range(256) if s != 254) == pytest.approx(1.0)
    got = [r["score"] for r in lm_scoring.adaptive_scores(documents(spark, [(1, "ab " * 30, "s"), (2, None, "s")])).collect()]
    assert got[0] > 30 * 3 * math.log10(1 / 255) / 2 and got[1] == pytest.approx(math.log10(1 / 255))


def test_license_scan_finds_edited_notices(spark):
    templates = spark.createDataFrame(list(license_scan.TEMPLATES), "license string, text string")
    gpl = dict(license_scan.TEMPLATES)["gpl-3.0"]
    rows = [
        (1, "x " * 33 + gpl.upper() + " y" * 50, "s"), (2, "Released under the MIT License", "s"), (3, "Released under the BSD License", "s"),
        (4, None, "s"), (5, "two words", "s"), (6, "all rights, reserved!", "s"),
        (7, gpl.replace("This work is", "It is").replace(", version", " version"), "s"),
    ]
    got = {(r["id"], r["license"]): r["containment"] for r in license_scan.scan(documents(spark, rows), templates).collect()}
    assert got[1, "gpl-3.0"] == 1.0 and got[2, "mit"] == 1.0 and got[6, "all-rights-reserved"] == 1.0
    assert got[7, "gpl-3.0"] >= 0.8 and not {i for i, _ in got} & {3, 4, 5}


def test_mix_meets_targets_and_caps(spark):
    rng = np.random.default_rng(2)
    rows = [(i, "w " * int(rng.integers(0, 60)), ["b", "a", None, "c"][i % 4]) for i in range(400)]
    rows += [(1000 + i, "q " * 7, "hot") for i in range(500)]
    got = mixing.mix(documents(spark, rows), ["doc_id", "size"]).collect()
    sizes = {s: sum(len(t.split()) for _, t, x in rows if x == s) for s in ("a", "b", "c", "hot", None)}
    target, weights = {}, dict(zip(["a", "b", "c", "hot", None], (5, 2, 1, 5, 2)))
    budget, free = 1.5 * sum(sizes.values()), dict(weights)
    while True:
        level = (budget - sum(target.values())) / sum(free.values())
        over = [s for s in free if level * free[s] > 2 * sizes[s]]
        if not over:
            target |= {s: level * w for s, w in free.items()}
            break
        for s in over:
            target[s] = 2 * sizes[s]
            del free[s]
    source = {i: s for i, _, s in rows}
    for s in sizes:
        mine = [r for r in got if source[r["doc_id"]] == s]
        assert {round(r["_target"], 6) for r in mine} == {round(target[s], 6)} and {r["_source_size"] for r in mine} == {sizes[s]}
        assert abs(sum(r["_copies"] * r["_size"] for r in mine) - target[s]) <= 8
    assert all(0 <= r["_copies"] <= 2 and r["size"] == "y" for r in got)
    again = mixing.mix(documents(spark, rows[::-1]).repartition(3), ["doc_id"]).collect()
    assert {r["doc_id"]: r["_copies"] for r in got} == {r["doc_id"]: r["_copies"] for r in again}
    assert mixing.mixed_rows(documents(spark, rows)).count() == sum(r["_copies"] for r in got)


def test_mix_ranks_within_hash_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 20)
    rows = [(i, "q " * 7, "hot") for i in range(300)] + [(1000 + i, "q " * (i % 5), "b") for i in range(200)]
    got = mixing.mix(documents(spark, rows), ["doc_id"]).collect()
    hot = [r for r in got if r["doc_id"] < 300]
    assert len(got) == 500 and abs(sum(r["_copies"] * r["_size"] for r in hot) - hot[0]["_target"]) <= 7


def plain_best_fit(lengths, sizes):
    """Bins as lists of lengths and their final sizes, by looking at every open bin."""
    bins = []  # [free, turn of the last change, lengths]
    for turn, length in enumerate(lengths):
        fitting = [b for b in bins if b[0] >= length]
        if fitting:
            chosen = min(fitting, key=lambda b: (b[0], -b[1]))
        else:
            rest = sum(lengths[turn:])
            price = {c: packing.sequence_cost(c) / min(c, rest) for c in sizes if c >= length}
            chosen = [min(c for c in price if price[c] == min(price.values())), turn, []]
            bins.append(chosen)
        chosen[0], chosen[1] = chosen[0] - length, turn
        chosen[2].append(length)
    return sorted((min(c for c in sizes if c >= sum(held)), tuple(held)) for *_, held in bins)


def plain_pack(lengths, sizes=packing.CAPACITIES):
    plans = [plain_best_fit(lengths, [c for c in sizes if c <= most]) for most in sizes if most >= lengths[0]]
    return min(plans, key=lambda plan: sum(packing.sequence_cost(c) for c, _ in plan))


def least_cost(lengths, sizes):
    """The cheapest of all ways to divide the pieces into bins."""
    if not lengths:
        return 0.0
    first, rest = lengths[0], lengths[1:]
    found = []
    for mask in range(1 << len(rest)):
        held = first + sum(n for k, n in enumerate(rest) if mask >> k & 1)
        if held <= max(sizes):
            left = [n for k, n in enumerate(rest) if not mask >> k & 1]
            found.append(packing.sequence_cost(min(c for c in sizes if c >= held)) + least_cost(left, sizes))
    return min(found)


def test_packing_against_every_open_bin_and_all_divisions():
    rng = np.random.default_rng(9)
    ratios = []
    for case in range(150):
        lengths = sorted((int(n) for n in rng.integers(1, 2049 if case % 2 else 300, rng.integers(1, 8))), reverse=True)
        place, _, final = packing.pack_lengths(lengths)
        held = [tuple(n for n, b in zip(lengths, place) if b == k) for k in range(len(final))]
        assert sorted(zip(final, held)) == plain_pack(lengths)
        ratios.append(sum(map(packing.sequence_cost, final)) / least_cost(lengths, packing.CAPACITIES))
    assert min(ratios) >= 1 - 1e-9 and max(ratios) < 1.7 and sum(ratios) / len(ratios) < 1.1


def test_packing_query_equals_plain_packing_with_ties(spark):
    """Whole operator on one shard: ties, repeated rows, documents beyond the largest size, no words."""
    rng = np.random.default_rng(10)
    sizes = [*map(int, rng.integers(1, 900, 120)), *[300] * 40, 2048, 2049, 5000, 5000, 0]
    got = packing.pack(documents(spark, [(i % 150, "w " * n, "s") for i, n in enumerate(sizes)]).repartition(5)).collect()
    bins = {}
    for r in sorted((r for r in got if r["bin_id"] is not None), key=lambda r: r["offset"]):
        bins.setdefault((r["bin_id"], r["capacity"]), []).append(r["length"])
    pieces = sorted((min(2048, n - k) for n in sizes for k in range(0, n, 2048)), reverse=True)
    assert sorted((c, tuple(held)) for (_, c), held in bins.items()) == plain_pack(pieces)
    assert sum(r["bin_id"] is None for r in got) == 1


def test_packing_is_whole_and_fits(spark):
    rng = np.random.default_rng(6)
    rows = [(i, "w " * int(rng.integers(0, 700)), "s") for i in range(200)] + [(500, "w " * 5000, "s"), (500, "w " * 5000, "s"), (501, None, "s")]
    got = packing.pack(documents(spark, rows)).collect()
    words = Counter()
    for i, t, _ in rows:
        words[i] += len((t or "").split())
    held, bins = Counter(), {}
    for r in got:
        held[r["doc_id"]] += r["length"]
        if r["bin_id"] is not None:
            bins.setdefault(r["bin_id"], []).append((r["offset"], r["length"], r["capacity"]))
    assert {i: n for i, n in words.items() if n} == {i: n for i, n in held.items() if n} and {i for i, *_ in rows} == set(held)
    used = room = 0
    for parts in bins.values():
        parts.sort()
        assert all(parts[k][0] + parts[k][1] == parts[k + 1][0] for k in range(len(parts) - 1)) and parts[0][0] == 0
        size, capacity = parts[-1][0] + parts[-1][1], parts[0][2]
        assert capacity == min(c for c in packing.CAPACITIES if c >= size)
        used, room = used + size, room + capacity
    assert used / room > 0.95


def test_quality_learns_marks_and_repeats(spark):
    rng = np.random.default_rng(8)
    rows, labels = [], []
    for i in range(400):
        words = [f"{'abcdefgh'[x]}{'aeiou'[x % 5]}n" for x in rng.integers(0, 8, 40)]
        bad = i % 3 == 0
        rows.append((i, " ".join(w + "###" if bad and i % 2 else w.upper() + "!!" if bad else w for w in words), "s"))
        labels.append((i, int(not bad)))
    docs = documents(spark, rows)
    table = spark.createDataFrame(labels, "doc_id bigint, quality int")
    kept = quality.keep_good(docs, table)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, q in labels if q}


def test_toxicity_grades_rise_with_toxic_words(spark):
    rng = np.random.default_rng(9)
    rows, labels = [], []
    for i in range(600):
        words = [f"{'bcdfghkl'[x]}{'aeiou'[x % 5]}{'mnprst'[x % 6]}on" for x in rng.integers(0, 8, 30)]
        words[: i % 6 * (i % 5 == 0)] = ["idiot"] * (i % 6 * (i % 5 == 0))
        rows.append((i, " ".join(words) + f" extra{i % 7}idiot" * 0, "s"))
        labels.append((i, int("idiot" in rows[-1][1])))
    table = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    docs = documents(spark, rows)
    got = {r["doc_id"]: r["_at_least"] for r in toxicity.grade(docs, table, quality.checksum(table["doc_id"]) >= 0).collect()}
    assert {i for i, p in got.items() if p[0] >= 0.5} == {i for i, t in labels if t}
    assert all(p[0] >= p[1] >= p[2] for p in got.values())


@pytest.mark.parametrize("order", ["descending", "shuffled"])
def test_components_of_long_chains_take_few_rounds(spark, order):
    names = list(range(1000))[::-1]
    if order == "shuffled":
        np.random.default_rng(4).shuffle(names)
    edges = spark.createDataFrame([(int(a), int(b)) for a, b in zip(names, names[1:])], "a bigint, b bigint")
    rounds = []
    got = components.connected_components(edges, Scratch(spark, "t"), rounds).collect()
    assert len(got) == 1000 and {r["component"] for r in got} == {0} and len(rounds) <= 20


def test_components_of_random_graphs(spark):
    rng = np.random.default_rng(6)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (220, 2))]
    low = {i: i for e in edges for i in e}
    for _ in low:
        for a, b in edges:
            low[a] = low[b] = min(low[a], low[b])
    table = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r["id"]: r["component"] for r in components.connected_components(table, Scratch(spark, "t")).collect()}
    assert got == low


def test_toxicity_features_by_run_equal_plain_ones(monkeypatch):
    monkeypatch.setattr(toxicity, "RUN_CHARS", 40)
    texts = ["The cat, the cat sat.", None, "", "ab a \x00 été", "x" * 300, "the Dog (dog) cat"]
    rng = np.random.default_rng(1)
    weights = np.where(rng.random(toxicity.BUCKETS) < 0.5, rng.normal(size=toxicity.BUCKETS), 0.0)
    features = list(toxicity.document_features(texts, np.ones(toxicity.BUCKETS, bool)))
    totals = list(toxicity._Scores(weights).totals(texts))
    for text, (ids, counts), total in zip(texts, features, totals, strict=True):
        plain = Counter()
        for word in set(lower_words(text)):
            plain.update(set(toxicity.word_buckets([word])[1].tolist()))
        assert dict(zip(ids.tolist(), counts.tolist())) == plain
        assert total == pytest.approx(sum(weights[i] * n for i, n in plain.items()))


def test_lm_counts_written_in_parts_add_up(monkeypatch):
    """Workers don't see patched constants, so the streams are run here."""
    texts = [None, "", *[f"text {i % 7} of words {'long ' * (i % 50)}{'held' * (i % 10 == 8)}" for i in range(300)]]
    rows = pa.table({
        "block": pa.array([i * 3 // len(texts) for i in range(len(texts))], pa.int32()),
        "held_out": [i % 10 == 0 for i in range(len(texts))], "text": texts,
    }).sort_by([("block", "ascending"), ("held_out", "ascending")])

    def counted(rows_a_batch):
        got, written = Counter(), 0
        for out in lm_scoring._count_blocks(iter(rows.to_batches(max_chunksize=rows_a_batch)), 5):
            written += out.num_rows
            for block, kind, key, n in zip(*(c.to_pylist() for c in out.columns)):
                got[block, kind, key] += n
        return got, written

    whole, few = counted(1000)
    for name, value in (("MOST_KEYS", 50), ("WORD_CHARS", 400), ("CHUNK", 64), ("WRITTEN", 13)):
        monkeypatch.setattr(lm_scoring, name, value)
    parts, many = counted(7)
    assert parts == whole and parts.keys() == whole.keys() and many > few == len(whole)
    assert len({block for block, _, _ in whole}) == 3 and 0 in whole.values()


CLASHING = [
    "_id", "_sha", "_points", "_key", "_kept_id", "_kept_hash", "_copies", "_size", "_target", "_score", "_row", "row", "id", "text_hash",
    "_host", "_rule", "m", "k", "given", "col",
]


@pytest.mark.parametrize("operator", ["deduplicate", "keep_one", "mixed_rows", "keep_good", "judge"])
def test_columns_with_the_operators_own_names_pass_through(spark, operator):
    rows = [(i, f"word{i} and some other text number {i}", "s" if i % 2 else None, *[f"{c}{i}" for c in CLASHING]) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, " + ", ".join(f"`{c}` string" for c in CLASHING))
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id bigint, quality int")
    rules = spark.createDataFrame(list(url_filter.RULES), "host string, path string, verdict string")
    got = {
        "deduplicate": lambda: exact_dedup.deduplicate(docs), "keep_one": lambda: minhash_dedup.keep_one(docs),
        "mixed_rows": lambda: mixing.mixed_rows(docs), "keep_good": lambda: quality.keep_good(docs, labels),
        "judge": lambda: url_filter.judge(docs, rules, url_col="text"),
    }[operator]()
    names = [c for c in docs.columns if operator != "judge" or c not in ("_host", "_rule")]
    assert got.columns[:len(names)] == names and len(set(got.columns)) == len(got.columns)
    given = {r["doc_id"]: tuple(r[c] for c in names) for r in docs.collect()}
    out = got.select(*[f"`{c}`" for c in names]).collect()
    assert all(tuple(r) == given[r["doc_id"]] for r in out)
    assert out if operator != "keep_good" else True
    if operator in ("deduplicate", "keep_one", "judge"):
        assert len(out) == 12


def test_lm_holds_few_texts_and_one_copy_of_the_pairs(monkeypatch):
    """A batch of many short texts is worked off in pieces, and a block's pairs are let go before its tables are searched."""
    held, symbols = [], lm_scoring._symbols
    monkeypatch.setattr(lm_scoring, "_symbols", lambda texts, order: held.append(len(texts)) or symbols(texts, order))
    n, order = 3000, 2
    texts = [f"text number {i % 7}" for i in range(n)]
    learned = pa.RecordBatch.from_pydict({
        "block": pa.array([0] * n, pa.int32()), "held_out": pa.array([False] * n), "text": pa.array(texts),
    })
    rows = [r for b in lm_scoring._count_blocks(iter([learned]), order) for r in b.to_pylist()]
    stream = [(r["kind"], r["key"], float(r["n"]), None) for r in rows] + [(2, i, 0.0, t) for i, t in enumerate(texts)]
    spot, key, value, text = zip(*sorted(stream, key=lambda r: r[0]))
    batch = pa.RecordBatch.from_pydict({
        "spot": pa.array(spot, pa.int32()), "key": pa.array(key, pa.int64()), "value": pa.array(value, pa.float64()), "text": pa.array(text),
    })
    got = [r for b in lm_scoring._score_blocks(iter([batch]), order, 4 * n, 9) for r in b.to_pylist()]
    assert [r["id"] for r in got] == list(range(n)) and all(r["n_tokens"] == 4 for r in got)
    assert max(held) <= lm_scoring.TEXT_ROWS


def test_pairs_of_a_full_tile_take_little_memory():
    """All pairs of two sides of a tile that are near copies, each a component of its own."""
    rng, n, rule = np.random.default_rng(3), 2 * minhash_dedup.TILE, minhash_dedup.WIDER
    prefix = np.sort(rng.integers(0, 40, rule.prefix))
    tile = pd.DataFrame({
        "key": int(prefix[0]), "one": 0, "two": 1, "side": np.arange(n) % 2, "comp": np.arange(n), "n": 100,
        "sig": [np.arange(minhash_dedup.COORDINATES)] * n, "prefix": [prefix] * n,
    })
    tracemalloc.start()
    try:
        pairs = sum(len(i) for i, _ in minhash_dedup._candidates(tile, rule))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    print(f"peak {peak / 1e6:.0f} MB")
    assert pairs == (n // 2) ** 2
    assert peak < 36e6
