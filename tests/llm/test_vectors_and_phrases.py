"""Whitening, collocations and top-k search against plain versions on small odd tables."""

import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orevein.llm import collocations as C, topk_search as K, whitening as W

SCHEMA = "vec_id bigint, embedding array<float>, n int, x string, list string"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, 7, "x", None) for i, v in rows], SCHEMA)


def random_vectors(n, width, seed):
    rnd = np.random.default_rng(seed)
    return [(i, [float(np.float32(v)) for v in rnd.normal(size=width) * np.linspace(3, 0.2, width)]) for i in range(n)]


ODD = [
    (900, None), (901, [1.0, None, 2.0]), (902, [float("nan")] * 3), (903, [float("inf"), 0.0, 0.0]),
]


# ------------------------------------------------------------------------------ whitening


def whitened_by_solver(rows, components):
    """All of the contract with exact integers and a dense solver."""
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    width = max(len(v) for _, v in good)
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v + [0.0] * (width - len(v))] for _, v in good])
    listed = np.unique(x, axis=0)
    n, sums = len(listed), listed.sum(axis=0)
    centred = (n * listed - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    size = min(components, int((values > 1e-9 * values[0]).sum()))
    white = (n * x - sums) / n @ vectors[:, :size] / np.sqrt(values[:size])
    return [i for i, _ in good], n, ((n * x - sums) ** 2).sum(axis=1), white, values[:size] / values.sum()


@pytest.mark.parametrize("n,width,components", [(300, 40, 16), (60, 3, 16), (80, 24, 5)])
def test_whitening_equals_a_dense_solver(spark, n, width, components):
    rows = random_vectors(n, width, n)
    rows += [(n + i, rows[3][1]) for i in range(40)] + [(5, rows[8][1])] + ODD
    got = W.whiten(vectors_of(spark, rows), components=components).toPandas()
    ids, size, deviations, white, shares = whitened_by_solver(rows, components)
    assert len(got) == len(ids) * white.shape[1] and set(got["n"]) == {size}
    assert got["identity_error"].nunique() == 1 and got["identity_error"][0] < 1e-9
    for c in range(white.shape[1]):
        mine = got[got.component == c + 1]
        assert mine["explained"].iloc[0] == pytest.approx(shares[c], rel=1e-9)
        key = sorted(zip(mine["id"], mine["deviation"], mine["whitened"]))
        want = sorted(zip(ids, deviations, white[:, c]))
        assert [k[:2] for k in key] == [k[:2] for k in want]
        # One sign for all rows; rows of one id may come in either order.
        a, b = np.sort([k[2] for k in key]), np.sort([k[2] for k in want])
        assert np.allclose(a, b, atol=1e-8) or np.allclose(a, np.sort(-b), atol=1e-8)


def test_whitening_of_few_directions_and_of_none(spark):
    flat = [(i, [float(i % 5), float(i % 3), 0.0, float(i % 5)]) for i in range(30)]
    got = W.whiten(vectors_of(spark, flat)).toPandas()
    assert set(got.component) == {1, 2} and got.identity_error[0] < 1e-9 and len(got) == 60
    assert W.whiten(vectors_of(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert W.whiten(vectors_of(spark, [])).count() == 0
    assert W.whiten(vectors_of(spark, [(1, None), (2, [])])).count() == 0


def test_whitening_null_ids_and_huge_components(spark):
    rows = [(None, [1e30, 1.0]), (1, [0.0, 2.0]), (1, [3.0, -1.0])]
    got = W.whiten(vectors_of(spark, rows)).toPandas()
    assert len(got) == 3 * got.component.nunique()
    assert got.whitened.notna().all() and got.deviation.isna().all()  # sums of squares beyond a long
    assert W._deviations(np.array([[2**40, 5]]), 3, np.array([7, 1]), np.array([1.0, 2.0])) == [None]
    assert W._deviations(np.array([[9, 5]]), 3, np.array([7, 1]), np.array([1.0, 2.0])) == [5**2 + 10**2]


@pytest.mark.parametrize("spread", [1.0, 1e-2, 1e-7])
def test_subspace_iteration_on_steep_and_flat_spectra(spread):
    rnd = np.random.default_rng(3)
    basis = np.linalg.qr(rnd.normal(size=(90, 90)))[0]
    values = np.geomspace(1, spread, 90) * (1 + rnd.random(90) / 100)
    v = (basis * values) @ basis.T
    found, vectors, passes, residual = W.leading_pairs(lambda q: v @ q, 90, 16)
    assert np.allclose(found, np.sort(values)[::-1][:16], rtol=1e-9) and residual <= W.ROUNDING
    assert np.allclose(vectors.T @ vectors, np.eye(16), atol=1e-12) and passes < 400


# --------------------------------------------------------------------------- top-k search


def searched_by_all_pairs(rows, k, scale=1024):
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for q, (i, v) in enumerate(good):
        if i is None or i % 100:
            continue
        x = [int(np.floor(scale * c)) for c in v]
        scores = [
            (-sum(a * int(np.floor(scale * b)) for a, b in zip(x, w)), j is None, j or 0, j)
            for r, (j, w) in enumerate(good) if r != q
        ]
        scores.sort()
        out += [(i, r + 1, j, -s) for r, (s, _, _, j) in enumerate(scores[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block,asking", [(65536, 4096), (7, 2)])
def test_top_k_equals_all_pairs(spark, monkeypatch, block, asking):
    monkeypatch.setattr(K, "BLOCK", block)
    monkeypatch.setattr(K, "ASKING", asking)
    rnd = np.random.default_rng(block)
    rows = [(i * 10, [float(np.float32(v)) for v in rnd.normal(size=6)]) for i in range(60)]
    rows += [(5000 + i * 50, rows[10][1]) for i in range(30)]  # a hot vector, asked and asking
    rows += [(200, rows[20][1]), (200, rows[20][1]), (200, rows[7][1]), (None, rows[20][1]), (None, [0.0] * 6)]
    rows += [(7000, [0.0] * 6), (7001, [1.0, 2.0]), (7100, [])] + ODD
    got = K.top_k(vectors_of(spark, rows), F.col("id") % 100 == 0, k=4)
    assert sorted(map(tuple, got.collect()), key=repr) == searched_by_all_pairs(rows, 4)


def test_top_k_of_few_rows(spark):
    search = lambda rows: sorted(map(tuple, K.top_k(vectors_of(spark, rows), F.col("id") % 100 == 0).collect()))
    assert search([]) == [] and search([(100, [1.0])]) == [] and search([(100, None), (200, [])]) == []
    assert search([(100, [1.0]), (3, [-0.5])]) == [(100, 1, 3, -1024 * 512)]
    assert search([(0, [1e30]), (1, [1e30]), (2, [-1e30])]) == [(0, 1, 1, 2**63 - 1), (0, 2, 2, -(2**63) + 1)]


def test_bounds_skip_pairs_but_lose_none():
    rnd = np.random.default_rng(9)
    rows = np.floor(rnd.normal(size=(5000, 16)) * rnd.lognormal(0, 1, size=(5000, 1)) * 1000).astype(np.int64)
    rows = rows[np.argsort(-np.linalg.norm(rows, axis=1))]
    asked = rows[rnd.integers(0, 5000, 40)]
    rotation = np.linalg.eigh((rows.T @ rows).astype(float))[1][:, ::-1]
    best = K.search_block(asked, np.full(40, K.NO_SCORE), rows, np.arange(5000), rotation, 11)
    scores = asked @ rows.T
    order = np.lexsort((np.broadcast_to(np.arange(5000), scores.shape), -scores), axis=1)[:, :11]
    assert (best.place == order).all() and (best.score == np.take_along_axis(scores, order, axis=1)).all()


@pytest.mark.parametrize("scale", [1000, 2**40])
def test_search_of_a_block_holds_few_pairs(scale):
    """No lower bound yet and all lengths alike: every pair of the first strip is left, but not all at once."""
    rnd = np.random.default_rng(4)
    rows = rnd.normal(size=(2048, 32))
    rows = np.floor(rows / np.linalg.norm(rows, axis=1)[:, None] * scale).astype(np.int64)
    rows = rows[np.argsort(-np.linalg.norm(rows.astype(float), axis=1), kind="stable")]
    asked = rows[rnd.integers(0, 2048, 1024 if scale == 1000 else 64)]
    tracemalloc.start()
    best = K.search_block(asked, np.full(len(asked), K.NO_SCORE), rows, np.arange(2048), np.eye(32), 5)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    scores = (asked.astype(object) @ rows.T.astype(object) if scale > 1000 else asked @ rows.T)
    scores = np.array([[min(max(s, K.NO_SCORE + 1), 2**63 - 1) for s in r] for r in scores.tolist()], dtype=np.int64)
    order = np.lexsort((np.broadcast_to(np.arange(2048), scores.shape), ~scores), axis=1)[:, :5]
    assert (best.place == order).all() and (best.score == np.take_along_axis(scores, order, axis=1)).all()
    assert most < 100e6


# --------------------------------------------------------------------------- collocations


def phrases_by_counting(docs, least, covered, top):
    counts, totals = {}, {}
    for text, lang in docs:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] = totals.get(lang, 0) + len(words)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    key = lang, tuple(words[i:i + n])
                    counts[key] = counts.get(key, 0) + 1
    out = {}
    for (lang, w), a in counts.items():
        if len(w) < 2 or a < least:
            continue
        holds = [f for (m, v), f in counts.items() if m == lang and f >= least and len(v) > len(w)
                 and any(v[i:i + len(w)] == w for i in range(len(v) - len(w) + 1))]
        if any(100 * f >= covered * a for f in holds):
            continue
        cuts = [(2_000_000 * a // (counts[lang, w[:k]] + counts[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), counts[lang, w[:k]], counts[lang, w[k:]]))
    rows = []
    for lang, found in out.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            rows.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(rows)


def odd_documents(seed, n=120):
    rnd = random.Random(seed)
    words = ["a", "b", "A", "c", "é", "ß x", "d\x00", "(e)", "\x1f", "long" * 30]
    docs = []
    for _ in range(n):
        text = "".join(rnd.choice(words[:rnd.choice((3, 10))]) + rnd.choice((" ", " ", "  ", "\t", ", ", ".", "\n", "\x0b ", " ; ")) for _ in range(rnd.randrange(40)))
        docs.append((text, rnd.choice(("de", "en", None, "und"))))
    return docs + [(None, "de"), ("", "en"), (" \t\n", None), ("a b " * 500, "en"), ("a b c", "fr")] + docs[:20]


@pytest.mark.parametrize("least,covered,top", [(2, 80, 2000), (5, 30, 7)])
def test_collocations_equal_plain_counting(spark, least, covered, top):
    docs = odd_documents(least)
    table = spark.createDataFrame([(t, l, 1, "x", 2) for t, l in docs], "text string, lang string, words int, phrase string, n int")
    got = C.collocations(table.repartition(3), least=least, covered=covered, top=top)
    assert sorted(map(tuple, got.collect())) == phrases_by_counting(docs, least, covered, top)


def test_collocations_of_nothing(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert C.collocations(empty).count() == 0
    rare = spark.createDataFrame([("one two three", "en"), (None, None)], "text string, lang string")
    assert C.collocations(rare).count() == 0


def test_blocks_are_cut_between_pieces(monkeypatch):
    """Counts do not depend on how texts fall into blocks; a piece longer than a block stays whole."""
    docs = odd_documents(4)
    def counted():
        batch = pa.RecordBatch.from_arrays(
            [pa.array([l or "und" for _, l in docs]), pa.array([None if t is None else t.encode() for t, _ in docs], pa.binary())], ["lang", "text"])
        found = {}
        ones = np.full(C.BITS // 32, 0xFFFFFFFF, np.uint32)
        for run in (C._single, lambda b: C._pairs(b, ones), lambda b: C._longer(b, ones)):
            for part in run(iter([batch.slice(0, 50), batch.slice(50)])):
                for r in part.to_pylist():
                    key = r["lang"], r["words"], r["phrase"]
                    found[key] = found.get(key, 0) + r["f"]
        return found
    whole = counted()
    monkeypatch.setattr(C, "BLOCK", 50)
    assert counted() == whole and max(len(p) for _, _, p in whole) > 100
