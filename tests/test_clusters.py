import math

import pytest
from pyspark.sql import functions as F

from orevein.operators import clusters as K, quality as Q, vectors as V

POINTS = {1: (1.0, 0.0), 2: (0.8, 0.6), 3: (0.6, 0.8), 4: (0.0, 1.0), 5: (1.0, 0.0)}


def vectors_of(spark, points):
    rows = [(i, d, float(w)) for i, p in points.items() for d, w in enumerate(p) if w]
    return spark.createDataFrame(rows, "id bigint, dim int, w double")


def seed_table(spark, ids):
    return spark.createDataFrame([(0, j, i) for j, i in enumerate(ids)], "trial int, k int, id bigint")


def state_of(spark, criterion):
    vectors = vectors_of(spark, POINTS)
    corpus = V.unit(V.total(vectors))
    return K.start(vectors, criterion, 2, range(1), seed_table(spark, (1, 4)), corpus)


def clusters(assigned):
    return {r["id"]: r["k_0"] for r in assigned.collect()}


def test_corpus_vector(spark):
    got = {r["dim"]: r["w"] for r in V.unit(V.total(vectors_of(spark, POINTS))).collect()}
    assert got[0] == pytest.approx(0.816968, abs=1e-6) and got[1] == pytest.approx(0.576683, abs=1e-6)


def test_first_pass_and_objectives(spark):
    state = state_of(spark, "I2")
    K.one_pass(state, [0])
    assert clusters(state.assigned) == {1: 0, 2: 0, 5: 0, 3: 1, 4: 1}
    wide = {r["dim"]: (r["c_0_0"], r["c_0_1"]) for r in state.wide.collect()}
    assert wide[0] == pytest.approx((2.8, 0.6)) and wide[1] == pytest.approx((0.6, 1.8))
    assert state.stats[0, 0].norm == pytest.approx(2.863564, abs=1e-6)
    stats = {j: s for (_, j), s in state.stats.items()}
    assert K.objective("I2", stats, 5) == pytest.approx(4.760931, abs=1e-6)
    assert K.objective("E1", stats, 5) == pytest.approx(4.369870, abs=1e-6)
    assert K.objective("SSE", stats, 5) == pytest.approx(0.466667, abs=1e-6)


def test_e1_changes(spark):
    """Deltas of staying in or joining a cluster, and the pass that follows from them."""
    state = state_of(spark, "I2")
    K.one_pass(state, [0])
    scored = K.dots(state.vectors, state.wide, list(state.stats)).join(state.assigned, "id")
    deltas = [K.separation(f"p_0_{j}", "p_total", state.stats[0, j], f"k_0 = {j}") + f" AS d{j}" for j in (0, 1)]
    got = {r["id"]: (round(r["d0"], 6), round(r["d1"], 6)) for r in scored.selectExpr("id", *deltas).collect()}
    assert got == {
        1: (0.844181, 1.310472), 2: (1.125059, 1.118444), 3: (1.141022, 1.034192),
        4: (1.222772, 0.659348), 5: (0.844181, 1.310472),
    }
    moved = K.assign(state.vectors, state.wide, state.stats, "E1", state.assigned)
    assert clusters(moved) == {1: 0, 5: 0, 2: 1, 3: 1, 4: 1}


def brute_force(points, seeds, k, passes):
    """Plain Lloyd passes for SSE, ties to the lowest cluster."""
    means = [points[i] for i in seeds]
    assigned = {}
    for _ in range(passes):
        dist = lambda p, m: round(sum((a - b) ** 2 for a, b in zip(p, m)), 9)
        assigned = {i: min(range(k), key=lambda j: (dist(p, means[j]), j)) for i, p in points.items()}
        for j in range(k):
            members = [points[i] for i, c in assigned.items() if c == j]
            if members:
                means[j] = tuple(sum(x) / len(members) for x in zip(*members))
    return assigned


def many_points(n=120, dims=4):
    points = {}
    for i in range(n):
        raw = [((i * 37 + d * 101 + i * i * (d + 1)) % 97) / 97 - 0.3 for d in range(dims)]
        norm = math.sqrt(sum(x * x for x in raw))
        points[i] = tuple(x / norm for x in raw)
    return points


def test_sse_equals_brute_force_and_never_rises(spark):
    points = many_points()
    vectors = vectors_of(spark, points)
    last = float("inf")
    for passes in (1, 2, 3):
        trial, = K.kmeans(vectors, 3, "SSE", max_iter=passes, seed=seed_table(spark, (0, 1, 2)), tol=0.0)
        assert {r["id"]: r["k"] for r in trial.assignment().collect()} == brute_force(points, (0, 1, 2), 3, passes)
        assert sum(trial.sizes.values()) == len(points)
        assert trial.objective <= last + 1e-9
        last = trial.objective


def test_trials_run_together_equal_single_runs(spark, monkeypatch):
    points = many_points(60)
    vectors = vectors_of(spark, points)
    together = K.kmeans(vectors, 3, "I2", trials=3, max_iter=6)
    monkeypatch.setattr(K, "MAX_SCORES", 3)  # one trial per batch
    single = K.kmeans(vectors, 3, "I2", trials=3, max_iter=6)
    for a, b in zip(together, single):
        assert (a.number, a.passes) == (b.number, b.passes)
        assert a.objective == pytest.approx(b.objective)
        assert sorted(map(tuple, a.assignment().collect())) == sorted(map(tuple, b.assignment().collect()))
    best = K.best_trial(together, "I2")
    assert best.objective == max(t.objective for t in together)


def test_e1_keeps_its_best_pass(spark):
    vectors = vectors_of(spark, many_points(60))
    last, = K.kmeans(vectors, 3, "E1", max_iter=4, keep="last", tol=0.0)
    best, = K.kmeans(vectors, 3, "E1", max_iter=4, tol=0.0)
    assert best.objective <= last.objective + 1e-9
    assert sum(best.sizes.values()) == 60


def test_empty_cluster_keeps_its_centroid(spark):
    # Equal seeds tie, so the second cluster stays empty and keeps the seed.
    vectors = vectors_of(spark, POINTS)
    trial, = K.kmeans(vectors, 2, "I2", max_iter=2, seed=seed_table(spark, (1, 5)), tol=0.0)
    assert trial.sizes[0] + trial.sizes[1] == 5


def test_documents_without_shared_dimension_score_zero(spark):
    vectors = spark.createDataFrame([(1, 0, 1.0), (2, 1, 1.0), (3, 2, 1.0)], "id bigint, dim int, w double")
    state = K.start(vectors, "I2", 2, range(1), seed_table(spark, (1, 2)), None)
    got = {r["id"]: (r["p_0_0"], r["p_0_1"]) for r in K.dots(vectors, state.wide, list(state.stats)).collect()}
    assert got == {1: (1.0, 0.0), 2: (0.0, 1.0), 3: (0.0, 0.0)}


def test_combine(spark):
    a = spark.createDataFrame([(0, 1.0), (1, 2.0)], "dim int, w double")
    b = spark.createDataFrame([(1, 3.0), (2, 4.0)], "dim int, w double")
    assert {r["dim"]: r["w"] for r in V.combine(a, 2, b, -1).collect()} == {0: 2.0, 1: 1.0, 2: -4.0}


def test_quality(spark):
    assigned = spark.createDataFrame([(i, 0) for i in range(4)] + [(i, 1) for i in (4, 5)], "id bigint, k int")
    topics = ["earn", "earn", "earn", "acq", "earn", "acq", "acq"]  # document 6 has no cluster
    classes = spark.createDataFrame(list(enumerate(topics)), "id bigint, topic string")
    per = {r["k"]: r for r in Q.purity_entropy(Q.contingency(assigned, classes)).collect()}
    assert (per[0]["purity"], per[1]["purity"]) == (0.75, 0.5)
    assert per[0]["entropy"] == pytest.approx(0.811278, abs=1e-6) and per[1]["entropy"] == pytest.approx(1.0)
    row = Q.global_quality(assigned, classes).first()
    assert row["purity"] == pytest.approx(0.666667, abs=1e-6)
    assert row["entropy"] == pytest.approx(0.874185, abs=1e-6)
    assert row["unmatched"] == 1
    table = Q.crosstab(Q.contingency(assigned, classes), ["earn", "acq", "none"]).orderBy("k").collect()
    assert [tuple(r) for r in table] == [(0, 3, 1, 0), (1, 1, 1, 0)]


def test_unit_length_of_arrays(spark):
    df = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0])], "id bigint, e array<double>")
    got = [(r["id"], r["dim"], round(r["w"], 6)) for r in V.from_arrays(df, "id", "e").orderBy("id", "dim").collect()]
    assert got == [(1, 0, 0.6), (1, 1, 0.8), (2, 0, 0.0), (2, 1, 0.0)]
    assert V.from_arrays(df, "id", "e").filter(F.isnan("w")).count() == 0


def test_trials_differ_and_the_best_wins(spark):
    vectors = vectors_of(spark, many_points())
    seeds = {}
    for r in K.seeds(vectors, 3, 12).collect():
        seeds.setdefault(r["trial"], set()).add(r["id"])
    assert len({frozenset(s) for s in seeds.values()}) >= 10
    gaps = [b - a for a, b in zip(sorted(seeds[0]), sorted(seeds[0])[1:])]
    assert len(set(gaps)) > 1 or len({frozenset(s) for s in seeds.values()}) > 1
    trials = K.kmeans(vectors, 3, "I2", trials=4, max_iter=3)
    values = [t.objective for t in trials]
    assert len({round(v, 6) for v in values}) > 1
    assert K.best_trial(trials, "I2").objective == max(values)


@pytest.mark.parametrize("passes", [1, 3])
def test_sse_of_vectors_of_any_length(spark, passes):
    points = {1: (3.0, 0.0), 2: (2.5, 0.5), 3: (0.0, 4.0), 4: (0.5, 3.0), 5: (0.0, 0.0), 6: (10.0, 10.0)}
    rows = [(i, d, float(w)) for i, p in points.items() for d, w in enumerate(p)]
    vectors = spark.createDataFrame(rows, "id bigint, dim int, w double")
    trial, = K.kmeans(vectors, 2, "SSE", max_iter=passes, tol=0.0, keep="last", seed=seed_table(spark, (1, 3)))
    got = {r["id"]: r["k"] for r in trial.assignment().collect()}
    assert got == brute_force(points, (1, 3), 2, passes)
    total = 0.0
    for j in (0, 1):
        members = [points[i] for i, c in got.items() if c == j]
        mean = [sum(x) / len(members) for x in zip(*members)]
        total += sum((a - b) ** 2 for p in members for a, b in zip(p, mean))
    assert trial.objective == pytest.approx(total)


def e1_by_hand(points, seeds, k, passes):
    """E1 in the way of the operator, over plain Python lists: proposals, thinner and thinner, until the objective falls."""
    import hashlib

    ids, dims = sorted(points), range(len(points[seeds[0]]))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    total = [sum(points[i][d] for i in ids) for d in dims]
    length = math.sqrt(dot(total, total))
    corpus = [x / length for x in total]
    cents = [(list(points[i]), 1) for i in seeds]
    place, best, history, start = {}, None, [], 0

    def rebuilt(place):
        out = []
        for j in range(k):
            mine = [i for i in ids if place[i] == j]
            out.append(([sum(points[i][d] for i in mine) for d in dims], len(mine)) if mine else cents[j])
        value = sum(n * dot(s, corpus) / math.sqrt(dot(s, s)) for j, (s, n) in enumerate(out) if any(place[i] == j for i in ids))
        return out, value

    def cost(i, j):
        s, n = cents[j]
        p, sd, norm2, pt = dot(points[i], s), dot(s, corpus), dot(s, s), dot(points[i], corpus)
        now = n * sd / math.sqrt(norm2)
        own = dot(points[i], points[i])
        if place.get(i) == j:
            left = math.sqrt(max(norm2 - 2 * p + own, 0))
            return now - ((n - 1) * (sd - pt) / left if n > 1 and left else 0)
        return (n + 1) * (sd + pt) / math.sqrt(norm2 + 2 * p + own) - now

    for number in range(passes):
        proposed = {i: min(range(k), key=lambda j: (round(cost(i, j), 9), j)) for i in ids}
        if best is None:
            place = proposed
            cents, best = rebuilt(place)
        else:
            order = {i: hashlib.md5(f"{number}:{i}".encode()).hexdigest() for i in ids}
            movers = [i for i in ids if proposed[i] != place[i]]
            done = False
            for level in [v for v in (0, 3, 6, 9, 12) if v >= start] + [None]:
                chosen = sorted(movers, key=order.get)[:1] if level is None else [i for i in movers if int(order[i][:8], 16) % 2**level == 0]
                trial = {i: proposed[i] if i in set(chosen) else place[i] for i in ids}
                after, value = rebuilt(trial)
                if value < best - 1e-12 * abs(best):
                    place, cents, best, done = trial, after, value, True
                    start = max(0, (12 if level is None else level) - 3)
                    break
            if not done:
                history.append(best)
                break
        history.append(best)
    return place, history


@pytest.mark.parametrize("n,k,passes", [(80, 3, 6), (12, 2, 4)])
def test_e1_passes_never_worsen_and_equal_brute_force(spark, n, k, passes):
    points = many_points(n)
    want, history = e1_by_hand(points, range(k), k, passes)
    assert all(b <= a + 1e-12 for a, b in zip(history, history[1:]))
    trial, = K.kmeans(vectors_of(spark, points), k, "E1", max_iter=passes, keep="last", tol=0.0, seed=seed_table(spark, range(k)))
    assert trial.objective == pytest.approx(history[-1], abs=1e-9)
    assert {r["id"]: r["k"] for r in trial.assignment().collect()} == want


def test_registered_fits_converge(spark, small):
    from orevein.plans import cluster_queries

    for name in ("clu_lloyd_sse", "clu_lloyd_i2"):
        row = cluster_queries.QUERIES[name](spark, small).agg(F.min("converged"), F.max("passes"), F.count("*")).first()
        assert row[0] and 1 < row[1] < cluster_queries.PASSES and row[2] > 0
