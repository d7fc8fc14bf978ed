import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orevein.operators import evaluate as E, forests as R, trees as T
from orevein.plans import tree_queries


def rows_of(spark, rows, first=0):
    data = [(first + i, label, [float(x) for x in features]) for i, (label, features) in enumerate(rows)]
    return spark.createDataFrame(data, "row_id bigint, label int, features array<double>")


def table_of(model):
    """Nodes by path: (attribute, split) or the leaf's label."""
    return {
        r["node"]: ("leaf", r["label"], r["n"]) if r["is_leaf"] else (r["a"], r["split"], r["n"]) for r in model.collect()
    }


def gini(parts):
    total = sum(len(p) for p in parts)
    return sum(len(p) - sum(p.count(c) ** 2 for c in set(p)) / len(p) for p in parts) / total


def grow(rows, minfreq, used=frozenset(), node="T", out=None):
    """Straightforward recursive tree over all boundaries, as the independent answer."""
    out = {} if out is None else out
    labels = [label for label, _ in rows]
    width = len(rows[0][1])
    majority = min(set(labels), key=lambda c: (-labels.count(c), c))
    best = None
    if len(rows) >= minfreq and len(set(labels)) > 1:
        for a in range(width):
            if a in used:
                continue
            for v in sorted({f[a] for _, f in rows})[1:]:
                left = [label for label, f in rows if f[a] < v]
                right = [label for label, f in rows if f[a] >= v]
                score = (round(gini([left, right]), 12), a, v)
                best = score if best is None or score < best else best
    if best is None:
        out[node] = ("leaf", majority, len(rows))
        return out
    _, a, v = best
    out[node] = (a, v, len(rows))
    grow([r for r in rows if r[1][a] < v], minfreq, used | {a}, node + "L", out)
    grow([r for r in rows if r[1][a] >= v], minfreq, used | {a}, node + "R", out)
    return out


def random_rows(n, width, values, seed):
    rnd = random.Random(seed)
    return [(rnd.randrange(4), tuple(rnd.randrange(values) for _ in range(width))) for _ in range(n)]


def walk(nodes, features):
    node = "T"
    while nodes[node][0] != "leaf":
        a, split, _ = nodes[node]
        node += "L" if features[a] < split else "R"
    return nodes[node][1]


@pytest.fixture(scope="module")
def sample():
    return random_rows(150, 5, 6, 1)


def unused(rows):
    return frozenset(a for a in range(len(rows[0][1])) if max(f[a] for _, f in rows) <= 0)


def test_tree_equals_brute_force(spark, sample):
    model = T.fit(T.single_tree(rows_of(spark, sample)), minfreq=10)
    assert table_of(model) == grow(sample, 10, unused(sample))


def test_value_ranges_give_the_same_tree(spark, sample):
    model = T.fit(T.single_tree(rows_of(spark, sample)), minfreq=10, scan_rows=20)
    assert table_of(model) == grow(sample, 10, unused(sample))


def test_prediction_follows_the_model(spark, sample):
    rows = T.single_tree(rows_of(spark, sample))
    model = T.fit(rows, minfreq=10)
    nodes = table_of(model)
    got = {r["row_id"]: r["pred"] for r in T.predict(model, rows).collect()}
    assert got == {i: walk(nodes, f) for i, (_, f) in enumerate(sample)}
    leaves = [n for kind, _, n in nodes.values() if kind == "leaf"]
    assert sum(leaves) == len(sample)


def test_prediction_of_a_deep_tree(spark):
    """A chain deeper than the levels between two rewrites."""
    width = 12
    rows = [(i % 10, tuple(1 if a == i else 0 for a in range(width))) for i in range(width)] * 3
    frame = T.single_tree(rows_of(spark, rows))
    model = T.fit(frame, minfreq=2)
    nodes = table_of(model)
    assert nodes == grow(rows, 2) and max(len(n) for n in nodes) > 9
    got = {r["row_id"]: r["pred"] for r in T.predict(model, frame).collect()}
    assert got == {i: walk(nodes, f) for i, (_, f) in enumerate(rows)}


def test_dropped_column_and_split_value(spark):
    rows = [(1, (0, 1)), (1, (0, 2)), (0, (0, 2)), (0, (0, 2)), (2, (0, 3)), (2, (0, 3))]
    frame = T.single_tree(rows_of(spark, rows))
    assert [tuple(r) for r in T.kept_columns(frame).select("a", "orig_a").collect()] == [(0, 1)]
    at_root = T.at_root(T.with_ranges(frame, None))
    found = {r["v"]: r["gini"] for r in T.split_candidates(T.running_counts(T.value_counts(at_root))).collect()}
    assert found == {2.0: pytest.approx(0.533333, abs=1e-6), 3.0: pytest.approx(0.333333, abs=1e-6)}
    assert table_of(T.fit(frame, minfreq=2, max_depth=1))["T"] == (1, 3.0, 6)


def test_boundary_after_a_pure_value(spark):
    rows = [(1, (1,))] + [(0, (2,))] * 6 + [(0, (3,))] + [(1, (3,))] * 4
    model = T.fit(T.single_tree(rows_of(spark, rows)), minfreq=2, max_depth=1)
    top = model.filter("node = 'T'").first()
    assert (top["split"], round(top["gini"], 6)) == (3.0, 0.276190)


def test_constant_node_becomes_a_leaf(spark):
    model = T.fit(T.single_tree(rows_of(spark, [(4, (1, 1)), (2, (1, 1))])), minfreq=2)
    assert table_of(model) == {"T": ("leaf", 2, 2)}


def test_pure_root_is_a_leaf(spark):
    model = T.fit(T.single_tree(rows_of(spark, [(3, (1,)), (3, (2,))])), minfreq=2)
    assert table_of(model) == {"T": ("leaf", 3, 2)}


def test_forest_equals_single_trees_of_its_samples(spark, sample):
    rows = rows_of(spark, sample)
    drawn = R.samples(rows, 3)
    model = R.fit(rows, 3, minfreq=8)
    got = {}
    for r in model.collect():
        got.setdefault(r["tree"], {})[r["node"]] = (
            ("leaf", r["label"], r["n"]) if r["is_leaf"] else (r["a"], r["split"], r["n"]))
    for tree in range(3):
        mine = [sample[r["row_id"]] for r in drawn.filter(F.col("tree") == tree).collect() for _ in range(r["m"])]
        assert len(mine) == int(0.4 * len(sample))
        assert got[tree] == grow(mine, 8, unused(mine))
    votes = R.votes(model, rows, 3)
    assert votes.count() == 3 * len(sample)
    for r in votes.collect():
        assert r["pred"] == walk(got[r["tree"]], sample[r["row_id"]][1])


def test_draws_repeat_some_rows(spark, sample):
    drawn = R.samples(rows_of(spark, sample), 5)
    assert drawn.agg(F.max("m")).first()[0] > 1


def test_vote_ties_go_to_the_lowest_class(spark):
    ballots = [(0, 1, 3), (0, 1, 1), (0, 1, 1), (1, 0, 9), (1, 0, 2), (1, 0, 5)]
    df = spark.createDataFrame(ballots, "row_id bigint, label int, pred int")
    assert sorted(tuple(r) for r in R.vote(df).collect()) == [(0, 1, 1), (1, 0, 2)]


def test_confusion_and_accuracy(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (2, 0)], "label int, pred int")
    cells = {(r["label"], r["pred"]): r["n"] for r in E.confusion(df).collect()}
    assert len(cells) == 100 and sum(cells.values()) == 5
    assert {k: n for k, n in cells.items() if n} == {(0, 0): 1, (0, 1): 1, (1, 1): 2, (2, 0): 1}
    assert tuple(E.accuracy(df).first()) == (5, 0.6)
    pivot = {r["label"]: [r[f"c{c}"] for c in range(10)] for r in E.confusion_table(df).collect()}
    assert pivot[1] == [0, 2, 0, 0, 0, 0, 0, 0, 0, 0] and len(pivot) == 10


def test_columns_of_test_rows_follow_training(spark):
    rows = rows_of(spark, [(0, (5, 6, 7))])
    assert T.apply_columns(rows, [2, 0]).first()["features"] == [7.0, 5.0]


@pytest.mark.parametrize("scan_rows", [2_000_000, 4])
@pytest.mark.parametrize("missing", [None, float("nan")])
def test_missing_values_go_left_everywhere(spark, missing, scan_rows):
    data = [(i, 0, [missing, 1.0]) for i in range(4)] + [(4 + i, 1, [2.0 + i, 1.0]) for i in range(4)]
    rows = T.single_tree(spark.createDataFrame(data, "row_id bigint, label int, features array<double>"))
    model = T.fit(rows, minfreq=2, scan_rows=scan_rows)
    assert {r["n"] for r in model.filter("depth = 1").collect()} == {4}
    assert all(r["pred"] == r["label"] for r in T.predict(model, rows).collect())


def test_unknown_labels_are_refused_and_more_classes_work(spark):
    data = [(i, 12 if i % 2 else 1, [float(i % 2)]) for i in range(60)]
    rows = T.single_tree(spark.createDataFrame(data, "row_id bigint, label int, features array<double>"))
    with pytest.raises(ValueError):
        T.fit(rows, minfreq=2)
    found = T.predict(T.fit(rows, minfreq=2, classes=13), rows)
    assert E.accuracy(found).first()["accuracy"] == 1.0
    assert E.confusion(found).agg(F.sum("n")).first()[0] == 60
    ballots = found.select("row_id", "label", "pred").withColumn("tree", F.lit(0))
    assert R.vote(ballots).filter("pred = label").count() == 60


def test_full_depth_query_sees_small_values(spark, tmp_path):
    rnd = random.Random(5)
    rows = [(i % 3, (rnd.random() / 4, 0.1 + i % 3 / 10, rnd.random())) for i in range(90)]
    data = [(i, label, [float(x) for x in features]) for i, (label, features) in enumerate(rows)]
    spark.createDataFrame(data, "vec_id bigint, label int, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert table_of(tree_queries.dt_model(spark, str(tmp_path))) == grow(rows, tree_queries.MIN_FREQ)


@pytest.mark.parametrize("batch", [1, 3, 7, 1000])
def test_bins_are_scanned_alike_however_they_are_batched(batch):
    """Candidates and open bins do not depend on where a batch ends; a bound is never above what its bin holds."""
    rnd = random.Random(batch)
    rows = [
        (t, n, a, b, b * 4, b * 4 + rnd.randrange(2), float(b), [rnd.randrange(4) for _ in range(3)])
        for t in (0, 1) for n in ("T", "TL") for a in (0, 2, 5) for b in sorted(rnd.sample(range(8), 5))
    ]
    names = ["tree", "node", "a", "bin", "low", "high", "v", "counts"]
    table = pa.Table.from_pylist([dict(zip(names, r)) for r in rows])
    found = {}
    for part in T._scan_bins(iter(table.to_batches(max_chunksize=batch)), 3):
        for r in part.to_pylist():
            if not r["open"]:
                key, value = (r["tree"], r["node"]), (r["gini"], r["a"], r["split"], r["lh"], r["rh"])
                found[key] = min(value, found.get(key, value))
    for t in (0, 1):
        for n in ("T", "TL"):
            best = None
            for a in (0, 2, 5):
                mine = [r for r in rows if r[:3] == (t, n, a)]
                for i, r in enumerate(mine):
                    left = [sum(x) for x in zip(*[q[7] for q in mine[:i]])] or [0, 0, 0]
                    right = [sum(x) for x in zip(*[q[7] for q in mine[i:]])]
                    if sum(left):
                        nl, nr = float(sum(left)), float(sum(right))
                        sides = ((nl - sum(c * c for c in left) / nl) + (nr - sum(c * c for c in right) / nr)) / (nl + nr) if nr else None
                        if sides is not None:
                            value = (sides, a, r[6], left, right)
                            best = value if best is None or value < best else best
            assert found[t, n][1:] == best[1:] and found[t, n][0] == pytest.approx(best[0], rel=1e-12)


def test_many_values_need_several_steps(spark):
    """Two digits of four bins each: splits are found by refining bins, ties and repeated values included."""
    rnd = random.Random(8)
    rows = [(rnd.randrange(3), (rnd.random(), round(rnd.random(), 1), rnd.choice((0.0, 1e30, -5.0)))) for _ in range(200)]
    frame = T.single_tree(rows_of(spark, rows))
    assert T.with_ranges(frame, 4).first()["bits"] == 8
    assert table_of(T.fit(frame, minfreq=15, scan_rows=4, reduce=False)) == grow(rows, 15)


def test_compiled_walk_equals_lookups(spark, sample):
    rows = T.single_tree(rows_of(spark, sample))
    model = R.fit(rows_of(spark, sample), 2, minfreq=8)
    both = rows.unionByName(rows.withColumn("tree", F.lit(1)))
    arrays = sorted(map(tuple, T.predict(model, both).collect()))
    assert arrays == sorted(map(tuple, T.predict(model, both, most_nodes=3).collect()))
    assert arrays == sorted(map(tuple, R.votes(model, rows_of(spark, sample), 2).collect()))
    assert T.compiled(model, 3) is None


def test_walk_over_odd_feature_arrays(spark):
    data = [(i, i % 2, [float(i % 2), 3.0]) for i in range(40)]
    schema = "row_id bigint, label int, features array<double>"
    model = T.fit(T.single_tree(spark.createDataFrame(data, schema)), minfreq=2)
    odd = [(1, 0, None), (2, 0, []), (3, 0, [None, 1.0]), (4, 0, [float("nan")]), (5, 1, [1.0, None, 9.0]), (None, 1, [7.0])]
    rows = T.single_tree(spark.createDataFrame(odd, schema)).withColumn("tree", F.lit(0))
    got = {r["row_id"]: r["pred"] for r in T.predict(model, rows).collect()}
    assert got == {1: 0, 2: 0, 3: 0, 4: 0, 5: 1, None: 1}
    assert got == {r["row_id"]: r["pred"] for r in T.predict_by_lookup(model, rows).collect()}
    nothing = T.predict(model, rows.withColumn("tree", F.lit(9)))
    assert {r["pred"] for r in nothing.collect()} == {None}
    assert T.predict(model, rows.limit(0)).count() == 0


def jobs_of(spark, run):
    spark.sparkContext.setJobGroup(name := f"counted-{random.random()}", "counted")
    try:
        out = run()
    finally:
        spark.sparkContext.setJobGroup("others", "not counted")
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_a_deep_tree_takes_few_jobs(spark):
    """Every level cuts off a little, so there are as many levels as attributes; only large nodes cost jobs per level."""
    width = 12
    rows = [(i % 10, tuple(1 if a == i else 0 for a in range(width))) for i in range(width)] * 3
    frame = T.single_tree(rows_of(spark, rows))
    want = grow(rows, 2)
    model, jobs = jobs_of(spark, lambda: T.fit(frame, minfreq=2))
    assert table_of(model) == want and max(len(n) for n in want) > 9
    assert jobs <= 40
    model, more = jobs_of(spark, lambda: T.fit(frame, minfreq=2, scan_rows=8))
    assert table_of(model) == want
    assert more <= jobs + 7 * 8


def odd_rows(n, seed):
    """Missing values, short and missing arrays, infinite and frequent values, both zeros."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        f = [rnd.choice([None, float("nan"), 0.0, -0.0, 1.0, rnd.random(), float("-inf"), float("inf")]), rnd.random(), float(rnd.randrange(3)), -rnd.random()]
        f = None if rnd.random() < 0.04 else f[:rnd.randrange(4)] if rnd.random() < 0.15 else f
        rows.append((i, rnd.randrange(3) if rnd.random() < 0.6 or not f or len(f) < 2 else int(f[1] * 4), f))
    return rows


def nodes_of(model):
    return sorted((tuple(map(repr, (r["tree"], r["node"], r["a"], r["label"], r["n"], r["hist"], (r["split"] or 0) + 0.0, r["gini"]))) for r in model.collect()))


def test_odd_rows_give_the_same_tree_by_levels_and_by_subtrees(spark):
    """One step of ``find_splits`` is the independent answer for the root."""
    rows = spark.createDataFrame(odd_rows(300, 3), "row_id bigint, label int, features array<double>")
    frame = T.single_tree(rows)
    whole, levels = T.fit(frame, 10, reduce=False), T.fit(frame, 10, reduce=False, scan_rows=40)
    assert nodes_of(whole) == nodes_of(levels) and whole.count() > 9
    step = T.find_splits(T.at_root(T.with_ranges(frame))).first()
    top = whole.filter("node = 'T'").first()
    assert [top[c] for c in ("a", "split", "gini")] == [step[c] for c in ("a", "split", "gini")]
    assert top["hist"] == [x + y for x, y in zip(step["lh"], step["rh"])]
    forests = [nodes_of(R.fit(rows, 3, 10, scan_rows=n)) for n in (None, 25)]
    assert forests[0] == forests[1]
    two = [nodes_of(T.fit(frame, 10, max_depth=2, scan_rows=n)) for n in (None, 25)]
    assert two[0] == two[1] and max(len(r[1]) for r in two[0]) == 5


@pytest.mark.parametrize("rows", [1, 4, 100])
def test_rows_of_a_key_stay_together(rows):
    keys = [0, 0, 1, 1, 1, 1, 1, 2, 3, 3]
    batches = pa.table({"k": keys, "x": list(range(10)), "y": keys}).to_batches(max_chunksize=2)
    parts = list(T._gathered(iter(batches), rows, ("k", "x"), "k"))
    assert [x for p in parts for x in p["x"].to_pylist()] == list(range(10)) and parts[0].column_names == ["k", "x"]
    found = [set(p["k"].to_pylist()) for p in parts]
    assert sum(map(len, found)) == len(set(keys))


def test_frequent_values_are_counted_before_they_move():
    """One value of half of the rows is one record cell per task, node and class."""
    n = 4000
    x = [[1.0 if i % 2 else float(i % 8)] for i in range(n)]
    table = pa.table({"at": [0] * n, "label": pa.array([i % 2 for i in range(n)], pa.int32()), "features": x, "m": [1] * n})
    top = T._Top()
    top.add()
    nodes = np.array([0, -1])
    packed = list(T._pack(iter(table.to_batches()), top.arrays(), nodes, np.ones((1, 1), bool), [np.array([2.0])], 2))
    cells = {p: len(np.frombuffer(v, np.float64)) for p, v in zip(packed[0]["part"].to_pylist(), packed[0]["v"].to_pylist())}
    assert cells == {-2: 0, 0: 2, 1: 3}
    found = next(T._scan_ranges(iter(packed), 1, 2)).to_pylist()
    assert [(r["a"], r["split"], r["lh"], r["rh"]) for r in found] == [(0, 2.0, [500, 2000], [1500, 0])]


@pytest.mark.parametrize("name", ["dt_predict", "eval_accuracy", "eval_confusion", "eval_confusion_pivot", "forest_votes", "forest_vote"])
def test_queries_of_deep_trees_take_few_jobs(spark, tmp_path, name):
    """A chain of levels, each with one value of its own: jobs do not grow with the levels."""
    rows = [(i, i % 10, [1.0 if a == i % 12 else 0.0 for a in range(12)]) for i in range(240)]
    spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    found, jobs = jobs_of(spark, lambda: tree_queries.QUERIES[name](spark, str(tmp_path)).collect())
    assert jobs <= 60
    right = {"dt_predict": 240, "eval_accuracy": 1, "eval_confusion": 100, "eval_confusion_pivot": 10, "forest_votes": 720, "forest_vote": 240}
    assert len(found) == right[name]
    if name == "dt_predict":
        used = [dict(enumerate(f)) for _, _, f in rows]
        nodes = grow([(label, tuple(f)) for _, label, f in rows], tree_queries.MIN_FREQ)
        assert {r["row_id"]: r["pred"] for r in found} == {i: walk(nodes, f) for (i, _, _), f in zip(rows, used)}
