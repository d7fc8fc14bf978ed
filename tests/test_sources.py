import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from orevein import session
from orevein.operators import baskets as B, clusters as K, corpus as C, forests as R, rules, trees as T
from orevein.sources import readers, writers


def lines(path):
    return sorted(l for p in path.glob("part-*") for l in p.read_text().splitlines())


def test_transactions(spark, tmp_path):
    # Unsorted, with a repeated line; the last basket counts.
    (tmp_path / "t.txt").write_text("2 b\n1 a\n1 a\n2 a\n10 c\n")
    got = B.assemble_baskets(readers.transactions(spark, str(tmp_path))).orderBy("tid").collect()
    assert [(r["tid"], r["items"]) for r in got] == [(1, ["a"]), (2, ["a", "b"]), (10, ["c"])]


ARTICLE = '<REUTERS TOPICS="YES" NEWID="{0}">\n<TOPICS>{1}</TOPICS>\n<TEXT><BODY>{2}</BODY></TEXT>\n</REUTERS>\n'


def test_corpus(spark, tmp_path):
    deep = tmp_path / "a" / "b"
    deep.mkdir(parents=True)
    first = ARTICLE.format(1, "<D>earn</D>", "Profit &lt;up&gt;\nAT&amp;T") + ARTICLE.format(2, "<D>a</D><D>b</D>", "two")
    (deep / "x.sgm").write_bytes(b"<!DOCTYPE lewis>\n" + first.encode() + b"\n")
    second = ARTICLE.format(3, "<D>acq</D>", "caf\xe9 buy").encode("latin-1") + ARTICLE.format(4, "<D>acq</D>", "").encode()
    (tmp_path / "y.sgm").write_bytes(second)
    (tmp_path / "z.txt").write_text(ARTICLE.format(5, "<D>acq</D>", "no"))
    got = {r["doc_id"]: (r["topic"], r["text"]) for r in readers.corpus(spark, str(tmp_path)).collect()}
    assert got == {1: ("earn", "Profit <up>\nAT&T"), 3: ("acq", "caf buy")}


def test_stop_words(spark, tmp_path):
    (tmp_path / "stop.txt").write_text("a able \n about\n\na\n")
    assert {r["word"] for r in readers.stop_words(spark, str(tmp_path)).collect()} == {"a", "able", "about"}


def test_triplets_last_value_wins(spark, tmp_path):
    (tmp_path / "v.csv").write_text("1,2,0.5\n1,3,0.25\n1,2,0.75\n")
    assert sorted(tuple(r) for r in readers.triplets(spark, str(tmp_path)).collect()) == [(1, 2, 0.75), (1, 3, 0.25)]


def test_weights_vocabulary_and_classes(spark, tmp_path):
    counts = spark.createDataFrame([(1, 0, 1), (1, 1, 3), (2, 0, 2)], "doc_id bigint, stem_id bigint, n bigint")
    weights = C.weights_by_scheme(C.term_weights(counts))
    writers.weights(weights, str(tmp_path / "w"))
    for scheme in C.SCHEMES:
        back = readers.triplets(spark, str(tmp_path / "w" / f"scheme={scheme}"))
        want = {(r["doc_id"], r["stem_id"]): r["w"] for r in weights.filter(F.col("scheme") == scheme).collect()}
        assert {(r["id"], r["dim"]): r["w"] for r in back.collect()} == pytest.approx(want)
    vocab = spark.createDataFrame([(0, "oil", 9)], "stem_id bigint, stem string, freq bigint")
    writers.vocabulary(vocab, str(tmp_path / "v"))
    assert lines(tmp_path / "v") == ["0,oil"]
    classes = spark.createDataFrame([(7, 0, "earn")], "doc_id bigint, topic_id int, topic string")
    writers.class_map(classes, str(tmp_path / "c"))
    assert [tuple(r) for r in readers.class_map(spark, str(tmp_path / "c")).collect()] == [(7, "earn")]


def test_rule_and_itemset_files(spark, tmp_path):
    sets = spark.createDataFrame(
        [(["a"], 1, 4), (["b"], 1, 2), (["a", "b"], 2, 2)], "items array<string>, size int, freq bigint")
    writers.rules(rules.association_rules(sets, 0.4), str(tmp_path / "r"))
    writers.itemsets(sets, str(tmp_path / "i"))
    assert lines(tmp_path / "r") == ["a  | b  | 2 | 0.500000", "b  | a  | 2 | 1.000000"]
    assert lines(tmp_path / "i") == ["a b  |  {} | 2 | -1"]


def test_assignment_file(spark, tmp_path):
    vectors = spark.createDataFrame([(1, 0, 1.0), (2, 1, 1.0)], "id bigint, dim int, w double")
    trial, = K.kmeans(vectors, 2, "I2", max_iter=1)
    writers.assignment(trial.assignment(), str(tmp_path / "a"))
    assert [l.split(",")[0] for l in lines(tmp_path / "a")] == ["1", "2"]


def test_matrix_model_and_predictions(spark, tmp_path):
    text = "".join(f"{i % 2},{i % 2}.5,{i % 3}\n" for i in range(30))
    (tmp_path / "m.csv").write_text(text)
    rows = readers.labelled_matrix(spark, str(tmp_path / "m.csv"), 2)
    assert rows.agg(F.count_distinct("row_id")).first()[0] == 30
    model = T.fit(T.single_tree(rows), minfreq=5)
    writers.model(model, str(tmp_path / "model"))
    back = readers.model(spark, str(tmp_path / "model"))
    columns = ["tree", "node", "depth", "is_leaf", "a", "split", "label", "n"]
    key = lambda df: sorted(map(repr, (tuple(r) for r in df.select(*columns).collect())))
    assert key(back) == key(model)
    predicted = T.predict(back, T.single_tree(rows))
    assert predicted.filter("label <> pred").count() == 0
    writers.predictions(predicted, str(tmp_path / "p"))
    assert readers.predictions(spark, str(tmp_path / "p")).count() == 30


def test_votes_by_tree(spark, tmp_path):
    votes = spark.createDataFrame(
        [(0, 5, 5, 0), (0, 5, 4, 1), (0, 5, 5, 2)], "row_id bigint, label int, pred int, tree int")
    writers.tree_predictions(votes, str(tmp_path / "votes"))
    back = readers.tree_predictions(spark, str(tmp_path / "votes"))
    assert [tuple(r) for r in R.vote(back).collect()] == [(0, 5, 5)]


def test_package_archive_can_be_imported_elsewhere(spark, tmp_path):
    """Workers of a cluster import the package from the archive alone."""
    (tmp_path / "orevein.zip").write_bytes(session.package_archive())
    code = "import orevein.operators.vertical as v, orevein.session as s; print(v.__file__)"
    out = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True,
        env={**os.environ, "PYTHONPATH": os.pathsep.join([str(tmp_path / "orevein.zip"), *[p for p in sys.path if "site-packages" in p or "pyspark" in p]])},
    ).stdout
    assert "orevein.zip" in out
    session.ship_package(spark)  # one machine: nothing to send
    assert not session._shipped
