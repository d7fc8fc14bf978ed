import contextlib
import io
import math
import re

import pytest
from pyspark.sql import functions as F

from orevein.functions import text as T
from orevein.operators import corpus as C
from orevein.plans import text_queries

# Published examples of the stemming rules and of the later departures.
STEMS = """
caresses caress|ponies poni|ties tie|cats cat|feed feed|agreed agre|plastered plaster|bled bled|motoring motor
sing sing|conflated conflat|troubled troubl|sized size|hopping hop|tanned tan|falling fall|hissing hiss|fizzed fizz
failing fail|filing file|happy happi|sky sky|skies sky|relational relat|conditional condit|rational ration
valenci valenc|hesitanci hesit|digitizer digit|conformabli conform|radicalli radic|differentli differ|vileli vile
analogousli analog|vietnamization vietnam|predication predic|operator oper|feudalism feudal|decisiveness decis
hopefulness hope|callousness callous|formaliti formal|sensitiviti sensit|sensibiliti sensibl|triplicate triplic
formative form|formalize formal|electriciti electr|electrical electr|hopeful hope|goodness good|revival reviv
allowance allow|inference infer|airliner airlin|gyroscopic gyroscop|adjustable adjust|defensible defens|irritant irrit
replacement replac|adjustment adjust|dependent depend|adoption adopt|communism commun|activate activ|angulariti angular
homologous homolog|effective effect|bowdlerize bowdler|probate probat|rate rate|cease ceas|controll control|roll roll
dies die|died die|tried tri|cries cri|say say|enjoy enjoy|dying die|news news|geology geolog|by by|yes ye|toy toy
sses ss|running run|traders trader|prices price|x9 x9|1980s 1980|proceed proceed|generalization gener
"""


def test_stems(spark):
    words = [w.split() for line in STEMS.split("\n") for w in line.split("|") if w.strip()]
    df = spark.createDataFrame(words, "token string, want string")
    wrong = [(r["token"], r["want"], r["stem"]) for r in T.with_stem(df, "token").collect() if r["stem"] != r["want"]]
    assert wrong == []


def test_tokens_and_stop_words(spark):
    docs = spark.createDataFrame([(1, "Café prices rose 12% -- U.S. traders' running x9")], "doc_id bigint, text string")
    counts = C.drop_stop_words(C.token_counts(docs), C.default_stop_words(spark))
    assert {r["token"] for r in counts.collect()} == {"caf", "prices", "rose", "traders", "running", "x9"}
    assert {r["stem"] for r in C.stem_counts(counts).collect()} == {"caf", "price", "rose", "trader", "run", "x9"}


def test_weights(spark):
    counts = spark.createDataFrame([(1, i, n) for i, n in enumerate((1, 2, 4))], "doc_id bigint, stem_id bigint, n bigint")
    rows = C.term_weights(counts).orderBy("stem_id").collect()
    wanted = {
        "freq": (0.218218, 0.436436, 0.872872), "sqrt": (0.460917, 0.556376, 0.691376), "log2": (0.267261, 0.534522, 0.801784),
    }
    for scheme, values in wanted.items():
        assert [round(r[scheme], 6) for r in rows] == list(values)


@pytest.fixture(scope="module")
def prepared(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", F.col("lang").alias("topic"), "text")
    return docs, C.text_vectors(docs, top=2)


def test_vectors_have_unit_length(prepared):
    _, (weights, _, _) = prepared
    for scheme in C.SCHEMES:
        worst = weights.groupBy("doc_id").agg(F.sum(F.col(scheme) ** 2).alias("s")).agg(F.max(F.abs(F.col("s") - 1))).first()[0]
        assert worst < 1e-9


def test_only_top_topics_stay(prepared):
    docs, (weights, vocab, classes) = prepared
    top = {r["topic"] for r in C.top_topics(docs, "topic", 2).collect()}
    assert len(top) == 2
    assert {r["topic"] for r in classes.select("topic").distinct().collect()} == top
    assert weights.join(classes, "doc_id", "left_anti").count() == 0
    assert vocab.agg(F.min("freq")).first()[0] >= 5
    n = vocab.count()
    assert vocab.agg(F.min("stem_id"), F.max("stem_id"), F.count_distinct("stem_id")).first() == (0, n - 1, n)


def test_top_topics_break_ties_by_name(spark):
    docs = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "topic string")
    assert [tuple(r) for r in C.top_topics(docs, "topic", 2).orderBy("topic_id").collect()] == [(0, "c", 2), (1, "a", 1)]


def test_pages(spark):
    page = '<html lang="en"><body><article><h1>A &amp;amp; B</h1><p>x<!-- no --></p><script>if(a<b){}</script>y</article></body></html>'
    rows = [(1, page), (2, page.replace("<article>", "<h1>2nd</h1><article>")), (3, "<html lang='x'><h1>t</h1></html>")]
    got = C.extract_pages(spark.createDataFrame(rows, "page_id bigint, html string")).collect()
    assert [(r["page_id"], r["topic"], r["title"], r["body"]) for r in got] == [(1, "en", "A &amp; B", "A &amp; B x y")]


def test_log_weight_formula():
    assert math.isclose(1 + math.log2(4), 3.0)


def test_stem_steps_fit_into_compiled_methods(spark):
    """The JVM interprets generated methods of more than 8000 bytes, at several times the CPU time."""
    docs = spark.createDataFrame([(1, "prices rose")], "doc_id bigint, text string")
    terms = C.stem_counts(C.drop_stop_words(C.token_counts(docs), C.default_stop_words(spark)))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with contextlib.redirect_stdout(io.StringIO()) as plan:
            terms.explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", plan.getvalue())]
    assert sizes and max(sizes) < 8000


def _rows_of_tasks(df):
    return [n for n in df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n]


def test_tasks_stay_small_as_documents_grow(spark, monkeypatch):
    monkeypatch.setattr(C, "TASK_CHARS", 1 << 10)
    monkeypatch.setattr(C, "TASK_TERMS", 1 << 8)
    text = " ".join(f"w{i}" for i in range(50))
    worst = {}
    for n in (200, 1600):
        docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("en").alias("topic"), F.lit(text).alias("text"))
        worst[n] = max(_rows_of_tasks(C.token_counts(docs)))
        weights, _, _ = C.text_vectors(docs)
        assert weights.count() == 50 * n
        assert max(_rows_of_tasks(weights)) < 50 * n / 8
    assert worst[1600] < 3 * worst[200]


def test_repeated_and_missing_ids_are_counted_together(spark):
    docs = spark.createDataFrame([(1, "ab cd"), (1, "ab"), (None, "ab"), (None, "ab"), (2, None)], "doc_id bigint, text string")
    assert {tuple(r) for r in C.token_counts(docs).collect()} == {(1, "ab", 2), (1, "cd", 1), (None, "ab", 2)}


def _plan(df):
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        df.explain()
    return plan.getvalue()


@pytest.mark.parametrize(("broadcast", "task", "join"), [(10, 10, "BroadcastHashJoin"), (2, 10, "ShuffledHashJoin"), (2, 1, "ShuffledHashJoin")])
def test_vocabulary_is_looked_up_without_sorting_the_terms(spark, monkeypatch, broadcast, task, join):
    """Sorting all terms by stem took memory of a task that grew with the documents."""
    monkeypatch.setattr(C, "BROADCAST_STEMS", broadcast, raising=False)
    monkeypatch.setattr(C, "TASK_STEMS", task, raising=False)
    terms = spark.createDataFrame(
        [(1, "a", 2), (1, "b", 1), (None, "a", 3), (2, "rare", 1), (2, None, 1), (3, "c", 1), (3, "c", 1)],
        "doc_id bigint, stem string, n bigint",
    )
    vocab = spark.createDataFrame([(i, s, 9) for i, s in enumerate("abcdefghi")], "stem_id bigint, stem string, freq bigint")
    kept = {x: spark.conf.get(x) for x in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        found = C.doc_terms(terms, vocab)
        plan, rows = _plan(found), [tuple(r) for r in found.collect()]
    finally:
        for x, value in kept.items():
            spark.conf.set(x, value)
    assert sorted(rows, key=str) == sorted([(1, 0, 2), (1, 1, 1), (None, 0, 3), (3, 2, 1), (3, 2, 1)], key=str)
    assert join in plan and "SortMergeJoin" not in plan
    if task == 1:  # nine stems, one a task
        assert re.findall(r"hashpartitioning\(stem#\d+, (\d+)\)", plan) == ["9", "9"]


@pytest.mark.parametrize("name", ["text_top_terms", "text_weights_all", "text_weights_log2", "text_weights_sqrt"])
def test_queries_on_terms_do_not_sort_them_by_stem(spark, monkeypatch, tmp_path, name):
    """A vocabulary too large to broadcast gives the same rows, and no sort of all terms by stem."""
    rows = [(i, " ".join(f"price{chr(97 + (i * k) % 9)} trade" for k in range(12)), "en" if i % 3 else None) for i in range(20)]
    rows += [(20, None, "en"), (20, "trade trade", "en"), (None, "trade rare", "en")]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    small = [tuple(r) for r in text_queries.QUERIES[name](spark, str(tmp_path)).collect()]
    monkeypatch.setattr(C, "BROADCAST_STEMS", 2, raising=False)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = text_queries.QUERIES[name](spark, str(tmp_path))
        plan, large = _plan(found), [tuple(r) for r in found.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert small and sorted(large, key=str) == sorted(small, key=str)
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_lookups_of_a_task_do_not_grow_with_the_terms(spark, monkeypatch, tmp_path):
    """The terms were dealt by stem into a fixed number of tasks, and the shuffle by document held all rows of one."""
    words = "transform(sequence(0, 4), k -> concat('q', (id * 5 + k) % 200, 'x'))"  # each of 200 words 40 times
    docs = spark.range(1600).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.expr(f"concat_ws(' ', {words})").alias("text"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    wanted = sorted(tuple(r) for r in text_queries.text_doc_term(spark, str(tmp_path)).collect())
    monkeypatch.setattr(C, "BROADCAST_STEMS", 4)
    monkeypatch.setattr(C, "TASK_LOOKUPS", 1 << 8, raising=False)
    found = text_queries.text_doc_term(spark, str(tmp_path))
    assert len(wanted) == 8000 and sorted(tuple(r) for r in found.collect()) == wanted
    assert max(_rows_of_tasks(found)) < 3 << 8
    weights, vocab, _ = C.text_vectors(docs.withColumnRenamed("lang", "topic"))
    assert re.findall(r"hashpartitioning\(stem#\d+, (\d+)\)", _plan(weights)) == ["32", "32"]
    assert weights.count() == 8000 and vocab.count() == 200
