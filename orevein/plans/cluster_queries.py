"""Clustering queries over the unit-length ``embeddings``; classes are their labels."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from orevein.operators import clusters as K, quality as Q, vectors as V
from orevein.plans import text_queries
from orevein.plans.tables import table
from orevein.session import materialize

CLUSTERS = 5
TEXT_CLUSTERS = 4
PASSES = 100  # never reached by the given tables: fits end when the centroids move less than SHIFT_LIMIT
SQL_PASSES = 24  # passes that the SQL unrolls; a trial that has converged stays as it is
TEXT_SQL_PASSES = 4
E1_PASSES = 2
TRIALS = 2
TOPICS = list(range(10))  # labels of the given table, for the SQL only


def unit_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return V.from_arrays(table(spark, sf, "embeddings").select("vec_id", "embedding"), "vec_id", "embedding")


def classes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("topic"))


def _start(spark, sf, criterion="I2") -> K.Batch:
    vectors = unit_vectors(spark, sf)
    corpus = V.unit(V.total(vectors)) if criterion == "E1" else None
    return K.start(vectors, criterion, CLUSTERS, range(1), K.seeds(vectors, CLUSTERS), corpus)


def _first_pass(spark, sf, criterion="I2") -> K.Batch:
    state = _start(spark, sf, criterion)
    K.one_pass(state, [0])
    return state


def _per_cluster(state: K.Batch, value) -> DataFrame:
    """Long ``(vec_id, k, value)`` of one score per cluster."""
    scores = K.dots(state.vectors, state.wide, list(state.stats))
    values = ", ".join(f"round({value(f'p_{t}_{j}', s)}, 6)" for (t, j), s in state.stats.items())
    return scores.selectExpr("id AS vec_id", f"posexplode(array({values})) AS (k, value)")


def _long(state: K.Batch, mean: bool) -> DataFrame:
    """Centroids as ``(k, dim, w, n, norm)``."""
    cells = []
    for (t, j), s in state.stats.items():
        scale = float(s.n) if mean else 1.0
        cells.append(
            f"struct({j} AS k, round({K.centroid(t, j)} / {scale!r}D, 6) AS w, {s.n}L AS n, "
            f"round({s.norm / scale!r}D, 6) AS norm)"
        )
    return state.wide.selectExpr("dim", f"inline(array({', '.join(cells)}))").select("k", "dim", "w", "n", "norm")


def _assignment(df: DataFrame) -> DataFrame:
    return df.select(F.col("id").alias("vec_id"), "k")


def clu_sparse_vectors(spark, sf):
    return unit_vectors(spark, sf).select(F.col("id").alias("vec_id"), "dim", F.round("w", 6).alias("w"))


def clu_total_vector(spark, sf):
    return V.unit(V.total(unit_vectors(spark, sf))).select("dim", F.round("w", 6).alias("w"))


def clu_seeds(spark, sf):
    return K.seeds(unit_vectors(spark, sf), CLUSTERS, TRIALS).select("trial", "k", F.col("id").alias("vec_id"))


def clu_dot(spark, sf):
    return _per_cluster(_start(spark, sf), lambda p, s: p)


def clu_cosine(spark, sf):
    return _per_cluster(_start(spark, sf), K.cosine)


def clu_l2(spark, sf):
    return _per_cluster(_start(spark, sf), K.l2_similarity)


def clu_similarity(spark, sf):
    return _per_cluster(_first_pass(spark, sf), K.cosine)


def clu_vector_add(spark, sf):
    """The corpus total without cluster 0: total - composite."""
    state = _first_pass(spark, sf)
    rest = V.combine(
        V.total(state.vectors), 1.0, state.wide.select("dim", F.col(K.centroid(0, 0)).alias("w")), -1.0
    )
    return rest.select("dim", F.round("w", 6).alias("w"))


def _assign_query(criterion):
    def query(spark, sf):
        state = _start(spark, sf, criterion)
        assigned = K.assign(state.vectors, state.wide, state.stats, criterion)
        return assigned.select(F.col("id").alias("vec_id"), F.col("k_0").alias("k"))
    return query


def clu_composites(spark, sf):
    return _long(_first_pass(spark, sf, "I2"), mean=False)


def clu_means(spark, sf):
    return _long(_first_pass(spark, sf, "SSE"), mean=True)


def clu_centroid_shift(spark, sf):
    shifts = [(c, round(_first_pass(spark, sf, c).trials[0].shift, 6)) for c in K.CRITERIA]
    return spark.createDataFrame(shifts, "criterion string, shift double")


def _objective_query(criterion):
    def query(spark, sf):
        value = round(_first_pass(spark, sf, criterion).trials[0].objective, 6)
        return spark.createDataFrame([(value,)], "objective double")
    return query


def _lloyd_query(criterion):
    def query(spark, sf):
        trial, = K.kmeans(unit_vectors(spark, sf), CLUSTERS, criterion, max_iter=PASSES, keep="last")
        return _assignment(trial.assignment()).select(
            "vec_id", "k", F.lit(trial.passes).alias("passes"), F.lit(trial.converged).alias("converged")
        )
    return query


def clu_lloyd_e1(spark, sf):
    """Two plain passes: an E1 fit that improves to its end takes many short passes, see README."""
    trial, = K.kmeans(unit_vectors(spark, sf), CLUSTERS, "E1", max_iter=E1_PASSES, keep="last", improving=False)
    return _assignment(trial.assignment())


def clu_best_trial(spark, sf):
    trials = K.kmeans(unit_vectors(spark, sf), CLUSTERS, "I2", trials=TRIALS, max_iter=PASSES)
    best = K.best_trial(trials, "I2")
    return _assignment(best.assignment()).select(
        F.lit(best.number).alias("trial"), F.lit(round(best.objective, 6)).alias("objective"), "vec_id", "k"
    )


def _clustered(spark, sf) -> DataFrame:
    trial, = K.kmeans(unit_vectors(spark, sf), CLUSTERS, "I2", max_iter=PASSES, keep="last")
    return trial.assignment()


def _contingency(spark, sf) -> DataFrame:
    return Q.contingency(_clustered(spark, sf), classes(spark, sf))


def clu_contingency(spark, sf):
    return _contingency(spark, sf)


def clu_crosstab(spark, sf):
    counts = materialize(_contingency(spark, sf), "contingency")
    topics = [r["topic"] for r in counts.select("topic").distinct().orderBy("topic").collect()]  # one per class
    return Q.crosstab(counts, topics)


def clu_purity_entropy(spark, sf):
    return Q.purity_entropy(_contingency(spark, sf)).select(
        "k", "size", F.round("purity", 6).alias("purity"), F.round("entropy", 6).alias("entropy")
    )


def clu_quality_global(spark, sf):
    return Q.global_quality(_clustered(spark, sf), classes(spark, sf)).select(
        F.round("purity", 6).alias("purity"), F.round("entropy", 6).alias("entropy"), "unmatched"
    )


def _text_clusters(spark, sf) -> DataFrame:
    """The whole way from documents to clusters: sparse log2 weights, then I2 passes until they converge."""
    weights = text_queries.weights(spark, sf).select(F.col("doc_id").alias("id"), F.col("stem_id").alias("dim"), F.col("log2").alias("w"))
    trial, = K.kmeans(materialize(weights, "vectors"), TEXT_CLUSTERS, "I2", max_iter=PASSES, keep="last")
    return trial.assignment()


def clu_text_lloyd(spark, sf):
    return _text_clusters(spark, sf).select(F.col("id").alias("doc_id"), "k")


def clu_text_quality(spark, sf):
    topics = text_queries.documents(spark, sf).select(F.col("doc_id").alias("id"), "topic")
    return Q.global_quality(_text_clusters(spark, sf), topics).select(
        F.round("purity", 6).alias("purity"), F.round("entropy", 6).alias("entropy"), "unmatched"
    )


QUERIES = {
    f.__name__: f
    for f in (
        clu_text_lloyd, clu_text_quality, clu_sparse_vectors, clu_total_vector, clu_seeds, clu_dot, clu_cosine, clu_l2, clu_similarity,
        clu_vector_add, clu_composites, clu_means, clu_centroid_shift, clu_best_trial,
        clu_contingency, clu_crosstab, clu_purity_entropy, clu_quality_global,
    )
}
QUERIES |= {"clu_assign_i2": _assign_query("I2"), "clu_assign_e1": _assign_query("E1")}
QUERIES |= {f"clu_objective_{c.lower()}": _objective_query(c) for c in K.CRITERIA}
QUERIES |= {f"clu_lloyd_{c.lower()}": _lloyd_query(c) for c in ("SSE", "I2")} | {"clu_lloyd_e1": clu_lloyd_e1}

# ---------------------------------------------------------------- SQL counterparts

_DENSE = """
cells AS (SELECT vec_id AS id, unnest(range(len(embedding))) AS dim, CAST(unnest(embedding) AS DOUBLE) AS v
          FROM embeddings),
vec AS (SELECT id, CAST(dim AS INTEGER) AS dim, v / sqrt(sum(v * v) OVER (PARTITION BY id)) AS w FROM cells)
"""


def _vectors(vec: str, k: int) -> str:
    """CTEs that every pass needs, from the CTE ``vec(id, dim, w)``."""
    return f"""{vec},
docs AS MATERIALIZED (SELECT DISTINCT id FROM vec),
total AS (SELECT dim, sum(w) AS w FROM vec GROUP BY dim),
corpus AS (SELECT dim, w / (SELECT sqrt(sum(w * w)) FROM total) AS w FROM total),
seeds AS (
  SELECT trial, id, row_number() OVER (PARTITION BY trial ORDER BY
           md5(trial || ':' || id), id) - 1 AS k
  FROM docs, (SELECT unnest([0, 1]) AS trial) QUALIFY k < {k}),
cent0 AS (SELECT trial, k, dim, w FROM seeds JOIN vec USING (id)),
size0 AS (SELECT trial, k, 1 AS n FROM seeds),
member0 AS (SELECT trial, NULL AS id, NULL AS k FROM seeds LIMIT 0),
to_corpus AS (SELECT id, sum(vec.w * corpus.w) AS p_total FROM vec JOIN corpus USING (dim) GROUP BY id)
"""


_VECTORS = _vectors(_DENSE, CLUSTERS)

_COST = {
    "SSE": "1 - 2 * p / n + norm2 / (CAST(n AS DOUBLE) * n)",
    "I2": "-p / sqrt(norm2)",
    "E1": """CASE WHEN m.k = s.k
      THEN n * sd / sqrt(norm2)
           - CASE WHEN n > 1 THEN (n - 1) * (sd - p_total) / sqrt(norm2 - 2 * p + 1) ELSE 0 END
      ELSE (n + 1) * (sd + p_total) / sqrt(norm2 + 2 * p + 1) - n * sd / sqrt(norm2) END""",
}


def _pass(i: int, criterion: str) -> str:
    """CTEs of pass ``i``: stats and dots of the old centroids, new members, new centroids."""
    return f""",
stat{i} AS (SELECT c.trial, c.k, any_value(z.n) AS n, sum(c.w * c.w) AS norm2, sum(c.w * d.w) AS sd
            FROM cent{i} c JOIN corpus d USING (dim) JOIN size{i} z ON z.trial = c.trial AND z.k = c.k
            GROUP BY c.trial, c.k),
shared{i} AS (SELECT c.trial, v.id, c.k, sum(v.w * c.w) AS p FROM vec v JOIN cent{i} c USING (dim) GROUP BY ALL),
dot{i} AS (SELECT z.trial, d.id, z.k, coalesce(s.p, 0) AS p
           FROM size{i} z CROSS JOIN docs d LEFT JOIN shared{i} s ON s.trial = z.trial AND s.k = z.k AND s.id = d.id),
member{i + 1} AS (
  SELECT trial, id, k FROM (
    SELECT p.trial, p.id, s.k, row_number() OVER (PARTITION BY p.trial, p.id
             ORDER BY round({_COST[criterion]}, 9), s.k) AS rn
    FROM dot{i} p JOIN stat{i} s ON s.trial = p.trial AND s.k = p.k JOIN to_corpus t ON t.id = p.id
    LEFT JOIN member{i} m ON m.trial = p.trial AND m.id = p.id) WHERE rn = 1),
live{i + 1} AS (SELECT trial, k, count(*) AS n FROM member{i + 1} GROUP BY ALL),
cent{i + 1} AS (SELECT trial, k, dim, sum(w) AS w FROM member{i + 1} JOIN vec USING (id) GROUP BY ALL
                UNION ALL SELECT c.* FROM cent{i} c ANTI JOIN live{i + 1} USING (trial, k)),
size{i + 1} AS (SELECT * FROM live{i + 1} UNION ALL SELECT z.* FROM size{i} z ANTI JOIN live{i + 1} USING (trial, k))
"""


def _passes(criterion: str, n: int = 1, vectors: str = _VECTORS) -> str:
    return "WITH " + vectors + "".join(_pass(i, criterion) for i in range(n))


def _until(criterion: str, n: int, vectors: str = _VECTORS) -> str:
    """CTEs of a whole fit: ``n`` passes, of which those of a converged trial change nothing; ``fit(trial, passes, converged)``."""
    change = {
        "SSE": "sqrt(sum((coalesce(a.w, 0) / a.n - coalesce(b.w, 0) / b.n) * (coalesce(a.w, 0) / a.n - coalesce(b.w, 0) / b.n)))",
        "I2": "1 - sum(a.w * b.w) / (any_value(a.norm) * any_value(b.norm))",
    }[criterion]
    parts = ["WITH " + vectors + ", open0 AS (SELECT DISTINCT trial FROM seeds)"]
    for i in range(n):
        whole = _pass(i, criterion)
        whole = whole.replace(f"FROM cent{i} c JOIN corpus d USING (dim)", f"FROM (SELECT * FROM cent{i} SEMI JOIN open{i} USING (trial)) c JOIN corpus d USING (dim)")
        whole = whole.replace(f"FROM size{i} z CROSS JOIN docs d", f"FROM (SELECT * FROM size{i} SEMI JOIN open{i} USING (trial)) z CROSS JOIN docs d")
        whole = whole.replace(" WHERE rn = 1),", f" WHERE rn = 1 UNION ALL SELECT trial, id, k FROM member{i} ANTI JOIN open{i} USING (trial)),")
        parts.append(whole + f""",
placed{i} AS (SELECT c.*, z.n, sqrt(sum(c.w * c.w) OVER (PARTITION BY c.trial, c.k)) AS norm
              FROM cent{i} c JOIN size{i} z ON z.trial = c.trial AND z.k = c.k),
placed{i + 1}b AS (SELECT c.*, z.n, sqrt(sum(c.w * c.w) OVER (PARTITION BY c.trial, c.k)) AS norm
                   FROM cent{i + 1} c JOIN size{i + 1} z ON z.trial = c.trial AND z.k = c.k),
open{i + 1} AS (SELECT trial FROM (SELECT trial, k, {change} AS moved
                                   FROM placed{i + 1}b a JOIN placed{i} b USING (trial, k, dim) GROUP BY trial, k)
                SEMI JOIN open{i} USING (trial) GROUP BY trial HAVING avg(moved) >= {K.SHIFT_LIMIT})
""")
    passes = " UNION ALL ".join(f"SELECT trial, {i} AS i FROM open{i}" for i in range(n))
    parts.append(f""",
fit AS (SELECT trial, CAST(max(i) + 1 AS INTEGER) AS passes, trial NOT IN (SELECT trial FROM open{n}) AS converged
        FROM ({passes}) GROUP BY trial)
""")
    return re.sub(r" AS \(\s*SELECT", " AS MATERIALIZED (SELECT", "".join(parts))


_OBJECTIVE = {
    "SSE": """SELECT trial, sum((v.w - c.w / n) * (v.w - c.w / n)) AS objective
              FROM member1 JOIN vec v USING (id) JOIN cent1 c USING (trial, k, dim) JOIN size1 USING (trial, k)
              GROUP BY trial""",
    "I2": """SELECT trial, sum(norm) AS objective
             FROM (SELECT trial, k, sqrt(sum(w * w)) AS norm FROM cent1 SEMI JOIN live1 USING (trial, k) GROUP BY trial, k)
             GROUP BY trial""",
    "E1": """SELECT trial, sum(cosine) AS objective
             FROM (SELECT trial, k, any_value(n) * sum(c.w * d.w) / sqrt(sum(c.w * c.w)) AS cosine
                   FROM cent1 c JOIN corpus d USING (dim) JOIN live1 USING (trial, k) GROUP BY trial, k)
             GROUP BY trial""",
}
_SHIFT = {
    "SSE": """SELECT avg(change) AS shift FROM (
        SELECT k, sqrt(sum((a.w / n - b.w) * (a.w / n - b.w))) AS change
        FROM cent1 a JOIN cent0 b USING (trial, k, dim) JOIN size1 USING (trial, k) WHERE trial = 0 GROUP BY k)""",
}
_SHIFT["I2"] = _SHIFT["E1"] = """SELECT avg(change) AS shift FROM (
        SELECT k, 1 - sum(a.w * b.w) / sqrt(sum(a.w * a.w) * sum(b.w * b.w)) AS change
        FROM cent1 a JOIN cent0 b USING (trial, k, dim) WHERE trial = 0 GROUP BY k)"""

_FIT = {c: _until(c, SQL_PASSES) for c in ("SSE", "I2")}
_QUALITY = _FIT["I2"] + f""",
clustered AS (SELECT id, k FROM member{SQL_PASSES} WHERE trial = 0),
counts AS (SELECT k, label AS topic, count(*) AS n FROM clustered JOIN embeddings ON vec_id = id GROUP BY ALL),
shares AS (SELECT k, topic, n, n / CAST(sum(n) OVER (PARTITION BY k) AS DOUBLE) AS p FROM counts),
quality AS (SELECT k, CAST(sum(n) AS BIGINT) AS size, max(p) AS purity, -sum(p * log2(p)) AS entropy
            FROM shares GROUP BY k)
"""

_TEXT = _until("I2", TEXT_SQL_PASSES, _vectors(text_queries.TERMS_SQL + """,
vec AS MATERIALIZED (SELECT doc_id AS id, stem_id AS dim, l / nl AS w FROM raw JOIN norms USING (doc_id))
""", TEXT_CLUSTERS))

ORACLES = {
    "clu_text_lloyd": _TEXT + f"SELECT id AS doc_id, CAST(k AS INTEGER) AS k FROM member{TEXT_SQL_PASSES} WHERE trial = 0",
    "clu_text_quality": _TEXT + f""",
        counts AS (SELECT k, lang, count(*) AS n FROM member{TEXT_SQL_PASSES} JOIN documents ON doc_id = id WHERE trial = 0 GROUP BY ALL),
        shares AS (SELECT k, n, n / CAST(sum(n) OVER (PARTITION BY k) AS DOUBLE) AS p FROM counts),
        quality AS (SELECT k, sum(n) AS size, max(p) AS purity, -sum(p * log2(p)) AS entropy FROM shares GROUP BY k)
        SELECT round(sum(size * purity) / sum(size), 6) AS purity, round(sum(size * entropy) / sum(size), 6) AS entropy,
               (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT id FROM docs)) AS unmatched
        FROM quality""",
    "clu_sparse_vectors": f"WITH {_VECTORS} SELECT id AS vec_id, dim, round(w, 6) AS w FROM vec",
    "clu_total_vector": f"WITH {_VECTORS} SELECT dim, round(w, 6) AS w FROM corpus",
    "clu_seeds": f"WITH {_VECTORS} SELECT CAST(trial AS INTEGER) AS trial, CAST(k AS INTEGER) AS k, id AS vec_id FROM seeds",
    "clu_dot": _passes("I2") + " SELECT id AS vec_id, CAST(k AS INTEGER) AS k, round(p, 6) AS value "
                               "FROM dot0 WHERE trial = 0",
    "clu_cosine": _passes("I2") + """
        SELECT v.id AS vec_id, CAST(k AS INTEGER) AS k,
               round(sum(v.w * c.w) / (sqrt(sum(v.w * v.w)) * sqrt(sum(c.w * c.w))), 6) AS value
        FROM vec v JOIN cent0 c USING (dim) WHERE trial = 0 GROUP BY v.id, k""",
    "clu_l2": _passes("I2") + """
        SELECT v.id AS vec_id, CAST(k AS INTEGER) AS k,
               -round(CASE WHEN sum((v.w - c.w) * (v.w - c.w)) < 1e-14 THEN 0
                           ELSE sqrt(sum((v.w - c.w) * (v.w - c.w))) END, 6) AS value
        FROM vec v JOIN cent0 c USING (dim) WHERE trial = 0 GROUP BY v.id, k""",
    "clu_similarity": _passes("I2") + """
        SELECT v.id AS vec_id, CAST(k AS INTEGER) AS k, round(sum(v.w * c.w) / sqrt(sum(c.w * c.w)), 6) AS value
        FROM vec v JOIN cent1 c USING (dim) WHERE trial = 0 GROUP BY v.id, k""",
    "clu_vector_add": _passes("I2") + """
        SELECT dim, round(total.w - c.w, 6) AS w FROM total JOIN cent1 c USING (dim) WHERE trial = 0 AND k = 0""",
    "clu_composites": _passes("I2") + """
        SELECT CAST(k AS INTEGER) AS k, dim, round(w, 6) AS w, n,
               round(sqrt(sum(w * w) OVER (PARTITION BY k)), 6) AS norm
        FROM cent1 JOIN size1 USING (trial, k) WHERE trial = 0""",
    "clu_means": _passes("SSE") + """
        SELECT CAST(k AS INTEGER) AS k, dim, round(w / n, 6) AS w, n,
               round(sqrt(sum(w / n * w / n) OVER (PARTITION BY k)), 6) AS norm
        FROM cent1 JOIN size1 USING (trial, k) WHERE trial = 0""",
    "clu_centroid_shift": " UNION ALL ".join(
        f"SELECT '{c}' AS criterion, round(shift, 6) AS shift FROM ({_passes(c)} {_SHIFT[c]})" for c in K.CRITERIA
    ),
    "clu_best_trial": _FIT["I2"] + f""",
        scores AS ({_OBJECTIVE['I2'].replace('cent1', f'cent{SQL_PASSES}').replace('live1', f'live{SQL_PASSES}')}),
        best AS (SELECT trial, objective FROM scores ORDER BY objective DESC, trial LIMIT 1)
        SELECT CAST(trial AS INTEGER) AS trial, round(objective, 6) AS objective, id AS vec_id, CAST(k AS INTEGER) AS k
        FROM best JOIN member{SQL_PASSES} USING (trial)""",
    "clu_contingency": _QUALITY + "SELECT CAST(k AS INTEGER) AS k, topic, n FROM counts",
    "clu_crosstab": _QUALITY + "SELECT CAST(k AS INTEGER) AS k, " + ", ".join(
        f"CAST(coalesce(sum(n) FILTER (WHERE topic = {t}), 0) AS BIGINT) AS t{t}" for t in TOPICS
    ) + " FROM counts GROUP BY k",
    "clu_purity_entropy": _QUALITY + """
        SELECT CAST(k AS INTEGER) AS k, size, round(purity, 6) AS purity, round(entropy, 6) AS entropy FROM quality""",
    "clu_quality_global": _QUALITY + """
        SELECT round(sum(size * purity) / sum(size), 6) AS purity, round(sum(size * entropy) / sum(size), 6) AS entropy,
               (SELECT count(*) FROM embeddings WHERE vec_id NOT IN (SELECT id FROM clustered)) AS unmatched
        FROM quality""",
    "clu_assign_i2": _passes("I2") + "SELECT id AS vec_id, CAST(k AS INTEGER) AS k FROM member1 WHERE trial = 0",
    "clu_assign_e1": _passes("E1") + "SELECT id AS vec_id, CAST(k AS INTEGER) AS k FROM member1 WHERE trial = 0",
}
ORACLES |= {
    f"clu_objective_{c.lower()}":
        _passes(c) + f"SELECT round(objective, 6) AS objective FROM ({_OBJECTIVE[c]}) WHERE trial = 0"
    for c in K.CRITERIA
}
ORACLES |= {
    f"clu_lloyd_{c.lower()}":
        _FIT[c] + f"SELECT id AS vec_id, CAST(k AS INTEGER) AS k, passes, converged FROM member{SQL_PASSES} JOIN fit USING (trial) WHERE trial = 0"
    for c in ("SSE", "I2")
}
ORACLES["clu_lloyd_e1"] = (
    _passes("E1", E1_PASSES) + f"SELECT id AS vec_id, CAST(k AS INTEGER) AS k FROM member{E1_PASSES} WHERE trial = 0"
)
