"""Text queries over ``documents`` (topic = language) and ``pages``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from orevein.functions import text as T
from orevein.operators import corpus as C
from orevein.plans.tables import table

MIN_COUNT = 5
TOP_TOPICS = 20
TOP_TERMS = 10


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.col("lang").alias("topic"), "text")


def _tokens(spark, sf) -> DataFrame:
    return C.token_counts(documents(spark, sf))


def _filtered(spark, sf) -> DataFrame:
    return C.drop_stop_words(_tokens(spark, sf), C.default_stop_words(spark))


def weights(spark, sf) -> DataFrame:
    return C.text_vectors(documents(spark, sf), min_count=MIN_COUNT, top=TOP_TOPICS)[0]


def _doc_terms(spark, sf) -> tuple[DataFrame, int]:
    """Terms of the documents, and the number of rows before rare terms are left out."""
    terms = C.materialize(C.stem_counts(_filtered(spark, sf)), "terms")
    rows = terms.count()
    return C.doc_terms(terms, C.vocabulary(terms, MIN_COUNT), rows), rows


def text_extract_pages(spark, sf):
    pages = C.extract_pages(table(spark, sf, "pages").select("page_id", "html"))
    return pages.select("page_id", "topic", "title", F.length("body").alias("body_chars"))


def text_tokens(spark, sf):
    return _tokens(spark, sf)


def text_stopword_filter(spark, sf):
    return _filtered(spark, sf)


def text_stems(spark, sf):
    return T.with_stem(_tokens(spark, sf).select("token").distinct(), "token")


def text_top_topics(spark, sf):
    return C.top_topics(table(spark, sf, "part"), "p_brand", TOP_TOPICS)


def text_class_map(spark, sf):
    docs = documents(spark, sf)
    return C.class_map(docs, C.top_topics(docs, "topic", TOP_TOPICS))


def text_vocabulary(spark, sf):
    return C.vocabulary(C.stem_counts(_filtered(spark, sf)), MIN_COUNT)


def text_doc_term(spark, sf):
    return _doc_terms(spark, sf)[0]


def text_top_terms(spark, sf):
    counts, rows = _doc_terms(spark, sf)
    return C.top_terms(counts, TOP_TERMS, rows)


def _scheme(name):
    def query(spark, sf):
        return weights(spark, sf).select("doc_id", "stem_id", F.round(name, 6).alias("w"))
    return query


def text_weights_all(spark, sf):
    return C.weights_by_scheme(weights(spark, sf)).withColumn("w", F.round("w", 6))


QUERIES = {
    f.__name__: f
    for f in (
        text_extract_pages, text_tokens, text_stopword_filter, text_stems, text_top_topics,
        text_class_map, text_vocabulary, text_doc_term, text_top_terms, text_weights_all,
    )
} | {f"text_weights_{s}": _scheme(s) for s in C.SCHEMES}

# ---------------------------------------------------------------- SQL counterparts

_STOP = ", ".join(f"('{w}')" for w in T.STOP_WORDS)

_TOKENS = r"""
words AS (SELECT doc_id, unnest(string_split(regexp_replace(lower(
              regexp_replace(text, '[^\x00-\x7F]', '', 'g')), '[^a-z0-9]+', ' ', 'g'), ' ')) AS token
          FROM documents),
tokens AS (SELECT doc_id, token, count(*) AS n FROM words
           WHERE token <> '' AND NOT regexp_full_match(token, '[0-9]+') GROUP BY ALL)
"""
_FILTERED = _TOKENS + f""",
stop(word) AS (VALUES {_STOP}),
filtered AS (SELECT * FROM tokens WHERE token NOT IN (SELECT word FROM stop))
"""


def _sql_case(pairs: dict[str, str], column: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items()) + " END"


def _stem_sql(source: str) -> str:
    """CTEs that turn the table ``source(token)`` into ``stems(token, stem)``."""
    measured, vowel = T.MEASURE_OVER_0, T.HAS_VOWEL

    def has(expr, pattern):
        return f"regexp_matches({expr}, '{pattern}')"

    def left(n):
        return f"left(w, length(w) - {n})"

    def swap(pairs):
        pattern = f"^(.*?)({'|'.join(pairs)})$"
        head, tail = (f"regexp_extract(w, '{pattern}', {g})" for g in (1, 2))
        return f"CASE WHEN {tail} <> '' AND {has(head, measured)} THEN {head} || {_sql_case(pairs, tail)} ELSE w END"

    drop = f"^(.*?)({'|'.join(T.STEP_4)}|ion)$"
    head, tail = (f"regexp_extract(w, '{drop}', {g})" for g in (1, 2))
    steps = [
        f"""CASE WHEN {has('w', '^.ies$')} THEN {left(1)} WHEN {has('w', '(sses|ies)$')} THEN {left(2)}
            WHEN {has('w', '[^s]s$')} THEN {left(1)} ELSE w END""",
        f"""CASE WHEN {has('w', '^.ied$')} THEN {left(1)} WHEN {has('w', 'ied$')} THEN {left(2)}
            WHEN {has('w', 'eed$')} THEN CASE WHEN {has(left(3), measured)} THEN {left(1)} ELSE w END
            WHEN {has('w', 'ed$')} AND {has(left(2), vowel)} THEN {left(2)} || '+'
            WHEN {has('w', 'ing$')} AND {has(left(3), vowel)} THEN {left(3)} || '+' ELSE w END""",
        f"""CASE WHEN NOT {has('w', '[+]$')} THEN w WHEN {has('w', '(at|bl|iz)[+]$')} THEN {left(1)} || 'e'
            WHEN length(w) > 2 AND w[-2] = w[-3] AND {has('w', '[^aeiou][+]$')}
                 THEN CASE WHEN {has('w', '[lsz][+]$')} THEN {left(1)} ELSE {left(2)} END
            WHEN {has(left(1), T.MEASURE_IS_1)} AND {has(left(1), T.ENDS_CVC)} THEN {left(1)} || 'e'
            ELSE {left(1)} END""",
        f"CASE WHEN {has('w', '^.+[^aeiouy]y$|^.*[aeiou]yy$')} THEN {left(1)} || 'i' ELSE w END",
        f"CASE WHEN {has('w', 'alli$')} AND {has(left(4), measured)} THEN {left(2)} ELSE w END",
        f"""CASE WHEN {has('w', 'logi$')} THEN CASE WHEN {has(left(3), measured)} THEN {left(1)} ELSE w END
            ELSE {swap(T.STEP_2)} END""",
        swap(T.STEP_3),
        f"""CASE WHEN {tail} <> '' AND {has(head, T.MEASURE_OVER_1)} AND ({tail} <> 'ion' OR {has(head, '[st]$')})
            THEN {head} ELSE w END""",
        f"""CASE WHEN {has('w', 'e$')} AND ({has(left(1), T.MEASURE_OVER_1)}
                 OR ({has(left(1), T.MEASURE_IS_1)} AND NOT {has(left(1), T.ENDS_CVC)})) THEN {left(1)} ELSE w END""",
        f"CASE WHEN {has('w', 'll$')} AND {has(left(1), T.MEASURE_OVER_1)} THEN {left(1)} ELSE w END",
    ]
    ctes = [f"step0 AS MATERIALIZED (SELECT DISTINCT token, regexp_replace(token, '^y', 'Y') AS w FROM {source})"]
    ctes += [f"step{i} AS (SELECT token, {step} AS w FROM step{i - 1})" for i, step in enumerate(steps, 1)]
    ctes.append(f"""stems AS (SELECT token, CASE WHEN {_sql_case(T.IRREGULAR, 'token')} IS NOT NULL
        THEN {_sql_case(T.IRREGULAR, 'token')} WHEN length(token) <= 2 THEN token
        ELSE regexp_replace(w, '^Y', 'y') END AS stem FROM step{len(steps)})""")
    return ",\n".join(ctes)


TERMS_SQL = _FILTERED + ",\n" + _stem_sql("filtered") + """,
terms AS (SELECT doc_id, stem, CAST(sum(n) AS BIGINT) AS n FROM filtered JOIN stems USING (token) GROUP BY ALL),
vocab AS (SELECT row_number() OVER (ORDER BY freq DESC, stem) - 1 AS stem_id, stem, freq
          FROM (SELECT stem, CAST(sum(n) AS BIGINT) AS freq FROM terms GROUP BY stem HAVING sum(n) >= 5)),
doc_terms AS (SELECT doc_id, stem_id, n FROM terms JOIN vocab USING (stem)),
raw AS (SELECT doc_id, stem_id, CAST(n AS DOUBLE) AS f, 1 + sqrt(n) AS s, 1 + log2(n) AS l FROM doc_terms),
norms AS (SELECT doc_id, sqrt(sum(f * f)) AS nf, sqrt(sum(s * s)) AS ns, sqrt(sum(l * l)) AS nl FROM raw GROUP BY doc_id),
weights AS (SELECT doc_id, stem_id, round(f / nf, 6) AS freq, round(s / ns, 6) AS sqrt, round(l / nl, 6) AS log2
            FROM raw JOIN norms USING (doc_id))
"""

_UNMARKED = r"regexp_replace({0}, '(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>', ' ', 'g')"


def _strip_sql(column: str) -> str:
    expr = f"regexp_replace({_UNMARKED.format(column)}, '(?s)<[^>]*>', ' ', 'g')"
    expr = rf"regexp_replace({expr}, '&#(12[89]|1[3-9]\d|[2-9]\d\d|\d{{4,}});', '', 'g')"
    expr = rf"regexp_replace({expr}, '&#\d{{1,3}};', ' ', 'g')"
    for entity, char in T.NAMED_ENTITIES.items():
        char = "''" if char == "'" else char
        expr = f"replace({expr}, '{entity}', '{char}')"
    return rf"trim(regexp_replace({expr}, '\s+', ' ', 'g'))"


ORACLES = {
    "text_extract_pages": rf"""
        WITH found AS (
          SELECT page_id, regexp_extract(html, '(?i)<html\b[^>]*\blang="([^"]*)"', 1) AS topic,
                 regexp_extract_all(html, '(?is)<h1\b[^>]*>(.*?)</h1>', 1) AS h1,
                 regexp_extract(html, '(?is)<article\b[^>]*>(.*?)</article>', 1) AS article FROM pages)
        SELECT page_id, topic, {_strip_sql('h1[1]')} AS title,
               CAST(length({_strip_sql('article')}) AS INTEGER) AS body_chars
        FROM found WHERE len(h1) = 1 AND article <> ''""",
    "text_tokens": f"WITH {_TOKENS} SELECT doc_id, token, n FROM tokens",
    "text_stopword_filter": f"WITH {_FILTERED} SELECT doc_id, token, n FROM filtered",
    "text_stems": f"WITH {_TOKENS}, {_stem_sql('tokens')} SELECT token, stem FROM stems",
    "text_top_topics": """
        SELECT CAST(row_number() OVER (ORDER BY n DESC, topic) - 1 AS INTEGER) AS topic_id, topic, n
        FROM (SELECT p_brand AS topic, count(*) AS n FROM part GROUP BY p_brand) ORDER BY n DESC, topic LIMIT 20""",
    "text_class_map": """
        WITH topics AS (SELECT CAST(row_number() OVER (ORDER BY n DESC, topic) - 1 AS INTEGER) AS topic_id, topic
                        FROM (SELECT lang AS topic, count(*) AS n FROM documents GROUP BY lang)
                        ORDER BY n DESC, topic LIMIT 20)
        SELECT doc_id, topic_id, topic FROM documents JOIN topics ON lang = topic""",
    "text_vocabulary": f"WITH {TERMS_SQL} SELECT stem_id, stem, freq FROM vocab",
    "text_doc_term": f"WITH {TERMS_SQL} SELECT doc_id, stem_id, n FROM doc_terms",
    "text_top_terms": f"""WITH {TERMS_SQL}
        SELECT doc_id, stem_id, n, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, stem_id) AS INTEGER) AS rk
        FROM doc_terms QUALIFY rk <= 10""",
    "text_weights_all": f"""WITH {TERMS_SQL}
        SELECT doc_id, stem_id, 'freq' AS scheme, freq AS w FROM weights
        UNION ALL SELECT doc_id, stem_id, 'sqrt', sqrt FROM weights
        UNION ALL SELECT doc_id, stem_id, 'log2', log2 FROM weights""",
} | {f"text_weights_{s}": f"WITH {TERMS_SQL} SELECT doc_id, stem_id, {s} AS w FROM weights" for s in C.SCHEMES}
