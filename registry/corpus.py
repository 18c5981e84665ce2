"""Corpus cleaning, statistics and vocabulary."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query
from registry.sqltext import clean, collapse, joined, stopword_list, words
from tinta.functions.stopwords import stopwords
from tinta.functions.text import digit_pattern, SPANISH_LETTERS, WORD_LETTERS
from tinta.functions.text import clean_token_list, normalize_text, split_words
from tinta.operators import corpus_stats as cs
from tinta.session import spread
from tinta.sources.corpus import load, with_text

CLEAN_CTE = lambda: f"""
    clean AS (
        SELECT * FROM (SELECT doc_id, lang, {clean('text')} AS tokens FROM documents WHERE text <> '')
        WHERE len(tokens) >= 2
    ),
    counts AS (SELECT token, count(*) AS n FROM (SELECT unnest(tokens) AS token FROM clean) GROUP BY token)
"""


def clean_documents(spark, folder):
    documents = spread(load(spark, folder, "documents").select("doc_id", "lang", "text"))
    return cs.clean_corpus(documents, stopwords())


@query("normalize_text", lambda: f"SELECT doc_id, {collapse('lower(text)')} AS normalized FROM documents")
def run_normalize(spark, folder):
    documents = load(spark, folder, "documents")
    return documents.select("doc_id", normalize_text(F.col("text")).alias("normalized"))


@query(
    "read_corpus",
    "SELECT doc_id, CAST(length(text) AS BIGINT) AS n FROM documents WHERE text IS NOT NULL AND text <> ''",
)
def run_read(spark, folder):
    documents = with_text(load(spark, folder, "documents"))
    return documents.select("doc_id", F.length("text").cast("bigint").alias("n"))


@query("clean_tokens", lambda: f"SELECT doc_id, {joined(clean('text'))} AS tokens FROM documents WHERE text <> ''")
def run_clean(spark, folder):
    documents = load(spark, folder, "documents").select("doc_id", "text")
    return cs.clean_corpus(documents, stopwords(), min_tokens=0).select(
        "doc_id", F.array_join("tokens", " ").alias("tokens")
    )


@query(
    "corpus_without_stopword_filter",
    lambda: f"""SELECT doc_id, {joined('tokens')} AS tokens
    FROM (SELECT doc_id, {clean('text', False)} AS tokens FROM documents WHERE text <> '')
    WHERE len(tokens) > 0""",
)
def run_plain_corpus(spark, folder):
    documents = load(spark, folder, "documents").select("doc_id", "text")
    return cs.clean_corpus(documents, min_tokens=1).select("doc_id", F.array_join("tokens", " ").alias("tokens"))


@query(
    "filter_min_tokens",
    lambda: f"WITH {CLEAN_CTE()} SELECT doc_id, CAST(len(tokens) AS BIGINT) AS n_tokens FROM clean",
)
def run_min_tokens(spark, folder):
    return clean_documents(spark, folder).select("doc_id", F.size("tokens").cast("bigint").alias("n_tokens"))


@query(
    "clean_first_n",
    lambda: f"WITH {CLEAN_CTE()} SELECT doc_id, {joined('tokens')} AS tokens FROM clean ORDER BY doc_id LIMIT 100",
)
def run_first_n(spark, folder):
    first = cs.first_rows(clean_documents(spark, folder), ["doc_id"], 100)
    return first.select("doc_id", F.array_join("tokens", " ").alias("tokens"))


STATISTICS_SQL = lambda: f"""
    WITH {CLEAN_CTE()},
    top AS (SELECT token, n, row_number() OVER (ORDER BY n DESC, token) AS rank FROM counts
            ORDER BY n DESC, token LIMIT 30),
    stats AS (SELECT count(*) AS n_sentencias,
        CAST(sum(len(tokens)) AS BIGINT) AS total_tokens,
        CAST(min(len(tokens)) AS BIGINT) AS longitud_minima,
        CAST(max(len(tokens)) AS BIGINT) AS longitud_maxima,
        round_even(sum(len(tokens))::DOUBLE / count(*) * 1000, 0) / 1000 AS longitud_promedio,
        (SELECT count(*) FROM counts) AS vocabulario_unico FROM clean)
"""


@query(
    "corpus_stats",
    lambda: STATISTICS_SQL()
    + """SELECT *, (SELECT string_agg(token || ':' || n, ' ' ORDER BY rank) FROM top) AS top_30_tokens
    FROM stats""",
)
def run_stats(spark, folder):
    statistics = cs.corpus_statistics(clean_documents(spark, folder))
    listed = F.transform("top_30_tokens", lambda x: F.concat_ws(":", x["token"], x["count"]))
    return statistics.withColumn("top_30_tokens", F.array_join(listed, " "))


@query(
    "stats_long",
    lambda: STATISTICS_SQL()
    + """SELECT 'n_sentencias' AS metrica, CAST(n_sentencias AS VARCHAR) AS valor FROM stats
    UNION ALL SELECT 'total_tokens', CAST(total_tokens AS VARCHAR) FROM stats
    UNION ALL SELECT 'longitud_minima', CAST(longitud_minima AS VARCHAR) FROM stats
    UNION ALL SELECT 'longitud_maxima', CAST(longitud_maxima AS VARCHAR) FROM stats
    UNION ALL SELECT 'longitud_promedio', CAST(longitud_promedio AS VARCHAR) FROM stats
    UNION ALL SELECT 'vocabulario_unico', CAST(vocabulario_unico AS VARCHAR) FROM stats
    UNION ALL SELECT 'top_token_' || rank, token || ':' || n FROM top""",
)
def run_stats_long(spark, folder):
    return cs.statistics_long(cs.corpus_statistics(clean_documents(spark, folder)))


@query(
    "top_tokens",
    lambda: f"""WITH {CLEAN_CTE()}
    SELECT token, n AS count, row_number() OVER (ORDER BY n DESC, token) AS rank
    FROM counts ORDER BY n DESC, token LIMIT 30""",
)
def run_top(spark, folder):
    return cs.top_tokens(clean_documents(spark, folder))


@query("vocab_min_count", lambda: f"WITH {CLEAN_CTE()} SELECT token, n AS count FROM counts WHERE n >= 5")
def run_vocabulary(spark, folder):
    return cs.vocabulary(clean_documents(spark, folder))


@query(
    "raw_vs_clean",
    lambda: f"""SELECT doc_id, text AS texto_original, {joined(clean('text'))} AS tokens_limpios,
        CAST(len({words('text')}) AS BIGINT) AS longitud_original_aprox,
        CAST(len({clean('text')}) AS BIGINT) AS longitud_limpia
    FROM documents WHERE text <> ''""",
)
def run_raw_and_clean(spark, folder):
    rows = cs.raw_and_clean(load(spark, folder, "documents"), "doc_id", stopwords())
    return rows.withColumn("tokens_limpios", F.array_join("tokens_limpios", " "))


def _token_list_sql() -> str:
    digit = digit_pattern()
    return f"""
    SELECT doc_id, {joined('kept')} AS tokens FROM (
        SELECT doc_id, list_filter(
            list_transform({words('text')}, lambda w: lower(w)),
            lambda w: length(w) >= 2 AND w NOT IN {stopword_list()}
                AND NOT regexp_matches(w, '{digit}')
                AND regexp_matches(w, '[{WORD_LETTERS}]') AND regexp_matches(w, '[{SPANISH_LETTERS}]')
        ) AS kept FROM documents)"""


@query("clean_token_list", _token_list_sql)
def run_token_list(spark, folder):
    tokens = clean_token_list(split_words(F.col("text")), stopwords())
    return load(spark, folder, "documents").select("doc_id", F.array_join(tokens, " ").alias("tokens"))
