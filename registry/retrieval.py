"""Documents, chunks, encodings and similarity queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query
from registry.sqltext import collapse, quote
from tinta.functions.rows import posexplode_rows
from tinta.functions.text import WS, chunk_text, format_for_model, model_slug, preview
from tinta.operators import chunking as ch
from tinta.operators import encoding as en
from tinta.operators import projection as pr
from tinta.operators import retrieval as rt
from tinta.session import cut_lineage, spread
from tinta.sources.corpus import load
from tinta.sources.documents import ENTITIES, extract_pages


def stripped(text: str) -> str:
    return f"regexp_replace({text}, '^[{WS}]+|[{WS}]+$', '', 'g')"


CHUNKS = f"""
    docs AS (SELECT doc_id, source AS source_file, 'corpus/' || source || '/' || doc_id AS source_path,
        {stripped('text')} AS body FROM documents),
    sized AS (SELECT *, length(body) AS n, 1 + CAST(ceil(greatest(length(body) - 1000, 0) / 800) AS BIGINT) AS windows
        FROM docs WHERE body <> ''),
    cut AS (SELECT *, unnest(range(windows)) AS chunk_index FROM sized),
    chunks AS MATERIALIZED (SELECT
        lower(trim(regexp_replace(source_file, '[^a-zA-Z0-9_-]+', '_', 'g'), '_')) || '_chunk_' ||
            printf('%04d', chunk_index) AS chunk_id,
        row_number() OVER (ORDER BY source_path, chunk_index) - 1 AS global_chunk_index, chunk_index, source_file,
        source_path, {stripped('substr(body, chunk_index * 800 + 1, 1000)')} AS text FROM cut)
"""


def source_documents(spark, folder):
    documents = load(spark, folder, "documents")
    path = F.concat(F.lit("corpus/"), "source", F.lit("/"), F.col("doc_id").cast("string"))
    return spread(documents.select(path.alias("source_path"), F.col("source").alias("source_file"), "text"))


def fixed_chunks(spark, folder):
    return ch.chunk_documents(source_documents(spark, folder), ch.fixed_windows)


def _page_sql() -> str:
    text = r"regexp_replace(html, '(?is)<(?:script|style)\b.*?</(?:script|style)\s*>', ' ', 'g')"
    text = rf"regexp_replace(regexp_replace({text}, '(?s)<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g')"
    for entity, character in ENTITIES:
        text = f"replace({text}, {quote(entity)}, {quote(character)})"
    return f"SELECT * FROM (SELECT page_id, url, {collapse(text)} AS text FROM pages) WHERE text <> ''"


@query("extract_pages", _page_sql)
def run_pages(spark, folder):
    return extract_pages(load(spark, folder, "pages"))


@query(
    "chunk_fixed",
    """SELECT doc_id, w AS chunk_index, substr(text, w * 800 + 1, 1000) AS chunk FROM (
        SELECT doc_id, text, unnest(range(1 + CAST(ceil(greatest(length(text) - 1000, 0) / 800) AS BIGINT))) AS w
        FROM documents WHERE text <> '')""",
)
def run_fixed(spark, folder):
    documents = spread(load(spark, folder, "documents").select("doc_id", "text"))
    rows = posexplode_rows(documents, ch.fixed_windows(F.col("text")), "chunk_index", "chunk", "doc_id")
    return rows.withColumn("chunk_index", F.col("chunk_index").cast("bigint"))


# Separators in their order with their lengths; a part that holds none of them is cut into windows.
_SEPARATORS = (("chr(10) || chr(10)", 2), ("chr(10)", 1), ("' '", 1))


def _split_sql() -> str:
    """Four rounds of cutting: a node is cut at the first separator it holds from its level on, and its long parts are the nodes of the next round."""
    level = " ".join(f"WHEN lvl <= {i} AND contains(piece, {s}) THEN {i}" for i, (s, _) in enumerate(_SEPARATORS))
    split = " ".join(f"WHEN {i} THEN string_split(piece, {s})" for i, (s, _) in enumerate(_SEPARATORS))
    width = "[" + ", ".join(str(w) for _, w in _SEPARATORS) + "]"
    rounds = ["nodes0 AS (SELECT r, 0::BIGINT AS a, n AS b, 0 AS lvl, body AS piece FROM numbered)"]
    for k in range(4):
        rounds.append(f"""held{k} AS MATERIALIZED (SELECT *, CASE {level} ELSE 3 END AS eff FROM nodes{k})""")
        rounds.append(f"""parts{k} AS MATERIALIZED (SELECT *, sum(CAST(e - s >= 1000 AS INT)) OVER (PARTITION BY r, a ORDER BY s) AS before FROM (
            SELECT r, a, eff, piece, CAST(a + sum(size) OVER w AS BIGINT) AS e, CAST(a + sum(size) OVER w - size AS BIGINT) AS s FROM (
                SELECT r, a, eff, piece, unnest(sizes) AS size, generate_subscripts(sizes, 1) AS i FROM (
                    SELECT *, list_transform(CASE eff {split} END, lambda x, i: length(x) + CASE WHEN i > 1 THEN {width}[eff + 1] ELSE 0 END) AS sizes
                    FROM held{k} WHERE eff < 3)) WHERE size > 0 WINDOW w AS (PARTITION BY r, a ORDER BY i)))""")
        rounds.append(f"""nodes{k + 1} AS (SELECT r, s AS a, e AS b, eff + 1 AS lvl, substr(piece, s - a + 1, e - s) AS piece FROM parts{k} WHERE e - s >= 1000)""")
    union = " UNION ALL ".join(f"SELECT r, {k} AS round, a, before, s, e FROM parts{k} WHERE e - s < 1000" for k in range(4))
    singles = " UNION ALL ".join(f"SELECT r, a, b FROM held{k} WHERE eff = 3" for k in range(4))
    return ",\n    ".join(rounds) + f""",
    runs AS MATERIALIZED (SELECT r, list(s ORDER BY s) || [max(e)] AS cuts FROM ({union}) GROUP BY r, round, a, before),
    walk AS (SELECT r, cuts, 1::BIGINT AS i, len(list_filter(cuts, lambda c: c <= cuts[1] + 1000)) AS j FROM runs
        UNION ALL SELECT r, cuts, k, len(list_filter(cuts, lambda c: c <= cuts[k] + 1000)) FROM (
            SELECT r, cuts, 1 + len(list_filter(cuts, lambda c: c < greatest(cuts[j] - 200, cuts[j + 1] - 1000))) AS k FROM walk WHERE j < len(cuts))),
    spans AS (SELECT r, cuts[i] AS s, cuts[j] AS e FROM walk
        UNION ALL SELECT r, a + 800 * w, least(a + 800 * w + 1000, b) FROM (
            SELECT *, unnest(range(1 + CAST(ceil(greatest(b - a - 1000, 0) / 800) AS BIGINT))) AS w FROM ({singles})))"""


def _recursive_sql() -> str:
    return f"""WITH RECURSIVE docs AS (SELECT source AS source_file, 'corpus/' || source || '/' || doc_id AS source_path,
        {stripped('text')} AS body FROM documents),
    numbered AS MATERIALIZED (SELECT *, length(body) AS n, row_number() OVER () AS r FROM docs WHERE body <> ''),
    {_split_sql()},
    told AS (SELECT * FROM (SELECT r, s, e, source_file, source_path, {stripped('substr(body, s + 1, e - s)')} AS text FROM spans JOIN numbered USING (r))
        WHERE text <> ''),
    chunks AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY s, e) - 1 AS chunk_index FROM told)
    SELECT lower(trim(regexp_replace(source_file, '[^a-zA-Z0-9_-]+', '_', 'g'), '_')) || '_chunk_' || printf('%04d', chunk_index) AS chunk_id,
        row_number() OVER (ORDER BY source_path, chunk_index) - 1 AS global_chunk_index, chunk_index, source_file, source_path, text,
        CAST(length(text) AS BIGINT) AS n_characters FROM chunks"""


@query("chunk_recursive", _recursive_sql)
def run_recursive(spark, folder):
    return ch.chunk_documents(source_documents(spark, folder))


@query("chunk_documents", lambda: f"""WITH {CHUNKS} SELECT *, CAST(length(text) AS BIGINT) AS n_characters FROM chunks""")
def run_chunks(spark, folder):
    return fixed_chunks(spark, folder)


@query(
    "chunk_report",
    lambda: f"""WITH {CHUNKS} SELECT chunk_id, global_chunk_index, source_file, chunk_index,
        CAST(length(text) AS BIGINT) AS n_characters, left({collapse('text')}, 300) AS text_preview FROM chunks""",
)
def run_report(spark, folder):
    return ch.chunk_report(fixed_chunks(spark, folder))


@query("chunks_per_file", lambda: f"WITH {CHUNKS} SELECT source_path, count(*) AS n_chunks FROM chunks GROUP BY 1")
def run_per_file(spark, folder):
    return ch.chunks_per_file(fixed_chunks(spark, folder))


@query(
    "chunk_text",
    """SELECT conv_id, turn, CASE WHEN role <> 'user' AND text <> '' THEN text ELSE role || ': ' || text END AS text
    FROM conversations""",
)
def run_chunk_text(spark, folder):
    turns = load(spark, folder, "conversations")
    text = F.when(F.col("role") != "user", F.col("text"))
    page = F.concat("role", F.lit(": "), "text")
    return turns.select("conv_id", "turn", chunk_text(text, page).alias("text"))


@query(
    "model_slug",
    "SELECT url, trim(regexp_replace(url, '[^a-zA-Z0-9._-]+', '_', 'g'), '_') AS slug FROM pages",
)
def run_slug(spark, folder):
    return load(spark, folder, "pages").select("url", model_slug(F.col("url")).alias("slug"))


_MODEL_LIST = "[" + ", ".join(quote(name) for name, _ in rt.MODELS) + "]"


@query(
    "e5_prefix",
    f"""WITH named AS (SELECT doc_id, {_MODEL_LIST}[1 + doc_id % 4] AS model_name,
        CASE WHEN doc_id % 3 = 0 THEN 'query' ELSE 'passage' END AS input_type,
        {stripped("CASE WHEN doc_id % 8 = 4 THEN ' Query: ' ELSE '' END || text")} AS t FROM documents)
    SELECT doc_id, model_name, input_type, CASE
        WHEN lower(model_name) NOT LIKE 'intfloat/multilingual-e5%' AND lower(model_name) NOT LIKE '%/e5-%' THEN t
        WHEN lower(t) LIKE 'query: %' OR lower(t) LIKE 'passage: %' THEN t
        ELSE input_type || ': ' || t END AS formatted FROM named""",
)
def run_prefix(spark, folder):
    names = F.array(*[F.lit(name) for name, _ in rt.MODELS])
    rows = load(spark, folder, "documents").select(
        "doc_id",
        F.element_at(names, (F.col("doc_id") % 4 + 1).cast("int")).alias("model_name"),
        F.when(F.col("doc_id") % 3 == 0, "query").otherwise("passage").alias("input_type"),
        F.concat(F.when(F.col("doc_id") % 8 == 4, " Query: ").otherwise(""), "text").alias("text"),
    )
    formatted = format_for_model(F.col("text"), F.col("model_name"), F.col("input_type"))
    return rows.withColumn("formatted", formatted).drop("text")


def _bucket_sql(term: str, dim: str) -> str:
    return f"('0x' || substr(md5({term}), 1, 7))::BIGINT % {dim}"


def _terms_sql(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '{en.TERM_PATTERN}')"


@query(
    "hashed_vectors",
    lambda: f"""SELECT doc_id, {_bucket_sql('term', '256')} AS bucket, count(*) AS count
    FROM (SELECT doc_id, unnest({_terms_sql('text')}) AS term FROM documents) GROUP BY 1, 2""",
)
def run_hashed(spark, folder):
    documents = spread(load(spark, folder, "documents").select("doc_id", "text"))
    return en.hashed_term_counts(documents, "doc_id", 256)


@query(
    "encode_texts",
    lambda: f"""SELECT doc_id, {_bucket_sql('term', '384')} AS bucket, count(*) AS n
    FROM (SELECT doc_id, unnest({_terms_sql("'passage: ' || text")}) AS term FROM documents) GROUP BY 1, 2""",
)
def run_encode(spark, folder):
    documents = spread(load(spark, folder, "documents").select("doc_id", "text"))
    name = rt.MODELS[0][0]
    coded = en.encode_texts(documents, name, lambda: en.hashing_encoder(384), normalize=False)
    cells = coded.select("doc_id", F.posexplode("embedding").alias("bucket", "n")).where("n > 0")
    return cells.select("doc_id", F.col("bucket").cast("bigint").alias("bucket"), F.col("n").cast("bigint").alias("n"))


@query("encode_tfidf")
def run_tfidf(spark, folder):
    documents = spread(load(spark, folder, "documents").select("doc_id", "text"))
    return en.encode_tfidf(documents, 256).select("doc_id", "embedding")


# --- vectors of the embeddings table -------------------------------------------------------------

FIRST_QUERY = "SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1"
SCORED = f"""
    q AS ({FIRST_QUERY}),
    scored AS (SELECT vec_id, label, list_cosine_similarity(embedding::DOUBLE[], (SELECT embedding FROM q)::DOUBLE[])
        AS score FROM embeddings)
"""


def scored_vectors(spark, folder):
    vectors = load(spark, folder, "embeddings")
    return rt.cosine_scores(vectors, vectors.orderBy("vec_id").limit(1))


def rounded(df):
    return df.withColumn("similarity_score", F.round("similarity_score", 6))


@query("cosine_scores", f"WITH {SCORED} SELECT vec_id, round(score, 6) AS similarity_score FROM scored")
def run_cosine(spark, folder):
    return rounded(scored_vectors(spark, folder)).select("vec_id", "similarity_score")


@query(
    "topk_chunks",
    f"""WITH {SCORED} SELECT vec_id, round(score, 6) AS similarity_score,
        row_number() OVER (ORDER BY score DESC, vec_id) AS rank FROM scored ORDER BY score DESC, vec_id LIMIT 5""",
)
def run_topk(spark, folder):
    return rounded(rt.top_k(scored_vectors(spark, folder), 5, "vec_id")).select("vec_id", "similarity_score", "rank")


@query(
    "best_chunk",
    f"""WITH {SCORED} SELECT vec_id, round(score, 6) AS similarity_score FROM scored
    ORDER BY score DESC, vec_id LIMIT 1""",
)
def run_best(spark, folder):
    scored = scored_vectors(spark, folder).select("vec_id", "similarity_score")
    return rounded(rt.best_chunk(scored, "vec_id"))


@query(
    "attach_scores",
    f"WITH {SCORED} SELECT vec_id, label, round(score, 6) AS similarity_score FROM scored",
)
def run_attach(spark, folder):
    scored = scored_vectors(spark, folder)
    return rounded(rt.attach_scores(scored.select("vec_id", "label"), scored, "vec_id"))


@query(
    "topk_per_query",
    """WITH queries AS (SELECT label AS query_label, arg_min(embedding, vec_id) AS q FROM embeddings GROUP BY label),
    ranked AS (SELECT query_label, vec_id, score, row_number() OVER (PARTITION BY query_label
        ORDER BY score DESC, vec_id) AS rank FROM (
            SELECT query_label, vec_id, list_cosine_similarity(embedding::DOUBLE[], q::DOUBLE[]) AS score
            FROM queries, embeddings))
    SELECT query_label, vec_id, round(score, 6) AS similarity_score, rank FROM ranked WHERE rank <= 5""",
)
def run_topk_per_query(spark, folder):
    vectors = load(spark, folder, "embeddings").withColumn("model_name", F.lit("table"))
    queries = vectors.groupBy("model_name", F.col("label").alias("query")).agg(
        F.min_by("embedding", "vec_id").alias("embedding")
    )
    scored = rt.cosine_scores_by_model(vectors, queries)
    ranked = rt.top_k(scored, 5, "vec_id", ("model_name", "query"))
    return rounded(ranked).select(F.col("query").alias("query_label"), "vec_id", "similarity_score", "rank")


# --- retrieval over chunks, all models -----------------------------------------------------------

_REGISTRY = ", ".join(f"({quote(name)}, {dim})" for name, dim in rt.MODELS)

RETRIEVAL = f"""
    {CHUNKS},
    asked AS (SELECT DISTINCT text AS query FROM benchmark),
    models AS (SELECT * FROM (VALUES {_REGISTRY}) AS t(model_name, dim)),
    prefixed AS (SELECT model_name, dim, lower(model_name) LIKE 'intfloat/multilingual-e5%' AS e5 FROM models),
    query_terms AS (SELECT model_name, dim, query, unnest({_terms_sql("CASE WHEN e5 THEN 'query: ' ELSE '' END || query")})
        AS term FROM prefixed, asked),
    query_vector AS MATERIALIZED (SELECT model_name, query, {_bucket_sql('term', 'dim')} AS bucket, count(*) AS n
        FROM query_terms GROUP BY 1, 2, 3),
    chunk_terms AS (SELECT model_name, dim, global_chunk_index,
        unnest({_terms_sql("CASE WHEN e5 THEN 'passage: ' ELSE '' END || text")}) AS term FROM prefixed, chunks),
    chunk_vector AS MATERIALIZED (SELECT model_name, global_chunk_index, {_bucket_sql('term', 'dim')} AS bucket, count(*) AS n
        FROM chunk_terms GROUP BY 1, 2, 3),
    query_norm AS (SELECT model_name, query, sqrt(sum(n * n)::DOUBLE) AS qn FROM query_vector GROUP BY 1, 2),
    chunk_norm AS (SELECT model_name, global_chunk_index, sqrt(sum(n * n)::DOUBLE) AS cn FROM chunk_vector GROUP BY 1, 2),
    products AS (SELECT c.model_name, q.query, c.global_chunk_index, sum(c.n * q.n)::DOUBLE AS dot FROM chunk_vector c
        JOIN query_vector q ON q.model_name = c.model_name AND q.bucket = c.bucket GROUP BY 1, 2, 3),
    scored AS (SELECT m.model_name, asked.query, chunks.*, length(text) AS n_characters,
        coalesce(dot / (cn * qn), 0) AS similarity_score
        FROM models m CROSS JOIN asked CROSS JOIN chunks
        LEFT JOIN query_norm qv ON qv.model_name = m.model_name AND qv.query = asked.query
        LEFT JOIN chunk_norm cv ON cv.model_name = m.model_name AND cv.global_chunk_index = chunks.global_chunk_index
        LEFT JOIN products p ON p.model_name = m.model_name AND p.query = asked.query
            AND p.global_chunk_index = chunks.global_chunk_index),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY model_name, query ORDER BY similarity_score DESC, global_chunk_index)
        AS rank FROM scored)
"""


def retrieval(spark, folder):
    """Every chunk scored with every query of its model: the full ranking holds them all."""
    asked = load(spark, folder, "benchmark").select(F.col("text").alias("query")).distinct()
    queries, chunks = en.encode_query_and_chunks(asked, fixed_chunks(spark, folder), normalize=False)
    return rt.cosine_scores_by_model(chunks, queries)


def ranked_chunks(spark, folder):
    """Query vectors, chunks, and the five best chunks per model and query."""
    asked = load(spark, folder, "benchmark").select(F.col("text").alias("query")).distinct()
    texts = fixed_chunks(spark, folder)
    queries, chunks = en.encode_query_and_chunks(asked, texts, normalize=False)
    return queries, texts, rt.top_k_by_model(chunks, queries, 5)


@query(
    "similarity_ranking",
    lambda: f"""WITH {RETRIEVAL} SELECT model_name, query, global_chunk_index AS chunk_position, chunk_id, source_file,
        source_path, chunk_index, CAST(n_characters AS BIGINT) AS n_characters,
        round(similarity_score, 6) AS similarity_score, left({collapse('text')}, 500) AS text_preview FROM scored""",
)
def run_ranking(spark, folder):
    return rounded(rt.similarity_ranking(retrieval(spark, folder), "global_chunk_index"))


@query(
    "retrieve_topk",
    lambda: f"""WITH {RETRIEVAL} SELECT model_name, chunk_id, source_path, rank,
        round(similarity_score, 6) AS similarity_score FROM ranked WHERE rank <= 5""",
)
def run_retrieve(spark, folder):
    ranked = ranked_chunks(spark, folder)[2]
    return rounded(ranked).select("model_name", "chunk_id", "source_path", "rank", "similarity_score")


@query(
    "top_result_per_model",
    lambda: f"""WITH {RETRIEVAL} SELECT model_name,
        trim(regexp_replace(model_name, '[^a-zA-Z0-9._-]+', '_', 'g'), '_') AS model_slug, query,
        round(similarity_score, 6) AS similarity_score, rank, chunk_id, global_chunk_index AS chunk_position,
        source_file, source_path, chunk_index, CAST(n_characters AS BIGINT) AS n_characters, text
    FROM ranked WHERE rank = 1""",
)
def run_top_result(spark, folder):
    return rounded(rt.top_result_per_model(ranked_chunks(spark, folder)[2]))


def projected(spark, folder):
    queries, texts, ranked = ranked_chunks(spark, folder)
    ranked = cut_lineage(ranked)  # read for the chunks that need their vectors again and for its rows
    chunks = en.encode_for_models(rt.ranked_chunks_only(texts, ranked), "passage", normalize=False)
    # chunk ids repeat over directories of equal file names, so the chunk is known by its number here
    by_number = F.col("global_chunk_index").cast("string")
    ranked = ranked.withColumn("chunk_id", by_number)
    return rt.projection_rows(queries, ranked, chunks.withColumn("chunk_id", by_number))


@query(
    "projection_roles",
    lambda: f"""WITH {RETRIEVAL}
    SELECT model_name, 0::BIGINT AS position, 'Consulta' AS label, 'query' AS role, NULL::DOUBLE AS similarity_score
    FROM models, asked
    UNION ALL SELECT model_name, rank, 'Top ' || rank || ' (' || source_file || ', chunk ' || chunk_index || ')',
        CASE WHEN rank = 1 THEN 'best_chunk' ELSE 'chunk' END, round(similarity_score, 6) FROM ranked WHERE rank <= 5""",
)
def run_roles(spark, folder):
    return rounded(projected(spark, folder)).select("model_name", "position", "label", "role", "similarity_score")


@query("query_coordinates")
def run_query_coordinates(spark, folder):
    return pr.query_coordinates(projected(spark, folder))


@query("pca_coordinates")
def run_pca(spark, folder):
    vectors = load(spark, folder, "embeddings")
    return pr.pca_coordinates(vectors, "embedding").select("vec_id", "x", "y")


@query("text_preview", lambda: f"SELECT doc_id, left({collapse('text')}, 300) AS preview FROM documents")
def run_preview(spark, folder):
    return load(spark, folder, "documents").select("doc_id", preview(F.col("text"), 300).alias("preview"))
