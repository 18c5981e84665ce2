"""Subword vocabularies, encodings and the tokenizer comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query
from registry.sentences import SPLIT_CTE
from registry.sqltext import joined, quote, rebuilt, words
from tinta.functions.text import PRETOKEN_PATTERN, rebuild_text, split_words
from tinta.operators import subword as sw
from tinta.operators.unigram import unigram_vocabulary
from tinta.operators.splits import split_rows
from tinta.session import scratch_path, spread
from tinta.sources.corpus import load, record_tokens

PATTERN = quote(PRETOKEN_PATTERN)

VOCABULARIES = f"""
    wp_words AS MATERIALIZED (
        SELECT w, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, {PATTERN})) AS w FROM documents)
        GROUP BY w),
    wp_pieces AS (SELECT piece, sum(n) AS n FROM (
        SELECT unnest(list_transform(range(1, least(length(w), 8) + 1), lambda l: left(w, l))) AS piece, n
        FROM wp_words
        UNION ALL
        SELECT unnest(list_transform(range(1, least(length(w) - s + 1, 8) + 1),
            lambda l: '##' || substr(w, s, l))) AS piece, n
        FROM (SELECT w, n, unnest(range(2, length(w) + 1)) AS s FROM wp_words))
        GROUP BY piece),
    wp_sized AS (SELECT piece, CAST(n AS BIGINT) AS n,
        CASE WHEN piece LIKE '##_%' THEN length(piece) - 2 ELSE length(piece) END AS size FROM wp_pieces),
    wp_vocab AS MATERIALIZED (
        SELECT piece, n FROM wp_sized WHERE size = 1
        UNION ALL (SELECT piece, n FROM wp_sized WHERE size > 1 ORDER BY n DESC, piece LIMIT 2000)),
    sp_units AS (
        SELECT '▁' || w AS u, count(*) AS n FROM (SELECT unnest({words('text')}) AS w FROM documents) GROUP BY w),
    sp_pieces AS (SELECT piece, CAST(sum(n) AS BIGINT) AS n FROM (
        SELECT unnest(list_transform(range(1, least(length(u) - s + 1, 8) + 1), lambda l: substr(u, s, l))) AS piece, n
        FROM (SELECT u, n, unnest(range(1, length(u) + 1)) AS s FROM sp_units)) GROUP BY piece),
    sp_kept AS (
        SELECT piece, n FROM sp_pieces WHERE length(piece) = 1
        UNION ALL (SELECT piece, n FROM sp_pieces WHERE length(piece) > 1 ORDER BY n DESC, piece LIMIT 2000)),
    sp_vocab AS MATERIALIZED (
        SELECT piece, n, CAST(round(-ln(n / (SELECT CAST(sum(n) AS BIGINT) FROM sp_kept)) * 1000000) AS BIGINT) AS cost
        FROM sp_kept)
"""

# Both encoders read a relation ``texts(doc_id, t)``.
WORDPIECE = f"""
    wp_found AS (SELECT doc_id, regexp_extract_all(t, {PATTERN}) AS ws FROM texts),
    wp_occ AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM wp_found),
    wp_seg(w, cur, pieces) AS (
        SELECT DISTINCT w, 1::BIGINT, []::VARCHAR[] FROM wp_occ WHERE length(w) <= 100
        UNION ALL
        SELECT w, cur + max(l), list_append(any_value(pieces), arg_max(piece, l)) FROM (
            SELECT s.w, s.cur, s.pieces, t.l, v.piece FROM wp_seg s, range(1, 9) t(l), wp_vocab v
            WHERE s.cur + t.l - 1 <= length(s.w)
            AND v.piece = CASE WHEN s.cur = 1 THEN '' ELSE '##' END || substr(s.w, s.cur, t.l))
        GROUP BY w, cur),
    wp_cut AS (SELECT w, pieces FROM wp_seg WHERE cur > length(w)),
    wp_tokens AS (
        SELECT doc_id, list_concat(['[CLS]'], coalesce(any_value(inner_tokens), []::VARCHAR[]), ['[SEP]']) AS wp
        FROM wp_found LEFT JOIN (
            SELECT doc_id, flatten(list(coalesce(pieces, ['[UNK]']) ORDER BY pos)) AS inner_tokens
            FROM wp_occ LEFT JOIN wp_cut USING (w) GROUP BY doc_id) USING (doc_id) GROUP BY doc_id)
"""

SENTENCEPIECE = f"""
    sp_found AS (SELECT doc_id, list_transform({words('t')}, lambda w: '▁' || w) AS us FROM texts),
    sp_occ AS (SELECT doc_id, unnest(us) AS u, generate_subscripts(us, 1) AS pos FROM sp_found),
    sp_path(u, i, costs, back) AS (
        SELECT DISTINCT u, 0::BIGINT, [0::BIGINT], []::BIGINT[] FROM sp_occ
        UNION ALL
        SELECT u, i + 1, list_append(any_value(costs), (min(option)).c), list_append(any_value(back), (min(option)).s)
        FROM (
            SELECT p.u, p.i, p.costs, p.back,
                {{'c': p.costs[p.i + 2 - t.l] + coalesce(v.cost, 10000000), 's': p.i + 1 - t.l}} AS option
            FROM sp_path p JOIN range(1, 9) t(l) ON t.l <= p.i + 1
            LEFT JOIN sp_vocab v ON v.piece = substr(p.u, p.i + 2 - t.l, t.l)
            WHERE p.i < length(p.u) AND (v.piece IS NOT NULL OR t.l = 1))
        GROUP BY u, i),
    sp_walk(u, cur, back, pieces) AS (
        SELECT u, i, back, []::VARCHAR[] FROM sp_path WHERE i = length(u)
        UNION ALL
        SELECT s.u, s.back[s.cur], s.back, CASE
            WHEN v.piece IS NOT NULL THEN list_prepend(v.piece, s.pieces)
            WHEN len(s.pieces) > 0 AND s.pieces[1] = '<unk>' THEN s.pieces
            ELSE list_prepend('<unk>', s.pieces) END
        FROM sp_walk s LEFT JOIN sp_vocab v ON v.piece = substr(s.u, s.back[s.cur] + 1, s.cur - s.back[s.cur])
        WHERE s.cur > 0),
    sp_cut AS (SELECT u, pieces FROM sp_walk WHERE cur = 0),
    sp_tokens AS (
        SELECT doc_id, list_concat(coalesce(any_value(inner_tokens), []::VARCHAR[]), ['</s>']) AS sp
        FROM sp_found LEFT JOIN (
            SELECT doc_id, flatten(list(pieces ORDER BY pos)) AS inner_tokens
            FROM sp_occ JOIN sp_cut USING (u) GROUP BY doc_id) USING (doc_id) GROUP BY doc_id)
"""

RAW_TEXTS = "texts AS MATERIALIZED (SELECT doc_id, text AS t FROM documents)"
COMPARISON = f"""
    {SPLIT_CTE},
    texts AS MATERIALIZED (SELECT doc_id, {words('text')} AS original, {rebuilt(words('text'))} AS t FROM documents),
    {VOCABULARIES}, {WORDPIECE}, {SENTENCEPIECE},
    compared AS MATERIALIZED (
        SELECT split.source AS dataset, split.split AS split, split.doc_id AS indice, t AS texto, original, wp, sp
        FROM split JOIN texts USING (doc_id) JOIN wp_tokens USING (doc_id) JOIN sp_tokens USING (doc_id))
"""


def segmenters(spark, folder):
    documents = spread(load(spark, folder, "documents").select("text"))
    return sw.wordpiece_segmenter(documents), sw.sentencepiece_segmenter(documents)


def documents_of(spark, folder):
    return spread(load(spark, folder, "documents").select("doc_id", F.col("source").alias("dataset"), "text"))


def comparison(spark, folder):
    examples = split_rows(documents_of(spark, folder), "doc_id").select(
        "dataset",
        "split",
        F.col("doc_id").alias("example_index"),
        F.col("doc_id").cast("string").alias("source_sentence_id"),
        F.lit(None).cast("string").alias("source_file"),
        split_words(F.col("text")).alias("original_tokens"),
    )
    return sw.compare_tokenizers(examples, *segmenters(spark, folder))


@query("rebuild_text", lambda: f"SELECT doc_id, {rebuilt(words('text'))} AS text FROM documents")
def run_rebuild(spark, folder):
    documents = load(spark, folder, "documents")
    tokens = record_tokens(documents.select("text"))
    return documents.select("doc_id", rebuild_text(tokens).alias("text"))


@query(
    "pretokenize",
    lambda: f"SELECT doc_id, {joined(f'regexp_extract_all(text, {PATTERN})')} AS words FROM documents",
)
def run_pretokenize(spark, folder):
    documents = load(spark, folder, "documents")
    return documents.select("doc_id", F.array_join(sw.wordpiece_words(F.col("text")), " ").alias("words"))


@query("wordpiece_vocabulary", lambda: f"WITH {VOCABULARIES} SELECT piece, n AS count FROM wp_vocab")
def run_wordpiece_vocabulary(spark, folder):
    tokens = documents_of(spark, folder).select(sw.wordpiece_words(F.col("text")).alias("tokens"))
    return sw.wordpiece_vocabulary(tokens)


@query("sentencepiece_vocabulary", lambda: f"WITH {VOCABULARIES} SELECT piece, n AS count, cost FROM sp_vocab")
def run_sentencepiece_vocabulary(spark, folder):
    units = documents_of(spark, folder).select(sw.sentencepiece_units(F.col("text")).alias("tokens"))
    return sw.sentencepiece_vocabulary(units)


LONGER = VOCABULARIES.replace("+ 1, 8) + 1)", "+ 1, 12) + 1)").replace("least(length(w), 8)", "least(length(w), 12)").replace("LIMIT 2000", "LIMIT 500")


@query("unigram_vocabulary")
def run_unigram_vocabulary(spark, folder):
    units = documents_of(spark, folder).select(sw.sentencepiece_units(F.col("text")).alias("tokens"))
    return unigram_vocabulary(units, size=500)


@query("wordpiece_vocabulary_longer", lambda: f"WITH {LONGER} SELECT piece, n AS count FROM wp_vocab")
def run_wordpiece_vocabulary_longer(spark, folder):
    tokens = documents_of(spark, folder).select(sw.wordpiece_words(F.col("text")).alias("tokens"))
    return sw.wordpiece_vocabulary(tokens, size=500, longest=12)


def encoded_columns(df):
    return df.select(
        "doc_id",
        F.array_join("tokens", " ").alias("tokens"),
        F.array_join(F.col("input_ids").cast("array<string>"), " ").alias("input_ids"),
        F.size("attention_mask").cast("bigint").alias("n_tokens"),
    )


def _encoded_sql(tokens: str, relation: str, vocabulary: str, specials: tuple[str, ...]) -> str:
    fixed = " UNION ALL ".join(f"SELECT {quote(t)} AS piece, {i} AS id" for i, t in enumerate(specials))
    return f"""
    ids AS ({fixed} UNION ALL SELECT piece, {len(specials) - 1} + row_number() OVER (ORDER BY n DESC, piece)
        FROM {vocabulary}),
    flat AS (SELECT doc_id, unnest({tokens}) AS piece, generate_subscripts({tokens}, 1) AS pos FROM {relation})
    SELECT doc_id, string_agg(piece, ' ' ORDER BY pos) AS tokens, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos)
        AS input_ids, count(*) AS n_tokens FROM flat JOIN ids USING (piece) GROUP BY doc_id"""


@query(
    "wordpiece_encode",
    lambda: f"WITH RECURSIVE {VOCABULARIES}, {RAW_TEXTS}, {WORDPIECE}, "
    + _encoded_sql("wp", "wp_tokens", "wp_vocab", sw.WORDPIECE_SPECIALS),
)
def run_wordpiece(spark, folder):
    documents = documents_of(spark, folder)
    return encoded_columns(sw.encode_wordpiece(documents, sw.wordpiece_segmenter(documents)))


@query(
    "sentencepiece_encode",
    lambda: f"WITH RECURSIVE {VOCABULARIES}, {RAW_TEXTS}, {SENTENCEPIECE}, "
    + _encoded_sql("sp", "sp_tokens", "sp_vocab", sw.SENTENCEPIECE_SPECIALS),
)
def run_sentencepiece(spark, folder):
    documents = documents_of(spark, folder)
    return encoded_columns(sw.encode_sentencepiece(documents, sw.sentencepiece_segmenter(documents)))


@query(
    "tokenizer_comparison",
    lambda: f"""WITH RECURSIVE {COMPARISON}
    SELECT dataset, split, indice AS example_index, CAST(indice AS VARCHAR) AS source_sentence_id, texto AS text,
        {joined('original')} AS original_tokens, {quote(sw.WORDPIECE_MODEL)} AS beto_model, {joined('wp')} AS beto_tokens,
        CAST(len(wp) AS BIGINT) AS beto_token_count, {quote(sw.SENTENCEPIECE_MODEL)} AS t5_model,
        {joined('sp')} AS t5_tokens, CAST(len(sp) AS BIGINT) AS t5_token_count FROM compared""",
)
def run_comparison(spark, folder):
    rows = comparison(spark, folder).drop("source_file")
    return rows.withColumns(
        {c: F.array_join(c, " ") for c in ("original_tokens", "beto_tokens", "t5_tokens")}
    )


@query(
    "join_tokenized",
    lambda: f"""WITH RECURSIVE {COMPARISON}
    SELECT dataset, split, indice AS example_index, texto AS text, CAST(len(wp) AS BIGINT) AS beto_token_count,
        CAST(len(sp) AS BIGINT) AS t5_token_count FROM compared""",
)
def run_join(spark, folder):
    keys = ["dataset", "split", "example_index"]
    path = scratch_path(spark, "comparison")  # encoded once, used three times; each reads its own columns
    comparison(spark, folder).select(*keys, "original_tokens", "beto_tokens", "t5_tokens").write.parquet(path)
    rows = spark.read.parquet(path)
    wordpiece = rows.select(*keys, F.col("beto_tokens").alias("tokens"))
    sentencepiece = rows.select(*keys, F.col("t5_tokens").alias("tokens"))
    found = sw.join_tokenized(rows.select(*keys, "original_tokens"), wordpiece, sentencepiece)
    return found.select(*keys, "text", "beto_token_count", "t5_token_count")
