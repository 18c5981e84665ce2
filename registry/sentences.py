"""Input layouts, splits and first rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query
from registry.sqltext import joined, words
from tinta.functions.rows import posexplode_rows
from tinta.functions.text import cell_tokens, column_key_expr, parse_token_list, split_words
from tinta.operators.splits import first_per_split, split_counts, split_rows
from tinta.session import scratch_path, spread
from tinta.sources.conll import parse_conll, read_conll
from tinta.sources.corpus import load
from tinta.sources.files import split_files
from tinta.sources.tables import (
    identifier_flags,
    sentences_from_grouped,
    sentences_from_text,
    sentences_from_token_rows,
)


@query(
    "split_files",
    """WITH files AS (
        SELECT source, doc_id || ['.train', '_dev-', ' test ', ' Valid.', 'misc', '-training']
            [1 + doc_id % 6] || lang || ['.txt', '.conll', '.csv'][1 + doc_id % 3] AS name FROM documents),
    aliases AS (SELECT * FROM (VALUES ('train', 'train'), ('train', 'training'), ('validation', 'validation'),
        ('validation', 'valid'), ('validation', 'val'), ('validation', 'dev'), ('validation', 'development'),
        ('test', 'test'), ('test', 'testing')) AS t(split, alias)),
    matched AS (
        SELECT DISTINCT source, name, split FROM files, aliases
        WHERE list_contains(string_split(trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')), ' '), alias)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY source, split ORDER BY length(name), lower(name), name)
        AS r FROM matched)
    SELECT source, name, split FROM ranked WHERE r = 1""",
)
def run_split_files(spark, folder):
    kind = F.element_at(
        F.array(*[F.lit(k) for k in (".train", "_dev-", " test ", " Valid.", "misc", "-training")]),
        (F.col("doc_id") % 6 + 1).cast("int"),
    )
    suffix = F.element_at(
        F.array(*[F.lit(s) for s in (".txt", ".conll", ".csv")]), (F.col("doc_id") % 3 + 1).cast("int")
    )
    files = load(spark, folder, "documents").select(
        "source", F.concat(F.col("doc_id").cast("string"), kind, "lang", suffix).alias("name")
    )
    return split_files(files, ["source"]).select("source", "name", "split")


CONLL_SQL = """WITH lines AS (
        SELECT doc_id, unnest(string_split(conll, chr(10))) AS line, generate_subscripts(string_split(conll, chr(10)), 1) AS n
        FROM (SELECT doc_id, '# ' || source || chr(10) || replace(replace(text, chr(10), ' O' || chr(10) || '  ' || chr(10)),
            ' ', ' O' || chr(10)) || ' O' AS conll FROM documents)),
    numbered AS (SELECT doc_id, n, trim(line) AS line,
        count(CASE WHEN trim(line) = '' THEN 1 END) OVER (PARTITION BY doc_id ORDER BY n) AS block FROM lines),
    blocks AS (SELECT doc_id, block, string_agg(string_split(line, ' ')[1], ' ' ORDER BY n) AS text, count(*) AS n_tokens
        FROM numbered WHERE line <> '' AND line NOT LIKE '#%' GROUP BY doc_id, block)
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY block) - 1 AS pos, text, n_tokens FROM blocks"""


def conll_texts(spark, folder):
    newline = F.lit(" O\n  \n")
    body = F.replace(F.replace("text", F.lit("\n"), newline), F.lit(" "), F.lit(" O\n"))
    return load(spark, folder, "documents").select(
        "doc_id", F.concat(F.lit("# "), "source", F.lit("\n"), body, F.lit(" O")).alias("value")
    )


@query("conll_parse", CONLL_SQL)
def run_conll(spark, folder):
    return parse_conll(conll_texts(spark, folder)).select(
        "doc_id", "pos", "text", F.size("tokens").cast("bigint").alias("n_tokens")
    )


@query("conll_read", f"SELECT text, n_tokens FROM ({CONLL_SQL})")
def run_conll_read(spark, folder):
    """The same sentences out of CoNLL files, which are written first; documents end with a blank line."""
    path = scratch_path(spark, "conll")
    texts = spread(conll_texts(spark, folder).select(F.concat("value", F.lit("\n")).alias("value")))
    texts.write.text(path, compression="gzip")
    return read_conll(spark, path).select("text", F.size("tokens").cast("bigint").alias("n_tokens"))



@query(
    "token_rows_to_sentences",
    f"""SELECT CAST(doc_id AS VARCHAR) AS sentence_id, {joined(words('text'))} AS text,
        CAST(len({words('text')}) AS BIGINT) AS n_tokens FROM documents WHERE len({words('text')}) > 0""",
)
def run_token_rows(spark, folder):
    documents = load(spark, folder, "documents")
    rows = posexplode_rows(documents, split_words(F.col("text")), "_row", "word", "doc_id")
    sentences = sentences_from_token_rows(rows, "word", "doc_id", "_row")
    return sentences.select("sentence_id", "text", F.size("tokens").cast("bigint").alias("n_tokens"))


@query(
    "grouped_tokens",
    r"""WITH words AS (SELECT doc_id, regexp_extract_all(text, '[\p{L}]+') AS w FROM documents)
    SELECT CAST(doc_id AS VARCHAR) AS sentence_id, array_to_string(w, ' ') AS text, CAST(len(w) AS BIGINT) AS n_tokens
    FROM words WHERE len(w) > 0""",
)
def run_grouped(spark, folder):
    found = F.regexp_extract_all("text", F.lit(r"[\p{L}]+"), F.lit(0))
    literal = F.concat(F.lit("['"), F.array_join(found, "', '"), F.lit("']"))
    cells = load(spark, folder, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 2 == 0, literal).otherwise(F.array_join(found, " ")).alias("tokens")
    )
    blank = cells.withColumn("tokens", F.when(F.col("tokens") != "['']", F.col("tokens")))
    sentences = sentences_from_grouped(blank, "tokens", "doc_id")
    return sentences.select("sentence_id", "text", F.size("tokens").cast("bigint").alias("n_tokens"))


@query(
    "text_sentences",
    f"""SELECT CAST(doc_id AS VARCHAR) AS sentence_id, text, {joined(words('text'))} AS tokens
    FROM documents WHERE len({words('text')}) > 0""",
)
def run_text(spark, folder):
    sentences = sentences_from_text(load(spark, folder, "documents"), "text", "doc_id")
    return sentences.select("sentence_id", "text", F.array_join("tokens", " ").alias("tokens"))


@query(
    "identifier_ratio",
    """SELECT 'doc_id' AS column_name, count(doc_id) AS n_values, count(DISTINCT doc_id) AS n_distinct,
        true AS is_identifier FROM documents
    UNION ALL SELECT 'text', count(text), count(DISTINCT text), count(DISTINCT text) / count(text) < 0.5 FROM documents
    UNION ALL SELECT 'source', count(source), count(DISTINCT source), count(DISTINCT source) / count(source) < 0.5
        FROM documents""",
)
def run_identifier(spark, folder):
    return identifier_flags(load(spark, folder, "documents"), ["doc_id", "text", "source"])


@query(
    "drop_null_rows",
    """SELECT e.event_id, regexp_extract(e.props, '"k":\\s*(\\d+)', 1) AS k FROM events e
    WHERE e.user_id IS NOT NULL AND regexp_extract(e.props, '"k":\\s*(\\d+)', 1) <> ''""".replace("\\\\", "\\"),
)
def run_drop_nulls(spark, folder):
    found = F.nullif(F.regexp_extract("props", r'"k":\s*(\d+)', 1), F.lit(""))
    rows = load(spark, folder, "events").select("event_id", "user_id", found.alias("k"))
    return rows.na.drop("all").na.drop(subset=["user_id", "k"]).select("event_id", "k")


SPLIT_CTE = """
    ordered AS (SELECT doc_id, source, md5('42|' || doc_id) AS shuffle_key,
        row_number() OVER (ORDER BY md5('42|' || doc_id)) AS r, count(*) OVER () AS n FROM documents),
    split AS (SELECT doc_id, source, shuffle_key, CASE WHEN r <= floor(n * 0.70::DOUBLE) THEN 'train'
        WHEN r <= floor(n * 0.70::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'validation' ELSE 'test' END AS split
        FROM ordered)
"""


@query("split_70_15_15", f"WITH {SPLIT_CTE} SELECT doc_id, shuffle_key, split FROM split")
def run_split(spark, folder):
    return split_rows(load(spark, folder, "documents").select("doc_id"), "doc_id")


def split_documents(spark, folder):
    documents = load(spark, folder, "documents").select("doc_id", F.col("source").alias("dataset"), "text")
    return split_rows(documents, "doc_id")


@query(
    "first_n_per_split",
    f"""WITH {SPLIT_CTE}, ranked AS (SELECT doc_id, source AS dataset, split,
        row_number() OVER (PARTITION BY source, split ORDER BY shuffle_key) AS example_index FROM split)
    SELECT doc_id, dataset, split, example_index FROM ranked WHERE example_index <= 3""",
)
def run_first(spark, folder):
    first = first_per_split(split_documents(spark, folder), ["shuffle_key"], 3, ("dataset", "split"))
    return first.select("doc_id", "dataset", "split", "example_index")


@query(
    "examples_table",
    f"""WITH {SPLIT_CTE}, ranked AS (SELECT *, row_number() OVER (PARTITION BY source, split ORDER BY shuffle_key)
        AS indice FROM split)
    SELECT source AS dataset, split, indice, {joined(words('text'))} AS tokens,
        CAST(len({words('text')}) AS BIGINT) AS n_tokens
    FROM ranked JOIN documents USING (doc_id) WHERE indice <= 3""".replace(
        "SELECT source AS", "SELECT ranked.source AS"
    ),
)
def run_examples(spark, folder):
    first = first_per_split(split_documents(spark, folder), ["shuffle_key"], 3, ("dataset", "split"))
    tokens = split_words(F.col("text"))
    return first.select(
        "dataset",
        "split",
        F.col("example_index").alias("indice"),
        F.array_join(tokens, " ").alias("tokens"),
        F.size(tokens).cast("bigint").alias("n_tokens"),
    )


@query(
    "split_counts",
    f"WITH {SPLIT_CTE} SELECT source AS dataset, split, count(*) AS n_examples FROM split GROUP BY 1, 2",
)
def run_split_counts(spark, folder):
    return split_counts(split_documents(spark, folder))


@query(
    "column_keys",
    """SELECT url, trim(regexp_replace(lower(url), '[^a-z0-9]+', '_', 'g'), '_') AS key FROM pages""",
)
def run_column_keys(spark, folder):
    return load(spark, folder, "pages").select("url", column_key_expr(F.col("url")).alias("key"))


@query(
    "parse_token_list",
    r"""WITH words AS (SELECT conv_id, turn, regexp_extract_all(text, '[\p{L}]+') AS w FROM conversations)
    SELECT conv_id, turn, CASE WHEN len(w) = 0 THEN '' ELSE array_to_string(w, '/') END AS tokens FROM words""",
)
def run_token_cells(spark, folder):
    found = F.regexp_extract_all("text", F.lit(r"[\p{L}]+"), F.lit(0))
    literal = F.concat(F.lit("['"), F.array_join(found, "', '"), F.lit("']"))
    double = F.concat(F.lit('["'), F.array_join(found, '", "'), F.lit('"]'))
    loose = F.concat(F.lit("["), F.array_join(found, ", "), F.lit("]"))
    rows = load(spark, folder, "conversations").select(
        "conv_id",
        "turn",
        F.when(F.size(found) == 0, F.lit(" "))
        .when(F.col("turn") % 3 == 0, literal)
        .when(F.col("turn") % 3 == 1, double)
        .otherwise(loose)
        .alias("cell"),
    )
    return rows.select("conv_id", "turn", F.array_join(parse_token_list(F.col("cell")), "/").alias("tokens"))


@query(
    "cell_tokens",
    r"""SELECT conv_id, turn, array_to_string(regexp_extract_all(text, '[\p{L}]+'), '/') AS tokens FROM conversations""",
)
def run_cell_tokens(spark, folder):
    found = F.regexp_extract_all("text", F.lit(r"[\p{L}]+"), F.lit(0))
    literal = F.concat(F.lit("['"), F.array_join(found, "', '"), F.lit("', ' ']"))
    rows = load(spark, folder, "conversations").select(
        "conv_id",
        "turn",
        F.when(F.size(found) == 0, F.lit(" "))
        .when(F.col("turn") % 2 == 0, literal)
        .otherwise(F.array_join(found, " \n "))
        .alias("cell"),
    )
    return rows.select("conv_id", "turn", F.array_join(cell_tokens(F.col("cell")), "/").alias("tokens"))
