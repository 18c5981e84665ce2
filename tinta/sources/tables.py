"""CSV/TSV tables and the layouts a sentence table may come in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tinta.functions.text import cell_tokens, find_column, split_words, strip
from tinta.operators.ranking import row_positions
from tinta.sources.files import TABLE_SUFFIXES, list_files

# Column names searched for, in order of preference.
GROUPED_COLUMNS = (
    "tokens",
    "tokenized_sentence",
    "tokenized_sentences",
    "words",
    "sentence_tokens",
    "oracion_tokens",
    "oración_tokens",
)
TEXT_COLUMNS = ("sentence", "sentencia", "oracion", "oración", "text", "texto")
TOKEN_COLUMNS = ("word", "token", "form", "palabra", "term")
SENTENCE_ID_COLUMNS = (
    "sentence #",
    "sentence_id",
    "sentence id",
    "sent_id",
    "sentid",
    "id_sentence",
    "id_sentencia",
    "oracion_id",
    "oración_id",
    "sentence",
)

# Cells read as missing, besides the empty one.
MISSING_CELLS = (
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

POSITION = "_row"
BLOCK_ROWS = 4096


def read_table(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Header table, comma or tab by suffix, with missing cells as NULL and a row position ``_row``.

    A file is split over tasks unless ``multi_line`` says that quoted cells may hold line ends.
    """
    suffix = path.lower().rsplit(".", 1)[-1]
    if suffix in ("xlsx", "xls"):
        raise ValueError("convert Excel files to CSV first")
    separator = "\t" if suffix == "tsv" else ","
    options = {"header": True, "sep": separator, "multiLine": multi_line, "quote": '"', "escape": '"'}
    raw = spark.read.options(**options).csv(path)
    cells = {
        column: F.when(~F.col(f"`{column}`").isin(*MISSING_CELLS), F.col(f"`{column}`"))
        for column in raw.columns
    }
    table = raw.select(*[cell.alias(column) for column, cell in cells.items()])
    return row_positions(_with_numeric_types(table), POSITION)


def _with_numeric_types(table: DataFrame) -> DataFrame:
    """Columns whose every value is a number become numeric; one aggregation decides for all."""
    if not table.columns:
        return table
    number = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$"

    def all_match(column: str, pattern: str, alias: str) -> Column:
        cell = F.col(f"`{column}`")
        return (F.count(cell) == F.count_if(cell.rlike(pattern))).alias(alias)

    flags = table.agg(
        *[all_match(c, number, f"d{i}") for i, c in enumerate(table.columns)],
        *[all_match(c, r"^\s*[+-]?\d{1,18}\s*$", f"i{i}") for i, c in enumerate(table.columns)],
    ).first()

    def typed(i: int, column: str) -> Column:
        cell = F.col(f"`{column}`")
        kind = "bigint" if flags[f"i{i}"] else "double" if flags[f"d{i}"] else "string"
        return (cell if kind == "string" else F.trim(cell).cast(kind)).alias(column)

    return table.select(*[typed(i, c) for i, c in enumerate(table.columns)])


def load_table_corpus(spark: SparkSession, folder: str, multi_line: bool = False) -> DataFrame:
    """Sentences of the first table (in name order) of a folder."""
    first = list_files(spark, folder, TABLE_SUFFIXES).orderBy("path").first()
    if first is None:
        raise FileNotFoundError(f"no table file in {folder}")
    return sentences_from_table(read_table(spark, first["path"], multi_line))


def identifier_flags(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column_name, n_values, n_distinct, is_identifier`` per column, in one aggregation.

    A column looks like an identifier if it is numeric or under half of its values are distinct.
    Digests keep long texts out of the shuffle of the distinct count.
    """
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    narrow = df.select(*[F.md5(F.col(f"`{c}`").cast("string")).alias(f"k{i}") for i, c in enumerate(columns)])
    counts = narrow.agg(
        *[F.count(f"k{i}").alias(f"n{i}") for i in range(len(columns))],
        *[F.count_distinct(f"k{i}").alias(f"d{i}") for i in range(len(columns))],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"n{i}").alias("n_values"),
            F.col(f"d{i}").alias("n_distinct"),
            F.lit(c in numeric).alias("is_numeric"),
        )
        for i, c in enumerate(columns)
    ]
    few = F.col("n_distinct") / F.col("n_values") < 0.5
    return counts.select(F.inline(F.array(*rows))).select(
        "column_name",
        "n_values",
        "n_distinct",
        F.when(F.col("n_values") == 0, False).otherwise(F.col("is_numeric") | few).alias("is_identifier"),
    )


def sentences_from_table(
    df: DataFrame,
    token_column: str | None = None,
    sentence_id_column: str | None = None,
    grouped_column: str | None = None,
    position: str = POSITION,
) -> DataFrame:
    """Infer the layout of a table and return its sentences.

    Tried in order: a column of grouped tokens, token rows with a sentence id, a text column.
    """
    columns = [c for c in df.columns if c != position]
    rows = df.na.drop("all", subset=columns)
    grouped = grouped_column or find_column(columns, GROUPED_COLUMNS)
    if grouped:
        return sentences_from_grouped(rows, grouped, position)
    token = token_column or find_column(columns, TOKEN_COLUMNS)
    sentence_id = sentence_id_column or find_column(columns, SENTENCE_ID_COLUMNS)
    if token and sentence_id:
        return sentences_from_token_rows(rows, token, sentence_id, position)
    text = find_column(columns, TEXT_COLUMNS)
    if text and not identifier_flags(rows, [text]).first()["is_identifier"]:
        return sentences_from_text(rows, text, position)
    raise ValueError(
        f"cannot infer sentences from the columns {columns}; name token_column and "
        "sentence_id_column, or grouped_column"
    )


def _sentence_columns(sentence_id: Column, pos: Column, text: Column, column: str | None) -> list[Column]:
    return [
        sentence_id.cast("string").alias("sentence_id"),
        pos.cast("bigint").alias("pos"),
        F.col("tokens"),
        text.alias("text"),
        F.lit(None).cast("string").alias("source_file"),
        F.lit(column).cast("string").alias("source_column"),
    ]


def sentences_from_grouped(df: DataFrame, column: str, position: str) -> DataFrame:
    cell = F.col(f"`{column}`")
    is_array = isinstance(df.schema[column].dataType, T.ArrayType)
    tokens = F.filter(cell, lambda t: strip(t) != "") if is_array else cell_tokens(cell.cast("string"))
    found = df.where(cell.isNotNull()).select(F.col(position), tokens.alias("tokens"))
    text = F.array_join("tokens", " ")
    return found.where(F.size("tokens") > 0).select(
        *_sentence_columns(F.col(position), F.col(position), text, column)
    )


def sentences_from_text(df: DataFrame, column: str, position: str) -> DataFrame:
    text = F.col(f"`{column}`").cast("string")
    found = df.where(text.isNotNull()).select(
        F.col(position), text.alias("_text"), split_words(text).alias("tokens")
    )
    return found.where(F.size("tokens") > 0).select(
        *_sentence_columns(F.col(position), F.col(position), F.col("_text"), column)
    )


def sentences_from_token_rows(
    df: DataFrame, token: str, sentence_id: str, position: str, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Token rows to sentences, tokens in row order, one output row per sentence id.

    Two levels, so a sentence that holds a large part of all rows is sorted in many tasks: first
    blocks of consecutive rows per sentence, then the few blocks of a sentence in order.
    """
    word = F.col(f"`{token}`").cast("string")
    rows = df.where(word.isNotNull() & F.col(f"`{sentence_id}`").isNotNull()).select(
        F.col(f"`{sentence_id}`").alias("_id"), F.col(position).alias("_pos"), word.alias("_word")
    )
    ordered = F.array_sort(F.collect_list(F.struct("_pos", "_word")))
    blocks = (
        rows.where(strip(F.col("_word")) != "")
        .groupBy("_id", F.floor(F.col("_pos") / block_rows).alias("_block"))
        .agg(F.transform(ordered, lambda x: x["_word"]).alias("_words"), F.min("_pos").alias("_first"))
    )
    in_order = F.array_sort(F.collect_list(F.struct("_block", "_words")))
    sentences = blocks.groupBy("_id").agg(
        F.flatten(F.transform(in_order, lambda x: x["_words"])).alias("tokens"),
        F.min("_first").alias("_pos"),
    )
    return sentences.select(
        *_sentence_columns(F.col("_id"), F.col("_pos"), F.array_join("tokens", " "), token)
    )
