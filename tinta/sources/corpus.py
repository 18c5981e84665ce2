"""Raw corpus tables and JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tinta import schemas
from tinta.functions.text import split_words


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def read_corpus(spark: SparkSession, path: str, fmt: str = "parquet", text: str = "text") -> DataFrame:
    """Rows with a text; the filter and the column list reach the scan."""
    return with_text(spark.read.format(fmt).load(path), text)


def with_text(df: DataFrame, text: str = "text") -> DataFrame:
    return df.where(F.col(text).isNotNull() & (F.col(text) != ""))


def record_tokens(df: DataFrame, tokens: str = "tokens", text: str = "text") -> Column:
    """Tokens of a record: its token list, else the words of its text."""
    options = []
    if tokens in df.columns:
        options.append(F.col(tokens))
    if text in df.columns:
        options.append(split_words(F.col(text)))
    if not options:
        raise ValueError(f"neither {tokens!r} nor {text!r} among {df.columns}")
    return F.coalesce(*options)


def read_sentences_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Clean sentences; a malformed line fails the read."""
    rows = spark.read.schema(schemas.CLEAN_SENTENCE).option("mode", "FAILFAST").json(path)
    return rows.where(F.size("tokens") > 0)


def read_chunks_jsonl(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(schemas.CHUNK).option("mode", "FAILFAST").json(path)
    return rows.where(F.length("text") > 0)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """Report written as CSV."""
    return spark.read.csv(path, header=True, inferSchema=True, multiLine=True, escape='"')
