"""Clean corpus and its statistics."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tinta.functions.rows import explode_rows
from tinta.functions.text import clean_tokens, split_words
from tinta.functions.tokens import round_even
from tinta.sources.corpus import with_text

MIN_TOKENS = 2
TOP_TOKENS = 30
MIN_COUNT = 5


def clean_corpus(
    df: DataFrame, stopwords: Iterable[str] = (), text: str = "text", min_tokens: int = MIN_TOKENS
) -> DataFrame:
    """Replace the text by its clean tokens and drop rows with fewer than ``min_tokens``.

    Also accepts a streaming DataFrame.
    """
    rows = with_text(df, text).withColumn("tokens", clean_tokens(F.col(text), stopwords)).drop(text)
    return rows.where(F.size("tokens") >= min_tokens)


def first_rows(df: DataFrame, order: list[str | Column], n: int) -> DataFrame:
    """Early stop after n rows, in a stated order."""
    return df.orderBy(*order).limit(n)


def raw_and_clean(
    df: DataFrame, row_id: str, stopwords: Iterable[str] = (), text: str = "text", n: int | None = None
) -> DataFrame:
    """Original text beside its clean tokens, with both lengths; rows without clean tokens stay."""
    rows = with_text(df, text)
    if n is not None:
        rows = rows.orderBy(row_id).limit(n)
    return rows.select(
        row_id,
        F.col(text).alias("texto_original"),
        clean_tokens(F.col(text), stopwords).alias("tokens_limpios"),
        F.size(split_words(F.col(text))).cast("bigint").alias("longitud_original_aprox"),
    ).withColumn("longitud_limpia", F.size("tokens_limpios").cast("bigint"))


def token_counts(sentences: DataFrame) -> DataFrame:
    """``token, count`` of a corpus; Spark adds up per task before the shuffle, so hot tokens are cheap."""
    return explode_rows(sentences, F.col("tokens"), "token").groupBy("token").count()


def vocabulary(sentences: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    return token_counts(sentences).where(F.col("count") >= min_count)


def top_tokens(sentences: DataFrame, n: int = TOP_TOKENS) -> DataFrame:
    """``rank, token, count`` of the most frequent tokens, ties in token order."""
    best = token_counts(sentences).orderBy(F.desc("count"), "token").limit(n)
    window = Window.orderBy(F.desc("count"), "token")  # over n rows
    return best.withColumn("rank", F.row_number().over(window).cast("bigint"))


def corpus_statistics(sentences: DataFrame, top_n: int = TOP_TOKENS) -> DataFrame:
    """One row: sizes, mean/min/max length, vocabulary size and the most frequent tokens."""
    return statistics_of(sentence_lengths(sentences), token_counts(sentences), top_n)


def sentence_lengths(sentences: DataFrame) -> DataFrame:
    """One row: how many sentences and tokens there are, and the shortest and longest length (NULL without sentences)."""
    size = F.size("tokens").cast("bigint")
    return sentences.agg(
        F.count("*").alias("n_sentencias"),
        F.coalesce(F.sum(size), F.lit(0)).alias("total_tokens"),
        F.min(size).alias("longitud_minima"),
        F.max(size).alias("longitud_maxima"),
    )


def statistics_of(lengths: DataFrame, counts: DataFrame, top_n: int = TOP_TOKENS) -> DataFrame:
    """The statistics row from ``sentence_lengths`` and ``token, count``, however these were added up."""
    least = {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("longitud_minima", "longitud_maxima")}
    lengths = lengths.withColumns(least).withColumn(
        "longitud_promedio",
        F.coalesce(
            round_even(F.col("total_tokens") / F.nullif(F.col("n_sentencias"), F.lit(0)), 3), F.lit(0.0)
        ),
    )
    size_of_vocabulary = counts.agg(F.count("*").alias("vocabulario_unico")).scalar()
    best = counts.orderBy(F.desc("count"), "token").limit(top_n)
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("neg"), "token")))
    listed = best.agg(
        F.transform(
            ordered,
            lambda x: F.struct(x["token"].alias("token"), (-x["neg"]).alias("count")),
        ).alias("top")
    ).scalar()
    return lengths.select(
        "n_sentencias",
        "total_tokens",
        "longitud_promedio",
        "longitud_minima",
        "longitud_maxima",
        size_of_vocabulary.alias("vocabulario_unico"),
        listed.alias(f"top_{top_n}_tokens"),
    )


def statistics_long(statistics: DataFrame) -> DataFrame:
    """``metrica, valor`` rows of a statistics row: its numbers, then ``top_token_<rank>``."""
    top = next(c for c in statistics.columns if c.startswith("top_"))
    numbers = [c for c in statistics.columns if c != top]
    flat = F.array(
        *[F.struct(F.lit(c).alias("metrica"), F.col(c).cast("string").alias("valor")) for c in numbers]
    )
    ranked = F.transform(
        F.col(top),
        lambda x, i: F.struct(
            F.concat(F.lit("top_token_"), i + 1).alias("metrica"),
            F.concat_ws(":", x["token"], x["count"]).alias("valor"),
        ),
    )
    return statistics.select(F.inline(F.concat(flat, ranked)))
