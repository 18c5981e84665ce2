"""Fragmentation metrics of tokenized sentences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tinta.functions.text import parse_token_list
from tinta.functions.tokens import (
    continuations,
    count_unknown,
    ratio,
    round_even,
    space_markers,
    tokenizer_kind,
    without_specials,
)
from tinta.session import stored

# Names of the analysis table for those of the comparison table.
RENAMES = {
    "example_index": "indice_sentencia",
    "text": "texto_reconstruido",
    "original_tokens": "tokens_originales",
    "beto_tokens": "tokens_wordpiece_beto",
    "t5_tokens": "tokens_sentencepiece_t5",
    "beto_token_count": "n_subtokens_wordpiece",
    "t5_token_count": "n_subtokens_sentencepiece",
}
REQUIRED = (
    "dataset",
    "split",
    "indice_sentencia",
    "tokens_originales",
    "texto_reconstruido",
    "tokens_wordpiece_beto",
    "tokens_sentencepiece_t5",
)
ANALYSIS_COLUMNS = (
    "dataset",
    "split",
    "indice_sentencia",
    "n_tokens_originales",
    "n_subtokens_wordpiece_sin_especiales",
    "n_subtokens_sentencepiece_sin_especiales",
    "razon_fragmentacion_wordpiece_sin_especiales",
    "razon_fragmentacion_sentencepiece_sin_especiales",
    "n_unknown_sentencepiece",
    "n_continuaciones_wordpiece",
    "tokenizador_menos_fragmentado",
)
WINNERS = ("wordpiece", "sentencepiece", "empate")


def rename_comparison(df: DataFrame) -> DataFrame:
    renamed = df.withColumnsRenamed(RENAMES)
    missing = sorted(set(REQUIRED) - set(renamed.columns))
    if missing:
        raise ValueError(f"required columns are missing: {missing}")
    return renamed


def _size(tokens: str | Column) -> Column:
    return F.size(tokens).cast("bigint")


def enrich(df: DataFrame) -> DataFrame:
    """All metrics of a comparison table, by projection only. Text cells are parsed into arrays."""
    renamed = rename_comparison(df)
    lists = ("tokens_originales", "tokens_wordpiece_beto", "tokens_sentencepiece_t5")
    parsed = {
        c: parse_token_list(F.col(c)) for c in lists if not isinstance(renamed.schema[c].dataType, T.ArrayType)
    }
    rows = renamed.withColumns(parsed) if parsed else renamed
    bare = {
        kind: without_specials(F.col(f"tokens_{kind}_{model}"), kind)
        for kind, model in (("wordpiece", "beto"), ("sentencepiece", "t5"))
    }
    rows = rows.withColumns(
        {
            "n_tokens_originales": _size("tokens_originales"),
            "n_subtokens_wordpiece": _size("tokens_wordpiece_beto"),
            "n_subtokens_sentencepiece": _size("tokens_sentencepiece_t5"),
            **{f"tokens_{kind}_sin_especiales": tokens for kind, tokens in bare.items()},
            "n_unknown_wordpiece": count_unknown(F.col("tokens_wordpiece_beto")),
            "n_unknown_sentencepiece": count_unknown(F.col("tokens_sentencepiece_t5")),
            "subtokens_con_prefijo_wordpiece": continuations(F.col("tokens_wordpiece_beto")),
            "tokens_con_marca_sentencepiece": space_markers(F.col("tokens_sentencepiece_t5")),
        }
    )
    rows = rows.withColumns(
        {f"n_subtokens_{kind}_sin_especiales": _size(f"tokens_{kind}_sin_especiales") for kind in bare}
        | {
            "n_continuaciones_wordpiece": _size("subtokens_con_prefijo_wordpiece"),
            "n_marcas_sentencepiece": _size("tokens_con_marca_sentencepiece"),
            "es_sentencia_corta": F.col("n_tokens_originales") <= 1,
            "es_sentencia_informativa": F.col("n_tokens_originales") > 3,
        }
    )
    originals = F.col("n_tokens_originales")
    ratios = {}
    for kind in bare:
        for ending in ("", "_sin_especiales"):
            ratios[f"razon_fragmentacion_{kind}{ending}"] = ratio(
                F.col(f"n_subtokens_{kind}{ending}"), originals
            )
    return rows.withColumns(ratios)


def enriched(df: DataFrame) -> DataFrame:
    """The metrics, computed only if the table lacks them."""
    return df if "es_sentencia_informativa" in df.columns else enrich(df)


def with_winner(df: DataFrame) -> DataFrame:
    """The tokenizer that fragments less; a missing ratio or equal ones are a tie."""
    rows = enriched(df)
    wordpiece = F.col("razon_fragmentacion_wordpiece_sin_especiales")
    sentencepiece = F.col("razon_fragmentacion_sentencepiece_sin_especiales")
    winner = (
        F.when(wordpiece < sentencepiece, WINNERS[0])
        .when(sentencepiece < wordpiece, WINNERS[1])
        .otherwise(WINNERS[2])
    )
    return rows.withColumn("tokenizador_menos_fragmentado", winner)


def winner_counts(df: DataFrame) -> DataFrame:
    """Sentences per winner; winners without a sentence count 0."""
    winner = "tokenizador_menos_fragmentado"
    rows = df if winner in df.columns else with_winner(df)
    counts = rows.agg(*[F.count_if(F.col(winner) == w).alias(w) for w in WINNERS])
    pairs = [F.struct(F.lit(w).alias(winner), F.col(w).alias("n_sentencias")) for w in WINNERS]
    return counts.select(F.inline(F.array(*pairs)))


def _mean(value: Column) -> Column:
    """Mean to three places. Ratios hold three places, so whole thousandths make the sum exact."""
    thousandths = F.round(value * 1000).cast("bigint")
    return round_even(F.sum(thousandths) / F.nullif(F.count(thousandths), F.lit(0)) / 1000, 3)


def summarize(df: DataFrame, by: str | None = "dataset") -> DataFrame:
    """Summary of all rows (``grupo = 'global'``) and, with ``by``, of each of its values.

    One aggregation over grouping sets serves both; a NULL value of ``by`` keeps a row of its own.
    """
    rows = enriched(df)
    wordpiece = F.col("razon_fragmentacion_wordpiece_sin_especiales")
    sentencepiece = F.col("razon_fragmentacion_sentencepiece_sin_especiales")
    informative, long = F.col("es_sentencia_informativa"), ~F.col("es_sentencia_corta")
    measures = [
        F.count("*").alias("n_sentencias"),
        F.count_if(informative).alias("n_sentencias_informativas"),
        _mean(F.col("razon_fragmentacion_wordpiece")).alias("promedio_wordpiece_con_especiales"),
        _mean(F.col("razon_fragmentacion_sentencepiece")).alias("promedio_sentencepiece_con_especiales"),
        _mean(wordpiece).alias("promedio_wordpiece_sin_especiales"),
        _mean(sentencepiece).alias("promedio_sentencepiece_sin_especiales"),
        _mean(F.when(long, wordpiece)).alias("promedio_wordpiece_sin_sentencias_cortas"),
        _mean(F.when(long, sentencepiece)).alias("promedio_sentencepiece_sin_sentencias_cortas"),
        _mean(F.when(informative, wordpiece)).alias("promedio_wordpiece_sentencias_informativas"),
        _mean(F.when(informative, sentencepiece)).alias("promedio_sentencepiece_sentencias_informativas"),
        F.coalesce(F.sum("n_unknown_wordpiece"), F.lit(0)).alias("total_unknown_wordpiece"),
        F.coalesce(F.sum("n_unknown_sentencepiece"), F.lit(0)).alias("total_unknown_sentencepiece"),
        _mean(F.col("n_continuaciones_wordpiece")).alias("promedio_continuaciones_wordpiece"),
        _mean(F.col("n_marcas_sentencepiece")).alias("promedio_marcas_sentencepiece"),
    ]
    if by is None:
        return rows.agg(*measures).select(F.lit("global").alias("grupo"), "*")
    grouped = rows.groupingSets([[], [F.col(by)]], F.col(by)).agg(F.grouping(by).alias("_all"), *measures)
    label = F.when(F.col("_all") == 1, "global").otherwise(F.col(by))
    return grouped.select(label.alias("grupo"), "*").drop("_all")


def most_fragmented(df: DataFrame, tokenizer: str, n: int = 5) -> DataFrame:
    """The n sentences with the highest ratio without specials; missing ratios come last."""
    score = f"razon_fragmentacion_{tokenizer_kind(tokenizer)}_sin_especiales"
    columns = (
        "dataset",
        "split",
        "indice_sentencia",
        "texto_reconstruido",
        "n_tokens_originales",
        score,
        "tokens_wordpiece_beto",
        "tokens_sentencepiece_t5",
    )
    rows = enriched(df)
    order = (F.desc_nulls_last(score), "dataset", "split", "indice_sentencia")
    return rows.orderBy(*order).limit(n).select(*[c for c in columns if c in rows.columns])


def unknown_sentences(df: DataFrame) -> DataFrame:
    return enriched(df).where("n_unknown_sentencepiece > 0")


def informative_sentences(df: DataFrame) -> DataFrame:
    return enriched(df).where("es_sentencia_informativa")


def by_continuations(df: DataFrame) -> DataFrame:
    """Sentences in falling order of their WordPiece continuations.

    A sort reads its rows for the cuts of its ranges and again to move them, so they are stored: nothing is encoded twice.
    """
    rows = enriched(df)
    rows = rows.select("dataset", "split", "indice_sentencia", "subtokens_con_prefijo_wordpiece", "n_continuaciones_wordpiece")
    return stored(rows, "continuations").orderBy(F.desc("n_continuaciones_wordpiece"), "dataset", "split", "indice_sentencia")


def union_comparisons(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Comparisons of several datasets in one table; absent columns become NULL."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
