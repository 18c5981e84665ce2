"""Fragmentation metrics over the tokenizer comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query
from registry.sqltext import joined
from registry.subwords import COMPARISON, comparison
from tinta.operators import token_metrics as tm
from tinta.functions.tokens import ratio
from tinta.session import cut_lineage

_RATIO = "round_even({} / nullif(n_tokens_originales, 0) * 1000, 0) / 1000"

ENRICHED = f"""
    {COMPARISON},
    counted AS (SELECT dataset, split, indice AS indice_sentencia, texto AS texto_reconstruido, wp, sp,
        CAST(len(original) AS BIGINT) AS n_tokens_originales,
        CAST(len(wp) AS BIGINT) AS n_subtokens_wordpiece, CAST(len(sp) AS BIGINT) AS n_subtokens_sentencepiece,
        list_filter(wp, lambda x: x NOT IN ('[CLS]', '[SEP]', '[PAD]')) AS wp_bare,
        list_filter(sp, lambda x: x NOT IN ('</s>', '<pad>')) AS sp_bare,
        CAST(len(list_filter(wp, lambda x: x = '<unk>')) AS BIGINT) AS n_unknown_wordpiece,
        CAST(len(list_filter(sp, lambda x: x = '<unk>')) AS BIGINT) AS n_unknown_sentencepiece,
        list_filter(wp, lambda x: starts_with(x, '##')) AS continued,
        list_filter(sp, lambda x: starts_with(x, '▁')) AS marked FROM compared),
    sized AS (SELECT *, CAST(len(wp_bare) AS BIGINT) AS n_subtokens_wordpiece_sin_especiales,
        CAST(len(sp_bare) AS BIGINT) AS n_subtokens_sentencepiece_sin_especiales,
        CAST(len(continued) AS BIGINT) AS n_continuaciones_wordpiece,
        CAST(len(marked) AS BIGINT) AS n_marcas_sentencepiece,
        n_tokens_originales <= 1 AS es_sentencia_corta, n_tokens_originales > 3 AS es_sentencia_informativa
        FROM counted),
    ratios AS (SELECT *, {_RATIO.format('n_subtokens_wordpiece')} AS razon_fragmentacion_wordpiece,
        {_RATIO.format('n_subtokens_sentencepiece')} AS razon_fragmentacion_sentencepiece,
        {_RATIO.format('n_subtokens_wordpiece_sin_especiales')} AS razon_fragmentacion_wordpiece_sin_especiales,
        {_RATIO.format('n_subtokens_sentencepiece_sin_especiales')} AS razon_fragmentacion_sentencepiece_sin_especiales
        FROM sized),
    enriched AS MATERIALIZED (SELECT *, CASE
        WHEN razon_fragmentacion_wordpiece_sin_especiales < razon_fragmentacion_sentencepiece_sin_especiales
            THEN 'wordpiece'
        WHEN razon_fragmentacion_sentencepiece_sin_especiales < razon_fragmentacion_wordpiece_sin_especiales
            THEN 'sentencepiece'
        ELSE 'empate' END AS tokenizador_menos_fragmentado FROM ratios)
"""

METRIC_COLUMNS = (
    "dataset, split, indice_sentencia, n_tokens_originales, n_subtokens_wordpiece, n_subtokens_sentencepiece, "
    "n_subtokens_wordpiece_sin_especiales, n_subtokens_sentencepiece_sin_especiales, razon_fragmentacion_wordpiece, "
    "razon_fragmentacion_sentencepiece, razon_fragmentacion_wordpiece_sin_especiales, "
    "razon_fragmentacion_sentencepiece_sin_especiales, n_unknown_wordpiece, n_unknown_sentencepiece, "
    "n_continuaciones_wordpiece, n_marcas_sentencepiece, es_sentencia_corta, es_sentencia_informativa"
).split(", ")


@query(
    "token_metrics",
    lambda: f"""WITH RECURSIVE {ENRICHED} SELECT {', '.join(METRIC_COLUMNS)}, {joined('wp_bare')} AS wp_bare,
        {joined('sp_bare')} AS sp_bare, {joined('continued')} AS continued, {joined('marked')} AS marked
    FROM enriched""",
)
def run_metrics(spark, folder):
    rows = tm.enrich(comparison(spark, folder))
    return rows.select(
        *METRIC_COLUMNS,
        F.array_join("tokens_wordpiece_sin_especiales", " ").alias("wp_bare"),
        F.array_join("tokens_sentencepiece_sin_especiales", " ").alias("sp_bare"),
        F.array_join("subtokens_con_prefijo_wordpiece", " ").alias("continued"),
        F.array_join("tokens_con_marca_sentencepiece", " ").alias("marked"),
    )


@query(
    "metrics_from_text_cells",
    lambda: f"""WITH RECURSIVE {ENRICHED} SELECT {', '.join(METRIC_COLUMNS)} FROM enriched""",
)
def run_metrics_from_cells(spark, folder):
    """The same from a comparison whose lists were written out as JSON text."""
    rows = comparison(spark, folder)
    lists = ("original_tokens", "beto_tokens", "t5_tokens")
    return tm.enrich(rows.withColumns({c: F.to_json(c) for c in lists})).select(*METRIC_COLUMNS)


@query(
    "winner_per_sentence",
    lambda: f"WITH RECURSIVE {ENRICHED} SELECT {', '.join(tm.ANALYSIS_COLUMNS)} FROM enriched",
)
def run_winner(spark, folder):
    return tm.with_winner(comparison(spark, folder)).select(*tm.ANALYSIS_COLUMNS)


@query(
    "winner_counts",
    lambda: f"""WITH RECURSIVE {ENRICHED},
    winners AS (SELECT * FROM (VALUES ('wordpiece'), ('sentencepiece'), ('empate')) AS t(tokenizador_menos_fragmentado))
    SELECT tokenizador_menos_fragmentado, count(enriched.dataset) AS n_sentencias
    FROM winners LEFT JOIN enriched USING (tokenizador_menos_fragmentado) GROUP BY 1""",
)
def run_winner_counts(spark, folder):
    return tm.winner_counts(comparison(spark, folder))


def _mean_sql(value: str) -> str:
    thousandths = f"CAST(round(({value}) * 1000) AS BIGINT)"
    return f"round_even(CAST(sum({thousandths}) AS BIGINT) / count({thousandths}) / 1000 * 1000, 0) / 1000"


def _summary_sql() -> str:
    wp, sp = (f"razon_fragmentacion_{k}_sin_especiales" for k in ("wordpiece", "sentencepiece"))
    means = {
        "promedio_wordpiece_con_especiales": "razon_fragmentacion_wordpiece",
        "promedio_sentencepiece_con_especiales": "razon_fragmentacion_sentencepiece",
        "promedio_wordpiece_sin_especiales": wp,
        "promedio_sentencepiece_sin_especiales": sp,
        "promedio_wordpiece_sin_sentencias_cortas": f"CASE WHEN NOT es_sentencia_corta THEN {wp} END",
        "promedio_sentencepiece_sin_sentencias_cortas": f"CASE WHEN NOT es_sentencia_corta THEN {sp} END",
        "promedio_wordpiece_sentencias_informativas": f"CASE WHEN es_sentencia_informativa THEN {wp} END",
        "promedio_sentencepiece_sentencias_informativas": f"CASE WHEN es_sentencia_informativa THEN {sp} END",
        "promedio_continuaciones_wordpiece": "n_continuaciones_wordpiece",
        "promedio_marcas_sentencepiece": "n_marcas_sentencepiece",
    }
    measures = ", ".join(f"{_mean_sql(value)} AS {name}" for name, value in means.items())
    return f"""count(*) AS n_sentencias, count(*) FILTER (es_sentencia_informativa) AS n_sentencias_informativas,
        CAST(sum(n_unknown_wordpiece) AS BIGINT) AS total_unknown_wordpiece,
        CAST(sum(n_unknown_sentencepiece) AS BIGINT) AS total_unknown_sentencepiece, {measures}"""


@query(
    "fragmentation_summary",
    lambda: f"""WITH RECURSIVE {ENRICHED}
    SELECT 'global' AS grupo, NULL AS dataset, {_summary_sql()} FROM enriched
    UNION ALL SELECT dataset, dataset, {_summary_sql()} FROM enriched GROUP BY dataset""",
)
def run_summary(spark, folder):
    return tm.summarize(comparison(spark, folder))


def _most_fragmented_sql(kind: str) -> str:
    score = f"razon_fragmentacion_{kind}_sin_especiales"
    return f"""WITH RECURSIVE {ENRICHED}
    SELECT dataset, split, indice_sentencia, texto_reconstruido, n_tokens_originales, {score},
        {joined('wp')} AS tokens_wordpiece_beto, {joined('sp')} AS tokens_sentencepiece_t5 FROM enriched
    ORDER BY {score} DESC NULLS LAST, dataset, split, indice_sentencia LIMIT 5"""


def _most_fragmented(spark, folder, kind):
    rows = tm.most_fragmented(comparison(spark, folder), kind)
    lists = ("tokens_wordpiece_beto", "tokens_sentencepiece_t5")
    return rows.withColumns({c: F.array_join(c, " ") for c in lists})


@query("most_fragmented_wp", lambda: _most_fragmented_sql("wordpiece"))
def run_most_wordpiece(spark, folder):
    return _most_fragmented(spark, folder, "beto")


@query("most_fragmented_sp", lambda: _most_fragmented_sql("sentencepiece"))
def run_most_sentencepiece(spark, folder):
    return _most_fragmented(spark, folder, "t5")


@query(
    "unknown_sentences",
    lambda: f"""WITH RECURSIVE {ENRICHED} SELECT dataset, split, indice_sentencia, texto_reconstruido,
        {joined('sp')} AS tokens_sentencepiece_t5, n_unknown_sentencepiece
    FROM enriched WHERE n_unknown_sentencepiece > 0""",
)
def run_unknown(spark, folder):
    rows = tm.unknown_sentences(comparison(spark, folder))
    return rows.select(
        "dataset",
        "split",
        "indice_sentencia",
        "texto_reconstruido",
        F.array_join("tokens_sentencepiece_t5", " ").alias("tokens_sentencepiece_t5"),
        "n_unknown_sentencepiece",
    )


@query(
    "informative_sentences",
    lambda: f"""WITH RECURSIVE {ENRICHED} SELECT dataset, split, indice_sentencia, n_tokens_originales,
        razon_fragmentacion_wordpiece_sin_especiales, razon_fragmentacion_sentencepiece_sin_especiales
    FROM enriched WHERE es_sentencia_informativa""",
)
def run_informative(spark, folder):
    return tm.informative_sentences(comparison(spark, folder)).select(
        "dataset",
        "split",
        "indice_sentencia",
        "n_tokens_originales",
        "razon_fragmentacion_wordpiece_sin_especiales",
        "razon_fragmentacion_sentencepiece_sin_especiales",
    )


@query(
    "by_continuations",
    lambda: f"""WITH RECURSIVE {ENRICHED} SELECT dataset, split, indice_sentencia,
        {joined('continued')} AS subtokens_con_prefijo_wordpiece, n_continuaciones_wordpiece
    FROM enriched ORDER BY n_continuaciones_wordpiece DESC, dataset, split, indice_sentencia""",
)
def run_continuations(spark, folder):
    prefix = "subtokens_con_prefijo_wordpiece"
    return tm.by_continuations(comparison(spark, folder)).withColumn(prefix, F.array_join(prefix, " "))


@query(
    "two_place_ratios",
    lambda: f"""WITH RECURSIVE {ENRICHED} SELECT dataset, split, indice_sentencia,
        round_even(n_subtokens_wordpiece / nullif(n_tokens_originales, 0) * 100, 0) / 100 AS razon_wordpiece,
        round_even(n_subtokens_sentencepiece / nullif(n_tokens_originales, 0) * 100, 0) / 100 AS razon_sentencepiece
    FROM enriched""",
)
def run_two_places(spark, folder):
    rows = tm.enriched(comparison(spark, folder))
    originals = F.col("n_tokens_originales")
    return rows.select(
        "dataset",
        "split",
        "indice_sentencia",
        ratio(F.col("n_subtokens_wordpiece"), originals, 2).alias("razon_wordpiece"),
        ratio(F.col("n_subtokens_sentencepiece"), originals, 2).alias("razon_sentencepiece"),
    )


@query(
    "union_comparisons",
    lambda: f"""WITH RECURSIVE {ENRICHED}
    SELECT dataset, count(*) AS n, CAST(sum(n_subtokens_wordpiece) AS BIGINT) AS wordpiece,
        CAST(sum(n_subtokens_sentencepiece) AS BIGINT) AS sentencepiece FROM enriched GROUP BY dataset""",
)
def run_union(spark, folder):
    rows = cut_lineage(comparison(spark, folder))  # encoded once, used twice
    trained, held_out = rows.where("split = 'train'"), rows.where("split <> 'train'").drop("source_file")
    return (
        tm.union_comparisons(trained, held_out)
        .groupBy("dataset")
        .agg(
            F.count("*").alias("n"),
            F.sum("beto_token_count").alias("wordpiece"),
            F.sum("t5_token_count").alias("sentencepiece"),
        )
    )
