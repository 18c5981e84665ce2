"""Tokenizer study: split, pick examples, encode twice, enrich, summarize."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tinta.operators import subword as sw
from tinta.operators import token_metrics as tm
from tinta.operators.splits import first_per_split
from tinta.sinks.writers import save_report
from tinta.sources.corpus import record_tokens


@dataclass(frozen=True)
class TokenizerStudy:
    comparison: DataFrame
    enriched: DataFrame
    summary: DataFrame
    most_fragmented_wordpiece: DataFrame
    most_fragmented_sentencepiece: DataFrame
    winners: DataFrame

    def save(self, path: str) -> None:
        for name, report in vars(self).items():
            save_report(report, f"{path}/{name}")


def examples_by_split(
    sentences: DataFrame, dataset: str, order: list[str | Column], n: int = 3
) -> DataFrame:
    """The first n sentences of each split in the shape the comparison takes."""
    rows = sentences.withColumn("dataset", F.lit(dataset))
    first = first_per_split(rows, order, n, ("dataset", "split"))
    return first.select(
        "dataset",
        "split",
        "example_index",
        F.col("sentence_id").cast("string").alias("source_sentence_id"),
        "source_file",
        record_tokens(first).alias("original_tokens"),
    )


def run(
    examples: DataFrame, wordpiece: sw.Segmenter, sentencepiece: sw.Segmenter, top_n: int = 5
) -> TokenizerStudy:
    """The whole study as lazy tables; ``examples`` may be a union over datasets."""
    comparison = sw.compare_tokenizers(examples, wordpiece, sentencepiece)
    enriched = tm.with_winner(comparison)
    return TokenizerStudy(
        comparison,
        enriched,
        tm.summarize(enriched),
        tm.most_fragmented(enriched, "wordpiece", top_n),
        tm.most_fragmented(enriched, "sentencepiece", top_n),
        tm.winner_counts(enriched),
    )
