"""Training run: statistics, both vector models, vocabulary reports, neighbours, coordinates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tinta.operators import projection as pr
from tinta.operators import subword_vectors as sv
from tinta.operators import word_vectors as wv
from tinta.operators.corpus_stats import MIN_COUNT, corpus_statistics
from tinta.operators.word2vec import train_word2vec
from tinta.session import cut_lineage
from tinta.sinks.writers import vocabulary_stats_table


@dataclass(frozen=True)
class VectorModels:
    statistics: DataFrame
    word2vec: DataFrame
    fasttext: DataFrame
    grams: DataFrame
    vocabulary: DataFrame


def run(
    sentences: DataFrame,
    vector_size: int = wv.VECTOR_SIZE,
    window: int = wv.WINDOW,
    min_count: int = MIN_COUNT,
    epochs: int = wv.EPOCHS,
    buckets: int = sv.BUCKETS,
) -> VectorModels:
    """Train both models on clean sentences; an empty corpus is an error."""
    if sentences.isEmpty():
        raise ValueError("no sentences to train on")
    word2vec, _ = train_word2vec(sentences, vector_size, window, min_count, epochs)
    word2vec = cut_lineage(word2vec)
    fasttext, grams = sv.train_subword_vectors(sentences, vector_size, window, min_count, epochs, buckets)
    fasttext = cut_lineage(fasttext)
    vocabulary = vocabulary_stats_table(
        wv.vocabulary_stats(word2vec, "Word2Vec"), wv.vocabulary_stats(fasttext, "FastText")
    )
    return VectorModels(corpus_statistics(sentences), word2vec, fasttext, grams, vocabulary)


def neighbours(models: VectorModels, n: int = wv.TOP_NEIGHBOURS, buckets: int = sv.BUCKETS) -> tuple[DataFrame, DataFrame]:
    """Neighbours of the default words in both models, and of the default unseen words."""
    words = wv.default_words(models.word2vec, models.fasttext)
    report = wv.similarity_report(models.word2vec, models.fasttext, words, ("Word2Vec", "FastText"), n)
    unseen = wv.word_list(models.word2vec.sparkSession, wv.DEFAULT_OOV_WORDS)
    return report, sv.unseen_neighbours(models.fasttext, models.grams, unseen, n=n, buckets=buckets)


def coordinates(models: VectorModels, training_size: str, max_words: int = 200) -> DataFrame:
    """Coordinates of the words to show, per model."""
    parts = []
    for name, vectors in (("word2vec", models.word2vec), ("fasttext", models.fasttext)):
        rows = wv.vectors_of(wv.display_words(vectors, max_words), vectors)
        parts.append(
            rows.select(F.lit(name).alias("model_name"), "word", "position", F.col("vector").cast("array<double>"))
        )
    return pr.word_coordinates(parts[0].unionByName(parts[1]), training_size)
