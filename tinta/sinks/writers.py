"""Sinks: JSON lines, reports, vectors, coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from tinta.functions.text import model_slug


def _write_counted(df: DataFrame, write) -> int:
    """Run one write and return its number of rows, counted on the way."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def save_sentences_jsonl(sentences: DataFrame, path: str) -> int:
    return _write_counted(sentences.select("tokens"), lambda df: df.write.mode("overwrite").json(path))


def save_chunks_jsonl(chunks: DataFrame, path: str) -> int:
    return _write_counted(chunks, lambda df: df.write.mode("overwrite").json(path))


def flatten_for_csv(df: DataFrame) -> DataFrame:
    """CSV holds no nested columns: they become JSON text."""

    def flat(field: T.StructField) -> Column:
        nested = isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType))
        column = F.col(f"`{field.name}`")
        return F.to_json(column).alias(field.name) if nested else column

    return df.select(*[flat(field) for field in df.schema.fields])


def save_report(df: DataFrame, path: str, formats: tuple[str, ...] = ("csv", "json")) -> None:
    """Report below ``path``, one folder per format."""
    for fmt in formats:
        rows = flatten_for_csv(df) if fmt == "csv" else df
        options = {"header": "true", "escape": '"'} if fmt == "csv" else {}
        rows.write.mode("overwrite").options(**options).format(fmt).save(f"{path}/{fmt}")


def _by_model(df: DataFrame, path: str, columns: list[str]) -> None:
    rows = df.select(model_slug(F.col("model_name")).alias("model_slug"), *columns)
    rows.write.mode("overwrite").partitionBy("model_slug").parquet(path)


def save_embeddings(queries: DataFrame, scored: DataFrame, path: str, key: str = "chunk_id") -> None:
    """Query vectors, and chunk vectors with their scores, in one folder per model."""
    _by_model(queries, f"{path}/queries", ["model_name", "query", "embedding"])
    _by_model(scored, f"{path}/chunks", ["model_name", key, "embedding", "similarity_score"])


def save_rankings(ranking: DataFrame, top: DataFrame, path: str) -> None:
    """Full ranking and top results per model."""
    _by_model(ranking, f"{path}/ranking", ranking.columns)
    _by_model(top.drop("embedding"), f"{path}/top", [c for c in top.columns if c != "embedding"])


def save_embedding_matrix(matrix: DataFrame, path: str) -> None:
    matrix.select("index", "word", "vector").write.mode("overwrite").parquet(path)


def vocabulary_stats_table(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Vocabulary statistics of several models, their top words as JSON text."""
    rows = first
    for other in others:
        rows = rows.unionByName(other)
    return rows.select(
        "model_type", "vocab_size", "vector_size", F.to_json("top_words").alias("top_words_json")
    )


def save_vocabulary_stats(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)


def save_coordinates(coordinates: DataFrame, path: str) -> None:
    coordinates.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)
