"""Retrieval run: documents to chunks to vectors to rankings, for all models at once."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tinta.operators import projection as pr
from tinta.operators import retrieval as rt
from tinta.operators.encoding import Encoder, encode_query_and_chunks
from tinta.sinks import writers


@dataclass(frozen=True)
class Retrieval:
    queries: DataFrame
    scored: DataFrame
    ranking: DataFrame
    top: DataFrame
    best: DataFrame
    coordinates: DataFrame

    def save(self, path: str) -> None:
        writers.save_embeddings(self.queries, self.scored, f"{path}/embeddings", "global_chunk_index")
        writers.save_rankings(self.ranking, self.top, f"{path}/similarity")
        writers.save_report(self.best, f"{path}/best")
        writers.save_coordinates(self.coordinates, f"{path}/coordinates")


def run(
    chunks: DataFrame,
    query: str,
    encoders: dict[str, Callable[[], Encoder]] | None = None,
    k: int = rt.TOP_K,
    projection_k: int = rt.PROJECTION_K,
) -> Retrieval:
    """Score all chunks against a query; ``chunks`` comes from ``chunk_documents``.

    ``k`` below 1 is an error. ``scored`` feeds several results: store or cache it to encode once.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    asked = chunks.sparkSession.createDataFrame([(query,)], "query string")
    queries, coded = encode_query_and_chunks(asked, chunks, encoders=encoders)
    scored = rt.cosine_scores_by_model(coded, queries)
    top = rt.top_k(scored, k, "global_chunk_index", ("model_name", "query"))
    numbered = [df.withColumn("chunk_id", df["global_chunk_index"].cast("string")) for df in (top, coded)]
    rows = rt.projection_rows(queries, *numbered, projection_k)
    return Retrieval(
        queries,
        scored,
        rt.similarity_ranking(scored, "global_chunk_index"),
        top,
        rt.top_result_per_model(top),
        pr.query_coordinates(rows),
    )
