"""Two-dimensional coordinates by principal components."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F


def pca_coordinates(vectors: DataFrame, vector: str = "vector", components: int = 2) -> DataFrame:
    """Add ``x, y`` (or ``c1..ck``) of a table of any size.

    Centred first, since the transformer does not; the sign makes the largest loading positive.
    Only the square matrix of the vector length reaches the driver.
    """
    dense = vectors.withColumn("_dense", array_to_vector(vector))
    scaler = StandardScaler(withMean=True, withStd=False, inputCol="_dense", outputCol="_centred").fit(dense)
    centred = scaler.transform(dense)
    model = PCA(k=components, inputCol="_centred", outputCol="_scores").fit(centred)
    loadings = model.pc.toArray()
    signs = np.sign(loadings[np.abs(loadings).argmax(axis=0), np.arange(components)])
    names = ["x", "y"] if components == 2 else [f"c{i + 1}" for i in range(components)]
    scored = model.transform(centred).withColumn("_scores", vector_to_array("_scores"))
    columns = {name: F.col("_scores")[i] * float(signs[i]) for i, name in enumerate(names)}
    return scored.withColumns(columns).drop("_dense", "_centred", "_scores")


def _plane(matrix: np.ndarray) -> np.ndarray:
    centred = matrix - matrix.mean(axis=0)
    _, _, axes = np.linalg.svd(centred, full_matrices=False)
    axes = axes[:2]
    signs = np.sign(axes[np.arange(len(axes)), np.abs(axes).argmax(axis=1)])
    points = centred @ (axes * signs[:, None]).T
    return np.pad(points, ((0, 0), (0, 2 - points.shape[1])))


def _projector(order: str, vector: str) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def project(group: pd.DataFrame) -> pd.DataFrame:
        rows = group.sort_values(order)
        points = _plane(np.stack(rows[vector].to_numpy()).astype(np.float64))
        return rows.drop(columns=[vector]).assign(x=points[:, 0], y=points[:, 1])

    return project


def project_groups(rows: DataFrame, keys: list[str], order: str, vector: str) -> DataFrame:
    """Coordinates of small groups, one principal plane per group, all groups in one job.

    For groups of bounded size only: top-k results or a list of words to show.
    """
    schema = [f for f in rows.schema.fields if f.name != vector]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ", x double, y double"
    return rows.groupBy(*keys).applyInPandas(_projector(order, vector), ddl)


def query_coordinates(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """Coordinates of queries and their best chunks, from ``projection_rows``."""
    placed = project_groups(rows, ["model_name", "query"], "position", vector)
    return placed.select(
        "model_name", F.lit("pca").alias("method"), "label", "role", "similarity_score", "x", "y"
    )


def word_coordinates(words: DataFrame, training_size: str) -> DataFrame:
    """Coordinates of words per model, from ``model_name, word, position, vector``.

    A model with fewer than two words is left out.
    """
    enough = words.groupBy("model_name").count().where("count >= 2").select("model_name")
    kept = words.join(F.broadcast(enough), "model_name", "left_semi")  # one row per model
    placed = project_groups(kept, ["model_name"], "position", "vector")
    return placed.select(
        "word",
        "x",
        "y",
        F.lit("pca").alias("method"),
        "model_name",
        F.lit(training_size).alias("training_size"),
    )
