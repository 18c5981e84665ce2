"""Finding input files and mapping them to splits (by name, as a table)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# Supported suffixes and the names that mark a split.
TABLE_SUFFIXES = (".csv", ".tsv")
CONLL_SUFFIXES = (".txt", ".conll", ".iob", ".bio")
SPLIT_ALIASES = {
    "train": ("train", "training", "esp.train", "spanish.train"),
    "validation": ("validation", "valid", "val", "dev", "development"),
    "test": ("test", "testing"),
}


def list_files(spark: SparkSession, folder: str, suffixes: Iterable[str] | None = None) -> DataFrame:
    """``path, name`` of the supported files directly below a folder; a missing folder is an error."""
    allowed = list(suffixes or TABLE_SUFFIXES + CONLL_SUFFIXES)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    return (
        files.select("path")  # the content column is never read
        .withColumn("name", name)
        .where(F.regexp_extract(F.lower("name"), r"[^.](\.[^.]+)$", 1).isin(allowed))
    )


def _words(name: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", " "))


def _matches(name: Column, aliases: Iterable[str]) -> Column:
    """An alias is the stem, a word of the name, or a run of words at either end of the stem."""
    words = F.concat(F.lit(" "), _words(name), F.lit(" "))
    stem = _words(F.regexp_replace(name, r"(?<=.)\.[^.]+$", ""))
    found = F.lit(False)
    for alias in aliases:
        key = " ".join(alias.replace(".", " ").split())
        at_edge = (stem == key) | stem.startswith(key + " ") | stem.endswith(" " + key)
        found = found | (at_edge if " " in key else at_edge | words.contains(f" {key} "))
    return found


def split_files(files: DataFrame, partition_by: Iterable[str] = ()) -> DataFrame:
    """One file per split: of the matching names the shortest, then the first in the alphabet."""
    candidates = F.filter(
        F.array(*[F.when(_matches(F.col("name"), a), s) for s, a in SPLIT_ALIASES.items()]),
        lambda split: split.isNotNull(),
    )
    keys = [*partition_by, "split"]
    order = Window.partitionBy(*keys).orderBy(F.length("name"), F.lower("name"), "name")
    return (
        files.withColumn("split", F.explode(candidates))
        .withColumn("_rank", F.row_number().over(order))
        .where("_rank = 1")
        .drop("_rank")
    )
