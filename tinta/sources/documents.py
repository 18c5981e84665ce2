"""Documents: discovery, text extraction through a plug-in, text of HTML pages."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tinta.functions.text import collapse_spaces, strip
from tinta import schemas
from tinta.session import cut_lineage

Extractor = Callable[[bytes], str]

# Entities resolved in page text; the ampersand comes last.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def discover_documents(spark: SparkSession, folder: str, suffix: str = "pdf") -> DataFrame:
    """Files below a folder at any depth whose suffix matches in any case."""
    any_case = "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*.{any_case}")
        .load(folder)
    )


def utf8_text(content: bytes) -> str:
    return content.decode("utf-8", errors="replace")


def extract_documents(files: DataFrame, extractor: Extractor = utf8_text) -> DataFrame:
    """``source_path, source_file, text`` of the documents that hold text.

    The extractor turns the bytes of one file into text and runs inside the tasks. Extracted texts are kept in the shared folder, so
    an extractor runs once; no files, or no text in any of them, raise ``ValueError``.
    """
    if files.limit(1).count() == 0:
        raise ValueError("no document was found")

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                {
                    "source_path": batch["path"],
                    "source_file": [path.rsplit("/", 1)[-1] for path in batch["path"]],
                    "text": [extractor(content) for content in batch["content"]],
                }
            )

    texts = files.select("path", "content").mapInPandas(extract, schemas.DOCUMENT)
    usable = cut_lineage(texts.withColumn("text", strip(F.col("text"))).where("text <> ''"))
    if usable.limit(1).count() == 0:
        raise ValueError("no document holds text")
    return usable


def html_text(html: Column) -> Column:
    """Visible text of a page: scripts, styles, comments and tags removed, entities resolved."""
    visible = F.regexp_replace(html, r"(?is)<(?:script|style)\b.*?</(?:script|style)\s*>", " ")
    text = F.regexp_replace(F.regexp_replace(visible, r"(?s)<!--.*?-->", " "), r"(?s)<[^>]*>", " ")
    for entity, character in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(character))
    return collapse_spaces(text)


def extract_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    return pages.withColumn("text", html_text(F.col(html))).drop(html).where("text <> ''")
