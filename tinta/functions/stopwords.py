"""Stopword lists, kept as plain data beside this module: no JVM and no file of the Spark distribution."""

from __future__ import annotations

from functools import lru_cache
from importlib.resources import files


@lru_cache(maxsize=None)
def stopwords(language: str = "spanish") -> tuple[str, ...]:
    """Sorted words of ``stopwords_<language>.txt``; lines that start with ``#`` are remarks."""
    text = (files("tinta.functions") / f"stopwords_{language}.txt").read_text(encoding="utf-8")
    lines = [line for line in text.splitlines() if not line.startswith("#")]
    return tuple(sorted({word for line in lines for word in line.split()}))
