"""Registered queries and, per query, the same result in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: QueryFn
    sql: Callable[[], str] | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: Callable[[], str] | str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register a query; SQL is given as text or as a function that builds it."""

    def add(run: QueryFn) -> QueryFn:
        text = (lambda: sql) if isinstance(sql, str) else sql
        QUERIES[name] = Query(run, text)
        return run

    return add


def load_all() -> dict[str, Query]:
    from registry import corpus, metrics, retrieval, sentences, subwords, words  # noqa: F401

    return QUERIES
