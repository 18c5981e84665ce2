"""Queries over whole word tables, where every word of the corpus has a vector in both of them, and training pairs."""

from __future__ import annotations

import random
from collections import Counter

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry_points
from tinta.operators import word_vectors as wv


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents whose word number i of the vocabulary is known, and fewer vectors than words."""
    path = str(tmp_path_factory.mktemp("words"))
    words = [f"palabra{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(330)]
    rows = [(i, " ".join(w for j, w in enumerate(words) for _ in range(1 + (i < 40 - j % 40))), "es", "x", 0) for i in range(40)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    documents.write.parquet(f"{path}/documents.parquet")
    vectors = np.random.default_rng(5).normal(size=(50, 64)).round(3).tolist()
    table = spark.createDataFrame([(i, v, i % 3) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<float>, label int")
    table.write.parquet(f"{path}/embeddings.parquet")
    return path


def answers(spark, folder, name):
    """Rows of the query, which are those of its SQL."""
    found = entry_points.queries()[name](spark, folder)
    connection = duckdb.connect()
    for table in ("documents", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    relation = connection.sql(entry_points.oracle_sql()[name]).select(*[duckdb.ColumnExpression(c) for c in found.columns])
    rows = [tuple(r) for r in found.collect()]
    assert sorted(rows) == sorted(relation.fetchall())
    return rows


def test_vocabulary_statistics_count_every_word(spark, folder):
    rows = {r[0]: r for r in answers(spark, folder, "vocab_stats")}
    assert {name: r[1] for name, r in rows.items()} == {"Word2Vec": 330, "FastText": 330}
    assert rows["Word2Vec"][3].count('"word"') == 30 and rows["FastText"][3].count('"word"') == 130


def test_matrix_holds_each_of_the_first_words(spark, folder):
    assert sorted(r[0] for r in answers(spark, folder, "embedding_matrix")) == list(range(300))


def test_default_words_are_the_most_frequent_ones(spark, folder):
    frequent = entry_points.queries()["vocabulary_index"](spark, folder).where("idx < 5").collect()
    assert sorted(answers(spark, folder, "default_words")) == sorted((r["word"], r["idx"] + 1) for r in frequent)


def test_words_to_show_leave_no_frequent_word_out(spark, folder):
    frequent = {r["word"] for r in entry_points.queries()["vocabulary_index"](spark, folder).where("idx < 200").collect()}
    assert {r[0] for r in answers(spark, folder, "display_words")} == frequent


def test_pairs_are_counted_once_for_both_orders(spark):
    draw = random.Random(4)
    sentences = [[draw.choice("abcde") for _ in range(draw.randint(0, 12))] for _ in range(60)]
    wanted = Counter(
        (s[i], s[j]) for s in sentences for i in range(len(s)) for j in range(max(0, i - 3), min(len(s), i + 4)) if i != j
    )
    pairs = wv.skipgram_pairs(spark.createDataFrame([(s,) for s in sentences], "tokens array<string>"), 3)
    assert pairs.columns == ["center", "context", "count"]
    assert {(r[0], r[1]): r[2] for r in pairs.collect()} == dict(wanted)
    # what is grouped and shuffled is an unordered pair
    assert "least(" in pairs._jdf.queryExecution().optimizedPlan().toString()
