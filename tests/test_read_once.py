"""Queries and operators that read an input several times must not work it out each time."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from registry import words as rw
from tinta.operators import word_vectors as wv


def counted(df, seen):
    """The same rows; ``seen`` is told each time one of them is worked out."""

    @F.udf("boolean")
    def count(_):
        seen.add(1)
        return True

    return df.where(count.asNondeterministic()(F.col(df.columns[0])))


@pytest.mark.parametrize("name", ["similar_words", "similarity_report", "oov_neighbours", "common_words", "word_coordinates"])
def test_word_queries_clean_the_corpus_once(spark, monkeypatch, name):
    tokens = [["gato", "perro", "luna"], ["gato", "sol"], ["perro", "casa", "mar"]] * 6
    documents = spark.createDataFrame([(i, t) for i, t in enumerate(tokens)], "doc_id bigint, tokens array<string>")
    texts = spark.createDataFrame([("gato luna nadie",), ("",), (None,)], "text string")
    vectors = [(i, [float(i % 3), 1.0, float(i)]) for i in range(7)]
    embeddings = spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>")
    seen = spark.sparkContext.accumulator(0)
    monkeypatch.setattr(rw, "clean_documents", lambda *_: counted(documents, seen))
    monkeypatch.setattr(rw, "load", lambda _, __, table: embeddings if table == "embeddings" else texts)
    run = {"similar_words": rw.run_similar, "similarity_report": rw.run_similarity_report, "oov_neighbours": rw.run_oov,
           "common_words": rw.run_common, "word_coordinates": rw.run_word_coordinates}[name]
    assert run(spark, "").collect()
    assert seen.value == len(tokens)


def test_words_of_a_report_are_worked_out_once(spark):
    vectors = spark.createDataFrame([(w, [float(i), 1.0]) for i, w in enumerate("abcd")], "word string, vector array<float>")
    seen = spark.sparkContext.accumulator(0)
    words = counted(spark.createDataFrame([("a",), ("b",), ("x",)], "word string"), seen)
    rows = wv.similarity_report(vectors, vectors, words, ("A", "B"), 1).collect()
    assert sorted((r.modelo, r.palabra_consultada) for r in rows) == [("A", "a"), ("A", "b"), ("B", "a"), ("B", "b")]
    assert seen.value == 3
