from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tinta.operators import chunking as ch
from tinta.operators import subword as sw
from tinta.operators.splits import split_rows
from tinta.plans import document_retrieval, tokenizer_study, vector_training


def test_tokenizer_study(spark, tmp_path):
    rows = [(f"s{i}", ["Hola", ",", f"mundo{i}", "."], None, None) for i in range(20)]
    sentences = spark.createDataFrame(rows, "sentence_id string, tokens array<string>, text string, source_file string")
    split = split_rows(sentences, "sentence_id")
    examples = tokenizer_study.examples_by_split(split, "demo", ["shuffle_key"], 2)
    text = sentences.select(F.array_join("tokens", " ").alias("text"))
    study = tokenizer_study.run(examples, sw.wordpiece_segmenter(text), sw.sentencepiece_segmenter(text))
    assert study.comparison.count() == 6
    assert {r.grupo for r in study.summary.collect()} == {"global", "demo"}
    study.save(str(tmp_path / "study"))
    assert spark.read.json(str(tmp_path / "study" / "enriched" / "json")).count() == 6


def test_vector_training(spark):
    lines = [["rey", "reina", "gobierno"], ["perro", "gato", "ciudad"]] * 10
    sentences = spark.createDataFrame([(t,) for t in lines], "tokens array<string>")
    models = vector_training.run(sentences, vector_size=6, epochs=1, buckets=512)
    assert {r.model_type: r.vocab_size for r in models.vocabulary.collect()} == {"Word2Vec": 6, "FastText": 6}
    report, unseen = vector_training.neighbours(models, 2, buckets=512)
    assert {r.modelo for r in report.collect()} == {"Word2Vec", "FastText"}
    assert {r.palabra_oov for r in unseen.collect()} == {"hiperconectividad", "futbolísticamente"}
    assert vector_training.coordinates(models, "demo").count() == 12
    with pytest.raises(ValueError):
        vector_training.run(sentences.limit(0))


def test_document_retrieval(spark, tmp_path):
    rows = [("d/a.pdf", "a.pdf", "el gato duerme. " * 20), ("d/b.pdf", "b.pdf", "la luna brilla. " * 20)]
    documents = spark.createDataFrame(rows, "source_path string, source_file string, text string")
    chunks = ch.chunk_documents(documents, ch.recursive_chunks(ch.Splitter(100, 20)))
    found = document_retrieval.run(chunks, "luna", k=2)
    best = found.best.collect()
    assert len(best) == 4 and {r.source_file for r in best} == {"b.pdf"}
    assert found.ranking.count() == 4 * chunks.count()
    assert found.coordinates.groupBy("role").count().count() == 3
    found.save(str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "similarity" / "top")).count() == 8
    with pytest.raises(ValueError):
        document_retrieval.run(chunks, "luna", k=0)
