"""From raw documents to training shards: five stages, each on all that the one before kept.

1. language ID: learned from the labelled documents, rejects texts whose language is not recognised.
2. near duplicates: one document of each component of links stays.
3. decontamination: test passages are cut out of the texts, documents with nothing left go.
4. mixing: documents in the order of a Pfair schedule of their sources.
5. token output: token ids in fixed-stride shards; a keyed order inside windows of sequences keeps the mix of the stage before from window to
   window. The rows are what the shards hold.

All stages but the last return the columns of ``documents``. Every stage is written and read again before the next one.

Defined results: a NULL or empty text has no language and goes in the first stage; repeated rows are near duplicates of each other, one stays; NULL sources are
a source of their own; an empty table gives no rows; columns beside ``doc_id, text, lang, source`` are carried to the last stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tinta.llm import decontaminate, feistel_output, jaccard_join, language_id, mixing
from tinta.session import scratch_path

# Sequences that the last stage shuffles among themselves: a prefix of the shards is off the mix by less than a window and a block.
MIX_WINDOW = 4096


def put_aside(docs: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """Documents without a column that the next operator adds: such columns of the input get another name, which the result undoes."""
    aside = {c: f"{c} of the input" for c in docs.columns if c.lower() in names}
    return docs.withColumnsRenamed(aside), {new: old for old, new in aside.items()}


def recognise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, back = put_aside(docs, "lang_pred", "score")
    net = language_id.learn(rows, F.col("doc_id"))
    return language_id.accepted(language_id.predict(rows, net)).select(*rows.columns).withColumnsRenamed(back)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.deduplicate(docs)


def remove_test_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows, back = put_aside(docs, "n_words", "spans", "items")
    clean = decontaminate.remove_spans(decontaminate.find_contamination(rows, benchmark))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*rows.columns).withColumnsRenamed(back)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, back = put_aside(docs, *mixing.ADDED)
    return mixing.in_training_order(mixing.mix(rows)).select(*rows.columns).withColumnsRenamed(back)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    layout = feistel_output.Layout(window=MIX_WINDOW)
    return feistel_output.materialised(feistel_output.stored_order(docs), layout=layout, ordered=True)


STAGES = [
    ("language ID", recognise),
    ("near duplicates", deduplicate),
    ("decontamination", remove_test_passages),
    ("mixing", mix_sources),
    ("token output", write_tokens),
]

# Training, shingle hashes and keyed orders have no equivalent in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage-{number}")
        stage(spark, rows, sf_dir).write.parquet(path)
        rows = spark.read.parquet(path)
    return rows
