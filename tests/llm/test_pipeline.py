"""The pipeline stage by stage on the smallest documents."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_documents import similar, words
from tinta.llm import decontaminate, feistel_output, mixing

DATA = "/root/testdata/sf0.001"


def test_stages_take_effect(spark, tmp_path):
    rows = start = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, rows, DATA)
        if number < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == start.columns
        out.write.parquet(str(tmp_path / str(number)))
        rows = spark.read.parquet(str(tmp_path / str(number)))
        kept.append(rows)
    recognised, single, clean, mixed, tokens = kept
    assert recognised.count() >= 0.97 * start.count()
    assert single.count() == similar(recognised)[3]
    benchmark = spark.read.parquet(f"{DATA}/benchmark.parquet")
    assert decontaminate.find_contamination(clean, benchmark).where("size(spans) > 0").count() == 0
    assert clean.count() >= 0.95 * single.count()
    untouched = {r["doc_id"]: r["text"] for r in decontaminate.find_contamination(single, benchmark).where("size(spans) = 0").collect()}
    assert all(untouched.get(r["doc_id"], r["text"]) == r["text"] and words(r["text"]) for r in clean.collect())
    assert sorted(map(tuple, mixed.collect())) == sorted(map(tuple, clean.collect()))
    assert tokens.select("doc_id").distinct().count() == mixed.count()
    assert sorted(r["slot"] for r in tokens.collect()) == list(range(tokens.count()))


def test_shards_keep_the_mix_from_window_to_window(spark, tmp_path):
    """The sequences of each window of slots are those that stand there in the order of the mix, in another order."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(5)
    corpus_pipeline.mix_sources(spark, docs, DATA).write.parquet(str(tmp_path / "mix"))
    mixed = spark.read.parquet(str(tmp_path / "mix"))
    wanted = {r["doc_id"]: (r["slot"], r["in_block"]) for r in mixing.mix(docs.select(*mixed.columns)).collect()}
    layout = feistel_output.Layout(length=64, shard_slots=50, window=100)
    rows = feistel_output.materialised(feistel_output.stored_order(mixed, 64), layout=layout, ordered=True).select("slot", "doc_id", "seq").collect()
    plain = sorted((r["doc_id"], r["seq"]) for r in feistel_output.materialised(mixed, layout=feistel_output.Layout(length=64)).select("doc_id", "seq").collect())
    assert sorted((r["doc_id"], r["seq"]) for r in rows) == plain
    order = sorted(plain, key=lambda x: (*wanted[x[0]], x[0], x[1]))
    place = {x: i for i, x in enumerate(order)}
    moved = 0
    for r in rows:
        at = place[r["doc_id"], r["seq"]]
        assert at // 100 == r["slot"] // 100
        moved += at != r["slot"]
    assert moved > len(rows) * 0.9


def test_run_gives_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, DATA)
    assert rows.columns == feistel_output.materialised(spark.read.parquet(f"{DATA}/documents.parquet").limit(3)).columns and rows.count() > 0


def test_stages_with_nulls_repeated_rows_clashing_columns_and_no_rows(spark, tmp_path):
    """What the module says of odd rows; all but the last stage return the columns they were given."""
    start = spark.read.parquet(f"{DATA}/documents.parquet")
    long = start.where("length(text) > 400").limit(30)
    odd = spark.createDataFrame([(None, None, None, None, None), (7001, "", "es", None, 0), (7002, " \n ", None, "s", 3)], start.schema)
    rows = long.unionByName(long.limit(5)).unionByName(odd).withColumn("source", F.when(F.col("doc_id") % 2 == 0, F.col("source")))
    rows = rows.withColumns({"spans": F.lit(1), "_row": F.lit(2), "slot": F.lit(3)})
    for table, name in ((rows, "odd"), (rows.limit(0), "none")):
        table.write.parquet(str(tmp_path / name / "start"))
        held = spark.read.parquet(str(tmp_path / name / "start"))
        columns, ids = held.columns, {r["doc_id"] for r in long.collect()} if name == "odd" else set()
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, held, DATA)
            assert out.columns == columns or number == len(corpus_pipeline.STAGES) - 1
            out.write.parquet(str(tmp_path / name / str(number)))
            held = spark.read.parquet(str(tmp_path / name / str(number)))
            assert {r["doc_id"] for r in held.select("doc_id").collect()} <= ids
        assert (held.count() > 0) == (name == "odd")
