"""A sort over costly rows works them out once."""

from __future__ import annotations

from pyspark.sql import functions as F

from tinta.operators import token_metrics as tm


def test_sorting_by_continuations_encodes_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def pieces(n):
        made.add(1)
        return ["[CLS]", *["##x"] * (n % 7), "[SEP]"]

    rows = spark.range(50).repartition(4).select(
        F.lit("d").alias("dataset"), F.lit("train").alias("split"), F.col("id").alias("example_index"), F.lit("t").alias("text"),
        F.array(F.lit("t")).alias("original_tokens"), pieces("id").alias("beto_tokens"), F.array(F.lit("▁t")).alias("t5_tokens"),
    )
    got = [(r.indice_sentencia, r.n_continuaciones_wordpiece, len(r.subtokens_con_prefijo_wordpiece)) for r in tm.by_continuations(rows).collect()]
    assert got == sorted(((i, i % 7, i % 7) for i in range(50)), key=lambda r: (-r[1], r[0]))
    assert made.value == 50
