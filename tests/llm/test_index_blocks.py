"""A vector of the multi-index goes to a block of cells once, and every link is found whatever the blocks are."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_tables import brute_links
from tinta.llm import multi_index


def vectors(spark, n=240):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + rng.normal(scale=0.15, size=8)).astype(np.float32).tolist(), int(i % 2)) for i in range(n)]
    rows += [(1000 + i, rows[i][1], 0) for i in range(5)] + [(2000, rows[0][1][:4], 0), (2001, rows[2][1][:4], 0), (2002, None, 1)]
    return rows, spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(4)


@pytest.mark.parametrize("block, tile, members", [(16, 7, 5), (1000, 1000, 1024), (40, 1000, 3)])
def test_blocks_and_tiles_lose_no_link(spark, monkeypatch, block, tile, members):
    monkeypatch.setattr(multi_index, "MEMBERS", members)
    monkeypatch.setattr(multi_index, "WALKED", 50)
    rows, table = vectors(spark)
    s = multi_index.IndexSettings(cell=4, block=block, tile=tile)
    got = multi_index.near_vectors(table, s).collect()
    assert sorted((str(r[0]), r[1], str(r[2])) for r in got) == brute_links(rows)


def test_a_vector_is_placed_once_per_block_and_not_per_cell(spark):
    _, table = vectors(spark)
    s = multi_index.IndexSettings(cell=2)
    rows = table.select("*", multi_index.linkable().alias("linkable"), *multi_index.keys())
    classes = multi_index.class_table(rows)
    books = multi_index.fit_codebooks(classes, s)
    assert len(books[8].halves[0]) ** 2 > 16  # many cells
    places = multi_index.placed(multi_index.coded(classes, spark.sparkContext.broadcast(books)), s)
    assert places.count() == classes.count()
    assert classes.schema["vector"].dataType.simpleString() == "array<float>"
    few = multi_index.placed(multi_index.coded(classes, spark.sparkContext.broadcast(books)), multi_index.IndexSettings(cell=2, block=60))
    assert few.groupBy("cno").count().agg(F.max("count")).first()[0] <= 3
