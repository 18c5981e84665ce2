from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tinta.sources import corpus, documents, files, tables
from tinta.sources import conll
from tinta.sources.conll import parse_conll, read_conll, read_split_corpus
from tinta.sinks import writers
from tinta.operators.splits import first_per_split, split_counts, split_rows

CONLL = "# c\nMelbourne NP B\n( Fpa O\n#skip\nAustralia NP B\n \t\n\n25 Z O\nmay NC O"


def write(folder, name, text):
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder / name)


def test_conll(spark, tmp_path):
    path = write(tmp_path, "esp.train.txt", CONLL)
    rows = read_conll(spark, path).orderBy("pos").collect()
    assert [r.tokens for r in rows] == [["Melbourne", "(", "Australia"], ["25", "may"]]
    assert rows[0].text == "Melbourne ( Australia" and rows[0].source_file == "esp.train.txt"
    empty = spark.createDataFrame([("",), ("\n\n",)], "value string")
    assert parse_conll(empty).count() == 0
    unix = write(tmp_path, "big.txt", "a X\nb X\n\nc X\n\n\nd X\n")
    assert [(r.pos, r.text) for r in read_conll(spark, unix).orderBy("pos").collect()] == [(0, "a b"), (1, "c"), (2, "d")]


def test_conll_files_that_are_split_over_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(conll, "BLOCK_LINES", 50)
    lines = [f"w{i} X" if i % 7 and i % 11 else " " if i % 7 else "# note" for i in range(4000)]
    (tmp_path / "in").mkdir()
    for name, end in (("one.txt", "\n"), ("two.txt", "\r\n")):
        (tmp_path / "in" / name).write_bytes(end.join(lines).encode())
    previous = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        found = read_conll(spark, str(tmp_path / "in")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", previous)
    whole = spark.createDataFrame([("\n".join(lines),)], "value string")
    expected = [(r.pos, r.text) for r in parse_conll(whole).collect()]
    for name in ("one.txt", "two.txt"):
        assert sorted((r.pos, r.text) for r in found if r.source_file == name) == expected


def test_file_listing_and_splits(spark, tmp_path):
    for name in ("esp.train.txt", "dev.conll", "test_b.txt", "spanish train.txt", "other.csv", "esp.train", "x.TXT"):
        write(tmp_path, name, "a X\n")
    (tmp_path / "sub").mkdir()
    write(tmp_path / "sub", "test.txt", "z X\n")
    listed = files.list_files(spark, str(tmp_path))
    assert {r.name for r in listed.collect()} == {
        "esp.train.txt", "dev.conll", "test_b.txt", "spanish train.txt", "other.csv", "x.TXT"
    }
    chosen = {r.split: r.name for r in files.split_files(listed).collect()}
    assert chosen == {"train": "esp.train.txt", "validation": "dev.conll", "test": "test_b.txt"}
    corpus_rows = read_split_corpus(spark, str(tmp_path))
    assert {r.split for r in corpus_rows.collect()} == {"train", "validation", "test"}
    (tmp_path / "part").mkdir()
    write(tmp_path / "part", "train.txt", "a X\n")
    with pytest.raises(FileNotFoundError, match="validation"):
        read_split_corpus(spark, str(tmp_path / "part"))
    with pytest.raises(Exception):
        files.list_files(spark, str(tmp_path / "missing")).collect()


def sentences(df):
    return [(r.sentence_id, r.tokens) for r in df.orderBy("pos").collect()]


def test_table_layouts(spark, tmp_path):
    grouped = write(tmp_path, "a.csv", "id,Tokens\n1,\"['a', 'b']\"\n2,NA\n3,x y\n")
    assert sentences(tables.sentences_from_table(tables.read_table(spark, grouped))) == [
        ("0", ["a", "b"]), ("2", ["x", "y"])
    ]
    rows = write(tmp_path, "b.tsv", "Word\tsentence #\nuno\ts2\n \ts2\ndos\ts1\ntres\ts2\nNA\ts1\n")
    assert sentences(tables.sentences_from_table(tables.read_table(spark, rows))) == [
        ("s2", ["uno", "tres"]), ("s1", ["dos"])
    ]
    text = write(tmp_path, "c.csv", "texto\nhola  mundo\nadios\n")
    found = tables.sentences_from_table(tables.read_table(spark, text))
    assert sentences(found) == [("0", ["hola", "mundo"]), ("1", ["adios"])]
    assert found.first().text == "hola  mundo"
    for unusable in ("id,value\n1,2\n", "text\n1\n2\n", "text\na\na\na\na\nb\n"):
        with pytest.raises(ValueError, match="cannot infer"):
            tables.sentences_from_table(tables.read_table(spark, write(tmp_path, "d.csv", unusable)))
    assert sentences(tables.load_table_corpus(spark, str(tmp_path)))[0] == ("0", ["a", "b"])


def test_one_huge_sentence_keeps_its_order(spark):
    rows = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("sid"),
        F.col("id").alias("_row"),
        F.col("id").cast("string").alias("word"),
    )
    found = {r.sentence_id: r.tokens for r in tables.sentences_from_token_rows(rows, "word", "sid", "_row").collect()}
    assert found["hot"] == [str(i) for i in range(0, 20000, 3)]
    assert sum(map(len, found.values())) == 20000


def test_records(spark):
    df = spark.createDataFrame([(["a"], "x y"), (None, "x y")], "tokens array<string>, text string")
    assert [r[0] for r in df.select(corpus.record_tokens(df)).collect()] == [["a"], ["x", "y"]]
    with pytest.raises(ValueError):
        corpus.record_tokens(df.select(F.lit(1).alias("z")))


def test_jsonl_round_trip_and_bad_lines(spark, tmp_path):
    df = spark.createDataFrame([(["ñ", "b"],), ([],)], "tokens array<string>")
    assert writers.save_sentences_jsonl(df, str(tmp_path / "s")) == 2
    assert [r.tokens for r in corpus.read_sentences_jsonl(spark, str(tmp_path / "s")).collect()] == [["ñ", "b"]]
    bad = write(tmp_path, "bad.jsonl", '{"tokens": ["a"]}\n\n{oops\n')
    with pytest.raises(Exception):
        corpus.read_sentences_jsonl(spark, bad).collect()


def test_documents(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    write(tmp_path / "deep", "one.PDF", "  hola ")
    write(tmp_path, "two.pdf", " \n")
    write(tmp_path, "three.txt", "no")
    rows = documents.extract_documents(documents.discover_documents(spark, str(tmp_path))).collect()
    assert [(r.source_file, r.text) for r in rows] == [("one.PDF", "hola")]
    found = documents.discover_documents(spark, str(tmp_path))
    with pytest.raises(ValueError, match="found"):
        documents.extract_documents(found.limit(0))
    with pytest.raises(ValueError, match="holds text"):
        documents.extract_documents(found.where("path LIKE '%two.pdf'"))
    pages = spark.createDataFrame([("<p>A&amp;B<script>x</script><!-- c --> <b>c</b></p>",)], "html string")
    assert documents.extract_pages(pages).first().text == "A&B c"


@pytest.mark.parametrize("n, sizes", [(10, (7, 1, 2)), (90, (62, 13, 15)), (1, (0, 0, 1))])
def test_split_sizes(spark, n, sizes):
    split = split_rows(spark.range(n), "id")
    counts = {r.split: r.n_examples for r in split_counts(split.withColumn("dataset", F.lit("d"))).collect()}
    assert tuple(counts.get(s, 0) for s in ("train", "validation", "test")) == sizes
    first = first_per_split(split, ["shuffle_key"], 2).groupBy("split").count().collect()
    assert all(r["count"] <= 2 for r in first)
    with pytest.raises(ValueError):
        split_rows(spark.range(3), "id", shares=(0.8, 0.1, 0.1))
