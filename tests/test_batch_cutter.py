"""Words cut together are cut as one by one, and a task holds a run of words, not a batch of rows."""

from __future__ import annotations

import random

import pyarrow as pa

from tinta.operators import subword as sw


def _pieces(draw: random.Random, marks: tuple[str, ...]) -> list[str]:
    return sorted({draw.choice(marks) + "".join(draw.choices("abcdé😀漢", k=draw.randint(1, 5))) for _ in range(40)})


def test_many_words_are_cut_as_one_word_is():
    draw = random.Random(3)
    for _ in range(20):
        bare = [*_pieces(draw, ("",)), "<unk>"]
        greedy = sw.Segmenter({p: i for i, p in enumerate(["[UNK]", "[CLS]", "##", *_pieces(draw, ("", "##"))])}, "[UNK]")
        cheapest = sw.Segmenter({p: i for i, p in enumerate(bare)}, "<unk>", {p: draw.randint(1, 9) * sw.COST_SCALE for p in bare})
        words = ["".join(draw.choices("abcdé😀漢x#<unk>", k=draw.choice([0, 1, 2, 5, 9, 20, 63, 64, 65, 101, 150]))) for _ in range(100)]
        for segmenter in (greedy, cheapest):
            cutter = sw.BatchCutter(segmenter)
            codes, counts = cutter(words)
            names, at = [cutter.names[c] for c in codes], 0
            for word, n in zip(words, counts):
                assert names[at : at + n] == segmenter(word)
                at += n


def test_runs_are_bounded_by_words_and_keep_every_row(monkeypatch):
    monkeypatch.setattr(sw, "RUN_WORDS", 10)
    rows = [["a"] * n for n in (4, 6, 1, 0, 30, 2)] + [None, ["b"] * 9]
    batch = pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.string()))], names=["w"])
    runs = [run.column(0).to_pylist() for run in sw._row_runs(batch, ["w"])]
    assert [row for run in runs for row in run] == rows
    assert all(len(run) == 1 or sum(len(row or []) for row in run) <= 10 for run in runs)


def test_other_columns_and_empty_rows_go_through(spark):
    segmenter = sw.Segmenter({"[UNK]": 0, "[CLS]": 1, "[SEP]": 2, "ho": 3, "##la": 4}, "[UNK]")
    rows = spark.createDataFrame([(1, "hola zz", {"k": 1.5}), (2, None, None), (3, "", None)], "id int, text string, `a.b` map<string, double>")
    found = {r[0]: r for r in sw.encode_wordpiece(rows, segmenter).collect()}
    assert found[1].tokens == ["[CLS]", "ho", "##la", "[UNK]", "[SEP]"] and found[1].input_ids == [1, 3, 4, 0, 2]
    assert found[1]["a.b"] == {"k": 1.5} and found[1].attention_mask == [1] * 5
    assert found[2].tokens == found[3].tokens == ["[CLS]", "[SEP]"]


def test_joins_of_outputs_move_no_list_that_is_not_read(spark):
    keys = "dataset string, split string, example_index int"
    examples = spark.createDataFrame([("a", "train", 0, ["x", ","])], f"{keys}, original_tokens array<string>")
    side = spark.createDataFrame([("a", "train", 0, ["x", "##y"])], f"{keys}, tokens array<string>")
    found = sw.join_tokenized(examples, side, side)
    assert found.first().asDict() == {
        "dataset": "a", "split": "train", "example_index": 0, "original_tokens": ["x", ","], "beto_tokens": ["x", "##y"],
        "t5_tokens": ["x", "##y"], "text": "x,", "beto_token_count": 2, "t5_token_count": 2,
    }
    read = found.select("dataset", "split", "example_index", "text", "beto_token_count", "t5_token_count")
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert "beto_tokens" not in plan and "t5_tokens" not in plan
