from __future__ import annotations

import ast
import re

import pytest
from pyspark.sql import functions as F

from tinta.functions import text as tx
from tinta.functions import tokens as tk
from tinta.functions.vectors import cosine


def values(spark, inputs, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


def test_normalize_keeps_accents_and_collapses_unicode_space(spark):
    assert values(spark, ["  Árbol \t NIÑO\x1c x ", ""], tx.normalize_text) == ["árbol niño x", ""]


def test_clean_tokens(spark):
    texts = ["El Niño-feliz y a 3D ın ſol-x", "123 ... !!", "DE la casa"]
    found = values(spark, texts, lambda v: tx.clean_tokens(v, ["el", "la", "de"]))
    assert found == [["niño-feliz", "ın", "ſol-x"], [], ["casa"]]


def test_is_valid_token(spark):
    tokens = [" Casa ", "a", "la", "x²y", "a½b", "٣ab", "--", "日本", "", "ñu"]
    found = values(spark, tokens, lambda v: tx.is_valid_token(v, ["la"]))
    assert found == [True, False, False, False, True, False, False, False, False, True]


def test_clean_token_list(spark):
    rows = [["Hola", "A1", "!", "De", "ſſ"]]
    full = values(spark, rows, lambda v: tx.clean_token_list(v, ["de"]), "array<string>")
    loose = values(spark, rows, lambda v: tx.clean_token_list(v, [], False, False), "array<string>")
    assert full == [["hola"]]
    assert loose == [["hola", "de", "ſſ"]]


def test_rebuild_text(spark):
    tokens = ["Melbourne", "(", "Australia", ")", ",", "25", "may", "(", "EFE", ")", "."]
    assert values(spark, [tokens], tx.rebuild_text, "array<string>") == ["Melbourne (Australia), 25 may (EFE)."]


@pytest.mark.parametrize(
    "cell, expected",
    [
        (None, []),
        ("  ", []),
        ("['a', \"it's\", 'c']", ["a", "it's", "c"]),
        ("('a', 'b')", ["a", "b"]),
        ("('a',)", ["a"]),
        ("[a, b,  c]", ["a", "b", "c"]),
        ('[a, "b, c", d]', ["a", "b, c", "d"]),
        ("[]", []),
        ("[ ]", []),
        ("[1, None]", ["1", "None"]),
        ("'quoted'", ["quoted"]),
        ("plain text", ["plain text"]),
        ("5", ["5"]),
    ],
)
def test_parse_token_list(spark, cell, expected):
    assert values(spark, [cell], tx.parse_token_list) == [expected]


def test_cell_tokens(spark):
    cells = ["['a', ' ', 'b c']", "x  y", "[x y", ""]
    assert values(spark, cells, tx.cell_tokens) == [["a", "b c"], ["x", "y"], ["[x", "y"], []]


def test_column_keys():
    assert tx.column_key(" Sentence # ") == "sentence"
    assert tx.column_key("oración") == "oraci_n"
    assert tx.find_column(["Text", "text ", "Word"], ["word", "text"]) == "Word"
    assert tx.find_column(["Text", "text "], ["text"]) == "text "
    assert tx.find_column(["x"], ["text"]) is None


def test_chunk_ids(spark):
    names = ["Mi Informe (2).pdf", "a.b.txt", "plain", ".hidden"]
    found = values(spark, names, lambda v: tx.chunk_id(v, F.lit(12345)))
    assert found == ["mi_informe_2_chunk_12345", "a_b_chunk_12345", "plain_chunk_12345", "hidden_chunk_12345"]


def test_model_prefixes(spark):
    names = ["intfloat/multilingual-e5-base", "BAAI/bge-m3", "x/E5-large"]
    found = values(spark, names, lambda v: tx.format_for_model(F.lit(" Hola "), v, F.lit("query")))
    assert found == ["query: Hola", "Hola", "query: Hola"]
    kept = values(spark, ["Passage: x"], lambda v: tx.format_for_model(v, F.lit(names[0]), F.lit("query")))
    assert kept == ["Passage: x"]
    assert values(spark, ["a/b c"], tx.model_slug) == ["a_b_c"]


def test_chunk_text_is_required(spark):
    with pytest.raises(Exception, match="chunk without text"):
        values(spark, [""], tx.chunk_text)


def test_token_helpers(spark):
    tokens = [["[CLS]", "Mel", "##b", "<unk>", "[SEP]"]]
    kind = "array<string>"
    assert values(spark, tokens, lambda v: tk.without_specials(v, "beto"), kind) == [["Mel", "##b", "<unk>"]]
    assert values(spark, tokens, tk.count_unknown, kind) == [1]
    assert values(spark, tokens, tk.continuations, kind) == [["##b"]]
    with pytest.raises(ValueError):
        tk.tokenizer_kind("other")


def test_ratio_rounds_half_to_even(spark):
    pairs = [(1, 16), (15, 11), (3, 0), (161, 80)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    assert [r[0] for r in df.select(tk.ratio(F.col("a"), F.col("b"))).collect()] == [0.062, 1.364, None, 2.013]


def test_cosine(spark):
    df = spark.createDataFrame([([1.0, 0.0], [2.0, 0.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>")
    assert [r[0] for r in df.select(cosine(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0]
    short = spark.createDataFrame([([1.0], [1.0, 2.0])], "a array<float>, b array<float>")
    with pytest.raises(Exception, match="vector lengths differ"):
        short.select(cosine(F.col("a"), F.col("b"))).collect()


def test_word_pattern_is_what_python_finds(spark):
    texts = ["El-niño está -- aquí-allá-ya 12x", "ÁÉ üñ-", "a-b-c d"]
    pattern = re.compile(r"[a-záéíóúüñ]+(?:-[a-záéíóúüñ]+)?", re.IGNORECASE)
    expected = [[w for w in pattern.findall(t.lower()) if len(w) > 1] for t in texts]
    assert values(spark, texts, tx.clean_tokens) == expected


def test_list_literals_agree_with_python(spark):
    cells = ["['x', 'y']", '["a", "b"]', "['ñ', '(', ')']"]
    assert values(spark, cells, tx.parse_token_list) == [ast.literal_eval(c) for c in cells]
