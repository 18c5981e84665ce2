"""Steps whose work must not grow with all substrings, all words of a task, or a vector per text and word."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tinta.operators import chunking as ch
from tinta.operators import encoding as en
from tinta.operators import retrieval as rt
from tinta.operators import subword as sw
from tinta.operators import unigram as ug


def plain_vocabulary(words, size, longest, heads):
    counts = Counter()
    for w in words:
        for s in range(len(w)):
            for n in range(1, min(longest, len(w) - s) + 1):
                counts[("##" if heads and s else "") + w[s : s + n]] += 1
    single = {p for p in counts if len(p[2:] if heads and p.startswith("##") and len(p) > 2 else p) == 1}
    longer = sorted((p for p in counts if p not in single), key=lambda p: (-counts[p], p.encode()))[:size]
    return {p: counts[p] for p in [*single, *longer]}


@pytest.mark.parametrize("extra", [[], ["##abc", "##a", "##", "#"] * 3])
def test_vocabularies_equal_counting_all_substrings(spark, extra, monkeypatch):
    monkeypatch.setattr(sw, "RUN_CHARACTERS", 50)
    draw = random.Random(5)
    words = ["".join(draw.choices("abcdñ😀", k=draw.randint(1, 12))) for _ in range(300)] + ["ab" * 6 + "x"] * 40 + extra
    tokens = spark.createDataFrame([(words[i::3],) for i in range(3)], "tokens array<string>")
    for size, longest in ((4, 8), (30, 12), (100_000, 5), (30, 2)):
        for build, heads in ((sw.wordpiece_vocabulary, True), (sw.sentencepiece_vocabulary, False)):
            found = {r["piece"]: r["count"] for r in build(tokens, size, longest).collect()}
            assert found == plain_vocabulary(words, size, longest, heads), (size, longest, heads)


def test_pieces_of_rare_stems_are_never_counted(spark):
    draw = random.Random(7)
    words = ["gato", "gatos", "lunar"] * 50 + ["".join(draw.choices("0123456789xyz", k=30)) for _ in range(100)]
    counted = sw.distinct_words(spark.createDataFrame([(words,)], "tokens array<string>"))
    for by_length in (False, True):
        short, pieces = sw.leading_pieces(counted, 10, 8, F.length("piece") == 1, by_length=by_length)
        assert {r["piece"] for r in pieces.where(F.length("piece") > 3).collect()} <= {"gato", "gatos", "atos", "luna", "unar", "lunar"}
        assert {r["piece"] for r in short.where(F.length("piece") == 1).collect()} == {c for w in words for c in w}


def test_expected_uses_of_many_words_at_once_equal_those_word_by_word(spark):
    draw = random.Random(3)
    words = ["".join(draw.choices("abñ😀", k=draw.choice([1, 2, 7, 30, 64, 65, 90]))) for _ in range(60)]
    pieces = {c: math.log(0.1) for c in "abñ😀"} | {"ab": math.log(0.3), "aba": math.log(0.2), "ñ😀": math.log(0.1)}
    counts = np.array([draw.randint(1, 5) for _ in words])
    plain, likelihood = Counter(), 0.0
    for word, n in zip(words, counts.tolist()):
        whole, found = ug.forward_backward(word, pieces, 3)
        likelihood += n * whole
        for piece, chance in found:
            plain[piece] += n * chance
    uses, told = ug.batch_uses(words, counts.astype(float), sw.Trie.of({p: i for i, p in enumerate(pieces)}), np.array(list(pieces.values())), 3)
    assert told == pytest.approx(likelihood) and dict(zip(pieces, uses)) == pytest.approx(dict(plain))
    table = spark.createDataFrame([(w, int(n)) for w, n in zip(words, counts)], "token string, count bigint")
    found, told = ug.expected_uses(table, pieces, 3)
    assert told == pytest.approx(likelihood) and found == pytest.approx(dict(plain))


def test_a_vector_meets_a_block_of_texts_once(spark, monkeypatch):
    vectors = spark.createDataFrame([("de", [4.0, 0.0]), ("rey", [0.0, 1.0]), ("rey", [0.0, 3.0])], "word string, vector array<float>")
    rows = [("k", ["de", "rey", None]), ("k", ["de"]), (None, ["de"]), ("z", ["nadie"]), ("y", None)]
    sentences = spark.createDataFrame(rows, "doc_id string, tokens array<string>")
    few = en.encode_mean_vectors(sentences, vectors)
    for numbers in (1, 64_000_000):
        monkeypatch.setattr(en, "BLOCK_NUMBERS", numbers)
        many = en.encode_mean_vectors(sentences, vectors, max_shared=0)
        assert sorted(map(str, many.collect())) == sorted(map(str, few.collect()))
    assert [list(r) for r in many.where("doc_id = 'k'").collect()] == [["k", 4, [2.0, 1.0]]] * 2
    # one row per text goes on, not one per text and word
    table = vectors.select("word", F.col("vector").alias("_vector"), F.lit(1.0).alias("_weight"))
    assert en._means_by_block(sentences, table, "doc_id", 2).count() == 3


def test_windows_take_a_text_apart_once(spark):
    plan = spark.range(1).select(ch.fixed_windows(F.col("id").cast("string"), 10, 3).alias("w"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_extract_all") == 1


def test_encoders_of_a_task_share_the_terms_of_a_text():
    """Equal to counting by regular expression, whatever is remembered; equal texts are taken apart once for all vector lengths."""
    texts = ["Una casa, una_casa İ ΟΔΟΣ ²x", "", "a\x85b c\x1cd ß", "Una casa, una_casa İ ΟΔΟΣ ²x"]
    hashes = en.TermHashes()
    for dim in (16, 7):
        expected = np.zeros((len(texts), dim))
        for row, text in zip(expected, texts):
            for term in re.findall(r"[^\W_]+", text.lower()):
                row[int(hashlib.md5(term.encode()).hexdigest()[:7], 16) % dim] += 1
        assert (en.hashing_encoder(dim, hashes)(texts) == expected).all()
        assert len(hashes.texts) == 3 and hashes.held == sum(map(len, set(texts)))


def test_best_chunks_are_joined_without_moving_the_texts(spark):
    chunks = spark.createDataFrame([("a", i, f"t{i}", [float(i), 1.0]) for i in range(9)], "model_name string, global_chunk_index bigint, text string, embedding array<float>")
    queries = spark.createDataFrame([("a", "q", [1.0, 0.0])], "model_name string, query string, embedding array<float>")
    found = rt.top_k_by_model(chunks, queries, 2)
    assert [(r["rank"], r["text"]) for r in found.orderBy("rank").collect()] == [(1, "t8"), (2, "t7")]
    assert "strategy=broadcast" in found._jdf.queryExecution().optimizedPlan().toString()
    few, many = (sorted(r[0] for r in rt.ranked_chunks_only(chunks, found, most_broadcast=n).select("text").collect()) for n in (10, 0))
    assert few == many == ["t7", "t8"]


def test_batches_of_an_encoding_are_small(spark):
    """A task's batch is bounded by bytes, so its memory does not grow with the rows that a task has."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, str(64 << 20))
        segmenter = sw.Segmenter({"[UNK]": 0, "[CLS]": 1, "[SEP]": 2, "a": 3, "##b": 4}, "[UNK]")
        rows = spark.createDataFrame([("ab a",), ("x",)], "text string")
        found = sw.encode_wordpiece(rows, segmenter)
        assert int(spark.conf.get(name)) <= 8 << 20
        assert sorted(r["tokens"] for r in found.collect()) == [["[CLS]", "[UNK]", "[SEP]"], ["[CLS]", "a", "##b", "a", "[SEP]"]]
    finally:
        spark.conf.set(name, before)
