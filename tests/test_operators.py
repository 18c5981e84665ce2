from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tinta.operators import chunking as ch
from tinta.operators import corpus_stats as cs
from tinta.operators import encoding as en
from tinta.operators import projection as pr
from tinta.operators import ranking as rk
from tinta.operators import retrieval as rt
from tinta.operators import subword as sw
from tinta.operators import token_metrics as tm
from tinta.operators import unigram as ug

GOLDEN = ["Melbourne", "(", "Australia", ")", ",", "25", "may", "(", "EFE", ")", "."]
WORDPIECES = ["Mel", "##bourne", "(", "Australia", ")", ",", "25", "may", "EF", "##E", "."]
GOLDEN_WORDPIECE = "[CLS] Mel ##bourne ( Australia ) , 25 may ( EF ##E ) . [SEP]".split()
GOLDEN_SENTENCEPIECE = "▁Melbourne ( ▁Australia ▁) ▁, ▁25 ▁may ▁( EF E ▁) ▁.".split()


def golden_comparison(spark):
    schema = (
        "dataset string, split string, example_index bigint, text string, original_tokens array<string>, "
        "beto_tokens array<string>, t5_tokens array<string>"
    )
    rows = [
        ("c", "train", 1, "t", GOLDEN, GOLDEN_WORDPIECE, GOLDEN_SENTENCEPIECE),
        (None, "train", 2, "t", ["-"], ["[CLS]", "-", "[SEP]"], ["▁-", "<unk>", "</s>"]),
        ("c", "test", 1, "", [], ["[CLS]", "[SEP]"], ["</s>"]),
    ]
    return spark.createDataFrame(rows, schema)


def test_wordpiece_golden(spark):
    vocabulary = sw.vocabulary_from_pieces(spark, WORDPIECES)
    segmenter = sw.collect_segmenter(vocabulary, sw.WORDPIECE_SPECIALS, "[UNK]")
    texts = spark.createDataFrame([(1, "Melbourne (Australia), 25 may (EFE)."), (2, ""), (3, "zzz 25"), (4, None)],
                                  "id int, text string")
    rows = {r.id: r for r in sw.encode_wordpiece(texts, segmenter).collect()}
    assert rows[1].tokens == GOLDEN_WORDPIECE
    assert len(rows[1].input_ids) == len(rows[1].attention_mask) == 15 and set(rows[1].attention_mask) == {1}
    assert rows[2].tokens == ["[CLS]", "[SEP]"]
    assert rows[3].tokens == ["[CLS]", "[UNK]", "25", "[SEP]"]
    assert rows[3].input_ids[1] == sw.WORDPIECE_SPECIALS.index("[UNK]")


def test_unigram_path_is_the_cheapest_of_all():
    random.seed(1)
    pieces = ["".join(p) for n in (1, 2, 3) for p in itertools.product("ab", repeat=n)]
    costs = {p: random.randint(1, 30) * len(p) + random.randint(0, 9) for p in pieces}
    segmenter = sw.Segmenter({p: i for i, p in enumerate(pieces)} | {"<unk>": 99}, "<unk>", costs)

    def cheapest(unit):
        if not unit:
            return 0
        return min(costs[unit[:n]] + cheapest(unit[n:]) for n in range(1, 4) if unit[:n] in costs)

    for unit in ("".join(p) for p in itertools.product("ab", repeat=7)):
        found = segmenter(unit)
        assert "".join(found) == unit and sum(costs[p] for p in found) == cheapest(unit)
    assert segmenter("axxb") == ["a", "<unk>", "b"]


def test_metrics_golden(spark):
    rows = {(r.dataset, r.indice_sentencia, r.split): r for r in tm.with_winner(golden_comparison(spark)).collect()}
    golden = rows[("c", 1, "train")]
    assert (golden.n_subtokens_wordpiece, golden.n_subtokens_wordpiece_sin_especiales) == (15, 13)
    assert (golden.razon_fragmentacion_wordpiece, golden.razon_fragmentacion_wordpiece_sin_especiales) == (1.364, 1.182)
    assert (golden.n_continuaciones_wordpiece, golden.n_unknown_wordpiece) == (2, 0)
    assert golden.tokenizador_menos_fragmentado == "sentencepiece"
    empty = rows[("c", 1, "test")]
    assert empty.razon_fragmentacion_wordpiece is None and empty.tokenizador_menos_fragmentado == "empate"
    assert empty.es_sentencia_corta and not empty.es_sentencia_informativa


def test_summary_keeps_the_null_dataset(spark):
    rows = {r.grupo if r.grupo == "global" else r.dataset: r for r in tm.summarize(golden_comparison(spark)).collect()}
    assert set(rows) == {"global", "c", None}
    assert rows["global"].n_sentencias == 3 and rows[None].total_unknown_sentencepiece == 1
    assert rows["c"].promedio_wordpiece_sin_sentencias_cortas == 1.182
    assert rows[None].promedio_wordpiece_sentencias_informativas is None
    counts = {r[0]: r[1] for r in tm.winner_counts(golden_comparison(spark)).collect()}
    assert counts == {"wordpiece": 1, "sentencepiece": 1, "empate": 1}
    top = tm.most_fragmented(golden_comparison(spark), "t5", 5).collect()
    assert [r.n_tokens_originales for r in top] == [1, 11, 0]


def test_metrics_from_text_and_missing_columns(spark):
    text = golden_comparison(spark).withColumn("beto_tokens", F.to_json("beto_tokens"))
    assert tm.enrich(text).where("split = 'train' and dataset = 'c'").first().n_subtokens_wordpiece == 15
    with pytest.raises(ValueError, match=r"\['split', 'tokens_wordpiece_beto'\]"):
        tm.enrich(golden_comparison(spark).drop("split", "beto_tokens"))


def test_join_of_unequal_outputs_fails(spark):
    rows = golden_comparison(spark).where("dataset is not null")
    keys = ["dataset", "split", "example_index"]
    examples = rows.select(*keys, "original_tokens")
    wordpiece = rows.select(*keys, F.col("beto_tokens").alias("tokens"))
    sentencepiece = rows.select(*keys, F.col("t5_tokens").alias("tokens"))
    assert sw.join_tokenized(examples, wordpiece, sentencepiece).count() == 2
    with pytest.raises(Exception, match="differ in number"):
        sw.join_tokenized(examples, wordpiece.limit(1), sentencepiece).collect()


def test_splitter_bounds():
    for size, overlap in ((0, 0), (5, -1), (5, 5)):
        with pytest.raises(ValueError):
            ch.Splitter(size, overlap)


def test_splitter_known_cases():
    assert ch.Splitter(10, 0)("aaa bbb ccc ddd") == ["aaa bbb", "ccc ddd"]
    assert ch.Splitter(11, 4)("aaa bbb ccc ddd") == ["aaa bbb ccc", "ccc ddd"]
    assert ch.Splitter(8, 0)("p one\n\np two\n\nlonger text") == ["p one", "p two", "longer", "text"]
    assert ch.Splitter(4, 2)("abcdefgh") == ["abcd", "cdef", "efgh"]
    assert ch.Splitter(4, 2)(" \n ") == []


def test_splitter_properties():
    random.seed(3)
    for _ in range(200):
        # every letter occurs once, so a chunk has one place only
        text = "".join(random.choice([chr(0x4E00 + i)] * 3 + [" ", "\n"]) for i in range(random.randint(0, 200)))
        chunks = ch.Splitter(20, 6)(text)
        assert all(0 < len(c) <= 20 and c in text for c in chunks)
        joined = "".join(text.split())
        at = 0
        for chunk in chunks:  # in order, and nothing is left out
            bare = "".join(chunk.split())
            start = joined.find(bare, max(0, at - 20))
            assert 0 <= start <= at
            at = max(at, start + len(bare))
        assert at == len(joined)


@pytest.mark.parametrize("size, overlap", [(10, 3), (10, 7), (4, 0)])
def test_fixed_windows(spark, size, overlap):
    texts = ["", "a", "x" * 10, "0123456789abc", "añb\n" * 9]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r[0] for r in df.select(ch.fixed_windows(F.col("t"), size, overlap)).collect()]
    for text, windows in zip(texts, found):
        stride, expected, start = size - overlap, [], 0
        while text and (start == 0 or start + overlap < len(text)):
            expected.append(text[start : start + size])
            start += stride
        assert windows == expected


def test_chunks_are_numbered_in_document_order(spark):
    rows = [(f"d{i:03d}", f"File {i % 3}.pdf", "lorem ipsum " * (i % 7)) for i in range(60)]
    documents = spark.createDataFrame(rows, "source_path string, source_file string, text string")
    chunks = ch.chunk_documents(documents, ch.recursive_chunks(ch.Splitter(30, 5))).orderBy("source_path", "chunk_index")
    found = chunks.collect()
    assert [r.global_chunk_index for r in found] == list(range(len(found)))
    assert len({r.source_path for r in found}) == sum(1 for i in range(60) if i % 7)
    assert found[0].chunk_id == "file_1_chunk_0000"


def test_chunking_refuses_repeated_paths_and_empty_corpora(spark):
    schema = "source_path string, source_file string, text string"
    with pytest.raises(ValueError, match="unique"):
        ch.chunk_documents(spark.createDataFrame([("d", "a", "one two"), ("d", "b", "three")], schema))
    for rows in ([], [("d", "a", "  "), ("e", "b", None)]):
        with pytest.raises(ValueError, match="no text"):
            ch.chunk_documents(spark.createDataFrame(rows, schema))


def test_vocabulary_counts_words_of_any_length(spark):
    long = "qé" * 55
    words = spark.createDataFrame([([long, "ab"],)], "tokens array<string>")
    pieces = {r.piece: r["count"] for r in sw.wordpiece_vocabulary(words, size=5000).collect()}
    assert pieces["q"] == 1 and pieces["##é"] == 55 and pieces["ab"] == 1 and max(map(len, pieces)) <= 10
    units = {r.piece: r["count"] for r in sw.sentencepiece_vocabulary(words, size=5000, longest=12).collect()}
    assert units["é"] == 55 and max(map(len, units)) == 12


def test_best_chunks_by_model_equal_the_full_ranking(spark, monkeypatch):
    rng = np.random.default_rng(2)
    chunks = [(m, i, f"t{i}", rng.integers(0, 3, 6).astype(float).tolist()) for m in ("a", "b") for i in range(40)]
    queries = [(m, f"q{i}", rng.integers(0, 3, 6).astype(float).tolist()) for m in ("a", "b", "c") for i in range(5)]
    left = spark.createDataFrame(chunks, "model_name string, global_chunk_index bigint, text string, embedding array<double>").repartition(3)
    right = spark.createDataFrame(queries, "model_name string, query string, embedding array<double>")
    full = rt.top_k(rt.cosine_scores_by_model(left, right), 5, "global_chunk_index", ("model_name", "query"))
    columns = ["model_name", "query", "global_chunk_index", "text", "rank", F.round("similarity_score", 9).alias("s")]
    expected = sorted(map(tuple, full.select(*columns).collect()))
    assert sorted(map(tuple, rt.top_k_by_model(left, right).select(*columns).collect())) == expected
    monkeypatch.setattr(rt, "MAX_SHARED_NUMBERS", 0)
    assert sorted(map(tuple, rt.top_k_by_model(left, right).select(*columns).collect())) == expected


def test_running_offset_with_many_ranges(spark):
    df = spark.range(3000).select(F.concat(F.lit("k"), F.md5(F.col("id").cast("string"))).alias("k"), (F.col("id") % 4).alias("w"))
    numeric = df.select(F.monotonically_increasing_id().alias("n"), "w")
    for frame, order in ((df, "k"), (numeric, "n")):
        rows = rk.running_offset(frame, order, "w", range_rows=40).orderBy(order).collect()
        total = 0
        for row in rows:
            assert row.offset == total
            total += row.w
        assert len(rows) == 3000


def test_statistics_of_nothing(spark):
    empty = spark.createDataFrame([], "tokens array<string>")
    row = cs.corpus_statistics(empty).first()
    assert (row.n_sentencias, row.total_tokens, row.longitud_promedio, row.vocabulario_unico) == (0, 0, 0.0, 0)
    metrics = [r.metrica for r in cs.statistics_long(cs.corpus_statistics(empty)).collect()]
    assert "n_sentencias" in metrics and "top_token_1" not in metrics


def vectors(spark):
    rows = [("a", [1.0, 0.0]), ("b", [0.0, 0.0]), ("c", [1.0, 1.0]), ("d", [2.0, 0.0])]
    return spark.createDataFrame(rows, "chunk_id string, embedding array<float>")


def test_ranking_rules(spark):
    scored = rt.cosine_scores(vectors(spark), vectors(spark).where("chunk_id = 'a'"))
    assert [(r.chunk_id, r["rank"]) for r in rt.top_k(scored, 3).orderBy("rank").collect()] == [("a", 1), ("d", 2), ("c", 3)]
    assert rt.top_k(scored, -1).count() == 0
    assert rt.best_chunk(scored).first().chunk_id == "a"
    assert {r.chunk_id: r.similarity_score for r in scored.collect()}["b"] == 0.0
    with pytest.raises(Exception, match="no chunks"):
        rt.best_chunk(scored.limit(0)).collect()
    with pytest.raises(Exception):
        rt.cosine_scores(vectors(spark), vectors(spark)).collect()
    with pytest.raises(Exception, match="do not match"):
        rt.attach_scores(vectors(spark), scored.limit(2)).collect()


def test_encoder_batches_and_unit_length(spark):
    sizes = []

    def factory():
        def encode(texts):
            assert len(texts) <= 2
            return np.array([[len(t), 1.0] for t in texts])

        return encode

    df = spark.createDataFrame([("ab",), ("c",), ("",)], "text string")
    rows = en.encode_texts(df, "m", factory, batch_size=2).collect()
    assert all(abs(np.linalg.norm(r.embedding) - 1) < 1e-6 for r in rows)
    assert en.encode_texts(df.limit(0), "m", factory).count() == 0
    dense = en.encode_tfidf(df.union(spark.createDataFrame([("ab c",)], "text string")), 32)
    assert all(len(r.embedding) == 32 for r in dense.collect()) and not sizes


def test_all_models_in_one_plan(spark):
    chunks = spark.createDataFrame([("x", "uno dos"), ("y", "tres")], "chunk_id string, text string")
    queries = spark.createDataFrame([("dos",)], "query string")
    asked, coded = en.encode_query_and_chunks(queries, chunks)
    assert {r.model_name: len(r.embedding) for r in asked.collect()} == dict(rt.MODELS)
    best = rt.top_k(rt.cosine_scores_by_model(coded, asked), 1, keys=("model_name",)).collect()
    assert len(best) == 4 and {r.chunk_id for r in best} == {"x"}


def test_pca_equals_svd(spark):
    rng = np.random.default_rng(0)
    matrix = rng.normal(size=(40, 5)) * [5, 3, 1, 0.5, 0.1] + 7
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(matrix)], "i int, vector array<double>")
    rows = pr.pca_coordinates(df).orderBy("i").collect()
    found = np.array([[r.x, r.y] for r in rows])
    assert np.allclose(found, pr._plane(matrix), atol=1e-6)
    centred = matrix - matrix.mean(axis=0)
    _, s, _ = np.linalg.svd(centred, full_matrices=False)
    assert np.allclose(np.linalg.norm(found, axis=0), s[:2])
    single = spark.createDataFrame([("m", "w", 1, [1.0, 2.0])], "model_name string, word string, position int, vector array<double>")
    assert pr.word_coordinates(single, "s").count() == 0


def test_many_queries_of_few_models_meet_in_blocks(spark, monkeypatch):
    """The block join and the block product equal the broadcast, and no key holds more rows than blocks allow."""
    monkeypatch.setattr(rt, "QUERY_BLOCK", 7)
    monkeypatch.setattr(rt, "CHUNK_BLOCK", 11)
    rng = np.random.default_rng(2)
    sizes = {"a": (60, 40), "b": (3, 2), "c": (0, 5), "d": (5, 0)}
    make = lambda n: [rng.integers(-3, 4, 6).astype(np.float32).tolist() for _ in range(n)]
    chunks = spark.createDataFrame([(m, i, v) for m, (n, _) in sizes.items() for i, v in enumerate(make(n))], "model_name string, global_chunk_index bigint, embedding array<float>")
    queries = spark.createDataFrame([(m, f"q{i}", v) for m, (_, n) in sizes.items() for i, v in enumerate(make(n))], "model_name string, query string, embedding array<float>")
    left, right = rt.dealt_to_blocks(chunks, queries, 11, 7)
    assert left.groupBy(*rt.BLOCK).count().agg(F.max("count")).first()[0] <= 3 * 11
    assert right.groupBy(*rt.BLOCK).count().agg(F.max("count")).first()[0] <= 3 * 7
    key = lambda r: (r["model_name"], r["query"], r["global_chunk_index"])
    plain, blocked = ({key(r): r["similarity_score"] for r in rt.cosine_scores_by_model(chunks, queries, most_broadcast=n).collect()} for n in (1000, 0))
    assert len(plain) == 60 * 40 + 3 * 2 and plain == blocked
    few, many = ({(*key(r), r["rank"]): r["similarity_score"] for r in rt.top_k_by_model(chunks, queries, 4, max_shared_numbers=n).collect()} for n in (10**9, 0))
    assert len(few) == 40 * 4 + 2 * 3 and few == pytest.approx(many)
    plan = rt.cosine_scores_by_model(chunks, queries, most_broadcast=0)._jdf.queryExecution().optimizedPlan().toString()
    assert "_query_block" in plan and "_chunk_block" in plan


def plain_spans(splitter, text, start, end, separators):
    """Recursive splitting part by part, with a queue of the parts that a chunk holds."""

    def pack(parts):
        held = []
        for part in parts:
            if held and part[1] - held[0][0] > splitter.size:
                yield held[0][0], held[-1][1]
                while held and (part[0] - held[0][0] > splitter.overlap or part[1] - held[0][0] > splitter.size):
                    held.pop(0)
            held.append(part)
        if held:
            yield held[0][0], held[-1][1]

    level = next((i for i, s in enumerate(separators) if text.find(s, start, end) >= 0), len(separators) - 1)
    separator, finer, short = separators[level], separators[level + 1 :], []
    if separator:
        cuts, at = [start], text.find(separator, start, end)
        while at >= 0:
            cuts.append(at)
            at = text.find(separator, at + len(separator), end)
        cuts.append(end)
    else:
        cuts = list(range(start, end + 1))
    for part in [(a, b) for a, b in zip(cuts, cuts[1:]) if a < b]:
        if part[1] - part[0] < splitter.size:
            short.append(part)
            continue
        yield from pack(short)
        short = []
        if finer:
            yield from plain_spans(splitter, text, *part, finer)
        else:
            yield part
    yield from pack(short)


def test_splitter_over_arrays_equals_splitting_part_by_part():
    draw = random.Random(4)
    for _ in range(1500):
        size = draw.randint(1, 30)
        splitter = ch.Splitter(size, draw.randint(0, size - 1), draw.choice([ch.SEPARATORS, ("\n\n", " "), ("ab", "\n", ""), (" ",)]))
        text = "".join(draw.choice("abé \n\n  😀" if draw.random() < 0.5 else "abcdefgh") for _ in range(draw.randint(0, 200)))
        assert list(splitter.spans(text)) == list(plain_spans(splitter, text, 0, len(text), splitter.separators)), (splitter, text)


def test_a_long_text_without_spaces_takes_no_part_per_character():
    chunks = ch.Splitter()("x" * 3_000_000)
    assert len(chunks) == 1 + -(-(3_000_000 - 1000) // 800) and {len(c) for c in chunks[:-1]} == {1000}


def segmentations(word, pieces):
    """All ways to cut a word, with their probability."""
    if not word:
        return [([], 1.0)]
    return [([word[:n], *rest], pieces[word[:n]] * p) for n in range(1, len(word) + 1) if word[:n] in pieces for rest, p in segmentations(word[n:], pieces)]


def test_unigram_training_equals_summing_over_all_segmentations(spark):
    words = ["▁lunes", "▁luna", "▁lunar", "▁una", "▁unas", "▁sol", "▁soles", "▁solar"]
    counts = {w: 3 + i for i, w in enumerate(words)}
    units = spark.createDataFrame([([w] * n,) for w, n in counts.items()] + [([],)], "tokens array<string>").repartition(3)
    trained = ug.train_unigram(units, size=6, longest=5, rounds=3, seeds=40)
    assert sum(len(p) > 1 for p in trained.pieces) == 6 and {c for w in words for c in w} <= set(trained.pieces)
    assert math.fsum(math.exp(x) for x in trained.pieces.values()) == pytest.approx(1)
    for told in trained.likelihoods:
        assert told == sorted(told) and told[-1] > told[0]
    # one round from the trained pieces, by listing every segmentation
    table = units.select(F.explode("tokens").alias("token")).groupBy("token").count()
    found, likelihood = ug.expected_uses(table, trained.pieces, 5)
    plain, shares = {}, {p: math.exp(x) for p, x in trained.pieces.items()}
    total = 0.0
    for word, n in counts.items():
        ways = segmentations(word, shares)
        whole = sum(p for _, p in ways)
        total += n * math.log(whole)
        for pieces, p in ways:
            for piece in pieces:
                plain[piece] = plain.get(piece, 0.0) + n * p / whole
    assert likelihood == pytest.approx(total)
    assert found == pytest.approx(plain)


def test_unigram_vocabulary_feeds_the_encoder(spark):
    documents = spark.createDataFrame([("la casa de la luna",), ("casas y lunas",), (None,)], "text string")
    vocabulary = ug.unigram_vocabulary(documents.select(sw.sentencepiece_units(F.col("text")).alias("tokens")), size=8)
    assert vocabulary.where("length(piece) > 1").count() == 8
    segmenter = sw.collect_segmenter(vocabulary, sw.SENTENCEPIECE_SPECIALS, "<unk>")
    assert "".join(segmenter("▁lunas")) == "▁lunas" and len(segmenter("▁casa")) < len("▁casa")
    empty = ug.train_unigram(documents.where("text IS NULL").select(sw.sentencepiece_units(F.col("text")).alias("tokens")), size=5)
    assert empty.pieces == {} and empty.likelihoods == []
