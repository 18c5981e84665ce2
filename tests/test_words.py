from __future__ import annotations

import heapq

import numpy as np
import pytest
from pyspark.sql import functions as F

from tinta.operators import encoding as en
from tinta.operators import frequency_tables as ft
from tinta.operators import neighbours as nb
from tinta.operators import subword_vectors as sv
from tinta.operators import word_vectors as wv
from tinta.operators import corpus_stats as cs
from tinta.operators.corpus_stats import token_counts
from tinta.operators.word2vec import train_word2vec
from tinta.sinks import writers
from tinta.streaming import corpus_stream as st


def table(spark, words):
    rows = [(w, i, 100 - i, v) for i, (w, v) in enumerate(words)]
    return spark.createDataFrame(rows, "word string, idx bigint, count bigint, vector array<float>")


def test_nearest_equals_brute_force_on_both_paths(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 8)).astype(np.float32)
    matrix = np.concatenate([base, base[:20], np.zeros((1, 8), np.float32)])  # exact copies and a zero vector
    df = spark.createDataFrame([(f"v{i:02d}", r.tolist()) for i, r in enumerate(matrix)], "id string, v array<float>")
    units = nb.unit_rows(list(matrix))
    scores = np.round(units @ units.T, 9)
    expected = {}
    for i in range(len(matrix)):
        order = sorted((j for j in range(len(matrix)) if j != i), key=lambda j: (-scores[i, j], j))[:4]
        expected[f"v{i:02d}"] = [f"v{j:02d}" for j in order]
    for limit in (10**9, 0):
        rows = nb.nearest(df, df, 4, "id", "v", max_shared_numbers=limit).collect()
        found = {}
        for row in sorted(rows, key=lambda r: (r.query_id, r.ranking)):
            found.setdefault(row.query_id, []).append(row.neighbour_id)
        assert found == expected


def test_blocks_far_from_the_queries_are_not_compared(spark, monkeypatch):
    """Clusters, copies, opposite and zero vectors in small blocks: equal to brute force, with most pairs of tile and block skipped."""
    monkeypatch.setattr(nb, "BLOCK_NUMBERS", 160)
    monkeypatch.setattr(nb, "TILE_QUERIES", 16)
    monkeypatch.setattr(nb, "TILES_AT_ONCE", 4)
    paired = []
    original = nb._met
    monkeypatch.setattr(nb, "_met", lambda tiles, blocks, pairs, *rest: (paired.append((pairs.count(), tiles.count() * blocks.count())), original(tiles, blocks, pairs, *rest))[1])
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(40, 8))
    matrix = (centres[rng.integers(0, 40, 2400)] + rng.normal(size=(2400, 8)) * 0.02).astype(np.float32)
    matrix[100:130], matrix[200], matrix[300] = matrix[5], 0, -matrix[301]
    ids = [f"w{i:05d}" for i in rng.permutation(2400)]
    df = spark.createDataFrame(list(zip(ids, matrix.tolist())), "id string, v array<float>").repartition(6)
    asked = df.where("substr(id, 6, 1) = '0'").union(spark.createDataFrame([("new", centres[3].astype(np.float32).tolist()), ("none", None)], df.schema))
    found: dict = {}
    for r in nb.nearest(df, asked, 5, "id", "v", max_shared_numbers=0).collect():
        found.setdefault(r.query_id, {})[r.ranking] = (r.neighbour_id, r.score)
    units, place = nb.unit_rows(list(matrix)), {w: i for i, w in enumerate(ids)}
    assert set(found) == {w for w in ids if w[-1] == "0"} | {"new"}
    for word, hits in found.items():
        query = units[place[word]] if word != "new" else nb.unit_rows([centres[3].astype(np.float32)])[0]
        scores = np.round(units @ query, 9)
        best = sorted((i for i in range(2400) if ids[i] != word), key=lambda i: (-scores[i], ids[i]))[:5]
        assert [hits[k + 1][0] for k in range(5)] == [ids[i] for i in best]
        assert [hits[k + 1][1] for k in range(5)] == pytest.approx([scores[i] for i in best], abs=2e-9)
    (_, _), (met, every) = paired
    assert met < every / 3, (met, every)


def test_a_vector_that_most_ids_share_is_one_class(spark):
    df = spark.range(3000).select(F.format_string("w%04d", "id").alias("id"), F.when(F.col("id") % 3 > 0, F.array(F.lit(1.0), F.lit(0.0))).otherwise(F.array(F.lit(0.0), F.col("id") + 1.0)).alias("v"))
    assert nb.vector_classes(df.withColumnRenamed("v", "vector"), 3).where("vector[0] = 1").select("ids").first()[0] == ["w0001", "w0002", "w0004"]
    rows = nb.nearest(df, df, 2, "id", "v", max_shared_numbers=0).where("query_id = 'w0002'").orderBy("ranking").collect()
    assert [(r.neighbour_id, r.score) for r in rows] == [("w0001", 1.0), ("w0004", 1.0)]


@pytest.mark.parametrize("dimensions", [16, 64, 300])
def test_score_tiles_are_bounded(dimensions, monkeypatch):
    monkeypatch.setattr(nb, "TILE_SCORES", 1000)
    rng = np.random.default_rng(dimensions)
    queries, units = rng.normal(size=(57, dimensions)), rng.normal(size=(90, dimensions))
    assert max(len(tile) * 90 for tile in nb.query_tiles(queries, 90)) <= 1000
    found = nb.best_in_batch(np.arange(57), queries, np.arange(90), units, 3, False)
    best = np.argsort(-np.round(queries @ units.T, 9), axis=1, kind="stable")[:, :3]
    assert (found["neighbour_id"].to_numpy().reshape(57, 3) == best).all()


def test_blocks_of_a_hot_word_stay_near_the_mean(spark, monkeypatch):
    monkeypatch.setattr(sv, "BLOCK_PAIRS", 2000)
    monkeypatch.setattr(sv, "PAIR_SHARE", 500)
    rng = np.random.default_rng(1)
    rows = [(["hot" if rng.random() < 1 / 3 else f"w{rng.integers(0, 400)}" for _ in range(30)],) for _ in range(600)]
    sentences = spark.createDataFrame(rows, "tokens array<string>")
    words = wv.vocabulary_index(token_counts(sentences))
    blocks = sv._training_blocks(sentences, words, 5, 1 << 10)
    totals = blocks.select("block", F.explode("counts").alias("n")).groupBy("block").agg(F.sum("n").alias("n")).collect()
    sizes = [r["n"] for r in totals]
    assert max(sizes) < 4 * sum(sizes) / len(sizes)


def test_similar_words_and_markers(spark):
    words = table(spark, [("gato", [1.0, 0.0]), ("perro", [0.9, 0.1]), ("sol", [0.0, 1.0])])
    asked = wv.word_list(spark, ["gato", "nadie"])
    rows = {(r.palabra_consultada, r.ranking): r for r in wv.similar_words(words, asked, "M", 1).collect()}
    assert rows[("gato", 1)].palabra_similar == "perro"
    assert rows[("nadie", None)].estado == "fuera_del_vocabulario"
    with pytest.raises(ValueError):
        wv.similarity_report(words, words, wv.word_list(spark, ["nadie"]), ("a", "b"))


def test_word_selection(spark):
    names = ["para", "gobierno", "año", "zz9z", "casas", "ciudad", "libro"]
    words = table(spark, [(w, [1.0]) for w in names])
    assert [r.word for r in wv.default_words(words, words, 4).orderBy("position").collect()] == [
        "gobierno", "ciudad", "casas", "libro"
    ]
    shown = wv.display_words(words, 3, ["libro", "nadie", "libro"]).orderBy("position").collect()
    assert [r.word for r in shown] == ["libro", "para", "gobierno"]
    stats = wv.vocabulary_stats(words, "M", 2)
    row = writers.vocabulary_stats_table(stats).first()
    assert row.vocab_size == 7 and row.top_words_json == '[{"word":"para","count":100},{"word":"gobierno","count":99}]'


def corpus(spark):
    lines = [["rey", "reina", "trono"], ["perro", "gato", "casa"]] * 40 + [["raro"]]
    return spark.createDataFrame([(t,) for t in lines], "tokens array<string>").repartition(4)


def test_pairs(spark):
    df = spark.createDataFrame([(["a", "b", "c", "a"],), ([],), (["z"],)], "tokens array<string>")
    found = {(r.center, r.context): r["count"] for r in wv.skipgram_pairs(df, 1).collect()}
    assert found == {("a", "b"): 1, ("b", "a"): 1, ("b", "c"): 1, ("c", "b"): 1, ("c", "a"): 1, ("a", "c"): 1}


def plain_huffman(weights):
    """Total weight times length of the shortest code."""
    heap, total = sorted(weights), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        joined = heapq.heappop(heap) + heapq.heappop(heap)
        total += joined
        heapq.heappush(heap, joined)
    return total


@pytest.mark.parametrize("seed", range(8))
def test_huffman_tree_of_runs_is_a_shortest_code(seed):
    draw = np.random.default_rng(seed)
    counts = np.sort(draw.choice(np.arange(1, 2000), draw.integers(1, 60), replace=False))[::-1]
    words = draw.integers(1, 40, len(counts)) if seed else np.array([1] * len(counts))
    tree = ft.HuffmanTree.build(counts, words)
    weights = np.repeat(counts, words)
    nodes, bits, lengths = tree.paths(np.arange(len(weights)))
    assert int((lengths * weights).sum()) == plain_huffman(weights.tolist())
    ends = np.cumsum(lengths)
    codes = {tuple(zip(nodes[b:e][::-1].tolist(), bits[b:e][::-1].tolist())) for b, e in zip(ends - lengths, ends)}
    assert len(codes) == len(weights)  # every word has a way of its own
    assert len(weights) == 1 or set(nodes.tolist()) == set(range(len(weights) - 1))
    assert all(nodes[e - 1] == len(weights) - 2 for e in ends if len(weights) > 1)  # they meet in the root


def test_noise_follows_the_power_of_the_counts():
    counts, words = np.array([900, 100, 10, 1]), np.array([1, 2, 10, 500])
    drawn = np.bincount(ft.NoiseTable.build(counts, words).draw(np.random.default_rng(3), 400_000), minlength=513) / 400_000
    share = np.repeat(counts**0.75, words)
    share /= share.sum()
    groups = np.repeat(np.arange(4), words)
    assert np.bincount(groups, drawn) == pytest.approx(np.bincount(groups, share), rel=0.02)
    assert drawn[:13] == pytest.approx(share[:13], rel=0.1) and (drawn[13:] > 0).mean() > 0.99


def test_negatives_do_not_depend_on_the_block(spark):
    """The pool of a block is drawn from the whole vocabulary: the same words whatever pairs the block holds."""
    noise = ft.NoiseTable.build(np.array([50, 5]), np.array([3, 200]))
    pools = [sv.noise_pool(noise, (42, 0), block) for block in range(30)]
    assert (sv.noise_pool(noise, (42, 0), 7) == pools[7]).all() and not (pools[7] == pools[8]).all()
    share = 3 * 50**0.75 / (3 * 50**0.75 + 200 * 5**0.75)
    assert np.mean(np.concatenate(pools) < 3) == pytest.approx(share, rel=0.05)


def test_word2vec(spark, monkeypatch):
    monkeypatch.setattr(sv, "BLOCK_PAIRS", 2000)
    rng = np.random.default_rng(11)
    topics = [[f"t{t}w{i}" for i in range(6)] for t in range(5)]
    lines = [[str(w) for w in rng.choice(topics[rng.integers(5)], 8)] for _ in range(400)] + [["raro"]] + [["solo"]] * 6
    sentences = spark.createDataFrame([(t,) for t in lines], "tokens array<string>").repartition(4)
    vectors, losses = train_word2vec(sentences, vector_size=12, epochs=4, rate=0.2)
    rows = {r.word: np.array(r.vector) for r in vectors.collect()}
    assert set(rows) == {w for t in topics for w in t} | {"solo"}  # raro is too rare, solo has no neighbour
    assert {len(v) for v in rows.values()} == {12} and sorted(r.idx for r in vectors.collect()) == list(range(31))
    assert losses == sorted(losses, reverse=True) and losses[-1] < 0.9 * losses[0]

    def cos(a, b):
        return rows[a] @ rows[b] / np.linalg.norm(rows[a]) / np.linalg.norm(rows[b])

    inside = np.mean([cos(a, b) for t in topics for a in t for b in t if a < b])
    across = np.mean([cos(a, b) for t in topics for s in topics if s is not t for a in t for b in s])
    assert inside > across + 0.4
    with pytest.raises(ValueError):
        train_word2vec(sentences, min_count=10**6)


def test_subword_training_learns_and_reaches_unseen_words(spark, monkeypatch):
    monkeypatch.setattr(sv, "BLOCK_PAIRS", 200)
    monkeypatch.setattr(sv, "PAIR_SHARE", 20)
    vectors, grams = sv.train_subword_vectors(
        corpus(spark), vector_size=12, window=2, epochs=12, buckets=2048, rate=0.3
    )
    vectors, grams = vectors.cache(), grams.cache()
    rows = {r.word: np.array(r.vector) for r in vectors.collect()}
    assert set(rows) == {"rey", "reina", "trono", "perro", "gato", "casa"}

    def cos(a, b):
        return rows[a] @ rows[b] / np.linalg.norm(rows[a]) / np.linalg.norm(rows[b])

    assert cos("gato", "perro") > cos("gato", "rey") and cos("rey", "reina") > cos("rey", "casa")
    asked = wv.word_list(spark, ["perros", "gato", "xyzq"])
    found = sv.unseen_neighbours(vectors, grams, asked, n=2, buckets=2048).collect()
    by_word = {(r.palabra_oov, r.ranking): r for r in found}
    assert by_word[("perros", 1)].palabra_similar == "perro"
    assert by_word[("gato", 1)].esta_en_vocabulario_explicito
    assert not by_word[("perros", 1)].esta_en_vocabulario_explicito
    assert by_word[("xyzq", None)].estado.startswith("error:")
    only = wv.word_list(spark, ["rey", "casa"])
    limited = sv.unseen_neighbours(vectors, grams, asked, references=only, n=5, buckets=2048).collect()
    assert {r.palabra_similar for r in limited if r.estado == "ok"} == {"rey", "casa"}


def test_training_pairs_are_all_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(sv, "BLOCK_PAIRS", 50)
    monkeypatch.setattr(sv, "PAIR_SHARE", 7)
    words = wv.vocabulary_index(token_counts(corpus(spark)))
    blocks = sv._training_blocks(corpus(spark), words, 2, 1024)
    dealt = blocks.select(F.explode("counts").alias("n")).agg(F.sum("n")).first()[0]
    assert dealt == wv.skipgram_pairs(corpus(spark), 2).agg(F.sum("count")).first()[0]
    assert blocks.select("block").distinct().count() > 1


def test_ngrams(spark):
    df = spark.createDataFrame([("sol",), ("a",)], "word string")
    found = [sorted(r[0]) for r in df.select(sv.char_ngrams(F.col("word"))).collect()]
    assert found == [sorted(["<so", "sol", "ol>", "<sol", "sol>", "<sol>"]), ["<a>"]]


def test_stream_limit_and_restart(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = spark.range(40).select(F.concat(F.lit("hola mundo "), F.col("id").cast("string")).alias("text"))
    rows.repartition(4).write.json(source)

    def run():
        stream = st.read_stream(spark, source, "text string", "json", max_files=1)
        st.write_clean_stream(stream, str(tmp_path / "out"), str(tmp_path / "ck"), max_sentences=7)
        counted = st.read_stream(spark, source, "text string", "json", max_files=1)
        st.write_token_counts(counted, str(tmp_path / "counts"), str(tmp_path / "ck2"))

    run()
    run()  # nothing new: nothing is written twice
    assert spark.read.json(str(tmp_path / "out")).count() == 7
    counts = {r.token: r["count"] for r in st.read_token_counts(spark, str(tmp_path / "counts")).collect()}
    assert counts == {"hola": 40, "mundo": 40}


def test_writers(spark, tmp_path):
    vectors = spark.createDataFrame(
        [("BAAI/bge-m3", "q", "c1", [1.0, 0.0], 0.5)],
        "model_name string, query string, chunk_id string, embedding array<float>, similarity_score double",
    )
    writers.save_embeddings(vectors, vectors, str(tmp_path / "e"))
    saved = spark.read.parquet(str(tmp_path / "e" / "chunks")).first()
    assert saved.model_slug == "BAAI_bge-m3" and saved.embedding == [1.0, 0.0]
    writers.save_rankings(vectors.drop("embedding"), vectors, str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "r" / "top")).count() == 1
    words = table(spark, [("a", [1.0]), ("b", [2.0])])
    writers.save_embedding_matrix(wv.embedding_matrix(words, 1), str(tmp_path / "m"))
    assert [r.word for r in spark.read.parquet(str(tmp_path / "m")).collect()] == ["a"]
    writers.save_vocabulary_stats(writers.vocabulary_stats_table(wv.vocabulary_stats(words, "M")), str(tmp_path / "v"))
    assert spark.read.csv(str(tmp_path / "v"), header=True, escape='"').first().vocab_size == "2"
    writers.save_coordinates(words.select("word", F.lit(0.0).alias("x")), str(tmp_path / "xy"))
    assert spark.read.csv(str(tmp_path / "xy"), header=True).count() == 2


def test_stream_statistics_stay_in_few_folders_and_count_a_repeated_batch_once(spark, tmp_path):
    lines = [["uno", "dos", "tres"][: 1 + i % 3] + [f"t{i % 7}"] * (1 + i % 5) for i in range(44)]
    batches = [spark.createDataFrame([(t,) for t in lines[i * 2 : i * 2 + 2]], "tokens array<string>") for i in range(22)]
    store = st.SegmentStore(spark, str(tmp_path / "stats"))
    for number, batch in enumerate(batches):
        store.add(batch, number)
        if number in (3, 7, 20):  # the merge of a batch is repeated as well
            store.add(batch, number)
    store.add(batches[21], 21)
    segments = store.segments()
    assert [(s["level"], s["first"], s["last"]) for s in segments] == [(2, 0, 15), (1, 16, 19), (0, 20, 20), (0, 21, 21)]
    assert len(store._names("segments")) <= 2 * st.FAN * 3 and len(store._names("manifests")) == 2
    whole = spark.createDataFrame([(t,) for t in lines], "tokens array<string>")
    assert st.read_statistics(spark, str(tmp_path / "stats")).collect() == cs.corpus_statistics(whole).collect()
    assert sorted(st.read_token_counts(spark, str(tmp_path / "stats")).collect()) == sorted(token_counts(whole).collect())
    empty = st.read_statistics(spark, str(tmp_path / "none")).first()
    assert (empty["n_sentencias"], empty["longitud_minima"], empty["vocabulario_unico"]) == (0, 0, 0)


def test_ngram_vectors_of_the_asked_words_only(spark):
    words = table(spark, [("gato", [1.0, 0.0]), ("gatos", [1.0, 0.0]), ("pato", [0.0, 3.0]), ("sol", [5.0, 5.0])])
    asked = spark.createDataFrame([("gat",), ("ñu",)], "word string")
    found = {r.ngram: list(r.vector) for r in sv.asked_gram_vectors(words, asked).collect()}
    assert found == {"<ga": [1.0, 0.0], "gat": [1.0, 0.0], "<gat": [1.0, 0.0]}
    rows = sv.unseen_neighbours(words, sv.asked_gram_vectors(words, asked), asked, n=2, gram="ngram", buckets=None).collect()
    assert [(r.palabra_similar, r.esta_en_vocabulario_explicito) for r in rows if r.palabra_oov == "gat"] == [("gato", False), ("gatos", False)]
    assert [r.estado for r in rows if r.palabra_oov == "ñu"] == ["error: no known n-gram"]


def test_mean_word_vectors_on_both_paths(spark):
    vectors = table(spark, [("rey", [1.0, 0.0]), ("reina", [0.0, 2.0]), ("de", [4.0, 4.0])])
    rows = [(1, ["rey", "rey", "reina", "nadie"]), (2, ["nadie"]), (3, []), (None, ["de"])] + [(i, ["de", "rey"]) for i in range(10, 60)]
    sentences = spark.createDataFrame(rows, "doc_id bigint, tokens array<string>")
    for limit in (10**9, 0):
        found = {r["doc_id"]: (r["n_known"], r["embedding"]) for r in en.encode_mean_vectors(sentences, vectors, max_shared=limit).collect()}
        assert len(found) == len(rows) and found[1] == (3, pytest.approx([2 / 3, 2 / 3])) and found[2] == (0, None) == found[3]
        assert found[30] == (2, pytest.approx([2.5, 2.0]))
    weights = spark.createDataFrame([("rey", 1.0), ("reina", 6.0)], "word string, weight double")
    found = {r["doc_id"]: r["embedding"] for r in en.encode_mean_vectors(sentences, vectors, weights=weights).collect()}
    assert found[1] == pytest.approx([2 / 8, 12 / 8]) and found[30] == pytest.approx([1.0, 0.0])
