"""Operators on documents against brute force, with NULLs, empty and long texts, ties, repeated rows and clashing columns."""

from __future__ import annotations

import base64
import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tinta.llm import decontaminate, feistel_output, jaccard_join, language_id, license_scan, mixing, ngram_lm
from tinta.llm import queries as registered

DATA = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, slot string, items int, k1 string, part int"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


@pytest.fixture(scope="module")
def documents(spark):
    """The smallest documents and rows that are odd in every way, with columns whose names the operators use themselves."""
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
    odd = [
        (None, None, None, None, None), (None, "", None, "s", 0), (9001, None, "en", None, None), (9002, "", "en", "src0", 0),
        (9003, "   \n\t 123 456 ", "fr", "src0", 12), (9004, "Ünïcode STRASSE ß K", "de", "src1", 3), (9005, long, "en", "src0", len(long)),
        (9005, long, "en", "src0", len(long)), (9006, long + " end", "en", "src2", 1), (9007, "one two three", None, "src0", 1),
        (9008, "One, TWO three!", None, "src0", 1), (9009, "one two three", None, "src9", 1), (9007, "one two three", None, "src0", 1),
    ]
    rows = [(*r, 0.5, "x", 1, "k", 7) for r in rows + odd]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_decontamination_finds_what_brute_force_finds(spark, documents, none):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    items += [(None, "one two three"), (700, None), (701, ""), (702, "w5x5 w6x6"), (700, "two")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    phrases = defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            phrases[tuple(w[i : i + 10])].add("null" if item is None else str(item))
    lengths = {len(p) for p in phrases}
    expected = []
    for row in documents.collect():
        w, hit, found = words(row["text"]), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (p := tuple(w[i : i + n])) in phrases:
                    hit.update(range(i, i + n))
                    found |= phrases[p]
        expected.append((str(row["doc_id"]), len(w), len(hit), ",".join(sorted(found))))
    for block_words in (1_000_000, 500):
        rows = decontaminate.find_contamination(documents, benchmark, block_words=block_words)
        got = [(str(r[0]), r[1], r[2], ",".join(r[3])) for r in rows.select("doc_id", "n_words", decontaminate.hit_words(), "items").collect()]
        assert sorted(got) == sorted(expected)
    cleaned = decontaminate.remove_spans(decontaminate.find_contamination(documents.drop("items"), benchmark))
    assert cleaned.columns == documents.drop("items").columns
    again = decontaminate.find_contamination(cleaned, benchmark.where("item_id < 100"))
    assert again.where(F.size("spans") > 0).count() == 0
    assert cleaned.where("doc_id = 9007").count() == 0 and cleaned.where("doc_id = 9001").count() == 1
    assert decontaminate.contamination_digest(decontaminate.find_contamination(none, benchmark)).count() == 0
    assert decontaminate.contamination_digest(decontaminate.find_contamination(documents, benchmark.limit(0))).where("contaminated").count() == 0


def similar(documents):
    """Links and smallest reachable rows by comparing all pairs of rows."""
    rows = documents.select("doc_id", "text").collect()
    sets = []
    for r in rows:
        w = words(r["text"])
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    n, label = len(rows), list(range(len(rows)))
    links = [0] * n

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(n):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 5 * common >= 4 * (len(sets[i]) + len(sets[j]) - common):
                links[i] += 1
                links[j] += 1
                label[find(i)] = find(j)
    smallest = defaultdict(list)
    for i in range(n):
        smallest[find(i)].append(rows[i]["doc_id"])
    first = {k: min((x for x in v if x is not None), default=None) for k, v in smallest.items()}
    return rows, links, [first[find(i)] for i in range(n)], len([k for k in smallest if sets[k]])


@pytest.mark.parametrize("sizes", [{}, {"limit": 2, "tile": 2}])
def test_jaccard_join_finds_all_links(documents, none, sizes):
    near = documents
    text = near.where("doc_id = 3").first()["text"]
    rows = [(8000 + i, " ".join(w for k, w in enumerate(text.split()) if k != 7 * i)) for i in range(12)]
    near = near.select("doc_id", "text").union(near.sparkSession.createDataFrame(rows, "doc_id bigint, text string"))
    rows, links, component, _ = similar(near)
    settings = jaccard_join.JoinSettings(**sizes)
    found = jaccard_join.near_duplicates(near, settings).select("doc_id", "n_links", "component_id").collect()
    assert sorted(map(str, map(tuple, found))) == sorted(str((r["doc_id"], n, c)) for r, n, c in zip(rows, links, component))
    assert jaccard_join.near_duplicates(none, settings).count() == 0


def test_deduplicate_keeps_one_of_each_component(documents):
    kept = jaccard_join.deduplicate(documents)
    assert kept.columns == documents.columns
    _, _, _, components = similar(documents)
    assert len([r for r in kept.collect() if words(r["text"])]) == components


def test_runs_follow_the_target_recall():
    assert jaccard_join.lost_in_a_run(jaccard_join.JoinSettings()) ** jaccard_join.JoinSettings().runs <= 1 - 0.9999
    few, many = (jaccard_join.runs_for(jaccard_join.JoinSettings(target_recall=t)) for t in (0.9, 0.9999))
    assert few < many <= 10


def test_language_id_on_held_out_documents(spark, documents, none):
    rows = registered.op9_language_id(spark, "/root/testdata/sf0.01").collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.98
    small = language_id.Training(per_language=60, epochs=3)
    net = language_id.learn(documents, F.col("doc_id"), small)
    found = {str(r["doc_id"]) + str(r["text"])[:20]: r for r in language_id.predict(documents, net).collect()}
    for key in ("NoneNone", "None", "9001None", "9002", "9003   \n\t 123 456 "):
        assert (found[key]["lang_pred"], found[key]["score"]) == ("und", 0.0)
    assert found["9007one two three"]["lang_pred"] in net.labels
    assert language_id.accepted(language_id.predict(documents, net)).where("doc_id IN (9001, 9002, 9003)").count() == 0
    assert language_id.predict(none, net).count() == 0
    assert language_id.learn(none, F.col("doc_id")) is None
    assert {r["lang_pred"] for r in language_id.predict(documents, None).collect()} == {"und"}


def test_lookup_tables_equal_the_convolution():
    net = language_id.train(["the cat", "le chat", "die katze"] * 4, ["en", "fr", "de"] * 4, language_id.Training(epochs=1, window=16))
    x = np.random.default_rng(0).integers(0, 256, (5, 16)).astype(np.uint8)
    looked = np.concatenate((net.embedding[x], np.broadcast_to(net.embedding[0], (5, 3, 8))), axis=1)
    pooled = [
        np.concatenate([looked[:, k : k + 16] for k in range(w)], axis=2) @ kernel for w, kernel in zip(language_id.WIDTHS, net.kernels)
    ]
    z = np.maximum(np.concatenate([p.max(axis=1) for p in pooled], axis=1) + net.biases, 0) @ net.dense + net.offset
    p = np.exp(z - z.max(axis=1, keepdims=True))
    assert np.allclose(language_id.window_probabilities(x, net, net.tables()), p / p.sum(axis=1, keepdims=True), atol=1e-4)


def license_places(text):
    w, labels = words(text), {"mit": "mit", "apache": "apache"}
    out = []
    for i in range(1, len(w)):
        if w[i] == "license" and w[i - 1] in labels:
            out.append((i - 1, labels[w[i - 1]]))
        elif w[i] == "license" and i > 1 and w[i - 2 : i] == ["general", "public"]:
            out.append((i - 2, "gpl"))
    return w, out


def test_license_scan(spark, documents, none):
    mit, apache = license_scan.TEMPLATES["mit"][0], license_scan.TEMPLATES["apache"][0]
    texts = [
        (1, f"some code {mit.upper()} and more"), (2, f"x {apache} y {mit}"), (3, mit.replace("free of charge", "for money")), (4, "MIT LicenSe, apache-license"),
        (5, "GNU General Public\nLicense general public license"), (6, " ".join(reversed(words(mit)))), (7, "Licensed under CC BY-NC 4.0."), (8, "license"), (8, "license"),
        (9, "MIT License " * 3000),
    ]
    docs = documents.select("doc_id", "text", "score").unionByName(spark.createDataFrame(texts, "doc_id bigint, text string"), allowMissingColumns=True)
    got = license_scan.license_scan(docs)
    expected = []
    for r in docs.collect():
        w, places = license_places(r["text"])
        starts = [s for s, _ in places]
        expected.append((r["doc_id"], len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))))
    rows = got.collect()
    assert sorted(map(str, [tuple(r)[:6] for r in rows])) == sorted(map(str, expected))
    labels = {r["doc_id"]: r["labels"] for r in rows if r["doc_id"] and r["doc_id"] < 10 and not (r["doc_id"] in truth_ids(spark) and r["labels"] == "")}
    assert labels[1] == "mit" and labels[2] == "apache,mit" and labels.get(3, "") == "" and labels.get(6, "") == "" and labels[7] == "cc-by-nc"
    assert labels[4] == "apache,mit" and labels[5] == "gpl" and all(0 <= r["score"] <= 1 for r in rows)
    assert license_scan.license_scan(none).count() == 0


def test_license_scan_of_files_with_many_licences(spark):
    """All templates in one file among files that hold parts of them, and a word before every line."""
    texts = {name: text for name, (text, _) in license_scan.TEMPLATES.items()}
    lines = lambda text, phrases: re.sub("|".join(map(re.escape, phrases)), lambda m: "\nrem " + m[0] + "\nrem ", " ".join(words(text)))
    marked = {name: "rem " + lines(text, phrases) for name, (text, phrases) in license_scan.TEMPLATES.items() if len(words(text)) > 30}
    every = " and then ".join(texts.values())
    rows = [(0, every), *[(i, text) for i, text in enumerate(marked.values(), 1)], *[(100 + i, " ".join(words(t)[: 5 + i % 40])) for i, t in enumerate([*texts.values()] * 20)]]
    found = {r["doc_id"]: r for r in license_scan.license_scan(spark.createDataFrame(rows, "doc_id bigint, text string")).where("doc_id < 100").collect()}
    assert {m["template"] for m in found[0]["matches"]} == set(texts) and found[0]["labels"] == ",".join(sorted(set(texts) | set(filter(None, found[0]["base_labels"].split(",")))))
    starts = {m["template"]: m["start"] for m in found[0]["matches"]}
    for name, text in texts.items():
        w = words(every)
        assert w[starts[name] : starts[name] + len(words(text))] == words(text)
    assert len(marked) > 3 and all(name in found[i]["labels"].split(",") for i, name in enumerate(marked, 1))


def truth_ids(spark):
    return {r["doc_id"] for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id").collect()}


def test_language_model_scores(documents, none):
    docs = documents.select("doc_id", "text", (F.coalesce(F.col("doc_id") % 3 != 1, F.lit(False))).alias("train"))
    settings = ngram_lm.ModelSettings(share=1e-3, shard_tokens=5000)
    known, model = ngram_lm.build_model(docs, settings)
    got = ngram_lm.score_texts(docs, known, model, settings).collect()
    rows = [(r["doc_id"], re.findall(r"[^\x20\x09-\x0D]+", (r["text"] or "").translate(LOWER)) + ["\n"], r["train"]) for r in docs.collect()]
    c, pairs = Counter(), Counter()
    for _, w, train in rows:
        if train:
            c.update(w)
            pairs.update(zip(["\t", *w], w))
    total, distinct = sum(c.values()), len(c)
    context = {**c, "\t": sum(t for *_, t in rows)}
    p = lambda v: (c[v] + 0.5) / (total + 0.5 * (distinct + 1))
    g = settings.g
    expected = []
    for doc, w, _ in rows:
        base = sum(math.log10(p(v)) for v in w)
        bigram = sum(math.log10((pairs[u, v] + g * p(v)) / (context.get(u, 0) + g)) for u, v in zip(["\t", *w], w))
        high, low = max(base, bigram), min(base, bigram)
        expected.append((str(doc), len(w), sum(c[v] > 0 for v in w), total, base, high + math.log10(0.5 * (1 + 10 ** (low - high)))))
    assert len(got) == len(expected)
    for r, e in zip(sorted(got, key=lambda r: (str(r[0]), r[1], r[4])), sorted(expected, key=lambda e: (e[0], e[1], e[4]))):
        assert (str(r[0]), r[1], r[2], r[3]) == e[:4]
        assert r["base_score"] == pytest.approx(e[4], rel=1e-9) and r["score"] == pytest.approx(e[5], abs=0.02 * e[1] + 0.05)
    known, model = ngram_lm.build_model(none.select("text", F.lit(True).alias("train")), settings)
    assert ngram_lm.score_texts(none, known, model).count() == 0
    untrained = docs.withColumn("train", F.lit(False))
    known, model = ngram_lm.build_model(untrained, settings)
    assert {r["base_score"] for r in ngram_lm.score_texts(untrained.limit(20), known, model).collect()} == {0.0}


def test_mixing_keeps_every_source_within_a_block(spark, documents, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    weights = {f"src{i}": 1 + i for i in range(20)}
    settings = mixing.Mixing(block=2, bucket=100)
    mixed = mixing.mix(docs, weights, settings=settings).select("source", "block", "slot", "in_block", "release", "deadline").collect()
    assert len(mixed) == docs.count() == len({(r["slot"], r["in_block"]) for r in mixed})
    shares, period = mixing.whole_shares(weights, settings.least_period)
    assert sum(shares.values()) == period
    for source in ("src0", "src7", "src19"):
        slots = sorted({(r["block"], r["slot"]) for r in mixed if r["source"] == source})
        for block, slot in slots:  # when block j runs, j blocks have run before
            assert block - 1 < slot * shares[source] / period < block + 1
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in mixed)
    every = mixing.mix(documents)
    assert every.count() == documents.count() and every.where("block IS NULL").count() == 0
    assert mixing.in_training_order(every).columns == [c for c in documents.columns if c != "slot"]
    pooled = mixing.mix(documents, settings=mixing.Mixing(most_sources=3))
    assert pooled.count() == documents.count()
    assert mixing.mix(none).count() == 0


def test_one_period_meets_all_deadlines():
    for weights in ({"a": 1}, {"a": 1, "b": 1000}, {None: 3, **{str(i): i + 1 for i in range(300)}}):
        shares, period = mixing.whole_shares(weights, 256)
        rows = mixing.one_period(shares, period)
        assert sorted(slot for _, _, slot, _, _ in rows) == list(range(period))
        assert all(release <= slot < deadline for _, _, slot, release, deadline in rows)


def within_a_block(placed, weights):
    """Deviation of each source with blocks left from the weights that were passed in."""
    total = sum(map(Fraction, weights.values()))
    for s, block, slot in {(r["source"], r["block"], r["slot"]) for r in placed}:
        w = Fraction(weights[s]) / total
        assert block - 1 < slot * w < block + 1 and math.floor(block / w) <= slot < math.ceil((block + 1) / w)


def test_schedules_keep_the_weights_that_are_passed_in():
    """One large source among many, two of very different weight, and a plain mix far beyond 10,000 slots."""
    cases = [
        ({"s0": 0.5, **{f"s{i}": 0.0005 for i in range(1, 1000)}}, 2000), ({"a": 0.9999, "b": 0.0001}, 30_000), ({"a": 0.4, "b": 0.3, "c": 0.2, "d": 0.1}, 40_000),
    ]
    for weights, slots in cases:
        shares, period = mixing.whole_shares(weights, 1)
        total = sum(map(Fraction, weights.values()))
        assert all(Fraction(shares[k], period) == Fraction(w) / total for k, w in weights.items())
        names = list(shares)
        blocks = [math.ceil(slots * Fraction(weights[k]) / total) for k in names]
        placed = [{"source": names[i], "block": j, "slot": slot} for i, j, slot, _, _ in mixing.schedule([shares[k] for k in names], period, blocks)]
        assert len(placed) == sum(blocks)
        within_a_block(placed, weights)


def test_mixing_holds_the_target_weights(spark):
    sizes = {"big": 900, **{f"s{i}": 3 for i in range(300)}}
    docs = spark.createDataFrame([(f"{s}-{i}", s) for s, n in sizes.items() for i in range(n)], "doc_id string, source string")
    weights = {"big": 0.5, **{f"s{i}": 0.5 / 300 for i in range(300)}}
    placed = mixing.mix(docs, weights, settings=mixing.Mixing(block=1)).collect()
    assert len(placed) == 1800 == len({r["slot"] for r in placed})
    within_a_block(placed, weights)


def test_mixing_gives_every_source_its_weight(spark):
    """More sources than ``most_sources``: each keeps the weight passed for it, also the smallest and NULL."""
    sizes = {"big": 200, None: 4, **{f"s{i}": 2 + i % 3 for i in range(60)}}
    docs = spark.createDataFrame([(i, s) for s, n in sizes.items() for i in range(n)], "doc_id bigint, source string")
    weights = {"big": 3, None: 0.25, **{f"s{i}": 0.01 * (1 + i % 7) for i in range(60)}}
    for most in (4, 1 << 16):
        settings = mixing.Mixing(block=1, most_sources=most)
        placed = mixing.mix(docs, weights, settings=settings).collect()
        assert Counter(r["source"] for r in placed) == sizes and len({r["slot"] for r in placed}) == docs.count()
        within_a_block(placed, weights)
    natural = mixing.mix(docs, power=1.0, settings=mixing.Mixing(block=1, most_sources=4)).collect()
    within_a_block(natural, sizes)


@pytest.mark.parametrize("count", [1, 2, 3, 17, 1000, 4097])
def test_feistel_is_a_bijection(count):
    image = feistel_output.feistel(np.arange(count), count, key=99)
    assert sorted(image) == list(range(count))
    assert count < 100 or (image != feistel_output.feistel(np.arange(count), count, key=98)).any()


def test_token_output_round_trip_and_resume(spark, documents, none):
    tiktoken = pytest.importorskip("tiktoken")
    odd = [(1, "a  b \n c  d e 's  \n\n x 　y  z"), (2, "  lead  trail  "), (3, "  wide")]
    docs = documents.where("doc_id >= 9001 OR doc_id < 40 OR doc_id IS NULL").select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id bigint, text string").selectExpr("doc_id + 20000", "text"))
    vocabulary, layout = feistel_output.Vocabulary(), feistel_output.Layout(length=64, shard_slots=128)
    path = feistel_output.materialise(docs, vocabulary, layout)
    rows = feistel_output.read_shards(spark, path, vocabulary).collect()
    assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    with open(vocabulary.path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    encoding = tiktoken.Encoding("own", pat_str=feistel_output.PATTERN, mergeable_ranks=ranks, special_tokens={})
    held = Counter((r["doc_id"], r["seq"], r["tokens"]) for r in rows)
    expected = Counter()
    for r in docs.collect():
        ids = [*encoding.encode_ordinary(r["text"] or ""), vocabulary.end]
        expected.update((r["doc_id"], i // 64, np.array(ids[i : i + 64], "<u2").tobytes()) for i in range(0, len(ids), 64))
    assert {(d, s, bytes(t)): n for (d, s, t), n in held.items()} == dict(expected)
    later = feistel_output.read_shards(spark, path, vocabulary, from_slot=200).collect()
    assert sorted(r["slot"] for r in later) == list(range(200, len(rows)))
    # a run that broke off: one shard is there already, only the others are added
    sequences, half = feistel_output.store_sequences(docs, vocabulary, layout), path + "-half"
    spark.read.parquet(path).where("shard = 0").write.parquet(half)
    feistel_output.write_shards(sequences, half, vocabulary, layout)
    assert spark.read.parquet(half).count() == spark.read.parquet(path).count() == -(-len(rows) // 128)
    assert feistel_output.materialised(none).count() == 0


def test_columns_with_the_names_used_on_the_way_are_kept(spark):
    rows = [(i, f"one two three four five six {i % 4}", "abc"[i % 3], i, -i, "x") for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, _row int, _digest int, _k1 string")
    mixed = mixing.mix(docs, settings=mixing.Mixing(block=2))
    assert mixed.columns == [*docs.columns, *mixing.ADDED]
    assert sorted(tuple(r)[:6] for r in mixed.collect()) == sorted(rows)
    single = jaccard_join.deduplicate(docs)
    assert single.columns == docs.columns and sorted(map(tuple, single.collect())) == sorted(rows)[:4]
