"""Cross-tokenizer alignment, repeated passages and periodic runs, each against a plain brute-force version."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tinta.llm import perfect_hash, run_detection, substring_dedup, token_alignment
from tinta.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SPACES = re.compile(r"[^\x20\x09-\x0D]+")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def documents(spark) -> list[tuple[int, str | None]]:
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


# ---- 11: alignment


def plain_alignment(texts: list[str | None]) -> list[dict]:
    """Whole texts through both tokenizers, links from all pairs of overlapping byte ranges."""
    import sentencepiece
    from tokenizers import Tokenizer

    paths = token_alignment.Tokenizers()
    first = Tokenizer.from_file(paths.a)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=paths.b)
    letters = token_alignment.byte_letters()

    def spans(sizes: list[int]) -> list[tuple[int, int]]:
        ends = np.cumsum(sizes).tolist()
        return list(zip([0, *ends[:-1]], ends))

    rows = []
    for text in texts:
        row = {"a": [], "b": [], "links": [], "groups": ""}
        rows.append(row)
        if not text:
            continue
        a = first.encode(" " + text, add_special_tokens=False).ids
        b = second.encode(text)
        a_bytes = [bytes(letters[c] for c in first.id_to_token(t)) for t in a]
        b_bytes = [bytes([int(second.id_to_piece(t)[3:5], 16)]) if second.is_byte(t) else second.id_to_piece(t).replace("▁", " ").encode() for t in b]
        if b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            continue
        at, bt = spans([len(x) for x in a_bytes]), spans([len(x) for x in b_bytes])
        low = 0
        for i, (begin, end) in enumerate(at):
            while bt[low][1] <= begin:
                low += 1
            j = low
            while j < len(bt) and bt[j][0] < end:
                row["links"].append((a[i], b[j]))
                j += 1
        ends = sorted({e for _, e in at} & {e for _, e in bt})
        groups = []
        for begin, end in zip([0, *ends[:-1]], ends):
            parts = [",".join(str(t) for t, (x, y) in zip(ids, where) if begin <= x and y <= end) for ids, where in ((a, at), (b, bt))]
            groups.append("|".join(parts))
        row |= {"a": a, "b": b, "groups": ";".join(groups)}
    counts = Counter(link for row in rows for link in set(row["links"]))
    best: dict[int, int] = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    for row in rows:
        row["n_best"] = sum(counts[link] == best[link[0]] for link in row["links"])
        row["count_sum"] = sum(counts[link] for link in row["links"])
    return rows


def expected_alignment(rows: list[tuple[int | None, str | None]]) -> list[tuple]:
    out = []
    for (doc, _), row in zip(rows, plain_alignment([t for _, t in rows])):
        n = row["groups"].count(";") + 1 if row["groups"] else 0
        out.append((doc, len(row["a"]), len(row["b"]), n, len(row["links"]), row["n_best"], row["count_sum"], digest(row["groups"]) if row["groups"] else ""))
    return sorted(out, key=str)


ALIGNED = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
ODD_TEXTS = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a\t b", "a \n b", "<|endoftext|> here <s> </s>", "don't  we'll I'M", "x y  z", "a 　b",
    "▁ under ▁score", "ﬁ ½ é naïve", "日本語 のテキスト です", "\U0001f469‍\U0001f52c lab \U0001f600", "1234567 89 0.5", "\x00 \x01a \x7f", "a" * 3000, "word " * 500, "\r\n x \x0b y \x0c", "a \x85b  c",
]


def test_alignment_equals_whole_text_alignment(spark):
    rows = documents(spark)
    assert sorted((tuple(r) for r in QUERIES["op11_token_alignment"](spark, SF).select(*ALIGNED).collect()), key=str) == expected_alignment(rows)


@pytest.mark.parametrize("settings", [token_alignment.AlignSettings(), token_alignment.AlignSettings(bucket_pairs=8, most_pairs=64)])
def test_alignment_of_odd_texts_in_one_or_many_ranges(spark, settings):
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(1, "a"), (None, "same again"), (None, "same again")]
    docs = spark.createDataFrame([(i, t, "kept", 7) for i, t in rows], "doc_id bigint, text string, n_a string, extra int").repartition(3)
    aligned = token_alignment.align_documents(docs, settings=settings)
    assert aligned.columns == ["doc_id", "extra", *token_alignment.NUMBERS, "groups"]
    found = token_alignment.alignment_digest(aligned).select(*ALIGNED).collect()
    assert sorted((tuple(r) for r in found), key=str) == expected_alignment(rows)


def test_pair_counts_are_document_counts(spark):
    texts = ["the cat sat", "the cat ran", "a cat", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    expected = Counter(link for row in plain_alignment(texts) for link in set(row["links"]))
    assert {(r["a"], r["b"]): r["n_docs"] for r in token_alignment.pair_counts(docs).collect()} == dict(expected)


def test_alignment_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert token_alignment.align_documents(docs).count() == 0
    assert token_alignment.pair_counts(docs).count() == 0


def test_the_memo_may_start_anew_between_runs():
    paths = token_alignment.Tokenizers()
    memo = token_alignment.PieceEncoder(open(paths.a, "rb").read(), open(paths.b, "rb").read(), most=3)
    odd = "  lead  \n and trail  \t \u3000 wide\u3000 gap\u00a0 nbsp  "
    for text in ("one two three four", "five six", "one two", "x▁y one", odd, odd + " ".join(f"w{i}" for i in range(200)) + odd):
        columns, same = token_alignment.encode_texts(pa.array([text]), memo)
        plain = plain_alignment([text])[0]
        assert [np.frombuffer(c[0].as_py(), np.uint16).tolist() for c in columns] == [plain["a"], plain["b"]] and same[0] == bool(plain["a"])


@pytest.mark.parametrize("count", [0, 1, 2, 63, 5000])
def test_perfect_hash_numbers_every_key_once_and_refuses_others(count):
    draw = np.random.default_rng(count)
    keys = np.unique(draw.integers(0, 1 << 62, count).astype(np.uint64))
    buckets = max(1, len(keys) // 100)
    of = perfect_hash.bucket_of(keys, buckets)
    index = perfect_hash.PerfectHash.joined(buckets, 0, [perfect_hash.build_bucket(keys[of == b]) for b in range(buckets)])
    numbers = index.find(keys)
    assert sorted(numbers.tolist()) == list(range(len(keys)))
    assert (index.keys[numbers] == keys).all()
    others = np.setdiff1d(draw.integers(0, 1 << 62, 5000).astype(np.uint64), keys)
    assert (index.find(others) == -1).all()
    assert index.words.size * 64 <= 5 * len(keys) + 128 * buckets * 8
    half = perfect_hash.PerfectHash.joined(buckets, buckets // 2, [perfect_hash.build_bucket(keys[of == b]) for b in range(buckets // 2, buckets)])
    assert ((half.find(keys) >= 0) == (of >= buckets // 2)).all()


# ---- 12: repeated passages


def plain_repeats(texts: list[str | None], window: int) -> list[list[bool]]:
    words = [SPACES.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    marks = []
    for w in words:
        hit = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                hit[i : i + window] = [True] * window
        marks.append(hit)
    return marks


def made_texts(draw: random.Random, count: int) -> list[str | None]:
    """Texts of shared passages that are cut, spliced and changed, with few words so that anchors meet in many places."""
    passages = [[draw.choice("abcdefgh") for _ in range(draw.randint(3, 60))] for _ in range(6)]
    texts: list[str | None] = [None, "", "a b c", "x " * 80, "x\ty\nz " * 40]
    while len(texts) < count:
        words: list[str] = []
        for _ in range(draw.randint(1, 5)):
            piece = list(draw.choice(passages))
            begin = draw.randint(0, len(piece) // 2)
            piece = piece[begin : draw.randint(begin, len(piece))]
            if piece and draw.random() < 0.4:
                piece[draw.randrange(len(piece))] = draw.choice("XYZ")
            words += piece + [draw.choice("0123456789") for _ in range(draw.randint(0, 4))]
        texts.append(draw.choice([" ", "\n", " \t "]).join(words))
    return texts


@pytest.mark.parametrize("seed,settings", [(1, substring_dedup.RepeatSettings(8, 3)), (2, substring_dedup.RepeatSettings(12, 5)), (3, substring_dedup.RepeatSettings(20, 8)), (4, substring_dedup.RepeatSettings(5, 1))])
def test_repeated_passages_equal_brute_force(spark, seed, settings):
    texts = made_texts(random.Random(seed), 150)
    docs = spark.createDataFrame([(i if i % 9 else None, t, i, "clash") for i, t in enumerate(texts)], "doc_id bigint, text string, _doc int, passages string").repartition(7)
    found = {r["_doc"]: r for r in substring_dedup.remove_repeats(docs, settings).collect()}
    assert len(found) == len(texts)
    for i, hit in enumerate(plain_repeats(texts, settings.window)):
        words = SPACES.findall(texts[i] or "")
        row = found[i]
        assert (row["n_words"], row["n_removed"]) == (len(words), sum(hit)), texts[i]
        assert row["kept_text"] == " ".join(w for w, h in zip(words, hit) if not h)
        covered = {p for s in row["passages"] for p in range(s["first_word"], s["last_word"] + 1)}
        assert covered == {p for p, h in enumerate(hit) if h}


def test_a_hot_passage_and_repeated_rows(spark):
    line = " ".join(f"w{i}" for i in range(40))
    rows = [(i, f"start {i} {line} end {i * 7}") for i in range(300)] + [(5, "only " * 40)] + [(900, f"u{i}") for i in range(2)] + [(901, " ".join(f"v{i}" for i in range(50)))] * 3
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = substring_dedup.remove_repeats(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        if r["doc_id"] < 300 and r["text"].startswith("start"):
            assert r["n_removed"] == 41 and r["kept_text"] == f"start {r['doc_id']} {r['doc_id'] * 7}"
        if r["doc_id"] == 901:
            assert r["kept_text"] == ""


def test_repeats_of_an_empty_table(spark):
    assert substring_dedup.remove_repeats(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


# ---- 13: periodic runs


def plain_runs(words: list, shortest: int = 12) -> list[tuple[int, int, int]]:
    best: dict[tuple[int, int], int] = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(shortest, 2 * q):
                best.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((start, length, q) for (start, length), q in best.items())


def made_words(draw: random.Random) -> list[int]:
    size, kind, symbols = draw.randint(0, 80), draw.random(), draw.randint(1, 5)
    if kind < 0.3:
        return [draw.randint(0, symbols) for _ in range(size)]
    if kind < 0.4:
        a, b = [0], [0, 1]
        while len(b) < size:
            a, b = b, b + a
        return b[:size]
    words: list[int] = []
    while len(words) < size:
        words += [draw.randint(0, symbols) for _ in range(draw.randint(1, 9))] * draw.randint(1, 6)
        del words[len(words) - draw.randint(0, 2) :]
    return words


def test_runs_equal_brute_force():
    draw = random.Random(5)
    for _ in range(1500):
        texts = [made_words(draw) for _ in range(draw.randint(1, 4))]
        shortest = draw.choice([2, 4, 12])
        first = np.cumsum([0, *map(len, texts)])
        found = run_detection.find_runs(np.array([w for t in texts for w in t], np.uint64), first, shortest)
        expected = [(s + int(first[i]), n, q) for i, t in enumerate(texts) for s, n, q in plain_runs(t, shortest)]
        assert list(zip(*(x.tolist() for x in found))) == expected, texts


def test_many_periods_around_one_centre():
    """Squares of every odd period: the proposed periods of two progressions are themselves a progression."""
    words = [0, 1] * 20 + [0] + [0, 1] * 20
    found = run_detection.find_runs(np.array(words, np.uint64), np.array([0, len(words)]))
    assert list(zip(*(x.tolist() for x in found))) == plain_runs(words)
    assert len(found[0]) > 10


def expected_runs(rows: list[tuple[int | None, str | None]]) -> list[tuple]:
    out = []
    for doc, text in rows:
        words, h = SPACES.findall(text or ""), zlib.crc32(str(doc).encode())
        if doc is not None and h % 10 == 0 and words:
            g = h // 10
            a = g % len(words)
            p = 1 + (len(words) - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, len(words))]
        runs = plain_runs(words)
        keep = [not any(s + q <= i < s + n for s, n, q in runs) for i in range(len(words))]
        top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        values = (top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else (None,) * 4
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        out.append((doc, len(runs), *values, digest(listed), digest(" ".join(w for w, k in zip(words, keep) if k))))
    return sorted(out, key=str)


RUNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_runs_of_documents_with_planted_periods(spark):
    rows = [(d, t) for d, t in documents(spark) if t is None or len(t) < 20_000]
    found = QUERIES["op13_periodic_runs"](spark, SF).select(*RUNS).where(F.col("doc_id").isin([d for d, _ in rows])).collect()
    assert sorted((tuple(r) for r in found), key=str) == expected_runs(rows)
    assert sum(r["n_runs"] > 0 for r in found) >= len(rows) // 20


def test_runs_of_odd_documents(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a " * 11), (5, "a " * 12), (5, "a " * 12), (None, "x y z " * 9), (7, "é é " * 30), (8, "A a " * 8)]
    docs = spark.createDataFrame([(d, t, "old") for d, t in rows], "doc_id bigint, text string, runs string")
    found = run_detection.with_runs(docs)
    assert found.columns == ["doc_id", "text", "n_words", "runs", "collapsed"]
    plain = [r for d, t in rows for r in [(d, [tuple(x) for x in plain_runs(SPACES.findall(t or ""))])]]
    assert sorted(((r["doc_id"], [tuple(x) for x in r["runs"]]) for r in found.collect()), key=str) == sorted(plain, key=str)
    assert run_detection.run_digest(found).where("n_runs = 0 AND start IS NULL AND runs_sha256 IS NOT NULL").count() == 4
    assert run_detection.with_runs(docs.limit(0)).count() == 0
