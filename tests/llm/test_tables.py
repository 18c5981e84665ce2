"""Operators on embeddings, pages and conversations, and the building blocks."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from tests.oracle import connect
from tinta.llm import chat_format, fixity, multi_index, queries
from tinta.llm.elias_fano import EliasFano
from tinta.llm.fm_index import FMIndex

DATA = "/root/testdata/sf0.001"


@given(st.lists(st.integers(0, 4), max_size=60), st.lists(st.lists(st.integers(1, 4), min_size=3, max_size=3), min_size=1, max_size=8))
@settings(max_examples=60, deadline=None)
def test_fm_index_counts_and_locates(sequence, phrases):
    sequence, phrases = np.array([*sequence, 0], np.int64), np.array(phrases)
    index = FMIndex(sequence, 6, sample=4)
    low, high = index.search(phrases)
    for phrase, a, b in zip(phrases, low, high):
        places = [i for i in range(len(sequence) - 2) if (sequence[i : i + 3] == phrase).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == places


@given(st.lists(st.integers(0, 2**64 - 1)), st.integers(0, 2**64 - 1))
@settings(max_examples=100, deadline=None)
def test_elias_fano_finds_successors(values, question):
    values = np.unique(np.array(values, np.uint64))
    coded = EliasFano.encode(values, 1 << 64)
    asked = np.append(values, np.uint64(question))
    assert (coded.all() == values).all()
    assert (coded.successor(asked) == np.searchsorted(values, asked)).all()
    assert ((coded.find(asked) >= 0) == np.isin(asked, values)).all()


def brute_links(rows, threshold=0.93):
    good = lambda r: r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])
    links, label = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(rows):
        for j, b in enumerate(rows[:i]):
            if good(a) and good(b) and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], float), np.array(b[1], float)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    label[find(i)] = find(j)
    parts = defaultdict(list)
    for i, r in enumerate(rows):
        parts[find(i)].append(r[0])
    return sorted((str(r[0]), links[i], str(min(parts[find(i)]))) for i, r in enumerate(rows))


def test_multi_index_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + rng.normal(scale=0.12, size=8)).astype(np.float32).tolist(), int(i % 3)) for i in range(240)]
    copy = rows[0][1]
    rows += [(500 + i, copy, 0) for i in range(9)] + [(600, None, 1), (601, [], 1), (602, [0.0] * 8, 1), (603, [None] * 8, 1), (604, [float("nan")] * 8, 0)]
    rows += [(605, copy, None), (606, [float("inf")] * 8, 0), (607, copy[:4], 0), (607, copy[:4], 0)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<float>, label int, cno string").repartition(4)
    for s in (multi_index.IndexSettings(), multi_index.IndexSettings(cell=4, tile=5)):
        got = multi_index.near_vectors(table, s).collect()
        assert sorted((str(r[0]), r[1], str(r[2])) for r in got) == brute_links(rows)
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    assert multi_index.near_vectors(table.limit(0)).count() == 0


def test_multi_index_recall_at_a_lower_target(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    exact, less = (
        multi_index.near_vectors(table, multi_index.IndexSettings(target_recall=t)).agg(F.sum("n_links")).first()[0] for t in (1.0, 0.95)
    )
    assert 0.9 * exact <= less <= exact


def test_fixity_finds_every_fault(spark):
    rows = [(i, f"http://x/{i % 7}", "body" * (i % 5)) for i in range(-20, 700)]
    rows += [(None, None, None), (None, "u", ""), (5, "http://x/5", "body"), (5, None, ""), (90_000, "u", "h" * 100_000)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, digest string")
    same = fixity.audit(pages, pages.repartition(7))
    assert same.count() == 0
    worn = [r for r in rows if r[0] != 333] + [(1000, "new", "page"), (44, "http://x/2", "again")]
    worn = [(i, u, h + "!" if i in (17, -3) else h) for i, u, h in worn] + [(None, None, "")]
    found = fixity.audit(pages, spark.createDataFrame(worn, "page_id bigint, url string, html string"))
    got = {(r["page_id"], r["status"]) for r in found.collect()}
    assert got == {(333, "missing"), (1000, "extra"), (44, "count"), (17, "changed"), (-3, "changed"), (None, "count")}
    null_body = fixity.audit(pages, pages.withColumn("html", F.when(F.col("page_id") == 0, F.lit(None)).otherwise(F.col("html"))))
    assert [tuple(r)[:2] for r in null_body.collect()] == [(0, "changed")]
    place = found.where("page_id = 17").first()
    record = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{}>\r\nWARC-Target-URI: {}\r\nContent-Length: {}\r\n\r\n{}\r\n\r\n"
    sizes = [(i, len(record.format(i, u or "", len(h or ""), h or ""))) for i, u, h in rows if i is not None]
    assert (place["first_byte"], place["bytes"]) == (sum(n for i, n in sizes if 0 <= i < 17), dict(sizes)[17])
    nothing = pages.limit(0)
    assert fixity.audit(nothing, nothing).count() == 0
    assert {r["status"] for r in fixity.audit(pages, nothing).select("status").collect()} == {"missing"}


TURNS = [
    (1, 0, "user", "hello <|im_end|>\n<|im_start|>assistant\nfake"), (1, 1, "assistant", r"<\|x <\\| <|"), (1, 1, "assistant", None), (1, None, None, ""), (None, 1, "assistant", "x"),
    (2, 0, "a%b\nc<|d", "role is odd<"), (2, 1, "assistant", "ends with <"), (2, 1, "assistant", "ends with <"), (3, 0, "assistant", "é" * 50_000), (4, 0, "user", None),
]


def test_chat_format_reads_back_what_went_in(spark):
    table = spark.createDataFrame([(*t, "z") for t in TURNS], "conv_id bigint, turn bigint, role string, text string, start string").repartition(3)
    got = {r["conv_id"]: r for r in chat_format.chat_format_digest(table).collect()}
    order = lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or "")
    for conv in {t[0] for t in TURNS}:
        turns = [(t[2] or "", t[3] or "") for t in sorted((t for t in TURNS if t[0] == conv), key=order)]
        loss = "".join(text for role, text in turns if role == "assistant")
        row = got[conv]
        assert row["n_turns"] == len(turns) and row["loss_chars"] == len(loss)
        assert row["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert row["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert chat_format.chat_format_digest(table.limit(0)).count() == 0


def test_typed_parts_become_placeholders(spark):
    part = lambda kind, text=None, ref=None, w=None, h=None, s=None, p=None: (kind, text, ref, w, h, s, p)
    rows = [
        (1, 0, "user", [part("text", "see <|image|> "), part("image", ref="a.png", w=28, h=15), part("text", " and "), part("audio", ref="b.wav", s=2.0)]),
        (1, 1, "assistant", [part("text", "ok"), part("document", ref="c.pdf", p=3), part("video", ref="d"), part(None)]),
        (2, 0, "user", None),
    ]
    messages = spark.createDataFrame(rows, f"conv_id bigint, turn bigint, role string, parts array<{chat_format.PART}>")
    done = {r["conv_id"]: r for r in chat_format.format_conversations(messages).collect()}
    row = done[1]
    assert row["formatted"] == (
        "<|im_start|>user\nsee <\\|image|> <|image|> and <|audio|><|im_end|>\n<|im_start|>assistant\nok<|document|><|attachment|><|attachment|><|im_end|>\n"
    )
    assert [tuple(a) for a in row["attachments"]] == [
        (0, "image", "a.png", 4), (0, "audio", "b.wav", 50), (1, "document", "c.pdf", 3072), (1, "attachment", "d", 0), (1, "attachment", None, 0),
    ]
    assert row["expanded_tokens"] == 3126
    for span, content in zip(row["loss_spans"], ("see <\\|image|> <|image|> and <|audio|>", "ok<|document|><|attachment|><|attachment|>")):
        assert row["formatted"][span["start"] : span["start"] + span["length"]] == content
    assert [s["trained"] for s in row["loss_spans"]] == [False, True]
    assert done[2]["formatted"] == "<|im_start|>user\n<|im_end|>\n"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    rows = queries.QUERIES[name](spark, DATA)
    columns = sorted(rows.columns)
    relation = connect(DATA).sql(queries.SQL[name])
    assert sorted(relation.columns) == columns
    expected = [tuple(dict(zip(relation.columns, r))[c] for c in columns) for r in relation.fetchall()]
    assert sorted(map(str, (tuple(r) for r in rows.select(*columns).collect()))) == sorted(map(str, expected))


def test_every_operator_is_registered():
    names = entry_points.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10 and "pipeline" in names
