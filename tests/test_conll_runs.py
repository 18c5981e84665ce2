"""Lines of CoNLL files are put together where they are read: only sentences are stored, and runs of lines are joined by a row for each."""

from __future__ import annotations

import numpy as np
import pytest

from tinta.sources import conll


@pytest.mark.parametrize("seed, blanks, most", [(1, 0.2, 400), (2, 0.01, 300), (3, 0.0, 500), (4, 0.7, 250), (5, 0.05, 1 << 20)])
def test_sentences_over_many_runs(spark, tmp_path, monkeypatch, seed, blanks, most):
    rng = np.random.default_rng(seed)
    kept = []
    real = conll.stored
    monkeypatch.setattr(conll, "stored", lambda df, name: kept.append(real(df, name)) or kept[-1])
    monkeypatch.setattr(conll, "MAX_BROADCAST_RUNS", 0 if seed % 2 else 100)
    expected = {}
    for name, n in (("one.txt", 900), ("two.txt", 37), ("none.txt", 0)):
        lines = ["" if x < blanks else " \t" if x < blanks * 1.2 else "# skip" if x < blanks + 0.25 else f"  w{i} X" for i, x in enumerate(rng.random(n))]
        (tmp_path / name).write_text("\n".join(lines), encoding="utf-8")
        sentences = [[]]
        for line in lines:
            if not line.strip():
                sentences.append([])
            elif not line.startswith("#"):
                sentences[-1].append(line.split()[0])
        expected[name] = [s for s in sentences if s]
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.execution.arrow.maxRecordsPerBatch")
    previous = [spark.conf.get(n) for n in names]
    for n, value in zip(names, (str(most), "7")):
        spark.conf.set(n, value)
    try:
        found = conll.read_conll(spark, str(tmp_path)).collect()
    finally:
        for n, value in zip(names, previous):
            spark.conf.set(n, value)
    for name, sentences in expected.items():
        got = sorted((r.pos, r.tokens, r.sentence_id, r.text) for r in found if r.source_file == name)
        assert got == [(i, s, f"{name}:{i}", " ".join(s)) for i, s in enumerate(sentences)]
    (rows,) = kept
    runs = rows.where("tokens IS NULL").count()
    # no row per line is kept: a run adds at most one part of a sentence
    assert rows.where("tokens IS NOT NULL").count() <= sum(map(len, expected.values())) + runs
