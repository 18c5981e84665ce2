"""Registered queries against their SQL on the smallest data; the costly ones run via tests.oracle."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from tests.oracle import DATA, compare, connect

FOLDER = f"{DATA}/sf0.001"
ROOT = Path(__file__).parent.parent
CHECKED = (
    "normalize_text clean_tokens clean_token_list corpus_stats stats_long raw_vs_clean split_files conll_parse "
    "token_rows_to_sentences grouped_tokens identifier_ratio split_70_15_15 first_n_per_split parse_token_list "
    "cell_tokens wordpiece_encode sentencepiece_encode token_metrics fragmentation_summary chunk_documents "
    "chunk_fixed encode_texts cosine_scores best_chunk attach_scores topk_per_query similar_words "
    "nearest_by_blocks skipgram_pairs stream_clean stream_token_counts stream_statistics sentences_jsonl report_csv "
    "chunk_recursive oov_neighbours encode_mean_vectors vectors_of_words"
).split()


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, connection, name):
    assert compare(spark, connection, name, FOLDER) == []


def test_entry_points(spark):
    assert entry_points.entry(spark).columns == ["token", "count", "rank"]
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_sql_needs_no_session_and_no_jar():
    code = (
        "import pathlib; pathlib.Path.glob = lambda *a: iter(()); import zipfile; zipfile.ZipFile = None;"
        "import __spark_entry__ as e; from pyspark.sql import SparkSession;"
        "assert len(e.oracle_sql()) >= 85; assert SparkSession.getActiveSession() is None"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
