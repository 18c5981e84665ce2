"""CoNLL-style text: one token per line, blank lines between sentences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tinta.functions.rows import posexplode_rows
from tinta.functions.text import WS, strip
from tinta.session import cut_lineage, stored
from tinta.sources.files import SPLIT_ALIASES, TABLE_SUFFIXES, list_files, split_files

BLOCK_LINES = 65_536
# Rows of a run of lines each that may be broadcast.
MAX_BROADCAST_RUNS = 100_000


def sentence_blocks(text: Column) -> Column:
    """Token arrays of the sentences in a text; ``#`` lines are skipped and end no sentence."""
    unix = F.regexp_replace(text, r"\r\n?", "\n")
    blocks = F.split(unix, f"\n(?:[{WS}]*\n)+")

    def tokens(block: Column) -> Column:
        lines = F.filter(
            F.transform(F.split(block, "\n"), strip),
            lambda line: (line != "") & ~line.startswith("#"),
        )
        return F.transform(lines, lambda line: F.regexp_extract(line, f"^[^{WS}]+", 0))

    return F.filter(F.transform(blocks, tokens), lambda block: F.size(block) > 0)


def parse_conll(texts: DataFrame, text: str = "value") -> DataFrame:
    """Explode whole texts into sentences ``pos, tokens, text``; the other columns stay."""
    kept = [c for c in texts.columns if c != text]
    return posexplode_rows(texts, sentence_blocks(F.col(text)), "pos", "tokens", *kept).select(
        *kept,
        F.col("pos").cast("bigint").alias("pos"),
        "tokens",
        F.array_join("tokens", " ").alias("text"),
    )


def read_conll(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Sentences of one or more CoNLL files, read by lines: a large file is split over tasks.

    ``pos`` numbers the sentences of a file. A task puts the sentences of its run of lines together, and only these are stored. What joins the runs
    is a row for each of them: how many blank lines and sentences it holds. A sentence that goes on in the next run is put together by its number.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("source_file"), strip(F.col("value")).alias("_text"))
    token = F.when(~F.startswith("_text", F.lit("#")), F.regexp_extract("_text", f"^[^{WS}]*", 0)).alias("_token")
    found = lines.select("source_file", token).mapInArrow(_sentences_of_runs, "source_file string, _run bigint, _k bigint, _block bigint, tokens array<string>")
    found = stored(found, "conll")
    runs = cut_lineage(_run_starts(found))
    if runs.limit(MAX_BROADCAST_RUNS + 1).count() <= MAX_BROADCAST_RUNS:
        runs = F.broadcast(runs)
    parts = found.where("tokens IS NOT NULL").join(runs, ["source_file", "_run"]).withColumn("pos", F.col("_start") + F.col("_k"))
    edge = (F.col("_block") == 0) | (F.col("_block") == F.col("_blanks"))
    in_order = F.array_sort(F.collect_list(F.struct("_run", "tokens")))
    joined = parts.where(edge).groupBy("source_file", "pos").agg(F.flatten(F.transform(in_order, lambda x: x["tokens"])).alias("tokens"))
    numbered = parts.where(~edge).select("source_file", "pos", "tokens").unionByName(joined)
    return numbered.select(
        F.concat_ws(":", "source_file", "pos").alias("sentence_id"),
        "pos",
        "tokens",
        F.array_join("tokens", " ").alias("text"),
        "source_file",
        F.lit(None).cast("string").alias("source_column"),
    )


def _sentences_of_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``source_file, _run, _k, _block, tokens``: sentences of the lines of a task, file by file, and a row without tokens behind each run of lines.

    ``_run`` follows the order of reading, ``_k`` numbers the sentences of a run and ``_block`` counts the blank lines before one. The last row has the number
    of sentences and of blank lines. A token is empty for a blank line and NULL for one that is skipped.
    """
    first = TaskContext.get().partitionId() << 33
    file, run, k, blanks, lines, held, held_block = None, 0, 0, 0, 0, [], 0

    def rows(blocks: np.ndarray, lists: pa.ListArray) -> pa.RecordBatch:
        n = len(lists)
        columns = [pa.array([file] * n, pa.string()), pa.array(np.full(n, run)), pa.array(np.arange(k, k + n)), pa.array(blocks.astype(np.int64)), lists]
        return pa.RecordBatch.from_arrays(columns, names=["source_file", "_run", "_k", "_block", "tokens"])

    def last() -> Iterator[pa.RecordBatch]:
        nonlocal k, held
        if held:
            tokens = pa.concat_arrays(held)
            yield rows(np.array([held_block]), pa.ListArray.from_arrays(pa.array([0, len(tokens)], pa.int32()), tokens))
            k, held = k + 1, []
        if file is not None:
            yield rows(np.array([blanks]), pa.nulls(1, pa.list_(pa.string())))

    for batch in batches:
        names = pc.run_end_encode(batch.column("source_file"))
        begin = 0
        for name, end in zip(names.values.to_pylist(), names.run_ends.to_pylist()):
            if name != file:
                yield from last()
                file, run, k, blanks = name, first + lines + begin, 0, 0
            tokens = batch.column("_token").slice(begin, end - begin).cast(pa.string()).drop_null()
            begin = end
            blank = pc.equal(tokens, "").to_numpy(zero_copy_only=False)
            block = blanks + np.cumsum(blank)[~blank]
            blanks += int(blank.sum())
            tokens = tokens.filter(pa.array(~blank))
            if not len(tokens):
                continue
            cuts = np.r_[0, np.flatnonzero(block[1:] != block[:-1]) + 1, len(tokens)]
            if held and held_block != block[0]:
                whole = pa.concat_arrays(held)
                yield rows(np.array([held_block]), pa.ListArray.from_arrays(pa.array([0, len(whole)], pa.int32()), whole))
                k, held = k + 1, []
            held.append(tokens.slice(0, cuts[1]))
            held_block = block[0]
            if len(cuts) > 2:  # all but the last sentence end here
                whole = pa.concat_arrays([*held, tokens.slice(cuts[1], cuts[-2] - cuts[1])])
                ends = cuts[1:-1] - cuts[1] + sum(map(len, held))
                done = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), whole)
                yield rows(block[cuts[:-2]], done)
                k, held, held_block = k + len(done), [tokens.slice(cuts[-2])], block[cuts[-2]]
        lines += batch.num_rows
    yield from last()


def _run_starts(found: DataFrame) -> DataFrame:
    """``source_file, _run, _start, _blanks``: the number that sentence 0 of a run has in its file, and the blank lines of the run."""
    ends = found.where("tokens IS NULL").select("source_file", "_run", F.col("_k").alias("_n"), F.col("_block").alias("_blanks"))
    ends_in = found.where("tokens IS NOT NULL").groupBy("source_file", "_run").agg(F.min("_block").alias("_least"), F.max("_block").alias("_most"))
    runs = ends.join(ends_in, ["source_file", "_run"], "left")
    earlier = Window.partitionBy("source_file").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_blanks").over(earlier), F.lit(0)))
    runs = runs.withColumn("_goes_on", F.coalesce((F.max(F.col("_before") + F.col("_most")).over(earlier) == F.col("_before") + F.col("_least")).cast("bigint"), F.lit(0)))
    new = F.coalesce(F.sum(F.col("_n") - F.col("_goes_on")).over(earlier), F.lit(0))
    return runs.select("source_file", "_run", (new - F.col("_goes_on")).alias("_start"), "_blanks")


def read_split_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Corpus kept in one file per split, with a ``split`` column; all three splits are required."""
    from tinta.sources.tables import read_table, sentences_from_table

    chosen = {row["split"]: row for row in split_files(list_files(spark, folder)).collect()}
    missing = [split for split in SPLIT_ALIASES if split not in chosen]
    if missing:
        raise FileNotFoundError(f"no files for the splits {missing} in {folder}")
    parts = []
    for split in SPLIT_ALIASES:
        path, name = chosen[split]["path"], chosen[split]["name"]
        if name.lower().endswith(TABLE_SUFFIXES):
            part = sentences_from_table(read_table(spark, path))
        else:
            part = read_conll(spark, path)
        parts.append(part.withColumn("split", F.lit(split)))
    corpus = parts[0]
    for part in parts[1:]:
        corpus = corpus.unionByName(part)
    return corpus
