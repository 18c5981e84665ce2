"""Periodic runs of words in documents, found with a dictionary of basic factors.

1. Every stretch of ``2**k`` words gets a name, equal for equal stretches of a document; a name of level ``k + 1`` is a pair of names of level
   ``k``. Stretches that occur once in their document are not named, and a level without names is the last one.
2. Occurrences of one name whose gaps are at most half its length ``m`` lie in an arithmetic progression with the stretch's own period as step.
   A run of smallest period ``q`` with ``m <= q < 2m`` holds two occurrences ``q`` words apart, and they lie in
   different progressions. The gaps between an occurrence's progression and those that follow within ``2m`` words
   are again arithmetic progressions: they are the proposed periods, linear in number per level.
3. A proposal is extended both ways by names of falling length. Proposals of one stretch are the same run; the smallest period stays.

Names are exact but for level 0, which names 64-bit hashes of words. A document is worked on in one piece (a run may be as long
as it is), with four bytes per word and level; texts of a batch go together in runs of a bounded size.

Defined results: NULL, empty and blank texts have no words and no runs, and collapse to an empty text; repeated rows stay rows; an empty table
gives no rows. Columns of the input are kept; ``n_words``, ``runs`` and ``collapsed`` are replaced if they exist.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tinta.llm.byte_words import EXACT_VALUES, NOT_SPACE, _mix, find_words, runs_of_rows, span_hashes, text_bytes

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
SHORTEST = 12


def _named(key: np.ndarray, at: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names (0: occurs once) of all places, and name and place of the named ones, ordered by both."""
    order = np.argsort(key, kind="stable")
    key, at = key[order], at[order]
    new = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)
    which = np.cumsum(new) - 1
    often = np.bincount(which)[which] > 1 if len(key) else new
    name, place = which[often] + 1, at[often]
    names = np.zeros(total, np.int32)
    names[place] = name
    return names, name, place


def _progressions(name: np.ndarray, place: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``name, first, last, step`` of the maximal progressions with gaps of at most ``m / 2``; a single place has step 0."""
    joined = np.concatenate(([False], (name[1:] == name[:-1]) & (2 * (place[1:] - place[:-1]) <= m)))
    begin = np.flatnonzero(~joined)
    end = np.append(begin[1:], len(place)) - 1
    step = np.where(end > begin, place[np.minimum(begin + 1, len(place) - 1)] - place[begin], 0)
    return name[begin], place[begin], place[end], step


def _proposed(name: np.ndarray, place: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """``place, period``: pairs of occurrences at least ``m`` and less than ``2m`` words apart, one per gap of two progressions."""
    of, first, last, step = _progressions(name, place, m)
    places, periods = [], []
    for ahead in range(1, 4):  # progressions are more than m / 2 apart, so the fourth is out of reach
        a = np.arange(max(len(of) - ahead, 0))
        a = a[(of[a] == of[a + ahead]) & (first[a + ahead] - last[a] < 2 * m)]
        b = a + ahead
        low, high = first[b] - last[a], last[b] - first[a]
        by = np.maximum(np.maximum(step[a], step[b]), 1)
        skip = np.maximum(0, -(-(m - low) // by))
        low, high = low + skip * by, np.minimum(high, 2 * m - 1)
        each = np.maximum(0, (high - low) // by + 1)
        which = np.repeat(np.arange(len(a)), each)
        period = low[which] + (np.arange(len(which)) - np.repeat(np.cumsum(each) - each, each)) * by[which]
        places.append(np.maximum(first[a][which], first[b][which] - period))
        periods.append(period)
    place, period = np.concatenate(places), np.concatenate(periods)
    order = np.lexsort((place, period))
    place, period = place[order], period[order]
    # the stretches of neighbouring pairs with one gap touch: they extend to the same run
    fresh = np.ones(len(place), bool)
    fresh[1:] = (period[1:] != period[:-1]) | (place[1:] - place[:-1] > m)
    return place[fresh], period[fresh]


def find_runs(symbols: np.ndarray, first: np.ndarray, shortest: int = SHORTEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start, length, period`` of all runs, by start and period. ``first[i]:first[i + 1]`` are the words of text ``i``; equal words have equal symbols.

    A run has at least ``shortest`` words and twice its smallest period, and no word next to it goes on with that period.
    """
    total = len(symbols)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    room = first[1:][text] - np.arange(total)
    key = _mix(symbols + _mix(text.astype(np.uint64)))
    at, m = np.arange(total), 1
    levels: list[np.ndarray] = []
    found: list[tuple[np.ndarray, np.ndarray]] = []
    while len(at):
        names, name, place = _named(key, at, total)
        if not len(place):
            break
        levels.append(names)
        found.append(_proposed(name, place, m))
        at = np.sort(place[room[place] >= 2 * m])
        at = at[names[at + m] > 0]
        key = (names[at].astype(np.uint64) << np.uint64(32)) | names[at + m].astype(np.uint64)
        m *= 2
    none = np.zeros(0, np.int64)
    place, period = (np.concatenate(x) for x in zip(*found)) if found else (none, none)
    low, high = place.copy(), place.copy()
    for k in range(len(levels) - 1, -1, -1):
        names, m = levels[k], 1 << k
        other = np.minimum(high + period, total - 1)
        high = high + m * ((high + period < total) & (names[np.minimum(high, total - 1)] > 0) & (names[np.minimum(high, total - 1)] == names[other]))
        back = np.maximum(low - m, 0)
        low = low - m * ((low >= m) & (names[back] > 0) & (names[back] == names[back + period]))
    start, length = low, high - low + period
    held = (length >= shortest) & (length >= 2 * period)
    start, length, period = start[held], length[held], period[held]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    # a stretch that was also proposed with a multiple of its period
    smallest = np.ones(len(start), bool)
    smallest[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[smallest], length[smallest], period[smallest]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def kept_words(total: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether a word lies in no run behind that run's first period."""
    cover = np.zeros(total + 1, np.int64)
    np.add.at(cover, start + period, 1)
    np.add.at(cover, start + length, -1)
    return np.cumsum(cover[:-1]) == 0


def _detected(batch: pa.RecordBatch, shortest: int) -> list[pa.Array]:
    """``n_words, runs, collapsed`` of the texts of a batch."""
    words = find_words(batch.column("text"), NOT_SPACE)
    start, length, period = find_runs(span_hashes(words.data, words.starts, words.ends, EXACT_VALUES), words.first, shortest)
    keep = kept_words(len(words.starts), start, length, period)
    text = np.searchsorted(words.first, start, "right") - 1
    begin = np.searchsorted(text, np.arange(batch.num_rows + 1))
    columns = [pa.array(x, pa.int64()) for x in (start - words.first[text], length, period)]
    runs = pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.StructArray.from_arrays(columns, ["start", "length", "period"]))
    data, offsets = text_bytes(batch.column("text"))
    collapsed = []
    for i in range(batch.num_rows):
        each = data[offsets[i] : offsets[i + 1]].tobytes().split()  # splits at the bytes that are outside NOT_SPACE
        if begin[i + 1] > begin[i]:
            each = compress(each, keep[words.first[i] : words.first[i + 1]].tolist())
        collapsed.append(b" ".join(each).decode())
    return [pa.array(words.counts, pa.int64()), runs, pa.array(collapsed, pa.string())]


def with_runs(docs: DataFrame, shortest: int = SHORTEST, prepare: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None) -> DataFrame:
    """``docs`` (with ``text``) plus ``n_words``, ``runs`` (by start, then period) and ``collapsed``, the words left joined by a space.

    ``prepare`` may replace texts of a batch before they are searched.
    """
    docs = docs.drop("n_words", "runs", "collapsed")

    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first, last in runs_of_rows(whole.column("text"), 2 << 20):
                batch = whole.slice(first, last - first)
                batch = prepare(batch) if prepare else batch
                yield pa.RecordBatch.from_arrays([*batch.columns, *_detected(batch, shortest)], names=[*batch.schema.names, "n_words", "runs", "collapsed"])

    added = T.StructType().add("n_words", T.LongType()).add("runs", T.ArrayType(RUN)).add("collapsed", T.StringType())
    return docs.mapInArrow(detect, T.StructType([*docs.schema.fields, *added.fields]))


def longest_run() -> Column:
    """The run of greatest length; of these the one with the smallest start, then period. NULL without runs."""
    first = F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period")))
    return F.array_min(first)


def run_digest(found: DataFrame) -> DataFrame:
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(line, "\n"), F.lit("\n"))).otherwise("")
    top = found.withColumn("_top", longest_run())
    return top.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("_top.start").alias("start"),
        (-F.col("_top.l")).alias("length"),
        F.col("_top.period").alias("period"),
        F.floor(-F.col("_top.l") * 1000 / F.col("_top.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
