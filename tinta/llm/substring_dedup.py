"""Repeated passages by seed and extend on winnowed anchors.

A window is ``window`` consecutive words of a document; it repeats if its words start anywhere else too, in the same document or another.

1. Winnowing: of the stretches of ``seed`` words in a window, the one with the smallest hash (the first of equal ones) is its anchor. Equal windows have equal anchors at
   equal places, so every repeated passage of at least ``window`` words is found through a shared anchor. About one word in fifteen is an anchor.
2. Seeds: documents are joined on their anchors. Anchors that stand once in the corpus go; they are most of them.
3. Extension both ways. An anchor's reach is the stretch of all windows that it was chosen for. Occurrences with one reach repeat from end to end, so
   a count per anchor and reach settles the inside of passages. What is left are the ends of passages, where the reaches of an
   anchor differ: there every extension (so many words to the left, the rest to the right) is looked up among the occurrences of the anchor. A
   reach that occurs several times sends one representative.
4. Windows that repeat are joined to maximal passages, which are cut out.

All of it is counting by key: occurrences of a hot anchor are combined in each task before they are shuffled, pairs of them are never listed, and the
joins give a hot key only rows that Spark may split. Words and stretches are compared by 64-bit hashes, extensions under their anchor by 128 bits.

Defined results: words are runs without white space, compared as they are; a NULL, empty or shorter text has no window and keeps its words; repeated
rows repeat each other; an empty table gives no rows. Columns of the input are kept; ``n_words``, ``n_removed``, ``passages`` and ``kept_text`` are replaced if they exist.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tinta.llm.byte_words import BASE, EXACT_VALUES, NOT_SPACE, Words, _inverse, _mix, find_words, powers, runs_of_rows, span_hashes, text_bytes
from tinta.session import scratch_path

FULL, EDGE, SHOWN = 0, 1, 2
PASSAGES = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("first_word", "last_word")]))
RUN_BYTES = 2 << 20


@dataclass(frozen=True)
class RepeatSettings:
    window: int = 35
    seed: int = 8


@dataclass
class Anchored:
    """Windows of a batch of texts, and the anchors that they chose; an anchor has the windows ``low .. high`` (numbers of their first words)."""

    words: Words
    text: np.ndarray
    low: np.ndarray
    high: np.ndarray
    anchor: np.ndarray
    reach: np.ndarray
    sums: np.ndarray

    def windows(self, which: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which anchor, first word and hash of all windows of some anchors."""
        each = self.high[which] - self.low[which] + 1
        of = np.repeat(which, each)
        first = self.low[of] + np.arange(len(of)) - np.repeat(np.cumsum(each) - each, each)
        return of, first, _stretch(self.sums, first, np.full(len(first), size))


def _sums(hashes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers(int(BASE), len(hashes)), out=out[1:])
    return out


def _stretch(sums: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of stretches of words."""
    back = powers(_inverse(int(BASE)), len(sums))[first]
    return _mix((sums[first + size] - sums[first]) * back + size.astype(np.uint64))


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest value (the first of equal ones) of every ``width`` neighbours."""
    at, size = np.arange(len(values)), 1

    def first_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(values[b] < values[a], b, a)

    while 2 * size <= width:
        at = first_of(at[:-size], at[size:])
        size *= 2
    rest = width - size
    return first_of(at[: len(at) - rest], at[rest:]) if rest else at


def anchored(column: pa.Array, s: RepeatSettings) -> Anchored:
    words = find_words(column, NOT_SPACE)
    total, text = len(words.starts), words.texts()
    none = np.zeros(0, np.int64)
    sums = _sums(span_hashes(words.data, words.starts, words.ends, EXACT_VALUES))
    if total < s.window:
        return Anchored(words, text, none, none, none.astype(np.uint64), none.astype(np.uint64), sums)
    places = np.arange(total - s.seed + 1)
    seeds = _stretch(sums, places, np.full(len(places), s.seed))
    chosen = _smallest(seeds, s.window - s.seed + 1)
    window = np.flatnonzero(text[: len(chosen)] == text[s.window - 1 :])
    at = chosen[window]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (at[1:] != at[:-1]) | (text[window[1:]] != text[window[:-1]])
    begin = np.flatnonzero(fresh)
    low, high, at = window[begin], window[np.append(begin[1:], len(window)) - 1] if len(window) else none, at[begin]
    reach = _stretch(sums, low, high - low + s.window)
    reach = _mix(reach ^ _mix(((at - low) * (s.window + 1) + high - at + s.window).astype(np.uint64)))
    return Anchored(words, text, low, high, seeds[at], reach, sums)


def row_key() -> Column:
    """A digest of a row's id and text. Rows that share one are asked for the same anchors, which changes nothing."""
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce(F.col("text"), F.lit("")))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _runs(batches: Iterator[pa.RecordBatch], within: str | None = None) -> Iterator[pa.RecordBatch]:
    """Runs of rows with a bounded size of text; ``within`` names a struct that holds the text."""
    for whole in batches:
        text = _plain(whole.column(within)).field("text") if within else whole.column("text")
        for first, last in runs_of_rows(text, RUN_BYTES):
            yield whole.slice(first, last - first)


def repeated_anchors(docs: DataFrame, s: RepeatSettings) -> DataFrame:
    """``anchor`` of every anchor that stands more than once in the corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches):
            anchors, n = np.unique(anchored(run.column("text"), s).anchor, return_counts=True)
            yield pa.RecordBatch.from_arrays([_signed(anchors), pa.array(n, pa.int64())], names=["anchor", "n"])

    return docs.select("text").mapInArrow(count, "anchor bigint, n bigint").groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor")


def occurrences(keyed: DataFrame, s: RepeatSettings) -> DataFrame:
    """``anchor, reach, doc, n`` of the anchors of all documents."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches):
            a, doc = anchored(run.column("text"), s), run.column("_doc").to_numpy()
            of = a.text[a.low]
            order = np.lexsort((a.reach, of))
            of, anchor, reach = of[order], a.anchor[order], a.reach[order]
            fresh = np.ones(len(of), bool)
            fresh[1:] = (of[1:] != of[:-1]) | (reach[1:] != reach[:-1])
            begin = np.flatnonzero(fresh)
            n = np.diff(np.append(begin, len(of)))
            yield pa.RecordBatch.from_arrays(
                [_signed(anchor[begin]), _signed(reach[begin]), pa.array(doc[of[begin]]), pa.array(n, pa.int64())], names=["anchor", "reach", "doc", "n"]
            )

    return keyed.select("_doc", "text").mapInArrow(find, "anchor bigint, reach bigint, doc bigint, n bigint")


def settled_reaches(keyed: DataFrame, s: RepeatSettings) -> DataFrame:
    """Stored ``doc, reaches``: what each document has to know of its repeated anchors.

    Kinds of a reach: ``FULL`` repeats from end to end, ``EDGE`` has to be extended word by word, ``SHOWN`` stands for a full one beside edges.
    """
    spark = keyed.sparkSession
    path = scratch_path(spark, "seeds")
    occurrences(keyed, s).join(repeated_anchors(keyed, s), "anchor", "left_semi").write.parquet(path)
    seeds = spark.read.parquet(path)
    path = scratch_path(spark, "reaches")
    seeds.groupBy("anchor", "reach").agg(F.sum("n").alias("n"), F.min("doc").alias("shown")).write.parquet(path)
    reaches = spark.read.parquet(path)
    mixed = reaches.where("n = 1").select("anchor").distinct()
    shown = reaches.where("n > 1").join(mixed, "anchor", "left_semi").select(F.col("shown").alias("doc"), "reach", F.lit(SHOWN).alias("kind"))
    kind = F.when(F.col("total") > 1, FULL).otherwise(EDGE).alias("kind")
    own = seeds.join(reaches.select("anchor", "reach", F.col("n").alias("total")), ["anchor", "reach"]).select("doc", "reach", kind)
    path = scratch_path(spark, "kinds")
    own.unionByName(shown).groupBy("doc").agg(F.collect_set(F.struct("reach", "kind")).alias("reaches")).write.parquet(path)
    return spark.read.parquet(path)


def _marked(a: Anchored, reaches: pa.Array, kind: int) -> np.ndarray:
    """Whether each anchor's reach is listed with its text as of this kind."""
    flat = reaches.flatten()
    values = flat.field("reach").to_numpy().view(np.uint64)
    text = np.repeat(np.arange(len(reaches)), _lengths(reaches))
    wanted = flat.field("kind").to_numpy() == kind
    return _listed(a.text[a.low], a.reach, text[wanted], values[wanted])


def _listed(text: np.ndarray, value: np.ndarray, in_text: np.ndarray, in_value: np.ndarray) -> np.ndarray:
    """Whether the pair of text and value is one of the listed pairs; values are compared in full inside each text."""
    every = np.concatenate((in_value, value))
    texts = np.concatenate((in_text, text))
    order = np.lexsort((np.arange(len(every)) >= len(in_value), every, texts))
    every, texts, asked = every[order], texts[order], order >= len(in_value)
    group = np.cumsum(np.concatenate(([True], (every[1:] != every[:-1]) | (texts[1:] != texts[:-1])))) - 1 if len(every) else np.zeros(0, np.int64)
    has = np.zeros(len(every), bool)
    has[group[~asked]] = True
    out = np.zeros(len(value), bool)
    out[order[asked] - len(in_value)] = has[group[asked]]
    return out


def repeated_extensions(keyed: DataFrame, reaches: DataFrame, s: RepeatSettings) -> DataFrame:
    """``doc, windows``: hashes of the windows at the ends of passages that repeat."""
    open_ = reaches.where(F.exists("reaches", lambda r: r["kind"] != FULL))

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches):
            a, doc, lists = anchored(run.column("text"), s), run.column("_doc").to_numpy(), _plain(run.column("reaches"))
            edge, shown = _marked(a, lists, EDGE), _marked(a, lists, SHOWN)
            of, _, hashes = a.windows(np.flatnonzero(edge | shown), s.window)
            yield pa.RecordBatch.from_arrays(
                [_signed(a.anchor[of]), _signed(hashes), pa.array(doc[a.text[a.low[of]]], mask=~edge[of]), pa.array(np.where(edge[of], 1, 2))],
                names=["anchor", "window", "doc", "n"],
            )

    spark = keyed.sparkSession
    path = scratch_path(spark, "extensions")
    asked = keyed.select("_doc", "text").join(open_, F.col("_doc") == F.col("doc")).drop("doc")
    asked.mapInArrow(extend, "anchor bigint, window bigint, doc bigint, n bigint").write.parquet(path)
    every = spark.read.parquet(path)
    often = every.groupBy("anchor", "window").agg(F.sum("n").alias("n")).where("n > 1").select("anchor", "window")
    hits = every.where("doc IS NOT NULL").join(often, ["anchor", "window"], "left_semi")
    return hits.groupBy("doc").agg(F.collect_set("window").alias("windows"))


def _plain(column: pa.Array) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def repeated_words(a: Anchored, full: np.ndarray, hits: np.ndarray, edge: np.ndarray, s: RepeatSettings) -> np.ndarray:
    """Whether each word is covered by a window that repeats: all windows of full reaches, and the windows of edges that were hit."""
    cover = np.zeros(len(a.words.starts) + 1, np.int64)
    np.add.at(cover, a.low[full], 1)
    np.add.at(cover, a.high[full] + s.window, -1)
    of, first, hashes = a.windows(np.flatnonzero(edge), s.window)
    texts = np.repeat(np.arange(len(hits)), _lengths(hits))
    hit = _listed(a.text[first], hashes, texts, hits.flatten().to_numpy().view(np.uint64))
    np.add.at(cover, first[hit], 1)
    np.add.at(cover, first[hit] + s.window, -1)
    return np.cumsum(cover[:-1]) > 0


def _lengths(lists: pa.Array) -> np.ndarray:
    return lists.value_lengths().fill_null(0).to_numpy()


def remove_repeats(docs: DataFrame, s: RepeatSettings = RepeatSettings()) -> DataFrame:
    """``docs`` (with ``doc_id, text``) plus ``n_words, n_removed``, the ``passages`` that repeat, and ``kept_text``, the other words joined by a space."""
    docs = docs.drop("n_words", "n_removed", "passages", "kept_text")
    names = [*docs.columns, "n_words", "n_removed", "passages", "kept_text"]
    keyed = docs.select("doc_id", "text", row_key().alias("_doc"))
    reaches = settled_reaches(keyed, s)
    known = reaches.select("doc", F.filter("reaches", lambda r: r["kind"] != SHOWN).alias("reaches"))
    known = known.join(repeated_extensions(keyed, reaches, s), "doc", "left")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), row_key().alias("_doc"))
    rows = packed.join(known, F.col("_doc") == F.col("doc"), "left").select("row", "reaches", "windows")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches, "row"):
            column = _plain(run.column("row")).field("text")
            a, lists = anchored(column, s), _plain(run.column("reaches"))
            hit = repeated_words(a, _marked(a, lists, FULL), _plain(run.column("windows")), _marked(a, lists, EDGE), s)
            counts, first = a.words.counts, a.words.first
            removed = np.concatenate(([0], np.cumsum(hit)))[first]
            data, offsets = text_bytes(column)
            kept = []
            for i in range(run.num_rows):
                each = data[offsets[i] : offsets[i + 1]].tobytes().split()  # splits at the bytes that are outside NOT_SPACE
                if removed[i + 1] > removed[i]:
                    each = compress(each, (~hit[first[i] : first[i + 1]]).tolist())
                kept.append(b" ".join(each).decode())
            same = hit[1:] & hit[:-1] & (a.text[1:] == a.text[:-1])
            begin = np.flatnonzero(hit & ~np.concatenate((np.zeros(min(len(hit), 1), bool), same)))
            end = np.flatnonzero(hit & ~np.concatenate((same, np.zeros(min(len(hit), 1), bool))))
            text = a.text[begin]
            spans = pa.StructArray.from_arrays([pa.array(begin - first[text]), pa.array(end - first[text])], ["first_word", "last_word"])
            passages = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(run.num_rows + 1)), pa.int32()), spans)
            yield pa.RecordBatch.from_arrays(
                [*_plain(run.column("row")).flatten(), pa.array(counts, pa.int64()), pa.array(np.diff(removed)), passages, pa.array(kept, pa.string())],
                names=names,
            )

    added = T.StructType().add("n_words", T.LongType()).add("n_removed", T.LongType()).add("passages", PASSAGES).add("kept_text", T.StringType())
    return rows.mapInArrow(cut, T.StructType([*docs.schema.fields, *added.fields]))


def repeat_digest(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
