"""Benchmark decontamination with an FM-index per shard of training documents.

A shard is a run of documents of a bounded size in a task. Its words become the numbers of the test words; all
other words are one border symbol, for no test phrase holds them, and runs between borders that are shorter
than the shortest phrase are left out, for no phrase fits in. What stays is indexed, all phrases are searched
backward at once, their places are found from sampled suffix positions, and overlapping places become removal spans.

The test set is read in blocks of a bounded number of words; each block goes to the tasks as one broadcast, and
further blocks pass over the documents again and add to their spans.

Defined results: NULL and empty texts have no words and no spans; items without words match nothing; a phrase of several items
counts for each; a NULL item id is listed as ``null``; repeated rows get a row each; empty tables give no
rows, or rows without spans. The columns of the documents are kept; ``spans`` and ``items`` are replaced if they exist.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tinta.llm.byte_words import ALPHANUMERIC, find_words, place_in, runs_of_rows, small_batches, text_bytes
from tinta.llm.fm_index import FMIndex
from tinta.session import cut_lineage

WINDOW = 10
BLOCK_WORDS = 1_000_000
SPAN = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("first_word", "last_word", "first_byte", "last_byte")]
)


@dataclass
class Phrases:
    """Test phrases by length as rows of word numbers (from 1), and the items of each."""

    words: np.ndarray  # sorted hashes of the test words
    by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # length: phrases, first item, items
    ids: list[str]

    @property
    def shortest(self) -> int:
        return min(self.by_length)


def phrase_blocks(items: Iterator[tuple[object, str | None]], window: int, block_words: int) -> Iterator[Phrases]:
    """Test items cut into phrases of ``window`` words, in blocks. A longer item goes on in the next block."""
    held, size = [], 0
    for item, text in items:
        found = find_words(pa.array([text], pa.large_string()), ALPHANUMERIC)
        hashes, name = found.hashes(), "null" if item is None else str(item)
        while len(hashes):
            room = max(block_words - size, window)
            held.append((name, hashes[:room]))
            size += min(room, len(hashes))
            hashes = hashes[room - window + 1 :] if len(hashes) > room else hashes[:0]
            if size >= block_words:
                yield _block(held, window)
                held, size = [], 0
    if held:
        yield _block(held, window)


def _block(held: list[tuple[str, np.ndarray]], window: int) -> Phrases:
    words = np.unique(np.concatenate([h for _, h in held]))
    ids = sorted({name for name, _ in held})
    number = {name: i for i, name in enumerate(ids)}
    rows: dict[int, list] = {}
    for name, hashes in held:
        symbols, n = np.searchsorted(words, hashes) + 1, min(window, len(hashes))
        cut = np.lib.stride_tricks.sliding_window_view(symbols, n)
        rows.setdefault(n, []).append((cut, np.full(len(cut), number[name])))
    by_length = {}
    for n, parts in rows.items():
        phrases, of = np.unique(np.concatenate([p for p, _ in parts]), axis=0, return_inverse=True)
        pairs = np.unique(np.stack((of.reshape(-1), np.concatenate([i for _, i in parts])), axis=1), axis=0)
        by_length[n] = phrases, np.searchsorted(pairs[:, 0], np.arange(len(phrases) + 1)), pairs[:, 1]
    return Phrases(words, by_length, ids)


def _expand(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the ranges, and all values within them."""
    sizes = high - low
    of = np.repeat(np.arange(len(sizes)), sizes)
    return of, np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[of]


def find_places(symbols: np.ndarray, texts: np.ndarray, phrases: Phrases) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``length, phrase, first word`` of all occurrences in a shard; symbols are 0 for words of no phrase."""
    known = symbols > 0
    joined = known[1:] & known[:-1] & (texts[1:] == texts[:-1])
    begins = np.flatnonzero(known & ~np.concatenate(([False], joined)))
    ends = np.flatnonzero(known & ~np.concatenate((joined, [False]))) + 1
    long = ends - begins >= phrases.shortest
    run, places = _expand(begins[long], ends[long])
    if not len(places):
        return
    at = np.arange(len(places)) + run  # a border after each run
    sequence = np.zeros(at[-1] + 2, np.int64)
    sequence[at] = symbols[places]
    where = np.zeros(len(sequence), np.int64)
    where[at] = places
    index = FMIndex(sequence, len(phrases.words) + 2)
    for length, (rows, _, _) in phrases.by_length.items():
        low, high = index.search(rows)
        phrase, suffixes = _expand(low, high)
        if len(suffixes):
            yield length, phrase, where[index.locate(suffixes)]


def _scan(batch: pa.RecordBatch, phrases: Phrases) -> pa.RecordBatch:
    words = find_words(batch.column("text"), ALPHANUMERIC)
    texts, total, n = words.texts(), len(words.starts), batch.num_rows
    symbols = place_in(phrases.words, words.hashes()) + 1
    cover = np.zeros(total + 1, np.int64)
    pairs = [np.zeros((0, 2), np.int64)]
    for length, phrase, first in find_places(symbols, texts, phrases):
        np.add.at(cover, first, 1)
        np.add.at(cover, first + length, -1)
        _, offsets, items = phrases.by_length[length]
        of, at = _expand(offsets[phrase], offsets[phrase + 1])
        pairs.append(np.unique(np.stack((texts[first[of]], items[at]), axis=1), axis=0))
    hit = np.cumsum(cover[:-1]) > 0
    spans = _spans_before(batch, words, hit)
    found = np.unique(np.concatenate(pairs), axis=0)
    named = [set() if x is None else set(x) for x in batch.column("items").to_pylist()]
    for text, item in found:
        named[text].add(phrases.ids[item])
    columns = [batch.column(c) for c in batch.schema.names]
    at = batch.schema.get_field_index
    columns[at("n_words")] = pa.array(words.counts, pa.int64())
    columns[at("spans")] = pa.array(spans, columns[at("spans")].type)
    columns[at("items")] = pa.array([sorted(x) for x in named], columns[at("items")].type)
    assert len(spans) == n
    return pa.RecordBatch.from_arrays(columns, schema=batch.schema)


def _spans_before(batch: pa.RecordBatch, words, hit: np.ndarray) -> list[list[dict]]:
    """Merged spans of each text: those of this pass and those that it had."""
    texts = words.texts()
    for text, had in enumerate(batch.column("spans").to_pylist()):
        for span in had or ():
            hit[words.first[text] + span["first_word"] : words.first[text] + span["last_word"] + 1] = True
    same = hit[1:] & hit[:-1] & (texts[1:] == texts[:-1]) if len(hit) else hit
    begins = np.flatnonzero(hit & ~np.concatenate(([False], same))) if len(hit) else np.zeros(0, np.int64)
    ends = np.flatnonzero(hit & ~np.concatenate((same, [False]))) if len(hit) else np.zeros(0, np.int64)
    spans: list[list[dict]] = [[] for _ in range(batch.num_rows)]
    from_byte = text_bytes(batch.column("text"))[1].tolist()
    for b, e in zip(begins.tolist(), ends.tolist()):
        text = int(texts[b])
        spans[text].append(
            {
                "first_word": b - int(words.first[text]),
                "last_word": e - int(words.first[text]),
                "first_byte": int(words.starts[b]) - from_byte[text],
                "last_byte": int(words.ends[e]) - from_byte[text] - 1,
            }
        )
    return spans


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """``docs`` (with ``text``) plus ``n_words``, ``spans`` of test words, and the sorted ``items`` found.

    ``benchmark`` has ``item_id, text``. Spans give the first and last word and byte of each stretch.
    """
    spark = docs.sparkSession
    small_batches(spark)
    start = docs.drop("n_words", "spans", "items").select(
        "*",
        F.lit(None).cast("bigint").alias("n_words"),
        F.lit(None).cast(T.ArrayType(SPAN)).alias("spans"),
        F.lit(None).cast("array<string>").alias("items"),
    )
    items = ((r["item_id"], r["text"]) for r in benchmark.select("item_id", "text").toLocalIterator())
    result, passes = start, 0
    for block in phrase_blocks(items, window, block_words):
        result = cut_lineage(result) if passes else result
        result, passes = _one_pass(result, spark.sparkContext.broadcast(block)), passes + 1
    if not passes:
        none = Phrases(np.zeros(0, np.uint64), {window: (np.zeros((0, window), np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64))}, [])
        result = _one_pass(result, spark.sparkContext.broadcast(none))
    return result


def _one_pass(rows: DataFrame, block) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in runs_of_rows(batch.column("text")):
                yield _scan(batch.slice(first, last - first), block.value)

    return rows.mapInArrow(scan, rows.schema)


def hit_words() -> Column:
    return F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["last_word"] - s["first_word"] + 1)


def contamination_digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id",
        "n_words",
        hit_words().alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def remove_spans(found: DataFrame) -> DataFrame:
    """Documents without their spans; the pieces left are joined by a space, and documents with no word left go."""
    names = [c for c in found.columns if c not in ("n_words", "spans", "items")]
    at = names.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first, last in runs_of_rows(whole.column("text")):
                batch, kept, texts = whole.slice(first, last - first), [], []
                for row, (text, spans) in enumerate(zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist())):
                    if spans:
                        raw, begin, pieces = text.encode(), 0, []
                        for s in spans:
                            pieces.append(raw[begin : s["first_byte"]])
                            begin = s["last_byte"] + 1
                        text = b" ".join([*pieces, raw[begin:]]).decode().strip()
                        if not len(find_words(pa.array([text], pa.large_string()), ALPHANUMERIC).starts):
                            continue
                    kept.append(row)
                    texts.append(text)
                columns = [batch.column(n).take(pa.array(kept, pa.int64())) for n in names]
                columns[at] = pa.array(texts, columns[at].type)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return found.mapInArrow(cut, found.select(*names).schema)
