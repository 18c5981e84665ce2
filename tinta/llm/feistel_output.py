"""Training-order materialisation of token sequences in fixed-stride shards.

1. Documents become token ids (two bytes each if the vocabulary allows), cut into sequences of a fixed length.
   They are stored once, numbered inside their task; the sizes of the tasks turn that into one number per sequence. Documents that come in an order of
   their own (``part, row``) are numbered in that order instead.
2. A keyed Feistel network permutes the numbers: a bijection of the next power of four, walked along its cycle until it falls below the
   number of sequences. The result is the sequence's slot in the training order. No sort of the corpus and no table of the order is needed.
   With ``Layout.window`` each run of so many numbers is permuted in itself, so an order that was made before, such as a mix of sources, holds from
   window to window.
3. Slots are range-partitioned; each shard holds a set number of slots as one payload with a fixed stride, so slot ``s`` begins at byte
   ``(s - first) * stride``. Spark commits a write as a whole; ``write_shards`` leaves out shards that a path already has.
4. ``read_shards`` reads from any slot on, in slot order.

Record of a slot: document id (8 bytes), place in the document (4), tokens (4), then ids, with zeros behind.

Defined results: a NULL or empty text is one sequence with the end token alone; a NULL id is stored as ``NULL_ID``; repeated
rows give sequences of their own; an empty table writes no shards. Other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tinta.llm.byte_words import EXACT_VALUES, runs_of_rows, small_batches, span_hashes, text_bytes
from tinta.session import cut_lineage, scratch_path

NULL_ID = -(1 << 63)
# Rows of two numbers that may be broadcast.
MOST_SHARED = 1 << 20
HEAD = np.dtype([("doc_id", "<i8"), ("part", "<i4"), ("n_tokens", "<i4")])
SEQUENCES = "part bigint, at bigint, doc_id bigint, seq int, n_tokens int, tokens binary"
# Fixed value: the public pattern that splits text before the merges of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@dataclass(frozen=True)
class Vocabulary:
    """A rank file of byte pairs, and the id that ends a document."""

    path: str = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    end: int = 50256

    @property
    def dtype(self) -> str:
        return "<u2" if self.end < 1 << 16 else "<u4"


@dataclass(frozen=True)
class Layout:
    length: int = 512
    shard_slots: int = 4096
    key: int = 0x5EED
    rounds: int = 6
    window: int | None = None


# ---- tokens


@lru_cache(maxsize=1)
def _memo(path: str, rank_bytes: bytes) -> PieceMemo:
    """One memo per worker process, kept over its tasks."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_bytes.splitlines())}
    return PieceMemo(tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}))


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans that can be encoded alone: cut before a space that a word follows, and between texts.

    The pattern never joins across such a space. Where the byte after it may begin a space outside ASCII, nothing is cut.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    closed = np.zeros(256, bool)
    closed[[32, *range(9, 14), 0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3]] = True
    spaces = np.flatnonzero(data[:-1] == 32)
    begins = np.zeros(len(data), bool)
    begins[spaces[~closed[data[spaces + 1]]]] = True
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(begins)
    return starts, np.append(starts[1:], len(data))


class PieceMemo:
    """Token ids of pieces that were met before; it starts anew when it holds ``most`` pieces."""

    def __init__(self, encoding, most: int = 200_000):
        self.encoding, self.most = encoding, most
        self._reset()

    def _reset(self) -> None:
        self.number: dict[int, int] = {}
        self.begin, self.flat = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def numbers(self, hashes: np.ndarray, raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of each of some different pieces, which are spans of ``raw``, in the memo."""
        if len(self.number) > self.most:
            self._reset()
        found = np.fromiter((self.number.get(h, -1) for h in hashes.tolist()), np.int64, len(hashes))
        new = np.flatnonzero(found < 0)
        if len(new):
            ids = [self.encoding.encode_ordinary(raw[b:e].decode("utf-8", "replace")) for b, e in zip(starts[new].tolist(), ends[new].tolist())]
            found[new] = np.arange(len(new)) + len(self.number)
            self.number.update(zip(hashes[new].tolist(), found[new].tolist()))
            sizes = np.array([len(k) for k in ids], np.int64)
            self.begin = np.concatenate((self.begin, self.begin[-1] + np.cumsum(sizes)))
            self.flat = np.concatenate((self.flat, np.fromiter((t for k in ids for t in k), np.uint32, int(sizes.sum()))))
        return found


def encode_texts(data: np.ndarray, offsets: np.ndarray, memo: PieceMemo, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts, each with the end token behind, and where each text begins. Every different piece is encoded once."""
    starts, ends = pieces(data, offsets)
    # a hash table instead of a sort; any occurrence of a piece tells its bytes
    which, hashes = pd.factorize(span_hashes(data, starts, ends, EXACT_VALUES))
    one = np.zeros(len(hashes), np.int64)
    one[which] = np.arange(len(which))
    number = memo.numbers(hashes, data.tobytes(), starts[one], ends[one])[which]
    at, sizes = memo.begin[number], memo.begin[number + 1] - memo.begin[number]
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(starts, offsets)))
    n = np.bincount(text, weights=sizes, minlength=len(offsets) - 1).astype(np.int64) + 1
    begin = np.concatenate(([0], np.cumsum(n)))
    tokens = np.full(begin[-1], end, np.uint32)
    total = int(sizes.sum())
    place = np.arange(total)
    before = np.cumsum(sizes) - sizes
    tokens[place + np.repeat(text, sizes)] = memo.flat[place + np.repeat(at - before, sizes)]  # one end token per text before
    return tokens, begin


def runs_of_texts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``first text, end, bytes, offsets`` of runs of texts of a bounded size."""
    data, offsets = text_bytes(column)
    for first, last in runs_of_rows(column):
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]


def store_sequences(docs: DataFrame, vocabulary: Vocabulary, layout: Layout, ordered: bool = False) -> DataFrame:
    """Sequences of all documents as a stored table; ``part, at`` is the number of a sequence inside its task, or if ``ordered`` the
    ``part, row`` of its document."""
    spark = docs.sparkSession
    small_batches(spark)
    # the rank file has a set size and goes to the tasks with the function
    ranks = spark.sparkContext.broadcast(spark.read.format("binaryFile").load(vocabulary.path).first()["content"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, part, at = _memo(vocabulary.path, bytes(ranks.value)), TaskContext.get().partitionId(), 0
        for batch in batches:
            every = batch.column("doc_id").cast(pa.int64()).fill_null(NULL_ID).to_numpy(zero_copy_only=False)
            parts, places = (batch.column(c).to_numpy() for c in ("part", "row")) if ordered else (None, None)
            for first, last, data, offsets in runs_of_texts(batch.column("text")):
                tokens, begin = encode_texts(data, offsets, memo, vocabulary.end)
                ids = every[first:last]
                each = -(-np.diff(begin) // layout.length)
                of = np.repeat(np.arange(len(each)), each)
                seq = np.arange(len(of)) - np.repeat(np.cumsum(each) - each, each)
                starts = begin[:-1][of] + seq * layout.length
                sizes = np.minimum(layout.length, begin[1:][of] - starts)
                packed = tokens.astype(vocabulary.dtype)
                # sequences lie one behind the other, so the tokens themselves are the values of the column
                bounds = (np.append(starts, begin[-1]) * packed.itemsize).astype(np.int64)
                values = pa.Array.from_buffers(pa.large_binary(), len(of), [None, pa.py_buffer(bounds), pa.py_buffer(packed)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(parts[first:last][of] if ordered else np.full(len(of), part, np.int64)),
                        pa.array(places[first:last][of] if ordered else at + np.arange(len(of))), pa.array(ids[of]),
                        pa.array(seq.astype(np.int32)), pa.array(sizes.astype(np.int32)), values.cast(pa.binary()),
                    ],
                    names=["part", "at", "doc_id", "seq", "n_tokens", "tokens"],
                )
                at += len(of)
        _memo.cache_clear()  # a worker may go on with other work, and the encoder is large

    path = scratch_path(spark, "sequences")
    docs.select("doc_id", "text", *(("part", "row") if ordered else ())).mapInArrow(cut, SEQUENCES).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(SEQUENCES).parquet(path)


# ---- order


def feistel(values: np.ndarray, count: int, key: int, rounds: int = 6) -> np.ndarray:
    """Image of each value under a keyed bijection of ``0 .. count - 1``."""
    half = max(1, -(-int(max(count - 1, 1)).bit_length() // 2))
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = [np.uint64((key * 0x9E3779B97F4A7C15 + (r + 1) * 0xD1B54A32D192ED03) % (1 << 64)) for r in range(rounds)]

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> shift, x & mask
        for k in keys:
            mixed = (right + k) * np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((mixed >> np.uint64(31)) & mask)
        return (left << shift) | right

    out = once(values.astype(np.uint64))
    while len(outside := np.flatnonzero(out >= np.uint64(count))):
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def slots(numbers: np.ndarray, count: int, layout: Layout) -> np.ndarray:
    """Slot of each number of ``0 .. count - 1``: one permutation of all, or one of each window with a key of its own."""
    if layout.window is None or layout.window >= count:
        return feistel(numbers, count, layout.key, layout.rounds)
    out = np.empty(len(numbers), np.int64)
    windows = numbers // layout.window
    for window in np.unique(windows):
        here = np.flatnonzero(windows == window)
        first = int(window) * layout.window
        out[here] = first + feistel(numbers[here] - first, min(layout.window, count - first), layout.key + int(window), layout.rounds)
    return out


def slot_of(number: Column, count: int, layout: Layout) -> Column:
    @F.pandas_udf("bigint")
    def slot(numbers: pd.Series) -> pd.Series:
        return pd.Series(slots(numbers.to_numpy(), count, layout))

    return slot(number)


def numbered_in_order(sequences: DataFrame) -> DataFrame:
    """``at`` becomes the number of a sequence in its part, by row and place in the document."""
    inside = Window.partitionBy("part").orderBy("at", "doc_id", "seq")
    return sequences.withColumn("at", (F.row_number().over(inside) - 1).cast("bigint"))


def with_slots(sequences: DataFrame, layout: Layout) -> tuple[DataFrame, int]:
    """Sequences with ``slot`` and ``shard``, and their count."""
    sizes = sequences.groupBy("part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per task
    starts = cut_lineage(sizes.select("part", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    tasks, count = starts.agg(F.count("*"), F.coalesce(F.sum("_n"), F.lit(0))).first()
    starts = starts.drop("_n")
    slot = slot_of(F.col("_start") + F.col("at"), count, layout)
    numbered = sequences.join(F.broadcast(starts) if tasks <= MOST_SHARED else starts, "part")
    numbered = numbered.withColumn("slot", slot).drop("_start", "part", "at")
    return numbered.withColumn("shard", F.floor(F.col("slot") / layout.shard_slots).cast("bigint")), count


# ---- shards


def stride(vocabulary: Vocabulary, layout: Layout) -> int:
    return HEAD.itemsize + layout.length * np.dtype(vocabulary.dtype).itemsize


def _pack(batches: Iterator[pa.RecordBatch], size: int, shard_slots: int) -> Iterator[pa.RecordBatch]:
    """Rows in slot order to one payload per shard."""
    open_shard, parts, n = None, [], 0

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([open_shard]), pa.array([open_shard * shard_slots]), pa.array([n], pa.int32()), pa.array([size], pa.int32()), pa.array([b"".join(parts)], pa.binary())],
            names=["shard", "first_slot", "slots", "stride", "payload"],
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        shards, records = batch.column("shard").to_numpy(), _records(batch, size)
        cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
        slots_ = batch.column("slot").to_numpy()
        for b, e in zip(cuts[:-1], cuts[1:]):
            if shards[b] != open_shard:
                if n:
                    yield done()
                open_shard, parts, n = int(shards[b]), [], 0
            if (slots_[b:e] != open_shard * shard_slots + n + np.arange(e - b)).any():
                raise ValueError(f"slots of shard {open_shard} are not dense")
            parts.append(records[b:e].tobytes())
            n += e - b
    if n:
        yield done()


def _records(batch: pa.RecordBatch, size: int) -> np.ndarray:
    """The records of a batch as rows of bytes: head, ids, zeros."""
    rows = batch.num_rows
    head = np.empty(rows, HEAD)
    for name, column in zip(HEAD.names, ("doc_id", "seq", "n_tokens")):
        head[name] = batch.column(column).to_numpy()
    out = np.zeros((rows, size), np.uint8)
    out[:, : HEAD.itemsize] = head.view(np.uint8).reshape(rows, -1)
    tokens = batch.column("tokens").cast(pa.large_binary())
    offsets = np.frombuffer(tokens.buffers()[1], np.int64, rows + 1, tokens.offset * 8)
    data = np.frombuffer(tokens.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    out[:, HEAD.itemsize :][np.arange(size - HEAD.itemsize)[None, :] < np.diff(offsets)[:, None]] = data
    return out


def write_shards(sequences: DataFrame, path: str, vocabulary: Vocabulary, layout: Layout, partitions: int | None = None) -> int:
    """Write the shards that ``path`` does not have yet; gives the number of sequences."""
    spark = sequences.sparkSession
    placed, count = with_slots(sequences, layout)
    if not count:
        return 0
    done = _shards_in(spark, path)
    if done is not None:
        placed = placed.join(done, "shard", "left_anti")
    size, slots = stride(vocabulary, layout), layout.shard_slots
    shards = -(-count // slots)
    parts = partitions or min(shards, max(int(spark.conf.get("spark.sql.shuffle.partitions")), shards // 16))
    # neighbouring shards go to one partition: ranges of equal length need no sampling, because slots are dense
    ordered = placed.repartitionById(parts, F.floor(F.col("shard") * parts / shards).cast("int")).sortWithinPartitions("slot")
    packed = ordered.mapInArrow(lambda b: _pack(b, size, slots), "shard bigint, first_slot bigint, slots int, stride int, payload binary")
    packed.write.mode("append").option("compression", "zstd").parquet(path)
    return count


def _shards_in(spark: SparkSession, path: str) -> DataFrame | None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return None
    return spark.read.parquet(path).select("shard")


def read_shards(spark: SparkSession, path: str, vocabulary: Vocabulary, from_slot: int = 0) -> DataFrame:
    """``slot, doc_id, seq, n_tokens, tokens`` from a slot on; rows of a shard come in slot order."""
    rows = spark.read.parquet(path).where(F.col("first_slot") + F.col("slots") > from_slot)
    width = np.dtype(vocabulary.dtype).itemsize

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                first, n, size = (batch.column(c)[row].as_py() for c in ("first_slot", "slots", "stride"))
                payload = batch.column("payload")[row].as_buffer()
                head = np.frombuffer(payload, np.dtype({"names": HEAD.names, "formats": [HEAD[c] for c in HEAD.names], "offsets": [0, 8, 12], "itemsize": size}), n)
                skip = max(0, from_slot - first)
                counts, ids = head["n_tokens"][skip:], head["doc_id"][skip:]
                at = np.arange(skip, n) * size + HEAD.itemsize
                tokens = [payload.slice(int(a), int(c) * width).to_pybytes() for a, c in zip(at, counts)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(first + skip, first + n)), pa.array(ids, mask=ids == NULL_ID),
                        pa.array(head["part"][skip:].astype(np.int32)), pa.array(counts.astype(np.int32)), pa.array(tokens, pa.binary()),
                    ],
                    names=["slot", "doc_id", "seq", "n_tokens", "tokens"],
                )

    return rows.select("first_slot", "slots", "stride", "payload").mapInArrow(unpack, "slot bigint, doc_id bigint, seq int, n_tokens int, tokens binary")


def stored_order(docs: DataFrame, rows: int = 4096) -> DataFrame:
    """``doc_id, text, part, row`` of documents read from files: files in the order of their numbers, rows in the order of each file,
    in parts of a bounded number of rows."""
    file, row = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1), F.col("_metadata.row_index")
    number = F.coalesce(F.expr("try_cast(nullif(_metadata_file, '') AS bigint)"), F.lit(0))
    numbered = docs.select("doc_id", "text", file.alias("_metadata_file"), row.alias("row"))
    return numbered.select("doc_id", "text", (number * (1 << 32) + F.floor(F.col("row") / rows)).cast("bigint").alias("part"), "row")


def materialise(docs: DataFrame, vocabulary: Vocabulary = Vocabulary(), layout: Layout = Layout(), ordered: bool = False) -> str:
    """Write all documents in training order; gives the folder of the shards."""
    path = scratch_path(docs.sparkSession, "shards")
    sequences = store_sequences(docs, vocabulary, layout, ordered)
    write_shards(numbered_in_order(sequences) if ordered else sequences, path, vocabulary, layout)
    return path


def materialised(docs: DataFrame, vocabulary: Vocabulary = Vocabulary(), layout: Layout = Layout(), ordered: bool = False) -> DataFrame:
    """Every slot as it is read back from the shards, with a digest of its ids."""
    path, spark = materialise(docs, vocabulary, layout, ordered), docs.sparkSession
    if _shards_in(spark, path) is None:
        return spark.createDataFrame([], "slot bigint, doc_id bigint, seq int, n_tokens int, tokens_sha256 string")
    return read_shards(spark, path, vocabulary).withColumn("tokens_sha256", F.sha2("tokens", 256)).drop("tokens")
