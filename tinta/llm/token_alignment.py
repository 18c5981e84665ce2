"""Alignment of two tokenizers over a corpus, with a count for every pair of token ids that ever overlap.

Both tokenizers cut ``space + text``. The places where a token of both ends cut the bytes into groups; a token of A and one of B are linked where their
bytes overlap: between two neighbouring ends of any token lies exactly one link. A pair's count is the number of documents that hold it linked.

1. Texts are cut before single spaces that a word follows. Both tokenizers end a token there whatever stands around (A's pattern never joins across such a space, no
   piece of B has a space behind another character, which is checked), so every different piece of a run is encoded once. The ids are stored.
2. The different pairs of the corpus are hashed without gaps or collisions (``perfect_hash``), bucket by bucket, in Spark tasks.
3. First pass: each task counts its documents in one dense vector, indexed by the hash. Vectors leave the task in blocks, without the blocks of zeros, and are
   summed in a tree of bounded fan-in.
4. Second pass: documents are aligned again; hash and counts, keys verified, give every link its count, and a count per id of A tells its best ones.

Memory is bounded by ``most_pairs``: a larger set of pairs is worked on in ranges of buckets, each with its passes, and what a document gets from the
ranges adds up. Tokenizer files are read by Spark and go to the tasks as broadcasts; their size is fixed.

Defined results: a text that is NULL or empty, or whose joined token bytes differ from ``space + text`` in either tokenizer, has no tokens: all
numbers are 0 and ``groups`` is ''. Repeated rows are documents of their own; an empty table gives no rows. Columns of the input other than
``text`` are kept; the result's own columns are replaced if they exist.
"""

from __future__ import annotations

import itertools
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tinta.llm.byte_words import EXACT_VALUES, byte_class, place_in, runs_of_rows, small_batches, span_hashes, text_bytes
from tinta.llm.perfect_hash import PerfectHash, bucket_of, build_bucket
from tinta.session import cut_lineage, scratch_path

NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
BLOCK = 4096
FAN = 32
RUN_BYTES = 1 << 20
# Pieces that are encoded in one go.
TOGETHER = 64
# Bytes that are, or may begin, white space.
CLOSED = byte_class({32, *range(9, 14), 0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3})


@dataclass(frozen=True)
class Tokenizers:
    """A: a byte-level tokenizer file; B: a sentence piece model with byte pieces that puts a space in front."""

    a: str = "/opt/tokenizers/byte_bpe_50k.json"
    b: str = "/opt/tokenizers/piece_bpe_32k.model"


@dataclass(frozen=True)
class AlignSettings:
    bucket_pairs: int = 4096
    most_pairs: int = 1 << 21


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary: Latin-1 letters for themselves, others from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class PieceEncoder:
    """Ids of both tokenizers for the pieces met before; it starts anew when it holds too much."""

    def __init__(self, a_file: bytes, b_file: bytes, most: int = 300_000, most_ids: int = 4_000_000):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_file.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        letters = byte_letters()
        vocabulary = {i: bytes(letters[c] for c in t) for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        self.bytes = [vocabulary.get(i, b"") for i in range(max(vocabulary) + 1)], [self._piece(i) for i in range(self.b.get_piece_size())]
        self.sizes = tuple(np.array([len(x) for x in side], np.int64) for side in self.bytes)
        if any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in range(self.b.get_piece_size())):
            raise ValueError("a piece holds a space behind another character: texts cannot be cut at spaces")
        self.most, self.most_ids = most, most_ids
        self._reset()

    def _piece(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:5], 16)])
        return self.b.id_to_piece(i).replace("▁", " ").encode()

    def _reset(self) -> None:
        self.number: dict[int, int] = {}
        self.begin = [np.zeros(1, np.int64), np.zeros(1, np.int64)]
        self.ids = [np.zeros(0, np.uint32), np.zeros(0, np.uint32)]
        self.differs = np.zeros(0, bool)

    def numbers(self, hashes: np.ndarray, pieces: list[bytes]) -> np.ndarray:
        """Number of each of some different pieces."""
        if len(self.number) > self.most or sum(map(len, self.ids)) > self.most_ids:
            self._reset()
        found = np.fromiter(map(self.number.get, hashes.tolist(), itertools.repeat(-1)), np.int64, len(hashes))
        new = np.flatnonzero(found < 0)
        if len(new):
            raw = [pieces[i] for i in new]
            found[new] = np.arange(len(new)) + len(self.number)
            self.number.update(zip(hashes[new].tolist(), found[new].tolist()))
            differs = np.zeros(len(new), bool)
            for side in (0, 1):
                flat, sizes, other = self._together(side, raw) or self._one_by_one(side, raw)
                differs |= other
                self.begin[side] = np.concatenate((self.begin[side], self.begin[side][-1] + np.cumsum(sizes)))
                self.ids[side] = np.concatenate((self.ids[side], flat))
            self.differs = np.concatenate((self.differs, differs))
        return found


    def _encode(self, side: int, texts: list[str]) -> list[list[int]]:
        if side:
            return self.b.encode([t[1:] for t in texts], num_threads=1)  # B puts the space in front itself
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, side: int, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids of all pieces, their number in each piece, and that no piece differs: pieces that may stand side by side are encoded in one go
        and told apart by the ends of their tokens. None if a tokenizer changes one of them."""
        plain = np.array([x[0] == 32 and len(x) > 1 and not CLOSED[x[1]] and x[-1] != 32 for x in raw])
        cut = np.ones(len(raw), bool)
        cut[1:] = ~(plain[1:] & plain[:-1])
        cut[np.arange(0, len(raw), TOGETHER)] = True
        first = np.flatnonzero(cut).tolist()
        texts = [b"".join(raw[b:e]).decode() for b, e in zip(first, [*first[1:], len(raw)])]
        flat = np.fromiter(itertools.chain.from_iterable(self._encode(side, texts)), np.uint32)
        if b"".join(map(self.bytes[side].__getitem__, flat.tolist())) != b"".join(raw):
            return None
        ends, wanted = np.cumsum(self.sizes[side][flat]), np.cumsum([len(x) for x in raw])
        last = np.searchsorted(ends, wanted, "left")
        if not (ends[last] == wanted).all():
            return None
        return flat, np.diff(last, prepend=-1), np.zeros(len(raw), bool)

    def _one_by_one(self, side: int, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = self._encode(side, [x.decode() for x in raw])
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        differs = np.array([b"".join(map(self.bytes[side].__getitem__, own)) != x for own, x in zip(ids, raw)], bool)
        return np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes, differs


@lru_cache(maxsize=1)
def _encoder(a: str, b: str, files: tuple[bytes, bytes]) -> PieceEncoder:
    """One encoder per worker process, kept over its tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
    return PieceEncoder(*files)


def led_by_space(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts with a space in front of each, and their offsets; empty texts stay empty."""
    sizes = np.diff(offsets)
    texts = np.flatnonzero(sizes)
    out = np.insert(data, offsets[:-1][texts], 32)
    return out, offsets + np.concatenate(([0], np.cumsum(sizes > 0)))


def cut_pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of the pieces: cut before a space that no space precedes and no space character follows, and between texts."""
    cut = np.zeros(len(data) + 1, bool)
    if len(data) > 2:
        cut[1:-2] = (data[1:-1] == 32) & (data[:-2] != 32) & ~CLOSED[data[2:]]
    cut[offsets] = True
    cut[-1] = False
    starts = np.flatnonzero(cut)
    return starts, np.append(starts[1:], len(data))[: len(starts)]


def ranges_of(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of some ranges, and the sizes of the ranges."""
    sizes = end - begin
    return np.arange(int(sizes.sum())) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes), sizes


def encode_texts(column: pa.Array, encoder: PieceEncoder) -> tuple[list[pa.Array], np.ndarray]:
    """Ids of both tokenizers as bytes, and whether a text has tokens."""
    data, offsets = led_by_space(*text_bytes(column))
    starts, ends = cut_pieces(data, offsets)
    hashes, first, which = np.unique(span_hashes(data, starts, ends, EXACT_VALUES), return_index=True, return_inverse=True)
    raw = data.tobytes()
    piece = encoder.numbers(hashes, [raw[b:e] for b, e in zip(starts[first].tolist(), ends[first].tolist())])[which]
    begin = np.searchsorted(starts, offsets, "left")
    same = (np.diff(np.concatenate(([0], np.cumsum(encoder.differs[piece])))[begin]) == 0) & (np.diff(offsets) > 0)
    text = np.repeat(np.arange(len(column)), np.diff(begin))
    piece, text = piece[same[text]], text[same[text]]
    columns = []
    for side in (0, 1):
        at, sizes = ranges_of(encoder.begin[side][piece], encoder.begin[side][piece + 1])
        values = encoder.ids[side][at].astype("<u2" if len(encoder.sizes[side]) <= 1 << 16 else "<u4")
        tokens = np.bincount(text, sizes, len(column)).astype(np.int64)
        bounds = np.concatenate(([0], np.cumsum(tokens))) * values.itemsize
        columns.append(pa.Array.from_buffers(pa.large_binary(), len(column), [None, pa.py_buffer(bounds), pa.py_buffer(values)]).cast(pa.binary()))
    return columns, same


@dataclass
class Aligned:
    """A run of documents: ids and document of the tokens of A and B, and place of both tokens of every link. Groups end where tokens of both end."""

    ids: tuple[np.ndarray, np.ndarray]
    counts: tuple[np.ndarray, np.ndarray]
    ends: tuple[np.ndarray, np.ndarray]
    links: tuple[np.ndarray, np.ndarray]
    text: np.ndarray
    common: np.ndarray

    @classmethod
    def of(cls, columns: tuple[pa.Array, pa.Array], sizes: tuple[np.ndarray, np.ndarray]) -> Aligned:
        ids, counts = zip(*(_ids(c, len(s)) for c, s in zip(columns, sizes)))
        ends = tuple(np.cumsum(s[i]) for s, i in zip(sizes, ids))
        both = np.concatenate(ends)
        both.sort(kind="stable")  # two rising runs
        every = both[np.concatenate((both[1:] != both[:-1], [True]))] if len(both) else both
        links = tuple(np.searchsorted(e, every, "left") for e in ends)
        text = np.repeat(np.arange(len(counts[0])), counts[0])[links[0]]
        return cls(ids, counts, ends, links, text, both[:-1][both[1:] == both[:-1]])

    def pairs(self) -> np.ndarray:
        """Both ids of every link as one key."""
        return (self.ids[0][self.links[0]].astype(np.uint64) << np.uint64(32)) | self.ids[1][self.links[1]].astype(np.uint64)

    def groups(self) -> tuple[np.ndarray, list[str]]:
        """Number of groups of each document, and ``a1,a2|b1;a3|b2`` of it."""
        of = [np.searchsorted(self.common, e, "left") for e in self.ends]
        n = len(self.common)
        before_b = np.concatenate(([0], np.cumsum(np.bincount(of[1], minlength=n))))
        upto_a = np.cumsum(np.bincount(of[0], minlength=n)) if n else np.zeros(0, np.int64)
        place = np.arange(len(of[0])) + before_b[of[0]], np.arange(len(of[1])) + (upto_a[of[1]] if n else 0)
        token, sep = np.zeros(len(of[0]) + len(of[1]), np.uint32), np.full(len(of[0]) + len(of[1]), ord(","), np.uint8)
        for side, (at, last) in enumerate(zip(place, b"|;")):
            token[at] = self.ids[side]
            closing = np.concatenate((of[side][1:] != of[side][:-1], [True])) if len(at) else np.zeros(0, bool)
            sep[at[closing]] = last
        total = self.counts[0] + self.counts[1]
        out, bounds = _decimals(token, sep, total)
        raw = out.tobytes()
        texts = [raw[b : max(b, e - 1)].decode() for b, e in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        ended = np.concatenate(([0], np.cumsum(self.counts[0])))
        first = np.searchsorted(self.common, np.concatenate(([0], self.ends[0]))[ended], "right") if n else np.zeros(len(ended), np.int64)
        return np.diff(first), texts


def _ids(column: pa.Array, known: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows, and their number in each."""
    column = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    kind = np.dtype("<u2" if known <= 1 << 16 else "<u4")
    data = column.buffers()[2]
    flat = np.frombuffer(data, kind, (int(offsets[-1]) - int(offsets[0])) // kind.itemsize, int(offsets[0])) if data is not None and offsets[-1] > offsets[0] else np.zeros(0, kind)
    return flat, np.diff(offsets) // kind.itemsize


def _decimals(numbers: np.ndarray, behind: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of each number with a byte behind it, all joined, and where each run of ``counts`` numbers begins."""
    digits = np.maximum(1, np.ceil(np.log10(numbers.astype(np.float64) + 1)).astype(np.int64))
    width = int(digits.max(initial=1))
    cells = np.empty((len(numbers), width + 1), np.uint8)
    rest = numbers.astype(np.int64)
    for k in range(width - 1, -1, -1):
        cells[:, k] = 48 + rest % 10
        rest //= 10
    cells[:, width] = behind
    held = np.arange(width + 1)[None, :] >= width - digits[:, None]
    ends = np.concatenate(([0], np.cumsum(digits + 1)))
    return cells[held], ends[np.concatenate(([0], np.cumsum(counts)))]


class Alignment:
    """The passes over the documents of one table."""

    def __init__(self, docs: DataFrame, tokenizers: Tokenizers = Tokenizers(), settings: AlignSettings = AlignSettings()):
        docs, self.spark, self.settings = docs.drop(*NUMBERS, "groups"), docs.sparkSession, settings
        small_batches(self.spark)
        files = tuple(bytes(self.spark.read.format("binaryFile").load(p).first()["content"]) for p in (tokenizers.a, tokenizers.b))
        self.sizes = PieceEncoder(*files).sizes  # bytes of every id
        self.tokens = self._encoded(docs, tokenizers, self.spark.sparkContext.broadcast(files))

    def _encoded(self, docs: DataFrame, tokenizers: Tokenizers, files) -> DataFrame:
        """Stored ``row, a, b``: the other columns of a document, and its ids."""
        others = [c for c in docs.columns if c != "text"]

        def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            encoder = _encoder(tokenizers.a, tokenizers.b, files.value)
            for batch in batches:
                for first, last in runs_of_rows(batch.column("text"), RUN_BYTES):
                    part = batch.slice(first, last - first)
                    columns, _ = encode_texts(part.column("text"), encoder)
                    yield pa.RecordBatch.from_arrays([part.column("row"), *columns], names=["row", "a", "b"])

        rows = docs.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in others]).alias("row"), "text")
        path = scratch_path(self.spark, "tokens")
        schema = T.StructType([rows.schema["row"], T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])
        rows.mapInArrow(encode, schema).write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def index(self) -> tuple[DataFrame, int]:
        """Stored ``bucket, sizes, words, keys`` of all different pairs, and the number of buckets."""
        lengths, size = self.sizes, self.settings.bucket_pairs

        def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            met = np.zeros(0, np.uint64)  # sorted
            for run in _aligned_runs(batches, lengths):
                found = np.unique(run[1].pairs())
                found = found[place_in(met, found) < 0]
                met = found if len(met) > 1 << 20 else np.union1d(met, found)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["pair"])

        path = scratch_path(self.spark, "pairs")
        self.tokens.select("a", "b").mapInArrow(pairs, "pair bigint").distinct().write.parquet(path)
        every = self.spark.read.parquet(path)
        buckets = max(1, every.count() // size)

        def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys = batch.column("pair").to_numpy().view(np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(bucket_of(keys, buckets)), batch.column("pair")], names=["bucket", "pair"])

        def build(group: pa.Table) -> pa.Table:
            sizes, words, keys = build_bucket(group.column("pair").to_numpy().view(np.uint64))
            return pa.table({"bucket": group.column("bucket").slice(0, 1), "sizes": pa.array([sizes], pa.list_(pa.int32())), "words": [words.tobytes()], "keys": [keys.tobytes()]})

        path = scratch_path(self.spark, "index")
        built = every.mapInArrow(numbered, "bucket bigint, pair bigint").groupBy("bucket").applyInArrow(build, "bucket bigint, sizes array<int>, words binary, keys binary")
        built.write.parquet(path)
        return self.spark.read.parquet(path), buckets

    def ranges(self, buckets: int) -> list[tuple[int, int]]:
        """First and end of ranges of buckets that hold at most about ``most_pairs`` pairs."""
        step = max(1, self.settings.most_pairs // (2 * self.settings.bucket_pairs))
        return [(b, min(b + step, buckets)) for b in range(0, buckets, step)]

    def load(self, index: DataFrame, buckets: int, first: int, end: int) -> PerfectHash:
        rows = {r["bucket"]: r for r in index.where(F.col("bucket").between(first, end - 1)).toLocalIterator()}
        parts = [
            (rows[b]["sizes"], np.frombuffer(rows[b]["words"], np.uint64), np.frombuffer(rows[b]["keys"], np.uint64)) if b in rows else build_bucket(np.zeros(0, np.uint64))
            for b in range(first, end)
        ]
        return PerfectHash.joined(buckets, first, parts)

    def count(self, index: PerfectHash) -> DataFrame:
        """Stored ``block, counts``: the documents that hold each pair of ``index``."""
        lengths, shared = self.sizes, self.spark.sparkContext.broadcast(index)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, total = shared.value, np.zeros(len(shared.value.keys), np.int64)
            for _, run in _aligned_runs(batches, lengths):
                # a pair counts once in a document, however often it is linked there
                links, which = np.unique(run.pairs(), return_inverse=True)
                once = np.unique(run.text * max(1, len(links)) + which)
                numbers = own.find(links)[once % max(1, len(links))]
                total += np.bincount(numbers[numbers >= 0], minlength=len(total))
            part = TaskContext.get().partitionId()
            blocks = [(i, total[i : i + BLOCK]) for i in range(0, len(total), BLOCK)]
            blocks = [(i // BLOCK, x.tobytes()) for i, x in blocks if x.any()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(blocks), pa.int64()), pa.array([b for b, _ in blocks], pa.int64()), pa.array([x for _, x in blocks], pa.binary())],
                names=["node", "block", "counts"],
            )

        def joined(group: pa.Table) -> pa.Table:
            sums = sum(np.frombuffer(x.as_buffer(), np.int64) for x in group.column("counts"))
            return pa.table({"node": group.column("node").slice(0, 1), "block": group.column("block").slice(0, 1), "counts": [sums.tobytes()]})

        vectors = self.tokens.select("a", "b").mapInArrow(add, "node bigint, block bigint, counts binary")
        nodes = vectors.rdd.getNumPartitions()
        while nodes > 1:
            nodes = -(-nodes // FAN)
            up = vectors.select(F.floor(F.col("node") / FAN).cast("bigint").alias("node"), "block", "counts")
            vectors = up.groupBy("node", "block").applyInArrow(joined, "node bigint, block bigint, counts binary")
        path = scratch_path(self.spark, "counts")
        vectors.select("block", "counts").write.parquet(path)
        shared.unpersist()
        return self.spark.read.parquet(path)

    @staticmethod
    def vector(index: PerfectHash, blocks: DataFrame) -> np.ndarray:
        out = np.zeros(len(index.keys), np.int64)
        for row in blocks.toLocalIterator():
            part = np.frombuffer(row["counts"], np.int64)
            out[row["block"] * BLOCK : row["block"] * BLOCK + len(part)] = part
        return out

    def looked_up(self, rows: DataFrame, number: int, index: PerfectHash, counts: np.ndarray, best: np.ndarray) -> DataFrame:
        """``rows`` with the numbers of one range of pairs added."""
        lengths, shared = self.sizes, self.spark.sparkContext.broadcast((index, counts, best))
        names = rows.columns

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index, counts, best = shared.value
            for part, run in _aligned_runs(batches, lengths):
                links, which = np.unique(run.pairs(), return_inverse=True)
                at = index.find(links)
                held = at >= 0
                count = np.zeros(len(links), np.int64)
                count[held] = counts[at[held]]
                top = np.zeros(len(links), np.int64)
                top[held] = count[held] == best[(links[held] >> np.uint64(32)).astype(np.int64)]
                sums = [np.bincount(run.text, x[which], part.num_rows).astype(np.int64) for x in (count, top)]
                columns = {c: part.column(c) for c in names}
                for name, more in zip(("count_sum", "n_best"), sums):
                    columns[name] = pa.array(part.column(name).to_numpy() + more)
                if not number:
                    n_groups, texts = run.groups()
                    n_links = np.bincount(run.text, minlength=part.num_rows)
                    columns |= {c: pa.array(x.astype(np.int64)) for c, x in zip(NUMBERS, (*run.counts, n_groups, n_links))}
                    columns["groups"] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)

        return rows.mapInArrow(look, rows.schema)

    def aligned(self) -> DataFrame:
        """The documents with ``n_a, n_b, n_groups, n_links, n_best, count_sum`` and ``groups``."""
        index, buckets = self.index()
        ranges = self.ranges(buckets)
        best, stored = np.zeros(0, np.int64), []
        for first, end in ranges:
            part = self.load(index, buckets, first, end)
            stored.append(self.count(part))
            counts = self.vector(part, stored[-1])
            ids = (part.keys >> np.uint64(32)).astype(np.int64)
            best = np.concatenate((best, np.zeros(max(0, int(ids.max(initial=-1)) + 1 - len(best)), np.int64)))
            np.maximum.at(best, ids, counts)
        zeros = [F.lit(0).cast("bigint").alias(c) for c in NUMBERS]
        rows = self.tokens.select("row", "a", "b", *zeros, F.lit("").alias("groups"))
        for number, ((first, end), blocks) in enumerate(zip(ranges, stored)):
            rows = cut_lineage(rows) if number else rows
            part = self.load(index, buckets, first, end)
            rows = self.looked_up(rows, number, part, self.vector(part, blocks), best)
        others = [F.col("row").getField(f.name).alias(f.name) for f in self.tokens.schema["row"].dataType.fields[1:]]
        return rows.select(*others, *NUMBERS, "groups")

    def pair_counts(self) -> DataFrame:
        """``a, b, n_docs`` of all pairs."""
        index, buckets = self.index()
        result = None
        for first, end in self.ranges(buckets):
            part = self.load(index, buckets, first, end)
            shared = self.spark.sparkContext.broadcast((part.keys, self.vector(part, self.count(part))))

            def rows(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    at = batch.column("id").to_numpy()
                    keys = shared.value[0][at]
                    ids = [pa.array((x).astype(np.int32)) for x in (keys >> np.uint64(32), keys & np.uint64(0xFFFFFFFF))]
                    yield pa.RecordBatch.from_arrays([*ids, pa.array(shared.value[1][at])], names=["a", "b", "n_docs"])

            more = self.spark.range(len(part.keys)).mapInArrow(rows, "a int, b int, n_docs bigint")
            result = more if result is None else result.unionByName(more)
        return result


def _aligned_runs(batches: Iterator[pa.RecordBatch], sizes: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[pa.RecordBatch, Aligned]]:
    """Runs of documents with a bounded number of ids (a longer one is a run alone)."""
    for batch in batches:
        ends = np.concatenate(([0], np.cumsum(pc.binary_length(batch.column("a")).to_numpy().astype(np.int64))))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + RUN_BYTES, "right")) - 1)
            part = batch.slice(first, last - first)
            yield part, Aligned.of((part.column("a"), part.column("b")), sizes)
            first = last


def alignment_digest(aligned: DataFrame) -> DataFrame:
    digest = F.when(F.col("n_a") == 0, "").otherwise(F.sha2(F.col("groups").cast("binary"), 256)).alias("groups_sha256")
    return aligned.select("doc_id", *NUMBERS, digest)


def align_documents(docs: DataFrame, tokenizers: Tokenizers = Tokenizers(), settings: AlignSettings = AlignSettings()) -> DataFrame:
    """``docs`` without their ``text``, plus the numbers of their alignment and ``groups`` (``a1,a2|b1;a3|b2``)."""
    return Alignment(docs, tokenizers, settings).aligned()


def pair_counts(docs: DataFrame, tokenizers: Tokenizers = Tokenizers(), settings: AlignSettings = AlignSettings()) -> DataFrame:
    return Alignment(docs, tokenizers, settings).pair_counts()
