"""Bigram language model in Elias-Fano tries, kept and asked shard by shard.

Model: ``p(v | u) = (c(u v) + g p(v)) / (c(u) + g)`` with ``p(v) = (c(v) + 0.5) / (N + 0.5 (V + 1))`` and one ``g`` for all contexts, whatever the size of
the corpus. It sums to 1 over the words and one unknown word. A text's probability is the even mixture of
its bigram and its unigram probability, so a text without known neighbours loses log10(2) at most.

The logarithm splits: the numerator belongs to the pair, ``c(v)`` to the word, the denominator to the context. So the trie is kept by the predicted
word: level 1 holds words and counts, level 2 their preceding words. A shard answers all that concerns its words, and a text's score is the sum of the
answers; no table of the whole vocabulary is needed anywhere.

Trie of a shard: words and contexts are rising hash sequences (Elias-Fano); pointers from words to their contexts are a rising sequence (Elias-Fano);
contexts are numbered inside the shard, and ``word * contexts + context`` is one rising sequence (Elias-Fano) in which a pair is found by successor search
inside its word's bucket. Numerators are quantised to 256 values. A shard is one row of bytes in the shared folder; a task writes it
to an unnamed temporary file and maps it.

Hot words: words above a set share of all tokens (at most ``1 / share`` of them) are known to every task with their counts, and their pairs are spread over the shards by
context. Hot pairs: counts are added up per task first; questions of a shard are salted by the tokens that it holds. Words are 64-bit hashes (one
bit tells frequent from other words).

Defined results: A-Z count as small letters; a NULL or empty text is its end token alone; without training texts every token is unknown and has probability 1;
repeated rows are scored each; NULL ids belong to the training side as ``train`` says (a NULL flag is false); an empty table gives no rows. Columns other
than the id, text and flag are ignored.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tinta.llm.byte_words import NOT_SPACE, _mix, find_words, text_bytes
from tinta.llm.elias_fano import EliasFano
from tinta.llm.group_rows import groups
from tinta.session import scratch_path

# Hashes that stand for the end of a text and the place before its first word.
END, BEGIN = np.uint64(1), np.uint64(2)
OTHER = np.uint64(1 << 63)  # set in the codes of words that are not frequent
RUN_BYTES = 5 << 20


@dataclass(frozen=True)
class ModelSettings:
    """``share``: share of all tokens from which a word is frequent, which is a matter of load alone. ``shard_tokens``: tokens per shard, about.
    ``g``: weight of the unigram model beside the counts of a context."""

    share: float = 1e-6
    shard_tokens: int = 1_500_000
    g: float = 200.0


@dataclass
class Frequent:
    """What every task knows: the frequent words with their counts, and the totals."""

    hashes: np.ndarray  # sorted
    counts: np.ndarray  # in training
    tokens: int
    distinct: int
    texts: int
    shards: int
    settings: ModelSettings

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        """Number of a frequent word, or the hash of another with the highest bit set."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at.astype(np.uint64), hashes | OTHER)

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 0.5) / (self.tokens + 0.5 * (self.distinct + 1))

    def shard(self, words: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        """Shard of a pair: by word, and for frequent words by word and context."""
        key = np.where(words < OTHER, _mix(words * np.uint64(0x9E3779B97F4A7C15) ^ contexts), _mix(words))
        return (key % np.uint64(self.shards)).astype(np.int64)


# ---- tokens


def token_runs(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows of a bounded size (a longer text is a run alone) with the hashes of their tokens and the row of each; an end token closes each text."""
    offsets = text_bytes(batch.column("text"))[1]
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + RUN_BYTES, "right")) - 1)
        part = batch.slice(first, last - first)
        words = find_words(part.column("text"), NOT_SPACE)
        text = words.texts()
        hashes = np.full(len(text) + part.num_rows, END, np.uint64)
        hashes[np.arange(len(text)) + text] = np.maximum(words.hashes() >> np.uint64(1), np.uint64(3))
        yield part, hashes, np.repeat(np.arange(part.num_rows), words.counts + 1)
        first = last


def contexts_of(codes: np.ndarray, rows: np.ndarray, begin: np.uint64) -> np.ndarray:
    before = np.empty_like(codes)
    before[1:] = codes[:-1]
    before[np.concatenate(([True], rows[1:] != rows[:-1]))] = begin
    return before


def count_words(docs: DataFrame, s: ModelSettings) -> Frequent:
    """Totals and frequent words of ``text, train``; the counts of all words are stored, not gathered."""
    spark = docs.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, hashes, rows in token_runs(batch):
                train = part.column("train").to_numpy(zero_copy_only=False)
                words, which = np.unique(hashes, return_inverse=True)
                trained = np.bincount(which, train[rows], len(words)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words.view(np.int64)), pa.array(trained), pa.array(np.bincount(which, minlength=len(words)).astype(np.int64))],
                    names=["word", "trained", "seen"],
                )

    path = scratch_path(spark, "words")
    counted = docs.select("text", "train").mapInArrow(count, "word bigint, trained bigint, seen bigint")
    counted.groupBy("word").agg(F.sum("trained").alias("trained"), F.sum("seen").alias("seen")).write.parquet(path)
    words = spark.read.parquet(path)
    total = words.agg(F.coalesce(F.sum("trained"), F.lit(0)), F.count(F.when(F.col("trained") > 0, 1)), F.coalesce(F.sum("seen"), F.lit(0))).first()
    # at most 1 / share words can have their share
    top = words.where((F.col("seen") >= s.share * total[2]) | (F.col("word") == int(END))).select("word", "trained").toArrow()
    hashes = np.concatenate((top.column("word").to_numpy().view(np.uint64), [END, BEGIN])).astype(np.uint64)
    counts = np.concatenate((top.column("trained").to_numpy(), [0, 0])).astype(np.float64)
    hashes, at = np.unique(hashes, return_index=True)
    counts = counts[at]
    texts = int(counts[hashes == END][0])
    counts[hashes == BEGIN] = texts
    return Frequent(hashes, counts, total[0], total[1], texts, max(1, -(-total[2] // s.shard_tokens)), s)


# ---- arrays as bytes


def to_bytes(*arrays: np.ndarray) -> bytes:
    """Sizes, then the arrays, each beginning at a multiple of eight bytes."""
    head = np.array([len(arrays), *[a.nbytes for a in arrays]], np.int64).tobytes()
    return head + b"".join(a.tobytes() + b"\0" * (-a.nbytes % 8) for a in arrays)


def from_bytes(raw, *kinds: str) -> list[np.ndarray]:
    data = raw if isinstance(raw, np.ndarray) else np.frombuffer(raw, np.uint8)
    n = int(data[:8].view(np.int64)[0])
    sizes, at, out = data[8 : 8 * (n + 1)].view(np.int64).tolist(), 8 * (n + 1), []
    for size, kind in zip(sizes, kinds):
        out.append(data[at : at + size].view(kind))
        at += size + -size % 8
    return out


def squeeze(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unsqueeze(raw: bytes) -> pa.Buffer:
    return pa.decompress(raw[8:], decompressed_size=int.from_bytes(raw[:8], "little"), codec="zstd")


# ---- model


def sorted_pairs(codes: np.ndarray, rows: np.ndarray, known: Frequent) -> tuple[np.ndarray, ...]:
    """``shard, word, context, row`` of all tokens, sorted by the first three."""
    begin = known.codes(np.array([BEGIN]))[0]
    names, which = np.unique(np.append(codes, begin), return_inverse=True)
    word, context = which[:-1], contexts_of(which[:-1].astype(np.uint64), rows, np.uint64(which[-1])).astype(np.int64)
    shard = known.shard(names[word], names[context])
    # the numbers inside a run are small, so all three fit in one sort key if there are not very many shards
    bits = max(1, int(len(names)).bit_length())
    if known.shards.bit_length() + 2 * bits < 63:
        order = np.argsort((((shard << bits) | word) << bits) | context, kind="stable")
    else:
        order = np.lexsort((context, word, shard))
    return shard[order], names[word[order]], names[context[order]], rows[order]


def build_model(docs: DataFrame, s: ModelSettings = ModelSettings()) -> tuple[Frequent, DataFrame]:
    """What every task knows, and the stored table ``shard, asked, trie`` learned from the rows of ``text, train`` with ``train``."""
    spark = docs.sparkSession
    known = count_words(docs, s)
    shared = spark.sparkContext.broadcast(known)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, hashes, rows in token_runs(batch):
                train = part.column("train").to_numpy(zero_copy_only=False)
                shard, word, context, row = sorted_pairs(shared.value.codes(hashes), rows, shared.value)
                new = np.concatenate(([True], (word[1:] != word[:-1]) | (context[1:] != context[:-1]) | (shard[1:] != shard[:-1])))
                first = np.flatnonzero(new)
                count = np.add.reduceat(train[row].astype(np.int64), first)
                asked = np.bincount(shard, minlength=0)
                shard, word, context = shard[first], word[first], context[first]
                held = count > 0
                shard, word, context, count = shard[held], word[held], context[held], count[held]
                cuts = np.searchsorted(shard, np.arange(len(asked) + 1))
                names = np.flatnonzero(asked)
                blobs = [squeeze(to_bytes(word[b:e], context[b:e], count[b:e].astype(np.uint32))) for b, e in zip(cuts[names], cuts[names + 1])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names), pa.array(asked[names]), pa.array(blobs, pa.binary())], names=["shard", "asked", "pairs"]
                )

    def tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ("shard",)):
            parts = [from_bytes(unsqueeze(x), "<u8", "<u8", "<u4") for x in group.column("pairs").to_pylist()]
            word, context, count = (np.concatenate(x) for x in zip(*parts))
            yield pa.RecordBatch.from_arrays(
                [group.column("shard").slice(0, 1), pa.array([int(group.column("asked").to_numpy().sum())]), pa.array([Trie.build(word, context, count, shared.value)], pa.binary())],
                names=["shard", "asked", "trie"],
            )

    blobs = docs.select("text", "train").mapInArrow(pairs, "shard bigint, asked bigint, pairs binary")
    path = scratch_path(spark, "model")
    blobs.repartition(known.shards, "shard").sortWithinPartitions("shard").mapInArrow(tries, "shard bigint, asked bigint, trie binary").write.parquet(path)
    return known, spark.read.parquet(path)


class Trie:
    """Words, their counts, their contexts, and quantised numerators of one shard."""

    @staticmethod
    def build(word: np.ndarray, context: np.ndarray, count: np.ndarray, known: Frequent) -> bytes:
        names, context = np.unique(context, return_inverse=True)
        words, at = np.unique(word, return_inverse=True)
        pair = at.astype(np.uint64) * np.uint64(max(1, len(names))) + context.astype(np.uint64)
        pair, which = np.unique(pair, return_inverse=True)
        count = np.bincount(which, count, len(pair))
        of = (pair // np.uint64(max(1, len(names)))).astype(np.int64)
        totals = np.bincount(of, count, len(words))
        frequent = words < OTHER
        totals[frequent] = known.counts[words[frequent].astype(np.int64)]
        value = np.log10(count + known.settings.g * known.unigram(totals[of]))
        level, book = quantise(value)
        pointers = np.searchsorted(of, np.arange(len(words) + 1))
        parts = [np.array([len(words), len(names), len(pair)], np.int64), totals.astype(np.float64), book, level]
        for sequence, universe in ((words, 1 << 64), (names, 1 << 64), (pointers, len(pair) + 1), (pair, len(words) * max(1, len(names)) + 1)):
            ef = EliasFano.encode(sequence, universe)
            parts += [np.array([ef.n, ef.width, ef.high_parts], np.int64), ef.high, ef.low]
        return to_bytes(*parts)

    def __init__(self, raw: bytes):
        with tempfile.TemporaryFile() as file:  # has no name and goes with the mapping
            file.write(raw)
            file.flush()
            mapped = np.memmap(file, np.uint8, "r")
        kinds = ["<i8", "<f8", "<f8", "u1"] + ["<i8", "<u8", "u1"] * 4
        sizes, self.totals, self.book, self.level, *rest = from_bytes(np.asarray(mapped), *kinds)
        self.contexts_n = max(1, int(sizes[1]))
        self.words, self.contexts, self.pointers, self.pairs = (
            EliasFano.opened(int(h[0]), int(h[1]), low, high, int(h[2])) for h, high, low in zip(rest[0::3], rest[1::3], rest[2::3])
        )

    def ask(self, word: np.ndarray, context: np.ndarray, known: Frequent) -> tuple[np.ndarray, np.ndarray]:
        """Training count of each word, and the logarithm of the numerator of each pair."""
        w = self.words.find(word)
        counts = np.where(w >= 0, self.totals[w] if len(self.totals) else 0.0, 0.0)
        frequent = word < OTHER
        counts[frequent] = known.counts[word[frequent].astype(np.int64)]
        value = np.log10(known.settings.g * known.unigram(counts))
        c = self.contexts.find(context)
        both = np.flatnonzero((w >= 0) & (c >= 0))
        pair = self.pairs.find(w[both].astype(np.uint64) * np.uint64(self.contexts_n) + c[both].astype(np.uint64))
        hit = pair >= 0
        value[both[hit]] = self.book[self.level[pair[hit]]]
        return counts, value

    def children(self, word: int) -> np.ndarray:
        """Places of a word's pairs: the range between its pointers."""
        begin, end = self.pointers.all()[[word, word + 1]]
        return np.arange(int(begin), int(end))


def quantise(values: np.ndarray, levels: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Level of each value and the mean of each level; levels are equally wide, so no value is off by more than a level's width."""
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(levels)
    low, high = values.min(), values.max()
    level = np.minimum((values - low) / max(high - low, 1e-12) * levels, levels - 1).astype(np.int64)
    held = np.bincount(level, minlength=levels)
    return level.astype(np.uint8), np.bincount(level, values, levels) / np.maximum(held, 1)


# ---- scores


def score_texts(docs: DataFrame, known: Frequent, model: DataFrame, s: ModelSettings = ModelSettings()) -> DataFrame:
    """One row per row of ``doc_id, text``: ``n_tokens, n_known, train_tokens, base_score, score``.

    Questions go to the shards; a shard with more questions than ``shard_tokens`` is there several times, and runs of texts are dealt over its copies.
    """
    spark = docs.sparkSession
    # rows of two numbers, one per shard
    salts = dict(model.select("shard", F.ceil(F.col("asked") / s.shard_tokens)).collect())
    table = np.ones(known.shards, np.int64)
    for shard, n in salts.items():
        table[shard] = max(1, n)
    shared = spark.sparkContext.broadcast((known, table))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def questions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, table = shared.value
        part_no, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part, hashes, rows in token_runs(batch):
                first = (part_no << 33) + at
                shard, word, context, row = sorted_pairs(known.codes(hashes), rows, known)
                cuts = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1], [True])))
                names = shard[cuts[:-1]]
                run = int(_mix(np.array([first], np.uint64))[0] >> np.uint64(1))
                blobs = [squeeze(to_bytes(word[b:e], context[b:e], row[b:e].astype(np.uint32))) for b, e in zip(cuts[:-1], cuts[1:])]
                n = len(names)
                # the ids of the run's rows travel once, with its first shard
                ids = pa.array([part.column("doc_id").to_pylist(), *[None] * (n - 1)], pa.list_(part.schema.field("doc_id").type))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names), pa.array(run % table[names]), pa.array(np.full(n, first)), pa.array(np.full(n, part.num_rows)), pa.array(blobs, pa.binary()), ids],
                    names=["shard", "salt", "first", "rows", "asked", "ids"],
                )
                at += part.num_rows

    def answer(key: tuple, asked: pa.Table, held: pa.Table) -> pa.Table:
        """Per run, what this shard adds to each of its rows."""
        known, _ = shared.value
        empty = np.zeros(0, np.uint64)
        trie = Trie(held.column("trie")[0].as_py() if held.num_rows else Trie.build(empty, empty, np.zeros(0), known))
        end, sums = known.codes(np.array([END]))[0], []
        for n, blob in zip(asked.column("rows").to_pylist(), asked.column("asked").to_pylist()):
            word, context, row = from_bytes(unsqueeze(blob), "<u8", "<u8", "<u4")
            counts, value = trie.ask(word, context, known)
            # a word is the context of the word behind it; the end is the context of nothing
            under = np.where(word == end, 0.0, np.log10(counts + known.settings.g))
            base, bigram = (np.bincount(row, x, n) for x in (np.log10(known.unigram(counts)), value - under))
            total, met = np.bincount(row, minlength=n), np.bincount(row, counts > 0, n)
            at = np.flatnonzero(total)
            step = np.diff(at, prepend=0)  # small numbers, which squeeze well
            sums.append(squeeze(to_bytes(step.astype(np.uint32), total[at].astype(np.uint32), met[at].astype(np.uint32), base[at], bigram[at].astype(np.float32))))
        return pa.table([asked.column("first"), asked.column("rows"), pa.array(sums, pa.binary()), asked.column("ids")], names=["first", "rows", "sums", "ids"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The answers of all shards to a run, added up for its rows."""
        for run in groups(batches, ("first",)):
            total = np.zeros((4, run.column("rows")[0].as_py()))
            for sums in run.column("sums"):
                step, *values = from_bytes(unsqueeze(sums.as_py()), "<u4", "<u4", "<u4", "<f8", "<f4")
                at = np.cumsum(step.astype(np.int64))
                for row, value in zip(total, values):
                    row[at] += value
            ids = run.column("ids").drop_null().flatten()
            yield pa.RecordBatch.from_arrays(
                [ids, *[pa.array(x.astype(np.int64)) for x in total[:2]], *map(pa.array, total[2:])], names=["doc_id", "n_tokens", "n_known", "base", "bigram"]
            )

    salt = F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.ceil(F.col("asked") / s.shard_tokens), F.lit(1)) - 1))
    copies = model.select("shard", salt.alias("salt"), "trie")
    asked = docs.select("doc_id", "text").mapInArrow(questions, f"shard bigint, salt bigint, first bigint, rows bigint, asked binary, ids array<{kind}>")
    answers = asked.groupBy("shard", "salt").cogroup(copies.groupBy("shard", "salt")).applyInArrow(
        answer, f"first bigint, rows bigint, sums binary, ids array<{kind}>"
    )
    sums = answers.repartition("first").sortWithinPartitions("first").mapInArrow(
        add, f"doc_id {kind}, n_tokens bigint, n_known bigint, base double, bigram double"
    )
    start = float(np.log10(known.texts + known.settings.g))
    bigram = F.col("bigram") - F.lit(start)
    high, low = F.greatest("base", bigram), F.least("base", bigram)
    mixed = high + F.log10(F.lit(0.5) * (1 + F.pow(F.lit(10.0), low - high)))
    return sums.select(
        "doc_id", "n_tokens", "n_known", F.lit(known.tokens).cast("bigint").alias("train_tokens"), F.col("base").alias("base_score"), mixed.alias("score")
    )
