"""Subword vocabularies and the WordPiece and SentencePiece-style encoders."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tinta.functions.text import pretokenize, rebuild_text, split_words
from tinta.operators.corpus_stats import token_counts
from tinta.session import cut_lineage, small_batches

# Special tokens in id order, and the model names of the comparison table.
WORDPIECE_SPECIALS = ("[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]")
SENTENCEPIECE_SPECIALS = ("<pad>", "</s>", "<unk>")
WORDPIECE_MODEL = "dccuchile/bert-base-spanish-wwm-cased"
SENTENCEPIECE_MODEL = "google-t5/t5-small"

MARKER = "▁"
# Default length of the longest piece, and the limit of WordPiece inference: a longer word is one unknown token.
MAX_PIECE = 8
MAX_WORD = 100
VOCABULARY_SIZE = 2000
COST_SCALE = 1_000_000
UNKNOWN_COST = 10 * COST_SCALE
# Words that a task works on at a time, and the longest word that is cut together with others.
RUN_WORDS = 200_000
BATCH_WORD = 64
# Characters of the words that a task takes apart at a time, about the words of a task, the characters of a stem, and the most stems that are sent along.
RUN_CHARACTERS = 500_000
TASK_WORDS = 100_000
STEM = 3
MOST_STEMS = 1_000_000
# Cells of a table of children that a task may hold.
EDGE_TABLE = 2_000_000


def wordpiece_words(text: Column) -> Column:
    return pretokenize(text)


def sentencepiece_units(text: Column) -> Column:
    """Whitespace units with the word-start marker."""
    return F.transform(split_words(text), lambda unit: F.concat(F.lit(MARKER), unit))


def distinct_words(words: DataFrame) -> DataFrame:
    """``token, count``, spread over the cores and stored: they are read for the short pieces and again for the longer ones."""
    spark = words.sparkSession
    counted = token_counts(words).where(F.length("token") > 0)
    counted = cut_lineage(counted.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return counted.coalesce(max(spark.sparkContext.defaultParallelism, -(-counted.count() // TASK_WORDS)))


def _run_pieces(words: list[str], counts: list[int], shortest: int, longest: int, heads: bool, kept: tuple[np.ndarray, np.ndarray] | None) -> Iterator[pa.RecordBatch]:
    """``piece, count`` of the different pieces of some words, a batch per length; with ``heads``, pieces inside a word are marked.

    ``kept`` holds the stems of words' beginnings and of places inside words; a piece with another stem at any place is left out.
    """
    text, sizes = "".join(words), np.array([len(w) for w in words], np.int64)
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    room = np.repeat(starts + sizes, sizes) - np.arange(len(chars))
    uses = np.repeat(np.array(counts, np.int64), sizes)
    head = np.zeros(len(chars), np.int64)
    head[starts] = 1 if heads else 0
    letters, letter = np.unique(chars, return_inverse=True)
    at = np.flatnonzero(room >= min(shortest, STEM))
    good = np.ones(len(chars), bool)
    if shortest > STEM:
        key = np.zeros(len(chars), np.int64)
        key[at] = (chars[at] << 42) | (chars[at + 1] << 21) | chars[at + 2]
        if kept is not None:
            good[:] = False
            for kind, stems in enumerate(kept):
                mine = at[head[at] == 1 - kind] if heads else at
                good[mine] |= np.isin(key[mine], stems)
            at = at[good[at]]
        code = np.unique(key[at], return_inverse=True)[1] * 2 + head[at]
        begin = STEM + 1
    else:
        code, begin = head[at], 1
    for length in range(begin, longest + 1):
        inside = (room[at] >= length) & good[np.minimum(at + max(0, length - STEM), len(chars) - 1)]
        at, code = at[inside], code[inside]
        _, first, code = np.unique(code * len(letters) + letter[at + length - 1], return_index=True, return_inverse=True)
        if not len(first):
            return
        if length >= shortest:
            total = np.zeros(len(first), np.int64)
            np.add.at(total, code, uses[at])
            inner = heads & (head[at[first]] == 0)
            pieces = ["##" + text[i : i + length] if marked else text[i : i + length] for i, marked in zip(at[first].tolist(), inner.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(pieces, pa.string()), pa.array(total)], names=["piece", "count"])


def _counted_pieces(counted: DataFrame, shortest: int, longest: int, heads: bool, kept: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """``piece, count`` of ``token, count`` for lengths from ``shortest`` (1, or above the stem); equal pieces of a run of words are added up first."""
    shared = counted.sparkSession.sparkContext.broadcast(kept)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts, held = [], [], 0
        for batch in batches:
            for word, n in zip(batch.column("token").to_pylist(), batch.column("count").to_pylist()):
                words.append(word)
                counts.append(n)
                held += len(word)
                if held >= RUN_CHARACTERS:
                    yield from _run_pieces(words, counts, shortest, longest, heads, shared.value)
                    words, counts, held = [], [], 0
        if words:
            yield from _run_pieces(words, counts, shortest, longest, heads, shared.value)

    found = counted.select("token", "count").mapInArrow(count, "piece string, count bigint")
    return found.groupBy("piece").agg(F.sum("count").alias("count"))


def _stems(pieces: list[str]) -> np.ndarray:
    return np.array(sorted((ord(p[0]) << 42) | (ord(p[1]) << 21) | ord(p[2]) for p in pieces), np.int64)


def leading_pieces(counted: DataFrame, size: int, longest: int, single: Column, heads: bool = False, by_length: bool = False) -> tuple[DataFrame, DataFrame]:
    """``piece, count`` of the pieces of up to three characters, and of these and every longer one that can be among the ``size`` first
    ones that are not ``single``: by count, or ``by_length`` by count times length.

    No piece occurs more often than a part of it. The value that stands at place ``size`` among the short pieces is at most the one that
    stands there among all, so a longer piece is counted only if all its stems of three characters reach that value.
    """
    short = cut_lineage(_counted_pieces(counted, 1, min(STEM, longest), heads))
    if longest <= STEM:
        return short, short
    value = F.col("count") * F.length("piece") if by_length else F.col("count")
    least, found = short.where(~single).select(value.alias("v")).orderBy(F.desc("v")).limit(size).agg(F.min("v"), F.count("*")).first()
    kept = None
    # the beginning of a word may look like a marked piece and adds to it: nothing is known from its stems then
    mixed = heads and not counted.where(F.startswith("token", F.lit("##"))).isEmpty()
    if found == size and size > 0 and not mixed:
        marked = F.startswith("piece", F.lit("##")) if heads else F.lit(False)
        reach = F.col("count") * longest if by_length else F.col("count")
        stems = short.where((F.length("piece") - F.when(marked, 2).otherwise(0) == STEM) & (reach >= least)).select("piece", marked.alias("inner"))
        rows = stems.limit(MOST_STEMS + 1).collect()
        if len(rows) <= MOST_STEMS:
            own, inner = [r["piece"] for r in rows if not r["inner"]], [r["piece"][2:] for r in rows if r["inner"]]
            kept = _stems(own), _stems(inner)
    pieces = short.unionByName(_counted_pieces(counted, STEM + 1, longest, heads, kept))
    return short, pieces.groupBy("piece").agg(F.sum("count").alias("count")) if mixed else pieces


def _top_vocabulary(short: DataFrame, counts: DataFrame, single: Column, size: int) -> DataFrame:
    """All single-character pieces, which are among the ``short`` ones, and the ``size`` most frequent longer ones."""
    longer = counts.where(~single).orderBy(F.desc("count"), "piece").limit(size)
    return short.where(single).unionByName(longer)


def wordpiece_vocabulary(words: DataFrame, size: int = VOCABULARY_SIZE, longest: int = MAX_PIECE) -> DataFrame:
    """``piece, count`` from a ``tokens`` column of words: prefixes bare, inner pieces with ``##``.

    Pieces have at most ``longest`` characters; every word counts, whatever its length.
    """
    # "##" itself is no continuation, and neither is a single "#"; a word may begin with "##" and a character: such a piece is single
    single = F.length(F.regexp_replace("piece", r"^##(?=.)", "")) == 1
    return _top_vocabulary(*leading_pieces(distinct_words(words), size, longest, single, heads=True), single, size)


def sentencepiece_vocabulary(units: DataFrame, size: int = VOCABULARY_SIZE, longest: int = MAX_PIECE) -> DataFrame:
    """``piece, count, cost`` from a ``tokens`` column of marked units.

    The cost is the negative log share in whole millionths, so paths add up without rounding.
    """
    single = F.length("piece") == 1
    # read for the total and for the rows
    vocabulary = cut_lineage(_top_vocabulary(*leading_pieces(distinct_words(units), size, longest, single), single, size))
    total = vocabulary.agg(F.sum("count")).scalar()
    cost = F.round(-F.ln(F.col("count") / total) * COST_SCALE).cast("bigint")
    return vocabulary.withColumn("cost", cost)


@dataclass
class Segmenter:
    """Cuts one word into pieces with ids; small enough to be sent with every task.

    ``ids`` is bounded by the vocabulary size plus the single characters. ``costs`` turns greedy
    longest-match WordPiece into the cheapest unigram path.
    """

    ids: dict[str, int]
    unknown: str
    costs: dict[str, int] | None = None
    longest: int = field(init=False)

    def __post_init__(self) -> None:
        self.longest = max((len(piece.removeprefix("##")) for piece in self.ids), default=0)

    def __call__(self, word: str) -> list[str]:
        return self._greedy(word) if self.costs is None else self._cheapest(word)

    def _greedy(self, word: str) -> list[str]:
        if len(word) > MAX_WORD:
            return [self.unknown]
        pieces, at = [], 0
        while at < len(word):
            prefix = "##" if at else ""
            ends = range(min(len(word), at + self.longest), at, -1)
            end = next((e for e in ends if prefix + word[at:e] in self.ids), None)
            if end is None:
                return [self.unknown]
            pieces.append(prefix + word[at:end])
            at = end
        return pieces

    def _cheapest(self, unit: str) -> list[str]:
        """Shortest path over the characters; of equal paths the one with the longest last piece."""
        best = [(0, 0)]
        for end in range(1, len(unit) + 1):
            options = [
                (best[start][0] + self.costs[unit[start:end]], start)
                for start in range(max(0, end - self.longest), end)
                if unit[start:end] in self.costs
            ]
            if unit[end - 1] not in self.costs:
                options.append((best[end - 1][0] + UNKNOWN_COST, end - 1))
            best.append(min(options))
        pieces, end = [], len(unit)
        while end:
            start = best[end][1]
            piece = unit[start:end]
            known = piece in self.costs
            if known or not (pieces and pieces[-1] == self.unknown):
                pieces.append(piece if known else self.unknown)
            end = start
        return pieces[::-1]


def collect_segmenter(vocabulary: DataFrame, specials: tuple[str, ...], unknown: str) -> Segmenter:
    """Bring a vocabulary of bounded size to the driver; ids follow the specials in count order."""
    with_costs = "cost" in vocabulary.columns
    rows = vocabulary.collect()
    ids = {token: i for i, token in enumerate(specials)}
    for row in sorted(rows, key=lambda r: (-(r["count"] or 0), r["piece"].encode())):
        ids.setdefault(row["piece"], len(ids))
    costs = {row["piece"]: row["cost"] for row in rows} if with_costs else None
    return Segmenter(ids, unknown, costs)


def vocabulary_from_pieces(spark: SparkSession, pieces: list[str], counts: list[int] | None = None) -> DataFrame:
    """Vocabulary table from pieces supplied by the caller, such as a pretrained list."""
    weights = counts or list(range(len(pieces), 0, -1))
    return spark.createDataFrame(list(zip(pieces, weights, strict=True)), "piece string, count bigint")


@dataclass
class Trie:
    """Pieces by their characters: an edge is a node and a character in one number. Children are a table by edge if that is small, else they
    are found among the sorted edges, so any alphabet fits. No child is the root."""

    alphabet: np.ndarray
    edges: np.ndarray
    children: np.ndarray
    piece: np.ndarray  # code of the piece that ends at a node, or -1
    table: np.ndarray | None

    @classmethod
    def of(cls, pieces: dict[str, int]) -> Trie:
        alphabet = sorted({ord(c) for piece in pieces for c in piece})
        place = {chr(c): i for i, c in enumerate(alphabet)}
        edges: dict[int, int] = {}
        codes = [-1]
        for piece, code in pieces.items():
            node = 0
            for c in piece:
                edge = node * (len(alphabet) + 1) + place[c]
                if edge not in edges:
                    edges[edge] = len(codes)
                    codes.append(-1)
                node = edges[edge]
            codes[node] = code
        order = sorted(edges)
        last = [np.iinfo(np.int64).max]  # no lookup runs over the end
        children, table = np.array([edges[e] for e in order] + [0]), None
        if len(codes) * (len(alphabet) + 1) <= EDGE_TABLE:
            table = np.zeros(len(codes) * (len(alphabet) + 1), np.int64)
            table[order] = children[:-1]
        return cls(np.array(alphabet + [1 << 32]), np.array(order + last), children, np.array(codes), table)

    def _child(self, edge: np.ndarray) -> np.ndarray:
        if self.table is not None:
            return self.table[edge]
        place = np.searchsorted(self.edges, edge)
        return np.where(self.edges[place] == edge, self.children[place], 0)

    def matches(self, chars: np.ndarray, room: np.ndarray, longest: int) -> list[np.ndarray]:
        """For each length from 1 the codes of the pieces that begin at each character, -1 where there is none."""
        letters = np.searchsorted(self.alphabet, chars)
        letters[self.alphabet[letters] != chars] = len(self.alphabet) - 1
        at, node, found = np.arange(len(chars)), np.zeros(len(chars), np.int64), []
        for length in range(1, longest + 1):
            inside = room[at] >= length
            at, node = at[inside], node[inside]
            edge = node * len(self.alphabet) + letters[at + length - 1]
            child = self._child(edge)
            at, node = at[child > 0], child[child > 0]
            codes = np.full(len(chars), -1, np.int32)
            codes[at] = self.piece[node]
            found.append(codes)
        return found


class BatchCutter:
    """The cuts of a ``Segmenter`` for many words at once, as codes of ``names``; one place of all words is worked on at a time."""

    def __init__(self, segmenter: Segmenter) -> None:
        self.segmenter = segmenter
        self.names = list(dict.fromkeys([*segmenter.ids, *(segmenter.costs or {}), segmenter.unknown]))
        self.codes = {name: i for i, name in enumerate(self.names)}
        self.unknown = self.codes[segmenter.unknown]
        fits = {n: c for n, c in self.codes.items() if 0 < len(n) <= segmenter.longest}
        if segmenter.costs is None:
            self.first = Trie.of({n: c for n, c in fits.items() if n in segmenter.ids})
            self.inner = Trie.of({n[2:]: c for n, c in self.codes.items() if n in segmenter.ids and n.startswith("##") and n != "##"})
        else:
            self.trie = Trie.of({n: c for n, c in fits.items() if n in segmenter.costs})
            self.cost = np.array([segmenter.costs.get(n, 0) for n in self.names], np.int64)

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all words in one array, and how many each word has."""
        sizes = np.array([len(w) for w in words], np.int64)
        short = np.flatnonzero((sizes > 0) & (sizes <= BATCH_WORD))
        short = short[np.argsort(-sizes[short], kind="stable")]  # words that reach a place are a prefix
        counts = np.zeros(len(words), np.int64)
        steps: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(short):
            text = "".join([words[i] for i in short]).encode("utf-32-le", "surrogatepass")
            cut = self._greedy if self.segmenter.costs is None else self._cheapest
            steps, counts[short] = cut(np.frombuffer(text, np.uint32).astype(np.int64), sizes[short])
        plain = {int(i): [self.codes[p] for p in self.segmenter(words[i])] for i in np.flatnonzero(sizes > BATCH_WORD)}
        for i, codes in plain.items():
            counts[i] = len(codes)
        begin = np.cumsum(counts) - counts
        out = np.zeros(int(counts.sum()), np.int32)
        for rows, places, codes in steps:
            out[begin[short[rows]] + places] = codes
        for i, codes in plain.items():
            out[begin[i] : begin[i] + len(codes)] = codes
        return out, counts

    def _greedy(self, chars: np.ndarray, sizes: np.ndarray):
        starts = np.cumsum(sizes) - sizes
        room = np.repeat(starts + sizes, sizes) - np.arange(len(chars))
        head = np.zeros(len(chars), bool)
        head[starts] = True
        code, length = np.full(len(chars), -1, np.int32), np.zeros(len(chars), np.int64)
        longest = self.segmenter.longest
        for n, (first, inner) in enumerate(zip(self.first.matches(chars, room, longest), self.inner.matches(chars, room, longest)), 1):
            here = np.where(head, first, inner)
            code, length = np.where(here >= 0, here, code), np.where(here >= 0, n, length)
        steps, counts = [], np.zeros(len(sizes), np.int64)
        rows, at = np.arange(len(sizes)), starts.copy()
        failed = np.zeros(len(sizes), bool)
        while len(rows):
            known = code[at] >= 0
            failed[rows[~known]] = True
            rows, at = rows[known], at[known]
            steps.append((rows, counts[rows], code[at]))
            counts[rows] += 1
            at = at + length[at]
            left = at < starts[rows] + sizes[rows]
            rows, at = rows[left], at[left]
        lost = np.flatnonzero(failed)
        counts[lost] = 1
        kept = [(r[~failed[r]], p[~failed[r]], c[~failed[r]]) for r, p, c in steps]
        return [*kept, (lost, np.zeros(len(lost), np.int64), np.full(len(lost), self.unknown, np.int32))], counts

    def _cheapest(self, chars: np.ndarray, sizes: np.ndarray):
        starts = np.cumsum(sizes) - sizes
        room = np.repeat(starts + sizes, sizes) - np.arange(len(chars))
        longest = max(1, self.segmenter.longest)
        found = self.trie.matches(chars, room, longest)
        none = np.iinfo(np.int64).max // 4
        costs = [np.where(codes >= 0, self.cost[codes], none) for codes in found]
        costs[0] = np.where(found[0] >= 0, costs[0], UNKNOWN_COST)
        # a word of n characters has n + 1 places
        base = starts + np.arange(len(sizes))
        best, taken = np.zeros(len(chars) + len(sizes), np.int64), np.zeros(len(chars) + len(sizes), np.int64)
        for end in range(1, int(sizes[0]) + 1):
            n = int(np.searchsorted(-sizes, -end, side="right"))
            least, by = np.full(n, none), np.ones(n, np.int64)
            for length in range(min(longest, end), 0, -1):  # of equal paths the one with the longest last piece
                path = best[base[:n] + end - length] + costs[length - 1][starts[:n] + end - length]
                by = np.where(path < least, length, by)
                least = np.minimum(path, least)
            best[base[:n] + end], taken[base[:n] + end] = least, by
        lengths = np.stack(found)
        steps, counts = [], np.zeros(len(sizes), np.int64)
        rows, at, before = np.arange(len(sizes)), sizes.copy(), np.full(len(sizes), -1)
        while len(rows):  # from the end of each word
            length = taken[base[rows] + at]
            at = at - length
            code = lengths[length - 1, starts[rows] + at]
            known = code >= 0
            code = np.where(known, code, self.unknown)
            new = known | (before != self.unknown)
            steps.append((rows[new], counts[rows[new]], code[new]))
            counts[rows[new]] += 1
            left = at > 0
            rows, at, before = rows[left], at[left], code[left]
        return [(r, counts[r] - 1 - p, c) for r, p, c in steps], counts


@dataclass
class Encoding:
    """One encoding of a row: the column of its words, the special tokens around it, the prefix of its columns."""

    words: Column
    segmenter: Segmenter
    first: tuple[str, ...] = ()
    last: tuple[str, ...] = ()
    prefix: str = ""


def _code_rows(words: pa.ListArray, cutter: BatchCutter, first: list[int], last: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the rows and the codes of their pieces between the special tokens."""
    flat = words.flatten().dictionary_encode()
    codes, counts = cutter(flat.dictionary.to_pylist())
    begin, picked = np.cumsum(counts) - counts, flat.indices.to_numpy(zero_copy_only=False)
    sizes = counts[picked]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    pieces = codes[np.repeat(begin[picked] - ends[:-1], sizes) + np.arange(ends[-1])]
    borders = ends[np.concatenate([[0], np.cumsum(words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])]
    lengths = np.diff(borders)
    offsets = np.concatenate([[0], np.cumsum(lengths + len(first) + len(last))])
    out = np.empty(offsets[-1], np.int32)
    out[np.repeat(offsets[:-1] + len(first) - borders[:-1], lengths) + np.arange(borders[-1])] = pieces
    for i, code in enumerate(first):
        out[offsets[:-1] + i] = code
    for i, code in enumerate(last):
        out[offsets[1:] - len(last) + i] = code
    return offsets, out


def _row_runs(batch: pa.RecordBatch, columns: list[str]) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``RUN_WORDS`` words, or one row."""
    sizes = sum(batch.column(c).value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns)
    ends, at = np.cumsum(sizes), 0
    while at < batch.num_rows:
        room = RUN_WORDS + (ends[at - 1] if at else 0)
        end = max(at + 1, int(np.searchsorted(ends, room, side="right")))
        yield batch.slice(at, end - at)
        at = end


def encode_all(df: DataFrame, encodings: list[Encoding], ids: bool = True) -> DataFrame:
    """Add ``tokens`` and, with ``ids``, ``input_ids, attention_mask`` of each encoding: pieces of the words between special tokens.

    A narrow map: words are found in the JVM, and a task cuts each distinct word of a run of rows once, so
    nothing is shuffled and a word that fills the corpus costs one lookup. What a task holds is bounded by the
    words of a run, not by its rows.
    """
    small_batches(df.sparkSession)
    names = [f"_words{i}" for i in range(len(encodings))]
    shared = df.sparkSession.sparkContext.broadcast([e.segmenter for e in encodings])
    specials = [(e.first, e.last) for e in encodings]
    kept = df.columns

    def map_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutters = [BatchCutter(s) for s in shared.value]
        pieces = [pa.array(c.names, pa.string()) for c in cutters]
        numbers = [np.array([c.segmenter.ids.get(n, c.segmenter.ids[c.segmenter.unknown]) for n in c.names], np.int32) for c in cutters]
        for batch in batches:
            for run in _row_runs(batch, names):
                columns = run.columns[: len(kept)]
                for i, cutter in enumerate(cutters):
                    first, last = ([cutter.codes[t] for t in tokens] for tokens in specials[i])
                    offsets, codes = _code_rows(run.column(len(kept) + i), cutter, first, last)
                    borders = pa.array(offsets, pa.int32())
                    columns.append(pa.ListArray.from_arrays(borders, pieces[i].take(pa.array(codes))))
                    if ids:
                        columns.append(pa.ListArray.from_arrays(borders, pa.array(numbers[i][codes])))
                yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])

    # columns go through by place, whatever their names
    fields = [T.StructField(f"c{i}", f.dataType) for i, f in enumerate(df.schema.fields)]
    added = []
    for e in encodings:
        added.append((f"{e.prefix}tokens", T.ArrayType(T.StringType())))
        if ids:
            added.append((f"{e.prefix}input_ids", T.ArrayType(T.IntegerType())))
    schema = T.StructType(fields + [T.StructField(f"c{len(kept) + i}", kind) for i, (_, kind) in enumerate(added)])
    sent = df.withColumns({name: e.words for name, e in zip(names, encodings)}).toDF(*[f.name for f in fields], *names)
    new = [name for name, _ in added]
    coded = sent.mapInArrow(map_runs, schema)
    back = [F.col(f"c{i}").alias(c) for i, c in enumerate(kept) if c not in new] + [F.col(f"c{len(kept) + i}").alias(c) for i, c in enumerate(new)]
    coded = coded.select(*back)
    if not ids:
        return coded
    return coded.withColumns({f"{e.prefix}attention_mask": F.array_repeat(F.lit(1), F.size(f"{e.prefix}tokens")) for e in encodings})


def encode(
    df: DataFrame,
    words: Column,
    segmenter: Segmenter,
    first: tuple[str, ...] = (),
    last: tuple[str, ...] = (),
    prefix: str = "",
) -> DataFrame:
    """Add ``tokens, input_ids, attention_mask``: pieces of the words between special tokens."""
    return encode_all(df, [Encoding(words, segmenter, first, last, prefix)])


def wordpiece_segmenter(df: DataFrame, text: str = "text", size: int = VOCABULARY_SIZE) -> Segmenter:
    words = df.select(wordpiece_words(F.col(text)).alias("tokens"))
    return collect_segmenter(wordpiece_vocabulary(words, size), WORDPIECE_SPECIALS, "[UNK]")


def sentencepiece_segmenter(df: DataFrame, text: str = "text", size: int = VOCABULARY_SIZE) -> Segmenter:
    units = df.select(sentencepiece_units(F.col(text)).alias("tokens"))
    return collect_segmenter(sentencepiece_vocabulary(units, size), SENTENCEPIECE_SPECIALS, "<unk>")


def wordpiece_encoding(text: Column, segmenter: Segmenter, prefix: str = "") -> Encoding:
    return Encoding(wordpiece_words(text), segmenter, ("[CLS]",), ("[SEP]",), prefix)


def sentencepiece_encoding(text: Column, segmenter: Segmenter, prefix: str = "") -> Encoding:
    return Encoding(sentencepiece_units(text), segmenter, (), ("</s>",), prefix)


def encode_wordpiece(df: DataFrame, segmenter: Segmenter, text: str = "text", prefix: str = "") -> DataFrame:
    return encode_all(df, [wordpiece_encoding(F.col(text), segmenter, prefix)])


def encode_sentencepiece(df: DataFrame, segmenter: Segmenter, text: str = "text", prefix: str = "") -> DataFrame:
    return encode_all(df, [sentencepiece_encoding(F.col(text), segmenter, prefix)])


# Columns of the comparison table.
COMPARISON_COLUMNS = (
    "dataset",
    "split",
    "example_index",
    "source_sentence_id",
    "source_file",
    "text",
    "original_tokens",
    "beto_model",
    "beto_tokens",
    "beto_token_count",
    "t5_model",
    "t5_tokens",
    "t5_token_count",
)


def compare_tokenizers(
    examples: DataFrame, wordpiece: Segmenter, sentencepiece: Segmenter, tokens: str = "original_tokens"
) -> DataFrame:
    """Both encodings of the text rebuilt from each example's tokens, side by side.

    Both are computed in the example's own row, so the sides need no join and cannot lose rows.
    """
    rebuilt = examples.withColumn("text", rebuild_text(F.col(tokens)))
    text = F.col("text")
    coded = encode_all(rebuilt, [wordpiece_encoding(text, wordpiece, "beto_"), sentencepiece_encoding(text, sentencepiece, "t5_")], ids=False)
    return coded.withColumns(
        {
            "beto_model": F.lit(WORDPIECE_MODEL),
            "t5_model": F.lit(SENTENCEPIECE_MODEL),
            "beto_token_count": F.size("beto_tokens").cast("bigint"),
            "t5_token_count": F.size("t5_tokens").cast("bigint"),
        }
    ).select(*COMPARISON_COLUMNS)


def join_tokenized(examples: DataFrame, wordpiece: DataFrame, sentencepiece: DataFrame) -> DataFrame:
    """Comparison of outputs encoded elsewhere, matched on ``dataset, split, example_index``.

    ``wordpiece`` and ``sentencepiece`` hold those keys and ``tokens``. An example without its
    partner is an error, as is any output without its example.
    """
    keys = ["dataset", "split", "example_index"]
    sides = {"beto": wordpiece, "t5": sentencepiece}
    # sizes and text are worked out before the joins, so that lists that nobody reads are not moved
    original = F.col("original_tokens")
    joined = examples.withColumns({"text": rebuild_text(original), "_original": original.isNotNull()})
    for name, side in sides.items():
        size = F.when(F.col("tokens").isNotNull(), F.size("tokens").cast("bigint"))
        counted = side.select(*keys, F.col("tokens").alias(f"{name}_tokens"), size.alias(f"{name}_token_count"))
        joined = joined.join(counted, keys, "full_outer")
    complete = F.coalesce("_original", F.lit(False))
    for name in sides:
        complete = complete & F.col(f"{name}_token_count").isNotNull()

    def checked(column: str) -> Column:
        failed = F.raise_error(F.lit("examples and tokenizer outputs differ in number"))
        return F.when(complete, F.col(column)).otherwise(failed.cast(joined.schema[column].dataType))

    columns = [c for c in joined.columns if c not in ("text", "_original", "beto_token_count", "t5_token_count")]
    return joined.withColumns({"original_tokens": checked("original_tokens"), "text": checked("text")}).select(
        *columns, "text", "beto_token_count", "t5_token_count"
    )
