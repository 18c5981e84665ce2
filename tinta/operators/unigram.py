"""A unigram subword vocabulary trained by expectation-maximisation over the distinct words of a corpus.

A word's probability is the sum over all its segmentations of the product of the pieces' probabilities. A round works out, by a forward and a backward
pass over each distinct word, how often each piece is expected to be used, adds that up by piece, and takes the shares as the new
probabilities: the likelihood of the corpus never falls. Between rounds the pieces that cost the least when they are replaced by their own
best segmentation go, until the wanted size is left. Single characters always stay, so every word can be cut.

Words stay a table; the pieces, of a bounded number, go to the tasks.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tinta.operators.subword import BATCH_WORD, COST_SCALE, MAX_PIECE, RUN_CHARACTERS, VOCABULARY_SIZE, Trie, distinct_words, leading_pieces

SEEDS = 4  # times the wanted size
ROUNDS = 2  # between two cuts
SHRINK = 0.75
LEAST_USE = 1e-9  # expected uses of a single character that no segmentation needs


@dataclass
class UnigramTraining:
    """``pieces``: piece to logarithm of its probability; ``expected``: its expected uses in the last round; ``likelihoods``: logarithms of the
    likelihood at the start of each round, grouped by the vocabularies between two cuts."""

    pieces: dict[str, float]
    expected: dict[str, float]
    likelihoods: list[list[float]]


def forward_backward(word: str, pieces: dict[str, float], longest: int) -> tuple[float, list[tuple[str, float]]]:
    """Logarithm of a word's probability, and each piece at each place with the chance that it is used there."""
    n = len(word)
    arcs = [(s, e, pieces[word[s:e]]) for e in range(1, n + 1) for s in range(max(0, e - longest), e) if word[s:e] in pieces]
    into: list[list] = [[] for _ in range(n + 1)]
    out: list[list] = [[] for _ in range(n + 1)]
    for s, e, p in arcs:
        into[e].append((s, p))
        out[s].append((e, p))

    def total(terms: list[float]) -> float:
        most = max(terms, default=-math.inf)
        return most if most == -math.inf else most + math.log(sum(math.exp(t - most) for t in terms))

    ahead, back = [0.0] + [0.0] * n, [0.0] * (n + 1)
    for e in range(1, n + 1):
        ahead[e] = total([ahead[s] + p for s, p in into[e]])
    for s in range(n - 1, -1, -1):
        back[s] = total([back[e] + p for e, p in out[s]])
    whole = ahead[n]
    return whole, [(word[s:e], math.exp(ahead[s] + p + back[e] - whole)) for s, e, p in arcs]


def best_without(piece: str, pieces: dict[str, float], longest: int) -> float:
    """Logarithm of the best segmentation of a piece into other pieces."""
    best = [0.0]
    for e in range(1, len(piece) + 1):
        options = (best[s] + pieces[piece[s:e]] for s in range(max(0, e - longest), e) if piece[s:e] in pieces and e - s < len(piece))
        best.append(max(options, default=-math.inf))
    return best[-1]


def _log_sum(options: list[np.ndarray]) -> np.ndarray:
    stacked = np.stack(options)
    most = stacked.max(axis=0)
    most = np.where(np.isfinite(most), most, 0.0)
    with np.errstate(divide="ignore"):
        return most + np.log(np.exp(stacked - most).sum(axis=0))


def batch_uses(words: list[str], counts: np.ndarray, trie: Trie, shares: np.ndarray, longest: int) -> tuple[np.ndarray, float]:
    """Expected uses of the pieces by their codes and the logarithm of the likelihood: ``forward_backward`` for many words, a place of all at once."""
    sizes = np.array([len(w) for w in words], np.int64)
    order = np.argsort(-sizes, kind="stable")  # words that reach a place are a prefix
    sizes, counts = sizes[order], counts[order]
    chars = np.frombuffer("".join([words[i] for i in order]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    found = trie.matches(chars, np.repeat(starts + sizes, sizes) - np.arange(len(chars)), longest)
    logs = [np.where(codes >= 0, shares[codes], -np.inf) for codes in found]
    # a word of n characters has n + 1 places
    base, word = starts + np.arange(len(sizes)), np.repeat(np.arange(len(sizes)), sizes)
    ahead, back = np.zeros(len(chars) + len(sizes)), np.zeros(len(chars) + len(sizes))
    for step in range(1, int(sizes[0]) + 1):
        n = int(np.searchsorted(-sizes, -step, side="right"))
        first, place, lengths = starts[:n], base[:n], range(1, min(longest, step) + 1)
        ahead[place + step] = _log_sum([ahead[place + step - m] + logs[m - 1][first + step - m] for m in lengths])
        at = sizes[:n] - step
        back[place + at] = _log_sum([back[place + at + m] + logs[m - 1][first + at] for m in lengths])
    whole = ahead[base + sizes]
    uses = np.zeros(len(shares))
    for m, codes in enumerate(found, 1):
        arc = np.flatnonzero(codes >= 0)
        place, of = arc + word[arc], word[arc]
        chance = np.exp(ahead[place] + logs[m - 1][arc] + back[place + m] - whole[of])
        uses += np.bincount(codes[arc], weights=counts[of] * chance, minlength=len(shares))
    return uses, float((counts * whole).sum())


def expected_uses(words: DataFrame, pieces: dict[str, float], longest: int) -> tuple[dict[str, float], float]:
    """Expected uses of every piece in ``token, count``, and the logarithm of the likelihood."""
    shared = words.sparkSession.sparkContext.broadcast(pieces)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, shares = list(shared.value), np.array(list(shared.value.values()))
        code = {name: i for i, name in enumerate(names)}
        trie = Trie.of(code)
        total, likelihood, some = np.zeros(len(names)), 0.0, False
        for batch in batches:
            sizes = pc.utf8_length(batch.column("token")).to_numpy(zero_copy_only=False)
            tokens, counts = batch.column("token"), batch.column("count").to_numpy(zero_copy_only=False).astype(np.float64)
            runs = np.cumsum(sizes) // RUN_CHARACTERS
            for run in np.unique(runs):
                mine = np.flatnonzero((runs == run) & (sizes <= BATCH_WORD))
                if len(mine):
                    uses, more = batch_uses(tokens.take(pa.array(mine)).to_pylist(), counts[mine], trie, shares, longest)
                    total, likelihood, some = total + uses, likelihood + more, True
            for i in np.flatnonzero(sizes > BATCH_WORD):
                whole, found = forward_backward(tokens[i].as_py(), shared.value, longest)
                likelihood, some = likelihood + counts[i] * whole, True
                for piece, chance in found:
                    total[code[piece]] += counts[i] * chance
        if some:
            used = np.flatnonzero(total)
            # the row without a piece is the likelihood
            yield pa.RecordBatch.from_arrays([pa.array([None, *(names[i] for i in used)], pa.string()), pa.array([likelihood, *total[used]])], names=["piece", "uses"])

    # at most a row per piece and task, added up per piece
    rows = words.mapInArrow(count, "piece string, uses double").groupBy("piece").agg(F.sum("uses").alias("uses")).collect()
    found = {r["piece"]: r["uses"] for r in rows}
    return found, found.pop(None, 0.0)


def _shares(uses: dict[str, float]) -> dict[str, float]:
    total = math.fsum(uses.values())
    return {p: math.log(n / total) for p, n in uses.items() if n > 0}


def train_unigram(
    units: DataFrame, size: int = VOCABULARY_SIZE, longest: int = MAX_PIECE, rounds: int = ROUNDS, shrink: float = SHRINK, seeds: int | None = None
) -> UnigramTraining:
    """Pieces of a ``tokens`` column of marked units: all single characters and ``size`` longer ones (all there are if fewer)."""
    words, wanted = distinct_words(units), seeds or SEEDS * size
    short, counts = leading_pieces(words, wanted, longest, F.length("piece") == 1, by_length=True)
    single = {r["piece"]: float(r["count"]) for r in short.where(F.length("piece") == 1).collect()}
    # frequent and long pieces first
    longer = counts.where(F.length("piece") > 1).orderBy(F.desc(F.col("count") * F.length("piece")), "piece").limit(wanted)
    uses = single | {r["piece"]: float(r["count"]) for r in longer.collect()}
    if not uses:
        return UnigramTraining({}, {}, [])
    pieces, likelihoods = _shares(uses), []
    while True:
        told = []
        for _ in range(rounds):
            uses, likelihood = expected_uses(words, pieces, longest)
            told.append(likelihood)
            pieces = _shares({p: max(uses.get(p, 0.0), LEAST_USE) if len(p) == 1 else uses.get(p, 0.0) for p in pieces})
        likelihoods.append(told)
        long = [p for p in pieces if len(p) > 1]
        if len(long) <= size:
            return UnigramTraining(pieces, uses, likelihoods)
        keep = max(size, int(len(long) * shrink))
        loss = {p: uses[p] * (pieces[p] - best_without(p, pieces, longest)) for p in long}
        kept = set(heapq.nsmallest(keep, long, key=lambda p: (-loss[p], p)))
        pieces = _shares({p: max(uses.get(p, 0.0), LEAST_USE) for p in pieces if len(p) == 1 or p in kept})


def unigram_vocabulary(units: DataFrame, size: int = VOCABULARY_SIZE, longest: int = MAX_PIECE) -> DataFrame:
    """``piece, count, cost`` as the encoder takes them: expected uses in whole numbers, and the negative logarithm of the share in whole millionths."""
    trained = train_unigram(units, size, longest)
    rows = [(p, round(trained.expected.get(p, 0.0)), round(-share * COST_SCALE)) for p, share in trained.pieces.items()]
    return units.sparkSession.createDataFrame(rows, "piece string, count bigint, cost bigint")
