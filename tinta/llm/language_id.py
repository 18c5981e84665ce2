"""Language identification by a byte convolutional network: filters of several widths, max pooling, softmax.

The network is trained in numpy on windows of labelled texts and applied to every fixed-length window of whole texts.
A text's probabilities are the mean over its windows, weighted by their bytes.

Training uses a sample bounded by ``Training.per_language`` windows per label and ``Training.most_windows`` in all:
one window per document, at a place drawn from its id, smallest digests first. Prediction reads every byte.

Defined results: NULL texts and texts without a letter are ``und`` with score 0, and so is every text if nothing was
learned; ties go to the first label; repeated rows get a row each; an empty table gives no rows. The columns of the
documents are kept; ``lang_pred`` and ``score`` are replaced if they exist.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tinta.llm.byte_words import LOWER, runs_of_rows, small_batches, text_bytes

UNKNOWN = "und"
WIDTHS = (2, 3, 4)
SCAN_WINDOWS = 512
FOLD = LOWER.astype(np.uint8)  # capital letters read as small ones


@dataclass(frozen=True)
class Training:
    per_language: int = 1500
    most_windows: int = 60_000
    window: int = 256
    filters: int = 8
    embedding: int = 8
    epochs: int = 6
    batch: int = 64
    rate: float = 0.01
    seed: int = 7


@dataclass
class ByteNet:
    """Trained weights. ``filters`` filters for each of the widths."""

    labels: list[str]
    window: int
    embedding: np.ndarray  # 256 x E
    kernels: list[np.ndarray]  # width*E x filters, one per width
    biases: np.ndarray  # filters of all widths
    dense: np.ndarray  # all filters x labels
    offset: np.ndarray

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The filters as sums of looked-up rows: by byte pair, by the third byte, and by the pair after the first two."""
        e, f = self.embedding.shape[1], self.kernels[0].shape[1]
        by_byte = lambda kernel, k: self.embedding @ kernel[k * e : (k + 1) * e]  # noqa: E731  256 x filters
        pair = lambda kernel, k: (by_byte(kernel, k)[:, None] + by_byte(kernel, k + 1)[None]).reshape(-1, f)
        two, three, four = self.kernels
        first = np.concatenate((pair(two, 0), pair(three, 0), pair(four, 0)), axis=1) + self.biases
        return tuple(np.ascontiguousarray(t, np.float32) for t in (first, by_byte(three, 2), pair(four, 2)))


def windows_of(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, window: int) -> np.ndarray:
    """Rows of ``window`` bytes with zeros behind their end."""
    rows = np.arange(window)[None, :]
    at = starts[:, None] + rows
    inside = rows < sizes[:, None]
    return np.where(inside, FOLD[data[np.minimum(at, len(data) - 1)]], 0).astype(np.uint8)


def train(texts: list[str], labels: list[str], settings: Training) -> ByteNet:
    """Adam on the cross entropy; a window is cut to a random length so that short texts are learned too."""
    rng = np.random.default_rng(settings.seed)
    names = sorted(set(labels))
    target = np.searchsorted(names, labels)
    e, f, w = settings.embedding, settings.filters, settings.window
    emb = rng.normal(0, 0.5, (256, e)).astype(np.float32)
    kernels = [rng.normal(0, (2 / (k * e)) ** 0.5, (k * e, f)).astype(np.float32) for k in WIDTHS]
    biases = np.zeros(f * len(WIDTHS), np.float32)
    dense = rng.normal(0, 0.1, (f * len(WIDTHS), len(names))).astype(np.float32)
    offset = np.zeros(len(names), np.float32)
    weights = [emb, *kernels, biases, dense, offset]
    moments = [(np.zeros_like(x), np.zeros_like(x)) for x in weights]
    raw = [t.encode()[:w] for t in texts]
    data, step = np.frombuffer(b"".join(raw) or b"\0", np.uint8), 0
    sizes = np.array([len(r) for r in raw])
    starts = np.cumsum(sizes) - sizes
    weight = len(target) / (len(names) * np.bincount(target, minlength=len(names)))
    for _ in range(settings.epochs):
        shuffled = rng.permutation(len(raw))
        for begin in range(0, len(raw), settings.batch):
            rows = shuffled[begin : begin + settings.batch]
            size = np.where(rng.random(len(rows)) < 0.4, np.minimum(sizes[rows], rng.integers(12, w, len(rows))), sizes[rows])
            x = windows_of(data, starts[rows], size, w)
            grads = _gradients(x, target[rows], weight[target[rows]], weights)
            step += 1
            for value, grad, (m, v) in zip(weights, grads, moments):
                m *= 0.9
                m += 0.1 * grad
                v *= 0.999
                v += 0.001 * grad * grad
                value -= settings.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return ByteNet(names, w, emb, kernels, biases, dense, offset)


def _gradients(x: np.ndarray, target: np.ndarray, weight: np.ndarray, weights: list[np.ndarray]) -> list[np.ndarray]:
    emb, *kernels, biases, dense, offset = weights
    e, f = emb.shape[1], kernels[0].shape[1]
    n, w = x.shape
    looked = emb[x]
    # every width reads the same places, as the lookup tables do; the last places see padding
    looked = np.concatenate((looked, np.broadcast_to(emb[0], (n, max(WIDTHS) - 1, e))), axis=1)
    best, pooled = [], []
    for width, kernel, bias in zip(WIDTHS, kernels, np.split(biases, len(WIDTHS))):
        cut = np.concatenate([looked[:, k : k + w] for k in range(width)], axis=2)
        out = cut.reshape(n * w, -1) @ kernel
        at = out.reshape(n, w, f).argmax(axis=1)
        best.append(at)
        pooled.append(np.take_along_axis(out.reshape(n, w, f), at[:, None], axis=1)[:, 0] + bias)
    z = np.concatenate(pooled, axis=1)
    hidden = np.maximum(z, 0)
    logits = hidden @ dense + offset
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    d = p
    d[np.arange(n), target] -= 1
    d *= (weight / n)[:, None].astype(np.float32)
    d_z = (d @ dense.T) * (z > 0)
    d_emb, d_kernels = np.zeros_like(emb), []
    padded = np.concatenate((x, np.zeros((n, max(WIDTHS) - 1), np.uint8)), axis=1)
    rows = np.arange(n)[:, None]
    for i, (width, kernel) in enumerate(zip(WIDTHS, kernels)):
        g, d_kernel = d_z[:, i * f : (i + 1) * f], np.zeros_like(kernel)
        for k in range(width):
            places = best[i] + k
            seen = looked[rows, places]  # n x filters x e
            d_kernel[k * e : (k + 1) * e] = np.einsum("nf,nfe->ef", g, seen)
            np.add.at(d_emb, padded[rows, places], g[:, :, None] * kernel[k * e : (k + 1) * e].T[None])
        d_kernels.append(d_kernel)
    return [d_emb, *d_kernels, d_z.sum(axis=0), hidden.T @ d, d.sum(axis=0)]


def window_probabilities(x: np.ndarray, net: ByteNet, tables: tuple[np.ndarray, ...]) -> np.ndarray:
    """Softmax of each window, by looked-up rows instead of products."""
    first, third, after = tables
    f = third.shape[1]
    n, w = x.shape
    padded = np.zeros((n, w + 4), np.int32)
    padded[:, :w] = x
    pair = padded[:, :-1] * 256 + padded[:, 1:]
    out = first[pair[:, :w].reshape(-1)]
    out[:, f : 2 * f] += third[padded[:, 2 : w + 2].reshape(-1)]
    out[:, 2 * f :] += after[pair[:, 2 : w + 2].reshape(-1)]
    hidden = np.maximum(out.reshape(n, w, 3 * f).max(axis=1), 0)
    logits = hidden @ net.dense + net.offset
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def classify(column: pa.Array, net: ByteNet, tables: tuple[np.ndarray, ...]) -> tuple[list[str], np.ndarray]:
    """Label and score of each text of a batch, over all its windows in runs of bounded size."""
    data, offsets = text_bytes(column)
    sizes = np.diff(offsets)
    each = -(-sizes // net.window)
    of = np.repeat(np.arange(len(sizes)), each)
    number = np.arange(len(of)) - np.repeat(np.cumsum(each) - each, each)
    starts = offsets[:-1][of] + number * net.window
    length = np.minimum(net.window, offsets[1:][of] - starts)
    total = np.zeros((len(sizes), len(net.labels)))
    for i in range(0, len(of), SCAN_WINDOWS):
        part = slice(i, i + SCAN_WINDOWS)
        low, high = starts[i], starts[part][-1] + length[part][-1]
        x = windows_of(data[low:high], starts[part] - low, length[part], net.window)
        p = window_probabilities(x, net, tables) * length[part][:, None]
        np.add.at(total, of[part], p)
    total /= np.maximum(sizes, 1)[:, None]
    letters = pc.match_substring_regex(column.cast(pa.large_string()), r"\p{L}").fill_null(False).to_numpy(zero_copy_only=False)
    best = total.argmax(axis=1)
    labels = [net.labels[b] if known else UNKNOWN for b, known in zip(best, letters)]
    return labels, np.where(letters, np.clip(total[np.arange(len(best)), best], 0, 1), 0.0)


def training_windows(labelled: DataFrame, key: Column, settings: Training) -> DataFrame:
    """``text, lang``: a bounded sample with one window of each chosen document."""
    usable = labelled.where("text IS NOT NULL AND lang IS NOT NULL AND length(text) > 0")
    # digests below a label's share hold about twice the wanted windows, so few rows reach the ranking of a label
    counts = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(settings.most_windows)
    share = F.least(F.lit(1.0), F.lit(2.0 * settings.per_language) / F.col("count"))
    shares = F.broadcast(counts.select(F.col("lang").alias("_lang"), share.alias("_share")))  # at most most_windows rows
    order = F.xxhash64(key, F.lit(settings.seed))
    drawn = usable.join(shares, F.col("lang") == F.col("_lang")).where(F.pmod(order, F.lit(1 << 20)) < F.col("_share") * (1 << 20))
    room = F.greatest(F.length("text") - settings.window, F.lit(1))
    rows = drawn.select(
        "lang",
        order.alias("order"),
        F.substring("text", F.pmod(F.xxhash64(key), room).cast("int") + 1, F.lit(settings.window)).alias("text"),
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order", "text"))
    few = rows.withColumn("rank", rank).where(F.col("rank") <= settings.per_language)
    return few.orderBy("rank", "lang").limit(settings.most_windows).select("text", "lang")


def learn(labelled: DataFrame, key: Column, settings: Training = Training()) -> ByteNet | None:
    """Network learned from ``text, lang``; None if there is nothing to learn from."""
    sample = training_windows(labelled, key, settings).collect()
    return train([r["text"] for r in sample], [r["lang"] for r in sample], settings) if sample else None


def predict(docs: DataFrame, net: ByteNet | None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` of the whole ``text``."""
    kept = docs.drop("lang_pred", "score")
    if net is None:
        return kept.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    shared = kept.sparkSession.sparkContext.broadcast(net)  # its size is set by the numbers of filters and labels
    target = kept.withColumns({"lang_pred": F.lit(None).cast("string"), "score": F.lit(None).cast("double")}).schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared.value.tables()
        for batch in (b.slice(first, last - first) for b in batches for first, last in runs_of_rows(b.column("text"))):
            labels, scores = classify(batch.column("text"), shared.value, tables)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(labels, pa.string()), pa.array(scores, pa.float64())], names=target.names
            )

    return kept.mapInArrow(score, target)


def accepted(predicted: DataFrame, least_score: float = 0.3) -> DataFrame:
    """Documents whose language was recognised; ``und`` and scores below ``least_score`` are rejected."""
    return predicted.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)).drop("lang_pred", "score")
