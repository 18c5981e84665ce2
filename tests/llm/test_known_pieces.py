"""Token encoding does work per different piece, and reads a piece's bytes only the first time."""

from __future__ import annotations

import numpy as np

from tinta.llm import feistel_output as fo


class Encoder:
    def __init__(self):
        self.asked = []

    def encode_ordinary(self, text):
        self.asked.append(text)
        return [ord(c) for c in text]


def encoded(texts, memo):
    raw = [t.encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in raw]))).astype(np.int64)
    tokens, begin = fo.encode_texts(np.frombuffer(b"".join(raw), np.uint8), offsets, memo, 7)
    return [tokens[b:e].tolist() for b, e in zip(begin[:-1], begin[1:])]


def test_texts_meet_the_encoder_once_per_different_piece():
    encoder = Encoder()
    memo = fo.PieceMemo(encoder)
    texts = ["", " a b a", "a", "", "b a c  d ", " a", "ñ a", ""]
    for _ in range(2):
        assert encoded(texts, memo) == [[*map(ord, t), 7] for t in texts]
    assert len(encoder.asked) == len(set(encoder.asked)) and {" a", " b", "a", "ñ"} <= set(encoder.asked)


def test_bytes_of_known_pieces_are_not_read():
    memo = fo.PieceMemo(Encoder())
    hashes, starts, ends = np.array([5, 9], np.uint64), np.array([0, 2]), np.array([2, 3])
    first = memo.numbers(hashes, b"xyz", starts, ends)
    assert first.tolist() == memo.numbers(hashes, None, starts, ends).tolist() == [0, 1]
