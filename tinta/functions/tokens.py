"""Expressions on subword token arrays."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Tokenizer names and the special tokens each of them adds.
SPECIAL_TOKENS = {
    "wordpiece": ("[CLS]", "[SEP]", "[PAD]"),
    "sentencepiece": ("</s>", "<pad>"),
}
TOKENIZER_NAMES = {
    "wordpiece": "wordpiece",
    "beto": "wordpiece",
    "wordpiece-beto": "wordpiece",
    "sentencepiece": "sentencepiece",
    "t5": "sentencepiece",
    "sentencepiece-t5": "sentencepiece",
}


def tokenizer_kind(name: str) -> str:
    kind = TOKENIZER_NAMES.get(name.lower())
    if kind is None:
        raise ValueError(f"unknown tokenizer {name!r}; use one of {sorted(TOKENIZER_NAMES)}")
    return kind


def without_specials(tokens: Column, tokenizer: str) -> Column:
    specials = SPECIAL_TOKENS[tokenizer_kind(tokenizer)]
    return F.filter(tokens, lambda token: ~token.isin(*specials))


def count_unknown(tokens: Column, unknown: str = "<unk>") -> Column:
    return F.size(F.filter(tokens, lambda token: token == unknown)).cast("bigint")


def continuations(tokens: Column) -> Column:
    return F.filter(tokens, lambda token: token.startswith("##"))


def space_markers(tokens: Column) -> Column:
    return F.filter(tokens, lambda token: token.startswith("▁"))


def round_even(value: Column, digits: int) -> Column:
    """Round as numpy does: scale, take the nearest whole number (even on ties), scale back."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def ratio(numerator: Column, denominator: Column, digits: int = 3) -> Column:
    """Half-even rounded quotient; NULL for a zero denominator."""
    return round_even(numerator / F.nullif(denominator, F.lit(0)), digits)
