"""Text expressions. Every function maps columns to a column and stays in the JVM."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable, Sequence
from functools import lru_cache
from itertools import groupby

from pyspark.sql import Column, functions as F

# Whitespace as Python's str.split() sees it; the syntax is valid in Java regex and in RE2.
WS = r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

WS_CHARACTERS = "".join(
    chr(p) for p in [*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
) + "\u2028\u2029\u202f\u205f\u3000"

# Letters of the word pattern, ASCII letters plus the Spanish ones. The dotless i and the
# long s belong to it because case-insensitive a-z accepts them.
SPANISH_LETTERS = "a-záéíóúüñ"
WORD_LETTERS = SPANISH_LETTERS + "ıſ"
WORD_PATTERN = f"[{WORD_LETTERS}]+(?:-[{WORD_LETTERS}]+)?"

# Replacements that put punctuation back next to its word, in order of application.
PUNCTUATION_JOINS = (
    (" ,", ","),
    (" .", "."),
    (" ;", ";"),
    (" :", ":"),
    (" !", "!"),
    (" ?", "?"),
    (" )", ")"),
    ("( ", "("),
    (" ]", "]"),
    ("[ ", "["),
    (" }", "}"),
    ("{ ", "{"),
)

# Word splitting of cased BERT models: whitespace separates, punctuation and CJK characters stand alone.
_CJK = (
    r"\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{f900}-\x{faff}"
    r"\x{20000}-\x{2a6df}\x{2a700}-\x{2ebef}\x{2f800}-\x{2fa1f}"
)
_ALONE = rf"\p{{P}}$+<=>\^`|~{_CJK}"
PRETOKEN_PATTERN = f"[^{_ALONE}{WS}]+|[{_ALONE}]"


@lru_cache(maxsize=None)
def digit_pattern() -> str:
    """What Python calls a digit: category ``Nd`` and the superscripts, circled digits and so on."""
    points = [
        p for p in range(sys.maxunicode + 1) if chr(p).isdigit() and unicodedata.category(chr(p)) != "Nd"
    ]
    runs = []
    for _, run in groupby(enumerate(points), key=lambda pair: pair[1] - pair[0]):
        members = [point for _, point in run]
        runs.append(rf"\x{{{members[0]:x}}}-\x{{{members[-1]:x}}}")
    return rf"[\p{{Nd}}{''.join(runs)}]"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WS_CHARACTERS))


def split_words(text: Column) -> Column:
    """Whitespace tokens; no empty strings."""
    return F.filter(F.split(text, f"[{WS}]+"), lambda token: token != "")


def collapse_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, f"[{WS}]+", " "))


def normalize_text(text: Column, lowercase: bool = True) -> Column:
    """Lower case and single spaces; accents and ñ stay."""
    return collapse_spaces(F.lower(text) if lowercase else text)


def is_valid_token(token: Column, stopwords: Iterable[str] = ()) -> Column:
    """True for a word worth training on: Spanish letter, two characters or more, no digit, no stopword."""
    candidate = F.lower(strip(token))
    valid = (
        (F.length(candidate) >= 2)
        & candidate.rlike(f"[{WORD_LETTERS}]")
        & ~candidate.rlike(digit_pattern())
    )
    words = list(stopwords)
    return valid & ~candidate.isin(words) if words else valid


def clean_tokens(text: Column, stopwords: Iterable[str] = ()) -> Column:
    """Lower-case Spanish words of a text without stopwords and single letters.

    The pattern only yields letters and inner hyphens, so of ``is_valid_token`` only length and
    stopwords are left to test. ``isin`` becomes a hash set lookup in the optimizer.
    """
    words = list(stopwords)

    def keep(token: Column) -> Column:
        long_enough = F.length(token) >= 2
        return long_enough & ~token.isin(words) if words else long_enough

    return F.filter(F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0)), keep)


def clean_token_list(
    tokens: Column,
    stopwords: Iterable[str] = (),
    remove_numbers: bool = True,
    remove_punctuation: bool = True,
) -> Column:
    """Clean tokens that are already split. Digits fall to ``is_valid_token`` even with a switch off."""

    def keep(token: Column) -> Column:
        kept = is_valid_token(token, stopwords)
        if remove_numbers:
            kept = kept & ~token.rlike(digit_pattern())
        if remove_punctuation:
            kept = kept & token.rlike(f"[{SPANISH_LETTERS}]")
        return kept

    return F.filter(F.transform(tokens, lambda token: normalize_text(token)), keep)


def rebuild_text(tokens: Column) -> Column:
    """Readable text from tokens: one space between, then the punctuation joins in their order."""
    text = F.array_join(tokens, " ")
    for old, new in PUNCTUATION_JOINS:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def pretokenize(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PRETOKEN_PATTERN), F.lit(0))


def preview(text: Column, max_chars: int) -> Column:
    return F.substring(collapse_spaces(text), 1, max_chars)


def chunk_text(text: Column, page_content: Column | None = None) -> Column:
    """Text of a chunk, from either field; a chunk without text is an error."""
    found = F.when(text != "", text)
    if page_content is not None:
        found = F.coalesce(found, F.when(page_content != "", page_content))
    return F.coalesce(found, F.raise_error(F.lit("chunk without text")).cast("string"))


def model_slug(model_name: Column) -> Column:
    """File-safe name of a model."""
    return F.btrim(F.regexp_replace(model_name, "[^a-zA-Z0-9._-]+", "_"), F.lit("_"))


def file_stem(file_name: Column) -> Column:
    """Name without its last suffix; a leading or trailing dot starts no suffix."""
    return F.regexp_replace(file_name, r"(?<=[^/])\.[^./]+$", "")


def chunk_id(source_file: Column, chunk_index: Column) -> Column:
    stem = F.coalesce(F.when(file_stem(source_file) != "", file_stem(source_file)), F.lit("documento"))
    safe = F.lower(F.btrim(F.regexp_replace(stem, "[^a-zA-Z0-9_-]+", "_"), F.lit("_")))
    return F.format_string("%s_chunk_%04d", safe, chunk_index)


def needs_prefix(model_name: Column) -> Column:
    """E5-style models expect ``query: `` or ``passage: `` in front of a text."""
    name = F.lower(model_name)
    return name.startswith("intfloat/multilingual-e5") | name.contains("/e5-")


def format_for_model(text: Column, model_name: Column, input_type: Column) -> Column:
    stripped = strip(text)
    prefix = F.when(input_type == "query", "query: ").otherwise("passage: ")
    missing = needs_prefix(model_name) & ~F.lower(stripped).rlike("^(query|passage): ")
    return F.when(missing, F.concat(prefix, stripped)).otherwise(stripped)


def _json_strings(text: Column) -> Column:
    """List literal to strings; NULL unless every element parses."""
    parsed = F.from_json(
        text,
        "array<string>",
        {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"},
    )
    return F.when(text.rlike(r"(?s)^\[.*\]$") & ~F.exists(parsed, lambda item: item.isNull()), parsed)


def _loose_list(inner: Column) -> Column:
    """``a, b, c`` without quotes around every element; commas inside double quotes do not split."""
    parts = F.split(inner, r',(?=(?:[^"]*"[^"]*")*[^"]*$)')
    bare = F.transform(parts, lambda part: F.btrim(strip(part), F.lit("'\"")))
    return F.filter(bare, lambda part: part != "")


def parse_token_list(value: Column) -> Column:
    """Cell with a list literal, a tuple, a quoted string, a loose list or plain text to an array."""
    text = strip(value)
    inner = F.substring(text, F.lit(2), F.greatest(F.length(text) - 2, F.lit(0)))
    as_tuple = F.concat(F.lit("["), F.regexp_replace(inner, f",[{WS}]*$", ""), F.lit("]"))
    is_tuple = text.rlike(r"(?s)^\((?:.*,.*)?\)$")
    is_string = text.rlike("""(?s)^(?:'[^'\\\\]*'|"[^"\\\\]*")$""")
    return (
        F.when(value.isNull() | (text == ""), F.array().cast("array<string>"))
        .when(is_string, F.array(inner))
        .otherwise(
            F.coalesce(
                _json_strings(text),
                F.when(is_tuple, _json_strings(as_tuple)),
                F.when(text.rlike(r"(?s)^\[.*\]$"), _loose_list(inner)),
                F.array(text),
            )
        )
    )


def cell_tokens(value: Column) -> Column:
    """Table cell to tokens: a list literal if it parses, else whitespace words; blanks dropped."""
    text = strip(value)
    tokens = F.coalesce(_json_strings(text), split_words(text))
    return F.filter(tokens, lambda token: strip(token) != "")


def column_key(name: str) -> str:
    """Normalised column name; works on metadata only."""
    kept = "".join(c if c.isascii() and c.isalnum() else " " for c in name.lower())
    return "_".join(kept.split())


def column_key_expr(name: Column) -> Column:
    """The same normalisation for names held in a column."""
    return F.btrim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "_"), F.lit("_"))


def find_column(columns: Sequence[str], candidates: Sequence[str]) -> str | None:
    """First candidate whose normalised name exists; of colliding columns the last one."""
    by_key = {column_key(column): column for column in columns}
    return next((by_key[column_key(c)] for c in candidates if column_key(c) in by_key), None)
