"""SQL fragments shared by the oracles."""

from __future__ import annotations

from tinta.functions.stopwords import stopwords
from tinta.functions.text import PUNCTUATION_JOINS, WORD_PATTERN, WS


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def stopword_list(language: str = "spanish") -> str:
    """The stopwords of a language as a SQL list."""
    return "(" + ", ".join(quote(w) for w in stopwords(language)) + ")"


def clean(text: str, with_stopwords: bool = True) -> str:
    """List of clean tokens of a text expression."""
    stop = f" AND w NOT IN {stopword_list()}" if with_stopwords else ""
    return (
        f"list_filter(regexp_extract_all(lower({text}), '{WORD_PATTERN}'), "
        f"lambda w: length(w) >= 2{stop})"
    )


def words(text: str) -> str:
    """Whitespace words of a text expression."""
    return f"list_filter(regexp_split_to_array({text}, '[{WS}]+'), lambda w: w <> '')"


def collapse(text: str) -> str:
    return f"trim(regexp_replace({text}, '[{WS}]+', ' ', 'g'))"


def joined(tokens: str) -> str:
    return f"array_to_string({tokens}, ' ')"


def rebuilt(tokens: str) -> str:
    text = joined(tokens)
    for old, new in PUNCTUATION_JOINS:
        text = f"replace({text}, {quote(old)}, {quote(new)})"
    return text
