"""Tokenising, stop words and per-document term counts as column expressions.

Arguments named ``text`` and ``words`` are a column name or any SQL expression. The expressions are
written as SQL text: a list of a few hundred stop words then costs one parse instead of a call into
the JVM per word.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import lru_cache

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F


@lru_cache(maxsize=None)
def _stop_words(language: str) -> tuple[str, ...]:
    return tuple(StopWordsRemover.loadDefaultStopWords(language))


def default_stop_words(language: str = "english") -> list[str]:
    return list(_stop_words(language))


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _kept_tokens(
    text: str, min_token_length: int, to_lower_case: bool, pattern: str, condition: str = "true"
) -> str:
    if min_token_length < 1:
        raise ValueError("min_token_length must be at least 1")
    text = f"coalesce({text}, '')"
    if to_lower_case:
        text = f"lower({text})"
    # The token length counts UTF-16 units, so a character outside the basic plane counts twice.
    wide = _quoted(r"[\x{10000}-\x{10FFFF}]")
    return f"""filter(split({text}, {_quoted(pattern)}), w -> {condition}
        AND (length(w) >= {min_token_length} OR (octet_length(w) >= 4
            AND length(w) + regexp_count(w, {wide}) >= {min_token_length})))"""


def _not_listed(word: str, stop_words: Iterable[str]) -> str:
    listed = ", ".join(_quoted(stop_word) for stop_word in sorted(set(stop_words)))
    return f"{word} NOT IN ({listed})" if listed else "true"


def tokenize(
    text: str, min_token_length: int = 2, to_lower_case: bool = True, pattern: str = r"\s+"
) -> Column:
    """Split on white space and keep tokens of at least ``min_token_length``; null gives no tokens."""
    return F.expr(_kept_tokens(text, min_token_length, to_lower_case, pattern))


def remove_stop_words(
    words: str, stop_words: Sequence[str], case_sensitive: bool = False
) -> Column:
    """Drop stop words, keeping order and repeats."""
    if case_sensitive:
        keep = _not_listed("w", stop_words)
    else:
        keep = _not_listed("lower(w)", (word.lower() for word in stop_words))
    return F.expr(f"filter({words}, w -> {keep})")


def _content_words(text: str, stop_words: Sequence[str] | None) -> str:
    listed = default_stop_words() if stop_words is None else stop_words
    # The tokens are in lower case already, so one filter can test length and list.
    keep = _not_listed("w", (word.lower() for word in listed))
    return _kept_tokens(text, 2, True, r"\s+", keep)


def content_words(text: str, stop_words: Sequence[str] | None = None) -> Column:
    """Lower-case tokens without stop words, the English ones by default."""
    return F.expr(_content_words(text, stop_words))


def count_terms(words: str) -> Column:
    """``array<struct<term, tf>>`` of one document's tokens.

    Sorts the tokens and measures the runs inside the row, so counting needs no shuffle. The
    one-element ``transform`` calls bind the sorted array and the run starts once each.
    """
    return F.expr(
        f"""
        transform(array(sort_array({words})), t -> if(size(t) = 0, array(),
            transform(
                array(filter(sequence(0, size(t) - 1), i -> i = 0 OR get(t, i) != get(t, i - 1))),
                starts -> transform(starts, (i, j) -> named_struct(
                    'term', get(t, i),
                    'tf', cast(coalesce(get(starts, j + 1), size(t)) - i AS bigint)))
            )[0]))[0]
        """
    )


def count_text_terms(text: str, stop_words: Sequence[str] | None = None) -> Column:
    """``count_terms`` of the content words of a text."""
    return count_terms(_content_words(text, stop_words))
