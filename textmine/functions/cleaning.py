"""Cleaning steps as column expressions: every match becomes one space, nothing is trimmed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 32 ASCII punctuation marks and the ten digits.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
DIGITS = "0123456789"


def _blank(text: Column, characters: str) -> Column:
    return F.translate(text, characters, " " * len(characters))


def concat_fields(*fields: Column, sep: str = " ") -> Column:
    """Join text fields with ``sep``; a missing field counts as empty, so the separator stays."""
    parts: list[Column] = []
    for field in fields:
        if parts:
            parts.append(F.lit(sep))
        parts.append(F.coalesce(field, F.lit("")))
    return F.concat(*parts)


def strip_tags(text: Column) -> Column:
    """Replace each HTML tag, from ``<`` to the next ``>`` and across lines, with a space.

    Only the part up to the last ``>`` goes through the regular expression. There every ``<`` does
    close, so the scan stays linear even on long runs of ``<`` that never close.
    """
    tail = F.substring_index(text, ">", -1)
    head = F.left(text, F.length(text) - F.length(tail))
    return F.concat(F.regexp_replace(head, "<[^>]*+>", " "), tail)


def strip_line_breaks(text: Column) -> Column:
    return _blank(text, "\n")


def strip_punctuation(text: Column) -> Column:
    return _blank(text, PUNCTUATION)


def strip_digits(text: Column) -> Column:
    return _blank(text, DIGITS)


def clean(text: Column) -> Column:
    """Tags, then line breaks, punctuation and digits.

    The last three map single characters to a space, so one pass does them together.
    """
    return _blank(strip_tags(text), "\n" + PUNCTUATION + DIGITS)
