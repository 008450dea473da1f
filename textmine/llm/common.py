"""Column helpers and small tools that several operators share."""

from __future__ import annotations

import string
from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmine.operators.lookup import lookup_join

# ASCII white space; every other character belongs to a word.
SPACES = r"[\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z only. Pure ASCII takes the fast built-in, where both agree."""
    slow = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(slow)


def words(text: Column, separators: str = SPACES) -> Column:
    """Words between ``separators``; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators, -1), "")


def text_hash(text: Column) -> Column:
    return F.xxhash64(text)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def with_results(df: DataFrame, found: DataFrame, doc_id: str, text: str, how: str) -> DataFrame:
    """Join ``df`` to results per ``(_id, _hash)`` without touching its own columns.

    ``found`` has at most one row per key. ``how`` is a join type; the key columns do not stay.
    """
    a, b = fresh(df, "_row_id"), fresh(df, "_row_hash")
    right = found.withColumnsRenamed({"_id": a, "_hash": b})
    on = df[doc_id].eqNullSafe(right[a]) & (text_hash(df[text]) == right[b])
    return df.join(right, on, how).drop(a, b)


def range_bucket(key: Column, bounds: Sequence[int]) -> Column:
    """Number of ``bounds``, an ascending list, that are not above ``key``; null counts as lowest.

    Looked up in two steps, so the work per row grows with the square root of the list.
    """
    if not bounds:
        return F.lit(0)
    width = max(1, isqrt(len(bounds)))
    chunks = [list(bounds[i : i + width]) for i in range(0, len(bounds), width)]

    def longs(values: Sequence[int]) -> str:
        return "array(" + ", ".join(f"{int(v)}L" if v > -(2**63) else f"cast('{v}' AS long)" for v in values) + ")"

    starts = F.expr(longs([chunk[0] for chunk in chunks]))
    table = F.expr("array(" + ", ".join(longs(chunk) for chunk in chunks) + ")")
    coarse = F.size(F.filter(starts, lambda b: b <= key))
    fine = F.size(F.filter(F.get(table, coarse - 1), lambda b: b <= key))
    return F.when(key.isNull() | (coarse == 0), 0).otherwise((coarse - 1) * width + fine)


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of an ordered array of structs, comma-joined."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def null_safe_lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    table_bytes: int,
    spread_by: Sequence[str],
    how: str = "inner",
) -> DataFrame:
    """``lookup_join`` on one string column whose null is a key like any other.

    The other columns of ``table`` must not have names that ``rows`` has, nor ``_salt``.
    """
    null, value = F.col(key).isNull(), F.coalesce(key, F.lit(""))
    flag = fresh(rows, "_null_key")
    coded = rows.withColumns({flag: null, key: value})
    other = table.withColumns({flag: null, key: value})
    joined = lookup_join(coded, other, [flag, key], table_bytes, spread_by, how)
    return joined.withColumn(key, F.when(~F.col(flag), F.col(key))).drop(flag)
