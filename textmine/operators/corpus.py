"""From raw posts to a ``(text, cat)`` corpus, and the checks one runs on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmine.functions.cleaning import clean, concat_fields


def build_corpus(
    posts: DataFrame,
    *keep: str,
    title: str = "Title",
    body: str = "Body",
    category: str = "Category",
) -> DataFrame:
    """Concatenate title and body, clean the text and name the columns ``text`` and ``cat``.

    ``keep`` carries further columns, such as a row key, through. One projection, no shuffle.
    """
    text = clean(concat_fields(F.col(title), F.col(body)))
    return posts.select(*keep, text.alias("text"), F.col(category).alias("cat"))


def clean_corpus(corpus: DataFrame, text: str = "text") -> DataFrame:
    return corpus.withColumn(text, clean(F.col(text)))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def count_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def preview(df: DataFrame, n: int, *order: str) -> DataFrame:
    """First ``n`` rows by ``order``; without an order any ``n`` rows."""
    return (df.orderBy(*order) if order else df).limit(n)


def schema_rows(df: DataFrame) -> list[tuple[str, str]]:
    """Column names and types."""
    return df.dtypes


def describe(df: DataFrame, *count: str) -> DataFrame:
    """One row per column: name, type and, for the columns in ``count``, how many values are present.

    Names and types are metadata: without ``count`` no data is read.
    """
    totals = df.agg(*[F.count(F.col(name)).alias(f"_{name}") for name in count]) if count else None
    rows = [
        F.struct(
            F.lit(name).alias("name"),
            F.lit(kind).alias("type"),
            (F.col(f"_{name}") if name in count else F.lit(None).cast("long")).alias("present"),
        )
        for name, kind in df.dtypes
    ]
    one = df.sparkSession.range(1) if totals is None else totals
    return one.select(F.inline(F.array(*rows)))
