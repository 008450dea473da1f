"""Label encoding and train/test splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmine.functions.splits import split_part


def label_index(corpus: DataFrame, cat: str = "cat") -> DataFrame:
    """``(cat, n, label)``: classes by falling frequency from 0, ties in alphabetical order.

    The window runs over one row per class, after the aggregation.
    """
    counts = corpus.where(F.col(cat).isNotNull()).groupBy(cat).agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.orderBy(F.desc("n"), cat)) - 1
    return counts.withColumn("label", rank.cast("double"))


def fit_label_indexer(
    corpus: DataFrame, cat: str = "cat", label: str = "label", handle_invalid: str = "error"
) -> StringIndexerModel:
    indexer = StringIndexer(
        inputCol=cat,
        outputCol=label,
        stringOrderType="frequencyDesc",
        handleInvalid=handle_invalid,
    )
    return indexer.fit(corpus)


def index_to_string(
    df: DataFrame,
    labels: Sequence[str],
    input_col: str = "prediction",
    output_col: str = "pred_cat",
) -> DataFrame:
    """Translate a numeric label column back to class names."""
    converter = IndexToString(inputCol=input_col, outputCol=output_col, labels=list(labels))
    return converter.transform(df)


def binary_label(
    corpus: DataFrame, names: Sequence[str], cat: str = "cat", label: str = "label"
) -> DataFrame:
    """1.0 for the classes in ``names``, 0.0 for every other class and for null."""
    inside = F.col(cat).isin(list(names))
    return corpus.withColumn(label, F.when(inside, 1.0).otherwise(0.0))


def hash_split(
    df: DataFrame, *key: str, weights: Sequence[int] = (7, 3), seed: int | None = None
) -> list[DataFrame]:
    """Parts in proportion to integer ``weights``, decided by the row key alone.

    Each part is a filter on the input: no sort, no shuffle, and the same rows on every run.
    """
    part = split_part(key, weights, seed)
    return [df.where(part == i) for i in range(len(weights))]


def random_split(
    df: DataFrame, weights: Sequence[float] = (0.7, 0.3), seed: int | None = None
) -> list[DataFrame]:
    """A random draw per partition; another partitioning draws other rows. See ``hash_split``."""
    return df.randomSplit(list(weights), seed)
