"""Confusion matrices and the metrics that follow from them.

All metrics come from the counts per (class, predicted class): one aggregation over the
predictions, then arithmetic on a table with at most classes squared rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METRICS = ("f1", "weightedPrecision", "weightedRecall", "accuracy")


def prediction_pairs(predictions: DataFrame) -> DataFrame:
    return predictions.select("cat", "pred_cat")


def confusion_long(predictions: DataFrame, *by: str) -> DataFrame:
    """``(*by, cat, pred_cat, n)``; pairs that do not occur have no row."""
    return predictions.groupBy(*by, "cat", "pred_cat").agg(F.count("*").alias("n"))


def confusion_wide(confusion: DataFrame, labels: Sequence[str]) -> DataFrame:
    """One row per predicted class, one column per true class, null where nothing occurred."""
    return confusion.groupBy("pred_cat").pivot("cat", list(labels)).agg(F.sum("n"))


def confusion_table(confusion: DataFrame, labels: Sequence[str]) -> DataFrame:
    """One row per true class, one column per predicted class, zeros filled in."""
    wide = confusion.groupBy("cat").pivot("pred_cat", list(labels)).agg(F.sum("n"))
    return wide.na.fill(0, list(labels))


def without_class(predictions: DataFrame, name: str) -> DataFrame:
    """Drop the rows whose true class is ``name``, or unknown; predictions of it stay."""
    return predictions.where(F.col("cat") != name)


def metrics(confusion: DataFrame, *by: str) -> DataFrame:
    """Weighted F1, precision and recall, and accuracy, one row per ``by`` group.

    Classes weigh in by their true count, so a class that is only ever predicted weighs nothing.
    """
    hit = F.col("cat") == F.col("pred_cat")
    none = F.lit(0).cast("long")
    sides = F.array(
        F.struct(
            F.col("cat").alias("class"),
            F.col("n").alias("sup"),
            none.alias("pp"),
            F.when(hit, F.col("n")).otherwise(none).alias("tp"),
        ),
        F.struct(
            F.col("pred_cat").alias("class"),
            none.alias("sup"),
            F.col("n").alias("pp"),
            none.alias("tp"),
        ),
    )
    per_class = (
        confusion.where(F.col("cat").isNotNull())
        .select(*by, F.inline(sides))
        .groupBy(*by, "class")
        .agg(F.sum("sup").alias("sup"), F.sum("pp").alias("pp"), F.sum("tp").alias("tp"))
        .where(F.col("sup") > 0)
    )
    sup, pp, tp = F.col("sup"), F.col("pp"), F.col("tp")
    total = F.sum(sup)
    return per_class.groupBy(*by).agg(
        (F.sum(sup * 2 * tp / (sup + pp)) / total).alias("f1"),
        (F.sum(F.when(pp > 0, sup * tp / pp).otherwise(0.0)) / total).alias("weightedPrecision"),
        (F.sum(tp) / total).alias("weightedRecall"),
        (F.sum(tp) / total).alias("accuracy"),
    )


def evaluate(
    predictions: DataFrame,
    metric: str = "f1",
    label_col: str = "label",
    prediction_col: str = "prediction",
) -> float:
    """One metric over numeric label and prediction columns."""
    return MulticlassClassificationEvaluator(
        labelCol=label_col, predictionCol=prediction_col, metricName=metric
    ).evaluate(predictions)
