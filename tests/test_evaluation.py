import random

import pytest
from pyspark.sql import functions as F

from textmine import operators as op
from textmine.operators.evaluation import METRICS

LABELS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def predictions(spark):
    rng = random.Random(11)
    rows = [(rng.choices(LABELS, [6, 3, 1])[0], rng.choice(LABELS)) for _ in range(300)]
    df = spark.createDataFrame(rows, "cat string, pred_cat string")
    index = F.create_map(*[F.lit(x) for i, c in enumerate(LABELS) for x in (c, float(i))])
    return df.withColumn("label", index[F.col("cat")]).withColumn(
        "prediction", index[F.col("pred_cat")]
    )


@pytest.mark.parametrize("dropped", [None, "a"])
def test_metrics_equal_the_evaluator(predictions, dropped):
    judged = op.without_class(predictions, dropped) if dropped else predictions
    row = op.metrics(op.confusion_long(judged)).first()
    for name in METRICS:
        assert row[name] == pytest.approx(op.evaluate(judged, name), rel=1e-12)


def test_class_that_is_never_predicted(spark):
    df = spark.createDataFrame(
        [("a", "a", 0.0, 0.0), ("b", "a", 1.0, 0.0), ("b", "c", 1.0, 2.0)],
        "cat string, pred_cat string, label double, prediction double",
    )
    row = op.metrics(op.confusion_long(df)).first()
    for name in METRICS:
        assert row[name] == pytest.approx(op.evaluate(df, name), rel=1e-12)


def test_metrics_by_group(predictions):
    halves = predictions.withColumn("g", F.pmod(F.monotonically_increasing_id(), F.lit(2)))
    halves = halves.cache()
    rows = op.metrics(op.confusion_long(halves, "g"), "g").collect()
    assert len(rows) == 2
    for row in rows:
        part = halves.where(F.col("g") == row["g"])
        assert row["f1"] == pytest.approx(op.evaluate(part, "f1"), rel=1e-12)


def test_wide_and_table(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b")], "cat string, pred_cat string")
    confusion = op.confusion_long(df)
    wide = {r["pred_cat"]: (r["a"], r["b"]) for r in op.confusion_wide(confusion, ["a", "b"]).collect()}
    assert wide == {"a": (1, None), "b": (1, 1)}
    table = {r["cat"]: (r["a"], r["b"]) for r in op.confusion_table(confusion, ["a", "b"]).collect()}
    assert table == {"a": (1, 1), "b": (0, 1)}


def test_unknown_class_is_dropped(spark):
    df = spark.createDataFrame([(None, "a"), ("a", "a"), ("b", "a")], "cat string, pred_cat string")
    assert op.without_class(df, "a").collect() == [("b", "a")]
    assert op.metrics(op.confusion_long(df)).first()["accuracy"] == 0.5
