import pytest
from pyspark.sql import functions as F

from textmine import operators as op


@pytest.fixture(scope="module")
def classes(spark):
    return spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "cat string")


def test_label_index_breaks_ties_by_name(classes):
    rows = op.label_index(classes).orderBy("label").collect()
    assert [(r["cat"], r["label"]) for r in rows] == [("c", 0.0), ("a", 1.0), ("b", 2.0)]


def test_label_indexer_agrees_with_label_index(classes):
    known = classes.where(F.col("cat").isNotNull())
    assert op.fit_label_indexer(known).labels == ["c", "a", "b"]


def test_unseen_label_is_an_error(spark, classes):
    model = op.fit_label_indexer(classes.where(F.col("cat").isNotNull()))
    unseen = model.transform(spark.createDataFrame([("z",)], "cat string"))
    with pytest.raises(Exception, match="Unseen label"):
        unseen.select("label").collect()


def test_index_to_string(spark):
    df = spark.createDataFrame([(0.0,), (2.0,)], "prediction double")
    rows = op.index_to_string(df, ["x", "y", "z"]).collect()
    assert [r["pred_cat"] for r in rows] == ["x", "z"]


def test_binary_label_of_null_is_zero(classes):
    rows = op.binary_label(classes, ["c"]).collect()
    assert [(r["cat"], r["label"]) for r in rows] == [
        ("b", 0.0), ("a", 0.0), ("c", 1.0), ("c", 1.0), (None, 0.0),
    ]


@pytest.mark.parametrize("weights", [(7, 3), (1, 1, 2)])
def test_hash_split_is_complete_disjoint_and_stable(spark, weights):
    df = spark.range(500)
    parts = [{r["id"] for r in p.collect()} for p in op.hash_split(df, "id", weights=weights)]
    again = [{r["id"] for r in p.collect()} for p in op.hash_split(df.repartition(13), "id", weights=weights)]
    assert parts == again
    assert sum(len(p) for p in parts) == 500 and set().union(*parts) == set(range(500))


def test_random_split_is_complete_and_disjoint(spark):
    training, test = op.random_split(spark.range(500), seed=1)
    left, right = ({r["id"] for r in p.collect()} for p in (training, test))
    assert not left & right and left | right == set(range(500)) and len(left) > len(right)


def test_null_keys_raise(spark):
    df = spark.createDataFrame([(1,), (None,)], "id long")
    with pytest.raises(Exception, match="null in key column id"):
        [part.collect() for part in op.hash_split(df, "id")]
