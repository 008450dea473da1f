"""Vectors over a vocabulary that stays in Spark equal those of the ML pipeline."""

import pytest
from pyspark.ml.classification import NaiveBayes

from textmine import operators as op
from textmine import plans
from textmine.operators import lookup


@pytest.mark.parametrize("broadcast", [True, False])
def test_vectors_equal_the_ml_pipeline(spark, corpus, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(lookup, "BROADCAST_LIMIT_BYTES", 0)
    vocabulary = op.fit_vocabulary(corpus, min_df=2)
    numbered = op.numbered_terms(vocabulary)
    terms = [r["term"] for r in numbered.table.orderBy("index").collect()]
    expected = sorted(vocabulary.table.collect(), key=lambda r: (-r["cf"], r["term"]))
    assert terms == [r["term"] for r in expected]
    assert [r["index"] for r in numbered.table.orderBy("index").collect()] == list(range(len(terms)))
    found = op.add_vectors(corpus, numbered, "doc_id", keep=["cat"])
    assert found.columns == ["doc_id", "cat", "raw_features", "features"]
    model = plans.fit_features(corpus, min_df=2)
    ml = {r["doc_id"]: r for r in plans.add_features(model, corpus).collect()}
    listed = model.stages[2].vocabulary
    rows = found.collect()
    assert {r["doc_id"] for r in rows} == ml.keys() and len(rows) == len(ml)
    for r in rows:
        for name in ("raw_features", "features"):
            ours, theirs = r[name], ml[r["doc_id"]][name]
            assert ours.size == theirs.size == len(terms)
            left = {terms[i]: v for i, v in zip(ours.indices, ours.values)}
            right = {listed[i]: v for i, v in zip(theirs.indices, theirs.values)}
            assert left == pytest.approx(right, rel=1e-12)
    assert any(r["features"].numNonzeros() == 0 for r in rows)


def test_estimators_take_them(corpus):
    numbered = op.numbered_terms(op.fit_vocabulary(corpus, min_df=2))
    table = op.add_vectors(corpus, numbered, "doc_id", keep=["cat", "fold"])
    indexed = op.fit_label_indexer(table).transform(table)
    training = indexed.where("fold <> -1")
    model = NaiveBayes(smoothing=0.5).fit(training)
    labels = op.fit_label_indexer(table).labels
    ours = op.score(corpus, op.fit_models(op.fit_statistics(corpus, min_df=2)), "doc_id", smoothings=[0.5]).collect()
    found = {r["doc_id"]: labels[int(r["prediction"])] for r in model.transform(indexed.where("fold = -1")).collect()}
    assert found == {r["doc_id"]: r["pred_cat"] for r in ours}


def test_many_terms_in_order(spark):
    """Ties of the count across partitions, numbered without gaps."""
    texts = [(k, " ".join(f"w{(k * 7 + j) % 900}" for j in range(30))) for k in range(300)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = op.numbered_terms(op.fit_vocabulary(df, min_df=1))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = numbered.table.orderBy("index").collect()
    assert [r["index"] for r in rows] == list(range(numbered.n_terms)) and numbered.n_terms == 900
    assert [r["term"] for r in rows] == [r["term"] for r in sorted(rows, key=lambda r: (-r["cf"], r["term"]))]


def test_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    numbered = op.numbered_terms(op.fit_vocabulary(empty))
    assert numbered.table.count() == 0 and op.add_vectors(empty, numbered, "doc_id").count() == 0
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    rows = op.add_vectors(blank, numbered, "doc_id").collect()
    assert len(rows) == 2 and all(r["features"].size == 0 for r in rows)
