"""Saved naive Bayes statistics, their versions, and their export as an ML pipeline."""

import pytest
from pyspark.sql import functions as F

from textmine import operators as op
from textmine import plans, sources


@pytest.fixture(scope="module")
def statistics(corpus):
    return op.fit_statistics(corpus, min_df=2, stop_words=["common", "the"])


@pytest.fixture
def folder(tmp_path):
    return f"file://{tmp_path}/bayes"


def scores(corpus, statistics):
    rows = op.score(corpus, op.fit_models(statistics, [-1, 0]), "doc_id", smoothings=[1.0, 0.5]).collect()
    return {(r["doc_id"], r["smoothing"]): (r["pred_cat"], r["scores"]) for r in rows}


def test_round_trip(spark, corpus, statistics, folder):
    assert sources.save_bayes(statistics, folder) == 1
    loaded = sources.load_bayes(spark, folder)
    assert loaded[1:] == statistics[1:] and loaded.stop_words == ["common", "the"]
    assert loaded.terms.schema == statistics.terms.schema
    order = ["term", "cat", "fold"]
    assert loaded.terms.orderBy(*order).collect() == statistics.terms.orderBy(*order).collect()
    found, expected = scores(corpus, loaded), scores(corpus, statistics)
    assert found.keys() == expected.keys()
    for k in found:
        assert found[k][0] == expected[k][0] and found[k][1] == pytest.approx(expected[k][1], abs=1e-12)


def test_versions(spark, corpus, statistics, folder):
    assert sources.model_versions(spark, folder) == []
    with pytest.raises(ValueError, match="no version None"):
        sources.load_bayes(spark, folder)
    other = op.fit_statistics(corpus, min_df=20)
    assert [sources.save_bayes(statistics, folder), sources.save_bayes(other, folder)] == [1, 2]
    assert sources.model_versions(spark, folder) == [1, 2]
    assert sources.load_bayes(spark, folder).n_terms == other.n_terms
    assert sources.load_bayes(spark, folder, 1).n_terms == statistics.n_terms
    with pytest.raises(ValueError, match="no version 3"):
        sources.load_bayes(spark, folder, 3)


def test_a_failed_save_changes_nothing(spark, statistics, folder):
    """A save that dies while it writes its tables leaves no version, and the next one takes its number."""
    sources.save_bayes(statistics, folder)
    broken = statistics._replace(terms=statistics.terms.withColumn("tf", F.raise_error(F.lit("lost")).cast("long")))
    with pytest.raises(Exception, match="lost"):
        sources.save_bayes(broken, folder)
    assert sources.model_versions(spark, folder) == [1]
    assert sources.load_bayes(spark, folder).n_terms == statistics.n_terms
    assert sources.save_bayes(statistics, folder) == 2


def test_damage_is_seen(spark, statistics, folder, tmp_path):
    sources.save_bayes(statistics, folder)
    data = next((tmp_path / "bayes" / "data").iterdir())
    spark.read.parquet(f"file://{data}/terms").limit(3).coalesce(1).write.mode("overwrite").parquet(f"file://{data}/t2")
    (data / "terms").rename(data / "old")
    (data / "t2").rename(data / "terms")
    with pytest.raises(ValueError, match="damaged"):
        sources.load_bayes(spark, folder)


@pytest.mark.parametrize("smoothing", [1.0, 0.25])
def test_export_as_an_ml_pipeline(spark, corpus, statistics, tmp_path, smoothing):
    path = f"file://{tmp_path}/pipeline"
    sources.save_model(plans.bayes_pipeline(statistics, smoothing), path)
    model = sources.load_model(path)
    test = corpus.where("fold = -1").withColumn("text", F.coalesce("text", F.lit("")))
    found = {r["doc_id"]: (r["pred_cat"], list(r["rawPrediction"])) for r in model.transform(test).collect()}
    ours = op.score(corpus, op.fit_models(statistics), "doc_id", smoothings=[smoothing]).collect()
    labels = list(statistics.trained_on(-1))
    assert len(found) == len(ours) > 0
    for r in ours:
        predicted, raw = found[r["doc_id"]]
        expected = dict(zip(statistics.classes, r["scores"]))
        assert predicted == r["pred_cat"] and raw == pytest.approx([expected[c] for c in labels], abs=1e-9)
