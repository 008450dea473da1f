import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import IDF
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from textmine import functions as fn
from textmine import operators as op
from textmine import plans, sources


def entries(model, df, vocabulary):
    rows = plans.vector_entries(plans.add_features(model, df), "features", "doc_id").collect()
    return {(r["doc_id"], vocabulary[r["index"]]): r["value"] for r in rows}


def test_fit_features_equals_the_ml_pipeline(corpus):
    ours = plans.fit_features(corpus)
    ml = plans.preprocessing_pipeline().fit(corpus)
    left = entries(ours, corpus, ours.stages[2].vocabulary)
    right = entries(ml, corpus, ml.stages[2].vocabulary)
    assert left.keys() == right.keys() and left
    assert all(left[k] == pytest.approx(right[k], rel=1e-12) for k in left)


def test_fit_on_training_rows_only(corpus):
    training = corpus.where(F.col("fold") != fn.TEST_FOLD)
    model = plans.fit_features(corpus, fit_on=training)
    expected = {r["term"] for r in op.fit_vocabulary(training).table.collect()}
    assert set(model.stages[2].vocabulary) == expected


def test_null_text_is_empty(spark, corpus):
    model = plans.fit_features(corpus)
    df = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert plans.add_features(model, df).first()["features"].numNonzeros() == 0


def test_oversized_vocabulary_is_refused(corpus):
    vocabulary = op.fit_vocabulary(corpus)._replace(term_bytes=1 << 40)
    with pytest.raises(ValueError, match="long rows"):
        plans.feature_model(vocabulary)


def test_svc_and_model_files(spark, corpus, tmp_path):
    features = plans.add_features(plans.fit_features(corpus), corpus)
    data = op.binary_label(features.select("doc_id", "cat", "fold", "features"), ["plants"])
    data = sources.compute(data, "svc_data")
    training, test = data.where("fold <> -1"), data.where("fold = -1")
    predicted = plans.fit_linear_svc(training, max_iter=10).transform(test)
    values = [r["prediction"] for r in predicted.select("prediction").collect()]
    assert set(values) <= {0.0, 1.0} and len(values) == test.count()
    assert op.evaluate(predicted, "f1") > 0.8
    sources.uncache_table(spark, "svc_data")

    pipeline = plans.naive_bayes_pipeline(smoothing=0.5)
    sources.save_model(pipeline, f"{tmp_path}/pipeline")
    fitted = sources.load_pipeline(f"{tmp_path}/pipeline").fit(training.drop("label"))
    sources.save_model(fitted, f"{tmp_path}/model")
    sources.save_model(fitted, f"{tmp_path}/model")
    loaded = sources.load_model(f"{tmp_path}/model")
    assert loaded.stages[-1].getSmoothing() == 0.5
    test = test.drop("label")
    assert loaded.transform(test).select("prediction").collect() == fitted.transform(test).select(
        "prediction"
    ).collect()


def test_grid_of_several_values_and_labels(corpus):
    features = plans.add_features(plans.fit_features(corpus), corpus).select("cat", "fold", "features")
    training = features.where("fold <> -1").cache()
    pipeline = plans.naive_bayes_pipeline()
    model = plans.cross_validator(
        pipeline, plans.smoothing_grid(pipeline, [1.0, 0.5, 0.1]), num_folds=2, seed=3
    ).fit(training)
    assert plans.validation_metrics(model, training).columns == ["smoothing", "avg_metric", "std_metric"]
    assert plans.validation_metrics(model, training).count() == 3
    assert plans.class_labels(model) == [
        r["cat"] for r in op.label_index(training).orderBy("label").collect()
    ]


def test_grid_over_several_parameters(corpus):
    pipeline = plans.naive_bayes_pipeline()
    grid = plans.param_grid(
        pipeline, {"NaiveBayes": {"smoothing": [1.0, 0.5], "modelType": ["multinomial", "complement"]}}
    )
    assert len(grid) == 4
    features = plans.add_features(plans.fit_features(corpus), corpus).select("cat", "fold", "features")
    training = features.where("fold <> -1").cache()
    model = plans.cross_validator(pipeline, grid, fold_col="fold").fit(training)
    rows = plans.validation_metrics(model, training).collect()
    assert {(r["smoothing"], r["modelType"]) for r in rows} == {
        (s, m) for s in (1.0, 0.5) for m in ("multinomial", "complement")
    }
    with pytest.raises(ValueError, match="LinearSVC"):
        plans.param_grid(pipeline, {"LinearSVC": {"maxIter": [1]}})


def test_grid_over_stages_of_one_class(spark):
    """Two stages of a class are varied apart, and each keeps a column of its own."""
    rows = [(k, float(k % 2), Vectors.dense(k % 2 + k % 3, k % 5, 1.0), k % 3) for k in range(60)]
    training = spark.createDataFrame(rows, ["doc_id", "label", "raw", "fold"]).withColumn("fold", F.col("fold").cast("int"))
    pipeline = Pipeline(stages=[
        IDF(inputCol="raw", outputCol="once"),
        IDF(inputCol="once", outputCol="features"),
        NaiveBayes(modelType="multinomial"),
    ])
    assert list(plans.stage_names(pipeline)) == ["IDF[0]", "IDF[1]", "NaiveBayes"]
    grid = plans.param_grid(
        pipeline,
        {"IDF[0]": {"minDocFreq": [0, 3]}, "IDF[1]": {"minDocFreq": [0, 50]}, "NaiveBayes": {"smoothing": [1.0]}},
    )
    found = plans.validation_metrics(plans.cross_validator(pipeline, grid, fold_col="fold").fit(training), training)
    assert found.columns == ["IDF[0].minDocFreq", "IDF[1].minDocFreq", "smoothing", "avg_metric", "std_metric"]
    assert {tuple(r)[:3] for r in found.collect()} == {(a, b, 1.0) for a in (0, 3) for b in (0, 50)}
    with pytest.raises(ValueError, match=r"IDF\[0\]"):
        plans.param_grid(pipeline, {"IDF": {"minDocFreq": [1]}})


def test_svc_certificate(spark):
    """The bound holds for any classifier, and is close for the fitted one; brute force on the same numbers."""
    rng = random.Random(4)
    rows = []
    for k in range(400):
        label = float(k % 3 == 0)
        x = [rng.gauss(0.8 * (2 * label - 1), 1.5) for _ in range(4)]
        rows.append((k, label, Vectors.dense(x)))
    train = spark.createDataFrame(rows, ["doc_id", "label", "features"]).repartition(3).cache()
    certificates = {}
    for reg_param in (0.1, 1.0):
        model = plans.fit_linear_svc(train, reg_param=reg_param, standardize=False)
        found = certificates[reg_param] = plans.svc_certificate(model, train, reg_param)
        w, b = model.coefficients.toArray(), model.intercept
        hinge = [max(0.0, 1 - (2 * y - 1) * (float(w @ x.toArray()) + b)) for _, y, x in rows]
        assert found.rows == 400
        assert found.primal == pytest.approx(sum(hinge) / 400 + reg_param / 2 * float(w @ w), rel=1e-9)
        assert 0 < found.dual <= found.primal and found.gap < 0.05
    # A model of another objective is further off, and its bound is still one of the optimum.
    poor = plans.fit_linear_svc(train, reg_param=50.0, standardize=False)
    other = plans.svc_certificate(poor, train, 0.1)
    assert other.dual <= certificates[0.1].primal <= other.primal and other.gap > certificates[0.1].gap
    with pytest.raises(ValueError, match="no dual bound"):
        plans.svc_certificate(poor, train, 0.0)


def test_layout_of_svc_rows_grows_with_the_rows(spark):
    from textmine.checks import queries

    assert queries._svc_partitions(spark.range(100_000)) == queries.SVC_PARTITIONS == 4
    assert queries._svc_partitions(spark.range(1_000_001)) == 41
