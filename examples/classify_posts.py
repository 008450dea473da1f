"""From a raw posts file to classifiers: ``spark-submit examples/classify_posts.py POSTS.csv OUTPUT DUMMY_CLASS``.

POSTS.csv has the columns Title, Body and Category. OUTPUT receives the cleaned corpus, the TF-IDF
table and the models. DUMMY_CLASS is the class the linear SVC tells from all others.
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from textmine import functions as fn  # noqa: E402
from textmine import operators as op  # noqa: E402
from textmine import plans, sources  # noqa: E402


def main(spark: SparkSession, posts_path: str, output: str, dummy_class: str) -> dict[str, float]:
    # Raw posts to a cleaned corpus file, and back with a key for every row.
    raw = sources.read_raw_posts(spark, posts_path)
    sources.write_csv(op.build_corpus(raw), f"{output}/corpus")
    read = sources.read_csv(spark, f"{output}/corpus", multi_line=False)
    corpus = sources.with_row_id(read).withColumn("fold", fn.fold_of(["doc_id"]))
    op.count_by(corpus, "cat").show()

    # TF-IDF features, stored: everything below reads them again and again.
    model = plans.fit_features(corpus)
    features = plans.add_features(model, corpus)
    sources.write_parquet(features.drop("text", "words"), f"{output}/tfidf")
    features = sources.read_parquet(spark, f"{output}/tfidf", name="tfidf")
    training = features.where(F.col("fold") != fn.TEST_FOLD)
    test = features.where(F.col("fold") == fn.TEST_FOLD)

    # Naive Bayes, tuned by cross-validation.
    pipeline = plans.naive_bayes_pipeline()
    grid = plans.param_grid(pipeline, {"NaiveBayes": {"smoothing": [1.0, 0.5]}})
    tuned = plans.cross_validator(pipeline, grid, fold_col="fold").fit(training)
    plans.validation_metrics(tuned, training).show()
    labels = plans.class_labels(tuned)
    confusion = sources.written(op.confusion_long(plans.predict(tuned, test)), "confusion")
    op.confusion_wide(confusion, labels).show()
    f1 = op.metrics(confusion).first()["f1"]
    rest = op.metrics(op.without_class(confusion, labels[0])).first()["f1"]

    # One class against the others.
    dummy = sources.compute(op.binary_label(features, [dummy_class]), "dummy")
    svc = plans.fit_linear_svc(dummy.where(F.col("fold") != fn.TEST_FOLD))
    scored = svc.transform(dummy.where(F.col("fold") == fn.TEST_FOLD))
    svc_f1 = op.evaluate(scored.select("label", "prediction"), "f1")
    sources.uncache_table(spark, "dummy")

    sources.save_model(pipeline, f"{output}/pipelines/bayes")
    sources.save_model(model, f"{output}/models/features")
    sources.save_model(tuned.bestModel, f"{output}/models/bayes")
    return {"f1": f1, f"f1 without {labels[0]}": rest, f"svc f1 {dummy_class}": svc_f1}


if __name__ == "__main__":
    session = SparkSession.builder.appName("classify-posts").getOrCreate()
    print(main(session, *sys.argv[1:4]))
    session.stop()
