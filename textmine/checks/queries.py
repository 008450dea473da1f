"""Registered queries: each takes (spark, folder of parquet tables) and gives a DataFrame.

The tables stand in for posts: ``documents`` with its language as the class, ``documents`` with the
``quality`` label, ``conversations`` with the speaker's role, and ``pages`` for raw HTML.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmine import functions as fn
from textmine import operators as op
from textmine import plans, sources

Query = Callable[[SparkSession, str], DataFrame]

SMOOTHINGS = (1.0, 0.5)
LANGUAGES = ["de", "en", "es", "fr"]
TOP_TERMS = 100
SMALL_VOCABULARY = 500
# Layout of the training rows: at least so many partitions, one more per ``SVC_ROWS`` rows beyond.
SVC_PARTITIONS = 4
SVC_ROWS = 25_000
#: Text in one file of ``csv_split``, twice what a task reads at most.
CSV_FILE_BYTES = 256 * 1024 * 1024
SVC_REG_PARAM, SVC_GAP = 20.0, 0.05


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "documents").select("doc_id", "text", F.col("lang").alias("cat"))


def _folded(corpus: DataFrame) -> DataFrame:
    return op.clean_corpus(corpus).withColumn("fold", fn.fold_of(["doc_id"]))


def corpus_by_language(spark: SparkSession, folder: str) -> DataFrame:
    return _folded(sources.spread(_documents(spark, folder), "doc_id"))


def corpus_by_quality(spark: SparkSession, folder: str) -> DataFrame:
    labels = _table(spark, folder, "labels").select(
        "doc_id", F.col("quality").cast("string").alias("cat")
    )
    texts = sources.spread(_documents(spark, folder).drop("cat"), "doc_id")
    return _folded(texts.join(labels, "doc_id"))


def corpus_by_source(spark: SparkSession, folder: str) -> DataFrame:
    sourced = _table(spark, folder, "documents").select("doc_id", "text", F.col("source").alias("cat"))
    return _folded(sources.spread(sourced, "doc_id"))


def corpus_by_role(spark: SparkSession, folder: str) -> DataFrame:
    turns = _table(spark, folder, "conversations").select(
        F.concat_ws(":", "conv_id", "turn").alias("doc_id"), "text", F.col("role").alias("cat")
    )
    return _folded(sources.spread(turns, "doc_id"))


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    return sources.spread(_table(spark, folder, "pages"), "page_id")


def _posts(spark: SparkSession, folder: str) -> DataFrame:
    return _pages(spark, folder).select(
        F.col("url").alias("Title"),
        F.col("html").alias("Body"),
        F.regexp_extract("html", 'lang="([a-z]+)"', 1).alias("Category"),
        "page_id",
    )


# Checks on a table, projections, cleaning ---------------------------------------------------------


def row_count(spark: SparkSession, folder: str) -> DataFrame:
    return op.row_count(_documents(spark, folder))


def count_by_category(spark: SparkSession, folder: str) -> DataFrame:
    return op.count_by(_documents(spark, folder), "cat")


def preview(spark: SparkSession, folder: str) -> DataFrame:
    return op.preview(_documents(spark, folder), 2, "doc_id")


def describe_schema(spark: SparkSession, folder: str) -> DataFrame:
    return op.describe(_documents(spark, folder), "doc_id")


def concat_fields(spark: SparkSession, folder: str) -> DataFrame:
    joined = fn.concat_fields(F.col("url"), F.col("html"))
    return _table(spark, folder, "pages").select("page_id", joined.alias("text"))


def project_rename(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "documents").select("text", "lang").toDF("text", "cat")


def _page_step(step) -> Query:
    return lambda spark, folder: _pages(spark, folder).select(
        "page_id", step(F.col("html")).alias("text")
    )


def clean_text(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_by_language(spark, folder).select("doc_id", "text", "cat")


def clean_posts(spark: SparkSession, folder: str) -> DataFrame:
    return op.build_corpus(_posts(spark, folder), "page_id")


# Tokens and features ------------------------------------------------------------------------------


def tokenize(spark: SparkSession, folder: str) -> DataFrame:
    corpus = corpus_by_language(spark, folder).select("doc_id", fn.tokenize("text").alias("w"))
    return corpus.select("doc_id", F.size("w").alias("n_words"), F.array_join("w", " ").alias("words"))


def remove_stopwords(spark: SparkSession, folder: str) -> DataFrame:
    corpus = corpus_by_language(spark, folder)
    words = corpus.select("doc_id", fn.tokenize("text").alias("words")).select(
        "doc_id", fn.remove_stop_words("words", fn.default_stop_words()).alias("w")
    )
    return words.select("doc_id", F.size("w").alias("n_words"), F.array_join("w", " ").alias("words"))


def stop_words(spark: SparkSession, folder: str) -> DataFrame:
    return op.word_frequency(corpus_by_language(spark, folder), fn.default_stop_words())


def doc_frequency(spark: SparkSession, folder: str) -> DataFrame:
    frequencies = op.document_frequency(corpus_by_language(spark, folder))
    return frequencies.where(F.col("df") >= 5)


def top_terms(spark: SparkSession, folder: str) -> DataFrame:
    frequencies = op.document_frequency(corpus_by_language(spark, folder))
    return op.top_terms(frequencies.where(F.col("df") >= 5), TOP_TERMS)


def vocabulary_size(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = op.fit_vocabulary(corpus_by_language(spark, folder), size=SMALL_VOCABULARY)
    return vocabulary.table.select("term", "df", "cf")


def term_counts(spark: SparkSession, folder: str) -> DataFrame:
    corpus = corpus_by_language(spark, folder)
    return op.vocabulary_counts(corpus, op.fit_vocabulary(corpus), "doc_id").drop("idf")


def idf_weights(spark: SparkSession, folder: str) -> DataFrame:
    weights = op.idf_weights(op.fit_vocabulary(corpus_by_language(spark, folder)))
    return weights.select("term", "df", F.round("idf", 4).alias("idf"))


def tfidf(spark: SparkSession, folder: str) -> DataFrame:
    corpus = corpus_by_language(spark, folder)
    weights = op.tfidf(corpus, op.fit_vocabulary(corpus), "doc_id")
    return weights.select("doc_id", "term", F.round("tfidf", 4).alias("tfidf"))


def _named_entries(model: PipelineModel, table: DataFrame) -> DataFrame:
    """Vector entries by term. The term list is the fitted vocabulary, at most 2^18 words."""
    spark = table.sparkSession
    terms = next(s for s in model.stages if hasattr(s, "vocabulary")).vocabulary
    names = sources.copy_to(spark, enumerate(terms), "index int, term string")
    entries = plans.vector_entries(table, "features", "doc_id")
    size = sum(len(term.encode()) for term in terms) + 64 * len(terms)
    return op.lookup_join(entries, names, ["index"], size, spread_by=["doc_id"]).select(
        "doc_id", "term", F.round("value", 4).alias("tfidf")
    )


def vector_tfidf(spark: SparkSession, folder: str) -> DataFrame:
    corpus = corpus_by_language(spark, folder)
    model = plans.fit_features(corpus)
    return _named_entries(model, plans.add_features(model, corpus))


def dictionary_tfidf(spark: SparkSession, folder: str) -> DataFrame:
    """The same vectors over a vocabulary that stays in Spark, entries by term."""
    corpus = corpus_by_language(spark, folder)
    numbered = op.numbered_terms(op.fit_vocabulary(corpus))
    entries = plans.vector_entries(op.add_vectors(corpus, numbered, "doc_id"), "features", "doc_id")
    names = numbered.table.select(F.col("index").cast("int").alias("index"), "term", "df")
    named = op.lookup_join(entries, names, ["index"], numbered.row_bytes(1), spread_by=["doc_id"], frequency="df")
    return named.select("doc_id", "term", F.round("value", 4).alias("tfidf"))


def ml_tfidf(spark: SparkSession, folder: str) -> DataFrame:
    corpus = corpus_by_language(spark, folder)
    model = plans.preprocessing_pipeline().fit(corpus)
    return _named_entries(model, plans.add_features(model, corpus))


# Labels and splits --------------------------------------------------------------------------------


def hash_split(spark: SparkSession, folder: str) -> DataFrame:
    """Both parts in one scan."""
    part = F.when(fn.split_part(["doc_id"]) == 0, "training").otherwise("test")
    return _documents(spark, folder).select("doc_id", part.alias("part"))


def random_split(spark: SparkSession, folder: str) -> DataFrame:
    """What holds for any draw: every key in exactly one part, and the shares near the weights.

    Four standard deviations are allowed; parts are compared by their keys.
    """
    training, test = op.random_split(_documents(spark, folder).select("doc_id"), seed=42)
    both = training.withColumn("part", F.lit(0)).union(test.withColumn("part", F.lit(1)))
    by_key = both.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum("part").alias("test"))
    share = F.sum(F.col("n") - F.col("test")) / F.sum("n")
    return by_key.agg(
        F.sum("n").alias("total"),
        F.count("*").alias("keys"),
        F.count_if((F.col("n") > 1) & (F.col("test") > 0) & (F.col("test") < F.col("n"))).alias("in_both"),
        (F.abs(share - 0.7) <= 4 * F.sqrt(F.lit(0.21) / F.sum("n"))).alias("share_holds"),
    )


def label_index(spark: SparkSession, folder: str) -> DataFrame:
    return op.label_index(_documents(spark, folder))


def string_index(spark: SparkSession, folder: str) -> DataFrame:
    sourced = _table(spark, folder, "documents").select("doc_id", F.col("source").alias("cat"))
    return op.fit_label_indexer(sourced).transform(sourced)


def index_to_string(spark: SparkSession, folder: str) -> DataFrame:
    sourced = _table(spark, folder, "documents").select("doc_id", F.col("source").alias("cat"))
    indexer = op.fit_label_indexer(sourced)
    indexed = indexer.transform(sourced).select("doc_id", "label")
    return op.index_to_string(indexed, indexer.labels, "label", "cat")


def binary_label(spark: SparkSession, folder: str) -> DataFrame:
    return op.binary_label(_documents(spark, folder).select("doc_id", "cat"), ["en"])


# Naive Bayes as aggregations ----------------------------------------------------------------------


def _predictions(corpus: DataFrame) -> DataFrame:
    models = op.fit_models(op.fit_statistics(corpus))
    return op.score(corpus, models, "doc_id")


def _predict(corpus_of: Query) -> Query:
    return lambda spark, folder: _predictions(corpus_of(spark, folder)).select(
        "doc_id", "cat", "pred_cat", F.round(F.array_max("scores"), 3).alias("score")
    )


def nb_priors(spark: SparkSession, folder: str) -> DataFrame:
    priors = op.class_priors(corpus_by_language(spark, folder))
    return priors.select("cat", F.round("prior", 4).alias("prior"))


def nb_term_weights(spark: SparkSession, folder: str) -> DataFrame:
    models = op.fit_models(op.fit_statistics(corpus_by_language(spark, folder)))
    return op.term_weights(models).select("cat", "term", F.round("weight", 4).alias("weight"))


def nb_predict_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Twenty classes in blocks of eight, as a thousand would be in blocks of more."""
    corpus = corpus_by_source(spark, folder)
    scored = op.score(corpus, op.fit_models(op.fit_statistics(corpus), block_classes=8), "doc_id")
    return scored.select("doc_id", "cat", "pred_cat", F.round(F.array_max("scores"), 3).alias("score"))


def nb_saved(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of the test part with statistics that were saved and loaded again."""
    corpus = corpus_by_source(spark, folder)
    path = sources.scratch_path(spark, "saved-bayes")
    sources.save_bayes(op.fit_statistics(corpus), path)
    models = op.fit_models(sources.load_bayes(spark, path))
    scored = op.score(corpus, models, "doc_id")
    return scored.select("doc_id", "cat", "pred_cat", F.round(F.array_max("scores"), 3).alias("score"))


def prediction_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return op.prediction_pairs(_predictions(corpus_by_quality(spark, folder)))


def _confusion(corpus_of: Query) -> Query:
    return lambda spark, folder: op.confusion_long(_predictions(corpus_of(spark, folder)))


def _confusion_wide(corpus_of: Query, labels: list[str]) -> Query:
    return lambda spark, folder: op.confusion_wide(_confusion(corpus_of)(spark, folder), labels)


def _confusion_table(corpus_of: Query, labels: list[str]) -> Query:
    return lambda spark, folder: op.confusion_table(_confusion(corpus_of)(spark, folder), labels)


def _rounded(scores: DataFrame, *names: str) -> DataFrame:
    return scores.select(*[F.round(name, 4).alias(name) for name in names])


def _eval_f1(corpus_of: Query) -> Query:
    return lambda spark, folder: _rounded(op.metrics(_confusion(corpus_of)(spark, folder)), "f1")


def _eval_all(corpus_of: Query) -> Query:
    names = ("f1", "weightedPrecision", "weightedRecall", "accuracy")
    return lambda spark, folder: _rounded(op.metrics(_confusion(corpus_of)(spark, folder)), *names)


def _eval_without_class(corpus_of: Query, dropped: str) -> Query:
    return lambda spark, folder: _rounded(
        op.metrics(op.without_class(_confusion(corpus_of)(spark, folder), dropped)), "f1"
    )


def _cv_metrics(corpus_of: Query) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        corpus = corpus_of(spark, folder)
        judged = op.validate(corpus, op.fit_statistics(corpus), "doc_id", smoothings=SMOOTHINGS)
        return _rounded(op.validation_metrics(judged), "smoothing", "avg_metric", "std_metric")

    return query


def _cv_best(corpus_of: Query) -> Query:
    """Tune the smoothing, then report the best value and its F1 on the test part."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        corpus = corpus_of(spark, folder)
        judged = op.validate(corpus, op.fit_statistics(corpus), "doc_id", smoothings=SMOOTHINGS)
        best = op.best_smoothing(judged, SMOOTHINGS)
        scores = op.metrics(op.tested(judged, best))
        return scores.select(F.lit(best).alias("smoothing"), F.round("f1", 4).alias("f1"))

    return query


# ML pipelines over vectors ------------------------------------------------------------------------


def _features(corpus: DataFrame) -> DataFrame:
    """Stored feature table: the estimators read it many times."""
    model = plans.fit_features(corpus)
    table = plans.add_features(model, corpus).select("doc_id", "cat", "fold", "features")
    return sources.written(table, "features")


def _parts(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (
        features.where(F.col("fold") != fn.TEST_FOLD),
        features.where(F.col("fold") == fn.TEST_FOLD),
    )


def _tuned(training: DataFrame):
    pipeline = plans.naive_bayes_pipeline()
    grid = plans.smoothing_grid(pipeline, SMOOTHINGS)
    return plans.cross_validator(pipeline, grid, fold_col="fold").fit(training)


def _ml_cv_metrics(corpus_of: Query) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        training, _ = _parts(_features(corpus_of(spark, folder)))
        scores = plans.validation_metrics(_tuned(training), training)
        return _rounded(scores, "smoothing", "avg_metric", "std_metric")

    return query


def ml_predict(spark: SparkSession, folder: str) -> DataFrame:
    training, test = _parts(_features(corpus_by_quality(spark, folder)))
    return plans.predict(_tuned(training), test).select("doc_id", "cat", "pred_cat")


def ml_eval(spark: SparkSession, folder: str) -> DataFrame:
    training, test = _parts(_features(corpus_by_quality(spark, folder)))
    predicted = plans.predict(_tuned(training), test).select("label", "prediction").cache()
    names = ("f1", "weightedPrecision", "weightedRecall", "accuracy")
    values = tuple(round(op.evaluate(predicted, name), 4) for name in names)
    predicted.unpersist()
    return sources.copy_to(spark, [values], ", ".join(f"{name} double" for name in names))


def _svc_partitions(training: DataFrame) -> int:
    """Decided by the number of rows alone, so that a model does not depend on the cluster."""
    return max(SVC_PARTITIONS, -(-training.count() // SVC_ROWS))


def _svc_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Label, compute, split, fit, score; the training rows are laid out by key."""
    features = op.binary_label(_features(corpus_by_language(spark, folder)), ["en"])
    training, test = _parts(sources.compute(features.select("doc_id", "fold", "label", "features"), "svc_rows"))
    scored = plans.fit_linear_svc(training, partitions=_svc_partitions(training)).transform(test)
    scored = sources.written(scored.select("doc_id", "label", "prediction"), "svc-predictions")
    sources.uncache_table(spark, "svc_rows")
    return scored


def svc_confusion(spark: SparkSession, folder: str) -> DataFrame:
    return op.count_by(_svc_predictions(spark, folder), "label", "prediction")


def svc_checks(spark: SparkSession, folder: str) -> DataFrame:
    """What holds for any optimum: every test document once, both labels, predictions of 0 or 1."""
    return _svc_predictions(spark, folder).groupBy("label").agg(
        F.count("*").alias("n"),
        F.countDistinct("doc_id").alias("documents"),
        F.count_if(F.col("prediction").isin(0.0, 1.0)).alias("judged"),
        (F.avg((F.col("prediction") == F.col("label")).cast("double")) > 0.5).alias("better_than_chance"),
    )


def svc_certificate(spark: SparkSession, folder: str) -> DataFrame:
    """A regularised fit is shown to be within a twentieth of the optimum."""
    features = op.binary_label(_features(corpus_by_language(spark, folder)), ["en"])
    training, _ = _parts(sources.compute(features.select("doc_id", "fold", "label", "features"), "svc_rows"))
    model = plans.fit_linear_svc(training, reg_param=SVC_REG_PARAM, partitions=_svc_partitions(training), standardize=False)
    found = plans.svc_certificate(model, training, SVC_REG_PARAM)
    sources.uncache_table(spark, "svc_rows")
    row = (found.rows, 0 < found.dual <= found.primal, found.gap <= SVC_GAP)
    return sources.copy_to(spark, [row], "n long, bound_holds boolean, near_optimum boolean")


def svc_f1(spark: SparkSession, folder: str) -> DataFrame:
    score = op.evaluate(_svc_predictions(spark, folder).select("label", "prediction"), "f1")
    return sources.copy_to(spark, [(round(score, 4),)], "f1 double")


# Sources, sinks, caching, persistence -------------------------------------------------------------


def csv_multiline(spark: SparkSession, folder: str) -> DataFrame:
    """Raw text with line breaks through a comma-separated file."""
    path = sources.scratch_path(spark, "raw-csv")
    raw = _documents(spark, folder)
    sources.write_csv(raw, path, sep=",")
    back = sources.read_csv(spark, path, sources.all_strings(raw), sep=",", multi_line=True)
    return back.withColumn("doc_id", F.col("doc_id").cast("long"))


def csv_split(spark: SparkSession, folder: str) -> DataFrame:
    """The same through files that several tasks read each; small tables are one file."""
    path = sources.scratch_path(spark, "raw-csv")
    raw = _documents(spark, folder)
    size = raw.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(1, -(-size // CSV_FILE_BYTES))
    # Too few splits to put together are dealt anew.
    enough = files == 1 or raw.rdd.getNumPartitions() >= 2 * files
    parts = raw.coalesce(files) if enough else raw.repartition(files, *raw.columns)
    sources.write_csv(parts, path, sep=",", max_records_per_file=0)
    back = sources.read_csv(spark, path, sources.all_strings(raw), sep=",", split=True)
    return back.withColumn("doc_id", F.col("doc_id").cast("long"))


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned text through a semicolon-separated file that many tasks can split."""
    path = sources.scratch_path(spark, "corpus-csv")
    sources.write_csv(clean_text(spark, folder).select("text", "cat"), path)
    return sources.read_csv(spark, path, multi_line=False, name="corpus")


def csv_preprocess(spark: SparkSession, folder: str) -> DataFrame:
    """Raw posts file to cleaned corpus file."""
    raw = sources.scratch_path(spark, "posts-csv")
    cleaned = sources.scratch_path(spark, "corpus-csv")
    sources.write_csv(_posts(spark, folder).drop("page_id"), raw, sep=",")
    sources.write_csv(op.build_corpus(sources.read_raw_posts(spark, raw)), cleaned)
    return sources.read_csv(spark, cleaned, multi_line=False)


def parquet_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """TF-IDF vectors through parquet."""
    corpus = corpus_by_language(spark, folder)
    model = plans.fit_features(corpus)
    path = sources.scratch_path(spark, "tfidf-parquet")
    sources.write_parquet(plans.add_features(model, corpus).drop("text", "words"), path)
    return _named_entries(model, sources.read_parquet(spark, path, name="tfidf"))


def json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Long TF-IDF rows through JSON lines."""
    path = sources.scratch_path(spark, "tfidf-json")
    rows = tfidf(spark, folder)
    sources.write_json(rows, path)
    return sources.read_json(spark, path, rows.schema)


def model_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Save and reload the pipeline, unfitted and fitted, and score with what was reloaded."""
    training, test = _parts(_features(corpus_by_quality(spark, folder)))
    pipeline_path = sources.scratch_path(spark, "pipeline")
    model_path = sources.scratch_path(spark, "model")
    sources.save_model(plans.naive_bayes_pipeline(), pipeline_path)
    sources.save_model(sources.load_pipeline(pipeline_path).fit(training), model_path)
    model = sources.load_model(model_path)
    scored = op.index_to_string(model.transform(test), model.stages[0].labels)
    return scored.select("doc_id", "cat", "pred_cat")


def local_table(spark: SparkSession, folder: str) -> DataFrame:
    """Class names from a local table, joined to the corpus counts."""
    rows = [("de", "German"), ("en", "English"), ("es", "Spanish"), ("fr", "French")]
    names = sources.copy_to(spark, rows, "cat string, name string", name="class_names")
    return count_by_category(spark, folder).join(F.broadcast(names), "cat").select("name", "n")


def csv_by_name(spark: SparkSession, folder: str) -> DataFrame:
    """Raw posts from a file whose columns stand in another order, with one more between them."""
    path = sources.scratch_path(spark, "posts-csv")
    posts = _posts(spark, folder).select("Category", "Body", F.col("page_id").cast("string").alias("Extra"), "Title")
    sources.write_csv(posts, path, sep=",")
    return sources.read_raw_posts(spark, path)


def csv_nulls(spark: SparkSession, folder: str) -> DataFrame:
    """Null, empty and blank texts through a file."""
    path = sources.scratch_path(spark, "nulls-csv")
    kind = F.col("doc_id") % 4
    text = F.when(kind == 0, F.lit(None)).when(kind == 1, "").when(kind == 2, "  ").otherwise(F.col("lang"))
    rows = _table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("key"), text.alias("text"))
    sources.write_csv(rows, path)
    return sources.read_csv(spark, path, sources.all_strings(rows), multi_line=False)


def csv_features(spark: SparkSession, folder: str) -> DataFrame:
    """A feature table through a text file: the vector as JSON, read back as entries."""
    path = sources.scratch_path(spark, "features-csv")
    corpus = corpus_by_language(spark, folder)
    model = plans.fit_features(corpus)
    table = plans.add_features(model, corpus).select("doc_id", "features")
    sources.write_csv(sources.writable_features(table, "features"), path)
    back = sources.read_csv(spark, path, "doc_id long, features string", multi_line=False)
    kind = "type tinyint, size int, indices array<int>, values array<double>"
    values = F.from_json("features", kind)["values"]
    total = F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)
    return back.select("doc_id", F.size(values).alias("n_terms"), F.round(total, 3).alias("total"))


def cached_count(spark: SparkSession, folder: str) -> DataFrame:
    """Cache a table, count it, release it."""
    classes = sources.compute(_documents(spark, folder).select("cat"), "cached_classes")
    n = classes.count()
    sources.uncache_table(spark, "cached_classes")
    still_cached = spark.catalog.isCached("cached_classes")
    return sources.copy_to(spark, [(n, still_cached)], "n long, still_cached boolean")


def registered() -> dict[str, Query]:
    language, quality, role = corpus_by_language, corpus_by_quality, corpus_by_role
    return {
        "row_count": row_count,
        "count_by_category": count_by_category,
        "preview": preview,
        "describe_schema": describe_schema,
        "concat_fields": concat_fields,
        "project_rename": project_rename,
        "clean_tags": _page_step(fn.strip_tags),
        "clean_newlines": _page_step(fn.strip_line_breaks),
        "clean_punct": _page_step(fn.strip_punctuation),
        "clean_digits": _page_step(fn.strip_digits),
        "clean_text": clean_text,
        "clean_posts": clean_posts,
        "tokenize": tokenize,
        "stop_words": stop_words,
        "remove_stopwords": remove_stopwords,
        "doc_frequency": doc_frequency,
        "top_terms": top_terms,
        "vocabulary_size": vocabulary_size,
        "term_counts": term_counts,
        "idf_weights": idf_weights,
        "tfidf": tfidf,
        "vector_tfidf": vector_tfidf,
        "dictionary_tfidf": dictionary_tfidf,
        "ml_tfidf": ml_tfidf,
        "hash_split": hash_split,
        "random_split": random_split,
        "label_index": label_index,
        "string_index": string_index,
        "index_to_string": index_to_string,
        "binary_label": binary_label,
        "nb_priors": nb_priors,
        "nb_term_weights": nb_term_weights,
        "nb_predict": _predict(language),
        "nb_predict_quality": _predict(quality),
        "nb_predict_role": _predict(role),
        "nb_predict_source": _predict(corpus_by_source),
        "nb_predict_blocks": nb_predict_blocks,
        "nb_saved": nb_saved,
        "prediction_pairs": prediction_pairs,
        "confusion_long": _confusion(language),
        "confusion_long_quality": _confusion(quality),
        "confusion_wide": _confusion_wide(language, LANGUAGES),
        "confusion_table": _confusion_table(language, LANGUAGES),
        "confusion_table_quality": _confusion_table(quality, ["0", "1"]),
        "eval_f1": _eval_f1(language),
        "eval_all": _eval_all(language),
        "eval_all_quality": _eval_all(quality),
        "eval_all_role": _eval_all(role),
        "eval_without_class": _eval_without_class(language, "en"),
        "eval_without_class_quality": _eval_without_class(quality, "1"),
        "cv_metrics": _cv_metrics(language),
        "cv_metrics_quality": _cv_metrics(quality),
        "cv_metrics_role": _cv_metrics(role),
        "cv_best": _cv_best(language),
        "cv_best_quality": _cv_best(quality),
        "ml_cv_metrics": _ml_cv_metrics(language),
        "ml_cv_metrics_quality": _ml_cv_metrics(quality),
        "ml_predict": ml_predict,
        "ml_eval": ml_eval,
        "svc_confusion": svc_confusion,
        "svc_checks": svc_checks,
        "svc_certificate": svc_certificate,
        "svc_f1": svc_f1,
        "csv_multiline": csv_multiline,
        "csv_split": csv_split,
        "csv_roundtrip": csv_roundtrip,
        "csv_preprocess": csv_preprocess,
        "csv_by_name": csv_by_name,
        "csv_nulls": csv_nulls,
        "csv_features": csv_features,
        "parquet_roundtrip": parquet_roundtrip,
        "json_roundtrip": json_roundtrip,
        "model_roundtrip": model_roundtrip,
        "local_table": local_table,
        "cached_count": cached_count,
    }
