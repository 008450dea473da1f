"""Classifier pipelines over feature vectors, with tuning and scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LinearSVCModel, NaiveBayes
from pyspark.ml.evaluation import Evaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmine.functions.splits import TEST_FOLD
from textmine.operators.bayes import BayesStatistics
from textmine.operators.labels import index_to_string
from textmine.operators.terms import Vocabulary
from textmine.plans.features import feature_model
from textmine.sources.tables import copy_to


def naive_bayes_pipeline(cat: str = "cat", smoothing: float = 1.0) -> Pipeline:
    """Label encoding and multinomial naive Bayes, fitted together."""
    return Pipeline(
        stages=[
            StringIndexer(inputCol=cat, outputCol="label", stringOrderType="frequencyDesc"),
            NaiveBayes(modelType="multinomial", smoothing=smoothing),
        ]
    )


def bayes_pipeline(statistics: BayesStatistics, smoothing: float = 1.0) -> PipelineModel:
    """The final model of aggregated statistics as a fitted ML pipeline, from ``text`` to ``pred_cat``.

    ML's naive Bayes learns sums of features and numbers of rows per class, so it is fitted on one weighted
    row per class that has both: the mean feature vector, weighted by the number of documents. The pipeline
    saves and loads like any other and needs nothing of this library. As ML models do, it holds the
    vocabulary and a number per term and class in memory: for more than 256 MB of terms it raises.
    ``text`` must not be null.
    """
    terms = statistics.terms
    spark = terms.sparkSession
    per_term = terms.groupBy("term").agg(F.first("idf").alias("idf"), F.sum("tf").alias("cf"))
    vocabulary = Vocabulary(per_term, sum(statistics.docs.values()), statistics.n_terms, statistics.term_bytes)
    features = feature_model(vocabulary, statistics.stop_words)
    listed = features.stages[2].vocabulary
    numbers = spark.createDataFrame(list(enumerate(listed)), "index int, term string")
    docs = statistics.trained_on(TEST_FOLD)
    labels = list(docs)
    kind = terms.schema["cat"].dataType.simpleString()
    classes = spark.createDataFrame(
        [(c, k, float(n)) for k, (c, n) in enumerate(docs.items())], f"cat {kind}, label int, rows double"
    )
    sums = (
        terms.where(F.col("fold") != TEST_FOLD)
        .groupBy("term", "cat")
        .agg((F.sum("tf") * F.first("idf")).alias("weight"))
    )
    # Every term in every class, so that a sorted list of a class is its vector.
    label = F.explode(F.sequence(F.lit(0), F.lit(len(labels) - 1)))
    every = numbers.withColumn("label", label).join(F.broadcast(classes), "label").join(sums, ["term", "cat"], "left")
    mean = F.coalesce(F.col("weight"), F.lit(0.0)) / F.col("rows")
    vectors = every.groupBy("label", "rows").agg(
        F.array_sort(F.collect_list(F.struct("index", mean.alias("mean")))).alias("cells")
    )
    table = vectors.select(F.col("label").cast("double"), "rows", array_to_vector(F.transform("cells", lambda c: c["mean"])).alias("features"))
    model = NaiveBayes(modelType="multinomial", smoothing=smoothing, weightCol="rows").fit(table)
    names = IndexToString(inputCol="prediction", outputCol="pred_cat", labels=[str(c) for c in labels])
    return PipelineModel(stages=[*features.stages, model, names])


def param_grid(pipeline: Pipeline, values: Mapping[str, Mapping[str, Sequence]]) -> list[dict]:
    """Grid over stage parameters, such as ``{"NaiveBayes": {"smoothing": [1.0, 0.5]}}``.

    Stages go by their class name. Where a pipeline has several of a class they are numbered in its order,
    as in ``IDF[0]`` and ``IDF[1]``. Several stages and parameters multiply.
    """
    stages = stage_names(pipeline)
    builder = ParamGridBuilder()
    for name, params in values.items():
        if name not in stages:
            raise ValueError(f"no stage {name}; the pipeline has {sorted(stages)}")
        for param, options in params.items():
            builder = builder.addGrid(stages[name].getParam(param), list(options))
    return builder.build()


def stage_names(pipeline: Pipeline) -> dict[str, Params]:
    """Stages by class name, numbered where a class comes more than once."""
    classes = [type(stage).__name__ for stage in pipeline.getStages()]
    found = {}
    for at, (name, stage) in enumerate(zip(classes, pipeline.getStages())):
        number = f"[{classes[:at].count(name)}]" if classes.count(name) > 1 else ""
        found[f"{name}{number}"] = stage
    return found


def smoothing_grid(pipeline: Pipeline, values: Sequence[float] = (1.0, 0.5)) -> list[dict]:
    return param_grid(pipeline, {"NaiveBayes": {"smoothing": values}})


def cross_validator(
    estimator: Pipeline,
    grid: list[dict],
    evaluator: Evaluator | None = None,
    num_folds: int = 3,
    parallelism: int = 4,
    fold_col: str | None = None,
    seed: int | None = None,
) -> CrossValidator:
    """Cross-validation by weighted F1 unless told otherwise.

    ``fold_col`` names an integer column with each row's fold, which makes the folds repeatable.
    Every fit reads the training data again, so give it a stored or cached feature table.
    """
    cv = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=grid,
        evaluator=evaluator or MulticlassClassificationEvaluator(metricName="f1"),
        numFolds=num_folds,
        parallelism=parallelism,
    )
    if fold_col:
        cv = cv.setFoldCol(fold_col)
    if seed is not None:
        cv = cv.setSeed(seed)
    return cv


def validation_metrics(model: CrossValidatorModel, train: DataFrame) -> DataFrame:
    """One row per grid entry: its parameters, and mean and deviation of the metric.

    A parameter that several stages vary has the stage in its column's name, as in ``IDF[1].minDocFreq``.
    """
    maps = model.getEstimatorParamMaps()
    types = {bool: "boolean", int: "bigint", float: "double", str: "string"}
    owners = {stage.uid: name for name, stage in stage_names(model.getEstimator()).items()}
    names = [param.name for param in maps[0]]

    def column(param: Param) -> str:
        return param.name if names.count(param.name) == 1 else f"`{owners[param.parent]}.{param.name}`"

    columns = [f"{column(param)} {types[type(value)]}" for param, value in maps[0].items()]
    rows = [
        (*grid.values(), float(mean), float(deviation))
        for grid, mean, deviation in zip(maps, model.avgMetrics, model.stdMetrics)
    ]
    schema = ", ".join([*columns, "avg_metric double", "std_metric double"])
    return copy_to(train.sparkSession, rows, schema)


def class_labels(model: CrossValidatorModel) -> list[str]:
    """Class names of the best model, in the order of the numeric label."""
    return list(model.bestModel.stages[0].labels)


def predict(model: CrossValidatorModel, test: DataFrame) -> DataFrame:
    """Score with the best model and name the predicted class in ``pred_cat``."""
    return index_to_string(model.transform(test), class_labels(model))


def fit_linear_svc(
    train: DataFrame,
    max_iter: int = 100,
    reg_param: float = 0.0,
    aggregation_depth: int = 2,
    partitions: int | None = None,
    key: str = "doc_id",
    standardize: bool = True,
) -> LinearSVCModel:
    """Linear support vector classifier for a 0/1 ``label``; give it a stored or cached table.

    Every step of the optimiser is a job over ``train``, many per iteration: deepen the aggregation
    for thousands of partitions. Sums of floating numbers depend on the order of rows, and without a
    regularisation separable classes have no unique optimum. ``partitions`` therefore lays the rows
    out by ``key``, in an order that nothing but the rows decides, and keeps them in memory while
    fitting; without it the table's own layout is used as it is.
    """
    estimator = LinearSVC(
        maxIter=max_iter, regParam=reg_param, aggregationDepth=aggregation_depth, standardization=standardize
    )
    if partitions is None:
        return estimator.fit(train)
    laid_out = train.repartition(partitions, key).sortWithinPartitions(key).select("features", "label").persist()
    try:
        return estimator.fit(laid_out)
    finally:
        laid_out.unpersist()


#: Widths of the band around the margin in which a row's dual weight goes from 1 to 0.
RAMPS = (0.01, 0.03, 0.1, 0.3)


class Certificate(NamedTuple):
    """What a support vector classifier reaches, and what no classifier can go below."""

    rows: int
    primal: float
    dual: float

    @property
    def gap(self) -> float:
        """Share of the objective by which the model may miss the optimum, at most."""
        return (self.primal - self.dual) / self.primal if self.primal > 0 else 0.0


def svc_certificate(
    model: LinearSVCModel, train: DataFrame, reg_param: float, ramps: Sequence[float] = RAMPS
) -> Certificate:
    """How close ``model`` is to the optimum on ``train``, without solving for it again.

    The objective is the mean hinge loss plus half of ``reg_param``, which must be above 0, times the squared
    coefficients: that of a fit with ``standardize=False``. Dual weights are read off the model's margins,
    brought to equal sums for both classes, and scaled; whatever the model, their dual value is a lower bound
    of the objective of every linear classifier. Two passes over ``train``, sums only.
    """
    if reg_param <= 0:
        raise ValueError("without a regularisation there is no dual bound")
    y = 2 * F.col("label") - 1
    margin = y * vector_to_array("rawPrediction")[1]
    judged = model.transform(train).select("features", y.alias("y"), margin.alias("m"))
    weights = [F.greatest(F.lit(0.0), F.least(F.lit(1.0), (1 - F.col("m")) / r + 0.5)) for r in ramps]
    sides = {1: F.col("y") > 0, -1: F.col("y") < 0}
    sums = judged.agg(
        F.count("*").alias("n"),
        F.sum(F.greatest(1 - F.col("m"), F.lit(0.0))).alias("hinge"),
        *[F.sum(F.when(on, w).otherwise(0.0)).alias(f"s{i}_{k}") for i, w in enumerate(weights) for k, on in sides.items()],
    ).first()
    n = sums["n"]
    if not n:
        raise ValueError("no rows")
    coefficients = model.coefficients.toArray()
    primal = sums["hinge"] / n + reg_param / 2 * float(coefficients @ coefficients)
    each = [
        Summarizer.metrics("sum").summary(F.col("features"), F.when(on, w).otherwise(0.0)).getField("sum").alias(f"v{i}_{k}")
        for i, w in enumerate(weights)
        for k, on in sides.items()
    ]
    vectors = judged.agg(*each).first()
    dual = 0.0
    for i in range(len(ramps)):
        total = {k: sums[f"s{i}_{k}"] for k in sides}
        equal = min(total.values())
        if equal <= 0:
            continue
        # Equal sums of dual weights, as the intercept is not regularised.
        v = sum(k * vectors[f"v{i}_{k}"].toArray() * (equal / total[k]) for k in sides) / n
        mean, square = 2 * equal / n, float(v @ v) / reg_param
        scale = min(1.0, mean / square) if square > 0 else 1.0
        dual = max(dual, scale * mean - scale * scale * square / 2)
    return Certificate(n, primal, dual)
