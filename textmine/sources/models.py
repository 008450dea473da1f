"""Save and load pipelines and fitted models, those of Spark and the aggregated naive Bayes statistics."""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

FORMAT = 1


def save_model(model, path: str) -> None:
    """Write a pipeline, fitted or not, replacing what is at ``path``."""
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> Pipeline:
    return Pipeline.load(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def _manifests(spark: SparkSession, path: str) -> dict[int, dict]:
    """Committed versions below ``path``."""
    try:
        rows = spark.read.schema("value string, version int").text(f"{path}/manifests").collect()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return {}
    return {row["version"]: json.loads(row["value"]) for row in rows}


def model_versions(spark: SparkSession, path: str) -> list[int]:
    """The versions saved at ``path``, oldest first."""
    return sorted(_manifests(spark, path))


def save_bayes(statistics, path: str) -> int:
    """Save naive Bayes statistics as the next version in a model folder and give its number.

    The tables of a version have a folder of their own. Its manifest, one line of JSON, is written when
    they are complete, through Spark's output committer: a version without a committed manifest does not
    exist, so a failed or killed save leaves the earlier versions as they are. Of two savers that take the
    same number, the later one fails. Nothing of the text is read again.
    """
    spark = statistics.terms.sparkSession
    path = path.rstrip("/")
    version = max(_manifests(spark, path), default=0) + 1
    folder = f"data/{version}-{uuid.uuid4().hex}"
    statistics.terms.write.parquet(f"{path}/{folder}/terms")
    cat = StructField("cat", statistics.terms.schema["cat"].dataType)
    fields = [cat, StructField("fold", IntegerType()), StructField("docs", LongType()), StructField("weight", DoubleType())]
    pairs = [(c, fold, n, float(statistics.weights[c, fold])) for (c, fold), n in statistics.docs.items()]
    spark.createDataFrame(pairs, StructType(fields)).coalesce(1).write.parquet(f"{path}/{folder}/classes")
    stored = spark.read.parquet(f"{path}/{folder}/terms")
    manifest = {
        "format": FORMAT,
        "kind": "naive Bayes statistics",
        "folder": folder,
        "terms_schema": json.loads(statistics.terms.schema.json()),
        "term_rows": stored.count(),
        "class_rows": len(pairs),
        "n_terms": statistics.n_terms,
        "term_bytes": statistics.term_bytes,
        "stop_words": statistics.stop_words,
    }
    line = spark.createDataFrame([(json.dumps(manifest),)], "value string")
    line.coalesce(1).write.mode("error").text(f"{path}/manifests/version={version}")
    return version


def load_bayes(spark: SparkSession, path: str, version: int | None = None):
    """The statistics of a version, the latest unless given. They score and tune as the saved ones did."""
    from textmine.operators.bayes import BayesStatistics

    path = path.rstrip("/")
    found = _manifests(spark, path)
    if version is None:
        version = max(found, default=None)
    if version not in found:
        raise ValueError(f"no version {version} at {path}; there are {sorted(found)}")
    manifest = found[version]
    if manifest["format"] != FORMAT:
        raise ValueError(f"format {manifest['format']} of {path} is not known here, only {FORMAT}")
    schema = StructType.fromJson(manifest["terms_schema"])
    terms = spark.read.schema(schema).parquet(f"{path}/{manifest['folder']}/terms")
    classes = spark.read.parquet(f"{path}/{manifest['folder']}/classes").collect()
    rows = terms.count()
    if rows != manifest["term_rows"] or len(classes) != manifest["class_rows"]:
        raise ValueError(f"version {version} of {path} is damaged: it has not the rows of its manifest")
    return BayesStatistics(
        terms,
        {(r["cat"], r["fold"]): r["docs"] for r in classes},
        {(r["cat"], r["fold"]): r["weight"] for r in classes},
        sorted({r["cat"] for r in classes}),
        manifest["n_terms"],
        manifest["term_bytes"],
        manifest["stop_words"],
    )
