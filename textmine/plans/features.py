"""Feature pipelines: text to a sparse TF-IDF vector."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    ElementwiseProduct,
    RegexTokenizer,
    StopWordsRemover,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmine.functions.tokens import default_stop_words
from textmine.operators.terms import MIN_DF, Vocabulary, fit_vocabulary

# The vectoriser's own default: a vocabulary goes to the driver and into every task. The long-table
# operators keep every term.
VOCAB_SIZE = 1 << 18
VOCABULARY_LIMIT_BYTES = 256 * 1024 * 1024


def _token_stages(stop_words: Sequence[str] | None) -> list:
    return [
        RegexTokenizer(
            inputCol="text",
            outputCol="words",
            pattern=r"\s+",
            gaps=True,
            minTokenLength=2,
            toLowercase=True,
        ),
        StopWordsRemover(
            inputCol="words",
            outputCol="words2",
            stopWords=default_stop_words() if stop_words is None else list(stop_words),
        ),
    ]


def preprocessing_pipeline(
    min_df: float = MIN_DF,
    vocab_size: int = VOCAB_SIZE,
    stop_words: Sequence[str] | None = None,
) -> Pipeline:
    """Unfitted pipeline: tokens, stop words, term frequency, TF-IDF. ``text`` must not be null.

    Fitting it reads the text twice, and its vectoriser brings up to ``vocab_size`` candidates per
    partition to the driver. ``fit_features`` gives the same features from one pass without that.
    """
    return Pipeline(
        stages=[
            *_token_stages(stop_words),
            CountVectorizer(
                inputCol="words2",
                outputCol="raw_features",
                minDF=float(min_df),
                vocabSize=vocab_size,
            ),
            IDF(inputCol="raw_features", outputCol="features"),
        ]
    )


def feature_model(
    vocabulary: Vocabulary, stop_words: Sequence[str] | None = None
) -> PipelineModel:
    """Fitted pipeline for a vocabulary.

    The vectoriser is fitted on the vocabulary table, one row per term, so the text is not read
    again and the driver only ever sees the kept terms.
    """
    if vocabulary.term_bytes > VOCABULARY_LIMIT_BYTES:
        raise ValueError(
            f"vocabulary text takes {vocabulary.term_bytes} bytes; use tfidf() on long rows"
        )
    terms = vocabulary.table.select("term", "idf")
    vectorizer = CountVectorizer(
        inputCol="words2",
        outputCol="raw_features",
        minDF=1.0,
        vocabSize=max(vocabulary.n_terms, 1),
    ).fit(terms.select(F.array("term").alias("words2")))
    known = terms.toPandas().set_index("term")["idf"]
    weights = ElementwiseProduct(
        inputCol="raw_features",
        outputCol="features",
        scalingVec=Vectors.dense(known.loc[vectorizer.vocabulary].to_numpy()),
    )
    return PipelineModel(stages=[*_token_stages(stop_words), vectorizer, weights])


def fit_features(
    corpus: DataFrame,
    min_df: float = MIN_DF,
    vocab_size: int = VOCAB_SIZE,
    stop_words: Sequence[str] | None = None,
    fit_on: DataFrame | None = None,
) -> PipelineModel:
    """Fit the feature pipeline in one pass over the text.

    Document frequency gives both vocabulary and IDF, and the set of kept terms does not depend on
    partitioning. The default fits on the whole corpus; ``fit_on`` restricts it, say to training rows.
    Vectors have at most ``vocab_size`` entries; ``fit_vocabulary(...).left_out`` tells how many terms
    that leaves out.
    """
    source = corpus if fit_on is None else fit_on
    return feature_model(fit_vocabulary(source, min_df, vocab_size, stop_words), stop_words)


def add_features(model: PipelineModel, corpus: DataFrame) -> DataFrame:
    """Apply a fitted feature pipeline; missing text counts as empty."""
    return model.transform(corpus.withColumn("text", F.coalesce("text", F.lit(""))))


def vector_entries(df: DataFrame, vector: str, *key: str) -> DataFrame:
    """Non-zero entries of a sparse vector column as long ``(*key, index, value)`` rows."""
    return df.select(*key, F.unwrap_udt(vector).alias("v")).select(
        *key, F.inline(F.arrays_zip(F.col("v.indices"), F.col("v.values")))
    ).toDF(*key, "index", "value")

