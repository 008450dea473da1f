from textmine.operators.bayes import (
    BayesModels,
    BayesStatistics,
    best_smoothing,
    class_priors,
    fit_models,
    fit_statistics,
    score,
    term_weights,
    tested,
    validate,
    validation_metrics,
)
from textmine.operators.corpus import (
    build_corpus,
    clean_corpus,
    count_by,
    describe,
    preview,
    row_count,
    schema_rows,
)
from textmine.operators.dictionary import add_vectors, numbered_terms
from textmine.operators.evaluation import (
    confusion_long,
    confusion_table,
    confusion_wide,
    evaluate,
    metrics,
    prediction_pairs,
    without_class,
)
from textmine.operators.labels import (
    binary_label,
    fit_label_indexer,
    hash_split,
    index_to_string,
    label_index,
    random_split,
)
from textmine.operators.lookup import lookup_join
from textmine.operators.terms import (
    Vocabulary,
    document_frequency,
    fit_vocabulary,
    idf_weights,
    term_counts,
    tfidf,
    top_terms,
    vocabulary_counts,
    vocabulary_cut,
    word_frequency,
)

__all__ = [
    "BayesModels",
    "BayesStatistics",
    "Vocabulary",
    "add_vectors",
    "best_smoothing",
    "binary_label",
    "build_corpus",
    "class_priors",
    "clean_corpus",
    "confusion_long",
    "confusion_table",
    "confusion_wide",
    "count_by",
    "describe",
    "document_frequency",
    "evaluate",
    "fit_label_indexer",
    "fit_models",
    "fit_statistics",
    "fit_vocabulary",
    "hash_split",
    "idf_weights",
    "index_to_string",
    "label_index",
    "lookup_join",
    "metrics",
    "numbered_terms",
    "prediction_pairs",
    "preview",
    "random_split",
    "row_count",
    "schema_rows",
    "score",
    "term_counts",
    "term_weights",
    "tested",
    "tfidf",
    "top_terms",
    "validate",
    "validation_metrics",
    "vocabulary_counts",
    "vocabulary_cut",
    "without_class",
    "word_frequency",
]
