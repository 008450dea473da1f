from textmine.plans.classification import (
    Certificate,
    bayes_pipeline,
    class_labels,
    cross_validator,
    fit_linear_svc,
    naive_bayes_pipeline,
    param_grid,
    predict,
    smoothing_grid,
    stage_names,
    svc_certificate,
    validation_metrics,
)
from textmine.plans.features import (
    add_features,
    feature_model,
    fit_features,
    preprocessing_pipeline,
    vector_entries,
)

__all__ = [
    "Certificate",
    "add_features",
    "bayes_pipeline",
    "class_labels",
    "cross_validator",
    "feature_model",
    "fit_features",
    "fit_linear_svc",
    "naive_bayes_pipeline",
    "param_grid",
    "predict",
    "preprocessing_pipeline",
    "smoothing_grid",
    "stage_names",
    "svc_certificate",
    "validation_metrics",
    "vector_entries",
]
