from textmine.sources.files import (
    CORPUS,
    RAW_POSTS,
    all_strings,
    read_csv,
    read_json,
    read_parquet,
    read_raw_posts,
    spread,
    writable_features,
    write_csv,
    write_json,
    write_parquet,
)
from textmine.sources.models import load_bayes, load_model, load_pipeline, model_versions, save_bayes, save_model
from textmine.sources.scratch import remove_scratch, scratch_dir, scratch_path, with_row_id, written
from textmine.sources.tables import (
    cache_table,
    collect_small,
    compute,
    copy_to,
    uncache_table,
)

__all__ = [
    "CORPUS",
    "RAW_POSTS",
    "all_strings",
    "cache_table",
    "collect_small",
    "compute",
    "copy_to",
    "load_bayes",
    "load_model",
    "load_pipeline",
    "model_versions",
    "read_csv",
    "read_json",
    "read_parquet",
    "read_raw_posts",
    "save_bayes",
    "save_model",
    "remove_scratch",
    "scratch_dir",
    "scratch_path",
    "spread",
    "uncache_table",
    "with_row_id",
    "writable_features",
    "write_csv",
    "write_json",
    "write_parquet",
    "written",
]
