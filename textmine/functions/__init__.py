from textmine.functions.cleaning import (
    clean,
    concat_fields,
    strip_digits,
    strip_line_breaks,
    strip_punctuation,
    strip_tags,
)
from textmine.functions.splits import TEST_FOLD, fold_of, hash_bucket, split_part
from textmine.functions.tokens import (
    content_words,
    count_terms,
    count_text_terms,
    default_stop_words,
    remove_stop_words,
    tokenize,
)

__all__ = [
    "TEST_FOLD",
    "clean",
    "concat_fields",
    "content_words",
    "count_terms",
    "count_text_terms",
    "default_stop_words",
    "fold_of",
    "hash_bucket",
    "remove_stop_words",
    "split_part",
    "strip_digits",
    "strip_line_breaks",
    "strip_punctuation",
    "strip_tags",
    "tokenize",
]
