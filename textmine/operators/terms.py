"""Term statistics of a corpus: counts, document frequency, vocabulary, IDF and TF-IDF.

A corpus is any DataFrame with a ``text`` column. Terms are counted inside each row, so the only
shuffle over the text is the aggregation by term, which combines on the map side first.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmine.functions.tokens import content_words, count_text_terms, tokenize
from textmine.operators.lookup import lookup_join
from textmine.sources.scratch import written
from textmine.sources.tables import copy_to

MIN_DF = 5
FEW_TIES = 10_000
#: Stop words that stand in the plan. Longer lists are tables that counted terms are looked up in.
LISTED_WORDS = 1000


def term_counts(
    corpus: DataFrame,
    *keep: str,
    stop_words: Sequence[str] | None = None,
    document_rows: bool = False,
) -> DataFrame:
    """Long ``(*keep, term, tf)``; with ``document_rows`` each document adds a row without a term."""
    listed = [] if is_long_list(stop_words) else stop_words
    counted = count_text_terms("text", listed)
    if document_rows:
        document = F.expr("array(named_struct('term', cast(null AS string), 'tf', 0L))")
        counted = F.concat(document, counted)
    rows = corpus.select(*keep, F.inline(counted))
    return without_words(rows, stop_words) if is_long_list(stop_words) else rows


def term_occurrences(
    corpus: DataFrame, stop_words: Sequence[str] | None = None, document_rows: bool = False
) -> DataFrame:
    """``(term, before)``: every token, and the one before it in the sorted tokens of its document.

    A term's first token in a document has another term before it. That tells documents from occurrences in
    an aggregation by term, without counting inside the row. With ``document_rows`` each document adds a row
    without a term, which counts as a first one.
    """
    listed = [] if is_long_list(stop_words) else stop_words
    words = F.sort_array(content_words("text", listed))
    none = F.array(F.lit(None).cast("string"))
    words = corpus.select((F.concat(none, words) if document_rows else words).alias("_words"))
    shifted = F.slice(F.concat(F.array(F.lit("")), "_words"), F.lit(1), F.size("_words"))
    rows = words.select(F.inline(F.arrays_zip(F.col("_words").alias("term"), shifted.alias("before"))))
    rows = rows.toDF("term", "before")
    return without_words(rows, stop_words) if is_long_list(stop_words) else rows


def _frequencies(occurrences: DataFrame) -> DataFrame:
    first = ~F.col("term").eqNullSafe(F.col("before"))
    return occurrences.groupBy("term").agg(F.count_if(first).alias("df"), F.count("*").alias("cf"))


def is_long_list(stop_words: Sequence[str] | None) -> bool:
    return stop_words is not None and len(stop_words) > LISTED_WORDS


def without_words(rows: DataFrame, words: Sequence[str]) -> DataFrame:
    """Rows whose ``term`` is none of ``words``, which are in lower case or made so; null terms stay.

    The words are a table, so the plan is the same for a hundred thousand of them as for one.
    """
    distinct = sorted({word.lower() for word in words})
    table = copy_to(rows.sparkSession, [(word,) for word in distinct], "term string")
    size = sum(64 + len(word.encode()) for word in distinct)
    return lookup_join(rows, table, ["term"], size, spread_by=rows.columns, how="left_anti")


def document_frequency(corpus: DataFrame, stop_words: Sequence[str] | None = None) -> DataFrame:
    """``(term, df, cf)``: documents with the term, and its occurrences in the corpus."""
    return _frequencies(term_occurrences(corpus, stop_words))


def top_terms(frequencies: DataFrame, k: int) -> DataFrame:
    """The ``k`` most frequent terms, equal counts in alphabetical order."""
    return frequencies.orderBy(F.desc("cf"), "term").limit(k)


def _nth_term(terms: DataFrame, n: int) -> str:
    """The ``n``-th term in order, found by narrowing a prefix; only a few terms are ever sorted."""
    prefix, left = "", terms.count()
    while left > FEW_TIES:
        following = F.substring("term", len(prefix) + 1, 1).alias("c")
        same = terms.where(F.col("term").startswith(prefix))
        for row in same.groupBy(following).agg(F.count("*").alias("n")).orderBy("c").collect():
            if n <= row["n"]:
                break
            n -= row["n"]
        if row["c"] == "":  # the prefix itself is a term, and there is only one of it
            return prefix
        prefix, left = prefix + row["c"], row["n"]
    return terms.where(F.col("term").startswith(prefix)).orderBy("term").limit(n).agg(F.max("term")).first()[0]


def vocabulary_cut(frequencies: DataFrame, size: int) -> Column:
    """Condition on ``cf`` and ``term`` that holds for the ``size`` most frequent terms.

    For a stored table with more than ``size`` terms. The cut comes from the histogram of counts,
    not from ranking all terms in one task: with T tokens there are at most sqrt(2 T) different
    counts. Among terms with the count at the cut the first in alphabetical order are kept.
    """
    histogram = frequencies.groupBy("cf").agg(F.count("*").alias("terms"))
    falling = Window.orderBy(F.desc("cf")).rowsBetween(Window.unboundedPreceding, 0)
    cut = (
        histogram.withColumn("upto", F.sum("terms").over(falling))
        .where(F.col("upto") >= size)
        .orderBy(F.desc("cf"))
        .first()
    )
    room = size - (cut["upto"] - cut["terms"])
    last = _nth_term(frequencies.where(F.col("cf") == cut["cf"]).select("term"), room)
    return (F.col("cf") > cut["cf"]) | ((F.col("cf") == cut["cf"]) & (F.col("term") <= last))


def term_totals(frequencies: DataFrame) -> tuple[int, int]:
    """Number of terms and their bytes, for a table with one row per term."""
    n_terms, term_bytes = frequencies.agg(F.count("*"), F.sum(F.octet_length("term"))).first()
    return n_terms, term_bytes or 0


def idf(n_docs: int, df: Column) -> Column:
    return F.log((F.lit(n_docs) + 1) / (df + 1))


class Vocabulary(NamedTuple):
    """Kept terms ``(term, df, cf, idf)`` as a stored table, with their number and size.

    ``left_out`` counts the terms that an explicit size did not keep.
    """

    table: DataFrame
    n_docs: int
    n_terms: int
    term_bytes: int
    left_out: int = 0

    def row_bytes(self, values: int) -> int:
        """Rough size in memory of a lookup table with ``values`` numbers per term."""
        return self.term_bytes + self.n_terms * (64 + 8 * values)


def fit_vocabulary(
    corpus: DataFrame,
    min_df: float = MIN_DF,
    size: int | None = None,
    stop_words: Sequence[str] | None = None,
) -> Vocabulary:
    """Vocabulary and IDF from one pass over the text; documents are counted in the same pass.

    ``min_df`` below 1 is a share of all documents, otherwise a number of documents. All such terms
    are kept unless ``size`` asks for the most frequent ones only.
    """
    counted = _frequencies(term_occurrences(corpus, stop_words, document_rows=True))
    if min_df >= 1:
        counted = counted.where(F.col("term").isNull() | (F.col("df") >= min_df))
    stored = written(counted, "vocabulary")
    documents = stored.where(F.col("term").isNull()).first()
    n_docs = documents["df"] if documents else 0
    least = min_df if min_df >= 1 else min_df * n_docs
    kept = stored.where(F.col("term").isNotNull() & (F.col("df") >= least))
    kept = kept.withColumn("idf", idf(n_docs, F.col("df")))
    n_terms, term_bytes = term_totals(kept)
    if size is not None and n_terms > size:
        left_out = n_terms - size
        kept = kept.where(vocabulary_cut(kept, size))
        return Vocabulary(kept, n_docs, *term_totals(kept), left_out)
    return Vocabulary(kept, n_docs, n_terms, term_bytes)


def idf_weights(vocabulary: Vocabulary) -> DataFrame:
    return vocabulary.table.select("term", "df", "idf")


def vocabulary_counts(
    corpus: DataFrame,
    vocabulary: Vocabulary,
    *key: str,
    stop_words: Sequence[str] | None = None,
) -> DataFrame:
    """Long ``(*key, term, tf, idf)`` with the vocabulary's terms only."""
    return lookup_join(
        term_counts(corpus, *key, stop_words=stop_words),
        vocabulary.table.select("term", "idf", F.col("df").alias("_df")),
        ["term"],
        vocabulary.row_bytes(1),
        spread_by=key,
        frequency="_df",
    ).select(*key, "term", "tf", "idf")


def tfidf(
    corpus: DataFrame,
    vocabulary: Vocabulary,
    *key: str,
    stop_words: Sequence[str] | None = None,
) -> DataFrame:
    """Long ``(*key, term, tf, tfidf)``."""
    counts = vocabulary_counts(corpus, vocabulary, *key, stop_words=stop_words)
    return counts.select(*key, "term", "tf", (F.col("tf") * F.col("idf")).alias("tfidf"))


def word_frequency(corpus: DataFrame, words: Sequence[str]) -> DataFrame:
    """How often each of a local list of words occurs among the raw tokens, 0 included."""
    words = list(dict.fromkeys(words))
    listed = copy_to(corpus.sparkSession, [(word,) for word in words], "word string")
    size = sum(64 + len(word.encode()) for word in words)
    tokens = corpus.select(F.explode(tokenize("text")).alias("word"))
    found = (
        lookup_join(tokens, listed, ["word"], size, spread_by=["word"], how="left_semi")
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )
    return listed.join(found, "word", "left").select("word", F.coalesce("n", F.lit(0)).alias("n"))
