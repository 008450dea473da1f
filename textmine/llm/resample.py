"""Importance resampling towards a target distribution.

Texts are bags of hashed word runs. The log ratio of target to raw frequency of every bucket stands in
one array, and a document's weight is the sum of the array's entries at its features. Gumbel noise from a
hash of the id turns drawing without replacement into taking the highest scores.

Ranks come from parallel sorting by regular sampling: runs are sorted where they lie, rows at regular
places of every run give splitters, segments between splitters are exchanged and sorted, and the counts of
the segments before it give a segment's first rank. Segments hold about twice their share of rows at most.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmine.llm.wordhash import slices, split_batch
from textmine.sources.scratch import written

BUCKETS = 10_000
MAX_WORDS = 1
MIN_WORDS = 20
PERCENT = 10
SEED = "2024"
#: Rows that a sorted run should hold, and runs at most: the samples are their square.
RUN_ROWS, MOST_RUNS = 4_000_000, 500

# ASCII letters and digits and all other characters form words; capitals A to Z become small.
_BYTES = np.arange(256, dtype=np.uint8)
_BYTES[[b for b in range(128) if not chr(b).isalnum()]] = ord(" ")
_BYTES[ord("A") : ord("Z") + 1] += 32


def _plain(texts: pa.Array) -> pa.LargeStringArray:
    """The texts in lower case with a blank for every character outside words. Bytes keep their places."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    content = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.empty(0, np.uint8)
    buffers = [pa.py_buffer(np.ascontiguousarray(offsets - offsets[0])), pa.py_buffer(_BYTES[content])]
    return pa.LargeStringArray.from_buffers(len(texts), *buffers)


def _features(texts: pa.Array, max_words: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, and the text and bucket of every feature."""
    flat, offsets = split_batch(_plain(texts))
    coded = flat.dictionary_encode()
    unique = [word.encode() for word in coded.dictionary.to_pylist()]
    codes = coded.indices.to_numpy().astype(np.int64)
    n_words = np.diff(offsets)
    owner = np.repeat(np.arange(len(n_words)), n_words)
    crc = np.array([zlib.crc32(word) for word in unique], np.int64)[codes] if unique else np.empty(0, np.int64)
    owners, found = [owner], [crc % buckets]
    for size in range(2, max_words + 1):
        # A run goes on with a blank and its next word, if that belongs to the same text.
        at = np.flatnonzero(owner[size - 1 :] == owner[: max(0, len(owner) - size + 1)])
        crc = np.array(
            [zlib.crc32(b" " + unique[w], int(c)) for c, w in zip(crc[at], codes[at + size - 1])], np.int64
        )
        longer = np.zeros(len(codes), np.int64)
        longer[at] = crc
        owners.append(owner[at])
        found.append(crc % buckets)
        crc = longer
    return n_words, np.concatenate(owners), np.concatenate(found)


def _count(max_words: int, buckets: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                total += np.bincount(_features(part.column(0), max_words, buckets)[2], minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])

    return task


def bucket_counts(
    texts: DataFrame, text: str = "text", max_words: int = MAX_WORDS, buckets: int = BUCKETS
) -> np.ndarray:
    """Features of all texts per bucket; a task sends one row per bucket."""
    found = texts.select(F.col(text)).mapInArrow(_count(max_words, buckets), "bucket long, n long")
    counts = np.zeros(buckets, np.int64)
    for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most one row per bucket
        counts[row["bucket"]] = row["n"]
    return counts


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of target to raw frequency, counted up by one, rounded down."""
    buckets = len(raw)
    total, wanted = int(raw.sum()), int(target.sum())
    return np.array(
        [
            floor(1000 * log(float((t + 1) * (total + buckets)) / float((s + 1) * (wanted + buckets))))
            for s, t in zip(raw.tolist(), target.tolist())
        ],
        np.int64,
    )


def _weigh(gains: np.ndarray, max_words: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                n_words, owner, bucket = _features(part.column(1), max_words, len(gains))
                # Sums of whole numbers, exact as doubles below 2^53.
                weight = np.bincount(owner, gains[bucket], len(n_words)).astype(np.int64)
                features = np.bincount(owner, minlength=len(n_words)).astype(np.int64)
                columns = [part.column(0), pa.array(n_words.astype(np.int64)), pa.array(features), pa.array(weight)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight"])

    return task


def gumbel(doc_id: Column, seed: str = SEED) -> Column:
    """Thousandths of a Gumbel variable, rounded down, from a hash of the id; null counts as ``null``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


# Parallel sorting by regular sampling --------------------------------------------------------------

_PLACE_BITS = 33  # of the row numbers that Spark deals out within a partition


def _sorted_runs(rows: DataFrame, *first: str) -> DataFrame:
    """Every partition in order, with the partition in ``run`` and the place in ``place``."""
    ordered = rows.sortWithinPartitions(*first, F.desc("score"), F.asc_nulls_last("doc_id"))
    numbered = ordered.withColumn("_n", F.monotonically_increasing_id())
    return numbered.withColumns(
        {"run": F.shiftright("_n", _PLACE_BITS), "place": F.col("_n").bitwiseAND((1 << _PLACE_BITS) - 1)}
    ).drop("_n")


def _segments(scores: np.ndarray, ids: np.ndarray):
    """Adds to each row the number of splitters, in descending order of score, before it."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = -batch.column("score").to_numpy()
            doc_id = batch.column("doc_id").fill_null(np.iinfo(np.int64).max).to_numpy()
            low, high = np.searchsorted(-scores, score, "left"), np.searchsorted(-scores, score, "right")
            for a, b in np.unique(np.stack([low, high], axis=1)[high > low], axis=0):
                tied = np.flatnonzero((low == a) & (high == b))
                low[tied] = a + np.searchsorted(ids[a:b], doc_id[tied], "right")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(low.astype(np.int32))], [*batch.schema.names, "segment"]
            )

    return task


def ranked(rows: DataFrame, run_rows: int = RUN_ROWS, runs: int | None = None) -> DataFrame:
    """A stored table of ``rows`` with ``rank`` from 1 on: highest ``score`` first, then smallest ``doc_id``.

    ``rows`` is a stored table with both columns whole numbers; null ids come last among equal scores, and
    equal rows take neighbouring ranks. ``runs`` sorted runs, from the number of rows unless given, each
    give as many samples.
    """
    spark = rows.sparkSession
    if runs is None:
        runs = max(spark.sparkContext.defaultParallelism, -(-rows.count() // run_rows))
    runs = max(1, min(runs, MOST_RUNS))
    dealt = rows.coalesce(runs) if rows.rdd.getNumPartitions() >= runs else rows.repartition(runs)
    stored = written(_sorted_runs(dealt), "sorted-runs")
    sizes = stored.groupBy("run").agg(F.count("*").alias("size"))
    step = F.greatest(F.lit(1), F.ceil(F.col("size") / runs))
    regular = stored.join(F.broadcast(sizes), "run").where(F.col("place") % step == F.floor(step / 2))
    # At most runs times runs rows.
    taken = regular.select("score", "doc_id").toArrow()
    scores = taken.column("score").to_numpy().astype(np.int64)
    ids = taken.column("doc_id").fill_null(np.iinfo(np.int64).max).to_numpy().astype(np.int64)
    order = np.lexsort((ids, -scores))
    at = order[(np.arange(1, runs) * len(order)) // runs] if len(order) else order
    kept = stored.drop("run", "place")
    schema = ", ".join(f"`{name}` {kind}" for name, kind in kept.dtypes) + ", segment int"
    exchanged = kept.mapInArrow(_segments(scores[at], ids[at]), schema).repartitionById(runs, F.col("segment"))
    merged = written(_sorted_runs(exchanged, "segment"), "segments")
    counts = merged.groupBy("segment").agg(F.count("*").alias("n"), F.min("place").alias("first")).collect()
    before, starts = 0, []
    for row in sorted(counts, key=lambda r: r["segment"]):
        starts.append((row["segment"], before - row["first"] + 1))
        before += row["n"]
    table = spark.createDataFrame(starts, "segment int, start long")
    placed = merged.join(F.broadcast(table), "segment")
    return placed.withColumn("rank", F.col("place") + F.col("start")).select(*rows.columns, "rank")


def importance_resampled(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    max_words: int = MAX_WORDS,
    buckets: int = BUCKETS,
    seed: str = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row of ``docs``.

    Words are runs of ASCII letters, digits and characters beyond ASCII, A to Z lower-cased; features are
    all runs of up to ``max_words`` of them. Of the documents with at least ``min_words`` words
    ``percent`` in a hundred, rounded down, are drawn: those with the highest scores, ties to smaller ids.
    ``rank`` numbers them and is null for all others. Ids are whole numbers.

    Null and empty texts have no features and weight 0. Repeated rows draw with the same noise and take
    neighbouring ranks; null ids share one noise and come last among equal scores. Without target texts
    the target is uniform. An empty table gives an empty result; other columns are ignored.
    """
    gains = bucket_gains(bucket_counts(docs, text, max_words, buckets), bucket_counts(target, text, max_words, buckets))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, n_words long, n_features long, weight long"
    weighed = rows.mapInArrow(_weigh(gains, max_words), schema)
    scored = weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    stored = written(scored, "scored")
    able = stored.where(F.col("n_words") >= min_words)
    drawn = percent * able.count() // 100
    chosen = ranked(able).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    others = stored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return chosen.unionByName(others).select("doc_id", "n_features", "weight", "score", "rank")
