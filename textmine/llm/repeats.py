"""Substring dedup: words in passages that already stand earlier in the corpus.

Seed and extend. Every window of ``window`` words has one anchor, the run of six words in it with the
smallest hash, so equal windows have equal anchors. Adjacent windows with the same anchor form a stretch:
the anchor extended both ways as far as it decides. Stretches meet by anchor:

* if all of an anchor's stretches are equal, the earliest document keeps it and the others lose it whole;
* if they differ, their windows are compared one by one, by hash.

No single 64-bit hash decides. Stretches are equal if their anchors and their contents agree (128 bits),
windows if both lanes of their hash do (96 bits: less than one false pair in a thousand runs over 10^13
windows), and what repeats inside a text is compared word by word.

An anchor that stands once costs a row and no more, copies never meet in pairs, and a passage in a third
of all documents is a count that is combined before the shuffle. What adjoins becomes a maximal repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmine.llm.common import text_hash
from textmine.llm.wordhash import MIX, SpanHash, gram_hashes, hash_words, scramble, slices, split_batch

WINDOW = 20
ANCHOR_WORDS = 6
NULL_ID = -(2**63)
# A place is start * PLACES + count; a stretch has fewer windows than that.
PLACES = 1024


def _window_starts(offsets: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all windows within texts, and the text of each."""
    counts = np.maximum(np.diff(offsets) - window + 1, 0)
    first = np.concatenate([[0], np.cumsum(counts)])
    owner = np.repeat(np.arange(len(counts)), counts)
    return np.arange(first[-1]) - first[:-1][owner] + offsets[:-1][owner], owner


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost smallest of the ``width`` values from each position on."""
    n = len(values)
    padded = np.concatenate([values, np.full(width, np.uint64(2**64 - 1))])
    best = np.arange(n + width)
    span = 1
    while span < width:
        step = min(span, width - span)
        ahead = np.concatenate([best[step:], best[-1:].repeat(step)])
        best = np.where(padded[ahead] < padded[best], ahead, best)
        span += step
    return best[:n]


class _Stretches:
    """Stretches of all texts of a piece: word positions, text, anchor and content hash."""

    def __init__(self, hashes: np.ndarray, offsets: np.ndarray, window: int):
        starts, owner = _window_starts(offsets, window)
        anchors = gram_hashes(hashes, ANCHOR_WORDS)
        seat = _smallest(anchors, window - ANCHOR_WORDS + 1)[starts] if len(starts) else starts
        new = np.ones(len(starts), bool)
        new[1:] = (seat[1:] != seat[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(new)
        self.start, self.owner = starts[at], owner[at]
        self.count = np.diff(np.concatenate([at, [len(starts)]]))
        self.anchor = anchors[seat[at]] if len(at) else np.empty(0, np.uint64)
        content = SpanHash(hashes)(self.start, self.start + self.count + window - 1)
        place = ((seat[at] - self.start) * PLACES + self.count).astype(np.uint64)
        self.content = scramble(content ^ (place * MIX))


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


def window_hash(hashes: np.ndarray) -> SpanHash:
    """First hash of the windows of words with the given hashes."""
    return SpanHash(hashes)


def _second_lane(hashes: np.ndarray) -> np.ndarray:
    """Word hashes for a second, independent hash of a run of words."""
    return scramble(hashes ^ MIX)


def _seed(window: int):
    """Stretches of ``(*key, text)``: start and count packed in one number."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.num_columns - 1
            for part in slices(batch, keys):
                flat, offsets = split_batch(part.column(keys))
                found = _Stretches(hash_words(flat), offsets, window)
                rows = pa.array(found.owner)
                place = (found.start - offsets[found.owner]) * PLACES + found.count
                columns = [_signed(found.anchor), _signed(found.content), pa.array(place)]
                columns += [part.column(k).take(rows) for k in range(keys)]
                names = ["anchor", "content", "place", *batch.schema.names[:keys]]
                yield pa.RecordBatch.from_arrays(columns, names)

    return task


def _listed(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and count of all entries of a column of packed places."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    place = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return np.repeat(np.arange(len(sizes)), sizes), place // PLACES, place % PLACES


def _compare(window: int):
    """Hash and place of every window in the listed stretches of ``(*key, text, stretches)``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.num_columns - 2
            for part in slices(batch, keys):
                flat, offsets = split_batch(part.column(keys))
                hashes = hash_words(flat)
                content, check = window_hash(hashes), SpanHash(_second_lane(hashes))
                row, start, count = _listed(part.column(keys + 1))
                each = np.repeat(np.arange(len(row)), count)
                local = start[each] + np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
                at = local + offsets[row[each]]
                owner = pa.array(row[each])
                lane = (check(at, at + window) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                columns = [_signed(content(at, at + window)), pa.array(lane), pa.array(local * PLACES + 1)]
                columns += [part.column(k).take(owner) for k in range(keys)]
                names = ["content", "check", "place", *batch.schema.names[:keys]]
                yield pa.RecordBatch.from_arrays(columns, names)

    return task


def _repeated_inside(hashes: np.ndarray, offsets: np.ndarray, window: int) -> np.ndarray:
    """Positions of windows that stand earlier in the same text."""
    starts, owner = _window_starts(offsets, window)
    if not len(starts):
        return starts
    key = window_hash(hashes)(starts, starts + window) ^ scramble(owner.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    at = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    later, earlier = order[at + 1], order[at]
    equal = owner[later] == owner[earlier]
    for i in range(window):
        equal &= hashes[starts[later] + i] == hashes[starts[earlier] + i]
    if equal.all():
        return starts[later]
    # Different windows share a key: all windows of shared keys are told apart by their words.
    seen: set[tuple[int, bytes]] = set()
    found = []
    for i in np.unique(np.concatenate([earlier, later])):
        own = (int(owner[i]), hashes[starts[i] : starts[i] + window].tobytes())
        if own in seen:
            found.append(starts[i])
        seen.add(own)
    return np.array(found, np.int64)


def _join_words(flat: pa.Array, offsets: np.ndarray) -> pa.Array:
    lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), flat)
    return pc.binary_join(lists, pa.scalar(" ", flat.type)).cast(pa.large_string())


def _dealt_anew(table: DataFrame, key: str) -> DataFrame:
    """The same rows under a key that Spark does not know to be dealt out already.

    A join on the key an aggregation was dealt by would run in that stage, where a hot key cannot be
    split; with a shuffle of its own on either side it can.
    """
    return table.withColumn(key, F.col(key).bitwiseXOR(F.lit(0)))


RESULT = "n_words long, n_removed long, kept string, spans array<struct<start: int, length: int>>"


def _remove(window: int):
    def cut(part: pa.RecordBatch) -> pa.RecordBatch:
        flat, offsets = split_batch(part.column(1))
        inside = _repeated_inside(hash_words(flat), offsets, window)
        row, start, count = _listed(part.column(2))
        begin = np.concatenate([inside, start + offsets[row]])
        end = np.concatenate([inside + window, start + offsets[row] + count + window - 1])
        edge = np.bincount(begin, minlength=len(flat) + 1) - np.bincount(end, minlength=len(flat) + 1)
        removed = np.cumsum(edge[: len(flat)]) > 0
        before = np.concatenate([[0], np.cumsum(~removed)])
        kept = _join_words(flat.filter(pa.array(~removed)), before[offsets])
        n_words = np.diff(offsets)
        n_kept = np.diff(before[offsets])
        # Maximal repeats: runs of removed words, cut where a text begins.
        first = np.zeros(len(flat) + 1, bool)
        first[offsets] = True
        head = np.flatnonzero(removed & (first[:-1] | ~np.concatenate([[False], removed[:-1]])))
        tail = np.flatnonzero(removed & (first[1:] | ~np.concatenate([removed[1:], [False]])))
        owner = np.searchsorted(offsets, head, side="right") - 1
        spans = pa.StructArray.from_arrays(
            [pa.array((head - offsets[owner]).astype(np.int32)), pa.array((tail - head + 1).astype(np.int32))],
            ["start", "length"],
        )
        bounds = np.searchsorted(head, offsets)
        lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), spans)
        return pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(n_words), pa.array(n_words - n_kept), kept.cast(pa.string()), lists],
            ["doc_id", "n_words", "n_removed", "kept", "spans"],
        )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                yield cut(part)

    return task


def remove_repeats(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept, spans``: each text without what stands earlier.

    A word goes if a window of ``window`` words around it also starts earlier: in a document with a
    smaller id, or earlier in the same one. Windows are judged on the input. ``kept`` joins the other
    words by one space, ``spans`` lists the maximal repeats as ``(start, length)`` in words.

    Ids are whole numbers; a null id comes before all others. Rows with the same id do not precede one
    another, each is cut on its own. Null and empty texts have no words; texts shorter than a window
    stay as they are; an empty table gives an empty result; other columns are ignored.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    doc = F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID).cast("long"))
    texts = docs.select(doc.alias("doc"), F.col(text).alias("text"))
    repeated_ids = texts.groupBy("doc").agg(F.count("*").alias("n")).where((F.col("n") > 1) | (F.col("doc") == NULL_ID))
    key, longs, collect = ["doc"], "doc long", F.collect_list
    if not repeated_ids.isEmpty():
        # Where an id does not tell rows apart, a hash of the text does; equal rows list each place once.
        own = F.coalesce(text_hash(F.col("text")), F.lit(0).cast("long"))
        texts = texts.withColumn("hash", own)
        key, longs, collect = ["doc", "hash"], "doc long, hash long", F.collect_set
    texts = texts.select(*key, "text")

    seeds = texts.mapInArrow(_seed(window), f"anchor long, content long, place long, {longs}")
    met = (
        seeds.groupBy("anchor")
        .agg(
            F.count("*").alias("n"),
            F.min("content").alias("low"),
            F.max("content").alias("high"),
            F.min("doc").alias("first"),
        )
        .where(F.col("n") > 1)
        .select("anchor", "first", (F.col("low") == F.col("high")).alias("equal"))
    )
    seen = seeds.drop("content").join(_dealt_anew(met, "anchor").hint("merge"), "anchor")
    # What goes for certain as it is, what has to be compared below zero: one list that both joins
    # below read, as they read the same texts, so that texts and lists are each shuffled once.
    signed = F.when(F.col("equal"), F.col("place")).otherwise(-F.col("place"))
    per_doc = (
        seen.where(~F.col("equal") | (F.col("doc") > F.col("first")))
        .groupBy(*key)
        .agg(collect(signed).alias("places"))
    )
    asked = texts.join(per_doc.hint("merge"), key).where(F.exists("places", lambda p: p < 0))
    to_compare = F.transform(F.filter("places", lambda p: p < 0), lambda p: -p)
    windows = asked.select(*key, "text", to_compare).mapInArrow(
        _compare(window), f"content long, check int, place long, {longs}"
    )
    earliest = (
        windows.groupBy("content", "check")
        .agg(F.count("*").alias("n"), F.min("doc").alias("first"))
        .where(F.col("n") > 1)
        .select("content", "check", "first")
    )
    once_more = _dealt_anew(earliest, "content").hint("merge")
    later = windows.join(once_more, ["content", "check"]).where(F.col("doc") > F.col("first"))
    singles = later.groupBy(*key).agg(collect("place").alias("more"))
    empty = F.array().cast("array<long>")
    joined = texts.join(per_doc.hint("merge"), key, "left").join(singles.hint("merge"), key, "left")
    gone = F.concat(F.filter(F.coalesce("places", empty), lambda p: p > 0), F.coalesce("more", empty))
    own_id = F.when(F.col("doc") != NULL_ID, F.col("doc")).cast(kind)
    cut = joined.select(own_id.alias("id"), "text", gone.alias("gone"))
    return cut.mapInArrow(_remove(window), f"doc_id {kind}, {RESULT}")
