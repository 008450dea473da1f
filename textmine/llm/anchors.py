"""SimHash near-dedup by anchor-point covering.

The anchors are the code words of the binary Hamming code of length 31, whose covering radius is 1. A
64-bit fingerprint is cut into two halves, and 31 bits of each half are placed among the code words.
Two fingerprints that differ in at most three bits differ in at most one bit of one half, so the anchor
nearest to the one is within 1 + 1 of the other. Each half is therefore copied to all anchors within
distance two, at most sixteen, and fingerprints are compared where they share an anchor. There are 2^26
anchors per half, so an anchor holds few fingerprints unless they are alike.

An anchor that many different fingerprints share is split: they differ in at most three bits of the other
half, so they agree in one of its four bytes and meet again by anchor and byte.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmine.llm.common import SPACES, ascii_lower, text_hash, with_results, words
from textmine.llm.simhash import fingerprint_votes, hex64
from textmine.sources.scratch import written

RADIUS = 3
TERM_WORDS = 3
# Fingerprints that may share an anchor before it is split.
ANCHOR_PRINTS = 4096
# Fingerprints that a task gathers before it compares them.
HELD_PRINTS = 65536
SMALL_GROUP = 8

# Bit masks of the five parity checks: check c covers the positions whose number has bit c.
_CHECKS = [np.uint32(sum(1 << (p - 1) for p in range(1, 32) if p >> c & 1)) for c in range(5)]
# The flips that lead to the code words within distance two, by syndrome.
_FLIPS = {
    s: [1 << (s - 1)] + [1 << (i - 1) | 1 << ((i ^ s) - 1) for i in range(1, 32) if i < i ^ s and i != s]
    for s in range(1, 32)
}


def _anchors(half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All code words within distance two of 31-bit values: ``(row of the value, code word)``."""
    syndrome = np.zeros(len(half), np.uint32)
    for c, mask in enumerate(_CHECKS):
        syndrome |= (np.bitwise_count(half & mask).astype(np.uint32) & 1) << np.uint32(c)
    rows, found = [], []
    for s in range(32):
        at = np.flatnonzero(syndrome == s)
        flips = np.array(_FLIPS.get(s, [0]), np.uint32)
        rows.append(np.repeat(at, len(flips)))
        found.append((half[at][:, None] ^ flips[None, :]).ravel())
    return np.concatenate(rows), np.concatenate(found)


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprints copied to their anchors on either half; bit 32 of an anchor tells the half."""
    for batch in batches:
        for start in range(0, batch.num_rows, 4096):
            prints = batch.slice(start, 4096).column(0).to_numpy()
            for side in range(2):
                half = (prints.view(np.uint64) >> np.uint64(32 * side)).astype(np.uint32) & np.uint32(0x7FFFFFFF)
                rows, code = _anchors(half)
                anchor = code.astype(np.int64) | np.int64(side << 32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(np.zeros(len(rows), np.int64)), pa.array(prints[rows])],
                    ["anchor", "part", "fp"],
                )


def _star(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Connected groups among rows of fingerprints, as (first row of the group, row) links."""
    left = np.arange(1, len(values))
    roots, members = [], []
    root, queue = 0, [0]
    while len(left):
        if not queue:
            root, left = left[0], left[1:]
            queue = [root]
            continue
        near = np.bitwise_count(values[left] ^ values[queue.pop()]).sum(axis=1) <= radius
        found = left[near]
        queue.extend(found)
        members.append(found)
        roots.append(np.full(len(found), root))
        left = left[~near]
    empty = np.empty(0, np.int64)
    return np.concatenate([empty, *roots]).astype(int), np.concatenate([empty, *members]).astype(int)


def _links(anchor: np.ndarray, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs within the radius among rows with equal, adjacent anchors.

    Small groups are compared at every shift at once. A larger one gives the links of a spanning star
    per connected group, so what it emits grows with its members and not with its pairs.
    """
    edges = np.flatnonzero(np.diff(anchor)) + 1
    starts = np.concatenate([[0], edges])
    sizes = np.diff(np.concatenate([starts, [len(anchor)]]))
    small = np.repeat(sizes <= SMALL_GROUP, sizes)
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for shift in range(1, SMALL_GROUP):
        at = np.flatnonzero((anchor[:-shift] == anchor[shift:]) & small[shift:])
        near = np.bitwise_count(values[at] ^ values[at + shift]).sum(axis=1) <= radius
        a.append(at[near])
        b.append(at[near] + shift)
    for k in np.flatnonzero(sizes > SMALL_GROUP):
        roots, members = _star(values[starts[k] : starts[k] + sizes[k]], radius)
        a.append(roots + starts[k])
        b.append(members + starts[k])
    return np.concatenate(a), np.concatenate(b)


def _forest(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Links between rows as (smallest fingerprint of the group, member): one per member and group."""
    nodes, at = np.unique(values[np.concatenate([a, b])], axis=0, return_inverse=True)
    at = at.reshape(-1)
    a, b = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if np.array_equal(root, before):
            break
    member = np.flatnonzero(root != np.arange(len(nodes)))
    return np.concatenate([nodes[root[member]], nodes[member]], axis=1)


def _compare(radius: int, most: int | None):
    """Links within each key of rows ``(anchor, part, fp)`` that come ordered by both.

    A key with more than ``most`` rows is not compared: its rows are given back, to be split.
    """

    def emit(keys: np.ndarray, values: np.ndarray, over: np.ndarray | None) -> pa.RecordBatch:
        starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
        sizes = np.diff(np.append(starts, len(keys)))
        large = np.zeros(len(keys), bool)
        if most is not None:
            large = np.repeat(sizes > most, sizes)
            if over is not None:
                large |= (keys == over).all(axis=1)
        group, small = np.repeat(np.arange(len(sizes)), sizes)[~large], values[~large]
        pairs = _forest(small, *_links(group, small.view(np.uint64), radius)) if len(small) else np.empty((0, 2), np.int64)
        columns = (
            np.append(np.zeros(len(pairs), np.int64), keys[large, 0]),
            np.append(pairs[:, 0], values[large, 0]),
            np.append(pairs[:, 1], values[large, 0]),
        )
        linked = np.arange(len(columns[0])) < len(pairs)
        arrays = [pa.array(columns[0], mask=linked), pa.array(columns[1]), pa.array(columns[2])]
        return pa.RecordBatch.from_arrays(arrays, ["split", "a", "b"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_keys: list[np.ndarray] = []
        held: list[np.ndarray] = []
        rows, over = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            held_keys.append(np.stack([batch.column(i).to_numpy() for i in range(2)], axis=1))
            held.append(batch.column(2).to_numpy()[:, None])
            rows += batch.num_rows
            if rows < HELD_PRINTS:
                continue
            keys, values = np.concatenate(held_keys), np.concatenate(held)
            before = np.flatnonzero((keys != keys[-1]).any(axis=1))
            # All but the last key, which may go on; a key that is too large already goes as it comes.
            cut = before[-1] + 1 if len(before) else 0
            if most is not None and len(keys) - cut > most:
                yield emit(keys, values, over)
                cut, over = len(keys), keys[-1]
            elif cut:
                yield emit(keys[:cut], values[:cut], over)
            held_keys, held, rows = [keys[cut:]], [values[cut:]], len(keys) - cut
        if rows:
            yield emit(np.concatenate(held_keys), np.concatenate(held), over)

    return task


COMPARED = "split long, a long, b long"


def anchor_links(prints: DataFrame, radius: int = RADIUS, anchor_prints: int = ANCHOR_PRINTS) -> DataFrame:
    """Links ``(a, b)`` between nodes, the hex text of the fingerprints in column ``fp``.

    Two fingerprints that differ in at most ``radius`` bits, three at most, are linked or joined by other
    links: of a connected group only a spanning part is given, so links grow with the members and not with
    the pairs. Only distinct fingerprints are copied. Those of an anchor with more than ``anchor_prints``
    meet again by anchor and by every byte of the half that the anchor does not cover: the anchor that
    brings two of them together leaves at most three bits to differ there, so one byte agrees.
    """
    if radius > RADIUS:
        raise ValueError(f"anchors cover {RADIUS} differing bits at most")
    copies = prints.select("fp").distinct().mapInArrow(_replicate, "anchor long, part long, fp long")

    def met(rows: DataFrame, most: int | None) -> DataFrame:
        ordered = rows.repartition("anchor", "part").sortWithinPartitions("anchor", "part")
        return ordered.mapInArrow(_compare(radius, most), COMPARED)

    first = written(met(copies, anchor_prints), "anchor-links")
    crowded = first.where("split is not null").select(F.col("split").alias("anchor"), F.col("a").alias("fp"))
    # The anchors of the low half, side 0, leave the high half, and the other way round.
    shift = F.when(F.col("anchor").bitwiseAND(1 << 32) == 0, 32).otherwise(0)
    byte = F.transform(
        F.array(*[F.lit(i) for i in range(4)]),
        lambda i: (F.call_function("shiftright", F.col("fp"), shift + 8 * i).bitwiseAND(255) + 256 * i).cast("long"),
    )
    parts = crowded.select("anchor", F.explode(byte).alias("part"), "fp")
    links = first.where("split is null").unionByName(met(parts, None))
    return _thinned(links.select(hex64(F.col("a")).alias("a"), hex64(F.col("b")).alias("b")))


def _thinned(links: DataFrame) -> DataFrame:
    """The same groups by fewer links: each node keeps its smallest partner.

    The other partners are linked to that one instead. A node has a bounded number of anchors, bands or
    parts, so the lists are short.
    """
    partners = links.groupBy("b").agg(F.array_sort(F.collect_set("a")).alias("a"))
    to_least = F.transform(
        F.concat(F.array("b"), F.slice("a", F.lit(2), F.size("a"))),
        lambda x: F.struct(F.get("a", F.lit(0)).alias("a"), x.alias("b")),
    )
    return partners.select(F.inline(to_least)).distinct().where("a <> b")


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node with a link: the smallest node it can reach.

    Every round each node takes the smallest root among its neighbours and then the root of that root,
    so long chains shrink by more than half. Rounds go through written tables.
    """
    both = written(links.union(links.select(F.col("b"), F.col("a"))).toDF("node", "other").distinct(), "links")
    roots = written(
        both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("root")),
        "roots",
    )
    while True:
        seen = both.join(roots.toDF("other", "seen"), "other").groupBy("node").agg(F.min("seen").alias("seen"))
        hooked = roots.join(seen, "node").select(
            "node", F.col("root").alias("old"), F.least("root", "seen").alias("root")
        )
        above = roots.toDF("root", "up")
        jumped = written(
            hooked.join(above, "root").select("node", "old", F.least("root", "up").alias("root")), "roots"
        )
        roots = jumped.select("node", "root")
        if jumped.where("old <> root").isEmpty():
            return roots


def smallest_per_group(rows: DataFrame, roots: DataFrame, value: str) -> DataFrame:
    """``(node, smallest)``: the smallest ``value`` in the whole group of each node of ``rows``."""
    own = rows.groupBy("node").agg(F.min(value).alias("v"))
    grouped = own.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = grouped.groupBy("root").agg(F.min("v").alias("smallest"))
    return grouped.join(least, "root").select("node", "smallest")


def _linked(docs: DataFrame, doc_id: str, text: str, term_words: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """Stored fingerprints ``(_id, _hash, fp, node)`` and the roots of their groups."""
    rows = docs.select(
        F.col(doc_id).alias("_id"),
        text_hash(F.col(text)).alias("_hash"),
        words(ascii_lower(F.col(text)), SPACES).alias("w"),
    )
    prints = fingerprint_votes(rows, ["_id", "_hash"], term_words, joined=True, wide=False)
    stored = written(prints, "prints").withColumn("node", hex64(F.col("fp")))
    return stored, components(anchor_links(stored, radius))


def linked_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    term_words: int = TERM_WORDS,
    radius: int = RADIUS,
) -> DataFrame:
    """``doc_id, fingerprint, component_id``: documents linked at ``radius`` or fewer differing bits.

    Texts are lower-cased from A to Z and split at ASCII white space; the fingerprint takes the majority
    of the XXH64 bits of all runs of three words. Null and empty texts have fingerprint zero and are
    linked like any other. Rows that repeat id and text give one row; null ids keep their component,
    whose id is the smallest id present (null if there is none). Other columns are ignored; an empty
    table gives an empty result.
    """
    stored, roots = _linked(docs, doc_id, text, term_words, radius)
    groups = smallest_per_group(stored.withColumnRenamed("_id", "id"), roots, "id")
    return stored.join(groups, "node").select(
        F.col("_id").alias("doc_id"), F.col("node").alias("fingerprint"), F.col("smallest").alias("component_id")
    )


def remove_near_copies(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    term_words: int = TERM_WORDS,
    radius: int = RADIUS,
) -> DataFrame:
    """One document of each group of ``linked_documents``, with all columns of ``docs``.

    The smallest id stays, null ids after all others, equal ids by text hash. Rows that repeat both id and
    text are one document: they stay or go together. Texts without words form one group, together with any
    text whose fingerprint lies near zero. An empty table gives an empty result.
    """
    stored, roots = _linked(docs, doc_id, text, term_words, radius)
    rank = F.struct(F.col("_id").isNull(), F.col("_id"), F.col("_hash"))
    ranked = stored.select("node", "_id", "_hash", rank.alias("rank"))
    groups = smallest_per_group(ranked, roots, "rank")
    gone = ranked.join(groups, "node").where(F.col("rank") != F.col("smallest")).select("_id", "_hash").distinct()
    return with_results(docs, gone, doc_id, text, "left_anti")
