"""Hard negatives by bounds along a spanning tree of anchors.

The anchors of a block are joined by a minimum spanning tree. A candidate's score at an anchor differs
from its score at the tree's parent by at most the length of the edge times the candidate's norm, so an
interval of possible scores goes from the root down the tree. Where it overlaps the window of scores that
still matter at an anchor, the candidate is scored there exactly, and its interval becomes a point; where
it does not, nothing is computed and the interval goes on. Windows shrink while a task finds rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmine.llm.vectors import (
    FOUND, Best, Stored, fitting, first_rows, found_rows, ids_of, matrix, query_blocks, search_tasks, whole_vectors,
)
from textmine.sources.scratch import written

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: The window of a positive, in hundredths of its score.
LOW, HIGH = 30, 90
#: Candidates that are followed down a tree at once.
SLICE_ROWS = 2048
PAIRS = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


class Tree(NamedTuple):
    """A spanning tree: anchors from the root down, each one's parent (-1 at the root) and edge."""

    order: np.ndarray
    parent: np.ndarray
    edge: np.ndarray


def spanning_tree(anchors: np.ndarray) -> Tree:
    """The minimum spanning tree of the rows by Euclidean distance, grown from the shortest row."""
    n = len(anchors)
    values = anchors.astype(np.float64)
    square = (values**2).sum(axis=1)
    nearest, parent = np.full(n, np.inf), np.full(n, -1)
    order, edge, outside = np.empty(n, int), np.zeros(n), np.ones(n, bool)
    at = int(np.argmin(square))
    for i in range(n):
        order[i], outside[at] = at, False
        if i == n - 1:
            break
        apart = square + square[at] - 2 * (values @ values[at])
        closer = outside & (apart < nearest)
        nearest[closer], parent[closer] = apart[closer], at
        at = int(np.argmin(np.where(outside, nearest, np.inf)))
        edge[at] = np.sqrt(((values[at] - values[parent[at]]) ** 2).sum())
    return Tree(order, parent, edge)


Overlap = Callable[[int, np.ndarray, np.ndarray], np.ndarray]
Take = Callable[[int, np.ndarray, np.ndarray], None]


def follow(tree: Tree, anchors: np.ndarray, rows: np.ndarray, overlap: Overlap, take: Take) -> int:
    """Carry the rows' score intervals down the tree; gives the number of exact scores.

    ``overlap(anchor, low, high)`` tells which rows can matter there, ``take(anchor, numbers, scores)``
    gets those with their exact scores. The root scores all rows.
    """
    exact = anchors.dtype.kind == "i"
    norms = np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1))
    # Bounds are doubles; what their rounding can amount to is added to every edge.
    largest = np.sqrt((anchors.astype(np.float64) ** 2).sum(axis=1)).max(initial=0) * norms
    rounding = largest * (1e-9 if exact else 1e-12) + 1e-6
    low, high = np.empty((len(anchors), len(rows))), np.empty((len(anchors), len(rows)))
    scored = 0
    for a in tree.order:
        above = tree.parent[a]
        if above < 0:
            chosen = np.arange(len(rows))
        else:
            reach = tree.edge[a] * norms + rounding
            np.subtract(low[above], reach, out=low[a])
            np.add(high[above], reach, out=high[a])
            chosen = np.flatnonzero(overlap(a, low[a], high[a]))
        if len(chosen):
            scores = rows[chosen] @ anchors[a]
            low[a, chosen] = high[a, chosen] = scores
            take(a, chosen, scores)
            scored += len(chosen)
    return scored


def _slices(batches: Iterator[pa.RecordBatch], anchors: np.ndarray):
    """``(rows, anchors, ids, known, labels)`` of a few thousand candidates at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(start, SLICE_ROWS)
            rows, asked = fitting(matrix(part.column("v")), anchors)
            yield rows, asked, *ids_of(part.column("vec_id")), part.column("label").to_numpy().astype(np.int64)


def _positives(ids: np.ndarray, labels: np.ndarray, anchors: np.ndarray, tree: Tree, k: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in ids]
        for rows, asked, row_ids, known, row_labels in _slices(batches, anchors):

            def overlap(a: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
                return (high >= best[a].bound()) & (row_labels == labels[a])

            def take(a: int, chosen: np.ndarray, scores: np.ndarray) -> None:
                other = (row_labels[chosen] == labels[a]) & ~(known[chosen] & (row_ids[chosen] == ids[a]))
                other &= scores >= best[a].bound()
                if other.any():
                    best[a].offer(scores[other], row_ids[chosen[other]], known[chosen[other]])

            follow(tree, asked, rows, overlap, take)
        yield found_rows([(a, 0, b) for a, b in enumerate(best)])

    return task


def window(score: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """The whole scores s with ``low * score <= 100 * s <= high * score``, as first and last."""
    return -(-low * score // 100), high * score // 100


def _negatives(
    labels: np.ndarray, anchors: np.ndarray, tree: Tree, windows: list[list[tuple[int, int]]], k: int
):
    """``windows`` has those of every anchor's positives, by slot."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [[Best(k) for _ in own] for own in windows]
        for rows, asked, row_ids, known, row_labels in _slices(batches, anchors):

            def overlap(a: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
                found = np.zeros(len(low), bool)
                for kept, (first, last) in zip(best[a], windows[a]):
                    found |= (high >= max(first, kept.bound())) & (low <= last)
                return found & (row_labels != labels[a])

            def take(a: int, chosen: np.ndarray, scores: np.ndarray) -> None:
                differs = row_labels[chosen] != labels[a]
                for kept, (first, last) in zip(best[a], windows[a]):
                    inside = differs & (scores >= max(first, kept.bound())) & (scores <= last)
                    if inside.any():
                        at = chosen[inside]
                        kept.offer(scores[inside], row_ids[at], known[at])

            follow(tree, asked, rows, overlap, take)
        yield found_rows([(a, slot, b) for a, own in enumerate(best) for slot, b in enumerate(own)])

    return task


def hard_negatives(
    rows: DataFrame,
    anchor: Column,
    label: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows for which ``anchor`` holds. Their positives are the first ``positives`` rows of
    their label and another id; for each positive come the first ``negatives`` rows of other labels whose
    score lies between ``low`` and ``high`` hundredths of the positive's. ``label`` is a whole number, the
    column of that name unless given. Scores are whole inner products of the components times ``scale``,
    rounded down; those beyond 63 bits raise. Higher scores come first, ties by smaller id, null ids last.

    Rows with a null label or a vector that is null or holds nulls, NaN or infinities take no part.
    Shorter vectors count as ending in zeros. Repeated rows are candidates each, and one anchor; an id with
    several vectors or labels is an anchor with each. An anchor without positives, or a positive without
    rows in its window, gives no row; a positive score below 0 has an empty window. An empty table gives an
    empty result; other columns are ignored.

    Anchors go to the tasks in blocks of a bounded size, a tree each; a block scans the rows twice.
    """
    named = rows.withColumn("label", (F.col("label") if label is None else label).cast("long"))
    usable = named.where(F.col("label").isNotNull())
    stored = written(whole_vectors(usable, scale, vec_id, vector, "label"), "whole-vectors")
    candidates = search_tasks(stored, stored.count())
    asked = whole_vectors(usable.where(anchor), scale, vec_id, vector, "label")
    out = Stored(rows, "negatives")
    for block in query_blocks(asked):
        ids, labels = (block.column(name).to_numpy().astype(np.int64) for name in ("vec_id", "label"))
        values = matrix(block.column("v"))
        tree = spanning_tree(values)
        near = first_rows(candidates.mapInArrow(_positives(ids, labels, values, tree, positives), FOUND), positives)
        # At most anchors of a block times positives.
        chosen = sorted(((r["q"], r["rank"], r["vec_id"], r["score"]) for r in near.collect()), key=lambda c: c[:2])
        own = _by_anchor(chosen, len(ids))
        windows = [[window(score, low, high) for *_, score in mine] for mine in own]
        task = _negatives(labels, values, tree, windows, negatives)
        found = first_rows(candidates.mapInArrow(task, FOUND), negatives)
        table = [
            (a, slot, int(ids[a]), positive, score)
            for a, mine in enumerate(own)
            for slot, (_, _, positive, score) in enumerate(mine)
        ]
        pairs = rows.sparkSession.createDataFrame(
            table, "q int, slot int, anchor_id long, positive_id long, positive_score long"
        )
        joined = found.join(F.broadcast(pairs), ["q", "slot"])
        out.add(
            joined.select(
                "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
                "positive_score", F.col("score").alias("negative_score"),
            )
        )
    return out.read(PAIRS)


def _by_anchor(chosen: list[tuple], anchors: int) -> list[list[tuple]]:
    own: list[list[tuple]] = [[] for _ in range(anchors)]
    for row in chosen:
        own[row[0]].append(row)
    return own
