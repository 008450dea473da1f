"""Exact top-k search over a bit-sliced index.

The index holds blocks of rows. In a block every attribute is quantised to a few bits, and bit j of an
attribute of all rows is one bitmap, a slice. A query weighs the attributes by small whole numbers: its
score is a sum of shifted slices, added for all rows at once by carry-save adders on the bitmaps. The
k-th largest sum is found from the most significant slice downward. What quantisation left out is bounded,
so rows whose sum lies below that by more than the bound are out; the others, among them all rows at the
boundary, are scored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmine.llm.vectors import (
    FOUND, Best, Stored, fitting, first_rows, found_rows, ids_of, matrix, query_blocks, search_tasks, whole_vectors,
)
from textmine.sources.scratch import written

SCALE = 1024
TOP = 10
#: Slices of an attribute, and bits of a query's weight.
SLICES, WEIGHT_BITS = 5, 6
#: Rows of a block of the index, and bytes of its vectors at most.
INDEX_ROWS = 32768
INDEX_BYTES = 32 * 1024 * 1024
INDEX = "ids array<long>, width int, bits int, vectors binary, low binary, step binary, slices binary"
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _narrow(values: np.ndarray) -> np.ndarray:
    """The smallest whole numbers that hold the values."""
    largest = max(-int(values.min(initial=0)), int(values.max(initial=0)) + 1)
    return values.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if largest <= np.iinfo(t).max + 1))


def _sliced(ids: pa.Array, values: np.ndarray, bits: int) -> pa.RecordBatch:
    """One row of the index."""
    n, width = values.shape
    low = values.min(axis=0)
    # As Python numbers: the span of an attribute can pass 63 bits.
    step = np.array([max(1, -(-(int(b) - int(a) + 1) // (1 << bits))) for a, b in zip(low, values.max(axis=0))], np.int64)
    code = ((values - low) // step).astype(np.uint8)
    planes = (code.T[:, None, :] >> np.arange(bits, dtype=np.uint8)[None, :, None]) & np.uint8(1)
    packed = np.packbits(planes, axis=2, bitorder="little")
    packed = np.pad(packed, ((0, 0), (0, 0), (0, -packed.shape[2] % 8)))
    vectors = _narrow(values)
    lists = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), ids)
    numbers = [pa.array([width], pa.int32()), pa.array([8 * vectors.itemsize], pa.int32())]
    binary = [pa.array([x.tobytes()], pa.binary()) for x in (vectors, low, step, packed)]
    names = ["ids", "width", "bits", "vectors", "low", "step", "slices"]
    return pa.RecordBatch.from_arrays([lists, *numbers, *binary], names)


def _index(bits: int, most_rows: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, size = [], 0, 0

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            return _sliced(table.column("vec_id").combine_chunks(), matrix(table.column("v")), bits)

        for batch in batches:
            start = 0
            while start < batch.num_rows:
                widest = max(1, batch.column(1).value_lengths().to_numpy().max())
                room = max(1, min(most_rows - rows, (INDEX_BYTES - size) // (8 * widest)))
                part = batch.slice(start, room)
                held.append(part)
                start, rows, size = start + part.num_rows, rows + part.num_rows, size + part.num_rows * 8 * widest
                if rows >= most_rows or size >= INDEX_BYTES - 8 * widest:
                    yield block()
                    held, rows, size = [], 0, 0
        if rows:
            yield block()

    return task


def build_index(
    rows: DataFrame,
    scale: int = SCALE,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    bits: int = SLICES,
    block_rows: int = INDEX_ROWS,
) -> DataFrame:
    """A stored table of blocks. Every row with a usable vector is in it; nothing is shuffled."""
    if not 1 <= bits <= 8:
        raise ValueError("an attribute has one to eight slices")
    vectors = whole_vectors(rows, scale, vec_id, vector)
    return written(vectors.mapInArrow(_index(bits, block_rows), INDEX), "bit-slices")


class _Block:
    """A block of the index in a task."""

    def __init__(self, row: dict[str, pa.Scalar], bits: int):
        self.ids, self.known = ids_of(row["ids"].values)
        width, n = row["width"].as_py(), len(self.ids)
        kind = np.dtype(f"int{row['bits'].as_py()}")

        def longs(name: str) -> np.ndarray:
            return np.frombuffer(row[name].as_buffer(), np.int64)

        self.vectors = np.frombuffer(row["vectors"].as_buffer(), kind).reshape(n, width)
        self.low, self.step = longs("low").astype(np.float64), longs("step").astype(np.float64)
        self.slices = np.frombuffer(row["slices"].as_buffer(), np.uint64).reshape(width, bits, -(-n // 64))
        full = np.packbits(np.ones(n, np.uint8), bitorder="little")
        self.every = np.pad(full, (0, -len(full) % 8)).view(np.uint64)


def _added(maps: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
    """Slices of the sum, least significant first, of bitmaps that count ``2 ** place`` each.

    Three bitmaps of a place become their sum there and a carry in the next place, all of a place at once.
    """
    columns = [maps[place == p] for p in range(int(place.max(initial=-1)) + 1)]
    total: list[np.ndarray] = []
    at = 0
    while at < len(columns):
        column = columns[at]
        carries = []
        while len(column) > 1:
            if len(column) == 2:
                a, b = column
                sums, carry = (a ^ b)[None], (a & b)[None]
            else:
                whole = len(column) // 3
                a, b, c = (column[i : 3 * whole : 3] for i in range(3))
                half = a ^ b
                sums, carry = half ^ c, (a & b) | (half & c)
                sums = np.concatenate([sums, column[3 * whole :]])
            column = sums
            carries.append(carry)
        total.append(column[0] if len(column) else np.zeros(maps.shape[1], np.uint64))
        if carries:
            if at + 1 == len(columns):
                columns.append(np.empty((0, maps.shape[1]), np.uint64))
            columns[at + 1] = np.concatenate([columns[at + 1], *carries])
        at += 1
    return total


def _kth_largest(total: list[np.ndarray], rows: np.ndarray, k: int) -> int:
    """The k-th largest sum of the marked rows, from the most significant slice down; 0 if there are fewer."""
    value, left = 0, k
    for place in range(len(total) - 1, -1, -1):
        ones = rows & total[place]
        n = int(np.bitwise_count(ones).sum())
        if n >= left:
            rows, value = ones, value | 1 << place
        else:
            rows, left = rows & ~total[place], left - n
    return value


def _at_least(total: list[np.ndarray], rows: np.ndarray, least: int) -> np.ndarray:
    """Of the marked rows those whose sum is ``least`` or more."""
    if least <= 0:
        return rows
    if least >> len(total):
        return np.zeros_like(rows)
    above, equal = np.zeros_like(rows), rows
    for place in range(len(total) - 1, -1, -1):
        if least >> place & 1:
            equal = equal & total[place]
        else:
            above, equal = above | (equal & total[place]), equal & ~total[place]
    return above | equal


def _candidates(block: _Block, query: np.ndarray, rows: np.ndarray, k: int, known_bound: float, bits: int) -> np.ndarray:
    """Numbers of the rows that can be among the first ``k`` of the block and reach ``known_bound``."""
    top = float((1 << bits) - 1)
    pull = query * block.step
    unit = max(np.abs(pull).max(initial=0) / ((1 << WEIGHT_BITS) - 1), 1e-300)
    weight = np.rint(pull / unit).astype(np.int64)
    # Score = base + unit * sum of weight * code + rest, and rest lies between least and most.
    rest = pull - unit * weight
    kept = query * (block.step - 1)
    least = np.minimum(rest * top, 0).sum() + np.minimum(kept, 0).sum()
    most = np.maximum(rest * top, 0).sum() + np.maximum(kept, 0).sum()
    # A negative weight counts the complement of the code, so all terms are added.
    base = (query * block.low).sum() - unit * (np.maximum(-weight, 0) * top).sum()
    # Rounding of these few sums, in doubles.
    slack = 1e-9 * (np.abs(query * block.low).sum() + np.abs(pull).sum() * top + np.abs(kept).sum()) + 1e-6
    size = np.abs(weight)
    attribute, bit = np.nonzero(size[:, None] >> np.arange(WEIGHT_BITS + 1)[None, :] & 1)
    plane = np.tile(np.arange(bits), len(attribute))
    attribute, bit = np.repeat(attribute, bits), np.repeat(bit, bits)
    maps = block.slices[attribute, plane] ^ np.where(weight[attribute] < 0, ALL, np.uint64(0))[:, None]
    total = _added(maps, bit + plane)
    threshold = 0.0
    if int(np.bitwise_count(rows).sum()) >= k:
        threshold = _kth_largest(total, rows, k) - (most - least + 2 * slack) / unit
    if known_bound > -np.inf:
        threshold = max(threshold, (known_bound - base - most - slack) / unit)
    chosen = _at_least(total, rows, int(np.ceil(min(max(threshold, 0.0), 2.0**62))))
    return np.flatnonzero(np.unpackbits(chosen.view(np.uint8), count=len(block.ids), bitorder="little"))


def _search(ids: np.ndarray, queries: np.ndarray, k: int, bits: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in ids]
        for batch in batches:
            for at in range(batch.num_rows):
                block = _Block({name: batch.column(name)[at] for name in batch.schema.names}, bits)
                width = max(queries.shape[1], block.vectors.shape[1])
                rows, asked = fitting(block.vectors.astype(np.int64), queries)
                part = queries[:, : block.vectors.shape[1]].astype(np.float64)
                part = np.pad(part, ((0, 0), (0, block.vectors.shape[1] - part.shape[1])))
                assert rows.shape[1] == asked.shape[1] == width
                for q in range(len(ids)):
                    own = np.flatnonzero((block.ids == ids[q]) & block.known)
                    allowed = block.every
                    if len(own):
                        allowed = allowed.copy()
                        np.bitwise_and.at(allowed, own // 64, ~(np.uint64(1) << (own % 64).astype(np.uint64)))
                    near = _candidates(block, part[q], allowed, k, best[q].bound(), bits)
                    if len(near):
                        best[q].offer(rows[near] @ asked[q], block.ids[near], block.known[near])
        yield found_rows([(q, 0, b) for q, b in enumerate(best)])

    return task


def top_k(
    rows: DataFrame,
    asked: Column,
    k: int = TOP,
    scale: int = SCALE,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    bits: int = SLICES,
    block_rows: int = INDEX_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows with the highest inner product per query.

    Queries are the rows for which ``asked`` holds; candidates are all rows of other ids. Components are
    multiplied by ``scale`` and rounded down; scores are exact whole numbers, and those beyond 63 bits
    raise. Ties go to the smaller id, null ids come last; a null id is no query's own. Rows whose vector
    is null or holds nulls, NaN or infinities take no part. Shorter vectors count as ending in zeros.
    Repeated rows are candidates each, and one query; an id with several vectors is a query with each.
    Fewer candidates give fewer rows; an empty table gives an empty result; other columns are ignored.

    Queries go to the tasks in blocks of a bounded size; each block scans the index once.
    """
    index = build_index(rows, scale, vec_id, vector, bits, block_rows)
    n = index.agg(F.sum(F.size("ids"))).first()[0] or 0
    out = Stored(rows, "top-k")
    for block in query_blocks(whole_vectors(rows.where(asked), scale, vec_id, vector)):
        ids = block.column("vec_id").to_numpy().astype(np.int64)
        task = _search(ids, matrix(block.column("v")), k, bits)
        found = first_rows(search_tasks(index, n).mapInArrow(task, FOUND), k)
        names = F.array(*[F.lit(int(i)) for i in ids])
        out.add(found.select(F.get(names, F.col("q")).alias("query_id"), "rank", "vec_id", "score"))
    return out.read("query_id long, rank int, vec_id long, score long")
