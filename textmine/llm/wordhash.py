"""Words of whole Arrow batches as hashes, for tasks that work on arrays."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

MIX = np.uint64(0x9E3779B97F4A7C15)


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def split_batch(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words between ASCII white space of all texts in a row, and the offsets of each text."""
    texts = texts.fill_null("").cast(pa.large_string())
    lists = pc.ascii_split_whitespace(texts)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    flat = lists.flatten()
    filled = pc.not_equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not filled.all():
        before = np.concatenate([[0], np.cumsum(filled)])
        return flat.filter(pa.array(filled)), before[offsets]
    return flat, offsets


def hash_words(flat: pa.Array) -> np.ndarray:
    """64-bit hash of each word; every distinct word is hashed once."""
    if len(flat) == 0:
        return np.empty(0, np.uint64)
    coded = flat.dictionary_encode()
    unique = coded.dictionary.to_numpy(zero_copy_only=False)
    return pd.util.hash_array(unique, categorize=False)[coded.indices.to_numpy()]


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each position on; positions near the end wrap to zeros."""
    padded = np.concatenate([hashes, np.zeros(size, np.uint64)])
    total = np.zeros(len(hashes), np.uint64)
    for i in range(size):
        total = (total + padded[i : i + len(hashes)]) * MIX
    return scramble(total)


def shingle_hashes(hashes: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside each text and their offsets.

    A text with fewer words is one run, a text without words has none.
    """
    lengths = np.diff(offsets)
    counts = np.where(lengths > 0, np.maximum(lengths - size + 1, 1), 0)
    starts = np.concatenate([[0], np.cumsum(counts)])
    place = np.arange(starts[-1]) - np.repeat(starts[:-1], counts) + np.repeat(offsets[:-1], counts)
    runs = gram_hashes(hashes, size)[place]
    for k in np.flatnonzero((lengths > 0) & (lengths < size)):
        own = hashes[offsets[k] : offsets[k + 1]]
        value = np.array([len(own)], np.uint64)
        for i in range(len(own)):
            value = scramble(value * MIX + own[i : i + 1])
        runs[starts[k]] = value[0]
    return runs, starts


def slices(batch: pa.RecordBatch, column: int, limit: int = 4_000_000) -> list[pa.RecordBatch]:
    """The batch in pieces of a few megabytes of text; a longer text is a piece of its own."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(np.diff(np.cumsum(np.maximum(lengths, 1)) // limit, prepend=0)).tolist()
    pieces = [batch.slice(a, b - a) for a, b in zip([0, *cuts], [*cuts, batch.num_rows])]
    return [piece for piece in pieces if piece.num_rows]


class SpanHash:
    """Hash of any run of words from running sums, in constant time per run."""

    BASE = np.uint64(0xD1342543DE82EF95)
    INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

    def __init__(self, hashes: np.ndarray):
        steps = np.full(len(hashes), self.BASE, np.uint64)
        powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], steps]), dtype=np.uint64)
        back = np.full(len(hashes), self.INVERSE, np.uint64)
        self.back = np.multiply.accumulate(np.concatenate([[np.uint64(1)], back]), dtype=np.uint64)
        sums = np.add.accumulate(hashes * powers[:-1], dtype=np.uint64)
        self.sums = np.concatenate([np.zeros(1, np.uint64), sums])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return scramble((self.sums[end] - self.sums[start]) * self.back[start])
