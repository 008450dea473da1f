"""Records of delimited text whose quoted fields hold line breaks, read by many tasks per file.

A line break ends a record if the number of quotes before it in the file is even. Files are read as lines,
which Spark splits by bytes. A first pass counts the quotes of every split; their running parity tells
whether a split begins inside a quoted field. With that every task joins the lines of its own records, and
only the pieces of records that cross a split are shuffled.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The function of the tasks travels with them, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Splits of one read; their table is broadcast. At 128 MB a split this is 128 TB.
MOST_SPLITS = 1_000_000
_RECORDS = "file string, start long, part int, first boolean, record string"
WHOLE, HEAD, TAIL = 0, 1, 2


def _join_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(file, start, open, value)`` in the order of the file to records and pieces of records."""

    split, held, inside, piece, first = None, [], False, False, False

    def rows(values: pa.Array, parts: np.ndarray, firsts: np.ndarray) -> pa.RecordBatch:
        n = len(values)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([split[0]] * n, pa.string()), pa.array([split[1]] * n, pa.int64()),
                pa.array(parts.astype(np.int32)), pa.array(firsts), values,
            ],
            ["file", "start", "part", "first", "record"],
        )

    def rest() -> Iterator[pa.RecordBatch]:
        """What a split leaves: a record that goes on in the next one, or lines in the middle of one."""
        if held:
            lines = pa.array(["\n".join(held)], pa.string())
            yield rows(lines, np.array([HEAD if piece else TAIL]), np.array([first and not piece]))

    for batch in batches:
        files, starts, opens, values = batch.columns
        at = starts.to_numpy()
        coded = files.dictionary_encode().indices.to_numpy()
        cuts = np.flatnonzero((at[1:] != at[:-1]) | (coded[1:] != coded[:-1])) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            if a == b:
                continue
            here = (files[a].as_py(), int(at[a]))
            if here != split:
                if split is not None:
                    yield from rest()
                split, held, inside = here, [], bool(opens[a].as_py())
                # The first lines may belong to a record of an earlier split.
                piece, first = inside, here[1] == 0
            lines = values.slice(a, b - a)
            odd = pc.count_substring(lines, '"').to_numpy() % 2
            after = (np.cumsum(odd) + inside) % 2
            ends = np.flatnonzero(after == 0)
            if len(ends):
                begins = np.concatenate([[0], ends[:-1] + 1])
                whole = lines.slice(0, int(ends[-1]) + 1)
                offsets = np.append(begins, len(whole)).astype(np.int32)
                records = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), whole), "\n")
                if held:
                    joined = pa.array(["\n".join([*held, records[0].as_py()])], pa.string())
                    records = pa.concat_arrays([joined, records.slice(1)])
                parts = np.full(len(records), WHOLE)
                if piece:
                    parts[0], piece = HEAD, False
                firsts = np.zeros(len(records), bool)
                if first:
                    # Blank lines before the header are no records.
                    filled = pc.not_equal(pc.utf8_trim_whitespace(records), "")
                    real = np.flatnonzero(filled.to_numpy(zero_copy_only=False))
                    if len(real):
                        firsts[real[0]], first = True, False
                yield rows(records, parts, firsts)
                held = lines.slice(int(ends[-1]) + 1).to_pylist()
            else:
                held += lines.to_pylist()
            inside = bool(after[-1])
    if split is not None:
        yield from rest()


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """``(file, start, first, record)``: every record, and whether it is the first of its file.

    Quotes stand around fields only, doubled inside them, as the library writes them. A file with an odd
    number of quotes raises: its last field never ends. Blank lines between records are left out, and a
    carriage return at the end of a record goes.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    placed = lines.select(
        F.input_file_name().alias("file"), F.expr("input_file_block_start()").alias("start"), "value"
    )
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    counted = placed.groupBy("file", "start").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = counted.withColumn("open", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1)
    found = splits.groupBy("file").agg(F.count("*").alias("n"), (F.sum("odd") % 2).alias("odd"))
    total = found.agg(F.sum("n").alias("n"), F.max(F.when(F.col("odd") == 1, F.col("file"))).alias("unclosed")).first()
    if total["unclosed"] is not None:
        raise ValueError(f"a quoted field of {total['unclosed']} never ends")
    if (total["n"] or 0) > MOST_SPLITS:
        raise ValueError(f"{total['n']} splits; raise spark.sql.files.maxPartitionBytes to have {MOST_SPLITS} at most")
    known = placed.join(F.broadcast(splits.select("file", "start", "open")), ["file", "start"])
    pieces = known.select("file", "start", "open", "value").mapInArrow(_join_lines, _RECORDS)
    # A record that crosses splits: its tail-end piece, then the head pieces of the following splits.
    crossing = pieces.where(F.col("part") != WHOLE)
    order = Window.partitionBy("file").orderBy("start", "part")
    grouped = crossing.withColumn("of", F.sum((F.col("part") == TAIL).cast("long")).over(order))
    joined = grouped.groupBy("file", "of").agg(
        F.min("start").alias("start"),
        F.max("first").alias("first"),
        F.array_sort(F.collect_list(F.struct("start", "part", "record"))).alias("pieces"),
    )
    stitched = joined.select(
        "file", "start", "first", F.array_join(F.transform("pieces", lambda p: p["record"]), "\n").alias("record")
    )
    whole = pieces.where(F.col("part") == WHOLE).select("file", "start", "first", "record")
    every = whole.union(stitched).withColumn("record", F.regexp_replace("record", "\r$", ""))
    return every.where(F.trim("record") != "")
