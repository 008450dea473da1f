"""Integer vectors, blocks of queries, and the first k rows of a search, for operators on embeddings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from textmine.sources.scratch import scratch_path, written

#: Rows of a block of queries, which goes to the driver and to every task, and its bytes at most.
BLOCK_ROWS = 1024
BLOCK_BYTES = 16 * 1024 * 1024
#: Rows that one task of a search takes where there are more than the session's cores can share.
TASK_ROWS = 1_000_000
EXACT_FLOAT, EXACT_LONG = 2.0**53, 2.0**63


def whole_vectors(rows: DataFrame, scale: int, vec_id: str, vector: str, *keep: str) -> DataFrame:
    """``(vec_id long, *keep, v array<long>)``: components times ``scale``, rounded down.

    Rows whose vector is null or holds a null, a NaN or an infinity take no part.
    """
    usable = F.col(vector).isNotNull() & F.forall(
        vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(x)
    )
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    return rows.where(usable).select(F.col(vec_id).cast("long").alias("vec_id"), *keep, whole.alias("v"))


def search_tasks(stored: DataFrame, rows: int) -> DataFrame:
    """A stored table in no more tasks than its rows and the session's cores ask for.

    Every task reports its own first rows of every query, so their number follows the tasks.
    """
    cores = stored.sparkSession.sparkContext.defaultParallelism
    tasks = max(cores, -(-rows // TASK_ROWS))
    return stored.coalesce(tasks)


def query_blocks(queries: DataFrame, rows: int = BLOCK_ROWS) -> Iterator[pa.Table]:
    """The rows of ``queries``, which has a column ``v``, in tables of a proven size, one at a time.

    Rows that repeat all columns count once. The table is written with so many rows a file at most, and
    each file is a block.
    """
    spark = queries.sparkSession
    widest = queries.agg(F.max(F.size("v"))).first()[0]
    if widest is None:
        return
    most = max(1, min(rows, BLOCK_BYTES // (8 * max(1, widest))))
    path = scratch_path(spark, "queries")
    distinct = written(queries.distinct(), "distinct-queries")
    # Dealt out evenly, so that the files are as few as the rows allow.
    even = distinct.repartition(max(1, -(-distinct.count() // most)))
    even.write.option("maxRecordsPerFile", most).parquet(path)
    for file in sorted(spark.read.schema(distinct.schema).parquet(path).inputFiles()):
        block = spark.read.schema(distinct.schema).parquet(file).toArrow()
        if block.num_rows:
            yield block.sort_by([(name, "ascending") for name in block.column_names if name != "v"])


class Stored:
    """A table that grows by appended parts and is read when all are there."""

    def __init__(self, like: DataFrame, name: str):
        self.spark, self.path = like.sparkSession, scratch_path(like.sparkSession, name)

    def add(self, part: DataFrame) -> None:
        part.write.mode("append").parquet(self.path)

    def read(self, schema: StructType | str) -> DataFrame:
        reader = self.spark.read.schema(schema)
        try:
            return reader.parquet(self.path)
        except Exception as error:
            # Without any query nothing was written.
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], schema)


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of longs as rows; shorter ones end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def as_wide(values: np.ndarray, width: int) -> np.ndarray:
    """Rows with zeros added up to ``width`` components."""
    return np.pad(values, ((0, 0), (0, width - values.shape[1]))) if values.shape[1] < width else values


def fitting(rows: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in one width, as doubles while all inner products are exact so, else as longs.

    Products beyond 63 bits raise.
    """
    width = max(rows.shape[1], others.shape[1])
    rows, others = as_wide(rows, width), as_wide(others, width)
    largest = [float(np.abs(x.astype(np.float64)).max(initial=0)) for x in (rows, others)]
    bound = largest[0] * largest[1] * max(1, width)
    if bound >= EXACT_LONG:
        raise OverflowError("inner products of these vectors do not fit in 64 bits")
    return (rows.astype(np.float64), others.astype(np.float64)) if bound < EXACT_FLOAT else (rows, others)


def ids_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids and whether they are there."""
    known = column.is_valid().to_numpy(zero_copy_only=False)
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), known


class Best:
    """The first k rows offered so far: higher scores first, then smaller ids, null ids last."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.id, self.known = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def bound(self) -> float:
        """A row with a lower score is not among them."""
        return float(self.score[-1]) if len(self.score) == self.k else -np.inf

    def offer(self, score: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        if len(score) > 4 * self.k:
            stay = score >= np.partition(score, len(score) - self.k)[len(score) - self.k]
            score, ids, known = score[stay], ids[stay], known[stay]
        score = np.concatenate([self.score, score.astype(np.int64)])
        ids, known = np.concatenate([self.id, ids]), np.concatenate([self.known, known])
        order = np.lexsort((ids, ~known, -score))[: self.k]
        self.score, self.id, self.known = score[order], ids[order], known[order]


FOUND = "q int, slot int, vec_id long, score long"


def found_rows(kept: list[tuple[int, int, Best]]) -> pa.RecordBatch:
    """Rows ``(q, slot, vec_id, score)`` of the searches ``(q, slot, best)``."""
    sizes = [len(best.score) for _, _, best in kept]
    empty = np.empty(0, np.int64)
    known = np.concatenate([empty.astype(bool), *[best.known for _, _, best in kept]])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat([q for q, _, _ in kept], sizes).astype(np.int32)),
            pa.array(np.repeat([slot for _, slot, _ in kept], sizes).astype(np.int32)),
            pa.array(np.concatenate([empty, *[best.id for _, _, best in kept]]), mask=~known),
            pa.array(np.concatenate([empty, *[best.score for _, _, best in kept]])),
        ],
        ["q", "slot", "vec_id", "score"],
    )


def first_rows(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each ``(q, slot)`` over all tasks, numbered in ``rank``."""
    order = Window.partitionBy("q", "slot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
