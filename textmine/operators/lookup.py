"""Join of long rows with a lookup table whose keys may be hot."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BROADCAST_LIMIT_BYTES = 256 * 1024 * 1024
SALTS = 64
ROWS_PER_SALT = 1_000_000


def broadcastable(table_bytes: int) -> bool:
    return table_bytes <= BROADCAST_LIMIT_BYTES


def common_part(table: DataFrame, rarity: str, row_bytes: Column) -> tuple[DataFrame, DataFrame]:
    """``table`` in two: its rows of the smallest ``rarity`` that may be broadcast together, and the others.

    Rows of equal rarity stay together. The cut comes from a histogram, as in ``vocabulary_cut``.
    """
    rising = Window.orderBy(rarity).rowsBetween(Window.unboundedPreceding, 0)
    upto = table.groupBy(rarity).agg(F.sum(row_bytes).alias("_bytes")).withColumn("_upto", F.sum("_bytes").over(rising))
    cut = upto.where(F.col("_upto") <= BROADCAST_LIMIT_BYTES).agg(F.max(rarity)).first()[0]
    common = F.lit(False) if cut is None else F.col(rarity) <= cut
    return table.where(common), table.where(~common)


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    table_bytes: int,
    spread_by: Sequence[str],
    how: str = "inner",
    salts: int = SALTS,
    frequency: str | None = None,
) -> DataFrame:
    """Join ``rows`` to ``table``, unique on ``on``, without ever gathering a hot key in one task.

    A table whose measured size is within ``BROADCAST_LIMIT_BYTES`` is broadcast: no row of ``rows``
    moves. A larger one is joined on key and salt. ``frequency`` names its column with the number of rows that
    have a key: then a key is copied once per ``ROWS_PER_SALT`` of them, so nearly all keys stand once. Without
    it every key is copied once per salt. Rows with a null key are spread over ``salts`` tasks. All ways give
    the same rows.
    """
    on = list(on)
    if broadcastable(table_bytes):
        return rows.join(F.broadcast(table), on, how)
    many = F.lit(salts)
    if frequency is not None:
        copies = F.greatest(F.ceil(F.col(frequency) / ROWS_PER_SALT).cast("int"), F.lit(1))
        hot = table.where(F.col(frequency) > ROWS_PER_SALT).select(*on, copies.alias("_copies"))
        rows = rows.join(F.broadcast(hot), on, "left")
        no_key = reduce(or_, [F.col(name).isNull() for name in on])
        many = F.when(no_key, F.lit(salts)).otherwise(F.coalesce("_copies", F.lit(1)))
    else:
        copies = F.lit(salts)
    salted_rows = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), many).cast("int")).drop("_copies")
    salted_table = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), copies - 1)))
    # Spark's own estimate does not see the copies and could still try to broadcast them.
    return salted_rows.join(salted_table.hint("merge"), [*on, "_salt"], how).drop("_salt")
