"""Named tables: register, cache, compute, copy in, collect."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.types import StructType


def cache_table(spark: SparkSession, name: str) -> DataFrame:
    """Cache a named table and fill the cache."""
    spark.catalog.cacheTable(name)
    table = spark.table(name)
    table.count()
    return table


def uncache_table(spark: SparkSession, name: str) -> None:
    spark.catalog.uncacheTable(name)


def compute(df: DataFrame, name: str) -> DataFrame:
    """Run ``df`` now and keep the cached result under ``name``."""
    df.createOrReplaceTempView(name)
    return cache_table(df.sparkSession, name)


def copy_to(
    spark: SparkSession,
    rows: Iterable[tuple],
    schema: str | StructType,
    name: str | None = None,
) -> DataFrame:
    """Move a small local table into Spark."""
    df = spark.createDataFrame(list(rows), schema)
    if name:
        df.createOrReplaceTempView(name)
    return df


def collect_small(df: DataFrame, max_rows: int = 100_000) -> list[Row]:
    """Collect a result that is known to be small; more rows than ``max_rows`` raise an error."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; aggregate it in Spark first")
    return rows
