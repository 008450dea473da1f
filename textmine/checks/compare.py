"""Run registered queries next to their SQL twins: ``python -m textmine.checks.compare FOLDER [NAME ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from textmine.checks.oracles import oracles
from textmine.checks.queries import registered


def duckdb_tables(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when the DataFrame and the SQL give the same columns and the same rows in any order."""
    ours = [tuple(row) for row in df.select(*sorted(df.columns)).collect()]
    cursor = connection.execute(sql)
    columns = [column[0] for column in cursor.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(columns)}"
    order = [columns.index(column) for column in sorted(columns)]
    theirs = [tuple(row[i] for i in order) for row in cursor.fetchall()]
    left, right = Counter(ours), Counter(theirs)
    if left == right:
        return ""
    only_left = list((left - right).elements())
    only_right = list((right - left).elements())
    return (
        f"{len(ours)} and {len(theirs)} rows, {len(only_left)} and {len(only_right)} differ: "
        f"{str(only_left[:2])[:300]} {str(only_right[:2])[:300]}"
    )


def compare(spark: SparkSession, connection, folder: str, name: str) -> str:
    """Differences of a registered query; one without SQL only has to give rows."""
    df = registered()[name](spark, folder)
    sql = oracles().get(name)
    if sql is None:
        return "" if df.take(1) else "no rows"
    return differences(df, connection, sql)


def main(folder: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duckdb_tables(folder)
    failed = 0
    for name in names or registered():
        start = time.time()
        try:
            problem = compare(spark, connection, folder, name)
        except Exception as error:  # keep going: one report for all queries
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} {time.time() - start:6.2f}s {problem}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
