"""Intermediate tables in the shared folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_folders: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. A temporary one stands in only for a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_folders:
        folder = tempfile.mkdtemp(prefix="textmine-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_folders[app] = f"file://{folder}"
    return _local_folders[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in this application's folder, which can go once the application has ended."""
    app = spark.conf.get("spark.app.id", "local")
    return f"{scratch_dir(spark)}/textmine/{app}/{name}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; nothing that reads them works afterwards."""
    app = spark.conf.get("spark.app.id", "local")
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_dir(spark)}/textmine/{app}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and go on from the stored table, so no later job repeats its lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_row_id(df: DataFrame, name: str = "doc_id") -> DataFrame:
    """Give every row a number once and go on from the stored table, where it no longer changes.

    For sources without a key. A hash of the content will not do: copies would share it.
    """
    return written(df.withColumn(name, F.monotonically_increasing_id()), "rows")
