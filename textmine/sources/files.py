"""CSV, parquet and JSON files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from textmine.sources.quoted import quoted_records

RAW_POSTS = "Title string, Body string, Category string"
CORPUS = "text string, cat string"
# What stands for null in the library's own files; an empty field stays an empty text.
NULL_MARK = "\\N"


def spread(df: DataFrame, *key: str, cores: int | None = None) -> DataFrame:
    """Hash-spread a scan whose rows lie in far fewer splits than the session has cores.

    One small file would otherwise keep every later step on a single core. Splits that hold no row do not
    count: a file with one row group is read by one task, however many byte ranges it is cut into. Where
    rows come from at least half as many splits as there are ``cores``, the scan is left alone: moving whole
    texts to win less than that costs more. Hashing by a key keeps the layout the same on a retry.
    """
    cores = cores or df.sparkSession.sparkContext.defaultParallelism
    if 2 * df.rdd.getNumPartitions() >= cores and 2 * _splits_with_rows(df, cores) >= cores:
        return df
    return df.repartition(cores, *key)


def _splits_with_rows(df: DataFrame, enough: int) -> int:
    """Distinct splits that rows come from, or many for a scan with many more splits than ``enough``.

    The count reads no column, so of parquet only the footers.
    """
    partitions = df.rdd.getNumPartitions()
    if partitions > 8 * enough or not df.inputFiles():
        return partitions
    split = F.struct(F.input_file_name(), F.expr("input_file_block_start()"))
    return df.select(split.alias("split")).distinct().count()


def _registered(df: DataFrame, name: str | None) -> DataFrame:
    if name:
        df.createOrReplaceTempView(name)
    return df


def _header(spark: SparkSession, path: str, sep: str, multi_line: bool) -> list[str]:
    """Column names of the first record."""
    options = {"sep": sep, "quote": '"', "escape": '"', "encoding": "UTF-8", "multiLine": multi_line, "header": True}
    return spark.read.options(**options).csv(path).columns


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str | StructType = CORPUS,
    sep: str = ";",
    multi_line: bool = True,
    name: str | None = None,
    mode: str = "FAILFAST",
    null_mark: str | None = NULL_MARK,
    split: bool = False,
) -> DataFrame:
    """Delimited text with a header; the columns of ``schema`` are found by their names there.

    Doubled quotes stand for a quote. Columns may come in any order and others may stand between
    them. A missing column raises, and so does a record with too few or too many fields, unless
    ``mode`` is Spark's ``PERMISSIVE`` or ``DROPMALFORMED``. A field that is ``null_mark`` is null;
    without a mark empty fields are.

    ``multi_line`` reads fields with line breaks, one task per file. Cleaned text holds no ``\\n``,
    so ``multi_line=False`` splits big files among tasks; a lone ``\\r`` stays inside its field.
    ``split`` reads fields with line breaks by many tasks per file, at the price of reading twice; quotes may
    then stand around fields only, and ``DROPMALFORMED`` is not supported. See ``quoted_records``.
    """
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    found = _header(spark, path, sep, multi_line)
    missing = [field.name for field in wanted if field.name not in found]
    if missing:
        raise ValueError(f"no column {missing} in {path}; its header is {found}")
    types = {field.name: field.dataType for field in wanted}
    file_schema = StructType([StructField(column, types.get(column, StringType())) for column in found])
    if split:
        return _registered(_split_csv(spark, path, file_schema, sep, mode, null_mark).select(*wanted.names), name)
    reader = (
        spark.read.schema(file_schema)
        .option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("multiLine", multi_line)
        .option("mode", mode)
        # A malformed record shows only if all its fields are parsed.
        .option("columnPruning", False)
    )
    if null_mark is not None:
        reader = reader.option("nullValue", null_mark).option("emptyValue", "")
    if not multi_line:
        reader = reader.option("lineSep", "\n")
    return _registered(reader.csv(path).select(*wanted.names), name)


def _split_csv(
    spark: SparkSession, path: str, file_schema: StructType, sep: str, mode: str, null_mark: str | None
) -> DataFrame:
    """The records of ``quoted_records`` but for the headers, each parsed by itself."""
    if mode.upper() not in ("FAILFAST", "PERMISSIVE"):
        raise ValueError(f"mode {mode} is not supported with split")
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": mode, "multiLine": "true"}
    if null_mark is not None:
        options |= {"nullValue": null_mark, "emptyValue": ""}
    records = quoted_records(spark, path).where(~F.col("first"))
    return records.select(F.from_csv("record", file_schema.toDDL(), options).alias("r")).select("r.*")


def read_raw_posts(
    spark: SparkSession, path: str, name: str | None = None, mode: str = "FAILFAST", split: bool = False
) -> DataFrame:
    """Raw posts by column name: ``Title``, ``Body`` and ``Category`` of whatever header there is."""
    return read_csv(
        spark, path, schema=RAW_POSTS, sep=",", multi_line=True, name=name, mode=mode, null_mark=None, split=split
    )


def all_strings(df: DataFrame) -> StructType:
    """Schema with the columns of ``df``, all read as strings."""
    return StructType([StructField(name, StringType()) for name in df.columns])


def write_csv(
    df: DataFrame,
    path: str,
    sep: str = ";",
    mode: str = "overwrite",
    max_records_per_file: int = 1_000_000,
) -> None:
    """Header, every value quoted, null as ``NULL_MARK``. Bounded files keep a multi-line read parallel."""
    writer = (
        df.write.option("header", True)
        .option("sep", sep)
        .option("quoteAll", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("nullValue", NULL_MARK)
        .option("emptyValue", "")
        .option("maxRecordsPerFile", max_records_per_file)
        # The defaults trim values on writing.
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    _saved(df, writer.format("csv"), path, mode)


def read_parquet(
    spark: SparkSession, path: str, name: str | None = None, schema: StructType | None = None
) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return _registered(reader.parquet(path), name)


def _saved(df: DataFrame, writer: DataFrameWriter, path: str, mode: str) -> None:
    """Save; ``overwrite`` swaps a complete new folder for the old one, which ``df`` may still read.

    The new table is written beside ``path`` and takes its place when it is whole: a write that fails leaves
    the old table, and no reader finds a half-written one. Between the two renames of the swap there is for a
    moment no table; if the second fails, the old one is put back.
    """
    if mode != "overwrite":
        writer.mode(mode).save(path)
        return
    spark = df.sparkSession
    mark = uuid.uuid4().hex
    place, staged, old = (f"{path.rstrip('/')}{end}" for end in ("", f".staged-{mark}", f".old-{mark}"))
    of = spark._jvm.org.apache.hadoop.fs.Path
    files = of(place).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        writer.mode("error").save(staged)
    except Exception:
        files.delete(of(staged), True)
        raise
    moved = files.exists(of(place)) and files.rename(of(place), of(old))
    if files.exists(of(place)) or not files.rename(of(staged), of(place)):
        if moved:
            files.rename(of(old), of(place))
        raise OSError(f"{place} could not be replaced; the new table is at {staged}")
    if moved:
        files.delete(of(old), True)
    spark.catalog.refreshByPath(place)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``overwrite`` replaces the table when the new one is whole, and may read what it replaces."""
    _saved(df, df.write.format("parquet"), path, mode)


def read_json(
    spark: SparkSession, path: str, schema: StructType | str, name: str | None = None
) -> DataFrame:
    return _registered(spark.read.schema(schema).json(path), name)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines. Give vector columns as arrays or long rows: JSON has no vector type."""
    _saved(df, df.write.format("json"), path, mode)


def writable_features(df: DataFrame, *vectors: str) -> DataFrame:
    """A feature table for text formats: vectors as JSON of size, indices and values, arrays as JSON."""
    for name in vectors:
        df = df.withColumn(name, F.to_json(F.unwrap_udt(name)))
    arrays = [field.name for field in df.schema if isinstance(field.dataType, ArrayType)]
    return df.withColumns({name: F.to_json(name) for name in arrays})
