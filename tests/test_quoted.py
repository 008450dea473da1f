"""Delimited text with line breaks in fields, read in splits: the rows of the reader that takes one task per file."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from textmine import sources


@pytest.fixture(scope="module", params=["64b", "300b", "1500b", "128m"])
def split_size(request, spark):
    """Splits so small that records cross several of them, and one for all."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


def posts(rng, n):
    pieces = ["a", "bb", "\n", "\n\n", '"', '""', ",", ";", "é“", " ", "\t", "x" * 40, "\n\"quoted\"\n", "<p>"]
    rows = []
    for k in range(n):
        body = "".join(rng.choices(pieces, k=rng.randint(0, 25))) if k % 17 else "line\n" * 150
        rows.append((f"title {k}", body, rng.choice(["one", "two, three", ""])))
    return rows


def write(path, rows, end="\n", header=("Title", "Body", "Category"), quote=csv.QUOTE_MINIMAL):
    with open(path, "w", newline="", encoding="utf-8") as file:
        out = csv.writer(file, lineterminator=end, quoting=quote)
        out.writerow(header)
        out.writerows(rows)


@pytest.mark.parametrize("end,quote", [("\n", csv.QUOTE_MINIMAL), ("\n", csv.QUOTE_ALL), ("\r\n", csv.QUOTE_ALL)])
def test_equal_rows(spark, tmp_path, split_size, end, quote):
    rng = random.Random(6)
    for name, n in (("a", 40), ("b", 1), ("c", 25), ("none", 0)):
        write(tmp_path / f"{name}.csv", posts(rng, n), end, quote=quote)
    path = f"file://{tmp_path}"
    whole = sources.read_raw_posts(spark, path)
    split = sources.read_raw_posts(spark, path, split=True)
    assert split.schema == whole.schema
    key = lambda r: tuple(x or "" for x in r)
    assert sorted(split.collect(), key=key) == sorted(whole.collect(), key=key)
    assert split.count() == 66


def test_one_file_by_many_tasks(spark, tmp_path):
    write(tmp_path / "posts.csv", posts(random.Random(2), 3000))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000b")
    try:
        split = sources.read_raw_posts(spark, f"file://{tmp_path}/posts.csv", split=True)
        tasks = split.groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) > 8 and sum(r["count"] for r in tasks) == 3000
        assert max(r["count"] for r in tasks) < 1000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_nulls_and_empty_texts(spark, tmp_path, split_size):
    rows = [("a", None), ("", "x\ny"), (None, ""), ('q"', "\\N"), ("  ", "\n")]
    df = spark.createDataFrame(rows, "text string, cat string").coalesce(1)
    path = f"file://{tmp_path}/corpus"
    sources.write_csv(df, path)
    whole, split = sources.read_csv(spark, path), sources.read_csv(spark, path, split=True)
    key = lambda r: tuple((x is None, x or "") for x in r)
    assert sorted(split.collect(), key=key) == sorted(whole.collect(), key=key)


def test_columns_by_name_and_types(spark, tmp_path):
    write(tmp_path / "t.csv", [("x\ny", "7", "c")], header=("Body", "n", "Category"))
    found = sources.read_csv(spark, f"file://{tmp_path}/t.csv", "n int, Body string", sep=",", split=True)
    assert [tuple(r) for r in found.collect()] == [(7, "x\ny")]


def test_bad_files(spark, tmp_path):
    (tmp_path / "open.csv").write_text('Title,Body,Category\na,"never\nends,b\n')
    with pytest.raises(ValueError, match="never ends"):
        sources.read_raw_posts(spark, f"file://{tmp_path}/open.csv", split=True)
    (tmp_path / "short.csv").write_text("Title,Body,Category\na,b\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        sources.read_raw_posts(spark, f"file://{tmp_path}/short.csv", split=True).collect()
    with pytest.raises(ValueError, match="not supported"):
        sources.read_raw_posts(spark, f"file://{tmp_path}/short.csv", mode="DROPMALFORMED", split=True)


def test_csv_split_bounds_what_one_task_writes(monkeypatch, spark, tmp_path):
    """Large tables go to several files; a small one stays one file."""
    from textmine.checks import queries

    texts = [f'line {i}\n"quoted", and\nmore' if i % 7 else None for i in range(3000)]
    rows = spark.createDataFrame([(i, text, "en") for i, text in enumerate(texts)], "doc_id long, text string, lang string")
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    written = []
    kept = sources.scratch_path
    monkeypatch.setattr(sources, "scratch_path", lambda *a: written.append(kept(*a)) or written[-1])
    several = -(-sum(len(text) for text in texts if text) // 10_000)
    for size, files in ((queries.CSV_FILE_BYTES, 1), (10_000, several)):
        monkeypatch.setattr(queries, "CSV_FILE_BYTES", size)
        found = queries.csv_split(spark, str(tmp_path))
        assert sorted(map(str, found.collect())) == sorted(map(str, rows.toDF("doc_id", "text", "cat").collect()))
        assert spark.read.text(written[-1]).select(F.input_file_name()).distinct().count() == files
