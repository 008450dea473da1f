import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from textmine import operators as op
from textmine import sources

TEXTS = [
    "plain",
    'quote " and ; and , inside',
    "back\\slash \\\" end",
    " lead and trail ",
    "carriage\rreturn",
    "ünï “q” 😀",
    "   ",
    "",
    None,
    "\\N is not null",
]


@pytest.fixture
def frame(spark):
    return spark.createDataFrame([(t, str(i)) for i, t in enumerate(TEXTS)], sources.CORPUS)


def test_csv_splittable(spark, frame, tmp_path):
    sources.write_csv(frame, f"{tmp_path}/c")
    back = sources.read_csv(spark, f"{tmp_path}/c", multi_line=False, name="csv_view")
    assert sorted(back.collect(), key=str) == sorted(frame.collect(), key=str)
    assert spark.table("csv_view").count() == len(TEXTS)


def test_csv_multi_line(spark, frame, tmp_path):
    broken = frame.union(spark.createDataFrame([("a\nb\r\nc\rd", "x"), ("\n", "y")], sources.CORPUS))
    sources.write_csv(broken, f"{tmp_path}/c", sep=",")
    back = sources.read_csv(spark, f"{tmp_path}/c", sep=",")
    assert sorted(back.collect(), key=str) == sorted(broken.collect(), key=str)


def test_raw_posts_file(spark, tmp_path):
    (tmp_path / "raw.csv").write_text(
        'Title,Body,Category\n"T ""1""","<p>line\nbreak</p>",money\nT2,plain,anime\n,x,money\n',
        encoding="utf-8",
    )
    raw = sources.read_raw_posts(spark, str(tmp_path / "raw.csv"), name="raw")
    assert raw.columns == ["Title", "Body", "Category"] and raw.count() == 3
    texts = {r["text"] for r in op.build_corpus(raw).collect()}
    assert texts == {"T" + 6 * " " + "line break ", "T  plain", " x"}


def test_small_files(spark, tmp_path):
    df = spark.range(25).select(F.col("id").cast("string").alias("text"), F.lit("c").alias("cat"))
    sources.write_csv(df.coalesce(1), f"{tmp_path}/c", max_records_per_file=10)
    assert len(list((tmp_path / "c").glob("*.csv"))) == 3
    assert sources.read_csv(spark, f"{tmp_path}/c").count() == 25


def test_parquet_and_json(spark, frame, tmp_path):
    sources.write_parquet(frame, f"{tmp_path}/p")
    sources.write_parquet(frame, f"{tmp_path}/p")
    rows = sorted(frame.collect(), key=str)
    assert sorted(sources.read_parquet(spark, f"{tmp_path}/p", "pq").collect(), key=str) == rows
    sources.write_json(frame, f"{tmp_path}/j")
    assert sorted(sources.read_json(spark, f"{tmp_path}/j", sources.CORPUS).collect(), key=str) == rows


def test_cache_compute_and_collect(spark, frame):
    frame.createOrReplaceTempView("to_cache")
    sources.cache_table(spark, "to_cache")
    assert spark.catalog.isCached("to_cache")
    sources.uncache_table(spark, "to_cache")
    assert not spark.catalog.isCached("to_cache")
    kept = sources.compute(frame.where(F.col("cat") == "0"), "kept")
    assert spark.catalog.isCached("kept") and kept.count() == 1
    sources.uncache_table(spark, "kept")
    assert len(sources.collect_small(frame, 100)) == len(TEXTS)
    with pytest.raises(ValueError):
        sources.collect_small(frame, 2)


def test_copy_to(spark):
    df = sources.copy_to(spark, [("a", 1)], "k string, v int", "copied")
    assert df.collect() == spark.table("copied").collect() == [("a", 1)]


def test_spread_leaves_wide_scans_alone(spark):
    wide = spark.range(0, 100, 1, 64)
    assert sources.spread(wide, "id") is wide
    assert sources.spread(wide, "id", cores=100) is wide
    assert sources.spread(wide, "id", cores=200).rdd.getNumPartitions() == 200
    narrow = sources.spread(spark.range(0, 100, 1, 1), "id")
    assert narrow.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_spread_counts_splits_that_hold_rows(spark, tmp_path):
    """One row group of many megabytes: byte ranges for half the cores, all rows in one of them."""
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefghijklmnop", k=12)) for _ in range(50_000)]
    rows = [(k, " ".join(rng.choices(words, k=60))) for k in range(20_000)]
    table = pa.table({"id": [r[0] for r in rows], "text": [r[1] for r in rows]})
    pq.write_table(table, tmp_path / "one.parquet", row_group_size=len(rows), compression="none", use_dictionary=False)
    one = spark.read.parquet(f"file://{tmp_path}/one.parquet")
    assert 2 * one.rdd.getNumPartitions() >= 8
    assert [n for (n,) in one.groupBy(F.spark_partition_id()).count().select("count").collect()] == [len(rows)]
    even = sources.spread(one, "id", cores=8)
    assert even.rdd.getNumPartitions() == 8 and even.groupBy(F.spark_partition_id()).count().count() == 8
    pq.write_table(table, tmp_path / "many.parquet", row_group_size=500, compression="none", use_dictionary=False)
    many = spark.read.parquet(f"file://{tmp_path}/many.parquet")
    assert sources.spread(many, "id", cores=8) is many


def test_scratch_dir_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    path = sources.scratch_dir(spark)
    assert path == configured.rstrip("/") if configured else path.startswith("file:///")
    assert sources.scratch_path(spark, "x") != sources.scratch_path(spark, "x")


def test_scratch_dir_must_be_set_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        sources.scratch_dir(Session())


def test_describe_and_checks(spark, frame):
    rows = {r["name"]: (r["type"], r["present"]) for r in op.describe(frame, "cat").collect()}
    assert rows == {"text": ("string", None), "cat": ("string", len(TEXTS))}
    assert op.row_count(frame).first()["n"] == len(TEXTS)
    assert op.schema_rows(frame) == [("text", "string"), ("cat", "string")]
    assert [r["cat"] for r in op.preview(frame, 2, "cat").collect()] == ["0", "1"]


def test_row_ids_are_unique_and_stay(spark):
    df = spark.range(50).select((F.col("id") % 3).alias("v")).repartition(5)
    numbered = sources.with_row_id(df)
    first = sorted(numbered.collect())
    assert len({r["doc_id"] for r in first}) == 50
    assert sorted(numbered.repartition(3).collect()) == first


def test_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "raw.csv").write_text("Category,Other,Title,Body\nmoney,o,t,b\n", encoding="utf-8")
    row = sources.read_raw_posts(spark, str(tmp_path / "raw.csv")).first()
    assert (row["Title"], row["Body"], row["Category"]) == ("t", "b", "money")
    (tmp_path / "bad.csv").write_text("Category,Title\nmoney,t\n", encoding="utf-8")
    with pytest.raises(ValueError, match="Body"):
        sources.read_raw_posts(spark, str(tmp_path / "bad.csv"))


@pytest.mark.parametrize("record", ["t,b,money,surplus", "only"])
def test_malformed_records_raise(spark, tmp_path, record):
    (tmp_path / "raw.csv").write_text(f"Title,Body,Category\nt,b,c\n{record}\n", encoding="utf-8")
    with pytest.raises(Exception, match="(?i)malformed"):
        sources.read_raw_posts(spark, str(tmp_path / "raw.csv")).collect()
    kept = sources.read_raw_posts(spark, str(tmp_path / "raw.csv"), mode="DROPMALFORMED").collect()
    assert [r["Title"] for r in kept] == ["t"]


def test_remove_scratch(spark):
    stored = sources.written(spark.range(3), "gone")
    assert stored.count() == 3
    sources.remove_scratch(spark)
    with pytest.raises(Exception):
        spark.read.parquet(stored.inputFiles()[0]).count()


def test_describe_without_counts_reads_nothing(frame):
    assert [(r["name"], r["present"]) for r in op.describe(frame).collect()] == [("text", None), ("cat", None)]


@pytest.mark.parametrize("kind", ["parquet", "json", "csv"])
def test_overwrite_what_is_read(spark, tmp_path, kind):
    """A table can be changed in place; a write that fails leaves the old one and nothing else."""
    path = f"file://{tmp_path}/table"
    write = {"parquet": sources.write_parquet, "json": sources.write_json, "csv": sources.write_csv}[kind]
    rows = [(k, f"text {k}") for k in range(50)]
    write(spark.createDataFrame(rows, "id long, text string"), path)

    def read():
        if kind == "csv":
            return sources.read_csv(spark, path, "id long, text string")
        return spark.read.schema("id long, text string").format(kind).load(path)

    write(read().where("id < 30").withColumn("text", F.upper("text")), path)
    expected = [(k, f"TEXT {k}") for k in range(30)]
    assert sorted(map(tuple, read().collect())) == expected
    broken = read().withColumn("text", F.when(F.col("id") == 29, F.raise_error(F.lit("lost"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="lost"):
        write(broken, path)
    assert sorted(map(tuple, read().collect())) == expected
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["table"]
