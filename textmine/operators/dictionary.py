"""A vocabulary with dense numbers that never leaves Spark, and feature vectors over it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from textmine.operators.lookup import lookup_join
from textmine.operators.terms import Vocabulary, term_counts
from textmine.sources.scratch import scratch_path, written

#: Bits of the row numbers that Spark deals out within a partition.
_PLACE_BITS = 33
LARGEST = (1 << 31) - 1


def numbered_terms(vocabulary: Vocabulary) -> Vocabulary:
    """The same vocabulary with ``index`` from 0 on: most frequent terms first, ties in order of the term.

    Terms are range-partitioned and sorted in place. A term's number is its place in its partition plus the
    sizes of the partitions before, so only one count per partition reaches the driver.
    """
    spark = vocabulary.table.sparkSession
    ordered = vocabulary.table.orderBy(F.desc("cf"), "term").withColumn("_n", F.monotonically_increasing_id())
    stored = written(ordered, "ordered-terms")
    part = F.shiftright("_n", _PLACE_BITS)
    sizes = stored.groupBy(part.alias("part")).agg(F.count("*").alias("size")).collect()
    before, starts = 0, []
    for row in sorted(sizes, key=lambda r: r["part"]):
        starts.append((row["part"], before))
        before += row["size"]
    offsets = F.broadcast(spark.createDataFrame(starts, "_part long, _start long"))
    place = F.col("_n").bitwiseAND((1 << _PLACE_BITS) - 1)
    joined = stored.withColumn("_part", part).join(offsets, "_part")
    numbered = joined.withColumn("index", F.col("_start") + place).drop("_n", "_part", "_start")
    return vocabulary._replace(table=written(numbered, "numbered-terms"))


def add_vectors(
    corpus: DataFrame,
    numbered: Vocabulary,
    *key: str,
    keep: Sequence[str] = (),
    stop_words: Sequence[str] | None = None,
) -> DataFrame:
    """A stored table ``(*key, *keep, raw_features, features)``: sparse vectors of counts and of TF-IDF.

    The vectors equal those of the ML pipeline, for a vocabulary of any size: terms are counted inside each
    row and meet the numbered vocabulary in a join, broadcast or salted by its measured size, and a
    document's entries meet by ``key``, which must be unique. A document without known terms has empty
    vectors. ML vectors have at most 2^31 - 1 entries; a larger vocabulary raises.
    """
    if numbered.n_terms > LARGEST:
        raise ValueError(f"{numbered.n_terms} terms; a vector has {LARGEST} entries at most")
    spark = corpus.sparkSession
    names = [*key, *keep]
    counts = term_counts(corpus, *names, stop_words=stop_words, document_rows=True)
    table = numbered.table.select("term", F.col("index").cast("int").alias("index"), "idf", F.col("df").alias("_df"))
    found = lookup_join(counts, table, ["term"], numbered.row_bytes(2), spread_by=key, how="left", frequency="_df")
    entry = F.struct("index", F.col("tf").cast("double").alias("tf"), (F.col("tf") * F.col("idf")).alias("w"))
    entries = F.sort_array(F.collect_list(F.when(F.col("index").isNotNull(), entry)))
    used = found.where(F.col("term").isNull() | F.col("index").isNotNull())
    met = used.groupBy(*key).agg(*[F.first(name).alias(name) for name in keep], entries.alias("e"))

    def vector(value: str):
        """What an ML vector consists of, in Spark's own types."""
        return F.struct(
            F.lit(0).cast("tinyint").alias("type"),
            F.lit(numbered.n_terms).alias("size"),
            F.col("e")["index"].alias("indices"),
            F.col("e")[value].alias("values"),
        )

    plain = met.select(*names, vector("tf").alias("raw_features"), vector("w").alias("features"))
    path = scratch_path(spark, "vectors")
    plain.write.parquet(path)
    fields = [plain.schema[name] for name in names]
    fields += [StructField(name, VectorUDT()) for name in ("raw_features", "features")]
    return spark.read.schema(StructType(fields)).parquet(path)
