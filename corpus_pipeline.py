"""A training corpus from raw documents, stage by stage.

Every stage reads what its predecessor kept, written as Parquet in between, and all but the last return
the columns of ``documents``. In every stage null and empty texts are documents without words, rows that
repeat id and text are judged alike, null ids and null sources are values like any other, an empty table
gives an empty result, and further columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textmine.llm import anchors, decontaminate, lines, mixing, toxicity
from textmine.sources.scratch import written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the class-conditional models do not score as toxic."""
    return toxicity.remove_toxic(docs, _table(spark, sf_dir, "labels"))


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that stand in more than a tenth of their source's distinct texts.

    Every document stays, and its ``n_chars`` follows its text.
    """
    return lines.drop_boilerplate_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group linked by SimHash; see ``op4``.

    Documents without words form one group, so one of them stays.
    """
    return anchors.remove_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.remove_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, numbered in ``copy``; sources without words give none."""
    return mixing.mixture(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_boilerplate_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

# Language models and fingerprints have no SQL form; tests compare every stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
