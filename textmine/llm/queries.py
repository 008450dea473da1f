"""Registered queries of the operators: each runs one over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmine.llm import (
    anchors, bitslice, decontaminate, lines, mixing, negatives, pii, repeats, resample, secrets, simhash, toxicity, warc,
)
from textmine.llm.common import spans_text
from textmine.sources.scratch import written

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op2_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """``n_within`` counts the documents within three bits of those whose id is divisible by 100."""
    prints = written(simhash.neighbour_fingerprints(table(spark, folder, "documents")), "fingerprints")
    asked = F.col("doc_id") % 100 == 0
    near = simhash.within_radius(prints, prints.where(asked)).toDF("q", "q2", "near")

    def text(name: str) -> Column:
        return F.concat(simhash.hex64(F.col(f"{name}2")), simhash.hex64(F.col(name)))

    def likeness(name: str) -> Column:
        differing = simhash.distance(F.col("fp"), F.col("fp2"), F.col(name), F.col(f"{name}2"))
        return (1 - differing / 128).cast("double")

    joined = prints.join(near, (F.col("fp") == F.col("q")) & (F.col("fp2") == F.col("q2")), "left")
    return joined.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        text("fp").alias("fingerprint"),
        text("edited_fp").alias("edited_fingerprint"),
        likeness("edited_fp").alias("near_edited"),
        likeness("next_fp").alias("near_next"),
        F.when(asked, F.col("near")).alias("n_within"),
    )


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = repeats.remove_repeats(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_simhash_links(spark: SparkSession, folder: str) -> DataFrame:
    return anchors.linked_documents(table(spark, folder, "documents"))


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived_pages(table(spark, folder, "pages"))


def _by_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    """``scores`` has those of the listed spans, in their order."""
    found = pii.personal_data(table(spark, folder, "documents"))
    kinds = [kind.name for kind in pii.KINDS if kind.base]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    return found.select(
        "doc_id",
        *[_by_kind(F.col("spans"), kind) for kind in kinds],
        F.sha2(spans_text(base), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
        F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",").alias("scores"),
    )


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, folder, "documents"))
    # Added spans never overlap base ones, so the start alone orders them among each other.
    every = F.array_sort(
        F.transform(
            F.concat("base", "added"),
            lambda s: F.struct(
                s["start"].alias("start"),
                F.array_position(F.array(*[F.lit(k) for k in [*secrets.KINDS, "random"]]), s["kind"]),
                s["end"].alias("end"),
                s["kind"].alias("kind"),
            ),
        )
    )
    return found.select(
        "doc_id",
        *[_by_kind(F.col("base"), kind) for kind in secrets.KINDS],
        F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
        spans_text(every).alias("spans"),
    )


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mix = mixing.mixed(table(spark, folder, "documents").select("doc_id", "text", "source"))
    return mix.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    split = lines.split_lines(F.col("html"), lines.HTML_LINES)
    kept = lines.drop_boilerplate(pages, lines.host_of(F.col("url")), split, "page_id")
    return kept.select(
        "page_id",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
        F.sha2(F.array_join("kept", "\n"), 256).alias("kept_sha256"),
    )


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, moved)


def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resample.importance_resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    return bitslice.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def registered() -> dict[str, Query]:
    named = (
        op1_decontaminate, op2_fingerprints, op3_substring_dedup, op4_simhash_links, op5_warc, op6_pii,
        op7_toxicity, op8_secrets, op9_mixing, op10_line_dedup, op11_hard_negatives, op12_importance_resampling,
        op13_topk_search,
    )
    return {query.__name__: query for query in named}
