"""Benchmark decontamination: find the word windows of test items in documents.

Windows of normalised words are hashed; the table of test windows is broadcast when its measured size
allows and joined by hash otherwise. Every hit is verified on the words themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmine.llm.common import ascii_lower, text_hash, with_results, words
from textmine.sources.scratch import written

# Fixed value: what separates words. Letters A to Z are lower-cased before.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def normalised_words(text: Column) -> Column:
    return words(ascii_lower(text), SEPARATORS)


def item_windows(
    items: DataFrame, window: int = WINDOW, item_id: str = "item_id", text: str = "text"
) -> DataFrame:
    """Stored ``(n, gram, h, items)``: one row per distinct window with the items that have it.

    An item with fewer words than ``window`` is one window, an item without words none.
    """
    split = items.select(
        F.col(item_id).cast("string").alias("item"), normalised_words(F.col(text)).alias("w")
    ).where(F.size("w") > 0)
    sized = split.withColumn("n", F.least(F.size("w"), F.lit(window)))
    grams = sized.select(
        "item",
        "n",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size("w") - F.col("n") + 1),
                lambda i: F.slice("w", i, F.col("n")),
            )
        ).alias("gram"),
    )
    grouped = grams.groupBy("gram", "n").agg(F.collect_set("item").alias("items"))
    return written(grouped.withColumn("h", F.xxhash64("gram")), "item-windows")


def find_hits(
    docs: DataFrame,
    windows: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    limit: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """``(_id, _hash, spans, items)`` of documents with hits.

    ``spans`` are sorted ``(pos, n)`` word positions from 0, ``items`` the sorted distinct items.
    A document's windows are made and looked up one by one within the scan; only hits are shuffled.
    """
    sizes = windows.groupBy("n").agg(
        F.sum(64 + 24 * F.col("n") + F.octet_length(F.concat_ws("", "gram", "items"))).alias("bytes")
    ).collect()  # a row per window length
    lengths = [row["n"] for row in sizes] or [WINDOW]
    rows = docs.select(
        F.col(doc_id).alias("_id"),
        text_hash(F.col(text)).alias("_hash"),
        normalised_words(F.col(text)).alias("w"),
        F.lit(lengths[0]).alias("n"),
    )
    if len(lengths) > 1:
        rows = rows.withColumn("n", F.explode(F.array(*[F.lit(n) for n in lengths])))
    # The outer form keeps Spark from splitting every text a second time for a filter.
    starts = F.when(F.size("w") >= F.col("n"), F.sequence(F.lit(1), F.size("w") - F.col("n") + 1))
    placed = rows.select("_id", "_hash", "w", "n", F.explode_outer(starts).alias("at"))
    placed = placed.where(F.col("at").isNotNull())
    gram = F.slice("w", F.col("at"), F.col("n"))
    test = windows.select("h", F.col("gram").alias("test_gram"), "items")
    if sum(row["bytes"] for row in sizes) <= limit:
        hits = placed.join(F.broadcast(test), (F.xxhash64(gram) == test["h"]) & (gram == F.col("test_gram")))
    else:
        # Of windows only places and hashes are shuffled; what meets a test window is verified on the text,
        # which travels once per document.
        hashed = placed.select("_id", "_hash", "n", "at", F.xxhash64(gram).alias("h"))
        met = hashed.join(test.hint("merge"), "h").withColumnsRenamed({"_id": "i", "_hash": "ih"})
        texts = docs.select(F.col(doc_id).alias("_id"), text_hash(F.col(text)).alias("_hash"), F.col(text).alias("t"))
        same = F.col("_id").eqNullSafe(F.col("i")) & (F.col("_hash") == F.col("ih"))
        read = met.join(texts, same).withColumn("w", normalised_words(F.col("t")))
        hits = read.where(F.slice("w", F.col("at"), F.col("n")) == F.col("test_gram"))
    return (
        hits.select("_id", "_hash", F.struct((F.col("at") - 1).alias("pos"), "n").alias("span"), "items")
        .groupBy("_id", "_hash")
        .agg(
            F.array_sort(F.collect_set("span")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
    )


def covered(spans: Column) -> Column:
    """Number of words inside at least one of the sorted spans."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))

    def step(acc: Column, span: Column) -> Column:
        end = span["pos"] + span["n"]
        new = F.greatest(end - F.greatest(span["pos"], acc["end"]), F.lit(0))
        return F.struct((acc["n"] + new).alias("n"), F.greatest(acc["end"], end).alias("end"))

    return F.aggregate(spans, start, step, lambda acc: acc["n"])


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    limit: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items, contaminated``.

    Null and empty texts have no words and no hits; repeated rows each keep a row; an empty item
    table hits nothing; other columns are ignored. Items without words are never found; equal items
    all count. Very long texts are handled in the row, window by window.
    """
    found = find_hits(docs, item_windows(items, window, item_id, item_text), doc_id, text, limit)
    hit = found.select(
        "_id", "_hash", covered(F.col("spans")).alias("n_hit"), F.col("items").alias("hit_items")
    )
    counted = docs.select(
        F.col(doc_id).alias("doc_id"),
        text_hash(F.col(text)).alias("h"),
        F.size(normalised_words(F.col(text))).cast("long").alias("n_words"),
    )
    on = counted["doc_id"].eqNullSafe(hit["_id"]) & (counted["h"] == hit["_hash"])
    joined = counted.join(hit, on, "left")
    hits = F.coalesce("n_hit", F.lit(0).cast("long"))
    listed = F.coalesce("hit_items", F.array().cast("array<string>"))
    return joined.select(
        "doc_id",
        "n_words",
        hits.alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        listed.alias("items"),
        (hits > 0).alias("contaminated"),
    )


def remove_contaminated(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    mode: str = "documents",
    doc_id: str = "doc_id",
    text: str = "text",
    limit: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Documents without the contaminated ones, or with ``mode="spans"`` without the hit words.

    All columns stay. A removed span leaves the separators around its words in place.
    """
    found = find_hits(docs, item_windows(items, window), doc_id, text, limit)
    if mode == "documents":
        return with_results(docs, found.select("_id", "_hash"), doc_id, text, "left_anti")
    spans = found.select("_id", "_hash", F.col("spans").alias("_hit_spans"))
    joined = with_results(docs, spans, doc_id, text, "left")
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    kept = F.transform(
        F.regexp_extract_all(F.col(text), F.lit(f"({word})"), F.lit(1)),
        lambda w, i: F.when(
            F.exists("_hit_spans", lambda s: (s["pos"] <= i) & (i < s["pos"] + s["n"])), ""
        ).otherwise(w),
    )
    gaps = F.split(F.col(text), word, -1)
    rebuilt = F.array_join(F.flatten(F.transform(F.arrays_zip(gaps.alias("g"), kept.alias("w")), lambda p: F.array(p["g"], p["w"]))), "")
    return joined.withColumn(
        text, F.when(F.col("_hit_spans").isNull(), F.col(text)).otherwise(rebuilt)
    ).drop("_hit_spans")
