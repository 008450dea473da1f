"""Line dedup by site-relative frequency.

Pages are grouped by host. A line that stands on more than a given share of its host's pages is
boilerplate and leaves them. Lines travel as 128-bit hashes, counted once per page and combined before
the shuffle; a host's boilerplate has at most (lines per page / ratio) entries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmine.llm.common import fresh, null_safe_lookup
from textmine.sources.scratch import written

RATIO = 0.1
MIN_PAGES = 5
NEWLINE = "\n"
# Tags and line breaks end a line of an HTML page.
HTML_LINES = r"<[^>]*>|\n"


def host_of(url: Column) -> Column:
    """Host of a URL, lower-cased; empty if there is none, null for null."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def split_lines(text: Column, pattern: str = NEWLINE) -> Column:
    """Lines as they stand, empty ones included; null has none."""
    return F.when(text.isNull(), F.array().cast("array<string>")).otherwise(F.split(text, pattern, -1))


def _digest(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(0), line).alias("b"))


def _counted(line: Column) -> Column:
    return F.trim(line) != ""


def boilerplate(
    pages: DataFrame,
    host: Column,
    lines: Column,
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    distinct: bool = False,
) -> DataFrame:
    """Stored ``(host, drop)``: per host the digests of lines above ``ratio`` of its pages.

    Blank lines never count. A line needs ``min_pages`` pages, so that hosts with few pages keep
    theirs. Null is a host of its own. With ``distinct``, pages of a host with the same lines in the
    same order count as one.
    """
    rows = pages.select(
        host.alias("host"),
        F.array_distinct(F.transform(F.filter(lines, _counted), lambda x: _digest(x))).alias("lines"),
        *([_digest(lines).alias("page")] if distinct else []),
    )
    if distinct:
        rows = rows.groupBy("host", "page").agg(F.first("lines").alias("lines"))
    # A null entry per page counts the pages in the same aggregation.
    page = F.array(F.struct(F.lit(None).cast("long").alias("a"), F.lit(None).cast("long").alias("b")))
    counts = (
        rows.select("host", F.explode(F.concat(page, F.col("lines"))).alias("line"))
        .groupBy("host", F.col("line.a").alias("a"), F.col("line.b").alias("b"))
        .agg(F.count("*").alias("n"))
        .where((F.col("n") >= min_pages) | F.col("a").isNull())
    )
    stored = written(counts, "line-counts")
    totals = stored.where(F.col("a").isNull()).select(F.col("host").alias("_host"), F.col("n").alias("pages"))
    size = totals.agg(F.sum(64 + F.coalesce(F.octet_length("_host"), F.lit(0)))).first()[0] or 0
    frequent = stored.where(F.col("a").isNotNull()).withColumn("_host", F.col("host"))
    found = null_safe_lookup(frequent, totals, "_host", size, ["a", "b"]).where(F.col("n") > F.col("pages") * ratio)
    lists = found.groupBy("_host").agg(F.collect_set(F.struct("a", "b")).alias("drop"))
    return written(lists, "boilerplate")


def drop_boilerplate(
    pages: DataFrame,
    host: Column,
    lines: Column,
    key: str,
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    distinct: bool = False,
    all_name: str = "lines",
    kept_name: str = "kept",
) -> DataFrame:
    """All columns of ``pages`` and the arrays ``all_name`` and ``kept_name``, which must be new names.

    Blank lines stay, null texts have no lines, repeated rows count as pages of their own unless
    ``distinct`` is set, an empty table gives an empty result. Every row keeps its place even when all
    its lines go. Pages without a host, null or empty, are one host each way. Columns of ``pages`` may have
    any other names.
    """
    taken = {c.lower() for c in pages.columns} & {all_name.lower(), kept_name.lower()}
    if taken:
        raise ValueError(f"the table has columns {sorted(taken)} already; choose other names for the results")
    lists = boilerplate(pages, host, lines, ratio, min_pages, distinct)
    size = lists.agg(F.sum(128 + 48 * F.size("drop"))).first()[0] or 0
    rows = pages.withColumn(all_name, lines)
    of, drop = fresh(rows, "_of_host"), fresh(rows, "_drop_lines")
    joined = null_safe_lookup(rows.withColumn(of, host), lists.toDF(of, drop), of, size, [key], "left")
    stays = F.filter(
        F.col(all_name),
        lambda x: ~_counted(x) | ~F.coalesce(F.array_contains(F.col(drop), _digest(x)), F.lit(False)),
    )
    return joined.withColumn(kept_name, stays).drop(of, drop)


def drop_boilerplate_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", group: str = "source", length: str = "n_chars", **options
) -> DataFrame:
    """``docs`` with the lines of ``text`` that stand in more than a tenth of their group's distinct texts cut out.

    Copies of a document count once, so a large group of copies is not boilerplate to itself. Every
    document and all columns stay; ``length`` follows its text where lines went and is left alone where
    none did. Null texts stay null, a null group is one of its own, repeated rows stay, an empty table gives
    an empty result, further columns may have any names.
    """
    every, kept = fresh(docs, "_lines"), fresh(docs, "_kept_lines")
    split = split_lines(F.col(text))
    cut = drop_boilerplate(
        docs, F.col(group), split, doc_id, distinct=True, all_name=every, kept_name=kept, **options
    )
    shorter = F.size(kept) < F.size(every)
    joined = F.array_join(kept, "\n")
    changed = {text: F.when(shorter, joined).otherwise(F.col(text))}
    changed[length] = F.when(shorter, F.length(joined).cast("long")).otherwise(F.col(length))
    return cut.withColumns(changed).select(*docs.columns)
