"""SimHash fingerprints and the search for all fingerprints within a Hamming radius.

Terms are runs of consecutive words; every occurrence votes with the bits of its hash, so a term weighs
as often as it stands in the text. Votes are plain sums, combined within the scan: a 64-bit hash is
added up as 32 long sums of two 32-bit lanes each. All of it is built-in DataFrame functions.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmine.llm.common import range_bucket, text_hash, words

LANES = 0x0000000100000001
TERM_WORDS = 3
RADIUS = 3


def _bits(hashed: str, name: str) -> list[Column]:
    return [
        F.sum(F.shiftrightunsigned(hashed, k).bitwiseAND(F.lit(LANES))).alias(f"{name}{k}") for k in range(32)
    ]


def _majority(name: str, total: str) -> Column:
    """The 64 bits that are set in more than half of ``total`` votes, as a long."""
    value = F.lit(0).cast("long")
    for k in range(32):
        low = F.col(f"{name}{k}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(f"{name}{k}", 32)
        for votes, bit in ((low, k), (high, k + 32)):
            set_bit = F.shiftleft(F.lit(1).cast("long"), bit)
            value = value.bitwiseOR(F.when(votes * 2 > F.col(total), set_bit).otherwise(F.lit(0).cast("long")))
    return value


def _term(at: Column, size: int) -> list[Column]:
    """The words of the term that starts at ``at``; null beyond the end, which hashing skips."""
    return [F.get("w", at + i) for i in range(size)]


def _term_starts(size: int) -> Column:
    """Starts of all terms; fewer words than ``size`` make one term, none makes none."""
    n = F.size("w")
    return F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - size, F.lit(0))))


def joined_term_hash(at: Column, size: int) -> Column:
    """XXH64 with seed 42 of the words joined by one space."""
    return F.xxhash64(F.concat_ws(" ", *_term(at, size)))


def fingerprint_votes(rows: DataFrame, keys: list[str], size: int, joined: bool, wide: bool) -> DataFrame:
    """Fingerprints ``fp`` (and ``fp2`` when ``wide``) per ``keys`` of rows with words ``w``.

    Rows without words get zero. ``joined`` hashes the space-joined term, otherwise its words in turn.
    """
    placed = rows.select(*keys, "w", F.explode_outer(_term_starts(size)).alias("at"))
    term = joined_term_hash(F.col("at"), size) if joined else F.xxhash64(*_term(F.col("at"), size))
    hashed = placed.select(*keys, F.when(F.col("at").isNotNull(), term).alias("h"))
    votes = [F.count("h").alias("terms"), *_bits("h", "a")]
    if wide:
        # A second hash of the first one widens the fingerprint to 128 bits.
        hashed = hashed.withColumn("h2", F.when(F.col("h").isNotNull(), F.xxhash64("h")))
        votes += _bits("h2", "b")
    summed = hashed.groupBy(*keys).agg(*votes)
    empty = F.col("terms") == 0
    result = [F.when(empty, F.lit(0).cast("long")).otherwise(_majority("a", "terms")).alias("fp")]
    if wide:
        result.append(F.when(empty, F.lit(0).cast("long")).otherwise(_majority("b", "terms")).alias("fp2"))
    return summed.select(*keys, *result)


def hex64(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def distance(a: Column, a2: Column, b: Column, b2: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) + F.bit_count(a2.bitwiseXOR(b2))


def neighbour_fingerprints(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    term_words: int = TERM_WORDS,
    buckets: int | None = None,
) -> DataFrame:
    """Fingerprints of every text, of its edited form, and of the next text by ascending id.

    Gives ``doc_id, n_chars, edited_sha256, fp, fp2, edited_fp, edited_fp2, next_fp, next_fp2``. The
    edited form replaces the last quarter by the start of the next document; after the last comes the
    first. Rows are dealt once into ranges of the id, each with a copy of the row that starts the next
    range, so successors, votes and comparisons need no further shuffle and no range needs another.

    Null texts count as empty, empty texts have fingerprint zero. Null ids come first. Equal ids are
    ordered by their text, then stay neighbours. A single document follows itself. An empty table gives
    an empty result; other columns are ignored. ``buckets`` is the number of ranges.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / buckets for i in range(1, buckets)]
    ids = rows.select("id").where(F.col("id").isNotNull())
    low = rows.agg(F.min("id"), F.count_if(F.col("id").isNull())).first()
    quantiles = ids.stat.approxQuantile("id", shares, 1 / (4 * buckets)) if buckets > 1 else []
    # Quantiles are doubles, which are no ids of the table beyond 2^53: a range starts at its smallest id.
    cuts = sorted({min(int(q), 2**63 - 1) for q in quantiles})
    least = ids.groupBy(range_bucket(F.col("id"), cuts).alias("range")).agg(F.min("id").alias("id")) if cuts else None
    bounds = sorted({r["id"] for r in least.collect()} - {low[0]}) if cuts else []
    last = len(bounds)
    # The smallest id of all starts no range, and nothing can be taken from the smallest long.
    jumps = range_bucket(F.col("id"), bounds) != range_bucket(F.col("id") - 1, bounds)
    starts = F.col("id").isin(bounds) if last <= 64 else F.when(F.col("id") > F.lit(low[0]), jumps)
    first = F.col("id").isNull() if low[1] else F.col("id") == F.lit(low[0])
    here = range_bucket(F.col("id"), bounds)
    # The row that starts a range also ends the one before; the first row of all ends the last range.
    copies = F.filter(
        F.array(
            F.struct(here.alias("bucket"), F.lit(0).alias("guest")),
            F.when(starts, F.struct((here - 1).alias("bucket"), F.lit(1).alias("guest"))),
            F.when(first, F.struct(F.lit(last).alias("bucket"), F.lit(2).alias("guest"))),
        ),
        lambda c: c.isNotNull(),
    )
    dealt = rows.select("id", "text", F.inline(copies))
    order = Window.partitionBy("bucket").orderBy("guest", F.col("id").asc_nulls_first(), "text")
    # Only this many characters of the next text are ever used.
    following = dealt.withColumn("next_text", F.lead("text").over(order)).withColumn(
        "seq", F.row_number().over(order)
    )
    n = F.length("text")
    cut = (n / 4).cast("int")
    edited = F.concat(F.expr("left(text, length(text) - int(length(text) / 4))"), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), cut))
    forms = following.select(
        "bucket", "seq", "guest", "id", n.cast("long").alias("n_chars"), "text",
        F.when(F.col("guest") == 0, edited).alias("edited"),
    )
    forms = forms.select(
        "bucket", "seq", "guest", "id", "n_chars",
        F.when(F.col("guest") == 0, F.sha2("edited", 256)).alias("edited_sha256"),
        F.posexplode(F.when(F.col("guest") == 0, F.array("text", "edited")).otherwise(F.array("text"))).alias("form", "t"),
    )
    keys = ["bucket", "seq", "guest", "id", "n_chars", "edited_sha256", "form"]
    split = forms.select(*keys, words(F.col("t")).alias("w"))
    prints = fingerprint_votes(split, keys, term_words, joined=False, wide=True)
    # All rows of a range are in one task already: pairing the forms needs a sort only.
    lined = Window.partitionBy("bucket").orderBy("seq", "form")
    paired = prints.select(
        *keys, "fp", "fp2",
        F.lead("fp", 1).over(lined).alias("edited_fp"), F.lead("fp2", 1).over(lined).alias("edited_fp2"),
        F.lead("fp", 2).over(lined).alias("next_fp"), F.lead("fp2", 2).over(lined).alias("next_fp2"),
    )
    return paired.where((F.col("form") == 0) & (F.col("guest") == 0)).select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256", "fp", "fp2",
        "edited_fp", "edited_fp2", "next_fp", "next_fp2",
    )


def _tables(radius: int) -> list[list[tuple[int, int]]]:
    """Bit ranges that make the key of each permuted table.

    128 bits are cut into ``radius + 2`` blocks. ``radius`` differing bits leave at least two blocks
    untouched, so two equal fingerprints within the radius meet in the table of some pair of blocks.
    """
    count = radius + 2
    edges = [round(i * 128 / count) for i in range(count + 1)]
    blocks = list(zip(edges, edges[1:]))
    return [list(pair) for pair in combinations(blocks, 2)]


def _block(start: int, end: int) -> Column:
    """Bits ``start`` to ``end`` (exclusive) of the 128 in ``fp`` and ``fp2``, in a long."""
    def part(name: str, a: int, b: int) -> Column:
        return F.shiftrightunsigned(F.shiftleft(name, 64 - b), 64 - (b - a))

    if end <= 64:
        return part("fp", start, end)
    if start >= 64:
        return part("fp2", start - 64, end - 64)
    high = part("fp2", 0, end - 64)
    return F.shiftleft(high, 64 - start).bitwiseOR(part("fp", start, 64))


def block_keys(radius: int) -> Column:
    """Array of ``(block, key)``: one entry per permuted table."""
    entries = []
    for number, table in enumerate(_tables(radius)):
        key = F.xxhash64(*[_block(a, b) for a, b in table])
        entries.append(F.struct(F.lit(number).alias("block"), key.alias("key")))
    return F.array(*entries)


def within_radius(prints: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(fp, fp2, near)``: number of rows of ``prints`` within ``radius`` bits of each query print.

    Both sides have ``fp`` and ``fp2``; equal prints are counted first, so copies meet as one row. Every
    print enters each permuted table under two of its blocks; a pair is checked where it meets, and
    pairs that meet in several tables are counted once.
    """
    known = prints.groupBy("fp", "fp2").agg(F.count("*").alias("rows"))
    t = known.select("fp", "fp2", "rows", F.inline(block_keys(radius))).alias("t")
    q = queries.select("fp", "fp2").distinct().select("fp", "fp2", F.inline(block_keys(radius))).alias("q")
    near = distance(F.col("q.fp"), F.col("q.fp2"), F.col("t.fp"), F.col("t.fp2")) <= radius
    met = q.join(t, (F.col("q.block") == F.col("t.block")) & (F.col("q.key") == F.col("t.key")) & near)
    pairs = met.groupBy(
        F.col("q.fp").alias("fp"), F.col("q.fp2").alias("fp2"), F.col("t.fp").alias("b"), F.col("t.fp2").alias("b2")
    ).agg(F.max("t.rows").alias("rows"))
    return pairs.groupBy("fp", "fp2").agg(F.sum("rows").alias("near"))
