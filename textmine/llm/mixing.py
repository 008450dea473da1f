"""Mixing sources to target weights: repeat documents until each source meets its share.

Sizes are summed per source, targets follow from the weights, and every document is emitted
``floor(rate)`` times plus once more with the probability of the fraction, drawn by a hash of its id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmine.llm.common import fresh, null_safe_lookup, words
from textmine.sources.scratch import written

# Fixed values of the mix: weights by rank of the source, share of all sizes, most repetitions.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = "mix"


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """``(source, source_size, target)`` from rows ``(source, size)``.

    Sources in code point order, null last, take the weights in turn. A target above ``most`` times
    the source's size stops there and the excess is shared again by weight. With sources ordered by
    the level at which they fill up, the final level is the first that the rest does not exceed, so
    no iteration is needed. The windows run over one row per source, after the aggregation.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weighted = totals.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))
    every = Window.partitionBy(F.lit(0))
    level = F.col("source_size") * most / F.col("weight")
    # Running sums over sources that fill up earlier; ties in name order.
    upward = Window.orderBy("level", F.col("source").asc_nulls_last())
    before = upward.rowsBetween(Window.unboundedPreceding, -1)
    onward = upward.rowsBetween(0, Window.unboundedFollowing)
    ranked = (
        weighted.withColumn("level", level)
        .withColumn("total", F.sum("source_size").over(every) * F.lit(float(share)))
        .withColumn("filled", F.coalesce(F.sum(F.col("source_size") * most).over(before), F.lit(0)))
        .withColumn("open_weight", F.sum("weight").over(onward))
        .withColumn("rest", (F.col("total") - F.col("filled")) / F.col("open_weight"))
        .withColumn("final", F.max(F.when(F.col("rest") <= F.col("level"), F.col("rest"))).over(every))
    )
    target = F.least(F.col("source_size") * F.lit(float(most)), F.coalesce(F.col("final") * F.col("weight"), F.lit(float("inf"))))
    return ranked.select("source", "source_size", target.alias("target"))


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the id alone."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)


def mixed(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: str = SEED,
) -> DataFrame:
    """All columns of ``docs`` and ``size, source_size, target, copies``, renamed on a clash.

    ``size`` counts words between ASCII white space; null and empty texts have size 0 and count as
    one source member like any other. A source without words has target 0 and rate 0. Null is a
    source of its own. Equal ids draw alike, so repeated rows are taken together; reruns agree.
    The text is read twice, once for the totals; nothing but totals is shuffled while the table of
    sources is small enough to broadcast, beyond that the join is salted by the document id.
    """
    size = F.size(words(F.col(text))).cast("long")
    sized = docs.select(F.col(source).alias("source"), size.alias("size"))
    targets = written(source_targets(sized, weights, share, most), "targets")
    names = result_names(docs)
    taken = docs.withColumns({name: F.lit(None) for name in names})
    own, own_size, own_target = (fresh(taken, f"_mix_{n}") for n in ("source", "size", "target"))
    targets = targets.toDF(own, own_size, own_target)
    bytes_ = targets.agg(F.sum(64 + F.coalesce(F.octet_length(own), F.lit(0)))).first()[0] or 0
    rows = docs.withColumns({names[0]: size, own: F.col(source)})
    joined = null_safe_lookup(rows, targets, own, bytes_, [doc_id])
    rate = F.when(F.col(own_size) > 0, F.try_divide(F.col(own_target), F.col(own_size))).otherwise(0.0)
    whole = F.floor(rate)
    copies = whole + (draw(F.col(doc_id), seed) < rate - whole).cast("long")
    return joined.withColumns({names[1]: F.col(own_size), names[2]: F.col(own_target), names[3]: copies}).drop(
        own, own_size, own_target
    )


def result_names(docs: DataFrame) -> list[str]:
    """The names that ``mixed`` gives to size, source size, target and copies: new ones where they clash."""
    return [fresh(docs, n) for n in ("size", "source_size", "target", "copies")]


def repeated(mix: DataFrame, copies: str = "copies") -> DataFrame:
    """The mix itself: every row as often as its column ``copies`` says, numbered in ``copy``.

    The number's name is lengthened on a clash. Rows with 0 or null copies go, an empty table stays empty.
    """
    return mix.where(F.col(copies) > 0).withColumn(
        fresh(mix, "copy"), F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))
    )


def mixture(docs: DataFrame, **options) -> DataFrame:
    """``mixed`` and ``repeated`` in one, whatever the columns of ``docs`` are called."""
    return repeated(mixed(docs, **options), result_names(docs)[3])
