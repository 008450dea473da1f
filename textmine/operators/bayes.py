"""Multinomial naive Bayes over TF-IDF weights, as aggregations.

Everything the classifier learns is a sum over documents, so one pass over the text, grouped by
(term, class, fold), trains every model at once: a model that holds out one fold sums the rows of
the other folds. Cross-validation over any smoothing grid and the final model come from the same
small table. Scoring is a second pass that looks each document's terms up in the model.

A corpus here has the columns ``text``, ``cat``, a unique key, and an integer ``fold``. Rows with
``fold = -1`` (``TEST_FOLD``) are the test part and train nothing. The model that holds out fold
``i`` trains on all training rows outside ``i``, so holding out the test part gives the final model.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from textmine.functions.splits import TEST_FOLD
from textmine.functions.tokens import content_words
from textmine.operators.evaluation import confusion_long, metrics
from textmine.operators.lookup import broadcastable, common_part, lookup_join
from textmine.operators.terms import MIN_DF, idf, is_long_list, term_counts, vocabulary_cut, without_words
from textmine.sources.scratch import written
from textmine.sources.tables import collect_small


class BayesStatistics(NamedTuple):
    """What one pass over the text leaves behind.

    ``terms`` is a stored table ``(term, cat, fold, tf, idf)``; ``docs`` and ``weights`` hold the
    number of documents and the sum of all TF-IDF weights per ``(cat, fold)``.
    """

    terms: DataFrame
    docs: dict[tuple[str, int], int]
    weights: dict[tuple[str, int], float]
    classes: list[str]
    n_terms: int
    term_bytes: int
    stop_words: list[str] | None = None

    def trained_on(self, holdout: int) -> dict[str, int]:
        """Training documents per class, classes by falling count: the label order."""
        counts = self._sums(self.docs, holdout)
        return dict(sorted(((c, int(n)) for c, n in counts.items()), key=lambda item: (-item[1], item[0])))

    def _sums(self, values: dict[tuple[str, int], float], holdout: int) -> dict[str, float]:
        sums = dict.fromkeys(self.classes, 0)
        for (c, fold), value in values.items():
            if fold not in (TEST_FOLD, holdout):
                sums[c] += value
        return sums

    def log_priors(self, holdout: int, smoothing: float) -> list[float]:
        """Per class, in the order of ``classes``."""
        docs = self._sums(self.docs, holdout)
        share = sum(docs.values()) + smoothing * len(docs)
        return [math.log(docs[c] + smoothing) - math.log(share) for c in self.classes]

    def log_totals(self, holdout: int, smoothing: float) -> list[float]:
        """Logarithms of the smoothed weight of all terms per class, in the order of ``classes``."""
        weights = self._sums(self.weights, holdout)
        return [math.log(weights[c] + smoothing * self.n_terms) for c in self.classes]

    def row_bytes(self, values: int) -> int:
        """Rough size in memory of a lookup table with ``values`` numbers per term."""
        return self.term_bytes + self.n_terms * (64 + 8 * values)


# Classes times folds up to which every pair is a column of one aggregation by term.
WIDE_PAIRS = 40


def _cells_by_columns(tokens: DataFrame, pairs: list[tuple[str, int]], least: float) -> DataFrame:
    """``(term, cat, fold, tf, df, cf, head)`` with one shuffle: a sum per class and fold.

    Terms below ``least`` documents are left out; ``head`` marks one row of each term.
    """
    same = [(F.col("cat") == F.lit(cat)) & (F.col("fold") == F.lit(fold)) for cat, fold in pairs]
    summed = tokens.groupBy("term").agg(
        F.count("*").alias("df"),
        *[F.sum(F.when(is_pair, F.col("tf"))).alias(f"t{k}") for k, is_pair in enumerate(same)],
    )
    cells = [
        F.struct(F.lit(cat).alias("cat"), F.lit(fold).cast("int").alias("fold"), F.col(f"t{k}").alias("tf"))
        for k, (cat, fold) in enumerate(pairs)
    ]
    by_term = summed.select("term", "df", F.filter(F.array(*cells), lambda c: c["tf"].isNotNull()).alias("cells"))
    cf = F.aggregate("cells", F.lit(0).cast("long"), lambda total, c: total + c["tf"])
    kept = by_term.where(F.col("df") >= least).select(
        "term", "df", cf.alias("cf"), F.posexplode("cells").alias("place", "cell")
    )
    return kept.select("term", "cell.cat", "cell.fold", "cell.tf", "df", "cf", (F.col("place") == 0).alias("head"))


def _cells_by_rows(tokens: DataFrame, least: float) -> DataFrame:
    """The same for many pairs: a row per term, class and fold, and sums over the rows of a term.

    The windows hold classes times folds rows at most, however frequent the term. Lists per term would be
    gathered by an aggregation that sorts, and taken apart again.
    """
    counts = tokens.groupBy("term", "cat", F.col("fold").cast("int").alias("fold")).agg(
        F.count("*").alias("docs"), F.sum("tf").alias("tf")
    )
    of_term = Window.partitionBy("term")
    place = F.row_number().over(of_term.orderBy("cat", "fold"))
    summed = counts.select(
        "term", "cat", "fold", "tf",
        F.sum("docs").over(of_term).alias("df"), F.sum("tf").over(of_term).alias("cf"), (place == 1).alias("head"),
    )
    return summed.where(F.col("df") >= least)


def fit_statistics(
    corpus: DataFrame,
    min_df: float = MIN_DF,
    vocab_size: int | None = None,
    stop_words: Sequence[str] | None = None,
) -> BayesStatistics:
    """One pass over the text. Vocabulary and IDF see all rows, test rows included.

    Documents per class and fold are counted first, without the text. Every term with ``min_df``
    documents is kept unless ``vocab_size`` asks for the most frequent ones only.
    """
    counted = corpus.groupBy("cat", "fold").agg(F.count("*").alias("n"))
    docs = {(row["cat"], row["fold"]): row["n"] for row in collect_small(counted, 1_000_000)}
    if any(cat is None for cat, _ in docs):
        raise ValueError("every document needs a class")
    if any(fold is None for _, fold in docs):
        raise ValueError("every document needs a fold; the test part has fold -1")
    n_docs = sum(docs.values())
    tokens = term_counts(corpus, "cat", "fold", stop_words=stop_words)
    pairs = sorted(docs)
    least = min_df if min_df >= 1 else min_df * n_docs
    by_columns = 0 < len(pairs) <= WIDE_PAIRS
    kept = _cells_by_columns(tokens, pairs, least) if by_columns else _cells_by_rows(tokens, least)
    stored = written(kept, "bayes-terms")
    sums, n_terms, term_bytes = _summary(stored)
    if vocab_size is not None and n_terms > vocab_size:
        stored = stored.where(vocabulary_cut(stored.where("head"), vocab_size))
        sums, n_terms, term_bytes = _summary(stored)
    # tf * ln((N + 1) / (df + 1)), summed before N is put in.
    weights = {k: math.log(n_docs + 1) * tf - tf_log_df for k, (tf, tf_log_df) in sums.items()}
    return BayesStatistics(
        stored.select("term", "cat", "fold", "tf", idf(n_docs, F.col("df")).alias("idf")),
        docs,
        {pair: weights.get(pair, 0.0) for pair in docs},
        sorted({cat for cat, _ in docs}),
        n_terms,
        term_bytes,
        None if stop_words is None else list(stop_words),
    )


def _summary(stored: DataFrame) -> tuple[dict, int, int]:
    """Weight sums, number of terms and their bytes: one small aggregation."""
    grouped = stored.groupBy("cat", "fold").agg(
        F.sum("tf").alias("tf"),
        F.sum(F.col("tf") * F.log(F.col("df") + 1)).alias("tf_log_df"),
        F.count_if("head").alias("terms"),
        F.sum(F.when(F.col("head"), F.octet_length("term"))).alias("bytes"),
    )
    rows = collect_small(grouped, 1_000_000)
    return (
        {(row["cat"], row["fold"]): (row["tf"], row["tf_log_df"]) for row in rows},
        sum(row["terms"] for row in rows),
        sum(row["bytes"] or 0 for row in rows),
    )


# Classes in one row of a model table, and sums that one aggregation over tokens carries: within the number
# of fields up to which Spark generates code.
BLOCK_CLASSES = 32
BLOCK_VALUES = 64


class BayesModels(NamedTuple):
    """Naive Bayes models, one per held-out fold, sharing one class order.

    ``sums`` has rows ``(fold, term, block, idf, s0, s1, ...)``: the weight seen in training of the classes
    from ``block * width`` on. A term has a row for block 0 and for every block with a class that has it.
    """

    statistics: BayesStatistics
    holdouts: list[int]
    sums: DataFrame
    width: int

    def blocks(self) -> int:
        return -(-len(self.statistics.classes) // self.width)


def fit_models(
    statistics: BayesStatistics, holdouts: Sequence[int] = (TEST_FOLD,), block_classes: int = BLOCK_CLASSES
) -> BayesModels:
    """Models from the stored statistics; never touches the text.

    Up to ``block_classes`` classes stand in one row per term. More are laid out in blocks, and only blocks
    that a term occurs in have a row, so tables and plans do not grow with terms times classes.
    """
    for holdout in holdouts:
        unseen = [c for c, n in statistics.trained_on(holdout).items() if n == 0]
        if unseen:
            raise ValueError(f"no training documents of {unseen} when fold {holdout} is held out")
    classes = statistics.classes
    trains = (F.col("fold") != F.col("holdout")) & (F.col("fold") != TEST_FOLD)
    weight = F.when(trains, F.col("tf") * F.col("idf")).otherwise(0.0)
    rows = statistics.terms.withColumn("holdout", F.explode(F.array(*[F.lit(h) for h in holdouts])))
    rows = rows.withColumn("weight", weight)
    if len(classes) <= block_classes:
        width, rows = max(1, len(classes)), rows.withColumn("block", F.lit(0))
        chosen = [F.col("cat") == c for c in classes]
    else:
        width = block_classes
        numbers = _class_numbers(statistics)
        head = F.struct(F.lit(0).alias("number"), F.lit(0.0).alias("weight"))
        cells = F.array(F.struct("number", "weight"), head)
        numbered = rows.join(F.broadcast(numbers), "cat")
        rows = numbered.select("holdout", "term", "idf", F.inline(cells)).withColumn(
            "block", F.floor(F.col("number") / width).cast("int")
        )
        chosen = [F.col("number") % width == k for k in range(width)]
    sums = (
        rows.groupBy("holdout", "term", "block")
        .agg(
            F.first("idf").alias("idf"),
            *[F.sum(F.when(c, F.col("weight")).otherwise(0.0)).alias(f"s{k}") for k, c in enumerate(chosen)],
        )
        .withColumnRenamed("holdout", "fold")
    )
    if len(classes) > block_classes:
        sums = written(sums, "bayes-models")
    return BayesModels(statistics, list(holdouts), sums, width)


def _class_numbers(statistics: BayesStatistics) -> DataFrame:
    """``(cat, number)``: the place of each class in ``classes``."""
    schema = StructType([statistics.terms.schema["cat"], StructField("number", IntegerType())])
    return statistics.terms.sparkSession.createDataFrame([(c, k) for k, c in enumerate(statistics.classes)], schema)


def class_priors(corpus: DataFrame, smoothing: float = 1.0) -> DataFrame:
    """``(cat, prior)``: log prior per class over the training rows, from the class counts alone."""
    counts = (
        corpus.where(F.col("fold") != TEST_FOLD).groupBy("cat").agg(F.count("*").alias("n"))
    )
    every = Window.partitionBy(F.lit(0))
    total = F.sum("n").over(every) + smoothing * F.count("*").over(every)
    return counts.select("cat", (F.log(F.col("n") + smoothing) - F.log(total)).alias("prior"))


def _double(value: float) -> str:
    return f"{float(value)!r}D"


def term_weights(models: BayesModels, smoothing: float = 1.0) -> DataFrame:
    """``(cat, term, weight)``: log weight of every vocabulary term in every class."""
    statistics = models.statistics
    if TEST_FOLD not in models.holdouts:
        raise ValueError("the final model is not among the fitted ones: fit with holdout -1")
    final = models.sums.where(F.col("fold") == TEST_FOLD)
    columns = [f"s{k}" for k in range(models.width)]
    if models.blocks() > 1:
        # Blocks without a row: no class there has the term.
        every = final.where(F.col("block") == 0).select(
            "term", F.explode(F.sequence(F.lit(0), F.lit(models.blocks() - 1))).alias("block")
        )
        final = every.join(final, ["term", "block"], "left").fillna(0.0, columns)
    cells = F.array(
        *[
            F.struct((F.col("block") * models.width + k).alias("number"), F.col(name).alias("sum"))
            for k, name in enumerate(columns)
        ]
    )
    totals = statistics.log_totals(TEST_FOLD, smoothing)
    schema = StructType(
        [
            StructField("number", IntegerType()), statistics.terms.schema["cat"], StructField("log_total", DoubleType())
        ]
    )
    named = models.sums.sparkSession.createDataFrame(
        [(k, c, t) for k, (c, t) in enumerate(zip(statistics.classes, totals))], schema
    )
    long = final.select("term", F.inline(cells)).join(F.broadcast(named), "number")
    return long.select("cat", "term", (F.log(F.col("sum") + smoothing) - F.col("log_total")).alias("weight"))


def _narrower(width: int, limit: int) -> int:
    """The largest width up to ``limit`` into which rows of ``width`` classes can be cut evenly."""
    return max(w for w in range(1, max(1, min(width, limit)) + 1) if width % w == 0)


def _differences(models: BayesModels, smoothings: Sequence[float], width: int) -> DataFrame:
    """Lookup table ``(fold, term, rarity, block, idf, d0_0, ...)`` with ``width`` classes in a row.

    ``d`` is what a class adds to a term's weight beyond that of a term it never saw. The ``idf`` stands in
    block 0 only, so that adding up rows counts it once per term; as ``rarity`` it stands in every row.
    """
    names = [[f"d{g}_{j}" for j in range(width)] for g in range(len(smoothings))]
    rarity = F.col("idf").alias("rarity")

    def fields(block: Column, sums: Sequence[str]) -> list[Column]:
        found = [block.alias("block"), F.when(block == 0, F.col("idf")).otherwise(0.0).alias("idf")]
        for row, s in zip(names, smoothings):
            for name, seen in zip(row, sums):
                found.append(F.expr(f"idf * (ln({seen} + {_double(s)}) - {_double(math.log(s))})").alias(name))
        return found

    if width == models.width:
        return models.sums.select("fold", "term", rarity, *fields(F.col("block"), [f"s{j}" for j in range(width)]))
    # Each row in narrower ones: the columns do not grow, and rows without any difference are not made.
    per = models.width // width
    sums = [f"s{k}" for k in range(models.width)]
    parts = F.array(
        *[
            F.struct(
                (F.col("block") * per + i).alias("b"),
                *[F.expr(name).alias(f"s{j}") for j, name in enumerate(sums[i * width : (i + 1) * width])],
            )
            for i in range(per)
        ]
    )
    any_seen = F.expr(" + ".join(f"s{j}" for j in range(width))) > 0
    narrow = models.sums.select("fold", "term", "idf", F.inline(parts)).where((F.col("b") == 0) | any_seen)
    return narrow.select("fold", "term", rarity, *fields(F.col("b"), [f"s{j}" for j in range(width)]))


def _found_in_two(rows: DataFrame, table: DataFrame, by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """``rows`` with what a ``table`` too large to broadcast has on them, ``(*by, block, tf, *values)``.

    The rows of the frequent terms are broadcast, and what they give is summed per document before anything
    moves. Only occurrences of the other terms, which are few, meet the rest of the table in a shuffle; there
    every term is rarer than all of the broadcast ones, so none is hot. The text is read once.
    """
    stored = written(table, "bayes-differences")
    row_bytes = F.octet_length("term") + F.lit(64 + 8 * len(values))
    common, rare = common_part(stored, "rarity", row_bytes)
    first = rows.join(F.broadcast(common.drop("rarity")), ["fold", "term"], "left")
    left_over = F.when(F.col("block").isNull(), F.col("term"))
    sums = [F.sum(F.col("tf") * F.col(name)).alias(name) for name in values]
    folded = first.groupBy(*by, "block", left_over.alias("term")).agg(F.sum("tf").alias("tf"), *sums)
    folded = written(folded, "bayes-folded")
    # What is summed already counts once. Unknown terms stay too, so that no document is lost.
    done = folded.where(F.col("term").isNull()).select(*by, "block", F.lit(1).cast("long").alias("tf"), *values)
    open_rows = folded.where(F.col("term").isNotNull()).select(*by, "term", "tf")
    met = open_rows.join(rare.drop("rarity").hint("merge"), ["fold", "term"], "left")
    return done.union(met.select(*done.columns))


def score(
    corpus: DataFrame,
    models: BayesModels,
    *key: str,
    smoothings: Sequence[float] = (1.0,),
    stop_words: Sequence[str] | None = None,
) -> DataFrame:
    """Score every document of a held-out fold with the model that did not see it.

    Gives ``(*key, cat, fold, smoothing, pred_cat, scores)``, where ``scores`` lists the log score
    per class in the order of ``statistics.classes``. Terms a class never saw share one weight, so
    that part is a single product per document and the lookup table only carries the differences.
    A document's terms sit next to each other when they are summed, so the map side folds them into
    one row before anything is shuffled.

    Many classes are summed in blocks, a row per document and block, and a document's blocks meet once.
    Stop words are those of the statistics unless given.
    """
    statistics, holdouts = models.statistics, models.holdouts
    stop_words = statistics.stop_words if stop_words is None else stop_words
    if any(s <= 0 for s in smoothings):
        raise ValueError("smoothing must be above 0: a term that a class never saw has no weight otherwise")
    n_classes = len(statistics.classes)
    width = models.width
    if width * len(smoothings) > BLOCK_VALUES:
        width = _narrower(width, BLOCK_VALUES // len(smoothings))
    blocks = -(-n_classes // width)
    names = [[f"d{g}_{j}" for j in range(width)] for g in range(len(smoothings))]
    values = ["idf", *[name for row in names for name in row]]
    table = _differences(models, smoothings, width)
    if blocks == 1:
        size = statistics.row_bytes(len(values)) * len(holdouts)
    else:
        rows_of = table.agg(F.count("*").alias("n"), F.sum(F.octet_length("term")).alias("bytes")).first()
        size = (rows_of["bytes"] or 0) + rows_of["n"] * (64 + 8 * len(values))
    held_out = corpus.where(F.col("fold").isin(holdouts))
    # Adding up occurrences costs less than counting them first.
    if is_long_list(stop_words):
        # A row without a term keeps documents of stop words only.
        tokens = F.explode(F.concat(F.array(F.lit(None).cast("string")), content_words("text", [])))
    else:
        tokens = F.explode_outer(content_words("text", stop_words))
    rows = held_out.select(*key, "cat", "fold", tokens.alias("term"), F.lit(1).cast("long").alias("tf"))
    if is_long_list(stop_words):
        rows = without_words(rows, stop_words)
    by = [*key, "cat", "fold"]
    if broadcastable(size):
        # No row moves.
        found = lookup_join(rows, table.drop("rarity"), ["fold", "term"], size, spread_by=key, how="left")
    else:
        found = _found_in_two(rows, table, by, values)
    totals = [F.expr(f"coalesce(sum(tf * {d}), 0D) AS {d}") for d in values]
    arrays = [F.array(*row) for row in names]
    if blocks == 1:
        summed = found.groupBy(*by).agg(*totals).select(*by, "idf", *[a.alias(f"d{g}") for g, a in enumerate(arrays)])
    else:
        folded = found.withColumn("block", F.coalesce("block", F.lit(0))).groupBy(*by, "block").agg(*totals)
        cell = F.struct("block", F.struct(*[a.alias(f"d{g}") for g, a in enumerate(arrays)]).alias("d"))
        met = folded.groupBy(*by).agg(F.sum("idf").alias("idf"), F.map_from_entries(F.collect_list(cell)).alias("of"))
        none = F.array_repeat(F.lit(0.0), width)

        def dense(g: int):
            every = F.transform(
                F.sequence(F.lit(0), F.lit(blocks - 1)),
                lambda b: F.coalesce(F.try_element_at("of", b)[f"d{g}"], none),
            )
            return F.slice(F.flatten(every), 1, n_classes).alias(f"d{g}")

        summed = met.select(*by, "idf", *[dense(g) for g in range(len(smoothings))])
    constants = _score_constants(models, smoothings)
    joined = summed.join(F.broadcast(constants), "fold")
    per_smoothing = []
    for g, s in enumerate(smoothings):
        base = F.zip_with(f"prior{g}", f"rest{g}", lambda prior, rest: prior + F.col("idf") * rest)
        scores = F.zip_with(base, F.col(f"d{g}"), lambda x, d: x + d)
        per_smoothing.append(F.struct(F.lit(float(s)).alias("smoothing"), scores.alias("scores")))
    scored = joined.select(*by, "ties", F.inline(F.array(*per_smoothing)))
    # Equal scores go to the class that comes first in the label order of that model.
    best = F.array_max(
        F.zip_with("scores", "ties", lambda s, t: F.struct(s.alias("score"), t["rank"].alias("rank"), t["cat"].alias("cat")))
    )
    return scored.select(*by, "smoothing", best["cat"].alias("pred_cat"), "scores")


def _score_constants(models: BayesModels, smoothings: Sequence[float]) -> DataFrame:
    """One row per fold: what every document's scores start from, and the order of classes on a tie."""
    statistics = models.statistics
    cat = statistics.terms.schema["cat"]
    tie = StructType([StructField("rank", IntegerType()), cat])
    numbers = ArrayType(DoubleType())
    fields = [StructField("fold", IntegerType()), StructField("ties", ArrayType(tie))]
    for g in range(len(smoothings)):
        fields += [StructField(f"prior{g}", numbers), StructField(f"rest{g}", numbers)]
    rows = []
    for h in models.holdouts:
        place = {c: -k for k, c in enumerate(statistics.trained_on(h))}
        row = [h, [(place[c], c) for c in statistics.classes]]
        for s in smoothings:
            row += [statistics.log_priors(h, s), [math.log(s) - total for total in statistics.log_totals(h, s)]]
        rows.append(tuple(row))
    return models.sums.sparkSession.createDataFrame(rows, StructType(fields))


def validate(
    corpus: DataFrame,
    statistics: BayesStatistics,
    *key: str,
    smoothings: Sequence[float] = (1.0, 0.5),
    stop_words: Sequence[str] | None = None,
) -> DataFrame:
    """Stored ``(smoothing, fold, cat, pred_cat, n)`` over all folds, the test part included.

    One scoring pass judges every document under every smoothing with the model that did not see
    it; tuning, and the test result of whichever smoothing wins, are read from this small table.
    """
    models = fit_models(statistics, sorted({fold for _, fold in statistics.docs}))
    predictions = score(corpus, models, *key, smoothings=smoothings, stop_words=stop_words)
    return written(confusion_long(predictions, "smoothing", "fold"), "validation")


def validation_metrics(validation: DataFrame, metric: str = "f1") -> DataFrame:
    """``(smoothing, avg_metric, std_metric)`` over the training folds."""
    folds = validation.where(F.col("fold") != TEST_FOLD)
    return (
        metrics(folds, "smoothing", "fold")
        .groupBy("smoothing")
        .agg(F.avg(metric).alias("avg_metric"), F.stddev_pop(metric).alias("std_metric"))
    )


def best_smoothing(
    validation: DataFrame, smoothings: Sequence[float], metric: str = "f1"
) -> float:
    """Smoothing with the highest mean metric; the earlier one in the grid wins a tie.

    Means are rounded first: their last digits depend on the order in which folds are added up.
    """
    rows = collect_small(validation_metrics(validation, metric))
    means = {row["smoothing"]: round(row["avg_metric"], 12) for row in rows}
    return max(smoothings, key=lambda s: means[float(s)])


def tested(validation: DataFrame, smoothing: float) -> DataFrame:
    """Confusion counts ``(cat, pred_cat, n)`` of the test part under one smoothing."""
    chosen = (F.col("fold") == TEST_FOLD) & (F.col("smoothing") == smoothing)
    return validation.where(chosen).select("cat", "pred_cat", "n")
