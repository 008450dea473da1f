"""Toxicity by class-conditional Kneser-Ney models.

One character model per class, toxic and ordinary, over the words of labelled texts. The highest order
is counted per class; everything below is one Kneser-Ney model of continuation counts that both share, so
an expression too rare to be counted backs off to what both classes know. The models are Spark tables, and
so are the log-likelihood ratios of all distinct words of the corpus, which a join gives. A text's evidence
is the sum of what its words' ratios exceed a margin, normalised by its length; margin, normalisation
and the logistic curve from evidence to score are fitted on labelled texts that the models have not seen.
"""

from __future__ import annotations

import math
import string
from collections import defaultdict
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmine.llm.common import text_hash, with_results
from textmine.llm.wordhash import hash_words, slices, split_batch
from textmine.operators.lookup import BROADCAST_LIMIT_BYTES, lookup_join
from textmine.sources.scratch import written

ORDER = 6
DISCOUNT = 0.75
# The shapes of the evidence that calibration chooses from: margin, and power of the number of words.
SHAPES = [(margin, power) for power in (1.0, 0.5) for margin in (0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 8.0)]
# Tables of word ratios up to this size go to every task; larger ones are joined.
WORDS_BROADCAST_BYTES = 64 * 1024 * 1024
LABELS_BROADCAST_BYTES = 64 * 1024 * 1024
FOLDS = 5
HELD_OUT, CALIBRATION = 0, 4
# Evidence is counted for the curve in steps of its logarithm.
STEPS = 100
EDGES = string.punctuation + "“”«»¿¡…’‘"


def fold_of(doc_id: Column) -> Column:
    """Remainder that decides what a labelled row is used for; 0 is held out from all learning."""
    return F.crc32(doc_id.cast("string")) % FOLDS


def _normal(token: str) -> str:
    return token.strip(EDGES)


def _tokens(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct tokens, the number of each word, and the offsets of each text."""
    flat, offsets = split_batch(pc.utf8_lower(texts))
    coded = flat.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64), offsets


def _hashes(words: Sequence[str]) -> np.ndarray:
    return hash_words(pa.array(words, pa.string())).view(np.int64)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(word, h, ordinary, toxic)`` of rows ``(text, class)``; class -1 counts for neither."""
    for batch in batches:
        for part in slices(batch, 0):
            tokens, codes, offsets = _tokens(part.column(0))
            kind = np.repeat(part.column(1).to_numpy().astype(np.int64), np.diff(offsets))
            counts = np.bincount(codes * 3 + kind + 1, minlength=3 * len(tokens)).reshape(-1, 3)[:, 1:]
            words: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(2, np.int64))
            for token, n in zip(tokens, counts):
                words[_normal(token)] += n
            words.pop("", None)
            table = np.array(list(words.values()), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(words), pa.string()), pa.array(_hashes(list(words))), pa.array(table[:, 0]), pa.array(table[:, 1])],
                ["word", "h", "ordinary", "toxic"],
            )


def word_counts(texts: DataFrame) -> DataFrame:
    """Stored ``(word, h, ordinary, toxic)`` of rows ``(text, class)``: every distinct word of all texts.

    Class 0 is ordinary, 1 toxic; other texts have null and count for neither.
    """
    coded = texts.select("text", F.coalesce(F.col("class"), F.lit(-1)).cast("int").alias("class"))
    found = coded.mapInArrow(_count_words, "word string, h long, ordinary long, toxic long")
    summed = found.groupBy("word").agg(
        F.first("h").alias("h"), F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")
    )
    return written(summed, "word-counts")


def _grams(word: Column, order: int) -> Column:
    """The n-gram that ends at each character of the word and at its end."""
    marked = F.concat(F.lit("^"), word, F.lit("$"))
    ends = F.sequence(F.lit(2), F.length(marked))
    return F.transform(ends, lambda i: F.substring(marked, F.greatest(F.lit(1), i - order + 1), F.least(i, F.lit(order))))


def _suffix(gram: str = "gram") -> Column:
    return F.expr(f"substring({gram}, 2)")


def _context(gram: str = "gram") -> Column:
    return F.expr(f"left({gram}, length({gram}) - 1)")


def shared_model(grams: DataFrame, order: int = ORDER) -> DataFrame:
    """Stored ``(gram, p)``: Kneser-Ney probabilities of all n-grams below ``order`` that end another.

    They rest on the number of different characters before an n-gram, so both classes share them. Windows
    run over the n-grams of one context, at most as many as there are different characters.
    """
    level = grams.where(F.length("gram") == order).select("gram")
    continued: dict[int, DataFrame] = {}
    for length in range(order - 1, 0, -1):
        counted = level.groupBy(_suffix().alias("gram")).agg(F.count("*").alias("n"))
        continued[length] = written(counted, f"continued-{length}")
        own = grams.where(F.length("gram") == length).select("gram")
        level = continued[length].select("gram").union(own).distinct()
    kinds = continued[1].count()
    lower = None
    parts = []
    for length in range(1, order):
        of_context = Window.partitionBy("context")
        rows = continued[length].withColumn("context", _context())
        rows = rows.withColumns({"total": F.sum("n").over(of_context), "kinds": F.count("*").over(of_context)})
        if lower is None:
            rows = rows.withColumn("lower", F.lit(1.0) / max(kinds, 1))
        else:
            rows = rows.withColumn("suffix", _suffix()).join(lower.toDF("suffix", "lower"), "suffix")
        rest = F.lit(DISCOUNT) * F.col("kinds") / F.col("total")
        p = (F.col("n") - DISCOUNT) / F.col("total") + rest * F.col("lower")
        lower = written(rows.select("gram", p.alias("p")), f"shared-{length}")
        parts.append(lower)
    every = parts[0]
    for part in parts[1:]:
        every = every.union(part)
    return every


def gram_ratios(words: DataFrame, order: int = ORDER) -> tuple[DataFrame, DataFrame]:
    """Stored ``(gram, ratio)`` of all n-grams of counted words, and ``(context, other)``.

    Ratios are log-likelihoods, toxic less ordinary. ``other`` is that of an n-gram never seen after a
    context that was: what its models leave to the shared one.
    """
    counted = words.where("ordinary + toxic > 0")
    grams = (
        counted.select(F.explode(_grams(F.col("word"), order)).alias("gram"), "ordinary", "toxic")
        .groupBy("gram")
        .agg(F.sum("ordinary").alias("n0"), F.sum("toxic").alias("n1"))
    )
    stored = written(grams, "grams")
    shared = shared_model(stored, order).toDF("suffix", "lower")
    of_context = Window.partitionBy("context")
    rows = stored.withColumns({"context": _context(), "suffix": _suffix()})
    for c in range(2):
        n = F.col(f"n{c}")
        rows = rows.withColumns(
            {
                f"total{c}": F.sum(n).over(of_context),
                f"kinds{c}": F.sum((n > 0).cast("long")).over(of_context),
            }
        )
    joined = rows.join(shared, "suffix")

    def rest(c: int) -> Column:
        return F.coalesce(F.try_divide(F.col(f"kinds{c}") * DISCOUNT, F.col(f"total{c}")), F.lit(1.0))

    def p(c: int) -> Column:
        own = F.try_divide(F.greatest(F.col(f"n{c}") - DISCOUNT, F.lit(0.0)), F.col(f"total{c}"))
        return F.coalesce(own, F.lit(0.0)) + rest(c) * F.col("lower")

    ratios = joined.select(
        "gram", "context", F.log(p(1) / p(0)).alias("ratio"), (F.log(rest(1)) - F.log(rest(0))).alias("other")
    )
    table = written(ratios, "gram-ratios")
    return table.select("gram", "ratio"), table.groupBy("context").agg(F.first("other").alias("other"))


def word_ratios(words: DataFrame, order: int = ORDER) -> DataFrame:
    """Stored ``(h, ratio)``: the log-likelihood ratio of every word, by its hash.

    Every distinct word meets the models once, by its n-grams, however often it occurs.
    """
    grams, contexts = gram_ratios(words, order)
    parts = words.select("h", F.explode(_grams(F.col("word"), order)).alias("gram")).withColumn("context", _context())
    size = grams.count() * (64 + 4 * order)
    known = lookup_join(parts, grams, ["gram"], size, spread_by=["h"], how="left")
    both = lookup_join(known, contexts, ["context"], size, spread_by=["h"], how="left")
    ratio = F.coalesce("ratio", "other", F.lit(0.0))
    return written(both.groupBy("h").agg(F.sum(ratio).alias("ratio")), "word-ratios")


class Lookup(NamedTuple):
    """Ratios by hash, ascending."""

    h: np.ndarray
    ratio: np.ndarray

    def of(self, words: list[str]) -> np.ndarray:
        if not words or not len(self.h):
            return np.zeros(len(words))
        wanted = _hashes(words)
        at = np.minimum(np.searchsorted(self.h, wanted), len(self.h) - 1)
        return np.where(self.h[at] == wanted, self.ratio[at], 0.0)


def _shaped(shapes: Sequence[tuple[float, float]], ratio: np.ndarray, codes: np.ndarray, offsets: np.ndarray):
    """The evidence of each text in every shape, a row per text."""
    n = np.maximum(np.diff(offsets), 1)
    sums = {}
    for margin in {m for m, _ in shapes}:
        excess = np.append(np.maximum(ratio - margin, 0.0), 0.0)
        running = np.concatenate([[0.0], np.cumsum(excess[codes])])
        sums[margin] = running[offsets[1:]] - running[offsets[:-1]]
    return np.stack([np.maximum(sums[m], 0.0) / n**power for m, power in shapes], axis=1)


def _evidence(table, shapes: Sequence[tuple[float, float]], at: int, schema: list[str]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(*table.value)
        for batch in batches:
            for part in slices(batch, at):
                tokens, codes, offsets = _tokens(part.column(at))
                values = _shaped(shapes, lookup.of([_normal(t) for t in tokens]), codes, offsets)
                ends = np.arange(len(values) + 1, dtype=np.int32) * len(shapes)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))
                kept = [column for i, column in enumerate(part.columns) if i != at]
                yield pa.RecordBatch.from_arrays([*kept, lists], schema)

    return task


def _words_of_rows(at: int, schema: list[str]):
    """For the join: per row a line without a word, with the row's number of words, and one per distinct word."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, at):
                tokens, codes, offsets = _tokens(part.column(at))
                h = _hashes([_normal(t) for t in tokens]) if tokens else np.empty(0, np.int64)
                lengths = np.diff(offsets)
                owner = np.repeat(np.arange(len(lengths)), lengths)
                pairs, n = np.unique(np.stack([owner, codes], axis=1), axis=0, return_counts=True)
                every = np.concatenate([np.arange(len(lengths)), pairs[:, 0]])
                kept = [column.take(pa.array(every)) for i, column in enumerate(part.columns) if i != at]
                hashes = np.concatenate([np.zeros(len(lengths), np.int64), h[pairs[:, 1]]])
                head = np.arange(len(every)) < len(lengths)
                numbers = [pa.array(hashes, mask=head), pa.array(np.concatenate([lengths, n]).astype(np.int64))]
                yield pa.RecordBatch.from_arrays([*kept, *numbers], schema)

    return task


class Ratios(NamedTuple):
    """Stored word ratios and, while they are small, the same for tasks to look up."""

    table: DataFrame
    sent: object | None


def sent_ratios(table: DataFrame, limit: int = WORDS_BROADCAST_BYTES) -> Ratios:
    """Ready for ``evidence``: a table of at most ``limit`` bytes goes to the tasks whole."""
    if 16 * table.count() > limit:
        return Ratios(table, None)
    rows = table.toArrow()
    h, ratio = rows.column("h").to_numpy().astype(np.int64), rows.column("ratio").to_numpy().astype(float)
    order = np.argsort(h)
    return Ratios(table, table.sparkSession.sparkContext.broadcast((h[order], ratio[order])))


def evidence(
    docs: DataFrame, ratios: Ratios, shapes: Sequence[tuple[float, float]], key: Sequence[str], text: str = "text"
) -> DataFrame:
    """``(*key, evidence)`` with an array of the evidence in every shape.

    With word ratios in the tasks every row of ``docs`` gives one, and nothing is shuffled. Otherwise the
    distinct words of every text meet the table in a join salted by the row, and rows with equal ``key``,
    whose texts must be equal, give one row.
    """
    rows = docs.select(*key, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    declared = ", ".join(f"`{name}` {kind}" for name, kind in rows.drop("_text").dtypes)
    if ratios.sent is not None:
        task = _evidence(ratios.sent, shapes, len(key), [*key, "evidence"])
        return rows.mapInArrow(task, f"{declared}, evidence array<double>")
    task = _words_of_rows(len(key), [*key, "h", "n"])
    words = rows.mapInArrow(task, f"{declared}, h long, n long")
    known = lookup_join(words, ratios.table, ["h"], BROADCAST_LIMIT_BYTES + 1, spread_by=key, how="left")
    head = F.col("h").isNull()
    margins = sorted({m for m, _ in shapes})
    summed = known.groupBy(*key).agg(
        F.count_if(head).alias("_rows"),
        F.sum(F.when(head, F.col("n"))).alias("_n"),
        *[
            F.sum(F.when(~head & (F.col("ratio") > m), F.col("n") * (F.col("ratio") - m)).otherwise(0.0)).alias(f"_m{i}")
            for i, m in enumerate(margins)
        ],
    )
    length = F.greatest(F.col("_n") / F.col("_rows"), F.lit(1.0))
    values = [F.col(f"_m{margins.index(m)}") / F.col("_rows") / F.pow(length, F.lit(power)) for m, power in shapes]
    return summed.select(*key, F.array(*values).alias("evidence"))


class Curve(NamedTuple):
    """Logistic curve of the evidence in one shape."""

    slope: float
    shift: float
    shape: tuple[float, float] = SHAPES[0]
    loss: float = 0.0

    def of(self, evidence: Column) -> Column:
        return 1 / (1 + F.exp(-(F.lit(self.slope) * evidence + F.lit(self.shift))))


def fit_curve(bins: list[tuple[float, int, int]], slope: float = 1.0) -> Curve:
    """Platt's curve through ``(evidence, toxic, rows)``: smoothed targets keep it finite."""
    positive = sum(n for _, toxic, n in bins if toxic)
    negative = sum(n for _, toxic, n in bins if not toxic)
    if not positive or not negative:
        # Nothing to compare: the smoothed share of toxic rows, whatever the evidence.
        return Curve(0.0, math.log((positive + 1) / (negative + 1)), loss=math.inf)
    x = np.array([b[0] for b in bins])
    weight = np.array([b[2] for b in bins], float)
    target = np.where([b[1] for b in bins], (positive + 1) / (positive + 2), 1 / (negative + 2))
    features = np.stack([x, np.ones_like(x)], axis=1)
    beta = np.array([slope, math.log(1 / (negative + 2))])

    def loss(b: np.ndarray) -> float:
        z = features @ b
        return float(np.sum(weight * (np.logaddexp(0, z) - target * z)))

    for _ in range(100):
        p = 1 / (1 + np.exp(-features @ beta))
        gradient = features.T @ (weight * (p - target))
        hessian = (features * (weight * p * (1 - p))[:, None]).T @ features + 1e-6 * np.eye(2)
        step, scale = np.linalg.solve(hessian, gradient), 1.0
        while loss(beta - scale * step) > loss(beta) and scale > 1e-6:
            scale /= 2
        beta = beta - scale * step
        if np.abs(scale * step).max() < 1e-8:
            break
    return Curve(float(max(beta[0], 0.0)), float(beta[1]), loss=loss(beta))


def class_of_texts(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(_id, text, toxic, fold)`` of all rows; ``toxic`` and ``fold`` are null without a label to learn from.

    Null ids and null labels teach nothing, and labels of the held-out fold are not read; a document with
    several labels is toxic if one says so. The labels are broadcast if they are few, so that the texts stay
    where they are.
    """
    marks = (
        labels.where(F.col(doc_id).isNotNull() & F.col("toxic").isNotNull())
        .groupBy(F.col(doc_id).alias("_id"))
        .agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
        .withColumn("fold", fold_of(F.col("_id")))
        .where(F.col("fold") != HELD_OUT)
    )
    small = 24 * marks.count() <= LABELS_BROADCAST_BYTES
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text"))
    joined = rows.join(F.broadcast(marks) if small else marks.hint("merge"), "_id", "left")
    return joined.select("_id", "text", "toxic", "fold")


def _curves(judged: DataFrame) -> list[Curve]:
    """A curve per shape from rows ``(toxic, evidence)``."""
    pairs = judged.select("toxic", F.posexplode("evidence").alias("shape", "x"))
    step = F.floor(F.log1p("x") * STEPS).alias("step")
    # Logarithms of sums of doubles have a few thousand steps at most.
    counts = pairs.groupBy("shape", "toxic", step).agg(F.count("*").alias("n"), F.avg("x").alias("x")).collect()
    bins: dict[int, list] = defaultdict(list)
    for r in sorted(counts, key=lambda r: (r["shape"], r["toxic"], r["step"])):
        bins[r["shape"]].append((r["x"], r["toxic"], r["n"]))
    return [fit_curve(bins[k])._replace(shape=shape) for k, shape in enumerate(SHAPES)]


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", order: int = ORDER,
    limit: int = WORDS_BROADCAST_BYTES,
) -> tuple[Ratios, Curve]:
    """Word ratios from the learning folds, shape and curve from the calibration fold.

    All labelled texts of these folds are used, at the same order whatever their number. The shape is the
    one whose curve has the least log loss on the calibration fold, the first on a tie.
    """
    known = class_of_texts(docs, labels, doc_id, text)
    learnt = F.when(F.col("fold") != CALIBRATION, F.col("toxic"))
    words = word_counts(known.select("text", learnt.alias("class")))
    ratios = sent_ratios(word_ratios(words, order), limit)
    check = known.where(F.col("fold") == CALIBRATION).withColumn("key", text_hash(F.col("text")))
    # Rows that repeat id and text count once.
    judged = evidence(check, ratios, SHAPES, ["_id", "toxic", "key"])
    once = judged.groupBy("_id", "toxic", "key").agg(F.first("evidence").alias("evidence"))
    return ratios, min(_curves(once), key=lambda curve: curve.loss)


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    Only rows of ``labels`` whose ``crc32(doc_id) mod 5`` is not 0 are learnt from, and of a document
    only its text. Null and empty texts carry no evidence and get the score of none. Null ids and
    repeated rows keep a row each (a null id is not held out). Without labels of both classes every
    score is the smoothed share of toxic ones. Other columns are ignored. ``options`` go to ``fit``.
    """
    ratios, curve = fit(docs, labels, doc_id, text, **options)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    if ratios.sent is not None:
        scored = evidence(rows, ratios, [curve.shape], ["doc_id"])
    else:
        keyed = rows.withColumn("_hash", text_hash(F.col("text")))
        found = evidence(keyed, ratios, [curve.shape], ["doc_id", "_hash"]).toDF("_id", "_hash", "evidence")
        same = keyed["doc_id"].eqNullSafe(found["_id"]) & (keyed["_hash"] == found["_hash"])
        scored = keyed.join(found, same).select("doc_id", "evidence")
    score = curve.of(F.col("evidence")[0])
    held_out = F.coalesce(fold_of(F.col("doc_id")) == HELD_OUT, F.lit(False))
    return scored.select(
        "doc_id", held_out.alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted")
    )


def remove_toxic(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, whose text does not score as toxic; see ``toxicity``.

    The rejected are few, so only their keys are gathered, and rows with the same id and text go
    together. Where labels of one class, or none, teach nothing, all rows stay.
    """
    ratios, curve = fit(docs, labels, doc_id, text, **options)
    if curve.slope == 0:
        return docs
    keyed = docs.select(F.col(doc_id).alias("_id"), text_hash(F.col(text)).alias("_hash"), F.col(text).alias("text"))
    scored = evidence(keyed, ratios, [curve.shape], ["_id", "_hash"])
    gone = scored.where(curve.of(F.col("evidence")[0]) >= 0.5).select("_id", "_hash").distinct()
    return with_results(docs, gone, doc_id, text, "left_anti")
