"""Toxicity: the models against their definition, and held-out accuracy."""

import math
import random
import zlib

from pathlib import Path

import brute_toxicity
import pytest
from pyspark.sql import functions as F

from textmine.llm import toxicity


def made(n, seed=1):
    """Texts of made-up words; toxic ones hold words with a telling beginning and changing ends."""
    rng = random.Random(seed)
    syllables = ["the", "an", "re", "on", "is", "lo", "ti", "ha", "ne", "or"]

    def word():
        return "".join(rng.choices(syllables, k=rng.randint(1, 3)))

    rows = []
    for k in range(n):
        w = [word() for _ in range(rng.randint(20, 150))]
        toxic = k % 4 == 0
        if toxic:
            for _ in range(max(2, len(w) // 40)):
                w[rng.randrange(len(w))] = "vexq" + word()
        rows.append((k, " ".join(w).capitalize() + ".", int(toxic)))
    return rows


@pytest.fixture(scope="module")
def tables(spark):
    rows = made(1200)
    extra = [(5000, None), (5001, ""), (None, "re on is"), (5002, "x" * 20000), (7, rows[7][1])]
    docs = spark.createDataFrame(
        [(k, t, "x", 1.0) for k, t in [(k, t) for k, t, _ in rows] + extra],
        "doc_id long, text string, toxic string, evidence double",
    ).repartition(5)
    marks = [(k, 1, y) for k, _, y in rows] + [(None, 1, 1), (3, 1, None), (9999, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    return rows, docs, labels


def test_held_out_accuracy(tables):
    rows, docs, labels = tables
    truth = {k: y for k, _, y in rows}
    found = toxicity.toxicity(docs, labels).collect()
    assert len(found) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    for r in found:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert len(held) > 150
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) >= 0.97


def test_held_out_labels_teach_nothing(tables, spark):
    rows, docs, labels = tables
    turned = [
        (k, 1, 1 - y if zlib.crc32(str(k).encode()) % 5 == 0 else y) for k, _, y in rows
    ] + [(None, 1, 1), (3, 1, None), (9999, 1, 1)]
    other = spark.createDataFrame(turned, "doc_id long, quality int, toxic int")
    a = {(r.doc_id, round(r.score, 9)) for r in toxicity.toxicity(docs, labels).collect()}
    b = {(r.doc_id, round(r.score, 9)) for r in toxicity.toxicity(docs, other).collect()}
    assert a == b


def test_remove_toxic(tables):
    rows, docs, labels = tables
    kept = toxicity.remove_toxic(docs, labels)
    assert kept.columns == docs.columns
    left = {r.doc_id for r in kept.collect()}
    assert {5000, 5001, 5002, None} <= left
    assert sum(k in left for k, _, y in rows if not y) >= 0.98 * 900
    assert sum(k in left for k, _, y in rows if y) <= 0.1 * 300


def test_without_labels(tables, spark):
    _, docs, labels = tables
    scores = {r.score for r in toxicity.toxicity(docs, labels.where("false")).collect()}
    assert scores == {0.5}
    ordinary = {r.predicted for r in toxicity.toxicity(docs, labels.where("toxic = 0")).collect()}
    assert ordinary == {0}
    assert toxicity.toxicity(docs.where("false"), labels).count() == 0


def test_ratios_are_those_of_two_distributions():
    """Both conditional models sum to one over all characters of a context."""
    counts = {}
    for word, c, n in (("abba", 0, 3), ("abca", 1, 2), ("bab", 0, 1), ("cab", 1, 1), ("aaaa", 0, 2)):
        for gram in brute_toxicity.grams_of(word, 3):
            counts.setdefault(gram, [0, 0])[c] += n
    rows = [(g, *n) for g, n in counts.items()]
    shared = brute_toxicity._shared(set(counts), 3)
    ratios = brute_toxicity.fit_ratios(rows, 3)
    alphabet = "abc$"
    for context in {g[:-1] for g in counts}:
        seen = [sum(n[c] for g, n in counts.items() if g[:-1] == context) for c in (0, 1)]
        if min(seen) == 0:
            continue
        kinds = [sum(n[c] > 0 for g, n in counts.items() if g[:-1] == context) for c in (0, 1)]
        # An ending is never followed by anything, so every shorter context leaves out "^".
        lower = {x: shared.get((context + x)[1:], 0.0) for x in alphabet}
        p = [
            {
                x: max(counts.get(context + x, [0, 0])[c] - 0.75, 0) / seen[c] + 0.75 * kinds[c] / seen[c] * lower[x]
                for x in alphabet
            }
            for c in (0, 1)
        ]
        for x in alphabet:
            if context + x in counts:
                assert ratios.grams[context + x] == pytest.approx(math.log(p[1][x] / p[0][x]))


@pytest.mark.parametrize("order", [2, 3, 6])
def test_word_ratios_equal_brute_force(tables, order):
    """Every word of the corpus, known to the models or not, against models in plain Python."""
    rows, docs, labels = tables
    known = toxicity.class_of_texts(docs.drop("toxic", "evidence"), labels)
    learnt = F.when(F.col("fold") != toxicity.CALIBRATION, F.col("toxic"))
    words = toxicity.word_counts(known.select("text", learnt.alias("class")))
    counted = {r.word: (r.ordinary, r.toxic) for r in words.collect()}
    truth = {k: y for k, _, y in rows}
    expected = {}
    for r in docs.collect():
        tokens = [t for t in (x.strip(toxicity.EDGES) for x in (r.text or "").lower().split()) if t]
        fold = zlib.crc32(str(r.doc_id).encode()) % 5
        for t in tokens:
            pair = expected.setdefault(t, [0, 0])
            if r.doc_id in truth and fold not in (toxicity.HELD_OUT, toxicity.CALIBRATION):
                pair[truth[r.doc_id]] += 1
    assert counted == {w: tuple(n) for w, n in expected.items()}
    counts = {}
    for word, n in expected.items():
        for gram in brute_toxicity.grams_of(word, order) if sum(n) else []:
            entry = counts.setdefault(gram, [0, 0])
            entry[0] += n[0]
            entry[1] += n[1]
    model = brute_toxicity.fit_ratios([(g, *n) for g, n in counts.items()], order)
    by_hash = {r.h: r.ratio for r in toxicity.word_ratios(words, order).collect()}
    assert len(by_hash) == len(expected)
    for r in words.select("word", "h").collect():
        assert by_hash[r.h] == pytest.approx(model.word(r.word), abs=1e-9)


def test_joined_and_sent_ratios_give_equal_scores(tables):
    rows, docs, labels = tables
    def scores(limit):
        return sorted(
            (r.doc_id is None, r.doc_id or 0, r.score) for r in toxicity.toxicity(docs, labels, limit=limit).collect()
        )

    sent, joined = scores(toxicity.WORDS_BROADCAST_BYTES), scores(0)
    assert [r[:2] for r in sent] == [r[:2] for r in joined]
    assert [r[2] for r in sent] == pytest.approx([r[2] for r in joined], abs=1e-9)


def test_strong_evidence_is_not_cut_off(spark):
    """Of two texts far above the threshold the stronger one scores higher."""
    curve = toxicity.Curve(0.05, -5.0)
    values = spark.createDataFrame([(float(x),) for x in range(0, 300, 20)], "x double")
    scores = [r.s for r in values.select(curve.of(F.col("x")).alias("s"), "x").orderBy("x").collect()]
    assert all(a < b for a, b in zip(scores, scores[1:]))


@pytest.mark.skipif(not Path("/root/testdata/sf0.1").exists(), reason="no test tables")
def test_held_out_accuracy_on_the_given_tables(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet") for name in ("documents", "labels"))
    found = toxicity.toxicity(docs.repartition(8, "doc_id"), labels).where("held_out")
    rows = found.join(labels, "doc_id").select("score", "toxic").collect()
    assert auc([(r.score, r.toxic) for r in rows]) >= 0.95


def auc(pairs):
    """Share of (toxic, ordinary) pairs in the right order, ties counting half."""
    toxic, other = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    wins = sum((a > b) + 0.5 * (a == b) for a in toxic for b in other)
    return wins / (len(toxic) * len(other))


def test_curve_is_finite_on_separated_data():
    curve = toxicity.fit_curve([(0.0, 0, 1000), (3.0, 1, 100)])
    assert 0 < curve.slope < 1000
    assert curve.shift < 0 < 3 * curve.slope + curve.shift
