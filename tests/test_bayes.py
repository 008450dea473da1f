import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.sql import functions as F

from textmine import functions as fn
from textmine import operators as op
from textmine import plans
from textmine.operators import bayes, lookup


@pytest.fixture(scope="module")
def statistics(corpus):
    return op.fit_statistics(corpus, min_df=2)


@pytest.fixture(scope="module")
def features(corpus):
    model = plans.fit_features(corpus, min_df=2)
    return plans.add_features(model, corpus).select("doc_id", "cat", "fold", "features").cache()


def ml_scores(features, holdout, smoothing):
    """{doc_id: ({class: score}, prediction)} of the ML pipeline with one fold held out."""
    training = features.where((F.col("fold") != holdout) & (F.col("fold") != fn.TEST_FOLD))
    model = plans.naive_bayes_pipeline(smoothing=smoothing).fit(training)
    labels = model.stages[0].labels
    rows = model.transform(features.where(F.col("fold") == holdout)).collect()
    return {
        r["doc_id"]: (dict(zip(labels, r["rawPrediction"])), labels[int(r["prediction"])])
        for r in rows
    }


@pytest.mark.parametrize("broadcast", [True, False])
def test_scores_equal_the_ml_classifier(monkeypatch, corpus, statistics, features, broadcast):
    if not broadcast:
        monkeypatch.setattr(lookup, "BROADCAST_LIMIT_BYTES", 0)
    models = op.fit_models(statistics, [-1, 0, 1, 2])
    rows = op.score(corpus, models, "doc_id", smoothings=[1.0, 0.5]).collect()
    assert len(rows) == 2 * corpus.count()
    for holdout in (-1, 0, 1, 2):
        for smoothing in (1.0, 0.5):
            expected = ml_scores(features, holdout, smoothing)
            found = [r for r in rows if r["fold"] == holdout and r["smoothing"] == smoothing]
            assert {r["doc_id"] for r in found} == expected.keys()
            for r in found:
                scores, predicted = expected[r["doc_id"]]
                for c, value in zip(statistics.classes, r["scores"]):
                    assert value == pytest.approx(scores[c], abs=1e-9)
                assert r["pred_cat"] == predicted


def test_partitioning_does_not_matter(corpus, statistics):
    other = op.fit_statistics(corpus.repartition(11), min_df=2)
    assert (other.docs, other.n_terms, other.term_bytes) == (
        statistics.docs, statistics.n_terms, statistics.term_bytes,
    )
    order = ["term", "cat", "fold"]
    assert other.terms.orderBy(*order).collect() == statistics.terms.orderBy(*order).collect()


def test_cross_validation_equals_the_ml_cross_validator(corpus, statistics, features):
    validation = op.validate(corpus, statistics, "doc_id", smoothings=[1.0, 0.5])
    ours = {r["smoothing"]: r for r in op.validation_metrics(validation).collect()}
    pipeline = plans.naive_bayes_pipeline()
    training = features.where(F.col("fold") != fn.TEST_FOLD)
    grid = plans.smoothing_grid(pipeline, [1.0, 0.5])
    model = plans.cross_validator(pipeline, grid, fold_col="fold").fit(training)
    for row in plans.validation_metrics(model, training).collect():
        assert ours[row["smoothing"]]["avg_metric"] == pytest.approx(row["avg_metric"], rel=1e-12)
        assert ours[row["smoothing"]]["std_metric"] == pytest.approx(row["std_metric"], abs=1e-12)
    best = op.best_smoothing(validation, [1.0, 0.5])
    assert best == model.bestModel.stages[-1].getSmoothing()
    test = plans.predict(model, features.where(F.col("fold") == fn.TEST_FOLD))
    found = op.metrics(op.tested(validation, best)).first()
    assert found["f1"] == pytest.approx(op.evaluate(test, "f1"), rel=1e-12)


def test_vocabulary_size_and_shares(corpus, corpus_rows):
    small = op.fit_statistics(corpus, min_df=1, vocab_size=6)
    expected = {r["term"] for r in op.fit_vocabulary(corpus, 1, 6).table.collect()}
    assert {r["term"] for r in small.terms.select("term").distinct().collect()} == expected
    assert small.n_terms == 6
    share = op.fit_statistics(corpus, min_df=0.1)
    vocabulary = op.fit_vocabulary(corpus, 0.1)
    assert (share.n_terms, share.term_bytes) == (vocabulary.n_terms, vocabulary.term_bytes)
    for s in (small, share):
        stored = s.terms.groupBy("cat", "fold").agg(F.sum(F.col("tf") * F.col("idf")).alias("w"))
        for r in stored.collect():
            assert s.weights[r["cat"], r["fold"]] == pytest.approx(r["w"], rel=1e-10)


def test_parameters_equal_the_ml_model(corpus, statistics, features):
    training = features.where(F.col("fold") != fn.TEST_FOLD)
    indexed = op.fit_label_indexer(training).transform(training)
    model = NaiveBayes(smoothing=0.5).fit(indexed)
    labels = op.fit_label_indexer(training).labels
    priors = {r["cat"]: r["prior"] for r in op.class_priors(corpus, 0.5).collect()}
    for c, value in zip(labels, model.pi):
        assert priors[c] == pytest.approx(value, rel=1e-12)
        own = statistics.log_priors(fn.TEST_FOLD, 0.5)[statistics.classes.index(c)]
        assert own == pytest.approx(value, rel=1e-12)
    weights = op.term_weights(op.fit_models(statistics), 0.5)
    found = sorted((r["cat"], round(r["weight"], 9)) for r in weights.collect())
    theta = model.theta.toArray()
    expected = sorted((c, round(float(v), 9)) for c, row in zip(labels, theta) for v in row)
    assert len(found) == len(expected)
    for (c, v), (d, w) in zip(found, expected):
        assert c == d and v == pytest.approx(w, abs=2e-9)


def test_class_without_training_documents_is_an_error(spark):
    df = spark.createDataFrame(
        [(1, "aa bb", "x", 0), (2, "aa cc", "x", 1), (3, "aa", "y", 1)],
        "doc_id long, text string, cat string, fold int",
    )
    statistics = op.fit_statistics(df, min_df=1)
    with pytest.raises(ValueError, match="y"):
        op.fit_models(statistics, [1])


def test_null_class_is_an_error(spark):
    df = spark.createDataFrame([("aa", None, 0)], "text string, cat string, fold int")
    with pytest.raises(ValueError, match="class"):
        op.fit_statistics(df, min_df=1)


def test_class_names_with_quotes(spark):
    rows = [(i, "aa bb" if i % 2 else "cc dd", "it's" if i % 2 else 'a "b"', i % 3 - 1) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, cat string, fold int")
    models = op.fit_models(op.fit_statistics(df, min_df=1))
    scored = op.score(df, models, "doc_id").collect()
    assert len(scored) == 20 and all(r["cat"] == r["pred_cat"] for r in scored)


def test_guards(corpus, statistics):
    with pytest.raises(ValueError, match="fold"):
        op.fit_statistics(corpus.withColumn("fold", F.when(F.col("doc_id") > 3, F.col("fold"))))
    with pytest.raises(ValueError, match="smoothing"):
        op.score(corpus, op.fit_models(statistics), "doc_id", smoothings=[0.0])
    with pytest.raises(ValueError, match="final model"):
        op.term_weights(op.fit_models(statistics, [0]))


def test_one_shuffle_and_no_window_over_the_raw_vocabulary(corpus, monkeypatch):
    from textmine.operators import bayes

    seen = []
    monkeypatch.setattr(bayes, "written", lambda df, name: seen.append(df) or df)
    bayes.fit_statistics(corpus, min_df=2)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Window" not in plan and "Sort" not in plan


@pytest.mark.parametrize("broadcast", [True, False])
def test_two_hundred_classes(monkeypatch, spark, broadcast):
    if not broadcast:
        monkeypatch.setattr(lookup, "BROADCAST_LIMIT_BYTES", 0)
    rows = [(k, f"all own{k % 200} own{k % 200}", f"c{k % 200:03d}", -1 if k >= 1200 else k % 3) for k in range(1400)]
    corpus = spark.createDataFrame(rows, "doc_id long, text string, cat string, fold int")
    models = op.fit_models(op.fit_statistics(corpus))
    judged = op.score(corpus, models, "doc_id")
    assert judged.count() == 200 and judged.where("cat = pred_cat").count() == 200


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("block_classes,grid", [(2, [1.0, 0.5]), (1, [0.3]), (2, [k / 40 for k in range(1, 41)]), (32, [k / 40 for k in range(1, 41)])])
def test_blocks_of_classes(monkeypatch, corpus, statistics, broadcast, block_classes, grid):
    """Classes in blocks, and sums in narrower rows, give what one row per term gives."""
    folds = [-1, 0, 1, 2]
    monkeypatch.setattr(bayes, "BLOCK_VALUES", 10_000)
    whole = op.score(corpus, op.fit_models(statistics, folds), "doc_id", smoothings=grid).collect()
    monkeypatch.undo()
    if not broadcast:
        monkeypatch.setattr(lookup, "BROADCAST_LIMIT_BYTES", 0)
    models = op.fit_models(statistics, folds, block_classes)
    found = op.score(corpus, models, "doc_id", smoothings=grid).collect()
    key = lambda r: (r["doc_id"], r["smoothing"])
    assert len(found) == len(whole) == len(grid) * corpus.count()
    for a, b in zip(sorted(found, key=key), sorted(whole, key=key)):
        assert key(a) == key(b) and a["pred_cat"] == b["pred_cat"] and a["scores"] == pytest.approx(b["scores"], abs=1e-9)
    weights = {(r["cat"], r["term"]): r["weight"] for r in op.term_weights(models).collect()}
    plain = {(r["cat"], r["term"]): r["weight"] for r in op.term_weights(op.fit_models(statistics)).collect()}
    assert weights == pytest.approx(plain, abs=1e-12)


def test_a_thousand_classes(spark):
    """Scores equal brute force; rows, columns and plan stay small, and code is generated."""
    rng = random.Random(9)
    n = 1000
    rows = [
        (k, " ".join([f"own{k % n}", *rng.choices([f"shared{i}" for i in range(40)], k=6)]), f"c{k % n:04d}", k % 5 - 1)
        for k in range(4 * n)
    ]
    corpus = spark.createDataFrame(rows, "doc_id long, text string, cat string, fold int").repartition(4)
    training = corpus.withColumn("fold", F.when(F.col("doc_id") < 3 * n, 0).otherwise(-1))
    statistics = op.fit_statistics(training, min_df=1)
    models = op.fit_models(statistics)
    scored = op.score(training, models, "doc_id", smoothings=[1.0, 0.5])
    assert models.blocks() == 32 and len(models.sums.columns) == 36
    found = {(r["doc_id"], r["smoothing"]): r for r in scored.collect()}
    plan = scored._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    sums = [line for line in plan.split("\n") if " HashAggregate(keys=[doc_id" in line and "sum((1.0 * d0_0" in line]
    assert len(plan) < 60_000 and sums and all(re.match(r"[ :+|-]*\*\(\d+\)", line) for line in sums)
    # A term of one class has a row for its block and one for block 0, not 32.
    assert models.sums.where("term = 'own999'").count() == 2
    train, test = [r for r in rows if r[0] < 3 * n], [r for r in rows if r[0] >= 3 * n]
    df = Counter(t for r in rows for t in set(r[1].split()))
    idf = {t: math.log((len(rows) + 1) / (d + 1)) for t, d in df.items()}
    sums, total = defaultdict(float), defaultdict(float)
    for _, text, cat, _ in train:
        for t in text.split():
            sums[cat, t] += idf[t]
            total[cat] += idf[t]
    assert len(found) == 2 * n
    for doc_id, text, cat, _ in test[:: n // 20]:
        for s in (1.0, 0.5):
            row = found[doc_id, s]
            expected = [
                math.log(1 / n)
                + sum(idf[t] * (math.log(sums[c, t] + s) - math.log(total[c] + s * len(df))) for t in text.split())
                for c in statistics.classes
            ]
            assert row["scores"] == pytest.approx(expected, abs=1e-8)
            assert row["pred_cat"] == cat


def test_many_classes_are_summed_without_lists_per_term(monkeypatch, spark):
    rng = random.Random(3)
    docs = [
        (k % 290, " ".join(rng.choices(["one", "two", *[f"w{i}" for i in range(120)]], k=rng.randint(0, 12))) if k % 50 else None, f"c{k % 20:02d}", k // 20 % 4 - 1)
        for k in range(300)
    ]
    corpus = spark.createDataFrame(docs, "doc_id int, text string, cat string, fold int")
    plans_of = {}

    def noted(df, name):
        plans_of[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return written(df, name)

    written = bayes.written
    monkeypatch.setattr(bayes, "written", noted)
    found = op.fit_statistics(corpus, min_df=8)
    assert "collect_list" not in plans_of["bayes-terms"]
    df, cells = Counter(), Counter()
    for _, text, cat, fold in docs:
        words = (text or "").split()
        df.update(set(words))
        cells.update((word, cat, fold) for word in words)
    kept = {word for word, n in df.items() if n >= 8}
    assert 0 < len(kept) < len(df) and found.n_terms == len(kept)
    rows = found.terms.collect()
    assert len(rows) == len({(r["term"], r["cat"], r["fold"]) for r in rows})
    assert {(r["term"], r["cat"], r["fold"]): r["tf"] for r in rows} == {c: n for c, n in cells.items() if c[0] in kept}
    assert all(r["idf"] == pytest.approx(math.log(301 / (df[r["term"]] + 1))) for r in rows)
    # The same by columns, and with a cut vocabulary, which needs one marked row per term.
    monkeypatch.setattr(bayes, "WIDE_PAIRS", 1000)
    wide = op.fit_statistics(corpus, min_df=8)
    assert wide.n_terms == found.n_terms and wide.term_bytes == found.term_bytes
    assert sorted(wide.terms.collect()) == sorted(rows) and wide.weights == pytest.approx(found.weights)
    monkeypatch.setattr(bayes, "WIDE_PAIRS", 0)
    cut = op.fit_statistics(corpus, min_df=8, vocab_size=3)
    totals = Counter()
    for (word, _, _), n in cells.items():
        totals[word] += n if word in kept else 0
    first = sorted(kept, key=lambda word: (-totals[word], word))[:3]
    assert cut.n_terms == 3 and {r["term"] for r in cut.terms.collect()} == set(first)
