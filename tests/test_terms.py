import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textmine import operators as op
from textmine.operators import lookup


def brute_force(rows, min_df):
    counts = {i: Counter(text.split()) for i, text, _ in rows}
    df, cf = Counter(), Counter()
    for counted in counts.values():
        df.update(counted.keys())
        cf.update(counted)
    kept = {t: (n, cf[t], math.log((len(rows) + 1) / (n + 1))) for t, n in df.items() if n >= min_df}
    return counts, kept


def test_document_frequency(corpus, corpus_rows):
    _, kept = brute_force(corpus_rows, 1)
    found = {r["term"]: (r["df"], r["cf"]) for r in op.document_frequency(corpus).collect()}
    assert found == {t: v[:2] for t, v in kept.items()}


@pytest.mark.parametrize("min_df", [1, 5, 0.05])
def test_fit_vocabulary(corpus, corpus_rows, min_df):
    least = min_df if min_df >= 1 else min_df * len(corpus_rows)
    _, kept = brute_force(corpus_rows, least)
    vocabulary = op.fit_vocabulary(corpus, min_df)
    assert vocabulary.n_docs == len(corpus_rows)
    assert vocabulary.n_terms == len(kept)
    assert vocabulary.term_bytes == sum(len(t) for t in kept)
    for row in vocabulary.table.collect():
        assert (row["df"], row["cf"]) == kept[row["term"]][:2]
        assert row["idf"] == pytest.approx(kept[row["term"]][2], rel=1e-12)


@pytest.mark.parametrize("size", [1, 2, 7, 20, 33, 60])
def test_vocabulary_size_keeps_the_most_frequent(corpus, corpus_rows, size):
    _, kept = brute_force(corpus_rows, 1)
    expected = sorted(kept, key=lambda t: (-kept[t][1], t))[:size]
    vocabulary = op.fit_vocabulary(corpus, 1, size)
    assert {r["term"] for r in vocabulary.table.collect()} == set(expected)
    assert vocabulary.n_terms == len(expected)


@pytest.mark.parametrize("partitions", [1, 7])
@pytest.mark.parametrize("broadcast", [True, False])
def test_tfidf(monkeypatch, corpus, corpus_rows, partitions, broadcast):
    if not broadcast:
        monkeypatch.setattr(lookup, "BROADCAST_LIMIT_BYTES", 0)
    counts, kept = brute_force(corpus_rows, 5)
    source = corpus.repartition(partitions)
    weights = op.tfidf(source, op.fit_vocabulary(source), "doc_id")
    found = {(r["doc_id"], r["term"]): (r["tf"], r["tfidf"]) for r in weights.collect()}
    expected = {(i, t): (n, n * kept[t][2]) for i, c in counts.items() for t, n in c.items() if t in kept}
    assert found.keys() == expected.keys()
    for pair, (tf, weight) in expected.items():
        assert found[pair][0] == tf
        assert found[pair][1] == pytest.approx(weight, rel=1e-12)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_broadcast_on_a_hot_key(spark, how):
    rows = spark.range(4000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k")
    )
    table = spark.createDataFrame([("hot", 1), *[(f"k{i}", i) for i in range(40)]], "k string, v int")
    small = lookup.lookup_join(rows, table, ["k"], 0, ["id"], how)
    large = lookup.lookup_join(rows, table, ["k"], 1 << 40, ["id"], how)
    assert sorted(small.select("id", "k", "v").collect(), key=str) == sorted(
        large.select("id", "k", "v").collect(), key=str
    )
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan and "SortMergeJoin" in plan and "Broadcast" not in plan
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()


def test_text_pass_has_one_shuffle(corpus):
    plan = op.document_frequency(corpus)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_count" in plan
    assert "Python" not in plan


def test_word_frequency(spark):
    corpus = spark.createDataFrame([("the cat The",), ("a dog",)], "text string")
    found = op.word_frequency(corpus, ["the", "dog", "bird"]).collect()
    assert {r["word"]: r["n"] for r in found} == {"the": 2, "dog": 1, "bird": 0}


def test_top_terms(corpus, corpus_rows):
    _, kept = brute_force(corpus_rows, 1)
    expected = sorted(kept, key=lambda t: (-kept[t][1], t))[:5]
    found = op.top_terms(op.document_frequency(corpus), 5).collect()
    assert [r["term"] for r in found] == expected


def test_every_term_is_kept_by_default(spark):
    """More terms than a vectoriser's default would take."""
    n = 300_000
    corpus = spark.range(n).selectExpr("id AS doc_id", "concat('term', id) AS text")
    vocabulary = op.fit_vocabulary(corpus, min_df=1)
    assert (vocabulary.n_docs, vocabulary.n_terms, vocabulary.left_out) == (n, n, 0)
    assert op.tfidf(corpus, vocabulary, "doc_id").count() == n
    labelled = corpus.selectExpr("*", "concat('c', doc_id % 2) AS cat", "cast(doc_id % 3 AS int) AS fold")
    assert op.fit_statistics(labelled, min_df=1).n_terms == n
    cut = op.fit_vocabulary(corpus, min_df=1, size=100_000)
    assert (cut.n_terms, cut.left_out) == (100_000, 200_000)
    expected = sorted(f"term{i}" for i in range(n))[:100_000]
    assert cut.table.agg(F.max("term")).first()[0] == expected[-1]


def test_long_lists_of_stop_words(spark, corpus, monkeypatch):
    """A hundred thousand words leave the plan as it is, and give what a short list gives."""
    from textmine.operators import terms

    few = ["Water", "common", "leaf"]
    many = few + [f"absent{k}" for k in range(100_000)]
    keys = ("doc_id", "term", "tf")

    def counted(words):
        return sorted(tuple(r) for r in op.term_counts(corpus, "doc_id", stop_words=words).select(*keys).collect())

    assert counted(many) == counted(few) and not any(t == "water" for _, t, _ in counted(many))
    plans = [
        len(op.term_counts(corpus, "doc_id", stop_words=w)._jdf.queryExecution().optimizedPlan().toString())
        for w in (many[:2000], many)
    ]
    assert abs(plans[0] - plans[1]) < 50
    statistics = [op.fit_statistics(corpus, min_df=2, stop_words=w) for w in (few, many)]
    assert statistics[0].n_terms == statistics[1].n_terms and statistics[0].docs == statistics[1].docs
    monkeypatch.setattr(terms, "LISTED_WORDS", 2)
    scores = [
        {r["doc_id"]: r["scores"] for r in op.score(corpus, op.fit_models(s), "doc_id", stop_words=w).collect()}
        for s, w in zip(statistics, (["zzz"], few))
    ]
    joined = {r["doc_id"]: r["scores"] for r in op.score(corpus, op.fit_models(statistics[1]), "doc_id").collect()}
    assert joined.keys() == scores[1].keys() == scores[0].keys()
    for k in joined:
        assert joined[k] == pytest.approx(scores[1][k], abs=1e-12)
