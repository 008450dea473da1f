"""Plans and data shapes that must hold at any size."""

import pytest
from pyspark.sql import functions as F

from textmine import functions as fn
from textmine import operators as op
from textmine.operators import lookup


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, corpus, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus") / "docs")
    corpus.select("doc_id", "text", "cat").write.parquet(path)
    return spark.read.parquet(path)


def test_counts_read_only_their_column(stored):
    plan = plan_of(op.count_by(stored, "cat"))
    assert "ReadSchema: struct<cat:string>" in plan
    assert "PushedFilters: [IsNotNull(cat), Not(EqualTo(cat,a))]" in plan_of(
        op.count_by(op.without_class(stored, "a"), "cat")
    )


def test_splits_and_cleaning_do_not_shuffle(stored):
    training, test = op.hash_split(op.clean_corpus(stored), "doc_id")
    for part in (training, test, op.binary_label(stored, ["a"])):
        assert "Exchange" not in plan_of(part) and "Python" not in plan_of(part)


def test_scoring_moves_one_row_per_document(stored):
    folded = stored.withColumn("fold", fn.fold_of(["doc_id"]))
    models = op.fit_models(op.fit_statistics(folded, min_df=2))
    plan = plan_of(op.score(folded, models, "doc_id"))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Python" not in plan
    # The model's own aggregation, its broadcast, and the folded documents.
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 2
    by_document = next(line for line in shuffles if "doc_id" in line)
    assert plan.index("partial_sum") > plan.index(by_document)


@pytest.mark.parametrize("broadcast", [True, False])
def test_a_third_of_all_documents_are_copies_of_one(monkeypatch, spark, broadcast):
    if not broadcast:
        monkeypatch.setattr(lookup, "BROADCAST_LIMIT_BYTES", 0)
    hot = "hot " * 50 + "shared"
    df = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, hot)
        .otherwise(F.concat_ws(" ", F.lit("word"), F.concat(F.lit("w"), F.col("id") % 97)))
        .alias("text"),
        F.when(F.col("id") % 3 == 0, "copies").otherwise("others").alias("cat"),
    )
    folded = df.withColumn("fold", fn.fold_of(["doc_id"]))
    statistics = op.fit_statistics(folded)
    terms = statistics.terms.where("term = 'hot'").agg(F.sum("tf")).first()[0]
    assert terms == 50_000 and sum(statistics.docs.values()) == 3000
    judged = op.validate(folded, statistics, "doc_id", smoothings=[1.0])
    assert judged.agg(F.sum("n")).first()[0] == 3000
    assert op.metrics(judged).first()["accuracy"] == 1.0


@pytest.mark.parametrize("block_classes", [32, 2])
def test_a_large_model_is_broadcast_in_part_and_not_copied(monkeypatch, spark, corpus, block_classes):
    """Frequent terms are broadcast, the others meet the documents in a join where every term stands once."""
    statistics = op.fit_statistics(corpus, min_df=2)
    models = op.fit_models(statistics, sorted({fold for _, fold in statistics.docs}), block_classes)
    unknown = spark.createDataFrame([(900, "strange word", "plants", 0), (901, None, "plants", 1)], corpus.schema)
    scored = corpus.union(unknown)

    def rows():
        found = op.score(scored, models, "doc_id", smoothings=[1.0, 0.5])
        return found, {(r.doc_id, r.smoothing): (r.pred_cat, [round(x, 9) for x in r.scores]) for r in found.collect()}

    whole, expected = rows()
    assert len(expected) == 2 * 242 and "SortMergeJoin" not in plan_of(whole)
    sizes = []
    for limit in (0, 2500, 5000):
        monkeypatch.setattr(lookup, "BROADCAST_LIMIT_BYTES", limit)
        parted, found = rows()
        assert found == expected
        assert "_salt" not in plan_of(parted) and "sequence(0, 63" not in plan_of(parted)
        common, rare = lookup.common_part(statistics.terms, "idf", F.octet_length("term") + F.lit(64))
        sizes.append((common.count() > 0, rare.count() > 0))
    assert sizes[0] == (False, True) and sizes[1] == sizes[2] == (True, True)


def test_only_hot_keys_are_copied(monkeypatch, spark):
    monkeypatch.setattr(lookup, "BROADCAST_LIMIT_BYTES", 0)
    monkeypatch.setattr(lookup, "ROWS_PER_SALT", 100)
    rows = spark.range(2000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 97 == 0, None).otherwise(F.concat(F.lit("w"), F.col("id"))).alias("term"),
    )
    table = rows.where("term is not null and doc_id % 5 < 4").groupBy("term").agg(F.count("*").alias("n"))
    for how in ("inner", "left"):
        joined = op.lookup_join(rows, table, ["term"], 1, spread_by=["doc_id"], how=how, frequency="n")
        plain = rows.join(table, "term", how)
        assert sorted(joined.collect(), key=str) == sorted(plain.select(joined.columns).collect(), key=str)
        assert "sequence(0, 63" not in plan_of(joined) and "_copies" in plan_of(joined)
