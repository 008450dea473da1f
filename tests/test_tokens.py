import random
from collections import Counter

import pytest
from pyspark.ml.feature import RegexTokenizer, StopWordsRemover
from pyspark.sql import functions as F

from textmine import functions as fn
from textmine.checks.oracles import STOP_WORDS

TEXTS = [
    "Ab<cd ef gh",
    "ab cd\x0bef gh",
    "  The  quick\tbrown\r\nfox, I don't know ",
    "É été ÀÉ a é",
    "😀 x 😀😀 y😀",
    "",
    " ",
    "don t the THE The",
    "İstanbul ΣΑΣ",
]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "i int, text string")


@pytest.mark.parametrize("least", [1, 2, 3])
@pytest.mark.parametrize("lower", [True, False])
def test_tokenize_equals_ml(spark, least, lower):
    df = frame(spark, TEXTS)
    ml = RegexTokenizer(inputCol="text", outputCol="ml", minTokenLength=least, toLowercase=lower)
    rows = ml.transform(df).withColumn("ours", fn.tokenize("text", least, lower)).collect()
    assert [row["ours"] for row in rows] == [row["ml"] for row in rows]


def test_white_space(spark):
    row = frame(spark, ["ab cd\x0bef gh"]).select(fn.tokenize("text").alias("w")).first()
    assert row["w"] == ["ab cd", "ef", "gh"]


def test_null_text_has_no_tokens(spark):
    row = frame(spark, [None]).select(
        fn.tokenize("text").alias("w"), fn.count_text_terms("text").alias("c")
    )
    assert row.first() == ([], [])


def test_min_token_length_is_checked(spark):
    with pytest.raises(ValueError):
        fn.tokenize("text", 0)


def test_stop_words_are_the_default_list(spark):
    assert fn.default_stop_words() == STOP_WORDS and len(STOP_WORDS) == 181
    assert "le" in fn.default_stop_words("french")


@pytest.mark.parametrize("sensitive", [True, False])
def test_remove_stop_words_equals_ml(spark, sensitive):
    words = ["The", "the", "Don't", "o'clock", "back\\slash", "x"]
    ml = StopWordsRemover(
        inputCol="w", outputCol="ml", stopWords=["the", "don't", "back\\slash"], caseSensitive=sensitive
    )
    df = spark.createDataFrame([(words,)], "w array<string>")
    row = (
        ml.transform(df)
        .withColumn("ours", fn.remove_stop_words("w", ["the", "don't", "back\\slash"], sensitive))
        .first()
    )
    assert row["ours"] == row["ml"]


def test_empty_stop_list_keeps_everything(spark):
    row = frame(spark, ["the cat"]).select(fn.content_words("text", []).alias("w")).first()
    assert row["w"] == ["the", "cat"]


def test_content_words_equal_both_steps(spark):
    df = frame(spark, TEXTS).withColumn("t", fn.tokenize("text"))
    rows = df.select(
        fn.content_words("text").alias("a"),
        fn.remove_stop_words("t", fn.default_stop_words()).alias("b"),
    ).collect()
    assert all(row["a"] == row["b"] for row in rows)


def test_count_terms_against_counter(spark):
    rng = random.Random(5)
    docs = [rng.choices("abcdefgé", k=rng.randint(0, 40)) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(docs)), "i int, w array<string>")
    rows = df.select("i", fn.count_terms("w").alias("c")).collect()
    for row in rows:
        assert {c["term"]: c["tf"] for c in row["c"]} == Counter(docs[row["i"]])
        assert len(row["c"]) == len(set(docs[row["i"]]))


def test_hash_bucket(spark):
    import hashlib

    rows = spark.range(50).select("id", fn.hash_bucket("id").alias("h")).collect()
    assert all(r["h"] == int(hashlib.md5(str(r["id"]).encode()).hexdigest()[:8], 16) for r in rows)


def test_fold_and_part_agree(spark):
    df = spark.range(3000).select(
        fn.split_part(["id"]).alias("part"), fn.fold_of(["id"]).alias("fold")
    )
    counts = {(r["part"], r["fold"]): r["n"] for r in df.groupBy("part", "fold").agg(F.count("*").alias("n")).collect()}
    assert set(counts) == {(0, 0), (0, 1), (0, 2), (1, -1)}
    assert 0.66 < sum(n for (p, _), n in counts.items() if p == 0) / 3000 < 0.74
    other = spark.range(3000).where(fn.split_part(["id"], seed=9) != fn.split_part(["id"]))
    assert other.count() > 0
