import random
import re

import pytest
from pyspark.sql import functions as F

from textmine import functions as fn
from textmine.operators import build_corpus

ALPHABET = "ab<>\n\r\t'\"&;-_.7 0é“” 😀"


def python_clean(text):
    text = re.sub(r"<.*?>", " ", text, flags=re.S)
    text = text.replace("\n", " ")
    text = re.sub(r"[!-/:-@\[-`{-~]", " ", text)
    return re.sub(r"[0-9]", " ", text)


def apply(spark, step, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    rows = df.select("i", step(F.col("text")).alias("out")).orderBy("i").collect()
    return [row["out"] for row in rows]


@pytest.mark.parametrize(
    "step, text, expected",
    [
        (fn.strip_tags, "a\n<b\nc='1'>x</b>", "a\n x "),
        (fn.strip_tags, "1 < 2 and <i>3</i> <", "1  3  <"),
        (fn.strip_tags, "no tags", "no tags"),
        (fn.strip_tags, "", ""),
        (fn.strip_tags, "a > b", "a > b"),
        (fn.strip_tags, "<<a>>", " >"),
        (fn.strip_line_breaks, "a\nb\r\nc", "a b\r c"),
        (fn.strip_punctuation, "don't “q” $5", "don t “q”  5"),
        (fn.strip_digits, "123", "   "),
        (fn.clean, "<p>Tea&amp;2\n</p>", " Tea amp    "),
    ],
)
def test_steps(spark, step, text, expected):
    assert apply(spark, step, text) == [expected]


def test_all_punctuation_marks(spark):
    marks = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
    assert len(marks) == 32 and set(marks) == set(fn.cleaning.PUNCTUATION)
    assert apply(spark, fn.strip_punctuation, marks) == [" " * 32]


def test_random_texts_against_python(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 60))) for _ in range(800)]
    assert apply(spark, fn.clean, *texts) == [python_clean(t) for t in texts]


def test_unclosed_tags_stay_linear(spark):
    text = "<" * 400_000
    assert apply(spark, fn.strip_tags, text, "x>" + text) == [text, "x>" + text]


def test_concat_fields_with_missing_parts(spark):
    df = spark.createDataFrame([(None, "x"), ("t", None), ("t", "x")], "a string, b string")
    rows = df.select(fn.concat_fields(F.col("a"), F.col("b")).alias("t")).collect()
    assert [row["t"] for row in rows] == [" x", "t ", "t x"]


def test_build_corpus(spark):
    posts = spark.createDataFrame(
        [(1, "Why?", "<p>Because\n9</p>", "money")],
        "id int, Title string, Body string, Category string",
    )
    built = build_corpus(posts, "id")
    assert built.columns == ["id", "text", "cat"]
    assert built.collect() == [(1, "Why" + 3 * " " + "Because" + 3 * " ", "money")]
