import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("textmine-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def corpus_rows():
    """A small corpus with a hot term, empty texts, repeats and three uneven classes."""
    import random

    rng = random.Random(7)
    words = {
        "plants": ["soil", "leaf", "root", "water", "seed", "green"],
        "planes": ["wing", "pilot", "fuel", "runway", "engine", "water"],
        "phones": ["screen", "battery", "update", "engine", "app"],
    }
    rows = []
    for doc_id in range(240):
        cat = rng.choices(list(words), weights=[6, 3, 2])[0]
        chosen = rng.choices(words[cat], k=rng.randint(0, 9))
        rare = [f"rare{rng.randint(0, 60)}"] if rng.random() < 0.4 else []
        text = " ".join([*chosen, *rare]) if doc_id % 17 else ""
        if doc_id % 3 == 0 and text:
            text += " common common"
        rows.append((doc_id, text, cat))
    return rows


@pytest.fixture(scope="session")
def corpus(spark, corpus_rows):
    from textmine.functions import fold_of

    df = spark.createDataFrame(corpus_rows, "doc_id long, text string, cat string")
    return df.withColumn("fold", fold_of(["doc_id"])).cache()
