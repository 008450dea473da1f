import random

import pytest

DOCS = "doc_id long, text string, source string, w string, _id int, bucket string, tokens string, line string"


def sentence(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="session")
def hard_rows():
    """Texts with copies, near copies, shared passages, ties, nulls, empties, accents and a long one."""
    rng = random.Random(5)
    passage, texts = sentence(rng, 60), []
    for k in range(60):
        text = sentence(rng, rng.randint(3, 120))
        if k % 5 == 0:
            text = f"{text} {passage}"
        if k % 7 == 0:
            text = f"{passage} {sentence(rng, 5)} {passage}"
        texts.append(text)
    texts += texts[:6] + [texts[0]] * 12
    for text in texts[10:20]:
        w = text.split()
        w[len(w) // 2] = "changed"
        texts.append(" ".join(w))
    texts += ["", None, "   ", "\n\t", "one", "ÉCOLE Été école", "a b", "x" * 5000, None, ""]
    texts.append(" ".join([sentence(rng, 3000), passage, passage]))
    rows = [(k * 3 + 1, text, f"s{k % 4}" if k % 9 else None) for k, text in enumerate(texts)]
    # Ids that repeat, with the same text and with another one, and null ids.
    rows += [rows[3], (rows[4][0], texts[8], "s1"), (None, texts[9], "s0"), (None, texts[9], "s0"), (None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def hard_docs(spark, hard_rows):
    """The same rows with extra columns whose names operators also use inside."""
    rows = [(*row, "clash", 7, "clash", "clash", None) for row in hard_rows]
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
