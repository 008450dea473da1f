"""Operators and stages on tables whose other columns are called like what operators use inside."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from textmine.llm import anchors, bitslice, decontaminate, lines, mixing, negatives, pii, repeats, resample, secrets, simhash, toxicity

NAMES = """drop kept lines copies copy size _host _null _source bucket w spans host page pages n a b h id node root rank
_id _hash _text fp fp2 _salt _row_id _row_hash target source_size _target _source_size base added tokens evidence score
n_words n_hit items item gram at class toxic label key anchor part v q slot vec_id_ segment run place weight n_features
_of_host _drop_lines _null_key _lines _kept_lines _mix_source _mix_size _mix_target word ratio count""".split()
BLOCK = "red green blue black white grey pink gold teal rust"


@pytest.fixture(scope="module")
def plain(spark):
    texts = [f"menu\n{BLOCK} number {k} in a row of {k * 7} and {k * 13} more\nown line {k}" for k in range(40)]
    texts += [f"vexq{k} re on is vexqa{k} ti ha {BLOCK} {BLOCK}" for k in range(8)]
    texts += [texts[3]] * 5 + [None, "", "  ", "x" * 3000, "token=abcdefgh1234 mail a@b.org"]
    rows = [(k, t, "en", f"s{k % 3}" if k % 11 else None, len(t or "")) for k, t in enumerate(texts)]
    rows += [rows[2], rows[2], (None, texts[5], "en", None, 9), (None, None, None, None, None), (7, texts[9], "en", "s1", 3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame(rows, schema).repartition(4)


@pytest.fixture(scope="module")
def clashing(plain):
    return plain.withColumns({name: F.lit("clash") for name in NAMES})


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('tables')}"
    labels = [(k, 1, int(40 <= k < 48)) for k in range(48)] + [(None, 1, 1), (3, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    items = [(1, f"{BLOCK} number 5 in a row of 35"), (2, None), (3, ""), (4, "one")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def rows_of(df, columns):
    return sorted(map(repr, df.select(*[F.col(f"`{c}`") for c in columns]).collect()))


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stage(spark, plain, clashing, folder, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    expected, found = stage(spark, plain, folder), stage(spark, clashing, folder)
    assert rows_of(found, plain.columns) == rows_of(expected, plain.columns)
    assert 0 < expected.count()
    if name != "mixing":
        assert expected.columns == plain.columns and found.columns == clashing.columns
        assert found.where(" OR ".join(f"`{n}` <> 'clash'" for n in NAMES)).count() == 0
    for none in (plain.where("false"), clashing.where("false")):
        assert stage(spark, none, folder).count() == 0
    # Null texts only: one group of them in the near-dedup, no words to mix, and no change elsewhere.
    nulls = plain.where("text is null")
    kept = {"SimHash near-dedup": 1, "mixing": 0}.get(name, nulls.count())
    assert stage(spark, nulls, folder).count() == kept


OPERATORS = {
    "op1": lambda d, t: decontaminate.contamination(d, t("benchmark")),
    "op2": lambda d, t: simhash.neighbour_fingerprints(d),
    "op3": lambda d, t: repeats.remove_repeats(d),
    "op4": lambda d, t: anchors.linked_documents(d),
    "op6": lambda d, t: pii.personal_data(d),
    "op7": lambda d, t: toxicity.toxicity(d, t("labels")),
    "op8": lambda d, t: secrets.find_secrets(d),
    "op9": lambda d, t: mixing.mixed(d),
    "op10": lambda d, t: lines.drop_boilerplate(
        d, F.col("source"), lines.split_lines(F.col("text")), "doc_id", all_name="its_lines", kept_name="its_kept"
    ),
    "op12": lambda d, t: resample.importance_resampled(d, t("benchmark")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operator(spark, plain, clashing, folder, name):
    def table(of):
        return spark.read.parquet(f"{folder}/{of}.parquet")

    expected, found = OPERATORS[name](plain, table), OPERATORS[name](clashing, table)
    if name == "op9":
        names = mixing.result_names(clashing)
        renamed = dict(zip(names, mixing.result_names(plain)))
        found = found.drop(*[n for n in renamed.values() if n not in names]).withColumnsRenamed(renamed)
    columns = [c for c in expected.columns if c in found.columns]
    assert len(columns) == len(expected.columns)
    assert rows_of(found, columns) == rows_of(expected, columns)


def test_results_that_clash_are_refused(clashing):
    with pytest.raises(ValueError, match="choose other names"):
        lines.drop_boilerplate(clashing, F.col("source"), lines.split_lines(F.col("text")), "doc_id")


def test_vectors(spark):
    rows = [(k, [float(k % 7), 1.0, float(-k % 5)], k % 3) for k in range(300)]
    plain = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    clashing = plain.withColumns({n: F.lit("clash") for n in NAMES if n not in ("label",)})
    asked = F.col("vec_id") % 100 == 0
    for search in (bitslice.top_k, negatives.hard_negatives):
        expected, found = search(plain, asked), search(clashing, asked)
        assert rows_of(found, found.columns) == rows_of(expected, expected.columns) and expected.count() > 0
