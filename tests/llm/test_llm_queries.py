"""Registered queries next to their SQL, and the pipeline against a plain version of its stages."""

import hashlib
from pathlib import Path

import brute
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from textmine.checks.compare import differences, duckdb_tables
from textmine.llm import mixing, simhash, toxicity
from textmine.llm.oracles import oracles
from textmine.llm.queries import registered

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb_tables(FOLDER)
    yield connection
    connection.close()


def test_registry():
    names = set(__spark_entry__.queries())
    assert set(registered()) | {"pipeline"} <= names
    assert {name.split("_")[0] for name in registered()} == {f"op{n}" for n in range(1, 14)}


@pytest.mark.parametrize("name", sorted(registered()))
def test_query(spark, tables, name):
    df = registered()[name](spark, FOLDER)
    if name in oracles():
        assert differences(df, tables, oracles()[name]) == ""
    else:
        assert df.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()


def _texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def _digest(spans):
    return hashlib.sha256(",".join(f"{kind}:{a}:{b}" for kind, a, b in spans).encode()).hexdigest()


@pytest.mark.parametrize("name,of,kinds", [
    ("op6_pii", brute.personal_data, ["email", "ip", "card", "phone"]),
    ("op8_secrets", brute.secrets, ["assign", "access", "hex"]),
])
def test_span_columns(spark, name, of, kinds):
    """Counts, digest and list of the query's own rows against the plain patterns."""
    texts = _texts(spark)
    rows = registered()[name](spark, FOLDER).collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    ordered = sorted(texts)
    random = dict(zip(ordered, brute.random_spans([texts[k] for k in ordered])))
    for r in rows:
        base = of(texts[r.doc_id])
        for kind in kinds:
            assert r[f"n_{kind}"] == sum(k == kind for k, _, _ in base)
        assert r.base_sha256 == _digest(base)
        listed = [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in r.spans.split(",") if x)]
        assert [x for x in listed if x[0] in kinds] == base
        if name == "op6_pii":
            scores = [float(x) for x in r.scores.split(",") if x]
            assert len(scores) == len(listed) and all(0 < x <= 1 for x in scores)
        if name == "op8_secrets":
            assert [x for x in listed if x[0] == "random"] == random[r.doc_id]


def test_link_columns(spark):
    texts = _texts(spark)
    prints = {k: brute.fingerprint(t) for k, t in texts.items()}
    roots = brute.groups(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for k in sorted(texts):
        least.setdefault(roots[prints[k]], k)
    rows = registered()["op4_simhash_links"](spark, FOLDER).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in rows} == {
        (k, f"{fp:016x}", least[roots[fp]]) for k, fp in prints.items()
    }
    assert len(rows) == len(texts)


def test_fingerprint_columns(spark):
    """Edited texts by hand; likeness from fingerprints that the operator gives for those texts alone."""
    texts = _texts(spark)
    ordered = sorted(texts)
    edited = {}
    for n, k in enumerate(ordered):
        text, after = texts[k] or "", texts[ordered[(n + 1) % len(ordered)]] or ""
        cut = len(text) // 4
        edited[k] = text[: len(text) - cut] + after[:cut]
    rows = {r.doc_id: r for r in registered()["op2_fingerprints"](spark, FOLDER).collect()}
    both = [(2 * k, texts[k]) for k in ordered] + [(2 * k + 1, edited[k]) for k in ordered]
    alone = {
        r.doc_id: (r.fp, r.fp2)
        for r in simhash.neighbour_fingerprints(spark.createDataFrame(both, "doc_id long, text string")).collect()
    }

    def likeness(a, b):
        return 1 - sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(a, b)) / 128

    for n, k in enumerate(ordered):
        r, after = rows[k], ordered[(n + 1) % len(ordered)]
        assert r.n_chars == len(texts[k] or "")
        assert r.edited_sha256 == hashlib.sha256(edited[k].encode()).hexdigest()
        own, changed = ("".join(f"{x & (2**64 - 1):016x}" for x in reversed(alone[i])) for i in (2 * k, 2 * k + 1))
        assert (r.fingerprint, r.edited_fingerprint) == (own, changed)
        assert r.near_edited == likeness(alone[2 * k], alone[2 * k + 1])
        assert r.near_next == likeness(alone[2 * k], alone[2 * after])


def test_fingerprint_likeness(spark):
    rows = registered()["op2_fingerprints"](spark, FOLDER).collect()
    long = [r for r in rows if r.n_chars > 400]
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert sum(r.near_edited for r in long) / len(long) > sum(r.near_next for r in long) / len(long) + 0.15
    assert all((r.n_within is not None) == (r.doc_id % 100 == 0) for r in rows)


def test_pipeline(spark):
    """Each stage on its own input: toxicity by its scores, the others by brute force."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    before = {r.doc_id: r for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line dedup", "SimHash near-dedup", "decontamination", "mixing"]

    kept = stages["toxicity"](spark, docs, FOLDER)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    wrong = {r.doc_id for r in toxicity.toxicity(docs, labels).collect() if r.predicted}
    assert kept.columns == columns and {r.doc_id for r in kept.collect()} == set(before) - wrong

    lined = stages["line dedup"](spark, kept, FOLDER).cache()
    assert lined.columns == columns
    rows = kept.collect()
    pages = {s: sum(r.source == s for r in rows) for s in {r.source for r in rows}}
    seen = {}
    for r in rows:
        for x in set(r.text.split("\n")):
            seen[r.source, x] = seen.get((r.source, x), 0) + 1
    for r in lined.collect():
        old = before[r.doc_id]
        left = [
            x for x in old.text.split("\n")
            if not x.strip(" ") or not (seen[r.source, x] >= 5 and seen[r.source, x] > 0.1 * pages[r.source])
        ]
        assert r.text == "\n".join(left) and r.n_chars == len(r.text)

    single = stages["SimHash near-dedup"](spark, lined, FOLDER).cache()
    assert single.columns == columns
    prints = {r.doc_id: brute.fingerprint(r.text) for r in lined.collect()}
    roots = brute.groups(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for i, fp in sorted(prints.items()):
        least.setdefault(roots[fp], i)
    assert {r.doc_id for r in single.collect()} == set(least.values())

    clean = stages["decontamination"](spark, single, FOLDER).cache()
    assert clean.columns == columns
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    judged = brute.contamination([(r.doc_id, r.text) for r in single.collect()], items)
    assert {r.doc_id for r in clean.collect()} == {r[0] for r in judged if not r[2]}

    mixed = stages["mixing"](spark, clean, FOLDER)
    copies = {r.doc_id: r.n for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    rows = clean.collect()
    names = sorted({r.source for r in rows})
    sizes = [sum(len(brute.words(r.text)) for r in rows if r.source == s) for s in names]
    for name, size, target in zip(names, sizes, brute.targets(sizes)):
        for r in (r for r in rows if r.source == name):
            rate = target / size
            assert abs(copies.get(r.doc_id, 0) - rate) < 1
    assert mixing.repeated(mixing.mixed(clean)).count() == mixed.count()
    assert corpus_pipeline.run(spark, FOLDER).count() == mixed.count()


def test_copies_are_not_boilerplate(spark):
    """Groups of copies keep their lines, and then one row each; a line of different texts still goes."""
    rows = [(k, f"first of {k % 3}\nsecond of {k % 3}\nthird of {k % 3}", "a", 0) for k in range(30)]
    rows += [(100 + k, f"menu\nown line {k}\nmore {k} of it", "a", 0) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").repartition(4)
    stages = dict(corpus_pipeline.STAGES)
    lined = stages["line dedup"](spark, docs, FOLDER)
    found = {r.doc_id: r.text for r in lined.collect()}
    assert found == {k: t.replace("menu\n", "") for k, t, _, _ in rows}
    left = {r.doc_id for r in stages["SimHash near-dedup"](spark, lined, FOLDER).collect()}
    assert left == {0, 1, 2, *range(100, 120)}
