"""Operators on embeddings, and importance resampling, against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmine.llm import bitslice, negatives, resample, vectors

VECTORS = (
    "vec_id long, embedding array<float>, label int, q int, slot int, v string, rank int, score string, ids string"
)
NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def rows():
    """Vectors with a large group of copies, ties, nulls, repeats, short and empty ones, and null ids."""
    rng = random.Random(3)
    found = [(i, [rng.gauss(0, 0.3) for _ in range(6)], rng.randint(0, 3)) for i in range(400)]
    hot = [0.5, -0.25, 0.125, 0.0, 0.75, -0.5]
    found += [(400 + i, list(hot), i % 3) for i in range(250)]
    found += [(700 + i, [rng.choice([-1.0, 0.0, 1.0]) for _ in range(6)], rng.randint(0, 3)) for i in range(120)]
    found += [(900, None, 1), (901, [0.1, None, 0.2], 1), (902, [NAN] * 6, 1), (903, [INF, 0.0], 2), (904, [], 2)]
    found += [(905, [0.5, 0.5], 1), (906, list(hot), None), (1000, [0.0] * 6, 1), (1100, [-0.5] * 6, 2)]
    found += [found[20], found[20], found[100], (200, [0.9] * 6, 2), (None, list(hot), 1), (None, list(hot), 2)]
    rng.shuffle(found)
    return found


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame([(*r, 7, 7, "clash", 7, "clash", "clash") for r in rows], VECTORS).repartition(5)


def whole(rows, scale):
    """Usable rows as ``(id, whole components, label)``."""
    found = []
    for i, x, label in rows:
        if x is not None and all(c is not None and math.isfinite(c) for c in x):
            found.append((i, tuple(math.floor(float(np.float32(c)) * scale) for c in x), label))
    return found


def product(a, b):
    return sum(x * y for x, y in zip(a, b))


def order(row):
    """Higher scores, then smaller ids, null ids last."""
    return -row[1], row[0] is None, row[0] or 0


def brute_top(rows, k, scale):
    usable, out = whole(rows, scale), []
    for i, x, _ in sorted({r[:2] + (0,) for r in usable if r[0] is not None and r[0] % 100 == 0}):
        scored = sorted(((j, product(x, y)) for j, y, _ in usable if j != i), key=order)
        out += [(i, n + 1, j, s) for n, (j, s) in enumerate(scored[:k])]
    return out


def key(row):
    return tuple((x is None, x or 0) for x in row)


@pytest.mark.parametrize("k,bits,block", [(10, 5, 64), (3, 2, 37), (300, 8, 10_000), (2000, 1, 100)])
def test_top_k(table, rows, k, bits, block):
    found = bitslice.top_k(table, F.col("vec_id") % 100 == 0, k, bits=bits, block_rows=block)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect()), key=key) == sorted(brute_top(rows, k, 1024), key=key)


def test_top_k_of_nothing(table):
    assert bitslice.top_k(table.where("false"), F.lit(True)).count() == 0
    assert bitslice.top_k(table, F.lit(False)).count() == 0
    assert bitslice.top_k(table.where("vec_id = 100").limit(1), F.lit(True)).count() == 0


def test_index_holds_every_row(table, rows):
    index = bitslice.build_index(table, block_rows=50)
    ids = [i for r in index.collect() for i in r.ids]
    assert sorted(ids, key=lambda i: (i is None, i)) == sorted((i for i, *_ in whole(rows, 1)), key=lambda i: (i is None, i))
    assert index.where(F.size("ids") > 50).count() == 0


def test_queries_in_blocks(table, rows, monkeypatch):
    """More queries than a block holds."""
    monkeypatch.setattr(vectors.query_blocks, "__defaults__", (3,))
    found = bitslice.top_k(table, F.col("vec_id") % 100 == 0, 5)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(brute_top(rows, 5, 1024), key=key)
    found = negatives.hard_negatives(table, F.col("vec_id") % 100 == 0)
    assert sorted(map(tuple, found.collect()), key=key) == brute_negatives(rows)


def test_large_components(spark):
    """Beyond 2^53 products stay exact, beyond 2^63 they raise."""
    rng = random.Random(1)
    rows = [(i, [float(rng.randrange(-(2**19), 2**19)) for _ in range(4)], 1) for i in range(60)]
    df = spark.createDataFrame([(i, x) for i, x, _ in rows], "vec_id long, embedding array<double>")
    found = bitslice.top_k(df, F.col("vec_id") == 0, 60)
    usable = [(i, [int(c) * 1024 for c in x]) for i, x, _ in rows]
    scored = sorted(((j, product(usable[0][1], y)) for j, y in usable[1:]), key=order)
    assert [(r.vec_id, r.score) for r in found.orderBy("rank").collect()] == scored
    assert max(abs(s) for _, s in scored) > 2**53
    wide = spark.createDataFrame([(0, [1e30]), (1, [1e30])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="do not fit in 64 bits"):
        bitslice.top_k(wide, F.col("vec_id") == 0).collect()


def test_carry_save_adder():
    rng = np.random.default_rng(0)
    maps, place = rng.integers(0, 2**63, (57, 3), np.uint64), rng.integers(0, 9, 57)
    total = bitslice._added(maps, place)
    bits = lambda x: np.unpackbits(x.view(np.uint8), bitorder="little").astype(np.int64)
    sums = sum(bits(t) << p for p, t in enumerate(total))
    assert np.array_equal(sums, sum(bits(m) << p for m, p in zip(maps, place)))
    every = np.full(3, 2**64 - 1, np.uint64)
    for k in (1, 10, 192):
        assert bitslice._kth_largest(total, every, k) == np.sort(sums)[-k]
    for least in (0, 1, int(np.median(sums)), int(sums.max()), int(sums.max()) + 1, 2**40):
        assert np.array_equal(bits(bitslice._at_least(total, every, least)).astype(bool), sums >= least)


# Hard negatives --------------------------------------------------------------------------------------


def brute_negatives(rows, positives=5, k=10):
    usable = [r for r in whole(rows, 256) if r[2] is not None]
    out = []
    for i, x, label in sorted({r for r in usable if r[0] is not None and r[0] % 100 == 0}):
        scored = sorted(((j, product(x, y), other) for j, y, other in usable if j != i), key=order)
        for p, ps, _ in [r for r in scored if r[2] == label][:positives]:
            near = [r for r in scored if r[2] != label and 30 * ps <= 100 * r[1] <= 90 * ps][:k]
            out += [(i, p, n + 1, j, ps, s) for n, (j, s, _) in enumerate(near)]
    return sorted(out, key=key)


def test_hard_negatives(table, rows):
    found = negatives.hard_negatives(table, F.col("vec_id") % 100 == 0)
    expected = brute_negatives(rows)
    assert sorted(map(tuple, found.collect()), key=key) == expected
    assert len({r[0] for r in expected}) > 4
    assert negatives.hard_negatives(table.where("false"), F.lit(True)).count() == 0
    assert negatives.hard_negatives(table, F.lit(False)).count() == 0
    one = table.where("label = 1")
    assert negatives.hard_negatives(one, F.col("vec_id") % 100 == 0).count() == 0


def test_windows():
    for score in (-7, -1, 0, 1, 3, 99, 100, 101):
        first, last = negatives.window(score)
        assert [s for s in range(-400, 400) if 30 * score <= 100 * s <= 90 * score] == list(range(first, last + 1))


def test_tree_spares_exact_scores():
    """Where anchors lie close together, most candidates are settled by their bounds, and none is lost."""
    rng = np.random.default_rng(2)
    anchors = np.rint(rng.normal(0, 3, (40, 8)) + 200).astype(float)
    rows = np.rint(rng.normal(0, 100, (500, 8)))
    tree = negatives.spanning_tree(anchors)
    assert sorted(tree.order) == list(range(40)) and (tree.parent < 0).sum() == 1
    place = {a: n for n, a in enumerate(tree.order)}
    assert all(place[tree.parent[a]] < place[a] for a in tree.order[1:])
    true, low_edge, high_edge = rows @ anchors.T, 30_000, 45_000
    found = [set() for _ in anchors]

    def overlap(a, low, high):
        assert (low <= true[:, a]).all() and (true[:, a] <= high).all()
        return (high >= low_edge) & (low <= high_edge)

    def take(a, chosen, scores):
        assert np.array_equal(scores, true[chosen, a])
        found[a] |= {int(c) for c, s in zip(chosen, scores) if low_edge <= s <= high_edge}

    scored = negatives.follow(tree, anchors, rows, overlap, take)
    assert found == [set(np.flatnonzero((t >= low_edge) & (t <= high_edge))) for t in true.T]
    assert scored < 0.5 * true.size


# Importance resampling -------------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def features(text, longest):
    words = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), runs


def brute_resampled(docs, items, longest=1, percent=10, least=20):
    bucket = lambda run: zlib.crc32(run.encode()) % 10_000
    bags = [(i, *features(t, longest)) for i, t in docs]
    s = Counter(bucket(r) for _, _, runs in bags for r in runs)
    t = Counter(bucket(r) for _, text in items for r in features(text, longest)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000)))) for b in range(10_000)}
    out = []
    for i, n, runs in bags:
        h = int(hashlib.sha256(f"2024:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(r)] for r in runs)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(runs), weight, weight + noise, None, n])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=key)


@pytest.mark.parametrize("longest,percent", [(1, 10), (1, 100), (3, 50)])
def test_resampled(spark, hard_docs, hard_rows, longest, percent):
    items = [(1, hard_rows[0][1]), (2, "One two three"), (3, None), (4, "")]
    target = spark.createDataFrame(items, "item_id long, text string")
    found = resample.importance_resampled(hard_docs, target, percent=percent, max_words=longest)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    ours = sorted(map(tuple, found.collect()), key=key)
    # Equal rows share their ranks in any order; null ids too.
    theirs = brute_resampled([(i, t) for i, t, _ in hard_rows], items, longest, percent)
    assert Counter(r[:4] for r in ours) == Counter(r[:4] for r in theirs)
    ranks = lambda found: sorted((r[4], r[0] is None, r[0], r[3]) for r in found if r[4] is not None)
    assert ranks(ours) == ranks(theirs) and len(ranks(ours)) > 0


def test_resampling_nothing(no_docs, hard_docs, spark):
    target = spark.createDataFrame([], "item_id long, text string")
    assert resample.importance_resampled(no_docs, target).count() == 0
    assert resample.importance_resampled(hard_docs, target).count() == hard_docs.count()
    short = hard_docs.where("length(text) < 10")
    assert resample.importance_resampled(short, target).where("rank is not null").count() == 0


@pytest.mark.parametrize("runs", [1, 3, 16])
def test_ranks_of_a_skewed_table(spark, runs):
    """Equal scores for half of the rows, sorted input, null ids: exact ranks, even segments."""
    scores = [(i, 5 if i % 2 else i // 7) for i in range(4000)] + [(None, 5), (None, 5), (None, 900)]
    table = spark.createDataFrame(scores, "doc_id long, score long").repartition(6)
    found = resample.ranked(table, runs=runs)
    ordered = sorted(scores, key=lambda r: (-r[1], r[0] is None, r[0] or 0))
    assert [tuple(r) for r in found.orderBy("rank").collect()] == [(*r, n) for n, r in enumerate(ordered, 1)]
    if runs > 1:
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) <= 2.5 * len(scores) / min(runs, 8)
