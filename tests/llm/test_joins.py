"""Exact dedup, the similarity join and connected components against plain versions."""

import random

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from medloom.llm import exact, jaccard
from medloom.llm.components import Forest, components

SCHEMA = "doc_id long, text string"


def near_copies(seed, size=4):
    rng = random.Random(seed)
    texts = [None, "", " \n", "a", "A", "a b", "a B c", "a b c", "a b c d", "É a b c", "é a b c"]
    base = [[rng.choice("abcdefghijkl") + str(rng.randint(0, 30)) for _ in range(rng.randint(5, 120))] for _ in range(30)]
    for i in range(300):
        words = list(rng.choice(base if i % 2 else base[:3]))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
            words[rng.randrange(len(words))] = f"Z{rng.randint(0, 1000)}"
        if rng.random() < 0.3:
            words = words[: rng.randint(3, len(words))]
        texts.append(" ".join(words))
    rows = [(None if i % 71 == 70 else i - 1 if i % 83 == 82 else i, t) for i, t in enumerate(texts)]
    rows += rows[20:25]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("words", "percent", "block"), [(4, 85, 4_000_000), (4, 85, 500), (5, 80, 4_000_000)])
def test_similar_components(spark, words, percent, block):
    rows = near_copies(5)
    df = brute.hostile(spark.createDataFrame(rows, SCHEMA))
    got = jaccard.similar_components(df, words=words, percent=percent, block_grams=block)
    assert brute.same(got.collect(), brute.similar(rows, words, percent))


def test_similar_dedup_keeps_one_of_each_component(spark):
    rows = near_copies(6)
    df = brute.hostile(spark.createDataFrame(rows, SCHEMA))
    got = jaccard.dedup(df)
    assert got.columns == df.columns
    expected = [r for r, (i, _, c) in zip(rows, brute.similar(rows), strict=True) if i == c]
    assert brute.same(got.select("doc_id", "text").collect(), expected)


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([60, 80, 85, 95, 100]))
def test_linked_sets_share_a_part_and_a_block_gives_its_components(seed, percent):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, rng.integers(1, 300), dtype=np.uint64)
    sets = []
    for _ in range(12):
        own = base[rng.random(len(base)) > rng.choice([0, 0.05, 0.1, 0.2])]
        extra = rng.integers(0, 2**63, rng.integers(0, 1 + len(base) // 8), dtype=np.uint64)
        s = np.unique(np.append(own, extra))
        if len(s):
            sets.append(s)
    if len(sets) < 2:
        return
    digests, counts = jaccard.part_digests(np.concatenate(sets), np.array([len(s) for s in sets]), percent)
    parts = [set(p.tolist()) for p in np.split(digests, np.cumsum(counts)[:-1])]
    forest = Forest(len(sets))
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                assert parts[i] & parts[j]
                forest.join(i, j)
    spanned = Forest(len(sets))
    for i, j in jaccard.spanning_links(sets, percent):
        spanned.join(i, j)
    assert [forest.root(i) for i in range(len(sets))] == [spanned.root(i) for i in range(len(sets))]


def test_no_documents(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert jaccard.similar_components(none).count() == 0
    assert exact.groups(none).count() == 0
    assert exact.dedup(none).count() == 0


@pytest.mark.parametrize("task_edges", [0, 10**6])
def test_components(spark, task_edges):
    rng = random.Random(2)
    edges = [(rng.randint(-50, 400), rng.randint(-50, 400)) for _ in range(230)] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7), (3, 2), (2, 3)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(edges, "a long, b long"), task_edges).collect()
    assert brute.same(got, [(x, root(x)) for x in up])


def equal_texts():
    rng = random.Random(8)
    rows = [(None, None), (1, ""), (2, " "), (3, "\t\n"), (None, "only here"), (None, "twice"), (None, "twice"), (9, "x\x0by"), (8, "x  y"), (8, "x y"), (5, "é"), (4, "x\x1fy")]
    rows += [(100 + rng.randint(0, 300), rng.choice(["a b", "a  b", "a\nb", " a b", "c" * 3000]) + str(rng.randint(0, 60))) for _ in range(300)]
    return rows


def test_equal_groups(spark):
    rows = equal_texts()
    df = brute.hostile(spark.createDataFrame(rows, SCHEMA))
    assert brute.same(exact.groups(df).collect(), brute.equal_groups(rows))


def test_equal_dedup(spark):
    rows = equal_texts()
    df = brute.hostile(spark.createDataFrame(rows, SCHEMA))
    got = exact.dedup(df)
    assert got.columns == df.columns
    assert brute.same(got.select("doc_id", "text").collect(), [r for r, g in zip(rows, brute.equal_groups(rows), strict=True) if g[3]])


def test_full_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(exact, "MIN_BITS", 64)
    monkeypatch.setattr(exact, "MAX_BITS", 64)
    rows = equal_texts()
    assert brute.same(exact.groups(spark.createDataFrame(rows, SCHEMA)).collect(), brute.equal_groups(rows))


def test_exact_dedup_runs_no_python(spark):
    df = spark.createDataFrame(equal_texts(), SCHEMA)
    for out in (exact.groups(df), exact.dedup(df)):
        plan = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "simple")
        assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_one_row_of_each_equal_text(spark):
    rows = [*equal_texts(), (7, "again"), (7, "again"), (7, "again "), (None, "again"), (6, "x y"), (6, "x y")]
    df = brute.hostile(spark.createDataFrame(rows, SCHEMA))
    got = exact.dedup_rows(df)
    assert got.columns == df.columns
    kept = [(brute.one_space(r.text), r.doc_id) for r in got.collect()]
    assert brute.same(kept, {(brute.one_space(t), g[1]) for (_, t), g in zip(rows, brute.equal_groups(rows), strict=True)})
    plan = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "simple")
    assert "WindowGroupLimit" in plan and "Python" not in plan and "Arrow" not in plan


def test_similar_dedup_goes_by_row(spark):
    near = [f"w{i}" for i in range(60)]
    other = " ".join(f"o{i}" for i in range(60))
    loose = [f"n{i}" for i in range(60)]
    rows = [(1, " ".join(near)), (2, " ".join([*near, "z"])), (2, other), (None, " ".join(loose)), (None, " ".join([*loose, "z"])), (None, " ".join([*near, "y"]))]
    rows += [(3, "same text here now"), (3, "same text here now"), (4, ""), (5, None)]
    df = brute.hostile(spark.createDataFrame(rows, SCHEMA))
    got = jaccard.dedup_rows(df)
    assert got.columns == df.columns
    left = [tuple(r) for r in got.select("doc_id", "text").collect()]
    assert sum(r in rows[3:5] for r in left) == 1
    assert brute.same([r for r in left if r not in rows[3:5]], [rows[0], rows[2], rows[6], rows[8], rows[9]])


def test_similar_dedup_by_row_keeps_the_smallest_id(spark):
    rows = [(i, t) for i, (_, t) in enumerate(near_copies(6))]
    got = jaccard.dedup_rows(spark.createDataFrame(rows, SCHEMA))
    assert brute.same(got.collect(), [r for r, (i, _, c) in zip(rows, brute.similar(rows), strict=True) if i == c])


def test_blocks_are_hardly_larger_than_components(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    docs = exact.dedup_rows(docs)
    rows = jaccard.keyed(docs, "doc_id", "text")
    schema = "_id long, _hash long, n long, one long, two long, counts binary"
    survey = jaccard.written(jaccard.arrow_map(rows, jaccard._survey(5), schema), "survey")
    parts = jaccard.arrow_map(rows.select("_text"), jaccard._parts(5, 80), "part long, class long")
    met = jaccard.written(jaccard.arrow_map(parts.repartition("part").sortWithinPartitions("part", "class"), jaccard._meetings, "part long, class long"), "meetings")
    blocks = jaccard.components(jaccard._blocks(met, survey.filter("n > 0"), 80, jaccard.MEETING))
    largest = blocks.groupBy("component").count().agg(F.max("count")).first()[0]
    found = jaccard.similar_components(docs, words=5, percent=80)
    component = found.groupBy("component_id").count().agg(F.max("count")).first()[0]
    assert component <= largest <= 50  # 1,541 where every shared part joined


def test_meetings_in_pieces(spark):
    rng = random.Random(5)
    base = [" ".join(f"w{rng.randrange(500)}" for _ in range(60)) for _ in range(6)]
    texts = []
    for _ in range(120):
        words = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 2, 9])):
            words[rng.randrange(len(words))] = f"x{rng.randrange(9)}"
        texts.append(" ".join(words))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = brute.similar(list(enumerate(texts)), 3, 70)
    for meeting, block_grams in ((3, 50), (jaccard.MEETING, jaccard.BLOCK_GRAMS)):
        got = jaccard.similar_components(df, words=3, percent=70, meeting=meeting, block_grams=block_grams).collect()
        assert brute.same(got, expected)


@pytest.mark.parametrize("percent", [70, 80, 95])
def test_counts_never_part_linked_sets(percent):
    rng = np.random.default_rng(percent)
    for _ in range(60):
        base = rng.integers(1, 1 << 62, int(rng.choice([3, 20, 80, 900, 6000])), dtype=np.uint64)
        sets = []
        for _ in range(8):
            kept = base[rng.random(len(base)) > rng.choice([0, 0.05, 0.12])]
            more = rng.integers(1, 1 << 62, int(len(base) * rng.choice([0, 0.05])), dtype=np.uint64)
            sets.append(np.unique(np.concatenate([kept if len(kept) else base[:1], more])))
        sizes = np.array([len(s) for s in sets])
        counts = jaccard.folded(jaccard.count_rows(np.concatenate(sets), sizes))
        links = [(i, j) for i in range(8) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= percent * len(np.union1d(sets[i], sets[j]))]
        forest = Forest(8)
        for pair in jaccard.allowed_links(sizes, counts, percent):
            forest.join(*pair)
        assert all(forest.root(i) == forest.root(j) for i, j in links)
