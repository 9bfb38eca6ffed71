"""Operators that learn: accuracy on held-out documents, recall against brute force, and odd inputs."""

import zlib

import brute
import numpy as np
import pytest
from conftest import SF, SF_SMALL
from pyspark.sql import functions as F

from medloom.llm import forest, langid, quality

MID = "/root/testdata/sf0.1"


def rows_of(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def fold(i, parts):
    return zlib.crc32(str(i).encode()) % parts


def test_language_of_held_out_documents(spark):
    docs = rows_of(spark, "documents", MID)
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    assert all(r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.99


def test_language_ignores_everything_but_the_text(spark):
    docs = rows_of(spark, "documents", SF_SMALL)
    odd = spark.createDataFrame([(None, None, "en"), (900, None, None), (901, "", "de"), (902, "12 ! 3", "fr"), (903, "é" * 9000, None), (903, "é" * 9000, None)], "doc_id long, text string, lang string")
    both = brute.hostile(docs.select("doc_id", "text", "lang").unionByName(odd))
    changed = both.withColumn("lang", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit("xx")).otherwise(F.col("lang")))
    a, b = langid.identify(both).collect(), langid.identify(changed).collect()
    assert brute.same(a, b) and len(a) == both.count()
    named = {r.doc_id: r.lang_pred for r in a}
    assert [named[i] for i in (None, 900, 901, 902)] == ["und"] * 4 and named[903] in ("en", "de", "fr", "es")


def test_language_without_examples(spark):
    df = spark.createDataFrame([(1, "abc", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in langid.identify(df).collect()} == {"und"}
    assert langid.identify(df.limit(0)).count() == 0
    one = spark.createDataFrame([(i, "abc def", "en") for i in range(8)], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in langid.identify(one).collect()} == {"en"}


def test_families_come_first():
    rng = np.random.default_rng(0)
    langs = {"en": "thorn and", "de": "schpf und", "fr": "eaux que", "es": "ción los"}
    texts, names = [], []
    for lang, words in langs.items():
        for _ in range(40):
            texts.append(" ".join(rng.choice(words.split(), 30)).encode())
            names.append(lang)
    rows = list(langid.counted(texts))
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"lang": pa.array(names), "at": pa.array([a.tobytes() for a, _ in rows], pa.binary()), "x": pa.array([x.tobytes() for _, x in rows], pa.binary())})
    model = [tuple(c[0].as_py() for c in b.columns) for b in langid._train([batch])]
    assert [m[:3] for m in model if m[3]] == [("", "germanic", "romance"), ("germanic", "de", "en"), ("romance", "es", "fr")]
    assert langid.Model(model).predict(texts)[0] == names


def test_quality_of_held_out_documents(spark):
    docs, labels = rows_of(spark, "documents", MID), rows_of(spark, "labels", MID)
    got = quality.rate(docs, labels).join(labels, "doc_id", "left").collect()
    assert all(r.held_out == (fold(r.doc_id, 3) == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out and r.quality is not None]
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.98
    bad = [r for r in held if r.quality == 0]
    assert sum(r.predicted == 0 for r in bad) / len(bad) > 0.9


def test_quality_of_odd_rows(spark):
    docs, labels = rows_of(spark, "documents", SF_SMALL), rows_of(spark, "labels", SF_SMALL)
    odd = spark.createDataFrame([(None, None), (900, ""), (901, " \n"), (902, "x"), (903, "a " * 30000), (903, "b")], "doc_id long, text string")
    both = brute.hostile(docs.select("doc_id", "text").unionByName(odd))
    more = labels.select("doc_id", "quality").unionByName(spark.createDataFrame([(None, 1), (900, None), (901, 7), (902, 0), (902, 1)], "doc_id long, quality int"))
    got = quality.rate(both, more).collect()
    assert len(got) == both.count() and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in quality.rate(both, labels.limit(0)).collect()} == {0.5}
    assert quality.rate(both.limit(0), labels).count() == 0


def exact_nearest(rows, k=5):
    sound = [(i, np.array(v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, a in sound:
        if q % 50 == 0:
            found = sorted((-float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum()))), i) for i, b in sound if i != q)
            out[q] = [(i, -s) for s, i in found[:k]]
    return out


def answers(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_recall(spark):
    df = rows_of(spark, "embeddings", MID).select("vec_id", "embedding")
    expected = exact_nearest([tuple(r) for r in df.collect()])
    got = answers(forest.search(df, df.filter("vec_id % 50 = 0")))
    assert set(got) == set(expected)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in e}) for q, e in expected.items())
    assert hits / sum(map(len, expected.values())) >= 0.9


@pytest.mark.parametrize("leaf_rows", [20_000, 40])
def test_search_of_everything_is_exact(spark, leaf_rows):
    df = rows_of(spark, "embeddings", SF_SMALL).select("vec_id", "embedding")
    rows = [tuple(r) for r in df.collect()]
    odd = [(10001, None), (10002, [0.0] * 64), (10003, [float("nan")] + [1.0] * 63), (10004, [None] + [1.0] * 63), (10006, [float("inf")] * 64), (10100, rows[7][1])]
    odd += [(20000 + i, rows[50][1]) for i in range(30)] + [rows[0]]
    more = brute.hostile(df.unionByName(spark.createDataFrame([*odd, (10005, [1.0] * 3), (None, [1.0] * 64), (10007, [])], df.schema)))
    expected = exact_nearest(rows + odd[:-1])
    got = answers(forest.search(more, more.filter("vec_id % 50 = 0"), share=9.0, leaf_rows=leaf_rows))
    assert {q: [i for i, _ in a] for q, a in got.items()} == {q: [i for i, _ in a] for q, a in expected.items()}
    assert all(abs(s - t) < 1e-12 for q in got for (_, s), (_, t) in zip(got[q], expected[q], strict=True))


def test_search_of_little(spark):
    df = rows_of(spark, "embeddings", SF_SMALL).select("vec_id", "embedding")
    assert forest.search(df.limit(0), df.limit(0)).count() == 0
    few = df.filter("vec_id in (0, 1, 50)")
    assert {q: len(a) for q, a in answers(forest.search(few, few.filter("vec_id % 50 = 0"))).items()} == {0: 2, 50: 2}


@pytest.mark.parametrize("leaf_rows", [20_000, 40])
def test_search_among_vectors_of_each_length(spark, leaf_rows):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=(64, 3, 300)[i // 50 % 3 if i % 10 == 0 else 0]).tolist()) for i in range(400)]
    rows += [(950, [1.0, 2.0]), (1000, [3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    expected = {}
    for n in {len(v) for _, v in rows}:
        expected |= exact_nearest([(i, v) for i, v in rows if len(v) == n])
    got = answers(forest.search(df, df.filter("vec_id % 50 = 0"), share=9.0, leaf_rows=leaf_rows))
    assert {len(v) for i, v in rows if i in got} == {64, 3, 300} and len(got) == 8
    assert {q: [i for i, _ in a] for q, a in got.items()} == {q: [i for i, _ in a] for q, a in expected.items() if a}


def test_vectors_of_any_size(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=3) * 10.0 ** rng.choice([-300, -200, 0, 200, 300])).tolist()) for i in range(300)]
    rows += [(1000, [1e200, 0.0]), (1001, [1.0, 0.0]), (1002, [1e-200, 0.0]), (1050, [5e-324, 0.0]), (1051, [1.7e308, 1.7e308])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = answers(forest.search(df, df.filter("vec_id % 50 = 0"), leaves=8))

    def unit(v):
        v = np.ldexp(np.array(v), -np.frexp(max(map(abs, v)))[1])
        return v / np.sqrt((v * v).sum())

    for q, v in rows:
        if q % 50 == 0:
            best = sorted((-float(unit(v) @ unit(w)), i) for i, w in rows if i != q and len(w) == len(v))[:5]
            assert np.allclose([s for _, s in got[q]], [-s for s, _ in best], atol=1e-12)
