"""The corpus pipeline, each stage against a plain version on its own input."""

import random

import brute
import corpus_pipeline
import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import Window
from pyspark.sql import functions as F

from medloom.llm import langid
from medloom.sources.shared import written
from medloom.sources.tables import table


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage got and gave."""
    docs, out = table(spark, SF_SMALL, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        left = written(stage(spark, docs, SF_SMALL), name)
        out[name] = (docs, left)
        docs = left
    return out


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages_keep_the_columns(spark, steps):
    columns = table(spark, SF_SMALL, "documents").columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "ngram_jaccard", "suffix_dedup", "packing"]
    assert all(left.columns == columns for name, (_, left) in steps.items() if name != "packing")


def test_language_stage_keeps_prose(spark, steps):
    docs, left = steps["language_id"]
    assert left.count() == docs.count()
    junk = spark.createDataFrame([(10**6, "12 34 !!", "en", "s", 8), (10**6 + 1, None, None, None, None)], docs.schema)
    kept = corpus_pipeline.language_id(spark, docs.unionByName(junk), SF_SMALL)
    assert brute.same(kept.collect(), docs.collect())


def test_exact_stage(steps):
    docs, left = steps["exact_dedup"]
    rows = pairs(docs)
    assert brute.same(pairs(left), [r for r, g in zip(rows, brute.equal_groups(rows), strict=True) if g[3]])


def test_jaccard_stage(steps):
    docs, left = steps["ngram_jaccard"]
    rows = pairs(docs)
    assert brute.same(pairs(left), [r for r, (i, _, c) in zip(rows, brute.similar(rows, 5, 80), strict=True) if i == c])


def test_suffix_stage(steps):
    docs, left = steps["suffix_dedup"]
    rows = dict(pairs(docs))
    data = {i: t.encode() for i, t in rows.items()}
    gone = dict(zip(data, brute.covered([b for b in data.values()], 200), strict=True))
    expected = [(i, bytes(x for x, g in zip(b, gone[i], strict=True) if not g).decode(errors="ignore")) for i, b in data.items()]
    assert brute.same(pairs(left), expected)
    assert all(r.n_chars == len(r.text) for r in left.collect())


def test_packing_stage(steps):
    docs, left = steps["packing"]
    by_doc = {}
    for r in left.collect():
        by_doc.setdefault(r.doc_id, []).append(r)
    assert set(by_doc) == {i for i, _ in pairs(docs)}
    for pieces in by_doc.values():
        assert sum(r.length for r in pieces) == pieces[0].doc_tokens


def test_run_equals_the_stages(spark, steps):
    last = steps["packing"][1].select("doc_id", "start", "length", "ids_crc32")
    assert brute.same(corpus_pipeline.run(spark, SF_SMALL).select("doc_id", "doc_tokens").distinct().collect(), steps["packing"][1].select("doc_id", "doc_tokens").distinct().collect())
    assert last.count() > 0


def test_stages_of_an_empty_table(spark):
    docs = table(spark, SF_SMALL, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF_SMALL), name)
        assert docs.count() == 0


def test_hostile_rows_pass_through(spark):
    """Missing values in every column, repeated rows, long texts and clashing column names."""
    rng = random.Random(1)
    words = [rng.choice(["der", "und", "the", "and", "les", "que", "los", "para"]) + rng.choice(["", "schaft", "tion", "eaux"]) for _ in range(400)]
    rows = [(i, " ".join(rng.sample(words, 60)), rng.choice(["de", "en", "fr", "es", None]), None, None) for i in range(60)]
    rows += [(None, None, None, None, None), (None, "the and", "en", "s", 7), (200, "", "en", "s", 0), (201, "x " * 40000, "en", "s", 80000), rows[3], rows[3]]
    docs = brute.hostile(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    for name, stage in corpus_pipeline.STAGES:
        left = written(stage(spark, docs, SF_SMALL), name)
        assert left.count() > 0 and (name == "packing" or left.columns == docs.columns)
        docs = left


def repeated_rows():
    """A long text ingested twice under one id, one twice without id, and others."""
    rng = random.Random(4)
    words = [rng.choice(["der", "und", "the", "and", "les", "que", "los", "para"]) + rng.choice(["", "schaft", "tion", "eaux"]) + str(i) for i in range(400)]
    twice, without = (" ".join(rng.sample(words, 60)) for _ in range(2))
    rows = [(i, " ".join(rng.sample(words, 60)), "en", None, None) for i in range(20)]
    return rows + [(100, twice, "en", "s", 1)] * 2 + [(None, without, "en", "s", 1)] * 2, twice, without


def test_one_copy_of_rows_ingested_twice_stays_with_its_text(spark):
    rows, twice, without = repeated_rows()
    docs = brute.hostile(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    for name, stage in corpus_pipeline.STAGES[1:4]:
        docs = written(stage(spark, docs, SF_SMALL), name)
    left = pairs(docs)
    assert len(left) == 22
    assert [t for i, t in left if i == 100] == [twice] and [t for i, t in left if i is None] == [without]


def test_language_stage_keeps_the_shortest_documents(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    order = Window.partitionBy("lang").orderBy(F.length("text"), "doc_id")
    lettered = docs.filter(F.col("text").rlike(r"\p{L}"))
    short = lettered.withColumn("place", F.row_number().over(order)).filter("place <= 50").select("doc_id", "lang").collect()
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, "").select("doc_id").collect()}
    assert len(short) > 100 and [tuple(r) for r in short if r.doc_id not in kept] == []


def test_language_stage_goes_by_the_weaker_chance(spark, monkeypatch):
    words = {"en": "thorn and", "de": "schpf und", "fr": "eaux que", "es": "cion los"}
    rows = [(i, " ".join(words[x].split()[(i + k) % 2] for k in range(9)), x) for i in range(80) for x in words]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs)
    # weights are scaled so that both margins are 0.4 or so: each chance is 0.69, their product 0.48
    scores = langid.summed([t.encode() for _, t, _ in rows], langid.Model(model).weights)
    scaled = []
    for m, w in zip([m for m in model if m[3]], scores.T, strict=True):
        own = [abs(s) for s, (_, _, x) in zip(w, rows, strict=True) if x in m[1:3] or m[0] == ""]
        scaled.append((*m[:3], (np.frombuffer(m[3], np.float32) * np.float32(0.4 / np.median(own))).tobytes()))
    scaled += [m for m in model if not m[3]]
    products = [r.score for r in langid.predict(docs, scaled).collect()]
    assert min(products) < 0.5
    monkeypatch.setattr(langid, "train", lambda labelled: scaled)
    assert corpus_pipeline.language_id(spark, docs, "").count() == len(rows)


def test_language_stage_without_examples_keeps_what_has_letters(spark):
    docs = spark.createDataFrame([(1, "abc def", None), (2, "12 34", None), (3, None, None), (4, "\u00e9", None), (None, "x", None)], "doc_id long, text string, lang string")
    assert brute.same(pairs(corpus_pipeline.language_id(spark, docs, "")), [(1, "abc def"), (4, "\u00e9"), (None, "x")])
