"""Toxicity: accuracy on held-out documents, the model against plain counting, and odd inputs."""

import collections
import math
import os
import random
import re
import zlib

import brute
import numpy as np
from conftest import SF_SMALL
from pyspark.sql import functions as F

from medloom.llm import toxicity

MID = "/root/testdata/sf0.1"
D = toxicity.DISCOUNT


def ratios(counts, words):
    """Log-likelihood ratio of each word, from counts {word: (toxic, ordinary)}, computed as it is defined."""

    def grams(w):
        s = f"<{w}>"
        return [(s[max(0, i - 7) : i], s[i]) for i in range(1, len(s))]

    n = collections.defaultdict(lambda: [0, 0])
    for w, both in counts.items():
        for gram in grams(w):
            n[gram][0] += both[0]
            n[gram][1] += both[1]
    follow = collections.Counter((h[1:], c) for h, c in n)
    single = collections.Counter(c for _, c in follow)
    whole = sum(single.values())

    def shared(g, c):
        around = [k for (g2, _), k in follow.items() if g2 == g]
        p0 = (single[c] + 1) / (whole + len(single) + 1)
        return (max(follow[g, c] - D, 0) + D * len(around) * p0) / sum(around) if around else p0

    def chance(h, c, x):
        seen = [v[x] for (h2, _), v in n.items() if h2 == h]
        if not sum(seen):
            return shared(h[1:], c)
        own = n[h, c][x] if (h, c) in n else 0
        return (max(own - D, 0) + D * sum(v > 0 for v in seen) * shared(h[1:], c)) / sum(seen)

    return [sum(math.log(chance(h, c, 0) / chance(h, c, 1)) for h, c in grams(w)) for w in words]


def test_model_against_its_definition(spark):
    counts = {"idiot": (5, 1), "idiom": (0, 4), "the": (9, 40), "a": (3, 30), "schön": (1, 2), "abcdefghijkl": (2, 0)}
    counted = spark.createDataFrame([(w, t, o) for w, (t, o) in counts.items()], "w string, toxic long, ordinary long")
    table = toxicity.table_of(counted)
    words = [*counts, "idiots", "x", "thea", "abcdefghijxx", "日本"]
    expected = ratios(counts, words)
    rows = spark.createDataFrame([([w],) for w in words], "words array<string>")
    for held in (0, 10**6):
        got = toxicity.features(rows.select("words", F.element_at("words", 1).alias("w")), table, held).collect()
        found = {r.w: r.worst for r in got}
        assert np.allclose([found[w] for w in words], expected, atol=1e-5)


def test_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{MID}/{n}.parquet") for n in ("documents", "labels"))
    got = toxicity.rate(docs, labels).join(labels, "doc_id", "left").join(docs.select("doc_id", "text"), "doc_id").collect()
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    insult = re.compile(r"\b(trash|pathetic|idiot|disgusting|worthless|stupid|clown|loser|scum|moron)\b", re.I)
    held = [r for r in got if r.held_out]
    named = [r.predicted for r in held if insult.search(r.text or "")]
    assert len(named) > 50 and sum(named) / len(named) > 0.97
    clean = [r.predicted for r in held if r.toxic == 0 and not insult.search(r.text or "")]
    assert len(clean) > 500 and sum(clean) / len(clean) < 0.03


def test_odd_rows_and_large_models(spark):
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{n}.parquet") for n in ("documents", "labels"))
    odd = spark.createDataFrame([(None, None), (900, ""), (901, " \n!"), (902, "x"), (903, "a " * 30000), (903, "b"), (904, "é" * 9000), (904, "é" * 9000), (905, "İ\U0001f642 İx")], "doc_id long, text string")
    both = brute.hostile(docs.select("doc_id", "text").unionByName(odd))
    more = labels.select("doc_id", "toxic").unionByName(spark.createDataFrame([(None, 1), (900, None), (901, 7), (902, 0), (902, 1), (904, 1)], "doc_id long, toxic int"))
    got = toxicity.rate(both, more).collect()
    assert len(got) == both.count() and all(0 <= r.score <= 1 for r in got)
    joined = toxicity.rate(both, more, held_rows=0).collect()
    order = lambda rows: [r.score for r in sorted(rows, key=lambda r: (str(r.doc_id), r.score))]
    assert np.allclose(order(got), order(joined), atol=1e-9)


def test_without_labels_or_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{n}.parquet") for n in ("documents", "labels"))
    assert {(r.score, r.predicted) for r in toxicity.rate(docs, labels.limit(0)).collect()} == {(0.5, 0)}
    assert {r.score for r in toxicity.rate(docs, labels.filter("toxic = 0")).collect()} == {0.5}
    assert toxicity.rate(docs.limit(0), labels).count() == 0


def test_label_and_language_are_not_inputs(spark):
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{n}.parquet") for n in ("documents", "labels"))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    changed = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    assert brute.same(toxicity.rate(docs, labels).collect(), toxicity.rate(changed, turned).collect())


def test_large_model_writes_no_texts(spark):
    """A model that is not held is laid out once; texts are scored where they are read."""
    rng = random.Random(12)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 12))) for _ in range(9000)]
    counted = spark.createDataFrame([(w, i % 3, 1 - i % 2) for i, w in enumerate(words[:300])], "w string, toxic long, ordinary long")
    table = toxicity.table_of(counted)
    rows = spark.createDataFrame([(i, rng.choices(words, k=rng.randint(0, 400))) for i in range(600)], "i long, words array<string>").cache()
    folder = spark.conf.get("spark.checkpoint.dir")
    used = lambda: sum(os.path.getsize(os.path.join(at, n)) for at, _, names in os.walk(folder) for n in names)
    rows.count()
    before = used()
    large = toxicity.features(rows, table, table.count() - 1)
    got = {r.i: (r.ratio, r.worst) for r in large.collect()}
    assert used() == before
    assert "Exchange" not in large._jdf.queryExecution().toString()
    assert got == {r.i: (r.ratio, r.worst) for r in toxicity.features(rows, table, table.count()).collect()}
    assert len(got) == 600 and len(set(got.values())) > 500
    rows.unpersist()


def test_laid_out_model_is_whole_and_in_order(spark):
    words = [f"{i:x}" for i in range(20000)]
    counted = spark.createDataFrame([(w, i % 4, i % 7) for i, w in enumerate(words)], "w string, toxic long, ordinary long")
    table = toxicity.table_of(counted)
    held = toxicity.model_of(table)()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that it comes in several partitions
    try:
        laid = toxicity.model_of(table, 0)()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(held.keys) == table.count() > 20000 and (np.diff(laid.keys) > 0).all()
    assert np.array_equal(held.keys, laid.keys) and np.array_equal(held.values, laid.values)
    assert np.array_equal(held.ratios([*words, "", "zzz"]), laid.ratios([*words, "", "zzz"]))
