"""Scores of the two classifiers against plain Python: every feature looked up on its own, every vote cast by hand."""

import math

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from medloom.llm import langid, quality

M32, M64 = (1 << 32) - 1, (1 << 64) - 1


def mixed(h):
    h ^= h >> 30
    h = h * 0xBF58476D1CE4E5B9 & M64
    h ^= h >> 27
    h = h * 0x94D049BB133111EB & M64
    return h ^ h >> 31


def texts_of(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").filter("text is not null").orderBy("doc_id").limit(60)
    return docs, {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


# Language: n-grams of letters, one-versus-one votes ------------------------------------------------------

def buckets(text):
    """Bucket of every n-gram of the text as the machines see it, one at a time."""
    data, _ = langid._letters([text.lower().encode()])
    data = data.tolist()
    for order in langid.ORDERS:
        for i in range(len(data) - order + 1):
            h = order
            for k in range(order):
                h = (h ^ data[i + k]) * 0x01000193 & M32
                h ^= h >> 15
            yield (h * 0x2C1B3C6D & M32) >> (32 - langid.BITS)


def plain_language(text, rows):
    found = list(buckets(text))
    margin = {}
    for family, a, b, raw in rows:
        if raw:
            w = np.frombuffer(raw, np.float32).astype(float)
            margin[family, a, b] = langid.SCALE * sum(w[k] for k in found) / len(found) + w[-1]
    members = {}
    for family, a, _, raw in rows:
        if not raw:
            members.setdefault(family, []).append(a)

    def choose(family, names):
        votes, sums = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0)
        for (f, a, b), s in margin.items():
            if f == family:
                votes[a if s >= 0 else b] += 1
                sums[a] += s
                sums[b] -= s
        best = max(names, key=lambda n: votes[n] + 0.5 * math.tanh(sums[n] / max(1, len(names))))
        own = [s if a == best else -s for (f, a, b), s in margin.items() if f == family and best in (a, b)]
        return best, 1 / (1 + math.exp(-2 * min(own))) if own else 1.0

    family, p = choose("", sorted(members))
    lang, q = choose(family, sorted(members[family]))
    return lang, p * q


def test_language_votes(spark):
    docs, texts = texts_of(spark)
    model = [(f, a, b, bytes(w)) for f, a, b, w in langid.train(docs)]
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs, model, "text", ("doc_id",)).collect()}
    for i, text in texts.items():
        if langid.has_letter(text) and len(text) < 3000:
            lang, score = plain_language(text, model)
            assert got[i][0] == lang and abs(got[i][1] - score) < 1e-4


# Quality: a sparse dot product, and the updates that train it ----------------------------------------------

def test_quality_is_a_dot_product_of_each_text(spark):
    docs, texts = texts_of(spark)
    labels = docs.select("doc_id", (F.length("text") % 2).cast("int").alias("quality"))
    model = quality.train(docs, labels)
    w = np.frombuffer(model, np.float32).astype(float).tolist()
    got = {r.doc_id: (r.score, r.predicted) for r in quality.score(docs, model, "text", ("doc_id",)).collect()}
    for i, text in texts.items():
        at, _ = quality.features([text.encode()])
        assert len(set(at.tolist())) == len(at)
        total = sum(w[k] for k in at.tolist()) / math.sqrt(max(1, len(at))) + w[-1]
        assert abs(got[i][0] - 1 / (1 + math.exp(-max(-35, min(35, total))))) < 1e-9
        assert got[i][1] == (got[i][0] >= 0.5)


@pytest.mark.parametrize("seed", range(3))
def test_leader_updates(seed):
    rng = np.random.default_rng(seed)
    model, z, n = quality.Leader(), {}, {}
    bias = 1 << quality.BITS

    def weight(k):
        if abs(z.get(k, 0.0)) <= quality.L1:
            return 0.0
        return -(z[k] - math.copysign(quality.L1, z[k])) / ((quality.BETA + math.sqrt(n[k])) / quality.ALPHA + quality.L2)

    for _ in range(80):
        at, label = np.unique(rng.integers(0, 30, 8)), int(rng.integers(0, 2))
        model.learn(at, label)
        x = {**{int(k): 1 / math.sqrt(len(at)) for k in at}, bias: 1.0}
        w = {k: weight(k) for k in x}
        p = 1 / (1 + math.exp(-sum(w[k] * x[k] for k in x)))
        for k, value in x.items():
            g, old = (p - label) * value, n.get(k, 0.0)
            z[k] = z.get(k, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / quality.ALPHA * w[k]
            n[k] = old + g * g
    found = model.weights()
    assert all(abs(found[k] - weight(k)) < 1e-12 for k in [*range(30), bias])


def test_features_of_a_text_by_hand():
    text = b"ab Cd ab 9!"
    at, counts = quality.features([text])
    assert counts.tolist() == [len(at)]
    words, *_ = quality.word_layout([text])
    expected = set()
    for kind, order in ((1, 1), (2, 2)):
        for i in range(len(words) - order + 1):
            h = kind
            for k in range(order):
                h = mixed((h * 0x9E3779B97F4A7C15 + int(words[i + k])) & M64)
            expected.add(h >> (64 - quality.BITS))
    assert expected <= set(at.tolist())
