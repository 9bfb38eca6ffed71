"""Removal of repeated byte strings and word passages against plain versions."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from medloom.llm import phrases, rolling, suffixes
from medloom.llm.rolling import anchored_runs, byte_layout

SCHEMA = "doc_id long, text string"


def texts(words, seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice(words) for _ in range(rng.randint(0, 150))) for _ in range(20)]
    out = [None, "", "x", " \n", "a" * 400, "ab" * 150, "aab" * 80 + "q", "a " * 90]
    for _ in range(100):
        parts = []
        for _ in range(rng.randint(1, 4)):
            b = rng.choice(base)
            at = rng.randint(0, len(b))
            parts += [b[at : at + rng.randint(0, 150)], "".join(rng.choice(words) for _ in range(rng.randint(0, 20)))]
        out.append("".join(parts))
    out += out[20:24]
    rows = [(None if i % 17 == 0 else i // 2 * 2 if i % 10 == 0 else i, t) for i, t in enumerate(out)]
    return rows + rows[30:32]


@pytest.mark.parametrize(("window", "gram", "hot"), [(60, 16, 10**9), (60, 16, 5), (40, 40, 10**9)])
def test_bytes(spark, window, gram, hot):
    rows = texts("abcdeé ", 3)
    df = brute.hostile(spark.createDataFrame(rows, SCHEMA))
    got = suffixes.remove_repeats(df, window=window, gram=gram, hot_runs=hot)
    assert brute.same(got.select("n_bytes", "n_removed", "n_spans", "kept_sha256").collect(), brute.bytes_removed([t for _, t in rows], window))


@pytest.mark.parametrize(("window", "gram", "hot", "limit"), [(15, 4, 10**9, 10**6), (15, 4, 5, 50), (9, 9, 10**9, 200)])
def test_words(spark, window, gram, hot, limit):
    rows = texts(["a ", "b\t", "cé ", "d\x1fe ", "f\n", "g", " h "], 4)
    df = brute.hostile(spark.createDataFrame(rows, SCHEMA))
    got = phrases.remove_passages(df, window=window, gram=gram, hot_runs=hot, automaton_words=limit)
    assert brute.same(got.select("n_words", "n_removed", "kept_sha256").collect(), brute.words_removed([t for _, t in rows], window))


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert suffixes.remove_repeats(none).count() == 0
    assert phrases.remove_passages(none).count() == 0
    assert suffixes.dedup(none).columns == ["doc_id", "text"]


def test_cut_characters_are_dropped(spark):
    a = "é" * 200
    df = brute.hostile(spark.createDataFrame([(1, "xx" + a), (2, a), (3, None)], SCHEMA))
    got = suffixes.dedup(df, window=11, gram=4)
    assert got.columns == df.columns
    assert {r.doc_id: r.text for r in got.collect()} == {1: "xx", 2: "", 3: ""}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=40).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=6), st.integers(2, 9))
def test_anchors_depend_on_content_only(parts, window):
    """Every window is in exactly one run, and equal windows have their anchor at the same place."""
    gram = max(1, window // 2)
    data, starts, ends = byte_layout(parts)
    doc, p0, p1, anchor, key, _ = anchored_runs(rolling.BYTE_TOKENS[data], rolling.BYTE_TOKENS_2[data], starts, ends, window, gram)
    place, seen = {}, 0
    for d, a, b, at, k in zip(doc, p0, p1, anchor, key, strict=True):
        for p in range(a, b + 1):
            seen += 1
            content = data[p : p + window].tobytes()
            assert starts[d] <= p and p + window <= ends[d] and p <= at <= p + window - gram
            assert place.setdefault(content, (at - p, k)) == (at - p, k)
    assert seen == sum(max(0, len(x) - window + 1) for x in parts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=20).map(lambda b: bytes(x % 3 for x in b)), max_size=30))
def test_multikey_order(parts):
    words, lengths = suffixes._padded(parts, 24)
    order = suffixes.multikey_order(words, lengths)
    assert [parts[i] for i in order] == sorted(parts, key=lambda b: (b.ljust(24, b"\0"), len(b)))
    shared = suffixes.shared_prefixes(words, lengths, order)
    for i in range(1, len(parts)):
        a, b = parts[order[i - 1]], parts[order[i]]
        common = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert shared[i] == common


def test_long_period_text_is_cut_into_runs():
    tokens = rolling.BYTE_TOKENS[np.zeros(5000, np.uint8)]
    doc, p0, p1, anchor, _, _ = anchored_runs(tokens, tokens, np.array([0]), np.array([5000]), 200, 48)
    assert (p0 == anchor).all() and (p0 == p1).all() and len(doc) == 4801


def test_replacement_characters_of_a_text_stay(spark):
    same = "é" * 101
    rows = [(1, "x�y" + same + "one�"), (2, "q" + same[:100] + "è" + "� two")]
    data = [t.encode() for _, t in rows]
    left = [bytes(b for b, g in zip(d, gone, strict=True) if not g) for d, gone in zip(data, brute.covered(data, 200), strict=True)]
    expected = [(i, b.decode(errors="ignore")) for (i, _), b in zip(rows, left, strict=True)]
    assert any(b != b.decode(errors="ignore").encode() for b in left) and all("�" in t for _, t in expected)
    assert brute.same(suffixes.dedup(spark.createDataFrame(rows, SCHEMA)).collect(), expected)


def test_buckets_are_settled_in_pieces_of_whole_grams(monkeypatch):
    """A task holds a piece of its bucket, however large that is, and finds what it found in one go."""
    rng = random.Random(9)
    rows = sorted((bytes([rng.randrange(4) for _ in range(4)]), bytes(rng.randrange(2) for _ in range(5))) for _ in range(3000))
    rows += [(b"zzzz", bytes([i % 2] * 5)) for i in range(700)]
    table = pa.table({
        "_id": pa.array(range(len(rows)), pa.int64()), "_hash": pa.array([0] * len(rows), pa.int64()),
        **{c: pa.array([0] * len(rows), pa.int32()) for c in ("p0", "anchor")}, "p1": pa.array([1] * len(rows), pa.int32()),
        "lead": pa.array([g for g, _ in rows], pa.binary()), "stretch": pa.array([g + rest for g, rest in rows], pa.binary()),
    })
    sizes, plain = [], suffixes.repeated_windows
    monkeypatch.setattr(suffixes, "repeated_windows", lambda s, *rest: sizes.append(len(s)) or plain(s, *rest))
    found = []
    for piece in (10**9, 100):
        monkeypatch.setattr(suffixes, "PIECE_RUNS", piece, raising=False)
        out = suffixes._settle(8, 4)(iter(table.to_batches(max_chunksize=64)))
        found.append(sorted(tuple(r.values()) for batch in out for r in batch.to_pylist()))
    assert found[0] == found[1] and found[0]
    assert sizes[0] == len(rows) and sum(sizes[1:]) == len(rows)
    assert max(sizes[1:]) < 1000 and sizes[1:].count(max(sizes[1:])) == 1
