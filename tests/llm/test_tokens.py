"""Tokenizing operators against the tokenizers library."""

import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from medloom.llm import bpe, huffman, packing
from medloom.llm.vocab import PieceEncoder, _strings, public_path
from medloom.sources.shared import new_path

BYTE, WORDS = public_path("byte_bpe_50k.json"), public_path("word_bpe_49k.json")
ODD = [
    (None, None), (5000, ""), (5001, " "), (5002, "a  b\n\n c <|endoftext|>x  <|endoftext|> y"),
    (5003, "don't  DON'T 12345 ٠١ \x1c\x85\xa0 日本語 é ́ Σας ΟΔΟΣ\n\n\n"), (5003, "x" * 5000),
    (5004, "日本語 한국어 🙂🙂 ​ zz" * 50), (5004, "<|startoftext|>Ab <|endoftext|>"), (5005, "tail \t "), (5005, "tail \t "),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    return brute.hostile(rows.union(spark.createDataFrame(ODD, "doc_id long, text string"))).cache()


@pytest.fixture(scope="module")
def ids(docs):
    tokenizer = Tokenizer.from_file(BYTE)
    return [(r.doc_id, r.text, tokenizer.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect()]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_prefix_bpe(docs, ids):
    tokenizer = Tokenizer.from_file(BYTE)
    expected = [
        (i, len(own), brute.sha(",".join(map(str, own))), brute.sha(tokenizer.decode(own, skip_special_tokens=False))) for i, _, own in ids
    ]
    assert brute.same(bpe.encode_digests(docs, BYTE).collect(), expected)


def test_prefix_bpe_gives_ids_and_text(docs, ids):
    got = bpe.encode(docs, BYTE).collect()
    assert brute.same([(r.doc_id, r.ids, r.decoded) for r in got], [(i, own, t or "") for i, t, own in ids])


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40) | st.text(alphabet="aehinrst '\n", max_size=60))
def test_pieces_and_prefixes_equal_the_library(text):
    expected = _TOKENIZER.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(next(_PIECES.encode([text])), "<u4").tolist() == expected
    assert _PREFIXES.text_ids(text) == expected
    assert _PREFIXES.digest(text)[1] == brute.sha(",".join(map(str, expected)))


_TOKENIZER, _PIECES, _PREFIXES = Tokenizer.from_file(BYTE), PieceEncoder(BYTE, kept=20), bpe.PrefixEncoder(BYTE)


def test_huffman_files(spark, docs, ids):
    folder = new_path(spark, "huffman-test")
    huffman.write_ids(docs, folder, BYTE)
    got = sorted(huffman.read_ids(spark, folder).collect(), key=lambda r: r.start)
    hashes = {(r.doc_id, r.text): r.h for r in docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    order = sorted(ids, key=lambda x: (x[0] is not None, x[0] or 0, hashes[x[0], x[1]]))
    start, expected = 0, []
    for i, _, own in order:
        own = [*own, 2]
        expected.append((i, start, len(own), crc(own), own))
        start += len(own)
    assert [tuple(r) for r in got] == expected


def test_huffman_of_nothing(spark):
    folder = new_path(spark, "huffman-none")
    huffman.write_ids(spark.createDataFrame([], "doc_id long, text string"), folder, BYTE)
    assert huffman.read_ids(spark, folder).count() == 0


def test_ids_are_counted_once_a_batch(monkeypatch):
    """A count is as long as the vocabulary, so one for each document costs more than the ids of short documents."""
    calls, count = [], np.bincount
    monkeypatch.setattr(huffman.np, "bincount", lambda *a, **k: calls.append(1) or count(*a, **k))
    own = [[i % 7, 40_000] for i in range(300)] + [[70_000, 3, 3]]
    raw = [np.array(x, "<u2" if max(x) < 1 << 16 else "<u4").tobytes() for x in own]
    columns = {"ids": pa.array(raw, pa.binary()), "n": pa.array([len(x) for x in own])}
    batch = pa.RecordBatch.from_pydict(columns)
    found = {r["id"]: r["n"] for b in huffman._count(iter([batch, batch.slice(0, 0), batch])) for r in b.to_pylist()}
    expected = np.bincount(sum(own, []))
    assert found == {i: 2 * int(n) for i, n in enumerate(expected) if n}
    assert len(calls) == 3  # two batches and the line above


def test_strings_of_a_column():
    texts = ["a", "", "\x00b", "é日🙂", "a"] * 3
    assert _strings(pa.array(texts).slice(2, 9)) == texts[2:11]
    assert _strings(pa.array([], pa.string())) == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 10**6), min_size=1, max_size=60), st.integers(6, 12), st.data())
def test_codes_are_prefix_free_bounded_and_decode(counts, limit, data):
    lengths = huffman.code_lengths(np.array(counts), limit)
    assert lengths.max() <= limit and sum(2.0 ** -x for x in lengths.tolist()) <= 1
    if len(counts) > 1:
        assert (np.diff(lengths[np.argsort(counts, kind="stable")]) <= 0).all()
    lengths = lengths.astype(np.uint8)
    ids = np.array(data.draw(st.lists(st.integers(0, len(counts) - 1), max_size=700)), np.int64)
    payload, marks = huffman.pack_bits(ids, lengths, huffman.canonical_codes(lengths))
    out = huffman.unpack_bits([payload, payload], [marks, marks], [len(ids)] * 2, huffman.decoding_tables(lengths))
    assert out[0].tolist() == ids.tolist() == out[1].tolist()


def test_lengths_are_optimal_when_the_limit_does_not_bind():
    import heapq

    counts = np.random.default_rng(1).integers(1, 1000, 200)
    heap, cost = counts.tolist(), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    assert int((huffman.code_lengths(counts, 30) * counts).sum()) == cost


def packed(df, **options):
    sequences, documents = {}, {}
    for r in packing.pack(df, WORDS, **options).collect():
        sequences.setdefault(r.sequence_id, []).append(r)
        documents.setdefault(r.doc_id, []).append(r)
        assert r.length == len(r.ids) > 0 and r.ids_crc32 == crc(r.ids)
    return sequences, documents


def test_packing(docs):
    sequences, documents = packed(docs)
    padding = 0
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        ends = np.cumsum([r.length for r in pieces])
        assert [r.offset for r in pieces] == [0, *ends[:-1]] and ends[-1] <= 2048 and len(pieces) <= packing.MAX_SEGMENTS
        padding += 0 if ends[-1] & (ends[-1] - 1) == 0 else 2048 - ends[-1]
    assert padding == 0
    tokenizer = Tokenizer.from_file(WORDS)
    expected = {}
    for r in docs.collect():
        expected.setdefault(r.doc_id, []).append([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1])
    assert set(documents) == set(expected)
    for i, own in expected.items():
        if len(own) == 1:
            pieces = sorted(documents[i], key=lambda r: r.start)
            assert [x for r in pieces for x in r.ids] == own[0] and {r.doc_tokens for r in pieces} == {len(own[0])}
        else:
            assert sum(r.length for r in documents[i]) == sum(map(len, own))


def test_packing_keeps_all_three_limits(spark):
    rows = [(i, "answer " * (i % 50), "question " * (i % 30)) for i in range(200)]
    sequences, _ = packed(spark.createDataFrame(rows, "doc_id int, text string, q string"), prompt_col="q", max_tokens=128, max_segments=3, max_loss=40)
    for pieces in sequences.values():
        bears = sum(max(0, r.start + r.length - max(r.start, r.doc_id % 30)) for r in pieces)
        assert sum(r.length for r in pieces) <= 128 and len(pieces) <= 3 and bears <= 40


def test_packing_of_nothing(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), WORDS).count() == 0
    assert bpe.encode(spark.createDataFrame([], "doc_id long, text string"), BYTE).count() == 0
