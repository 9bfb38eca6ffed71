"""What a packing worker holds at once: finished sequences leave in small batches, texts are cut a little at a time."""

import random

import brute
import pyarrow as pa
import pytest

from medloom.llm import packing, vocab

PATH = vocab.public_path("word_bpe_49k.json")


class _Task:
    """The part of a task's context that packing reads."""

    @staticmethod
    def get():
        return _Task

    @staticmethod
    def partitionId():
        return 3


def texts(n, words):
    rng = random.Random(7)
    return [" ".join(rng.choice(["tide", "stone", "Wood,", "and", "rain."]) + str(rng.randrange(300)) for _ in range(words)) for _ in range(n)]


@pytest.mark.parametrize("max_tokens", [2048, 7])
def test_sequences_leave_in_small_batches(monkeypatch, max_tokens):
    monkeypatch.setattr(packing, "TaskContext", _Task)
    rows = texts(1200, 500) if max_tokens > 7 else texts(300, 120)
    batch = pa.RecordBatch.from_pydict({"_id": pa.array(range(len(rows)), pa.int64()), "_text": pa.array(rows, pa.string())})
    block = (packing.BLOCK_DOCUMENTS, packing.BLOCK_TOKENS)
    found = list(packing._pack(PATH, 1, (max_tokens, 256, max_tokens), True, block)(iter([batch])))
    assert max(b.num_rows for b in found) <= 5_000 + max_tokens
    assert max(sum(b.column("length").to_pylist()) for b in found) <= 500_000 + max_tokens
    whole = pa.Table.from_batches(found)
    lengths = dict.fromkeys(range(len(rows)), 0)
    for doc, length, ids in zip(*(whole[c].to_pylist() for c in ("_id", "length", "ids")), strict=True):
        assert len(ids) == length
        lengths[doc] += length
    assert lengths == dict(zip(whole["_id"].to_pylist(), whole["doc_tokens"].to_pylist(), strict=True))
    assert len(found) > 1


def test_columns_of_any_size_give_the_same_rows(spark):
    rows = [(i, t) for i, t in enumerate(texts(40, 60))] + [(None, None), (7, ""), (7, "日本語 <|endoftext|> x\n\ny"), (8, "z" * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    expected = packing.pack(docs, PATH).collect()
    assert brute.same(packing.pack(docs, PATH, kept_pieces=50, column_chars=100).collect(), expected)
    assert len({r.doc_id for r in expected}) == 41
