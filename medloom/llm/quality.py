"""Quality scores: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

Features of a text: its distinct words and word pairs, the distinct shapes (classes of the first two and the last
character, and whether the word before was the same) of one to three neighbouring words, and for shapes also how large
a share of the text they make, in powers of two. They are hashed into 2**18 buckets; all present features have the same
value, one over the root of their number. One task trains, row by row, on at most ``TRAIN_ROWS`` labelled documents (those of
least hash) and returns the weights. Every text is scored whole, as a sparse dot product.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medloom.llm.langid import fold
from medloom.llm.mapping import arrow_map
from medloom.llm.rolling import chunks, mix, ranges, word_layout

BITS = 18
TRAIN_ROWS = 8000
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-3, 1e-4
U = np.uint64


def _shape_classes() -> np.ndarray:
    """A class for each byte: upper case, lower case (and all non-ASCII), digit, or the byte itself."""
    out = np.arange(256, dtype=U)
    out[65:91], out[97:123], out[48:58], out[128:] = 65, 97, 48, 97
    return out


SHAPES = _shape_classes()


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers of each text, end to end, and how many each text has."""
    words, starts, ends, data, begin, end = word_layout(texts)
    again = np.append(False, words[1:] == words[:-1])
    shape = SHAPES[data[begin]] << U(16) | SHAPES[data[np.minimum(begin + 1, end - 1)]] << U(8) | SHAPES[data[end - 1]]
    shape = mix(shape | again.astype(U) << U(24))
    length = ends - starts
    docs = np.arange(len(texts))
    found = []
    for kind, tokens, order in ((1, words, 1), (2, words, 2), (3, shape, 1), (4, shape, 2), (5, shape, 3)):
        counts = np.maximum(0, length - order + 1)
        at = ranges(starts, counts)
        h = np.full(len(at), kind, U)
        for k in range(order):
            h = mix(h * U(0x9E3779B97F4A7C15) + tokens[at + k])
        code = np.repeat(docs, counts) << BITS | (h >> U(64 - BITS)).astype(np.int64)
        code.sort()
        first = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.empty(0, np.int64)
        found.append(code[first])
        if kind > 2 and len(code):
            times = np.diff(np.append(first, len(code)))
            owner = code[first] >> BITS
            share = np.frexp(counts[owner] / times)[1].astype(U)
            h = mix(mix((code[first] & ((1 << BITS) - 1)).astype(U) + U(kind << 32)) + share)
            found.append(owner << BITS | (h >> U(64 - BITS)).astype(np.int64))
    code = np.concatenate(found)
    code.sort()
    code = code[np.append(True, code[1:] != code[:-1])] if len(code) else code
    return code & ((1 << BITS) - 1), np.bincount(code >> BITS, minlength=len(texts))


class Leader:
    """Follow-the-proximally-regularised-leader updates for logistic loss; the last weight is the bias."""

    def __init__(self) -> None:
        self.z = np.zeros((1 << BITS) + 1)
        self.n = np.zeros((1 << BITS) + 1)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, label: int) -> None:
        at = np.append(at, 1 << BITS)
        x = np.full(len(at), 1.0 / np.sqrt(max(1, len(at) - 1)))
        x[-1] = 1.0
        w = self.weights(at)
        p = 1.0 / (1.0 + np.exp(-np.clip(w @ x, -35, 35)))
        g = (p - label) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model = Leader()
    for batch in batches:
        labels = batch.column("label").to_pylist()
        for first, group in chunks([t.encode() for t in batch.column("_text").to_pylist()]):
            at, counts = features(group)
            for own, label in zip(np.split(at, np.cumsum(counts)[:-1]), labels[first : first + len(group)], strict=True):
                model.learn(own, label)
    yield pa.RecordBatch.from_pydict({"w": pa.array([model.weights().astype(np.float32).tobytes()], pa.binary())})


def _score(model: bytes) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = np.frombuffer(model, np.float32).astype(np.float64) if model else np.zeros((1 << BITS) + 1)
        for batch in batches:
            score = np.empty(batch.num_rows)
            for first, group in chunks([t.encode() for t in batch.column("_text").to_pylist()]):
                at, counts = features(group)
                sums = np.append(0.0, np.cumsum(w[at]))
                ends = np.cumsum(counts)
                total = (sums[ends] - sums[ends - counts]) / np.sqrt(np.maximum(1, counts)) + w[-1]
                score[first : first + len(group)] = 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))
            kept = {n: batch.column(n) for n in batch.schema.names if n != "_text"}
            yield pa.RecordBatch.from_pydict(kept | {"score": pa.array(score), "predicted": pa.array((score >= 0.5).astype(np.int32))})

    return run


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = TRAIN_ROWS) -> bytes:
    """Weights (1 MB) learned from at most ``rows`` labelled documents; none without any."""
    known = labels.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label_col}`").cast("int").alias("label")).filter("_id is not null and label in (0, 1)").distinct()
    drawn = known.orderBy(F.xxhash64("_id"), "_id", "label").limit(rows)
    texts = docs.select(F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("_text"))
    sample = texts.join(F.broadcast(drawn), "_id")  # at most ``rows`` pairs of numbers
    one = sample.repartition(1).sortWithinPartitions(F.xxhash64("_id"), "_id", "label", "_text").select("label", "_text")
    learned = arrow_map(one, _train, "w binary").first()
    return bytes(learned.w) if learned else b""


def score(docs: DataFrame, model: bytes, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``keep`` with score (0 to 1, higher: label 1 likelier) and predicted (score >= 0.5) of every text."""
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("_text"))
    schema = T.StructType([*(rows.schema[c] for c in keep), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return arrow_map(rows, _score(model), schema)


def rate(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", parts: int = 3, held: int = 1) -> DataFrame:
    """Per row: the id, held_out, score, predicted; learned from labels of documents that are not held out.

    A row is held out when crc32 of its id modulo ``parts`` is ``held``; rows without id are neither held out nor
    learned from. Labels other than 0 and 1 are ignored; contradictory labels are learned in order. A missing text is
    empty and scored by the bias. Without labels every score is 0.5. Other columns are ignored; an empty table
    gives an empty table.
    """
    side = fold(id_col, parts)
    model = train(docs, labels.filter(side != held), id_col, text_col, label_col)
    named = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"), F.coalesce(side == held, F.lit(False)).alias("held_out"))
    return score(named, model, "_text", ("_id", "held_out")).withColumnRenamed("_id", id_col)
