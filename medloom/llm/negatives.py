"""Hard negatives: candidates of another label whose integer inner product with an anchor is a little below a positive's.

Scores are exact and cover all pairs of an anchor and a candidate, by the method of four Russians. A candidate is
kept as packed bit planes: byte g of plane k holds bit k (two's complement) of its components 8g to 8g+7. For an
anchor and each group of eight components a table of the 256 subset sums is built; one lookup by a candidate's byte
adds up to eight products at once, the lookups of a plane are summed, and planes are joined by shift and add, the sign
plane negative.

Anchors are dealt into blocks, candidates into chunks; a cell is one block against one chunk, each of at most about
``BLOCK_ROWS`` rows, so memory is bounded at any size. A first round finds each anchor's positives, a second one, which
knows the range of scores each positive allows, its negatives. Cells return a few rows per anchor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medloom.llm.mapping import arrow_map
from medloom.sources.shared import written

BLOCK_ROWS = 16_384
LEAST_ROWS = 1_024
#: Anchors whose tables are held at once, and candidates that are looked up together.
TABLES, LOOKUPS = 64, 2_048
#: Scores are longs; those outside count as the nearest of these.
LIMIT = (1 << 63) - 1
_PACKED = "id long, label long, bits int, planes binary"


def quantise(values: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """floor(scale * x) of a matrix of finite doubles, as longs where a row fits, and which rows do not."""
    with np.errstate(over="ignore"):
        product = np.floor(values * float(scale))
    wide = (np.abs(product) >= 2.0**53).any(axis=1)
    return np.where(wide[:, None], 0, product).astype(np.int64), wide


def planes_for(largest: int) -> int:
    """How many bit planes hold numbers up to ``largest`` in size; few different answers, so rows can be looked up together."""
    bits = largest.bit_length() + 1
    return next((b for b in (9, 17, 33, 54) if bits <= b), -(-bits // 64) * 64)


def pack_planes(rows: np.ndarray, bits: int) -> np.ndarray:
    """Bytes (rows, bits, groups of eight) of a matrix of whole numbers in two's complement."""
    groups = -(-rows.shape[1] // 8)
    full = np.zeros((len(rows), groups * 8), rows.dtype)
    full[:, : rows.shape[1]] = rows
    out = np.empty((len(rows), bits, groups), np.uint8)
    for k in range(bits):
        out[:, k] = np.packbits(((full >> k) & 1).astype(np.uint8), axis=1, bitorder="little")
    return out


def unpack_planes(planes: np.ndarray) -> np.ndarray:
    """The whole numbers (rows, 8 x groups) that bytes (rows, bits, groups) stand for."""
    bits = planes.shape[1]
    kind = np.int64 if bits < 63 else object
    ones = np.unpackbits(planes, axis=2, bitorder="little").astype(kind)
    total = -ones[:, -1]
    for k in range(bits - 2, -1, -1):
        total = total * 2 + ones[:, k]
    return total


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """Tables (groups, 256, anchors): the sum of the anchor's components whose bits are set in the byte."""
    count, width = anchors.shape
    by_group = anchors.reshape(count, width // 8, 8).transpose(1, 2, 0)
    out = np.zeros((width // 8, 256, count), anchors.dtype)
    for j in range(8):
        out[:, 1 << j : 2 << j] = out[:, : 1 << j] + by_group[:, None, j]
    return out


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products (candidates, anchors) by table lookups; a shorter vector ends in zeros."""
    groups = min(len(tables), planes.shape[2])
    index = np.ascontiguousarray(planes[:, :, :groups].transpose(1, 2, 0)).astype(np.intp)
    total = np.zeros((len(planes), tables.shape[2]), tables.dtype)
    found = np.empty_like(total)
    for k in range(planes.shape[1] - 1, -1, -1):
        total += total
        add = np.subtract if k == planes.shape[1] - 1 else np.add
        for g in range(groups):
            np.take(tables[g], index[k, g], axis=0, out=found, mode="clip")
            add(total, found, out=total)
    return total


class Block:
    """Anchors of one block: their numbers, and the best candidates met so far for each of their questions.

    A question is an anchor with a range of scores; in the first round an anchor asks one (its own label, any
    score), in the second one for each positive (other labels, a range below the positive's score).
    """

    def __init__(self, rows: list[tuple], most: int):
        self.rows, self.most = rows, most
        self.ids = np.array([r["id"] for r in rows], np.int64)
        self.labels = np.array([r["label"] for r in rows], np.int64)
        widest = max(r["groups"] for r in rows)
        numbers = []
        for r in rows:
            planes = np.frombuffer(r["planes"], np.uint8).reshape(1, r["bits"], r["groups"])
            full = np.zeros(8 * widest, object if r["bits"] >= 63 else np.int64)
            full[: 8 * r["groups"]] = unpack_planes(planes)[0]
            numbers.append(full)
        self.numbers = np.array(numbers)
        self.ranges = [r["ranges"] for r in rows]  # None, or (lowest, highest) for each positive
        slots = max(1, max((len(x) for x in self.ranges if x is not None), default=1))
        self.low = np.full((slots, len(rows)), LIMIT, np.int64)
        self.high = np.full((slots, len(rows)), -LIMIT, np.int64)
        for i, x in enumerate(self.ranges):
            for j, (low, high) in enumerate([(-LIMIT, LIMIT)] if x is None else x):
                self.low[j, i], self.high[j, i] = low, high
        #: question number, score, candidate; and the score a candidate must reach to matter
        self.found = np.empty((0, 3), np.int64)
        self.floor = np.full((slots, len(rows)), -LIMIT, np.int64)

    def meet(self, ids: np.ndarray, labels: np.ndarray, times: np.ndarray, planes: np.ndarray) -> None:
        times = np.minimum(times, self.most)
        for first in range(0, len(self.rows), TABLES):
            part = slice(first, first + TABLES)
            numbers = self.numbers[part]
            groups = min(numbers.shape[1] // 8, planes.shape[2])
            bound = 8 * max(1, groups) * (1 << (planes.shape[1] - 1)) * max(1, max(abs(int(numbers.min())), abs(int(numbers.max()))) if numbers.size else 1)
            kind = np.int32 if bound < 1 << 31 else np.int64 if bound <= LIMIT else object
            tables = subset_sums(numbers.astype(kind))
            fresh = [self.found]
            for at in range(0, len(ids), LOOKUPS):
                own = slice(at, at + LOOKUPS)
                product = scores(tables, planes[own])
                if kind is object:
                    product = np.clip(product, -LIMIT, LIMIT)
                fresh += self.hits(part, product.astype(np.int64), ids[own], labels[own], times[own])
            if len(fresh) > 1:
                self.found = np.concatenate(fresh)
                self.trim()

    def hits(self, part: slice, product: np.ndarray, ids: np.ndarray, labels: np.ndarray, times: np.ndarray) -> Iterator[np.ndarray]:
        same = labels[:, None] == self.labels[None, part]
        other = ids[:, None] != self.ids[None, part]
        asked = self.ranges[0] is None
        allowed = other & same if asked else other & ~same
        for j in range(len(self.low)):
            ok = allowed & (product >= np.maximum(self.low, self.floor)[j, part]) & (product <= self.high[j, part])
            if (self.floor[j, part] == -LIMIT).any() and len(ids) > self.most:
                shown = np.where(ok, product, -LIMIT)
                ok &= product >= np.partition(shown, len(ids) - self.most, axis=0)[len(ids) - self.most]
            row, anchor = np.nonzero(ok)
            if len(row):
                question = (anchor + (part.start or 0)) * len(self.low) + j
                hit = np.stack([question, product[row, anchor], ids[row]], axis=1)
                yield np.repeat(hit, times[row], axis=0)

    def trim(self) -> None:
        """Keep the best of each question."""
        order = np.lexsort((self.found[:, 2], -self.found[:, 1], self.found[:, 0]))
        found = self.found[order]
        first = np.flatnonzero(np.append(True, found[1:, 0] != found[:-1, 0]))
        place = np.arange(len(found)) - np.repeat(first, np.diff(np.append(first, len(found))))
        self.found = found[place < self.most]
        last = found[place == self.most - 1]
        self.floor[last[:, 0] % len(self.low), last[:, 0] // len(self.low)] = last[:, 1]

    def answers(self) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(self.found), 65_536):
            question, score, found = self.found[at : at + 65_536].T
            who = [self.rows[i] for i in (question // len(self.low)).tolist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "anchor": pa.array([r["id"] for r in who], pa.int64()),
                    "mark": pa.array([r["mark"] for r in who], pa.int64()),
                    "slot": pa.array((question % len(self.low)).astype(np.int32)),
                    "score": pa.array(score),
                    "id": pa.array(found),
                }
            )


def _pack(scale: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs = batch.column("vec")
            lengths = np.diff(vecs.offsets.to_numpy())
            flat = vecs.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            ends = np.cumsum(lengths)
            bits, planes = np.zeros(len(lengths), np.int32), [b""] * len(lengths)
            for n in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == n)
                rows = flat[(ends[at] - n)[:, None] + np.arange(n)]
                whole, wide = quantise(rows, scale)
                size = [planes_for(int(m)) for m in np.abs(whole).max(axis=1, initial=0)]
                for b in set(size):
                    pick = np.flatnonzero((np.array(size) == b) & ~wide)
                    for i, data in zip(at[pick].tolist(), pack_planes(whole[pick], b), strict=True):
                        bits[i], planes[i] = b, data.tobytes()
                for i in np.flatnonzero(wide).tolist():
                    exact = np.array([[int(np.floor(x * scale)) if abs(x) < 1e290 else int(x) * scale for x in rows[i].tolist()]], object)
                    b = planes_for(max(abs(x) for x in exact[0]))
                    bits[at[i]], planes[at[i]] = b, pack_planes(exact, b)[0].tobytes()
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "label": batch.column("label"), "bits": pa.array(bits), "planes": pa.array(planes, pa.binary())})

    return run


def _cells(most: int) -> Callable:
    """Rows arrive by cell, anchors (those without ``times``) before candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, waiting, block = None, [], None
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            times = batch.column("times").to_numpy()
            starts = np.flatnonzero(np.append(True, (cells[1:] != cells[:-1]) | ((times[1:] > 0) != (times[:-1] > 0)))) if len(cells) else []
            for first, end in zip(starts, [*starts[1:], len(cells)], strict=True):
                rows = batch.slice(first, end - first)
                if cells[first] != cell:
                    if block:
                        yield from block.answers()
                    cell, waiting, block = cells[first], [], None
                if times[first] == 0:
                    waiting += [dict(r, groups=len(r["planes"]) // r["bits"], ranges=None if r["low"] is None else list(zip(r["low"], r["high"], strict=True))) for r in rows.to_pylist()]
                elif waiting:
                    block = block or Block(waiting, most)
                    _candidates(block, rows)
        if block:
            yield from block.answers()

    return run


def _candidates(block: Block, rows: pa.RecordBatch) -> None:
    ids, labels, times, bits = (rows.column(c).to_numpy() for c in ("id", "label", "times", "bits"))
    planes = rows.column("planes")
    sizes = np.diff(np.frombuffer(planes.buffers()[1], np.int32)[planes.offset : planes.offset + len(planes) + 1])
    for b, size in set(zip(bits.tolist(), sizes.tolist(), strict=True)):
        at = np.flatnonzero((bits == b) & (sizes == size))
        data = np.frombuffer(b"".join(planes.take(pa.array(at)).to_pylist()), np.uint8).reshape(len(at), b, size // b)
        block.meet(ids[at], labels[at], times[at], data)


def _valid(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    rows = df.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"), F.col(f"`{vector_col}`").cast("array<double>").alias("vec")
    )
    sound = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull()).filter(sound)


def _met(anchors: DataFrame, candidates: DataFrame, blocks: int, chunks: int, most: int) -> DataFrame:
    """The ``most`` best candidates of every question: anchor, mark, slot, score, id, place."""
    own = F.pmod(F.xxhash64("id", "mark"), F.lit(blocks))
    asked = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), "*", own.alias("block"), F.lit(0).cast("long").alias("times"))
    none = F.lit(None).cast("array<long>")
    dealt = F.pmod(F.xxhash64("id", "planes"), F.lit(chunks)).alias("chunk")
    given = candidates.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), dealt, "id", "label", "bits", "planes", "times", F.lit(0).cast("long").alias("mark"), none.alias("low"), none.alias("high")
    )
    columns = ["id", "label", "bits", "planes", "times", "mark", "low", "high"]
    cell = (F.col("block") * chunks + F.col("chunk")).cast("long").alias("cell")
    meeting = asked.select(cell, *columns).unionByName(given.select(cell, *columns))
    meeting = meeting.repartition(blocks * chunks, "cell").sortWithinPartitions("cell", F.col("times") > 0)
    found = arrow_map(meeting, _cells(most), "anchor long, mark long, slot int, score long, id long")
    order = Window.partitionBy("anchor", "mark", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)


def mine(
    vectors: DataFrame,
    anchors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = 5,
    negatives: int = 3,
    least: int = 50,
    greatest: int = 95,
    scale: int = 256,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Hard negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A component x counts as floor(scale * x), a score is the whole inner product with the anchor; higher first, ties to
    the smaller id. Positives are the first rows of the anchor's label, negatives the first rows of other labels
    whose score is ``least`` to ``greatest`` percent of the positive's.

    Rows without id, label or vector, and those with a missing or non-finite component, take no part. Rows that share
    the anchor's id are neither positives nor negatives of it. An anchor row that is repeated is asked once; repeated
    candidates each count. Vectors of different length meet as if the shorter ended in zeros; an empty vector scores
    0. Scores beyond a long count as the nearest long. Other columns are ignored; an empty table gives an empty table.
    """
    spark = vectors.sparkSession
    pack = _pack(scale)
    counted = arrow_map(_valid(vectors, id_col, vector_col, label_col), pack, _PACKED).groupBy("id", "label", "bits", "planes").agg(F.count("*").alias("times"))
    candidates = written(counted, "candidates")
    asking = arrow_map(_valid(anchors, id_col, vector_col, label_col), pack, _PACKED).distinct()
    mark = F.xxhash64("id", "label", "planes").alias("mark")
    asking = written(asking.select("*", mark), "anchors")
    rows, asked = candidates.count(), asking.count()
    tasks = spark.sparkContext.defaultParallelism
    chunks = max(1, -(-rows // block_rows), min(4 * tasks, -(-rows // LEAST_ROWS)))
    blocks = max(1, -(-asked // block_rows))
    none = F.lit(None).cast("array<long>")
    first = _met(asking.select("*", none.alias("low"), none.alias("high")), candidates, blocks, chunks, positives)
    # an anchor has at most ``positives`` of them
    ranked = first.groupBy("anchor", "mark").agg(F.array_sort(F.collect_list(F.struct("place", F.col("id").alias("pid"), "score"))).alias("near"))
    near = written(ranked, "positives")
    # whole numbers n with least * p <= 100 * n <= greatest * p; wide decimals hold the products
    p = lambda x, percent: x["score"].cast("decimal(38,0)") * F.lit(percent).cast("decimal(5,0)") / F.lit(100).cast("decimal(5,0)")
    low = F.transform("near", lambda x: F.ceil(p(x, least)).cast("long"))
    high = F.transform("near", lambda x: F.floor(p(x, greatest)).cast("long"))
    knowing = asking.join(near, (asking["id"] == near["anchor"]) & (asking["mark"] == near["mark"])).select(
        "id", "label", "bits", "planes", asking["mark"], low.alias("low"), high.alias("high")
    )
    second = _met(written(knowing, "ranges"), candidates, blocks, chunks, negatives)
    given = near.select("anchor", "mark", F.posexplode("near").alias("slot", "positive"))
    return second.join(given, ["anchor", "mark", "slot"]).select(
        F.col("anchor").alias("anchor_id"),
        F.col("positive.pid").alias("positive_id"),
        F.col("place").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        F.col("positive.score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


