"""Token ids in files of canonical, length-limited Huffman codes, decoded by tables in independent blocks.

Documents are sorted by id into range partitions, tokenized once, and their ids kept in the shared folder. A first pass
over the ids counts them: every task sends one row per id it met, so at most a vocabulary's worth, and the sums
(bounded by the vocabulary) go to the driver, which fits code lengths by package-merge. A second pass packs bits.

File format. A folder with two Parquet tables:

* ``code``: id, bits. The canonical codes follow from the lengths alone.
* ``segments``: part, first (ids before the segment in its part), doc_ids, n_tokens (ids of each document), payload
  (the bits, big-endian), checkpoints (little-endian unsigned 64-bit bit offsets of every block of ``BLOCK`` ids).

A reader may start at any checkpoint. All blocks of a batch are decoded in step, one id of every block at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medloom.llm.mapping import arrow_map
from medloom.llm.vocab import encoder
from medloom.sources.shared import new_path

BLOCK = 256
MAX_BITS = 18
SEGMENT_IDS = 1_000_000


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits for positive counts (package-merge)."""
    n = len(counts)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols need more than {limit} bits")
    if n < 2:
        return np.ones(n, np.int64)
    order = np.argsort(counts, kind="stable")
    weights = np.asarray(counts, np.int64)[order]
    merged, where = weights, []  # where[k]: which items of list k are symbols
    symbols = np.ones(n, bool)
    for _ in range(limit - 1):
        where.append(symbols)
        half = len(merged) // 2
        packages = merged[0 : 2 * half : 2] + merged[1 : 2 * half : 2]
        both = np.append(weights, packages)
        turn = np.argsort(both, kind="stable")
        merged, symbols = both[turn], turn < n
    where.append(symbols)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for symbols in reversed(where):
        used = int(symbols[:take].sum())
        lengths[:used] += 1
        take = 2 * (take - used)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then of id; ``lengths`` has an entry for each id, 0 for ids without code."""
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    size = lengths[order].astype(np.int64)
    codes = np.zeros(len(lengths), np.uint64)
    if len(order):
        top = int(size[-1])
        steps = np.left_shift(1, top - size)
        codes[order] = ((np.cumsum(steps) - steps) >> (top - size)).astype(np.uint64)
    return codes


def pack_bits(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The codes of ``ids`` one after the other, and the bit offset of every block."""
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    at = ends - size
    total = int(ends[-1]) if len(ends) else 0
    words = np.zeros(total // 32 + 2, np.uint64)
    if total:
        shifted = codes[ids] << (64 - (at & 31) - size).astype(np.uint64)
        word = at >> 5
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        words[word[first]] += np.add.reduceat(shifted >> np.uint64(32), first)
        words[word[first] + 1] += np.add.reduceat(shifted & np.uint64(0xFFFFFFFF), first)
    return words.astype(">u4").tobytes()[: (total + 7) // 8], at[::BLOCK].astype("<u8")


def decoding_tables(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Id and code length for every possible look ahead of as many bits as the longest code."""
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    size = lengths[order].astype(np.int64)
    top = int(size[-1]) if len(size) else 1
    repeat = np.left_shift(1, top - size)
    ids, bits = np.zeros(1 << top, np.uint32), np.ones(1 << top, np.uint8)
    filled = int(repeat.sum())
    ids[:filled], bits[:filled] = np.repeat(order, repeat), np.repeat(size, repeat)
    return ids, bits, top


def unpack_bits(
    payloads: list[bytes], checkpoints: list[np.ndarray], totals: list[int], tables: tuple[np.ndarray, np.ndarray, int]
) -> list[np.ndarray]:
    """The ids of several payloads; every block is decoded from its own checkpoint."""
    ids, bits, top = tables
    spare = b"\0" * (4 * (BLOCK * top // 32 + 3))
    starts, lanes, base, parts = [], [], 0, []
    for payload, marks in zip(payloads, checkpoints, strict=True):
        parts.append(payload + b"\0" * (-len(payload) % 4))
        starts.append(marks.astype(np.int64) + base)
        base += 8 * len(parts[-1])
        lanes.append(len(marks))
    words = np.frombuffer(b"".join(parts) + spare, ">u4").astype(np.uint64)
    at = np.concatenate(starts) if starts else np.empty(0, np.int64)
    out = np.empty((BLOCK, len(at)), np.uint32)
    for step in range(BLOCK if len(at) else 0):
        word = at >> 5
        look = (words[word] << np.uint64(32)) | words[word + 1]
        look = (look << (at & 31).astype(np.uint64)) >> np.uint64(64 - top)
        out[step] = ids[look]
        at = np.minimum(at + bits[look], base)
    by_block = out.T
    done, first = [], 0
    for n, total in zip(lanes, totals, strict=True):
        done.append(by_block[first : first + n].reshape(-1)[:total])
        first += n
    return done


def _tokenize(path: str, end_id: int) -> Callable:
    """The ids of each document, its part, and how many ids come before it in the part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            encoded = encoder(path).encode(batch.column("_text"))
            for at in range(0, batch.num_rows, 500):
                own = [np.frombuffer(x + end, "<u4") for _, x in zip(range(min(500, batch.num_rows - at)), encoded, strict=False)]
                ends = before + np.cumsum([len(x) for x in own])
                wide = [x.astype("<u2").tobytes() if x.max() < 1 << 16 else x.tobytes() for x in own]
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array(np.full(len(own), part, np.int32)),
                        "before": pa.array(np.append(before, ends[:-1])),
                        "n": pa.array(np.diff(ends, prepend=before)),
                        "_id": batch.column("_id").slice(at, len(own)),
                        "ids": pa.array(wide, pa.binary()),
                    }
                )
                before = int(ends[-1])

    return run


def _ids(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("ids", "n"))
        ids = [_ids(raw, n) for raw, n in zip(*columns, strict=True)]
        if ids:  # once a batch: each count is as long as the vocabulary
            found = np.bincount(np.concatenate(ids), minlength=len(total))
            found[: len(total)] += total
            total = found
    ids = np.flatnonzero(total)
    if len(ids):
        yield pa.RecordBatch.from_pydict({"id": pa.array(ids.astype(np.int32)), "n": pa.array(total[ids])})


def _encode(lengths: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = canonical_codes(lengths)
        names: list = []
        waiting: list[np.ndarray] = []
        part, first, held, id_type = -1, 0, 0, pa.null()

        def segment() -> pa.RecordBatch:
            payload, marks = pack_bits(np.concatenate(waiting), lengths, codes)
            return pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "first": pa.array([first], pa.int64()),
                    "doc_ids": pa.array([names], pa.list_(id_type)),
                    "n_tokens": pa.array([[len(x) for x in waiting]], pa.list_(pa.int64())),
                    "payload": pa.array([payload], pa.binary()),
                    "checkpoints": pa.array([marks.tobytes()], pa.binary()),
                }
            )

        for batch in batches:
            id_type = batch.column("_id").type
            columns = (batch.column(c).to_pylist() for c in ("_id", "ids", "part", "before", "n"))
            for name, raw, own_part, before, n in zip(*columns, strict=True):
                if names and (own_part != part or before != first + held or held >= SEGMENT_IDS):
                    yield segment()
                    names, waiting, held = [], [], 0
                if not names:
                    part, first = own_part, before
                names.append(name)
                waiting.append(_ids(raw, n))
                held += n
        if names:
            yield segment()

    return run


def write_ids(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS
) -> None:
    """Encode all documents in ascending order of their ids into ``folder``.

    A missing text is empty: its document is one end id. Missing document ids come first; rows that repeat an id
    follow each other in the order of a hash of their texts. Other columns are ignored; an empty table gives a
    folder without segments.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), text.alias("_text")).withColumn("_hash", F.xxhash64("_text"))
    id_type = rows.schema["_id"].dataType
    ordered = rows.repartitionByRange("_id", "_hash").sortWithinPartitions("_id", "_hash").drop("_hash")
    longs = [T.StructField(c, T.LongType()) for c in ("before", "n")]
    fields = [T.StructField("part", T.IntegerType()), *longs, rows.schema["_id"], T.StructField("ids", T.BinaryType())]
    kept = new_path(spark, "ids")
    arrow_map(ordered, _tokenize(tokenizer_path, end_id), T.StructType(fields)).write.option("compression", "zstd").parquet(kept)
    tokens = spark.read.schema(T.StructType(fields)).parquet(kept)
    counts = arrow_map(tokens.select("ids", "n"), _count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = counts.orderBy("id").collect()  # at most the vocabulary
    lengths = np.zeros(max((r.id for r in counts), default=0) + 1, np.uint8)
    if counts:
        lengths[[r.id for r in counts]] = code_lengths(np.array([r.n for r in counts]), max_bits)
    spark.createDataFrame([(r.id, int(lengths[r.id])) for r in counts], "id int, bits int").coalesce(1).write.parquet(f"{folder}/code")
    fields = [T.StructField("part", T.IntegerType()), T.StructField("first", T.LongType()), T.StructField("doc_ids", T.ArrayType(id_type)), T.StructField("n_tokens", T.ArrayType(T.LongType()))]
    fields += [T.StructField(c, T.BinaryType()) for c in ("payload", "checkpoints")]
    segments = arrow_map(tokens, _encode(lengths), T.StructType(fields))
    segments.write.option("compression", "uncompressed").parquet(f"{folder}/segments")


def _decode(lengths: np.ndarray, before: dict[int, int], with_ids: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = decoding_tables(lengths)
        for batch in batches:
            sizes = batch.column("n_tokens").to_pylist()
            decoded = unpack_bits(
                batch.column("payload").to_pylist(),
                [np.frombuffer(c, "<u8") for c in batch.column("checkpoints").to_pylist()],
                [sum(s) for s in sizes],
                tables,
            )
            for i, ids in enumerate(decoded):
                size = np.array(sizes[i], np.int64)
                ends = np.cumsum(size)
                start = before[batch.column("part")[i].as_py()] + batch.column("first")[i].as_py() + ends - size
                raw = memoryview(ids.astype("<u4").tobytes())
                own = [raw[4 * (e - s) : 4 * e] for s, e in zip(size.tolist(), ends.tolist(), strict=True)]
                columns = {
                    "_id": batch.column("doc_ids")[i].values,
                    "start": pa.array(start),
                    "n_tokens": pa.array(size),
                    "ids_crc32": pa.array([zlib.crc32(x) for x in own], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array([np.frombuffer(x, "<u4").astype(np.int64).tolist() for x in own], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(columns)

    return run


def read_ids(spark: SparkSession, folder: str, id_col: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """Documents back from a folder of :func:`write_ids`.

    Returns the id, start (ids of all documents before it), n_tokens (with the end id), ids_crc32 (unsigned, over
    little-endian unsigned 32-bit ids) and with ``with_ids`` the ids.
    """
    code = spark.read.parquet(f"{folder}/code").collect()  # at most the vocabulary
    lengths = np.zeros(max((r.id for r in code), default=0) + 1, np.uint8)
    for r in code:
        lengths[r.id] = r.bits
    segments = spark.read.parquet(f"{folder}/segments")
    totals = (
        segments.select("part", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
        .groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    )  # one number per part
    before, total = {}, 0
    for r in totals:
        before[r.part] = total
        total += r.n
    names = ("start", "n_tokens", "ids_crc32")
    id_type = segments.schema["doc_ids"].dataType.elementType
    fields = [T.StructField("_id", id_type), *(T.StructField(c, T.LongType()) for c in names)]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))
    return arrow_map(segments, _decode(lengths, before, with_ids), T.StructType(fields)).withColumnRenamed("_id", id_col)
