"""Exact removal of repeated byte strings through a range-partitioned suffix array.

Which suffixes: one per anchor whose gram occurs in different surroundings (see ``stretches``); every repeated
window contains such an anchor at the same offset, or lies in a run that is the same everywhere. So the array is
sparse, about one suffix per 80 bytes of possibly repeated text, and still finds every repeated window.

* Spark samples splitters from the suffixes' leading bytes and range-partitions the suffixes by them.
* Every bucket arrives in the order of the grams (Spark sorts it, on disk if need be) and is taken in pieces of whole
  grams, so a task holds one piece and not its bucket. A piece sorts its suffixes, and separately the bytes left of the
  anchors read backwards, by multikey quicksort, all segments in step, and takes the lengths of the prefixes that
  neighbours share.
* Suffixes that share the leading ``gram`` bytes never straddle a splitter, as those bytes are the partitioning
  key, so windows of two buckets, or pieces, differ within their leading bytes; that is the comparison across a boundary.
* For every offset of the anchor in a window, suffixes equal to the right and equal to the left of the anchor have
  the same window. Equality to a depth is a class number, taken from the two arrays, so no pairs are formed.

A gram that occurs in more than ``HOT_RUNS`` runs does not go to one bucket: its windows are dealt out by their
content instead and counted with a combining aggregation (``_hot_ranges``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medloom.llm.mapping import arrow_map
from medloom.llm.stretches import KEYS, covered, hot_grams, keyed, repeated_runs, with_ranges, with_runs

WINDOW = 200
GRAM = 48
#: Rows of one gram above which its windows are counted by content instead of being sorted in one bucket.
HOT_RUNS = 200_000
#: Rows after which a piece of a bucket ends, with the gram it has reached.
PIECE_RUNS = 20_000


def multikey_order(words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Order of byte strings given as rows of big-endian 8-byte characters padded with zero bytes.

    Multikey quicksort: each open segment is split three ways by its middle row's character; the equal part goes on
    with the next character. All open segments are split in the same step, as whole-array operations. Strings that
    differ in trailing zero bytes only are ordered by length.
    """
    n, width = words.shape
    order = np.arange(n)
    if n < 2:
        return order
    start = np.zeros(n, np.int64)  # of the segment that holds each place
    depth = np.zeros(n, np.int64)
    places = np.arange(n)
    while len(places):
        seg = start[places]
        head = np.flatnonzero(np.append(True, seg[1:] != seg[:-1]))
        size = np.diff(np.append(head, len(seg)))
        own = np.repeat(np.arange(len(head)), size)
        level = depth[places]
        rows = order[places]
        chars = words[rows, level]
        pivot = chars[head + size // 2][own]
        part = (chars > pivot).astype(np.int8) + (chars >= pivot).astype(np.int8)
        turn = np.lexsort((part, own))
        part, rows = part[turn], rows[turn]
        order[places] = rows
        level = level + (part == 1)
        depth[places] = level
        fresh = np.append(True, (own[1:] != own[:-1]) | (part[1:] != part[:-1]))
        first = np.flatnonzero(fresh)
        count = np.diff(np.append(first, len(fresh)))
        start[places] = np.repeat(places[first], count)
        still = np.repeat(count > 1, count) & (level < width)
        places = places[still]
    tie = np.ones(n, bool)
    tie[1:] = start[1:] != start[:-1]
    if not tie.all():
        order = order[np.lexsort((lengths[order], start))]
    return order


def shared_prefixes(words: np.ndarray, lengths: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes that each string in ``order`` shares with the one before it; -1 for the first."""
    n, width = words.shape
    out = np.full(n, -1, np.int64)
    if n < 2:
        return out
    left, right = order[:-1], order[1:]
    common = np.zeros(n - 1, np.int64)
    open_ = np.arange(n - 1)
    for j in range(width):
        x = words[left[open_], j] ^ words[right[open_], j]
        zero = np.zeros(len(open_), np.int64)
        for k in range(1, 9):  # leading zero bytes
            zero += x < np.uint64(1) << np.uint64(64 - 8 * k) if k < 8 else x == 0
        common[open_] += zero
        open_ = open_[x == 0]
        if not len(open_):
            break
    out[1:] = np.minimum(common, np.minimum(lengths[left], lengths[right]))
    return out


def _padded(parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    flat = b"".join(p.ljust(width, b"\0") for p in parts)
    words = np.frombuffer(flat, ">u8").reshape(len(parts), width // 8).astype(np.uint64)
    return words, np.array([len(p) for p in parts], np.int64)


def repeated_windows(stretches: list[bytes], offsets: np.ndarray, counts: np.ndarray, window: int, gram: int) -> np.ndarray:
    """For runs of windows, which windows occur more than once: a flag per run and window of the run.

    ``stretches[i]`` holds ``counts[i] + window - 1`` bytes, the anchor lies at ``offsets[i]``. Only runs with the
    same gram at the anchor can share windows. Equal runs are sorted once.
    """
    kinds: dict[tuple[bytes, int], int] = {}
    kind = np.array([kinds.setdefault((s, int(o)), len(kinds)) for s, o in zip(stretches, offsets, strict=True)])
    times = np.bincount(kind, minlength=len(kinds))
    one = np.zeros(len(kinds), np.int64)
    one[kind] = np.arange(len(kind))
    parts = [s for s, _ in kinds]
    high = np.array([o for _, o in kinds], np.int64)  # the anchor's offset in the run's first window
    low = high - counts[one] + 1
    n, deepest = len(parts), window - gram
    room = (window + 8) // 8 * 8
    words, lengths = _padded([s[o : o + window] for s, o in kinds], room)
    right = multikey_order(words, lengths)
    right_shared = shared_prefixes(words, lengths, right)
    words, lengths = _padded([s[:o][::-1] for s, o in kinds], room)
    left = multikey_order(words, lengths)
    left_shared = shared_prefixes(words, lengths, left)
    again = np.zeros((n, deepest + 1), bool)
    right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for d in range(deepest + 1):
        here = np.flatnonzero((low <= d) & (d <= high))
        if not len(here):
            continue
        right_class[right] = np.cumsum(right_shared < window - d)
        left_class[left] = np.cumsum(left_shared < d)
        code = right_class[here] * (n + 1) + left_class[here]
        _, which, many = np.unique(code, return_inverse=True, return_counts=True)
        again[here, d] = (many[which] > 1) | (times[here] > 1)
    return again[kind]


def _emit_stretches(window: int, gram: int) -> Callable:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = batch.column("_id"), batch.column("_hash")
            texts, lists = batch.column("_text").to_pylist(), batch.column("runs").to_pylist()
            for first in range(len(texts)):
                text = texts[first].encode()
                for at in range(0, len(lists[first]), 20_000):
                    runs = lists[first][at : at + 20_000]
                    rows = pa.array([first] * len(runs))
                    yield pa.RecordBatch.from_pydict(
                        {
                            "_id": ids.take(rows),
                            "_hash": hashes.take(rows),
                            "p0": pa.array([r["p0"] for r in runs], pa.int32()),
                            "p1": pa.array([r["p1"] for r in runs], pa.int32()),
                            "anchor": pa.array([r["anchor"] for r in runs], pa.int32()),
                            "lead": pa.array([text[r["anchor"] : r["anchor"] + gram] for r in runs], pa.binary()),
                            "stretch": pa.array([text[r["p0"] : r["p1"] + window] for r in runs], pa.binary()),
                        }
                    )

    return emit


def whole_grams(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.Table]:
    """Rows in the order of ``lead`` as tables of at least ``least`` rows (the last may have fewer), no gram in two of them."""
    held: list[pa.RecordBatch] = []
    rows, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        lead = batch.column("lead")
        if rows + batch.num_rows >= least:
            starts = np.flatnonzero(pc.not_equal(lead[1:], lead[:-1]).to_numpy(zero_copy_only=False)) + 1
            cut = int(starts[-1]) if len(starts) else 0
            if held and (cut or lead[0] != last):
                yield pa.Table.from_batches([*held, batch.slice(0, cut)])
                held, rows, batch = [], 0, batch.slice(cut)
            elif cut:
                yield pa.Table.from_batches([batch.slice(0, cut)])
                batch = batch.slice(cut)
        held.append(batch)
        rows += batch.num_rows
        last = lead[-1]
    if held:
        yield pa.Table.from_batches(held)


def _settle(window: int, gram: int) -> Callable:
    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_grams(batches, PIECE_RUNS):
            p0 = table["p0"].to_numpy().astype(np.int64)
            counts = table["p1"].to_numpy() - p0 + 1
            offsets = table["anchor"].to_numpy() - p0
            again = repeated_windows(table["stretch"].to_pylist(), offsets, counts, window, gram)
            yield from range_batches(table, again, p0, offsets, window)

    return settle


def range_batches(table: pa.Table, again: np.ndarray, p0, offsets, window: int) -> Iterator[pa.RecordBatch]:
    """Covered ranges from flags by run and anchor offset; a window with offset d starts at p0 + offset - d."""
    steps = np.diff(again.astype(np.int8), axis=1, prepend=0, append=0)
    row, first = np.nonzero(steps == 1)
    _, last = np.nonzero(steps == -1)  # one past
    if len(row):
        where = p0[row] + offsets[row]
        take = pa.array(row)
        yield from pa.table(
            {
                "_id": table["_id"].take(take),
                "_hash": table["_hash"].take(take),
                "lo": pa.array((where - last + 1).astype(np.int32)),
                "hi": pa.array((where - first + window).astype(np.int32)),
            }
        ).to_batches()


def _hot_windows(window: int) -> Callable:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (p0, p1, s) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("p0", "p1", "stretch")), strict=True)):
                n = p1 - p0 + 1
                rows = pa.array([i] * n)
                yield pa.RecordBatch.from_pydict(
                    {
                        "_id": batch.column("_id").take(rows),
                        "_hash": batch.column("_hash").take(rows),
                        "lo": pa.array(range(p0, p1 + 1), pa.int32()),
                        "digest": pa.array(
                            [hashlib.blake2b(s[k : k + window], digest_size=16).digest() for k in range(n)], pa.binary()
                        ),
                    }
                )

    return emit


def _hot_ranges(stretches: DataFrame, window: int, range_schema: T.StructType) -> DataFrame:
    """Windows of very frequent grams, counted by content; a content, however frequent, is combined before the shuffle."""
    schema = T.StructType([range_schema["_id"], range_schema["_hash"], range_schema["lo"], T.StructField("digest", T.BinaryType())])
    windows = arrow_map(stretches, _hot_windows(window), schema)
    often = windows.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest")
    return windows.join(often, "digest").select(*KEYS, "lo", (F.col("lo") + window).alias("hi"))


def _strip(as_text: bool = False) -> Callable:
    """What is left of each text, with counts and a digest; or, ``as_text``, only the text without broken characters."""

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept": [], "sha": []}
            for text, found in zip(batch.column("_text").to_pylist(), batch.column("ranges").to_pylist(), strict=True):
                data = np.frombuffer(text.encode(), np.uint8)
                gone = covered(len(data), found)
                kept = data[~gone].tobytes()
                out["n_bytes"].append(len(data))
                out["n_removed"].append(int(gone.sum()))
                out["n_spans"].append(int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()))
                out["kept"].append(kept)
                out["sha"].append(hashlib.sha256(kept).hexdigest())
            rest = {n: batch.column(n) for n in batch.schema.names if n not in ("_text", "ranges")}
            if as_text:
                text = [kept.decode(errors="ignore") for kept in out["kept"]]
                yield pa.RecordBatch.from_pydict(rest | {"text": pa.array(text, pa.string())})
                continue
            yield pa.RecordBatch.from_pydict(
                rest
                | {c: pa.array(out[c], pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")}
                | {"kept": pa.array(out["kept"], pa.binary()), "kept_sha256": pa.array(out["sha"], pa.string())}
            )

    return strip


def repeated_ranges(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot_runs: int = HOT_RUNS) -> tuple[DataFrame, DataFrame]:
    """``docs`` (from ``keyed``) as runs that repeat for sure or by comparison: (runs, settled ranges)."""
    runs = repeated_runs(docs, "byte", window, gram)
    hot = hot_grams(runs, hot_runs)
    id_field = docs.schema["_id"]
    ints = [T.StructField(c, T.IntegerType()) for c in ("p0", "p1", "anchor")]
    schema = T.StructType([id_field, T.StructField("_hash", T.LongType()), *ints, T.StructField("lead", T.BinaryType()), T.StructField("stretch", T.BinaryType())])
    range_schema = T.StructType([id_field, T.StructField("_hash", T.LongType()), T.StructField("lo", T.IntegerType()), T.StructField("hi", T.IntegerType())])
    often = hot.limit(1).count() > 0
    plain = runs
    parts = []
    if often:
        flagged = runs.join(hot, "key", "left")
        plain = flagged.filter("hot is null").drop("hot")
        frequent = arrow_map(with_runs(docs, flagged.filter("hot").drop("hot")), _emit_stretches(window, gram), schema)
        parts.append(_hot_ranges(frequent, window, range_schema))
    stretches = arrow_map(with_runs(docs, plain), _emit_stretches(window, gram), schema)
    parts.append(arrow_map(stretches.repartitionByRange("lead").sortWithinPartitions("lead"), _settle(window, gram), range_schema))
    settled = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return runs, settled


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, hot_runs: int = HOT_RUNS
) -> DataFrame:
    """Remove every byte that a ``window``-byte string covers which also starts anywhere else.

    Returns per row: the id, n_bytes, n_removed, n_spans, kept (binary), kept_sha256. A missing text counts as
    empty; texts shorter than the window stay whole. Rows that repeat both id and text are copies of one another,
    so they lose their windows. A missing id is an id like any other. Other columns are ignored; an empty table
    gives an empty table. Windows are compared as they stand in the input.
    """
    if not gram <= window:
        raise ValueError("the gram must fit into the window")
    rows = keyed(docs, id_col, text_col)
    runs, settled = repeated_ranges(rows, window, gram, hot_runs)
    found = with_ranges(rows, runs, settled, window)
    longs = [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")]
    schema = T.StructType([rows.schema["_id"], T.StructField("_hash", T.LongType()), *longs, T.StructField("kept", T.BinaryType()), T.StructField("kept_sha256", T.StringType())])
    return arrow_map(found, _strip(), schema).withColumnRenamed("_id", id_col).drop("_hash")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, hot_runs: int = HOT_RUNS) -> DataFrame:
    """The rows of ``docs``, with all their columns, each text as :func:`remove_repeats` leaves it.

    Bytes of a character that was cut through are dropped. A missing text comes back empty.
    """
    rows = keyed(docs, id_col, text_col, rest=True)
    runs, settled = repeated_ranges(rows.select("_id", "_hash", "_text"), window, gram, hot_runs)
    found = with_ranges(rows, runs, settled, window).select("_rest", "_text", "ranges")
    whole = arrow_map(found, _strip(as_text=True), T.StructType([rows.schema["_rest"], T.StructField("text", T.StringType())]))
    return whole.select(*[F.col("text").alias(c) if c == text_col else F.col(f"_rest.`{c}`").alias(c) for c in docs.columns])
