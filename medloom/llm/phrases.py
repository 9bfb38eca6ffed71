"""Removal of repeated word passages, located by sharded Aho-Corasick automata.

1. Candidates: runs of 35-word windows whose anchor gram occurs more than once (``stretches``). A run whose gram
   always has the same surroundings is one passage, already confirmed at each of its places.
2. All other runs are dealt by their gram into shards. A shard confirms, gram by gram, which windows recur (equal
   word by word), joins recurring neighbours into passages, compiles the distinct passages into one automaton over
   word numbers (pyahocorasick), and streams every stretch dealt to it through the automaton; each hit marks its
   words.

Every document is streamed, as the stretches of it that hold a repeated gram: a passage can occur nowhere else. So
each word meets the few shards whose passages it may belong to, not all of them, and the work grows with the input
instead of input times shards. An automaton is built for at most ``AUTOMATON_WORDS`` words of stretches; then the
shard goes on with the next one. A gram in more than ``HOT_RUNS`` runs does not go to one shard: its windows are
dealt by their content and counted.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medloom.llm.mapping import arrow_map
from medloom.llm.rolling import chunks, word_layout
from medloom.llm.stretches import KEYS, covered, hot_grams, keyed, repeated_runs, with_ranges, with_runs

WINDOW = 35
GRAM = 8
AUTOMATON_WORDS = 1_000_000
HOT_RUNS = 200_000


def _emit_stretches(window: int) -> Callable:
    """The words of each run, with single spaces, under the run's gram."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode() for t in batch.column("_text").to_pylist()]
            lists = batch.column("runs").to_pylist()
            for first, group in chunks(texts):
                _, starts, _, data, begin, end = word_layout(group)
                whole = data.tobytes()
                for i in range(len(group)):
                    runs = lists[first + i]
                    for at in range(0, len(runs), 20_000):
                        part = runs[at : at + 20_000]
                        rows = pa.array([first + i] * len(part))
                        stretches = []
                        for r in part:
                            a, b = starts[i] + r["p0"], starts[i] + r["p1"] + window
                            stretches.append(b" ".join(whole[begin[a] : end[b - 1]].split()))
                        yield pa.RecordBatch.from_pydict(
                            {
                                "_id": batch.column("_id").take(rows),
                                "_hash": batch.column("_hash").take(rows),
                                "p0": pa.array([r["p0"] for r in part], pa.int32()),
                                "key": pa.array([r["key"] for r in part], pa.int64()),
                                "stretch": pa.array(stretches, pa.binary()),
                            }
                        )

    return emit


def confirmed_passages(stretches: list[tuple[int, ...]], times: list[int], window: int) -> set[tuple[int, ...]]:
    """The maximal recurring passages of stretches that share a gram; ``times`` is how often each stretch occurs."""
    seen: Counter = Counter()
    for s, n in zip(stretches, times, strict=True):
        for k in range(len(s) - window + 1):
            seen[s[k : k + window]] += n
    found = set()
    for s in stretches:
        k, last = 0, len(s) - window
        while k <= last:
            if seen[s[k : k + window]] < 2:
                k += 1
                continue
            first = k
            while k <= last and seen[s[k : k + window]] >= 2:
                k += 1
            found.add(s[first : k - 1 + window])
    return found


def compiled(passages: set[tuple[int, ...]]) -> ahocorasick.Automaton:
    """An automaton over word numbers that reports the length of each passage it meets."""
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for p in passages:
        automaton.add_word(p, len(p))
    automaton.make_automaton()
    return automaton


def located(stretches: list[tuple[int, ...]], automaton: ahocorasick.Automaton) -> list[list[tuple[int, int]]]:
    """Where passages occur in each stretch, as word ranges."""
    return [[(end + 1 - size, end + 1) for end, size in automaton.iter(s)] for s in stretches]


def _shard(window: int, limit: int) -> Callable:
    """Rows arrive sorted by key: grams are confirmed one by one, automata built for many grams together."""

    def settle(ids: dict, passages: set, kinds: dict, rows: list) -> Iterator[pa.RecordBatch]:
        if not passages:
            return
        names = list(kinds)
        hits = located(names, compiled(passages))
        out: dict[str, list] = {"_id": [], "_hash": [], "lo": [], "hi": []}
        for row_id, row_hash, p0, kind in rows:
            for lo, hi in hits[kind]:
                out["_id"].append(row_id)
                out["_hash"].append(row_hash)
                out["lo"].append(p0 + lo)
                out["hi"].append(p0 + hi)
        if out["lo"]:
            yield pa.RecordBatch.from_pydict(
                {
                    "_id": pa.array(out["_id"], ids["type"]),
                    "_hash": pa.array(out["_hash"], pa.int64()),
                    "lo": pa.array(out["lo"], pa.int32()),
                    "hi": pa.array(out["hi"], pa.int32()),
                }
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[bytes, int] = {}
        kinds: dict[tuple[int, ...], int] = {}
        passages: set[tuple[int, ...]] = set()
        rows: list = []
        key, own, words = None, Counter(), 0
        ids = {"type": pa.null()}
        for batch in batches:
            ids["type"] = batch.column("_id").type
            columns = (batch.column(c).to_pylist() for c in ("_id", "_hash", "p0", "key", "stretch"))
            for row_id, row_hash, p0, row_key, stretch in zip(*columns, strict=True):
                if row_key != key:
                    if own:
                        passages |= confirmed_passages(list(own), list(own.values()), window)
                    if words > limit:
                        yield from settle(ids, passages, kinds, rows)
                        numbers, kinds, passages, rows, words = {}, {}, set(), [], 0
                    key, own = row_key, Counter()
                s = tuple([numbers.setdefault(w, len(numbers)) for w in stretch.split(b" ")])
                if s not in own:
                    words += len(s)
                own[s] += 1
                rows.append((row_id, row_hash, p0, kinds.setdefault(s, len(kinds))))
        if own:
            passages |= confirmed_passages(list(own), list(own.values()), window)
        yield from settle(ids, passages, kinds, rows)

    return run


def _hot_windows(window: int) -> Callable:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (p0, stretch) in enumerate(zip(batch.column("p0").to_pylist(), batch.column("stretch").to_pylist(), strict=True)):
                words = stretch.split(b" ")
                n = len(words) - window + 1
                rows = pa.array([i] * n)
                digests = [hashlib.blake2b(b" ".join(words[k : k + window]), digest_size=16).digest() for k in range(n)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "_id": batch.column("_id").take(rows),
                        "_hash": batch.column("_hash").take(rows),
                        "lo": pa.array(range(p0, p0 + n), pa.int32()),
                        "digest": pa.array(digests, pa.binary()),
                    }
                )

    return emit


def _hot_ranges(stretches: DataFrame, window: int, range_schema: T.StructType) -> DataFrame:
    schema = T.StructType([*range_schema.fields[:3], T.StructField("digest", T.BinaryType())])
    windows = arrow_map(stretches, _hot_windows(window), schema)
    often = windows.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest")
    return windows.join(often, "digest").select(*KEYS, "lo", (F.col("lo") + window).alias("hi"))


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t.encode() for t in batch.column("_text").to_pylist()]
        found = batch.column("ranges").to_pylist()
        out: dict[str, list] = {"n_words": [], "n_removed": [], "kept": [], "sha": []}
        for first, group in chunks(texts):
            _, starts, ends, data, begin, end = word_layout(group)
            for i in range(len(group)):
                lo, hi = starts[i], ends[i]
                gone = covered(hi - lo, found[first + i])
                base = begin[lo] if hi > lo else 0
                chars = data[base : end[hi - 1]] if hi > lo else data[:0]
                if gone.any():
                    steps = np.zeros(len(chars) + 1, np.int32)
                    np.add.at(steps, begin[lo:hi][gone] - base, 1)
                    np.subtract.at(steps, end[lo:hi][gone] - base, 1)
                    chars = chars[np.cumsum(steps[:-1]) == 0]
                kept = b" ".join(chars.tobytes().split())
                out["n_words"].append(int(hi - lo))
                out["n_removed"].append(int(gone.sum()))
                out["kept"].append(kept.decode())
                out["sha"].append(hashlib.sha256(kept).hexdigest())
        rest = {n: batch.column(n) for n in batch.schema.names if n not in ("_text", "ranges")}
        yield pa.RecordBatch.from_pydict(
            rest
            | {c: pa.array(out[c], pa.int64()) for c in ("n_words", "n_removed")}
            | {"kept": pa.array(out["kept"], pa.string()), "kept_sha256": pa.array(out["sha"], pa.string())}
        )


def remove_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    hot_runs: int = HOT_RUNS,
    automaton_words: int = AUTOMATON_WORDS,
) -> DataFrame:
    """Remove every word that a window of ``window`` words covers whose words also start anywhere else.

    Words are separated by space, tab, line feed, vertical tab, form feed and carriage return. Returns per row: the
    id, n_words, n_removed, kept (remaining words joined by one space), kept_sha256. A missing or empty text has no
    words; texts shorter than the window stay whole. Rows that repeat both id and text are copies of one another.
    A missing id is an id like any other. Other columns are ignored; an empty table gives an empty table. Windows
    are judged on the input, not on what is left.
    """
    if not gram <= window:
        raise ValueError("the gram must fit into the window")
    rows = keyed(docs, id_col, text_col)
    runs = repeated_runs(rows, "word", window, gram)
    head = [rows.schema["_id"], T.StructField("_hash", T.LongType())]
    schema = T.StructType([*head, T.StructField("p0", T.IntegerType()), T.StructField("key", T.LongType()), T.StructField("stretch", T.BinaryType())])
    range_schema = T.StructType([*head, T.StructField("lo", T.IntegerType()), T.StructField("hi", T.IntegerType())])
    hot = hot_grams(runs, hot_runs)
    plain, parts = runs, []
    if hot.limit(1).count():
        flagged = runs.join(hot, "key", "left")
        plain = flagged.filter("hot is null").drop("hot")
        frequent = arrow_map(with_runs(rows, flagged.filter("hot").drop("hot")), _emit_stretches(window), schema)
        parts.append(_hot_ranges(frequent, window, range_schema))
    stretches = arrow_map(with_runs(rows, plain), _emit_stretches(window), schema)
    dealt = stretches.repartition("key").sortWithinPartitions("key")
    parts.append(arrow_map(dealt, _shard(window, automaton_words), range_schema))
    settled = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    found = with_ranges(rows, runs, settled, window)
    out = T.StructType(
        [*head, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType()), T.StructField("kept_sha256", T.StringType())]
    )
    return arrow_map(found, _strip, out).withColumnRenamed("_id", id_col).drop("_hash")
