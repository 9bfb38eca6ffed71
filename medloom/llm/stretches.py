"""Finding the stretches of documents in which a window of N tokens may occur twice.

Shared by the two substring operators. Equal windows share the gram at their anchor (``rolling.anchored_runs``), so
one combining aggregation over anchor grams, of 24 bytes an anchor, tells which runs of windows can repeat at all:

* a gram that occurs once: nothing in its run repeats;
* a gram whose runs all have the same content: every window of them repeats, whatever their number;
* a gram with runs of different content: these go on to the operator, with their text.

A gram frequent in any number of rows is combined before the shuffle. The table of repeated grams is written before
it is joined, so that adaptive execution can split the partition of a frequent gram.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medloom.llm.mapping import arrow_map
from medloom.llm.rolling import (
    BYTE_TOKENS,
    BYTE_TOKENS_2,
    SECOND,
    anchored_runs,
    byte_layout,
    chunks,
    mix,
    word_layout,
)
from medloom.sources.shared import written

KEYS = ("_id", "_hash")


def keyed(docs: DataFrame, id_col: str, text_col: str, rest: bool = False) -> DataFrame:
    """Id and text under names of our own, with a hash that tells apart rows that share an id.

    With ``rest`` also all columns but the text, as one value.
    """
    columns = [F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("_text")]
    if rest:
        columns.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("_rest"))
    kept = ("_rest",) if rest else ()
    return docs.select(*columns).select("_id", F.xxhash64("_id", "_text").alias("_hash"), "_text", *kept)


def same_row(left: DataFrame, right: DataFrame):
    """Join condition on the two key columns; a missing id equals a missing id."""
    return left["_id"].eqNullSafe(right["_id"]) & (left["_hash"] == right["_hash"])


def _layout(texts: list[bytes], unit: str):
    if unit == "byte":
        data, starts, ends = byte_layout(texts)
        return BYTE_TOKENS[data], BYTE_TOKENS_2[data], starts, ends
    tokens, starts, ends, *_ = word_layout(texts)
    return tokens, mix(tokens + SECOND), starts, ends


def _emit_runs(unit: str, window: int, gram: int, full: bool) -> Callable:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode() for t in batch.column("_text").to_pylist()]
            for first, group in chunks(texts):
                tokens, second, starts, ends = _layout(group, unit)
                doc, p0, p1, anchor, key, whole = anchored_runs(tokens, second, starts, ends, window, gram)
                if not len(doc):
                    continue
                columns = {"key": pa.array(key.view(np.int64)), "whole": pa.array(whole.view(np.int64))}
                if full:
                    rows = pa.array(doc + first)
                    base = starts[doc]
                    columns = {
                        "_id": batch.column("_id").take(rows),
                        "_hash": batch.column("_hash").take(rows),
                        "p0": pa.array((p0 - base).astype(np.int32)),
                        "p1": pa.array((p1 - base).astype(np.int32)),
                        "anchor": pa.array((anchor - base).astype(np.int32)),
                        "key": columns["key"],
                    }
                yield pa.RecordBatch.from_pydict(columns)

    return emit


def repeated_runs(docs: DataFrame, unit: str, window: int, gram: int) -> DataFrame:
    """Runs of windows whose anchor gram occurs more than once: _id, _hash, p0, p1, anchor, key, mixed.

    ``docs`` comes from :func:`keyed`; ``unit`` is ``byte`` or ``word``. Windows start at p0 to p1 (token numbers in
    the document). ``mixed`` is false where all runs of the gram have the same content. Written to the shared folder.
    """
    light = arrow_map(docs.select("_text"), _emit_runs(unit, window, gram, False), "key long, whole long")
    repeated = written(
        light.groupBy("key")
        .agg(F.count("*").alias("n"), F.min("whole").alias("lo"), F.max("whole").alias("hi"))
        .filter("n > 1")
        .select("key", (F.col("lo") != F.col("hi")).alias("mixed")),
        "grams",
    )
    schema = T.StructType(
        [docs.schema["_id"], T.StructField("_hash", T.LongType())]
        + [T.StructField(c, T.IntegerType()) for c in ("p0", "p1", "anchor")]
        + [T.StructField("key", T.LongType())]
    )
    runs = arrow_map(docs, _emit_runs(unit, window, gram, True), schema)
    return written(runs.join(repeated, "key").select("_id", "_hash", "p0", "p1", "anchor", "key", "mixed"), "runs")


def hot_grams(runs: DataFrame, limit: int) -> DataFrame:
    """Grams of more than ``limit`` mixed runs. Written, so that a join to it can split such a gram's rows."""
    counts = runs.filter("mixed").groupBy("key").agg(F.count("*").alias("n"))
    return written(counts.filter(F.col("n") > limit).select("key", F.lit(True).alias("hot")), "hot")


def with_runs(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """Documents that have mixed runs, each with the list of them (at most as long as the document)."""
    listed = (
        runs.filter("mixed")
        .groupBy(*KEYS)
        .agg(F.collect_list(F.struct("p0", "p1", "anchor", "key")).alias("runs"))
    )
    return docs.join(listed, same_row(docs, listed)).select(docs["_id"], docs["_hash"], docs["_text"], "runs")


def with_ranges(docs: DataFrame, runs: DataFrame, settled: DataFrame, window: int) -> DataFrame:
    """All documents, each with its list of covered token ranges (lo, hi); ``settled`` has those of the mixed runs."""
    sure = runs.filter("not mixed").select(*KEYS, F.col("p0").alias("lo"), (F.col("p1") + window).alias("hi"))
    listed = (
        sure.unionByName(settled).groupBy(*KEYS).agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    )
    return docs.join(listed, same_row(docs, listed), "left").select(*[docs[c] for c in docs.columns], listed["ranges"])


def covered(size: int, ranges: list[dict] | None) -> np.ndarray:
    """A flag per token: inside any of the ranges."""
    steps = np.zeros(size + 1, np.int32)
    if ranges:
        np.add.at(steps, [r["lo"] for r in ranges], 1)
        np.subtract.at(steps, [r["hi"] for r in ranges], 1)
    return np.cumsum(steps[:size]) > 0
