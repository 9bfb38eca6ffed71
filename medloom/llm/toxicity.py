"""Toxicity: two Kneser-Ney models of the characters of words, one of toxic documents and one of ordinary ones.

A document counts each of its distinct words once, for its class, so neither a rant nor many copies of a line weigh more
than a document. The words' counts give those of every character with its up to seven characters before it.
Both classes discount their own counts and give what is saved to one shared lower order: continuation counts (in how many
different contexts a character follows), pooled over the classes. What neither class has seen therefore says nothing,
and what is rare says little. The lower order cancels wherever a pair is unseen, so the ratio of the two likelihoods
of any text is a sum over its characters of numbers for (context, character) and for contexts: the model is one table of them.

A document is compared by its log-likelihood ratio per character, and by that of its worst word. Two weights and a bias
turn these into a chance; they are fitted on at most ``FIT_ROWS`` documents of the fifth of the labelled ones that is
kept out of the counts. Counts cover all other labelled documents and every text is scored whole.

The table is held by every task if it has at most ``HELD_ROWS`` rows (12 bytes each). A larger one is sorted and
laid out in two files that Spark copies to every machine once and its tasks map, so no task holds it. Either way texts are
scored where they are read: neither they nor their words are shuffled or written, however large the table.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medloom.llm.langid import fold
from medloom.llm.mapping import arrow_map
from medloom.llm.rolling import mix, prefix_sums, ranges, stretch_hash
from medloom.sources.shared import written, written_alone

#: Characters of context, and of the pieces in which longer words are read.
CONTEXT, PIECE = 7, 32
DISCOUNT = 0.75
KEPT_OUT = 5
FIT_ROWS = 8_000
HELD_ROWS = 4_000_000
LEAST_SCORE = 0.7
#: Weight of a document's ratio, of its worst word's ratio, and bias, before any labelled document is seen.
PRIOR = np.array([0.0, 1.0, -4.0])
U = np.uint64


def words_of(text: Column) -> Column:
    """Runs of letters and digits in lower case, in pieces of at most 32 characters; none without text."""
    return F.regexp_extract_all(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(rf"[\p{{L}}\p{{N}}]{{1,{PIECE}}}"), F.lit(0))


def _grams(words: DataFrame) -> DataFrame:
    """Every character of the words ``w``, end mark included, with the characters before it, start mark included: h, c."""
    at = "sequence(2, length(w) + 2)"
    gram = f"struct(substring(s, greatest(1, i - {CONTEXT}), least({CONTEXT}, i - 1)) as h, substring(s, i, 1) as c)"
    marked = words.withColumn("s", F.concat(F.lit("<"), "w", F.lit(">")))
    return marked.withColumn("gram", F.explode(F.expr(f"transform({at}, i -> {gram})"))).select("gram.*", *words.columns)


def table_of(counted: DataFrame) -> DataFrame:
    """The model from words ``w`` with counts of toxic and ordinary documents: kind (0 context, 1 with character), key, value.

    A text's log-likelihood ratio is the sum of the values of all its contexts and of all its pairs; missing ones are 0.
    """
    pairs = written_alone(_grams(counted).groupBy("h", "c").agg(F.sum("toxic").alias("t"), F.sum("ordinary").alias("o")), "grams")
    held = F.lit(DISCOUNT)
    contexts = pairs.groupBy("h").agg(
        F.sum("t").alias("ht"), F.sum("o").alias("ho"), (held * F.count_if(F.col("t") > 0)).alias("kt"), (held * F.count_if(F.col("o") > 0)).alias("ko")
    )
    contexts = written(contexts, "contexts")
    shorter = F.expr("substring(h, 2)").alias("g")
    follow = written_alone(pairs.groupBy(shorter, "c").agg(F.count("*").alias("k")), "continuations")
    around = follow.groupBy("g").agg(F.sum("k").alias("all"), F.count("*").alias("kinds"))
    single = written(follow.groupBy("c").agg(F.count("*").alias("u")), "characters")
    total = single.agg(F.coalesce(F.sum("u"), F.lit(0)).alias("us"), F.count("*").alias("vs")).first()
    base = single.select("c", ((F.col("u") + 1) / (total.us + total.vs + 1)).alias("p0"))
    low = (F.col("k") - held + held * F.col("kinds") * F.col("p0")) / F.col("all")
    shared = written_alone(follow.join(around, "g").join(base, "c").select("g", "c", low.alias("low")), "shared")

    def chance(n: str, seen: str, left: str) -> Column:
        own = (F.greatest(F.col(n) - held, F.lit(0.0)) + F.col(left) * F.col("low")) / F.nullif(F.col(seen), F.lit(0))
        return F.coalesce(own, F.col("low"))

    unseen = F.log(F.coalesce(F.col("kt") / F.nullif(F.col("ht"), F.lit(0)), F.lit(1.0))) - F.log(F.coalesce(F.col("ko") / F.nullif(F.col("ho"), F.lit(0)), F.lit(1.0)))
    seen = F.log(chance("t", "ht", "kt")) - F.log(chance("o", "ho", "ko"))
    joined = pairs.select("h", "c", "t", "o", shorter).join(shared, ["g", "c"]).join(contexts, "h")
    known = joined.select(F.lit(1).alias("kind"), F.concat("h", "c").alias("key"), (seen - unseen).alias("value"))
    return written_alone(known.unionByName(contexts.select(F.lit(0).alias("kind"), F.col("h").alias("key"), unseen.alias("value"))), "toxicity")


def _keys(points: np.ndarray, start: np.ndarray, end: np.ndarray, kind: np.ndarray | int) -> np.ndarray:
    sums = prefix_sums(mix(points.astype(U) + U(1)))
    return mix(stretch_hash(sums, start, end) + (end - start).astype(U) * U(0x9E3779B97F4A7C15) + np.asarray(kind).astype(U))


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32), lengths


def _hash_table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        points, lengths = _points(batch.column("key").to_pylist())
        ends = np.cumsum(lengths)
        keys = _keys(points, ends - lengths, ends, batch.column("kind").to_numpy())
        yield pa.RecordBatch.from_pydict({"key": pa.array(keys.view(np.int64)), "value": pa.array(batch.column("value").to_numpy().astype(np.float32))})


class Held:
    """The model's table, by hash; ``keys`` ascend, as signed numbers."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values

    def find(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys))
        asked, back = np.unique(keys.view(np.int64), return_inverse=True)  # in order, so the search goes through the table once
        at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        return np.where(self.keys[at] == asked, self.values[at], 0.0).astype(np.float64)[back]

    def ratios(self, words: list[str]) -> np.ndarray:
        """Log-likelihood ratio of each word."""
        if not words:
            return np.zeros(0)
        points, lengths = _points([f"<{w}>" for w in words])
        starts = np.cumsum(lengths) - lengths
        at = ranges(starts + 1, lengths - 1)
        since = np.maximum(np.repeat(starts, lengths - 1), at - CONTEXT)
        found = self.find(_keys(points, since, at + 1, 1)) + self.find(_keys(points, since, at, 0))
        return np.add.reduceat(found, np.cumsum(lengths - 1) - (lengths - 1))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = (batch.column("key").to_numpy().astype(np.int64).tobytes(), batch.column("value").to_numpy().astype(np.float32).tobytes())
        yield pa.RecordBatch.from_pydict({n: pa.array([v], pa.binary()) for n, v in zip(("keys", "values"), both, strict=True)})


#: Folders of laid out tables; each goes when the driver ends, as tasks may ask for the files until then.
_FOLDERS: list[tempfile.TemporaryDirectory] = []


def _laid_out(hashed: DataFrame) -> Callable[[], Held]:
    """What maps the rows key, value in a task, from files on the task's machine. The driver holds a partition at a time.

    The files, 12 bytes a row, stay on the machines until the application ends.
    """
    _FOLDERS.append(tempfile.TemporaryDirectory(prefix="medloom-"))
    mark = uuid.uuid4().hex
    names = [f"toxicity-{mark}.{n}" for n in ("keys", "values")]
    paths = [os.path.join(os.path.realpath(_FOLDERS[-1].name), n) for n in names]
    rows = arrow_map(hashed.orderBy("key", "value"), _packed, "keys binary, values binary")
    with open(paths[0], "wb") as keys, open(paths[1], "wb") as values:
        for k, v in rows.toLocalIterator():
            keys.write(k)
            values.write(v)
    for path in paths:
        hashed.sparkSession.sparkContext.addFile(path)

    def load() -> Held:
        return Held(*(np.asarray(np.memmap(SparkFiles.get(n), kind, "r")) for n, kind in zip(names, (np.int64, np.float32), strict=True)))

    return load


def model_of(table: DataFrame, held_rows: int = HELD_ROWS) -> Callable[[], Held]:
    """What gives a task the model."""
    hashed = arrow_map(table, _hash_table, "key long, value float")
    if table.count() > held_rows:
        return _laid_out(hashed)
    both = hashed.toArrow()  # 12 bytes a row, at most ``held_rows``
    keys, values = (both.column(n).to_numpy() for n in ("key", "value"))
    order = np.argsort(keys, kind="stable")
    held = Held(keys[order], values[order])
    return lambda: held


def _features(model: Callable[[], Held]) -> Callable:
    """Adds ratio (per character of a text's words) and worst (of one word); both 0 without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = model()
        for batch in batches:
            column = batch.column("words")
            count = pc.list_value_length(column).to_numpy(zero_copy_only=False)
            ratio, worst = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            coded = column.flatten().dictionary_encode()
            if len(coded):
                words = coded.dictionary.to_pylist()
                index = coded.indices.to_numpy()
                value = held.ratios(words)[index]
                size = np.fromiter(map(len, words), np.int64, len(words))[index] + 1
                some = np.flatnonzero(count)
                first = (np.cumsum(count) - count)[some]
                ratio[some] = np.add.reduceat(value, first) / np.add.reduceat(size, first)
                worst[some] = np.maximum.reduceat(value, first)
            kept = {n: batch.column(n) for n in batch.schema.names if n != "words"}
            yield pa.RecordBatch.from_pydict(kept | {"ratio": pa.array(ratio), "worst": pa.array(worst)})

    return run


def _with_features(rows: DataFrame, model: Callable[[], Held]) -> DataFrame:
    kept = [rows.schema[c] for c in rows.columns if c != "words"]
    schema = T.StructType([*kept, T.StructField("ratio", T.DoubleType()), T.StructField("worst", T.DoubleType())])
    return arrow_map(rows, _features(model), schema)


def features(rows: DataFrame, table: DataFrame, held_rows: int = HELD_ROWS) -> DataFrame:
    """The columns of ``rows``, but for their ``words``, with ratio and worst."""
    return _with_features(rows, model_of(table, held_rows))


def fit(ratio: np.ndarray, worst: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Two weights and a bias by Newton's method, drawn to ``PRIOR`` as if by a few documents."""
    x = np.stack([100 * ratio, worst, np.ones(len(ratio))], axis=1)
    w = PRIOR.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(3), x.T @ (label - p) - (w - PRIOR))
        w = w + step * min(1.0, 2.0 / max(1e-12, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-9:
            break
    return w


def rate(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    parts: int = 3,
    held: int = 1,
    least: float = LEAST_SCORE,
    held_rows: int = HELD_ROWS,
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """Per row: the id, held_out, score (0 to 1, higher: toxic likelier), predicted (score >= ``least``).

    A row is held out when crc32 of its id modulo ``parts`` is ``held``; rows without id are neither held out nor
    learned from. Labels other than 0 and 1 are ignored; a document with both counts for both. A missing text
    is empty; texts without letters or digits get the score of no evidence. Without documents of both labels every
    score is 0.5. Repeated rows of an id each count, each is scored. Other columns are ignored; an empty table gives an empty table.
    """
    side = fold(id_col, parts)
    own = F.col(f"`{id_col}`")
    known = labels.filter(own.isNotNull() & (side != held)).select(own.alias("_id"), F.col(f"`{label_col}`").cast("int").alias("label")).filter("label in (0, 1)").distinct()
    texts = docs.filter(own.isNotNull() & (side != held)).select(own.alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    sample = texts.join(known, "_id").select("_id", "label", words_of(F.col("_text")).alias("words"))
    sample = written_alone(sample, "labelled")
    apart = F.pmod(F.xxhash64("_id"), F.lit(KEPT_OUT)) == 0
    once = sample.filter(~apart).select("label", F.explode(F.array_distinct("words")).alias("w"))
    counted = written_alone(once.groupBy("w").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("ordinary")), "counted")
    rows = docs.select(own.alias("_id"), F.coalesce(side == held, F.lit(False)).alias("held_out"), words_of(F.col(f"`{text_col}`")).alias("words"))
    seen = counted.agg(F.coalesce(F.sum("toxic"), F.lit(0)).alias("t"), F.coalesce(F.sum("ordinary"), F.lit(0)).alias("o")).first()
    if not seen.t or not seen.o:
        found = rows.select("_id", "held_out", F.lit(0.5).alias("score"))
    else:
        model = model_of(table_of(counted), held_rows)
        drawn = sample.filter(apart).orderBy(F.xxhash64("_id"), "_id", "label").limit(fit_rows)
        seen = _with_features(drawn, model).select("ratio", "worst", "label").toArrow()  # at most ``fit_rows``
        a, b, c = fit(*(seen.column(n).to_numpy().astype(np.float64) for n in ("ratio", "worst", "label"))).tolist()
        chance = 1 / (1 + F.exp(-(a * 100 * F.col("ratio") + b * F.col("worst") + c)))
        found = _with_features(rows, model).select("_id", "held_out", chance.alias("score"))
    return found.select(F.col("_id").alias(id_col), "held_out", "score", (F.col("score") >= least).cast("int").alias("predicted"))
