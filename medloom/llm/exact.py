"""Exact dedup in two passes over a Bloom filter, with DataFrame functions only.

Pass 1 maps each text to a digest, and each digest to ``PROBES`` positions of a bit array; positions that two rows or
more hit are kept, as an array of 64-bit words in one row. Equal digests hit equal positions, so a row that
misses one of its positions has no equal. Pass 2 tests every row in place: rows whose positions are all hit twice are
possibly repeated; only they shuffle, and all others pass straight through as groups of one.

The array has ``BITS_PER_ROW`` bits a row, at most ``MAX_BITS`` (16 MB), which bounds what a task holds. Beyond that
size more rows count as possibly repeated and shuffle, as digests; the result is the same. Groups are formed by a
combining aggregation, so a text that a third of all rows share is one row per task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medloom.sources.shared import written

PROBES = 2
BITS_PER_ROW = 16
MIN_BITS = 1 << 16
MAX_BITS = 1 << 27
#: Text is normalised by turning every run of these into one space: space, tab, LF, VT, FF, CR.
_TO_SPACE = ("\t\n\x0b\x0c\r", "     ")


def normalised(text: Column) -> Column:
    """Text with each run of white space (ASCII) replaced by one space; missing text is empty."""
    return F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), *_TO_SPACE), "  +", " ")


def _positions(digest: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(digest, F.lit(k)), F.lit(bits)) for k in range(PROBES)]


def filter_bits(rows: int) -> int:
    """Size of the filter: a power of two."""
    return min(MAX_BITS, max(MIN_BITS, 1 << (BITS_PER_ROW * max(rows, 1) - 1).bit_length()))


def twice_hit(digests: DataFrame, bits: int) -> DataFrame:
    """One row: the words of a bit array in which positions hit by two rows or more are set, from first to last."""
    positions = digests.select(F.explode(F.array(*_positions(F.col("digest"), bits))).alias("at"))
    often = positions.groupBy("at").agg(F.count("*").alias("n")).filter("n > 1")
    words = (
        often.groupBy(F.shiftright("at", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("set"))
    )
    everything = digests.sparkSession.range(bits >> 6).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("set"))
    full = words.unionByName(everything).groupBy("word").agg(F.bit_or("set").alias("set"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("word", "set"))), lambda x: x["set"])
    return full.agg(ordered.alias("bits"))  # bits / 64 numbers: bounded by MAX_BITS


def possibly_repeated(digest: Column, hit: DataFrame, bits: int) -> Column:
    """Whether all positions of a digest are set in the filter, which tasks hold as one value."""
    out = F.lit(True)
    for p in _positions(digest, bits):
        word = F.element_at(hit.scalar(), (F.shiftright(p, 6) + 1).cast("int"))
        out = out & (F.getbit(word, p.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return out


def _tested(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, Column, Callable[[Column], Column]]:
    """Digests of all rows, the digest expression, and the test for possible repeats."""
    digest = F.sha2(normalised(F.col(f"`{text_col}`").cast("string")), 256)
    digests = written(docs.select(F.col(f"`{id_col}`").alias("_id"), digest.alias("digest")), "digests")
    bits = filter_bits(digests.count())
    hit = written(twice_hit(digests, bits), "bloom")
    return digests, digest, lambda d: possibly_repeated(d, hit, bits)


def _filtered(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, Column, Callable[[Column], Column], DataFrame]:
    """As :func:`_tested`, and the groups of the rows that are possibly repeated."""
    digests, digest, again = _tested(docs, id_col, text_col)
    sizes = (
        digests.filter(again(F.col("digest")))
        .groupBy("digest").agg(F.min("_id").alias("keep_id"), F.count("*").alias("group_size"))
    )
    return digests, digest, again, written(sizes, "groups")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with its group of equal texts: the id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after :func:`normalised`; a missing text is empty. keep_id is the smallest id of
    the group, kept says whether the row has it. Rows that repeat both text and id are kept or dropped together.
    Missing ids come after all others: they are keep_id only where a group has no other. Other columns are
    ignored; an empty table gives an empty table.
    """
    digests, _, again, sizes = _filtered(docs, id_col, text_col)
    alone = digests.filter(~again(F.col("digest"))).select(
        "_id", F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "digest"
    )
    grouped = digests.filter(again(F.col("digest"))).join(sizes, "digest").select("_id", "keep_id", "group_size", "digest")
    return alone.unionByName(grouped).select(
        F.col("_id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("keep_id").eqNullSafe(F.col("_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, without those that :func:`groups` drops.

    Rows that repeat both text and id all stay; :func:`dedup_rows` thins them out too.
    """
    _, digest, again, sizes = _filtered(docs, id_col, text_col)
    repeats = sizes.filter("group_size > 1").select(F.col("digest").alias("_digest"), F.col("keep_id").alias("_keep_id"))
    alone = docs.filter(~again(digest))
    maybe = docs.filter(again(digest))
    beaten = (digest == repeats["_digest"]) & ~maybe[f"`{id_col}`"].eqNullSafe(repeats["_keep_id"])
    return alone.unionByName(maybe.join(repeats, beaten, "left_anti"))


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns that can be hashed, which orders rows that are otherwise equal."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))])


def first_of_each(df: DataFrame, key: Column, *order: Column) -> DataFrame:
    """One row of each key, the first by ``order``. Tasks keep one row a key before the shuffle."""
    place = F.row_number().over(Window.partitionBy("_key").orderBy(*[F.col(f"_order{i}") for i in range(len(order))]))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), key.alias("_key"), *[o.alias(f"_order{i}") for i, o in enumerate(order)])
    return rows.withColumn("_place", place).filter("_place = 1").select("_row.*")


def dedup_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, exactly one of each group of equal texts.

    The smallest id stays, a missing id only where the group has no other; of rows that share the id, one of least hash.
    """
    _, digest, again = _tested(docs, id_col, text_col)
    own = F.col(f"`{id_col}`")
    name = "_digest"
    while name in docs.columns:
        name += "_"
    # a column that is not deterministic, though its value is, is computed once instead of in every place that uses it
    marked = docs.withColumn(name, F.when(F.monotonically_increasing_id() >= 0, digest))
    alone = marked.filter(~again(F.col(name))).drop(name)
    maybe = marked.filter(again(F.col(name)))
    return alone.unionByName(first_of_each(maybe, F.col(name), own.isNull(), own, row_hash(docs)).drop(name))
