"""A corpus from documents to training sequences: five stages, each written as Parquet before the next.

Every stage takes (spark, docs, sf_dir) and returns the columns of documents, the last one pieces of sequences. A
stage works on all rows that the one before kept.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.llm import exact, jaccard, langid, packing, suffixes
from medloom.llm.vocab import public_path
from medloom.sources.shared import written
from medloom.sources.tables import table

#: Documents whose family or language is less sure than this (it loses to another one) go, as do those without any letter.
LEAST_SCORE = 0.5

#: Workers hold what earlier stages have left as well, so they remember fewer words than by default, and cut less text at once.
KEPT_PIECES = 100_000
COLUMN_CHARS = 1 << 19


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised. Learned from documents outside the held-out quarter.

    Where these teach nothing, all documents with a letter stay.
    """
    model = langid.train(docs.filter(langid.fold("doc_id", 4) != 2))
    if not model:
        return docs.filter(F.col("text").cast("string").rlike(r"\p{L}"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("text").alias("_text"))
    found = langid.predict(rows, model, "_text", ("_row",), np.minimum)
    sure = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return found.filter(sure).select("_row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group that is equal up to white space, whether ids repeat, are missing or differ."""
    return exact.dedup_rows(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of rows whose shingles of five words overlap by 80 percent or more."""
    return jaccard.dedup_rows(docs, words=5, percent=80)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 200-byte strings that occur elsewhere; n_chars follows the text."""
    left = suffixes.dedup(docs)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else left


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens, with their ids."""
    return packing.pack(docs, public_path("word_bpe_49k.json"), kept_pieces=KEPT_PIECES, column_chars=COLUMN_CHARS)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("suffix_dedup", suffix_dedup),
    ("packing", pack),
]

#: Learned language models and tokenizers have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
