"""The registered queries: every operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.llm import bpe, exact, forest, huffman, jaccard, langid, negatives, packing, phrases, quality, repair, suffixes, toxicity
from medloom.llm.checks import CHECKS
from medloom.llm.vocab import public_path
from medloom.sources.shared import new_path
from medloom.sources.tables import table


def op1_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_path("word_bpe_49k.json"), with_ids=False)


def op2_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every 50th vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return forest.search(vectors, vectors.filter("vec_id % 50 = 0"))


def op3_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without passages of 35 words that occur elsewhere."""
    return phrases.remove_passages(table(spark, sf_dir, "documents")).drop("kept")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without strings of 200 bytes that occur elsewhere."""
    return suffixes.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op5_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, written as Huffman codes and read back."""
    folder = new_path(spark, "huffman")
    huffman.write_ids(table(spark, sf_dir, "documents"), folder, public_path("byte_bpe_50k.json"))
    return huffman.read_ids(spark, folder, with_ids=False)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three quarters of them."""
    return langid.identify(table(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingles overlap by 85 percent or more."""
    return jaccard.similar_components(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that are equal up to white space."""
    return exact.groups(table(spark, sf_dir, "documents"))


def op9_quality_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learned from two thirds of the labels."""
    return quality.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of all documents and of the texts decoded from them."""
    return bpe.encode_digests(table(spark, sf_dir, "documents"), public_path("byte_bpe_50k.json"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 50th vector, after every 7th label is moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return negatives.mine(vectors, vectors.filter("vec_id % 50 = 0"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from two thirds of the labels."""
    return toxicity.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation, after some of its rows are damaged."""
    rows = table(spark, sf_dir, "conversations")
    return repair.repair(repair.damage(rows), rows)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_vector_packing": op1_vector_packing,
    "op2_projection_forest": op2_projection_forest,
    "op3_phrase_dedup": op3_phrase_dedup,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_huffman_ids": op5_huffman_ids,
    "op6_language_id": op6_language_id,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_quality_ftrl": op9_quality_ftrl,
    "op10_prefix_bpe": op10_prefix_bpe,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_toxicity": op12_toxicity,
    "op13_conversation_repair": op13_conversation_repair,
}

__all__ = ["CHECKS", "QUERIES"]
