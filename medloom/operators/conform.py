"""Conformance: standardized values to shared ones through lookup maps."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.sources.shared import written

UNMAPPED = "Unmapped"


def map_frame(spark: SparkSession, pairs: Mapping[str, str]) -> DataFrame:
    """A lookup map written out in code."""
    return spark.createDataFrame(list(pairs.items()), "source_value string, standard_value string")


def lookup_side(lookup: DataFrame) -> DataFrame:
    """The map with one row per source value, written once.

    Whether it is broadcast follows from its bytes. Where it is not, adaptive execution splits the partitions of
    very frequent or missing values, which it could not if the map were still to be aggregated.
    """
    single = lookup.filter(F.col("source_value").isNotNull()).groupBy("source_value").agg(
        F.min("standard_value").alias("standard_value")
    )
    return written(single, "lookup")


def conform_column(df: DataFrame, column: str, lookup: DataFrame, alias: str) -> DataFrame:
    """Add ``alias``: the mapped value, 'Unmapped' where the map has none, NULL where the value is missing.

    The map has one row per source value, so the left join keeps the row count.
    """
    side = lookup_side(lookup).select(
        F.col("source_value").alias(column), F.col("standard_value").alias(alias)
    )
    joined = df.join(side, column, "left")
    value = F.when(F.col(column).isNotNull(), F.coalesce(F.col(alias), F.lit(UNMAPPED)))
    return joined.select(*df.columns, value.alias(alias))


def conform(df: DataFrame, maps: Mapping[str, DataFrame]) -> DataFrame:
    """Add a ``<column>_conformed`` column for each mapped column."""
    for column, lookup in maps.items():
        df = conform_column(df, column, lookup, f"{column}_conformed")
    return df


def unmapped_counts(conformed: DataFrame, columns: list[str]) -> DataFrame:
    """Per mapped column: rows with a value, and rows whose value the map lacks. One aggregate."""
    wide = conformed.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(c).alias("rows_with_value"),
                F.count_if(F.col(f"{c}_conformed") == UNMAPPED).alias("unmapped"),
            ).alias(c)
            for c in columns
        ]
    )
    return wide.select(F.inline(F.array(*columns)))
