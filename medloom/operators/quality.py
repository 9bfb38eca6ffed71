"""Guards that run before measures are computed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.sources.shared import written


def dup_key_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count. Empty means a join on them cannot fan out."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def exclude_rows(
    df: DataFrame, deleted: Column | None = None, test_keys: DataFrame | None = None, key: str | None = None
) -> DataFrame:
    """Leave out soft-deleted rows and rows of listed test keys; rows without a key stay.

    The keys are joined as they are: an aggregate between would keep adaptive execution from splitting the
    partition of a key with very many rows.
    """
    if deleted is not None:
        df = df.filter(~F.coalesce(deleted, F.lit(False)))
    if test_keys is not None:
        df = df.join(test_keys.select(key), key, "left_anti")
    return df


def with_match(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in ``other``. Adaptive execution splits a key with very many rows of ``df``."""
    return df.join(other.select(key), key, "left_semi")


def latest_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` columns per key; further columns break ties.

    A combining ``max`` of a struct instead of a window: each task keeps one row per key before the shuffle,
    so a key with a third of all rows is reduced where it lies.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    best = F.max(F.struct(*order, *rest)).alias("best")
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(best).select(
        *[F.col(key) if c == key else F.col(f"best.{c}").alias(c) for c in df.columns]
    )


def refresh_latest(path: str, updates: DataFrame, key: str, order: Sequence[str], buckets: int = 64) -> None:
    """Bring a table of latest rows up to date, rewriting only the buckets the updates touch.

    The table is partitioned by a bucket of the key. The merged rows are written beside the table first, so the rows that
    are put in place don't depend on those they replace; the replacement itself is one overwrite of the buckets, which
    readers may see half done. ``dimension`` keeps versions instead, and writes changed rows only.
    """
    spark = updates.sparkSession
    bucket = F.pmod(F.hash(F.col(key)), F.lit(buckets)).alias("bucket")
    fresh = written(latest_per_key(updates, key, order).select("*", bucket), "latest-updates")
    try:
        present = spark.read.parquet(path)
    except Exception as error:  # the first run finds no table
        if "PATH_NOT_FOUND" not in str(error):
            raise
        fresh.repartition("bucket").write.partitionBy("bucket").parquet(path)
        return
    touched = [r.bucket for r in fresh.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
    old = present.filter(F.col("bucket").isin(touched)).select(*fresh.columns)
    merged = latest_per_key(old.unionByName(fresh).drop("bucket"), key, order).select("*", bucket)
    (
        written(merged, "latest")
        .repartition("bucket")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("bucket")
        .parquet(path)
    )
