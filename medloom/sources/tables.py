"""Reading source tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Parquet, so filters and column choices reach the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_text_csv(spark: SparkSession, path: str, columns: Sequence[str], **options: str) -> DataFrame:
    """CSV with a header, every column as text. No inference, so the files are read once."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).options(header=True, **options).csv(path)


def all_text(df: DataFrame) -> DataFrame:
    """Every column as text, whatever its type: the form the standardization jobs expect."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def publish_views(frames: dict[str, DataFrame]) -> None:
    """Register each DataFrame as a temporary view of the given name."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
