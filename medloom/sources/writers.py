"""Result files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def export_csv(df: DataFrame, path: str) -> None:
    """Write a result as CSV files with a header line, in parallel, one file per partition."""
    df.write.mode("error").option("header", True).csv(path)
