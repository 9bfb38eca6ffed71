"""Column profile: one row per column with counts, range and most frequent values.

All columns are profiled together. Every row is turned into (column, text) pairs, counted per pair with
map-side combining, and counts and top values come out of those: one large shuffle for any number of
columns. The top values are cut to a few per task before they are brought together, so no column's values
are ever collected in one place, however many distinct ones there are. Ranges are a second, shuffle-free
aggregate in each column's own type that reads only numeric and date columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def family(kind: T.DataType) -> str:
    """'numeric', 'datetime' or 'other'."""
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return "numeric"
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType, T.TimeType)):
        return "datetime"
    return "other"


def sample_by_key(df: DataFrame, fraction: float, key: Sequence[str]) -> DataFrame:
    """About ``fraction`` of the rows, by a digest of a key.

    The same rows are drawn whatever the file layout. Rows that share a key are kept or left together.
    """
    digest = F.md5(F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key]))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return df.filter(bucket < F.lit(int(2**32 * min(1.0, fraction))))


def _ranged(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    return column.cast("int") if isinstance(field.dataType, T.BooleanType) else column


def _text(field: T.StructField) -> Column:
    return _ranged(field).cast("string")


def column_texts(df: DataFrame) -> list[tuple[str, Column]]:
    """Name and text of each column."""
    return [(f.name, _text(f)) for f in df.schema.fields]


def null_share(nulls: Column, rows: Column) -> Column:
    """Missing values in percent, 0 without rows."""
    share = F.when(rows > 0, nulls * F.lit(100).cast("decimal(3,0)") / F.nullif(rows, F.lit(0)))
    return F.coalesce(share, F.lit(0)).cast("decimal(5,2)")


def column_ranges(df: DataFrame) -> DataFrame:
    """Smallest and greatest value of numeric and date columns in their own type: column_no, min_value, max_value."""
    ranged = [(i, f) for i, f in enumerate(df.schema.fields) if family(f.dataType) != "other"]
    if not ranged:
        return df.sparkSession.createDataFrame([], "column_no int, min_value string, max_value string")
    return df.agg(
        *[
            F.struct(
                F.lit(i).alias("column_no"),
                F.min(_ranged(f)).cast("string").alias("min_value"),
                F.max(_ranged(f)).cast("string").alias("max_value"),
            ).alias(f"c{i}")
            for i, f in ranged
        ]
    ).select(F.inline(F.array(*[f"c{i}" for i, _ in ranged])))


def same_text(counts: DataFrame) -> DataFrame:
    """Counts of texts that are equal but for letter case and trailing spaces, as one; the smallest spelling stands for all."""
    folded = F.collate("value", "UTF8_LCASE_RTRIM").alias("_key")
    return counts.groupBy("column_no", folded).agg(F.sum("freq").alias("freq"), F.min("value").alias("value")).drop("_key")


def profile_columns(
    df: DataFrame,
    top_k: int = 5,
    fraction: float = 1.0,
    sample_key: Sequence[str] = (),
    case_blind: bool = False,
) -> DataFrame:
    """Profile of every column of ``df``, sorted by column name.

    Every row counts, unless the caller asks for a ``fraction`` of them, drawn by ``sample_key``; the fraction is
    reported. With ``case_blind`` texts that differ only in letter case or trailing spaces are one value.
    """
    if fraction < 1.0:
        if not sample_key:
            raise ValueError("a sample needs a key")
        df = sample_by_key(df, fraction, sample_key)
    fields = df.schema.fields
    spark = df.sparkSession
    columns = spark.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(fields)],
        "column_no int, column_name string, data_type string",
    )  # one row per column of the schema
    pairs = df.select(
        F.inline(F.array(*[F.struct(F.lit(i).alias("column_no"), _text(f).alias("value")) for i, f in enumerate(fields)]))
    )
    counts = pairs.groupBy("column_no", "value").agg(F.count(F.lit(1)).alias("freq"))

    if case_blind:
        counts = same_text(counts)
    stats = counts.groupBy("column_no").agg(
        F.sum("freq").alias("sample_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("freq"))), F.lit(0)).alias("null_count"),
        F.count("value").alias("distinct_count"),
    )
    extremes = column_ranges(df)
    # NULL is ranked last and dropped afterwards: a filter on it would be pushed below the counts, and those be made twice
    order = Window.partitionBy("column_no").orderBy(F.col("value").isNull(), F.col("freq").desc(), F.col("value"))
    top = (
        counts.withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= top_k)
        .groupBy("column_no")
        .agg(
            F.array_join(
                F.transform(
                    F.filter(F.sort_array(F.collect_list(F.struct("place", "value", "freq"))), lambda x: x["value"].isNotNull()),
                    lambda x: F.concat(x["value"], F.lit(" ("), x["freq"].cast("string"), F.lit(")")),
                ),
                ", ",
            ).alias("joined")
        )
        .select("column_no", F.nullif("joined", F.lit("")).alias("sample_values"))
    )
    return (
        columns.join(stats, "column_no", "left")
        .join(top, "column_no", "left")
        .join(extremes, "column_no", "left")
        .select(
            "column_name",
            "data_type",
            F.coalesce("sample_rows", F.lit(0)).alias("sample_rows"),
            F.coalesce("null_count", F.lit(0)).alias("null_count"),
            null_share(F.col("null_count"), F.col("sample_rows")).alias("null_pct"),
            F.coalesce("distinct_count", F.lit(0)).alias("distinct_count"),
            "min_value",
            "max_value",
            "sample_values",
            F.lit(float(fraction)).alias("sampled_fraction"),
        )
        .orderBy("column_name")
    )
