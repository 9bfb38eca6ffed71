"""Column profiles without shuffling every value: sketches for distinct counts, a proven short cut for top values.

**Distinct counts.** A HyperLogLog sketch of 2**lg_k registers stands for the values of a column on a day. Sketches are
a few kilobytes, are stored, and join without loss: the sketch of a month is the union of its days'. What is shuffled
is sketches, never values. The relative standard error, 1.04 / sqrt(2**lg_k), stands in the result.

**Top values.** Every task counts, for each column, how many values fall into each of ``BUCKETS`` hash buckets. A value
occurs at most as often as its bucket. The values of the fullest buckets are counted exactly; if the k-th of them
occurs more often than any bucket left out is full, no other value can be among the first k, and only few values were
shuffled. Otherwise the buckets that could still hold one are counted too, which for a column without frequent values
means all of it. The result is exact either way, and says which way it took.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medloom.operators.profile import column_ranges, column_texts, null_share
from medloom.sources.shared import written

LG_K = 12
BUCKETS = 1 << 14
FULLEST = 64


def relative_error(lg_k: int = LG_K) -> float:
    """The standard error of a distinct count, relative to it."""
    return round(1.04 / (1 << lg_k) ** 0.5, 6)


def day_sketches(df: DataFrame, day: str | None = None, lg_k: int = LG_K) -> DataFrame:
    """One row per day and column: day, column_name, rows, nulls, sketch. Without ``day`` all rows are one day, NULL."""
    texts = column_texts(df)
    when = F.col(f"`{day}`").cast("date") if day else F.lit(None).cast("date")
    rows = df.select(when.alias("_day"), *[text.alias(f"c{i}") for i, (_, text) in enumerate(texts)])
    parts = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col(f"c{i}").isNull()).alias("nulls"),
            F.hll_sketch_agg(f"c{i}", F.lit(lg_k)).alias("sketch"),
        ).alias(f"s{i}")
        for i, (name, _) in enumerate(texts)
    ]
    wide = rows.groupBy("_day").agg(*parts)
    return wide.select(F.col("_day").alias("day"), F.inline(F.array(*[f"s{i}" for i in range(len(texts))])))


def merged(sketches: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """Sketches of any days as one per column: column_name, rows, nulls, distinct_estimate, relative_error.

    A sketch that was never joined is estimated from the order in which it was filled. Joined once more with itself it
    is estimated from its registers alone, so the answer does not depend on how the rows were split into days.
    """
    whole = F.hll_union_agg("sketch")
    return sketches.groupBy("column_name").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.hll_sketch_estimate(F.hll_union(whole, whole)).alias("distinct_estimate"),
        F.lit(relative_error(lg_k)).alias("relative_error"),
    )


def add_days(df: DataFrame, path: str, day: str, lg_k: int = LG_K) -> None:
    """Append the sketches of the rows' days to a store. Rows of a day may come in several deliveries."""
    day_sketches(df, day, lg_k).write.mode("append").parquet(path)


def stored(df_path: str, spark, since=None, until=None) -> DataFrame:
    """The stored sketches of a range of days, ends included."""
    out = spark.read.schema("day date, column_name string, rows long, nulls long, sketch binary").parquet(df_path)
    if since is not None:
        out = out.filter(F.col("day") >= F.lit(since))
    return out if until is None else out.filter(F.col("day") <= F.lit(until))


def top_values(df: DataFrame, k: int = 5, buckets: int = BUCKETS, fullest: int = FULLEST) -> DataFrame:
    """The k most frequent values of every column: column_no, place, value, freq, counted.

    Ties go to the smaller value; missing values are none. ``counted`` is 'summary' where the fullest buckets were proof
    enough, 'exact' where more values had to be counted. Memory is ``buckets`` numbers a column and task.
    """
    texts = column_texts(df)

    def pairs(numbers: Sequence[int]) -> DataFrame:
        each = [F.struct(F.lit(i).alias("column_no"), texts[i][1].alias("value")) for i in numbers]
        rows = df.select(F.inline(F.array(*each))).filter(F.col("value").isNotNull())
        return rows.select("column_no", F.pmod(F.xxhash64("value"), F.lit(buckets)).cast("int").alias("bucket"), "value")

    def counted(numbers: Sequence[int], wanted: DataFrame) -> DataFrame:
        # at most ``buckets`` rows of two numbers for each column of the schema
        met = pairs(numbers).join(F.broadcast(wanted), ["column_no", "bucket"])
        return met.groupBy("column_no", "value").agg(F.count(F.lit(1)).alias("freq"))

    everything = range(len(texts))
    full = written(pairs(everything).groupBy("column_no", "bucket").agg(F.count(F.lit(1)).alias("n")), "buckets")
    place = F.row_number().over(Window.partitionBy("column_no").orderBy(F.desc("n"), "bucket"))
    ranked = written(full.withColumn("place", place), "ranked")
    best = Window.partitionBy("column_no").orderBy(F.desc("freq"), "value")
    first = written(counted(everything, ranked.filter(F.col("place") <= fullest).select("column_no", "bucket")), "counts")
    last = first.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k).groupBy("column_no").agg(
        F.when(F.count(F.lit(1)) == k, F.min("freq")).otherwise(F.lit(1)).alias("least")
    )
    open_buckets = ranked.filter(F.col("place") > fullest).join(last, "column_no").filter(F.col("n") >= F.col("least")).select("column_no", "bucket")
    more = written(open_buckets, "open")
    again = sorted(r.column_no for r in more.select("column_no").distinct().collect())  # columns of the schema
    counts = first.unionByName(counted(again, more)) if again else first
    way = F.when(F.col("column_no").isin(again), F.lit("exact")).otherwise(F.lit("summary")) if again else F.lit("summary")
    top = counts.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k)
    return top.select("column_no", "place", "value", "freq", way.alias("counted"))


def profile_sketched(df: DataFrame, top_k: int = 5, lg_k: int = LG_K, buckets: int = BUCKETS) -> DataFrame:
    """The profile of every column with distinct counts from sketches and top values by the short cut.

    Columns as in ``profile_columns``, but for distinct_estimate and relative_error in place of distinct_count, and
    ``counted`` (how the top values were found).
    """
    spark = df.sparkSession
    columns = spark.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)], "column_no int, column_name string, data_type string"
    )
    entry = F.concat("value", F.lit(" ("), F.col("freq").cast("string"), F.lit(")")).alias("entry")
    top = top_values(df, top_k, buckets).select("column_no", "place", entry, "counted").groupBy("column_no").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "entry"))), lambda x: x["entry"]), ", ").alias("sample_values"), F.max("counted").alias("counted")
    )
    numbers = merged(day_sketches(df, None, lg_k), lg_k)
    joined = columns.join(numbers, "column_name", "left").join(top, "column_no", "left").join(column_ranges(df), "column_no", "left")
    return joined.select(
        "column_name",
        "data_type",
        F.coalesce("rows", F.lit(0)).alias("sample_rows"),
        F.coalesce("nulls", F.lit(0)).alias("null_count"),
        null_share(F.col("nulls"), F.col("rows")).alias("null_pct"),
        F.coalesce("distinct_estimate", F.lit(0)).alias("distinct_estimate"),
        F.lit(relative_error(lg_k)).alias("relative_error"),
        "min_value",
        "max_value",
        "sample_values",
        F.coalesce("counted", F.lit("summary")).alias("counted"),
    ).orderBy("column_name")
