"""Latest run figures per object from a log of executed queries."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _milliseconds(micros: Column) -> Column:
    return F.floor(micros / 1000).cast("bigint")


def _part(label: str, value: Column) -> Column:
    return F.concat(F.lit(f"{label}="), F.coalesce(value.cast("string"), F.lit("NULL")))


def named_objects(query_text: Column, longest: Column, lengths: Column) -> Column:
    """The texts of the given lengths that a query text, in lower case, names: in a '/*bench...;obj:<name>*/' comment or
    after FROM, where any text that begins there counts. One regular expression each finds the places, whatever the
    number of objects; ``longest`` is the largest of ``lengths``."""
    text = F.lower(query_text)

    def after(mark: str, more: int) -> Column:
        shape = F.concat(F.lit(f"(?s){mark}(?=(.{{0,"), (longest + more).cast("string"), F.lit("}))"))
        return F.regexp_extract_all(text, shape, F.lit(1))

    def cuts(tails: Column, follows: Callable[[Column, Column], Column]) -> Column:
        return F.flatten(F.transform(tails, lambda tail: F.transform(F.filter(lengths, lambda n: follows(tail, n)), lambda n: F.substring(tail, F.lit(1), n))))

    commented = cuts(after(";obj:", 2), lambda tail, n: F.substring(tail, n + 1, F.lit(2)) == "*/")
    selected = cuts(after("from ", 0), lambda tail, n: F.length(tail) >= n)
    return F.array_union(commented, selected)


def latest_run_stats(
    objects: Sequence[str], run_log: DataFrame, fallback_ms: Mapping[str, int] | None = None
) -> DataFrame:
    """Per object the figures of its last run and the averages of all its runs, as metric rows.

    An object without a logged run still gets its 'timing:sample_recent' row, with only the elapsed time
    given in ``fallback_ms``. The last run is the greatest (ended_at, log_id), found with a combining
    aggregate, so an object with a third of the log is no heavier than others.
    """
    fallback_ms = dict(fallback_ms or {})
    listed = run_log.sparkSession.createDataFrame(
        [(o, fallback_ms.get(o, 0)) for o in objects], "object_name string, fallback_ms bigint"
    )
    names = listed.select("object_name", F.lower("object_name").alias("_name"))
    lengths = sorted(r.n for r in names.select(F.length("_name").alias("n")).distinct().collect())
    named = named_objects(F.col("query_text"), F.lit(max(lengths, default=0)), F.array(*[F.lit(n) for n in lengths]).cast("array<int>"))
    hits = run_log.select(
        F.explode(named).alias("_name"), "cpu_us", "duration_us", "reads", "executions", "ended_at", "log_id"
    ).join(names, "_name")
    latest = F.struct("ended_at", "log_id")
    per_object = hits.groupBy("object_name").agg(
        F.max_by(F.struct("cpu_us", "duration_us", "reads"), latest).alias("last"),
        F.sum("cpu_us").alias("cpu_sum"), F.count("cpu_us").alias("cpu_n"),
        F.sum("duration_us").alias("duration_sum"), F.count("duration_us").alias("duration_n"),
        F.sum("reads").alias("reads_sum"), F.count("reads").alias("reads_n"),
        F.sum("executions").alias("executions"),
    )
    joined = listed.join(per_object, "object_name", "left")

    def mean(name: str) -> Column:
        return F.expr(f"try_divide({name}_sum, {name}_n)")

    found = F.coalesce(F.col("last.cpu_us"), F.col("last.duration_us"), F.col("last.reads")).isNotNull()
    sample = F.when(
        found,
        F.concat_ws(
            "|",
            _part("cpu_ms", _milliseconds(F.col("last.cpu_us"))),
            _part("elapsed_ms", _milliseconds(F.col("last.duration_us"))),
            _part("logical_reads", F.col("last.reads")),
        ),
    ).otherwise(
        F.concat_ws(
            "|", F.lit("cpu_ms=NULL"), _part("elapsed_ms", F.col("fallback_ms")), F.lit("logical_reads=NULL")
        )
    )
    averaged = F.coalesce(F.col("cpu_n") + F.col("duration_n") + F.col("reads_n"), F.lit(0)) > 0
    aggregate = F.when(
        averaged,
        F.concat_ws(
            "|",
            _part("cpu_ms", _milliseconds(mean("cpu"))),
            _part("elapsed_ms", _milliseconds(mean("duration"))),
            _part("logical_reads", F.floor(mean("reads")).cast("bigint")),
            F.concat(F.lit("exec_count="), F.coalesce(F.col("executions"), F.lit(0)).cast("string")),
        ),
    )
    rows = joined.select(
        "object_name",
        F.inline(
            F.array(
                F.struct(F.lit("timing:sample_recent").alias("metric"), sample.alias("value_text")),
                F.struct(F.lit("timing:recent_aggregate").alias("metric"), aggregate.alias("value_text")),
            )
        ),
    )
    return rows.filter(F.col("value_text").isNotNull()).orderBy("object_name", "metric")


def measure(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Run each DataFrame into a sink that discards it; wall milliseconds as metric rows."""
    rows = []
    for name, df in frames.items():
        start = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        elapsed = (time.perf_counter() - start) * 1000
        rows.append((name, "timing:elapsed_ms", elapsed, f"{elapsed:.0f}", "bigint"))
        spark = df.sparkSession
    return spark.createDataFrame(
        rows, "object_name string, metric string, value_num double, value_text string, value_type string"
    )
