"""The append-only metric log: long rows stamped with a run id and a run time, one folder per day."""

from __future__ import annotations

import datetime as dt
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_COLUMNS = ("object_name", "metric", "value_num", "value_text", "value_type", "run_utc", "run_id")
LOG_SCHEMA = (
    "object_name string, metric string, value_num double, value_text string, value_type string, "
    "run_utc timestamp, run_id string, run_date date"
)


def stamp(metrics: DataFrame, run_id: str, run_utc: dt.datetime) -> DataFrame:
    """Add the run id and time. Both are passed in, so a retried task writes the same rows."""
    return metrics.withColumns(
        {
            "run_utc": F.lit(run_utc).cast("timestamp"),
            "run_id": F.lit(run_id),
            "run_date": F.lit(run_utc.date()),
        }
    )


def append_metrics(metrics: DataFrame, path: str, run_id: str, run_utc: dt.datetime) -> None:
    """Append one run to the log, and its day to the index of runs."""
    stamped = stamp(metrics, run_id, run_utc)
    stamped.write.mode("append").partitionBy("run_date").parquet(path)
    index_runs(metrics.sparkSession.createDataFrame([(run_id, run_utc.date())], RUNS_SCHEMA), path)


RUNS_SCHEMA = "run_id string, run_date date"
RUN_BUCKETS = 64


def _runs_path(path: str) -> str:
    return path.rstrip("/") + "_runs"


def _run_bucket(run_id: str | Column) -> Column:
    return F.pmod(F.crc32(run_id if isinstance(run_id, Column) else F.lit(run_id)), F.lit(RUN_BUCKETS)).cast("int")


def index_runs(log: DataFrame, path: str) -> None:
    """Note on which days the runs of a log, or of rows about to be added to it, lie: beside the log, by bucket of the run id."""
    runs = log.filter(F.col("run_id").isNotNull()).select("run_id", "run_date").distinct()
    bucketed = runs.withColumn("bucket", _run_bucket(F.col("run_id")))
    bucketed.repartition("bucket").write.mode("append").partitionBy("bucket").parquet(_runs_path(path))


def days_of_run(spark: SparkSession, path: str, run_id: str) -> list[dt.date]:
    """The days a run lies on, usually one; reads one bucket of the index."""
    bucket = zlib.crc32(run_id.encode()) % RUN_BUCKETS
    index = spark.read.schema(RUNS_SCHEMA + ", bucket int").parquet(_runs_path(path))
    found = index.filter((F.col("bucket") == bucket) & (F.col("run_id") == run_id)).select("run_date").distinct()
    return sorted(r.run_date for r in found.collect())


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The whole log."""
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def read_run(spark: SparkSession, path: str, run_id: str, run_date: dt.date | None = None) -> DataFrame:
    """One run, sorted. Only the folders of its days are read: of ``run_date``, or as the index of runs has them."""
    days = [run_date] if run_date is not None else days_of_run(spark, path, run_id)
    log = read_log(spark, path).filter(F.col("run_id") == run_id).filter(F.col("run_date").isin(days))
    return log.select("run_id", "object_name", "metric", "value_num", "value_text", "value_type", "run_utc").orderBy(
        "object_name", "metric"
    )


def backfill_run_id(log: DataFrame) -> DataFrame:
    """Give rows without a run id one of their own.

    The id is a digest of the row instead of a random value: a re-run or a retried task gives the same id.
    """
    stable = F.concat_ws(
        "|",
        F.coalesce(F.col("object_name"), F.lit("")),
        F.coalesce(F.col("metric"), F.lit("")),
        F.coalesce(F.col("value_text"), F.lit("")),
        F.date_format("run_utc", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
    )
    return log.withColumn("run_id", F.coalesce(F.col("run_id"), F.sha2(stable, 256)))
