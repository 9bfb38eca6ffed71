"""Where jobs put intermediate tables that every executor must be able to read."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="medloom-")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a local one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_folder()


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/medloom/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as parquet in the shared folder and read back: cuts the lineage."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_alone(df: DataFrame, name: str) -> DataFrame:
    """``written``, after which the files of the shuffles that made it go.

    Spark deletes a shuffle's files when the driver's JVM collects the plan they belong to, which may be long after the last use.
    """
    out = written(df, name)
    df.sparkSession.sparkContext._jvm.System.gc()
    return out


def importable(spark: SparkSession) -> None:
    """Let Python workers that run where the driver's files are import this package.

    On other machines the package is installed, or sent with ``--py-files``, as for any PySpark job.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
