"""Running array functions over the partitions of a DataFrame."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


#: Larger batches reach the functions in slices, which bounds what they hold besides the batch.
SLICE_BYTES = 4 << 20


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        step = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes))
        if step >= batch.num_rows:
            yield batch
        else:
            for at in range(0, batch.num_rows, step):
                yield batch.slice(at, step)


def _give_back() -> None:
    """Return memory that a finished task no longer uses: worker processes outlive tasks, and keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _sliced(function: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(slices(batches))
        _give_back()

    return run


def arrow_map(df: DataFrame, function: Callable, schema: T.StructType | str) -> DataFrame:
    """``df.mapInArrow``, with this package importable in workers that run where the driver's files are.

    On other machines the package is installed, or sent with ``--py-files``, as for any PySpark job.
    """
    environment = df.sparkSession.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, _ROOT])
    return df.mapInArrow(_sliced(function), schema)
