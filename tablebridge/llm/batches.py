"""Arrow batches of few rows while a staged table is written, so that workers hold little text at once."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tablebridge import session

ROWS = 1_000
SLICE = 256  # rows whose Python objects a task holds at once
_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int = ROWS) -> Iterator[None]:
    """The session's batch size while the block runs; the old one returns behind it."""
    old = spark.conf.get(_KEY)
    spark.conf.set(_KEY, str(min(rows, int(old)) if int(old) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(_KEY, old)


def stage(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder in small batches and read back."""
    with small_batches(df.sparkSession):
        return session.stage(df, label)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The same rows in short batches that share the memory of the long ones."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def tidy(run: Callable) -> Callable:
    """``run``, giving freed memory back to the system at its end: Spark keeps workers for later tasks."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):
                pass  # another C library

    return tidied
