"""Incremental scans of arriving files and micro-batched copies."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tablebridge.sources.scan import key_range_scan, project


def stream_scan(spark: SparkSession, path: str, schema: T.StructType | str, columns: Sequence[str] | None = None,
                key_range: tuple[str, Any, Any] | None = None, max_files: int = 1000,
                glob: str | None = None) -> DataFrame:
    """A directory of arriving Parquet files as a stream, with range and projection pushed down.

    ``glob`` picks the file names that belong to the table.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    df = (reader.option("pathGlobFilter", glob) if glob else reader).parquet(path)
    df = key_range_scan(df, *key_range) if key_range else df
    return project(df, columns) if columns else df


def stream_copy(stream: DataFrame, dst: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Each micro-batch replaces its own ``batch_id`` directory of ``dst``.

    A batch that is replayed after a crash overwrites itself, so every row
    arrives exactly once.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{dst}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def batch_counts(spark: SparkSession, dst: str) -> DataFrame:
    """Rows per committed micro-batch, from file statistics."""
    return spark.read.parquet(dst).groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows"))
