"""Bulk writes, batch planning, text export and partitioned layout."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from tablebridge.functions.text import copy_line
from tablebridge.functions.values import split_timestamps
from tablebridge.model import BulkWriteError, UnsupportedError
from tablebridge.operators.batchplan import greedy_batches
from tablebridge.sources.scan import KEEP_NULLS, bound_literal, col, require_columns

# Batch limits of the two bulk paths (fixed values).
INSERT_TARGET_ROWS = 500
INSERT_MAX_PLACEHOLDERS = 65_535
INSERT_BYTE_BUDGET = 8 * 1024 * 1024
COPY_FLUSH_ROWS = 10_000
COPY_FLUSH_BYTES = 1024 * 1024

# Estimated bytes of a value beside its own length (fixed values).
TEXT_OVERHEAD, JSON_TEXT_OVERHEAD, JSON_OTHER, PLAIN_VALUE = 16, 32, 256, 16


def bulk_write(df: DataFrame, target: str, mode: str = "append", partition_by: Sequence[str] = (), **jdbc: str) -> int:
    """Append rows by position and return how many were written.

    ``target`` is a path, a table, or with a JDBC ``url`` among the options a
    remote table. The count is observed in the writing stage itself, without
    a second pass. Files are published by one commit: a failing source leaves
    nothing behind.
    """
    spark = df.sparkSession
    if "url" not in jdbc and mode == "append":
        df = _by_position(df, target)
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    try:
        if "url" in jdbc:
            options = {"batchsize": str(rows_per_batch(len(df.columns))), **jdbc}
            counted.write.format("jdbc").options(dbtable=target, **options).mode(mode).save()
        elif "/" in target:
            writer = counted.write.mode(mode)
            (writer.partitionBy(*partition_by) if partition_by else writer).parquet(target)
        elif mode == "append" and spark.catalog.tableExists(target):
            counted.write.insertInto(target)
        else:
            counted.write.mode(mode).saveAsTable(target)
    except AnalysisException as exc:
        raise BulkWriteError(f"cannot write {target}: {exc}") from exc
    return seen.get["rows"]


def _by_position(df: DataFrame, target: str) -> DataFrame:
    """Rename and type columns after the target's, in order; a first write keeps its own."""
    spark = df.sparkSession
    try:
        existing = spark.read.parquet(target).schema if "/" in target else spark.table(target).schema
    except AnalysisException:
        return df
    if len(existing) != len(df.columns):
        raise BulkWriteError(f"{target} has {len(existing)} columns, the rows have {len(df.columns)}")
    for mine, theirs in zip(df.schema.fields, existing.fields):
        if mine.dataType != theirs.dataType:
            raise BulkWriteError(f"column {theirs.name} is {theirs.dataType.simpleString()}, "
                                 f"the rows bring {mine.dataType.simpleString()}")
    return df.toDF(*existing.names)


def rows_per_batch(columns: int, target_rows: int = INSERT_TARGET_ROWS,
                   max_placeholders: int = INSERT_MAX_PLACEHOLDERS) -> int:
    return max(1, min(target_rows, max_placeholders // max(1, columns)))


def estimated_bytes(df: DataFrame, json_columns: Sequence[str] = ()) -> Column:
    """A row's estimated wire size: the length of text and bytes plus a fixed part per value."""
    total = F.lit(0).cast("bigint")
    for f in df.schema.fields:
        c = col(f.name)
        if f.name in json_columns or isinstance(f.dataType, T.VariantType):
            doc = c if isinstance(f.dataType, T.VariantType) else F.try_parse_json(c)
            text = F.when(F.schema_of_variant(doc) == "STRING", F.variant_get(doc, "$", "string"))
            size = F.when(text.isNotNull(), F.octet_length(text) + JSON_TEXT_OVERHEAD).otherwise(JSON_OTHER)
            total = total + F.when(c.isNull(), PLAIN_VALUE).otherwise(size)
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(c) + TEXT_OVERHEAD, F.lit(PLAIN_VALUE))
        else:
            total = total + PLAIN_VALUE
    return total


def estimate_row_bytes(df: DataFrame, json_columns: Sequence[str] = ()) -> DataFrame:
    return df.withColumn("row_bytes", estimated_bytes(df, json_columns))


def plan_write_batches(df: DataFrame, order_by: Sequence[str], target_rows: int = INSERT_TARGET_ROWS,
                       max_placeholders: int = INSERT_MAX_PLACEHOLDERS, byte_budget: int = INSERT_BYTE_BUDGET,
                       json_columns: Sequence[str] = ()) -> DataFrame:
    """The INSERT batches of the whole table in the order of ``order_by``: (batch, first_row, rows, bytes).

    Greedy over all rows, so the plan does not depend on partitions.
    """
    if any(isinstance(f.dataType, T.ArrayType) for f in df.schema.fields):
        raise UnsupportedError("this bulk path takes no arrays")
    cap = rows_per_batch(len(df.columns), target_rows, max_placeholders)
    return greedy_batches(df, estimated_bytes(df, json_columns), order_by, cap, byte_budget)


def copy_flush_plan(df: DataFrame, order_by: Sequence[str], flush_rows: int = COPY_FLUSH_ROWS,
                    flush_bytes: int = COPY_FLUSH_BYTES) -> DataFrame:
    """The same for the text path: buffers flushed by rows or encoded bytes."""
    return greedy_batches(df, F.octet_length(copy_line(df)) + 1, order_by, flush_rows, flush_bytes)


def export_copy_text(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Rows as COPY text, one file per task."""
    df.select(copy_line(df).alias("value")).write.mode(mode).text(path)


def adapt_for_target(df: DataFrame, engine: str, arrays: str = "error") -> DataFrame:
    """Values in forms the target engine stores.

    PostgreSQL takes everything. MySQL has no zones (instants become UTC wall
    clocks) and no arrays: an error, or JSON text with ``arrays="json"``.
    """
    if engine == "postgres":
        return df
    if engine != "mysql":
        raise UnsupportedError(f"unknown engine {engine!r}")
    with_arrays = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    if with_arrays and arrays != "json":
        raise UnsupportedError(f"mysql has no array type: {with_arrays}")
    plain = split_timestamps(df)
    return plain.select(*[F.to_json(col(c), KEEP_NULLS).alias(c) if c in with_arrays else col(c) for c in plain.columns])


@dataclass(frozen=True)
class RangePartitions:
    """Named half-open ranges of a column."""

    column: str
    children: Sequence[tuple[str, Any, Any]]


@dataclass(frozen=True)
class ListPartitions:
    column: str
    children: Mapping[str, Sequence[Any]]


@dataclass(frozen=True)
class HashPartitions:
    column: str
    modulus: int


PartitionSpec = RangePartitions | ListPartitions | HashPartitions


def partition_child(df: DataFrame, spec: PartitionSpec) -> Column:
    """The child a row belongs to; NULL when it fits none."""
    require_columns(df, [spec.column])
    data_type = df.schema[spec.column].dataType
    c = col(spec.column)
    if isinstance(spec, HashPartitions):
        return F.concat(F.lit("p"), F.pmod(F.xxhash64(c), F.lit(spec.modulus)).cast("string"))
    out = F.lit(None).cast("string")
    if isinstance(spec, ListPartitions):
        for name, values in spec.children.items():
            given = [v for v in values if v is not None]
            test = c.isin(*[bound_literal(v, data_type) for v in given]) if given else F.lit(False)
            out = F.when(test | c.isNull() if None in values else test, name).otherwise(out)
        return out
    for name, lower, upper in spec.children:
        test = c.isNotNull()
        if lower is not None:
            test = test & (c >= bound_literal(lower, data_type))
        if upper is not None:
            test = test & (c < bound_literal(upper, data_type))
        out = F.when(test, name).otherwise(out)
    return out


def partitioned_write(df: DataFrame, path: str, spec: PartitionSpec, name: str = "child",
                      default_child: str | None = None, mode: str = "errorifexists") -> None:
    """One directory per child under the parent path.

    A row outside every child goes to ``default_child`` or stops the job.
    The rebalance hint lets AQE split a hot child over several tasks and
    merge tiny ones.
    """
    child = partition_child(df, spec)
    stray = F.lit(default_child) if default_child is not None else F.raise_error(
        F.concat(F.lit("no partition for value "), F.coalesce(col(spec.column).cast("string"), F.lit("NULL")))).cast("string")
    tagged = df.withColumn(name, F.coalesce(child, stray))
    tagged.hint("rebalance", name).write.mode(mode).partitionBy(name).parquet(path)


def children_for_range(spec: RangePartitions, lower: Any = None, upper: Any = None) -> list[str]:
    """The children a key range can touch, for a filter on the partition column."""
    return [name for name, lo, hi in spec.children
            if (upper is None or lo is None or lo < upper) and (lower is None or hi is None or hi > lower)]


def partition_rollup(df: DataFrame, spec: PartitionSpec) -> DataFrame:
    """Rows per child, the rows outside all of them, and the parent total they add up to."""
    named = df.select(partition_child(df, spec).alias("child"))
    rolled = named.rollup("child").agg(F.grouping("child").alias("_all"), F.count(F.lit(1)).alias("rows"))
    part = F.when(F.col("_all") == 1, "parent").when(F.col("child").isNull(), "outside").otherwise("child")
    return rolled.select(part.alias("part"), "child", "rows")
