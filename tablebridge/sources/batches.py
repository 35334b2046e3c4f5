"""Global row numbers and consecutive batches without a global window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tablebridge.model import QueryError
from tablebridge.session import stage
from tablebridge.sources.scan import col, require_columns

_SHIFT = 33  # monotonically_increasing_id keeps the partition above bit 33


def spread_key(df: DataFrame) -> Column:
    """A hash of the whole row: splits rows that share a key across ranges."""
    usable = [col(f.name) for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.xxhash64(*usable)


def with_tie_break(df: DataFrame, name: str = "_spread") -> DataFrame:
    """Add two numbers that split the rows of one key, copies of one row included.

    ``name`` is a hash of the whole row and splits everything but exact copies;
    ``name``_part is the task a row is read in and splits those, so copies stay
    together only as far as one input split holds them. Neither depends on the
    order of rows within a task, so both are the same when a lost task runs again.
    """
    return df.withColumns({name: spread_key(df), f"{name}_part": F.spark_partition_id()})


def tie_columns(name: str = "_spread") -> list[str]:
    return [name, f"{name}_part"]


def _staged_order(df: DataFrame, order_by: Sequence[str], label: str) -> DataFrame:
    """The rows in ranges of ``order_by``, written once, with ``_place``: their range and place in it."""
    require_columns(df, order_by)
    keys = [col(c) for c in order_by]
    # By number, or Spark would join ranges up to a size as shuffled: millions of copies, which take little there, in one sort.
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (with_tie_break(df)
              .repartitionByRange(ranges, *keys, *tie_columns())
              .sortWithinPartitions(*keys, *tie_columns())
              .drop(*tie_columns())
              .withColumn("_place", F.monotonically_increasing_id()))
    return stage(ranged, label)


def number_rows(df: DataFrame, order_by: Sequence[str], name: str = "row_index") -> DataFrame:
    """Consecutive 0-based numbers in the order of ``order_by``.

    One range shuffle sorts the rows; its ranges also split on a tie break,
    so a key held by a third of the rows still spreads over many tasks, and are
    as many as the session's shuffle partitions. The
    sorted rows are staged once with their place in their range, which fixes
    the ranges for good; a second pass reads the places alone and gives each
    range its offset. The offset frame has one row per range.
    """
    staged = _staged_order(df, order_by, "numbered")
    part = F.shiftright(F.col("_place"), _SHIFT)
    local = F.col("_place") - F.shiftleft(part, _SHIFT)
    sizes = staged.groupBy(part.alias("_part")).agg((F.max(local) + 1).alias("_size"))
    # One row per shuffle partition: the window runs over that many rows.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    # Rows find the offset of their range where they are: a shuffle by range would gather ranges, long ones of copies too, in sorts.
    return (staged.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_offset") + local)
            .drop("_part", "_place", "_offset"))


def running_sum(df: DataFrame, order_by: Sequence[str], value: str, name: str = "before") -> DataFrame:
    """The sum of ``value`` over all rows before each row, in the order of ``order_by``.

    Ranges and staging are those of ``number_rows``; each range is summed in a window of its own
    and starts from the total of the ranges before it. ``value`` holds no NULL.
    """
    require_columns(df, [value])
    staged = _staged_order(df, order_by, "summed")
    staged = staged.withColumn("_part", F.shiftright(F.col("_place"), _SHIFT))
    zero = F.lit(0).cast("double" if isinstance(df.schema[value].dataType, (T.DoubleType, T.FloatType)) else "long")
    sums = staged.groupBy("_part").agg(F.sum(col(value)).alias("_sum"))
    # One row per shuffle partition: the window runs over that many rows.
    parts = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_part", F.coalesce(F.sum("_sum").over(parts), zero).alias("_offset"))
    within = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    return (staged.withColumn("_within", F.coalesce(F.sum(col(value)).over(within), zero))
            .join(offsets, "_part").withColumn(name, F.col("_offset") + F.col("_within"))
            .drop("_part", "_place", "_offset", "_within"))


def batch_rows(df: DataFrame, order_by: Sequence[str], size: int) -> DataFrame:
    """Consecutive batches of ``size`` rows as ``batch_id``; the last may be short."""
    if size < 1:
        raise QueryError("the batch size must be at least 1")
    return (number_rows(df, order_by)
            .withColumn("batch_id", F.expr(f"row_index div {size}")))
