"""Tile plans of any length as frames: a mergeable quantile sketch, and an index that tags rows.

The sketch is a multi-level compactor. A task gathers ``size`` weighted keys at a time, and two
summaries of the same level are merged, sorted and cut back to ``size`` keys: the cumulative
weight is read off at ``size`` equal steps from a random start, and each key stands for the
steps that hit it. So a key keeps its weight on average however often it is merged. Summaries of
tasks are merged in groups the same way, and what the groups hold is sorted by Spark in ranges;
no task sees all of it.

The rank of a key in a summary is off by less than a step at each cut: at most
``(2 + log2(rows / size)) / size`` of all weight in a task and again in a group. The errors of
tasks and groups are independent with mean zero, so over many of them they nearly cancel.
Up to ``size`` rows a task and a group nothing is cut and the plan is exact.

The index is a tree of tiles with 64 children a node. A row finds the top node by comparisons
in an expression and goes down by joins on the node with a range condition, so it meets at most
64 ranges a level, and the plan has a few joins instead of a branch for each tile.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tablebridge.model import QueryError
from tablebridge.session import stage
from tablebridge.sources.batches import running_sum
from tablebridge.sources.literals import composite_sql, incoming, literal_sql, outgoing, quoted, search_sql
from tablebridge.sources.scan import col, require_columns

LEAST, MOST = 1_024, 65_536  # keys of a summary
KEYS_PER_TILE = 16  # of one summary, as far as MOST allows
GROUPS = 64
FAN_OUT = 64
BROADCAST_BYTES = 64 << 20  # of one level of the index; a larger one is joined as Spark decides


def _compactor(size: int, seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])

        def cut(parts: list[pa.Table]) -> pa.Table:
            whole = pa.concat_tables(parts)
            if whole.num_rows <= size:
                return whole
            names = [n for n in whole.schema.names if n != "_weight"]
            placed = "at_start" if len(names) > 1 else "at_end"
            whole = whole.take(pc.sort_indices(whole, sort_keys=[(n, "ascending") for n in names], null_placement=placed))
            total = np.cumsum(whole["_weight"].to_numpy())
            step = total[-1] / size
            hit = np.searchsorted(total, (np.arange(size) + rng.random()) * step, side="right")
            kept, steps = np.unique(np.minimum(hit, len(total) - 1), return_counts=True)
            short, at = whole.take(pa.array(kept)), len(names)
            return short.set_column(at, short.schema.field(at), pa.array(steps * step))

        levels: list[pa.Table | None] = []
        waiting: list[pa.Table] = []
        for batch in batches:
            waiting.append(pa.Table.from_batches([batch]))
            if sum(t.num_rows for t in waiting) < size:
                continue
            summary, level, waiting = cut(waiting), 0, []
            while level < len(levels) and levels[level] is not None:
                summary, levels[level] = cut([levels[level], summary]), None
                level += 1
            levels[level:level + 1] = [summary]
        rest = [t for t in levels if t is not None] + waiting
        if rest:
            yield from cut(rest).to_batches()

    return run


def quantile_sketch(df: DataFrame, columns: Sequence[str], size: int, weight: Column | None = None,
                    groups: int = GROUPS, seed: int = 7) -> DataFrame:
    """At most ``groups * size`` keys as ``k0, k1, ..., _weight`` that stand for all rows.

    ``weight`` (one by default) is a number above zero for each row, say its bytes. The key order
    is Spark's; any type that Spark and Arrow both sort will do.
    """
    named = [col(c).alias(f"k{i}") for i, c in enumerate(columns)]
    keys = df.select(*named, (F.lit(1.0) if weight is None else weight.cast("double")).alias("_weight"))
    keys = keys.where("_weight > 0")
    names = keys.columns[:-1]
    of_tasks = keys.mapInArrow(_compactor(size, seed), keys.schema).withColumn("_task", F.spark_partition_id())
    # In the order of tasks and keys a group is cut the same way when a lost task runs again.
    grouped = of_tasks.repartition(groups, "_task").sortWithinPartitions("_task", *names).drop("_task")
    merged = grouped.mapInArrow(_compactor(size, seed + 1), keys.schema)
    return merged.groupBy(*names).agg(F.sum("_weight").alias("_weight"))


def plan_tile_frame(df: DataFrame, columns: Sequence[str], n: int, weight: Column | None = None,
                    size: int | None = None) -> DataFrame:
    """Ranges ``[lower, upper)`` of about equal weight as ``tile_id, lower, upper``.

    ``lower`` and ``upper`` are structs of the key columns, NULL where the range is open. A key
    that is heavier than a tile gives one boundary, so there may be fewer tiles than ``n``; a key
    with a NULL is never a boundary. An empty table has one open tile.
    """
    require_columns(df, columns)
    if n < 1:
        raise QueryError("the number of tiles must be at least 1")
    size = size or min(MOST, max(LEAST, KEYS_PER_TILE * n))
    rows = df.where(col(columns[0]).isNotNull()) if len(columns) == 1 else df
    names = [f"k{i}" for i in range(len(columns))]
    groups = max(min(GROUPS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), n // LEAST)
    sketch = stage(quantile_sketch(rows, columns, size, weight, groups), "sketch")
    total = sketch.agg(F.sum("_weight")).first()[0] or 0.0
    share = total / n
    # A key is a boundary if a multiple of the share lies in the weight that it covers.
    multiple = F.greatest(F.lit(1), F.ceil(F.col("before") / F.lit(share or 1.0)))
    bounds = (running_sum(sketch, names, "_weight", "before")
              .where((multiple < n) & (multiple * F.lit(share) < F.col("before") + F.col("_weight")))
              .where(~F.greatest(*[F.col(c).isNull() for c in names], F.lit(False)))
              .select(F.struct(*[F.col(c).alias(o) for c, o in zip(names, columns)]).alias("lower")))
    schema = T.StructType([T.StructField("lower", bounds.schema["lower"].dataType)])
    opened = bounds.unionByName(df.sparkSession.createDataFrame([(None,)], schema))
    # One row for each tile: the window runs over the plan, never over the table.
    in_order = Window.orderBy(F.col("lower").asc_nulls_first())
    return stage(opened.select((F.row_number().over(in_order) - 1).cast("int").alias("tile_id"), "lower",
                               F.lead("lower").over(in_order).alias("upper")), "tiles")


def _key(columns: Sequence[str]) -> Column:
    return F.struct(*[col(c) for c in columns]) if len(columns) > 1 else col(columns[0])


def tag_tiles(df: DataFrame, columns: Sequence[str], tiles: DataFrame, name: str = "tile_id") -> DataFrame:
    """Every row once with its tile of a frame of ``plan_tile_frame``; a NULL single key has tile -1.

    The levels of the index are broadcast while their counted size is below ``BROADCAST_BYTES``,
    so the rows stay where they are.
    """
    require_columns(df, columns)
    plain = tiles if len(columns) > 1 else tiles.withColumns({e: F.col(e)[columns[0]] for e in ("lower", "upper")})
    count, widest = plain.agg(F.count(F.lit(1)), F.max(F.length(F.to_json(F.struct("lower", "upper"))))).first()
    small = count * (64 + 2 * (widest or 0)) <= BROADCAST_BYTES
    depth = 0
    while count > FAN_OUT ** (depth + 1):
        depth += 1

    def nodes(level: int) -> DataFrame:
        if level == 0:
            return plain.select(F.col("tile_id").alias("_id"), "lower", "upper")
        return (plain.groupBy(F.expr(f"CAST(tile_id DIV {FAN_OUT ** level} AS INT)").alias("_id"))
                .agg(F.min_by("lower", "tile_id").alias("lower"), F.max_by("upper", "tile_id").alias("upper")))

    key, types = _key(columns), [df.schema[c].dataType for c in columns]
    top = nodes(depth).where(F.col("lower").isNotNull()).orderBy("_id")
    parts = [F.col("lower")] if len(columns) == 1 else [F.col("lower")[c] for c in columns]
    # Fewer than FAN_OUT nodes.
    edges = top.select("_id", *[outgoing(p, t).alias(f"k{i}") for i, (p, t) in enumerate(zip(parts, types))]).collect()
    literals = [[literal_sql(incoming(v, t), t) for v, t in zip(e[1:], types)] for e in edges]
    names = [quoted(c) for c in columns]
    if len(columns) > 1:
        found = search_sql(composite_sql(names), [composite_sql(e) for e in literals], [0, *(e[0] for e in edges)])
    else:
        found = f"CASE WHEN {names[0]} IS NULL THEN -1 ELSE {search_sql(names[0], [e[0] for e in literals], [0, *(e[0] for e in edges)])} END"
    tagged = df.withColumn("_node", F.expr(f"CAST({found} AS INT)"))
    for level in reversed(range(depth)):
        below = nodes(level).select(F.col("_id").alias("_child"), F.col("lower").alias("_lower"), F.col("upper").alias("_upper"),
                                    F.expr(f"CAST(_id DIV {FAN_OUT} AS INT)").alias("_parent"))
        inside = ((F.col("_node") == F.col("_parent")) & (F.col("_lower").isNull() | (key >= F.col("_lower")))
                  & (F.col("_upper").isNull() | (key < F.col("_upper"))))
        tagged = (tagged.join(F.broadcast(below) if small else below, inside, "left")
                  .withColumn("_node", F.coalesce("_child", "_node")).drop("_child", "_lower", "_upper", "_parent"))
    return tagged.withColumnRenamed("_node", name)
