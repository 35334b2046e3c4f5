"""Declared constraints as distributed checks that return what breaks them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tablebridge.functions.values import lost_in, parse_schema
from tablebridge.model import QueryError
from tablebridge.session import stage
from tablebridge.sources.batches import number_rows, running_sum, tie_columns, with_tie_break
from tablebridge.sources.scan import col, require_columns
from tablebridge.sources.tileindex import plan_tile_frame, tag_tiles


ROWS_PER_TILE = 4_000_000  # of an overlap check, where the session asks for fewer tiles
BLOCK = 64  # consecutive starts that meet an interval together, at least
LARGEST_BLOCK = 4_096  # and at most, where intervals have many partners
WIDE = 65_536  # blocks that one row lists at a time


def any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda x, y: x | y, [col(c).isNull() for c in columns])


def pk_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys that occur more than once or hold a NULL, with their row counts.

    One aggregation; a hot key combines before the shuffle.
    """
    require_columns(df, columns)
    counted = df.groupBy(*[col(c) for c in columns]).agg(F.count(F.lit(1)).alias("rows"))
    reason = F.when(any_null(columns), "null key").otherwise("duplicate key")
    return counted.where(any_null(columns) | (F.col("rows") > 1)).withColumn("reason", reason)


def unique_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; a key with a NULL never conflicts."""
    require_columns(df, columns)
    return (df.where(~any_null(columns)).groupBy(*[col(c) for c in columns])
            .agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1))


def rows_with_keys(df: DataFrame, keys: DataFrame, columns: Sequence[str], null_keys: bool = True) -> DataFrame:
    """The full rows behind a frame of violating keys.

    Where no key of the frame holds a NULL, ``null_keys=False`` leaves rows
    with a NULL out before the join, so they never meet in one task.
    """
    k = keys.select(*[col(c).alias(f"_k{i}") for i, c in enumerate(columns)])
    pairs = [(col(c), F.col(f"_k{i}")) for i, c in enumerate(columns)]
    on = reduce(lambda x, y: x & y, [a.eqNullSafe(b) if null_keys else a == b for a, b in pairs])
    return (df if null_keys else df.where(~any_null(columns))).join(k, on, "left_semi")


def orphan_keys(child: DataFrame, parent: DataFrame, columns: Sequence[str], ref_columns: Sequence[str]) -> DataFrame:
    """Foreign-key values without a parent row, with the number of child rows.

    The child's keys are counted before the join, so the shuffle moves one
    record per distinct key and task, and no key is hot after it.
    """
    require_columns(child, columns)
    require_columns(parent, ref_columns)
    if len(columns) != len(ref_columns):
        raise QueryError("the column lists of a foreign key must pair up")
    keys = (child.where(~any_null(columns)).groupBy(*[col(c) for c in columns])
            .agg(F.count(F.lit(1)).alias("rows")))
    ref = parent.select(*[col(c).alias(f"_r{i}") for i, c in enumerate(ref_columns)])
    on = reduce(lambda x, y: x & y, [col(c) == F.col(f"_r{i}") for i, c in enumerate(columns)])
    return keys.join(ref, on, "left_anti")


def fk_violations(child: DataFrame, parent: DataFrame, columns: Sequence[str], ref_columns: Sequence[str]) -> DataFrame:
    """Child rows without a parent; a NULL in any column passes (MATCH SIMPLE)."""
    return rows_with_keys(child, orphan_keys(child, parent, columns, ref_columns), columns, null_keys=False)


def check_violations(df: DataFrame, checks: Mapping[str, str]) -> DataFrame:
    """Rows for which a bare condition is FALSE, with the broken names; NULL passes."""
    if not checks:
        raise QueryError("at least one check is needed")
    broken = [F.when(~F.expr(f"({e})"), F.lit(name)) for name, e in checks.items()]
    return df.withColumn("violated", F.array_compact(F.array(*broken))).where(F.size("violated") > 0)


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column, from one pass without a shuffle of rows."""
    require_columns(df, columns)
    counts = [F.count_if(col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)]
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("nulls")) for i, c in enumerate(columns)]
    return df.agg(*counts).select(F.inline(F.array(*pairs)))


def enum_violations(df: DataFrame, column: str, labels: Sequence[str] | DataFrame) -> DataFrame:
    """Rows whose value is none of the labels; NULL passes.

    ``labels`` is a list, or a one-column frame for a large domain. A NULL
    among the labels allows nothing more.
    """
    require_columns(df, [column])
    if isinstance(labels, DataFrame):
        known = labels.select(labels.columns[0]).toDF("_label")
        bad = (df.where(col(column).isNotNull()).groupBy(col(column)).agg(F.count(F.lit(1)))
               .join(known, col(column) == F.col("_label"), "left_anti"))
        return rows_with_keys(df, bad, [column], null_keys=False)
    known = [v for v in labels if v is not None]
    return df.where(~col(column).isin(*known)) if known else df.where(col(column).isNotNull())


def domain_misfit(c: Column, source: T.DataType, target: T.DataType) -> Column:
    """Whether a value is too long, too wide or too precise for ``target``."""
    if isinstance(target, (T.CharType, T.VarcharType)):
        return F.length(c.cast("string")) > target.length
    tried = c.try_cast(target)
    return c.isNotNull() & lost_in(c, tried, source, target)


def domain_violations(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Rows with values outside their declared domains, with the column names."""
    target = parse_schema(schema)
    require_columns(df, target.names)
    flags = [F.when(domain_misfit(col(f.name), df.schema[f.name].dataType, f.dataType), F.lit(f.name))
             for f in target.fields]
    return df.withColumn("misfit_columns", F.array_compact(F.array(*flags))).where(F.size("misfit_columns") > 0)


def exclusion_violations(df: DataFrame, eq_columns: Sequence[str], lower: str, upper: str,
                         order_by: Sequence[str] = (), tiles: int | None = None) -> DataFrame:
    """Rows whose [lower, upper) overlaps an earlier row of the same key.

    ``prior_upper`` is the furthest end among the earlier rows; ``order_by``
    breaks ties of equal starts (by default a row hash). Rows with a NULL key
    or an empty range never conflict.

    A running maximum per key would put a hot key in one task. So rows fall
    into tiles of (lower, tie) that cut every key, the maxima per (key, tile)
    are carried over the few tiles of a key, and enter each tile's window as
    one leading row. No pairs are formed.
    """
    require_columns(df, [*eq_columns, lower, upper, *order_by])
    rows = df.where(~any_null([*eq_columns, lower, upper]) & (col(lower) < col(upper)))
    rows = with_tie_break(rows, "_tie")
    ties = [*order_by, *tie_columns("_tie")]
    n = tiles or max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.count() // ROWS_PER_TILE)
    axis = [lower, *ties]
    tiled = tag_tiles(rows, axis, plan_tile_frame(rows, axis, n), "_tile")
    keys = [col(c) for c in eq_columns]
    ends = tiled.groupBy(*keys, "_tile").agg(F.max(col(upper)).alias("_end"))
    earlier = Window.partitionBy(*keys).orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*keys, "_tile", F.max("_end").over(earlier).alias("_end")).where(F.col("_end").isNotNull())
    body = tiled.withColumn("_end", col(upper)).withColumn("_carry", F.lit(0))
    both = body.unionByName(carried.withColumn("_carry", F.lit(1)), allowMissingColumns=True)
    order = [F.col("_carry").desc(), col(lower), *[col(c) for c in ties]]
    before = Window.partitionBy(*keys, "_tile").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (both.withColumn("prior_upper", F.max("_end").over(before))
            .where((F.col("_carry") == 0) & (F.col("prior_upper") > col(lower)))
            .drop("_tile", *tie_columns("_tie"), "_end", "_carry"))


def overlap_ranks(df: DataFrame, eq_columns: Sequence[str], lower: str, upper: str,
                  order_by: Sequence[str] = ()) -> DataFrame:
    """The rows with ``_rank``, their place by (key, lower, order_by), and ``_end``.

    Of the rows of its key behind it a row overlaps just those before place ``_end``, so
    ``_end - _rank - 1`` is their number. Two global sorts find both: one numbers the rows, one
    puts each end among the counted starts. A hot key is cut like any other range. Rows with a
    NULL key or bound or an empty range are left out; equal rows take places in any order.
    """
    require_columns(df, [*eq_columns, lower, upper, *order_by])
    rows = df.where(~any_null([*eq_columns, lower, upper]) & (col(lower) < col(upper)))
    ranked = number_rows(rows, [*eq_columns, lower, *order_by], "_rank")
    keys = [col(c) for c in eq_columns]
    starts = ranked.groupBy(*keys, col(lower).alias("_at")).agg(F.count(F.lit(1)).alias("_starts"))
    # At the same place ends stand before starts: ranges are half-open.
    ends = ranked.withColumns({"_at": col(upper), "_starts": F.lit(0).cast("long"), "_kind": F.lit(0)})
    events = ends.unionByName(starts.withColumn("_kind", F.lit(1)), allowMissingColumns=True)
    swept = running_sum(events, [*eq_columns, "_at", "_kind"], "_starts", "_end")
    return swept.where("_kind = 0").drop("_at", "_starts", "_kind")


def block_size(ranked: DataFrame) -> int:
    """Places of a block, from the pairs that ``overlap_ranks`` tells, within BLOCK and LARGEST_BLOCK.

    A quarter of the partners that a row has on average: up to LARGEST_BLOCK, rows go to
    five blocks on average at most, however the pairs are dealt, and at most half as many places
    as there are pairs are met in vain.
    """
    rows, pairs = ranked.agg(F.count(F.lit(1)), F.sum(F.expr("_end - _rank - 1"))).first()
    return max(BLOCK, min(LARGEST_BLOCK, pairs // (4 * rows))) if rows else BLOCK


def to_blocks(ranked: DataFrame, kept: Sequence[Column], size: int) -> DataFrame:
    """Rows with partners once for each ``_block`` of ``size`` places that holds some of them."""
    coarse = F.explode(F.expr(f"sequence((_rank + 1) DIV {size * WIDE}, (_end - 1) DIV {size * WIDE})")).alias("_coarse")
    fine = F.explode(F.expr(f"sequence(greatest(_coarse * {WIDE}, (_rank + 1) DIV {size}), "
                            f"least(_coarse * {WIDE} + {WIDE - 1}, (_end - 1) DIV {size}))")).alias("_block")
    return ranked.where("_end > _rank + 1").select(*kept, "_rank", "_end", coarse).select("*", fine).drop("_coarse")


def overlap_pairs(df: DataFrame, eq_columns: Sequence[str], lower: str, upper: str, columns: Sequence[str],
                  order_by: Sequence[str] = ()) -> DataFrame:
    """Every pair of rows with equal keys and overlapping [lower, upper), once.

    Gives the key and ``first_<c>``, ``second_<c>`` for each of ``columns``; the first row is
    the earlier one by (lower, order_by). Copies of a row overlap each other. The partners of a
    row are consecutive places (``overlap_ranks``), so it goes to the blocks of ``block_size``
    places that hold them and to no other: the work grows with the rows and with the pairs, and
    neither a hot key nor an interval over the whole table gathers in one task.
    """
    require_columns(df, columns)
    wanted = list(dict.fromkeys([*eq_columns, lower, upper, *order_by, *columns]))
    ranked = overlap_ranks(df.select(*[col(c) for c in wanted]), eq_columns, lower, upper, order_by)
    ranked = stage(ranked, "overlaps")
    size = block_size(ranked)
    kept = [col(c).alias(f"first_{c}") for c in columns]
    firsts = to_blocks(ranked, [*[col(c) for c in eq_columns], *kept], size)
    seconds = ranked.select(F.expr(f"_rank DIV {size}").alias("_block"), F.col("_rank").alias("_place"),
                            *[col(c).alias(f"second_{c}") for c in columns])
    met = firsts.join(seconds, "_block").where((F.col("_place") > F.col("_rank")) & (F.col("_place") < F.col("_end")))
    return met.drop("_block", "_rank", "_end", "_place")
