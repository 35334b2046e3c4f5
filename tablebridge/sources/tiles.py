"""Half-open key ranges that tile a table."""

from __future__ import annotations

import datetime as dt
import decimal
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tablebridge.model import QueryError
from tablebridge.sources.literals import composite_sql, incoming, literal_sql, outgoing, quoted, search_sql
from tablebridge.sources.scan import col, range_condition, require_columns
from tablebridge.sources.tileindex import plan_tile_frame, tag_tiles

IN_EXPRESSION = 256  # tiles that one expression tells apart; longer plans are joined as an index


@dataclass(frozen=True)
class Tile:
    """``[lower, upper)``; a missing bound is open, and the NULL tile holds NULL keys."""

    tile_id: int
    lower: Any = None
    upper: Any = None
    is_null: bool = False


def tiles_from_bounds(bounds: Sequence[Any], null_tile: bool = True) -> list[Tile]:
    """Tiles around ascending inner boundaries: the first and last stay open."""
    edges = [None, *bounds, None]
    tiles = [Tile(i, lo, hi) for i, (lo, hi) in enumerate(zip(edges, edges[1:]))]
    return tiles + [Tile(-1, is_null=True)] if null_tile else tiles


def _equal_width(lo: Any, hi: Any, n: int) -> list[Any]:
    if isinstance(lo, int):
        span = hi - lo + 1
        return [lo + i * span // n for i in range(1, n)]
    if isinstance(lo, dt.datetime):
        micros = (hi - lo) // dt.timedelta(microseconds=1) + 1
        return [lo + dt.timedelta(microseconds=i * micros // n) for i in range(1, n)]
    if isinstance(lo, dt.date):
        days = (hi - lo).days + 1
        return [lo + dt.timedelta(days=i * days // n) for i in range(1, n)]
    return [lo + (hi - lo) * i / n for i in range(1, n)]


def plan_key_tiles(df: DataFrame, column: str, n: int, method: str = "quantile",
                   weight: Column | None = None) -> list[Tile]:
    """Boundaries for ``n`` ranges over ``column`` plus the NULL tile.

    ``quantile`` balances rows, or ``weight`` (``row_bytes``, say), whatever the
    type and distribution of the key, from a mergeable sketch; its rank error is
    stated in ``tileindex``. ``equal_width`` needs only min and max. Repeated
    boundaries (a very frequent key) are merged, so a plan may hold fewer tiles
    than asked for, never overlapping ones. The driver holds the plan, one
    boundary a tile; ``plan_tile_frame`` keeps it as a frame.
    """
    require_columns(df, [column])
    if n < 1:
        raise QueryError("the number of tiles must be at least 1")
    if n == 1:
        return tiles_from_bounds([])
    data_type = df.schema[column].dataType
    if method == "equal_width":
        key = outgoing(col(column), data_type)
        lo, hi = (incoming(v, data_type) for v in df.agg(F.min(key), F.max(key)).first())
        bounds = [] if lo is None else _equal_width(lo, hi, n)
    elif method == "quantile":
        lowers = plan_tile_frame(df, [column], n, weight).where(F.col("lower").isNotNull())
        found = lowers.select(outgoing(F.col("lower")[column], data_type).alias("bound")).collect()
        bounds = [incoming(r.bound, data_type) for r in found]
    else:
        raise QueryError(f"unknown tiling method {method!r}")
    return tiles_from_bounds(sorted(set(bounds)))


def tile_id_expr(df: DataFrame, column: str, tiles: Sequence[Tile]) -> Column:
    """The tile a row belongs to, as one expression over one column."""
    ranges = [t for t in tiles if not t.is_null]
    data_type, key = df.schema[column].dataType, quoted(column)
    found = search_sql(key, [literal_sql(t.upper, data_type) for t in ranges[:-1]], [t.tile_id for t in ranges])
    return F.expr(f"CAST(CASE WHEN {key} IS NULL THEN -1 ELSE {found} END AS INT)")


def tuple_tile_expr(df: DataFrame, columns: Sequence[str], bounds: Sequence[tuple]) -> Column:
    """Tile number of a composite key in lexicographic order (NULL sorts first)."""
    types = [df.schema[c].dataType for c in columns]

    edges = [composite_sql([literal_sql(v, t) for v, t in zip(b, types)]) for b in bounds]
    return F.expr(f"CAST({search_sql(composite_sql([quoted(c) for c in columns]), edges, range(len(edges) + 1))} AS INT)")


def tile_condition(df: DataFrame, column: str, tile: Tile) -> Column:
    if tile.is_null:
        return col(column).isNull()
    if tile.lower is None and tile.upper is None:
        return col(column).isNotNull()
    return range_condition(df, column, tile.lower, tile.upper)


def tiled_scan(df: DataFrame, column: str, tiles: Sequence[Tile]) -> DataFrame:
    """Every row once, tagged with its tile."""
    ids = [t.tile_id for t in tiles if not t.is_null]
    if len(ids) <= IN_EXPRESSION or ids != list(range(len(ids))):
        return df.withColumn("tile_id", tile_id_expr(df, column, tiles))
    return tag_tiles(df, [column], tile_frame(df, column, tiles))


def tile_frame(df: DataFrame, column: str, tiles: Sequence[Tile]) -> DataFrame:
    """A plan as the frame that ``tag_tiles`` joins; its NULL tile is implied."""
    ranges = [t for t in tiles if not t.is_null]
    bound = T.StructType([T.StructField(column, df.schema[column].dataType)])
    schema = T.StructType([T.StructField("tile_id", T.IntegerType()), T.StructField("lower", bound), T.StructField("upper", bound)])
    rows = [(t.tile_id, None if t.lower is None else (t.lower,), None if t.upper is None else (t.upper,)) for t in ranges]
    return df.sparkSession.createDataFrame(rows, schema)


def scan_tile(df: DataFrame, column: str, tile: Tile) -> DataFrame:
    """One tile; its bounds reach the source as pushed filters."""
    return df.where(tile_condition(df, column, tile))


def _sql_literal(value: Any, mysql: bool) -> str:
    """A literal both engines read; MySQL also takes a backslash in text for an escape."""
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float, decimal.Decimal)):
        return str(value)
    if isinstance(value, (bytes, bytearray)):
        return f"X'{bytes(value).hex()}'" if mysql else f"'\\x{bytes(value).hex()}'::bytea"
    kind = {dt.datetime: "TIMESTAMP ", dt.date: "DATE ", dt.time: "TIME "}.get(type(value), "")
    text = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value.isoformat() if kind else str(value)
    text = text.replace("'", "''")
    return kind + "'" + (text.replace("\\", "\\\\") if mysql else text) + "'"


def jdbc_predicates(column: str, tiles: Sequence[Tile], quote: str = '"') -> list[str]:
    """One WHERE text per tile; together they cover every row once.

    A backtick as ``quote`` stands for MySQL, whose text literals differ.
    """
    name = quote + column.replace(quote, quote * 2) + quote
    out = []
    for tile in tiles:
        parts = [f"{name} IS NULL"] if tile.is_null else []
        if tile.lower is not None:
            parts.append(f"{name} >= {_sql_literal(tile.lower, quote == '`')}")
        if tile.upper is not None:
            parts.append(f"{name} < {_sql_literal(tile.upper, quote == '`')}")
        out.append(" AND ".join(parts) or f"{name} IS NOT NULL")
    return out


def jdbc_tiled_scan(spark: SparkSession, url: str, table: str, column: str, tiles: Sequence[Tile],
                    quote: str = '"', **options: str) -> DataFrame:
    """A remote table read by one task and one bounded query per tile."""
    return spark.read.jdbc(url, table, predicates=jdbc_predicates(column, tiles, quote), properties=dict(options))


def tile_coverage(df: DataFrame, column: str, tiles: Sequence[Tile]) -> DataFrame:
    """Rows and key span per tile, empty tiles included.

    Each row is counted in exactly one tile, so the counts add up to the table.
    """
    found = (tiled_scan(df.select(col(column)), column, tiles).groupBy("tile_id")
             .agg(F.count(F.lit(1)).alias("rows"), F.min(col(column)).alias("min_key"),
                  F.max(col(column)).alias("max_key")))
    ids = df.sparkSession.createDataFrame([(t.tile_id,) for t in tiles], "tile_id int")
    return (ids.join(found, "tile_id", "left")
            .select("tile_id", F.coalesce("rows", F.lit(0)).alias("rows"), "min_key", "max_key"))
