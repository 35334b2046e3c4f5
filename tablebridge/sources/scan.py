"""Table scans, projections, half-open key ranges and bound SQL."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import uuid
from collections.abc import Iterator, Mapping, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from tablebridge.model import QueryError, TableRef, UnsupportedError


def scan_table(spark: SparkSession, source: str | TableRef, columns: Sequence[str] | None = None,
               **jdbc: str) -> DataFrame:
    """All columns of a table, in table order.

    ``source`` is a path (it contains a slash), a table name, or with a JDBC
    ``url`` among the options a remote table.
    """
    try:
        if "url" in jdbc:
            df = spark.read.format("jdbc").options(dbtable=str(source), **jdbc).load()
        elif isinstance(source, str) and "/" in source:
            df = spark.read.parquet(source)
        else:
            df = spark.table(str(source))
    except AnalysisException as exc:
        raise QueryError(f"cannot read {source}: {exc}") from exc
    if not df.columns:
        raise QueryError(f"{source} has no columns")
    return df if columns is None else project(df, columns)


def require_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    wanted = list(columns)
    if not wanted:
        raise QueryError("at least one column is needed")
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise QueryError(f"unknown columns {missing}; the table has {df.columns}")
    return wanted


def col(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only ``columns``, in this order."""
    return df.select(*[col(c) for c in require_columns(df, columns)])


def bound_literal(value: Any, data_type: T.DataType) -> Column:
    """A range bound as a literal of the column's own type.

    A bound of another type would make Spark cast the column and lose the
    filter pushdown. Wall-clock and instant bounds are never mixed.
    """
    if isinstance(value, uuid.UUID):
        value = str(value)
    allowed = (bool, int, float, str, decimal.Decimal, dt.date, dt.datetime, dt.time)
    if not isinstance(value, allowed):
        raise UnsupportedError(f"not usable as a range bound: {value!r}")
    if isinstance(value, dt.datetime):
        aware = value.tzinfo is not None
        if isinstance(data_type, T.TimestampNTZType) and aware:
            raise UnsupportedError("an instant cannot bound a wall-clock column")
        if isinstance(data_type, T.TimestampType) and not aware:
            raise UnsupportedError("a wall-clock value cannot bound an instant column")
        return F.lit(value.isoformat(sep=" ")).cast(data_type)
    if isinstance(value, (dt.date, dt.time)):
        return F.lit(value.isoformat()).cast(data_type)
    if isinstance(value, bool) != isinstance(data_type, T.BooleanType):
        raise UnsupportedError(f"{value!r} does not fit a {data_type.simpleString()} column")
    if isinstance(data_type, T.IntegralType):
        # A bound outside the column's range must not wrap or raise.
        if isinstance(value, int):
            bits = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}[data_type.simpleString()]
            fits = -(2 ** (bits - 1)) <= value < 2 ** (bits - 1)
            return F.lit(value).cast(data_type) if fits else F.lit(decimal.Decimal(value))
        if isinstance(value, str):
            raise UnsupportedError(f"{value!r} does not fit a {data_type.simpleString()} column")
        return F.lit(value)
    if isinstance(value, float) and isinstance(data_type, (T.DoubleType, T.FloatType)):
        return F.lit(value).cast(data_type) if math.isfinite(value) else F.lit(value)
    return F.lit(value).cast(data_type) if isinstance(data_type, T.StringType) else F.lit(value)


def range_condition(df: DataFrame, column: str, lower: Any = None, upper: Any = None) -> Column:
    """``column >= lower AND column < upper``; a missing bound leaves that side open."""
    require_columns(df, [column])
    if lower is None and upper is None:
        raise QueryError("a key range needs at least one bound")
    data_type = df.schema[column].dataType
    if isinstance(data_type, (T.BinaryType, T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        raise UnsupportedError(f"{column} ({data_type.simpleString()}) cannot be a range key")
    condition: Column | None = None
    if lower is not None:
        condition = col(column) >= bound_literal(lower, data_type)
    if upper is not None:
        below = col(column) < bound_literal(upper, data_type)
        condition = below if condition is None else condition & below
    return condition


def key_range_scan(df: DataFrame, column: str, lower: Any = None, upper: Any = None) -> DataFrame:
    """The rows of one half-open key range; a NULL key is in no range."""
    return df.where(range_condition(df, column, lower, upper))


def run_query_lazy(spark: SparkSession, sql: str, params: Sequence[Any] | Mapping[str, Any] = (),
                   **views: DataFrame) -> DataFrame:
    """A caller's SQL with bound parameters; ``views`` are named as ``{name}``."""
    args = dict(params) if isinstance(params, Mapping) else list(params)
    return spark.sql(sql, args=args or None, **views)


def run_query(spark: SparkSession, sql: str, params: Sequence[Any] | Mapping[str, Any] = (),
              max_rows: int = 10_000, **views: DataFrame) -> list[Row]:
    """A small result, held whole; more than ``max_rows`` rows is an error."""
    rows = run_query_lazy(spark, sql, params, **views).limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise QueryError(f"more than {max_rows} rows; use run_query_lazy")
    return rows


def iter_rows(df: DataFrame, batch_size: int = 1000) -> Iterator[list[Row]]:
    """Rows at the driver's edge in batches, one Spark partition in memory at a time."""
    if batch_size < 1:
        raise QueryError("batch_size must be at least 1")

    def batches() -> Iterator[list[Row]]:
        batch: list[Row] = []
        for row in df.toLocalIterator():
            batch.append(row)
            if len(batch) == batch_size:
                yield batch
                batch = []
        if batch:
            yield batch

    return batches()


KEEP_NULLS = {"ignoreNullFields": "false"}  # a NULL member of a struct is part of the value


def reads_natively(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return reads_natively(data_type.elementType)
    return not isinstance(data_type, (T.DayTimeIntervalType, T.YearMonthIntervalType, T.CalendarIntervalType,
                                      T.VariantType, T.MapType, T.StructType, T.NullType))


def readable_projection(df: DataFrame) -> DataFrame:
    """Native columns untouched, every other column as text under its own name."""
    def readable(f: T.StructField) -> Column:
        if reads_natively(f.dataType):
            return col(f.name)
        if isinstance(f.dataType, (T.VariantType, T.MapType, T.StructType)):
            return F.to_json(col(f.name), KEEP_NULLS).alias(f.name)
        if isinstance(f.dataType, T.ArrayType):
            return F.to_json(F.transform(col(f.name), lambda x: x.cast("string"))).alias(f.name) \
                if not isinstance(f.dataType.elementType, (T.MapType, T.StructType, T.VariantType)) \
                else F.to_json(col(f.name), KEEP_NULLS).alias(f.name)
        return col(f.name).cast("string").alias(f.name)

    return df.select(*[readable(f) for f in df.schema.fields])


# Types a PostgreSQL source cannot hand over as themselves (fixed values).
PG_TEXT_CATEGORIES = ("interval", "bit", "xml", "enum", "geometry", "unsupported")


def readable_select_list(columns: DataFrame) -> DataFrame:
    """Per table the select list that casts unreadable columns at a PostgreSQL source.

    ``columns`` is a mapped inventory (see ``operators.typemap``) with
    source_id, schema_name, table_name, column_name, ordinal and ``t``.
    """
    quoted = F.concat(F.lit('"'), F.replace(F.col("column_name"), F.lit('"'), F.lit('""')), F.lit('"'))
    as_text = F.col("t.category").isin(*PG_TEXT_CATEGORIES) | ((F.col("t.category") == "time") & F.col("t.tz"))
    item = F.when(as_text, F.concat(quoted, F.lit("::text AS "), quoted)).otherwise(quoted)
    ordered = F.array_sort(F.collect_list(F.struct(F.col("ordinal"), item.alias("item"))))
    return (columns.groupBy("source_id", "schema_name", "table_name")
            .agg(F.array_join(F.transform(ordered, lambda x: x["item"]), ", ").alias("select_list")))
