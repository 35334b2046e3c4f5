"""Table definitions and structure changes as DataFrame transforms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from tablebridge.functions.values import lost_in, strict_cast
from tablebridge.model import (AddColumn, AddConstraint, Alteration, AlterColumnType, ColumnDef, Constraint, DdlError,
                               DropColumn, TableDef)
from tablebridge.operators.constraints import not_null_violations, pk_violations
from tablebridge.operators.keys import assign_identity
from tablebridge.plans.constraint_report import violations
from tablebridge.sources.scan import col


def ddl_type(text: str) -> T.DataType:
    return T.StructType.fromDDL(f"c {text}").fields[0].dataType


def stored_type(data_type: T.DataType) -> T.DataType:
    """Length-limited text is plain text in flight."""
    return T.StringType() if isinstance(data_type, (T.CharType, T.VarcharType)) else data_type


def conform(df: DataFrame, definition: TableDef, order_by: Sequence[str] = ()) -> DataFrame:
    """Rows in the shape of a definition: its columns, order, types, defaults and identities.

    Identity beats default. Values that do not fit their type stop the job;
    NULLs in NOT NULL columns and broken primary keys are refused.
    """
    names = [c.name for c in definition.columns]
    if len(set(names)) != len(names) or not names:
        raise DdlError(f"{definition.name}: column names must be given and differ")
    extra = [c for c in df.columns if c not in names]
    if extra:
        raise DdlError(f"{definition.name} has no columns {extra}")
    out = df
    generated = {c.name for c in definition.columns if c.identity}
    for c in definition.columns:
        target = stored_type(ddl_type(c.data_type))
        if c.identity:
            order = list(order_by) or [n for n in df.columns if n not in generated]
            out = assign_identity(out, c.name, order, c.identity)
        elif c.name not in df.columns:
            default = F.expr(c.default) if c.default is not None else F.lit(None)
            out = out.withColumn(c.name, default.cast(target))
    limits = {c.name: ddl_type(c.data_type) for c in definition.columns}
    shaped = []
    for c in definition.columns:
        declared, value = limits[c.name], col(c.name)
        if isinstance(declared, (T.CharType, T.VarcharType)):
            text = value.cast("string")
            shaped.append(F.when(F.length(text) > declared.length, F.raise_error(F.concat(
                F.lit(f"{c.name} is longer than {declared.length}: "), text)).cast("string")).otherwise(text).alias(c.name))
        else:
            shaped.append(strict_cast(value, out.schema[c.name].dataType, declared).alias(c.name))
    out = out.select(*shaped)
    key = list(definition.primary_key.columns) if definition.primary_key else []
    required = [c.name for c in definition.columns if not c.nullable and c.name not in key]
    if required:
        bad = not_null_violations(out, required).where("nulls > 0").collect()
        if bad:
            raise DdlError(f"{definition.name}: NULL in NOT NULL columns {[(r.column_name, r.nulls) for r in bad]}")
    if key and not pk_violations(out, key).isEmpty():
        raise DdlError(f"{definition.name}: the primary key {key} is broken")
    return out


def create_as(df: DataFrame, definition: TableDef, target: str, order_by: Sequence[str] = ()) -> DataFrame:
    """Conform the rows, write them as a new table or path and return what was written."""
    out = conform(df, definition, order_by)
    spark = df.sparkSession
    if "/" in target:
        out.write.parquet(target)
        return spark.read.parquet(target)
    out.write.format("parquet").saveAsTable(target)
    return spark.table(target)


def add_column(df: DataFrame, column: ColumnDef, order_by: Sequence[str] = ()) -> DataFrame:
    """Existing rows get the identity, the default or NULL; NOT NULL needs one of the first two."""
    if column.name in df.columns:
        raise DdlError(f"column {column.name} exists already")
    if column.identity:
        return assign_identity(df, column.name, list(order_by) or df.columns, column.identity)
    if not column.nullable and column.default is None and not df.isEmpty():
        raise DdlError(f"{column.name} is NOT NULL and has no default for the existing rows")
    value = F.expr(column.default) if column.default is not None else F.lit(None)
    return df.withColumn(column.name, value.cast(stored_type(ddl_type(column.data_type))))


def drop_column(df: DataFrame, name: str) -> DataFrame:
    if name not in df.columns:
        raise DdlError(f"column {name} does not exist")
    if len(df.columns) == 1:
        raise DdlError("a table keeps at least one column")
    return df.drop(name)


def type_change_failures(df: DataFrame, name: str, data_type: str) -> DataFrame:
    """Rows whose value the new type cannot hold unchanged."""
    if name not in df.columns:
        raise DdlError(f"column {name} does not exist")
    source, declared = df.schema[name].dataType, ddl_type(data_type)
    if isinstance(declared, (T.CharType, T.VarcharType)):
        return df.where(F.length(col(name).cast("string")) > declared.length)
    return df.where(col(name).isNotNull() & lost_in(col(name), col(name).try_cast(declared), source, declared))


def alter_column_type(df: DataFrame, name: str, data_type: str) -> DataFrame:
    """All values in the new type; one that does not fit aborts the change.

    The audit is one filtered pass that stops at its first find.
    """
    failed = type_change_failures(df, name, data_type).take(1)
    if failed:
        raise DdlError(f"{name} cannot become {data_type}: {failed[0].asDict()[name]!r} does not fit")
    target = stored_type(ddl_type(data_type))
    return df.select(*[col(c).cast(target).alias(c) if c == name else col(c) for c in df.columns])


def add_constraint(df: DataFrame, constraint: Constraint, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The table unchanged when every row satisfies the constraint, else an error."""
    broken = violations(df, constraint, tables or {}).take(1)
    if broken:
        raise DdlError(f"constraint {constraint.name} is broken, for example by {broken[0].asDict()}")
    return df


def apply_alteration(df: DataFrame, step: Alteration) -> DataFrame:
    if isinstance(step, AddColumn):
        return add_column(df, step.column)
    if isinstance(step, DropColumn):
        return drop_column(df, step.name)
    if isinstance(step, AlterColumnType):
        return alter_column_type(df, step.name, step.data_type)
    if isinstance(step, AddConstraint):
        return add_constraint(df, step.constraint, step.tables)
    raise DdlError(f"unknown alteration {step!r}")


def apply_migration(df: DataFrame, steps: Sequence[Alteration]) -> DataFrame:
    """The steps in order, as one plan over the table."""
    return reduce(apply_alteration, steps, df)
