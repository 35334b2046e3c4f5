"""Finding keys, generating identity and sequence values, clustered layout."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tablebridge.model import DdlError, Identity, QueryError, SequenceDef
from tablebridge.operators.constraints import unique_violations
from tablebridge.operators.discovery import discover_inclusions, discover_keys  # noqa: F401
from tablebridge.sources.batches import number_rows, tie_columns, with_tie_break
from tablebridge.sources.scan import col, require_columns


def discover_foreign_keys(tables: Mapping[str, DataFrame], keys: Mapping[str, str],
                          columns: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Inclusion dependencies: columns whose every value occurs in some table's key.

    ``keys`` names one key column per referenced table. Integer and text columns
    are compared within their own class, as whole inclusions of one column.
    """
    def wanted(table: str, f: T.StructField) -> bool:
        chosen = columns is None or f.name in columns.get(table, ()) or keys.get(table) == f.name
        return chosen and isinstance(f.dataType, (T.IntegralType, T.StringType))

    compared = {t: df.select(*[col(f.name) for f in df.schema.fields if wanted(t, f)]) for t, df in tables.items()}
    found = discover_inclusions(compared, references={t: [c] for t, c in keys.items()})
    return found.select(F.col("col_names").alias("col_name"), F.col("ref_names").alias("ref_name"), "distinct_values")


def assign_identity(df: DataFrame, column: str, order_by: Sequence[str], identity: Identity = Identity()) -> DataFrame:
    """Fill ``column`` with generated numbers.

    ``always`` refuses supplied values and numbers every row; ``by_default``
    keeps supplied values and numbers the rest past the furthest of them.
    """
    supplied = column in df.columns
    step, first = identity.increment, identity.start
    if supplied and identity.mode == "always" and not df.where(col(column).isNotNull()).isEmpty():
        raise DdlError(f"{column} is generated always and takes no supplied values")
    if not supplied or identity.mode == "always":
        base = df.drop(column) if supplied else df
        numbered = number_rows(base, order_by, "_n")
        out = numbered.withColumn(column, F.lit(first).cast("bigint") + F.col("_n") * step).drop("_n")
        return out.select(*df.columns) if supplied else out
    furthest = df.agg((F.max if step > 0 else F.min)(col(column))).first()[0]
    if furthest is not None and (furthest - first) * (1 if step > 0 else -1) >= 0:
        first = first + ((furthest - first) // step + 1) * step
    kept = df.where(col(column).isNotNull()).withColumn(column, col(column).cast("bigint"))
    numbered = number_rows(df.where(col(column).isNull()).drop(column), order_by, "_n")
    fresh = numbered.withColumn(column, F.lit(first).cast("bigint") + F.col("_n") * step).drop("_n")
    return kept.unionByName(fresh).select(*df.columns)


def sequence_value(index: Column, seq: SequenceDef) -> Column:
    """The value after ``index`` draws (from 0): start, then past the end by cycle or an error."""
    edge, restart = (seq.max_value, seq.min_value) if seq.increment > 0 else (seq.min_value, seq.max_value)
    first_run = (edge - seq.start) // seq.increment + 1
    full_run = (edge - restart) // seq.increment + 1
    def number(n: int) -> Column:
        return F.lit(Decimal(n)).cast("decimal(20,0)")

    i = index.cast("decimal(20,0)")
    plain = number(seq.start) + i * number(seq.increment)
    if seq.cycle:
        again = number(restart) + F.pmod(i - number(first_run), number(full_run)) * number(seq.increment)
        return F.when(i < number(first_run), plain).otherwise(again).cast("bigint")
    ended = F.raise_error("the sequence reached its end").cast("bigint")
    return F.when(i < number(first_run), plain.cast("bigint")).otherwise(ended)


def sequence_values(spark: SparkSession, n: int, seq: SequenceDef) -> DataFrame:
    """The first ``n`` draws as (draw, value)."""
    if n < 0:
        raise QueryError("the number of draws must not be negative")
    return spark.range(n).select(F.col("id").alias("draw"), sequence_value(F.col("id"), seq).alias("value"))


def draw_sequence(df: DataFrame, order_by: Sequence[str], seq: SequenceDef, name: str = "value") -> DataFrame:
    """One draw per row, in the order of ``order_by``."""
    return number_rows(df, order_by, "_n").withColumn(name, sequence_value(F.col("_n"), seq)).drop("_n")


def clustered_write(df: DataFrame, path: str, columns: Sequence[str], descending: Sequence[bool] = (),
                    unique: bool = False, mode: str = "errorifexists") -> None:
    """An index as physical layout: files in key order, each sorted.

    Min/max statistics then prune files and row groups for the index columns.
    The ranges also split on a tie break, so a hot key fills many files.
    """
    require_columns(df, columns)
    if unique and not unique_violations(df, columns).isEmpty():
        raise DdlError(f"the index columns {list(columns)} are not unique")
    flags = [*descending, *[False] * (len(columns) - len(descending))]
    order = [col(c).desc() if d else col(c).asc() for c, d in zip(columns, flags)]
    (with_tie_break(df).repartitionByRange(*order, *tie_columns())
     .sortWithinPartitions(*order, *tie_columns()).drop(*tie_columns()).write.mode(mode).parquet(path))


def bucketed_write(df: DataFrame, table: str, columns: Sequence[str], buckets: int, sort: bool = True,
                   mode: str = "errorifexists") -> None:
    """A hash index as buckets: joins and lookups on the columns need no shuffle."""
    require_columns(df, columns)
    writer = df.write.mode(mode).format("parquet").bucketBy(buckets, *columns)
    (writer.sortBy(*columns) if sort else writer).saveAsTable(table)
