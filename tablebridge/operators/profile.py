"""Reflection of a data table that has no catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tablebridge.sources.scan import col


def profile_table(df: DataFrame, exact: bool = False) -> DataFrame:
    """Per column: type, NULLs, distinct values, min, max and greatest text length.

    Everything but an exact distinct count comes from one pass. ``exact``
    counts each column's distinct values by its own two-step aggregation over
    (column, value), which combines before the shuffle.
    """
    fields = df.schema.fields
    flat = [not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)) for f in fields]
    aggs, items = [F.count(F.lit(1)).alias("rows")], []
    for i, (f, simple) in enumerate(zip(fields, flat)):
        c = col(f.name)
        aggs.append(F.count_if(c.isNull()).alias(f"n{i}"))
        span = simple and not isinstance(f.dataType, T.BinaryType)
        lo = F.min(c).cast("string") if span else F.lit(None).cast("string")
        hi = F.max(c).cast("string") if span else F.lit(None).cast("string")
        aggs += [lo.alias(f"lo{i}"), hi.alias(f"hi{i}")]
        sized = isinstance(f.dataType, (T.StringType, T.BinaryType))
        aggs.append((F.max(F.length(c)) if sized else F.max(F.lit(None).cast("int"))).alias(f"len{i}"))
        if not exact:
            aggs.append((F.approx_count_distinct(c) if simple else F.max(F.lit(None).cast("bigint"))).alias(f"d{i}"))
        items.append(F.struct(
            F.lit(f.name).alias("column_name"), F.lit(i + 1).alias("ordinal"),
            F.lit(f.dataType.simpleString()).alias("type"), F.col("rows"), F.col(f"n{i}").alias("nulls"),
            F.col(f"lo{i}").alias("min_value"), F.col(f"hi{i}").alias("max_value"),
            F.col(f"len{i}").cast("int").alias("max_length"),
            *([] if exact else [F.col(f"d{i}").alias("distinct_values")])))
    profile = df.agg(*aggs).select(F.inline(F.array(*items)))
    if not exact:
        return profile
    cells = df.select(F.inline(F.array(*[
        F.struct(F.lit(i + 1).alias("ordinal"), col(f.name).cast("string").alias("v"))
        for i, (f, simple) in enumerate(zip(fields, flat)) if simple])))
    counts = (cells.where(F.col("v").isNotNull()).distinct().groupBy("ordinal")
              .agg(F.count(F.lit(1)).alias("distinct_values")))
    nested = [i + 1 for i, simple in enumerate(flat) if not simple]
    found = F.when(~F.col("ordinal").isin(nested) if nested else F.lit(True), F.coalesce("distinct_values", F.lit(0)))
    return profile.join(counts, "ordinal", "left").select(*profile.columns, found.alias("distinct_values"))
