"""Bitwise float identity: NaN equals NaN, +0.0 differs from -0.0."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablebridge.sources.scan import col, require_columns

FLOATS = (T.DoubleType, T.FloatType)


def is_negative_zero(c: Column) -> Column:
    """True for -0.0 only; the text is made for zeros alone."""
    return (c == F.lit(0.0)) & c.cast("string").startswith("-")


def has_floats(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return has_floats(data_type.elementType)
    return isinstance(data_type, FLOATS)


def float_key_text(c: Column) -> Column:
    """Text that separates both zeros; every NaN reads ``NaN``."""
    return c.cast("string")


def zero_signs(c: Column, data_type: T.DataType) -> Column:
    """What grouping on ``c`` itself forgets: where its negative zeros are."""
    if isinstance(data_type, T.ArrayType):
        return F.transform(c, lambda x: zero_signs(x, data_type.elementType))
    return is_negative_zero(c)


def restore_zero_signs(c: Column, signs: Column, data_type: T.DataType) -> Column:
    """Undo the zero merging of a grouping, from the signs kept beside it."""
    if isinstance(data_type, T.ArrayType):
        return F.zip_with(c, signs, lambda x, s: restore_zero_signs(x, s, data_type.elementType))
    return F.when(signs, F.lit(-0.0).cast(data_type)).otherwise(c)


def bitwise_equal(a: Column, b: Column, data_type: T.DataType) -> Column:
    """Cell equality: NULL equals NULL, floats by their bits, arrays by element."""
    if isinstance(data_type, T.VariantType):
        return F.to_json(a).eqNullSafe(F.to_json(b))
    if not has_floats(data_type):
        return a.eqNullSafe(b)
    if isinstance(data_type, T.ArrayType):
        same = F.forall(F.zip_with(a, b, lambda x, y: bitwise_equal(x, y, data_type.elementType)), lambda e: e)
        both = a.isNotNull() & b.isNotNull()
        return (a.isNull() & b.isNull()) | F.coalesce(both & (F.size(a) == F.size(b)) & same, F.lit(False))
    signs = is_negative_zero(a).eqNullSafe(is_negative_zero(b))
    return a.eqNullSafe(b) & signs


def float_bits(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_bits``: the exact bit pattern as an integer, by Arrow views."""
    wanted = require_columns(df, columns)
    wide = {c: isinstance(df.schema[c].dataType, T.DoubleType) for c in wanted}
    schema = T.StructType(df.schema.fields + [
        T.StructField(f"{c}_bits", T.LongType() if wide[c] else T.IntegerType()) for c in wanted])

    def view(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays, names = list(batch.columns), list(batch.schema.names)
            for c in wanted:
                arrays.append(batch.column(names.index(c)).view(pa.int64() if wide[c] else pa.int32()))
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, *(f"{c}_bits" for c in wanted)])

    return df.select(*[col(c) for c in df.columns]).mapInArrow(view, schema)
