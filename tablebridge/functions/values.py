"""Value normalisation as column expressions."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablebridge.model import QueryError, UnsupportedError
from tablebridge.sources.scan import col, require_columns

# Widened home of each unsigned width and its largest value (fixed values).
UNSIGNED = {
    "u8": ("smallint", 255),
    "u16": ("int", 65535),
    "u32": ("bigint", 4294967295),
    "u64": ("decimal(20,0)", 18446744073709551615),
    "year": ("int", 65535),
}

UUID_PATTERN = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def parse_schema(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def canonicalize(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Every column cast to its canonical type by one plan fixed up front.

    NULL stays NULL; a value its type cannot hold stops the job (ANSI cast).
    Only a boolean target reads numbers by ``<> 0``.
    """
    target = parse_schema(schema)
    require_columns(df, target.names)

    def decode(f: T.StructField) -> Column:
        source = df.schema[f.name].dataType
        if isinstance(f.dataType, T.BooleanType) and isinstance(source, T.NumericType):
            return tinyint_to_bool(col(f.name)).alias(f.name)
        if isinstance(f.dataType, T.VariantType) and isinstance(source, T.StringType):
            return F.parse_json(col(f.name)).alias(f.name)
        return strict_cast(col(f.name), source, f.dataType).alias(f.name)

    return df.select(*[decode(f) for f in target.fields])


def strict_cast(c: Column, source: T.DataType, target: T.DataType) -> Column:
    """A cast that fails where a value would change, whatever the session's ANSI mode."""
    if source == target:
        return c
    tried = c.try_cast(target)
    text = F.concat(F.lit(f"value does not fit {target.simpleString()}: "), c.cast("string")) \
        if not isinstance(source, (T.ArrayType, T.MapType, T.StructType)) \
        else F.lit(f"value does not fit {target.simpleString()}")
    return F.when(c.isNotNull() & lost_in(c, tried, source, target), F.raise_error(text).cast(target)).otherwise(tried)


def lost_in(c: Column, tried: Column, source: T.DataType, target: T.DataType) -> Column:
    """Whether the cast value is missing or is no longer the same number."""
    exact = (T.IntegralType, T.DecimalType)
    if isinstance(source, T.NumericType) and isinstance(target, exact):
        return tried.isNull() | (tried != c)
    if isinstance(target, (T.CharType, T.VarcharType)):
        return F.length(c.cast("string")) > target.length
    narrowed = isinstance(source, T.NumericType) and isinstance(target, (T.DoubleType, T.FloatType))
    if narrowed or isinstance(source, (T.TimestampType, T.TimestampNTZType)) and isinstance(target, T.DateType):
        return tried.isNull() | ~tried.try_cast(source).eqNullSafe(c)
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        pair = F.zip_with(c, tried, lambda x, y: x.isNotNull() & lost_in(x, y, source.elementType, target.elementType))
        return tried.isNull() | F.exists(pair, lambda e: e)
    return tried.isNull()


def widen_unsigned(df: DataFrame, widths: Mapping[str, str]) -> DataFrame:
    """Unsigned columns in the next larger signed type; out of range stops the job."""
    require_columns(df, list(widths))
    unknown = sorted(set(widths.values()) - set(UNSIGNED))
    if unknown:
        raise QueryError(f"unknown unsigned widths {unknown}")
    out = []
    for name in df.columns:
        if name not in widths:
            out.append(col(name))
            continue
        target, top = UNSIGNED[widths[name]]
        wide = col(name).cast("decimal(20,0)")
        bad = (wide < 0) | (wide > F.lit(Decimal(top)).cast("decimal(20,0)"))
        message = F.concat(F.lit(f"{name} does not fit {widths[name]}: "), col(name).cast("string"))
        out.append(F.when(bad, F.raise_error(message).cast(target)).otherwise(wide.cast(target)).alias(name))
    return df.select(*out)


def unsigned_audit(df: DataFrame, widths: Mapping[str, str]) -> DataFrame:
    """Per column the values below zero and above the width's top, in one pass."""
    require_columns(df, list(widths))
    counts, pairs = [], []
    for i, (name, width) in enumerate(widths.items()):
        wide, top = col(name).cast("decimal(38,0)"), F.lit(Decimal(UNSIGNED[width][1])).cast("decimal(38,0)")
        counts += [F.count_if(wide < 0).alias(f"n{i}"), F.count_if(wide > top).alias(f"o{i}")]
        pairs.append(F.struct(F.lit(name).alias("column_name"), F.lit(width).alias("width"),
                              F.col(f"n{i}").alias("negative"), F.col(f"o{i}").alias("too_large")))
    return df.agg(*counts).select(F.inline(F.array(*pairs)))


def bits_to_text(c: Column, length: Column | int | None = None) -> Column:
    """Binary as a bit string, most significant first; ``length`` keeps the last n bits."""
    digits = F.split(F.hex(c), "")
    nibbles = F.transform(F.filter(digits, lambda d: d != ""), lambda d: F.lpad(F.conv(d, 16, 2), 4, "0"))
    bits = F.array_join(nibbles, "")
    if length is None:
        return bits
    n = F.lit(length) if isinstance(length, int) else length
    return F.when(F.length(bits) > n, F.right(bits, n)).otherwise(bits)


def tinyint_to_bool(c: Column) -> Column:
    return c != 0


def utc_wall_clock(c: Column) -> Column:
    """An instant as its UTC wall clock, independent of the session's zone."""
    micros = F.unix_micros(c)
    seconds = (F.pmod(micros, F.lit(86_400_000_000)) / F.lit(1_000_000)).cast("decimal(18,6)")
    days = F.floor(micros / F.lit(86_400_000_000).cast("decimal(20,0)")).cast("int")
    return (F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(days, F.lit(0), F.lit(0), seconds))


def split_timestamps(df: DataFrame) -> DataFrame:
    """Instants to UTC wall clock for a target without zones; wall clocks untouched."""
    return df.select(*[
        utc_wall_clock(col(f.name)).alias(f.name) if isinstance(f.dataType, T.TimestampType) else col(f.name)
        for f in df.schema.fields])


def normalize_uuid(c: Column) -> Column:
    """Canonical lower-case text, or NULL where the value is not a UUID.

    Accepts braces, a ``urn:uuid:`` head and undashed digits.
    """
    bare = F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), "^urn:uuid:", ""), r"^\{(.*)\}$", "$1")
    dashed = F.when(F.regexp_like(bare, F.lit("^[0-9a-f]{32}$")),
                    F.regexp_replace(bare, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")).otherwise(bare)
    return F.when(F.regexp_like(dashed, F.lit(UUID_PATTERN)), dashed)


def uuid_rejects(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value is present but not a UUID."""
    require_columns(df, [column])
    return df.where(col(column).isNotNull() & normalize_uuid(col(column)).isNull())


def normalize_json(c: Column, binary: bool, strict: bool = True) -> Column:
    """``binary`` parses the document (sorted keys, compact text); verbatim keeps the text.

    Malformed text stops the job, or with ``strict=False`` becomes NULL.
    """
    if not binary:
        return c
    return F.to_json(F.parse_json(c) if strict else F.try_parse_json(c))


def decode_array(c: Column, source: T.DataType, element: T.DataType) -> Column:
    """Element-wise cast; NULL elements stay and NULL differs from an empty array."""
    if not isinstance(source, T.ArrayType):
        raise UnsupportedError(f"{source.simpleString()} is not an array")
    if isinstance(element, (T.MapType, T.StructType)):
        raise UnsupportedError(f"array elements cannot be {element.simpleString()}")
    return strict_cast(c, source, T.ArrayType(element, True))


def text_or_bytes(c: Column) -> Column:
    """Struct(text, bytes): valid UTF-8 becomes text, anything else keeps its bytes."""
    good = F.is_valid_utf8(c.cast("string"))
    return F.struct(F.when(good, c.cast("string")).alias("text"), F.when(~good, c).alias("bytes"))
