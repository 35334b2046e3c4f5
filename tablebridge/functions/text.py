"""The tab-separated text form of rows that PostgreSQL's COPY reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablebridge.functions.values import utc_wall_clock
from tablebridge.model import UnsupportedError
from tablebridge.sources.scan import KEEP_NULLS, col

NULL_MARK = "\\N"


def float_text(c: Column) -> Column:
    """Shortest decimal text without exponent: ``1``, ``0.00001``, ``inf``, ``-0``."""
    raw = c.cast("string")
    plain = F.regexp_replace(raw, r"\.0$", "")
    shape = r"^(-?)(\d)\.(\d+)E(-?\d+)$"
    sign, lead = F.regexp_extract(raw, shape, 1), F.regexp_extract(raw, shape, 2)
    tail = F.regexp_replace(F.regexp_extract(raw, shape, 3), "0+$", "")
    power = F.regexp_extract(raw, shape, 4).try_cast("int")
    digits, width = F.concat(lead, tail), F.length(tail)
    moved = (F.when(power < 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits))
             .when(power >= width, F.concat(digits, F.repeat(F.lit("0"), power - width)))
             .otherwise(F.concat(F.substring(digits, F.lit(1), power + 1), F.lit("."),
                                 F.substring(digits, power + 2, width))))
    return (F.when(F.isnan(c), "NaN")
            .when(raw == "Infinity", "inf").when(raw == "-Infinity", "-inf")
            .when(F.contains(raw, F.lit("E")), F.concat(sign, moved))
            .otherwise(plain))


def wall_clock_text(c: Column) -> Column:
    """ISO date and time with no fraction or one of 3 or 6 digits."""
    raw = c.cast("string")
    fraction = F.regexp_extract(raw, r"\.(\d+)$", 1)
    head = F.regexp_replace(raw, r"\.\d+$", "")
    digits = F.length(fraction)
    return (F.when(digits == 0, head)
            .when(digits <= 3, F.concat(head, F.lit("."), F.rpad(fraction, 3, "0")))
            .otherwise(F.concat(head, F.lit("."), F.rpad(fraction, 6, "0"))))


def plain_text(c: Column, data_type: T.DataType) -> Column:
    """A scalar's text before any escaping."""
    if isinstance(data_type, T.BooleanType):
        return F.when(c, "t").when(~c, "f")
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return float_text(c)
    if isinstance(data_type, T.BinaryType):
        return F.concat(F.lit("\\x"), F.lower(F.hex(c)))
    if isinstance(data_type, T.TimestampNTZType):
        return wall_clock_text(c)
    if isinstance(data_type, T.TimestampType):
        return F.concat(wall_clock_text(utc_wall_clock(c)), F.lit("+00:00"))
    if isinstance(data_type, T.TimeType):
        return wall_clock_text(c)
    if isinstance(data_type, (T.VariantType, T.StructType, T.MapType)):
        return F.to_json(c, KEEP_NULLS)
    if isinstance(data_type, (T.IntegralType, T.DecimalType, T.StringType, T.DateType)):
        return c.cast("string")
    raise UnsupportedError(f"no text form for {data_type.simpleString()}")


def array_literal(c: Column, data_type: T.DataType) -> Column:
    """``{"a",NULL,{"nested"}}``: quoted elements with quotes and backslashes escaped."""
    if not isinstance(data_type, T.ArrayType):
        raise UnsupportedError(f"{data_type.simpleString()} is not an array")
    element = data_type.elementType

    def one(x: Column) -> Column:
        if isinstance(element, T.ArrayType):
            return F.coalesce(array_literal(x, element), F.lit("NULL"))
        quoted = F.replace(F.replace(plain_text(x, element), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
        return F.coalesce(F.concat(F.lit('"'), quoted, F.lit('"')), F.lit("NULL"))

    return F.concat(F.lit("{"), F.array_join(F.transform(c, one), ","), F.lit("}"))


def escape_copy(c: Column) -> Column:
    """Backslash first, then tab, line feed and carriage return."""
    out = c
    for raw, escaped in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        out = F.replace(out, F.lit(raw), F.lit(escaped))
    return out


def copy_field(c: Column, data_type: T.DataType) -> Column:
    text = array_literal(c, data_type) if isinstance(data_type, T.ArrayType) else plain_text(c, data_type)
    free_text = (T.StringType, T.ArrayType, T.BinaryType, T.VariantType, T.StructType, T.MapType)
    return F.coalesce(escape_copy(text) if isinstance(data_type, free_text) else text, F.lit(NULL_MARK))


def copy_line(df: DataFrame) -> Column:
    """A row as one COPY text line, without the line end."""
    return F.concat_ws("\t", *[copy_field(col(f.name), f.dataType) for f in df.schema.fields])
