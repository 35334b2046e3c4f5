"""Key values between Spark, the driver and SQL text."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, functions as F, types as T

_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def outgoing(c: Column, data_type: T.DataType) -> Column:
    """Instants leave Spark as microseconds, free of the driver's own time zone."""
    return F.unix_micros(c) if isinstance(data_type, T.TimestampType) else c


def incoming(value: Any, data_type: T.DataType) -> Any:
    if value is not None and isinstance(data_type, T.TimestampType):
        return _EPOCH + dt.timedelta(microseconds=value)
    return value


def literal_sql(value: Any, data_type: T.DataType) -> str:
    """A typed literal as SQL text; text travels as hex, so nothing needs escaping."""
    if value is None:
        return f"CAST(NULL AS {data_type.simpleString()})"
    if isinstance(value, str):
        return f"decode(X'{value.encode().hex()}', 'UTF-8')"
    if isinstance(value, (bytes, bytearray)):
        return f"X'{bytes(value).hex()}'"
    text = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else str(value)
    return f"CAST('{text}' AS {data_type.simpleString()})"


def search_sql(key: str, edges: Sequence[str], ids: Sequence[int]) -> str:
    """A balanced tree of comparisons, log2(n) tests per row, as SQL text.

    Text is parsed in one step; a tree of a thousand column objects takes
    seconds to build.
    """
    def tree(lo: int, hi: int) -> str:
        if lo == hi:
            return str(ids[lo])
        mid = (lo + hi) // 2
        return f"CASE WHEN {key} < {edges[mid]} THEN {tree(lo, mid)} ELSE {tree(mid + 1, hi)} END"

    return tree(0, len(ids) - 1)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def composite_sql(parts: Sequence[str]) -> str:
    return "named_struct(" + ", ".join(f"'k{i}', {p}" for i, p in enumerate(parts)) + ")"
