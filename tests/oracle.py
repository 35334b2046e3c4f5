"""Compare registered queries with their SQL in DuckDB: ``python tests/oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def cell(x) -> str:
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return "NULL" if x is None else "NaN"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, (int, decimal.Decimal)):
        return format(decimal.Decimal(x).normalize(), "f")
    if isinstance(x, float):
        return repr(x)
    if isinstance(x, dt.datetime):
        return x.isoformat()
    if isinstance(x, (bytes, bytearray)):
        return bytes(x).hex()
    if isinstance(x, (list, tuple)):
        return "[" + ",".join(cell(v) for v in x) + "]"
    return str(x)


def normalise(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str:
    """Empty when both sides agree, else what differs."""
    rel = con.sql(sql)
    cols = list(rel.columns)
    if sorted(cols) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(cols)}"
    types = dict(zip(cols, [str(t) for t in rel.types]))
    doubles = [f.name for f in df.schema.fields if f.dataType.simpleString() == "double" and types[f.name] != "DOUBLE"]
    ours, theirs = normalise(df.columns, df.collect()), normalise(cols, rel.fetchall())
    if doubles:
        return f"types differ in {doubles}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}"[:1500] if bad else ""


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from tablebridge.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(entry.queries())
    spark, con = local_session(8), connect(sf_dir)
    oracles, failed = entry.oracle_sql(), 0
    for name in names:
        start = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            note = compare(df, con, oracles[name]) if name in oracles else ""
            size = "" if name in oracles else f" ({len(df.collect())} rows, no SQL)"
        except Exception as exc:  # report every query
            note, size = f"{type(exc).__name__}: {str(exc)[:1200]}", ""
        failed += bool(note)
        print(f"{'FAIL' if note else 'ok  '} {name} {time.time() - start:.2f}s{size} {note}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
