"""Bulk writes, text export, copies, partitioned layout and streams, read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tablebridge.functions.text import array_literal
from tablebridge.operators import sink
from tablebridge.plans.copy import clean_tiled, copy_table, copy_tiled, read_tiled, write_generation
from tablebridge.queries.registry import query, table
from tablebridge.session import staging_path
from tablebridge.sources.tiles import plan_key_tiles
from tablebridge.streaming.incremental import batch_counts, stream_copy, stream_scan


@query("bulk_write", """
SELECT *, 2 * (SELECT count(*) FROM orders) AS reported FROM orders
UNION ALL SELECT *, 2 * (SELECT count(*) FROM orders) FROM orders""")
def bulk(spark, d):
    """Two appends; the second brings other column names and goes by position."""
    path = staging_path(spark, "bulk")
    orders = table(spark, d, "orders")
    rows = sink.bulk_write(orders, path, "errorifexists") + sink.bulk_write(orders.toDF(*[f"c{i}" for i in range(len(orders.columns))]), path)
    return spark.read.parquet(path).withColumn("reported", F.lit(rows).cast("bigint"))


@query("estimate_row_bytes", f"""
SELECT event_id, 16 * 4 + length(event_type) + 16 + CASE WHEN event_type = 'view' THEN 36 WHEN event_type = 'error' THEN 16 ELSE 256 END AS row_bytes
FROM events""")
def row_bytes(spark, d):
    events = table(spark, d, "events").withColumn("props", F.expr(
        "CASE WHEN event_type = 'view' THEN concat('\"', event_type, '\"') WHEN event_type = 'error' THEN NULL ELSE props END"))
    return sink.estimate_row_bytes(events, ["props"]).select("event_id", "row_bytes")


@query("estimate_row_bytes_text", "SELECT doc_id, strlen(text) + strlen(lang) + strlen(source) + 80 AS row_bytes FROM documents")
def row_bytes_text(spark, d):
    return sink.estimate_row_bytes(table(spark, d, "documents")).select("doc_id", "row_bytes")


def _greedy_sql(name: str, order: str, size: str, max_rows: int, budget: int) -> str:
    """The plan by a walk from batch to batch."""
    return f"""
WITH RECURSIVE s AS (SELECT row_number() OVER (ORDER BY {order}) - 1 AS i, CAST({size} AS BIGINT) AS size, count(*) OVER () AS n FROM {name}),
c AS (SELECT i, n, CAST(sum(size) OVER (ORDER BY i) AS BIGINT) AS total, CAST(sum(size) OVER (ORDER BY i) AS BIGINT) - size AS before FROM s),
x AS (SELECT a.i, a.n, a.before, least(a.i + {max_rows}, coalesce(b.i + 1, a.n), a.n) AS nx FROM c a ASOF LEFT JOIN c b ON a.before + {budget} <= b.total),
w(batch, i) AS (SELECT 0::BIGINT, 0::BIGINT UNION ALL SELECT batch + 1, nx FROM w JOIN x USING (i) WHERE nx < n)
SELECT batch, i AS first_row, nx - i AS rows, c.total - x.before AS bytes FROM w JOIN x USING (i) JOIN c ON c.i = nx - 1"""


_LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]  # line numbers repeat
_DOC_BYTES = "strlen(text) + strlen(lang) + strlen(source) + 80"
_LINE_BYTES = " + ".join(f"strlen({c}::VARCHAR)" for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus")) + "".join(
    f" + strlen(regexp_replace({c}::VARCHAR, '\\.0$', ''))" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")) + " + 19 + 11"


@query("plan_write_batches", _greedy_sql("documents", "doc_id", _DOC_BYTES, 500, 256 * 1024))
def write_batches(spark, d):
    return sink.plan_write_batches(table(spark, d, "documents"), ["doc_id"], byte_budget=256 * 1024)


@query("plan_write_batches_totals", """
SELECT count(*) AS rows, CAST(sum(strlen(text) + strlen(lang) + strlen(source) + 80) AS BIGINT) AS bytes, TRUE AS within_caps FROM documents""")
def write_batch_totals(spark, d):
    planned = sink.plan_write_batches(table(spark, d, "documents"), ["doc_id"], byte_budget=256 * 1024)
    return planned.agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.every(F.col("rows") <= 500).alias("within_caps"))


@query("copy_flush_plan", _greedy_sql("lineitem", ", ".join(_LINE_ORDER), _LINE_BYTES, 10_000, 1024 * 1024))
def flushes(spark, d):
    return sink.copy_flush_plan(table(spark, d, "lineitem"), _LINE_ORDER)


@query("copy_flush_plan_small_buffers", _greedy_sql("lineitem", ", ".join(_LINE_ORDER), _LINE_BYTES, 150, 8 * 1024))
def small_flushes(spark, d):
    """Buffers so small that the table is many blocks, whose plans are composed."""
    return sink.copy_flush_plan(table(spark, d, "lineitem"), _LINE_ORDER, flush_rows=150, flush_bytes=8 * 1024)


_STAMP_SQL = r"""regexp_replace(regexp_replace(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '\.000000$', ''), '(\.\d{3})000$', '\1')"""


@query("export_copy_text", f"""
SELECT event_id || chr(9) || {_STAMP_SQL} || chr(9) || user_id || chr(9) || coalesce(nullif(event_type, 'click'), '\\N') || chr(9)
 || regexp_replace(value::VARCHAR, '\\.0$', '') || chr(9) || props || chr(9) || (CASE WHEN value > 5 THEN 't' ELSE 'f' END) AS value FROM events""")
def export(spark, d):
    path = staging_path(spark, "export")
    events = (table(spark, d, "events").withColumn("event_type", F.nullif("event_type", F.lit("click")))
              .withColumn("high", F.col("value") > 5))
    sink.export_copy_text(events, path)
    return spark.read.text(path)


@query("export_copy_text_escapes", r"""
SELECT doc_id || chr(9) || replace(replace(replace(replace(text || chr(9) || '\' || chr(13), '\', '\\'), chr(9), '\t'), chr(10), '\n'), chr(13), '\r')
 || chr(9) || '\\x' || lower(hex(encode(lang))) AS value FROM documents""")
def export_escapes(spark, d):
    path = staging_path(spark, "export")
    docs = table(spark, d, "documents").select(
        "doc_id", F.concat("text", F.lit("\t\\\r")).alias("text"), F.encode("lang", "UTF-8").alias("raw"))
    sink.export_copy_text(docs, path)
    return spark.read.text(path)


@query("array_literal", """
SELECT vec_id, '{' || list_aggregate([CASE WHEN x < -0.2 THEN 'NULL' ELSE '"' || floor(x::DOUBLE * 1000)::BIGINT || '"' END FOR x IN embedding], 'string_agg', ',') || '}' AS literal
FROM embeddings""")
def arrays(spark, d):
    cut = table(spark, d, "embeddings").select("vec_id", F.expr(
        "transform(embedding, x -> if(x < -0.2D, null, cast(floor(double(x) * 1000) as bigint)))").alias("v"))
    return cut.select("vec_id", array_literal(F.col("v"), cut.schema["v"].dataType).alias("literal"))


@query("array_literal_nested", r"""
SELECT page_id, '{{"' || replace(replace(html, '\', '\\'), '"', '\"') || '"},{"' || replace(replace(url, '\', '\\'), '"', '\"') || '",NULL}}' AS literal FROM pages""")
def nested_arrays(spark, d):
    pages = table(spark, d, "pages").select("page_id", F.expr("array(array(html), array(url, null))").alias("v"))
    return pages.select("page_id", array_literal(F.col("v"), pages.schema["v"].dataType).alias("literal"))


@query("adapt_for_target", """
SELECT event_id, ts - INTERVAL 2 HOUR AS seen, ts AS wall, '["' || event_type || '",null]' AS tags FROM events""")
def adapt(spark, d):
    events = table(spark, d, "events").select(
        "event_id", F.to_timestamp(F.concat(F.col("ts").cast("string"), F.lit("+02:00"))).alias("seen"), F.col("ts").alias("wall"),
        F.array("event_type", F.lit(None)).alias("tags"))
    return sink.adapt_for_target(events, "mysql", arrays="json")


@query("copy_table", """
SELECT l_orderkey, CAST(l_linenumber AS SMALLINT) AS l_linenumber, CAST(l_extendedprice AS DECIMAL(15,2)) AS l_extendedprice, l_shipdate, TRUE AS verified
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01'""")
def copy(spark, d):
    path = staging_path(spark, "copy")
    done = copy_table(spark, f"{d}/lineitem.parquet", path, ["l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate"],
                      ("l_shipdate", dt.datetime(1996, 1, 1), None),
                      "l_orderkey bigint, l_linenumber smallint, l_extendedprice decimal(15,2), l_shipdate timestamp_ntz")
    return spark.read.parquet(path).withColumn("verified", F.lit(done.check.verified))


_TILED_SQL = """
WITH o AS (SELECT *, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey END AS k FROM orders),
 e AS (SELECT min(k) AS lo, max(k) AS hi FROM o), b AS (SELECT lo + (i * (hi - lo + 1)) // {n} AS bound FROM e, range(1, {n}) r(i))
SELECT o.*, CASE WHEN k IS NULL THEN -1 ELSE (SELECT count(*) FROM b WHERE bound <= k) END::INTEGER AS tile_id FROM o"""


def _keyed_orders(spark, d):
    return table(spark, d, "orders").withColumn("k", F.expr("CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END"))


@query("copy_tiled", _TILED_SQL.format(n=12))
def tiled_copy(spark, d):
    """A first run copies a tile of another plan, a second starts over, a third copies only the missing tiles."""
    orders = _keyed_orders(spark, d)
    plan = plan_key_tiles(orders, "k", 12, "equal_width")
    path, ledger = staging_path(spark, "tiled"), staging_path(spark, "ledger")
    copy_tiled(orders, "k", plan_key_tiles(orders, "k", 3, "equal_width")[:1], path, ledger)
    first = copy_tiled(orders, "k", plan[:5], path, ledger, per_commit=4)
    second = copy_tiled(orders, "k", plan, path, ledger, per_commit=4)
    if (first, second) != (5, len(plan) - 5):
        raise AssertionError("a finished tile was copied again")
    return read_tiled(spark, path, ledger)


@query("copy_tiled_after_crashes", _TILED_SQL.format(n=4))
def tiled_copy_after_crashes(spark, d):
    """A run that dies between data and ledger, one that stops half-way, then a coarser plan; strays are removed."""
    orders = _keyed_orders(spark, d)
    fine, coarse = (plan_key_tiles(orders, "k", n, "equal_width") for n in (12, 4))
    path, ledger = staging_path(spark, "tiled"), staging_path(spark, "ledger")
    write_generation(orders, "k", fine, fine, path, ledger)
    copy_tiled(orders, "k", fine[:7], path, ledger, per_commit=3)
    write_generation(orders, "k", coarse, coarse[:2], path, ledger)
    copy_tiled(orders, "k", coarse, path, ledger)
    if len(clean_tiled(spark, path, ledger)) != 5:
        raise AssertionError("folders that no manifest names were left")
    return read_tiled(spark, path, ledger)


_SPEC = sink.RangePartitions("o_orderdate", [("before_1996", None, dt.datetime(1996, 1, 1)),
                                             ("y1996_1997", dt.datetime(1996, 1, 1), dt.datetime(1998, 1, 1)),
                                             ("y1998", dt.datetime(1998, 1, 1), dt.datetime(1999, 1, 1))])
_CHILD_SQL = """CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN 'before_1996' WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'y1996_1997'
 WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'y1998' END"""


@query("partitioned_write", f"SELECT *, coalesce({_CHILD_SQL}, 'rest') AS child FROM orders")
def partitioned(spark, d):
    path = staging_path(spark, "partitioned")
    sink.partitioned_write(table(spark, d, "orders"), path, _SPEC, default_child="rest")
    return spark.read.parquet(path)


@query("partitioned_write_list", """
SELECT *, CASE WHEN event_type IN ('view', 'click') THEN 'browse' WHEN event_type = 'purchase' THEN 'buy' ELSE 'other' END AS child FROM events""")
def partitioned_list(spark, d):
    path = staging_path(spark, "partitioned")
    spec = sink.ListPartitions("event_type", {"browse": ["view", "click"], "buy": ["purchase"]})
    sink.partitioned_write(table(spark, d, "events"), path, spec, default_child="other")
    return spark.read.parquet(path)


@query("partition_rollup", f"""
SELECT CASE WHEN g = 1 THEN 'parent' WHEN child IS NULL THEN 'outside' ELSE 'child' END AS part, child, rows FROM (
 SELECT child, grouping(child) AS g, count(*) AS rows FROM (SELECT {_CHILD_SQL} AS child FROM orders) GROUP BY ROLLUP (child))""")
def rollup(spark, d):
    return sink.partition_rollup(table(spark, d, "orders"), _SPEC)


def _streamed(spark, d, name, **scan):
    """One available-now run over the table's files; returns the target path."""
    path = staging_path(spark, "stream")
    stream = stream_scan(spark, d, table(spark, d, name).schema, glob=f"{name}.parquet", **scan)
    stream_copy(stream, path, staging_path(spark, "progress")).awaitTermination()
    return path


@query("stream_scan", "SELECT event_id, user_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'")
def streamed_scan(spark, d):
    path = _streamed(spark, d, "events", columns=["event_id", "user_id", "value"],
                     key_range=("ts", dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20)))
    return spark.read.parquet(path).drop("batch_id")


@query("stream_copy", "SELECT 0 AS batch_id, count(*) AS rows FROM events")
def streamed_copy(spark, d):
    return batch_counts(spark, _streamed(spark, d, "events"))
