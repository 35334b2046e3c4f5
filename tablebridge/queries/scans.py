"""Scans, ranges, tiles, batches and bound SQL."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import functions as F

from tablebridge.operators.verify import table_fingerprint
from tablebridge.queries.registry import query, table
from tablebridge.sources import scan, tileindex, tiles
from tablebridge.sources.batches import batch_rows


@query("scan_table", "SELECT * FROM lineitem")
def scan_all(spark, d):
    return scan.scan_table(spark, f"{d}/lineitem.parquet")


@query("project", "SELECT o_totalprice, o_orderkey, o_orderpriority FROM orders")
def project(spark, d):
    return scan.scan_table(spark, f"{d}/orders.parquet", ["o_totalprice", "o_orderkey", "o_orderpriority"])


@query("key_range_scan_timestamp", """
SELECT o_orderkey, o_custkey, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1997-07-01'""")
def range_timestamp(spark, d):
    orders = scan.scan_table(spark, f"{d}/orders.parquet", ["o_orderkey", "o_custkey", "o_orderdate"])
    return scan.key_range_scan(orders, "o_orderdate", dt.datetime(1995, 1, 1), dt.datetime(1997, 7, 1))


@query("key_range_scan_text", """
SELECT c_custkey, c_mktsegment FROM (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment FROM customer)
WHERE c_mktsegment >= 'B' AND c_mktsegment < 'HOUSEHOLD'""")
def range_text(spark, d):
    customer = table(spark, d, "customer").select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"))
    return scan.key_range_scan(customer, "c_mktsegment", "B", "HOUSEHOLD")


@query("key_range_scan_double", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 25.5")
def range_double(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return scan.key_range_scan(lines, "l_quantity", lower=25.5)


_KEYED_ORDERS = "SELECT o_orderkey, o_totalprice, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderkey END AS k FROM orders"
_EQUAL_BOUNDS = "lo + (i * (hi - lo + 1)) // 16"


def _keyed_orders(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", "o_totalprice", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey")).alias("k"))


@query("plan_key_tiles", f"""
WITH s AS (SELECT min(k) AS lo, max(k) AS hi FROM ({_KEYED_ORDERS})),
     b AS (SELECT i::INTEGER AS i, {_EQUAL_BOUNDS} AS bound FROM s, range(1, 16) r(i))
SELECT coalesce(u.i - 1, 15)::INTEGER AS tile_id, l.bound AS lower, u.bound AS upper, FALSE AS is_null
FROM (SELECT * FROM b UNION ALL SELECT 0, NULL) l LEFT JOIN b u ON u.i = l.i + 1
UNION ALL SELECT -1, NULL, NULL, TRUE""")
def plan_tiles(spark, d):
    planned = tiles.plan_key_tiles(_keyed_orders(spark, d), "k", 16, "equal_width")
    return spark.createDataFrame([(t.tile_id, t.lower, t.upper, t.is_null) for t in planned],
                                 "tile_id int, lower bigint, upper bigint, is_null boolean")


@query("tiled_scan", f"""
WITH o AS ({_KEYED_ORDERS}), s AS (SELECT min(k) AS lo, max(k) AS hi FROM o),
     b AS (SELECT i, {_EQUAL_BOUNDS} AS bound FROM s, range(1, 16) r(i))
SELECT o_orderkey, o_totalprice, k,
       CASE WHEN k IS NULL THEN -1 ELSE (SELECT count(*) FROM b WHERE b.bound <= k) END::INTEGER AS tile_id
FROM o""")
def tiled(spark, d):
    orders = _keyed_orders(spark, d)
    return tiles.tiled_scan(orders, "k", tiles.plan_key_tiles(orders, "k", 16, "equal_width"))


@query("tile_coverage", f"""
WITH o AS ({_KEYED_ORDERS}), s AS (SELECT min(k) AS lo, max(k) AS hi FROM o),
     b AS (SELECT i, {_EQUAL_BOUNDS} AS bound FROM s, range(1, 16) r(i)),
     g AS (SELECT k, CASE WHEN k IS NULL THEN -1 ELSE (SELECT count(*) FROM b WHERE b.bound <= k) END AS tile_id FROM o)
SELECT tile_id::INTEGER AS tile_id, count(*) AS rows, min(k) AS min_key, max(k) AS max_key FROM g GROUP BY tile_id""")
def coverage(spark, d):
    orders = _keyed_orders(spark, d)
    return tiles.tile_coverage(orders, "k", tiles.plan_key_tiles(orders, "k", 16, "equal_width"))


@query("tile_coverage_quantile", """
SELECT count(*) AS rows, count(DISTINCT l_partkey) AS keys, min(l_partkey) AS min_key, max(l_partkey) AS max_key FROM lineitem""")
def coverage_quantile(spark, d):
    """Quantile tiles tile the table exactly: their distinct keys and rows add up."""
    lines = table(spark, d, "lineitem").select("l_partkey")
    planned = tiles.plan_key_tiles(lines, "l_partkey", 32)
    per_key = tiles.tiled_scan(lines, "l_partkey", planned).groupBy("tile_id", "l_partkey").agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("keys"),
                       F.min("l_partkey").alias("min_key"), F.max("l_partkey").alias("max_key"))


@query("tiled_scan_indexed", """
WITH s AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders),
     b AS (SELECT bound, row_number() OVER (ORDER BY bound) AS i FROM (SELECT DISTINCT lo + (i * (hi - lo + 1)) // 2000 AS bound FROM s, range(1, 2000) r(i)))
SELECT o.*, coalesce(b.i, 0)::INTEGER AS tile_id FROM orders o ASOF LEFT JOIN b ON o.o_orderkey >= b.bound""")
def tiled_indexed(spark, d):
    """Two thousand tiles, fewer where bounds repeat: rows find theirs by joins down the index."""
    orders = table(spark, d, "orders")
    return tiles.tiled_scan(orders, "o_orderkey", tiles.plan_key_tiles(orders, "o_orderkey", 2000, "equal_width"))


def _balance(df, columns, n, weight):
    """Tiles, rows and weight found in them, and whether each holds its share as near as the sketch states."""
    named = df.withColumn("_w", weight)
    tagged = tileindex.tag_tiles(named, columns, tileindex.plan_tile_frame(named, columns, n, F.col("_w")))
    per = tagged.groupBy("tile_id").agg(F.count(F.lit(1)).alias("rows"), F.sum("_w").cast("long").alias("weight"), F.max("_w").alias("widest"))
    total, found = per.agg(F.sum("weight")).first()[0], per.count()
    # Both ends of a tile may be off by the error of a task's summary and of a group's.
    error = 2 * 2 * (2 + math.log2(1 + df.count() / tileindex.LEAST)) / tileindex.LEAST
    near = F.abs(F.col("weight") - total / n) <= F.lit(error * total) + 2 * F.col("widest")
    return per.agg(F.sum("rows").alias("rows"), F.sum("weight").alias("weight"), F.lit(found).cast("long").alias("tiles"),
                   F.every(near).alias("near"))


@query("plan_tiles_composite", """
SELECT count(*) AS rows, count(*) AS weight, 40::BIGINT AS tiles, TRUE AS near FROM lineitem""")
def plan_composite(spark, d):
    """Tiles of equal rows over a composite key whose first column repeats."""
    return _balance(table(spark, d, "lineitem"), ["l_shipdate", "l_orderkey", "l_linenumber"], 40, F.lit(1.0))


@query("plan_tiles_text_bytes", """
SELECT count(*) AS rows, sum(40 + octet_length(encode(c_name)) + octet_length(encode(c_mktsegment)))::BIGINT AS weight, 12::BIGINT AS tiles, TRUE AS near
FROM customer""")
def plan_text_bytes(spark, d):
    """Tiles of equal bytes over a text key."""
    return _balance(table(spark, d, "customer"), ["c_name"], 12,
                    F.lit(40) + F.octet_length("c_name") + F.octet_length("c_mktsegment"))


@query("batch_rows", """
SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS row_index,
       (row_number() OVER (ORDER BY event_id) - 1) // 1000 AS batch_id FROM events""")
def batches(spark, d):
    return batch_rows(table(spark, d, "events"), ["event_id"], 1000)


@query("batch_rows_copies", """
WITH c AS (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_orderkey END AS k FROM lineitem)
SELECT k, row_number() OVER (ORDER BY k) - 1 AS row_index, (row_number() OVER (ORDER BY k) - 1) // 500 AS batch_id FROM c""")
def batches_of_copies(spark, d):
    """A third of the rows are copies of one."""
    copies = table(spark, d, "lineitem").select(F.expr("CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_orderkey END AS k"))
    return batch_rows(copies, ["k"], 500)


@query("batch_rows_composite", """
SELECT conv_id, turn, role, row_number() OVER (ORDER BY conv_id, turn) - 1 AS row_index,
       (row_number() OVER (ORDER BY conv_id, turn) - 1) // 64 AS batch_id FROM conversations""")
def batches_composite(spark, d):
    return batch_rows(table(spark, d, "conversations").select("conv_id", "turn", "role"), ["conv_id", "turn"], 64)


@query("run_query_join_aggregate", """
SELECT n_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND c_mktsegment <> 'MACHINERY' GROUP BY n_name""")
def bound_join(spark, d):
    return scan.run_query_lazy(spark, """
        SELECT n_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM {orders}
        JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
        WHERE o_orderdate >= cast(:since AS timestamp_ntz) AND c_mktsegment <> :segment GROUP BY n_name""",
        {"since": "1996-01-01", "segment": "MACHINERY"}, orders=table(spark, d, "orders"),
        customer=table(spark, d, "customer"), nation=table(spark, d, "nation"))


@query("run_query_window", """
SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS nth
FROM events WHERE value >= 3.5""")
def bound_window(spark, d):
    return scan.run_query_lazy(spark, """
        SELECT user_id, event_id, event_type,
               cast(row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS bigint) AS nth
        FROM {events} WHERE value >= ?""", [3.5], events=table(spark, d, "events"))


@query("run_query_set_operation", """
SELECT c_nationkey AS nationkey FROM customer WHERE c_acctbal < 100.0
EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal >= 9000.0""")
def bound_set(spark, d):
    return scan.run_query_lazy(spark, """
        SELECT c_nationkey AS nationkey FROM {customer} WHERE c_acctbal < ?
        EXCEPT SELECT s_nationkey FROM {supplier} WHERE s_acctbal >= ?""", [100.0, 9000.0],
        customer=table(spark, d, "customer"), supplier=table(spark, d, "supplier"))


@query("run_query_small_result", """
SELECT l_returnflag, l_linestatus, count(*) AS lines, round(sum(l_quantity), 2) AS quantity FROM lineitem
WHERE l_tax >= 0.02 GROUP BY l_returnflag, l_linestatus""")
def bound_small(spark, d):
    rows = scan.run_query(spark, """
        SELECT l_returnflag, l_linestatus, count(*) AS lines, round(sum(l_quantity), 2) AS quantity
        FROM {lineitem} WHERE l_tax >= ? GROUP BY l_returnflag, l_linestatus""", [0.02],
        max_rows=100, lineitem=table(spark, d, "lineitem"))
    return spark.createDataFrame(rows, "l_returnflag string, l_linestatus string, lines bigint, quantity double")


@query("readable_projection", """
SELECT event_id, '{"type":"' || event_type || '","value":' || CAST(value AS VARCHAR) || '}' AS cell,
       CAST(user_id // 12 AS VARCHAR) || '-' || CAST(user_id % 12 AS VARCHAR) AS span, 2 AS kept_size FROM events""")
def readable(spark, d):
    events = table(spark, d, "events").select(
        "event_id", F.struct(F.col("event_type").alias("type"), "value").alias("cell"),
        F.make_ym_interval(F.lit(0), F.col("user_id").cast("int")).alias("span"),
        F.array("event_type", F.lit(None)).alias("kept"))
    out = scan.readable_projection(events)
    bare = F.regexp_replace(F.regexp_replace("span", "INTERVAL '", ""), "' YEAR TO MONTH", "")
    return out.select("event_id", "cell", bare.alias("span"), F.size("kept").alias("kept_size"))


FLAGSHIP_SQL = """
WITH s AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders
           WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'),
     e AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM s),
     b AS (SELECT lo + (i * (hi - lo + 1)) // 8 AS bound FROM e, range(1, 8) r(i)),
     f AS (SELECT (SELECT count(*) FROM b WHERE bound <= o_orderkey) AS tile_id,
                  md5(length(o_orderkey::VARCHAR) || ':' || o_orderkey || length(o_custkey::VARCHAR) || ':' || o_custkey
                      || length(o_totalprice::VARCHAR) || ':' || o_totalprice) AS h FROM s)
SELECT tile_id::INTEGER AS tile_id, count(*) AS rows, CAST(sum(('0x' || substr(h, 1, 8))::BIGINT) AS VARCHAR) AS hash_a,
       CAST(sum(('0x' || substr(h, 9, 8))::BIGINT) AS VARCHAR) AS hash_b FROM f GROUP BY tile_id"""


@query("tiled_fingerprint", FLAGSHIP_SQL)
def flagship(spark, d):
    """Scan, project, range, tile, fingerprint."""
    orders = scan.scan_table(spark, f"{d}/orders.parquet")
    ranged = scan.project(scan.key_range_scan(orders, "o_orderdate", dt.datetime(1995, 1, 1), dt.datetime(1999, 1, 1)),
                          ["o_orderkey", "o_custkey", "o_totalprice"])
    planned = tiles.plan_key_tiles(ranged, "o_orderkey", 8, "equal_width")
    return table_fingerprint(ranged, tiles.tile_id_expr(ranged, "o_orderkey", planned))
