"""Comparing tables with damaged copies of themselves."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablebridge.functions.floats import bitwise_equal, float_bits, float_key_text
from tablebridge.operators import hashtree, verify as v
from tablebridge.queries.registry import query, table
from tablebridge.session import staging_path
from tablebridge.sources import tiles
from tablebridge.sources.tileindex import plan_tile_frame

# A damaged copy: cheap urgent orders lost, statuses of dear orders changed,
# prices of one day's orders raised, extra rows with keys past the end.
_COPY_SQL = """
SELECT o_orderkey, o_custkey, CASE WHEN o_totalprice > 450000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderdate = TIMESTAMP '1996-06-01' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE NOT (o_orderpriority = '1-URGENT' AND o_totalprice < 50000)
UNION ALL SELECT o_orderkey + 100000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 400000"""
_ORIG_SQL = "SELECT * FROM orders"


def _orig(spark, d):
    return table(spark, d, "orders")


def _copy(spark, d):
    orders = table(spark, d, "orders")
    kept = orders.where("NOT (o_orderpriority = '1-URGENT' AND o_totalprice < 50000)").withColumns({
        "o_orderstatus": F.expr("CASE WHEN o_totalprice > 450000 THEN 'X' ELSE o_orderstatus END"),
        "o_totalprice": F.expr("CASE WHEN o_orderdate = timestamp_ntz'1996-06-01' THEN o_totalprice + 1 ELSE o_totalprice END")})
    extra = orders.where("o_orderstatus = 'P' AND o_totalprice > 400000").withColumn("o_orderkey", F.col("o_orderkey") + 100000000)
    return kept.unionByName(extra)


_DIFF_SQL = f"""
WITH a AS ({_ORIG_SQL}), b AS ({_COPY_SQL}), j AS (
 SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
  CASE WHEN b.o_orderkey IS NULL THEN 'only_a' WHEN a.o_orderkey IS NULL THEN 'only_b' ELSE 'changed' END AS change,
  CASE WHEN a.o_orderkey IS NOT NULL AND b.o_orderkey IS NOT NULL THEN
   concat_ws(',', CASE WHEN a.o_custkey <> b.o_custkey THEN 'o_custkey' END, CASE WHEN a.o_orderstatus <> b.o_orderstatus THEN 'o_orderstatus' END,
    CASE WHEN a.o_totalprice <> b.o_totalprice THEN 'o_totalprice' END) END AS changed_columns
 FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey)
SELECT o_orderkey, change, changed_columns FROM j WHERE changed_columns IS NULL OR changed_columns <> ''"""


@query("table_diff", _DIFF_SQL)
def diff(spark, d):
    out = v.table_diff(_orig(spark, d), _copy(spark, d), ["o_orderkey"])
    return out.select("o_orderkey", "change", F.array_join("changed_columns", ",").alias("changed_columns"))


@query("bisect_diff", _DIFF_SQL)
def bisect(spark, d):
    out = v.bisect_diff(_orig(spark, d), _copy(spark, d), "o_orderkey", 32)
    return out.select("o_orderkey", "change", F.array_join("changed_columns", ",").alias("changed_columns"))


def _trees(a, b, columns, n):
    leaves = plan_tile_frame(a, columns, n)
    return leaves, *[hashtree.write_hash_tree(df, columns, leaves, staging_path(a.sparkSession, "tree")) for df in (a, b)]


@query("hash_tree_diff", _DIFF_SQL)
def tree_diff(spark, d):
    a, b = _orig(spark, d), _copy(spark, d)
    out = hashtree.hash_tree_diff(a, b, ["o_orderkey"], *_trees(a, b, ["o_orderkey"], 1_000))
    return out.select("o_orderkey", "change", F.array_join("changed_columns", ",").alias("changed_columns"))


_LAST_LINES = "SELECT max(l_orderkey) FROM lineitem"


@query("hash_tree_one_leaf", f"""
WITH x AS (SELECT count(*) AS n, count(*) FILTER (WHERE l_orderkey IN ({_LAST_LINES})) AS changed FROM lineitem)
SELECT 1::BIGINT AS leaves, TRUE AS few_rows_read, changed AS lost, 0::BIGINT AS added FROM x""")
def one_leaf(spark, d):
    """The last order's lines lost: of 500 leaves one differs, and its rows alone are compared."""
    a = table(spark, d, "lineitem")
    last = a.agg(F.max("l_orderkey")).first()[0]
    b = a.where(F.col("l_orderkey") != last)
    leaves, tree_a, tree_b = _trees(a, b, ["l_orderkey"], 500)
    bad = hashtree.differing_leaves(tree_a, tree_b)
    # A tile is off by both ends' rank error at most, and keys of up to some dozen lines are not cut.
    found = bad.agg(F.lit(1).alias("_one"), F.count(F.lit(1)).alias("leaves"), (F.sum("rows_a") <= 64 + a.count() // 100).alias("few_rows_read"))
    parts = [hashtree.rows_of_leaves(df, ["l_orderkey"], leaves, bad) for df in (a, b)]
    lines = v.multiset_diff(*parts).agg(F.lit(1).alias("_one"), F.sum("copies_a").alias("lost"), F.sum("copies_b").alias("added"))
    return found.join(lines, "_one").drop("_one")


@query("hash_tree_diff_composite", """
SELECT c_nationkey, c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'only_a' ELSE 'changed' END AS change, CASE WHEN c_mktsegment <> 'BUILDING' THEN 'c_name' END AS changed_columns
FROM customer WHERE c_mktsegment = 'BUILDING' OR c_acctbal > 9000""")
def tree_diff_composite(spark, d):
    """A text-free composite key in the order of the nations."""
    a = table(spark, d, "customer")
    b = a.where("c_mktsegment <> 'BUILDING'").withColumn("c_name", F.expr("IF(c_acctbal > 9000, upper(c_name) || '!', c_name)"))
    key = ["c_nationkey", "c_custkey"]
    out = hashtree.hash_tree_diff(a, b, key, *_trees(a, b, key, 300))
    return out.select(*key, "change", F.array_join("changed_columns", ",").alias("changed_columns"))


@query("multiset_diff", """
WITH b AS (SELECT * FROM lineitem WHERE l_quantity < 49 UNION ALL SELECT * FROM lineitem WHERE l_quantity < 2),
 u AS (SELECT *, 1 AS x, 0 AS y FROM lineitem UNION ALL SELECT *, 0, 1 FROM b)
SELECT * EXCLUDE (x, y), CAST(sum(x) AS BIGINT) AS copies_a, CAST(sum(y) AS BIGINT) AS copies_b
FROM u GROUP BY ALL HAVING sum(x) <> sum(y)""")
def multiset(spark, d):
    lines = table(spark, d, "lineitem")
    return v.multiset_diff(lines, lines.where("l_quantity < 49").unionByName(lines.where("l_quantity < 2")))


def _field(c: str) -> str:
    return f"coalesce(length({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"


@query("table_fingerprint", f"""
WITH h AS (SELECT md5({_field('event_id')} || {_field('ts')} || {_field('user_id')} || {_field("nullif(event_type, 'view')")} || {_field('value')} || {_field('props')}) AS h FROM events)
SELECT count(*) AS rows, CAST(sum(('0x' || substr(h, 1, 8))::BIGINT) AS VARCHAR) AS hash_a,
       CAST(sum(('0x' || substr(h, 9, 8))::BIGINT) AS VARCHAR) AS hash_b FROM h""")
def fingerprint(spark, d):
    return v.table_fingerprint(table(spark, d, "events").withColumn("event_type", F.nullif("event_type", F.lit("view"))))


@query("table_fingerprint_text", f"""
WITH h AS (SELECT md5({_field('doc_id')} || {_field('text')} || {_field('lang')} || {_field('source')} || {_field('n_chars')}) AS h, lang FROM documents)
SELECT lang AS tile_id, count(*) AS rows, CAST(sum(('0x' || substr(h, 1, 8))::BIGINT) AS VARCHAR) AS hash_a,
       CAST(sum(('0x' || substr(h, 9, 8))::BIGINT) AS VARCHAR) AS hash_b FROM h GROUP BY lang""")
def fingerprint_text(spark, d):
    return v.table_fingerprint(table(spark, d, "documents"), F.col("lang"))


@query("unequal_tiles", f"""
WITH a AS ({_ORIG_SQL}), b AS ({_COPY_SQL}), e AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM a),
 e2 AS (SELECT lo + (i * (hi - lo + 1)) // 512 AS bound FROM e, range(1, 512) r(i)),
 ta AS (SELECT *, (SELECT count(*) FROM e2 WHERE bound <= o_orderkey) AS t FROM a),
 tb AS (SELECT *, (SELECT count(*) FROM e2 WHERE bound <= o_orderkey) AS t FROM b),
 d AS (SELECT DISTINCT t FROM ((SELECT * FROM ta EXCEPT SELECT * FROM tb) UNION ALL (SELECT * FROM tb EXCEPT SELECT * FROM ta)))
SELECT t::INTEGER AS tile_id, (SELECT count(*) FROM ta WHERE ta.t = d.t) AS rows_a, (SELECT count(*) FROM tb WHERE tb.t = d.t) AS rows_b FROM d""")
def bad_tiles(spark, d):
    a = _orig(spark, d)
    return v.unequal_tiles(a, _copy(spark, d), "o_orderkey", tiles.plan_key_tiles(a, "o_orderkey", 512, "equal_width"))


@query("verify_copy", f"""
SELECT (SELECT count(*) FROM orders) AS rows_a, (SELECT count(*) FROM ({_COPY_SQL})) AS rows_b, TRUE AS schema_equal,
 (SELECT count(*) FROM orders) = (SELECT count(*) FROM ({_COPY_SQL})) AS rows_equal,
 NOT EXISTS ({_ORIG_SQL} EXCEPT ({_COPY_SQL})) AS fingerprint_equal, NOT EXISTS ({_ORIG_SQL} EXCEPT ({_COPY_SQL})) AS verified""")
def verify(spark, d):
    return v.verify_copy(_orig(spark, d), _copy(spark, d))


@query("verify_copy_equal", "SELECT count(*) AS rows_a, count(*) AS rows_b, TRUE AS schema_equal, TRUE AS rows_equal, TRUE AS fingerprint_equal, TRUE AS verified FROM lineitem")
def verify_equal(spark, d):
    """A copy whose rows come in another order and other partitions."""
    lines = table(spark, d, "lineitem")
    return v.verify_copy(lines, lines.repartition("l_suppkey").sortWithinPartitions(F.desc("l_shipdate")))


_ZERO_SQL = """CASE WHEN event_type = 'view' THEN CAST('-0.0' AS DOUBLE) WHEN event_type = 'click' THEN CAST('0.0' AS DOUBLE)
 WHEN event_type = 'error' THEN CAST('NaN' AS DOUBLE) WHEN event_type = 'signup' THEN NULL ELSE value END"""


def _zeros(spark, d):
    """Events whose values cover both zeros, NaN, NULL and plain numbers."""
    return table(spark, d, "events").select(
        "event_id", "event_type", F.expr("""CASE WHEN event_type = 'view' THEN double('-0.0') WHEN event_type = 'click' THEN 0.0D
        WHEN event_type = 'error' THEN double('NaN') WHEN event_type = 'signup' THEN NULL ELSE value END""").alias("x"))


@query("bitwise_float_key", f"""
SELECT event_id, CASE WHEN x IS NULL THEN NULL WHEN isnan(x) THEN 'NaN' ELSE CAST(x AS VARCHAR) END AS key
FROM (SELECT event_id, {_ZERO_SQL} AS x FROM events)""")
def float_key(spark, d):
    return _zeros(spark, d).select("event_id", float_key_text(F.col("x")).alias("key"))


@query("bitwise_float_key_exact", f"""
SELECT event_id, CASE WHEN event_type = 'view' THEN -9223372036854775808 WHEN event_type = 'click' THEN 0
 WHEN event_type = 'error' THEN 9221120237041090560 END AS special FROM events""")
def float_exact(spark, d):
    bits = float_bits(_zeros(spark, d), ["x"])
    return bits.select("event_id", F.when(F.col("event_type").isin("view", "click", "error"), F.col("x_bits")).alias("special"))


@query("null_safe_bitwise_equal", f"""
WITH z AS (SELECT event_id, event_type, {_ZERO_SQL} AS x FROM events)
SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN event_type = 'click' ELSE TRUE END AS against_positive_zero, TRUE AS against_itself
FROM z""")
def cells(spark, d):
    z = _zeros(spark, d)
    double = z.schema["x"].dataType
    other = F.when(F.col("x") == 0, F.lit(0.0)).otherwise(F.col("x"))
    return z.select("event_id", bitwise_equal(F.col("x"), other, double).alias("against_positive_zero"),
                    bitwise_equal(F.col("x"), F.col("x"), double).alias("against_itself"))
