"""Constraints, referential actions, keys and generated values."""

from __future__ import annotations

from functools import reduce
from itertools import combinations, permutations, product

from pyspark.sql import functions as F

from tablebridge import model as m
from tablebridge.operators import constraints as c, keys as k, profile as p, referential as r
from tablebridge.plans.constraint_report import constraint_report
from tablebridge.queries.registry import query, table
from tablebridge.session import staging_path

_PK_SQL = "SELECT nullif(l_linenumber, 4) AS l_linenumber, l_orderkey FROM lineitem"


def _nullable_lines(spark, d):
    return table(spark, d, "lineitem").select(F.nullif("l_linenumber", F.lit(4)).alias("l_linenumber"), "l_orderkey")


@query("pk_violations", f"""
SELECT l_orderkey, l_linenumber, count(*) AS rows,
       CASE WHEN l_linenumber IS NULL THEN 'null key' ELSE 'duplicate key' END AS reason
FROM ({_PK_SQL}) GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1 OR l_linenumber IS NULL""")
def pk(spark, d):
    return c.pk_violations(_nullable_lines(spark, d), ["l_orderkey", "l_linenumber"])


@query("unique_violations", f"""
SELECT l_orderkey, l_linenumber, count(*) AS rows FROM ({_PK_SQL})
WHERE l_linenumber IS NOT NULL GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def unique(spark, d):
    return c.unique_violations(_nullable_lines(spark, d), ["l_orderkey", "l_linenumber"])


@query("unique_violation_rows", """
SELECT l.* FROM lineitem l JOIN (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1) v
ON l.l_orderkey = v.l_orderkey AND l.l_linenumber = v.l_linenumber""")
def unique_rows(spark, d):
    lines, key = table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"]
    return c.rows_with_keys(lines, c.unique_violations(lines, key), key)


@query("fk_violations", """
SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey END AS o_custkey FROM orders
WHERE o_orderpriority <> '5-LOW' AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'AUTOMOBILE')""")
def fk(spark, d):
    orders = table(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("o_custkey"))
    parent = table(spark, d, "customer").where("c_mktsegment <> 'AUTOMOBILE'")
    return c.fk_violations(orders, parent, ["o_custkey"], ["c_custkey"])


@query("fk_violations_composite", """
SELECT l_partkey, l_suppkey, count(*) AS rows FROM lineitem a WHERE l_returnflag = 'R' AND NOT EXISTS
 (SELECT 1 FROM lineitem b WHERE b.l_returnflag <> 'R' AND b.l_partkey = a.l_partkey AND b.l_suppkey = a.l_suppkey)
GROUP BY l_partkey, l_suppkey""")
def fk_composite(spark, d):
    lines = table(spark, d, "lineitem")
    return c.orphan_keys(lines.where("l_returnflag = 'R'"), lines.where("l_returnflag <> 'R'"),
                         ["l_partkey", "l_suppkey"], ["l_partkey", "l_suppkey"])


@query("check_violations", """
SELECT * FROM (SELECT l_orderkey, l_linenumber, l_discount, l_tax,
  concat_ws(',', CASE WHEN NOT (nullif(l_discount, 0.1) <= 0.05) THEN 'small_discount' END,
                  CASE WHEN NOT (l_tax < 0.07 OR l_returnflag = 'N') THEN 'tax_rule' END) AS violated
  FROM lineitem) WHERE violated <> ''""")
def check(spark, d):
    bad = c.check_violations(table(spark, d, "lineitem"), {
        "small_discount": "nullif(l_discount, 0.1) <= 0.05", "tax_rule": "l_tax < 0.07 OR l_returnflag = 'N'"})
    return bad.select("l_orderkey", "l_linenumber", "l_discount", "l_tax", F.array_join("violated", ",").alias("violated"))


@query("not_null_violations", """
SELECT 'o_orderstatus' AS column_name, count(*) AS nulls FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'o_custkey', 0 UNION ALL SELECT 'o_orderpriority', count(*) FROM orders WHERE o_orderpriority = '2-HIGH'""")
def not_null(spark, d):
    orders = table(spark, d, "orders").select(F.nullif("o_orderstatus", F.lit("F")).alias("o_orderstatus"), "o_custkey",
                                              F.nullif("o_orderpriority", F.lit("2-HIGH")).alias("o_orderpriority"))
    return c.not_null_violations(orders, ["o_orderstatus", "o_custkey", "o_orderpriority"])


@query("enum_violations", "SELECT event_id, event_type FROM events WHERE event_type NOT IN ('view', 'click', 'purchase')")
def enum(spark, d):
    return c.enum_violations(table(spark, d, "events").select("event_id", "event_type"), "event_type", ["view", "click", "purchase"])


@query("enum_violations_null_label", "SELECT event_id, event_type FROM events WHERE event_type NOT IN ('view', 'click', 'purchase')")
def enum_null_label(spark, d):
    """A NULL among three hundred labels allows nothing more."""
    labels = ["view", None, "click", "purchase", *[f"label {i}" for i in range(300)]]
    return c.enum_violations(table(spark, d, "events").select("event_id", "event_type"), "event_type", labels)


@query("fk_violations_mostly_null", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN o_custkey + 1 END AS o_custkey FROM orders
WHERE o_orderkey % 5 = 0 AND o_custkey + 1 NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def fk_null(spark, d):
    """Four fifths of the foreign keys are NULL and pass."""
    orders = table(spark, d, "orders").select("o_orderkey", F.expr("CASE WHEN o_orderkey % 5 = 0 THEN o_custkey + 1 END AS o_custkey"))
    return c.fk_violations(orders, table(spark, d, "customer").where("c_mktsegment = 'BUILDING'"), ["o_custkey"], ["c_custkey"])


@query("enum_violations_frame", """
SELECT p_partkey, p_brand FROM part WHERE p_brand NOT IN (SELECT p_brand FROM part WHERE p_size = 50)""")
def enum_frame(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    return c.enum_violations(part.select("p_partkey", "p_brand"), "p_brand", part.where("p_size = 50").select("p_brand"))


@query("domain_violations", """
SELECT * FROM (SELECT p_partkey, concat_ws(',', CASE WHEN length(p_name) > 10 THEN 'p_name' END,
  CASE WHEN p_retailprice >= 1000 OR round(p_retailprice, 1) <> p_retailprice THEN 'p_retailprice' END,
  CASE WHEN p_partkey > 32767 OR p_partkey < -32768 THEN 'p_partkey' END) AS misfit_columns
 FROM part) WHERE misfit_columns <> ''""")
def domain(spark, d):
    bad = c.domain_violations(table(spark, d, "part"), "p_name varchar(10), p_retailprice decimal(4,1), p_partkey smallint")
    return bad.select("p_partkey", F.array_join("misfit_columns", ",").alias("misfit_columns"))


@query("exclusion_violations", """
SELECT * FROM (SELECT user_id, event_id, ts,
  max(ts + INTERVAL 10 MINUTE) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  AS prior_upper FROM events) WHERE prior_upper > ts""")
def exclusion(spark, d):
    spans = table(spark, d, "events").select("user_id", "event_id", "ts", F.expr("ts + INTERVAL 10 MINUTES").alias("until"))
    return c.exclusion_violations(spans, ["user_id"], "ts", "until", ["event_id"]).drop("until")


@query("exclusion_violations_one_key", """
SELECT * FROM (SELECT o_orderstatus, o_orderkey, o_orderdate, max(o_orderdate + INTERVAL 6 HOUR) OVER
  (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_upper
 FROM orders) WHERE prior_upper > o_orderdate""")
def exclusion_hot(spark, d):
    """Three keys hold all rows: each must split over many tiles."""
    spans = table(spark, d, "orders").select("o_orderstatus", "o_orderkey", "o_orderdate",
                                             F.expr("o_orderdate + INTERVAL 6 HOURS").alias("until"))
    return c.exclusion_violations(spans, ["o_orderstatus"], "o_orderdate", "until", ["o_orderkey"], tiles=64).drop("until")


@query("overlap_pairs", """
SELECT a.user_id, a.event_id AS first_event_id, a.ts AS first_ts, b.event_id AS second_event_id, b.ts AS second_ts
FROM events a JOIN events b ON a.user_id = b.user_id AND (b.ts, b.event_id) > (a.ts, a.event_id) AND b.ts < a.ts + INTERVAL 10 MINUTE""")
def pairs(spark, d):
    spans = table(spark, d, "events").withColumn("until", F.expr("ts + INTERVAL 10 MINUTES"))
    return c.overlap_pairs(spans, ["user_id"], "ts", "until", ["event_id", "ts"], ["event_id"])


@query("overlap_pairs_one_key", """
SELECT a.o_orderstatus, a.o_orderkey AS first_o_orderkey, b.o_orderkey AS second_o_orderkey FROM orders a JOIN orders b
ON a.o_orderstatus = b.o_orderstatus AND (b.o_orderdate, b.o_orderkey) > (a.o_orderdate, a.o_orderkey) AND b.o_orderdate < a.o_orderdate + INTERVAL 6 HOUR""")
def pairs_hot(spark, d):
    """Three keys hold all rows: the blocks of places cut them."""
    spans = table(spark, d, "orders").withColumn("until", F.expr("o_orderdate + INTERVAL 6 HOURS"))
    return c.overlap_pairs(spans, ["o_orderstatus"], "o_orderdate", "until", ["o_orderkey"], ["o_orderkey"])


@query("overlap_counts", """
SELECT o_custkey, o_orderkey, (SELECT count(*) FROM orders b WHERE b.o_custkey = a.o_custkey AND (b.o_orderdate, b.o_orderkey) > (a.o_orderdate, a.o_orderkey)
  AND b.o_orderdate < a.o_orderdate + INTERVAL 90 DAY) AS overlaps FROM orders a""")
def overlap_numbers(spark, d):
    """How many later orders of its customer each order's quarter overlaps; no pair is formed."""
    spans = table(spark, d, "orders").withColumn("until", F.expr("o_orderdate + INTERVAL 90 DAYS"))
    ranks = c.overlap_ranks(spans, ["o_custkey"], "o_orderdate", "until", ["o_orderkey"])
    return ranks.select("o_custkey", "o_orderkey", F.expr("_end - _rank - 1").alias("overlaps"))


_CHILD = "SELECT o_orderkey, o_custkey FROM orders"
_GONE = "SELECT c_custkey FROM customer WHERE c_nationkey = 3"


def _delete(spark, d, action, defaults=None):
    customer, orders = table(spark, d, "customer"), table(spark, d, "orders").select("o_orderkey", "o_custkey")
    fk = m.ForeignKey("orders_customer", ["o_custkey"], "customer", ["c_custkey"], on_delete=action)
    return r.apply_delete(customer, orders, fk, customer.where("c_nationkey = 3"), defaults, on_blocked="report")


@query("apply_delete_no_action", f"{_CHILD} WHERE o_custkey IN ({_GONE})")
def delete_no_action(spark, d):
    return _delete(spark, d, m.NO_ACTION).blocked


@query("apply_delete_restrict", f"""
SELECT 'blocked' AS part, count(*) AS rows FROM orders WHERE o_custkey IN ({_GONE})
UNION ALL SELECT 'parent', count(*) FROM customer UNION ALL SELECT 'child', count(*) FROM orders""")
def delete_restrict(spark, d):
    out = _delete(spark, d, m.RESTRICT)
    counts = [f.agg(F.lit(n).alias("part"), F.count(F.lit(1)).alias("rows"))
              for n, f in (("blocked", out.blocked), ("parent", out.parent), ("child", out.child))]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("apply_delete_cascade", f"{_CHILD} WHERE o_custkey NOT IN ({_GONE})")
def delete_cascade(spark, d):
    return _delete(spark, d, m.CASCADE).child


@query("apply_delete_set_null", f"SELECT o_orderkey, CASE WHEN o_custkey IN ({_GONE}) THEN NULL ELSE o_custkey END AS o_custkey FROM orders")
def delete_set_null(spark, d):
    return _delete(spark, d, m.SET_NULL).child


@query("apply_delete_set_default", f"""
SELECT o_orderkey, CASE WHEN o_custkey IN ({_GONE}) THEN (SELECT min(c_custkey) FROM customer WHERE c_nationkey <> 3)
ELSE o_custkey END AS o_custkey FROM orders""")
def delete_set_default(spark, d):
    fallback = table(spark, d, "customer").where("c_nationkey <> 3").agg(F.min("c_custkey")).first()[0]
    return _delete(spark, d, m.SET_DEFAULT, {"o_custkey": str(fallback)}).child


_RENAME = "c_custkey + 10000000"


def _update(spark, d, action, defaults=None):
    customer, orders = table(spark, d, "customer"), table(spark, d, "orders").select("o_orderkey", "o_custkey")
    fk = m.ForeignKey("orders_customer", ["o_custkey"], "customer", ["c_custkey"], on_update=action)
    mapping = customer.where("c_nationkey = 3").select(F.col("c_custkey").alias("old_c_custkey"), F.expr(_RENAME).alias("new_c_custkey"))
    return r.apply_key_update(customer, orders, fk, mapping, defaults, on_blocked="report")


@query("apply_key_update_cascade", f"SELECT o_orderkey, CASE WHEN o_custkey IN ({_GONE}) THEN o_custkey + 10000000 ELSE o_custkey END AS o_custkey FROM orders")
def update_cascade(spark, d):
    return _update(spark, d, m.CASCADE).child


@query("apply_key_update_parent", f"SELECT CASE WHEN c_nationkey = 3 THEN {_RENAME} ELSE c_custkey END AS c_custkey, c_name FROM customer")
def update_parent(spark, d):
    return _update(spark, d, m.CASCADE).parent.select("c_custkey", "c_name")


@query("apply_key_update_set_null", f"SELECT o_orderkey, CASE WHEN o_custkey IN ({_GONE}) THEN NULL ELSE o_custkey END AS o_custkey FROM orders")
def update_set_null(spark, d):
    return _update(spark, d, m.SET_NULL).child


@query("apply_key_update_set_default", f"SELECT o_orderkey, CASE WHEN o_custkey IN ({_GONE}) THEN 10 ELSE o_custkey END AS o_custkey FROM orders")
def update_set_default(spark, d):
    return _update(spark, d, m.SET_DEFAULT, {"o_custkey": "10"}).child


@query("apply_key_update_restrict", f"{_CHILD} WHERE o_custkey IN ({_GONE})")
def update_restrict(spark, d):
    return _update(spark, d, m.RESTRICT).blocked


@query("cascade_closure", """
WITH n AS (SELECT n_nationkey FROM nation WHERE n_regionkey = 1),
 c AS (SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT * FROM n)),
 s AS (SELECT s_suppkey FROM supplier WHERE s_nationkey IN (SELECT * FROM n)),
 o AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT * FROM c)),
 l AS (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem
       WHERE l_orderkey IN (SELECT * FROM o) OR l_suppkey IN (SELECT * FROM s))
SELECT 'region' AS table_name, 1 AS rows UNION ALL SELECT 'nation', count(*) FROM n UNION ALL SELECT 'customer', count(*) FROM c
UNION ALL SELECT 'supplier', count(*) FROM s UNION ALL SELECT 'orders', count(*) FROM o UNION ALL SELECT 'lineitem', count(*) FROM l""")
def cascade(spark, d):
    names = ["region", "nation", "customer", "supplier", "orders", "lineitem"]
    tables = {n: table(spark, d, n) for n in names}
    links = [r.Link("nation", ["n_regionkey"], "region", ["r_regionkey"]),
             r.Link("customer", ["c_nationkey"], "nation", ["n_nationkey"]),
             r.Link("supplier", ["s_nationkey"], "nation", ["n_nationkey"]),
             r.Link("orders", ["o_custkey"], "customer", ["c_custkey"]),
             r.Link("lineitem", ["l_orderkey"], "orders", ["o_orderkey"]),
             r.Link("lineitem", ["l_suppkey"], "supplier", ["s_suppkey"])]
    line_key = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    keys = {"region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"],
            "supplier": ["s_suppkey"], "orders": ["o_orderkey"], "lineitem": line_key}
    gone = r.cascade_closure(tables, links, "region", tables["region"].where("r_regionkey = 1"), keys)
    counts = [f.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("rows")) for n, f in gone.items()]
    out = counts[0]
    for part in counts[1:]:
        out = out.unionByName(part)
    return out


def _mixed(spark, d, order_action, line_action=m.NO_ACTION):
    """Customers of a nation go; suppliers lose their nation, orders as their own key says."""
    tables = {n: table(spark, d, n) for n in ("nation", "customer", "supplier", "orders", "lineitem")}
    fks = {"customer": [m.ForeignKey("customer_nation", ["c_nationkey"], "nation", ["n_nationkey"], on_delete=m.CASCADE)],
           "supplier": [m.ForeignKey("supplier_nation", ["s_nationkey"], "nation", ["n_nationkey"], on_delete=m.SET_NULL)],
           "orders": [m.ForeignKey("order_customer", ["o_custkey"], "customer", ["c_custkey"], on_delete=order_action)],
           "lineitem": [m.ForeignKey("line_order", ["l_orderkey"], "orders", ["o_orderkey"], on_delete=line_action),
                        m.ForeignKey("line_supplier", ["l_suppkey"], "supplier", ["s_suppkey"], on_delete=m.RESTRICT)]}
    keys = {"nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"], "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"]}
    fallback = tables["customer"].where("c_nationkey <> 3").agg(F.min("c_custkey")).first()[0]
    return r.cascade_delete(tables, fks, "nation", tables["nation"].where("n_nationkey = 3"), keys,
                            {"order_customer": {"o_custkey": str(fallback)}}, on_blocked="report")


@query("cascade_delete_mixed", f"""
SELECT 'nation' AS table_name, n_nationkey AS key, n_regionkey::BIGINT AS value FROM nation WHERE n_nationkey <> 3
UNION ALL SELECT 'customer', c_custkey, c_nationkey FROM customer WHERE c_nationkey <> 3
UNION ALL SELECT 'supplier', s_suppkey, nullif(s_nationkey, 3) FROM supplier
UNION ALL SELECT 'orders', o_orderkey, CASE WHEN o_custkey IN ({_GONE}) THEN (SELECT min(c_custkey) FROM customer WHERE c_nationkey <> 3) ELSE o_custkey END FROM orders
UNION ALL SELECT 'lineitem', l_orderkey, l_linenumber FROM lineitem
UNION ALL SELECT 'changed supplier', s_suppkey, NULL FROM supplier WHERE s_nationkey = 3""")
def cascade_mixed(spark, d):
    """Four actions in one delete; the rows of every table after it."""
    out = _mixed(spark, d, m.SET_DEFAULT)
    shown = {"nation": ("n_nationkey", "n_regionkey"), "customer": ("c_custkey", "c_nationkey"), "supplier": ("s_suppkey", "s_nationkey"),
             "orders": ("o_orderkey", "o_custkey"), "lineitem": ("l_orderkey", "l_linenumber")}
    parts = [(n, out.tables[n], *c) for n, c in shown.items()] + [("changed supplier", out.changed["supplier"], *shown["supplier"])]
    frames = [f.select(F.lit(n).alias("table_name"), F.col(k).cast("long").alias("key"), F.col(v).cast("long").alias("value")) for n, f, k, v in parts]
    return reduce(lambda a, b: a.unionAll(b), frames)


@query("cascade_delete_blocked", f"SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey IN ({_GONE}))")
def cascade_blocked(spark, d):
    """Orders go with their customers, but their lines forbid it."""
    return _mixed(spark, d, m.CASCADE).blocked["line_order"]


_TEAM = "SELECT c_custkey, c_name, CASE WHEN c_custkey = 5 THEN 45 ELSE c_custkey // 3 END AS boss FROM customer"


@query("cascade_delete_cyclic", f"""
WITH RECURSIVE team AS ({_TEAM}), gone(c_custkey) AS (SELECT 15::BIGINT UNION SELECT t.c_custkey FROM team t JOIN gone g ON t.boss = g.c_custkey)
SELECT 'team' AS table_name, c_custkey AS key, c_name AS name FROM team WHERE c_custkey IN (SELECT c_custkey FROM gone)
UNION ALL SELECT 'orders', o_orderkey, o_orderpriority FROM orders WHERE o_custkey IN (SELECT c_custkey FROM gone)""")
def cascade_cyclic(spark, d):
    """Customers that answer to one another, three of them in a circle, and their orders."""
    team = table(spark, d, "customer").select("c_custkey", "c_name", F.expr("CASE WHEN c_custkey = 5 THEN 45 ELSE c_custkey DIV 3 END").alias("boss"))
    fks = {"team": [m.ForeignKey("team_boss", ["boss"], "team", ["c_custkey"], on_delete=m.CASCADE)],
           "orders": [m.ForeignKey("order_team", ["o_custkey"], "team", ["c_custkey"], on_delete=m.CASCADE)]}
    out = r.cascade_delete({"team": team, "orders": table(spark, d, "orders")}, fks, "team", team.where("c_custkey = 15"),
                           {"team": ["c_custkey"], "orders": ["o_orderkey"]}).deleted
    return (out["team"].select(F.lit("team").alias("table_name"), F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
            .unionAll(out["orders"].select(F.lit("orders"), "o_orderkey", "o_orderpriority")))


_ORDER_COLS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
_KEY_SETS = [s for width in (1, 2) for s in combinations(_ORDER_COLS, width)]


def _key_sql() -> str:
    """Every set that is unique and has no unique column in it."""
    parts = []
    for s in _KEY_SETS:
        narrow = "".join(f" AND count(DISTINCT {c}) < count(*)" for c in s if len(s) > 1)
        parts.append(f"SELECT '{','.join(s)}' AS key_columns, {len(s)} AS width WHERE "
                     f"(SELECT count(DISTINCT ({', '.join(s)})) = count(*){narrow} FROM orders)")
    return " UNION ALL ".join(parts)


@query("discover_keys", _key_sql())
def find_keys(spark, d):
    return k.discover_keys(table(spark, d, "orders"), 2)


_LINE_COLS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus", "l_shipdate")


def _wide_key_sql(name: str, columns: tuple[str, ...], widest: int) -> str:
    """Every set of at most ``widest`` columns without NULL and without two equal rows, unless a part of it is one."""
    sets = [s for width in range(1, widest + 1) for s in combinations(columns, width)]
    parts = [f"SELECT '{','.join(s)}' AS key_columns, {len(s)} AS width WHERE NOT EXISTS (SELECT 1 FROM {name} GROUP BY {', '.join(s)} "
             f"HAVING count(*) > 1 OR {' OR '.join(c + ' IS NULL' for c in s)})" for s in sets]
    return (f"WITH u AS MATERIALIZED ({' UNION ALL '.join(parts)}) SELECT * FROM u WHERE NOT EXISTS (SELECT 1 FROM u p WHERE p.width < u.width "
            "AND list_has_all(string_split(u.key_columns, ','), string_split(p.key_columns, ',')))")


@query("discover_keys_orders_4", _wide_key_sql("orders", _ORDER_COLS, 4))
def find_wide_keys_of_orders(spark, d):
    return k.discover_keys(table(spark, d, "orders"), 4)


@query("discover_keys_lineitem_4", _wide_key_sql("lineitem", _LINE_COLS, 4))
def find_wide_keys_of_lines(spark, d):
    return k.discover_keys(table(spark, d, "lineitem"), 4)


@query("discover_keys_composite", """
SELECT 'conv_id,turn' AS key_columns, 2 AS width WHERE (SELECT count(*) = count(DISTINCT (conv_id, turn)) FROM conversations)
UNION ALL SELECT 'conv_id,role', 2 WHERE (SELECT count(*) = count(DISTINCT (conv_id, role)) FROM conversations)
UNION ALL SELECT 'turn,role', 2 WHERE (SELECT count(*) = count(DISTINCT (turn, role)) FROM conversations)
UNION ALL SELECT 'conv_id,text', 2 WHERE (SELECT count(*) = count(DISTINCT (conv_id, text)) AND count(*) > count(DISTINCT text) FROM conversations)
UNION ALL SELECT 'turn,text', 2 WHERE (SELECT count(*) = count(DISTINCT (turn, text)) AND count(*) > count(DISTINCT text) FROM conversations)
UNION ALL SELECT 'role,text', 2 WHERE (SELECT count(*) = count(DISTINCT (role, text)) AND count(*) > count(DISTINCT text) FROM conversations)
UNION ALL SELECT 'text', 1 WHERE (SELECT count(*) = count(DISTINCT text) FROM conversations)""")
def find_composite(spark, d):
    return k.discover_keys(table(spark, d, "conversations"), 2)


@query("discover_foreign_keys", """
WITH v AS (
 SELECT DISTINCT 'orders.o_custkey' AS c, o_custkey AS v FROM orders UNION SELECT 'orders.o_orderkey', o_orderkey FROM orders
 UNION SELECT 'customer.c_custkey', c_custkey FROM customer UNION SELECT 'customer.c_nationkey', c_nationkey FROM customer
 UNION SELECT 'nation.n_nationkey', n_nationkey FROM nation UNION SELECT 'nation.n_regionkey', n_regionkey FROM nation
 UNION SELECT 'region.r_regionkey', r_regionkey FROM region UNION SELECT 'supplier.s_suppkey', s_suppkey FROM supplier
 UNION SELECT 'supplier.s_nationkey', s_nationkey FROM supplier),
 z AS (SELECT c, count(*) AS distinct_values FROM v GROUP BY c),
 p AS (SELECT a.c AS col_name, b.c AS ref_name, count(*) AS shared FROM v a JOIN v b ON a.v = b.v AND a.c <> b.c
       WHERE b.c IN ('orders.o_orderkey', 'customer.c_custkey', 'nation.n_nationkey', 'region.r_regionkey', 'supplier.s_suppkey')
       GROUP BY ALL)
SELECT col_name, ref_name, distinct_values FROM p JOIN z ON z.c = p.col_name WHERE shared = distinct_values""")
def find_references(spark, d):
    names = ["orders", "customer", "nation", "region", "supplier"]
    tables = {n: table(spark, d, n) for n in names}
    keys = {"orders": "o_orderkey", "customer": "c_custkey", "nation": "n_nationkey", "region": "r_regionkey", "supplier": "s_suppkey"}
    cols = {"orders": ["o_custkey"], "customer": ["c_nationkey"], "nation": ["n_regionkey"], "supplier": ["s_nationkey"]}
    return k.discover_foreign_keys(tables, keys, cols)


# Every integer and text column of the seven star tables, and the keys that a foreign key can name.
_STAR = {"region": ("r_regionkey", "r_name"), "nation": ("n_nationkey", "n_regionkey", "n_name"),
         "supplier": ("s_suppkey", "s_nationkey", "s_name"), "customer": ("c_custkey", "c_nationkey", "c_name", "c_mktsegment"),
         "part": ("p_partkey", "p_size", "p_name", "p_brand", "p_type"), "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"),
         "lineitem": ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus")}
_STAR_KEYS = {t: c[0] for t, c in _STAR.items() if t != "lineitem"}


def _star_sql() -> str:
    values = " UNION ALL ".join(f"SELECT DISTINCT '{t}.{c}' AS c, typeof({c}) = 'VARCHAR' AS is_text, {c}::VARCHAR AS v FROM {t} WHERE {c} IS NOT NULL"
                                for t, columns in _STAR.items() for c in columns)
    keys = ", ".join(f"'{t}.{c}'" for t, c in _STAR_KEYS.items())
    return f"""
WITH v AS ({values}),
 z AS (SELECT c, count(*) AS distinct_values FROM v GROUP BY c),
 p AS (SELECT a.c AS col_name, b.c AS ref_name, count(*) AS shared
       FROM v a JOIN v b ON a.v = b.v AND a.is_text = b.is_text AND a.c <> b.c WHERE b.c IN ({keys}) GROUP BY ALL)
SELECT col_name, ref_name, distinct_values FROM p JOIN z ON z.c = p.col_name WHERE shared = distinct_values"""


@query("discover_foreign_keys_star", _star_sql())
def find_star_references(spark, d):
    """All integer and text columns of all seven tables."""
    return k.discover_foreign_keys({t: table(spark, d, t) for t in _STAR}, _STAR_KEYS)


def _inclusion_sql(tables: dict[str, dict[str, str]], widest: int, ratio: float) -> str:
    """Every tuple of a table against every tuple of equal families, by joins of their distinct values."""
    parts = []
    for (t, own), (u, other) in product(tables.items(), tables.items()):
        for width in range(1, widest + 1):
            for cs, rs in product(combinations(sorted(own), width), permutations(sorted(other), width)):
                if any(own[c] != other[r] or (t, c) == (u, r) for c, r in zip(cs, rs)):
                    continue
                distinct = [f"(SELECT DISTINCT {', '.join(f'{c} AS v{i}' for i, c in enumerate(x))}, 1 AS one FROM {n} WHERE {' AND '.join(f'{c} IS NOT NULL' for c in x)})"
                            for n, x in ((t, cs), (u, rs))]
                on = " AND ".join(f"a.v{i} = b.v{i}" for i in range(width))
                parts.append(f"SELECT '{','.join(f'{t}.{c}' for c in cs)}' AS col_names, '{','.join(f'{u}.{r}' for r in rs)}' AS ref_names, {width} AS width, "
                             f"count(*) AS distinct_values, count(b.one) AS shared FROM {distinct[0]} a LEFT JOIN {distinct[1]} b ON {on}")
    return f"SELECT *, shared / distinct_values AS ratio FROM ({' UNION ALL '.join(parts)}) x WHERE shared > 0 AND shared >= {ratio} * distinct_values"


def _kinds(columns: tuple[str, ...]) -> dict[str, str]:
    text = ("name", "segment", "brand", "type", "status", "priority", "flag")
    return {c: "text" if c.endswith(text) else "date" if c.endswith("date") else "integer" for c in columns}


@query("discover_inclusions_star", _inclusion_sql({t: _kinds(c + {"orders": ("o_orderdate",), "lineitem": ("l_shipdate",)}.get(t, ())) for t, c in _STAR.items()}, 1, 0.5))
def find_partial_inclusions(spark, d):
    """Every column of the seven tables against every other, half of the values at least."""
    return k.discover_inclusions({t: table(spark, d, t) for t in _STAR}, 1, 0.5)


_BUYERS = "SELECT DISTINCT o_custkey, c_nationkey AS buyer_nation, o_orderpriority FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 200000"
_PAIR_TABLES = {"nation": _STAR["nation"], "supplier": _STAR["supplier"], "customer": _STAR["customer"],
                "buyers": ("o_custkey", "buyer_nation", "o_orderpriority")}


def _buyer_tables(spark, d):
    frames = {t: table(spark, d, t) for t in ("nation", "supplier", "customer")}
    return {**frames, "buyers": spark.sql(_BUYERS.replace("orders", "{orders}").replace("customer", "{customer}"), orders=table(spark, d, "orders"), customer=frames["customer"])}


@query("discover_inclusions_pairs", f"WITH buyers AS MATERIALIZED ({_BUYERS}) " + _inclusion_sql({t: _kinds(c) for t, c in _PAIR_TABLES.items()}, 2, 1.0))
def find_pair_inclusions(spark, d):
    return k.discover_inclusions(_buyer_tables(spark, d), 2)


@query("discover_inclusions_pairs_partial", f"WITH buyers AS MATERIALIZED ({_BUYERS}) " + _inclusion_sql({t: _kinds(c) for t, c in _PAIR_TABLES.items()}, 2, 0.3))
def find_partial_pair_inclusions(spark, d):
    return k.discover_inclusions(_buyer_tables(spark, d), 2, 0.3)


@query("assign_identity_always", "SELECT c_custkey, c_name, 100 + 5 * (row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1) AS id FROM customer")
def identity_always(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    return k.assign_identity(rows, "id", ["c_acctbal", "c_custkey"], m.Identity("always", 100, 5)).drop("c_acctbal")


@query("assign_identity_by_default", """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderkey END AS id FROM orders), x AS (SELECT max(id) AS top FROM o)
SELECT o_orderkey, id FROM o WHERE id IS NOT NULL
UNION ALL SELECT o_orderkey, top + row_number() OVER (ORDER BY o_orderkey) FROM o, x WHERE id IS NULL""")
def identity_by_default(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "F", F.col("o_orderkey")).alias("id"))
    return k.assign_identity(orders, "id", ["o_orderkey"])


@query("sequence_values", """
WITH o AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders)
SELECT o_orderkey, CASE WHEN i < 326 THEN 25 + 3 * i ELSE 1 + 3 * ((i - 326) % 334) END AS value FROM o""")
def sequence(spark, d):
    seq = m.SequenceDef(start=25, increment=3, min_value=1, max_value=1000, cycle=True)
    return k.draw_sequence(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"], seq)


@query("clustered_write", "SELECT l_orderkey, l_suppkey, l_shipdate FROM lineitem")
def clustered(spark, d):
    path = staging_path(spark, "clustered")
    k.clustered_write(table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_shipdate"), path,
                      ["l_suppkey", "l_shipdate"], [True, False])
    return spark.read.parquet(path)


@query("constraint_report", """
SELECT 'lineitem' AS table_name, 'line_pk' AS constraint_name, 'primary key' AS kind, (SELECT count(*) FROM lineitem) AS checked,
 CAST((SELECT sum(n) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) AS BIGINT) AS violations
UNION ALL SELECT 'lineitem', 'line_order', 'foreign key', (SELECT count(*) FROM lineitem), 0
UNION ALL SELECT 'lineitem', 'low_discount', 'check', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM lineitem WHERE l_discount > 0.05)
UNION ALL SELECT 'lineitem', 'flag_domain', 'enum', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM lineitem WHERE l_returnflag NOT IN ('A', 'N'))
UNION ALL SELECT 'lineitem', 'quantity_given', 'not null', (SELECT count(*) FROM lineitem), 0
UNION ALL SELECT 'orders', 'order_pk', 'primary key', (SELECT count(*) FROM orders), 0
UNION ALL SELECT 'orders', 'one_per_customer', 'unique', (SELECT count(*) FROM orders),
 CAST((SELECT sum(n) FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1)) AS BIGINT)
UNION ALL SELECT 'orders', 'no_overlap', 'exclusion', (SELECT count(*) FROM orders), (SELECT count(*) FROM (SELECT o_orderdate,
 max(o_orderdate + INTERVAL 30 DAY) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS e
 FROM orders) WHERE e > o_orderdate)""")
def report(spark, d):
    lines = table(spark, d, "lineitem")
    orders = table(spark, d, "orders").withColumn("o_until", F.expr("o_orderdate + INTERVAL 30 DAYS"))
    return constraint_report({"lineitem": lines, "orders": orders}, {
        "lineitem": [m.PrimaryKey(["l_orderkey", "l_linenumber"], "line_pk"),
                     m.ForeignKey("line_order", ["l_orderkey"], "orders", ["o_orderkey"]),
                     m.CheckRule("low_discount", "l_discount <= 0.05"),
                     m.EnumDomain("flag_domain", "l_returnflag", ["A", "N"]), m.NotNull(["l_quantity"], "quantity_given")],
        "orders": [m.PrimaryKey(["o_orderkey"], "order_pk"), m.UniqueKey("one_per_customer", ["o_custkey"]),
                   m.Exclusion("no_overlap", ["o_custkey"], "o_orderdate", "o_until")]})


@query("profile_table", """
SELECT 'c_custkey' AS column_name, 1 AS ordinal, 'bigint' AS type, count(*) AS rows, 0 AS nulls, min(c_custkey)::VARCHAR AS min_value,
 max(c_custkey)::VARCHAR AS max_value, NULL::INTEGER AS max_length, count(DISTINCT c_custkey) AS distinct_values FROM customer
UNION ALL SELECT 'c_name', 2, 'string', count(*), 0, min(c_name), max(c_name), max(length(c_name)), count(DISTINCT c_name) FROM customer
UNION ALL SELECT 'c_nationkey', 3, 'int', count(*), 0, min(c_nationkey)::VARCHAR, max(c_nationkey)::VARCHAR, NULL, count(DISTINCT c_nationkey) FROM customer
UNION ALL SELECT 'c_mktsegment', 5, 'string', count(*), count(*) - count(nullif(c_mktsegment, 'BUILDING')), min(nullif(c_mktsegment, 'BUILDING')),
 max(nullif(c_mktsegment, 'BUILDING')), max(length(nullif(c_mktsegment, 'BUILDING'))), count(DISTINCT nullif(c_mktsegment, 'BUILDING')) FROM customer
UNION ALL SELECT 'c_acctbal', 4, 'double', count(*), 0, min(c_acctbal)::VARCHAR, max(c_acctbal)::VARCHAR, NULL, count(DISTINCT c_acctbal) FROM customer
UNION ALL SELECT 'empty', 6, 'string', count(*), count(*), NULL, NULL, NULL, 0 FROM customer""")
def profile(spark, d):
    """The whole table, one column with NULLs and a column of nothing else."""
    customer = table(spark, d, "customer").withColumns({
        "c_mktsegment": F.nullif("c_mktsegment", F.lit("BUILDING")), "empty": F.lit(None).cast("string")})
    return p.profile_table(customer, exact=True)
