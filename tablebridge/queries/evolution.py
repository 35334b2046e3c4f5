"""Definitions and structure changes over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablebridge import model as m
from tablebridge.operators import evolve as e
from tablebridge.queries.registry import query, table
from tablebridge.session import staging_path


@query("create_as", """
SELECT row_number() OVER (ORDER BY c_custkey) AS id, c_custkey AS code, CAST(c_acctbal AS DECIMAL(12,2)) AS amount, c_name AS label, TRUE AS is_active FROM customer""")
def create(spark, d):
    customer = table(spark, d, "customer").select(F.col("c_acctbal").alias("amount"), F.col("c_custkey").alias("code"), F.col("c_name").alias("label"))
    shape = m.TableDef("accounts", [
        m.ColumnDef("id", "bigint", False, identity=m.Identity()), m.ColumnDef("code", "bigint", False),
        m.ColumnDef("amount", "decimal(12,2)"), m.ColumnDef("label", "varchar(100)"),
        m.ColumnDef("is_active", "boolean", False, "true")], m.PrimaryKey(["id"]))
    return e.create_as(customer, shape, staging_path(spark, "created"), ["code"])


@query("add_column", "SELECT o_orderkey, o_totalprice, CAST(o_totalprice / 10 AS DECIMAL(12,3)) AS tax, NULL::VARCHAR AS note FROM orders")
def add(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    taxed = e.add_column(orders, m.ColumnDef("tax", "decimal(12,3)", False, "o_totalprice / 10"))
    return e.add_column(taxed, m.ColumnDef("note", "varchar(40)"))


@query("add_column_identity", "SELECT p_partkey, p_name, 10 + 10 * (row_number() OVER (ORDER BY p_partkey) - 1) AS id FROM part")
def add_identity(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_name")
    return e.add_column(part, m.ColumnDef("id", "bigint", False, identity=m.Identity("always", 10, 10)), ["p_partkey"])


@query("drop_column", "SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier")
def drop(spark, d):
    return e.drop_column(table(spark, d, "supplier"), "s_name")


@query("alter_column_type", "SELECT l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber, CAST(l_quantity AS SMALLINT) AS l_quantity FROM lineitem")
def alter(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return e.alter_column_type(e.alter_column_type(lines, "l_linenumber", "varchar(3)"), "l_quantity", "smallint")


@query("alter_column_type_failures", "SELECT c_custkey, c_acctbal FROM customer WHERE round(c_acctbal) <> c_acctbal")
def alter_failures(spark, d):
    return e.type_change_failures(table(spark, d, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", "int")


@query("add_constraint", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def constrain(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    tables = {"customer": table(spark, d, "customer")}
    for rule in (m.PrimaryKey(["o_orderkey"]), m.UniqueKey("u", ["o_orderkey", "o_custkey"]), m.CheckRule("paid", "o_totalprice > 0"),
                 m.ForeignKey("fk", ["o_custkey"], "customer", ["c_custkey"])):
        orders = e.add_constraint(orders, rule, tables)
    return orders


@query("apply_migration", "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_totalprice, 'new' AS stage FROM orders")
def migrate(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    return e.apply_migration(orders, [
        m.AddColumn(m.ColumnDef("stage", "varchar(8)", False, "'new'")), m.DropColumn("o_orderpriority"),
        m.AlterColumnType("o_custkey", "string"), m.AddConstraint(m.CheckRule("positive", "o_totalprice > 0"))])
