"""Type mapping and reflection over the derived catalogue snapshots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tablebridge.operators import catalog as c, ddl, typemap as t
from tablebridge.operators.verify import schema_diff
from tablebridge.queries.registry import ORACLES, query, table
from tablebridge.queries.snapshots import MYSQL, PG, mysql_catalog, oracle, pg_catalog
from tablebridge.sources.scan import readable_select_list

_PG_CATEGORY = """CASE q % 16 WHEN 0 THEN 'integer' WHEN 1 THEN 'bigint' WHEN 2 THEN 'decimal' WHEN 3 THEN 'varchar' WHEN 4 THEN 'text' WHEN 5 THEN 'timestamp' WHEN 6 THEN 'timestamp'
 WHEN 7 THEN 'boolean' WHEN 8 THEN 'double' WHEN 9 THEN 'json' WHEN 10 THEN 'uuid' WHEN 11 THEN 'enum' WHEN 12 THEN 'integer' WHEN 13 THEN 'varchar' WHEN 14 THEN 'unsupported' ELSE 'bit' END"""
_MY_CATEGORY = """CASE q % 16 WHEN 0 THEN 'integer' WHEN 1 THEN 'decimal' WHEN 2 THEN 'decimal' WHEN 3 THEN 'varchar' WHEN 4 THEN 'text' WHEN 5 THEN 'timestamp' WHEN 6 THEN 'timestamp'
 WHEN 7 THEN 'boolean' WHEN 8 THEN 'double' WHEN 9 THEN 'json' WHEN 10 THEN 'char' WHEN 11 THEN 'enum' WHEN 12 THEN 'unsupported' WHEN 13 THEN 'bigint' WHEN 14 THEN 'geometry' ELSE 'bit' END"""
_TO_MYSQL = """CASE q % 16 WHEN 0 THEN 'int' WHEN 1 THEN 'bigint' WHEN 2 THEN 'decimal(' || (q + 5) || ',2)' WHEN 3 THEN 'varchar(' || q || ')' WHEN 4 THEN 'text' WHEN 5 THEN 'datetime' WHEN 6 THEN 'datetime(3)'
 WHEN 7 THEN 'tinyint(1)' WHEN 8 THEN 'double' WHEN 9 THEN 'json' WHEN 10 THEN 'char(36)' WHEN 11 THEN 'enum(''petrol'', ''diesel'', ''it''''s ' || custkey || ''')' WHEN 12 THEN 'json' WHEN 13 THEN 'json' WHEN 14 THEN 'cidr'
 ELSE 'bit(' || q || ')' END"""
_TO_PG = """CASE q % 16 WHEN 0 THEN 'integer' WHEN 1 THEN 'bigint' WHEN 2 THEN 'numeric(' || (q + 5) || ',2)' WHEN 3 THEN 'character varying(' || q || ')' WHEN 4 THEN 'text' WHEN 5 THEN 'timestamp without time zone'
 WHEN 6 THEN 'timestamp(3) with time zone' WHEN 7 THEN 'boolean' WHEN 8 THEN 'double precision' WHEN 9 THEN 'jsonb' WHEN 10 THEN 'uuid' WHEN 11 THEN 'text' WHEN 12 THEN 'integer[]'
 WHEN 13 THEN 'character varying(' || q || ')[][]' WHEN 14 THEN 'cidr' ELSE 'bit(' || q || ')' END"""
_TO_SPARK = """CASE q % 16 WHEN 0 THEN 'int' WHEN 1 THEN 'bigint' WHEN 2 THEN CASE WHEN q + 5 > 38 THEN 'string' ELSE 'decimal(' || (q + 5) || ',2)' END WHEN 3 THEN 'varchar(' || q || ')' WHEN 4 THEN 'string' WHEN 5 THEN 'timestamp_ntz'
 WHEN 6 THEN 'timestamp' WHEN 7 THEN 'boolean' WHEN 8 THEN 'double' WHEN 9 THEN 'variant' WHEN 10 THEN 'string' WHEN 11 THEN 'string' WHEN 12 THEN 'array<int>' WHEN 13 THEN 'array<array<varchar(' || q || ')>>'
 WHEN 14 THEN 'string' ELSE 'string' END"""
_SQL_KEY = "c.source_id, n.nspname AS schema_name, c.relname AS table_name"
_USER_NS = "(SELECT * FROM pg_namespace WHERE nspname LIKE 'app%')"
_REL = f"FROM pg_class c JOIN {_USER_NS} n ON n.source_id = c.source_id AND n.oid = c.relnamespace AND c.relkind IN ('r', 'p')"
_ATT = f"{_REL} JOIN att a ON a.source_id = c.source_id AND a.attrelid = c.oid AND a.tax < 0.08"
_K = f"{_REL} JOIN k ON k.source_id = c.source_id AND k.rel = c.oid"
_MY_K = "k.source_id, 'app_' || custkey AS schema_name, 't_' || rel AS table_name"


def _columns(spark, d, live=("att", "k")):
    """Columns alone: their lines are read once, index relations not at all."""
    return c.reflect_columns(pg_catalog(spark, d, ("enum", "type_"), live))


@query("map_pg_types", oracle(PG, f"""
SELECT {_SQL_KEY}, attname AS column_name, {_PG_CATEGORY} AS category, CASE WHEN q % 16 IN (3, 13, 15) THEN q END AS length,
 CASE q % 16 WHEN 2 THEN q + 5 WHEN 6 THEN 3 END AS precision, CASE WHEN q % 16 = 2 THEN 2 END AS scale, CASE q % 16 WHEN 5 THEN FALSE WHEN 6 THEN TRUE END AS tz,
 CASE q % 16 WHEN 12 THEN 1 WHEN 13 THEN 2 ELSE 0 END AS dims, CASE WHEN q % 16 = 11 THEN 'petrol|diesel|it''s ' || custkey END AS labels,
 CASE WHEN q % 16 = 14 THEN 'cidr' END AS native, CASE WHEN q % 16 = 9 THEN TRUE END AS binary_json {_ATT}"""))
def pg_types(spark, d):
    return _columns(spark, d).select("source_id", "schema_name", "table_name", "column_name", "t.category", "t.length", "t.precision", "t.scale", "t.tz",
                                     "t.dims", F.array_join("t.labels", "|").alias("labels"), "t.native", F.col("t.binary").alias("binary_json"))


@query("map_mysql_types", oracle(MYSQL, f"""
SELECT source_id, table_name, attname AS column_name, {_MY_CATEGORY} AS category, CASE q % 16 WHEN 3 THEN q WHEN 10 THEN 36 WHEN 15 THEN q END AS length,
 CASE q % 16 WHEN 1 THEN 20 WHEN 2 THEN q + 5 WHEN 5 THEN 6 END AS precision, CASE q % 16 WHEN 1 THEN 0 WHEN 2 THEN 2 END AS scale,
 CASE WHEN q % 16 = 11 THEN 'a|b,c|it''s' END AS labels, CASE WHEN q % 16 = 14 THEN 'point' END AS subtype, CASE WHEN q % 16 = 12 THEN 'set(''a'',''b'')' END AS native
FROM (SELECT *, 't_' || attrelid AS table_name FROM att)"""))
def mysql_types(spark, d):
    cols = mysql_catalog(spark, d).columns.withColumnRenamed("column_type", "native_type")
    return t.map_mysql_types(cols).select("source_id", "table_name", "column_name", "t.category", "t.length", "t.precision", "t.scale",
                                          F.array_join("t.labels", "|").alias("labels"), "t.subtype", "t.native")


@query("to_target_types", oracle(PG, f"""
SELECT {_SQL_KEY}, attname AS column_name, {_TO_SPARK} AS spark_type, {_TO_PG} AS pg_type, {_TO_MYSQL} AS mysql_type {_ATT}"""))
def targets(spark, d):
    return _columns(spark, d).select("source_id", "schema_name", "table_name", "column_name", t.to_spark_type(F.col("t")).alias("spark_type"),
                                     t.to_pg_type(F.col("t")).alias("pg_type"), t.to_mysql_type(F.col("t")).alias("mysql_type"))


@query("mysql_to_pg_types", oracle(MYSQL, """
SELECT source_id, attrelid, attname AS column_name, CASE q % 16 WHEN 0 THEN 'integer' WHEN 1 THEN 'numeric(20,0)' WHEN 2 THEN 'numeric(' || (q + 5) || ',2)' WHEN 3 THEN 'character varying(' || q || ')' WHEN 4 THEN 'text'
 WHEN 5 THEN 'timestamp(6) without time zone' WHEN 6 THEN 'timestamp without time zone' WHEN 7 THEN 'boolean' WHEN 8 THEN 'double precision' WHEN 9 THEN 'jsonb' WHEN 10 THEN 'character(36)' WHEN 11 THEN 'text'
 WHEN 12 THEN 'set(''a'',''b'')' WHEN 13 THEN 'bigint' WHEN 14 THEN 'text' ELSE 'bit(' || q || ')' END AS pg_type FROM att"""))
def mysql_to_pg(spark, d):
    cols = mysql_catalog(spark, d).columns.withColumnRenamed("column_type", "native_type")
    return t.map_mysql_types(cols).select("source_id", F.substring("table_name", 3, 20).cast("bigint").alias("attrelid"), "column_name",
                                          t.to_pg_type(F.col("t")).alias("pg_type"))


@query("lossy_mapping_report", oracle(PG, f"""
SELECT category, becomes, losses, count(*) AS columns FROM (SELECT
 CASE q % 16 WHEN 6 THEN 'timestamp' WHEN 10 THEN 'uuid' WHEN 12 THEN 'integer[]' WHEN 13 THEN 'varchar[][]' WHEN 14 THEN 'unsupported' END AS category,
 CASE q % 16 WHEN 6 THEN 'timestamp' WHEN 10 THEN 'char' WHEN 12 THEN 'json' WHEN 13 THEN 'json' WHEN 14 THEN 'unsupported' END AS becomes,
 CASE q % 16 WHEN 6 THEN 'time zone' WHEN 10 THEN 'category' WHEN 12 THEN 'category, array' WHEN 13 THEN 'category, array' WHEN 14 THEN 'passed through' END AS losses {_ATT})
WHERE category IS NOT NULL GROUP BY ALL"""))
def losses(spark, d):
    return t.lossy_mapping_report(_columns(spark, d), "mysql")


@query("type_inventory", oracle(PG, f"""
SELECT category, dims, unsupported_type, count(*) AS columns FROM (SELECT {_PG_CATEGORY} AS category, CASE q % 16 WHEN 12 THEN 1 WHEN 13 THEN 2 ELSE 0 END AS dims,
 CASE WHEN q % 16 = 14 THEN 'cidr' END AS unsupported_type {_ATT}) GROUP BY ALL"""))
def inventory(spark, d):
    return t.type_inventory(_columns(spark, d))


@query("readable_select_list", oracle(PG, f"""
SELECT source_id, schema_name, table_name, string_agg(item, ', ' ORDER BY attnum) AS select_list FROM (SELECT {_SQL_KEY}, attnum,
 CASE WHEN q % 16 IN (11, 14, 15) THEN '"' || attname || '"::text AS "' || attname || '"' ELSE '"' || attname || '"' END AS item {_ATT})
GROUP BY source_id, schema_name, table_name"""))
def select_lists(spark, d):
    return readable_select_list(_columns(spark, d))


@query("reflect_schemas", oracle(PG, f"SELECT DISTINCT source_id, nspname AS schema_name FROM {_USER_NS}"))
def schemas(spark, d):
    return c.reflect_schemas(pg_catalog(spark, d))


@query("reflect_schemas_mysql", oracle(MYSQL, "SELECT DISTINCT source_id, table_schema AS schema_name FROM my_tables WHERE table_schema <> 'mysql'"))
def schemas_mysql(spark, d):
    return c.reflect_schemas(mysql_catalog(spark, d))


@query("reflect_tables", oracle(PG, f"""
SELECT {_SQL_KEY}, c.partkeydef AS partition_key, CASE WHEN c.relispartition AND p.parent IS NOT NULL THEN pn.nspname END AS parent_schema,
 CASE WHEN c.relispartition THEN 't_' || p.parent END AS parent_table, nullif(c.comment, '') AS comment {_REL}
LEFT JOIN pg_inherits i ON i.source_id = c.source_id AND i.inhrelid = c.oid
LEFT JOIN parents p ON p.source_id = c.source_id AND p.parent = i.inhparent LEFT JOIN pg_namespace pn ON pn.source_id = c.source_id AND pn.oid = c.relnamespace"""))
def tables(spark, d):
    return c.reflect_tables(pg_catalog(spark, d))


@query("reflect_tables_mysql", oracle(MYSQL, """
SELECT source_id, table_schema AS schema_name, table_name, NULL::VARCHAR AS partition_key, NULL::VARCHAR AS parent_schema, NULL::VARCHAR AS parent_table, nullif(table_comment, '') AS comment
FROM my_tables WHERE table_type = 'BASE TABLE' AND table_schema <> 'mysql'"""))
def tables_mysql(spark, d):
    return c.reflect_tables(mysql_catalog(spark, d))


@query("reflect_columns", oracle(PG, f"""
SELECT {_SQL_KEY}, attname AS column_name, attnum AS ordinal, a.native_type, NOT a.attnotnull AS nullable, a.default_expr,
 CASE a.attidentity WHEN 'a' THEN 'always' WHEN 'd' THEN 'by_default' END AS identity, a.comment
{_REL} JOIN pg_attribute a ON a.source_id = c.source_id AND a.attrelid = c.oid AND NOT a.attisdropped"""))
def columns(spark, d):
    return _columns(spark, d).drop("t")


@query("reflect_columns_mysql", oracle(MYSQL, """
SELECT m.source_id, m.table_schema AS schema_name, m.table_name, column_name, ordinal_position::INTEGER AS ordinal, column_type AS native_type, is_nullable = 'YES' AS nullable,
 column_default AS default_expr, CASE WHEN extra <> '' THEN 'by_default' END AS identity, nullif(column_comment, '') AS comment
FROM my_columns m JOIN my_tables x ON x.source_id = m.source_id AND x.table_name = m.table_name AND x.table_type = 'BASE TABLE' WHERE m.table_schema <> 'mysql'"""))
def columns_mysql(spark, d):
    return c.reflect_columns(mysql_catalog(spark, d)).drop("t")


def _joined(df, *lists):
    for name in lists:
        df = df.withColumn(name, F.array_join(name, ","))
    return df


@query("reflect_primary_keys", oracle(PG, f"SELECT {_SQL_KEY}, 'pk_' || rel AS constraint_name, 'c' || k2 || CASE WHEN k1 <> k2 THEN ',c' || k1 ELSE '' END AS columns {_K}"))
def primary_keys(spark, d):
    return _joined(c.reflect_primary_keys(pg_catalog(spark, d)), "columns")


@query("reflect_primary_keys_mysql", oracle(MYSQL, f"SELECT {_MY_K}, 'PRIMARY' AS constraint_name, 'c' || k2 || CASE WHEN k1 <> k2 THEN ',c' || k1 ELSE '' END AS columns FROM k"))
def primary_keys_mysql(spark, d):
    return _joined(c.reflect_primary_keys(mysql_catalog(spark, d)), "columns")


@query("reflect_foreign_keys", oracle(PG, f"""
SELECT {_SQL_KEY}, 'f_' || k.rel AS constraint_name, 'c' || k.k1 || CASE WHEN k.k1 <> k.k2 AND t.k1 <> t.k2 THEN ',c' || k.k2 ELSE '' END AS columns,
 n.nspname AS referenced_schema, 't_' || p.parent AS referenced_table, 'c' || t.k1 || CASE WHEN k.k1 <> k.k2 AND t.k1 <> t.k2 THEN ',c' || t.k2 ELSE '' END AS referenced_columns,
 CASE WHEN k.price < 100000 THEN 'NO ACTION' WHEN k.price < 200000 THEN 'SET NULL' WHEN k.price < 300000 THEN 'SET DEFAULT' ELSE 'CASCADE' END AS on_delete,
 CASE k.status WHEN 'O' THEN 'CASCADE' WHEN 'F' THEN 'RESTRICT' ELSE 'NO ACTION' END AS on_update
{_K} JOIN parents p ON p.source_id = k.source_id AND p.custkey = k.custkey JOIN k t ON t.source_id = k.source_id AND t.rel = p.parent"""))
def foreign_keys(spark, d):
    return _joined(c.reflect_foreign_keys(pg_catalog(spark, d)), "columns", "referenced_columns")


@query("reflect_foreign_keys_mysql", oracle(MYSQL, """
SELECT k.source_id, 'app_' || k.custkey AS schema_name, 't_' || k.rel AS table_name, 'fk' AS constraint_name, 'c' || k.k1 || CASE WHEN k.k1 <> k.k2 AND t.k1 <> t.k2 THEN ',c' || k.k2 ELSE '' END AS columns,
 'app_' || t.custkey AS referenced_schema, 't_' || p.parent AS referenced_table, 'c' || t.k1 || CASE WHEN k.k1 <> k.k2 AND t.k1 <> t.k2 THEN ',c' || t.k2 ELSE '' END AS referenced_columns,
 CASE WHEN k.price < 200000 THEN 'SET NULL' ELSE 'NO ACTION' END AS on_delete, CASE k.status WHEN 'O' THEN 'CASCADE' WHEN 'F' THEN 'RESTRICT' ELSE 'NO ACTION' END AS on_update
FROM k JOIN parents p ON p.source_id = k.source_id AND p.custkey = k.custkey JOIN k t ON t.source_id = k.source_id AND t.rel = p.parent"""))
def foreign_keys_mysql(spark, d):
    return _joined(c.reflect_foreign_keys(mysql_catalog(spark, d)), "columns", "referenced_columns")


@query("reflect_unique_constraints", oracle(PG, f"SELECT {_SQL_KEY}, 'u_' || rel AS constraint_name, 'c' || k1 || ',c' || k2 AS columns {_K} WHERE k1 <> k2 AND price > 200000"))
def uniques(spark, d):
    return _joined(c.reflect_unique_constraints(pg_catalog(spark, d)), "columns")


@query("reflect_unique_constraints_mysql", oracle(MYSQL, f"SELECT {_MY_K}, 'u_' || rel AS constraint_name, 'c' || k1 AS columns FROM k WHERE price > 200000"))
def uniques_mysql(spark, d):
    return _joined(c.reflect_unique_constraints(mysql_catalog(spark, d)), "columns")


@query("reflect_check_constraints", oracle(PG, f"""
SELECT {_SQL_KEY}, 'ck_' || rel AS constraint_name, CASE WHEN price < 150000 THEN '(c1 > 0)' WHEN price < 250000 THEN 'c1 IS NOT NULL' ELSE '(c1 <> ''a)''::text)' END AS expression {_K}"""))
def checks(spark, d):
    return c.reflect_check_constraints(pg_catalog(spark, d))


@query("reflect_check_constraints_mysql", oracle(MYSQL, f"SELECT {_MY_K}, 'ck' AS constraint_name, '(`c1` > ' || rel || ')' AS expression FROM k"))
def checks_mysql(spark, d):
    return c.reflect_check_constraints(mysql_catalog(spark, d))


@query("reflect_exclusion_constraints", oracle(PG, f"SELECT {_SQL_KEY}, 'x_' || rel AS constraint_name, 'EXCLUDE USING gist (c1 WITH &&)' AS definition {_K} WHERE price > 400000"))
def exclusions(spark, d):
    return c.reflect_exclusion_constraints(pg_catalog(spark, d, ("constraint",), ("att", "k", "parents")))


def _index_text(df):
    word = F.transform("columns", lambda x: F.concat(x["name"], F.when(x["descending"], " desc").otherwise("")))
    return df.withColumn("columns", F.array_join(word, ","))


@query("reflect_indexes", oracle(PG, f"""
SELECT {_SQL_KEY}, 'ix_' || rel AS index_name, 'c' || k2 || ' desc,c' || k1 AS columns, price > 300000 AS is_unique, CASE WHEN k1 = 1 THEN 'btree' ELSE 'hash' END AS method
{_K} WHERE NOT (k1 <> k2 AND price > 200000)"""))
def indexes(spark, d):
    return _index_text(c.reflect_indexes(pg_catalog(spark, d)))


@query("reflect_indexes_mysql", oracle(MYSQL, f"SELECT {_MY_K}, 'ix_' || rel AS index_name, 'c' || k2 || CASE WHEN k1 <> k2 THEN ',c' || k1 ELSE '' END AS columns, FALSE AS is_unique, 'HASH' AS method FROM k"))
def indexes_mysql(spark, d):
    return _index_text(c.reflect_indexes(mysql_catalog(spark, d)))


@query("reflect_triggers", oracle(PG, f"""
SELECT k.source_id, n.nspname AS schema_name, 't_' || rel AS table_name, 'tr_' || rel AS trigger_name, CASE WHEN price < 100000 THEN 'BEFORE' WHEN price < 300000 THEN 'AFTER' ELSE 'INSTEAD OF' END AS timing,
 CASE WHEN price < 100000 THEN 'INSERT' WHEN price < 200000 THEN 'INSERT,DELETE,UPDATE' WHEN price < 300000 THEN 'TRUNCATE' ELSE 'INSERT' END AS events, 'fn_' || custkey AS function_name, 'CREATE TRIGGER tr_' || rel AS body
FROM k JOIN {_USER_NS} n ON n.source_id = k.source_id AND n.oid = custkey WHERE k1 <= 1"""))
def triggers(spark, d):
    return _joined(c.reflect_triggers(pg_catalog(spark, d)), "events")


@query("reflect_triggers_mysql", oracle(MYSQL, f"""
SELECT {_MY_K}, 'tr_' || rel AS trigger_name, CASE WHEN k1 = 1 THEN 'BEFORE' ELSE 'AFTER' END AS timing, CASE WHEN price < 100000 THEN 'INSERT' WHEN price < 200000 THEN 'UPDATE' ELSE 'DELETE' END AS events,
 NULL::VARCHAR AS function_name, 'SET @a = 1' AS body FROM k"""))
def triggers_mysql(spark, d):
    return _joined(c.reflect_triggers(mysql_catalog(spark, d)), "events")


@query("reflect_enums", oracle(PG, "SELECT source_id, nspname AS schema_name, 'fuel' AS type_name, 'petrol|diesel|it''s ' || oid AS labels FROM pg_namespace WHERE nspname NOT IN ('pg_catalog', 'information_schema') AND nspname NOT LIKE 'pg\\_toast%' ESCAPE '\\' AND nspname NOT LIKE 'pg\\_temp%' ESCAPE '\\'"))
def enums(spark, d):
    return c.reflect_enums(pg_catalog(spark, d)).withColumn("labels", F.array_join("labels", "|"))


@query("reflect_views", oracle(PG, f"""
SELECT {_SQL_KEY}, c.viewdef AS definition FROM pg_class c JOIN {_USER_NS} n ON n.source_id = c.source_id AND n.oid = c.relnamespace WHERE c.relkind IN ('v', 'm')"""))
def views(spark, d):
    return c.reflect_views(pg_catalog(spark, d))


@query("reflect_view_columns", oracle(PG, f"""
SELECT {_SQL_KEY}, attname AS column_name, attnum AS ordinal, {_PG_CATEGORY} AS category FROM pg_class c JOIN {_USER_NS} n ON n.source_id = c.source_id AND n.oid = c.relnamespace AND c.relkind IN ('v', 'm')
JOIN att a ON a.source_id = c.source_id AND a.attrelid = c.oid AND a.tax < 0.08"""))
def view_columns(spark, d):
    return c.reflect_view_columns(pg_catalog(spark, d)).select("source_id", "schema_name", "table_name", "column_name", "ordinal", "t.category")


@query("reflect_views_mysql", oracle(MYSQL, "SELECT source_id, table_schema AS schema_name, table_name, view_definition AS definition FROM my_views"))
def views_mysql(spark, d):
    return c.reflect_views(mysql_catalog(spark, d))


@query("reflect_sequences", oracle(PG, f"""
SELECT source_id, schemaname AS schema_name, sequencename AS sequence_name, data_type AS native_type, start_value, increment_by AS increment, min_value, max_value, cycle, data_type AS category
FROM pg_sequences WHERE schemaname LIKE 'app%'"""))
def sequences(spark, d):
    return c.reflect_sequences(pg_catalog(spark, d)).withColumn("category", F.col("t.category")).drop("t")


@query("reflect_sequences_mysql", oracle(MYSQL, """
SELECT source_id, table_schema AS schema_name, table_name AS sequence_name, 'bigint' AS native_type, start_value, increment, min_value, max_value, cycle_option = 'yes' AS cycle FROM my_sequences"""))
def sequences_mysql(spark, d):
    return c.reflect_sequences(mysql_catalog(spark, d)).drop("t")


@query("reflect_functions", oracle(PG, f"""
SELECT n.source_id, n.nspname AS schema_name, 'fn_' || n.oid AS function_name, CASE WHEN n.acct > 5000 THEN '' ELSE 'a integer' END AS arguments, 'trigger' AS return_type, 'plpgsql' AS language, 'BEGIN ' || n.oid AS body
FROM ns n WHERE nspname LIKE 'app%' AND acct >= 1000 AND acct <= 9000"""))
def functions(spark, d):
    return _joined(c.reflect_functions(pg_catalog(spark, d, ("proc", "language"), ("att", "k"))), "arguments")


@query("reflect_functions_mysql", oracle(MYSQL, """
SELECT source_id, routine_schema AS schema_name, 'fn' AS function_name, '' AS arguments, dtd_identifier AS return_type, 'SQL' AS language, routine_definition AS body FROM my_routines"""))
def functions_mysql(spark, d):
    return _joined(c.reflect_functions(mysql_catalog(spark, d)), "arguments")


@query("reflect_comments", oracle(PG, f"SELECT {_SQL_KEY}, c.comment {_REL} WHERE c.comment <> ''"))
def comments(spark, d):
    return c.reflect_comments(pg_catalog(spark, d))


@query("assemble_catalog", oracle(PG, f"""
SELECT {_SQL_KEY}, (SELECT coalesce(string_agg(attname, ',' ORDER BY attnum), '') FROM att a WHERE a.source_id = c.source_id AND a.attrelid = c.oid AND a.tax < 0.08) AS columns,
 CASE WHEN k.rel IS NOT NULL THEN 'pk_' || k.rel END AS primary_key, (p.parent IS NOT NULL)::INTEGER AS foreign_keys, coalesce(k1 <> k2 AND price > 200000, FALSE)::INTEGER AS uniques,
 (k.rel IS NOT NULL)::INTEGER AS checks, coalesce(price > 400000, FALSE)::INTEGER AS exclusions, coalesce(NOT (k1 <> k2 AND price > 200000), FALSE)::INTEGER AS indexes,
 coalesce(k1 <= 1, FALSE)::INTEGER AS triggers, c.partkeydef AS partition_key
{_REL} LEFT JOIN k ON k.source_id = c.source_id AND k.rel = c.oid LEFT JOIN parents p ON p.source_id = k.source_id AND p.custkey = k.custkey"""))
def assembled(spark, d):
    cat = c.assemble_catalog(pg_catalog(spark, d))
    return cat.select("source_id", "schema_name", "table_name", F.array_join(F.transform("columns", lambda x: x["column_name"]), ",").alias("columns"),
                      F.col("primary_key.constraint_name").alias("primary_key"), F.size("foreign_keys").alias("foreign_keys"), F.size("unique_constraints").alias("uniques"),
                      F.size("check_constraints").alias("checks"), F.size("exclusion_constraints").alias("exclusions"), F.size("indexes").alias("indexes"),
                      F.size("triggers").alias("triggers"), "partition_key")


# The views that an assembled row is made of, besides those of tables and columns.
_MY_PARTS = ("statistics", "key_column_usage", "referential_constraints", "table_constraints", "check_constraints", "triggers")


@query("assemble_catalog_mysql", oracle(MYSQL, """
SELECT x.source_id, x.table_schema AS schema_name, x.table_name, (SELECT coalesce(string_agg(column_name, ',' ORDER BY ordinal_position), '') FROM my_columns m
  WHERE m.source_id = x.source_id AND m.table_schema = x.table_schema AND m.table_name = x.table_name) AS columns,
 CASE WHEN k.rel IS NOT NULL THEN 'c' || k2 || CASE WHEN k1 <> k2 THEN ',c' || k1 ELSE '' END END AS primary_key, (p.parent IS NOT NULL)::INTEGER AS foreign_keys,
 coalesce(price > 200000, FALSE)::INTEGER AS uniques, (k.rel IS NOT NULL)::INTEGER AS checks, (k.rel IS NOT NULL)::INTEGER AS indexes, (k.rel IS NOT NULL)::INTEGER AS triggers,
 nullif(table_comment, '') AS comment
FROM my_tables x LEFT JOIN k ON k.source_id = x.source_id AND 't_' || k.rel = x.table_name AND 'app_' || k.custkey = x.table_schema
LEFT JOIN parents p ON p.source_id = k.source_id AND p.custkey = k.custkey WHERE x.table_type = 'BASE TABLE' AND x.table_schema <> 'mysql'"""))
def assembled_mysql(spark, d):
    cat = c.assemble_catalog(mysql_catalog(spark, d, _MY_PARTS))
    return cat.select("source_id", "schema_name", "table_name", F.array_join(F.transform("columns", lambda x: x["column_name"]), ",").alias("columns"),
                      F.array_join("primary_key.columns", ",").alias("primary_key"), F.size("foreign_keys").alias("foreign_keys"),
                      F.size("unique_constraints").alias("uniques"), F.size("check_constraints").alias("checks"), F.size("indexes").alias("indexes"),
                      F.size("triggers").alias("triggers"), "comment")


# What a scope holds, part by part: the query that lists the part, its column in an assembled row, its fields.
_PARTS = {
    "columns": ("reflect_columns", ("column_name", "ordinal", "native_type", "nullable", "default_expr", "identity", "comment")),
    "primary_key": ("reflect_primary_keys", ("constraint_name", "columns")),
    "foreign_keys": ("reflect_foreign_keys", ("constraint_name", "columns", "referenced_schema", "referenced_table", "referenced_columns", "on_delete", "on_update")),
    "unique_constraints": ("reflect_unique_constraints", ("constraint_name", "columns")),
    "check_constraints": ("reflect_check_constraints", ("constraint_name", "expression")),
    "exclusion_constraints": ("reflect_exclusion_constraints", ("constraint_name", "definition")),
    "indexes": ("reflect_indexes", ("index_name", "columns", "is_unique", "method")),
    "triggers": ("reflect_triggers", ("trigger_name", "timing", "events", "function_name", "body")),
}
_SCHEMA = "app_7"


def _scoped_sql(engine: str, one_table: bool) -> str:
    """All parts of a scope's tables from the SQL of the whole parts."""
    ending = "_mysql" if engine == "mysql" else ""
    inside = f"t.schema_name = '{_SCHEMA}'" + (f" AND t.table_name = ({_FIRST_TABLE})" if one_table else "")
    lists = []
    for part, (name, fields) in _PARTS.items():
        sql = ORACLES.get(name + ending)
        item = "concat_ws(' : ', " + ", ".join(f"coalesce(x.{f}::VARCHAR, '-')" for f in fields) + ")"
        lists.append(f"coalesce((SELECT string_agg({item}, ' ; ' ORDER BY {item}) FROM ({sql}) x WHERE x.source_id = t.source_id "
                     f"AND x.schema_name = t.schema_name AND x.table_name = t.table_name), '') AS {part}" if sql else f"'' AS {part}")
    return f"SELECT t.*, {', '.join(lists)} FROM ({ORACLES['reflect_tables' + ending]}) t WHERE {inside}"


_FIRST_TABLE = "SELECT 't_' || min(o_orderkey) FROM orders WHERE o_custkey = 7 AND o_orderstatus = 'O'"


def _one_table(spark, d) -> c.Scope:
    orders = table(spark, d, "orders").where("o_custkey = 7 AND o_orderstatus = 'O'")
    return c.Scope(_SCHEMA, f"t_{orders.agg(F.min('o_orderkey')).first()[0]}")


def _part_texts(assembled):
    """The nested parts of each table as sorted text."""
    types = {f.name: f.dataType for f in assembled.schema.fields}

    def text(x, name: str, data_type):
        if data_type.typeName() == "array" and data_type.elementType.typeName() == "struct":
            x = F.transform(x, lambda y: F.concat(y["name"], F.when(y["descending"], " desc").otherwise("")))
        if data_type.typeName() == "array":
            x = F.array_join(x, ",")
        return F.coalesce(x.cast("string"), F.lit("-"))

    def whole(part: str, fields):
        data_type = types[part]
        single = data_type.typeName() == "struct"
        entries = F.array_compact(F.array(part)) if single else F.col(part)
        shape = data_type if single else data_type.elementType
        items = F.transform(entries, lambda x: F.concat_ws(" : ", *[text(x[f], f, shape[f].dataType) for f in fields]))
        return F.array_join(F.array_sort(items), " ; ").alias(part)

    head = [*c.TABLE_KEY, "partition_key", "parent_schema", "parent_table", "comment"]
    return assembled.select(*head, *[whole(p, f) for p, (_, f) in _PARTS.items()])


@query("assemble_catalog_schema", _scoped_sql("postgres", False))
def assembled_schema(spark, d):
    """One schema of every source, each part in full."""
    return _part_texts(c.assemble_catalog(pg_catalog(spark, d), c.Scope(_SCHEMA)))


@query("assemble_catalog_table", _scoped_sql("postgres", True))
def assembled_table(spark, d):
    return _part_texts(c.assemble_catalog(pg_catalog(spark, d), _one_table(spark, d)))


@query("assemble_catalog_schema_mysql", _scoped_sql("mysql", False))
def assembled_schema_mysql(spark, d):
    return _part_texts(c.assemble_catalog(mysql_catalog(spark, d, _MY_PARTS), c.Scope(_SCHEMA)))


@query("assemble_catalog_table_mysql", _scoped_sql("mysql", True))
def assembled_table_mysql(spark, d):
    return _part_texts(c.assemble_catalog(mysql_catalog(spark, d, _MY_PARTS), _one_table(spark, d)))


def _reflected_sql() -> str:
    """One line for each key, foreign key, index and column of the scope."""
    parts = []
    for part in ("columns", "primary_key", "foreign_keys", "indexes"):
        name, fields = _PARTS[part]
        item = "concat_ws(' : ', " + ", ".join(f"coalesce({f}::VARCHAR, '-')" for f in fields) + ")"
        parts.append(f"SELECT '{part}' AS part, source_id, table_name, {item} AS item FROM ({ORACLES[name]}) x WHERE schema_name = '{_SCHEMA}'")
    return " UNION ALL ".join(parts)


@query("reflect_schema_scope", _reflected_sql())
def reflected_schema(spark, d):
    """Columns, keys and indexes of one schema; attributes and indexes of others are not aggregated."""
    scope = c.Scope(_SCHEMA)
    cat = c.scoped(pg_catalog(spark, d), scope)
    frames = {"columns": c.reflect_columns(cat, scope), "primary_key": _joined(c.reflect_primary_keys(cat, scope), "columns"),
              "foreign_keys": _joined(c.reflect_foreign_keys(cat, scope), "columns", "referenced_columns"),
              "indexes": _index_text(c.reflect_indexes(cat, scope))}
    lines = [df.select(F.lit(part).alias("part"), "source_id", "table_name",
                       F.concat_ws(" : ", *[F.coalesce(F.col(f).cast("string"), F.lit("-")) for f in _PARTS[part][1]]).alias("item"))
             for part, df in frames.items()]
    return reduce(DataFrame.unionAll, lines)


def _ddl_sql(engine: str, quote: str, types: str, native: str) -> str:
    def q(text: str) -> str:
        return f"'{quote}' || {text} || '{quote}'"
    table_q = f"{q('n.nspname')} || '.' || {q('c.relname')}"
    extra = ("CASE WHEN q % 16 <= 1 AND disc < 0.01 THEN ' GENERATED ALWAYS AS IDENTITY' WHEN q % 16 <= 1 AND disc > 0.09 THEN ' GENERATED BY DEFAULT AS IDENTITY'"
             " WHEN q % 16 = 4 THEN ' DEFAULT ''x''::text' ELSE '' END") if engine == "postgres" else (
             "CASE WHEN q % 16 <= 1 AND (disc < 0.01 OR disc > 0.09) THEN ' AUTO_INCREMENT' WHEN q % 16 = 4 THEN ' DEFAULT ''x''::text' ELSE '' END")
    method = "' USING ' || CASE WHEN k1 = 1 THEN 'btree' ELSE 'hash' END"
    key = f"'PRIMARY KEY (' || {q(chr(39) + 'c' + chr(39) + ' || k2')} || CASE WHEN k1 <> k2 THEN ', ' || {q(chr(39) + 'c' + chr(39) + ' || k1')} ELSE '' END || ')'"
    c1, c2, t1, t2 = (q(f"'c' || {x}") for x in ("k.k1", "k.k2", "t.k1", "t.k2"))
    partition = "coalesce(' PARTITION BY ' || c.partkeydef, '')" if engine == "postgres" else "''"
    head = "SELECT c.source_id, n.nspname AS schema_name, c.relname AS table_name"
    parts = [
        f"""{head}, 1 AS phase, 0 AS position, 'CREATE TABLE ' || {table_q} || ' (' || chr(10) || '  ' || concat_ws(',' || chr(10) || '  ',
 (SELECT string_agg({q('attname')} || ' ' || {types} || CASE WHEN disc < 0.05 THEN ' NOT NULL' ELSE '' END || {extra}, ',' || chr(10) || '  ' ORDER BY attnum) FROM att a WHERE a.source_id = c.source_id AND a.attrelid = c.oid AND a.tax < 0.08),
 {key}) || chr(10) || ')' || {partition} AS statement {_REL} LEFT JOIN k ON k.source_id = c.source_id AND k.rel = c.oid""",
        f"{head}, 2, 0, 'ALTER TABLE ' || {table_q} || ' ADD CONSTRAINT ' || {q(chr(39) + 'u_' + chr(39) + ' || k.rel')} || ' UNIQUE (' || {c1} || ', ' || {c2} || ')' {_K} WHERE k1 <> k2 AND price > 200000",
        f"""{head}, 3, 0, 'ALTER TABLE ' || {table_q} || ' ADD CONSTRAINT ' || {q(chr(39) + 'ck_' + chr(39) + ' || k.rel')} || ' CHECK (' ||
 CASE WHEN price < 150000 THEN '(c1 > 0)' WHEN price < 250000 THEN 'c1 IS NOT NULL' ELSE '(c1 <> ''a)''::text)' END || ')' {_K}""",
        f"""{head}, 5, 0, 'ALTER TABLE ' || {table_q} || ' ADD CONSTRAINT ' || {q(chr(39) + 'f_' + chr(39) + ' || k.rel')} || ' FOREIGN KEY (' || {c1} || CASE WHEN k.k1 <> k.k2 AND t.k1 <> t.k2 THEN ', ' || {c2} ELSE '' END
 || ') REFERENCES ' || {q('n.nspname')} || '.' || {q(chr(39) + 't_' + chr(39) + ' || p.parent')} || ' (' || {t1} || CASE WHEN k.k1 <> k.k2 AND t.k1 <> t.k2 THEN ', ' || {t2} ELSE '' END || ') ON UPDATE '
 || CASE k.status WHEN 'O' THEN 'CASCADE' WHEN 'F' THEN 'RESTRICT' ELSE 'NO ACTION' END || ' ON DELETE ' || CASE WHEN k.price < 100000 THEN 'NO ACTION' WHEN k.price < 200000 THEN 'SET NULL' WHEN k.price < 300000 THEN 'SET DEFAULT' ELSE 'CASCADE' END
 {_K} JOIN parents p ON p.source_id = k.source_id AND p.custkey = k.custkey JOIN k t ON t.source_id = k.source_id AND t.rel = p.parent""",
        f"""{head}, 6, 0, 'CREATE ' || CASE WHEN price > 300000 THEN 'UNIQUE ' ELSE '' END || 'INDEX ' || {q(chr(39) + 'ix_' + chr(39) + ' || k.rel')} || {method} || ' ON ' || {table_q} || ' (' || {c2} || ' DESC, ' || {c1} || ')'
 {_K} WHERE NOT (k1 <> k2 AND price > 200000)""",
    ]
    if engine == "postgres":
        parts.append(f"{head}, 4, 0, 'ALTER TABLE ' || {table_q} || ' ADD CONSTRAINT ' || {q(chr(39) + 'x_' + chr(39) + ' || k.rel')} || ' EXCLUDE USING gist (c1 WITH &&)' {_K} WHERE price > 400000")
    return oracle(PG, "\nUNION ALL ".join(parts))


@query("render_ddl_postgres", _ddl_sql("postgres", '"', _TO_PG, "pg"))
def ddl_postgres(spark, d):
    return ddl.render_ddl(c.assemble_catalog(pg_catalog(spark, d)), "postgres")


@query("render_ddl_mysql", _ddl_sql("mysql", "`", _TO_MYSQL, "my"))
def ddl_mysql(spark, d):
    return ddl.render_ddl(c.assemble_catalog(pg_catalog(spark, d)), "mysql")


@query("render_ddl_spark", oracle(PG, f"""
SELECT {_SQL_KEY}, 1 AS phase, 0 AS position, 'CREATE TABLE `' || n.nspname || '`.`' || c.relname || '` (' || chr(10) || '  ' || coalesce(
 (SELECT string_agg('`' || attname || '` ' || {_TO_SPARK} || CASE WHEN disc < 0.05 THEN ' NOT NULL' ELSE '' END || CASE WHEN q % 16 = 4 THEN ' DEFAULT ''x''::text' ELSE '' END, ',' || chr(10) || '  ' ORDER BY attnum)
  FROM att a WHERE a.source_id = c.source_id AND a.attrelid = c.oid AND a.tax < 0.08), '') || chr(10) || ') USING parquet' AS statement {_REL}"""))
def ddl_spark(spark, d):
    return ddl.render_ddl(c.assemble_catalog(pg_catalog(spark, d)), "spark")


@query("schema_diff", oracle(PG, f"""
SELECT {_SQL_KEY}, attname AS column_name, 'type changed' AS changes {_ATT} WHERE q % 16 IN (6, 10, 12, 13)
UNION ALL SELECT {_SQL_KEY}, attname, 'identity changed' {_ATT} WHERE q % 16 <= 1 AND disc < 0.01"""))
def diff_catalogs(spark, d):
    """The reflected catalogue against itself after a move to MySQL types and identities."""
    cols = _columns(spark, d, ("k",))  # read twice
    key = ["source_id", "schema_name", "table_name", "column_name"]
    here = cols.select(*key, "ordinal", t.to_pg_type(F.col("t")).alias("type"), "nullable", "identity")
    moved = t.map_mysql_types(t.computed(cols, moved_type=t.to_mysql_type(F.col("t"))), "moved_type", "moved")
    there = moved.select(*key, "ordinal", t.to_pg_type(F.col("moved")).alias("type"), "nullable",
                         F.when(F.col("identity").isNotNull(), "by_default").alias("identity"))
    return schema_diff(here, there, key).select(*key, F.array_join("changes", ",").alias("changes"))
