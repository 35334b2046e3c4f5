from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tablebridge.model import ReflectionError, UnsupportedError
from tablebridge.operators import catalog as c, ddl, typemap as t
from tablebridge.operators.verify import schema_diff

PG = [  # every category of the type model, each with and without its modifiers
    ("smallint", "smallint", {}), ("bigint", "bigint", {}), ("real", "real", {}), ("double precision", "double", {}), ("boolean", "boolean", {}),
    ("numeric", "decimal", {"precision": None, "scale": None}), ("numeric(7)", "decimal", {"precision": 7, "scale": None}),
    ("numeric(31,6)", "decimal", {"precision": 31, "scale": 6}), ("character(12)", "char", {"length": 12}), ("character varying", "varchar", {"length": None}),
    ("character varying(64)", "varchar", {"length": 64}), ("text", "text", {}), ("xml", "xml", {}), ("bytea", "blob", {}), ("uuid", "uuid", {}),
    ("date", "date", {}), ("interval", "interval", {}), ("time without time zone", "time", {"precision": None, "tz": False}),
    ("time(2) with time zone", "time", {"precision": 2, "tz": True}), ("timestamp(0) without time zone", "timestamp", {"precision": 0, "tz": False}),
    ("timestamp with time zone", "timestamp", {"precision": None, "tz": True}), ("json", "json", {"binary": False}), ("jsonb", "json", {"binary": True}),
    ("bit(9)", "bit", {"length": 9}), ("bit varying(17)", "bit", {"length": 17}), ("date[]", "date", {"dims": 1}), ("numeric(9,3)[]", "decimal", {"scale": 3, "dims": 1}),
    ("text[][][]", "text", {"dims": 3}), ("timestamp(4) with time zone[]", "timestamp", {"precision": 4, "dims": 1}),
    ("fuel", "enum", {"labels": ["petrol", "diesel"]}), ("fuel[]", "enum", {"dims": 1}), ("other.fuel", "enum", {"labels": ["x"]}),
    ("macaddr", "unsupported", {"native": "macaddr"}), ("tsvector", "unsupported", {"native": "tsvector"}),
]
MYSQL = [
    ("tinyint(1)", "boolean", {}), ("tinyint(3)", "smallint", {}), ("tinyint unsigned", "smallint", {}), ("smallint unsigned", "integer", {}), ("mediumint(9)", "integer", {}),
    ("int unsigned zerofill", "bigint", {}), ("bigint", "bigint", {}), ("bigint unsigned", "decimal", {"precision": 20, "scale": 0}),
    ("decimal(18,4)", "decimal", {"precision": 18, "scale": 4}), ("decimal(6,1) unsigned", "decimal", {"precision": 6, "scale": 1}), ("float", "real", {}), ("double", "double", {}),
    ("char(2)", "char", {"length": 2}), ("varchar(700)", "varchar", {"length": 700}), ("mediumtext", "text", {}), ("varbinary(16)", "varbinary", {"length": 16}), ("longblob", "blob", {}),
    ("date", "date", {}), ("time(1)", "time", {"precision": 1, "tz": False}), ("datetime(6)", "timestamp", {"precision": 6, "tz": False}), ("year", "integer", {}),
    ("json", "json", {"binary": True}), ("bit(3)", "bit", {"length": 3}), ("enum('petrol','gas, bottled','driver''s')", "enum", {"labels": ["petrol", "gas, bottled", "driver's"]}),
    ("set('x','y','z')", "unsupported", {"native": "set('x','y','z')"}), ("multipolygon", "geometry", {"subtype": "multipolygon"}),
]
TARGETS = [  # canonical from PostgreSQL text: (native, pg, mysql, spark)
    ("character", "character(1)", "char(1)", "char(1)"), ("character varying", "character varying", "varchar(255)", "string"), ("bit", "bit(1)", "bit(1)", "string"),
    ("numeric", "numeric", "decimal", "decimal(38,18)"), ("numeric(7)", "numeric(7)", "decimal(7)", "decimal(7,0)"), ("numeric(50,2)", "numeric(50,2)", "decimal(50,2)", "string"),
    ("time(3) with time zone", "time(3) with time zone", "time(3)", "string"), ("time without time zone", "time without time zone", "time", "string"),
    ("timestamp(0) without time zone", "timestamp(0) without time zone", "datetime", "timestamp_ntz"), ("timestamp with time zone", "timestamp with time zone", "datetime", "timestamp"),
    ("interval", "interval", "varchar(255)", "string"), ("uuid", "uuid", "char(36)", "string"), ("json", "json", "json", "string"), ("jsonb", "jsonb", "json", "variant"),
    ("xml", "xml", "text", "string"), ("integer[][]", "integer[][]", "json", "array<array<int>>"), ("fuel", "text", "enum('petrol', 'diesel')", "string"), ("bytea", "bytea", "blob", "binary"),
    ("cidr", "cidr", "cidr", "string"),
]


def inventory(spark, natives):
    return spark.createDataFrame([("s", "app", "t", f"c{i}", n) for i, n in enumerate(natives)],
                                 "source_id string, schema_name string, table_name string, column_name string, native_type string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([("s", "app", "fuel", ["petrol", "diesel"]), ("s", "other", "fuel", ["x"]), ("s2", "app", "cidr", ["no"])],
                                 "source_id string, schema_name string, type_name string, labels array<string>")


def check(rows, cases):
    got = {r.native_type: r.t for r in rows}
    for native, category, fields in cases:
        assert got[native].category == category, native
        for name, value in fields.items():
            assert got[native][name] == value, (native, name)


def test_pg_types(spark, labels):
    check(t.map_pg_types(inventory(spark, [n for n, *_ in PG]), labels).collect(), PG)


def test_mysql_types(spark):
    check(t.map_mysql_types(inventory(spark, [n for n, *_ in MYSQL])).collect(), MYSQL)


def test_target_types(spark, labels):
    df = t.map_pg_types(inventory(spark, [n for n, *_ in TARGETS]), labels)
    out = df.select("native_type", *[t.target_type(F.col("t"), e).alias(e) for e in ("postgres", "mysql", "spark")]).collect()
    assert sorted(map(tuple, out)) == sorted(TARGETS)
    with pytest.raises(UnsupportedError):
        t.target_type(F.col("t"), "db2")
    with pytest.raises(UnsupportedError):
        t.lossy_columns(df, "spark")


def test_losses(spark, labels):
    df = t.map_pg_types(inventory(spark, ["integer", "uuid", "fuel", "jsonb", "json", "timestamp with time zone", "integer[]", "cidr", "character varying", "xml"]), labels)
    found = {r.native_type: r.losses for r in t.lossy_columns(df, "mysql").collect()}
    assert found == {"uuid": ["category"], "json": ["json form"], "timestamp with time zone": ["time zone"], "integer[]": ["category", "array"],
                     "cidr": ["passed through"], "character varying": ["length"], "xml": ["category"]}
    assert {r.native_type for r in t.lossy_columns(df, "postgres").collect()} == {"fuel", "cidr"}


@pytest.fixture(scope="module")
def pg(spark):
    """Two sources; in the first a parent and a child with every kind of constraint."""
    f = spark.createDataFrame
    return c.PgCatalog(
        namespace=f([("s", 1, "app"), ("s", 2, "pg_catalog"), ("s", 3, "pg_toast_9"), ("s2", 1, "app")], "source_id string, oid long, nspname string"),
        class_=f([("s", 10, "parent", 1, "r", False, None, None, "", None), ("s", 11, "child", 1, "p", False, None, "RANGE (id)", "kids", None),
                  ("s", 12, "child_1", 1, "r", True, None, None, None, None), ("s", 13, 'odd"name', 1, "r", False, None, None, None, None),
                  ("s", 20, "child_ix", 1, "i", False, 403, None, None, None), ("s", 30, "v", 1, "v", False, None, None, None, "SELECT 1"),
                  ("s", 99, "pg_class", 2, "r", False, None, None, None, None), ("s2", 10, "alone", 1, "r", False, None, None, None, None)],
                 "source_id string, oid long, relname string, relnamespace long, relkind string, relispartition boolean, relam long, partkeydef string, comment string, viewdef string"),
        attribute=f([("s", 10, 1, "id", "integer", True, False, "a", None, None), ("s", 11, 1, "id", "bigint", True, False, "d", "7", None),
                     ("s", 11, 2, "gone", "text", False, True, "", None, None), ("s", 11, 3, "parent_id", "integer", False, False, "", None, "ref"),
                     ("s", 11, 4, "code", "character varying(20)", True, False, "", "'x'::text", None), ("s", 12, 1, "id", "bigint", True, False, "", None, None),
                     ("s", 30, 1, "one", "integer", False, False, "", None, None), ("s", 11, -1, "ctid", "tid", True, False, "", None, None)],
                    "source_id string, attrelid long, attnum short, attname string, native_type string, attnotnull boolean, attisdropped boolean, attidentity string, default_expr string, comment string"),
        constraint=f([("s", 1, "parent_pkey", "p", 10, None, [1], None, None, None, None, None), ("s", 2, "child_pkey", "p", 11, None, [4, 1], None, None, None, 21, None),
                      ("s", 3, "child_fk", "f", 11, 10, [3], [1], "a", "c", None, None), ("s", 4, "child_code", "u", 11, None, [4], None, None, None, 22, None),
                      ("s", 5, "child_ck", "c", 11, None, [1], None, None, None, None, "CHECK ((id > 0)) NOT VALID"), ("s", 6, "child_x", "x", 11, None, [1], None, None, None, None, "EXCLUDE USING gist (id WITH =)")],
                     "source_id string, oid long, conname string, contype string, conrelid long, confrelid long, conkey array<short>, confkey array<short>, confupdtype string, confdeltype string, conindid long, definition string"),
        index=f([("s", 20, 11, [3, 0, 4], [1, 0, 0], False, False), ("s", 21, 11, [4, 1], [0, 0], True, True), ("s", 22, 11, [4], [0], True, False)],
                "source_id string, indexrelid long, indrelid long, indkey array<short>, indoption array<short>, indisunique boolean, indisprimary boolean"),
        am=f([("s", 403, "btree")], "source_id string, oid long, amname string"),
        inherits=f([("s", 12, 11), ("s", 13, 10)], "source_id string, inhrelid long, inhparent long"),
        trigger=f([("s", 1, 11, "tr", 2 + 4 + 16, False, 5, "CREATE TRIGGER tr")],
                  "source_id string, oid long, tgrelid long, tgname string, tgtype int, tgisinternal boolean, tgfoid long, definition string"),
        proc=f([("s", 5, "fn", 1, "f", 14, " ", None, "BEGIN")], "source_id string, oid long, proname string, pronamespace long, prokind string, prolang long, args string, result string, body string"),
        language=f([("s", 14, "plpgsql")], "source_id string, oid long, lanname string"))


def by_table(df):
    return {(r.source_id, r.table_name): r for r in df.collect()}


def test_reflected_tables(pg):
    assert sorted(map(tuple, c.reflect_schemas(pg).collect())) == [("s", "app"), ("s2", "app")]
    tables = by_table(c.reflect_tables(pg))
    assert set(tables) == {("s", "parent"), ("s", "child"), ("s", "child_1"), ("s", 'odd"name'), ("s2", "alone")}
    assert tables["s", "child"].partition_key == "RANGE (id)"
    assert (tables["s", "child_1"].parent_schema, tables["s", "child_1"].parent_table) == ("app", "child")
    assert tables["s", 'odd"name'].parent_table is None  # plain inheritance
    assert [r.comment for r in c.reflect_comments(pg).collect()] == ["kids"]


def test_reflected_parts(pg):
    cols = c.reflect_columns(pg, c.Scope("app", "child")).orderBy("ordinal").collect()
    assert [(r.column_name, r.nullable, r.identity) for r in cols] == [("id", False, "by_default"), ("parent_id", True, None), ("code", False, None)]
    assert by_table(c.reflect_primary_keys(pg))["s", "child"].columns == ["code", "id"]
    fk = c.reflect_foreign_keys(pg).first()
    assert (fk.columns, fk.referenced_table, fk.referenced_columns, fk.on_delete, fk.on_update) == (["parent_id"], "parent", ["id"], "CASCADE", "NO ACTION")
    assert c.reflect_check_constraints(pg).first().expression == "(id > 0)"
    ix = c.reflect_indexes(pg).collect()
    assert [(r.index_name, [tuple(x) for x in r.columns], r.method) for r in ix] == [("child_ix", [("parent_id", True), ("code", False)], "btree")]
    tr = c.reflect_triggers(pg).first()
    assert (tr.timing, tr.events, tr.function_name) == ("BEFORE", ["INSERT", "UPDATE"], "fn")
    assert c.reflect_functions(pg).first().arguments == []
    assert [r.column_name for r in c.reflect_view_columns(pg).collect()] == ["one"]


def test_assembled_equals_the_parts(pg):
    whole = by_table(c.assemble_catalog(pg))
    child = whole["s", "child"]
    assert [x.column_name for x in child.columns] == ["id", "parent_id", "code"]
    assert child.primary_key.columns == ["code", "id"] and child.foreign_keys[0].columns == ["parent_id"]
    assert (child.unique_constraints[0].columns, child.check_constraints[0].expression) == (["code"], "(id > 0)")
    assert [tuple(x) for x in child.indexes[0].columns] == [("parent_id", True), ("code", False)]
    assert whole["s2", "alone"].columns == [] and whole["s2", "alone"].primary_key is None
    one = c.assemble_catalog(pg, c.Scope("app", "child")).collect()
    assert [tuple(r) for r in one] == [tuple(child)]
    with pytest.raises(ReflectionError):
        c.assemble_catalog(pg, c.Scope("app", "nope"))


def test_scopes_filter_before_aggregation(spark, pg):
    """A scope aggregates its own attributes and labels alone, and types of other schemas keep their labels."""
    more = spark.createDataFrame([("s", 40, "color", 3), ("s", 41, "color", 1), ("s", 42, "unused", 1)], "source_id string, oid long, typname string, typnamespace long")
    labels = spark.createDataFrame([("s", 40, "red", 1.0), ("s", 41, "blue", 1.0), ("s", 42, "x", 1.0)], "source_id string, enumtypid long, enumlabel string, enumsortorder float")
    attribute = pg.attribute.withColumn("native_type", F.when(F.col("attname") == "code", "pg_toast_9.color[]").when(F.col("attname") == "parent_id", "color").otherwise(F.col("native_type")))
    cat = replace(pg, type_=more, enum=labels, attribute=attribute)
    scope = c.Scope("app", "child")
    found = {r.column_name: r.t.labels for r in c.reflect_columns(cat, scope).collect()}
    assert found == {"id": None, "parent_id": ["blue"], "code": ["red"]}
    for reflect in (c.reflect_columns, c.reflect_primary_keys, c.reflect_foreign_keys, c.reflect_indexes, c.reflect_unique_constraints):
        key = lambda r: str(r)
        whole = [r for r in reflect(cat).collect() if r.table_name == "child" and r.source_id == "s"]
        assert sorted(reflect(cat, scope).collect(), key=key) == sorted(whole, key=key)
    wide = c._attribute_names(cat, scope, c._relations(cat, scope, ("r", "p")).withColumnRenamed("oid", "conrelid"), "conrelid")
    assert [r.conrelid for r in wide.collect()] == [11]
    assert {r.type_name for r in c._labels_for(cat, scope, c.reflect_columns(cat, scope)).collect()} == {"color"}


def test_a_scoped_catalogue_holds_what_the_scope_reads(spark, pg):
    """Rows of the scope and of what it refers to stay, others go, and all reflections of the scope find the same."""
    types = spark.createDataFrame([("s", 40, "color", 3), ("s", 41, "color", 1), ("s", 43, "color", 2)], "source_id string, oid long, typname string, typnamespace long")
    labels = spark.createDataFrame([("s", 40, "red", 1.0), ("s", 41, "blue", 1.0), ("s", 43, "x", 1.0)], "source_id string, enumtypid long, enumlabel string, enumsortorder float")
    attribute = pg.attribute.withColumn("native_type", F.when(F.col("attname") == "code", "pg_toast_9.color[]").when(F.col("attname") == "parent_id", "color").otherwise(F.col("native_type")))
    cat = replace(pg, type_=types, enum=labels, attribute=attribute)
    for scope in (c.Scope("app", "child"), c.Scope("app")):
        own = c.scoped(cat, scope)
        for reflect in (c.reflect_tables, c.reflect_columns, c.reflect_primary_keys, c.reflect_foreign_keys, c.reflect_unique_constraints, c.reflect_check_constraints,
                        c.reflect_exclusion_constraints, c.reflect_indexes, c.reflect_triggers, c.reflect_views, c.reflect_functions, c.reflect_enums):
            assert sorted(map(str, reflect(own, scope).collect())) == sorted(map(str, reflect(cat, scope).collect())), (scope, reflect)
    own = c.scoped(cat, c.Scope("app", "child"))
    assert {(r.source_id, r.attrelid) for r in own.attribute.collect()} == {("s", 10), ("s", 11)}
    assert {(r.source_id, r.oid) for r in own.class_.collect()} == {("s", 10), ("s", 11), ("s", 20)}
    assert {r.enumtypid for r in own.enum.collect()} == {40, 41}
    assert c.scoped(cat, c.ALL) is cat


def test_missing_snapshots_read_as_empty(pg):
    bare = c.PgCatalog(pg.namespace, pg.class_, pg.attribute)
    for reflect in (c.reflect_primary_keys, c.reflect_foreign_keys, c.reflect_unique_constraints, c.reflect_check_constraints, c.reflect_exclusion_constraints,
                    c.reflect_indexes, c.reflect_triggers, c.reflect_enums, c.reflect_sequences, c.reflect_functions):
        assert reflect(bare).count() == 0
    assert by_table(c.assemble_catalog(bare))["s", "child"].indexes == []


def test_unresolvable_key_column_stops(spark, pg):
    broken = c.PgCatalog(pg.namespace, pg.class_, pg.attribute.where("attname <> 'parent_id'"), pg.constraint)
    for attempt in (c.reflect_foreign_keys, c.assemble_catalog):
        with pytest.raises(Exception, match="unresolved key column of child_fk"):
            attempt(broken).collect()


def test_ddl(pg):
    out = ddl.render_ddl(c.assemble_catalog(pg), "postgres").collect()
    child = [r.statement for r in sorted(out, key=lambda r: (r.phase, r.position)) if r.table_name == "child" and r.source_id == "s"]
    assert child == [
        'CREATE TABLE "app"."child" (\n  "id" bigint NOT NULL GENERATED BY DEFAULT AS IDENTITY,\n  "parent_id" integer,\n'
        '  "code" character varying(20) NOT NULL DEFAULT \'x\'::text,\n  PRIMARY KEY ("code", "id")\n) PARTITION BY RANGE (id)',
        'ALTER TABLE "app"."child" ADD CONSTRAINT "child_code" UNIQUE ("code")',
        'ALTER TABLE "app"."child" ADD CONSTRAINT "child_ck" CHECK ((id > 0))',
        'ALTER TABLE "app"."child" ADD CONSTRAINT "child_x" EXCLUDE USING gist (id WITH =)',
        'ALTER TABLE "app"."child" ADD CONSTRAINT "child_fk" FOREIGN KEY ("parent_id") REFERENCES "app"."parent" ("id") ON UPDATE NO ACTION ON DELETE CASCADE',
        'CREATE INDEX "child_ix" USING btree ON "app"."child" ("parent_id" DESC, "code")']
    assert not any(r.statement.endswith(";") for r in out)
    assert any('"odd""name"' in r.statement for r in out)
    mysql = [r.statement for r in ddl.render_ddl(c.assemble_catalog(pg, c.Scope("app", "child")), "mysql").orderBy("phase").collect()]
    assert mysql[0].startswith("CREATE TABLE `app`.`child` (\n  `id` bigint NOT NULL AUTO_INCREMENT,") and not any("EXCLUDE" in s or "PARTITION" in s for s in mysql)
    with pytest.raises(UnsupportedError):
        ddl.render_ddl(c.assemble_catalog(pg), "db2")


def test_spark_ddl_runs(spark, pg):
    spark.sql("CREATE DATABASE IF NOT EXISTS app")
    made = ddl.render_ddl(c.assemble_catalog(pg, c.Scope("app", "parent")), "spark").first().statement
    spark.sql(made)
    assert spark.table("app.parent").dtypes == [("id", "int")]


def test_catalogue_diff(pg):
    cols = c.reflect_columns(pg).withColumnRenamed("native_type", "type")
    changed = cols.withColumn("nullable", F.when(F.col("column_name") == "code", F.lit(True)).otherwise(F.col("nullable"))).where("column_name <> 'parent_id'")
    key = ["source_id", "schema_name", "table_name", "column_name"]
    assert {r.column_name: r.changes for r in schema_diff(cols, changed, key).collect()} == {"code": ["nullability changed"], "parent_id": ["removed"]}


@pytest.fixture(scope="module")
def mysql(spark):
    f = spark.createDataFrame
    return c.MysqlCatalog(
        tables=f([("s", "app", "parent", "BASE TABLE", ""), ("s", "app", "child", "BASE TABLE", "kids"), ("s", "app", "v", "VIEW", ""), ("s", "mysql", "user", "BASE TABLE", "")],
                 "source_id string, table_schema string, table_name string, table_type string, table_comment string"),
        columns=f([("s", "app", "parent", "id", 1, "int(10) unsigned", "NO", None, "auto_increment", ""), ("s", "app", "child", "b", 2, "varchar(9)", "YES", "'x'", "", "about b"),
                   ("s", "app", "child", "a", 1, "bigint unsigned", "NO", None, "", ""), ("s", "app", "v", "z", 1, "int", "YES", None, "", "")],
                  "source_id string, table_schema string, table_name string, column_name string, ordinal_position long, column_type string, is_nullable string, column_default string, extra string, column_comment string"),
        statistics=f([("s", "app", "child", "PRIMARY", 2, "a", 0, "BTREE", "A"), ("s", "app", "child", "PRIMARY", 1, "b", 0, "BTREE", "A"), ("s", "app", "child", "u", 1, "b", 0, "BTREE", "A"),
                      ("s", "app", "child", "ix", 2, "b", 1, "HASH", "A"), ("s", "app", "child", "ix", 1, "a", 1, "HASH", "D")],
                     "source_id string, table_schema string, table_name string, index_name string, seq_in_index long, column_name string, non_unique long, index_type string, collation string"),
        key_column_usage=f([("s", "app", "u", "app", "child", "b", 1, None, None, None), ("s", "app", "fk", "app", "child", "a", 2, "app", "parent", "q"), ("s", "app", "fk", "app", "child", "b", 1, "app", "parent", "p"),
                            ("s", "app", "norule", "app", "child", "a", 1, "app", "parent", "q")],
                           "source_id string, constraint_schema string, constraint_name string, table_schema string, table_name string, column_name string, ordinal_position long, referenced_table_schema string, referenced_table_name string, referenced_column_name string"),
        referential_constraints=f([("s", "app", "fk", "child", "cascade", "SET NULL"), ("s", "app", "fk", "parent", "RESTRICT", "RESTRICT")],
                                  "source_id string, constraint_schema string, constraint_name string, table_name string, update_rule string, delete_rule string"),
        table_constraints=f([("s", "app", "app", "child", "u", "UNIQUE"), ("s", "app", "app", "child", "ck", "CHECK")],
                            "source_id string, constraint_schema string, table_schema string, table_name string, constraint_name string, constraint_type string"),
        check_constraints=f([("s", "app", "child", "ck", "(a > 0)"), ("s", "app", "parent", "ck", "(id > 0)")], "source_id string, constraint_schema string, table_name string, constraint_name string, check_clause string"),
        triggers=f([("s", "app", "child", "tr", "before", "update", "SET x")], "source_id string, trigger_schema string, event_object_table string, trigger_name string, action_timing string, event_manipulation string, action_statement string"))


def test_mysql_assembly_equals_the_parts(mysql):
    whole = by_table(c.assemble_catalog(mysql))
    assert set(whole) == {("s", "parent"), ("s", "child")}
    child, key = whole["s", "child"], ("source_id", "schema_name", "table_name")
    assert [(x.column_name, x.nullable, x.default_expr, x.comment, x.t.category) for x in child.columns] == [("a", False, None, None, "decimal"), ("b", True, "'x'", "about b", "varchar")]
    assert whole["s", "parent"].columns[0].identity == "by_default" and whole["s", "parent"].foreign_keys == []
    for name, reflect in (("foreign_keys", c.reflect_foreign_keys), ("unique_constraints", c.reflect_unique_constraints), ("check_constraints", c.reflect_check_constraints),
                          ("indexes", c.reflect_indexes), ("triggers", c.reflect_triggers)):
        flat = [{k: v for k, v in r.asDict(True).items() if k not in key} for r in reflect(mysql).collect()]
        assert [x.asDict(True) for x in child[name]] == flat, name
    assert child.primary_key.columns == c.reflect_primary_keys(mysql).first().columns == ["b", "a"]
    fk = child.foreign_keys[0]
    assert (fk.columns, fk.referenced_columns, fk.on_delete, fk.on_update) == (["b", "a"], ["p", "q"], "SET NULL", "CASCADE")
    assert [tuple(x) for x in child.indexes[0].columns] == [("a", True), ("b", False)]
    assert (child.triggers[0].timing, child.triggers[0].events, child.comment) == ("BEFORE", ["UPDATE"], "kids")
    bare = c.MysqlCatalog(mysql.tables, mysql.columns)
    assert by_table(c.assemble_catalog(bare))["s", "child"].indexes == []
    with pytest.raises(ReflectionError):
        c.assemble_catalog(mysql, c.Scope("app", "v"))


def test_mysql_catalogue_renders_for_postgres(mysql):
    out = ddl.render_ddl(c.assemble_catalog(mysql, c.Scope("app", "child")), "postgres").orderBy("phase").collect()
    assert out[0].statement == ('CREATE TABLE "app"."child" (\n  "a" numeric(20,0) NOT NULL,\n  "b" character varying(9) DEFAULT \'x\',\n  PRIMARY KEY ("b", "a")\n)')
    assert [r.phase for r in out] == [1, 2, 3, 5, 6]
