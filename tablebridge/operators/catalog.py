"""Reflection of many databases at once: joins over catalogue snapshot tables.

Every frame carries ``source_id``. Results have the same columns for both
engines. Scoping to a schema or table filters the snapshots before any join:
attributes, indexes and enum labels, which carry only ids, are reduced to the
scoped relations by semi-joins before they are aggregated.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, GroupedData, functions as F

from tablebridge.model import ReflectionError
from tablebridge.operators.typemap import computed, map_mysql_types, map_pg_types, pg_type_names, pg_type_schemas
from tablebridge.session import stage

TABLE_KEY = ["source_id", "schema_name", "table_name"]

# Namespaces of the engines themselves (fixed values).
PG_SYSTEM_SCHEMAS = ("pg_catalog", "information_schema")
PG_SYSTEM_PREFIXES = ("pg_toast", "pg_temp_")
MYSQL_SYSTEM_SCHEMAS = ("information_schema", "mysql", "performance_schema", "sys")

# Referential action codes and words (fixed values).
PG_ACTIONS = {"a": "NO ACTION", "r": "RESTRICT", "c": "CASCADE", "n": "SET NULL", "d": "SET DEFAULT"}
MYSQL_ACTIONS = ("CASCADE", "SET NULL", "SET DEFAULT", "RESTRICT")

# Bits of a PostgreSQL trigger type (fixed values).
TRIGGER_INSTEAD, TRIGGER_BEFORE = 64, 2
TRIGGER_EVENTS = ((4, "INSERT"), (8, "DELETE"), (16, "UPDATE"), (32, "TRUNCATE"))


@dataclass(frozen=True)
class PgCatalog:
    """Snapshots of PostgreSQL's catalogue tables; a missing one reads as empty."""

    namespace: DataFrame
    class_: DataFrame
    attribute: DataFrame
    constraint: DataFrame | None = None
    index: DataFrame | None = None
    am: DataFrame | None = None
    inherits: DataFrame | None = None
    enum: DataFrame | None = None
    type_: DataFrame | None = None
    trigger: DataFrame | None = None
    proc: DataFrame | None = None
    language: DataFrame | None = None
    sequences: DataFrame | None = None


@dataclass(frozen=True)
class MysqlCatalog:
    """Snapshots of ``information_schema`` views; a missing one reads as empty."""

    tables: DataFrame
    columns: DataFrame
    statistics: DataFrame | None = None
    key_column_usage: DataFrame | None = None
    referential_constraints: DataFrame | None = None
    table_constraints: DataFrame | None = None
    check_constraints: DataFrame | None = None
    triggers: DataFrame | None = None
    views: DataFrame | None = None
    sequences: DataFrame | None = None
    routines: DataFrame | None = None


Catalog = PgCatalog | MysqlCatalog


@dataclass(frozen=True)
class Scope:
    """All schemas, one schema, or one table of it."""

    schema: str | None = None
    table: str | None = None

    def of(self, df: DataFrame, schema: str | None = None, table: str | None = None) -> DataFrame:
        if schema and self.schema is not None:
            df = df.where(F.col(schema) == self.schema)
        if table and self.table is not None:
            df = df.where(F.col(table) == self.table)
        return df


ALL = Scope()


def _empty(df: DataFrame, ddl: str) -> DataFrame:
    return df.sparkSession.createDataFrame([], ddl)


def _user_schema(name: Column) -> Column:
    keep = ~name.isin(*PG_SYSTEM_SCHEMAS)
    for prefix in PG_SYSTEM_PREFIXES:
        keep = keep & ~name.startswith(prefix)
    return keep


def scoped(cat: Catalog, scope: Scope) -> Catalog:
    """A catalogue that holds what reflections of ``scope`` read, references to other schemas included.

    Each snapshot is reduced by ids that were written before, so that Spark knows how few they are
    and leaves the large side where it is. An engine's names filter MySQL's views without ids.
    """
    if scope == ALL or isinstance(cat, MysqlCatalog):
        return cat
    named = stage(scope.of(cat.namespace, "nspname").select("source_id", F.col("oid").alias("relnamespace"), F.col("nspname").alias("schema_name")).distinct(), "scope-named")
    spaces = _ids(named, "relnamespace")
    kinds = scope.of(cat.class_, None, "relname").where("relkind NOT IN ('i', 'I')")
    owners = stage(kinds.join(named, ["source_id", "relnamespace"]).select("source_id", F.col("oid").alias("attrelid"), "schema_name").distinct(), "scope-relations")
    relations = _ids(owners, "attrelid")
    constraint = _written(cat.constraint, "scope-constraints", ("conrelid", relations))
    index = _written(cat.index, "scope-indexes", ("indrelid", relations))
    trigger = _written(cat.trigger, "scope-triggers", ("tgrelid", relations))
    inherits = _written(cat.inherits, "scope-inherits", ("inhrelid", relations))
    tables = [relations] if constraint is None else [relations, _ids(constraint, "confrelid")]
    attribute = _written(cat.attribute, "scope-attributes", ("attrelid", *tables))
    others = [_ids(df, name) for df, name in ((inherits, "inhparent"), (index, "indexrelid")) if df is not None]
    class_ = _written(cat.class_, "scope-classes", ("oid", *tables, *others))
    enum, type_, proc, typed = cat.enum, cat.type_, cat.proc, [spaces]
    if type_ is not None:
        names = stage(pg_type_schemas(attribute.join(owners, ["source_id", "attrelid"])).withColumnRenamed("schema_name", "nspname"), "scope-type-schemas")
        typed.append(stage(_ids(cat.namespace.join(names, ["source_id", "nspname"], "left_semi")), "scope-type-namespaces"))
        type_ = _written(type_, "scope-types", ("typnamespace", *typed))
        enum = _written(enum, "scope-enums", ("enumtypid", _ids(type_)))
    if proc is not None:
        called = stage(_ids(_having(proc, ("pronamespace", spaces))), "scope-own-functions")
        proc = _written(proc, "scope-functions", ("oid", *([called] if trigger is None else [called, _ids(trigger, "tgfoid")])))
    namespace = _written(cat.namespace, "scope-schemas", ("oid", *typed, _ids(class_, "relnamespace")))
    return replace(cat, namespace=namespace, class_=class_, attribute=attribute, constraint=constraint, index=index, trigger=trigger,
                   inherits=inherits, enum=enum, type_=type_, proc=proc)


def _ids(df: DataFrame, column: str = "oid") -> DataFrame:
    return df.select("source_id", F.col(column).alias("oid")).where("oid IS NOT NULL").distinct()


def _having(df: DataFrame, wanted: tuple) -> DataFrame:
    """Rows whose column, the first of ``wanted``, holds an id of one of the frames behind it."""
    column, *frames = wanted
    ids = reduce(DataFrame.union, frames).withColumnRenamed("oid", column)
    return df.join(ids, ["source_id", column], "left_semi")


def _written(df: DataFrame | None, label: str, wanted: tuple) -> DataFrame | None:
    return None if df is None else stage(_having(df, wanted), label)


def reflect_schemas(cat: Catalog) -> DataFrame:
    """Namespaces that are not the engine's own."""
    if isinstance(cat, PgCatalog):
        names = cat.namespace.select("source_id", F.col("nspname").alias("schema_name"))
        return names.where(_user_schema(F.col("schema_name"))).distinct()
    names = cat.tables.select("source_id", F.col("table_schema").alias("schema_name"))
    return names.where(~F.col("schema_name").isin(*MYSQL_SYSTEM_SCHEMAS)).distinct()


def _relations(cat: PgCatalog, scope: Scope, kinds: tuple[str, ...]) -> DataFrame:
    """Relations of the wanted kinds with their schema names."""
    ns = scope.of(cat.namespace, "nspname").where(_user_schema(F.col("nspname")))
    rel = scope.of(cat.class_, None, "relname").where(F.col("relkind").isin(*kinds))
    ns = ns.select("source_id", F.col("oid").alias("relnamespace"), F.col("nspname").alias("schema_name"))
    return rel.join(ns, ["source_id", "relnamespace"]).withColumnRenamed("relname", "table_name")


def _mysql_user(df: DataFrame, schema: str) -> DataFrame:
    return df.where(~F.col(schema).isin(*MYSQL_SYSTEM_SCHEMAS))


def reflect_tables(cat: Catalog, scope: Scope = ALL) -> DataFrame:
    """Ordinary tables and partitioned parents, with partition key and parent.

    A parent is given only for real partitions, not for plain inheritance.
    """
    if isinstance(cat, MysqlCatalog):
        base = _mysql_user(scope.of(cat.tables, "table_schema", "table_name"), "table_schema").where("table_type = 'BASE TABLE'")
        none = F.lit(None).cast("string")
        return base.select("source_id", F.col("table_schema").alias("schema_name"), "table_name", none.alias("partition_key"),
                           none.alias("parent_schema"), none.alias("parent_table"),
                           F.nullif("table_comment", F.lit("")).alias("comment"))
    rel = _relations(cat, scope, ("r", "p"))
    key = F.when(F.col("relkind") == "p", F.col("partkeydef")).alias("partition_key")
    base = rel.select(*TABLE_KEY, key, "oid", "relispartition", F.nullif("comment", F.lit("")).alias("comment"))
    return _with_parents(cat, base).select(*TABLE_KEY, "partition_key", "parent_schema", "parent_table", "comment")


def _with_parents(cat: PgCatalog, base: DataFrame) -> DataFrame:
    if cat.inherits is None:
        none = F.lit(None).cast("string")
        return base.withColumns({"parent_schema": none, "parent_table": none})
    parent_ns = cat.namespace.select("source_id", F.col("oid").alias("relnamespace"), F.col("nspname").alias("parent_schema"))
    parents = (cat.class_.where("relkind = 'p'").select("source_id", F.col("oid").alias("inhparent"), "relnamespace",
                                                        F.col("relname").alias("parent_table"))
               .join(parent_ns, ["source_id", "relnamespace"]).drop("relnamespace"))
    links = (cat.inherits.join(parents, ["source_id", "inhparent"])
             .select("source_id", F.col("inhrelid").alias("oid"), F.lit(True).alias("relispartition"), "parent_schema", "parent_table"))
    return base.join(links, ["source_id", "oid", "relispartition"], "left")


def reflect_enums(cat: PgCatalog, scope: Scope = ALL) -> DataFrame:
    """Labels per enum type in sort order, keyed by schema and type; the engine's own schemas are left out."""
    return _enum_labels(cat, scope).where(_user_schema(F.col("schema_name")))


def _enum_labels(cat: PgCatalog, scope: Scope = ALL, named: DataFrame | None = None) -> DataFrame:
    """Labels of the enum types of all schemas, which columns of any schema can name.

    ``named`` (source_id, type_name) leaves only types of these names.
    """
    shape = "source_id string, schema_name string, type_name string, labels array<string>"
    if cat.enum is None or cat.type_ is None:
        return _empty(cat.class_, shape)
    ns = scope.of(cat.namespace, "nspname").select("source_id", F.col("oid").alias("typnamespace"), F.col("nspname").alias("schema_name"))
    types = cat.type_.select("source_id", F.col("oid").alias("enumtypid"), F.col("typname").alias("type_name"), "typnamespace")
    values = cat.enum
    if named is not None:
        types = types.join(named, ["source_id", "type_name"], "left_semi")
        values = values.join(types, ["source_id", "enumtypid"], "left_semi")
    labels = (values.groupBy("source_id", "enumtypid")
              .agg(F.transform(F.array_sort(F.collect_list(F.struct("enumsortorder", "enumlabel"))),
                               lambda x: x["enumlabel"]).alias("labels")))
    return (labels.join(types, ["source_id", "enumtypid"]).join(ns, ["source_id", "typnamespace"])
            .select("source_id", "schema_name", "type_name", "labels"))


def _pg_columns(cat: PgCatalog, scope: Scope, kinds: tuple[str, ...]) -> DataFrame:
    rel = _relations(cat, scope, kinds).select(*TABLE_KEY, F.col("oid").alias("attrelid"))
    live = cat.attribute.where("attnum > 0 AND NOT attisdropped")
    identity = F.when(F.col("attidentity") == "a", "always").when(F.col("attidentity") == "d", "by_default")
    flat = live.join(rel, ["source_id", "attrelid"]).select(
        *TABLE_KEY, F.col("attname").alias("column_name"), F.col("attnum").cast("int").alias("ordinal"), "native_type",
        (~F.col("attnotnull")).alias("nullable"), "default_expr", identity.alias("identity"), "comment")
    return map_pg_types(flat, _labels_for(cat, scope, flat))


def _labels_for(cat: PgCatalog, scope: Scope, columns: DataFrame) -> DataFrame:
    """Enum types of other schemas can be named too, so a scope takes them by name."""
    return _enum_labels(cat) if scope == ALL else _enum_labels(cat, named=pg_type_names(columns))


def reflect_columns(cat: Catalog, scope: Scope = ALL) -> DataFrame:
    """One row per live column, with its canonical type ``t``."""
    if isinstance(cat, PgCatalog):
        return _pg_columns(cat, scope, ("r", "p"))
    tables = reflect_tables(cat, scope).select(*TABLE_KEY)
    return _mysql_columns(cat, scope).join(tables, TABLE_KEY, "left_semi")


def _mysql_columns(cat: MysqlCatalog, scope: Scope) -> DataFrame:
    auto = F.contains(F.lower("extra"), F.lit("auto_increment"))
    flat = _mysql_user(scope.of(cat.columns, "table_schema", "table_name"), "table_schema").select(
        "source_id", F.col("table_schema").alias("schema_name"), "table_name", "column_name",
        F.col("ordinal_position").cast("int").alias("ordinal"), F.col("column_type").alias("native_type"),
        (F.col("is_nullable") == "YES").alias("nullable"), F.col("column_default").alias("default_expr"),
        F.when(auto, "by_default").alias("identity"), F.nullif("column_comment", F.lit("")).alias("comment"))
    return map_mysql_types(flat)


def _attribute_names(cat: PgCatalog, scope: Scope, relations: DataFrame, key: str) -> DataFrame:
    """Per relation a map ``names`` from attribute number to name (an engine allows 1,600), keyed by ``key``.

    A scope reads the attributes of ``relations`` alone.
    """
    attributes = cat.attribute
    if scope != ALL:
        wanted = relations.select("source_id", F.col(key).alias("attrelid"))
        attributes = attributes.join(wanted, ["source_id", "attrelid"], "left_semi")
    return (attributes.groupBy("source_id", F.col("attrelid").alias(key))
            .agg(F.map_from_entries(F.collect_list(F.struct(F.col("attnum").cast("int"), "attname"))).alias("names")))


def _named(names: Column, numbers: Column) -> Column:
    return F.transform(numbers, lambda n: F.try_element_at(names, n.cast("int")))


def _pg_constraints(cat: PgCatalog, scope: Scope, kind: str) -> DataFrame:
    rel = _relations(cat, scope, ("r", "p")).select(*TABLE_KEY, F.col("oid").alias("conrelid"))
    return cat.constraint.where(F.col("contype") == kind).join(rel, ["source_id", "conrelid"])


def _pg_keys(cat: PgCatalog, scope: Scope, kind: str) -> DataFrame:
    if cat.constraint is None:
        return _empty(cat.class_, "source_id string, schema_name string, table_name string, constraint_name string, columns array<string>")
    constraints = _pg_constraints(cat, scope, kind)
    return (constraints.join(_attribute_names(cat, scope, constraints, "conrelid"), ["source_id", "conrelid"])
            .select(*TABLE_KEY, F.col("conname").alias("constraint_name"),
                    F.array_compact(_named(F.col("names"), F.col("conkey"))).alias("columns")))


def _in_order(position: str, *names: str) -> Column:
    return F.array_sort(F.collect_list(F.struct(F.col(position).cast("long").alias("pos"), *names)))


def reflect_primary_keys(cat: Catalog, scope: Scope = ALL) -> DataFrame:
    """Key columns in key order."""
    if isinstance(cat, PgCatalog):
        return _pg_keys(cat, scope, "p")
    if cat.statistics is None:
        return _empty(cat.tables, "source_id string, schema_name string, table_name string, constraint_name string, columns array<string>")
    rows = _mysql_user(scope.of(cat.statistics, "table_schema", "table_name"), "table_schema").where("index_name = 'PRIMARY'")
    return (rows.groupBy("source_id", F.col("table_schema").alias("schema_name"), "table_name")
            .agg(F.transform(_in_order("seq_in_index", "column_name"), lambda x: x["column_name"]).alias("columns"))
            .select(*TABLE_KEY, F.lit("PRIMARY").alias("constraint_name"), "columns"))


def reflect_unique_constraints(cat: Catalog, scope: Scope = ALL) -> DataFrame:
    if isinstance(cat, PgCatalog):
        return _pg_keys(cat, scope, "u")
    if cat.table_constraints is None or cat.key_column_usage is None:
        return _empty(cat.tables, "source_id string, schema_name string, table_name string, constraint_name string, columns array<string>")
    unique = _mysql_user(scope.of(cat.table_constraints, "table_schema", "table_name"), "table_schema").where("constraint_type = 'UNIQUE'")
    uses = scope.of(cat.key_column_usage, "constraint_schema", "table_name").select("source_id", "constraint_schema", "table_name", "constraint_name", "column_name", "ordinal_position")
    return (unique.join(uses, ["source_id", "constraint_schema", "table_name", "constraint_name"])
            .groupBy("source_id", F.col("table_schema").alias("schema_name"), "table_name", "constraint_name")
            .agg(F.transform(_in_order("ordinal_position", "column_name"), lambda x: x["column_name"]).alias("columns")))


FK_SHAPE = ("source_id string, schema_name string, table_name string, constraint_name string, columns array<string>, "
            "referenced_schema string, referenced_table string, referenced_columns array<string>, on_delete string, on_update string")


def reflect_foreign_keys(cat: Catalog, scope: Scope = ALL) -> DataFrame:
    """Both column lists paired by position, and the two actions.

    A key column that cannot be resolved stops the job.
    """
    return _pg_foreign_keys(cat, scope) if isinstance(cat, PgCatalog) else _mysql_foreign_keys(cat, scope)


def _resolved(names: Column, numbers: Column, constraint: Column) -> Column:
    found = _named(names, numbers)
    gap = names.isNull() | F.exists(found, lambda x: x.isNull())
    message = F.concat(F.lit("unresolved key column of "), constraint)
    return F.when(gap, F.raise_error(message).cast("array<string>")).otherwise(found)


def _fk_targets(cat: PgCatalog, scope: Scope, constraints: DataFrame) -> DataFrame:
    """Foreign keys with their referenced table and columns and both actions."""
    other = _attribute_names(cat, scope, constraints, "confrelid").withColumnRenamed("names", "ref_names")
    ref_ns = cat.namespace.select("source_id", F.col("oid").alias("relnamespace"), F.col("nspname").alias("referenced_schema"))
    ref = (cat.class_.where("relkind IN ('r', 'p')")
           .select("source_id", F.col("oid").alias("confrelid"), "relnamespace", F.col("relname").alias("referenced_table"))
           .join(ref_ns, ["source_id", "relnamespace"]).drop("relnamespace"))

    def action(code: str) -> Column:
        words = F.create_map(*[F.lit(x) for kv in PG_ACTIONS.items() for x in kv])
        return F.coalesce(F.try_element_at(words, F.col(code)), F.lit("NO ACTION"))

    return (constraints.join(ref, ["source_id", "confrelid"]).join(other, ["source_id", "confrelid"], "left")
            .withColumns({"referenced_columns": _resolved(F.col("ref_names"), F.col("confkey"), F.col("conname")),
                          "on_delete": action("confdeltype"), "on_update": action("confupdtype")}))


def _pg_foreign_keys(cat: PgCatalog, scope: Scope) -> DataFrame:
    if cat.constraint is None:
        return _empty(cat.class_, FK_SHAPE)
    constraints = _pg_constraints(cat, scope, "f")
    own = _attribute_names(cat, scope, constraints, "conrelid").withColumnRenamed("names", "own_names")
    return (_fk_targets(cat, scope, constraints).join(own, ["source_id", "conrelid"], "left")
            .select(*TABLE_KEY, F.col("conname").alias("constraint_name"),
                    _resolved(F.col("own_names"), F.col("conkey"), F.col("conname")).alias("columns"),
                    "referenced_schema", "referenced_table", "referenced_columns", "on_delete", "on_update"))


def _mysql_action(rule: str) -> Column:
    word = F.upper(rule)
    return F.when(word.isin(*MYSQL_ACTIONS), word).otherwise("NO ACTION")


def _mysql_foreign_keys(cat: MysqlCatalog, scope: Scope) -> DataFrame:
    if cat.key_column_usage is None or cat.referential_constraints is None:
        return _empty(cat.tables, FK_SHAPE)
    uses = _mysql_user(scope.of(cat.key_column_usage, "table_schema", "table_name"), "table_schema").where(
        F.col("referenced_table_name").isNotNull())
    rules = scope.of(cat.referential_constraints, "constraint_schema", "table_name").select("source_id", "constraint_schema", "table_name", "constraint_name", "update_rule", "delete_rule")

    grouped = (uses.groupBy("source_id", "constraint_schema", F.col("table_schema").alias("schema_name"), "table_name", "constraint_name",
                            F.col("referenced_table_schema").alias("referenced_schema"), F.col("referenced_table_name").alias("referenced_table"))
               .agg(_in_order("ordinal_position", "column_name", "referenced_column_name").alias("pairs")))
    return (grouped.join(rules, ["source_id", "constraint_schema", "table_name", "constraint_name"])
            .select(*TABLE_KEY, "constraint_name", F.transform("pairs", lambda x: x["column_name"]).alias("columns"),
                    "referenced_schema", "referenced_table",
                    F.transform("pairs", lambda x: x["referenced_column_name"]).alias("referenced_columns"),
                    _mysql_action("delete_rule").alias("on_delete"), _mysql_action("update_rule").alias("on_update")))


def bare_check(definition: Column) -> Column:
    """The condition without its CHECK frame and without NOT VALID or NO INHERIT."""
    body = F.regexp_replace(F.trim(definition), r"(?:\s+(?:NOT VALID|NO INHERIT))+$", "")
    return F.regexp_replace(body, r"(?s)^CHECK \((.*)\)$", "$1")


def reflect_check_constraints(cat: Catalog, scope: Scope = ALL) -> DataFrame:
    """Bare conditions; a server without the view has none."""
    shape = "source_id string, schema_name string, table_name string, constraint_name string, expression string"
    if isinstance(cat, PgCatalog):
        if cat.constraint is None:
            return _empty(cat.class_, shape)
        return _pg_constraints(cat, scope, "c").select(*TABLE_KEY, F.col("conname").alias("constraint_name"),
                                                       bare_check(F.col("definition")).alias("expression"))
    if cat.check_constraints is None or cat.table_constraints is None:
        return _empty(cat.tables, shape)
    rows = _mysql_user(scope.of(cat.table_constraints, "table_schema", "table_name"), "table_schema").where("constraint_type = 'CHECK'")
    clauses = scope.of(cat.check_constraints, "constraint_schema", "table_name").select("source_id", "constraint_schema", "table_name", "constraint_name", "check_clause")
    return (rows.join(clauses, ["source_id", "constraint_schema", "table_name", "constraint_name"])
            .select("source_id", F.col("table_schema").alias("schema_name"), "table_name", "constraint_name",
                    F.col("check_clause").alias("expression")))


def reflect_exclusion_constraints(cat: Catalog, scope: Scope = ALL) -> DataFrame:
    """Definitions as the engine prints them; only PostgreSQL has any."""
    if isinstance(cat, MysqlCatalog) or cat.constraint is None:
        frame = cat.tables if isinstance(cat, MysqlCatalog) else cat.class_
        return _empty(frame, "source_id string, schema_name string, table_name string, constraint_name string, definition string")
    return _pg_constraints(cat, scope, "x").select(*TABLE_KEY, F.col("conname").alias("constraint_name"), "definition")


INDEX_SHAPE = ("source_id string, schema_name string, table_name string, index_name string, "
               "columns array<struct<name:string,descending:boolean>>, is_unique boolean, method string")


def reflect_indexes(cat: Catalog, scope: Scope = ALL) -> DataFrame:
    """Plain indexes: neither the primary key's nor one that backs a constraint."""
    return _pg_indexes(cat, scope) if isinstance(cat, PgCatalog) else _mysql_indexes(cat, scope)


def _plain_indexes(cat: PgCatalog, indexes: DataFrame, backing_too: bool = False) -> DataFrame:
    own = cat.class_.where("relkind IN ('i', 'I')").select(
        "source_id", F.col("oid").alias("indexrelid"), F.col("relname").alias("index_name"), F.col("relam").alias("amoid"))
    method = cat.am.select("source_id", F.col("oid").alias("amoid"), F.col("amname").alias("method"))
    plain = indexes.where("NOT indisprimary")
    if cat.constraint is not None and not backing_too:
        backing = cat.constraint.where("conindid IS NOT NULL").select("source_id", F.col("conindid").alias("indexrelid"))
        plain = plain.join(backing, ["source_id", "indexrelid"], "left_anti")
    return plain.join(own, ["source_id", "indexrelid"]).join(method, ["source_id", "amoid"])


def _index_columns(names: Column, numbers: Column, options: Column) -> Column:
    """Named key columns; expression keys (number 0) have no name and drop out."""
    pairs = F.zip_with(numbers, options, lambda k, o: F.struct(
        F.try_element_at(names, k.cast("int")).alias("name"),
        (F.coalesce(o.cast("int"), F.lit(0)).bitwiseAND(1) == 1).alias("descending")))
    return F.filter(pairs, lambda x: x["name"].isNotNull())


def _pg_indexes(cat: PgCatalog, scope: Scope) -> DataFrame:
    if cat.index is None or cat.am is None:
        return _empty(cat.class_, INDEX_SHAPE)
    rel = _relations(cat, scope, ("r", "p")).select(*TABLE_KEY, F.col("oid").alias("indrelid"))
    names = _attribute_names(cat, scope, rel, "indrelid")
    own = cat.index if scope == ALL else cat.index.join(rel, ["source_id", "indrelid"], "left_semi")
    return (_plain_indexes(cat, own).join(rel, ["source_id", "indrelid"]).join(names, ["source_id", "indrelid"])
            .select(*TABLE_KEY, "index_name", _index_columns(F.col("names"), F.col("indkey"), F.col("indoption")).alias("columns"),
                    F.col("indisunique").alias("is_unique"), "method"))


def _descending(statistics: DataFrame) -> Column:
    """``collation`` is D for a descending key; older snapshots do not have it."""
    collation = F.col("collation") if "collation" in statistics.columns else F.lit("A")
    return F.coalesce(collation == "D", F.lit(False))


def _mysql_indexes(cat: MysqlCatalog, scope: Scope) -> DataFrame:
    if cat.statistics is None:
        return _empty(cat.tables, INDEX_SHAPE)
    rows = _mysql_user(scope.of(cat.statistics, "table_schema", "table_name"), "table_schema").where("index_name <> 'PRIMARY'")
    if cat.table_constraints is not None:
        backing = scope.of(cat.table_constraints, "table_schema", "table_name").where("constraint_type = 'UNIQUE'").select(
            "source_id", "table_schema", "table_name", F.col("constraint_name").alias("index_name"))
        rows = rows.join(backing, ["source_id", "table_schema", "table_name", "index_name"], "left_anti")
    parts = rows.withColumn("descending", _descending(rows))
    return (parts.groupBy("source_id", F.col("table_schema").alias("schema_name"), "table_name", "index_name",
                          (F.col("non_unique") == 0).alias("is_unique"), F.col("index_type").alias("method"))
            .agg(F.transform(_in_order("seq_in_index", "column_name", "descending"),
                             lambda x: F.struct(x["column_name"].alias("name"), x["descending"].alias("descending"))).alias("columns"))
            .select(*TABLE_KEY, "index_name", "columns", "is_unique", "method"))


TRIGGER_SHAPE = ("source_id string, schema_name string, table_name string, trigger_name string, timing string, "
                 "events array<string>, function_name string, body string")


def trigger_timing(bits: Column) -> Column:
    return (F.when(bits.bitwiseAND(TRIGGER_INSTEAD) != 0, "INSTEAD OF")
            .when(bits.bitwiseAND(TRIGGER_BEFORE) != 0, "BEFORE").otherwise("AFTER"))


def trigger_events(bits: Column) -> Column:
    return F.array_compact(F.array(*[F.when(bits.bitwiseAND(bit) != 0, F.lit(word)) for bit, word in TRIGGER_EVENTS]))


def _plain_triggers(cat: PgCatalog) -> DataFrame:
    proc = cat.proc.select("source_id", F.col("oid").alias("tgfoid"), F.col("proname").alias("function_name"))
    bits = F.col("tgtype").cast("int")
    return (cat.trigger.where("NOT tgisinternal").join(proc, ["source_id", "tgfoid"])
            .select("source_id", "tgrelid", F.col("tgname").alias("trigger_name"), trigger_timing(bits).alias("timing"),
                    trigger_events(bits).alias("events"), "function_name", F.col("definition").alias("body")))


def reflect_triggers(cat: Catalog, scope: Scope = ALL) -> DataFrame:
    """Timing and events from the bit mask or the words; bodies as they are."""
    if isinstance(cat, PgCatalog):
        if cat.trigger is None or cat.proc is None:
            return _empty(cat.class_, TRIGGER_SHAPE)
        rel = _relations(cat, scope, ("r", "p", "v", "m", "f")).select(*TABLE_KEY, F.col("oid").alias("tgrelid"))
        return (_plain_triggers(cat).join(rel, ["source_id", "tgrelid"])
                .select(*TABLE_KEY, "trigger_name", "timing", "events", "function_name", "body"))
    if cat.triggers is None:
        return _empty(cat.tables, TRIGGER_SHAPE)
    rows = _mysql_user(scope.of(cat.triggers, "trigger_schema", "event_object_table"), "trigger_schema")
    event = F.upper("event_manipulation")
    return rows.select("source_id", F.col("trigger_schema").alias("schema_name"), F.col("event_object_table").alias("table_name"), "trigger_name",
                       F.when(F.upper("action_timing") == "BEFORE", "BEFORE").otherwise("AFTER").alias("timing"),
                       F.array(F.when(event.isin("UPDATE", "DELETE"), event).otherwise("INSERT")).alias("events"),
                       F.lit(None).cast("string").alias("function_name"), F.col("action_statement").alias("body"))


def reflect_views(cat: Catalog, scope: Scope = ALL) -> DataFrame:
    """View definitions, materialised ones included."""
    shape = "source_id string, schema_name string, table_name string, definition string"
    if isinstance(cat, PgCatalog):
        return _relations(cat, scope, ("v", "m")).select(*TABLE_KEY, F.col("viewdef").alias("definition"))
    if cat.views is None:
        return _empty(cat.tables, shape)
    rows = _mysql_user(scope.of(cat.views, "table_schema", "table_name"), "table_schema")
    return rows.select("source_id", F.col("table_schema").alias("schema_name"), "table_name", F.col("view_definition").alias("definition"))


def reflect_view_columns(cat: Catalog, scope: Scope = ALL) -> DataFrame:
    if isinstance(cat, PgCatalog):
        return _pg_columns(cat, scope, ("v", "m"))
    return _mysql_columns(cat, scope).join(reflect_views(cat, scope).select(*TABLE_KEY), TABLE_KEY, "left_semi")


def reflect_sequences(cat: Catalog, scope: Scope = ALL) -> DataFrame:
    """Start, step, bounds and cycle flag, with the canonical type ``t``."""
    shape = ("source_id string, schema_name string, sequence_name string, native_type string, start_value bigint, "
             "increment bigint, min_value bigint, max_value bigint, cycle boolean")
    if isinstance(cat, PgCatalog):
        if cat.sequences is None:
            frame = _empty(cat.class_, shape)
        else:
            rows = scope.of(cat.sequences, "schemaname").where(_user_schema(F.col("schemaname")))
            frame = rows.select("source_id", F.col("schemaname").alias("schema_name"), F.col("sequencename").alias("sequence_name"),
                                F.col("data_type").alias("native_type"), "start_value", F.col("increment_by").alias("increment"),
                                "min_value", "max_value", "cycle")
        return map_pg_types(frame)
    if cat.sequences is None:
        frame = _empty(cat.tables, shape)
    else:
        rows = _mysql_user(scope.of(cat.sequences, "table_schema"), "table_schema")
        frame = rows.select("source_id", F.col("table_schema").alias("schema_name"), F.col("table_name").alias("sequence_name"),
                            F.lit("bigint").alias("native_type"), "start_value", "increment", "min_value", "max_value",
                            (F.upper("cycle_option") == "YES").alias("cycle"))
    return map_mysql_types(frame)


def reflect_functions(cat: Catalog, scope: Scope = ALL) -> DataFrame:
    """Routines with a body; the argument list is one text, empty when there is none."""
    shape = ("source_id string, schema_name string, function_name string, arguments array<string>, return_type string, "
             "language string, body string")
    if isinstance(cat, PgCatalog):
        if cat.proc is None or cat.language is None:
            return _empty(cat.class_, shape)
        ns = scope.of(cat.namespace, "nspname").where(_user_schema(F.col("nspname"))).select(
            "source_id", F.col("oid").alias("pronamespace"), F.col("nspname").alias("schema_name"))
        lang = cat.language.where("lanname NOT IN ('internal', 'c')").select("source_id", F.col("oid").alias("prolang"), F.col("lanname").alias("language"))
        arguments = F.when(F.trim("args") == "", F.array().cast("array<string>")).otherwise(F.array("args"))
        return (cat.proc.where("prokind IN ('f', 'p')").join(ns, ["source_id", "pronamespace"]).join(lang, ["source_id", "prolang"])
                .select("source_id", "schema_name", F.col("proname").alias("function_name"), arguments.alias("arguments"),
                        F.col("result").alias("return_type"), "language", "body"))
    if cat.routines is None:
        return _empty(cat.tables, shape)
    rows = _mysql_user(scope.of(cat.routines, "routine_schema"), "routine_schema")
    return rows.select("source_id", F.col("routine_schema").alias("schema_name"), F.col("routine_name").alias("function_name"),
                       F.array().cast("array<string>").alias("arguments"), F.col("dtd_identifier").alias("return_type"),
                       F.lit("SQL").alias("language"), F.col("routine_definition").alias("body"))


def reflect_comments(cat: Catalog, scope: Scope = ALL) -> DataFrame:
    """Table comments; an empty one counts as none."""
    return reflect_tables(cat, scope).where(F.col("comment").isNotNull()).select(*TABLE_KEY, "comment")


def assemble_catalog(cat: Catalog, scope: Scope = ALL) -> DataFrame:
    """One row per table with everything about it nested.

    A table's parts are bounded by its engine (columns, keys, indexes); whole
    schemas are never nested into a row, they stay grouped by their name
    columns.
    """
    cat = scoped(cat, scope)
    tables = reflect_tables(cat, scope)
    if scope.table is not None and tables.isEmpty():
        raise ReflectionError(f"table {scope.schema}.{scope.table} not found")
    return _assemble_pg(cat, scope) if isinstance(cat, PgCatalog) else _assemble_mysql(cat, scope, tables)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def _gathered(groups: GroupedData, names: list[str], *others: Column) -> DataFrame:
    """Each group's values of the columns ``names`` as sorted arrays, without nulls.

    A row of a union holds a value in one of them, so a group gathers its rows in one list, not one for each column.
    """
    rows = groups.agg(*others, F.collect_list(F.struct(*names)).alias("_rows"))
    return computed(rows, **{n: F.array_sort(F.array_compact(F.col("_rows")[n])) for n in names}).drop("_rows")


MYSQL_PARTS = {
    "column": "struct<ordinal:int,column_name:string>",
    "stat": "struct<index_name:string,seq:bigint,column_name:string,non_unique:bigint,index_type:string,descending:boolean>",
    "con": "struct<constraint_name:string,constraint_type:string>",
    "usage": "struct<constraint_name:string,pos:bigint,column_name:string,referenced_schema:string,referenced_table:string,"
             "referenced_column:string>",
    "rule": "struct<constraint_name:string,on_delete:string,on_update:string>",
    "clause": "struct<constraint_name:string,expression:string>",
    "trigger": "struct<trigger_name:string,timing:string,events:array<string>,function_name:string,body:string>",
}


def _assemble_mysql(cat: MysqlCatalog, scope: Scope, tables: DataFrame) -> DataFrame:
    """The rows of all views meet once per table; keys and indexes form inside the row.

    An engine allows 64 indexes of 16 columns, so the arrays stay short.
    """
    def part(df: DataFrame, name: str, *fields: Column | str, schema: str = "schema_name") -> DataFrame:
        return df.select("source_id", F.col(schema).alias("schema_name"), "table_name", F.struct(*fields).alias(name))

    def scoped(df: DataFrame | None, schema: str = "table_schema") -> DataFrame | None:
        return None if df is None else _mysql_user(scope.of(df, schema, "table_name"), schema)

    fields = ["ordinal", "column_name", "native_type", "nullable", "default_expr", "identity", "comment", "t"]
    parts = [part(tables, "info", "partition_key", "parent_schema", "parent_table", "comment"),
             part(_mysql_columns(cat, scope), "column", *fields)]
    stats, cons, uses = scoped(cat.statistics), scoped(cat.table_constraints), scoped(cat.key_column_usage)
    rules, clauses = scoped(cat.referential_constraints, "constraint_schema"), scoped(cat.check_constraints, "constraint_schema")
    if stats is not None:
        parts.append(part(stats, "stat", "index_name", F.col("seq_in_index").alias("seq"), "column_name", "non_unique", "index_type",
                          _descending(stats).alias("descending"), schema="table_schema"))
    if cons is not None:
        parts.append(part(cons, "con", "constraint_name", "constraint_type", schema="table_schema"))
    if uses is not None:
        parts.append(part(uses, "usage", "constraint_name", F.col("ordinal_position").alias("pos"), "column_name",
                          F.col("referenced_table_schema").alias("referenced_schema"), F.col("referenced_table_name").alias("referenced_table"),
                          F.col("referenced_column_name").alias("referenced_column"), schema="table_schema"))
    if rules is not None:
        parts.append(part(rules, "rule", "constraint_name", _mysql_action("delete_rule").alias("on_delete"),
                          _mysql_action("update_rule").alias("on_update"), schema="constraint_schema"))
    if clauses is not None:
        parts.append(part(clauses, "clause", "constraint_name", F.col("check_clause").alias("expression"), schema="constraint_schema"))
    parts.append(part(reflect_triggers(cat, scope), "trigger", "trigger_name", "timing", "events", "function_name", "body"))
    union = _union(parts)
    for name, shape in MYSQL_PARTS.items():
        if name not in union.columns:
            union = union.withColumn(name, F.lit(None).cast(shape))
    grouped = _gathered(union.repartition(*TABLE_KEY).groupBy(*TABLE_KEY), [*MYSQL_PARTS], F.first("info", ignorenulls=True).alias("info"))

    def label(rows: str) -> str:
        return "index_name" if rows == "stat" else "constraint_name"

    def names_where(rows: str, test) -> Column:
        return F.array_distinct(F.transform(F.filter(rows, test), lambda x: x[label(rows)]))

    def named(rows: str, name: Column) -> Column:
        return F.filter(rows, lambda x: x[label(rows)] == name)

    # Parts of relations that are not base tables carry no info.
    staged = computed(
        grouped.where(F.col("info").isNotNull()),
        unique_names=names_where("con", lambda x: x["constraint_type"] == "UNIQUE"),
        check_names=names_where("con", lambda x: x["constraint_type"] == "CHECK"),
        fk_names=F.array_intersect(names_where("usage", lambda x: x["referenced_table"].isNotNull()), F.transform("rule", lambda x: x["constraint_name"])))
    index_names = names_where("stat", lambda x: (x["index_name"] != "PRIMARY") & ~F.array_contains("unique_names", x["index_name"]))

    def foreign(n: Column) -> Column:
        pairs = F.filter("usage", lambda x: (x["constraint_name"] == n) & x["referenced_table"].isNotNull())
        rule = named("rule", n)[0]
        return F.struct(n.alias("constraint_name"), F.transform(pairs, lambda x: x["column_name"]).alias("columns"),
                        pairs[0]["referenced_schema"].alias("referenced_schema"), pairs[0]["referenced_table"].alias("referenced_table"),
                        F.transform(pairs, lambda x: x["referenced_column"]).alias("referenced_columns"),
                        rule["on_delete"].alias("on_delete"), rule["on_update"].alias("on_update"))

    def index(n: Column) -> Column:
        rows = named("stat", n)
        cols = F.transform(rows, lambda x: F.struct(x["column_name"].alias("name"), x["descending"].alias("descending")))
        return F.struct(n.alias("index_name"), cols.alias("columns"), (rows[0]["non_unique"] == 0).alias("is_unique"),
                        rows[0]["index_type"].alias("method"))

    primary = F.transform(named("stat", F.lit("PRIMARY")), lambda x: x["column_name"])
    uniques = F.transform("unique_names", lambda n: F.struct(
        n.alias("constraint_name"), F.transform(named("usage", n), lambda x: x["column_name"]).alias("columns")))
    return staged.select(
        *TABLE_KEY, F.col("column").alias("columns"),
        F.when(F.size(primary) > 0, F.struct(F.lit("PRIMARY").alias("constraint_name"), primary.alias("columns"))).alias("primary_key"),
        F.transform("fk_names", foreign).alias("foreign_keys"),
        F.filter(uniques, lambda x: F.size(x["columns"]) > 0).alias("unique_constraints"),
        F.filter("clause", lambda x: F.array_contains("check_names", x["constraint_name"])).alias("check_constraints"),
        F.array().cast("array<struct<constraint_name:string,definition:string>>").alias("exclusion_constraints"),
        F.transform(index_names, index).alias("indexes"), F.col("trigger").alias("triggers"),
        F.col("info.partition_key").alias("partition_key"), F.col("info.parent_schema").alias("parent_schema"),
        F.col("info.parent_table").alias("parent_table"), F.col("info.comment").alias("comment"))


def _assemble_pg(cat: PgCatalog, scope: Scope) -> DataFrame:
    """The parts of each relation meet in one aggregation by its id.

    Key and index columns are then named inside the row from the relation's
    own attributes; only foreign keys look up another relation.
    """
    rel = _relations(cat, scope, ("r", "p")).withColumnRenamed("oid", "relid")
    key = ["source_id", "relid"]

    def within(df: DataFrame, column: str) -> DataFrame:
        keyed = df.withColumn("relid", F.col(column))
        return keyed if scope == ALL else keyed.join(rel.select(*key), key, "left_semi")

    identity = F.when(F.col("attidentity") == "a", "always").when(F.col("attidentity") == "d", "by_default")
    attributes = (within(cat.attribute.where("attnum > 0"), "attrelid")
                  .join(rel.select(*key, "schema_name", "table_name"), key)
                  .select(*key, "schema_name", "table_name", F.col("attnum").cast("int").alias("ordinal"), F.col("attname").alias("column_name"),
                          "native_type", (~F.col("attnotnull")).alias("nullable"), "default_expr", identity.alias("identity"), "comment",
                          "attisdropped"))
    fields = ["ordinal", "column_name", "native_type", "nullable", "default_expr", "identity", "comment", "t"]
    parts = [map_pg_types(attributes, _labels_for(cat, scope, attributes)).select(*key, F.struct(*fields, "attisdropped").alias("attribute"))]
    if cat.constraint is not None:
        con = within(cat.constraint.where("contype IN ('p', 'u', 'c', 'x')"), "conrelid")
        parts.append(con.select(*key, F.struct(F.col("conname").alias("constraint_name"), "contype", "conkey", "definition", "conindid").alias("con")))
        parts.append(_fk_targets(cat, scope, within(cat.constraint.where("contype = 'f'"), "conrelid")).select(*key, F.struct(
            F.col("conname").alias("constraint_name"), "conkey", "referenced_schema", "referenced_table", "referenced_columns",
            "on_delete", "on_update").alias("fk")))
    if cat.index is not None and cat.am is not None:
        # A constraint's index belongs to its own table, so the row itself can tell.
        parts.append(_plain_indexes(cat, within(cat.index, "indrelid"), backing_too=True).select(*key, F.struct(
            "index_name", "indkey", "indoption", F.col("indisunique").alias("is_unique"), "method", "indexrelid").alias("ix")))
    if cat.trigger is not None and cat.proc is not None:
        parts.append(within(_plain_triggers(cat), "tgrelid").select(*key, F.struct(
            "trigger_name", "timing", "events", "function_name", "body").alias("trigger")))
    empty = {"con": "struct<constraint_name:string,contype:string,conkey:array<smallint>,definition:string,conindid:bigint>",
             "fk": "struct<constraint_name:string,conkey:array<smallint>,referenced_schema:string,referenced_table:string,"
                   "referenced_columns:array<string>,on_delete:string,on_update:string>",
             "ix": "struct<index_name:string,indkey:array<smallint>,indoption:array<smallint>,is_unique:boolean,method:string,indexrelid:bigint>",
             "trigger": "struct<trigger_name:string,timing:string,events:array<string>,function_name:string,body:string>"}
    union = _union(parts)
    for name, shape in empty.items():
        if name not in union.columns:
            union = union.withColumn(name, F.lit(None).cast(shape))
    grouped = _gathered(union.repartition(*key).groupBy(*key), ["attribute", *empty])
    head = _with_parents(cat, rel.select(*TABLE_KEY, F.when(F.col("relkind") == "p", F.col("partkeydef")).alias("partition_key"),
                                         F.col("relid").alias("oid"), "relispartition", F.nullif("comment", F.lit("")).alias("comment")))
    # Joining first drops parts of relations that are not tables.
    joined = head.withColumnRenamed("oid", "relid").join(grouped, key, "left")
    entries = F.transform("attribute", lambda x: F.struct(x["ordinal"], x["column_name"]))
    named = computed(joined, names=F.map_from_entries(entries))
    names = F.col("names")

    def known(numbers: Column) -> Column:
        return F.array_compact(_named(names, numbers))

    def of_kind(kind: str, shape) -> Column:
        return F.transform(F.filter("con", lambda x: x["contype"] == kind), shape)

    def keyed(x: Column) -> Column:
        return F.struct(x["constraint_name"], known(x["conkey"]).alias("columns"))

    def foreign(x: Column) -> Column:
        return F.struct(x["constraint_name"], _resolved(names, x["conkey"], x["constraint_name"]).alias("columns"),
                        *[x[n] for n in ("referenced_schema", "referenced_table", "referenced_columns", "on_delete", "on_update")])

    live = F.transform(F.filter("attribute", lambda x: ~x["attisdropped"]), lambda x: F.struct(*[x[n] for n in fields]))
    nested = {
        "columns": live,
        "foreign_keys": F.transform("fk", foreign),
        "unique_constraints": of_kind("u", keyed),
        "check_constraints": of_kind("c", lambda x: F.struct(x["constraint_name"], bare_check(x["definition"]).alias("expression"))),
        "exclusion_constraints": of_kind("x", lambda x: F.struct(x["constraint_name"], x["definition"])),
        "indexes": F.transform(F.filter("ix", lambda x: ~F.exists("con", lambda y: y["conindid"].eqNullSafe(x["indexrelid"]))), lambda x: F.struct(
            x["index_name"], _index_columns(names, x["indkey"], x["indoption"]).alias("columns"), x["is_unique"], x["method"])),
        "triggers": F.col("trigger"),
    }
    filled = {n: F.coalesce(c, F.array()).alias(n) for n, c in nested.items()}
    columns = filled.pop("columns")
    return named.select(*TABLE_KEY, columns, F.try_element_at(of_kind("p", keyed), F.lit(1)).alias("primary_key"), *filled.values(),
                        "partition_key", "parent_schema", "parent_table", "comment")
