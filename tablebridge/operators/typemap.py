"""Native column types to canonical types and on to a target's types.

All functions work on column inventories: one row per column of any number of
databases. The canonical type is one struct column ``t``:

    category, length, precision, scale, tz, binary, dims, labels, subtype, native

``dims`` counts array levels around the base category.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablebridge.model import UnsupportedError

# Base names of each engine and their canonical categories (fixed values).
PG_NAMES = {
    "boolean": "boolean", "bool": "boolean",
    "smallint": "smallint", "int2": "smallint",
    "integer": "integer", "int": "integer", "int4": "integer",
    "bigint": "bigint", "int8": "bigint",
    "numeric": "decimal", "decimal": "decimal",
    "real": "real", "float4": "real",
    "double precision": "double", "float8": "double",
    "character": "char", "char": "char", "bpchar": "char",
    "character varying": "varchar", "varchar": "varchar",
    "text": "text", "bytea": "blob", "date": "date",
    "interval": "interval", "uuid": "uuid",
    "json": "json", "jsonb": "json", "xml": "xml",
}
PG_TIMED_OR_BIT = "^(bit|bit varying|(time|timestamp)( with(out)? time zone)?)$"
MYSQL_NAMES = {
    "tinyint": "smallint", "smallint": "smallint",
    "mediumint": "integer", "int": "integer", "integer": "integer",
    "bigint": "bigint",
    "decimal": "decimal", "numeric": "decimal",
    "float": "real", "double": "double", "double precision": "double",
    "char": "char", "varchar": "varchar",
    "text": "text", "tinytext": "text", "mediumtext": "text", "longtext": "text",
    "binary": "binary", "varbinary": "varbinary",
    "blob": "blob", "tinyblob": "blob", "mediumblob": "blob", "longblob": "blob",
    "date": "date", "time": "time", "datetime": "timestamp", "timestamp": "timestamp",
    "year": "integer", "json": "json", "bit": "bit",
    "geometry": "geometry", "point": "geometry", "linestring": "geometry", "polygon": "geometry",
    "multipoint": "geometry", "multilinestring": "geometry", "multipolygon": "geometry",
    "geometrycollection": "geometry",
}
# Unsigned integers need the next wider category (fixed values).
MYSQL_UNSIGNED = {"tinyint": "smallint", "smallint": "integer", "mediumint": "bigint", "int": "bigint",
                  "integer": "bigint", "bigint": "decimal"}

# Canonical categories in each target's words where no argument is involved (fixed values).
SPARK_TYPES = {
    "boolean": "boolean", "smallint": "smallint", "integer": "int", "bigint": "bigint",
    "real": "float", "double": "double", "text": "string", "binary": "binary", "varbinary": "binary",
    "blob": "binary", "date": "date", "time": "string", "interval": "string", "uuid": "string",
    "xml": "string", "bit": "string", "enum": "string", "geometry": "binary", "unsupported": "string",
}
PG_TYPES = {
    "boolean": "boolean", "smallint": "smallint", "integer": "integer", "bigint": "bigint",
    "real": "real", "double": "double precision", "text": "text", "binary": "bytea", "varbinary": "bytea",
    "blob": "bytea", "date": "date", "interval": "interval", "uuid": "uuid", "xml": "xml",
    "enum": "text", "geometry": "text",
}
MYSQL_TYPES = {
    "boolean": "tinyint(1)", "smallint": "smallint", "integer": "int", "bigint": "bigint",
    "real": "float", "double": "double", "text": "text", "blob": "blob", "date": "date",
    "interval": "varchar(255)", "uuid": "char(36)", "json": "json", "xml": "text", "geometry": "geometry",
}

_SIZED = ("char", "varchar", "binary", "varbinary", "bit")
_TIMED = ("time", "timestamp")


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later expressions refer to instead of copying.

    The optimizer merges stacked projections by substitution, which here
    would multiply the expressions; a one-element generator keeps each
    evaluated once.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _lookup(table: dict[str, str], name: Column) -> Column:
    """A constant map, folded once and probed per row."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), name)


def _argument(args: Column, position: int) -> Column:
    text = F.trim(F.try_element_at(F.split(args, ","), F.lit(position)))
    return F.when(F.regexp_like(text, F.lit(r"^\+?[0-9]+$")), text.try_cast("int"))


_WORK = ("_text", "_args", "_dims", "_name", "_labels", "_category", "_first", "_second")


def _canonical(df: DataFrame, name: str, *, tz: Column, binary: Column, subtype: Column, native: Column,
               first: Column | None = None, second: Column | None = None) -> DataFrame:
    """Add the struct ``name`` from the work columns and drop those."""
    category = F.col("_category")
    staged = computed(df, _first=_argument(F.col("_args"), 1) if first is None else first,
                      _second=_argument(F.col("_args"), 2) if second is None else second)
    struct = F.struct(
        category.alias("category"),
        F.when(category.isin(*_SIZED), F.col("_first")).alias("length"),
        F.when((category == "decimal") | category.isin(*_TIMED), F.col("_first")).alias("precision"),
        F.when(category == "decimal", F.col("_second")).alias("scale"),
        F.when(category.isin(*_TIMED), tz).alias("tz"),
        F.when(category == "json", binary).alias("binary"),
        F.col("_dims").cast("int").alias("dims"),
        F.when(category == "enum", F.col("_labels")).alias("labels"),
        F.when(category == "geometry", subtype).alias("subtype"),
        F.when(category == "unsupported", native).alias("native"))
    return computed(staged, **{name: struct}).drop(*_WORK)


def _pg_parts(df: DataFrame, native: str) -> DataFrame:
    """Base text, bare name, arguments and array depth of a PostgreSQL type string."""
    text = F.trim(F.col(native))
    brackets = F.regexp_extract(text, r"((?:\[\]\s*)+)$", 1)
    parts = computed(df, _text=F.trim(F.regexp_replace(text, r"(\[\]\s*)+$", "")),
                     _dims=F.length(F.regexp_replace(brackets, r"\s", "")) / 2)
    return computed(parts, _args=F.regexp_extract("_text", r"^[^(]*\(([^)]*)\)", 1),
                    _name=F.regexp_replace("_text", r"^([^(]*?)\s*\([^)]*\)(.*)$", "$1$2"))


def _pg_struct(parts: DataFrame, name: str) -> DataFrame:
    base = F.col("_name")
    category = (F.when(F.col("_labels").isNotNull(), "enum")
                .when(base.startswith("timestamp"), "timestamp").when(base.startswith("time"), "time")
                .when(base.startswith("bit"), "bit")
                .otherwise(F.coalesce(_lookup(PG_NAMES, base), F.lit("unsupported"))))
    return _canonical(computed(parts, _category=category), name, tz=F.contains(base, F.lit("with time zone")),
                      binary=base == "jsonb", subtype=F.lit(None).cast("string"), native=F.col("_text"))


def pg_type_names(columns: DataFrame, native: str = "native_type") -> DataFrame:
    """The distinct names (source_id, type_name) that types of columns end in, built-in ones included."""
    bare = F.replace(F.col("_name"), F.lit('"'), F.lit(""))
    return _pg_parts(columns, native).select("source_id", F.substring_index(bare, ".", -1).alias("type_name")).distinct()


def _type_schema(bare: Column) -> Column:
    return F.when(F.contains(bare, F.lit(".")), F.substring_index(bare, ".", 1)).otherwise(F.col("schema_name"))


def pg_type_schemas(columns: DataFrame, native: str = "native_type") -> DataFrame:
    """The distinct schemas (source_id, schema_name) in which types of columns are looked up."""
    bare = F.replace(F.col("_name"), F.lit('"'), F.lit(""))
    return _pg_parts(columns, native).select("source_id", _type_schema(bare).alias("schema_name")).distinct()


def map_pg_types(columns: DataFrame, enum_labels: DataFrame | None = None, native: str = "native_type",
                 name: str = "t") -> DataFrame:
    """Add the canonical struct of each PostgreSQL type.

    ``enum_labels`` holds (source_id, schema_name, type_name, labels). A bare
    type name means the column's own schema, ``schema.type`` the named one.
    """
    parts = _pg_parts(columns, native)
    if enum_labels is None:
        return _pg_struct(parts.withColumn("_labels", F.lit(None).cast("array<string>")), name)
    bare = F.replace(F.col("_name"), F.lit('"'), F.lit(""))
    schema = _type_schema(bare)
    builtin = F.col("_name").isin(*PG_NAMES) | F.regexp_like(F.col("_name"), F.lit(PG_TIMED_OR_BIT))
    # Built-in types match no label; the table name spreads them over the join's
    # partitions, where their few type names in a large schema would pile up.
    keyed = computed(parts, _es=F.when(builtin, F.col("table_name")).otherwise(schema),
                     _et=F.when(builtin, "").otherwise(F.substring_index(bare, ".", -1)))
    labels = enum_labels.select(F.col("source_id").alias("_e0"), F.col("schema_name").alias("_e1"),
                                F.col("type_name").alias("_e2"), F.col("labels").alias("_labels"))
    on = (F.col("source_id") == F.col("_e0")) & (F.col("_es") == F.col("_e1")) & (F.col("_et") == F.col("_e2"))
    return _pg_struct(keyed.join(labels, on, "left").drop("_es", "_et", "_e0", "_e1", "_e2"), name)


def map_mysql_types(columns: DataFrame, native: str = "native_type", name: str = "t") -> DataFrame:
    """Add the canonical struct of each MySQL or MariaDB ``COLUMN_TYPE``."""
    given = F.trim(F.col(native))
    bare = F.rtrim(F.regexp_replace(F.rtrim(F.regexp_replace(given, r"(zerofill)+$", "")), r"(unsigned)+$", ""))
    staged = computed(columns, _text=bare, _unsigned=F.regexp_like(given, F.lit(r"unsigned(\s+zerofill)?$")))
    text, base, unsigned = F.col("_text"), F.col("_name"), F.col("_unsigned")
    labels = F.transform(F.regexp_extract_all(text, F.lit("'((?:[^']|'')*)'"), 1),
                         lambda x: F.replace(x, F.lit("''"), F.lit("'")))
    is_enum = text.startswith("enum(") & text.endswith(")")
    parts = computed(staged, _args=F.regexp_extract(text, r"^[^(]*\(([^)]*)\)", 1), _dims=F.lit(0),
                     _name=F.trim(F.regexp_replace(text, r"^([^(]*)\([^)]*\).*$", "$1")),
                     _labels=F.when(is_enum, labels))
    category = (F.when(F.col("_labels").isNotNull(), "enum").when(text.startswith("set("), "unsupported")
                .when((base == "tinyint") & (F.trim("_args") == "1"), "boolean")
                .when(unsigned, F.coalesce(_lookup(MYSQL_UNSIGNED, base), _lookup(MYSQL_NAMES, base), F.lit("unsupported")))
                .otherwise(F.coalesce(_lookup(MYSQL_NAMES, base), F.lit("unsupported"))))
    widened = unsigned & (base == "bigint")
    out = _canonical(computed(parts, _category=category), name, tz=F.lit(False), binary=F.lit(True), subtype=base,
                     native=F.col(native),
                     first=F.when(widened, F.lit(20)).otherwise(_argument(F.col("_args"), 1)),
                     second=F.when(widened, F.lit(0)).otherwise(_argument(F.col("_args"), 2)))
    return out.drop("_unsigned")


def _f(t: Column, name: str) -> Column:
    return t.getField(name)


def _sized(word: str, length: Column) -> Column:
    return F.concat(F.lit(f"{word}("), length.cast("string"), F.lit(")"))


def _numeric(word: str, t: Column) -> Column:
    p, s = _f(t, "precision").cast("string"), _f(t, "scale").cast("string")
    return (F.when(p.isNull(), word).when(s.isNull(), F.concat(F.lit(f"{word}("), p, F.lit(")")))
            .otherwise(F.concat(F.lit(f"{word}("), p, F.lit(","), s, F.lit(")"))))


def to_spark_type(t: Column) -> Column:
    """Spark DDL text; a numeric wider than Spark's decimal stays text."""
    category, p, s, n = _f(t, "category"), _f(t, "precision"), F.coalesce(_f(t, "scale"), F.lit(0)), _f(t, "length")
    decimal = (F.when(p.isNull(), "decimal(38,18)").when((p > 38) | (s > p), "string")
               .otherwise(F.concat(F.lit("decimal("), p.cast("string"), F.lit(","), s.cast("string"), F.lit(")"))))
    base = (F.when(category == "decimal", decimal)
            .when(category == "char", _sized("char", F.coalesce(n, F.lit(1))))
            .when((category == "varchar") & n.isNotNull(), _sized("varchar", n))
            .when(category == "varchar", "string")
            .when((category == "timestamp") & _f(t, "tz"), "timestamp").when(category == "timestamp", "timestamp_ntz")
            .when((category == "json") & _f(t, "binary"), "variant").when(category == "json", "string")
            .otherwise(_lookup(SPARK_TYPES, category)))
    return F.concat(F.repeat(F.lit("array<"), _f(t, "dims")), base, F.repeat(F.lit(">"), _f(t, "dims")))


def to_pg_type(t: Column) -> Column:
    """PostgreSQL DDL type, from the canonical type alone."""
    category, n, p = _f(t, "category"), _f(t, "length"), _f(t, "precision").cast("string")
    zone = F.when(_f(t, "tz"), " with time zone").otherwise(" without time zone")
    timed = F.concat(category, F.coalesce(F.concat(F.lit("("), p, F.lit(")")), F.lit("")), zone)
    base = (F.when(category == "decimal", _numeric("numeric", t))
            .when(category == "char", _sized("character", F.coalesce(n, F.lit(1))))
            .when((category == "varchar") & n.isNotNull(), _sized("character varying", n))
            .when(category == "varchar", "character varying")
            .when(category.isin(*_TIMED), timed)
            .when(category == "json", F.when(_f(t, "binary"), "jsonb").otherwise("json"))
            .when(category == "bit", _sized("bit", F.coalesce(n, F.lit(1))))
            .when(category == "unsupported", _f(t, "native"))
            .otherwise(_lookup(PG_TYPES, category)))
    return F.concat(base, F.repeat(F.lit("[]"), _f(t, "dims")))


def to_mysql_type(t: Column) -> Column:
    """MySQL DDL type; zones are dropped and arrays become JSON."""
    category, n, p = _f(t, "category"), _f(t, "length"), _f(t, "precision")
    quoted = F.transform(_f(t, "labels"), lambda x: F.concat(F.lit("'"), F.replace(x, F.lit("'"), F.lit("''")), F.lit("'")))
    word = F.when(category == "timestamp", "datetime").otherwise("time")
    timed = F.concat(word, F.when(p > 0, F.concat(F.lit("("), p.cast("string"), F.lit(")"))).otherwise(""))
    return (F.when(_f(t, "dims") > 0, "json")
            .when(category == "decimal", _numeric("decimal", t))
            .when(category == "char", _sized("char", F.coalesce(n, F.lit(1))))
            .when(category == "varchar", _sized("varchar", F.coalesce(n, F.lit(255))))
            .when(category == "binary", _sized("binary", F.coalesce(n, F.lit(1))))
            .when(category == "varbinary", _sized("varbinary", F.coalesce(n, F.lit(255))))
            .when(category == "bit", _sized("bit", F.coalesce(n, F.lit(1))))
            .when(category.isin(*_TIMED), timed)
            .when(category == "enum", F.concat(F.lit("enum("), F.array_join(quoted, ", "), F.lit(")")))
            .when(category == "unsupported", _f(t, "native"))
            .otherwise(_lookup(MYSQL_TYPES, category)))


TARGETS = {"postgres": to_pg_type, "mysql": to_mysql_type, "spark": to_spark_type}


def target_type(t: Column, engine: str) -> Column:
    if engine not in TARGETS:
        raise UnsupportedError(f"unknown engine {engine!r}")
    return TARGETS[engine](t)


def lossy_columns(columns: DataFrame, engine: str) -> DataFrame:
    """Columns whose meaning changes on the target: their type there, read back, is another one.

    Adds ``target_type``, ``becomes`` and the ``losses``.
    """
    if engine not in ("postgres", "mysql"):
        raise UnsupportedError(f"no type mapping back from {engine!r}")
    staged = computed(columns, target_type=target_type(F.col("t"), engine))
    back = map_pg_types if engine == "postgres" else map_mysql_types
    both = back(staged, native="target_type", name="_b")
    a, b = F.col("t"), F.col("_b")
    checks = [
        (_f(a, "category") != _f(b, "category"), "category"),
        (_f(a, "category") == "unsupported", "passed through"),
        (_f(a, "dims") != _f(b, "dims"), "array"),
        (_f(a, "tz") & ~F.coalesce(_f(b, "tz"), F.lit(False)), "time zone"),
        ((_f(a, "category") == _f(b, "category")) & (_f(a, "binary") != _f(b, "binary")), "json form"),
        ((_f(a, "category") == _f(b, "category")) & ~_f(a, "length").eqNullSafe(_f(b, "length")), "length"),
    ]
    losses = F.array_compact(F.array(*[F.when(test, F.lit(name)) for test, name in checks]))
    return (both.withColumn("losses", losses).withColumn("becomes", F.concat(
        _f(b, "category"), F.repeat(F.lit("[]"), _f(b, "dims")))).drop("_b").where(F.size("losses") > 0))


def lossy_mapping_report(columns: DataFrame, engine: str) -> DataFrame:
    """Counts of columns per kind of loss."""
    source = F.concat(_f(F.col("t"), "category"), F.repeat(F.lit("[]"), _f(F.col("t"), "dims")))
    return (lossy_columns(columns, engine)
            .groupBy(source.alias("category"), "becomes", F.array_join("losses", ", ").alias("losses"))
            .agg(F.count(F.lit(1)).alias("columns")))


def type_inventory(columns: DataFrame) -> DataFrame:
    """Columns per category, and per native type where no category fits."""
    return columns.groupBy(F.col("t.category").alias("category"), F.col("t.dims").alias("dims"),
                           F.col("t.native").alias("unsupported_type")).agg(F.count(F.lit(1)).alias("columns"))
