"""DDL statements for whole catalogues, one row per statement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablebridge.model import UnsupportedError
from tablebridge.operators.typemap import target_type

# Identifier quotes of each engine (fixed values).
QUOTES = {"postgres": '"', "mysql": "`", "spark": "`"}

# All statements of a phase may run before the next phase starts (fixed values).
CREATE, UNIQUE, CHECK, EXCLUSION, FOREIGN_KEY, INDEX = 1, 2, 3, 4, 5, 6


def quote_ident(name: Column, engine: str) -> Column:
    q = QUOTES[engine]
    return F.concat(F.lit(q), F.replace(name, F.lit(q), F.lit(q * 2)), F.lit(q))


def _list(names: Column, engine: str) -> Column:
    return F.array_join(F.transform(names, lambda n: quote_ident(n, engine)), ", ")


def _column_line(c: Column, engine: str) -> Column:
    null = F.when(c["nullable"], "").otherwise(" NOT NULL")
    default = F.coalesce(F.concat(F.lit(" DEFAULT "), c["default_expr"]), F.lit(""))
    if engine == "postgres":
        extra = (F.when(c["identity"] == "always", " GENERATED ALWAYS AS IDENTITY")
                 .when(c["identity"] == "by_default", " GENERATED BY DEFAULT AS IDENTITY").otherwise(default))
    elif engine == "mysql":
        extra = F.when(c["identity"].isNotNull(), " AUTO_INCREMENT").otherwise(default)
    else:  # Parquet tables generate no numbers; assign_identity does
        extra = F.when(c["identity"].isNotNull(), "").otherwise(default)
    return F.concat(quote_ident(c["column_name"], engine), F.lit(" "), target_type(c["t"], engine), null, extra)


def render_ddl(catalog: DataFrame, engine: str) -> DataFrame:
    """Statements that recreate the tables: (key, phase, position, statement).

    ``catalog`` comes from ``assemble_catalog``. No statement ends in a
    semicolon. Phases order the whole catalogue: every foreign key comes after
    every table. What the target cannot declare is left out: MySQL has no
    exclusion constraints and no such partition clause, Spark's tables
    enforce no constraint.
    """
    if engine not in QUOTES:
        raise UnsupportedError(f"unknown engine {engine!r}")
    qualified = F.concat(quote_ident(F.col("schema_name"), engine), F.lit("."), quote_ident(F.col("table_name"), engine))
    lines = F.transform("columns", lambda c: _column_line(c, engine))
    if engine != "spark":
        key = F.concat(F.lit("PRIMARY KEY ("), _list(F.col("primary_key.columns"), engine), F.lit(")"))
        lines = F.when(F.col("primary_key").isNotNull(), F.concat(lines, F.array(key))).otherwise(lines)
    tail = F.lit(" USING parquet") if engine == "spark" else (
        F.coalesce(F.concat(F.lit(" PARTITION BY "), F.col("partition_key")), F.lit("")) if engine == "postgres" else F.lit(""))
    create = F.concat(F.lit("CREATE TABLE "), qualified, F.lit(" (\n  "), F.array_join(lines, ",\n  "), F.lit("\n)"), tail)

    def alter(name: Column, body: Column) -> Column:
        return F.concat(F.lit("ALTER TABLE "), qualified, F.lit(" ADD CONSTRAINT "), quote_ident(name, engine), F.lit(" "), body)

    def foreign_key(x: Column) -> Column:
        target = F.concat(quote_ident(x["referenced_schema"], engine), F.lit("."), quote_ident(x["referenced_table"], engine))
        return alter(x["constraint_name"], F.concat(
            F.lit("FOREIGN KEY ("), _list(x["columns"], engine), F.lit(") REFERENCES "), target, F.lit(" ("),
            _list(x["referenced_columns"], engine), F.lit(") ON UPDATE "), x["on_update"], F.lit(" ON DELETE "), x["on_delete"]))

    def index(x: Column) -> Column:
        cols = F.array_join(F.transform(x["columns"], lambda c: F.concat(
            quote_ident(c["name"], engine), F.when(c["descending"], " DESC").otherwise(""))), ", ")
        method = F.coalesce(F.concat(F.lit(" USING "), x["method"]), F.lit(""))
        if engine == "mysql":
            method = F.when(F.upper(x["method"]).isin("BTREE", "HASH"), method).otherwise("")
        return F.concat(F.lit("CREATE "), F.when(x["is_unique"], "UNIQUE ").otherwise(""), F.lit("INDEX "),
                        quote_ident(x["index_name"], engine), method, F.lit(" ON "), qualified, F.lit(" ("), cols, F.lit(")"))

    def statements(phase: int, texts: Column) -> Column:
        return F.transform(texts, lambda s, i: F.struct(F.lit(phase).alias("phase"), i.alias("position"), s.alias("statement")))

    groups = [statements(CREATE, F.array(create))]
    if engine != "spark":
        groups += [
            statements(UNIQUE, F.transform("unique_constraints", lambda x: alter(
                x["constraint_name"], F.concat(F.lit("UNIQUE ("), _list(x["columns"], engine), F.lit(")"))))),
            statements(CHECK, F.transform("check_constraints", lambda x: alter(
                x["constraint_name"], F.concat(F.lit("CHECK ("), x["expression"], F.lit(")")))))]
        if engine == "postgres":
            groups.append(statements(EXCLUSION, F.transform("exclusion_constraints", lambda x: alter(x["constraint_name"], x["definition"]))))
        groups += [statements(FOREIGN_KEY, F.transform("foreign_keys", foreign_key)),
                   statements(INDEX, F.transform("indexes", index))]
    return catalog.select("source_id", "schema_name", "table_name", F.inline(F.concat(*groups)))
