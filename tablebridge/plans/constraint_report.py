"""Every declared constraint of many tables in one report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tablebridge.model import CheckRule, Constraint, EnumDomain, Exclusion, ForeignKey, NotNull, PrimaryKey, UniqueKey
from tablebridge.operators import constraints as c
from tablebridge.sources.scan import col


def violations(df: DataFrame, rule: Constraint, tables: Mapping[str, DataFrame]) -> DataFrame:
    """What breaks one constraint: rows, or keys with their row counts."""
    if isinstance(rule, PrimaryKey):
        return c.pk_violations(df, rule.columns)
    if isinstance(rule, UniqueKey):
        return c.unique_violations(df, rule.columns)
    if isinstance(rule, ForeignKey):
        return c.orphan_keys(df, tables[rule.referenced_table], rule.columns, rule.referenced_columns)
    if isinstance(rule, CheckRule):
        return c.check_violations(df, {rule.name: rule.expression})
    if isinstance(rule, EnumDomain):
        return c.enum_violations(df, rule.column, rule.labels)
    if isinstance(rule, Exclusion):
        return c.exclusion_violations(df, rule.eq_columns, rule.lower, rule.upper)
    return df.where(c.any_null(rule.columns))


_KINDS = {PrimaryKey: "primary key", UniqueKey: "unique", ForeignKey: "foreign key", CheckRule: "check",
          EnumDomain: "enum", Exclusion: "exclusion", NotNull: "not null"}
_KEYED = (PrimaryKey, UniqueKey, ForeignKey)


def constraint_report(tables: Mapping[str, DataFrame], declared: Mapping[str, Sequence[Constraint]]) -> DataFrame:
    """One row per constraint: table, name, kind, rows checked and offending rows.

    Row-wise rules (check, enum, NOT NULL) of a table share one scan; keys,
    references and exclusions need an aggregation each.
    """
    parts = []
    for table, rules in declared.items():
        df = tables[table]
        simple = [r for r in rules if isinstance(r, (CheckRule, EnumDomain, NotNull))]
        shared = [F.count(F.lit(1)).alias("checked")]
        items = []
        for i, rule in enumerate(simple):
            if isinstance(rule, CheckRule):
                bad = ~F.expr(f"({rule.expression})")
            elif isinstance(rule, EnumDomain):
                known = [v for v in rule.labels if v is not None]  # a NULL label allows nothing more
                bad = ~col(rule.column).isin(*known) if known else col(rule.column).isNotNull()
            else:
                bad = c.any_null(rule.columns)
            shared.append(F.count_if(bad).alias(f"v{i}"))
            items.append(_line(table, rule, F.col("checked"), F.col(f"v{i}")))
        if items:
            parts.append(df.agg(*shared).select(F.inline(F.array(*items))))
        for rule in rules:
            if rule in simple:
                continue
            broken = violations(df, rule, tables)
            amount = F.sum("rows") if isinstance(rule, _KEYED) else F.count(F.lit(1))
            found = broken.agg(F.coalesce(amount, F.lit(0)).alias("n"), F.lit(1).alias("_one"))
            size = df.agg(F.count(F.lit(1)).alias("checked"), F.lit(1).alias("_one"))
            parts.append(size.join(found, "_one").select(
                F.inline(F.array(_line(table, rule, F.col("checked"), F.col("n"))))))
    return reduce(DataFrame.unionAll, parts)


def _line(table: str, rule: Constraint, checked, bad):
    return F.struct(F.lit(table).alias("table_name"), F.lit(rule.name).alias("constraint_name"),
                    F.lit(_KINDS[type(rule)]).alias("kind"), checked.cast("bigint").alias("checked"),
                    bad.cast("bigint").alias("violations"))
