"""Referential actions: what a delete or key change does to the children."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from tablebridge.model import (CASCADE, NO_ACTION, REFERENTIAL_ACTIONS, RESTRICT, SET_DEFAULT, SET_NULL,
                               DdlError, ForeignKey, QueryError)
from tablebridge.operators.constraints import any_null, pk_violations
from tablebridge.session import stage
from tablebridge.sources.batches import spread_key
from tablebridge.sources.scan import col, require_columns


class ActionResult(NamedTuple):
    """Both tables after the action and the child rows that forbid it.

    When ``blocked`` holds rows the statement as a whole is refused, and
    parent and child are the inputs.
    """

    parent: DataFrame
    child: DataFrame
    blocked: DataFrame


def _pairs(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [col(a) == F.col(b) for a, b in zip(left, right)])


def _keys(frame: DataFrame, columns: Sequence[str], prefix: str = "_k") -> DataFrame:
    return frame.select(*[col(c).alias(f"{prefix}{i}") for i, c in enumerate(columns)])


def _names(columns: Sequence[str], prefix: str = "_k") -> list[str]:
    return [f"{prefix}{i}" for i in range(len(columns))]


def _defaults(child: DataFrame, columns: Sequence[str], defaults: Mapping[str, str] | None) -> dict[str, Column]:
    given = defaults or {}
    return {c: F.expr(given[c]).cast(child.schema[c].dataType) if c in given
            else F.lit(None).cast(child.schema[c].dataType) for c in columns}


def _replace(child: DataFrame, columns: Sequence[str], hit: Column, values: Mapping[str, Column]) -> DataFrame:
    return child.select(*[F.when(hit, values[c]).otherwise(col(c)).alias(c) if c in values else col(c)
                          for c in child.columns if c != "_hit"])


def _spread(df: DataFrame, columns: Sequence[str], keys: DataFrame, how: str) -> DataFrame:
    """Join on nullable ``columns`` with ``keys`` (columns _k0, _k1, ...), one row per key.

    Rows with a NULL key match nothing, but would all hash to one task. A
    companion key takes the hash of the whole row there, and the hash of the
    key everywhere else, on both sides.
    """
    names = _names(columns)
    # A key the column's type cannot hold matches no row; the cast makes it NULL.
    cast = {n: F.col(n).try_cast(df.schema[c].dataType) for n, c in zip(names, columns)}
    typed = keys.select(*[F.when(t == F.col(n), t).alias(n) for n, t in cast.items()],
                        *[c for c in keys.columns if c not in names])
    right = typed.withColumn("_kh", F.xxhash64(*names))
    left = df.withColumn("_h", F.when(any_null(columns), spread_key(df)).otherwise(F.xxhash64(*[col(c) for c in columns])))
    return left.join(right, _pairs(columns, names) & (F.col("_h") == F.col("_kh")), how).drop("_h", "_kh")


def apply_delete(parent: DataFrame, child: DataFrame, fk: ForeignKey, keys: DataFrame,
                 defaults: Mapping[str, str] | None = None, on_blocked: str = "error") -> ActionResult:
    """Delete the parent rows listed in ``keys`` (columns named as the referenced ones).

    NO ACTION and RESTRICT refuse while children remain: an error, or with
    ``on_blocked="report"`` the blocking rows. CASCADE drops the children,
    SET NULL and SET DEFAULT rewrite their key. After SET DEFAULT the new key
    must exist among the remaining parents, or the row is in ``blocked``.
    """
    require_columns(child, fk.columns)
    require_columns(parent, fk.referenced_columns)
    require_columns(keys, fk.referenced_columns)
    doomed = _keys(keys, fk.referenced_columns).distinct()
    survivors = _spread(parent, fk.referenced_columns, doomed, "left_anti")
    nothing = child.where(F.lit(False))
    # Only keys that were really parents touch a child.
    doomed = doomed.join(_keys(parent, fk.referenced_columns, "_p"),
                         reduce(lambda x, y: x & y, [F.col(f"_k{i}") == F.col(f"_p{i}")
                                                     for i in range(len(fk.columns))]), "left_semi")
    if fk.on_delete == CASCADE:
        return ActionResult(survivors, _spread(child, fk.columns, doomed, "left_anti"), nothing)
    if fk.on_delete in (NO_ACTION, RESTRICT):
        blocked = child.join(doomed, _pairs(fk.columns, doomed.columns), "left_semi")
        return _checked(parent, child, survivors, child, blocked, fk, on_blocked)
    marked = _spread(child, fk.columns, doomed.withColumn("_hit", F.lit(True)), "left").drop(*doomed.columns)
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    if fk.on_delete == SET_NULL:
        nulls = {c: F.lit(None).cast(child.schema[c].dataType) for c in fk.columns}
        return ActionResult(survivors, _replace(marked, fk.columns, hit, nulls), nothing)
    values = _defaults(child, fk.columns, defaults)
    changed = marked.where(hit)
    moved = _replace(changed, fk.columns, F.lit(True), values)
    blocked = (moved.where(~any_null(fk.columns))
               .join(_keys(survivors, fk.referenced_columns), _pairs(fk.columns, _names(fk.columns)), "left_anti"))
    return _checked(parent, child, survivors, _replace(marked, fk.columns, hit, values), blocked, fk, on_blocked)


def _checked(parent: DataFrame, child: DataFrame, new_parent: DataFrame, new_child: DataFrame,
             blocked: DataFrame, fk: ForeignKey, on_blocked: str) -> ActionResult:
    if blocked.isEmpty():
        return ActionResult(new_parent, new_child, blocked)
    if on_blocked == "error":
        raise DdlError(f"foreign key {fk.name}: child rows still refer to the changed keys")
    return ActionResult(parent, child, blocked)


def apply_key_update(parent: DataFrame, child: DataFrame, fk: ForeignKey, mapping: DataFrame,
                     defaults: Mapping[str, str] | None = None, on_blocked: str = "error") -> ActionResult:
    """Change parent keys by ``mapping`` (``old_<column>`` to ``new_<column>``) with the same five actions."""
    olds = [f"old_{c}" for c in fk.referenced_columns]
    news = [f"new_{c}" for c in fk.referenced_columns]
    require_columns(mapping, [*olds, *news])
    if not pk_violations(mapping, olds).isEmpty():
        raise QueryError("each old key may be mapped once and must not be NULL")
    pairs = _keys(mapping, olds).columns
    m = mapping.select(*[col(o).alias(p) for o, p in zip(olds, pairs)],
                       *[col(n).alias(f"_n{i}") for i, n in enumerate(news)], F.lit(True).alias("_hit"))
    # Keys mapped to themselves change nothing, and only existing keys can change.
    m = m.where(~reduce(lambda x, y: x & y, [F.col(f"_k{i}").eqNullSafe(F.col(f"_n{i}")) for i in range(len(pairs))]))
    m = m.join(_keys(parent, fk.referenced_columns, "_p"),
               reduce(lambda x, y: x & y, [F.col(f"_k{i}") == F.col(f"_p{i}") for i in range(len(pairs))]), "left_semi")

    def rewritten(df: DataFrame, columns: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
        joined = _spread(df, columns, m, "left")
        hit = F.coalesce(F.col("_hit"), F.lit(False))
        return joined.select(*[F.when(hit, values[c]).otherwise(col(c)).alias(c) if c in values else col(c)
                               for c in df.columns])

    new_keys = {c: F.col(f"_n{i}").cast(parent.schema[c].dataType) for i, c in enumerate(fk.referenced_columns)}
    new_parent = rewritten(parent, fk.referenced_columns, new_keys)
    touched = child.join(m, _pairs(fk.columns, pairs), "left_semi")
    if fk.on_update in (NO_ACTION, RESTRICT):
        return _checked(parent, child, new_parent, child, touched, fk, on_blocked)
    if fk.on_update == CASCADE:
        moved = {c: F.col(f"_n{i}").cast(child.schema[c].dataType) for i, c in enumerate(fk.columns)}
    elif fk.on_update == SET_NULL:
        moved = {c: F.lit(None).cast(child.schema[c].dataType) for c in fk.columns}
    else:
        moved = _defaults(child, fk.columns, defaults)
    new_child = rewritten(child, fk.columns, moved)
    if fk.on_update != SET_DEFAULT:
        return ActionResult(new_parent, new_child, child.where(F.lit(False)))
    landed = touched.select(*[moved[c].alias(c) if c in moved else col(c) for c in child.columns])
    blocked = (landed.where(~any_null(fk.columns))
               .join(_keys(new_parent, fk.referenced_columns), _pairs(fk.columns, _names(fk.columns)), "left_anti"))
    return _checked(parent, child, new_parent, new_child, blocked, fk, on_blocked)


@dataclass(frozen=True)
class Link:
    """A foreign key between two named tables of a cascade."""

    child: str
    columns: Sequence[str]
    parent: str
    referenced_columns: Sequence[str]


def cascade_closure(tables: Mapping[str, DataFrame], links: Sequence[Link], root: str, doomed: DataFrame,
                    keys: Mapping[str, Sequence[str]]) -> dict[str, DataFrame]:
    """Rows of every table that a cascading delete from ``root`` removes.

    ``doomed`` are the root rows to delete; ``keys`` names each table's
    primary key. Tables outside cycles are settled in one pass along the
    links. On a cycle the newly reached rows are staged per round and only
    they go on, so the loop ends when a round reaches nothing new.
    """
    unknown = [n for n in ({root} | {l.child for l in links} | {l.parent for l in links}) if n not in tables]
    if unknown:
        raise QueryError(f"unknown tables {unknown}")
    order = _topological(root, links)
    if order is not None:
        gone = {root: tables[root].join(_keys(doomed, keys[root]).distinct(),
                                        _pairs(keys[root], _names(keys[root])), "left_semi")}
        for name in order[1:]:
            hits = [_reached(tables[name], gone[l.parent], l) for l in links if l.child == name and l.parent in gone]
            gone[name] = hits[0] if len(hits) == 1 else _union_distinct(hits, keys[name])
        return gone
    return _cyclic_closure(tables, links, root, doomed, keys)


def _reached(child: DataFrame, gone_parent: DataFrame, link: Link) -> DataFrame:
    k = _keys(gone_parent, link.referenced_columns)
    return child.join(k, _pairs(link.columns, k.columns), "left_semi")


def _union_distinct(frames: Sequence[DataFrame], key: Sequence[str]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames).dropDuplicates(list(key))


def _topological(root: str, links: Sequence[Link]) -> list[str] | None:
    """Tables reachable from ``root``, parents first; None when they form a cycle."""
    order: list[str] = []
    state: dict[str, int] = {}

    def visit(name: str) -> bool:
        if state.get(name) == 1:
            return False
        if state.get(name) == 2:
            return True
        state[name] = 1
        for link in links:
            if link.parent == name and not visit(link.child):
                return False
        state[name] = 2
        order.append(name)
        return True

    return order[::-1] if visit(root) else None


def _cyclic_closure(tables, links, root, doomed, keys) -> dict[str, DataFrame]:
    first = tables[root].join(_keys(doomed, keys[root]).distinct(), _pairs(keys[root], _names(keys[root])), "left_semi")
    fresh = {root: stage(first, "cascade")}
    gone = dict(fresh)
    while True:
        reached: dict[str, list[DataFrame]] = {}
        for link in links:
            if link.parent in fresh:
                reached.setdefault(link.child, []).append(_reached(tables[link.child], fresh[link.parent], link))
        fresh = {}
        for name, hits in reached.items():
            new = _union_distinct(hits, keys[name])
            if name in gone:
                k = _keys(gone[name], keys[name])
                new = new.join(k, _pairs(keys[name], k.columns), "left_anti")
            new = stage(new, "cascade")
            if not new.isEmpty():
                fresh[name] = new
        if not fresh:
            return gone
        for name, new in fresh.items():
            gone[name] = gone[name].unionByName(new) if name in gone else new


class CascadeResult(NamedTuple):
    """All tables after a delete, what it removed and rewrote, and the rows that forbid it by constraint.

    When ``blocked`` holds rows the statement as a whole is refused, and ``tables`` are the inputs.
    ``changed`` has the rewritten rows with their new values.
    """

    tables: dict[str, DataFrame]
    deleted: dict[str, DataFrame]
    changed: dict[str, DataFrame]
    blocked: dict[str, DataFrame]


def cascade_delete(tables: Mapping[str, DataFrame], foreign_keys: Mapping[str, Sequence[ForeignKey]], root: str,
                   doomed: DataFrame, keys: Mapping[str, Sequence[str]],
                   defaults: Mapping[str, Mapping[str, str]] | None = None, on_blocked: str = "error") -> CascadeResult:
    """A delete from ``root`` through a graph of tables in which each foreign key has its own action.

    ``foreign_keys`` lists the keys of each child table, ``keys`` the primary key of each table,
    ``defaults`` the default expressions of a key's columns by its name. CASCADE carries the
    deletion on, cycles included. SET NULL and SET DEFAULT stop it: the rows that are left get a
    new key, where several keys write one column the first listed wins. RESTRICT refuses while
    any row refers to a deleted one, NO ACTION while such a row is left at the end; a default
    must exist among the parents that are left. A rewritten column that is itself referred to
    would start a key update, which this does not do: an error.

    Every table is read once for its new state and staged; what goes round a cycle are the rows
    newly reached. NULL keys are spread by a hash of their row.
    """
    every = [(child, fk) for child, fks in foreign_keys.items() for fk in fks]
    unknown = {n for child, fk in every for n in (child, fk.referenced_table)} | {root}
    if unknown - set(tables):
        raise QueryError(f"unknown tables {sorted(unknown - set(tables))}")
    for child, fk in every:
        require_columns(tables[child], fk.columns)
        require_columns(tables[fk.referenced_table], fk.referenced_columns)
        referred = {c for _, other in every if other.referenced_table == child for c in other.referenced_columns}
        if fk.on_delete in (SET_NULL, SET_DEFAULT) and referred & set(fk.columns):
            raise QueryError(f"foreign key {fk.name} would rewrite columns that other keys refer to")
    links = [Link(child, fk.columns, fk.referenced_table, fk.referenced_columns) for child, fk in every if fk.on_delete == CASCADE]
    gone = {n: stage(f, "deleted") for n, f in cascade_closure(tables, links, root, doomed, keys).items()}
    active = [(child, fk) for child, fk in every if fk.referenced_table in gone]
    after, changed, blocked = dict(tables), {}, {}
    for name in {*gone, *(child for child, fk in active if fk.on_delete in (SET_NULL, SET_DEFAULT))}:
        rewriting = [fk for child, fk in active if child == name and fk.on_delete in (SET_NULL, SET_DEFAULT)]
        left = _spread(tables[name], keys[name], _keys(gone[name], keys[name]).distinct(), "left_anti") if name in gone else tables[name]
        state = stage(_rewritten(left, rewriting, gone, defaults or {}), "cascade")
        after[name] = state.drop("_changed")
        if rewriting:
            changed[name] = state.where("size(_changed) > 0").drop("_changed")
        for fk in rewriting:
            if fk.on_delete == SET_DEFAULT:
                blocked[fk.name] = state.where(F.array_contains("_changed", fk.name) & ~any_null(fk.columns)).drop("_changed")
    for child, fk in active:
        dead = _keys(gone[fk.referenced_table], fk.referenced_columns)
        if fk.on_delete in (RESTRICT, NO_ACTION):
            looked = tables[child] if fk.on_delete == RESTRICT else after[child]
            blocked[fk.name] = looked.join(dead, _pairs(fk.columns, dead.columns), "left_semi")
        elif fk.on_delete == SET_DEFAULT:
            there = _keys(after[fk.referenced_table], fk.referenced_columns)
            blocked[fk.name] = blocked[fk.name].join(there, _pairs(fk.columns, there.columns), "left_anti")
    blocked = {name: rows for name, rows in blocked.items() if not rows.isEmpty()}
    if blocked and on_blocked == "error":
        raise DdlError(f"foreign keys {sorted(blocked)}: child rows still refer to the deleted keys")
    return CascadeResult(dict(tables) if blocked else after, gone, changed, blocked)


def _rewritten(left: DataFrame, rewriting: Sequence[ForeignKey], gone: Mapping[str, DataFrame],
               defaults: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """``left`` with the keys of deleted parents replaced, and in ``_changed`` the names of those foreign keys."""
    marked = left
    for i, fk in enumerate(rewriting):
        dead = _keys(gone[fk.referenced_table], fk.referenced_columns).distinct()
        marked = _spread(marked, fk.columns, dead.withColumn(f"_hit{i}", F.lit(True)), "left").drop(*dead.columns)
    values: dict[str, Column] = {c: col(c) for c in left.columns}
    for i, fk in reversed(list(enumerate(rewriting))):
        new = _defaults(left, fk.columns, defaults.get(fk.name) if fk.on_delete == SET_DEFAULT else None)
        values.update({c: F.when(F.col(f"_hit{i}"), new[c]).otherwise(values[c]) for c in fk.columns})
    names = F.array(*[F.when(F.col(f"_hit{i}"), F.lit(fk.name)) for i, fk in enumerate(rewriting)]).cast("array<string>")
    return marked.select(*[v.alias(c) for c, v in values.items()], F.array_compact(names).alias("_changed"))
