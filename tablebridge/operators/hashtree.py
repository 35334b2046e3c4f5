"""Stored hash trees: two sites find what differs by exchanging hashes, then read only that.

The leaves are the tiles of a plan over the key (``tileindex.plan_tile_frame``), which both sites
share; rows whose single key is NULL are a leaf of their own. A leaf's hash covers its rows in any
order, their number and the table's schema, and a node above covers its ``FAN_OUT`` children. A
tree is a folder of ``level=N`` tables, one row for each node that has rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tablebridge.model import QueryError
from tablebridge.operators.verify import require_same_schema, table_diff, table_fingerprint
from tablebridge.session import stage
from tablebridge.sources.literals import composite_sql, incoming, literal_sql, outgoing, quoted
from tablebridge.sources.tileindex import tag_tiles

FAN_OUT = 16
RANGES = 64  # runs of differing leaves that are named in a filter; more are met by a join
NODES = "node bigint, rows bigint, hash string"


def _parent(node: str) -> Column:
    return F.expr(f"{node} DIV {FAN_OUT}")


def write_hash_tree(df: DataFrame, columns: Sequence[str], leaves: DataFrame, path: str) -> DataFrame:
    """Hash ``df`` by the plan ``leaves`` over its key ``columns`` into a new folder; returns the tree.

    One pass over the table with one record for each leaf and task; the levels above are small. An
    empty table has an empty tree. Trees of one plan have equally many levels.
    """
    shape = df.schema.simpleString()
    tagged = tag_tiles(df, columns, leaves, "_leaf")
    prints = table_fingerprint(tagged, F.col("_leaf"), "xxhash")
    level = prints.select((F.col("tile_id") + 1).cast("bigint").alias("node"), "rows",
                          F.sha2(F.concat_ws(":", F.lit(shape), F.col("rows"), "hash_a", "hash_b"), 256).alias("hash"))
    spark, widest, depth = df.sparkSession, leaves.count(), 0
    while True:
        level.write.parquet(f"{path}/level={depth}")
        if widest == 0:
            return read_hash_tree(spark, path)
        below = spark.read.schema(NODES).parquet(f"{path}/level={depth}")
        children = F.array_sort(F.collect_list(F.struct("node", "hash")))
        text = F.array_join(F.transform(children, lambda x: F.concat_ws(":", x["node"], x["hash"])), ",")
        level = (below.groupBy(_parent("node").alias("node"))
                 .agg(F.sum("rows").alias("rows"), F.sha2(text, 256).alias("hash")))
        widest, depth = widest // FAN_OUT, depth + 1


def read_hash_tree(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{NODES}, level int").parquet(path)


def differing_leaves(a: DataFrame, b: DataFrame) -> DataFrame:
    """``leaf``, ``rows_a`` and ``rows_b`` of the leaves that differ between two trees of one plan.

    The levels are compared from the top, each only below the nodes that differ above it.
    """
    tops = [t.agg(F.max("level")).first()[0] for t in (a, b)]
    known = {t for t in tops if t is not None}
    if len(known) > 1:
        raise QueryError("the trees are not of the same plan")
    suspects = None
    for depth in reversed(range(max(known, default=0) + 1)):
        sides = []
        for tree, side in ((a, "a"), (b, "b")):
            nodes = tree.where(F.col("level") == depth)
            if suspects is not None:
                nodes = nodes.withColumn("_parent", _parent("node")).join(suspects.select(F.col("node").alias("_parent")), "_parent", "left_semi")
            sides.append(nodes.select("node", F.col("rows").alias(f"rows_{side}"), F.col("hash").alias(f"_{side}")))
        unequal = sides[0].join(sides[1], "node", "full_outer").where(~F.col("_a").eqNullSafe(F.col("_b")))
        suspects = stage(unequal.select("node", *[F.coalesce(f"rows_{s}", F.lit(0)).alias(f"rows_{s}") for s in "ab"]), "suspects")
    return suspects.select((F.col("node") - 1).cast("int").alias("leaf"), "rows_a", "rows_b")


def _runs(bad: DataFrame, leaves: DataFrame) -> DataFrame:
    """Neighbouring leaves as one range each; the windows run over leaves, never over rows."""
    found = leaves.join(bad.select(F.col("leaf").alias("tile_id")), "tile_id", "left_semi")
    run = F.col("tile_id") - F.row_number().over(Window.orderBy("tile_id"))
    return (found.withColumn("_run", run).groupBy("_run")
            .agg(F.min_by("lower", "tile_id").alias("lower"), F.max_by("upper", "tile_id").alias("upper")))


def _range_sql(columns: Sequence[str], types: Sequence[T.DataType], lower: Sequence[Any] | None, upper: Sequence[Any] | None) -> str:
    """A range of keys; a composite one also bounds its first column, which a source can use."""
    first = quoted(columns[0])
    if len(columns) == 1:
        tests = [f"{first} {sign} {literal_sql(bound[0], types[0])}" for sign, bound in ((">=", lower), ("<", upper)) if bound]
        return " AND ".join(tests) or f"{first} IS NOT NULL"
    key, tests = composite_sql([quoted(c) for c in columns]), []
    for sign, bound in ((">=", lower), ("<", upper)):
        if bound:
            edge = [literal_sql(v, t) for v, t in zip(bound, types)]
            near = f"{first} >= {edge[0]}" if sign == ">=" else f"({first} <= {edge[0]} OR {first} IS NULL)"
            tests.append(f"{near} AND {key} {sign} {composite_sql(edge)}")
    return " AND ".join(tests) or "TRUE"


def rows_of_leaves(df: DataFrame, columns: Sequence[str], leaves: DataFrame, bad: DataFrame) -> DataFrame:
    """The rows in some leaves: few runs of leaves reach the source as ranges, many are met by a join."""
    types = [df.schema[c].dataType for c in columns]
    bounds = [F.when(F.col(e).isNotNull(), F.array(F.struct(*[outgoing(F.col(e)[c], t).alias(f"k{i}") for i, (c, t) in enumerate(zip(columns, types))]))).alias(e)
              for e in ("lower", "upper")]
    runs = _runs(bad, leaves).select(*bounds).limit(RANGES + 1).collect()
    if len(runs) > RANGES:
        tagged = tag_tiles(df, columns, leaves, "_leaf")
        return tagged.join(bad.select(F.col("leaf").alias("_leaf")), "_leaf", "left_semi").select(*df.columns)

    def edge(bound) -> list[Any] | None:
        return [incoming(v, t) for v, t in zip(bound[0], types)] if bound else None

    tests = [f"({_range_sql(columns, types, edge(r.lower), edge(r.upper))})" for r in runs]
    if not bad.where("leaf = -1").isEmpty():
        tests.append(f"{quoted(columns[0])} IS NULL")
    return df.where(" OR ".join(tests) or "FALSE")


def hash_tree_diff(a: DataFrame, b: DataFrame, columns: Sequence[str], leaves: DataFrame, tree_a: DataFrame, tree_b: DataFrame) -> DataFrame:
    """``table_diff`` by the key over the rows of the leaves that differ; other rows are not read.

    The trees must be of ``a`` and ``b`` as they are. NULL keys are compared as well.
    """
    require_same_schema(a, b)
    bad = stage(differing_leaves(tree_a, tree_b), "leaves")
    return table_diff(*[rows_of_leaves(df, columns, leaves, bad) for df in (a, b)], list(columns))
