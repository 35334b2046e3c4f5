"""Merkle manifest of a dataset: a digest for each row, a tree for each group, one root for all.

A row's leaf is the SHA-256 of its columns, each written as ``-`` if null, else as its UTF-8
byte count, ``:`` and its value. In each group the leaves stand in ascending order; while
there are several nodes, every FANOUT consecutive ones become the hash of their hex digests
(a last run may be shorter, even a single node). What remains is the group's subroot; the
subroots, ordered by group, make one more tree, whose top is the root.

The trees grow by a slot pivot: conditional aggregates spread the children of each parent
into FANOUT columns of one row. Those columns joined are what the parent hashes, and with a
node's own column left out they are its siblings. On the way down each parent row gets the
siblings of all levels above it, so that the leaves' proofs come from the rows of their
parents, a sixteenth of the leaves. All of it is DataFrame expressions.

Places in a group come from one range shuffle of the digests: rows are numbered within their
range, and each range of a group gets the number of the group's rows before it. So a group
that holds a third of all rows is dealt over as many tasks as it has ranges.

Order and ties: a null group or null id comes first, equal ids stand in the order of their
leaves; equal rows have equal leaves, so their order does not show. A row that is alone in
its group is the subroot, a lone group's subroot is the root. An empty table has no rows and
so no root. Other columns than the named ones play no part, whatever their names are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablebridge.session import stage

FANOUT = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_PART = 33  # bits below the partition in monotonically_increasing_id
_PATH = "array<struct<left: string, right: string>>"


def written(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(values: Sequence[Column]) -> Column:
    """The digest of one row."""
    return F.sha2(F.concat(*map(written, values)), 256)


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings of a path, level by level and left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x.left, x.right)), ""), 256)


def fold(own: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path lead to."""
    return F.aggregate(path, own, lambda below, x: F.sha2(F.concat(x.left, below, x.right), 256))


def placed(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Written nodes with ``at``, their place in their tree from 0, and ``size``, the tree's nodes.

    ``tie`` tells equal nodes apart, so that the copies of one node need not share a range.
    """
    keys = ["tree", *order, "digest", "tie"]
    ranged = stage(nodes.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie").withColumn("row", F.monotonically_increasing_id()), "places")
    part = F.shiftright("row", _PART).alias("part")
    held = ranged.groupBy("tree", part).agg(F.min("row").alias("first"), F.count("*").alias("n"))
    # One row for each range that a tree stands in.
    whole = Window.partitionBy("tree")
    before = F.coalesce(F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = stage(held.select("tree", "part", (before - F.col("first")).alias("shift"), F.sum("n").over(whole).alias("size")), "starts")
    return ranged.withColumn("part", part).join(starts, ["tree", "part"]).withColumn("at", F.col("row") + F.col("shift")).drop("part", "row", "shift")


def grown(nodes: DataFrame, kept: Sequence[str]) -> tuple[list[DataFrame], DataFrame]:
    """The levels of the trees, lowest first, and (tree, label, digest) of their tops.

    A level has a row for each parent: tree, label, size (nodes of the tree on this level), at
    and the columns c0 to c15 of its children; on the lowest level these hold ``kept`` too.
    """
    nodes = nodes.select("tree", "label", "size", "at", F.struct("digest", *kept).alias("node"))
    levels, tops = [], [nodes.filter("size = 1").select("tree", "label", "node.digest")]
    biggest = nodes.agg(F.max("size")).first()[0] or 0
    while biggest > 1:
        slot = F.col("at") % FANOUT
        parent = F.floor(F.col("at") / FANOUT).cast("long").alias("at")
        level = stage(nodes.filter("size > 1").groupBy("tree", "label", "size", parent).agg(
            *[F.max(F.when(slot == k, F.col("node"))).alias(f"c{k}") for k in range(FANOUT)]), "level")
        levels.append(level)
        nodes = level.select("tree", "label", F.ceil(F.col("size") / FANOUT).cast("long").alias("size"), "at", F.struct(
            F.sha2(F.concat_ws("", *[F.col(f"c{k}.digest") for k in range(FANOUT)]), 256).alias("digest")).alias("node"))
        tops.append(nodes.filter("size = 1").select("tree", "label", "node.digest"))
        biggest = -(-biggest // FANOUT)
    out = tops[0]
    for top in tops[1:]:
        out = out.union(top)
    return levels, out


def _children(level: DataFrame) -> DataFrame:
    """The children of rows that have a path, each with its own siblings before that path."""
    slots = [F.struct(
        F.lit(k).alias("slot"), F.col(f"c{k}").alias("node"), F.concat(F.array(F.struct(
            F.concat_ws("", *[F.col(f"c{j}.digest") for j in range(k)]).alias("left"),
            F.concat_ws("", *[F.col(f"c{j}.digest") for j in range(k + 1, FANOUT)]).alias("right"))), "path").alias("path"))
        for k in range(FANOUT)]
    each = level.select("tree", "subroot", "root", "at", F.explode(F.filter(F.array(*slots), lambda s: s.node.isNotNull())).alias("child"))
    return each.select("tree", "subroot", "root", (F.col("at") * FANOUT + F.col("child.slot")).alias("at"), "child.node", "child.path")


def with_paths(nodes: DataFrame, levels: Sequence[DataFrame], tops: DataFrame, kept: Sequence[str]) -> DataFrame:
    """The nodes with their path upward; ``tops`` has tree, subroot, root and the path above each tree."""
    alone = nodes.filter("size = 1").select("tree", F.struct("digest", *kept).alias("node")).join(tops, "tree").select(
        "subroot", "root", "node", "path")
    above = None
    for level in reversed(levels):
        last = level.filter(F.col("size") <= FANOUT).join(tops, "tree")  # the one row of a tree's highest level
        if above is not None:
            last = last.unionByName(level.join(above.drop("node"), ["tree", "at"]))
        above = _children(last)
    below = alone if above is None else above.select("subroot", "root", "node", "path").union(alone)
    return below.select("node.*", "subroot", "root", "path")


def manifest(docs: DataFrame, columns: Sequence[str] = COLUMNS, group: str = "source", order: str = "doc_id",
             extra: dict[str, Column] | None = None) -> DataFrame:
    """Per row: the order column, leaf, subroot, root and path, its siblings from leaf to root.

    ``extra`` names further columns that are worked out with the leaf and pass along.
    """
    extra = extra or {}
    own = F.struct(F.col(order).alias("id"), *[value.alias(name) for name, value in extra.items()])
    nodes = stage(docs.select(
        written(F.col(group)).alias("tree"), F.col(group).alias("label"), own.alias("own"),
        leaf([F.col(c) for c in columns]).alias("digest"), F.monotonically_increasing_id().alias("tie")), "leaves")
    nodes = placed(nodes, ["own.id"])
    levels, tops = grown(nodes, ["own"])
    tops = stage(tops.select(
        F.lit("").alias("tree"), F.lit("").alias("label"), F.col("tree").alias("of"), F.col("label").alias("group"), "digest", F.lit(0).alias("tie")), "subroots")
    groups = placed(tops, ["group"])
    over, root = grown(groups, ["of"])
    end = root.select("tree", F.col("digest").alias("root"), F.lit(None).cast("string").alias("subroot"), F.array().cast(_PATH).alias("path"))
    found = stage(with_paths(groups, over, end, ["of"]).select(
        F.col("of").alias("tree"), F.col("digest").alias("subroot"), "root", "path"), "roots")
    return with_paths(nodes, levels, found, ["own"]).select(
        F.col("own.id").alias(order), *[F.col(f"own.{name}").alias(name) for name in extra], F.col("digest").alias("leaf"), "subroot", "root", "path")
