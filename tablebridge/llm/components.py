"""Connected components of links, by stars that grow and shrink; all work is joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablebridge.session import stage


def _least(links: DataFrame) -> DataFrame:
    """(u, least) of every node: the least of itself and its neighbours."""
    return links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b); the component is its least node.

    Each round hangs larger neighbours, then smaller ones, on the least node in reach, until
    nothing changes. Rounds grow with the logarithm of the longest chain. Nodes without links
    are not listed; null ends, loops and repeated links change nothing.
    """
    def both(x: DataFrame) -> DataFrame:
        return x.select("u", "v").union(x.select(F.col("v").alias("u"), F.col("u").alias("v")))

    now = stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "links")
    before = _mark(now)
    while True:
        wide = both(now)
        grown = stage(
            wide.join(_least(wide), "u").filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct(), "links")
        shrunk = grown.join(_least(grown), "u")
        now = stage(
            shrunk.select(F.col("v").alias("u"), F.col("least").alias("v")).union(shrunk.select("u", F.col("least").alias("v")))
            .filter("u > v").distinct(), "links")
        after = _mark(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v")).distinct()
