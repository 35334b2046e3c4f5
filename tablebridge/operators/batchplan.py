"""One greedy batch plan for a whole table, whatever the cluster that works it out.

A batch closes with the row that brings it to its row or byte limit, so where a batch begins
depends on all batches before it. The rows are numbered in order and cut into blocks of equal
length; each block also sees the first rows of the next one, as many as a batch can hold. Then:

1. A block works out the row behind the batch that begins at each of its rows, and follows
   these steps by pointer doubling to the first one beyond its end. A batch can only reach
   into a block's first rows, so a block is told by a short table: entry to exit.
2. The tables are composed like a parallel prefix: jumps over 1, 2, 4 ... blocks, each round a
   join of the table with itself. From row 0 this gives every block its true entry.
3. Each block replays its batches from there.

No task sees more than a block, and the number of rounds grows with the logarithm of the
number of blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tablebridge.model import QueryError
from tablebridge.session import stage
from tablebridge.sources.batches import number_rows
from tablebridge.sources.scan import col, require_columns

BLOCK_ROWS = 1 << 18  # rows of a block, at least; with short batches there are fewer blocks to compose
BLOCK_BATCHES = 4  # a block holds the rows of so many full batches, at least
_PLAN = "batch bigint, first_row bigint, rows bigint, bytes bigint"


def behind(sizes: np.ndarray, max_rows: int, budget: int) -> np.ndarray:
    """For each row the position behind the batch that begins with it, as far as the rows are known."""
    total = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    at = np.arange(len(sizes))
    by_bytes = np.searchsorted(total, total[:-1] + budget, side="left")
    return np.minimum(np.maximum(by_bytes, at + 1), at + max_rows)


def exits(step: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row before ``end``: the first batch start at or beyond it, and the batches until there."""
    to, count = step[:end].copy(), np.ones(end, dtype=np.int64)
    while True:
        inside = np.flatnonzero(to < end)
        if not len(inside):
            return to, count
        via = to[inside]
        to[inside], count[inside] = to[via], count[inside] + count[via]


def _sorted_sizes(frame: pd.DataFrame) -> np.ndarray:
    return frame.sort_values("row_index")["_size"].to_numpy()


def entry_table(max_rows: int, budget: int, block: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A block's rows to (block, entry, to, batches): batches that begin at ``entry`` leave it at ``to`` of the next."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        sizes = _sorted_sizes(frame)
        to, count = exits(behind(sizes, max_rows, budget), min(block, len(sizes)))
        wanted = min(max_rows, len(to))
        return pd.DataFrame({"block": frame["block"].iat[0], "entry": np.arange(wanted), "to": to[:wanted] - block, "batches": count[:wanted]})

    return run


def replay(max_rows: int, budget: int, block: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A block's rows with their true entry to the batches that begin in it."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        sizes = _sorted_sizes(frame)
        step = behind(sizes, max_rows, budget)
        number, at = int(frame["block"].iat[0]), int(frame["entry"].iat[0])
        starts = []
        while at < min(block, len(sizes)):
            starts.append(at)
            at = int(step[at])
        first = np.asarray(starts, dtype=np.int64)
        last = np.minimum(step[first], len(sizes))  # the table's last batch may stay open
        total = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
        return pd.DataFrame({"batch": int(frame["before"].iat[0]) + np.arange(len(first)), "first_row": number * block + first,
                             "rows": last - first, "bytes": total[last] - total[first]})

    return run


def _entries(table: DataFrame, blocks: int) -> DataFrame:
    """(block, entry, before) for every block: where its first batch begins and how many are before it."""
    spark = table.sparkSession
    reached = spark.createDataFrame([(0, 0, 0)], "block bigint, entry bigint, before bigint")
    jumps, span = table, 1
    while span < blocks:
        far = jumps.select("block", "entry", "to", "batches")
        further = reached.join(far, ["block", "entry"]).select(
            (F.col("block") + span).alias("block"), F.col("to").alias("entry"), (F.col("before") + F.col("batches")).alias("before"))
        reached = stage(reached.union(further), "entries")
        if 2 * span < blocks:
            then = far.toDF("mid", "at", "end", "more")
            jumps = stage(far.join(then, (F.col("mid") == F.col("block") + span) & (F.col("at") == F.col("to"))).select(
                "block", "entry", F.col("end").alias("to"), (F.col("batches") + F.col("more")).alias("batches")), "jumps")
        span *= 2
    return reached.filter(F.col("block") < blocks)


def greedy_batches(df: DataFrame, size: Column, order_by: Sequence[str], max_rows: int, budget: int, block: int | None = None) -> DataFrame:
    """(batch, first_row, rows, bytes) of the greedy plan over all rows in the order of ``order_by``.

    Rows of equal keys stand in the order of a hash of their sizes; only the key and a size
    travel. ``block`` is the number of rows that a task holds, at least ``max_rows``.
    """
    require_columns(df, order_by)
    if max_rows < 1 or budget < 1:
        raise QueryError("a batch holds at least one row and one byte")
    block = max(max_rows, block or max(BLOCK_ROWS, BLOCK_BATCHES * max_rows))
    sized = df.select(*[col(c) for c in order_by], size.cast("bigint").alias("_size"))
    rows = stage(number_rows(sized, order_by).select("row_index", "_size"), "sizes")
    total = rows.count()
    if not total:
        return rows.sparkSession.createDataFrame([], _PLAN)
    own = F.expr(f"row_index div {block}")
    ahead = (F.col("row_index") >= block) & (F.col("row_index") % block < max_rows)
    seen = rows.withColumn("block", F.explode(F.when(ahead, F.array(own, own - 1)).otherwise(F.array(own))))
    blocks = -(-total // block)
    table = stage(seen.groupBy("block").applyInPandas(entry_table(max_rows, budget, block), "block bigint, entry bigint, to bigint, batches bigint"),
                  "entry_table") if blocks > 1 else None
    entries = _entries(table, blocks) if blocks > 1 else rows.sparkSession.createDataFrame([(0, 0, 0)], "block bigint, entry bigint, before bigint")
    return seen.join(entries, "block").groupBy("block").applyInPandas(replay(max_rows, budget, block), _PLAN)
