"""Whole-table copies: one job, or tile by tile and restartable."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from tablebridge.functions.values import canonicalize
from tablebridge.model import BulkWriteError, SourceError
from tablebridge.operators.sink import adapt_for_target, bulk_write
from tablebridge.operators.verify import merge_ranges, verify_copy
from tablebridge.sources.scan import col, key_range_scan, project, scan_table
from tablebridge.sources.tiles import Tile, tile_condition, tile_id_expr


@dataclass(frozen=True)
class CopyResult:
    rows: int
    check: Row | None


def prepared(src: DataFrame, columns: Sequence[str] | None = None, key_range: tuple[str, Any, Any] | None = None,
             schema: T.StructType | str | None = None, engine: str = "postgres", arrays: str = "error") -> DataFrame:
    """Range, project, canonicalise and adapt; nothing runs yet."""
    df = key_range_scan(src, *key_range) if key_range else src
    df = project(df, columns) if columns else df
    df = canonicalize(df, schema) if schema else df
    return adapt_for_target(df, engine, arrays)


def copy_table(spark: SparkSession, src: str | DataFrame, dst: str, columns: Sequence[str] | None = None,
               key_range: tuple[str, Any, Any] | None = None, schema: T.StructType | str | None = None,
               engine: str = "postgres", arrays: str = "error", mode: str = "errorifexists",
               verify: bool = True) -> CopyResult:
    """Scan to write, then compare what was read with what can be read back.

    The check wants the target alone, so ``append`` turns it off.
    """
    source = src if isinstance(src, DataFrame) else scan_table(spark, src)
    rows_out = prepared(source, columns, key_range, schema, engine, arrays)
    written = bulk_write(rows_out, dst, mode)
    check = None
    if verify and mode != "append":
        check = verify_copy(rows_out, scan_table(spark, dst)).first()
        if not check.verified:
            raise BulkWriteError(f"the copy in {dst} differs from its source: {check}")
    return CopyResult(written, check)


# A tiled copy's ledger: tiles that are copied, generations about to be written or removed, plans that are whole.
TILES = "tile_id int, key_column string, lower string, upper string, is_null boolean, rows bigint, generation string"
MANIFEST = f"sequence bigint, {TILES}"
GENERATIONS = "generation string"


def _line(column: str, tile: Tile) -> tuple:
    """What makes a tile the same tile in another run: its number, column and bounds."""
    lower, upper = (None if v is None else repr(v) for v in (tile.lower, tile.upper))
    return tile.tile_id, column, lower, upper, tile.is_null


def _lines(spark: SparkSession, ledger: str, part: str, schema: str) -> list[Row]:
    try:
        return spark.read.schema(schema).parquet(f"{ledger}/{part}").collect()  # as long as the plans
    except AnalysisException:
        return []


def _add(spark: SparkSession, ledger: str, part: str, schema: str, rows: Sequence[tuple]) -> None:
    """One file, so that readers see all of the lines or none."""
    spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(f"{ledger}/{part}")


def finished_tiles(spark: SparkSession, ledger: str) -> dict[tuple, tuple[int, str]]:
    """Rows and generation of each copied tile."""
    gone = {r.generation for r in _lines(spark, ledger, "removed", GENERATIONS)}
    return {tuple(r)[:5]: (r.rows, r.generation) for r in _lines(spark, ledger, "tiles", TILES) if r.generation not in gone}


def write_generation(src: DataFrame, column: str, tiles: Sequence[Tile], wave: Sequence[Tile], dst: str, ledger: str) -> tuple[str, dict[int, int]]:
    """Write the tiles of ``wave`` to a folder of their own; returns its name and the rows of each tile.

    The intent is noted first, so that what a crash leaves behind can be found. Nothing reads
    the folder before the ledger lists it.
    """
    spark = src.sparkSession
    generation = f"g{uuid.uuid4().hex}"
    _add(spark, ledger, "intents", GENERATIONS, [(generation,)])
    tagged = src.withColumn("tile_id", tile_id_expr(src, column, tiles))
    within = reduce(lambda x, y: x | y, [tile_condition(src, column, t) for t in merge_ranges(wave)])
    tagged.where(within).hint("rebalance", "tile_id").write.partitionBy("tile_id").parquet(f"{dst}/generation={generation}")
    expected = _rows_per_tile(tagged.select("tile_id", col(column)).where(within))
    written = _written(spark, dst, [generation])
    if {(generation, t): n for t, n in expected.items()} != written:
        raise BulkWriteError(f"tiles of {dst} hold other row counts than their source: {written} against {expected}")
    return generation, expected


def copy_tiled(src: DataFrame, column: str, tiles: Sequence[Tile], dst: str, ledger: str, per_commit: int | None = None) -> int:
    """Copy the tiles that the ledger does not list; returns the tiles copied now.

    Data goes to new folders only, one for each commit: all pending tiles, or ``per_commit``
    neighbouring ones. A commit is counted against the source and then listed in the ledger by
    its tiles' numbers and bounds, so another plan finds nothing of its own there and copies
    anew. When all tiles of the plan are listed and the target still holds their rows, a
    manifest names the folders that make up the table; ``read_tiled`` follows the newest
    manifest. A crash at any point leaves folders that no manifest names, never rows too many
    or too few; ``clean_tiled`` removes them. One copy writes to a target at a time. Driver
    state is the tile plan.
    """
    spark = src.sparkSession
    done = finished_tiles(spark, ledger)
    pending = [t for t in sorted(tiles, key=lambda t: t.tile_id) if _line(column, t) not in done]
    step = per_commit or max(1, len(pending))
    for start in range(0, len(pending), step):
        wave = pending[start:start + step]
        generation, rows = write_generation(src, column, tiles, wave, dst, ledger)
        _add(spark, ledger, "tiles", TILES, [(*_line(column, t), rows.get(t.tile_id, 0), generation) for t in wave])
    done = finished_tiles(spark, ledger)
    whole = [(*_line(column, t), *done[_line(column, t)]) for t in tiles]
    sequence, newest = _newest(spark, ledger)
    if sorted(whole, key=repr) != sorted(newest, key=repr):
        listed = {(g, t): n for t, *_, n, g in whole if n}
        held = _written(spark, dst, sorted({g for g, _ in listed}))
        if any(held.get(k) != n for k, n in listed.items()):
            raise BulkWriteError(f"{dst} no longer holds the rows that {ledger} lists")
        _add(spark, ledger, "manifests", MANIFEST, [(sequence + 1, *line) for line in whole])
    return len(pending)


def _newest(spark: SparkSession, ledger: str) -> tuple[int, list[tuple]]:
    """The number of the newest manifest and its lines; (0, []) before the first."""
    lines = _lines(spark, ledger, "manifests", MANIFEST)
    last = max((r.sequence for r in lines), default=0)
    return last, [tuple(r)[1:] for r in lines if r.sequence == last]


def read_tiled(spark: SparkSession, dst: str, ledger: str) -> DataFrame:
    """The table that the newest manifest describes, with ``tile_id``."""
    sequence, lines = _newest(spark, ledger)
    if not sequence:
        raise SourceError(f"no copy to {dst} is whole yet")
    generations = sorted({g for *_, g in lines})
    named = spark.createDataFrame([(g, t) for t, *_, _, g in lines], "generation string, tile_id int")
    return (spark.read.parquet(dst).where(F.col("generation").isin(generations))
            .join(named, ["generation", "tile_id"], "left_semi").drop("generation"))


def clean_tiled(spark: SparkSession, dst: str, ledger: str) -> list[str]:
    """Remove the folders that the newest manifest does not name; returns their names.

    They are noted as removed first, so no later copy relies on them. Not for use while a copy
    runs, or while an older manifest is still being read.
    """
    sequence, lines = _newest(spark, ledger)
    gone = {r.generation for r in _lines(spark, ledger, "removed", GENERATIONS)}
    kept = {g for *_, g in lines}
    stray = sorted({r.generation for r in _lines(spark, ledger, "intents", GENERATIONS)} - kept)
    if new := [g for g in stray if g not in gone]:
        _add(spark, ledger, "removed", GENERATIONS, [(g,) for g in new])
    for generation in stray:  # also those that an earlier call noted but did not get to remove
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{dst}/generation={generation}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return new


def _rows_per_tile(df: DataFrame) -> dict[int, int]:
    """One number for each tile of the plan."""
    return {r.tile_id: r.n for r in df.groupBy("tile_id").agg(F.count(F.lit(1)).alias("n")).collect()}


def _written(spark: SparkSession, dst: str, generations: Sequence[str]) -> dict[tuple[str, int], int]:
    """Rows of each tile in some folders; an empty table leaves nothing that could be read."""
    try:
        found = spark.read.parquet(dst).where(F.col("generation").isin(list(generations)))
        return {(r.generation, r.tile_id): r.n for r in found.groupBy("generation", "tile_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    except AnalysisException:
        return {}
