"""Comparing tables: cells, rows, multisets, fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablebridge.functions.floats import FLOATS, bitwise_equal, has_floats, is_negative_zero, restore_zero_signs, zero_signs
from tablebridge.model import QueryError
from tablebridge.sources.scan import col, require_columns
from tablebridge.sources.tiles import Tile, plan_key_tiles, tile_condition, tile_id_expr


def require_same_schema(a: DataFrame, b: DataFrame) -> None:
    """Values of different types never compare equal, so types must match first."""
    left = [(f.name, f.dataType) for f in a.schema.fields]
    right = [(f.name, f.dataType) for f in b.schema.fields]
    if left != right:
        raise QueryError(f"schemas differ: {a.schema.simpleString()} and {b.schema.simpleString()}")


def null_safe_bitwise_equal(a: Column, a_type: T.DataType, b: Column, b_type: T.DataType) -> Column:
    """Cell equality of the value model; different types are never equal."""
    return bitwise_equal(a, b, a_type) if a_type == b_type else F.lit(False)


def _variant_safe(df: DataFrame) -> DataFrame:
    """Variants cannot be grouped on; their sorted JSON text can."""
    return df.select(*[F.to_json(col(f.name)).alias(f.name) if isinstance(f.dataType, T.VariantType)
                       else col(f.name) for f in df.schema.fields])


def multiset_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with ``copies_a`` and ``copies_b``.

    One aggregation over both inputs with map-side combine: copies of a row
    collapse before the shuffle, so a row held by a third of the table is one
    record per task.
    """
    require_same_schema(a, b)
    a, b = _variant_safe(a), _variant_safe(b)
    names = a.columns
    float_cols = [f for f in a.schema.fields if has_floats(f.dataType)]
    signs = [zero_signs(col(f.name), f.dataType).alias(f"_zero_{f.name}") for f in float_cols]

    def side(df: DataFrame, left: int) -> DataFrame:
        return df.select(*[col(c) for c in names], *signs, F.lit(left).alias("_a"), F.lit(1 - left).alias("_b"))

    keys = names + [f"_zero_{f.name}" for f in float_cols]
    both = side(a, 1).unionByName(side(b, 0)).groupBy(*[col(k) for k in keys])
    out = (both.agg(F.sum("_a").alias("copies_a"), F.sum("_b").alias("copies_b"))
           .where(F.col("copies_a") != F.col("copies_b")))
    restored = {f.name: restore_zero_signs(col(f.name), col(f"_zero_{f.name}"), f.dataType).alias(f.name)
                for f in float_cols}
    return out.select(*[restored.get(c, col(c)) for c in names], "copies_a", "copies_b")


def table_diff(a: DataFrame, b: DataFrame, key: Sequence[str]) -> DataFrame:
    """Per differing key: ``only_a``, ``only_b``, ``changed`` or ``ambiguous``.

    Columns: the key, ``change``, ``changed_columns`` and the numbers of
    unmatched rows on either side. Equal rows cancel in one aggregation
    first; what is left is grouped by key. A key left with several rows on a
    side cannot be paired and is reported as ``ambiguous`` with its counts,
    never as all pairs.
    """
    require_columns(a, key)
    left = multiset_diff(a, b)
    values = [f for f in a.schema.fields if f.name not in key]
    surplus = F.col("copies_a") - F.col("copies_b")
    row = F.struct(*[col(f.name).alias(f"v{i}") for i, f in enumerate(values)], F.lit(0).alias("_"))
    grouped = left.groupBy(*[col(k) for k in key]).agg(
        F.sum(F.when(surplus > 0, surplus).otherwise(0)).alias("rows_a"),
        F.sum(F.when(surplus < 0, -surplus).otherwise(0)).alias("rows_b"),
        F.any_value(F.when(surplus > 0, row), F.lit(True)).alias("_ra"),
        F.any_value(F.when(surplus < 0, row), F.lit(True)).alias("_rb"))
    change = (F.when((F.col("rows_a") == 1) & (F.col("rows_b") == 1), "changed")
              .when(F.col("rows_b") == 0, "only_a").when(F.col("rows_a") == 0, "only_b").otherwise("ambiguous"))
    flags = [F.when(~bitwise_equal(F.col(f"_ra.v{i}"), F.col(f"_rb.v{i}"),
                                   T.StringType() if isinstance(f.dataType, T.VariantType) else f.dataType),
                    F.lit(f.name)) for i, f in enumerate(values)]
    names = F.array_compact(F.array(*flags)) if flags else F.array().cast("array<string>")
    return (grouped.withColumn("change", change)
            .select(*[col(k) for k in key], "change",
                    F.when(F.col("change") == "changed", names).alias("changed_columns"), "rows_a", "rows_b"))


def cell_text(c: Column, data_type: T.DataType) -> Column:
    """Unambiguous text of a cell for hashing; NULL stays NULL."""
    if isinstance(data_type, T.BinaryType):
        return F.lower(F.hex(c))
    if isinstance(data_type, T.ArrayType):
        inner = F.transform(c, lambda x: length_prefixed(cell_text(x, data_type.elementType)))
        return F.array_join(inner, "")
    if isinstance(data_type, (T.VariantType, T.MapType, T.StructType)):
        return F.to_json(c)
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(c).cast("string")
    return c.cast("string")


def length_prefixed(text: Column) -> Column:
    """``<length>:<text>`` so that neighbouring fields cannot run together; NULL is ``-``."""
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(df: DataFrame) -> Column:
    fields = [length_prefixed(cell_text(col(f.name), f.dataType)) for f in df.schema.fields]
    return F.md5(F.concat(*fields).cast("binary"))


def row_hashes(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes per row without making text of numbers.

    The engine's hash skips NULLs and merges both zeros, so a bit mask of each
    goes in as well. Arrays and documents, whose inner NULLs it would skip too,
    go in as their unambiguous text.
    """
    fields = df.schema.fields
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    cells = [cell_text(col(f.name), f.dataType) if isinstance(f.dataType, nested) else col(f.name) for f in fields]
    flags = [c.isNull() for c in cells] + [is_negative_zero(col(f.name)) for f in fields if isinstance(f.dataType, FLOATS)]
    masks = []
    for start in range(0, len(flags), 60):
        mask = F.lit(0).cast("bigint")
        for i, flag in enumerate(flags[start:start + 60]):
            mask = mask + F.when(flag, F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
        masks.append(mask)
    return [F.xxhash64(F.lit(seed), *cells, *masks) for seed in (1, 2)]


def table_fingerprint(df: DataFrame, tile: Column | None = None, method: str = "md5") -> DataFrame:
    """Row count and two order-insensitive hash sums, overall or per ``tile``.

    ``md5`` sums 32-bit parts of each row's digest and can be recomputed by
    any engine; ``xxhash`` is faster and compares tables within Spark. The
    sums combine before any shuffle and are exact for any number of rows.
    """
    if method == "md5":
        hashed = df.select(*([tile.alias("tile_id")] if tile is not None else []), row_digest(df).alias("_d"))
        parts = [F.conv(F.substring("_d", start, 8), 16, 10) for start in (1, 9)]
    elif method == "xxhash":
        one, two = row_hashes(df)
        hashed = df.select(*([tile.alias("tile_id")] if tile is not None else []), one.alias("_a"), two.alias("_b"))
        parts = [F.col("_a"), F.col("_b")]
    else:
        raise QueryError(f"unknown fingerprint method {method!r}")
    sums = [F.coalesce(F.sum(p.cast("decimal(20,0)")).cast("string"), F.lit("0")) for p in parts]
    aggs = [F.count(F.lit(1)).alias("rows"), sums[0].alias("hash_a"), sums[1].alias("hash_b")]
    return hashed.groupBy("tile_id").agg(*aggs) if tile is not None else hashed.agg(*aggs)


def unequal_tiles(a: DataFrame, b: DataFrame, column: str, tiles: Sequence[Tile]) -> DataFrame:
    """Tiles whose fingerprints differ, missing ones included."""
    require_same_schema(a, b)
    fa = table_fingerprint(a, tile_id_expr(a, column, tiles), "xxhash")
    fb = table_fingerprint(b, tile_id_expr(b, column, tiles), "xxhash")
    named = [fb[c].alias(f"{c}_b") for c in ("rows", "hash_a", "hash_b")]
    joined = fa.join(fb.select(F.col("tile_id"), *named), "tile_id", "full_outer")
    same = (F.col("rows").eqNullSafe(F.col("rows_b")) & F.col("hash_a").eqNullSafe(F.col("hash_a_b"))
            & F.col("hash_b").eqNullSafe(F.col("hash_b_b")))
    return joined.where(~same).select("tile_id", F.coalesce("rows", F.lit(0)).alias("rows_a"),
                                      F.coalesce("rows_b", F.lit(0)).alias("rows_b"))


def bisect_diff(a: DataFrame, b: DataFrame, key: str, n: int = 64,
                tiles: Sequence[Tile] | None = None) -> DataFrame:
    """``table_diff`` restricted to the tiles whose fingerprints differ.

    The tile numbers come to the driver (at most ``n + 1``); the drill-down
    reads only their key ranges, pushed to the source.
    """
    tiles = list(tiles) if tiles is not None else plan_key_tiles(a, key, n)
    bad = {r.tile_id for r in unequal_tiles(a, b, key, tiles).select("tile_id").collect()}
    wanted = merge_ranges([t for t in tiles if t.tile_id in bad])

    def drill(df: DataFrame) -> DataFrame:
        condition = F.lit(False)
        for tile in wanted:
            condition = condition | tile_condition(df, key, tile)
        return df.where(condition)

    return table_diff(drill(a), drill(b), [key])


def merge_ranges(tiles: Sequence[Tile]) -> list[Tile]:
    """Join neighbouring ranges so that a filter names each run of tiles once."""
    out: list[Tile] = []
    for tile in sorted(tiles, key=lambda t: t.tile_id):
        last = out[-1] if out else None
        if last and not tile.is_null and not last.is_null and last.upper is not None and last.upper == tile.lower:
            out[-1] = Tile(last.tile_id, last.lower, tile.upper)
        else:
            out.append(tile)
    return out


def columns_frame(df: DataFrame) -> DataFrame:
    """The structure of a DataFrame as rows: one per column."""
    rows = [(f.name, i + 1, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, ordinal int, type string, nullable boolean")


def schema_diff(a: DataFrame, b: DataFrame, keys: Sequence[str] = ("column_name",)) -> DataFrame:
    """Column-level differences of two inventories.

    Inputs have ``keys`` (for many tables at once also source, schema and
    table), ``ordinal``, ``type``, ``nullable`` and, if present on both
    sides, ``identity``. One row per differing column.
    """
    attrs = ["type", "nullable", "ordinal"] + (["identity"] if "identity" in a.columns and "identity" in b.columns else [])
    l = a.select(*keys, *[F.col(x).alias(f"{x}_a") for x in attrs], F.lit(True).alias("_ina"))
    r = b.select(*keys, *[F.col(x).alias(f"{x}_b") for x in attrs], F.lit(True).alias("_inb"))
    joined = l.join(r, list(keys), "full_outer")
    label = {"type": "type changed", "nullable": "nullability changed", "ordinal": "position changed",
             "identity": "identity changed"}
    both = [F.when(~F.col(f"{x}_a").eqNullSafe(F.col(f"{x}_b")), F.lit(label[x])) for x in attrs]
    changes = (F.when(F.col("_inb").isNull(), F.array(F.lit("removed")))
               .when(F.col("_ina").isNull(), F.array(F.lit("added")))
               .otherwise(F.array_compact(F.array(*both))))
    return (joined.withColumn("changes", changes).where(F.size("changes") > 0)
            .select(*keys, "changes", "type_a", "type_b"))


def verify_copy(src: DataFrame, dst: DataFrame) -> DataFrame:
    """One row: schemas alike, counts alike, fingerprints alike, and the verdict."""
    alike = [(f.name, f.dataType) for f in src.schema.fields] == [(f.name, f.dataType) for f in dst.schema.fields]
    a = table_fingerprint(src, method="xxhash").select(F.col("rows").alias("rows_a"), F.col("hash_a").alias("h1"), F.col("hash_b").alias("h2"),
                                      F.lit(1).alias("_one"))
    b = table_fingerprint(dst, method="xxhash").select(F.col("rows").alias("rows_b"), F.col("hash_a").alias("h3"), F.col("hash_b").alias("h4"),
                                      F.lit(1).alias("_one"))
    same = (F.col("h1") == F.col("h3")) & (F.col("h2") == F.col("h4"))
    return (a.join(b, "_one")
            .select("rows_a", "rows_b", F.lit(alike).alias("schema_equal"),
                    (F.col("rows_a") == F.col("rows_b")).alias("rows_equal"), same.alias("fingerprint_equal"))
            .withColumn("verified", F.col("schema_equal") & F.col("rows_equal") & F.col("fingerprint_equal")))
