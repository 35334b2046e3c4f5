import datetime as dt
import shutil

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tablebridge import model as m
from tablebridge.functions.text import copy_line
from tablebridge.operators import batchplan, evolve as e, sink
from tablebridge.operators.verify import multiset_diff, table_diff
from tablebridge.plans.copy import clean_tiled, copy_table, copy_tiled, finished_tiles, read_tiled, write_generation
from tablebridge.sources.tiles import plan_key_tiles, tiles_from_bounds
from tablebridge.streaming.incremental import batch_counts, stream_copy, stream_scan


def greedy(sizes, max_rows, budget):
    out, rows, held = [], 0, 0
    for s in sizes:
        rows, held = rows + 1, held + s
        if rows >= max_rows or held >= budget:
            out.append((rows, held))
            rows, held = 0, 0
    return out + ([(rows, held)] if rows else [])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=80), st.integers(1, 9), st.integers(1, 60), st.integers(0, 20))
def test_blocks_compose_to_the_row_loop(sizes, max_rows, budget, more):
    """Entry tables of blocks, followed from row 0, and replays give the plan of one pass over all rows."""
    block, sizes = max_rows + more, np.asarray(sizes)
    got, entry, before = [], 0, 0
    for number in range(-(-len(sizes) // block)):
        seen = sizes[number * block:(number + 1) * block + max_rows]
        frame = pd.DataFrame({"block": number, "row_index": number * block + np.arange(len(seen)), "_size": seen, "entry": entry, "before": before})
        frame = frame.sample(frac=1, random_state=1)
        got += batchplan.replay(max_rows, budget, block)(frame).to_dict("records")
        leaving = batchplan.entry_table(max_rows, budget, block)(frame).set_index("entry")
        if entry in leaving.index:
            entry, before = int(leaving.to[entry]), before + int(leaving.batches[entry])
    expected, first = [], 0
    for k, (rows, held) in enumerate(greedy(sizes.tolist(), max_rows, budget)):
        expected.append({"batch": k, "first_row": first, "rows": rows, "bytes": held})
        first += rows
    assert got == expected


@pytest.mark.parametrize("block", [None, 60, 7])
def test_one_plan_whatever_the_partitions(spark, sf, block):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    sizes = [r.row_bytes for r in sink.estimate_row_bytes(docs).orderBy("doc_id").collect()]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    plans = []
    for partitions in (2, 16):
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        plan = batchplan.greedy_batches(docs.repartition(partitions), sink.estimated_bytes(docs), ["doc_id"], 7, 9_000, block)
        plans.append(sorted(tuple(r) for r in plan.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", old)
    assert plans[0] == plans[1] and [r[0] for r in plans[0]] == list(range(len(plans[0])))
    assert [r[2:] for r in plans[0]] == greedy(sizes, 7, 9_000)
    assert batchplan.greedy_batches(docs.limit(0), sink.estimated_bytes(docs), ["doc_id"], 7, 9_000).count() == 0
    with pytest.raises(m.QueryError):
        batchplan.greedy_batches(docs, F.lit(1), ["doc_id"], 0, 9_000)


@pytest.mark.parametrize("max_rows", [150, 10_000])
def test_blocks_are_of_one_size_for_short_and_long_batches(spark, monkeypatch, max_rows):
    """20,000 rows of short batches are one block, and long batches don't make blocks of 640,000 rows."""
    blocks = []
    monkeypatch.setattr(batchplan, "replay", lambda m, b, block, replay=batchplan.replay: blocks.append(block) or replay(m, b, block))
    plan = batchplan.greedy_batches(spark.range(20_000), F.lit(1), ["id"], max_rows, 1 << 20)
    assert sum(r.rows for r in plan.collect()) == 20_000 and blocks == [batchplan.BLOCK_ROWS]


def test_flush_plan_counts_encoded_bytes(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    planned = sink.copy_flush_plan(docs, ["doc_id"], flush_bytes=50_000)
    encoded = docs.agg(F.sum(F.octet_length(copy_line(docs)) + 1)).first()[0]
    total = planned.agg(F.sum("rows"), F.sum("bytes"), F.min("rows")).first()
    assert tuple(total)[:2] == (docs.count(), encoded) and total[2] >= 1


def test_placeholder_cap(spark):
    assert [sink.rows_per_batch(n) for n in (1, 131, 132, 65_535, 70_000)] == [500, 500, 496, 1, 1]
    with pytest.raises(m.UnsupportedError):
        sink.plan_write_batches(spark.sql("SELECT array(1) AS a"), ["a"])


def test_row_bytes(spark):
    df = spark.sql("SELECT 'é' AS t, X'0102' AS b, 1 AS i, '\"abc\"' AS j, '{}' AS k, CAST(NULL AS STRING) AS n, parse_json('1') AS v")
    sizes = sink.estimate_row_bytes(df, ["j", "k"]).first().row_bytes
    assert sizes == (2 + 16) + (2 + 16) + 16 + (3 + 32) + 256 + 16 + 256


@pytest.fixture(scope="module")
def three(spark):
    return spark.createDataFrame([(1, "alpha"), (2, None), (3, "gamma")], "id int, name string")


def test_bulk_write_counts_and_appends_by_position(spark, three, tmp_path):
    path = f"{tmp_path}/rows"
    assert sink.bulk_write(three, path) == 3
    assert sink.bulk_write(three.toDF("x", "y"), path) == 3
    assert multiset_diff(spark.read.parquet(path), three.union(three)).count() == 0
    with pytest.raises(m.BulkWriteError):
        sink.bulk_write(three.select("id"), path)
    with pytest.raises(m.BulkWriteError):
        sink.bulk_write(three.select("name", "id"), path)
    assert sink.bulk_write(three.limit(0), path) == 0
    assert sink.bulk_write(three, "bulk_rows") == 3
    assert sink.bulk_write(three.toDF("x", "y"), "bulk_rows") == 3
    assert spark.table("bulk_rows").count() == 6


def test_failing_source_publishes_nothing(spark, three, tmp_path):
    path = f"{tmp_path}/failing"
    bad = three.withColumn("name", F.when(F.col("id") == 3, F.raise_error("source broke")).otherwise(F.col("name")))
    with pytest.raises(Exception, match="source broke"):
        sink.bulk_write(bad, path)
    with pytest.raises(Exception):
        spark.read.parquet(path).count()


def test_adaptation(spark):
    df = spark.sql("SELECT array(1) AS a, TIMESTAMP'2024-01-01 00:00:00Z' AS z, '0-0' AS u")
    assert sink.adapt_for_target(df, "postgres") is df
    with pytest.raises(m.UnsupportedError):
        sink.adapt_for_target(df, "mysql")
    with pytest.raises(m.UnsupportedError):
        sink.adapt_for_target(df, "oracle9")
    assert sink.adapt_for_target(df, "mysql", "json").first() == ("[1]", dt.datetime(2024, 1, 1), "0-0")


def test_copy_table_verifies(spark, three, tmp_path):
    out = copy_table(spark, three, f"{tmp_path}/c", ["name", "id"], ("id", 2, None), "name string, id bigint")
    assert out.rows == 2 and out.check.verified
    assert spark.read.parquet(f"{tmp_path}/c").dtypes == [("name", "string"), ("id", "bigint")]


@pytest.fixture
def keyed(spark):
    return spark.range(0, 1000).select(F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id")).alias("k"), (F.col("id") * 2).alias("v"))


def test_tiled_copy_restarts(spark, keyed, tmp_path):
    tiles, dst, ledger = plan_key_tiles(keyed, "k", 6), f"{tmp_path}/d", f"{tmp_path}/l"
    with pytest.raises(m.SourceError):
        read_tiled(spark, dst, ledger)
    assert copy_tiled(keyed, "k", tiles[:2], dst, ledger, 1) == 2
    assert {line[0] for line in finished_tiles(spark, ledger)} == {t.tile_id for t in tiles[:2]}
    write_generation(keyed, "k", tiles, tiles[2:4], dst, ledger)  # died before its ledger line
    assert {r.tile_id for r in read_tiled(spark, dst, ledger).collect()} == {t.tile_id for t in tiles[:2]}
    assert copy_tiled(keyed, "k", tiles, dst, ledger, 3) == len(tiles) - 2
    assert copy_tiled(keyed, "k", tiles, dst, ledger) == 0
    assert multiset_diff(keyed, read_tiled(spark, dst, ledger).drop("tile_id")).count() == 0
    assert spark.read.parquet(f"{ledger}/tiles").agg(F.sum("rows")).first()[0] == 1000
    assert spark.read.parquet(f"{ledger}/manifests").agg(F.max("sequence")).first()[0] == 2


def test_lost_ledger_and_another_plan(spark, keyed, tmp_path):
    """The target holds a whole copy that no ledger knows; a coarser plan must not add to it."""
    src, dst = spark.range(100).withColumnRenamed("id", "k"), f"{tmp_path}/d"
    copy_tiled(src, "k", tiles_from_bounds([20, 80], null_tile=False), dst, f"{tmp_path}/lost")
    ledger = f"{tmp_path}/l"
    assert copy_tiled(src, "k", tiles_from_bounds([50], null_tile=False), dst, ledger) == 2
    assert sorted(r.k for r in read_tiled(spark, dst, ledger).collect()) == list(range(100))


def test_partial_ledger_and_another_plan(spark, tmp_path):
    """Tiles of a plan that was given up are not read; tiles with the same bounds are taken over."""
    src, dst, ledger = spark.range(100).withColumnRenamed("id", "k"), f"{tmp_path}/d", f"{tmp_path}/l"
    fine, coarse = tiles_from_bounds([20, 80], null_tile=False), tiles_from_bounds([20], null_tile=False)
    assert copy_tiled(src, "k", fine[:2], dst, ledger, per_commit=1) == 2
    assert copy_tiled(src, "k", coarse, dst, ledger) == 1  # the first tile is the same
    assert sorted(r.k for r in read_tiled(spark, dst, ledger).collect()) == list(range(100))
    assert copy_tiled(src, "k", coarse, dst, ledger) == 0
    assert len(clean_tiled(spark, dst, ledger)) == 1 and clean_tiled(spark, dst, ledger) == []
    assert sorted(r.k for r in read_tiled(spark, dst, ledger).collect()) == list(range(100))
    assert copy_tiled(src, "k", fine, dst, ledger) == 2  # what was removed is copied again
    assert sorted((r.k, r.tile_id) for r in read_tiled(spark, dst, ledger).collect()) == [(k, 0 if k < 20 else 1 if k < 80 else 2) for k in range(100)]


def test_lost_data_is_noticed(spark, tmp_path):
    src, dst, ledger = spark.range(100).withColumnRenamed("id", "k"), f"{tmp_path}/d", f"{tmp_path}/l"
    plan = tiles_from_bounds([20, 80], null_tile=False)
    copy_tiled(src, "k", plan[:1], dst, ledger)
    (_, generation), = finished_tiles(spark, ledger).values()
    shutil.rmtree(f"{dst}/generation={generation}")
    with pytest.raises(m.BulkWriteError, match="no longer holds"):
        copy_tiled(src, "k", plan, dst, ledger)


def test_empty_tile_is_finished(spark, tmp_path):
    src = spark.createDataFrame([], "k bigint, v string")
    tiles = plan_key_tiles(src, "k", 3)
    assert copy_tiled(src, "k", tiles, f"{tmp_path}/d", f"{tmp_path}/l") == len(tiles)
    assert copy_tiled(src, "k", tiles, f"{tmp_path}/d", f"{tmp_path}/l") == 0


def test_partitions(spark, three, tmp_path):
    spec = sink.RangePartitions("id", [("low", None, 2), ("high", 2, 3)])
    with pytest.raises(Exception, match="no partition for value 3"):
        sink.partitioned_write(three, f"{tmp_path}/p", spec)
    sink.partitioned_write(three, f"{tmp_path}/q", spec, default_child="rest")
    back = spark.read.parquet(f"{tmp_path}/q")
    assert {r.id: r.child for r in back.collect()} == {1: "low", 2: "high", 3: "rest"}
    assert sink.children_for_range(spec, 2) == ["high"] and sink.children_for_range(spec, None, 2) == ["low"]
    plan = back.where(F.col("child").isin(sink.children_for_range(spec, 2)))._jdf.queryExecution().executedPlan().toString()
    assert "(child#" in plan and "DataFilters: []" in plan
    rolled = {(r.part, r.child): r.rows for r in sink.partition_rollup(three, spec).collect()}
    assert rolled == {("child", "low"): 1, ("child", "high"): 1, ("outside", None): 1, ("parent", None): 3}
    lists = sink.ListPartitions("name", {"known": ["alpha"], "unknown": [None, "gamma"]})
    assert {r.part + str(r.child): r.rows for r in sink.partition_rollup(three, lists).collect()} == {
        "childknown": 1, "childunknown": 2, "parentNone": 3}
    hashed = sink.partition_rollup(spark.range(1000), sink.HashPartitions("id", 4)).where("part = 'child'").collect()
    assert len(hashed) == 4 and sum(r.rows for r in hashed) == 1000


def test_stream_of_arriving_files(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "ts", "user_id")
    inbox, dst, progress = (f"{tmp_path}/{n}" for n in ("inbox", "dst", "progress"))
    half = events.count() // 2
    for number, part in enumerate((events.where(F.col("event_id") < half), events.where(F.col("event_id") >= half))):
        part.write.mode("append").parquet(inbox)
        stream = stream_scan(spark, inbox, events.schema, ["event_id", "user_id"])
        stream_copy(stream, dst, progress).awaitTermination()
        assert batch_counts(spark, dst).count() == number + 1
    stream_copy(stream_scan(spark, inbox, events.schema, ["event_id", "user_id"]), dst, progress).awaitTermination()
    back = spark.read.parquet(dst).select("event_id", "user_id")
    assert multiset_diff(events.select("event_id", "user_id"), back).count() == 0


DEF = m.TableDef("basic", [m.ColumnDef("id", "int", False), m.ColumnDef("label", "varchar(5)"), m.ColumnDef("is_active", "boolean", False, "true")],
                 m.PrimaryKey(["id"]))


def test_create_as(spark, tmp_path):
    made = e.create_as(spark.sql("SELECT 'x' AS label, 1L AS id"), DEF, f"{tmp_path}/basic")
    assert made.first() == (1, "x", True)
    table = e.create_as(spark.sql("SELECT 'x' AS label, 1L AS id"), DEF, "basic_table")
    assert table.count() == 1
    for sql, error in (("SELECT 1 AS id, 2 AS zz", "no columns"), ("SELECT explode(array(1, 1)) AS id", "primary key"), ("SELECT CAST(NULL AS INT) AS id", "primary key"),
                       ("SELECT 1 AS id, CAST(NULL AS BOOLEAN) AS is_active", "NOT NULL"), ("SELECT 1 AS id, 'toolong' AS label", "longer"), ("SELECT 3000000000L AS id", "does not fit")):
        with pytest.raises(Exception, match=error):
            e.conform(spark.sql(sql), DEF).collect()


def test_structure_changes(three):
    assert e.add_column(three, m.ColumnDef("n", "int", True)).first().n is None
    for wrong in (m.ColumnDef("n", "int", False), m.ColumnDef("id", "int")):
        with pytest.raises(m.DdlError):
            e.add_column(three, wrong)
    assert "n" in e.add_column(three.limit(0), m.ColumnDef("n", "int", False)).columns
    for name in ("zz",):
        with pytest.raises(m.DdlError):
            e.drop_column(three, name)
    with pytest.raises(m.DdlError):
        e.drop_column(three.select("id"), "id")
    with pytest.raises(m.DdlError, match="gamma"):
        e.alter_column_type(three.where("id = 3"), "name", "int")
    with pytest.raises(m.DdlError):
        e.alter_column_type(three, "name", "varchar(4)")
    assert e.alter_column_type(three, "id", "bigint").dtypes[0] == ("id", "bigint")
    with pytest.raises(m.DdlError, match="broken"):
        e.add_constraint(three, m.CheckRule("small", "id < 3"))
    with pytest.raises(m.DdlError):
        e.apply_migration(three, [m.DropColumn("name"), m.DropColumn("name")])
    with pytest.raises(m.DdlError):
        e.apply_migration(three, ["what"])


def test_recreated_table_has_the_same_rows(spark, tmp_path):
    """Identity and amounts survive a definition, a write and a second definition."""
    shape = m.TableDef("orig", [m.ColumnDef("id", "bigint", False, identity=m.Identity()), m.ColumnDef("amount", "decimal(10,2)"),
                                m.ColumnDef("code", "varchar(20)", False)], m.PrimaryKey(["id"]))
    first = e.create_as(spark.sql("SELECT * FROM VALUES (1.50BD, 'a'), (NULL, 'b') AS t(amount, code)"), shape, f"{tmp_path}/a", ["code"])
    second = e.create_as(first, shape, f"{tmp_path}/b")
    assert table_diff(first, second, ["id"]).count() == 0
    e.add_constraint(second, m.UniqueKey("code", ["code"]))
