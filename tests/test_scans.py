import datetime as dt
import decimal
import math
import uuid

import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tablebridge import session
from tablebridge.model import QueryError, UnsupportedError
from tablebridge.sources import scan, tileindex, tiles
from tablebridge.sources.batches import batch_rows, number_rows, running_sum, tie_columns, with_tie_break
from tablebridge.sources.tiles import Tile

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@pytest.fixture(scope="module")
def opts(spark):
    return spark.createDataFrame([(i, f"row{i}") for i in range(1, 6)], "id int, name string")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_projection_order_and_errors(opts):
    assert scan.project(opts, ["name", "id"]).columns == ["name", "id"]
    for bad in ([], ["nope"]):
        with pytest.raises(QueryError):
            scan.project(opts, bad)


def test_scan_of_missing_table(spark, tmp_path):
    for missing in ("no_such_table", f"{tmp_path}/none"):
        with pytest.raises(QueryError):
            scan.scan_table(spark, missing)


def test_half_open_range(opts):
    ids = [r.id for r in scan.key_range_scan(opts, "id", 2, 4).collect()]
    assert sorted(ids) == [2, 3]
    assert scan.key_range_scan(opts, "id", upper=3).count() == 2


@pytest.mark.parametrize("lower", [b"x", [1], {"a": 1}, float("nan").hex, True, "5"])
def test_range_rejects_bounds(opts, lower):
    with pytest.raises(UnsupportedError):
        scan.key_range_scan(opts, "id", lower)


def test_range_needs_a_bound_and_a_column(opts):
    with pytest.raises(QueryError):
        scan.key_range_scan(opts, "id")
    with pytest.raises(QueryError):
        scan.key_range_scan(opts, "nope", 1)


def test_range_bounds_of_every_kind(spark):
    utc = dt.timezone.utc
    row = spark.sql("""SELECT 5S AS s, 5 AS i, 5L AS l, 5.5BD AS d, 1.5F AS f, 1.5D AS x, true AS b, 'k' AS t,
        DATE'2024-01-02' AS dd, TIMESTAMP'2024-01-02 03:04:05Z' AS z, TIMESTAMP_NTZ'2024-01-02 03:04:05' AS n,
        '00000000-0000-0000-0000-000000000005' AS u""")
    bounds = {"s": 5, "i": 5, "l": 5, "d": decimal.Decimal("5.5"), "f": 1.5, "x": 1.5, "b": True, "t": "k", "dd": dt.date(2024, 1, 2),
              "z": dt.datetime(2024, 1, 2, 3, 4, 5, tzinfo=utc), "n": dt.datetime(2024, 1, 2, 3, 4, 5), "u": uuid.UUID(int=5)}
    for name, bound in bounds.items():
        assert scan.key_range_scan(row, name, lower=bound).count() == 1, name
        assert scan.key_range_scan(row, name, upper=bound).count() == 0, name
    assert scan.key_range_scan(row, "s", lower=70_000).count() == 0
    assert scan.key_range_scan(row, "s", upper=70_000).count() == 1


def test_instants_and_wall_clocks_never_mix(spark):
    row = spark.sql("SELECT TIMESTAMP'2024-01-02 03:04:05Z' AS z, TIMESTAMP_NTZ'2024-01-02 03:04:05' AS n")
    with pytest.raises(UnsupportedError):
        scan.key_range_scan(row, "n", dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc))
    with pytest.raises(UnsupportedError):
        scan.key_range_scan(row, "z", dt.datetime(2024, 1, 1))


def test_null_keys_are_in_no_range(spark):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    assert scan.key_range_scan(df, "k", lower=-10).count() == 1


def test_range_and_projection_reach_the_scan(spark, sf):
    orders = scan.scan_table(spark, f"{sf}/orders.parquet")
    text = plan(scan.project(scan.key_range_scan(orders, "o_orderkey", 10, 20), ["o_custkey"]))
    assert "GreaterThanOrEqual(o_orderkey,10), LessThan(o_orderkey,20)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text


def test_run_query_binds_and_guards(spark, opts):
    rows = scan.run_query(spark, "SELECT name FROM {t} WHERE id = ? OR name = ?", [2, "x' OR '1'='1"], t=opts)
    assert [r.name for r in rows] == ["row2"]
    with pytest.raises(QueryError):
        scan.run_query(spark, "SELECT * FROM {t}", max_rows=4, t=opts)
    lazy = scan.run_query_lazy(spark, "SELECT * FROM {t}", t=opts)
    assert sorted(lazy.collect()) == sorted(scan.run_query(spark, "SELECT * FROM {t}", t=opts))


def test_streamed_batches_equal_the_table(opts):
    batches = list(scan.iter_rows(opts, 2))
    assert [len(b) for b in batches] == [2, 2, 1]
    assert sorted(r for b in batches for r in b) == sorted(opts.collect())
    with pytest.raises(QueryError):
        scan.iter_rows(opts, 0)


def test_readable_projection(spark):
    df = spark.sql("SELECT INTERVAL '3' DAY AS i, parse_json('{\"b\":1}') AS v, map('a', 1) AS m, array(1, null) AS a, 1.5D AS x, array(INTERVAL '1' YEAR) AS ai")
    out = scan.readable_projection(df)
    assert dict(out.dtypes) == {"i": "string", "v": "string", "m": "string", "a": "array<int>", "x": "double", "ai": "string"}
    assert out.first().v == '{"b":1}'


KEYS = st.lists(st.one_of(st.none(), st.integers(-50, 50), st.just(7)), min_size=1, max_size=60)


@SLOW
@given(keys=KEYS, n=st.integers(1, 9), method=st.sampled_from(["quantile", "equal_width"]))
def test_tiles_cover_every_row_once(spark, keys, n, method):
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    planned = tiles.plan_key_tiles(df, "k", n, method)
    tagged = sorted((r.tile_id, r.k is None, r.k) for r in tiles.tiled_scan(df, "k", planned).collect() if r.k is not None)
    by_scan = sorted((t.tile_id, False, r.k) for t in planned if not t.is_null for r in tiles.scan_tile(df, "k", t).collect())
    assert tagged == by_scan
    assert len(tagged) + sum(k is None for k in keys) == len(keys)
    assert sum(r.rows for r in tiles.tile_coverage(df, "k", planned).collect()) == len(keys)


def test_text_tiles_with_quotes(spark):
    df = spark.createDataFrame([(x,) for x in ["a'b", "a\\c", "zé", 'q"', None, "m", "n", "o"]], "k string")
    planned = tiles.plan_key_tiles(df, "k", 4)
    assert sum(r.rows for r in tiles.tile_coverage(df, "k", planned).collect()) == 8
    for t in planned:
        assert tiles.scan_tile(df, "k", t).count() == tiles.tiled_scan(df, "k", planned).where(F.col("tile_id") == t.tile_id).count()


@pytest.mark.parametrize("method", ["quantile", "equal_width"])
@pytest.mark.parametrize("key", ["timestamp_micros(id * 3600000000)", "cast(timestamp_micros(id * 3600000000) AS timestamp_ntz)", "date_add(DATE'2024-01-01', cast(id AS int))",
                                 "cast(id / 7 AS decimal(12,3))", "cast(id AS double) / 3", "cast(id AS smallint)"])
def test_tiles_over_other_types(spark, key, method):
    df = spark.range(200).selectExpr(f"{key} AS k")
    planned = tiles.plan_key_tiles(df, "k", 5, method)
    assert len(planned) == 6
    counts = {r.tile_id: r.rows for r in tiles.tile_coverage(df, "k", planned).collect()}
    assert sum(counts.values()) == 200 and max(counts.values()) <= 60
    assert {t.tile_id: tiles.scan_tile(df, "k", t).count() for t in planned} == counts


def test_composite_tiles_over_bytes_and_instants(spark):
    df = spark.range(300).selectExpr("encode(string(id % 9), 'UTF-8') AS b", "timestamp_micros(id) AS t")
    bounds = [tuple(r.lower) for r in tileindex.plan_tile_frame(df, ["b", "t"], 4).orderBy("tile_id").collect() if r.lower]
    tagged = df.withColumn("tile", tiles.tuple_tile_expr(df, ["b", "t"], bounds))
    spans = tagged.groupBy("tile").agg(F.min(F.struct("b", "t")).alias("lo"), F.max(F.struct("b", "t")).alias("hi"), F.count(F.lit(1)).alias("n")).orderBy("tile").collect()
    assert sum(r.n for r in spans) == 300 and len(spans) > 1
    assert all((bytes(x.hi.b), x.hi.t) < (bytes(y.lo.b), y.lo.t) for x, y in zip(spans, spans[1:]))


def test_tile_count_is_checked(opts):
    with pytest.raises(QueryError):
        tiles.plan_key_tiles(opts, "id", 0)
    with pytest.raises(QueryError):
        tileindex.plan_tile_frame(opts, ["id"], 0)
    with pytest.raises(QueryError):
        tiles.plan_key_tiles(opts, "id", 4, "guess")


def ranks(df, frame, order, weight="1"):
    """Weight below each boundary, by a plain sort on the driver."""
    rows = df.select(*order, F.expr(weight).alias("w")).orderBy(*order).collect()
    keys, sums, total = [tuple(r[:-1]) for r in rows], [], 0
    for r in rows:
        sums.append(total)
        total += r.w
    return [sums[keys.index(tuple(r.lower))] for r in frame.orderBy("tile_id").collect() if r.lower], total


@pytest.mark.parametrize("weight", ["1", "1 + id % 9"])
def test_sketch_keeps_the_stated_rank_error(spark, weight):
    """Summaries of 64 keys over tens of thousands of rows, merged over several levels and groups."""
    df = spark.range(0, 40_000, 1, 5).selectExpr("id", "CAST((id * 7919) % 500 AS STRING) AS a", "id AS b")
    n, size = 20, 64
    frame = tileindex.plan_tile_frame(df, ["a", "b"], n, F.expr(weight), size)
    found, total = ranks(df, frame, ["a", "b"], weight)
    error = 2 * (2 + math.log2(40_000 / size)) / size
    assert len(found) == n - 1 and all(abs(f / total - (i + 1) / n) <= error for i, f in enumerate(found))
    assert max(abs(f / total - (i + 1) / n) for i, f in enumerate(found)) < 0.05
    sketch = tileindex.quantile_sketch(df, ["a", "b"], size, F.expr(weight), groups=3)
    assert sketch.count() <= 3 * size
    assert sketch.agg(F.sum("_weight")).first()[0] == pytest.approx(total)


def test_small_plans_are_exact_and_repeat(spark):
    df = spark.range(0, 1000, 1, 4).selectExpr("CASE WHEN id < 100 THEN NULL ELSE id END AS id")
    frame = tileindex.plan_tile_frame(df, ["id"], 9)
    assert ranks(df.where("id IS NOT NULL"), frame, ["id"])[0] == [100 * i for i in range(1, 9)]
    big = spark.range(0, 50_000, 1, 4).selectExpr("id % 777 AS k", "id")
    first, second = (tileindex.plan_tile_frame(big, ["k", "id"], 7, size=32).orderBy("tile_id").collect() for _ in range(2))
    assert first == second


@pytest.mark.parametrize("key", ["id", "CAST(id AS STRING)", "timestamp_micros(id * 1000)", "CAST(id AS DECIMAL(20, 2))", "date_add(DATE'2024-01-01', CAST(id AS INT))",
                                 "CASE WHEN id % 50 = 0 THEN DOUBLE('NaN') ELSE id / 3 END", "encode(CAST(id AS STRING), 'UTF-8')", "id > 700"])
def test_index_agrees_with_plain_ranges(spark, monkeypatch, key):
    """Three levels of the index for small nodes, against a join with all ranges."""
    monkeypatch.setattr(tileindex, "FAN_OUT", 8)
    df = spark.range(900).selectExpr(f"CASE WHEN id % 11 = 3 THEN NULL ELSE {key} END AS k")
    frame = tileindex.plan_tile_frame(df, ["k"], 300)
    bounds = [r.lower.k for r in frame.orderBy("tile_id").collect() if r.lower]
    by_index = tileindex.tag_tiles(df, ["k"], frame)
    steps = frame.select("tile_id", F.col("lower.k").alias("lo"), F.col("upper.k").alias("hi"))
    inside = df.join(steps, (F.col("lo").isNull() | (F.col("k") >= F.col("lo"))) & (F.col("hi").isNull() | (F.col("k") < F.col("hi"))))
    by_join = inside.select("k", "tile_id").unionAll(df.where("k IS NULL").select("k", F.lit(-1).alias("tile_id")))
    assert by_index.exceptAll(by_join).isEmpty() and by_join.exceptAll(by_index).isEmpty()
    assert len(bounds) == frame.count() - 1


def test_index_of_composite_keys_with_nulls(spark):
    df = spark.range(5000).selectExpr("CASE WHEN id % 3 = 0 THEN NULL ELSE id % 40 END AS a", "CASE WHEN id % 7 = 0 THEN NULL ELSE string(id) END AS `b c`")
    tagged = tileindex.tag_tiles(df, ["a", "b c"], tileindex.plan_tile_frame(df, ["a", "b c"], 500), "part")
    spans = tagged.groupBy("part").agg(F.min(F.struct("a", "b c")).alias("lo"), F.max(F.struct("a", "b c")).alias("hi"), F.count(F.lit(1)).alias("n"))
    pairs = spans.alias("x").join(spans.alias("y"), F.expr("y.part > x.part AND y.lo <= x.hi"))
    assert spans.agg(F.sum("n")).first()[0] == 5000 and spans.count() > tileindex.FAN_OUT and pairs.isEmpty()


def test_index_of_an_empty_table(spark):
    none = spark.createDataFrame([], "k string, tile_id int")
    frame = tileindex.plan_tile_frame(none, ["k"], 4)
    assert [tuple(r) for r in frame.collect()] == [(0, None, None)]
    assert tileindex.tag_tiles(none, ["k"], frame, "t").isEmpty()
    nulls = spark.createDataFrame([(None,)], "k int")
    assert tileindex.tag_tiles(nulls, ["k"], tileindex.plan_tile_frame(nulls, ["k"], 4), "t").first().t == -1


def test_running_sums(spark):
    df = spark.range(0, 3000, 1, 6).selectExpr("id % 5 AS k", "id", "id % 4 AS v")
    out = running_sum(df, ["k", "id"], "v").collect()
    total, expected = 0, {}
    for r in sorted(out, key=lambda r: (r.k, r.id)):
        expected[r.id], total = total, total + r.v
    assert {r.id: r.before for r in out} == expected
    assert running_sum(df.where("id < 0"), ["k"], "v").isEmpty()


def test_jdbc_predicates_cover_the_table():
    planned = tiles.tiles_from_bounds([10, 20])
    assert tiles.jdbc_predicates('a"b', planned) == ['"a""b" < 10', '"a""b" >= 10 AND "a""b" < 20', '"a""b" >= 20', '"a""b" IS NULL']
    assert tiles.jdbc_predicates("d", [Tile(0, dt.date(2024, 1, 1), dt.datetime(2024, 2, 1))], "`") == \
        ["`d` >= DATE '2024-01-01' AND `d` < TIMESTAMP '2024-02-01 00:00:00'"]
    text, key = [Tile(0, "a\\'", None)], uuid.UUID(int=7)
    assert tiles.jdbc_predicates("t", text) == ["\"t\" >= 'a\\'''"]
    assert tiles.jdbc_predicates("t", text, "`") == ["`t` >= 'a\\\\'''"]
    assert tiles.jdbc_predicates("t", [Tile(0, dt.time(9, 30), True)]) == ["\"t\" >= TIME '09:30:00' AND \"t\" < TRUE"]
    assert tiles.jdbc_predicates("t", [Tile(0, key, None)]) == [f"\"t\" >= '{key}'"]
    assert tiles.jdbc_predicates("t", [Tile(0)]) == ['"t" IS NOT NULL']


@SLOW
@given(keys=st.lists(st.one_of(st.none(), st.sampled_from([1, 1, 1, 2, 3])), max_size=40), size=st.integers(1, 7))
def test_batches_are_consecutive(spark, keys, size):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, i int")
    out = sorted(batch_rows(df, ["k"], size).collect(), key=lambda r: r.row_index)
    assert [r.row_index for r in out] == list(range(len(keys)))
    assert [r.batch_id for r in out] == [i // size for i in range(len(keys))]
    ordered = [(-1 if r.k is None else r.k) for r in out]
    assert ordered == sorted(ordered)
    assert sorted(r.i for r in out) == list(range(len(keys)))


def test_hot_key_is_numbered_in_many_tasks(spark):
    df = spark.range(0, 40_000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"), "id")
    out = number_rows(df, ["k"]).cache()
    assert out.select("row_index").distinct().count() == 40_000
    assert out.agg(F.max("row_index")).first()[0] == 39_999


def test_copies_of_one_row_spread_over_tasks(spark):
    """A third of the rows are one row: its copies must not land in one range."""
    copies = spark.range(0, 6000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    tied = with_tie_break(copies)
    ranged = tied.repartitionByRange(8, "k", *tie_columns()).withColumn("p", F.spark_partition_id())
    assert ranged.where("k = -1").select("p").distinct().count() > 1
    out = number_rows(copies, ["k"])
    assert sorted(r.row_index for r in out.collect()) == list(range(6000))
    assert out.where("k = -1").agg(F.max("row_index")).first()[0] == 1999


def test_batch_size_is_checked(opts):
    with pytest.raises(QueryError):
        batch_rows(opts, ["id"], 0)


def test_numbered_rows_are_not_gathered_by_range(spark):
    """The second pass adds offsets where the rows are: it neither shuffles nor sorts them."""
    copies = spark.range(3000).select(F.expr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the rows were many
    try:
        out = batch_rows(copies, ["k"], 500)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 1
    rows = sorted((r.row_index, r.k, r.batch_id) for r in out.collect())
    assert rows == [(i, k, i // 500) for i, k in enumerate(sorted(r.k for r in copies.collect()))]


def test_ranges_of_copies_are_not_joined(spark, tmp_path, monkeypatch):
    """Copies shrink in a shuffle, so their ranges look small; each is still sorted by a task of its own."""
    monkeypatch.setattr(session, "staging_path", lambda spark, label: f"{tmp_path}/{label}")
    copies = spark.range(0, 80_000, 1, 4).select(F.lit(7).alias("k"))
    assert sorted(r.row_index for r in number_rows(copies, ["k"]).collect()) == list(range(80_000))
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in tmp_path.glob("numbered/*.parquet")]
    assert sum(sizes) == 80_000 and max(sizes) <= 40_000
