import datetime as dt
import random
from itertools import combinations, permutations, product

import pytest
from pyspark.sql import functions as F

from tablebridge import model as m
from tablebridge.operators import constraints as c, discovery, keys as k, profile, referential as r
from tablebridge.plans.constraint_report import constraint_report


def rows(df):
    return sorted(tuple(x) for x in df.collect())


@pytest.fixture(scope="module")
def parent(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, name string")


@pytest.fixture(scope="module")
def child(spark):
    return spark.createDataFrame([(10, 1), (11, 1), (12, 2), (13, None), (14, 9)], "id int, parent_id int")


def test_primary_and_unique_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, None), (1, None), (2, 1)], "a int, b int")
    assert {(x.a, x.b, x.rows, x.reason) for x in c.pk_violations(df, ["a", "b"]).collect()} == {
        (1, 1, 2, "duplicate key"), (1, None, 2, "null key")}
    assert rows(c.unique_violations(df, ["a", "b"])) == [(1, 1, 2)]
    with pytest.raises(m.QueryError):
        c.pk_violations(df, ["zz"])


def test_rows_behind_null_keys(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, None, "y"), (2, 2, "z")], "a int, b int, c string")
    assert c.rows_with_keys(df, c.pk_violations(df, ["a", "b"]), ["a", "b"]).count() == 2


def test_foreign_keys_match_simple(spark, parent, child):
    assert rows(c.fk_violations(child, parent, ["parent_id"], ["id"])) == [(14, 9)]
    two = spark.createDataFrame([(1, None), (1, 5), (1, 1)], "x int, y int")
    ref = spark.createDataFrame([(1, 1)], "p int, q int")
    assert rows(c.fk_violations(two, ref, ["x", "y"], ["p", "q"])) == [(1, 5)]
    with pytest.raises(m.QueryError):
        c.fk_violations(two, ref, ["x", "y"], ["p"])


def test_checks_pass_on_null(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "v int")
    assert [(x.v, x.violated) for x in c.check_violations(df, {"pos": "v > 0", "small": "v < 100"}).collect()] == [(-1, ["pos"])]
    with pytest.raises(m.QueryError):
        c.check_violations(df, {})


def test_enum_and_domain(spark):
    df = spark.createDataFrame([("a", 300), ("b", 1), (None, 2)], "e string, n int")
    assert rows(c.enum_violations(df, "e", ["a"])) == [("b", 1)]
    for many in (0, 300):
        labels = [f"l{i}" for i in range(many)] + ["a", None]
        assert rows(c.enum_violations(df, "e", labels)) == [("b", 1)]
        assert rows(c.enum_violations(df, "e", spark.createDataFrame([(v,) for v in labels], "label string"))) == [("b", 1)]
    assert c.enum_violations(df, "e", [None]).count() == 2
    bad = c.domain_violations(df.withColumn("x", F.lit("toolong")), "n tinyint, x varchar(3)")
    assert {(x.n, tuple(x.misfit_columns)) for x in bad.collect()} == {(300, ("n", "x")), (1, ("x",)), (2, ("x",))}


@pytest.mark.parametrize("seed, tiles", [(1, 2), (2, 8), (3, 64)])
def test_exclusion_against_brute_force(spark, seed, tiles):
    """One key holds most rows, many starts are equal, some keys and bounds are NULL."""
    rng = random.Random(seed)
    data = []
    for i in range(300):
        lo = rng.choice([5, 5, rng.randint(0, 400)])
        data.append((i, rng.choice(["hot", "hot", "k1", None]), rng.choice([lo, lo, lo, None]), lo + rng.randint(0, 4)))
    df = spark.createDataFrame(data, "i int, k string, lo int, hi int")
    live = sorted((x for x in data if x[1] is not None and x[2] is not None and x[2] < x[3]), key=lambda x: (x[2], x[0]))
    expected = []
    for n, x in enumerate(live):
        ends = [y[3] for y in live[:n] if y[1] == x[1]]
        if ends and max(ends) > x[2]:
            expected.append((*x, max(ends)))
    assert rows(c.exclusion_violations(df, ["k"], "lo", "hi", ["i"], tiles)) == sorted(expected)
    assert c.exclusion_violations(df, ["k"], "lo", "hi").count() == len(expected)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_overlap_pairs_against_brute_force(spark, monkeypatch, seed):
    """A hot key, equal starts, equal rows, ranges over everything, NULL keys and bounds, small blocks."""
    monkeypatch.setattr(c, "BLOCK", 4)
    monkeypatch.setattr(c, "WIDE", 3)
    rng = random.Random(seed)
    data = []
    for i in range(250):
        lo = rng.choice([5, 5, rng.randint(0, 300)])
        hi = rng.choice([lo, lo + 3, lo + 40, 1000 if rng.random() < 0.05 else lo + 1])
        data.append((i // 2, rng.choice(["hot", "hot", "k1", None]), rng.choice([lo, lo, lo, None]), hi))
    df = spark.createDataFrame(data, "i int, k string, lo int, hi int")
    live = [x for x in data if x[1] is not None and x[2] is not None and x[2] < x[3]]
    expected = []
    for n, x in enumerate(live):
        for y in live[n + 1:]:
            if x[1] == y[1] and x[2] < y[3] and y[2] < x[3]:
                a, b = sorted((x, y), key=lambda r: (r[2], r[0], r[3]))
                expected.append((a[1], a[0], a[3], b[0], b[3]))
    out = c.overlap_pairs(df, ["k"], "lo", "hi", ["i", "hi"], ["i", "hi"])
    assert out.columns == ["k", "first_i", "first_hi", "second_i", "second_hi"]
    assert rows(out) == sorted(expected)
    assert c.overlap_ranks(df, ["k"], "lo", "hi").agg(F.sum(F.expr("_end - _rank - 1"))).first()[0] == len(expected)
    late = c.overlap_pairs(df, ["k"], "lo", "hi", ["i"], ["i"]).select("second_i", "k").distinct()
    assert late.count() == c.exclusion_violations(df, ["k"], "lo", "hi", ["i", "hi"]).select("i", "k").distinct().count()
    assert c.overlap_pairs(df.where("i < 0"), ["k"], "lo", "hi", ["i"]).isEmpty()
    with pytest.raises(m.QueryError):
        c.overlap_pairs(df, ["k"], "lo", "hi", ["zz"])


def test_overlapping_rows_go_to_few_blocks(spark):
    """Rows that all overlap are sent to blocks in proportion to the rows, not to the pairs."""
    n = 3_000
    df = spark.range(n).selectExpr("id", "'k' AS k", "id % 7 AS lo", "100 + id AS hi")
    ranked = c.overlap_ranks(df, ["k"], "lo", "hi", ["id"])
    sent = c.to_blocks(ranked, [F.col("id")], c.block_size(ranked))
    assert sent.count() <= 6 * n
    out = c.overlap_pairs(df, ["k"], "lo", "hi", ["id"], ["id"])
    assert out.count() == out.distinct().count() == n * (n - 1) // 2
    assert out.where("(second_id % 7, second_id) <= (first_id % 7, first_id)").isEmpty()
    few = df.where("id < 100").withColumn("hi", F.expr("lo + 1"))
    assert c.block_size(c.overlap_ranks(few, ["k"], "lo", "hi", ["id"])) == c.BLOCK
    assert c.block_size(c.overlap_ranks(few.where("id < 0"), ["k"], "lo", "hi", ["id"])) == c.BLOCK


def action(name, update=False):
    return m.ForeignKey("fk", ["parent_id"], "parent", ["id"], **({"on_update": name} if update else {"on_delete": name}))


def test_delete_actions(spark, parent, child):
    doomed = spark.createDataFrame([(1,), (7,)], "id int")
    for name in (m.NO_ACTION, m.RESTRICT):
        with pytest.raises(m.DdlError):
            r.apply_delete(parent, child, action(name), doomed)
        out = r.apply_delete(parent, child, action(name), doomed, on_blocked="report")
        assert rows(out.blocked) == [(10, 1), (11, 1)]
        assert out.parent.count() == 3
    free = r.apply_delete(parent, child, action(m.NO_ACTION), spark.createDataFrame([(3,)], "id int"))
    assert free.parent.count() == 2
    gone = r.apply_delete(parent, child, action(m.CASCADE), doomed)
    assert [x.id for x in gone.parent.orderBy("id").collect()] == [2, 3]
    assert sorted(x.id for x in gone.child.collect()) == [12, 13, 14]
    nulls = r.apply_delete(parent, child, action(m.SET_NULL), doomed).child
    assert {x.id: x.parent_id for x in nulls.collect()} == {10: None, 11: None, 12: 2, 13: None, 14: 9}
    moved = r.apply_delete(parent, child, action(m.SET_DEFAULT), doomed, {"parent_id": "3"}).child
    assert {x.id: x.parent_id for x in moved.collect()}[10] == 3
    with pytest.raises(m.DdlError):  # the default itself has no parent
        r.apply_delete(parent, child, action(m.SET_DEFAULT), doomed, {"parent_id": "77"})


def test_key_update_actions(spark, parent, child):
    mapping = spark.createDataFrame([(1, 100), (2, 2)], "old_id int, new_id int")
    out = r.apply_key_update(parent, child, action(m.CASCADE, True), mapping)
    assert sorted(x.id for x in out.parent.collect()) == [2, 3, 100]
    assert {x.id: x.parent_id for x in out.child.collect()} == {10: 100, 11: 100, 12: 2, 13: None, 14: 9}
    nulls = r.apply_key_update(parent, child, action(m.SET_NULL, True), mapping).child
    assert {x.id: x.parent_id for x in nulls.collect()}[10] is None
    with pytest.raises(m.DdlError):
        r.apply_key_update(parent, child, action(m.RESTRICT, True), mapping)
    with pytest.raises(m.QueryError):
        r.apply_key_update(parent, child, action(m.CASCADE, True), mapping.union(mapping))
    with pytest.raises(m.DdlError):
        r.apply_key_update(parent, child, action(m.SET_DEFAULT, True), mapping, {"parent_id": "1"})


def test_cascade_over_a_cycle(spark):
    people = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 3), (5, None), (6, 5)], "id int, boss int")
    gone = r.cascade_closure({"people": people}, [r.Link("people", ["boss"], "people", ["id"])], "people",
                             spark.createDataFrame([(2,)], "id int"), {"people": ["id"]})
    assert sorted(x.id for x in gone["people"].collect()) == [2, 3, 4]
    with pytest.raises(m.QueryError):
        r.cascade_closure({}, [], "people", people, {})


def test_cascade_with_an_action_for_each_key(spark):
    """One row is reached by two keys, one key writes a column first, a cycle is cut by SET NULL."""
    a = spark.createDataFrame([(1, 3), (2, None), (3, 1)], "id int, c int")
    b = spark.createDataFrame([(10, 1, 1), (11, 1, 2), (12, 2, 1), (13, None, 2), (14, 9, None)], "id int, a1 int, a2 int")
    tables, keys = {"a": a, "b": b}, {"a": ["id"], "b": ["id"]}

    def fk(name, column, action, to="a"):
        return m.ForeignKey(name, [column], to, ["id"], on_delete=action)

    def run(doomed, *of_b, of_a=(), **more):
        return r.cascade_delete(tables, {"b": of_b, "a": of_a}, "a", a.where(doomed), keys, **more)

    out = run("id = 1", fk("f1", "a1", m.CASCADE), fk("f2", "a2", m.SET_NULL))
    assert set(rows(out.tables["b"].where("id < 13"))) == {(12, 2, None)} and rows(out.deleted["b"]) == [(10, 1, 1), (11, 1, 2)]
    assert rows(out.changed["b"]) == [(12, 2, None)] and out.tables["b"].count() == 3 and not out.blocked
    out = run("id = 1", fk("f1", "a1", m.SET_DEFAULT), fk("f2", "a1", m.SET_NULL), defaults={"f1": {"a1": "2"}})
    assert {x.id: x.a1 for x in out.tables["b"].collect()} == {10: 2, 11: 2, 12: 2, 13: None, 14: 9}
    out = run("id = 1", fk("f1", "a1", m.SET_DEFAULT), defaults={"f1": {"a1": "1"}}, on_blocked="report")
    assert sorted(x.id for x in out.blocked["f1"].collect()) == [10, 11] and out.tables["b"].count() == 5 and out.tables["a"].count() == 3
    with pytest.raises(m.DdlError, match="f1"):
        run("id = 1", fk("f1", "a1", m.NO_ACTION))
    # A row that goes by another key does not block NO ACTION, but it blocks RESTRICT.
    only = b.where("id = 10")
    for action, names in ((m.NO_ACTION, set()), (m.RESTRICT, {"f2"})):
        out = r.cascade_delete({"a": a, "b": only}, {"b": [fk("f1", "a1", m.CASCADE), fk("f2", "a2", action)]}, "a", a.where("id = 1"), keys, on_blocked="report")
        assert set(out.blocked) == names
    out = run("id = 3", of_a=[fk("f0", "c", m.CASCADE)])
    assert sorted(x.id for x in out.deleted["a"].collect()) == [1, 3] and [x.id for x in out.tables["a"].collect()] == [2]
    out = run("id = 3", of_a=[fk("f0", "c", m.SET_NULL)])
    assert {x.id: x.c for x in out.tables["a"].collect()} == {1: None, 2: None}
    assert run("id = 77", fk("f1", "a1", m.RESTRICT)).tables["a"].count() == 3
    with pytest.raises(m.QueryError):
        r.cascade_delete(tables, {"b": [fk("f1", "id", m.SET_NULL)], "a": [fk("f0", "c", m.CASCADE, "b")]}, "a", a, keys)
    with pytest.raises(m.QueryError):
        run("id = 1", fk("f1", "a1", m.CASCADE, "zz"))


def brute_keys(table, names, widest):
    solid = [i for i in range(len(names)) if all(r[i] is not None for r in table)]
    found = []
    for width in range(1, widest + 1):
        for s in combinations(solid, width):
            if not any(set(f) <= set(s) for f in found) and len({tuple(r[i] for i in s) for r in table}) == len(table):
                found.append(s)
    return sorted((",".join(names[i] for i in s), len(s)) for s in found)


@pytest.mark.parametrize("domains, count", [((400, 20, 20, 400, 2, 60), 2_000), ((5, 60, 40, 9, 2, 3), 200), ((9, 9, 9, 9, 9, 9), 1), ((9, 9, 9, 9, 9, 9), 0)])
def test_keys_of_any_width_equal_brute_force(spark, domains, count):
    rnd = random.Random(count)
    table = [(*(rnd.randrange(d) for d in domains), rnd.choice([None, 1])) for _ in range(count)]
    names = ["a", "b", "set", "h", "c0", "n", "gaps"]
    df = spark.createDataFrame(table, ", ".join(f"`{n}` int" for n in names))
    assert rows(k.discover_keys(df, 4)) == brute_keys(table, names, 4)


def brute_inclusions(tables, families, widest, ratio):
    def values(t, columns):
        names = list(families[t])
        at = [names.index(c) for c in columns]
        return {tuple(r[i] for i in at) for r in tables[t] if all(r[i] is not None for i in at)}

    out = []
    for t, u in product(tables, tables):
        for width in range(1, widest + 1):
            for cs, rs in product(combinations(sorted(families[t]), width), permutations(sorted(families[u]), width)):
                if any(families[t][c] != families[u][r] or (t, c) == (u, r) for c, r in zip(cs, rs)):
                    continue
                own, other = values(t, cs), values(u, rs)
                if own & other and len(own & other) >= ratio * len(own):
                    out.append((",".join(f"{t}.{c}" for c in cs), ",".join(f"{u}.{r}" for r in rs), width, len(own), len(own & other), len(own & other) / len(own)))
    return sorted(out)


@pytest.mark.parametrize("widest, ratio", [(3, 1.0), (2, 0.6), (2, 0.01)])
def test_inclusions_equal_brute_force(spark, widest, ratio):
    """NULLs, an empty table, a column without values, repeated rows and clashing names."""
    rnd = random.Random(11)
    families = {"big": {"value": "bigint", "n": "int", "w0": "string", "day": "date"}, "part": {"value": "int", "n": "smallint", "w0": "string", "day": "date"},
                "none": {"n": "int"}, "gaps": {"value": "int", "n": "int"}}
    day = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(9)]
    big = [(rnd.randrange(60), rnd.choice([None, 1, 2, 3]), rnd.choice(["a", "b", "1", ""]), rnd.choice(day)) for _ in range(300)]
    tables = {"big": big, "part": [x for x in big if x[0] < 20] * 2 + [(3, None, "zz", day[0])] * (ratio < 1), "none": [], "gaps": [(None, 2), (None, 50)]}
    frames = {t: spark.createDataFrame(tables[t], ", ".join(f"{c} {kind}" for c, kind in families[t].items())) for t in tables}
    kinds = {t: {c: "integer" if kind.endswith("int") else kind for c, kind in f.items()} for t, f in families.items()}
    expected = brute_inclusions(tables, kinds, widest, ratio)
    assert len(expected) > 10 and rows(k.discover_inclusions(frames, widest, ratio)) == expected
    only = rows(k.discover_inclusions(frames, 1, ratio, {"big": ["value"]}))
    assert only == [x for x in expected if x[1] == "big.value"]


def test_inclusions_need_a_ratio(spark):
    for tables, ratio in (({}, 1.0), ({"a": spark.range(1)}, 0.0), ({"a": spark.range(1)}, 1.5)):
        with pytest.raises(m.QueryError):
            k.discover_inclusions(tables, 1, ratio)


def test_keys_of_odd_values(spark):
    twice = spark.createDataFrame([(1, "x"), (2, "y"), (1, "x")], "a int, b string")
    assert rows(k.discover_keys(twice, 2)) == []
    floats = spark.sql("SELECT * FROM VALUES (0.0D, 1), (double('-0.0'), 2), (double('NaN'), 1), (double('NaN'), 2) AS t(f, n)")
    assert rows(k.discover_keys(floats, 2)) == [("f,n", 2)]


def test_a_partition_is_the_table_of_all_supersets(spark, monkeypatch):
    """Of 20,000 rows only those that share their pair with another one are read for wider sets."""
    df = spark.range(20_000).selectExpr("id DIV 2 * 2 + IF(id < 19900, id % 2, 0) AS a", "id % 7 AS b", "IF(id < 19900, 0, id % 2) AS c")
    kept = []
    monkeypatch.setattr(discovery, "_keyed", lambda r, s, p, keyed=discovery._keyed: kept.append((bool(p), r.count())) or keyed(r, s, p))
    assert rows(k.discover_keys(df, 3)) == [("a,b", 2), ("a,c", 2)]
    assert [n for refined, n in kept if refined] == [100]


def test_only_sets_without_many_witnesses_read_the_table(spark, monkeypatch):
    """A fifth of the rows share ``a``: some of them show it, and only the pair is judged over all 40,000 rows."""
    df = spark.range(40_000).selectExpr("id % 36000 AS a", "id DIV 36000 AS b", "id % 5 AS c")
    whole = []
    monkeypatch.setattr(discovery, "_keyed", lambda r, s, p, keyed=discovery._keyed: whole.append((r.count(), list(s.values()))) or keyed(r, s, p))
    assert rows(k.discover_keys(df, 2)) == [("a,b", 2)]
    assert [s for n, s in whole if n == 40_000] == [[frozenset({0, 1})]]


def test_rows_in_doubt_beyond_the_broadcast_are_joined(spark, monkeypatch):
    df = spark.range(20_000).selectExpr("IF(id < 20, 0, id) AS a", "IF(id % 1000 < 2, id DIV 1000, id + 100) AS b", "id % 1000 AS c")
    expected = rows(k.discover_keys(df, 3))
    monkeypatch.setattr(discovery, "BROADCAST_REPEATS", 25)
    assert rows(k.discover_keys(df, 3)) == expected == [("a,c", 2), ("b,c", 2)]


def test_discovery(spark, parent, child):
    assert rows(k.discover_keys(parent.withColumn("dup", F.lit(1)))) == [("id", 1), ("name", 1)]
    pairs = spark.createDataFrame([(1, 1, None), (1, 2, 5), (2, 1, 6)], "a int, b int, n int")
    assert rows(k.discover_keys(pairs)) == [("a,b", 2)]
    found = k.discover_foreign_keys({"child": child.where("id < 14"), "parent": parent}, {"parent": "id"}, {"child": ["parent_id"]})
    assert rows(found) == [("child.parent_id", "parent.id", 2)]


def test_columns_out_of_range_move_no_values(spark, monkeypatch):
    shared = []
    monkeypatch.setattr(discovery, "_shared", lambda t, pairs, own=discovery._shared: shared.append(pairs) or own(t, pairs))
    tables = {"p": spark.range(10).selectExpr("id", "'x' AS name"), "c": spark.range(5).selectExpr("id AS p_id", "id + 100 AS far", "1.5D AS ratio")}
    assert rows(k.discover_foreign_keys(tables, {"p": "id"})) == [("c.p_id", "p.id", 5)]
    assert {i.label() for pairs in shared for pair in pairs for i in pair} == {"c.p_id", "p.id"}


def test_identity(spark):
    df = spark.createDataFrame([("c", None), ("a", 4), ("b", None)], "name string, id int")
    out = {x.name: x.id for x in k.assign_identity(df, "id", ["name"], m.Identity("by_default", 1, 3)).collect()}
    assert out == {"a": 4, "b": 7, "c": 10}
    with pytest.raises(m.DdlError):
        k.assign_identity(df, "id", ["name"], m.Identity("always"))
    down = k.assign_identity(df.drop("id"), "id", ["name"], m.Identity("always", 10, -2))
    assert {x.name: x.id for x in down.collect()} == {"a": 10, "b": 8, "c": 6}
    with pytest.raises(m.DdlError):
        m.Identity("sometimes")


@pytest.mark.parametrize("seq, expected", [
    (m.SequenceDef(3, 2, 1, 6, True), [3, 5, 1, 3, 5, 1]), (m.SequenceDef(2, -2, -3, 4, True), [2, 0, -2, 4, 2, 0]),
    (m.SequenceDef(1, 1, 1, 2**63 - 1, False), [1, 2, 3, 4, 5, 6]), (m.SequenceDef(0, 1, -2**63, 2**63 - 1, True), [0, 1, 2, 3, 4, 5])])
def test_sequences(spark, seq, expected):
    assert [x.value for x in k.sequence_values(spark, 6, seq).orderBy("draw").collect()] == expected


def test_sequence_end_is_an_error(spark):
    with pytest.raises(Exception, match="reached its end"):
        k.sequence_values(spark, 3, m.SequenceDef(1, 1, 1, 2)).collect()
    with pytest.raises(m.DdlError):
        m.SequenceDef(5, 1, 6, 9)


def test_clustered_and_bucketed_layout(spark, tmp_path):
    df = spark.range(0, 2000).select((F.col("id") % 10).alias("k"), "id")
    path = f"{tmp_path}/ix"
    k.clustered_write(df, path, ["k", "id"], [True])
    back = spark.read.parquet(path).withColumn("f", F.input_file_name())
    spans = back.groupBy("f").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("lo").collect()
    assert sum(1 for a, b in zip(spans, spans[1:]) if a.hi > b.lo) == 0
    with pytest.raises(m.DdlError):
        k.clustered_write(df, f"{tmp_path}/u", ["k"], unique=True)
    k.bucketed_write(df, "bucketed_rows", ["k"], 4)
    joined = spark.table("bucketed_rows").join(spark.table("bucketed_rows").withColumnRenamed("id", "id2").hint("merge"), "k")
    assert "Exchange hashpartitioning(k" not in joined._jdf.queryExecution().executedPlan().toString()


def test_report_and_profile(spark, parent, child):
    report = constraint_report({"child": child, "parent": parent}, {"child": [
        m.PrimaryKey(["id"]), m.ForeignKey("fk", ["parent_id"], "parent", ["id"]), m.NotNull(["parent_id"]), m.CheckRule("c", "id > 10")]})
    assert {x.constraint_name: (x.checked, x.violations) for x in report.collect()} == {
        "primary_key": (5, 0), "fk": (5, 1), "not_null": (5, 1), "c": (5, 1)}
    line = {x.column_name: x for x in profile.profile_table(child).collect()}["parent_id"]
    assert (line.nulls, line.min_value, line.max_value, line.distinct_values, line.type) == (1, "1", "9", 3, "int")


def test_definitions_are_checked():
    with pytest.raises(m.DdlError):
        m.ForeignKey("f", ["a"], "t", ["x", "y"])
    with pytest.raises(m.DdlError):
        m.ForeignKey("f", ["a"], "t", ["x"], on_delete="EXPLODE")


def test_star_references_reach_lineitem(spark, sf):
    import __spark_entry__ as entry

    found = {(r.col_name, r.ref_name) for r in entry.queries()["discover_foreign_keys_star"](spark, sf).collect()}
    assert {("lineitem.l_orderkey", "orders.o_orderkey"), ("lineitem.l_partkey", "part.p_partkey"), ("lineitem.l_suppkey", "supplier.s_suppkey"),
            ("orders.o_custkey", "customer.c_custkey"), ("nation.n_regionkey", "region.r_regionkey")} <= found
