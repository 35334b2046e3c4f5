import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from tablebridge.functions import floats, text, values as v
from tablebridge.model import QueryError, UnsupportedError


def one(df, column):
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize("sql, expected", [
    ("1.0D", "1"), ("double('-0.0')", "-0"), ("1.0E7D", "10000000"), ("1.5E-5D", "0.000015"),
    ("1.2345E10D", "12345000000"), ("1234567890.125D", "1234567890.125"), ("double('NaN')", "NaN"), ("double('Infinity')", "inf"),
    ("double('-Infinity')", "-inf"), ("1.0E300D", "1" + "0" * 300), ("0.1F", "0.1"), ("-2.5E-4F", "-0.00025"), ("NULL", None)])
def test_float_text(spark, sql, expected):
    df = spark.sql(f"SELECT {sql} AS f")
    assert one(df, text.float_text(F.col("f").cast("double") if sql == "NULL" else F.col("f"))) == expected


@pytest.mark.parametrize("stamp, expected", [
    ("2026-07-17 12:00:00", "2026-07-17 12:00:00"), ("2026-07-17 12:00:00.12", "2026-07-17 12:00:00.120"),
    ("2026-07-17 12:00:00.120001", "2026-07-17 12:00:00.120001"), ("2026-07-17 12:00:00.1234", "2026-07-17 12:00:00.123400")])
def test_fraction_digits(spark, stamp, expected):
    df = spark.sql(f"SELECT TIMESTAMP_NTZ'{stamp}' AS n, TIMESTAMP'{stamp}Z' AS z")
    assert one(df, text.plain_text(F.col("n"), T.TimestampNTZType())) == expected
    assert one(df, text.plain_text(F.col("z"), T.TimestampType())) == expected + "+00:00"


def test_instants_do_not_depend_on_the_session_zone(spark):
    df = spark.sql("SELECT TIMESTAMP'1965-03-04 05:06:07.5Z' AS z")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(df, text.plain_text(F.col("z"), T.TimestampType())) == "1965-03-04 05:06:07.500+00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_copy_line_of_a_mixed_row(spark):
    df = spark.sql(r"""SELECT 9223372036854775807 AS a, concat('tab', chr(9), 'here ', chr(92), ' end', chr(10), chr(13)) AS b, 12345.67BD AS c, true AS d,
        TIMESTAMP'2026-07-17 12:00:00Z' AS e, DATE'2026-07-17' AS f, CAST(NULL AS STRING) AS g, array('vip', NULL, 'a,b{c}') AS i, X'DEADBEEF' AS j""")
    assert one(df, text.copy_line(df)) == (
        "9223372036854775807\ttab\\there \\\\ end\\n\\r\t12345.67\tt\t2026-07-17 12:00:00+00:00\t2026-07-17\t\\N\t"
        '{"vip",NULL,"a,b{c}"}\t\\\\xdeadbeef')


def test_array_literals(spark):
    df = spark.sql(r"""SELECT array(array('a"b', NULL), array(), NULL) AS n, CAST(array() AS ARRAY<STRING>) AS e, CAST(NULL AS ARRAY<STRING>) AS z,
        array(chr(92)) AS s, array(1.0D, double('-0.0')) AS f, array(X'0A') AS b""")
    t = {f.name: f.dataType for f in df.schema.fields}
    assert one(df, text.array_literal(F.col("n"), t["n"])) == '{{"a\\"b",NULL},{},NULL}'
    assert one(df, text.array_literal(F.col("e"), t["e"])) == "{}"
    assert one(df, text.array_literal(F.col("z"), t["z"])) is None
    assert one(df, text.array_literal(F.col("s"), t["s"])) == '{"\\\\"}'
    assert one(df, text.array_literal(F.col("f"), t["f"])) == '{"1","-0"}'
    assert one(df, text.array_literal(F.col("b"), t["b"])) == '{"\\\\x0a"}'
    with pytest.raises(UnsupportedError):
        text.array_literal(F.lit("x"), T.StringType())


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="ab\\\t\n\r,é", max_size=12), min_size=1, max_size=8))
def test_escaping_is_reversible(spark, words):
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string")
    back = {"\\\\": "\\", "\\t": "\t", "\\n": "\n", "\\r": "\r"}
    for r in df.select("i", text.escape_copy(F.col("w")).alias("e")).collect():
        assert not set("\t\n\r") & set(r.e)
        out, i = "", 0
        while i < len(r.e):
            step = 2 if r.e[i] == "\\" else 1
            out += back.get(r.e[i:i + step], r.e[i:i + step])
            i += step
        assert out == words[r.i]


def test_canonicalize_errors_rather_than_nulls(spark):
    good = spark.sql("SELECT 7L AS i, '12' AS s, 2S AS b, CAST(NULL AS STRING) AS n")
    assert v.canonicalize(good, "i int, s int, b boolean, n int").first() == (7, 12, True, None)
    for sql, schema in (("3000000000L AS i", "i int"), ("'x' AS i", "i int"), ("1.5D AS i", "i int"), ("1.239BD AS i", "i decimal(4,2)"),
                        ("array(1L, 3000000000L) AS i", "i array<int>")):
        with pytest.raises(Exception, match="does not fit"):
            v.canonicalize(spark.sql(f"SELECT {sql}"), schema).collect()
    with pytest.raises(QueryError):
        v.canonicalize(good, "zz int")


def test_unsigned_extremes(spark):
    df = spark.sql("SELECT 255S AS a, 65535 AS b, 4294967295L AS c, CAST('18446744073709551615' AS DECIMAL(20,0)) AS d")
    out = v.widen_unsigned(df, {"a": "u8", "b": "u16", "c": "u32", "d": "u64"})
    assert [t for _, t in out.dtypes] == ["smallint", "int", "bigint", "decimal(20,0)"]
    assert out.first() == (255, 65535, 4294967295, Decimal(18446744073709551615))
    with pytest.raises(Exception, match="does not fit u8"):
        v.widen_unsigned(spark.sql("SELECT 256 AS a"), {"a": "u8"}).collect()
    with pytest.raises(QueryError):
        v.widen_unsigned(df, {"a": "u7"})
    assert v.unsigned_audit(spark.sql("SELECT explode(array(-1, 256, 3)) AS a"), {"a": "u8"}).first() == ("a", "u8", 1, 1)


def test_bits(spark):
    df = spark.sql("SELECT X'A50F' AS b, CAST(NULL AS BINARY) AS n, X'' AS e")
    assert one(df, v.bits_to_text(F.col("b"))) == "1010010100001111"
    assert one(df, v.bits_to_text(F.col("b"), 5)) == "01111"
    assert one(df, v.bits_to_text(F.col("n"))) is None
    assert one(df, v.bits_to_text(F.col("e"))) == ""


def test_uuid_forms(spark):
    plain = "0123abcd-0123-0123-0123-0123456789ab"
    for given_text, expected in ((plain.upper(), plain), ("{" + plain + "}", plain), ("urn:uuid:" + plain, plain), (plain.replace("-", ""), plain),
                                 (plain[:-1], None), ("g" + plain[1:], None)):
        assert one(spark.createDataFrame([(given_text,)], "u string"), v.normalize_uuid(F.col("u"))) == expected


def test_json_forms(spark):
    df = spark.createDataFrame([('{"b": 1, "a": [true, null]}',)], "j string")
    assert one(df, v.normalize_json(F.col("j"), True)) == '{"a":[true,null],"b":1}'
    assert one(df, v.normalize_json(F.col("j"), False)) == '{"b": 1, "a": [true, null]}'
    bad = spark.createDataFrame([("{oops",)], "j string")
    assert one(bad, v.normalize_json(F.col("j"), True, strict=False)) is None
    with pytest.raises(Exception):
        bad.select(v.normalize_json(F.col("j"), True)).collect()


def test_decode_arrays(spark):
    df = spark.sql("SELECT array('1', NULL) AS a, CAST(NULL AS ARRAY<STRING>) AS n, CAST(array() AS ARRAY<STRING>) AS e")
    t = df.schema["a"].dataType
    assert df.select(*[v.decode_array(F.col(c), t, T.IntegerType()) for c in "ane"]).first() == ([1, None], None, [])
    with pytest.raises(UnsupportedError):
        v.decode_array(F.col("a"), T.StringType(), T.IntegerType())
    with pytest.raises(UnsupportedError):
        v.decode_array(F.col("a"), t, T.StructType())


def test_text_or_bytes(spark):
    df = spark.sql("SELECT X'FF41' AS bad, X'41' AS good, CAST(NULL AS BINARY) AS n")
    out = df.select(*[v.text_or_bytes(F.col(c)).alias(c) for c in df.columns]).first()
    assert (out.bad.text, bytes(out.bad.bytes)) == (None, b"\xffA")
    assert (out.good.text, out.good.bytes) == ("A", None)
    assert (out.n.text, out.n.bytes) == (None, None)


def test_float_bits(spark):
    df = spark.sql("SELECT explode(array(0.0D, double('-0.0'), 1.0D)) AS d, 1.0F AS f")
    rows = floats.float_bits(df, ["d", "f"]).collect()
    assert [r.d_bits for r in rows] == [0, -2**63, 4607182418800017408]
    assert {r.f_bits for r in rows} == {1065353216}


def test_split_timestamps_keeps_wall_clocks(spark):
    df = spark.sql("SELECT TIMESTAMP'2024-06-01 10:00:00+02:00' AS z, TIMESTAMP_NTZ'2024-06-01 10:00:00' AS n")
    out = v.split_timestamps(df)
    assert [t for _, t in out.dtypes] == ["timestamp_ntz", "timestamp_ntz"]
    assert out.first() == (dt.datetime(2024, 6, 1, 8), dt.datetime(2024, 6, 1, 10))
