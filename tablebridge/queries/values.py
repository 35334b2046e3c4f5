"""Value normalisation over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from tablebridge.functions import values as v
from tablebridge.queries.registry import query, table


@query("canonicalize", """
SELECT l_orderkey, CAST(l_linenumber AS SMALLINT) AS l_linenumber, CAST(nullif(l_quantity, 7) AS INTEGER) AS l_quantity,
 CAST(l_extendedprice AS DECIMAL(15,2)) AS l_extendedprice, l_discount <> 0 AS l_discount, CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem""")
def canonical(spark, d):
    lines = table(spark, d, "lineitem").withColumn("l_quantity", F.nullif("l_quantity", F.lit(7.0)))
    return v.canonicalize(lines, "l_orderkey bigint, l_linenumber smallint, l_quantity int, l_extendedprice decimal(15,2), l_discount boolean, l_shipdate date")


@query("widen_unsigned", """
SELECT CAST(p_size AS SMALLINT) AS p_size, CAST(p_partkey AS DECIMAL(20,0)) + 18446744073000000000 AS p_partkey, CAST(p_partkey AS BIGINT) AS k32, 1990 + p_size AS made FROM part""")
def widen(spark, d):
    part = table(spark, d, "part").select(
        "p_size", (F.col("p_partkey").cast("decimal(20,0)") + F.lit("18446744073000000000").cast("decimal(20,0)")).cast("decimal(20,0)").alias("p_partkey"),
        F.col("p_partkey").alias("k32"), (F.lit(1990) + F.col("p_size")).cast("smallint").alias("made"))
    return v.widen_unsigned(part, {"p_size": "u8", "p_partkey": "u64", "k32": "u32", "made": "year"})


@query("unsigned_audit", """
SELECT 'user_id' AS column_name, 'u8' AS width, count(*) FILTER (user_id < 0) AS negative, count(*) FILTER (user_id > 255) AS too_large FROM events
UNION ALL SELECT 'shifted', 'u16', count(*) FILTER (event_id - 500 < 0), count(*) FILTER (event_id - 500 > 65535) FROM events""")
def audit(spark, d):
    events = table(spark, d, "events").select("user_id", (F.col("event_id") - 500).alias("shifted"))
    return v.unsigned_audit(events, {"user_id": "u8", "shifted": "u16"})


@query("bits_to_text", """
SELECT c_custkey, to_binary(nullif(c_mktsegment, 'BUILDING')) AS bits, right(to_binary(c_name), 5) AS last_five FROM customer""")
def bits(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey", v.bits_to_text(F.encode(F.nullif("c_mktsegment", F.lit("BUILDING")), "UTF-8")).alias("bits"),
        v.bits_to_text(F.encode("c_name", "UTF-8"), 5).alias("last_five"))


@query("split_timestamps", "SELECT o_orderkey, o_orderdate AS wall, o_orderdate - INTERVAL 5 HOUR - INTERVAL 30 MINUTE AS seen FROM orders")
def stamps(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").alias("wall"),
                                              F.to_timestamp(F.concat(F.col("o_orderdate").cast("string"), F.lit("+05:30"))).alias("seen"))
    return v.split_timestamps(orders)


_UUID_SQL = """CASE WHEN event_type = 'view' THEN upper(h) WHEN event_type = 'click' THEN '{' || dashed || '}' WHEN event_type = 'error' THEN 'urn:uuid:' || dashed
 WHEN event_type = 'signup' THEN substr(dashed, 2) ELSE dashed END"""


@query("normalize_uuid", """
WITH h AS (SELECT event_id, event_type, md5(event_id::VARCHAR) AS h FROM events)
SELECT event_id, CASE WHEN event_type <> 'signup' THEN substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21) END AS uuid FROM h""")
def uuids(spark, d):
    h = F.md5(F.col("event_id").cast("string").cast("binary"))
    dashed = F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    raw = (F.when(F.col("event_type") == "view", F.upper(h)).when(F.col("event_type") == "click", F.concat(F.lit("{"), dashed, F.lit("}")))
           .when(F.col("event_type") == "error", F.concat(F.lit("urn:uuid:"), dashed))
           .when(F.col("event_type") == "signup", F.substring(dashed, 2, 40)).otherwise(dashed))
    return table(spark, d, "events").select("event_id", v.normalize_uuid(raw).alias("uuid"))


@query("uuid_rejects", "SELECT event_id, 'x' || event_id AS token FROM events WHERE event_type = 'signup'")
def uuid_bad(spark, d):
    token = F.when(F.col("event_type") == "signup", F.concat(F.lit("x"), F.col("event_id").cast("string"))) \
        .when(F.col("event_type") != "view", F.md5(F.col("props").cast("binary")))
    return v.uuid_rejects(table(spark, d, "events").select("event_id", token.alias("token")), "token")


@query("normalize_json", """
SELECT event_id, '{"a":"' || event_type || '","b":[' || user_id || ',null]}' AS parsed, '{"b": [' || user_id || ', null],  "a": "' || event_type || '"}' AS verbatim,
 CASE WHEN event_type <> 'error' THEN '{"k":1}' END AS lenient FROM events""")
def json(spark, d):
    text = F.concat(F.lit('{"b": ['), F.col("user_id").cast("string"), F.lit(', null],  "a": "'), "event_type", F.lit('"}'))
    shaky = F.when(F.col("event_type") == "error", "{broken").otherwise('{"k": 1}')
    return table(spark, d, "events").select(
        "event_id", v.normalize_json(text, True).alias("parsed"), v.normalize_json(text, False).alias("verbatim"),
        v.normalize_json(shaky, True, strict=False).alias("lenient"))


@query("normalize_json_properties", "SELECT event_id, CAST(props ->> '$.k' AS BIGINT) AS k FROM events")
def json_properties(spark, d):
    parsed = v.normalize_json(F.col("props"), True)
    return table(spark, d, "events").select("event_id", F.get_json_object(parsed, "$.k").cast("bigint").alias("k"))


@query("decode_arrays", """
SELECT event_id, CASE WHEN event_type = 'view' THEN NULL ELSE 3 END AS size, CASE WHEN event_type <> 'view' THEN user_id + event_id END AS total,
 CASE WHEN event_type <> 'view' THEN TRUE END AS null_kept FROM events""")
def array_decode(spark, d):
    events = table(spark, d, "events").select("event_id", F.expr(
        "CASE WHEN event_type <> 'view' THEN array(string(user_id), NULL, string(event_id)) END AS v"))
    decoded = v.decode_array(F.col("v"), events.schema["v"].dataType, T.LongType())
    return events.select("event_id", decoded.alias("v")).select(
        "event_id", F.when(F.col("v").isNotNull(), F.size("v")).cast("bigint").alias("size"),
        (F.element_at("v", 1) + F.element_at("v", 3)).alias("total"),
        F.when(F.col("v").isNotNull(), F.element_at("v", 2).isNull()).alias("null_kept"))


@query("text_or_bytes", """
SELECT doc_id, CASE WHEN lang <> 'fr' THEN text END AS text, CASE WHEN lang = 'fr' THEN hex(encode(text)) || 'FF' END AS bytes FROM documents""")
def text_bytes(spark, d):
    raw = F.when(F.col("lang") == "fr", F.concat(F.encode("text", "UTF-8"), F.unhex(F.lit("FF")))).otherwise(F.encode("text", "UTF-8"))
    return table(spark, d, "documents").select("doc_id", v.text_or_bytes(raw).alias("r")).select("doc_id", "r.text", F.hex("r.bytes").alias("bytes"))


@query("tinyint_to_bool", "SELECT doc_id, quality <> 0 AS quality, nullif(toxic, 1) <> 0 AS toxic FROM labels")
def booleans(spark, d):
    return table(spark, d, "labels").select("doc_id", v.tinyint_to_bool(F.col("quality")).alias("quality"),
                                            v.tinyint_to_bool(F.nullif("toxic", F.lit(1))).alias("toxic"))
