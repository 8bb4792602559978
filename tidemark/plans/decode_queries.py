"""Queries for envelope parsing and decoding: S2, S3, P1-P15."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import decode as DC
from tidemark.plans import derived as D
from tidemark.plans.registry import CHG_EVENTS, CHG_ORDERS, query, with_ctes
from tidemark.session import spread
from tidemark.sources import envelope as EV

# ------------------------------------------------------------------ derived envelopes

EVENT_FIELDS = [
    {"field": "event_id", "type": "int64", "name": None},
    {"field": "ts", "type": "int64", "name": DC.TS_MICRO},
    {"field": "event_type", "type": "string", "name": None},
    {"field": "value", "type": "double", "name": None},
    {"field": "props", "type": "string", "name": DC.JSON_TYPE},
]

ORDER_FIELDS = [
    {"field": "o_orderkey", "type": "int64", "name": None},
    {"field": "o_custkey", "type": "int64", "name": None},
    {"field": "o_orderstatus", "type": "string", "name": None},
    {"field": "o_totalprice", "type": "bytes", "name": DC.DECIMAL, "scale": 2},
    {"field": "price_delta", "type": "bytes", "name": DC.DECIMAL, "scale": 2},
    {"field": "o_orderdate", "type": "int32", "name": DC.DATE},
    {"field": "o_orderpriority", "type": "string", "name": None},
    {"field": "changed_at", "type": "int64", "name": DC.TS_MILLI},
]


def _field_cols(fields):
    return [EV.field_entry(f["field"], f["type"], f.get("name"), True, f.get("scale")) for f in fields]


def events_raw(spark, sf_dir):
    """Raw change events for the events table: one per change (keys wrapped
    in ``payload`` for even users), plus a heartbeat per user and a tombstone
    after every delete -- both of which parsing must drop."""
    ch = spread(D.chg_events(spark, sf_dir))
    image = F.struct(
        F.col("seq").alias("event_id"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"),
        "event_type",
        "value",
        "props",
    )
    topic = F.lit("srv.public.events")
    changes = EV.encode_envelope(
        ch, topic, ["k"], image, _field_cols(EVENT_FIELDS), F.col("op"), F.unix_millis(F.col("ts").cast("timestamp")), F.col("k") % 2 == 0
    )
    beats = (
        ch.groupBy("k")
        .agg(F.max("ts").alias("ts"))
        .select(
            topic.alias("topic"),
            F.to_json(F.struct("k")).alias("key"),
            F.to_json(F.struct(F.struct(F.lit("m").alias("op"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms")).alias("payload"))).alias("value"),
        )
    )
    tombstones = ch.filter(F.col("op") == "d").select(topic.alias("topic"), F.to_json(F.struct("k")).alias("key"), F.lit(None).cast("string").alias("value"))
    return changes.unionByName(beats).unionByName(tombstones)


def orders_raw(spark, sf_dir):
    ch = spread(D.chg_orders(spark, sf_dir))
    image = F.struct(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        DC.decimal_to_base64(F.col("o_totalprice"), 2).alias("o_totalprice"),
        DC.decimal_to_base64(F.col("o_totalprice") - F.lit(250000.0), 2).alias("price_delta"),
        F.datediff(F.col("o_orderdate"), F.lit("1970-01-01").cast("date")).alias("o_orderdate"),
        "o_orderpriority",
        F.unix_millis(F.col("ts").cast("timestamp")).alias("changed_at"),
    )
    return EV.encode_envelope(
        ch.withColumn("seq_key", F.col("seq")),
        F.lit("srv.public.orders"),
        ["o_orderkey", "seq_key"],
        image,
        _field_cols(ORDER_FIELDS),
        F.col("op"),
        F.unix_millis(F.col("ts").cast("timestamp")),
    )


def _decoded_orders(spark, sf_dir):
    parsed = EV.parse_table_changes(orders_raw(spark, sf_dir), ORDER_FIELDS)
    keyed = parsed.withColumn("seq", F.get_json_object("key", "$.seq_key").cast("int"))
    return keyed.select("op", "seq", *[f["field"] for f in ORDER_FIELDS])


# ------------------------------------------------------------------ S2, S3, P1


@query(
    "cdc_parse_envelope",
    with_ctes(CHG_EVENTS)
    + """
SELECT k, op, 'events' AS table_name, CAST(epoch_us(ts) // 1000 AS BIGINT) AS ts_ms, seq AS event_id, ts, event_type, value, props
FROM chg_events
""",
)
def cdc_parse_envelope(spark, sf_dir):
    """Raw events -> change records; heartbeats and tombstones dropped,
    wrapped and bare keys both read, image chosen by operation."""
    parsed = EV.parse_table_changes(events_raw(spark, sf_dir), EVENT_FIELDS)
    return parsed.select(F.get_json_object("key", "$.k").cast("long").alias("k"), "op", "table_name", "ts_ms", *[f["field"] for f in EVENT_FIELDS])


@query(
    "cdc_topic_table",
    """
SELECT 'tbl_' || CAST(user_id % 10 AS VARCHAR) AS table_name, count(*) AS n_events
FROM events WHERE event_type <> 'click'
GROUP BY 1
""",
)
def cdc_topic_table(spark, sf_dir):
    """S3: table name from the topic's last segment; two-segment topics
    (here: click events) are skipped."""
    (ev,) = D.tables(spark, sf_dir, "events")
    table = F.concat(F.lit("tbl_"), (F.col("user_id") % 10).cast("string"))
    topic = F.when(F.col("event_type") == "click", F.concat(F.lit("public."), table)).otherwise(F.concat(F.lit("srv.public."), table))
    routed = ev.select(EV.topic_table(topic).alias("table_name")).filter(F.col("table_name").isNotNull())
    return routed.groupBy("table_name").agg(F.count("*").alias("n_events"))


_ORDER_CATALOG_VALUES = ",\n".join(
    f"('{f['field']}', '{f['type']}', {repr(f['name']) if f['name'] else 'NULL'}, {f.get('scale') if f.get('scale') is not None else 'NULL'})"
    for f in ORDER_FIELDS
)


@query(
    "decode_type_catalog",
    with_ctes(CHG_ORDERS)
    + f"""
SELECT 'orders' AS table_name, f.field, f.type, f.name, TRUE AS optional, CAST(f.scale AS INTEGER) AS scale,
       (SELECT count(*) FROM chg_orders) AS n_events
FROM (VALUES {_ORDER_CATALOG_VALUES}) AS f(field, type, name, scale)
""",
)
def decode_type_catalog(spark, sf_dir):
    """Column types of each table read from the envelopes' schema part."""
    return EV.type_catalog_raw(orders_raw(spark, sf_dir))


# ------------------------------------------------------------------ P2-P5


@query(
    "decode_decimal",
    with_ctes(CHG_ORDERS)
    + """
SELECT o_orderkey, seq, op,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS o_totalprice,
       CAST(CAST(o_totalprice - 250000.0 AS DECIMAL(12,2)) AS VARCHAR) AS price_delta
FROM chg_orders
""",
)
def decode_decimal(spark, sf_dir):
    """base64 two's-complement decimals (positive and negative) decoded
    exactly at the declared scale."""
    dec = _decoded_orders(spark, sf_dir)
    return dec.select(
        "o_orderkey",
        "seq",
        "op",
        F.col("o_totalprice").cast("string").alias("o_totalprice"),
        F.col("price_delta").cast("string").alias("price_delta"),
    )


@query(
    "decode_date",
    with_ctes(CHG_ORDERS)
    + """
SELECT o_orderkey, seq, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, ts AS changed_at
FROM chg_orders
""",
)
def decode_date(spark, sf_dir):
    """P3 (+P4 ms): epoch days -> DATE, epoch millis -> TIMESTAMP_NTZ."""
    dec = _decoded_orders(spark, sf_dir)
    return dec.select("o_orderkey", "seq", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "changed_at")


@query(
    "decode_timestamp",
    """
SELECT event_id, date_trunc('millisecond', ts) AS ts_from_ms, ts AS ts_from_us, ts AS ts_from_ns
FROM events
""",
)
def decode_timestamp(spark, sf_dir):
    """Epoch ms / us / ns -> TIMESTAMP_NTZ (ns truncated to us)."""
    (ev,) = D.tables(spark, sf_dir, "events")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    ns = us * F.lit(1000) + F.pmod(F.col("event_id"), F.lit(1000))
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return ev.select(
        "event_id",
        DC.timestamp_from_epoch(ms, "ms").alias("ts_from_ms"),
        DC.timestamp_from_epoch(us, "us").alias("ts_from_us"),
        DC.timestamp_from_epoch(ns, "ns").alias("ts_from_ns"),
    )


@query(
    "decode_time",
    """
SELECT event_id,
       CASE WHEN (epoch_us(ts) // 1000) % 1000 = 0 THEN strftime(ts, '%H:%M:%S')
            ELSE strftime(ts, '%H:%M:%S') || '.' || lpad(CAST(((epoch_us(ts) // 1000) % 1000) * 1000 AS VARCHAR), 6, '0') END AS time_from_ms,
       CASE WHEN epoch_us(ts) % 1000000 = 0 THEN strftime(ts, '%H:%M:%S') ELSE strftime(ts, '%H:%M:%S.%f') END AS time_from_us,
       CASE WHEN epoch_us(ts) % 1000000 = 0 THEN strftime(ts, '%H:%M:%S') ELSE strftime(ts, '%H:%M:%S.%f') END AS time_from_ns
FROM events
""",
)
def decode_time(spark, sf_dir):
    """P5: time of day from ms / us / ns counts -> ``HH:MM:SS[.ffffff]``."""
    (ev,) = D.tables(spark, sf_dir, "events")
    us = F.pmod(F.unix_micros(F.col("ts").cast("timestamp")), F.lit(DC.MICROS_PER_DAY))
    ms = F.pmod(F.unix_millis(F.col("ts").cast("timestamp")), F.lit(86_400_000))
    ns = us * F.lit(1000) + F.pmod(F.col("event_id"), F.lit(1000))
    return ev.select(
        "event_id",
        DC.time_from_epoch(ms, "ms").alias("time_from_ms"),
        DC.time_from_epoch(us, "us").alias("time_from_us"),
        DC.time_from_epoch(ns, "ns").alias("time_from_ns"),
    )


# ------------------------------------------------------------------ P6-P8

# Zone suffixes given to the events' wall-clock times, by user_id % 3.
_OFFSETS = ["Z", "+05:30", "-03:00"]
_OFFSET_SECONDS = [0, 19800, -10800]


def _zoned_events(spark, sf_dir):
    (ev,) = D.tables(spark, sf_dir, "events")
    r = F.col("user_id") % 3
    suffix = F.when(r == 0, F.lit(_OFFSETS[0])).when(r == 1, F.lit(_OFFSETS[1])).otherwise(F.lit(_OFFSETS[2]))
    iso = F.concat(DC.format_ntz(F.col("ts")), suffix)
    t = F.concat(DC.format_time_of_day(F.pmod(F.unix_micros(F.col("ts").cast("timestamp")), F.lit(DC.MICROS_PER_DAY)), always_fraction=True), suffix)
    return ev.select("event_id", "ts", "event_type", iso.alias("iso_ts"), t.alias("iso_time"))


_ZONED_SQL = """
WITH z AS (
  SELECT event_id, ts, event_type,
         CASE user_id % 3 WHEN 0 THEN 0 WHEN 1 THEN 19800 ELSE -10800 END AS off_s
  FROM events),
j AS (SELECT event_id, ts, event_type, off_s, ts - to_seconds(off_s) + INTERVAL 7 HOUR AS jkt FROM z)
"""


@query(
    "normalize_timestamptz",
    _ZONED_SQL
    + """
SELECT event_id,
       strftime(jkt, '%Y-%m-%dT%H:%M:%S')
       || CASE WHEN epoch_us(jkt) % 1000000 = 0 THEN '' ELSE '.' || strftime(jkt, '%f') END
       || '+07:00' AS ts_jakarta
FROM j
""",
)
def normalize_timestamptz(spark, sf_dir):
    """ISO timestamps with Z / +05:30 / -03:00 -> Asia/Jakarta ISO text."""
    z = _zoned_events(spark, sf_dir)
    return z.select("event_id", DC.normalize_timestamptz(F.col("iso_ts"), "Asia/Jakarta").alias("ts_jakarta"))


@query(
    "normalize_timetz",
    _ZONED_SQL
    + """
SELECT event_id,
       strftime(jkt, '%H:%M:%S')
       || CASE WHEN epoch_us(jkt) % 1000000 = 0 THEN '' ELSE '.' || strftime(jkt, '%f') END
       || '+07:00' AS time_jakarta
FROM j
""",
)
def normalize_timetz(spark, sf_dir):
    """ISO times with offsets -> the same moment at +07:00 (wrapping
    around midnight)."""
    z = _zoned_events(spark, sf_dir)
    return z.select("event_id", DC.normalize_timetz(F.col("iso_time"), "Asia/Jakarta").alias("time_jakarta"))


@query(
    "normalize_untyped_time",
    _ZONED_SQL
    + """
SELECT event_id,
       CASE WHEN event_type = 'view' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
            WHEN event_type IN ('click', 'error') THEN event_type
            ELSE strftime(jkt, '%Y-%m-%dT%H:%M:%S')
                 || CASE WHEN epoch_us(jkt) % 1000000 = 0 THEN '' ELSE '.' || strftime(jkt, '%f') END
                 || '+07:00' END AS normalized
FROM j
""",
)
def normalize_untyped_time(spark, sf_dir):
    """Untyped strings: zoned ISO timestamps converted, zone-less ones
    kept, other text untouched."""
    z = _zoned_events(spark, sf_dir)
    et = F.col("event_type")
    raw = (
        F.when(et == "view", DC.format_ntz(F.col("ts")))
        .when(et.isin("click", "error"), et)
        .otherwise(F.col("iso_ts"))
    )
    return z.select("event_id", DC.normalize_untyped_time(raw, "Asia/Jakarta").alias("normalized"))


# ------------------------------------------------------------------ P9-P12


@query(
    "normalize_json",
    """
WITH raw AS (
  SELECT event_id,
         CASE event_type WHEN 'purchase' THEN props WHEN 'view' THEN event_type
                         WHEN 'click' THEN CAST(user_id AS VARCHAR) WHEN 'error' THEN '{bad ' || props
                         ELSE '[' || CAST(user_id AS VARCHAR) || ', "x"]' END AS v
  FROM events)
SELECT event_id, CASE WHEN json_valid(v) THEN v ELSE CAST(to_json(v) AS VARCHAR) END AS v_json FROM raw
""",
)
def normalize_json(spark, sf_dir):
    """Valid JSON text kept, anything else stored as a JSON string."""
    (ev,) = D.tables(spark, sf_dir, "events")
    et = F.col("event_type")
    raw = (
        F.when(et == "purchase", F.col("props"))
        .when(et == "view", et)
        .when(et == "click", F.col("user_id").cast("string"))
        .when(et == "error", F.concat(F.lit("{bad "), F.col("props")))
        .otherwise(F.concat(F.lit("["), F.col("user_id").cast("string"), F.lit(', "x"]')))
    )
    return ev.select("event_id", DC.normalize_json(raw).alias("v_json"))


@query(
    "array_literal",
    """
SELECT p_partkey,
       '{' || array_to_string(list_transform(string_split(p_name, ' '), lambda x: '"' || replace(x, '"', '\\"') || '"'), ',') || '}' AS name_words,
       '{' || CAST(p_size AS VARCHAR) || ',NULL,' || CAST(p_partkey AS VARCHAR) || '}' AS numbers
FROM part
""",
)
def array_literal(spark, sf_dir):
    """P10: arrays -> PostgreSQL array literals (quoted strings, NULL items)."""
    (p,) = D.tables(spark, sf_dir, "part")
    nums = F.array(F.col("p_size").cast("long"), F.lit(None).cast("long"), F.col("p_partkey"))
    return p.select(
        "p_partkey",
        DC.array_literal(F.split(F.col("p_name"), " "), "string").alias("name_words"),
        DC.array_literal(nums, "long").alias("numbers"),
    )


@query(
    "decode_wkb",
    """
SELECT c_custkey,
       lower('0101000000' || lpad(hex(c_custkey), 16, '0') || lpad(hex(c_nationkey), 16, '0')) AS wkb_hex,
       4326 AS srid
FROM customer
""",
)
def decode_wkb(spark, sf_dir):
    """Geometry struct {wkb (base64), srid} -> lower-case hex WKB + srid."""
    (c,) = D.tables(spark, sf_dir, "customer")
    wkb = F.base64(F.unhex(F.concat(F.lit("0101000000"), F.lpad(F.hex("c_custkey"), 16, "0"), F.lpad(F.hex(F.col("c_nationkey").cast("long")), 16, "0"))))
    geom = F.struct(wkb.alias("wkb"), F.lit(4326).alias("srid"))
    return c.select("c_custkey", geom.alias("g")).select("c_custkey", DC.wkb_hex(F.col("g")).alias("wkb_hex"), F.col("g.srid").alias("srid"))


@query(
    "binary_hex",
    """
SELECT doc_id, md5(lower(hex(encode(text)))) AS hex_md5, octet_length(encode(text)) AS n_bytes FROM documents
""",
)
def binary_hex(spark, sf_dir):
    """Binary -> lower-case hex, over whole document texts (digest kept
    to compare)."""
    (d,) = D.tables(spark, sf_dir, "documents")
    b = F.encode(F.col("text"), "UTF-8")
    return d.select("doc_id", F.md5(DC.binary_hex(b)).alias("hex_md5"), F.octet_length(b).cast("long").alias("n_bytes"))


# ------------------------------------------------------------------ P13-P15

_STRING_ORDERS = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query(
    "infer_numeric_columns",
    """
WITH s AS (SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
                  CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders),
f AS (
  SELECT 'o_orderkey' AS column_name, bool_and(try_cast(trim(o_orderkey) AS DOUBLE) IS NOT NULL) AS all_numeric, bool_or(contains(o_orderkey, '.')) AS has_dot FROM s
  UNION ALL SELECT 'o_orderstatus', bool_and(try_cast(trim(o_orderstatus) AS DOUBLE) IS NOT NULL), bool_or(contains(o_orderstatus, '.')) FROM s
  UNION ALL SELECT 'o_totalprice', bool_and(try_cast(trim(o_totalprice) AS DOUBLE) IS NOT NULL), bool_or(contains(o_totalprice, '.')) FROM s
  UNION ALL SELECT 'o_orderdate', bool_and(try_cast(trim(o_orderdate) AS DOUBLE) IS NOT NULL), bool_or(contains(o_orderdate, '.')) FROM s
  UNION ALL SELECT 'o_orderpriority', bool_and(try_cast(trim(o_orderpriority) AS DOUBLE) IS NOT NULL), bool_or(contains(o_orderpriority, '.')) FROM s)
SELECT column_name, all_numeric, has_dot, all_numeric AND has_dot AS inferred_double FROM f
""",
)
def infer_numeric_columns(spark, sf_dir):
    """A string column becomes numeric only if every non-null value is a
    number and at least one has a decimal point (one aggregation pass)."""
    (o,) = D.tables(spark, sf_dir, "orders")
    s = o.select(*[F.col(c).cast("string").alias(c) for c in _STRING_ORDERS])
    return DC.inference_flags(s, _STRING_ORDERS)


@query(
    "serialize_snapshot",
    """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS price,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') AS o_orderdate,
       strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS order_day,
       strftime(o_orderdate + INTERVAL 7 HOUR, '%Y-%m-%dT%H:%M:%S') || '+07:00' AS order_tz,
       lower(hex(encode(o_orderpriority))) AS priority_bytes
FROM orders
""",
)
def serialize_snapshot(spark, sf_dir):
    """Snapshot rows as text by type: decimal digits, zone-less ISO with
    micros, ISO date, zoned timestamp in the target zone, binary as hex."""
    (o,) = D.tables(spark, sf_dir, "orders")
    typed = o.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
        "o_orderdate",
        F.col("o_orderdate").cast("date").alias("order_day"),
        F.col("o_orderdate").cast("timestamp").alias("order_tz"),
        F.encode("o_orderpriority", "UTF-8").alias("priority_bytes"),
    )
    return DC.serialize_snapshot(typed, "Asia/Jakarta")


@query(
    "cast_to_target",
    """
WITH s AS (
  SELECT event_id,
         CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS value,
         CAST(user_id AS VARCHAR) AS user_id, event_type
  FROM events)
SELECT CAST(event_id AS BIGINT) AS event_id, try_cast(value AS DOUBLE) AS value, try_cast(user_id AS INTEGER) AS user_id,
       event_type, CAST(CASE WHEN value IS NOT NULL AND try_cast(value AS DOUBLE) IS NULL THEN 1 ELSE 0 END AS INTEGER) AS cast_errors
FROM s
""",
)
def cast_to_target(spark, sf_dir):
    """Cast every column to the target's type; failures become NULL and
    are counted (the rows to dead-letter)."""
    (ev,) = D.tables(spark, sf_dir, "events")
    s = ev.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("value"),
        F.col("user_id").cast("string").alias("user_id"),
        "event_type",
    )
    target = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("value", T.DoubleType()),
            T.StructField("user_id", T.IntegerType()),
            T.StructField("event_type", T.StringType()),
        ]
    )
    return DC.cast_to_target(s, target)


# ------------------------------------------------------------------ every type at once

LINE_FIELDS = [
    {"field": "line_id", "type": "int64", "name": None},
    {"field": "price", "type": "bytes", "name": DC.DECIMAL, "scale": 2},
    {"field": "discount", "type": "bytes", "name": DC.DECIMAL, "scale": 4},
    {"field": "shipped_on", "type": "int32", "name": DC.DATE},
    {"field": "placed_at", "type": "int64", "name": DC.TS_MICRO},
    {"field": "day_micros", "type": "int64", "name": DC.TIME_MICRO},
    {"field": "slot_tz", "type": "string", "name": DC.ZONED_TIME},
    {"field": "placed_tz", "type": "string", "name": DC.ZONED_TS},
    {"field": "is_urgent", "type": "boolean", "name": None},
    {"field": "quantity", "type": "float", "name": None},
    {"field": "priority_words", "type": "array", "name": None},
    {"field": "flags", "type": "string", "name": DC.JSON_TYPE},
    {"field": "place", "type": "struct", "name": DC.GEOGRAPHY},
]


def lines_raw(spark, sf_dir):
    """The every-type table (line items with their orders) as change
    events, each type encoded the way a change connector writes it."""
    li, o = D.tables(spark, sf_dir, "lineitem", "orders")
    j = spread(li.join(o, li["l_orderkey"] == o["o_orderkey"]), rows=None)
    image = F.struct(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_id"),
        DC.decimal_to_base64(F.col("l_extendedprice"), 2).alias("price"),
        DC.decimal_to_base64(F.col("l_discount"), 4).alias("discount"),
        F.datediff(F.col("l_shipdate"), F.lit("1970-01-01").cast("date")).alias("shipped_on"),
        F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("placed_at"),
        (F.pmod(F.col("l_orderkey"), F.lit(86400)) * F.lit(1_000_000)).alias("day_micros"),
        F.format_string("%02d:30:00Z", F.col("l_linenumber")).alias("slot_tz"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("placed_tz"),
        (F.col("o_orderpriority") == "1-URGENT").alias("is_urgent"),
        F.col("l_quantity").cast("float").alias("quantity"),
        F.split(F.col("o_orderpriority"), "-").alias("priority_words"),
        F.to_json(F.struct("l_returnflag", "l_linestatus")).alias("flags"),
        F.struct(
            F.base64(F.unhex(F.concat(F.lit("0101000000"), F.lpad(F.hex("l_orderkey"), 16, "0"), F.lpad(F.hex(F.col("l_linenumber").cast("long")), 16, "0")))).alias("wkb"),
            F.lit(4326).alias("srid"),
        ).alias("place"),
    )
    return EV.encode_envelope(j, F.lit("srv.public.lines"), ["l_orderkey", "l_linenumber"], image, _field_cols(LINE_FIELDS), F.lit("c"), F.unix_millis(F.col("o_orderdate").cast("timestamp")))


@query(
    "decode_all_types",
    """
SELECT l.l_orderkey * 10 + l.l_linenumber AS line_id,
       CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS price,
       CAST(CAST(l.l_discount AS DECIMAL(5,4)) AS VARCHAR) AS discount,
       strftime(l.l_shipdate, '%Y-%m-%d') AS shipped_on,
       o.o_orderdate AS placed_at,
       strftime(TIMESTAMP '2000-01-01' + to_seconds(l.l_orderkey % 86400), '%H:%M:%S') AS day_micros,
       printf('%02d:30:00+07:00', (l.l_linenumber + 7) % 24) AS slot_tz,
       strftime(o.o_orderdate + INTERVAL 7 HOUR, '%Y-%m-%dT%H:%M:%S') || '+07:00' AS placed_tz,
       o.o_orderpriority = '1-URGENT' AS is_urgent,
       CAST(l.l_quantity AS FLOAT) AS quantity,
       '{' || array_to_string(list_transform(string_split(o.o_orderpriority, '-'), lambda x: '"' || x || '"'), ',') || '}' AS priority_words,
       '{"l_returnflag":"' || l.l_returnflag || '","l_linestatus":"' || l.l_linestatus || '"}' AS flags,
       lower('0101000000' || lpad(hex(l.l_orderkey), 16, '0') || lpad(hex(CAST(l.l_linenumber AS BIGINT)), 16, '0')) AS place
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
""",
)
def decode_all_types(spark, sf_dir):
    """P2-P12 together: a table with every column type, parsed and decoded in
    one pass from its change events (decimals exact at their scales, dates,
    micro timestamps and times, zoned values in Asia/Jakarta, booleans,
    floats, arrays as literals, JSON, WKB geometry as hex)."""
    dec = EV.parse_table_changes(lines_raw(spark, sf_dir), LINE_FIELDS)
    return dec.select(
        "line_id",
        F.col("price").cast("string").alias("price"),
        F.col("discount").cast("string").alias("discount"),
        F.date_format("shipped_on", "yyyy-MM-dd").alias("shipped_on"),
        "placed_at",
        "day_micros",
        "slot_tz",
        "placed_tz",
        "is_urgent",
        "quantity",
        DC.array_literal(F.col("priority_words")).alias("priority_words"),
        "flags",
        "place",
    )
