"""Queries for change application: K1-K7, W1, V3, V4."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import apply as A
from tidemark.plans import derived as D
from tidemark.plans.registry import (
    CHG_EVENTS,
    CHG_ORDERS,
    ORDERS_BATCH,
    ORDERS_STATE,
    query,
    with_ctes,
)

ORDER_COLS_SQL = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

_LATEST_ORDERS_SQL = f"""
latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY ts DESC, seq DESC) AS rn
    FROM orders_batch) WHERE rn = 1)
"""


@query(
    "merge_apply",
    with_ctes(CHG_ORDERS, ORDERS_STATE, ORDERS_BATCH, _LATEST_ORDERS_SQL)
    + f"""
SELECT {ORDER_COLS_SQL} FROM orders_state t
WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.o_orderkey = t.o_orderkey)
UNION ALL
SELECT {ORDER_COLS_SQL} FROM latest WHERE op <> 'd'
""",
)
def merge_apply(spark, sf_dir):
    """Flagship: the orders as of the cutoff with every later change applied."""
    target = D.orders_state(spark, sf_dir)
    batch = D.orders_batch(spark, sf_dir)
    return A.apply_changes(target, batch, ["o_orderkey"])


@query(
    "merge_latest",
    with_ctes(CHG_EVENTS)
    + """
SELECT k, seq, ts, op, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts DESC, seq DESC) AS rn FROM chg_events)
WHERE rn = 1
""",
)
def merge_latest(spark, sf_dir):
    """Latest change per user key (skew-safe aggregate form)."""
    return A.latest_per_key(D.chg_events(spark, sf_dir), ["k"], ["ts", "seq"])


@query(
    "merge_replay_idempotent",
    with_ctes(CHG_ORDERS, ORDERS_STATE, ORDERS_BATCH, _LATEST_ORDERS_SQL)
    + f"""
SELECT {ORDER_COLS_SQL} FROM orders_state t
WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.o_orderkey = t.o_orderkey)
UNION ALL
SELECT {ORDER_COLS_SQL} FROM latest WHERE op <> 'd'
""",
)
def merge_replay_idempotent(spark, sf_dir):
    """V3: applying the same batch twice gives the result of applying it once."""
    target = D.orders_state(spark, sf_dir)
    batch = D.orders_batch(spark, sf_dir)
    once = A.apply_changes(target, batch, ["o_orderkey"])
    return A.apply_changes(once, batch, ["o_orderkey"])


@query(
    "merge_out_of_order",
    with_ctes(CHG_ORDERS)
    + f"""
, target AS (
  SELECT {ORDER_COLS_SQL}, o_orderdate + INTERVAL 1 DAY AS ts FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY ts DESC, seq DESC) AS rn FROM chg_orders)
  WHERE rn = 1),
effective AS (
  SELECT l.* FROM latest l LEFT JOIN target t ON l.o_orderkey = t.o_orderkey
  WHERE t.ts IS NULL OR l.ts > t.ts)
SELECT {ORDER_COLS_SQL}, ts FROM target t
WHERE NOT EXISTS (SELECT 1 FROM effective e WHERE e.o_orderkey = t.o_orderkey)
UNION ALL
SELECT {ORDER_COLS_SQL}, ts FROM effective WHERE op <> 'd'
""",
)
def merge_out_of_order(spark, sf_dir):
    """V4: the whole change log (including versions older than what the target
    already holds) applied to a target that stores each row's change time;
    stale changes are ignored."""
    snap = D.orders_snapshot(spark, sf_dir).withColumn("ts", F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"))
    return A.apply_changes(snap, D.chg_orders(spark, sf_dir), ["o_orderkey"], target_ts_col="ts")


@query(
    "apply_upsert",
    with_ctes(CHG_ORDERS, ORDERS_STATE, ORDERS_BATCH, _LATEST_ORDERS_SQL)
    + f"""
SELECT {ORDER_COLS_SQL} FROM orders_state t
WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.o_orderkey = t.o_orderkey)
UNION ALL
SELECT {ORDER_COLS_SQL} FROM latest
""",
)
def apply_upsert(spark, sf_dir):
    """K1: delete-then-insert by key (operation ignored: every change upserts)."""
    target = D.orders_state(spark, sf_dir)
    batch = D.orders_batch(spark, sf_dir)
    return A.upsert(target, batch, ["o_orderkey"], order=["ts", "seq"])


_LINE_COLS = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"


@query(
    "apply_upsert_composite",
    f"""
WITH target AS (SELECT {_LINE_COLS} FROM lineitem WHERE l_shipdate < TIMESTAMP '1997-01-01'),
batch AS (SELECT {_LINE_COLS} FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-07-01'),
latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
               l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
    FROM batch) WHERE rn = 1)
SELECT {_LINE_COLS} FROM target t
WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.l_orderkey = t.l_orderkey AND l.l_linenumber = t.l_linenumber)
UNION ALL
SELECT {_LINE_COLS} FROM latest
""",
)
def apply_upsert_composite(spark, sf_dir):
    """K1 with a two-column key that is not unique in the input: the batch is
    reduced to its latest row per key (by ship date, then the other columns)
    before it replaces the target rows."""
    (li,) = D.tables(spark, sf_dir, "lineitem")
    cols = [c.strip() for c in _LINE_COLS.split(",")]
    li = li.select(*cols)
    target = li.filter(F.col("l_shipdate") < F.lit("1997-01-01").cast("timestamp_ntz"))
    batch = li.filter(F.col("l_shipdate") >= F.lit("1996-07-01").cast("timestamp_ntz"))
    return A.upsert(target, batch, ["l_orderkey", "l_linenumber"], order=["l_shipdate"])


@query(
    "landing_append",
    with_ctes(CHG_EVENTS)
    + """
SELECT k AS "K", seq AS "SEQ", ts AS "TS", event_type AS "EVENT_TYPE", value AS "VALUE", props AS "PROPS",
       CASE WHEN lower(op) = 'd' THEN 'd' WHEN lower(op) = 'u' THEN 'u' ELSE 'c' END AS "OPERATION",
       TIMESTAMP '2024-01-31 00:00:00' AS "SYNC_TIMESTAMP"
FROM chg_events
""",
)
def landing_append(spark, sf_dir):
    """K2: the rows appended to the landing table for one batch."""
    return A.landing_rows(D.chg_events(spark, sf_dir), "op", "2024-01-31 00:00:00")


_NULLY_EVENTS = """
nully AS (
  SELECT event_id,
         CASE WHEN event_id % 2 = 0 THEN NULL ELSE event_type END AS event_type,
         CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS value,
         CASE WHEN event_id % 3 = 0 THEN NULL ELSE props END AS props
  FROM events)
"""


def _nully_events(spark, sf_dir):
    (ev,) = D.tables(spark, sf_dir, "events")
    i = F.col("event_id")
    return ev.select(
        "event_id",
        F.when(i % 2 == 0, F.lit(None)).otherwise(F.col("event_type")).alias("event_type"),
        F.when(i % 5 == 0, F.lit(None)).otherwise(F.col("value")).alias("value"),
        F.when(i % 3 == 0, F.lit(None)).otherwise(F.col("props")).alias("props"),
    )


@query(
    "drop_all_null_rows",
    with_ctes(_NULLY_EVENTS)
    + """
SELECT event_type, value, props, 'c' AS "OPERATION"
FROM nully WHERE COALESCE(CAST(event_type AS VARCHAR), CAST(value AS VARCHAR), props) IS NOT NULL
""",
)
def drop_all_null_rows(spark, sf_dir):
    """K6: rows whose data columns are all NULL are skipped; the metadata
    column does not count."""
    df = _nully_events(spark, sf_dir).drop("event_id").withColumn("OPERATION", F.lit("c"))
    return A.drop_all_null_rows(df, ignore=["OPERATION"])


@query(
    "merge_coalesce_defaults",
    with_ctes(_NULLY_EVENTS)
    + """
SELECT event_id, COALESCE(event_type, '') AS event_type, COALESCE(value, 0.0) AS value,
       COALESCE(props, '{}') AS props
FROM nully
""",
)
def merge_coalesce_defaults(spark, sf_dir):
    """K4: NOT NULL target columns take their declared default (``value``
    DEFAULT 0, ``props`` DEFAULT '{}') or their type's default (``event_type``
    has none -> '')."""
    df = _nully_events(spark, sf_dir)
    return A.coalesce_defaults(df, {"event_type": None, "value": "0", "props": "{}"})


@query(
    "size_bounded_batches",
    """
WITH RECURSIVE sized AS (
  SELECT lang, doc_id,
         strlen(CAST(to_json(struct_pack(doc_id := doc_id, text := text)) AS VARCHAR)) + 1 AS b,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn
  FROM documents),
r AS (
  SELECT lang, rn, b, CAST(0 AS BIGINT) AS batch, b AS used FROM sized WHERE rn = 1
  UNION ALL
  SELECT s.lang, s.rn, s.b,
         CASE WHEN r.used + s.b > 65536 THEN r.batch + 1 ELSE r.batch END,
         CASE WHEN r.used + s.b > 65536 THEN s.b ELSE r.used + s.b END
  FROM r JOIN sized s ON s.lang = r.lang AND s.rn = r.rn + 1)
SELECT lang, batch AS batch_no, count(*) AS n_rows, CAST(sum(b) AS BIGINT) AS payload_bytes FROM r GROUP BY lang, batch
""",
)
def size_bounded_batches(spark, sf_dir):
    """K7 exact: request batches of at most 64 KiB of JSON over all documents,
    packed greedily per language in document order (the reference bound is
    3.5 MB; a smaller bound exercises the split at this data size).  Returns
    one row per request."""
    (docs,) = D.tables(spark, sf_dir, "documents")
    rows = A.size_bounded_batches(docs.select("doc_id", "text", "lang"), ["doc_id"], limit_bytes=65536, group=["lang"], payload=["doc_id", "text"])
    # The payload of a request is (doc_id, text); lang only routes it.
    return rows.groupBy("lang", "batch_no").agg(F.count("*").alias("n_rows"), F.sum("row_bytes").alias("payload_bytes"))


@query(
    "size_bounded_batches_approx",
    """
WITH sized AS (
  SELECT lang, doc_id,
         strlen(CAST(to_json(struct_pack(doc_id := doc_id, text := text)) AS VARCHAR)) + 1 AS row_bytes
  FROM documents),
run AS (
  SELECT lang, doc_id, row_bytes,
         CAST(floor((sum(row_bytes) OVER (PARTITION BY lang ORDER BY doc_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - row_bytes) / 65536) AS BIGINT) AS batch_no
  FROM sized)
SELECT lang, batch_no, count(*) AS n_rows, CAST(sum(row_bytes) AS BIGINT) AS payload_bytes
FROM run GROUP BY lang, batch_no
""",
)
def size_bounded_batches_approx(spark, sf_dir):
    """K7 approximate: running JSON size per language, batch = floor(prefix / limit)."""
    (docs,) = D.tables(spark, sf_dir, "documents")
    df = docs.select("lang", "doc_id", "text")
    sized = A.approx_size_batches(df, ["lang"], ["doc_id"], 65536, payload=["doc_id", "text"])
    return sized.groupBy("lang", "batch_no").agg(
        F.count("*").alias("n_rows"), F.sum("row_bytes").alias("payload_bytes")
    )


@query(
    "apply_delete_as_upsert",
    with_ctes(CHG_ORDERS, ORDERS_STATE, ORDERS_BATCH, _LATEST_ORDERS_SQL)
    + f"""
SELECT {ORDER_COLS_SQL} FROM orders_state t
WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.o_orderkey = t.o_orderkey)
UNION ALL
SELECT {ORDER_COLS_SQL} FROM latest
""",
)
def apply_delete_as_upsert(spark, sf_dir):
    """X2 (the reference's row-store path): the operation is ignored, so a
    delete writes its before-image like any other change
    (``on_delete='upsert'``)."""
    target = D.orders_state(spark, sf_dir)
    batch = D.orders_batch(spark, sf_dir)
    return A.apply_changes(target, batch, ["o_orderkey"], on_delete="upsert")


@query(
    "apply_upsert_null_safe",
    """
WITH keyed AS (
  SELECT CASE WHEN o_custkey % 97 = 0 THEN NULL ELSE o_custkey END AS ck, o_orderkey, o_totalprice, o_orderdate FROM orders),
target AS (SELECT * FROM keyed WHERE o_orderdate < TIMESTAMP '1998-01-01'),
batch AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY ck ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM keyed WHERE o_orderdate >= TIMESTAMP '1998-01-01') WHERE rn = 1)
SELECT ck, o_orderkey, o_totalprice, o_orderdate FROM target t
WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.ck IS NOT DISTINCT FROM t.ck)
UNION ALL
SELECT ck, o_orderkey, o_totalprice, o_orderdate FROM batch
""",
)
def apply_upsert_null_safe(spark, sf_dir):
    """K1 with a nullable key matched NULL-safely: the batch's row for the
    NULL key replaces every target row whose key is NULL."""
    (o,) = D.tables(spark, sf_dir, "orders")
    keyed = o.select(
        F.when(F.col("o_custkey") % 97 == 0, F.lit(None)).otherwise(F.col("o_custkey")).alias("ck"),
        "o_orderkey",
        "o_totalprice",
        "o_orderdate",
    )
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    target = keyed.filter(F.col("o_orderdate") < cut)
    batch = keyed.filter(F.col("o_orderdate") >= cut)
    return A.upsert(target, batch, ["ck"], order=["o_orderdate", "o_orderkey"], null_safe=True)
