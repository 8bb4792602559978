"""Queries for the dead-letter tables: D1-D10, A15."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import dlq as Q
from tidemark.plans import derived as D
from tidemark.plans.registry import CHG_EVENTS, DLQ_MESSAGES, query, with_ctes

NOW = "2024-01-31 00:00:00"
DLQ_BASE = with_ctes(CHG_EVENTS, DLQ_MESSAGES)

# The branches that the letters were meant for, as they were stored and as they are
# now: the second has another filter and SQL, the third is gone.
BIG = {"version": 2, "groups": [{"conditions": [{"column": "value", "operator": ">", "value": "50"}]}], "interLogic": []}
SMALL = {"version": 2, "groups": [{"conditions": [{"column": "value", "operator": "<", "value": "80"}]}], "interLogic": []}
OLD_SQL = "SELECT k, seq, ts, op, event_type, value, props FROM changes"
NEW_SQL = "SELECT k, seq, ts, op, upper(event_type) AS event_type, value * 2 AS value, props FROM changes"
STORED = {1: (None, None), 2: (SMALL, "SELECT no_longer_there FROM changes"), 3: (SMALL, OLD_SQL)}
CURRENT = {1: (None, None), 2: (BIG, NEW_SQL)}


def letters(spark, sf_dir, first: str | None = None):
    """Every change (from ``first`` on) as a dead letter of its branch: inserts,
    updates and deletes with their whole rows."""
    ch = D.chg_events(spark, sf_dir)
    if first:
        ch = ch.filter(F.col("ts") >= F.lit(first).cast("timestamp_ntz"))
    names = F.concat(F.when(F.col("k") % 2 == 0, F.lit("public.tbl_")).otherwise(F.lit("tbl_")), (F.col("k") % D.EVENT_TABLES).cast("string"))
    destination = (F.col("k") % 3 + 1).cast("int")
    stored = {d: Q.branch_config(f"branch_{d}", *STORED[d]) for d in STORED}
    pick = lambda field: F.element_at(F.array(*[F.lit(stored[d][field]) for d in sorted(stored)]), destination)
    routing = {
        "pipeline_id": 1,
        "source_id": 1,
        "table_name": names,
        "destination_id": destination,
        "target_name": F.concat(F.lit("users_"), destination.cast("string")),
    }
    changed = ch.withColumn("key", F.to_json(F.struct("k"))).withColumn("ts_ms", F.unix_millis(F.col("ts").cast("timestamp")))
    return Q.dead_letters(changed, routing, {c: pick(c) for c in ("branch", "filter", "sql")}, F.lit("target table missing"), F.col("ts"))


@query(
    "dlq_enqueue",
    DLQ_BASE
    + """
SELECT msg_id, source_id, table_name, destination_id, k, op, value,
       'target table missing' AS error, 0 AS retry_count, first_failed_at
FROM dlq_messages
""",
)
def dlq_enqueue(spark, sf_dir):
    """Failed changes enqueued with routing, configuration, error and first
    failure; the row itself is a VARIANT, read back here by name and type."""
    out = letters(spark, sf_dir)
    value = lambda name, kind: F.try_variant_get("record", f"$.{name}", kind).alias(name)
    return out.select(
        value("seq", "long").alias("msg_id"), "source_id", "table_name", "destination_id", value("k", "long"), F.col("operation").alias("op"),
        value("value", "double"), "error", "retry_count", "first_failed_at",
    )


@query(
    "dlq_roundtrip",
    DLQ_BASE + "SELECT msg_id, source_id, table_name, destination_id, k, op, value, retry_count, first_failed_at FROM dlq_messages",
)
def dlq_roundtrip(spark, sf_dir):
    """Serialise each message body to JSON and restore it unchanged."""
    m = D.dlq_messages(spark, sf_dir)
    body = ["k", "op", "value", "retry_count", "first_failed_at"]
    schema = T.StructType([f for f in m.schema.fields if f.name in body])
    return Q.restore(Q.serialize(m, body), schema)


@query(
    "dlq_cap",
    DLQ_BASE
    + """
SELECT msg_id, source_id, table_name, destination_id FROM (
  SELECT *, row_number() OVER (PARTITION BY source_id, table_name, destination_id ORDER BY msg_id DESC) AS rn FROM dlq_messages)
WHERE rn <= 50
""",
)
def dlq_cap(spark, sf_dir):
    """D3: each queue trimmed to its newest 50 messages (the production cap
    is 100,000; a small cap exercises the trim at this data size)."""
    return Q.cap(D.dlq_messages(spark, sf_dir), "msg_id", 50).select("msg_id", "source_id", "table_name", "destination_id")


@query(
    "dlq_batch",
    DLQ_BASE
    + """
SELECT msg_id, source_id, table_name, destination_id FROM (
  SELECT *, row_number() OVER (PARTITION BY source_id, table_name, destination_id ORDER BY msg_id) AS rn FROM dlq_messages)
WHERE rn <= 3
""",
)
def dlq_batch(spark, sf_dir):
    """The next batch (oldest 3) of every queue."""
    return Q.batch(D.dlq_messages(spark, sf_dir), "msg_id", 3).select("msg_id", "source_id", "table_name", "destination_id")


@query(
    "dlq_stale_claims",
    DLQ_BASE
    + f"""
, claimed AS (SELECT msg_id, CASE WHEN msg_id % 3 = 0 THEN first_failed_at + INTERVAL 1 DAY END AS claimed_at FROM dlq_messages)
SELECT msg_id, 'worker-0' AS claimed_by, TIMESTAMP '{NOW}' AS claimed_at FROM claimed
WHERE claimed_at IS NOT NULL AND epoch_us(TIMESTAMP '{NOW}') - epoch_us(claimed_at) >= 90000000
""",
)
def dlq_stale_claims(spark, sf_dir):
    """Messages in flight (every third was claimed a day after it failed)
    idle for 90 s or more are re-claimed."""
    m = D.dlq_messages(spark, sf_dir).withColumn(
        "claimed_at", F.when(F.col("msg_id") % 3 == 0, F.col("first_failed_at") + F.expr("INTERVAL 1 DAY"))
    )
    return Q.stale_claims(m, NOW).select("msg_id", "claimed_by", "claimed_at")


@query(
    "dlq_ack",
    DLQ_BASE + "SELECT msg_id FROM dlq_messages WHERE msg_id NOT IN (SELECT msg_id FROM dlq_messages WHERE retry_count < 4)",
)
def dlq_ack(spark, sf_dir):
    """Messages processed (here: those with fewer than 4 retries) are
    acknowledged and removed."""
    m = D.dlq_messages(spark, sf_dir)
    return Q.ack(m, m.filter(F.col("retry_count") < 4), "msg_id").select("msg_id")


@query(
    "dlq_retry_split",
    DLQ_BASE
    + """
SELECT msg_id, retry_count + 1 AS retry_count, CASE WHEN retry_count + 1 >= 10 THEN 'discard' ELSE 'requeue' END AS action
FROM dlq_messages
""",
)
def dlq_retry_split(spark, sf_dir):
    """Failed retry: count + 1, discard at 10, else requeue."""
    return Q.retry_split(D.dlq_messages(spark, sf_dir)).select("msg_id", "retry_count", "action")


@query(
    "dlq_purge",
    DLQ_BASE
    + f"""
SELECT msg_id, retry_count, first_failed_at FROM dlq_messages
WHERE NOT (retry_count >= 10 OR first_failed_at < TIMESTAMP '{NOW}' - INTERVAL 7 DAY)
""",
)
def dlq_purge(spark, sf_dir):
    """Purge by retry count (>= 10) or age (> 7 days)."""
    return Q.purge(D.dlq_messages(spark, sf_dir), NOW).select("msg_id", "retry_count", "first_failed_at")


@query(
    "dlq_depth",
    DLQ_BASE
    + """
SELECT source_id, table_name, destination_id, count(*) AS depth FROM dlq_messages GROUP BY ALL
UNION ALL SELECT NULL, 'total', NULL, count(*) FROM dlq_messages
""",
)
def dlq_depth(spark, sf_dir):
    """Depth per queue (deepest first) plus the overall total."""
    per = Q.depth(D.dlq_messages(spark, sf_dir))
    total = per.agg(F.sum("depth").cast("long").alias("depth")).select(
        F.lit(None).cast("int").alias("source_id"), F.lit("total").alias("table_name"), F.lit(None).cast("int").alias("destination_id"), "depth"
    )
    return per.orderBy(F.col("depth").desc(), "table_name", "destination_id").unionByName(total)


@query(
    "dlq_queue_keys",
    DLQ_BASE
    + """
, q AS (SELECT source_id, table_name, destination_id, count(*) AS n_messages,
               'dlq:s' || CAST(source_id AS VARCHAR) || ':t' || table_name || ':d' || CAST(destination_id AS VARCHAR) AS queue_key
        FROM dlq_messages WHERE NOT (source_id = 1 AND table_name = 'tbl_3' AND destination_id = 1) GROUP BY ALL)
SELECT queue_key, n_messages,
       CAST(regexp_extract(queue_key, '^dlq:s(\\d+):t(.+):d(\\d+)$', 1) AS INTEGER) AS parsed_source,
       regexp_extract(queue_key, '^dlq:s(\\d+):t(.+):d(\\d+)$', 2) AS parsed_table,
       CAST(regexp_extract(queue_key, '^dlq:s(\\d+):t(.+):d(\\d+)$', 3) AS INTEGER) AS parsed_destination,
       n_messages > 0 AS has_messages
FROM q
""",
)
def dlq_queue_keys(spark, sf_dir):
    """Queue listing with key text, parsed back (table names with dots
    round-trip), has-messages flag, after deleting one queue."""
    m = Q.delete_queue(D.dlq_messages(spark, sf_dir), 1, "tbl_3", 1)
    qs = Q.queues(m)
    s, t, d = Q.parse_queue_key(F.col("queue_key"))
    return qs.select("queue_key", "n_messages", s.alias("parsed_source"), t.alias("parsed_table"), d.alias("parsed_destination"), (F.col("n_messages") > 0).alias("has_messages"))


FIRST_FAILURE = "2024-01-12 00:00:00"


@query(
    "dlq_replay",
    with_ctes(CHG_EVENTS)
    + f"""
, target AS (  -- what reached the targets before the failures
  SELECT CAST(k % 3 + 1 AS INTEGER) AS destination_id, * FROM (
    SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts DESC, seq DESC) AS rn FROM chg_events WHERE ts < TIMESTAMP '{FIRST_FAILURE}')
  WHERE rn = 1 AND op <> 'd'),
replayed AS (  -- each branch's filter and SQL: the current ones, or the stored ones of the branch that is gone
  SELECT CAST(k % 3 + 1 AS INTEGER) AS destination_id, k, seq, ts, op,
         CASE WHEN k % 3 = 1 THEN upper(event_type) ELSE event_type END AS event_type,
         CASE WHEN k % 3 = 1 THEN value * 2 ELSE value END AS value, props
  FROM chg_events
  WHERE ts >= TIMESTAMP '{FIRST_FAILURE}'
    AND COALESCE(CASE k % 3 WHEN 1 THEN value > 50 WHEN 2 THEN value < 80 ELSE TRUE END, TRUE)),
latest AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts DESC, seq DESC) AS rn FROM replayed)
SELECT destination_id, k, seq, ts, op, event_type, value, props FROM latest WHERE rn = 1 AND op <> 'd'
UNION ALL
SELECT destination_id, k, seq, ts, op, event_type, value, props FROM target t
WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.k = t.k)
""",
)
def dlq_replay(spark, sf_dir):
    """Dead-lettered inserts, updates and deletes with their whole rows, each
    restored with its table's columns and run through its branch as it is now (other
    filter and SQL for the second destination; the third's is gone, so the stored
    ones count), then merged into the branch's target."""
    from tidemark.streaming import changes as S

    base = S.fresh_dir(spark, "replay")
    ch = D.chg_events(spark, sf_dir)
    early = ch.filter(F.col("ts") < F.lit(FIRST_FAILURE).cast("timestamp_ntz"))
    queued = letters(spark, sf_dir, FIRST_FAILURE)
    fields = [{"field": f.name, "spark_type": f.dataType} for f in ch.schema.fields if f.name != "op"]
    results = []
    for d in sorted(STORED):
        path = f"{base}/users_{d}"
        target = S.Target(spark, path, ["k"])
        mine = F.col("k") % 3 + 1 == d
        target.write(early.filter(mine), "early")
        spec, sql = CURRENT.get(d, STORED[d])
        stored = None if d in CURRENT else Q.branch_config(f"branch_{d}", spec, sql)
        branch = S.Branch(f"branch_{d}", "changes", fields, ["k"], path, spec, sql, destination_id=d, require_target=True)
        rows = queued.filter((F.col("destination_id") == d)).withColumn("table_name", F.lit("changes")).withColumn("target_name", F.lit(path))
        left, _ = S.replay(spark, rows, [replace(branch, name="another")] if stored else [branch], "replay")
        if left.limit(1).count():
            raise RuntimeError(f"letters of destination {d} stay")
        results.append(target.read().withColumn("destination_id", F.lit(d)))
    out = results[0].unionByName(results[1]).unionByName(results[2])
    return out.select("destination_id", "k", "seq", "ts", "op", "event_type", "value", "props")
