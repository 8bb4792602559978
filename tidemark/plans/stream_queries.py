"""Queries for Structured Streaming: S1, V1, V2, V7/K10, K5, streamed A5.

Each query lays its input down as files in a fresh folder under the shared
checkpoint directory, runs the streaming query to completion
(``availableNow``) with its own checkpoint, and returns the resulting table.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import apply as A
from tidemark.plans import derived as D
from tidemark.plans.decode_queries import EVENT_FIELDS, events_raw
from tidemark.plans.registry import CHG_EVENTS, query, with_ctes
from tidemark.streaming import changes as S

BIG_VALUES = {"version": 2, "groups": [{"conditions": [{"column": "value", "operator": ">", "value": "50"}]}], "interLogic": []}
_LONG, _TEXT = T.LongType(), T.StringType()
TARGET_COLUMNS = {
    "k": _LONG, "op": _TEXT, "ts_ms": _LONG, "event_id": _LONG, "ts": T.TimestampNTZType(), "event_type": _TEXT, "value": T.DoubleType(), "props": _TEXT,
}
BIG_COLUMNS = ["k", "event_id", "ts", "op", "value"]
BIG_SQL = f"SELECT {', '.join(BIG_COLUMNS)} FROM events"


def _branches(base: str):
    common = dict(table="events", fields=EVENT_FIELDS, key_from_json={"k": "long"}, ts_col="ts", seq_col="event_id", require_target=True)
    return [
        S.Branch(name="all_users", keys=["k"], target_path=f"{base}/targets/all_users", **common),
        # The key of this one is read from the events' own.
        S.Branch(name="big_values", keys=None, target_path=f"{base}/targets/big_values", filter_spec=BIG_VALUES, sql=BIG_SQL, **common),
    ]


def _run_events_stream(spark, sf_dir, split: bool = False, max_files: int | None = 4):
    base = S.fresh_dir(spark, "stream")
    raw = events_raw(spark, sf_dir)
    src = f"{base}/source"
    sinks = S.StreamSinks(dlq_path=f"{base}/dlq", throughput_path=f"{base}/throughput")
    branches = _branches(base)
    ckpt = f"{base}/checkpoint"
    for br in branches:  # K8, K9: targets are made first, a branch without one would dead-letter
        names = list(TARGET_COLUMNS) if br.sql is None else BIG_COLUMNS
        br.target(spark).create(T.StructType([T.StructField(c, TARGET_COLUMNS[c]) for c in names]))
    if split:
        # First delivery: changes up to mid-month; then the rest arrives and
        # the query is restarted from its checkpoint.
        ms = F.get_json_object("value", "$.payload.ts_ms").cast("long")
        cut = F.unix_millis(F.lit("2024-01-15 00:00:00").cast("timestamp"))
        first, rest = raw.filter(ms.isNull() | (ms < cut)), raw.filter(ms.isNotNull() & (ms >= cut))
        first.repartition(6).write.mode("overwrite").json(src)
        S.run_change_stream(spark, src, branches, sinks, ckpt, max_files)
        rest.repartition(6).write.mode("append").json(src)
        S.run_change_stream(spark, src, branches, sinks, ckpt, max_files)
    else:
        S.write_change_files(raw, src, 12)
        S.run_change_stream(spark, src, branches, sinks, ckpt, max_files)
    return base, branches, sinks


_LATEST_SQL = with_ctes(CHG_EVENTS) + """
SELECT k, op, CAST(epoch_us(ts) // 1000 AS BIGINT) AS ts_ms, seq AS event_id, ts, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts DESC, seq DESC) AS rn FROM chg_events)
WHERE rn = 1 AND op <> 'd'
"""


@query("stream_apply", _LATEST_SQL)
def stream_apply(spark, sf_dir):
    """V1 (+V3, V4): the change log streamed in micro-batches (files in any
    order), each batch parsed once and applied to two branches; the first
    branch's target ends as the latest live row per user."""
    base, branches, _ = _run_events_stream(spark, sf_dir)
    return branches[0].target(spark).read()


@query("stream_restart", _LATEST_SQL)
def stream_restart(spark, sf_dir):
    """V2: the query is stopped after the first delivery and restarted from
    its checkpoint when more files arrive; nothing is lost or applied twice."""
    base, branches, _ = _run_events_stream(spark, sf_dir, split=True)
    return branches[0].target(spark).read()


@query(
    "throughput_log",
    """
SELECT 'all_users' AS branch, 'events' AS table_name, count(*) AS record_count FROM events
UNION ALL
SELECT 'big_values', 'events', count(*) FROM events WHERE COALESCE(value > 50, TRUE)
""",
)
def throughput_log(spark, sf_dir):
    """Rows written per branch, summed over the micro-batch log."""
    _, _, sinks = _run_events_stream(spark, sf_dir)
    log = spark.read.parquet(sinks.throughput_path)
    return log.groupBy("branch", "table_name").agg(F.sum("record_count").cast("long").alias("record_count"))


@query(
    "stream_change_source",
    with_ctes(CHG_EVENTS) + "SELECT k, op, 'events' AS table_name FROM chg_events",
)
def stream_change_source(spark, sf_dir):
    """Bounded micro-batches (4 files per trigger) of raw change events,
    parsed; heartbeats and tombstones dropped."""
    from tidemark.sources import envelope as EV

    base = S.fresh_dir(spark, "source")
    S.write_change_files(events_raw(spark, sf_dir), f"{base}/source", 12)
    out = f"{base}/parsed"

    def each(batch, epoch):
        parsed = EV.parse_envelope(batch).select(F.get_json_object("key", "$.k").cast("long").alias("k"), "op", "table_name")
        parsed.withColumn("epoch", F.lit(epoch)).write.mode("append").parquet(out)

    q = S.change_stream(spark, f"{base}/source", 4).writeStream.foreachBatch(each).option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(out).drop("epoch")


@query(
    "landing_incremental_merge",
    with_ctes(CHG_EVENTS)
    + """
SELECT k AS "K", seq AS "SEQ", ts AS "TS", event_type AS "EVENT_TYPE", value AS "VALUE", props AS "PROPS",
       op AS "OPERATION", TIMESTAMP '2024-01-31 00:00:00' AS "SYNC_TIMESTAMP" FROM (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts DESC, seq DESC) AS rn FROM chg_events)
WHERE rn = 1 AND op <> 'd'
""",
)
def landing_incremental_merge(spark, sf_dir):
    """K5: landing rows appended in two deliveries, each followed by an
    incremental (checkpointed) merge run into the target."""
    base = S.fresh_dir(spark, "landing")
    rows = A.landing_rows(D.chg_events(spark, sf_dir), "op", "2024-01-31 00:00:00")
    landing = f"{base}/landing"
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    target = S.Target(spark, f"{base}/target", ["K"], "TS", "SEQ", op_col="OPERATION")
    rows.filter(F.col("TS") < cut).write.mode("append").parquet(landing)
    S.landing_merge_stream(spark, landing, rows.schema, target, f"{base}/ckpt")
    rows.filter(F.col("TS") >= cut).write.mode("append").parquet(landing)
    S.landing_merge_stream(spark, landing, rows.schema, target, f"{base}/ckpt")
    return target.read()


@query(
    "stream_lag_hourly",
    """
SELECT date_trunc('hour', ts) AS hour, user_id % 4 + 1 AS source_id,
       round(sum(CAST(round(value * 1e8) AS BIGINT)) / count(*), 2) AS avg_bytes, count(*) AS n
FROM events GROUP BY 1, 2
""",
)
def stream_lag_hourly(spark, sf_dir):
    """A5 streamed: hourly mean lag per source with a watermark, windows
    upserted as they update."""
    from tidemark.plans.monitor_queries import wal_metrics

    base = S.fresh_dir(spark, "lag")
    w = wal_metrics(spark, sf_dir).select("source_id", "size_bytes", "recorded_at")
    w.repartition(8).write.mode("overwrite").parquet(f"{base}/series")
    out = S.Target(spark, f"{base}/hourly", ["hour", "source_id"], "ts", "seq")
    S.hourly_lag_stream(spark, f"{base}/series", w.schema, out, f"{base}/ckpt")
    r = out.read()
    return r.select("hour", "source_id", F.round(F.col("total_bytes") / F.col("n"), 2).alias("avg_bytes"), F.col("n").cast("long").alias("n"))
