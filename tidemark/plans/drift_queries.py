"""Queries for schema drift carried by the change events: E1-E4, A12."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import decode as DC
from tidemark.operators import evolution as EVO
from tidemark.plans import derived as D
from tidemark.plans.registry import CHG_EVENTS, query, with_ctes
from tidemark.session import spread
from tidemark.sources import envelope as EV

_BASE = [EV.field_entry("event_id", "int64"), EV.field_entry("ts", "int64", DC.TS_MICRO), EV.field_entry("event_type", "string")]
_VALUE, _COUNT = EV.field_entry("value", "double"), EV.field_entry("value", "int64")
_PROPS, _CHANNEL = EV.field_entry("props", "string", DC.JSON_TYPE), EV.field_entry("channel", "string", default="web")
# Phase 2 gains a column; phase 3 retypes one and, in every second table, loses another.
PHASES = {
    "one": [*_BASE, _VALUE, _PROPS],
    "two": [*_BASE, _VALUE, _PROPS, _CHANNEL],
    "three": [*_BASE, _COUNT, _PROPS, _CHANNEL],
    "three_less": [*_BASE, _COUNT, _CHANNEL],
}


def drifting_events(spark, sf_dir, one_table: bool = False):
    """Raw change events whose tables change while they flow: the schema block of
    each event is that of its table and day.  ``one_table``: all in ``events``, with
    changes on the 11th and the 21st; else ten tables, each on days of its own."""
    ch = spread(D.chg_events(spark, sf_dir))
    number = F.lit(1) if one_table else F.col("k") % D.EVENT_TABLES
    first, second = (F.lit(11), F.lit(21)) if one_table else (5 + number, 15 + number)
    day = F.dayofmonth("ts")
    phase = F.when(day < first, "one").when(day < second, "two").when(number % 2 == 1, "three_less").otherwise("three")
    name = F.lit("events") if one_table else F.concat(F.lit("tbl_"), number.cast("string"))
    staged = ch.withColumn("__phase", phase).withColumn("__topic", F.concat(F.lit("srv.public."), name))
    parts = []
    for which, fields in PHASES.items():
        count = which.startswith("three")
        wire = {
            "event_id": F.col("seq"),
            "ts": F.unix_micros(F.col("ts").cast("timestamp")),
            "event_type": F.col("event_type"),
            "value": F.col("value").cast("long") if count else F.col("value"),
            "props": F.col("props"),
            "channel": F.when(F.col("k") % 2 == 0, "web").otherwise("app"),
        }
        image = F.struct(*[wire[f["field"]].alias(f["field"]) for f in fields])
        mine = staged.filter(F.col("__phase") == which)
        parts.append(EV.encode_envelope(mine, F.col("__topic"), ["k"], image, fields, F.col("op"), F.unix_millis(F.col("ts").cast("timestamp"))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


DRIFT = """
drift AS (
  SELECT 'tbl_' || CAST(user_id % 10 AS VARCHAR) AS table_name, user_id % 2 = 1 AS odd, ts,
         CASE WHEN day(ts) < 5 + user_id % 10 THEN 1 WHEN day(ts) < 15 + user_id % 10 THEN 2 ELSE 3 END AS phase
  FROM events),
versions AS (
  SELECT table_name, odd, phase, row_number() OVER w AS version, lag(phase) OVER w AS before,
         make_timestamp(epoch_us(min(ts)) // 1000 * 1000) AS created_at
  FROM drift GROUP BY table_name, odd, phase WINDOW w AS (PARTITION BY table_name ORDER BY phase)),
labelled AS (
  SELECT *, CASE WHEN before IS NULL THEN 'INITIAL_LOAD' WHEN before = 1 THEN 'NEW COLUMN' WHEN odd THEN 'DROP COLUMN'
                 ELSE 'CHANGES TYPE' END AS changes_type FROM versions)
"""


def _log(spark, sf_dir):
    return EVO.version_log(EVO.schema_runs(EVO.schema_events(drifting_events(spark, sf_dir))))


@query(
    "schema_versions",
    with_ctes(DRIFT) + "SELECT table_name, CAST(version AS INTEGER) AS version_schema, changes_type, created_at FROM labelled",
)
def schema_versions(spark, sf_dir):
    """The versions of ten tables whose events gain, retype and lose columns:
    one where the columns differ from those before, none for equal ones."""
    log = _log(spark, sf_dir)
    return log.select("table_name", F.col("version").cast("int").alias("version_schema"), "changes_type", F.timestamp_millis("started_ms").cast("timestamp_ntz").alias("created_at"))


@query(
    "schema_at_version",
    with_ctes(DRIFT)
    + f"""
, columns(phase, odd, column_name, type, logical_name) AS (
  SELECT p, o, c, t, n FROM (VALUES (1), (2), (3)) a(p), (VALUES (TRUE), (FALSE)) b(o), (VALUES
    ('event_id', 'int64', NULL), ('ts', 'int64', '{DC.TS_MICRO}'), ('event_type', 'string', NULL), ('value', 'double', NULL),
    ('value', 'int64', NULL), ('props', 'string', '{DC.JSON_TYPE}'), ('channel', 'string', NULL)) x(c, t, n)
  WHERE (c <> 'channel' OR p > 1) AND (c <> 'value' OR (t = 'int64') = (p = 3)) AND (c <> 'props' OR NOT (o AND p = 3))),
now AS (SELECT table_name, version, c.* FROM versions v JOIN columns c USING (phase, odd)),
earlier AS (SELECT table_name, version, c.* FROM versions v JOIN columns c ON c.phase = v.before AND c.odd = v.odd)
SELECT table_name, CAST(version AS INTEGER) AS version, column_name, COALESCE(n.type, e.type) AS type,
       COALESCE(n.logical_name, e.logical_name) AS logical_name,
       CASE WHEN e.type IS NULL THEN 'added' WHEN n.type IS NULL THEN 'dropped' WHEN e.type <> n.type THEN 'type_changed' ELSE 'unchanged' END AS change
FROM now n FULL OUTER JOIN earlier e USING (table_name, version, column_name)
""",
)
def schema_at_version(spark, sf_dir):
    """The schema of every table at every version, folded from the logged
    column changes, each column with the change that this version made."""
    log = _log(spark, sf_dir)
    at = EVO.schema_at(EVO.column_changes(log), log.select("table_name", "version"))
    return at.select("table_name", F.col("version").cast("int").alias("version"), "column_name", "type", "logical_name", "change")


@query(
    "stream_schema_drift",
    with_ctes(CHG_EVENTS)
    + """
SELECT k, op, CAST(epoch_us(ts) // 1000 AS BIGINT) AS ts_ms, seq AS event_id, ts, event_type, CAST(trunc(value) AS BIGINT) AS value,
       CASE WHEN day(ts) < 11 OR k % 2 = 0 THEN 'web' ELSE 'app' END AS channel
FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts DESC, seq DESC) AS rn FROM chg_events)
WHERE rn = 1 AND op <> 'd'
""",
)
def stream_schema_drift(spark, sf_dir):
    """E1/E2/E4 on the stream: the events of one table gain a column (with a
    default), then lose one and retype another.  They come in four deliveries whose
    edges are not those of the changes; the branch has no fields of its own, and its
    target ends with the last schema's columns in every row."""
    from tidemark.streaming import changes as S

    base = S.fresh_dir(spark, "drift")
    raw = drifting_events(spark, sf_dir, one_table=True)
    ms = F.get_json_object("value", "$.payload.ts_ms").cast("long")
    week = F.least(F.floor((F.dayofmonth(F.timestamp_millis(ms)) - 1) / 8), F.lit(3)).cast("int")
    raw.withColumn("slice", week).write.partitionBy("slice").json(f"{base}/slices")
    branch = S.Branch("all", "events", None, ["k"], f"{base}/target", key_from_json={"k": "long"}, seq_col="event_id")
    sinks = S.StreamSinks(f"{base}/dlq", f"{base}/throughput", f"{base}/schemas")
    for i in range(4):
        if not S.path_exists(spark, f"{base}/slices/slice={i}"):
            continue
        spark.read.schema(EV.RAW_EVENT_SCHEMA).json(f"{base}/slices/slice={i}").write.mode("append").json(f"{base}/source")
        S.run_change_stream(spark, f"{base}/source", [branch], sinks, f"{base}/checkpoint", None)
    return branch.target(spark).read(S.SchemaLog(spark, sinks.schema_path).defaults("events"))
