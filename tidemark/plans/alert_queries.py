"""Queries for alerts, error state and redaction: V5, V6, M9, M10, R1, R2."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import redact as R
from tidemark.operators import alerts as AL
from tidemark.plans import derived as D
from tidemark.plans.registry import query, with_ctes

# The error texts the derived failures carry (by event_id % 8).
ERROR_TEMPLATES = [
    ("connection refused: could not connect to server at host db-", "user"),
    ('FATAL: password authentication failed for user "app" password=s3cret', "user"),
    ('relation "tbl_', "table_missing"),
    ("canceling statement due to statement timeout after ", "value"),
    ('column "value" does not exist in target ', "table"),
    ("SSL error: certificate verify failed", None),
    ("server closed the connection unexpectedly; connection reset by peer", None),
    ("unexpected value for api_key=abc", "user"),
]


def _message_expr():
    i = F.col("event_id") % 8
    parts = []
    for n, (text, extra) in enumerate(ERROR_TEMPLATES):
        if extra == "user":
            e = F.concat(F.lit(text), F.col("user_id").cast("string"))
        elif extra == "table_missing":
            e = F.concat(F.lit(text), (F.col("user_id") % 10).cast("string"), F.lit('" does not exist'))
        elif extra == "value":
            e = F.concat(F.lit(text), F.round(F.col("value")).cast("long").cast("string"), F.lit(" ms"))
        elif extra == "table":
            e = F.concat(F.lit(text), F.lit("tbl_"), (F.col("user_id") % 10).cast("string"))
        else:
            e = F.lit(text)
        parts.append((n, e))
    out = parts[-1][1]
    for n, e in reversed(parts[:-1]):
        out = F.when(i == n, e).otherwise(out)
    return out


def _message_sql():
    cases = []
    for n, (text, extra) in enumerate(ERROR_TEMPLATES):
        t = text.replace("'", "''")
        if extra == "user":
            e = f"'{t}' || CAST(user_id AS VARCHAR)"
        elif extra == "table_missing":
            e = f"'{t}' || CAST(user_id % 10 AS VARCHAR) || '\" does not exist'"
        elif extra == "value":
            e = f"'{t}' || CAST(CAST(round(value) AS BIGINT) AS VARCHAR) || ' ms'"
        elif extra == "table":
            e = f"'{t}' || 'tbl_' || CAST(user_id % 10 AS VARCHAR)"
        else:
            e = f"'{t}'"
        cases.append(f"WHEN {n} THEN {e}")
    return "CASE event_id % 8 " + " ".join(cases) + " END"


def outcomes(spark, sf_dir):
    """Batch outcomes per branch: every event is one write attempt of branch
    (pipeline, destination, table); error events are failures."""
    (ev,) = D.tables(spark, sf_dir, "events")
    msg = _message_expr()
    return ev.select(
        "event_id",
        "ts",
        "value",
        (F.col("user_id") % 5).alias("pipeline_id"),
        (F.col("user_id") % 3 + 1).alias("destination_id"),
        F.concat(F.lit("dest_"), (F.col("user_id") % 3 + 1).cast("string")).alias("destination_name"),
        F.concat(F.lit("tbl_"), (F.col("user_id") % 10).cast("string")).alias("table_name"),
        (F.col("event_type") != "error").alias("ok"),
        F.when(F.col("event_type") == "error", msg).alias("error_message"),
    ).withColumn("error_type", F.when(F.lower("error_message").contains("connection"), "CONNECTION_ERROR").otherwise("DESTINATION_ERROR"))


OUTCOMES_SQL = f"""
outcomes AS (
  SELECT event_id, ts, value, user_id % 5 AS pipeline_id, user_id % 3 + 1 AS destination_id,
         'dest_' || CAST(user_id % 3 + 1 AS VARCHAR) AS destination_name, 'tbl_' || CAST(user_id % 10 AS VARCHAR) AS table_name,
         event_type <> 'error' AS ok,
         CASE WHEN event_type = 'error' THEN {_message_sql()} END AS error_message
  FROM events),
failures AS (
  SELECT *, CASE WHEN event_id % 8 IN (0, 6) THEN 'CONNECTION_ERROR' ELSE 'DESTINATION_ERROR' END AS error_type
  FROM outcomes WHERE NOT ok)
"""

_KEY_SQL = "'pipeline_' || CAST(pipeline_id AS VARCHAR) || '_dest_' || CAST(destination_id AS VARCHAR) || '_table_' || table_name || '_' || error_type"
# Written out by hand from the error texts above: the first, fourth and seventh force
# delivery ("connection", "refused", "timeout"), the first and seventh are connection
# problems.
_FORCE_SQL = "event_id % 8 IN (0, 3, 6)"
_CONNECTION_SQL = "event_id % 8 IN (0, 6)"


@query(
    "alert_compose",
    with_ctes(OUTCOMES_SQL)
    + f"""
SELECT event_id, {_KEY_SQL} AS key_notification,
       CASE WHEN {_CONNECTION_SQL} THEN 'ERROR' ELSE 'WARNING' END AS type,
       CASE WHEN {_CONNECTION_SQL}
            THEN 'Destination Connection Failed: ' || destination_name ELSE 'Destination Error: ' || destination_name END AS title,
       ({_FORCE_SQL}) AS is_force_sent
FROM failures
""",
)
def alert_compose(spark, sf_dir):
    """M9: key, severity, title and force flag of each failure's alert."""
    f = outcomes(spark, sf_dir).filter(~F.col("ok"))
    return AL.compose(f).select("event_id", "key_notification", "type", "title", "is_force_sent")


@query(
    "alert_iterations",
    "WITH RECURSIVE "
    + OUTCOMES_SQL.strip()
    + f""",
a AS (
  SELECT event_id, {_KEY_SQL} AS k, ({_FORCE_SQL}) AS forced,
         row_number() OVER (PARTITION BY {_KEY_SQL} ORDER BY ts, event_id) AS rn
  FROM failures),
r AS (
  SELECT k, rn, event_id, 1 AS it, CAST(1 AS BIGINT) AS no FROM a WHERE rn = 1
  UNION ALL
  SELECT a.k, a.rn, a.event_id,
         CASE WHEN r.it < 3 OR a.forced THEN r.it + 1 ELSE 1 END,
         CASE WHEN r.it < 3 OR a.forced THEN r.no ELSE r.no + 1 END
  FROM r JOIN a ON a.k = r.k AND a.rn = r.rn + 1)
SELECT event_id, k AS key_notification, no AS notification_no, CAST(it AS INTEGER) AS iteration_check FROM r
""",
)
def alert_iterations(spark, sf_dir):
    """V5: which notification row absorbs each alert and its counter
    (limit 3, forced alerts keep counting) -- skew-safe fold."""
    f = AL.compose(outcomes(spark, sf_dir).filter(~F.col("ok")))
    out = AL.iteration_fold(f.select("event_id", "ts", "key_notification", "is_force_sent"), "key_notification", ["ts", "event_id"], "is_force_sent")
    return out.select("event_id", "key_notification", "notification_no", "iteration_check")


@query(
    "alert_throttle",
    """
WITH RECURSIVE a AS (
  SELECT user_id % 10 AS k, event_id, ts, event_id % 4 = 0 AS acked,
         row_number() OVER (PARTITION BY user_id % 10 ORDER BY ts, event_id) AS rn
  FROM events),
r AS (
  SELECT k, rn, event_id, TRUE AS created, ts AS last FROM a WHERE rn = 1
  UNION ALL
  SELECT a.k, a.rn, a.event_id, (a.acked OR a.ts - r.last >= INTERVAL 5 MINUTE),
         CASE WHEN a.acked OR a.ts - r.last >= INTERVAL 5 MINUTE THEN a.ts ELSE r.last END
  FROM r JOIN a ON a.k = r.k AND a.rn = r.rn + 1)
SELECT event_id, k, created AS "create" FROM r
""",
)
def alert_throttle(spark, sf_dir):
    """V6: anti-spam -- create an alert only for the first attempt, after the
    previous one was sent/read, or 5+ minutes after the last created one
    (a key is split over tasks; jumps between them are doubled)."""
    (ev,) = D.tables(spark, sf_dir, "events")
    a = ev.select(
        (F.col("user_id") % D.EVENT_TABLES).alias("k"), "event_id", "ts", (F.col("event_id") % 4 == 0).alias("acked")
    )
    return AL.throttle(a, "k", "ts", "event_id", "acked").select("event_id", "k", "create")


@query(
    "branch_error_state",
    with_ctes(OUTCOMES_SQL)
    + """
SELECT pipeline_id, destination_id, table_name, NOT arg_max(ok, event_id) AS is_error,
       CASE WHEN NOT arg_max(ok, event_id) THEN arg_max(error_message, event_id) END AS error_message,
       max(CASE WHEN NOT ok THEN event_id END) AS last_error_seq
FROM outcomes GROUP BY pipeline_id, destination_id, table_name
""",
)
def branch_error_state(spark, sf_dir):
    """Error flag per branch after its latest write: set with the
    failure's message, cleared by a later success."""
    o = outcomes(spark, sf_dir)
    return AL.error_state(o, ["pipeline_id", "destination_id", "table_name"], "event_id")


# The expected replacements, written out for the other engine's regular expressions.
_REDACTED = r"""
regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text,
  '(?is)postgresql://[^:]+:[^@]+@', 'postgresql://***:***@', 'g'),
  '(?is)mysql://[^:]+:[^@]+@', 'mysql://***:***@', 'g'),
  '(?is)mongodb://[^:]+:[^@]+@', 'mongodb://***:***@', 'g'),
  '(?is)password[''"]?[ \t\n\f\r\v]*[:=][ \t\n\f\r\v]*[''"]?[^''";, }\t\n\f\r\v]+', 'password=***', 'g'),
  '(?is)pwd[''"]?[ \t\n\f\r\v]*[:=][ \t\n\f\r\v]*[''"]?[^''";, }\t\n\f\r\v]+', 'pwd=***', 'g'),
  '(?is)passwd[''"]?[ \t\n\f\r\v]*[:=][ \t\n\f\r\v]*[''"]?[^''";, }\t\n\f\r\v]+', 'passwd=***', 'g'),
  '(?is)(api_key|api-key|apikey)[''"]?[ \t\n\f\r\v]*[:=][ \t\n\f\r\v]*[''"]?[^''";, }\t\n\f\r\v]+', 'api_key=***', 'g'),
  '(?is)token[''"]?[ \t\n\f\r\v]*[:=][ \t\n\f\r\v]*[''"]?[^''";, }\t\n\f\r\v]+', 'token=***', 'g'),
  '(?is)secret[''"]?[ \t\n\f\r\v]*[:=][ \t\n\f\r\v]*[''"]?[^''";, }\t\n\f\r\v]+', 'secret=***', 'g'),
  '(?is)-----BEGIN (RSA )?PRIVATE KEY-----.*?-----END (RSA )?PRIVATE KEY-----', '-----BEGIN PRIVATE KEY----- [REDACTED] -----END PRIVATE KEY-----', 'g'),
  '(?is)Authorization:[ \t\n\f\r\v]*Bearer[ \t\n\f\r\v]+[^ \t\n\f\r\v]+', 'Authorization: Bearer ***', 'g'),
  '(?is)Authorization:[ \t\n\f\r\v]*Basic[ \t\n\f\r\v]+[^ \t\n\f\r\v]+', 'Authorization: Basic ***', 'g')
"""


@query(
    "redact_text",
    f"""
SELECT doc_id, md5(r) AS redacted_md5, r <> text AS changed, length(r) AS n_chars_redacted
FROM (SELECT doc_id, text, {_REDACTED} AS r FROM documents)
""",
)
def redact_text(spark, sf_dir):
    """Credential patterns removed from every document (whole texts)."""
    (d,) = D.tables(spark, sf_dir, "documents")
    red = R.redact(F.col("text"))
    return d.select("doc_id", F.md5(red).alias("redacted_md5"), (red != F.col("text")).alias("changed"), F.length(red).cast("long").alias("n_chars_redacted"))


# The class of each error text above, by hand: the third and fifth name no known class
# (a name stands inside the phrase) and stay as they are, the last one's key is masked.
@query(
    "error_classes",
    """
SELECT CASE event_id % 8
         WHEN 0 THEN 'Unable to connect to destination database'
         WHEN 1 THEN 'Database authentication failed'
         WHEN 2 THEN 'relation "tbl_' || CAST(user_id % 10 AS VARCHAR) || '" does not exist'
         WHEN 3 THEN 'Database operation timeout'
         WHEN 4 THEN 'column "value" does not exist in target tbl_' || CAST(user_id % 10 AS VARCHAR)
         WHEN 5 THEN 'SSL/TLS connection error'
         WHEN 6 THEN 'Database connection was interrupted'
         ELSE 'unexpected value for api_key=***' END AS error_class, count(*) AS n
FROM events WHERE event_type = 'error' GROUP BY 1
""",
)
def error_classes(spark, sf_dir):
    """R2: failures by error class (first matching category; otherwise the
    friendly or redacted message)."""
    f = outcomes(spark, sf_dir).filter(~F.col("ok"))
    return f.groupBy(R.error_class(F.col("error_message")).alias("error_class")).agg(F.count("*").alias("n"))


def _deliveries(df, ts_col: str, path: str, slices: int) -> list[str]:
    """Lay ``df`` down as ``slices`` folders, one time slice each, in one write."""
    t = F.unix_micros(F.col(ts_col).cast("timestamp"))
    bounds = df.select(F.min(t).alias("lo"), F.max(t).alias("hi")).first()
    if bounds["lo"] is None:
        return []
    step = -(-(int(bounds["hi"]) + 1 - int(bounds["lo"])) // slices)
    df.withColumn("slice", F.floor((t - bounds["lo"]) / step).cast("int")).write.partitionBy("slice").parquet(path)
    return [f"{path}/slice={i}" for i in range(slices)]


def _run_state_stream(spark, frame, ts_col, builder, name):
    """Four time-ordered deliveries, each followed by a run of the query that
    resumes from its checkpoint; then a tick beyond the last row."""
    from tidemark.streaming import alert_state as ST
    from tidemark.streaming import changes as S

    base = S.fresh_dir(spark, name)
    frame = frame.withColumn("tick", F.lit(False))
    src = f"{base}/src"
    last = frame.agg(F.max(ts_col)).first()[0]
    for folder in _deliveries(frame, ts_col, f"{base}/slices", 4):
        if S.path_exists(spark, folder):
            spark.read.schema(frame.schema).parquet(folder).write.mode("append").parquet(src)
        ST.run_state_stream(spark, builder(spark.readStream.schema(frame.schema).parquet(src)), f"{base}/out", f"{base}/ckpt")
    if last is not None:
        ticks = frame.limit(1).withColumn(ts_col, F.lit(last) + F.expr("INTERVAL 2 HOURS")).withColumn("tick", F.lit(True))
        ticks.select(*frame.columns).write.mode("append").parquet(src)
        ST.run_state_stream(spark, builder(spark.readStream.schema(frame.schema).parquet(src)), f"{base}/out", f"{base}/ckpt")
    return spark.read.parquet(f"{base}/out")


from tidemark.plans.registry import ORACLE as _TWINS  # noqa: E402


@query("alert_iterations_stream", _TWINS["alert_iterations"])
def alert_iterations_stream(spark, sf_dir):
    """V5 as a stateful stream (``transformWithStateInPandas``): failures arrive
    in four time-ordered deliveries and the query is restarted for each; each
    key's counter lives in the state store.  Must equal the batch fold."""
    from tidemark.streaming.alert_state import iteration_stream

    f = AL.compose(outcomes(spark, sf_dir).filter(~F.col("ok"))).select("event_id", "ts", "key_notification", "is_force_sent")
    out = _run_state_stream(spark, f, "ts", lambda st: iteration_stream(st, "key_notification", "ts", "event_id", "is_force_sent"), "alert-iter")
    return out.select("event_id", "key_notification", "notification_no", "iteration_check")


@query("alert_throttle_stream", _TWINS["alert_throttle"])
def alert_throttle_stream(spark, sf_dir):
    """V6 as a stateful stream: the last creation time per key lives in the
    state store between restarts.  Must equal the batch fold."""
    from tidemark.streaming.alert_state import throttle_stream

    (ev,) = D.tables(spark, sf_dir, "events")
    a = ev.select(
        (F.col("user_id") % D.EVENT_TABLES).alias("k"), "event_id", "ts", (F.col("event_id") % 4 == 0).alias("acked")
    )
    out = _run_state_stream(spark, a, "ts", lambda st: throttle_stream(st, "k", "ts", "event_id", "acked"), "alert-throttle")
    return out.select("event_id", "k", "create")
