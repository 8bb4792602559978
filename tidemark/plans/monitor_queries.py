"""Queries for monitors: A1-A8, A14, T1-T6, U3, W5, M1-M5, M8-M10."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tidemark.operators import apply as A
from tidemark.operators import monitor as M
from tidemark.plans import derived as D
from tidemark.plans.registry import BRANCHES, TAG_LINKS, TAG_LIST, VOLUME_LOG, query, with_ctes

TODAY = D.TODAY
NOW = "2024-01-30 23:59:59"

# ------------------------------------------------------------------ derived monitoring tables


def pipelines(spark, sf_dir):
    (c,) = D.tables(spark, sf_dir, "customer")
    status = F.when(F.col("c_mktsegment") == "BUILDING", "START").when(F.col("c_mktsegment") == "AUTOMOBILE", "PAUSE").otherwise("REFRESH")
    return c.select(F.col("c_custkey").alias("pipeline_id"), F.col("c_name").alias("name"), status.alias("status"))


PIPELINES_SQL = """
pipelines AS (
  SELECT c_custkey AS pipeline_id, c_name AS name,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'START' WHEN c_mktsegment = 'AUTOMOBILE' THEN 'PAUSE' ELSE 'REFRESH' END AS status
  FROM customer)
"""


def metering(spark, sf_dir):
    """Credit usage: one metering record per event."""
    (ev,) = D.tables(spark, sf_dir, "events")
    return ev.select(
        (F.col("user_id") % 3 + 1).alias("destination_id"),
        F.concat(F.lit("dest_"), (F.col("user_id") % 3 + 1).cast("string")).alias("destination_name"),
        F.when(F.col("event_type").isin("purchase", "click"), "PIPE").otherwise("WAREHOUSE_METERING").alias("service_type"),
        (F.col("value") / 100).alias("credits"),
        F.col("ts").alias("usage_time"),
    )


METERING_SQL = """
metering AS (
  SELECT user_id % 3 + 1 AS destination_id, 'dest_' || CAST(user_id % 3 + 1 AS VARCHAR) AS destination_name,
         CASE WHEN event_type IN ('purchase', 'click') THEN 'PIPE' ELSE 'WAREHOUSE_METERING' END AS service_type,
         value / 100 AS credits, ts AS usage_time
  FROM events)
"""


def wal_metrics(spark, sf_dir):
    """Replication-lag series: one measurement per event, per source."""
    (ev,) = D.tables(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("metric_id"),
        (F.col("user_id") % 4 + 1).alias("source_id"),
        F.concat(F.lit("source_"), (F.col("user_id") % 4 + 1).cast("string")).alias("source_name"),
        F.round(F.col("value") * F.lit(1e8)).cast("long").alias("size_bytes"),
        F.col("ts").alias("recorded_at"),
        "event_type",
        "value",
    )


WAL_SQL = """
wal_metrics AS (
  SELECT event_id AS metric_id, user_id % 4 + 1 AS source_id, 'source_' || CAST(user_id % 4 + 1 AS VARCHAR) AS source_name,
         CAST(round(value * 1e8) AS BIGINT) AS size_bytes, ts AS recorded_at, event_type, value
  FROM events)
"""


def notifications(spark, sf_dir):
    """Alert log: one notification per event."""
    (ev,) = D.tables(spark, sf_dir, "events")
    i = F.col("event_id")
    return ev.select(
        i.alias("notification_id"),
        F.concat(F.col("event_type"), F.lit(":tbl_"), (F.col("user_id") % 10).cast("string")).alias("key_notification"),
        F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO").alias("type"),
        F.concat(F.lit("Pipeline "), F.col("event_type"), F.lit(" on tbl_"), (F.col("user_id") % 10).cast("string")).alias("title"),
        (i % 4 == 0).alias("is_read"),
        (i % 9 == 0).alias("is_deleted"),
        (i % 6 + 1).cast("int").alias("iteration_check"),
        (i % 3 == 0).alias("is_sent"),
        (i % 7 == 0).alias("is_force_sent"),
        F.col("ts").alias("created_at"),
    )


NOTIFICATIONS_SQL = """
notifications AS (
  SELECT event_id AS notification_id, event_type || ':tbl_' || CAST(user_id % 10 AS VARCHAR) AS key_notification,
         CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS type,
         'Pipeline ' || event_type || ' on tbl_' || CAST(user_id % 10 AS VARCHAR) AS title,
         event_id % 4 = 0 AS is_read, event_id % 9 = 0 AS is_deleted, CAST(event_id % 6 + 1 AS INTEGER) AS iteration_check,
         event_id % 3 = 0 AS is_sent, event_id % 7 = 0 AS is_force_sent, ts AS created_at
  FROM events)
"""

# ------------------------------------------------------------------ A1-A8


@query(
    "status_summary",
    with_ctes(PIPELINES_SQL)
    + """
, counts AS (SELECT status, count(*) AS n FROM pipelines GROUP BY status),
filled AS (
  SELECT COALESCE(k.status, c.status) AS status, CAST(COALESCE(c.n, 0) AS BIGINT) AS n
  FROM (VALUES ('START'), ('PAUSE'), ('ERROR')) k(status) FULL OUTER JOIN counts c ON c.status = k.status)
SELECT status, n FROM filled UNION ALL SELECT 'total', CAST(sum(n) AS BIGINT) FROM filled
""",
)
def status_summary(spark, sf_dir):
    """A1: pipelines per status, known statuses zero-filled, plus the total."""
    return M.status_summary(pipelines(spark, sf_dir), "status", ["START", "PAUSE", "ERROR"])


@query(
    "volume_today_yesterday",
    with_ctes(VOLUME_LOG)
    + f"""
SELECT CAST(COALESCE(sum(CASE WHEN CAST(created_at AS DATE) = DATE '{TODAY}' THEN record_count END), 0) AS BIGINT) AS total_today,
       CAST(COALESCE(sum(CASE WHEN CAST(created_at AS DATE) = DATE '{TODAY}' - 1 THEN record_count END), 0) AS BIGINT) AS total_yesterday
FROM volume_log
""",
)
def volume_today_yesterday(spark, sf_dir):
    """A2: records written today and yesterday."""
    return M.day_totals(D.volume_log(spark, sf_dir), "created_at", "record_count", TODAY)


@query(
    "volume_daily_pivot",
    with_ctes(VOLUME_LOG)
    + """
, spine AS (SELECT CAST(DATE '2024-01-24' + CAST(i AS INTEGER) AS DATE) AS day FROM range(0, 8) t(i)),
cells AS (  -- every day with every pipeline of the range
  SELECT s.day, n.pipeline_name, CAST(COALESCE(sum(v.record_count), 0) AS BIGINT) AS n
  FROM spine s CROSS JOIN (SELECT DISTINCT pipeline_name FROM volume_log WHERE CAST(created_at AS DATE) >= DATE '2024-01-24') n
  LEFT JOIN volume_log v ON CAST(v.created_at AS DATE) = s.day AND v.pipeline_name = n.pipeline_name
  GROUP BY s.day, n.pipeline_name)
SELECT * REPLACE (strftime(day, '%Y-%m-%d') AS day) FROM (PIVOT cells ON pipeline_name USING first(n) GROUP BY day)
""",
)
def volume_daily_pivot(spark, sf_dir):
    """A3: daily records per pipeline over the last 7 days + today, one
    column for every pipeline that the range holds, every day present (0 when idle)."""
    out = M.daily_pivot(D.volume_log(spark, sf_dir), "created_at", "pipeline_name", "record_count", "2024-01-24", 7)
    return out.select(F.date_format("day", "yyyy-MM-dd").alias("day"), *[F.col(f"`{p}`").cast("long").alias(p) for p in out.columns if p != "day"])


@query(
    "cost_daily_pivot",
    with_ctes(METERING_SQL)
    + """
, spine AS (SELECT CAST(DATE '2024-01-01' + CAST(i AS INTEGER) AS DATE) AS day FROM range(0, 30) t(i)),
cells AS (
  SELECT s.day, n.destination_name, COALESCE(sum(m.credits), 0) AS credits
  FROM spine s CROSS JOIN (SELECT DISTINCT destination_name FROM metering WHERE CAST(usage_time AS DATE) >= DATE '2024-01-01') n
  LEFT JOIN metering m ON CAST(m.usage_time AS DATE) = s.day AND m.destination_name = n.destination_name
  GROUP BY s.day, n.destination_name),
totals AS (SELECT day, round(sum(sum(credits)) OVER (ORDER BY day), 4) AS month_to_date FROM cells GROUP BY day)
SELECT p.* REPLACE (strftime(p.day, '%Y-%m-%d') AS day), t.month_to_date
FROM (PIVOT (SELECT day, destination_name, round(credits, 4) AS credits FROM cells) ON destination_name USING first(credits) GROUP BY day) p
JOIN totals t USING (day)
""",
)
def cost_daily_pivot(spark, sf_dir):
    """A4: daily credits per destination (whichever there are) for the month,
    pivoted and filled, with the month-to-date running total (over 30 day rows)."""
    out = M.daily_pivot(metering(spark, sf_dir), "usage_time", "destination_name", "credits", "2024-01-01", 29)
    names = [c for c in out.columns if c != "day"]
    total = reduce(lambda x, y: x + y, [F.col(f"`{c}`") for c in names], F.lit(0.0))
    out = M.running_total(out.withColumn("__day_total", total), "day", "__day_total", "month_to_date")
    return out.select(
        F.date_format("day", "yyyy-MM-dd").alias("day"),
        *[F.round(F.col(f"`{c}`"), 4).alias(c) for c in names],
        F.round("month_to_date", 4).alias("month_to_date"),
    )


@query(
    "lag_hourly_avg",
    with_ctes(WAL_SQL)
    + """
, cells AS (
  SELECT date_trunc('hour', recorded_at) AS hour, source_name, round(avg(size_bytes), 2) AS mean
  FROM wal_metrics WHERE recorded_at >= TIMESTAMP '2024-01-29 23:59:59' GROUP BY 1, 2)
SELECT * FROM (PIVOT cells ON source_name USING first(mean) GROUP BY hour)
""",
)
def lag_hourly_avg(spark, sf_dir):
    """A5: hourly mean lag over the last day, a column for every source that the day
    holds (no fill)."""
    out = M.hourly_avg_pivot(wal_metrics(spark, sf_dir), "recorded_at", "source_name", "size_bytes", "2024-01-29 23:59:59")
    return out.select("hour", *[F.round(F.col(f"`{c}`"), 2).alias(c) for c in out.columns if c != "hour"])


def throughput_log(spark, sf_dir):
    (ev,) = D.tables(spark, sf_dir, "events")
    return ev.select(
        F.when(F.col("event_type") == "view", F.lit(None)).otherwise(F.col("user_id") % 50).cast("long").alias("sync_id"),
        (F.col("user_id") % 4 + 1).alias("destination_id"),
        F.concat(F.lit("tbl_"), (F.col("user_id") % 10).cast("string")).alias("table_name"),
        F.lit(1).cast("long").alias("record_count"),
        F.col("ts").alias("created_at"),
    )


THROUGHPUT_SQL = """
throughput_log AS (
  SELECT CAST(CASE WHEN event_type = 'view' THEN NULL ELSE user_id % 50 END AS BIGINT) AS sync_id,
         user_id % 4 + 1 AS destination_id, 'tbl_' || CAST(user_id % 10 AS VARCHAR) AS table_name,
         CAST(1 AS BIGINT) AS record_count, ts AS created_at
  FROM events)
"""


@query(
    "lineage_flow_stats",
    with_ctes(THROUGHPUT_SQL, TAG_LINKS, BRANCHES)
    + f"""
, dests AS (SELECT DISTINCT destination_id, destination_name FROM branches),
keyed AS (
  SELECT CASE WHEN t.sync_id IS NOT NULL THEN 'sync:' || CAST(t.sync_id AS VARCHAR)
              ELSE 'dest:' || CAST(t.destination_id AS VARCHAR) || ':' || t.table_name END AS lineage_key,
         COALESCE(d.destination_name, 'Unknown Destination') AS destination_name, t.table_name, t.record_count, t.created_at
  FROM throughput_log t LEFT JOIN dests d ON d.destination_id = t.destination_id),
daily AS (SELECT lineage_key, destination_name, table_name, strftime(CAST(created_at AS DATE), '%Y-%m-%d') AS day,
                 CAST(sum(record_count) AS BIGINT) AS n FROM keyed GROUP BY ALL),
recent AS (SELECT lineage_key, CAST(sum(record_count) AS BIGINT) AS recent_5m FROM keyed
           WHERE created_at >= TIMESTAMP '{NOW}' - INTERVAL 5 MINUTE GROUP BY lineage_key)
SELECT d.*, COALESCE(r.recent_5m, 0) AS recent_5m FROM daily d LEFT JOIN recent r ON r.lineage_key = d.lineage_key
""",
)
def lineage_flow_stats(spark, sf_dir):
    """Daily records per lineage (branch if known, else destination +
    table), destination names from metadata ("Unknown Destination" when
    missing), plus each lineage's last-5-minutes volume."""
    t = throughput_log(spark, sf_dir)
    dests = D.branches(spark, sf_dir).select("destination_id", "destination_name").distinct()
    key = F.when(F.col("sync_id").isNotNull(), F.concat(F.lit("sync:"), F.col("sync_id").cast("string"))).otherwise(
        F.concat(F.lit("dest:"), F.col("destination_id").cast("string"), F.lit(":"), F.col("table_name"))
    )
    keyed = t.join(dests, "destination_id", "left").select(
        key.alias("lineage_key"),
        F.coalesce("destination_name", F.lit("Unknown Destination")).alias("destination_name"),
        "table_name",
        "record_count",
        "created_at",
    )
    daily = keyed.groupBy("lineage_key", "destination_name", "table_name", F.date_format(F.to_date("created_at"), "yyyy-MM-dd").alias("day")).agg(
        F.sum("record_count").cast("long").alias("n")
    )
    since = F.lit(NOW).cast("timestamp_ntz") - F.expr("INTERVAL 5 MINUTES")
    recent = keyed.filter(F.col("created_at") >= since).groupBy("lineage_key").agg(F.sum("record_count").cast("long").alias("recent_5m"))
    return daily.join(recent, "lineage_key", "left").withColumn("recent_5m", F.coalesce("recent_5m", F.lit(0)).cast("long"))


@query(
    "cost_daily",
    with_ctes(METERING_SQL)
    + f"""
, pipes AS (SELECT DISTINCT destination_id, destination_name FROM metering WHERE destination_id <> 2)
SELECT strftime(CAST(m.usage_time AS DATE), '%Y-%m-%d') AS day, round(sum(m.credits), 4) AS credits
FROM metering m LEFT JOIN pipes p ON p.destination_id = m.destination_id
WHERE m.service_type = 'PIPE' AND p.destination_name IS NOT NULL
  AND CAST(m.usage_time AS DATE) >= DATE '{TODAY}' - 30
GROUP BY 1
""",
)
def cost_daily(spark, sf_dir):
    """A7 + J13: daily pipe credits over the last 30 days for destinations
    that still have pipes (left join + post-filter on the right side, which
    Catalyst turns into an inner join)."""
    m = metering(spark, sf_dir)
    pipes = m.filter(F.col("destination_id") != 2).select("destination_id", F.col("destination_name").alias("pipe_name")).distinct()
    d = F.to_date("usage_time")
    j = m.join(pipes, "destination_id", "left").filter((F.col("service_type") == "PIPE") & F.col("pipe_name").isNotNull() & (d >= F.date_sub(F.lit(TODAY).cast("date"), 30)))
    return j.groupBy(F.date_format(d, "yyyy-MM-dd").alias("day")).agg(F.round(F.sum("credits"), 4).alias("credits"))


@query(
    "cost_calendar_compare",
    with_ctes(METERING_SQL)
    + f"""
, b AS (SELECT CAST(usage_time AS DATE) AS d, credits FROM metering),
k AS (SELECT CAST(date_trunc('week', DATE '{TODAY}') AS DATE) AS wk, CAST(date_trunc('month', DATE '{TODAY}') AS DATE) AS mo)
SELECT round(COALESCE(sum(CASE WHEN d >= wk AND d <= DATE '{TODAY}' THEN credits END), 0), 6) AS this_week,
       round(COALESCE(sum(CASE WHEN d >= wk - 7 AND d < wk THEN credits END), 0), 6) AS previous_week,
       round(COALESCE(sum(CASE WHEN d >= mo AND d <= DATE '{TODAY}' THEN credits END), 0), 6) AS this_month,
       round(COALESCE(sum(CASE WHEN d >= CAST(mo - INTERVAL 1 MONTH AS DATE) AND d < mo THEN credits END), 0), 6) AS previous_month
FROM b, k
""",
)
def cost_calendar_compare(spark, sf_dir):
    """this/previous week (Monday start) and this/previous month."""
    return M.calendar_compare(metering(spark, sf_dir), "usage_time", "credits", TODAY)


@query(
    "cost_recent_days",
    with_ctes(METERING_SQL)
    + f"""
SELECT strftime(CAST(usage_time AS DATE), '%Y-%m-%d') AS day, destination_name, round(sum(credits), 4) AS credits
FROM metering WHERE CAST(usage_time AS DATE) >= DATE '{TODAY}' - 30
GROUP BY 1, 2 ORDER BY 1 DESC, 2
""",
)
def cost_recent_days(spark, sf_dir):
    """Daily credits per destination, last 30 days, newest first."""
    m = metering(spark, sf_dir)
    d = F.to_date("usage_time")
    out = m.filter(d >= F.date_sub(F.lit(TODAY).cast("date"), 30)).groupBy(F.date_format(d, "yyyy-MM-dd").alias("day"), "destination_name").agg(
        F.round(F.sum("credits"), 4).alias("credits")
    )
    return out.orderBy(F.col("day").desc(), "destination_name")


# ------------------------------------------------------------------ A14, T1-T5, U3


@query(
    "health_unhealthy",
    with_ctes(VOLUME_LOG)
    + f"""
, tables AS (SELECT DISTINCT 'tbl_' || CAST(user_id % 12 AS VARCHAR) AS table_name FROM events),
last AS (SELECT table_name, max(created_at) AS last_seen FROM volume_log WHERE pipeline_name <> 'error' GROUP BY table_name)
SELECT t.table_name, last_seen FROM tables t LEFT JOIN last USING (table_name)
WHERE last_seen IS NULL OR last_seen < TIMESTAMP '{NOW}' - INTERVAL 1 HOUR
""",
)
def health_unhealthy(spark, sf_dir):
    """Published tables whose last successful write is older than an hour,
    those that never had one included."""
    (ev,) = D.tables(spark, sf_dir, "events")
    published = ev.select(F.concat(F.lit("tbl_"), (F.col("user_id") % 12).cast("string")).alias("table_name"))
    return M.unhealthy(published, D.volume_log(spark, sf_dir), NOW, F.col("pipeline_name") != "error")


@query(
    "group_coalesce_count",
    """
SELECT COALESCE(CASE WHEN event_id % 2 = 0 THEN NULL ELSE event_type END, 'unknown') AS app, count(*) AS n,
       count(*) FILTER (WHERE value > 50) AS active
FROM events GROUP BY 1 ORDER BY n DESC, app
""",
)
def group_coalesce_count(spark, sf_dir):
    """Connections per application (NULL -> 'unknown'), active ones
    counted alongside, largest first."""
    (ev,) = D.tables(spark, sf_dir, "events")
    app = F.when(F.col("event_id") % 2 != 0, F.col("event_type"))
    out = ev.groupBy(F.coalesce(app, F.lit("unknown")).alias("app")).agg(
        F.count("*").alias("n"), F.count(F.when(F.col("value") > 50, 1)).alias("active")
    )
    return out.orderBy(F.col("n").desc(), "app")


@query(
    "topn_tables",
    with_ctes(VOLUME_LOG)
    + f"""
SELECT table_name, CAST(sum(record_count) AS BIGINT) AS total FROM volume_log
WHERE CAST(created_at AS DATE) = DATE '{TODAY}' GROUP BY table_name ORDER BY total DESC, table_name LIMIT 5
""",
)
def topn_tables(spark, sf_dir):
    """The five tables with most records today."""
    v = D.volume_log(spark, sf_dir).filter(F.to_date("created_at") == F.lit(TODAY).cast("date"))
    return M.top_n(v, "table_name", "record_count", 5, "total").select("table_name", F.col("total").cast("long").alias("total"))


@query(
    "page_newest",
    with_ctes(NOTIFICATIONS_SQL)
    + """
SELECT * FROM notifications WHERE NOT is_deleted AND NOT is_read
ORDER BY created_at DESC, notification_id DESC LIMIT 20 OFFSET 40
""",
)
def page_newest(spark, sf_dir):
    """Page 3 (20 per page) of unread, undeleted alerts, newest first."""
    n = notifications(spark, sf_dir)
    return M.page_newest(n, "created_at", "notification_id", 40, 20, ~F.col("is_deleted") & ~F.col("is_read"))


@query(
    "lag_range_units",
    with_ctes(WAL_SQL)
    + """
SELECT metric_id, source_id, recorded_at, size_bytes,
       round(size_bytes / 1048576.0, 2) AS size_mb, round(size_bytes / 1073741824.0, 4) AS size_gb
FROM wal_metrics WHERE source_id = 2 AND recorded_at BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-12'
""",
)
def lag_range_units(spark, sf_dir):
    """One source's lag series in a time range, with MB and GB columns."""
    w = wal_metrics(spark, sf_dir)
    r = w.filter((F.col("source_id") == 2) & F.col("recorded_at").between(F.lit("2024-01-10").cast("timestamp_ntz"), F.lit("2024-01-12").cast("timestamp_ntz")))
    return r.select(
        "metric_id",
        "source_id",
        "recorded_at",
        "size_bytes",
        F.round(F.col("size_bytes") / F.lit(1048576.0), 2).alias("size_mb"),
        F.round(F.col("size_bytes") / F.lit(1073741824.0), 4).alias("size_gb"),
    )


@query(
    "search_contains",
    with_ctes(TAG_LIST) + "SELECT tag FROM tag_list WHERE contains(lower(tag), 'e') ORDER BY tag LIMIT 10",
)
def search_contains(spark, sf_dir):
    """T4: case-insensitive substring search over tags, ordered, limited."""
    tl = D.tag_list(spark, sf_dir)
    return tl.filter(F.lower("tag").contains("E".lower())).orderBy("tag").limit(10)


@query(
    "activity_feed",
    with_ctes(NOTIFICATIONS_SQL, PIPELINES_SQL)
    + """
, errors AS (SELECT created_at AS ts, title AS message, key_notification AS source, 'ERROR' AS type
             FROM notifications WHERE type = 'ERROR' ORDER BY created_at DESC, notification_id DESC LIMIT 10),
statuses AS (SELECT CAST(NULL AS TIMESTAMP) AS ts, 'Status changed to ' || status AS message, name AS source, 'STATUS' AS type
             FROM pipelines ORDER BY pipeline_id LIMIT 10)
SELECT * FROM (SELECT * FROM errors UNION ALL SELECT * FROM statuses)
ORDER BY ts DESC NULLS LAST, source LIMIT 10
""",
)
def activity_feed(spark, sf_dir):
    """T5: newest errors and status changes merged: both top-10 lists, status
    text rewritten, re-sorted newest first with unknown times last, cut to 10."""
    n = notifications(spark, sf_dir).filter(F.col("type") == "ERROR")
    errors = n.orderBy(F.col("created_at").desc(), F.col("notification_id").desc()).limit(10).select(
        F.col("created_at").alias("ts"), F.col("title").alias("message"), F.col("key_notification").alias("source"), F.lit("ERROR").alias("type")
    )
    p = pipelines(spark, sf_dir)
    statuses = p.orderBy("pipeline_id").limit(10).select(
        F.lit(None).cast("timestamp_ntz").alias("ts"), F.concat(F.lit("Status changed to "), F.col("status")).alias("message"), F.col("name").alias("source"), F.lit("STATUS").alias("type")
    )
    return errors.unionByName(statuses).orderBy(F.col("ts").desc_nulls_last(), "source").limit(10)


@query(
    "distinct_pairs",
    with_ctes(TAG_LINKS, BRANCHES) + "SELECT DISTINCT pipeline_id, destination_id FROM branches",
)
def distinct_pairs(spark, sf_dir):
    """Distinct (pipeline, destination) pairs in use."""
    return D.branches(spark, sf_dir).select("pipeline_id", "destination_id").distinct()


@query(
    "latest_per_key",
    with_ctes(WAL_SQL)
    + """
SELECT source_id, recorded_at, size_bytes FROM (
  SELECT source_id, recorded_at, size_bytes,
         row_number() OVER (PARTITION BY source_id ORDER BY recorded_at DESC, size_bytes DESC) AS rn FROM wal_metrics)
WHERE rn = 1
""",
)
def latest_per_key(spark, sf_dir):
    """The latest measurement per source (max_by, partial aggregate)."""
    return M.latest_state(wal_metrics(spark, sf_dir), ["source_id"], "recorded_at", ["size_bytes"])


# ------------------------------------------------------------------ M1-M5, M8-M10

_SIZE_TEXT = """
CASE event_type WHEN 'click' THEN CAST(CAST(round(value * 1000000) AS BIGINT) AS VARCHAR) || ' bytes'
                WHEN 'view' THEN CAST(CAST(round(value * 1000) AS BIGINT) AS VARCHAR) || ' kB'
                WHEN 'purchase' THEN printf('%.1f', CAST(round(value * 1000) AS BIGINT) / 10.0) || ' MB'
                WHEN 'signup' THEN printf('%.3f', CAST(round(value * 100) AS BIGINT) / 1000.0) || ' GB'
                ELSE printf('%.4f', CAST(round(value * 10) AS BIGINT) / 10000.0) || ' TB' END
"""


def _size_text():
    et, v = F.col("event_type"), F.col("value")

    def scaled(factor: float) -> F.Column:
        return F.round(v * F.lit(factor)).cast("long")

    return (
        F.when(et == "click", F.concat(scaled(1e6).cast("string"), F.lit(" bytes")))
        .when(et == "view", F.concat(scaled(1000).cast("string"), F.lit(" kB")))
        .when(et == "purchase", F.concat(F.format_string("%.1f", scaled(1000) / F.lit(10.0)), F.lit(" MB")))
        .when(et == "signup", F.concat(F.format_string("%.3f", scaled(100) / F.lit(1000.0)), F.lit(" GB")))
        .otherwise(F.concat(F.format_string("%.4f", scaled(10) / F.lit(10000.0)), F.lit(" TB")))
    )


@query(
    "lag_threshold",
    with_ctes(WAL_SQL)
    + f"""
, t AS (SELECT metric_id, {_SIZE_TEXT} AS total_wal_size FROM wal_metrics),
p AS (SELECT metric_id, total_wal_size,
             COALESCE(CAST(regexp_extract(total_wal_size, '^([0-9]+(\\.[0-9]+)?)', 1) AS DOUBLE) *
               CASE regexp_extract(total_wal_size, '([A-Za-z]+)$', 1)
                 WHEN 'TB' THEN 1048576.0 WHEN 'GB' THEN 1024.0 WHEN 'MB' THEN 1.0 WHEN 'kB' THEN 1.0 / 1024
                 WHEN 'bytes' THEN 1.0 / 1048576 WHEN 'B' THEN 1.0 / 1048576 END, 0.0) AS size_mb
      FROM t)
SELECT metric_id, total_wal_size, round(size_mb, 4) AS size_mb,
       CASE WHEN size_mb >= 6000 THEN 'ERROR' WHEN size_mb >= 3000 THEN 'WARNING' END AS level
FROM p
""",
)
def lag_threshold(spark, sf_dir):
    """M1: WAL size text -> MB (every unit, TB and bytes included) and the
    WARNING (>= 3000 MB) / ERROR (>= 6000 MB) label."""
    w = wal_metrics(spark, sf_dir).select("metric_id", _size_text().alias("total_wal_size"))
    mb = M.size_text_to_mb(F.col("total_wal_size"))
    return w.select("metric_id", "total_wal_size", F.round(mb, 4).alias("size_mb"), M.wal_threshold_label(mb).alias("level"))


@query(
    "lag_class",
    with_ctes(WAL_SQL)
    + """
SELECT metric_id, size_bytes,
       CASE WHEN size_bytes > 5368709120 THEN 'ERROR' WHEN size_bytes > 1073741824 THEN 'WARNING' ELSE 'OK' END AS lag_class
FROM wal_metrics
""",
)
def lag_class(spark, sf_dir):
    """M2: replication-lag class (> 5 GiB error, > 1 GiB warning)."""
    w = wal_metrics(spark, sf_dir)
    return w.select("metric_id", "size_bytes", M.lag_class(F.col("size_bytes")).alias("lag_class"))


@query(
    "state_upsert",
    """
WITH sizes AS (
  SELECT user_id AS source_id, CAST(round(value * 1e8) AS BIGINT) AS size_bytes, ts AS recorded_at FROM events),
state AS (SELECT source_id, size_bytes, recorded_at FROM sizes WHERE recorded_at < TIMESTAMP '2024-01-15'
            QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY recorded_at DESC, size_bytes DESC) = 1),
incoming AS (SELECT source_id, size_bytes, recorded_at FROM sizes WHERE recorded_at >= TIMESTAMP '2024-01-15'
             QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY recorded_at DESC, size_bytes DESC) = 1)
SELECT * FROM state s WHERE s.source_id NOT IN (SELECT source_id FROM incoming)
UNION ALL SELECT * FROM incoming
""",
)
def state_upsert(spark, sf_dir):
    """M3: one state row per source (here a user's events); newer measurements
    replace it (K1)."""
    (ev,) = D.tables(spark, sf_dir, "events")
    w = ev.select(
        F.col("user_id").alias("source_id"), F.round(F.col("value") * F.lit(1e8)).cast("long").alias("size_bytes"), F.col("ts").alias("recorded_at")
    )
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    state = M.latest_state(w.filter(F.col("recorded_at") < cut), ["source_id"], "recorded_at", ["size_bytes"])
    incoming = w.filter(F.col("recorded_at") >= cut)
    return A.upsert(state.select("source_id", "size_bytes", "recorded_at"), incoming, ["source_id"], order=["recorded_at", "size_bytes"])


@query(
    "retention_prune",
    with_ctes(NOTIFICATIONS_SQL)
    + f"""
SELECT notification_id, created_at FROM notifications WHERE created_at >= TIMESTAMP '{NOW}' - INTERVAL 10 DAY
""",
)
def retention_prune(spark, sf_dir):
    """M4: retention rewrite -- alerts older than the window are dropped (10
    days here so that the window cuts inside the data)."""
    n = notifications(spark, sf_dir)
    return M.retention(n, "created_at", NOW, 10).select("notification_id", "created_at")


@query(
    "retention_partitions",
    with_ctes(NOTIFICATIONS_SQL)
    + f"""
SELECT notification_id, created_at FROM notifications WHERE created_at >= TIMESTAMP '{NOW}' - INTERVAL 246 HOUR
""",
)
def retention_partitions(spark, sf_dir):
    """M4 on alerts laid out by day: whole days before the cutoff (mid-day here) are
    dropped, the cutoff's day alone is rewritten."""
    from tidemark.session import scratch_path

    n = notifications(spark, sf_dir)
    path = scratch_path(spark, "alerts-by-day")
    n.withColumn("day", F.to_date("created_at").cast("string")).write.partitionBy("day").parquet(path)
    cutoff = n.select((F.lit(NOW).cast("timestamp_ntz") - F.expr("INTERVAL 246 HOURS")).cast("string")).first()
    if cutoff:
        M.prune_days(spark, path, "day", "created_at", cutoff[0])
    return spark.read.schema(n.schema).parquet(path).select("notification_id", "created_at")


@query(
    "alerts_pending",
    with_ctes(NOTIFICATIONS_SQL)
    + """
SELECT notification_id, key_notification, iteration_check, is_force_sent FROM notifications
WHERE (iteration_check >= 3 OR is_force_sent) AND NOT is_sent AND NOT is_deleted AND NOT is_read
""",
)
def alerts_pending(spark, sf_dir):
    """M5: alerts due: repeated 3+ times or forced, and unsent/undeleted/unread."""
    n = notifications(spark, sf_dir)
    return M.pending_alerts(n, 3).select("notification_id", "key_notification", "iteration_check", "is_force_sent")


@query(
    "alerts_bulk_flag",
    with_ctes(NOTIFICATIONS_SQL)
    + """
SELECT notification_id, CASE WHEN NOT is_deleted THEN TRUE ELSE is_read END AS is_read, is_deleted FROM notifications
""",
)
def alerts_bulk_flag(spark, sf_dir):
    """M8: mark every active (undeleted) alert as read."""
    n = notifications(spark, sf_dir)
    return M.bulk_flag(n, "is_read", ~F.col("is_deleted")).select("notification_id", "is_read", "is_deleted")
