"""Registry of the named queries and their SQL twins.

A query is a callable ``(spark, sf_dir) -> DataFrame``.  Its SQL twin (when the
operator is SQL-expressible) is an independent formulation of the same result
over the same input tables, used as a correctness oracle.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name!r}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return register


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


# SQL twins of plans/derived.py.
CHG_EVENTS = """
chg_events AS (
  SELECT user_id AS k, event_id AS seq, ts,
         CASE WHEN event_type = 'error' THEN 'd' WHEN event_type = 'signup' THEN 'c' ELSE 'u' END AS op,
         event_type, value, props
  FROM events)
"""

CHG_ORDERS = """
chg_orders AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
         'c' AS op, 1 AS seq, o_orderdate AS ts FROM orders
  UNION ALL
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 100.0, o_orderdate, o_orderpriority,
         'u', 2, o_orderdate + INTERVAL 1 DAY FROM orders WHERE o_orderstatus = 'O'
  UNION ALL
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
         'd', 3, o_orderdate + INTERVAL 2 DAY FROM orders WHERE o_orderpriority = '5-LOW')
"""

ORDERS_STATE = """
orders_state AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
    SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY ts DESC, seq DESC) AS rn
    FROM chg_orders WHERE ts < TIMESTAMP '1998-01-01') WHERE rn = 1 AND op <> 'd')
"""

ORDERS_BATCH = """
orders_batch AS (SELECT * FROM chg_orders WHERE ts >= TIMESTAMP '1998-01-01')
"""

VOLUME_LOG = """
volume_log AS (
  SELECT event_id AS log_id, event_type AS pipeline_name,
         'tbl_' || CAST(user_id % 10 AS VARCHAR) AS table_name,
         CASE WHEN user_id % 2 = 0 THEN 'dest_even' ELSE 'dest_odd' END AS destination_name,
         CAST(1 AS BIGINT) AS record_count, ts AS created_at
  FROM events)
"""

DLQ_MESSAGES = """
dlq_messages AS (
  SELECT seq AS msg_id, 1 AS source_id,
         CASE WHEN k % 2 = 0 THEN 'public.tbl_' ELSE 'tbl_' END || CAST(k % 10 AS VARCHAR) AS table_name,
         CAST(k % 3 + 1 AS INTEGER) AS destination_id, k, op, value,
         CAST(seq % 12 AS INTEGER) AS retry_count, ts AS first_failed_at
  FROM chg_events)
"""

TAG_LINKS = """
tag_links AS (
  SELECT DISTINCT CAST(p_partkey % 50 AS BIGINT) AS sync_id, tag
  FROM (SELECT p_partkey, unnest(string_split(lower(p_type), ' ')) AS tag FROM part))
"""

TAG_LIST = """
tag_list AS (
  SELECT DISTINCT tag FROM (
    SELECT unnest(string_split(lower(p_name), ' ')) AS tag FROM part
    UNION ALL
    SELECT unnest(string_split(lower(p_type), ' ')) AS tag FROM part))
"""

BRANCHES = """
branches AS (
  SELECT sync_id, sync_id % 5 AS pipeline_id, 'pipeline_' || CAST(sync_id % 5 AS VARCHAR) AS pipeline_name,
         sync_id % 3 + 1 AS destination_id, 'dest_' || CAST(sync_id % 3 + 1 AS VARCHAR) AS destination_name,
         'tbl_' || CAST(sync_id % 10 AS VARCHAR) AS table_name
  FROM (SELECT DISTINCT sync_id FROM tag_links))
"""
