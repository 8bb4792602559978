"""Queries for backfill: S4-S7, M6, M7."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans import derived as D
from tidemark.plans.registry import query, with_ctes
from tidemark.sources import backfill as B

NOW = "2001-09-01 00:00:00"


def backfill_jobs(spark, sf_dir) -> DataFrame:
    """One backfill job per customer, derived from its orders: progress =
    finished orders, cursor = the largest finished order key."""
    o, c = D.tables(spark, sf_dir, "orders", "customer")
    per = o.groupBy("o_custkey").agg(
        F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("count_record"),
        F.count("*").alias("total_record"),
        F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey"))).alias("last_pk_value"),
        F.min("o_orderdate").alias("created_at"),
        F.max("o_orderdate").alias("updated_at"),
    )
    status = F.element_at(F.array(*[F.lit(s) for s in B.STATUSES]), (F.col("o_custkey") % 5 + 1).cast("int"))
    return per.join(c.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("source_id")), "o_custkey").select(
        F.col("o_custkey").alias("job_id"),
        "source_id",
        F.concat(F.lit("tbl_"), (F.col("o_custkey") % 10).cast("string")).alias("table_name"),
        status.alias("status"),
        "count_record",
        "total_record",
        (F.col("o_custkey") % 4).cast("int").alias("resume_attempts"),
        "last_pk_value",
        F.lit("o_orderkey").alias("pk_column"),
        F.lit(None).cast("string").alias("error_message"),
        "created_at",
        "updated_at",
    )


BACKFILL_JOBS = """
backfill_jobs AS (
  SELECT o.o_custkey AS job_id, c.c_nationkey AS source_id, 'tbl_' || CAST(o.o_custkey % 10 AS VARCHAR) AS table_name,
         (['PENDING', 'EXECUTING', 'COMPLETED', 'FAILED', 'CANCELLED'])[o.o_custkey % 5 + 1] AS status,
         count(CASE WHEN o.o_orderstatus = 'F' THEN 1 END) AS count_record, count(*) AS total_record,
         CAST(o.o_custkey % 4 AS INTEGER) AS resume_attempts,
         max(CASE WHEN o.o_orderstatus = 'F' THEN o.o_orderkey END) AS last_pk_value,
         'o_orderkey' AS pk_column, CAST(NULL AS VARCHAR) AS error_message,
         min(o.o_orderdate) AS created_at, max(o.o_orderdate) AS updated_at
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY o.o_custkey, c.c_nationkey)
"""


@query(
    "backfill_snapshot",
    """
SELECT o_orderkey, o_custkey, o_totalprice, 'r' AS op FROM orders
WHERE o_orderstatus = 'F' AND o_totalprice > 100000
""",
)
def backfill_snapshot(spark, sf_dir):
    """Filtered snapshot as ``r`` events (filter pushed to the scan)."""
    (o,) = D.tables(spark, sf_dir, "orders")
    filters = [
        {"column": "o_orderstatus", "operator": "=", "value": "F"},
        {"column": "o_totalprice", "operator": ">", "value": "100000"},
    ]
    return B.snapshot_filtered(o.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"), filters).drop("o_orderstatus")


@query(
    "backfill_keyset_page",
    """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey > 1000 ORDER BY o_orderkey LIMIT 10000
""",
)
def backfill_keyset_page(spark, sf_dir):
    """One keyset page (10,000 rows after the cursor)."""
    (o,) = D.tables(spark, sf_dir, "orders")
    return B.keyset_page(o.select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey", 1000, 10_000)


_LINE_PAGE_COLS = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate"


@query(
    "backfill_offset_page",
    f"""
SELECT {_LINE_PAGE_COLS} FROM (
  SELECT {_LINE_PAGE_COLS}, row_number() OVER (ORDER BY {_LINE_PAGE_COLS}) - 1 AS idx FROM lineitem)
WHERE idx >= 20000 AND idx < 30000
""",
)
def backfill_offset_page(spark, sf_dir):
    """Positional page of a table without a unique key (ordered by all
    columns, computed from a distributed global index)."""
    (li,) = D.tables(spark, sf_dir, "lineitem")
    cols = [c.strip() for c in _LINE_PAGE_COLS.split(",")]
    return B.offset_page(li.select(*cols), 20_000, 10_000)


@query(
    "backfill_chunk_plan",
    """
WITH idx AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders),
total AS (SELECT count(*) AS n FROM orders),
chunks AS (SELECT CAST(i // 1000 AS BIGINT) AS chunk_no, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key, count(*) AS n_rows
           FROM idx GROUP BY 1)
SELECT chunk_no, first_key, last_key, n_rows,
       CAST(least((chunk_no + 1) * 1000, total.n) AS BIGINT) AS cumulative_rows, CAST(total.n AS BIGINT) AS total_rows,
       round(least((chunk_no + 1) * 1000, total.n) / total.n * 100, 2) AS percent_done
FROM chunks, total
""",
)
def backfill_chunk_plan(spark, sf_dir):
    """Chunks of 1,000 keys with cumulative progress."""
    (o,) = D.tables(spark, sf_dir, "orders")
    return B.chunk_plan(o.select("o_orderkey"), "o_orderkey", 1000)


@query(
    "backfill_recover",
    with_ctes(BACKFILL_JOBS)
    + """
SELECT job_id, source_id, table_name, count_record, total_record, resume_attempts, last_pk_value, pk_column, created_at,
       CASE WHEN status = 'EXECUTING' AND resume_attempts >= 3 THEN 'FAILED'
            WHEN status = 'EXECUTING' THEN 'PENDING' ELSE status END AS status,
       CASE WHEN status = 'EXECUTING' AND resume_attempts >= 3 THEN 'Maximum resume attempts exceeded after compute restart'
            ELSE error_message END AS error_message,
       CASE WHEN status = 'EXECUTING' THEN TIMESTAMP '2001-09-01 00:00:00' ELSE updated_at END AS updated_at
FROM backfill_jobs
""",
)
def backfill_recover(spark, sf_dir):
    """M6: startup recovery of EXECUTING jobs (threshold 0 = all of them)."""
    return B.recover_stale(backfill_jobs(spark, sf_dir), NOW, 0)


@query(
    "backfill_next_jobs",
    with_ctes(BACKFILL_JOBS)
    + """
SELECT j.*, n.n_name AS source_name FROM backfill_jobs j JOIN nation n ON j.source_id = n.n_nationkey
WHERE j.status = 'PENDING' ORDER BY j.created_at, j.job_id LIMIT 10
""",
)
def backfill_next_jobs(spark, sf_dir):
    """M7: the ten oldest pending jobs joined to their source."""
    (n,) = D.tables(spark, sf_dir, "nation")
    sources = n.select(F.col("n_nationkey").alias("source_id"), F.col("n_name").alias("source_name"))
    return B.next_jobs(backfill_jobs(spark, sf_dir), sources, 10)


@query(
    "backfill_run",
    """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, 'r' AS op FROM orders
WHERE o_orderstatus = 'F' AND o_totalprice > 100000
""",
)
def backfill_run(spark, sf_dir):
    """S4-S7 end to end: the filtered snapshot written into a target in one job;
    a restart of the job finds it done."""
    from tidemark.streaming import changes as S

    (o,) = D.tables(spark, sf_dir, "orders")
    base = S.fresh_dir(spark, "backfill")
    target = S.Target(spark, f"{base}/target", ["o_orderkey"])
    pred = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000)
    src = o.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    for _ in range(2):
        B.run_backfill(spark, src, target, "job1", f"{base}/progress", pred)
    return target.read().select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "op")
