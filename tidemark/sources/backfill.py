"""Backfill: snapshot scans, paging, chunk plans and the job table.

A backfill in the reference pages through a table 10,000 rows at a time with
``pk > last ORDER BY pk LIMIT n``.  On Spark the whole history is one scan --
Parquet/JDBC partitions read in parallel with the filter pushed into the scan
-- and paging survives only where it is the feature: a single keyset page for
a resumable cursor, and an exact chunk plan (chunk boundaries, cumulative
progress) computed from a distributed global index rather than a loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import filters as FL
from tidemark.operators import ordering as O

PAGE_SIZE = 10_000
PAGE_RANGES = 32
MAX_RESUME_ATTEMPTS = 3
STATUSES = ["PENDING", "EXECUTING", "COMPLETED", "FAILED", "CANCELLED"]


def snapshot(df: DataFrame, predicate: Column | None = None, op: str = "r") -> DataFrame:
    """The table's current rows as change events (``op='r'``); the
    predicate is an ordinary WHERE (NULL drops) and reaches the scan."""
    if predicate is not None:
        df = df.filter(predicate)
    return df.withColumn("op", F.lit(op))


def snapshot_filtered(df: DataFrame, filters: Sequence[dict]) -> DataFrame:
    """S4 with the backfill filter list (at most five conditions)."""
    return snapshot(df, FL.backfill_predicate(filters, df.schema))


def keyset_page(df: DataFrame, pk: str, last=None, size: int = PAGE_SIZE) -> DataFrame:
    """The next page after cursor ``last`` -- a distributed top-``size``
    (TakeOrdered), not a sort of the whole table."""
    if last is not None:
        df = df.filter(F.col(pk) > F.lit(last))
    return df.orderBy(F.col(pk).asc()).limit(size)


def offset_page(df: DataFrame, offset: int, size: int = PAGE_SIZE, order: Sequence[str] | None = None) -> DataFrame:
    """Page by position when there is no usable single key; the order is
    all columns, so the page is deterministic.

    The rows are counted by ranges of the leading order column, and only the
    ranges that the page touches are sorted and numbered.  ``PAGE_RANGES`` rows,
    picked by hash, name the range bounds; they only spread the work, every row
    is counted."""
    cols = list(order or df.columns)
    lead = F.col(cols[0])
    picked = df.select(lead.alias("b")).filter(F.col("b").isNotNull()).orderBy(F.xxhash64("b"), "b").limit(PAGE_RANGES)
    bounds = picked.distinct().agg(F.array_sort(F.collect_list("b"))).scalar()
    # Rows below a bound come before it; NULLs first (range 0).
    at = F.when(lead.isNull(), 0).otherwise(F.size(F.filter("__bounds", lambda b: b <= lead)) + 1)
    ranged = df.withColumn("__bounds", bounds).withColumn("__range", at).drop("__bounds")
    first, before, touched = None, 0, []
    for r in ranged.groupBy("__range").count().orderBy("__range").collect():
        if before < offset + size and before + r["count"] > offset:
            touched.append(r["__range"])
            first = before if first is None else first
        before += r["count"]
    indexed = O.global_index(ranged.filter(F.col("__range").isin(touched)).drop("__range"), cols, "__idx")
    skip = offset - (first or 0)
    return indexed.filter((F.col("__idx") >= skip) & (F.col("__idx") < skip + size)).drop("__idx")


def chunk_plan(df: DataFrame, pk: str, size: int = PAGE_SIZE) -> DataFrame:
    """The chunks a keyset backfill walks through -- per chunk its key
    range, row count, cumulative count and percent done -- from one global
    index (no per-page loop, no single-task window)."""
    total = df.count()
    indexed = O.global_index(df.select(pk), [pk], "__idx")
    chunks = indexed.groupBy((F.col("__idx") / F.lit(size)).cast("long").alias("chunk_no")).agg(
        F.min(pk).alias("first_key"), F.max(pk).alias("last_key"), F.count("*").alias("n_rows")
    )
    cumulative = F.least((F.col("chunk_no") + 1) * F.lit(size), F.lit(total))
    return chunks.select(
        "chunk_no",
        "first_key",
        "last_key",
        "n_rows",
        cumulative.cast("long").alias("cumulative_rows"),
        F.lit(total).cast("long").alias("total_rows"),
        F.round(cumulative / F.lit(max(total, 1)) * 100, 2).alias("percent_done"),
    )


def recover_stale(jobs: DataFrame, now: str, threshold_minutes: int = 0, max_attempts: int = MAX_RESUME_ATTEMPTS) -> DataFrame:
    """M6: EXECUTING jobs left behind by a stopped worker (all of them when the
    threshold is 0, else those idle longer than it) become FAILED when they
    have used up their resume attempts, otherwise PENDING with the cursor kept."""
    now_ts = F.lit(now).cast("timestamp_ntz")
    stale = F.col("status") == "EXECUTING"
    if threshold_minutes > 0:
        stale = stale & (F.col("updated_at") < now_ts - F.expr(f"INTERVAL {int(threshold_minutes)} MINUTES"))
    exhausted = F.col("resume_attempts") >= max_attempts
    return jobs.select(
        *[c for c in jobs.columns if c not in ("status", "error_message", "updated_at")],
        F.when(stale & exhausted, F.lit("FAILED")).when(stale, F.lit("PENDING")).otherwise(F.col("status")).alias("status"),
        F.when(stale & exhausted, F.lit("Maximum resume attempts exceeded after compute restart"))
        .otherwise(F.col("error_message"))
        .alias("error_message"),
        F.when(stale, now_ts).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def next_jobs(jobs: DataFrame, sources: DataFrame, limit: int = 10) -> DataFrame:
    """M7: the oldest pending jobs (ties by job id) with their source."""
    pending = jobs.filter(F.col("status") == "PENDING")
    return pending.join(sources, "source_id").orderBy(F.col("created_at").asc(), F.col("job_id").asc()).limit(limit)


def run_backfill(
    spark,
    source: DataFrame,
    target,
    job_id: str,
    progress_path: str,
    predicate: Column | None = None,
    backfill_ts: str = "1970-01-01 00:00:00",
) -> DataFrame:
    """Backfill: the filtered snapshot, as ``r`` events that are older than any
    change, written into ``target`` (``streaming.changes.Target``) as a batch of its
    own by one job.  Spark commits the batch as a whole and retries lost tasks; a
    restarted job that finds its batch committed writes nothing, one that doesn't
    writes the same batch again.  Returns the progress rows ``(job_id, n_rows)``,
    each in a folder of its own; one that a crash lost is counted again."""
    from tidemark.streaming.changes import path_exists

    name = f"backfill-{job_id}"
    if not target.written(name):
        snap = snapshot(source, predicate)
        snap = snap.withColumn(target.ts_col, F.lit(backfill_ts).cast("timestamp_ntz")).withColumn(target.seq_col, F.lit(0).cast("long"))
        target.write(snap, name)
    noted = f"{progress_path.rstrip('/')}/job={job_id}"
    if not path_exists(spark, f"{noted}/_SUCCESS"):
        n = target.batch(name).count()
        spark.createDataFrame([(job_id, n)], "job_id string, n_rows long").coalesce(1).write.mode("overwrite").parquet(noted)
    return spark.read.schema("job_id string, n_rows long").parquet(progress_path)
