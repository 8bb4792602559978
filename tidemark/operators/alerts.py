"""Alert state machines and alert tables.

V5 -- iteration counter.  Alerts with the same key fold into one notification
row: an alert updates the key's latest row while its counter is below the limit
(or the alert is forced), raising the counter; otherwise it opens a new row with
counter 1.

V6 -- throttle.  A new notification is created for an attempt when the key has
none yet, when the previous one was already sent or read, or when the last
*created* one is at least five minutes old.

Both are greedy runs over a key's ordered rows (``operators/runs.py``): which row
opens the next run depends on the row that opened the last, so a key that holds a
third of all alerts is split over tasks and the jumps between them are doubled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import runs

ITERATION_LIMIT = 3
THROTTLE_MINUTES = 5

# Message fragments that force delivery of an alert.
FORCE_MARKERS = ("connection", "refused", "timeout", "operationalerror")


# ---------------------------------------------------------------- V5, V6


def iteration_fold(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    force_col: str,
    limit: int = ITERATION_LIMIT,
    partitions: int | None = None,
) -> DataFrame:
    """V5: for every alert, which notification row of its key absorbs it
    (``notification_no``, 1-based) and that row's counter after it
    (``iteration_check``).  ``order`` must be a total order within a key (end it
    with a unique id); an unknown force flag is not forced."""
    staged = df.withColumn("__free", ~F.coalesce(F.col(force_col), F.lit(False)))
    rule = runs.Rule("index", limit - 1)
    out = runs.greedy_runs(staged, [key], order, rule, eligible="__free", run="notification_no", place="iteration_check", partitions=partitions)
    return out.withColumn("iteration_check", F.col("iteration_check").cast("int")).drop("__free")


def throttle(df: DataFrame, key: str, ts_col: str, tiebreak: str, acked_col: str, minutes: int = THROTTLE_MINUTES, partitions: int | None = None) -> DataFrame:
    """V6: ``create`` per attempt -- the first attempt of a key, an attempt
    whose previous notification was already sent or read (``acked_col``), or
    one at least ``minutes`` after the last created notification."""
    staged = df.withColumn("__t", F.unix_micros(F.col(ts_col).cast("timestamp")))
    rule = runs.Rule("value", minutes * 60 * 1_000_000 - 1)
    out = runs.greedy_runs(staged, [key], ["__t", tiebreak], rule, value="__t", always=acked_col, place="__place", run="__run", partitions=partitions)
    return out.withColumn("create", F.col("__place") == 1).drop("__t", "__run", "__place")


# ---------------------------------------------------------------- M9, M10


def force_flag(message: Column) -> Column:
    low = F.lower(message)
    cond = None
    for m in FORCE_MARKERS:
        c = low.contains(m)
        cond = c if cond is None else cond | c
    return cond


def compose(failures: DataFrame) -> DataFrame:
    """M9: the notification for each destination failure: key from pipeline,
    destination, table and error type; connection problems are errors, others
    warnings; the force flag follows the message text."""
    msg = F.col("error_message")
    is_conn = F.lower(msg).contains("connection") | (F.col("error_type") == "CONNECTION_ERROR")
    key = F.concat(
        F.lit("pipeline_"), F.col("pipeline_id").cast("string"), F.lit("_dest_"), F.col("destination_id").cast("string"),
        F.lit("_table_"), F.col("table_name"), F.lit("_"), F.col("error_type"),
    )
    title = F.when(is_conn, F.concat(F.lit("Destination Connection Failed: "), F.col("destination_name"))).otherwise(
        F.concat(F.lit("Destination Error: "), F.col("destination_name"))
    )
    return failures.select(
        "*",
        key.alias("key_notification"),
        F.when(is_conn, "ERROR").otherwise("WARNING").alias("type"),
        title.alias("title"),
        force_flag(msg).alias("is_force_sent"),
    )


def error_state(outcomes: DataFrame, branch: Sequence[str], seq_col: str) -> DataFrame:
    """Per branch, the state after its latest outcome: in error with
    that failure's message, or cleared by a later success.  ``max_by`` is a
    partial aggregate, so a busy branch is reduced map-side."""
    latest = outcomes.groupBy(*branch).agg(
        F.max_by(F.struct("ok", "error_message"), F.col(seq_col)).alias("__l"),
        F.max(F.when(~F.col("ok"), F.col(seq_col))).alias("last_error_seq"),
    )
    return latest.select(
        *branch,
        (~F.col("__l.ok")).alias("is_error"),
        F.when(~F.col("__l.ok"), F.col("__l.error_message")).alias("error_message"),
        "last_error_seq",
    )
