"""Dead-letter queue as tables.

A dead letter is a row: the failed change record (a VARIANT, so one table holds the
rows of all source tables with their own columns and types), its routing
(pipeline, source, table, destination, target), the branch configuration it was
processed with, an error text, ``retry_count`` and ``first_failed_at``; batch jobs
and streams write the same shape.  A queue is the set of rows with one
(source, table, destination); the queue key text is
``<prefix>:s<source>:t<table>:d<destination>`` (table names may contain dots
and colons).  Every queue operation is a filter, join or aggregate over the
whole table -- per-queue limits are found by counting, so a queue holding a third
of all dead letters is never ordered as a whole.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import ordering as O

# Queue limits.
MAX_QUEUE_LENGTH = 100_000
BATCH_SIZE = 100
MAX_RETRY_COUNT = 10
MAX_AGE_DAYS = 7
CHECK_INTERVAL_SECONDS = 30
DEFAULT_PREFIX = "dlq"

QUEUE = ["source_id", "table_name", "destination_id"]


def queue_key(prefix: str = DEFAULT_PREFIX) -> Column:
    return F.concat(
        F.lit(f"{prefix}:s"), F.col("source_id").cast("string"), F.lit(":t"), F.col("table_name"), F.lit(":d"), F.col("destination_id").cast("string")
    )


def parse_queue_key(key: Column, prefix: str = DEFAULT_PREFIX) -> tuple[Column, Column, Column]:
    """(source_id, table_name, destination_id); NULLs when the text is not a
    queue key of this prefix."""
    import re

    pattern = rf"^{re.escape(prefix)}:s(\d+):t(.+):d(\d+)$"
    ok = key.rlike(pattern)
    return (
        F.when(ok, F.regexp_extract(key, pattern, 1).cast("int")),
        F.when(ok, F.regexp_extract(key, pattern, 2)),
        F.when(ok, F.regexp_extract(key, pattern, 3).cast("int")),
    )


CONFIG = "struct<branch: string, filter: string, sql: string>"
CHANGE = ("op", "table_name", "key", "ts_ms")  # of a decoded change; the rest is the record
RAW = "__raw"  # the text of a change that could not be decoded


def branch_config(name: str, filter_spec=None, sql: str | None = None) -> dict:
    """The part of a branch's configuration that a dead letter keeps."""
    spec = filter_spec if filter_spec is None or isinstance(filter_spec, str) else json.dumps(filter_spec, sort_keys=True)
    return {"branch": name, "filter": spec, "sql": sql}


def stored_config(config) -> dict:
    """The filter and SQL of a stored configuration."""
    return {"filter": config["filter"], "sql": config["sql"]}


def _as_column(value, kind: str) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast(kind)


def dead_letters(failed: DataFrame, routing: Mapping, config: Mapping, error: Column, failed_at: Column | None = None) -> DataFrame:
    """Failed changes (``op, table_name, key, ts_ms`` and the table's columns)
    become dead letters with retry 0.  ``routing`` and ``config`` hold values or
    columns.  ``message_id`` is a hash of the change and its route, so a batch that
    is delivered again writes the same ids."""
    record = F.to_variant_object(F.struct(*[F.col(c) for c in failed.columns if c not in CHANGE]))
    at = lambda c: F.col(c) if c in failed.columns else F.lit(None)
    out = failed.select(
        *[_as_column(routing[c], kind).alias(c) for c, kind in (("pipeline_id", "int"), ("source_id", "int"), ("table_name", "string"), ("destination_id", "int"), ("target_name", "string"))],
        at("op").cast("string").alias("operation"),
        at("key").cast("string").alias("key"),
        at("ts_ms").cast("long").alias("changed_ms"),
        record.alias("record"),
        F.struct(*[_as_column(config[c], "string").alias(c) for c in ("branch", "filter", "sql")]).alias("config"),
        error.cast("string").alias("error"),
        F.lit(0).alias("retry_count"),
        (failed_at if failed_at is not None else F.current_timestamp()).cast("timestamp_ntz").alias("first_failed_at"),
    )
    what = F.xxhash64("source_id", "table_name", "destination_id", "config.branch", "operation", "key", "changed_ms", F.to_json("record"))
    return out.select(what.alias("message_id"), "*")


def restore_records(letters: DataFrame, schema: T.StructType) -> DataFrame:
    """The changes of one table's dead letters, with the columns and types that
    the table has now: each value is read from the record by its name, one that
    the type can't take is NULL.  Changes that were never decoded are left out."""
    out = []
    for f in schema.fields:
        if f.name in CHANGE:
            out.append(F.col({"op": "operation", "ts_ms": "changed_ms"}.get(f.name, f.name)).alias(f.name))
        else:
            path = "$['" + f.name.replace("\\", "\\\\").replace("'", "\\'") + "']"
            out.append(F.try_variant_get("record", path, f.dataType.simpleString()).alias(f.name))
    return letters.filter(decoded()).select(*out)


def decoded() -> Column:
    """Whether a dead letter holds a decoded change."""
    return F.try_variant_get("record", f"$.{RAW}", "string").isNull()


# Full microsecond precision in message bodies (the JSON default keeps ms).
JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def serialize(df: DataFrame, payload_cols: Sequence[str]) -> DataFrame:
    """Message body as JSON text (routing columns stay columns)."""
    keep = [c for c in df.columns if c not in payload_cols]
    return df.select(*keep, F.to_json(F.struct(*[F.col(c) for c in payload_cols]), JSON_OPTIONS).alias("body"))


def restore(df: DataFrame, payload_schema: T.StructType) -> DataFrame:
    """Inverse of ``serialize``."""
    keep = [c for c in df.columns if c != "body"]
    return df.select(*keep, F.from_json("body", payload_schema, JSON_OPTIONS).alias("__b")).select(*keep, "__b.*")


def cap(df: DataFrame, id_col: str, max_len: int = MAX_QUEUE_LENGTH) -> DataFrame:
    """D3: keep the newest ``max_len`` messages of every queue.  The oldest one
    kept is found by counts, so queues are neither sorted nor shuffled."""
    return O.first_n(df, QUEUE, id_col, max_len, descending=True)


def batch(df: DataFrame, id_col: str, size: int = BATCH_SIZE) -> DataFrame:
    """The oldest ``size`` messages of every queue (the next batch), found
    like the cap's."""
    return O.first_n(df, QUEUE, id_col, size)


def stale_claims(df: DataFrame, now: str, min_idle_seconds: int = 3 * CHECK_INTERVAL_SECONDS, consumer: str = "worker-0") -> DataFrame:
    """In-flight messages idle for at least ``min_idle_seconds`` (all
    in-flight ones when 0, as at startup) are claimed by ``consumer``."""
    now_ts = F.lit(now).cast("timestamp_ntz")
    idle = F.unix_micros(now_ts.cast("timestamp")) - F.unix_micros(F.col("claimed_at").cast("timestamp"))
    stale = F.col("claimed_at").isNotNull() & (idle >= F.lit(min_idle_seconds * 1_000_000))
    return df.filter(stale).withColumn("claimed_by", F.lit(consumer)).withColumn("claimed_at", now_ts)


def ack(df: DataFrame, done: DataFrame, id_col: str) -> DataFrame:
    """Remove acknowledged messages."""
    return df.join(done.select(id_col).distinct(), id_col, "left_anti")


def retry_split(df: DataFrame, max_retry: int = MAX_RETRY_COUNT) -> DataFrame:
    """After a failed retry the count goes up by one; messages reaching
    the limit are discarded, the rest go back to the tail of their queue."""
    n = F.col("retry_count") + 1
    return df.withColumn("action", F.when(n >= max_retry, "discard").otherwise("requeue")).withColumn("retry_count", n)


def purge(df: DataFrame, now: str, max_retry: int = MAX_RETRY_COUNT, max_age_days: int = MAX_AGE_DAYS) -> DataFrame:
    """Drop messages retried ``max_retry`` times or older than
    ``max_age_days``; returns the survivors."""
    cutoff = F.lit(now).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(max_age_days)} DAYS")
    doomed = (F.col("retry_count") >= max_retry) | (F.col("first_failed_at") < cutoff)
    return df.filter(~doomed)


def depth(df: DataFrame) -> DataFrame:
    """Messages per queue, deepest first (ties by key), plus the total."""
    per = df.groupBy(*QUEUE).agg(F.count("*").alias("depth"))
    return per


def queues(df: DataFrame, prefix: str = DEFAULT_PREFIX) -> DataFrame:
    """The queues that have messages, with their key text."""
    return df.groupBy(*QUEUE).agg(F.count("*").alias("n_messages")).withColumn("queue_key", queue_key(prefix))


def delete_queue(df: DataFrame, source_id: int, table_name: str, destination_id: int) -> DataFrame:
    """Drop one queue."""
    hit = (F.col("source_id") == source_id) & (F.col("table_name") == table_name) & (F.col("destination_id") == destination_id)
    return df.filter(~hit)


def effective_config(messages: DataFrame, current: DataFrame, on: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Each message's branch configuration: the branch's current one if
    it still exists, else the one stored with the message."""
    cur = current.select(*on, *[F.col(c).alias(f"__cur_{c}") for c in cols])
    j = messages.join(cur, list(on), "left")
    for c in cols:
        j = j.withColumn(c, F.coalesce(F.col(f"__cur_{c}"), F.col(c))).drop(f"__cur_{c}")
    return j
