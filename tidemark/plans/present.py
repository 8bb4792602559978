"""Presentation of query results for cross-engine comparison.

Library operators return real timestamps.  At the registry boundary, the
result's timestamp and date columns are rendered as ISO text
(``YYYY-MM-DD HH:MM:SS.ffffff`` / ``YYYY-MM-DD``) -- identically by Spark and
by the SQL twins -- so that a comparison does not depend on how each engine
hands timestamps to client libraries (e.g. nanosecond vs microsecond units).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Timestamp columns of each query's result (kept equal to the Spark schemas by
# tests/test_oracle.py::test_time_columns_declared).
TIME_COLUMNS = {
    'activity_feed': ['ts'],
    'apply_delete_as_upsert': ['o_orderdate'],
    'apply_upsert': ['o_orderdate'],
    'apply_upsert_composite': ['l_shipdate'],
    'apply_upsert_null_safe': ['o_orderdate'],
    'backfill_next_jobs': ['created_at', 'updated_at'],
    'backfill_offset_page': ['l_shipdate'],
    'backfill_recover': ['created_at', 'updated_at'],
    'cdc_parse_envelope': ['ts'],
    'decode_all_types': ['placed_at'],
    'decode_date': ['changed_at'],
    'decode_timestamp': ['ts_from_ms', 'ts_from_us', 'ts_from_ns'],
    'dlq_enqueue': ['first_failed_at'],
    'dlq_purge': ['first_failed_at'],
    'dlq_replay': ['ts'],
    'dlq_roundtrip': ['first_failed_at'],
    'dlq_stale_claims': ['claimed_at'],
    'evolve_target': ['o_orderdate'],
    'filter_between': ['ts'],
    'health_unhealthy': ['last_seen'],
    'history_balance': ['ordered_at'],
    'key_anti': ['l_shipdate'],
    'lag_hourly_avg': ['hour'],
    'lag_range_units': ['recorded_at'],
    'landing_append': ['TS', 'SYNC_TIMESTAMP'],
    'landing_incremental_merge': ['TS', 'SYNC_TIMESTAMP'],
    'latest_per_key': ['recorded_at'],
    'merge_apply': ['o_orderdate'],
    'merge_latest': ['ts'],
    'merge_out_of_order': ['o_orderdate', 'ts'],
    'merge_replay_idempotent': ['o_orderdate'],
    'page_newest': ['created_at'],
    'retention_partitions': ['created_at'],
    'retention_prune': ['created_at'],
    'schema_history_dedup': ['created_at'],
    'schema_versions': ['created_at'],
    'state_upsert': ['recorded_at'],
    'stream_apply': ['ts'],
    'stream_lag_hourly': ['hour'],
    'stream_restart': ['ts'],
    'stream_schema_drift': ['ts'],
    'transform_passthrough': ['ts'],
}

# Integer / boolean columns that hold NULLs in some rows: rendered as text on
# both sides (client libraries turn them into floats on one side and nullable
# integers on the other).
NULLABLE_TEXT_COLUMNS = {
    "apply_upsert_null_safe": ["ck"],
    "backfill_recover": ["last_pk_value"],
    "catalog_columns": ["numeric_precision", "numeric_scale"],
    "decode_type_catalog": ["scale"],
    "dlq_depth": ["source_id", "destination_id"],
    "evolve_target": ["o_flag"],
}

TS_FORMAT_SPARK = "yyyy-MM-dd HH:mm:ss.SSSSSS"
TS_FORMAT_SQL = "%Y-%m-%d %H:%M:%S.%f"


def present(df: DataFrame, key: str | None = None) -> DataFrame:
    text = set(NULLABLE_TEXT_COLUMNS.get(key, ()))
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in text:
            out.append(c.cast("string").alias(f.name))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            out.append(F.date_format(c, TS_FORMAT_SPARK).alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            out.append(F.date_format(c, "yyyy-MM-dd").alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def present_sql(key: str, sql: str) -> str:
    fmt = "'" + TS_FORMAT_SQL + "'"
    parts = [f'strftime("{c}", {fmt}) AS "{c}"' for c in TIME_COLUMNS.get(key, ())]
    parts += [f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in NULLABLE_TEXT_COLUMNS.get(key, ())]
    if not parts:
        return sql
    return f"SELECT * REPLACE ({', '.join(parts)}) FROM (\n{sql}\n) AS presented"
