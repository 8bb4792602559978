"""Named queries over the driver tables, each with an optional SQL twin."""

from __future__ import annotations

import importlib

MODULES = [
    "apply_queries",
    "filter_queries",
    "decode_queries",
    "join_queries",
    "backfill_queries",
    "monitor_queries",
    "schema_queries",
    "dlq_queries",
    "alert_queries",
    "stream_queries",
    "drift_queries",
]


def load_all():
    """Import every query module; returns (queries, oracle_sql) dicts."""
    for name in MODULES:
        importlib.import_module(f"tidemark.plans.{name}")
    from tidemark.plans.registry import ORACLE, QUERIES

    return QUERIES, ORACLE
