"""Queries for filters: F1-F9, F11."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tidemark.functions import filters as FL
from tidemark.plans import derived as D
from tidemark.plans.registry import query

# Filter specs used by the queries (as stored by the filter editor).
V2_SPEC = {
    "version": 2,
    "groups": [
        {
            "conditions": [
                {"column": "l_quantity", "operator": ">", "value": "30"},
                {"column": "l_returnflag", "operator": "=", "value": "N"},
            ],
            "intraLogic": "AND",
        },
        {"conditions": [{"column": "l_discount", "operator": "BETWEEN", "value": "0.02", "value2": "0.04"}]},
        {"conditions": [{"column": "l_comment", "operator": "=", "value": ""}], "intraLogic": "AND"},
        {
            "conditions": [
                {"column": "l_linestatus", "operator": "=", "value": "F"},
                {"column": "l_tax", "operator": "<", "value": "0.02"},
            ],
            "intraLogic": "OR",
        },
    ],
    "interLogic": ["OR", "AND", "AND"],
}


def _lineitem(spark, sf_dir):
    (li,) = D.tables(spark, sf_dir, "lineitem")
    # The empty-valued condition in V2_SPEC names a column that is then
    # dropped; give the frame that column so the schema check passes.
    return li.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_discount", "l_linestatus", "l_tax"
    ).withColumn("l_comment", F.lit(None).cast("string"))


@query(
    "filter_v2_groups",
    """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
WHERE COALESCE((l_quantity > 30 AND l_returnflag = 'N')
            OR (l_discount BETWEEN 0.02 AND 0.04 AND (l_linestatus = 'F' OR l_tax < 0.02)), TRUE)
""",
)
def filter_v2_groups(spark, sf_dir):
    """groups with intra AND/OR, connectives OR then AND (AND binds
    tighter), an empty-valued condition dropped; stream NULL rule."""
    df = _lineitem(spark, sf_dir)
    return FL.apply_filter(df, json.dumps(V2_SPEC), unknown="keep").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount"
    )


@query(
    "filter_legacy",
    """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE (l_quantity > 10) AND (l_returnflag = 'R') AND (l_discount <= 0.05)
""",
)
def filter_legacy(spark, sf_dir):
    """``;``-separated conditions, all AND-ed."""
    df = _lineitem(spark, sf_dir)
    return FL.apply_filter(df, "l_quantity > 10; l_returnflag = 'R' ;; l_discount <= 0.05", unknown="drop").select(
        "l_orderkey", "l_linenumber", "l_quantity"
    )


def _v2(*conds, intra="AND"):
    return {"version": 2, "groups": [{"conditions": list(conds), "intraLogic": intra}], "interLogic": []}


@query(
    "filter_compare",
    """
SELECT event_id FROM events
WHERE user_id >= 7 AND event_type <> 'view' AND value < 50 AND value != 10.5 AND user_id <= 120
""",
)
def filter_compare(spark, sf_dir):
    """comparison operators; '007' against a number column is 7."""
    (ev,) = D.tables(spark, sf_dir, "events")
    spec = _v2(
        {"column": "user_id", "operator": ">=", "value": "007"},
        {"column": "event_type", "operator": "<>", "value": "view"},
        {"column": "value", "operator": "<", "value": "50"},
        {"column": "value", "operator": "!=", "value": "10.5"},
        {"column": "user_id", "operator": "<=", "value": "120"},
    )
    return FL.apply_filter(ev, spec, unknown="drop").select("event_id")


@query(
    "filter_between",
    """
SELECT event_id, ts FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00'
""",
)
def filter_between(spark, sf_dir):
    """BETWEEN on a timestamp column with date-only literals."""
    (ev,) = D.tables(spark, sf_dir, "events")
    spec = _v2({"column": "ts", "operator": "BETWEEN", "value": "2024-01-10", "value2": "2024-01-20"})
    return FL.apply_filter(ev, spec, unknown="drop").select("event_id", "ts")


@query(
    "filter_like",
    """
SELECT doc_id, n_chars FROM documents WHERE text LIKE '%token = "%'
""",
)
def filter_like(spark, sf_dir):
    """LIKE means "contains" (value wrapped in %), over whole documents."""
    (docs,) = D.tables(spark, sf_dir, "documents")
    spec = _v2({"column": "text", "operator": "LIKE", "value": 'token = "'})
    return FL.apply_filter(docs, spec, unknown="drop").select("doc_id", "n_chars")


@query(
    "filter_ilike",
    """
SELECT doc_id, n_chars FROM documents WHERE text ILIKE '%LICEN_ED UNDER%'
""",
)
def filter_ilike(spark, sf_dir):
    """ILIKE contains, case-insensitive; wildcards inside the value stay live."""
    (docs,) = D.tables(spark, sf_dir, "documents")
    spec = _v2({"column": "text", "operator": "ILIKE", "value": "LICEN_ED UNDER"})
    return FL.apply_filter(docs, spec, unknown="drop").select("doc_id", "n_chars")


@query(
    "filter_in",
    """
SELECT o_orderkey, o_orderpriority FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') OR o_custkey IN (1, 2, 3, 7)
""",
)
def filter_in(spark, sf_dir):
    """IN lists, trimmed, blanks dropped, literals typed by the column."""
    (o,) = D.tables(spark, sf_dir, "orders")
    spec = {
        "version": 2,
        "groups": [
            {"conditions": [{"column": "o_orderpriority", "operator": "IN", "value": " 1-URGENT, 2-HIGH ,, "}]},
            {"conditions": [{"column": "o_custkey", "operator": "IN", "value": "1,2, 3,007"}]},
        ],
        "interLogic": ["OR"],
    }
    return FL.apply_filter(o, spec, unknown="drop").select("o_orderkey", "o_orderpriority")


_NULLY = """
WITH nully AS (
  SELECT event_id,
         CASE WHEN event_id % 2 = 0 THEN NULL ELSE event_type END AS event_type,
         CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS value,
         CASE WHEN event_id % 3 = 0 THEN NULL ELSE props END AS props
  FROM events)
"""


def _nully(spark, sf_dir):
    from tidemark.plans.apply_queries import _nully_events

    return _nully_events(spark, sf_dir)


@query(
    "filter_nulls",
    _NULLY
    + """
SELECT event_id FROM nully WHERE event_type IS NULL AND props IS NOT NULL
""",
)
def filter_nulls(spark, sf_dir):
    """IS NULL / IS NOT NULL; a comparison with an empty value is dropped."""
    spec = _v2(
        {"column": "event_type", "operator": "IS NULL"},
        {"column": "props", "operator": "is not null"},
        {"column": "value", "operator": ">", "value": ""},
    )
    return FL.apply_filter(_nully(spark, sf_dir), spec, unknown="drop").select("event_id")


@query(
    "filter_keep_unknown",
    _NULLY
    + """
SELECT event_id, value FROM nully WHERE COALESCE(value > 50 AND event_type <> 'view', TRUE)
""",
)
def filter_keep_unknown(spark, sf_dir):
    """F8: change-stream rule -- rows go only where the predicate is FALSE, so
    rows with an unknown (NULL) predicate stay."""
    spec = _v2(
        {"column": "value", "operator": ">", "value": "50"},
        {"column": "event_type", "operator": "!=", "value": "view"},
    )
    return FL.apply_filter(_nully(spark, sf_dir), spec, unknown="keep").select("event_id", "value")


@query(
    "filter_drop_unknown",
    _NULLY
    + """
SELECT event_id, value FROM nully WHERE value > 50 AND event_type <> 'view'
""",
)
def filter_drop_unknown(spark, sf_dir):
    """backfill rule -- ordinary WHERE, unknown rows are dropped."""
    spec = _v2(
        {"column": "value", "operator": ">", "value": "50"},
        {"column": "event_type", "operator": "!=", "value": "view"},
    )
    return FL.apply_filter(_nully(spark, sf_dir), spec, unknown="drop").select("event_id", "value")


@query(
    "filter_backfill",
    """
SELECT p_partkey, p_type FROM part
WHERE p_type LIKE '%MO' AND p_size IN (1, 5, 10, 15, 20, 25, 30, 35, 40, 45, 50) AND p_retailprice >= 950
""",
)
def filter_backfill(spark, sf_dir):
    """backfill conditions (at most five, AND-ed); LIKE uses the value as
    the whole pattern."""
    (p,) = D.tables(spark, sf_dir, "part")
    conds = [
        {"column": "p_type", "operator": "LIKE", "value": "%MO"},
        {"column": "p_size", "operator": "IN", "value": "1,5,10,15,20,25,30,35,40,45,50"},
        {"column": "p_retailprice", "operator": ">=", "value": "950"},
    ]
    return p.filter(FL.backfill_predicate(conds, p.schema)).select("p_partkey", "p_type")
