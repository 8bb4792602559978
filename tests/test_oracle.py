"""Every registered query against its SQL twin (DuckDB) on sf0.001, and every
query without a twin runs and returns a stable schema."""

from collections import Counter

import pytest

import __spark_entry__ as E
from conftest import SF
from tools.oracle_check import rows_of

# The training-data operators have tests of their own (tests/llm).
QUERIES = {k: v for k, v in E.queries().items() if k not in E.LLM_QUERIES}
ORACLE = {k: v for k, v in E.oracle_sql().items() if k not in E.LLM_QUERIES}


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF)
    names = df.columns
    got = rows_of(names, [tuple(r) for r in df.collect()])
    cur = duck.execute(ORACLE[key])
    onames = [d[0] for d in cur.description]
    want = rows_of(onames, cur.fetchall())
    assert sorted(names) == sorted(onames)
    assert got == want


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only(spark, key):
    df = QUERIES[key](spark, SF)
    schema = df.schema
    n = df.count()
    assert n >= 0
    assert QUERIES[key](spark, SF).schema == schema


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert Counter(df.columns) == Counter(
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    )


def test_time_columns_declared(spark):
    """The SQL twins render exactly the timestamp columns the Spark results
    have (checked against the raw, unpresented query results)."""
    from pyspark.sql import types as T

    from tidemark.plans import load_all
    from tidemark.plans.present import TIME_COLUMNS

    raw, _ = load_all()
    for key in ["merge_apply", "decode_timestamp", "landing_append", "backfill_recover", "lag_hourly_avg", "history_balance"]:
        df = raw[key](spark, SF)
        got = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))]
        assert got == TIME_COLUMNS.get(key, []), key
