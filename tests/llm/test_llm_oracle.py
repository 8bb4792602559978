"""Queries with a SQL twin, against DuckDB on sf0.001."""

import pytest

from conftest import SF
from tidemark.llm.registry import ORACLE, QUERIES
from tools.oracle_check import rows_of


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF)
    cur = duck.execute(ORACLE[key])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, cur.fetchall())
