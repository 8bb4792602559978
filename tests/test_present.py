import datetime as dt

import duckdb

from tidemark.plans import present as P


def test_present_spark_and_sql_agree(spark):
    rows = [(1, dt.datetime(2024, 1, 2, 3, 4, 5, 6), 7), (2, None, None)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, n long")
    P.TIME_COLUMNS["__probe"] = ["ts"]
    P.NULLABLE_TEXT_COLUMNS["__probe"] = ["n"]
    try:
        got = sorted(tuple(r) for r in P.present(df, "__probe").collect())
        sql = P.present_sql("__probe", "SELECT * FROM (VALUES (1, TIMESTAMP '2024-01-02 03:04:05.000006', 7), (2, NULL, NULL)) v(id, ts, n)")
        want = sorted(duckdb.sql(sql).fetchall())
    finally:
        del P.TIME_COLUMNS["__probe"], P.NULLABLE_TEXT_COLUMNS["__probe"]
    assert got == want == [(1, "2024-01-02 03:04:05.000006", "7"), (2, None, None)]


def test_present_sql_untouched_without_columns():
    assert P.present_sql("no_such_key", "SELECT 1") == "SELECT 1"
