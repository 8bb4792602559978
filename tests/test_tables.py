"""Retention by day, key search, open pivots, health, aggregates kept by deltas."""

import datetime as dt
import os
import random
import tempfile

from pyspark.sql import functions as F

from tidemark.operators import incremental as I
from tidemark.operators import monitor as M
from tidemark.sources import catalog as C


def test_retention_touches_only_the_days_it_must(spark):
    base = tempfile.mkdtemp(prefix="tm-days-") + "/t"
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)) for i in range(24 * 5)] + [(999, None)]
    df = spark.createDataFrame(rows, "id long, at timestamp_ntz")
    df.withColumn("day", F.to_date("at").cast("string")).repartition(3).write.partitionBy("day").parquet(base)
    files = lambda: {d: sorted(f for f in os.listdir(f"{base}/{d}") if f.endswith(".parquet")) for d in os.listdir(base) if d.startswith("day=")}
    before = files()
    done = M.prune_days(spark, base, "day", "at", "2024-01-03 07:00:00")
    after = files()
    assert done == {"dropped": ["2024-01-01", "2024-01-02"], "rewritten": True}
    assert set(after) == {"day=2024-01-03", "day=2024-01-04", "day=2024-01-05", "day=__HIVE_DEFAULT_PARTITION__"}
    assert all(after[d] == before[d] for d in after if d != "day=2024-01-03") and after["day=2024-01-03"] != before["day=2024-01-03"]
    assert sorted(r.id for r in spark.read.parquet(base).collect()) == [*range(24 * 2 + 7, 24 * 5), 999]
    # At midnight nothing is rewritten; a day that goes as a whole goes.
    assert M.prune_days(spark, base, "day", "at", "2024-01-04 00:00:00") == {"dropped": ["2024-01-03"], "rewritten": False}
    M.prune_days(spark, base, "day", "at", "2024-01-05 23:59:00")
    assert sorted(r.id for r in spark.read.parquet(base).collect()) == [999]


def test_least_keys(spark):
    rng = random.Random(1)
    rows = [(i // 10, i % 10, rng.randint(0, 5), i, "same") for i in range(1000)]
    df = spark.createDataFrame(rows, "a int, b int, c int, d long, e string")
    assert C.least_keys(df) == [("d",)]
    assert C.least_keys(df.drop("d")) == [("a", "b")]
    assert C.least_keys(df.drop("d").withColumn("f", F.col("a") + 1)) == [("a", "b"), ("b", "f")]
    assert C.least_keys(df.select("c", "e")) == []
    assert C.least_keys(df.drop("d").unionByName(df.drop("d").limit(1))) == []  # one row twice
    holes = df.withColumn("d", F.when(F.col("d") != 5, F.col("d")))
    assert C.least_keys(holes) == [("a", "b")]  # a column with a NULL is in no key
    assert C.least_keys(df.where("false")) == [] and C.least_keys(df, max_width=1) == [("d",)]
    three = spark.createDataFrame([(i % 5, i // 5 % 5, i // 25) for i in range(125)], "x int, y int, z int")
    assert C.least_keys(three) == [("x", "y", "z")] and C.least_keys(three, max_width=2) == []


def test_open_pivots(spark):
    rows = [(f"p{i % 4}", i, dt.datetime(2024, 1, 2 + i % 3, i % 24)) for i in range(40)]
    df = spark.createDataFrame(rows, "name string, v long, at timestamp_ntz")
    assert M.pivot_names(df, "name", "v") == ["p0", "p1", "p2", "p3"]
    wide = M.daily_pivot(df, "at", "name", "v", "2024-01-01", 3)
    assert wide.columns == ["day", "p0", "p1", "p2", "p3"] and wide.count() == 4
    # A new pipeline appears without a change; a NULL name and small ones share a column.
    more = df.unionByName(spark.createDataFrame([("new", 1000, dt.datetime(2024, 1, 2)), (None, 7, dt.datetime(2024, 1, 3))], df.schema))
    assert M.pivot_names(more, "name", "v") == ["new", "p0", "p1", "p2", "p3", "other"]
    assert M.pivot_names(more, "name", "v", 2) == ["new", "p3", "other"]
    sums = M.daily_pivot(more, "at", "name", "v", "2024-01-01", 3)
    assert sum(sum(r[1:]) for r in sums.collect()) == sum(r[1] for r in rows) + 1007
    hours = M.hourly_avg_pivot(more, "at", "name", "v", "2024-01-01")
    assert set(hours.columns) == {"hour", "new", "p0", "p1", "p2", "p3", "other"}
    assert M.daily_pivot(df.where("false"), "at", "name", "v", "2024-01-01", 3).columns == ["day"]


def test_health_lists_tables_that_never_succeeded(spark):
    at = lambda h: dt.datetime(2024, 1, 1, h)
    writes = spark.createDataFrame([("a", True, at(9)), ("b", True, at(5)), ("b", False, at(9)), ("c", False, at(9))], "table_name string, ok boolean, created_at timestamp_ntz")
    tables = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("d",)], "table_name string")
    got = {r.table_name: r.last_seen for r in M.unhealthy(tables, writes, "2024-01-01 09:30:00", F.col("ok")).collect()}
    assert got == {"b": at(5), "c": None, "d": None}


def test_aggregate_by_deltas_equals_a_full_one(spark):
    """Moves between groups, removed greatest values, emptied and new groups, NULLs."""
    for seed in range(3):
        rng = random.Random(seed)
        one = lambda k: (k, rng.choice([None, "a", "b", "c", "d"]), rng.choice([None, rng.randint(0, 9)]), rng.choice(["x", "y", None]))
        rows = [one(k) for k in range(60)]
        changes = [(*one(rng.randint(0, 90)), rng.choice(["c", "u", "d", None, "D"]), rng.randint(0, 5), i) for i in range(80)]
        changes += [(k, "gone", 3, "x", "d", 9, 100 + k) for k in range(60) if rows[k][1] == "d"]
        kind = "k long, g string, v long, label string"
        before = spark.createDataFrame(rows, kind)
        batch = spark.createDataFrame(changes, f"{kind}, op string, ts long, seq long")
        got = I.apply_deltas(I.aggregate(before, ["g"], "v", "label"), before, batch, ["k"], ["g"], "v", "label")
        after = {r[0]: r for r in rows}
        latest = {}
        for c in changes:
            if c[0] not in latest or c[5:7] > latest[c[0]][5:7]:
                latest[c[0]] = c
        for k, c in latest.items():
            after.pop(k, None)
            if (c[4] or "u").lower() != "d":
                after[k] = c[:4]
        want = I.aggregate(spark.createDataFrame(list(after.values()), kind), ["g"], "v", "label")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert "d" not in {r.g for r in got.collect()} or any(r[1] == "d" for r in after.values())
