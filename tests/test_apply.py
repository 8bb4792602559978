from pyspark.sql import functions as F

from tidemark.operators import apply as A
from tidemark.operators import ordering as O


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_merge_semantics(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, v string")
    changes = spark.createDataFrame(
        [(1, "a2", "u", 10, 1), (2, None, "D", 10, 1), (4, "d", "c", 10, 1), (4, "d2", "u", 10, 2), (5, "e", "c", 9, 1), (5, None, "d", 11, 1)],
        "k long, v string, op string, ts long, seq long",
    )
    out = A.apply_changes(target, changes, ["k"])
    assert _rows(out) == [(1, "a2"), (3, "c"), (4, "d2")]


def test_replay_and_order_independence(spark):
    target = spark.createDataFrame([(i, f"v{i}") for i in range(20)], "k long, v string")
    log = [(i % 7, f"x{j}", "d" if j % 5 == 0 else "u", j // 3, j) for j, i in enumerate(range(60))]
    changes = spark.createDataFrame(log, "k long, v string, op string, ts long, seq long")
    once = A.apply_changes(target, changes, ["k"])
    twice = A.apply_changes(once, changes, ["k"])
    shuffled = A.apply_changes(target, changes.orderBy(F.rand(7)), ["k"])
    assert _rows(once) == _rows(twice) == _rows(shuffled)


def test_out_of_order_ignored(spark):
    target = spark.createDataFrame([(1, "new", 100)], "k long, v string, ts long")
    changes = spark.createDataFrame([(1, "old", "u", 50, 1)], "k long, v string, op string, ts long, seq long")
    out = A.apply_changes(target, changes, ["k"], target_ts_col="ts")
    assert _rows(out) == [(1, "new", 100)]


def test_composite_upsert_dedups_batch(spark):
    target = spark.createDataFrame([(1, 1, "t")], "a long, b long, v string")
    batch = spark.createDataFrame([(1, 1, "x", 1), (1, 1, "y", 2), (2, 1, "z", 1)], "a long, b long, v string, o long")
    out = A.upsert(target, batch, ["a", "b"], order=["o"])
    assert _rows(out) == [(1, 1, "y"), (2, 1, "z")]


def test_group_rank_matches_window(spark):
    from pyspark.sql import Window

    rows = [(g, float(v)) for g in ("x", "y") for v in [5, 3, 3, 9, 1, 9, 2]] + [("z", 4.0)]
    df = spark.createDataFrame(rows, "g string, v double").withColumn("id", F.monotonically_increasing_id())
    got = O.group_rank(df, ["g"], "v", True, "r", partitions=3)
    want = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.col("v").desc())))
    assert _rows(got.select("id", "r")) == _rows(want.select("id", "r"))


def test_global_index_contiguous(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"))
    idx = O.global_index(df, ["k"], "i", partitions=5)
    assert _rows(idx.select("k", "i")) == [(k, k) for k in range(1000)]


def test_size_batches_bounded(spark):
    df = spark.createDataFrame([(i, "x" * (i * 10)) for i in range(50)], "id long, t string").repartition(3)
    out = A.size_bounded_batches(df, ["id"], limit_bytes=500).collect()
    sizes = {}
    for r in out:
        sizes[(r.part_id, r.batch_no)] = sizes.get((r.part_id, r.batch_no), 0) + r.row_bytes
    singles = {(r.part_id, r.batch_no) for r in out if r.row_bytes > 500}
    assert all(v <= 500 or k in singles for k, v in sizes.items())
    assert len(out) == 50


def test_size_batches_match_greedy(spark):
    import random

    rnd = random.Random(5)
    rows = [(i, "y" * rnd.randint(0, 400)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, t string").coalesce(1)
    out = sorted(A.size_bounded_batches(df, ["id"], limit_bytes=1000).collect(), key=lambda r: r.id)
    batch, used, want = 0, 0, []
    for r in out:
        if used > 0 and used + r.row_bytes > 1000:
            batch, used = batch + 1, 0
        used += r.row_bytes
        want.append(batch)
    assert [r.batch_no for r in out] == want


def test_merge_with_hot_key(spark):
    # One key holds a third of all changes; the result must still be exact.
    log = [(0 if i % 3 == 0 else i, f"v{i}", "u", i, i) for i in range(3000)]
    changes = spark.createDataFrame(log, "k long, v string, op string, ts long, seq long").repartition(7)
    target = spark.createDataFrame([(0, "old"), (5, "keep")], "k long, v string")
    out = dict((r.k, r.v) for r in A.apply_changes(target, changes, ["k"]).collect())
    assert out[0] == "v2997" and len(out) == 1 + 2000 + (0 if 5 in {i for i in range(3000) if i % 3} else 1)


def test_group_prefix_sum_matches_window(spark):
    from pyspark.sql import Window

    rows = [("hot" if i % 2 else f"g{i % 5}", i, float(i % 13)) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, o long, v double")
    got = O.group_prefix_sum(df, ["g"], ["o"], "v", "s", partitions=7)
    w = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("s", F.sum("v").over(w))
    assert _rows(got.select("g", "o", "s")) == _rows(want.select("g", "o", "s"))


def test_merge_into_statement_and_fallback(spark, tmp_path):
    stmt = A.merge_into_statement("db.t", "src", ["k"], ["k", "v"])
    assert stmt.startswith("MERGE INTO db.t AS t USING src AS s ON t.`k` = s.`k`")
    assert "WHEN MATCHED AND coalesce(lower(s.`op`), 'u') = 'd' THEN DELETE" in stmt and "INSERT (`k`, `v`) VALUES (s.`k`, s.`v`)" in stmt
    # A Parquet-backed view cannot be merged into: the call reports it so the
    # caller falls back to the DataFrame apply.
    spark.createDataFrame([(1, "a")], "k long, v string").write.parquet(str(tmp_path / "t"))
    spark.read.parquet(str(tmp_path / "t")).createOrReplaceTempView("merge_target_view")
    changes = spark.createDataFrame([(1, "b", "u", 1, 1)], "k long, v string, op string, ts long, seq long")
    assert A.merge_into(spark, "merge_target_view", changes, ["k"], columns=["k", "v"]) is False


def test_latest_per_key_keys_only(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k long")
    assert _rows(A.latest_per_key(df, ["k"], ["k"])) == [(1,), (2,)]


def test_null_operation_and_null_key(spark):
    """A change without an operation is an update; a replay with a NULL key
    doesn't double the row."""
    target = spark.createDataFrame([(1, "a")], "k long, v string")
    log = spark.createDataFrame([(1, "b", None, 1, 1), (None, "n", "c", 2, 2)], "k long, v string, op string, ts long, seq long")
    once = A.apply_changes(target, log, ["k"], "ts", "seq", "op")
    again = A.apply_changes(once, log, ["k"], "ts", "seq", "op")
    for got in (once, again):
        assert sorted(((r.k, r.v) for r in got.collect()), key=str) == [(1, "b"), (None, "n")]


def test_merge_into_statement_gives_the_rows_of_apply_changes(spark):
    """The statement, run by another engine: changes without an operation, late
    changes, deletes of unknown keys, NULL keys, and a table of keys only."""
    import datetime as dt

    import duckdb

    t = lambda h: dt.datetime(2024, 1, 1, h)
    target = [(1, "a", t(5)), (2, "b", t(5)), (3, "c", None), (4, "d", t(5)), (5, "e", t(5))]
    changes = [(1, "A", t(6), None, 1), (2, "B", t(4), "u", 2), (3, "C", t(1), "U", 3), (4, "D", t(6), "D", 4), (5, "E", t(5), "d", 5), (6, "F", t(2), None, 6), (7, "G", t(2), "d", 7), (8, "H", t(2), "c", 8), (8, "I", t(3), "u", 9)]
    con = duckdb.connect()
    con.execute("CREATE TABLE tgt (k BIGINT, v VARCHAR, ts TIMESTAMP)")
    con.executemany("INSERT INTO tgt VALUES (?, ?, ?)", target)
    tdf = spark.createDataFrame(target, "k long, v string, ts timestamp_ntz")
    cdf = spark.createDataFrame(changes, "k long, v string, ts timestamp_ntz, op string, seq long")
    latest = A.latest_per_key(cdf, ["k"], ["ts", "seq"]).collect()
    con.execute("CREATE TABLE src (k BIGINT, v VARCHAR, ts TIMESTAMP, op VARCHAR, seq BIGINT)")
    con.executemany("INSERT INTO src VALUES (?, ?, ?, ?, ?)", [tuple(r) for r in latest])
    con.execute("CREATE TABLE keys AS SELECT k FROM tgt")
    con.execute("CREATE TABLE other AS SELECT * FROM tgt")
    run = lambda *a, **b: con.execute(A.merge_into_statement(*a, **b).replace("`", '"'))
    run("tgt", "src", ["k"], ["k", "v", "ts"], ts_col="ts", target_ts_col="ts")
    want = A.apply_changes(tdf, cdf, ["k"], target_ts_col="ts").collect()
    assert sorted(con.execute("SELECT * FROM tgt").fetchall()) == sorted(map(tuple, want))
    assert {(r.k, r.v) for r in want} == {(1, "A"), (2, "b"), (3, "C"), (5, "e"), (6, "F"), (8, "I")}
    run("other", "src", ["k"], ["k", "v", "ts"])
    assert sorted(con.execute("SELECT * FROM other").fetchall()) == sorted(map(tuple, A.apply_changes(tdf, cdf, ["k"]).collect()))
    run("keys", "src", ["k"], ["k"])
    assert sorted(con.execute("SELECT k FROM keys").fetchall()) == [(1,), (2,), (3,), (6,), (8,)]
